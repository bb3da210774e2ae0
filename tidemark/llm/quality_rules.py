"""Quality rules: fixed base rules and a decision list learned by sequential covering.

Statistics, base rules and verdicts are Spark expressions alone. The list is learned on the driver
from the statistics of a bounded sample of labelled rows, weighted back to the labels' own shares,
and comes back as an ordered conditional expression that any DataFrame with the statistics can use.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import labelled

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Shares that thresholds are set on.
FEATURES = ("repeat_share", "dup_line_share", "symbol_share", "upper_share", "mark_share", "digit_share", "distinct_share", "word_length", "n_words", "words_a_line")


def statistics(docs: DataFrame) -> DataFrame:
    """doc (the input row as a struct), then the statistics of its whole text.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words as in the base rules, and FEATURES.
    A null or empty text counts as no words, and its shares are 0. Everything is computed within
    the row, without a shuffle; repeated windows are found by sorting window hashes with their
    places, so that a text of n words takes n log n steps.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.struct("*").alias("doc"), text.alias("text"))
    split = base.select(
        "doc",
        F.filter(F.split("text", r"[ \t-\r]+"), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "").alias("lines"),
        F.char_length(F.translate("text", SPACE, "")).alias("word_chars"),
        *[(F.char_length("text") - F.char_length(F.translate("text", which, ""))).alias(name) for name, which in (("n_symbols", SYMBOLS), ("n_upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("n_marks", "!?"), ("n_digits", "0123456789"))],
    )
    counted = split.select(
        "*", F.size("words").alias("n_words"), F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    ).drop("words", "lines")
    none = F.array().cast("array<bigint>")
    starts = F.sequence(F.lit(1), F.col("n_words") - F.lit(WINDOW - 1))
    windowed = counted.withColumn("windows", F.when(F.col("n_words") > WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)))).otherwise(none))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("p")))
    windowed = windowed.withColumn("sorted", F.when(repeats, F.array_sort(placed)).otherwise(F.array().cast("array<struct<h:bigint,p:int>>")))
    same = lambda x, i, by: F.coalesce(F.get("sorted", i + by)["h"] == x["h"], F.lit(False))
    again = F.filter("sorted", lambda x, i: same(x, i, F.lit(-1)) | same(x, i, F.lit(1)))
    found = windowed.withColumn("again", F.sort_array(F.transform(again, lambda x: x["p"])))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate("again", start, lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])
    full = found.withColumn("n_repeat_words", covered).withColumn("n_distinct", F.size(F.array_distinct("hashes")))
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    share = lambda a, b: (F.col(a) / b).cast("double").alias
    return full.select(
        "doc", *[F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        share("n_repeat_words", words)("repeat_share"), share("n_dup_lines", F.greatest("n_lines", F.lit(1)))("dup_line_share"),
        share("n_symbols", chars)("symbol_share"), share("n_upper", chars)("upper_share"), share("n_marks", chars)("mark_share"), share("n_digits", chars)("digit_share"),
        share("n_distinct", words)("distinct_share"), share("word_chars", words)("word_length"), share("n_words", F.greatest("n_lines", F.lit(1)))("words_a_line"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict[str, float]) -> bool:
        return row[self.feature] >= self.threshold if self.above else row[self.feature] <= self.threshold

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, rows: list[dict]) -> list[dict]:
    return [r for r in rows if all(c.holds(r) for c in rule)]


def _weight(row: dict) -> float:
    return row.get("weight", 1.0)


def _purity(rows: list[dict]) -> float:
    return sum(r["bad"] * _weight(r) for r in rows) / sum(map(_weight, rows)) if rows else 0.0


def _grown(rows: list[dict], most: int, cuts: int) -> Rule:
    """Add the condition of the largest information gain until only rejected rows are left."""
    from math import log2

    rule: Rule = ()
    while len(rule) < most and 0 < _purity(rows) < 1:
        before, best = log2(_purity(rows)), (0.0, None)
        for name in FEATURES:
            pairs = sorted((r[name], r["bad"], _weight(r)) for r in rows)
            values = [p[0] for p in pairs]
            sums, all_sums = [0.0], [0.0]
            for _, b, w in pairs:
                sums.append(sums[-1] + b * w)
                all_sums.append(all_sums[-1] + w)
            bad, total = sums[-1], all_sums[-1]
            edges = [i for i in range(1, len(pairs)) if values[i] > values[i - 1]]
            for i in edges[:: max(1, len(edges) // cuts)]:
                middle = (values[i - 1] + values[i]) / 2
                for above, p, n in ((False, sums[i], all_sums[i]), (True, bad - sums[i], total - all_sums[i])):
                    if p > 1e-9 * total and (gain := p * (log2(p / n) - before)) > best[0]:
                        best = (gain, Condition(name, above, middle))
        if best[1] is None:
            break
        rule = (*rule, best[1])
        rows = _covered(rule, rows)
    return rule


def learn(rows: list[dict], most_rules: int = 16, most_conditions: int = 3, least_rows: int = 3, purity: float = 0.97, cuts: int = 200) -> list[Rule]:
    """An ordered list of conjunctions that cover rejected rows, by sequential covering.

    rows: FEATURES, bad (1 to reject), fold (an integer) and weight (1 if absent), by which purity
    and gain count a row. Each rule is grown on two thirds of
    what is left and cut back on the other third, to the shortest front part that is as pure
    there. A rule that isn't pure enough over both, or covers fewer than least_rows rejected rows,
    ends the list. Few or one-sided labels give a short or empty list, which rejects nothing.
    """
    rules: list[Rule] = []
    left = rows
    while len(rules) < most_rules:
        rule = _grown([r for r in left if r["fold"] % 3], most_conditions, cuts)
        if not rule:
            break
        held = [r for r in left if r["fold"] % 3 == 0]
        fronts = [rule[: k + 1] for k in range(len(rule))]
        worth = [(_purity(_covered(f, held)) if _covered(f, held) else _purity(_covered(f, left)), -len(f), f) for f in fronts]
        rule = max(worth, key=lambda x: x[:2])[2]
        got = _covered(rule, left)
        if _purity(got) < purity or sum(r["bad"] for r in got) < least_rows:
            break
        rules.append(rule)
        left = [r for r in left if not all(c.holds(r) for c in rule)]
    return rules


def learned(docs: DataFrame, labels: DataFrame, most: int = 3000) -> list[Rule]:
    """Learn from at most about 2 * most labelled rows, chosen by the hash of doc_id.

    If a label has more rows than the sample takes, its rows weigh more, so that a rule's purity is
    that of all labelled rows, whatever their number.
    """
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    weight = {r.quality: max(1.0, r.n / most) for r in marks.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = labelled(docs, labels, "quality", 1, -1, most, [F.col("text")])
    stats = statistics(sample).select(F.col("doc.doc_id").alias("id"), F.col("doc._label").alias("label"), base_failed().alias("failed"), F.crc32(F.col("doc.doc_id").cast("string")).alias("fold"), *FEATURES)
    rows = [{**{f: float(r[f]) for f in FEATURES}, "bad": int(r["label"] == 0), "fold": r["fold"] >> 4, "weight": weight[r["label"]]} for r in sorted(stats.collect(), key=lambda r: r["id"]) if not r["failed"]]
    return learn(rows)


def rejected_by(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that holds, 0 if none does: one ordered conditional."""
    out = None
    for number, rule in enumerate(rules, 1):
        holds = rule[0].column()
        for c in rule[1:]:
            holds = holds & c.column()
        out = F.when(holds, F.lit(number)) if out is None else out.when(holds, F.lit(number))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """statistics() with base_failed, rule (the first learned rule that holds, else 0) and kept."""
    return statistics(docs).withColumn("base_failed", base_failed()).withColumn("rule", rejected_by(rules)).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document row: doc_id, the base statistics, base_failed, kept and rule.

    Null and empty texts fail the base rules; repeated rows are judged alike; extra columns are
    ignored; an empty table gives no rows.
    """
    out = judged(docs.select("doc_id", "text"), learned(docs, labels))
    return out.select(F.col("doc.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that base rules and learned rules keep, with all their own columns."""
    # a filter is not moved below a row number, where it would compute the statistics once for each use of them
    numbered = judged(docs, learned(docs, labels)).select("doc", "kept", F.monotonically_increasing_id().alias("row"))
    return numbered.where(F.col("kept") & (F.col("row") >= 0)).select("doc.*")
