"""Scalar functions as Spark columns: ids, names, dates, blends and linear scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Name parts that are no part of a name's key.
SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v")
#: Texts that stand for a missing id.
MISSING = ("", "nan", "<NA>", "None")

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def norm_id(c: Column) -> Column:
    """An id as text without a ".0" tail; blank and missing ones are NULL."""
    text = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    return F.when(~text.isin(*MISSING), text)


def name_key(c: Column) -> Column:
    """Lower case without full stops and apostrophes, hyphens as blanks, suffixes dropped."""
    parts = F.split(F.translate(F.translate(F.lower(c), ".'", ""), "-", " "), r"\s+")
    return F.array_join(F.filter(parts, lambda p: (p != "") & ~p.isin(*SUFFIXES)), " ")


def letters_key(c: Column) -> Column:
    """Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-|-$", "")


def number(c: Column) -> Column:
    """A number, 0 where the text is none."""
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def mapped(c: Column, values: dict[str, str], other: Column | None = None) -> Column:
    """A code's value in a small fixed map."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), c)
    return found if other is None else F.coalesce(found, other)


def first_that_holds(labels: list[tuple[Column, str]], other: str | None) -> Column:
    """The label of the first condition that holds: labels that would overwrite earlier ones come first."""
    out = None
    for cond, label in labels:
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(F.lit(other))


def blended(current: Column, prior: Column, weight: Column) -> Column:
    """weight of prior and the rest of current; where one is missing, the other."""
    return F.when(current.isNotNull() & prior.isNotNull(), weight * prior + (1 - weight) * current).otherwise(F.coalesce(current, prior))


def prior_weight(week: Column) -> Column:
    """How much last season still counts: all before the first week, nothing from the fourth on."""
    return F.greatest(F.lit(0.0), (4 - week) / 4)


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL unless b is positive."""
    return F.when(b > 0, a / b)


def shrunk(total: Column, n: Column, prior: Column, k: float) -> Column:
    """A rate drawn to a prior that counts as k observations."""
    return (total + k * prior) / (n + k)


def linear_score(weights: dict[str, float]) -> Column:
    """The weighted sum of columns, missing ones as 0: one expression that codegen compiles."""
    out = F.lit(0.0)
    for name, weight in weights.items():
        out = out + F.coalesce(F.col(name), F.lit(0.0)) * weight
    return out


def micros(c: Column) -> Column:
    """Microseconds since 1970 of a timestamp without time zone, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), c)


def age(birth: Column, at: Column) -> Column:
    return F.datediff(at, birth) / 365.25


def next_weekday(day: Column, name: str) -> Column:
    """The first such weekday strictly after a date."""
    return F.next_day(day, name)


def epoch_hours(stamp: Column, now: Column) -> Column:
    """Hours between an epoch stamp, in seconds or milliseconds, and now in epoch seconds."""
    seconds = F.when(stamp > 10**11, stamp / 1000).otherwise(stamp)
    return (now - seconds) / 3600


def scrubbed(c: Column) -> Column:
    """Values of key parameters masked."""
    return F.regexp_replace(c, r"(?i)((?:api_?)?key=)[^&\s]+", "$1***")


def fingerprint(*columns: Column) -> Column:
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in columns]), 256)


def sorted_quantiles(*columns: Column) -> tuple[Column, Column]:
    """Quantile columns in ascending order, and whether any two were crossed."""
    values = F.array(*columns)
    return F.array_sort(values), F.array_sort(values) != values
