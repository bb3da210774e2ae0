"""Secrets in texts: patterns of known forms, and a token-efficiency test for random strings.

A vocabulary of byte pairs learned from prose and code needs few tokens for words and names, and
many for random strings. A run of 16 or more letters, digits and + / _ = - that has a letter and
gives at most RATIO characters a token is held to be random, and so is a part of it between the
signs. A run whose parts have the form of words (letters of one case, or a capital before small ones)
is held to be random only at WORD_RATIO, since long or foreign words give few characters a token
too. Known digests (hexadecimal of a digest's length), UUIDs and times are cut out before. An
identifier (parts of letters with digits at their ends only, such as field_name_2 or someName12)
is none if its words alone give more characters a token. The ratio is of the whole run at any length.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import released

#: Kinds in their order, patterns, and least lengths (of group 2 for assign).
KINDS = ("assign", "access", "hex", "random")
PATTERNS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
LEAST = {"assign": 12, "access": 18, "hex": 16}
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
RATIO, WORD_RATIO = 2.2, 1.55

_assign, _access = re.compile(PATTERNS["assign"], re.ASCII), re.compile(PATTERNS["access"])
_hex = re.compile(r"[0-9a-f]{16,}")  # runs are whole, so only long ones count
_words = ("password", "passwd", "secret", "token", "apikey", "api_key")
_run = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_stretch = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9+/_=-]*[A-Za-z0-9])?=*")
_known = re.compile(
    r"(?<![A-Za-z0-9])(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9]{4}-?[0-9]{2}-?[0-9]{2}T[0-9]{2}-?[0-9]{2}-?[0-9]{2}Z?|"
    + "|".join(f"[0-9a-fA-F]{{{n}}}" for n in DIGEST_LENGTHS)
    + r")(?![A-Za-z0-9])"
)
_piece = re.compile(r"[A-Za-z0-9]{16,}")
_letter = re.compile(r"[A-Za-z]")
_part = re.compile(r"[0-9]*[A-Za-z]*[0-9]*")
_camel = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_word = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_encodings: dict[str, object] = {}

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


def encoding(path: str):
    """The tiktoken encoding of a vocabulary file, loaded once a worker."""
    if path not in _encodings:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encodings[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def base_spans(text: str) -> list[Span]:
    """Matches of each pattern, leftmost and apart within a kind, that are long enough."""
    out: list[Span] = []
    low = text.lower()  # may only find more than the pattern, which decides
    if any(w in low for w in _words):
        out += [(m.start(), 0, m.end()) for m in _assign.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _access.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), 2, m.end()) for m in _hex.finditer(text)]
    return sorted(out)


def _tokens(run: str, enc) -> int:
    """Tokens of the whole run, however long: the vocabulary takes time in proportion."""
    return len(enc.encode_ordinary(run))


def looks_random(run: str, enc, ratio: float, word_ratio: float = WORD_RATIO) -> bool:
    """Whether a run with letters gives few characters a token, and so do its words if it is an identifier."""
    if not _letter.search(run):
        return False
    parts = [p for p in re.split(r"[+/_=-]+", run) if p]
    if all(_word.fullmatch(p) for p in parts):
        ratio = min(ratio, word_ratio)
    if len(run) > ratio * _tokens(run, enc):
        return False
    if not all(_part.fullmatch(p) for p in parts):
        return True
    words = [w for p in parts for w in _camel.findall(p)]
    return sum(map(len, words)) <= ratio * sum(_tokens(w, enc) for w in words)


def random_spans(text: str, enc, base: list[Span], ratio: float = RATIO) -> list[Span]:
    """Random runs, and random parts of other runs, that lie within no span of base (in ascending order)."""
    out = []
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))  # the furthest end of the spans so far

    def found(start: int, end: int) -> bool:
        at = bisect_right(starts, start)
        if (at and reach[at - 1] >= end) or not looks_random(text[start:end], enc, ratio):
            return False
        out.append((start, 3, end))
        return True

    for m in _run.finditer(text):
        edges = [m.start(), *(x for k in _known.finditer(text, m.start(), m.end()) for x in k.span()), m.end()]
        for low, high in zip(edges[::2], edges[1::2], strict=True):
            whole = _stretch.search(text, low, high)
            if whole and whole.end() - whole.start() >= 16 and not found(*whole.span()):
                for part in _piece.finditer(text, *whole.span()):
                    if part.span() != whole.span():
                        found(*part.span())
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scanner(vocab: str, ratio: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(vocab)
        for batch in batches:
            counts, digests, spans = [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                every = sorted(base + random_spans(text, enc, base, ratio))
                counts.append([sum(k == kind for _, k, _ in every) for kind in range(4)])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(every))
            numbers = [pa.array([c[k] for c in counts], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers[:3], pa.array(digests, pa.string()), pa.array(spans, pa.string()), numbers[3]], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    return scan


def scanned(docs: DataFrame, vocab: str | None = None, ratio: float = RATIO) -> DataFrame:
    """One row per document row: doc_id, counts by kind, base_sha256 and spans.

    A span is kind:start:end in code points, end exclusive. Null and empty texts have none; null
    doc_ids and repeated rows are scanned like others; extra columns are ignored; an empty table
    gives no rows. Each text is scanned whole, within its row.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scanner(vocab or vocabulary(), ratio), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")


def without(text: str, spans: list[Span], mark: str) -> str:
    """The text with each stretch of overlapping spans replaced by mark."""
    out, at = [], 0
    for s, _, e in sorted(spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, vocab: str | None = None, ratio: float = RATIO, mark: str = "[secret]") -> DataFrame:
    """docs with assigned, access and random secrets replaced in text, and n_chars to match.

    Hexadecimal runs are judged by their tokens like others, so digests and numbers stay. All
    rows and columns stay; null texts stay null; rows without secrets are unchanged.
    """
    path = vocab or vocabulary()

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path)

        def one(text: str | None) -> str | None:
            if not text:
                return text
            base = [s for s in base_spans(text) if s[1] != 2]
            spans = base + random_spans(text, enc, base, ratio)
            return without(text, spans, mark) if spans else text

        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = pa.array([one(text.as_py()) for text in batch.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)
        released()

    out = docs.mapInArrow(clean, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return out
