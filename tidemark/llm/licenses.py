"""License scan: ordered signature rules behind a keyword prefilter.

Texts are matched as lower-cased words (digits, letters and anything beyond ASCII) joined by single
spaces. Rules are hand-written signatures (license_notices.py) and, for names with versions, templates
over a table of license families; a rule runs only on texts that hold one of its keywords, one of
which every match holds as a word. Detections are taken by priority, then length, and one that lies
within an accepted interval is suppressed. The base phrases are always kept.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.license_notices import NOTICES
from tidemark.llm.words import ALNUM, Block, blocks

#: The base phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Families as label, names (regex alternatives), keyword, versions.
FAMILIES = (
    ("gpl", r"(?:gnu )?(?:gpl|general public licen[cs]e)", ("gpl", "general"), ("1", "2", "3")),
    ("lgpl", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public licen[cs]e)", ("lgpl", "lesser", "library"), ("2", "2 1", "3")),
    ("agpl", r"(?:gnu )?(?:agpl|affero general public licen[cs]e)", ("agpl", "affero"), ("1", "3")),
    ("gfdl", r"(?:gnu )?(?:gfdl|free documentation licen[cs]e)", ("gfdl", "documentation"), ("1 1", "1 2", "1 3")),
    ("apache", r"apache(?: software)?(?: licen[cs]e)?", ("apache",), ("1", "1 1", "2")),
    ("mpl", r"(?:mpl|mozilla public licen[cs]e)", ("mpl", "mozilla"), ("1", "1 1", "2")),
    ("epl", r"(?:epl|eclipse public licen[cs]e)", ("epl", "eclipse"), ("1", "2")),
    ("eupl", r"(?:eupl|european union public licen[cs]e)", ("eupl", "european"), ("1", "1 1", "1 2")),
    ("cddl", r"(?:cddl|common development and distribution licen[cs]e)", ("cddl", "distribution"), ("1", "1 1")),
    ("cpl", r"(?:cpl|common public licen[cs]e)", ("cpl", "common"), ("1",)),
    ("artistic", r"artistic licen[cs]e", ("artistic",), ("1", "2")),
    ("afl", r"(?:afl|academic free licen[cs]e)", ("afl", "academic"), ("1 1", "2", "2 1", "3")),
    ("osl", r"(?:osl|open software licen[cs]e)", ("osl", "software"), ("1", "2", "2 1", "3")),
    ("boost", r"(?:bsl|boost software licen[cs]e)", ("bsl", "boost"), ("1",)),
    ("zpl", r"(?:zpl|zope public licen[cs]e)", ("zpl", "zope"), ("1 1", "2", "2 1")),
    ("ofl", r"(?:sil )?(?:ofl|open font licen[cs]e)", ("ofl", "font"), ("1", "1 1")),
    ("odbl", r"(?:odbl|open database licen[cs]e)", ("odbl", "database"), ("1",)),
    ("lppl", r"(?:lppl|latex project public licen[cs]e)", ("lppl", "latex"), ("1", "1 1", "1 2", "1 3")),
    ("ms-pl", r"(?:ms pl|microsoft public licen[cs]e)", ("pl", "microsoft"), ("",)),
    ("mit", r"(?:mit|expat|x11)", ("mit", "expat", "x11"), ("",)),
    ("isc", r"isc", ("isc",), ("",)),
    ("zlib", r"zlib(?: libpng)?", ("zlib",), ("",)),
    ("wtfpl", r"(?:wtfpl|do what the fuck you want to public licen[cs]e)", ("wtfpl", "fuck"), ("", "2")),
    ("unlicense", r"(?:the )?unlicense", ("unlicense",), ("",)),
    ("bsd-2-clause", r"(?:bsd 2 clause|(?:simplified|freebsd) bsd|2 clause bsd)", ("bsd",), ("",)),
    ("bsd-3-clause", r"(?:bsd 3 clause|(?:new|modified|revised) bsd|3 clause bsd)", ("bsd",), ("",)),
    ("bsd-4-clause", r"(?:bsd 4 clause|original bsd|4 clause bsd)", ("bsd",), ("",)),
    ("bsd", r"bsd(?: style)?", ("bsd",), ("",)),
    ("psf", r"python software foundation", ("python",), ("", "2")),
    ("ruby", r"ruby", ("ruby",), ("",)),
)
CC_PARTS = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd", "by sa nc", "sa", "nc", "nd")
CC_NAMES = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:s|atives|ative works)"}
CC_VERSIONS = ("", "1 0", "2 0", "2 5", "3 0", "4 0")
#: Templates over a name and a version: priority, confidence, regex. A version may end in " 0".
TEMPLATES = (
    (4, 1.0, r"spdx licen[cs]e identifier {name}{v}(?: (?:only|or later))?"),
    (3, 0.95, r"(?:licen[cs]ed|released|distributed|available|provided|published|covered|redistributed) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{name}(?: licen[cs]e)?{v}(?: licen[cs]e)?"),
    (2, 0.8, r"{name} licen[cs]es?{v}"),
)
VERSIONED = (1, 0.6, r"{name}{v}")


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: frozenset[str]
    priority: int
    confidence: float
    regex: re.Pattern


def _version(v: str) -> str:
    if not v:
        return ""
    return rf"(?:(?: version| v)? v?|v?){v}(?: 0)?(?![0-9]| [0-9])"


def _with_version(keywords: tuple[str, ...], v: str) -> tuple[str, ...]:
    """Keywords, and those with the version in one word, such as gplv3 and gpl3."""
    return keywords + tuple(f"{k}{sign}{v.split()[0]}" for k in keywords for sign in ("", "v") if v)


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in order; each regex matches whole words."""
    out: dict[tuple, Rule] = {}

    def add(label: str, keywords: tuple[str, ...], priority: int, confidence: float, pattern: str) -> None:
        made = re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])")
        out.setdefault((label, pattern), Rule(label, frozenset(keywords), priority, confidence, made))

    for label, name, keywords, versions in FAMILIES:
        for v in sorted(set(versions) | {""}, reverse=True):
            full = f"{label}-{v.replace(' ', '.')}" if v else label
            bonus = 0.5 if v else 0  # a version says more than none
            for priority, confidence, template in TEMPLATES:
                add(full, _with_version(keywords, v), priority + bonus, confidence, template.format(name=name, v=_version(v)))
            if v:
                add(full, _with_version(keywords, v), VERSIONED[0] + bonus, VERSIONED[1], VERSIONED[2].format(name=name, v=_version(v)))
    for parts in CC_PARTS:
        long = " ".join(CC_NAMES[p] for p in parts.split())
        for v in CC_VERSIONS:
            full = "cc-" + parts.replace(" ", "-") + (f"-{v.replace(' ', '.')}" if v else "")
            add(full, ("cc",), 3 + len(parts) / 10 + bool(v) / 2, 0.9, f"cc {parts}" + (f" {v}" if v else ""))
            add(full, ("creative",), 3 + len(parts) / 10 + bool(v) / 2, 0.95, f"creative commons {long}(?: licen[cs]e)?" + (f" {v}(?: international| unported| generic)?" if v else ""))
    for label, notices in NOTICES.items():
        for priority, confidence, keywords, pattern in notices:
            add(label, tuple(keywords.split("|")), priority, confidence, pattern)
    return tuple(sorted(out.values(), key=lambda r: -r.priority))


@cache
def by_keyword() -> dict[str, list[int]]:
    """The rules of each keyword, by their place among all."""
    out: dict[str, list[int]] = {}
    for i, r in enumerate(rules()):
        for k in r.keywords:
            out.setdefault(k, []).append(i)
    return out


BASE_CONFIDENCE = 0.9


def base_places(text: str) -> list[tuple[int, int, str]]:
    """(first word, words, label) of every place of a base phrase in a text of words joined by spaces."""
    out, padded = [], f" {text} "
    for phrase, label in BASE:
        at, word, counted = padded.find(f" {phrase} "), -1, 0
        while at >= 0:
            word += padded.count(" ", counted, at + 1)  # only from the last place on
            counted = at + 1
            out.append((word, phrase.count(" ") + 1, label))
            at = padded.find(f" {phrase} ", at + 1)
    return out


def detect(text: str, words: set[str]) -> list[tuple[int, int, str, float]]:
    """(start, end, label, confidence) in code points of what no better detection contains."""
    asked = sorted({i for w in words & by_keyword().keys() for i in by_keyword()[w]})
    found = [(-r.priority, m.start() - m.end(), m.start(), m.end(), r.label, r.confidence) for r in map(rules().__getitem__, asked) for m in r.regex.finditer(text)]
    kept: list[tuple[int, int, str, float]] = []
    starts, ends = [], []  # accepted intervals that none contains: both ascend
    for _, _, s, e, label, confidence in sorted(found):
        at = bisect_right(starts, s)
        if at and ends[at - 1] >= e:
            continue
        kept.append((s, e, label, confidence))
        low, high = bisect_left(starts, s), bisect_right(ends, e)
        starts[low:high], ends[low:high] = [s], [e]
    return kept


def _keyword_filter() -> Callable[[Block], np.ndarray]:
    """Which texts of a block may hold a rule's or base phrase's keyword, by word hashes."""
    keywords = sorted({k for r in rules() for k in r.keywords} | {"license", "cc"})
    probe = next(blocks(pa.array([" ".join(keywords)]), lower=True, word_bytes=ALNUM))[1].hashes()
    known = np.sort(probe)
    bitmap = np.zeros(1 << 20, dtype=bool)
    bitmap[(known >> np.uint64(44)).astype(np.int64)] = True

    def has(block: Block) -> np.ndarray:
        hashes = block.hashes()
        at = np.flatnonzero(bitmap[(hashes >> np.uint64(44)).astype(np.int64)])
        at = at[known[np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)] == hashes[at]]
        return np.unique(np.searchsorted(block.first, at, side="right") - 1)

    return has


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    has = _keyword_filter()
    for batch in batches:
        n = len(batch)
        n_words, n_base, first, last = np.zeros(n, dtype=np.int64), [0] * n, [None] * n, [None] * n
        base_labels, labels, score = [""] * n, [""] * n, [0.0] * n
        for low, block in blocks(batch.column(1), lower=True, word_bytes=ALNUM):
            n_words[low : low + len(block)] = np.diff(block.first)
            for i in has(block).tolist():
                a, b = block.first[i], block.first[i + 1]
                raw = block.text(i)
                at = block.offsets[i]
                words = [raw[s:e].decode() for s, e in zip((block.begin[a:b] - at).tolist(), (block.end[a:b] - at).tolist(), strict=True)]
                text = " ".join(words)
                places, more = base_places(text), detect(text, set(words))
                if places:
                    n_base[low + i], first[low + i], last[low + i] = len(places), min(p[0] for p in places), max(p[0] for p in places)
                base = {p[2] for p in places}
                base_labels[low + i] = ",".join(sorted(base))
                labels[low + i] = ",".join(sorted(base | {m[2] for m in more}))
                score[low + i] = max([BASE_CONFIDENCE * bool(places), *(m[3] for m in more)])
        longs = [pa.array(c, pa.int64()) for c in (n_words, n_base, first, last)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *longs, pa.array(base_labels, pa.string()), pa.array(labels, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])


def scanned(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_words, base places and labels, all labels, score.

    n_base counts all places of base phrases, first_word and last_word are the smallest and largest
    of their first words. score is the largest confidence of a detection, 0 without any. Null and
    empty texts have no words; null doc_ids and repeated rows are scanned like others; extra
    columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
