"""A small language for variants of a model: what a trial changes, as one line of text.

    recent:N        rows of the newest N periods weigh RECENT times as much
    recent:NxF      ... weigh F times as much
    +family:NAME    add a family's columns
    -family:NAME    leave a family's columns out
    +cols:A,B       add columns
    -cols:A,B       leave columns out
    param:NAME=V    another value of a parameter
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

RECENT = 2.0
_RECENT = re.compile(r"(\d+)(?:x(\d+(?:\.\d+)?))?")


@dataclass(frozen=True)
class Candidate:
    """A parsed line. columns: what is added (sign 1) or left out (-1)."""

    text: str
    sign: int = 0
    columns: tuple[str, ...] = ()
    periods: int = 0
    factor: float = 1.0
    parameter: tuple[str, float] | None = None

    def applied(self, columns: list[str]) -> list[str]:
        """The columns of a model that has the given ones, in their order; added ones come last."""
        if self.sign < 0:
            return [c for c in columns if c not in self.columns]
        return [*columns, *[c for c in self.columns if c not in columns]]

    def weight(self, period: Column, newest: Column) -> Column:
        """A row's weight from its period and the newest that may be known."""
        return F.when(period > newest - self.periods, F.lit(self.factor)).otherwise(1.0) if self.periods else F.lit(1.0)

    def value(self, name: str, default: float) -> float:
        return self.parameter[1] if self.parameter and self.parameter[0] == name else default


def parsed(text: str, families: dict[str, list[str]], parameters: tuple[str, ...] = ()) -> Candidate:
    """The candidate that a line means; a ValueError names the line and what is wrong in it."""

    def wrong(what: str) -> ValueError:
        return ValueError(f"{text!r}: {what}")

    line = text.strip()
    kind, colon, rest = line.partition(":")
    rest = rest.strip()
    if not colon or not rest:
        raise wrong("a candidate is a kind, a colon and a value, such as recent:4 or +family:role")
    if kind == "recent":
        found = _RECENT.fullmatch(rest)
        if not found or int(found[1]) < 1 or float(found[2] or RECENT) <= 0:
            raise wrong("recent takes a number of periods, and then x and a factor above 0 if need be")
        return Candidate(line, periods=int(found[1]), factor=float(found[2] or RECENT))
    if kind in ("+family", "-family"):
        if rest not in families:
            raise wrong(f"no family {rest}; there are {', '.join(families)}")
        return Candidate(line, 1 if kind[0] == "+" else -1, tuple(families[rest]))
    if kind in ("+cols", "-cols"):
        names = tuple(n.strip() for n in rest.split(",") if n.strip())
        known = {c for cs in families.values() for c in cs}
        if unknown := [n for n in names if n not in known]:
            raise wrong(f"no column {', '.join(unknown)}")
        return Candidate(line, 1 if kind[0] == "+" else -1, names)
    if kind == "param":
        name, equals, value = (part.strip() for part in rest.partition("="))
        if not equals or name not in parameters:
            raise wrong(f"param takes one of {', '.join(parameters) or 'no parameters'}, = and a number")
        try:
            return Candidate(line, parameter=(name, float(value)))
        except ValueError:
            raise wrong(f"{value!r} isn't a number") from None
    raise wrong(f"no kind {kind}; there are recent, +family, -family, +cols, -cols, param")
