"""Repeatable pseudo-random draws from row values.

``rand`` depends on how rows are partitioned, so two runs of a generator would
differ. A digest of the seed, the draw's name and the row's own values does
not, and any engine with md5 can recompute it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS_PER_MILLION = 1_000_000


def draw(seed: int, name: str, *row: Column) -> Column:
    """A 32-bit number that is fixed by seed, name and row."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(name), *[c.cast("string") for c in row])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def draw_int(seed: int, name: str, low: int, high: int, *row: Column) -> Column:
    """A whole number in [low, high]."""
    return F.lit(low) + F.pmod(draw(seed, name, *row), F.lit(high - low + 1))


def draw_chance(seed: int, name: str, rate: float, *row: Column) -> Column:
    """True for about ``rate`` of all rows."""
    limit = round(rate * _PARTS_PER_MILLION)
    return F.pmod(draw(seed, name, *row), F.lit(_PARTS_PER_MILLION)) < limit


def draw_item(seed: int, name: str, items: list[str], *row: Column) -> Column:
    """One of ``items``."""
    index = draw_int(seed, name, 1, len(items), *row).cast("int")
    return F.element_at(F.array(*[F.lit(item) for item in items]), index)
