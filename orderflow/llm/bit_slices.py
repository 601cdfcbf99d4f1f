"""Embedding whitening from an exact, bit-sliced scatter matrix.

Entries become whole numbers x = floor(scale * c). Every distinct vector counts once.

1. The distinct vectors are written with row numbers. 64 consecutive rows are a block,
   and bit p of dimension d over the block's rows, all shifted by the smallest entry so
   that none is negative, is one 64-bit word: a plane. One more dimension is always 1.
2. The sum over rows of y_i * y_j is the sum over blocks and bits p, q of
   2**(p + q) * popcount(plane(i, p) AND plane(j, q)). Each plane of a block is one row
   that meets all planes of the block; sums are taken by dimension before the shuffle,
   so a task sends one row per dimension. The one that is always 1 gives the number of
   rows and the sums.
3. n * sum(x_i x_j) - S_i * S_j are whole numbers, free of the shift, and n**2 times the
   covariance. Only that matrix, of dimensions squared, comes to the driver for eigh.
4. Rows are projected by column expressions.

Defined cases: rows whose vector is null, holds null or non-finite entries, or has fewer
entries than the longest one are dropped; repeated vectors get equal results, rows of
equal or null id their own. A component without variance has null ``whitened`` and is
left out of identity_error. ``deviation`` is null where it exceeds 63 bits. Entries must
lie within 2**56 of each other after scaling, else ValueError. An empty table gives no
rows. Native: columns only, numpy only for the matrix.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement
from math import sqrt

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.text import stored

#: Rows of a block, the bits of a word.
LANES = 64
MOST_BITS = 56

RESULT = (
    "component int, n bigint, deviation bigint, whitened double, explained double, "
    "identity_error double"
)


@dataclass(frozen=True)
class Scatter:
    """Of n distinct vectors: sums S of x, and n**2 times their covariance, exact;
    all entries lie in [low, high]."""

    n: int
    low: int
    high: int
    sums: list[int]
    centred: list[list[int]]

    def components(self, most: int) -> tuple[list[float], list[list[float]], float]:
        """Falling eigenvalues, their unit vectors and the trace of the covariance."""
        square = self.n * self.n
        matrix = np.array([[c / square for c in row] for row in self.centred])
        values, vectors = np.linalg.eigh(matrix)
        order = np.argsort(-values, kind="stable")[:most]
        trace = sum(row[i] for i, row in enumerate(self.centred)) / square
        return values[order].tolist(), vectors[:, order].T.tolist(), trace


def total(terms: Sequence[Column]) -> Column:
    """Their sum, as a balanced tree."""
    terms = list(terms)
    while len(terms) > 1:
        pairs = [a + b for a, b in zip(terms[::2], terms[1::2], strict=False)]
        terms = pairs + ([terms[-1]] if len(terms) % 2 else [])
    return terms[0]


def quantised(vectors: DataFrame, column: str, scale: int) -> DataFrame:
    """The rows with a finite vector, with ``x``, its entries as whole numbers."""
    entries = F.col(column).cast("array<double>")
    finite = F.forall(entries, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    return vectors.where(finite).withColumn(
        "x", F.transform(entries, lambda c: F.floor(c * float(scale)))
    )


def fit_list(rows: DataFrame) -> DataFrame:
    """Every distinct x once, with a row number; written."""
    return stored(
        rows.select("x").distinct().withColumn("row", F.monotonically_increasing_id()), "whiten-fit"
    )


def planes(fit: DataFrame, bits: int, low: int) -> DataFrame:
    """One row per block: ``planes`` by dimension and bit, the last dimension being the
    one that is always 1."""
    lane = F.col("row").bitwiseAND(F.lit(LANES - 1)).cast("int").alias("lane")
    one = F.array(F.lit(low + 1).cast("long"))
    each = fit.select(
        F.shiftright("row", 6).alias("block"), lane, F.posexplode(F.concat("x", one)).alias("dim", "v")
    )

    def plane(p: int) -> Column:
        bit = F.shiftright(F.col("v") - F.lit(low), p).bitwiseAND(F.lit(1).cast("long"))
        return F.bit_or(F.call_function("shiftleft", bit, F.col("lane"))).alias(f"w{p}")

    words = F.array(*(f"w{p}" for p in range(bits))).alias("words")
    return (
        each.groupBy("block", "dim")
        .agg(*map(plane, range(bits)))
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("dim", words))).alias("dims"))
        .select(F.flatten("dims.words").alias("planes"))
    )


def scatter(fit: DataFrame) -> Scatter | None:
    """None without a row."""
    shape = fit.agg(
        F.max(F.size("x")), F.min(F.array_min("x")), F.max(F.array_max("x")), F.count("*")
    ).head()
    if not shape[3] or not shape[0]:
        return None
    dims, low, high, rows = shape
    bits = max(1, (high - low).bit_length())
    if bits > MOST_BITS:
        raise ValueError("entries are too far apart for exact sums")
    # Sums of weighted counts stay below rows * 4**bits.
    narrow = rows.bit_length() + 2 * bits < 63

    def product(j: int) -> Column:
        # The dimension that is always 1 has its only bits in its first plane.
        counts = [
            F.bit_count(F.col("plane").bitwiseAND(F.get("planes", F.lit(j * bits + q)))).cast("long")
            * F.lit(1 << q).cast("long")
            for q in range(bits if j < dims else 1)
        ]
        value = total(counts)
        value = value if narrow else value.cast("decimal(38,0)")
        return F.sum(F.when(F.col("i") <= j, value * F.col("weight"))).alias(f"s{j}")

    weight = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("k", F.lit(bits)))
    each = (
        planes(fit, bits, low)
        .select("planes", F.posexplode("planes").alias("k", "plane"))
        .where("plane <> 0")
        .withColumn("i", F.floor(F.col("k") / bits).cast("int"))
        .withColumn("weight", weight if narrow else weight.cast("decimal(20,0)"))
    )
    found = each.groupBy("i").agg(*(product(j) for j in range(dims + 1))).collect()
    # A dimension whose entries are all the lowest one has no row here.
    sums = {(r["i"], j): int(v) for r in found for j, v in enumerate(r[1:]) if v is not None}
    n = sums[dims, dims]
    shifted = [sums.get((i, dims), 0) for i in range(dims)]
    centred = [[0] * dims for _ in range(dims)]
    for i, j in combinations_with_replacement(range(dims), 2):
        centred[i][j] = centred[j][i] = n * sums.get((i, j), 0) - shifted[i] * shifted[j]
    return Scatter(n, low, high, [s + n * low for s in shifted], centred)


def deviation(x: str, known: Scatter) -> Column:
    """Sum over dimensions of (n * x - S)**2, exact; null beyond 63 bits."""
    kind = "long"
    if (known.n * (known.high - known.low + 1)) ** 2 * len(known.sums) >= 1 << 63:
        kind = "decimal(38,0)"
    gaps = [
        F.get(x, F.lit(d)).cast(kind) * F.lit(known.n).cast(kind) - F.lit(s).cast(kind)
        for d, s in enumerate(known.sums)
    ]
    return total([gap.cast(kind) * gap.cast(kind) for gap in gaps]).try_cast("bigint")


def whitened(
    vectors: DataFrame, column: str = "embedding", components: int = 4, scale: int = 256
) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained and
    identity_error."""
    rows = quantised(vectors.select("vec_id", column), column, scale)
    fit = fit_list(rows)
    longest = fit.agg(F.max(F.size("x"))).head()[0]
    same = F.size("x") == F.lit(longest)
    fit, rows = fit.where(same), rows.where(same)
    known = scatter(fit)
    if known is None:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, {RESULT}")
    values, axes, trace = known.components(components)
    solid = [k for k, e in enumerate(values) if e > values[0] * 1e-12 > 0]

    def projected(k: int) -> Column:
        return total(
            [
                (F.get("x", F.lit(d)) - F.lit(s / known.n)) * F.lit(axes[k][d])
                for d, s in enumerate(known.sums)
            ]
        ) / F.lit(sqrt(values[k]))

    scores = fit.select(*(projected(k).alias(f"c{k}") for k in solid))
    pairs = list(combinations_with_replacement(solid, 2))
    error = 0.0
    if pairs:
        found = scores.agg(*(F.covar_pop(f"c{a}", f"c{b}") for a, b in pairs)).head()
        error = max(abs(v - (a == b)) for v, (a, b) in zip(found, pairs, strict=True))
    each = [
        F.struct(
            F.lit(k + 1).alias("component"),
            (projected(k) if k in solid else F.lit(None).cast("double")).alias("whitened"),
            F.lit(float(e / trace) if trace else 0.0).alias("explained"),
        )
        for k, e in enumerate(values)
    ]
    return rows.select(
        "vec_id", deviation("x", known).alias("deviation"), F.explode(F.array(*each)).alias("c")
    ).select(
        "vec_id",
        "c.component",
        F.lit(known.n).cast("long").alias("n"),
        "deviation",
        "c.whitened",
        "c.explained",
        F.lit(float(error)).alias("identity_error"),
    )
