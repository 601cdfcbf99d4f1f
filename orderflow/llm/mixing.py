"""Mixing of sources to target weights by thresholds on a document hash.

Every document has a hash that depends on its id alone. A source's documents are
taken in full as often as its target allows, and once more where the hash lies
below the source's threshold. The threshold comes from histograms: words are
summed by source and hash bucket, and only the bucket that crosses the budget is
looked at again with finer buckets, until it holds one hash. Nothing is sorted
and each pass reads a narrow table of ids, sizes and hashes.

The sources themselves, one row each, are ordered in one task: tens of thousands of them
are fine, sources as fine as hosts are not what this is for.

Defined cases: a null text has size 0, the null source is a source of its own and
comes last, documents of equal id share a hash and are taken together, a null id
is hashed as the empty string, and an empty table gives an empty mix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.text import stored, whole, word_count

HASH_BITS = 56


@dataclass(frozen=True)
class Mix:
    """weights repeat over the sources in code point order; the mix holds ``share``
    times all words; no source gives more than ``most`` times its own. ``bits`` is
    the width of one histogram level; it divides 56."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most: int = 2
    seed: str = "mix"
    bits: int = 8


def id_hash(key: Column, seed: str) -> Column:
    """56 bits of md5 over the seed and the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size) to their targets and how often each is taken in full.

    One row per source: filling up by weight, lightest cap per weight first. The
    level that all uncapped sources reach is the highest one met on the way.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*map(F.lit, mix.weights)),
        (F.row_number().over(by_name) - 1) % len(mix.weights) + 1,
    ).cast("long")
    cap = F.col("source_size") * mix.most
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * F.lit(mix.share)
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    return (
        sizes.withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
        .withColumn(
            "passes",
            F.when(F.col("source_size") == 0, F.lit(0))
            .otherwise(F.floor(F.col("target") / F.col("source_size")))
            .cast("int"),
        )
        .withColumn("budget", F.col("target") - F.col("passes") * F.col("source_size"))
        .select("source", "source_size", "target", "passes", "budget")
    )


def _refine(rows: DataFrame, state: DataFrame, level: int, mix: Mix) -> DataFrame:
    """One histogram level: finds the bucket that crosses each open source's budget."""
    step = HASH_BITS - mix.bits * (level + 1)
    width = 1 << step
    start = F.expr(f"shiftleft(shiftright(hash, {step}), {step})")
    opened = state.where("open").select(
        F.col("source").alias("at"), "below", "budget", F.col("threshold").alias("low")
    )
    inside = rows.join(
        opened,
        rows["source"].eqNullSafe(F.col("at"))
        & (F.col("hash") >= F.col("low"))
        & (F.col("hash") - F.col("low") < width * (1 << mix.bits)),
    )
    by_bucket = Window.partitionBy("at").orderBy("bucket")
    crossing = (
        inside.groupBy("at", "below", "budget", start.alias("bucket"))
        .agg(F.sum("size").alias("words"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
        .withColumn("upto", F.col("below") + F.sum("words").over(by_bucket))
        .where(F.col("upto") > F.col("budget"))
        .groupBy("at", "budget")
        .agg(F.min_by(F.struct("bucket", "words", "lo", "hi", "upto"), "bucket").alias("b"))
        .select("at", "budget", "b.*")
        .withColumn("before", F.col("upto") - F.col("words"))
        .withColumn("single", F.col("lo") == F.col("hi"))
        .withColumn(
            "taken", F.col("upto") - F.col("budget") < F.col("budget") - F.col("before")
        )
        .select(
            "at",
            F.when(~F.col("single"), F.col("bucket"))
            .when(F.col("taken"), F.col("lo") + 1)
            .otherwise(F.col("lo"))
            .alias("new_threshold"),
            F.col("before").alias("new_below"),
            (~F.col("single")).alias("new_open"),
        )
    )
    return state.join(crossing, state["source"].eqNullSafe(crossing["at"]), "left").select(
        "source",
        "source_size",
        "target",
        "passes",
        "budget",
        F.coalesce("new_threshold", "threshold").alias("threshold"),
        F.coalesce("new_below", "below").alias("below"),
        F.coalesce("new_open", F.lit(False)).alias("open"),
    )


def thresholds(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, size, hash) rows to one row per source with passes and threshold.

    The prefix of hashes whose words come nearest to the budget is taken; of two
    equally near ones the shorter.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    state = stored(
        targets(sizes, mix).select(
            "*",
            F.lit(0).cast("long").alias("threshold"),
            F.lit(0).cast("long").alias("below"),
            (F.col("budget") > 0).alias("open"),
        ),
        "mix-targets",
    )
    for level in range(HASH_BITS // mix.bits):
        if state.where("open").isEmpty():
            break
        state = stored(_refine(rows, state, level, mix), "mix-level")
    return state.select("source", "source_size", "target", "passes", "threshold")


def sized(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, source, size and hash of every document."""
    return docs.select(
        "doc_id",
        "source",
        word_count(whole("text")).alias("size"),
        id_hash(F.col("doc_id"), mix.seed).alias("hash"),
    )


def copies(hashes: Column) -> Column:
    """How often the mix takes a document; needs the columns of thresholds()."""
    return F.col("passes") + (hashes < F.col("threshold")).cast("int")


def mix_plan(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per document: its size, its source's size and target, and how often it is taken."""
    rows = stored(sized(docs, mix), "mix-sizes")
    plan = thresholds(rows, mix).withColumnRenamed("source", "at")
    return rows.join(plan, rows["source"].eqNullSafe(plan["at"])).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies(F.col("hash")).alias("copies"),
        (F.col("size") * copies(F.col("hash"))).alias("taken"),
    )


def mixed(docs: DataFrame, mix: Mix = Mix(), copy: str | None = None) -> DataFrame:
    """The documents of the mix, each as often as it is taken, columns unchanged;
    ``copy`` names a column for the copy's number, from 1."""
    plan = thresholds(stored(sized(docs, mix), "mix-sizes"), mix).select(
        F.struct("source", "passes", "threshold").alias("__mix")
    )
    rows = docs.join(plan, docs["source"].eqNullSafe(F.col("__mix.source")))
    times = F.col("__mix.passes") + (
        id_hash(docs["doc_id"], mix.seed) < F.col("__mix.threshold")
    ).cast("int")
    taken = rows.withColumn("__copy", F.explode(F.when(times > 0, F.sequence(F.lit(1), times))))
    number = [] if copy is None else [F.col("__copy").alias(copy)]
    return taken.select(*(F.col(c) for c in docs.columns if c != copy), *number)
