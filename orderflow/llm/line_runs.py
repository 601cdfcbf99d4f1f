"""Line deduplication over levelled sorted runs.

A run is a table of line hashes, bucketed and sorted by hash, with the number of
documents that hold the line and the largest of their ids. Documents come in
batches. A batch's hashes are merge-joined with the runs, without shuffling or
sorting those: hashes the runs lack become a new run, the others are set down as
repeats. When a level has ``fanout`` runs they are merged into one of the next
level. At the end every hash stands in one run, and the runs merge-joined with
the few repeats give the lines found in enough documents.

Hashes are 128-bit md5 of the line's key. Defined cases: a null or empty text is
one empty line; each row counts as a document, and a line once per row; rows of
the largest id all keep their line; a null id counts as the smallest, and ids that are
no whole numbers are compared as text; a key below ``min_chars`` is never dropped. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.text import SPACES, bound, lower_ascii, stored, whole
from orderflow.plans.scratch import scratch_dir


@dataclass(frozen=True)
class LineRules:
    """Lines of at least ``min_chars`` code points found in ``min_docs`` documents
    go; ``batches`` is the number of batches a whole table is fed in."""

    min_chars: int = 40
    min_docs: int = 5
    batches: int = 4
    fanout: int = 3


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.trim(line, F.lit(SPACES)))


def _entries(text: Column, min_chars: int) -> Column:
    """(hash, pos, first) of the lines that can be dropped, sorted by hash."""
    keys = F.transform(split_lines(text), line_key)
    hashed = F.transform(
        keys,
        lambda k, i: F.struct(
            F.when(F.length(k) >= min_chars, F.unhex(F.md5(k))).alias("hash"), i.alias("pos")
        ),
    )
    return bound(
        F.array_sort(F.filter(hashed, lambda x: x["hash"].isNotNull())),
        lambda all_of: F.transform(
            all_of,
            lambda x, i: F.struct(
                x["hash"].alias("hash"),
                x["pos"].alias("pos"),
                ((i == 0) | (F.get(all_of, i - 1)["hash"] != x["hash"])).alias("first"),
            ),
        ),
    )


def _row_key(docs: DataFrame) -> dict[str, Column]:
    """id and mark tell rows apart; equal rows share them and their lines. Ids that are
    no whole numbers are compared as text; a null one is below all others."""
    whole_number = docs.schema["doc_id"].dataType.simpleString() in (
        "tinyint",
        "smallint",
        "int",
        "bigint",
    )
    kind, least = ("long", F.lit(-(2**63))) if whole_number else ("string", F.lit(""))
    return {
        "__id": F.coalesce(F.col("doc_id").cast(kind), least),
        "__mark": F.xxhash64(whole("text")),
    }


@dataclass
class LineRuns:
    """Runs of line hashes; ``add`` takes the lines of one batch of documents."""

    spark: SparkSession
    fanout: int = 3
    levels: list[list[str]] = field(default_factory=list)
    repeats: list[str] = field(default_factory=list)
    name: str = field(default_factory=lambda: f"line_runs_{uuid.uuid4().hex}")
    made: int = 0

    def __post_init__(self) -> None:
        # Buckets equal shuffle partitions, so runs join and are written without a shuffle.
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, rows: DataFrame) -> str:
        self.made += 1
        table = f"{self.name}_{self.made}"
        rows.write.partitionBy("fresh").bucketBy(self.buckets, "hash").sortBy("hash").saveAsTable(table)
        return table

    def _read(self, table: str, fresh: bool = True) -> DataFrame:
        return self.spark.table(table).where(F.col("fresh") == fresh).drop("fresh")

    def runs(self) -> list[str]:
        return [table for level in self.levels for table in level]

    def add(self, lines: DataFrame) -> None:
        """lines: hash, id and first (one row per document and hash has first set)."""
        batch = (
            lines.where("first").groupBy("hash").agg(F.count("*").alias("n"), F.max("id").alias("top"))
        )
        known = F.lit(False)
        for i, table in enumerate(self.runs()):
            hit = self._read(table).select("hash", F.lit(True).alias(f"hit{i}"))
            batch = batch.hint("merge").join(hit, "hash", "left")
            known = known | F.col(f"hit{i}").isNotNull()
        table = self._write(batch.select("hash", "n", "top", (~known).alias("fresh")))
        if self.made > 1:
            self.repeats.append(table)
        self.levels = self.levels or [[]]
        self.levels[0].append(table)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        """Merges the runs of a level; they have no hash in common."""
        inputs = self.levels[level]
        union = reduce(DataFrame.unionByName, map(self._read, inputs))
        merged = self._write(union.repartition(self.buckets, "hash").withColumn("fresh", F.lit(True)))
        self.levels[level] = []
        if level + 1 == len(self.levels):
            self.levels.append([])
        self.levels[level + 1].append(merged)
        for table in set(inputs) - set(self.repeats):
            self.spark.sql(f"DROP TABLE {table}")

    def found_in(self, min_docs: int) -> DataFrame:
        """hash and top of the lines that at least ``min_docs`` documents hold."""
        found = []
        more = None
        if self.repeats:
            more = (
                reduce(DataFrame.unionByName, [self._read(t, False) for t in self.repeats])
                .groupBy("hash")
                .agg(F.sum("n").alias("more"), F.max("top").alias("more_top"))
            )
        for table in self.runs():
            run = self._read(table)
            if more is not None:
                run = run.join(more, "hash", "left").select(
                    "hash",
                    (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"),
                    F.greatest("top", "more_top").alias("top"),
                )
            found.append(run.where(F.col("n") >= min_docs).select("hash", "top"))
        return reduce(DataFrame.unionByName, found)

    def drop(self) -> None:
        for table in {*self.runs(), *self.repeats}:
            self.spark.sql(f"DROP TABLE {table}")


def repeated_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Positions of the lines to drop: __id, __mark, __positions."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "lines")
    lines = (
        docs.withColumns(_row_key(docs))
        .select(
            F.col("__id").alias("id"),
            F.col("__mark").alias("mark"),
            F.pmod(F.xxhash64("doc_id"), F.lit(rules.batches)).cast("int").alias("batch"),
            F.inline(_entries(whole("text"), rules.min_chars)),
        )
    )
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)
    runs = LineRuns(spark, rules.fanout)
    for batch in range(rules.batches):
        runs.add(lines.where(F.col("batch") == batch))
    popular = stored(runs.found_in(rules.min_docs), "lines-found")
    runs.drop()
    return (
        lines.join(popular, "hash")
        .where("id <> top")
        .groupBy(F.col("id").alias("__id"), F.col("mark").alias("__mark"))
        .agg(F.collect_set("pos").alias("__positions"))
    )


def without_repeated_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents with kept_text, n_lines and n_dropped; other columns unchanged."""
    gone = repeated_lines(docs, rules)
    text = whole("text")
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1

    def keep(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__positions"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    kept = F.when(F.col("__positions").isNull(), text).otherwise(bound(split_lines(text), keep))
    return (
        docs.withColumns(_row_key(docs))
        .join(gone, ["__id", "__mark"], "left")
        .withColumns(
            {
                "kept_text": kept,
                "n_lines": n_lines.cast("long"),
                "n_dropped": F.coalesce(F.size("__positions"), F.lit(0)).cast("long"),
            }
        )
        .drop("__id", "__mark", "__positions")
    )
