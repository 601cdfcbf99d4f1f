"""Exact deduplication by naming blocks.

A normalised text is cut into blocks of a fixed number of bytes. The distinct
blocks are sorted and numbered task by task, so a block's name is an integer that
no other block has. Adjacent names are paired, the distinct pairs are numbered
in turn, and so on until each document has one name. Two documents end with the
same name in the same round exactly if their texts are equal; hashes only set
aside documents that hold a block found nowhere else, which have no equal.

Defined cases: a null text is empty, an empty text is one empty block. Rows that
share doc_id and normalised text are one document: they give one result row, and
group_size counts them all. A null doc_id is an id of its own; it is never the
smallest unless a group has no other. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.text import SPACE, bound, stored, whole

BLOCK_BYTES = 4096
KEY = ["id", "sha"]


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space."""
    return F.regexp_replace(text, rf"\x20{SPACE}++|[\x09-\x0D]{SPACE}*+", " ")


def blocks(text: Column, size: int) -> Column:
    """The text's bytes in blocks of ``size``, at least one."""

    def cut(raw: Column) -> Column:
        last = F.floor((F.greatest(F.octet_length(raw), F.lit(1)) - 1) / size).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.substring(raw, i * size + 1, F.lit(size)),
        )

    return bound(text.cast("binary"), cut)


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with id (never null) and sha of the normalised text, which tell rows apart."""
    text = normalised(whole("text"))
    return docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        text.alias("text"),
    )


def _numbered(values: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values with an integer name each: equal values meet in one task of
    the ``distinct``, each task sorts its values and numbers them in a range of its
    own. Written down, so that a repeated task cannot give other names."""
    ranked = values.select(*columns).distinct().sortWithinPartitions(*columns)
    return stored(ranked.withColumn("new_name", F.monotonically_increasing_id()), "block-names")


def _pair_up(sequences: DataFrame) -> DataFrame:
    """One round: names of adjacent pairs; a last single name is paired with -1."""
    even = F.col("pos") % 2 == 0
    pairs = (
        sequences.groupBy(
            *KEY, ((F.col("n") + 1) / 2).cast("int").alias("n"), (F.col("pos") / 2).cast("int").alias("pos")
        )
        .agg(
            F.max(F.when(even, F.col("name"))).alias("left_name"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right_name"),
        )
    )
    sides = ["left_name", "right_name"]
    return stored(
        pairs.join(_numbered(pairs, sides), sides).select(
            *KEY, "n", "pos", F.col("new_name").alias("name")
        ),
        "block-rounds",
    )


def duplicate_classes(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: id, sha, doc_id, keep_id, group_size and the rows it stands for."""
    rows = _keyed(docs)
    cut = blocks(F.col("text"), block_bytes)
    prints = stored(
        rows.select("doc_id", *KEY, F.transform(cut, lambda block: F.xxhash64(block)).alias("hashes"))
        .groupBy(*KEY)
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("hashes").alias("hashes"),
            F.count("*").alias("n_rows"),
        ),
        "block-prints",
    )
    hashed = prints.select(*KEY, F.size("hashes").alias("n"), F.explode("hashes").alias("hash"))
    repeated = stored(
        hashed.groupBy("hash").agg(F.count("*").alias("k")).where("k > 1").select("hash"),
        "block-repeats",
    )
    shared = stored(
        hashed.join(repeated, "hash", "left_semi")
        .groupBy(*KEY, "n")
        .agg(F.count("*").alias("k"))
        .where("k = n")
        .select(*KEY, "n"),
        "block-candidates",
    )
    # The one time that texts move: to the few rows of their key, at any size of the table.
    pieces = stored(
        rows.join(shared.hint("shuffle_hash"), KEY)
        .select(*KEY, "n", F.posexplode(cut).alias("pos", "block"))
        .distinct(),
        "block-pieces",
    )
    sequences = stored(
        pieces.join(_numbered(pieces, ["block"]), "block").select(
            *KEY, "n", "pos", F.col("new_name").alias("name")
        ),
        "block-rounds",
    )
    named = []
    longest = shared.agg(F.max("n")).first()[0] or 1
    for turn in range((longest - 1).bit_length() + 1):
        named.append(sequences.where("n = 1").select(*KEY, F.lit(turn).alias("turn"), "name"))
        if 1 << turn < longest:
            sequences = _pair_up(sequences.where("n > 1"))
    identities = reduce(DataFrame.unionByName, named).join(
        prints.select(*KEY, "doc_id", "n_rows"), KEY
    )
    identities = stored(identities, "block-identities")
    classes = stored(
        identities.groupBy("turn", "name").agg(
            F.min("doc_id").alias("keep_id"), F.sum("n_rows").alias("group_size")
        ),
        "block-classes",
    )
    members = identities.join(classes, ["turn", "name"]).select(*KEY, "keep_id", "group_size")
    return prints.join(members, KEY, "left").select(
        *KEY,
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", "n_rows").alias("group_size"),
        "n_rows",
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def deduplicated(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that stay, columns unchanged; of rows that share id and
    normalised text the one with the smallest raw text."""
    stay = stored(duplicate_classes(docs, block_bytes).where("kept").select(*KEY), "block-kept")
    stay = stay.select(F.col("id").alias("__id"), F.col("sha").alias("__sha"))
    key = ["__id", "__sha"]
    rows = docs.withColumns(
        {
            "__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            "__sha": F.unhex(F.sha2(normalised(whole("text")), 256)),
        }
    )
    first = Window.partitionBy(*key).orderBy("text")
    return (
        rows.join(stay, key, "left_semi")
        .withColumn("__row", F.row_number().over(first))
        .where("__row = 1")
        .drop(*key, "__row")
    )
