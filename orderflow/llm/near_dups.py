"""Near-duplicate detection with fast similarity sketches.

A document's set is its distinct word shingles as 64-bit hashes. The sketch has
one coordinate per bin: in each of the first rounds every element falls into one
hashed bin, in each of as many more rounds all elements fall into the next bin in
turn, and a bin keeps the smallest hash of the first round that reached it. So
every coordinate fills after at most twice as many rounds as bins, most documents
need a few, and the share of equal coordinates is concentrated around the Jaccard
similarity.

Equal sets are one node. Nodes that agree in all coordinates of a band share a
bucket. Links are found without comparing all pairs of a bucket:

1. every node is compared with its bucket's smallest node;
2. verified links make components, and only buckets that still hold several
   components are looked at again. In some ``rounds``, as long as they find links, a
   node outside its bucket's largest component is compared with a member of it, another
   one in each bucket and round, for a few of its buckets;
3. of small buckets all pairs across components are then compared;
4. of large ones the nodes outside the largest component, and all nodes, are cut into
   blocks, and each pair of such blocks is a group of its own. There a second, longer
   sketch of each node tells which pairs across components may reach the threshold;
   only those are compared. A pair that shares several buckets is looked at in the
   first.

So a bucket of k nodes of which m are outside its largest component is dealt out as some
2 k m / block rows. Many pages of one template that do not link have m near k.

Every link is confirmed on the full sets. A pair at the threshold shares no band
with probability (1 - least ** rows) ** bands, 5e-6 with the defaults, and falls
``slack`` standard deviations below it in step 4 with probability 4e-6. ``prints=0``
leaves the second sketch out: all pairs across components of a bucket are confirmed.

Defined cases: a null or empty text, or one without words, has an empty set and
links with nothing; fewer words than a shingle are one shingle; rows of equal id
and text are in the same component, and stay or go together; component ids are the
smallest non-null doc_id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.batches import offsets, slices, spread
from orderflow.llm.text import stored, whole

#: Bits of a coordinate that hold the hash; the round is above them.
HASH = 48
EMPTY = np.uint64((1 << 64) - 1)


@dataclass(frozen=True)
class Near:
    """words per shingle; percent: least similarity; bands of rows coordinates each;
    rounds and their buckets a node: see step 2; small: largest bucket whose pairs are compared without a look at sketches; block:
    nodes of a large bucket in one block; prints: coordinates of the second sketch, none to
    confirm all pairs of large buckets too."""

    words: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 6
    rounds: int = 3
    buckets: int = 4
    small: int = 8
    block: int = 256
    prints: int = 720
    slack: float = 4.5

    @property
    def bins(self) -> int:
        return self.bands * self.rows

    @property
    def least_prints(self) -> int:
        """Equal coordinates that a pair at the threshold has but for a rare error."""
        share = self.percent / 100
        return int(self.prints * share - self.slack * (self.prints * share * (1 - share)) ** 0.5)


def mixed(value: np.ndarray) -> np.ndarray:
    """64-bit mix of uint64 values."""
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, in one array, and their numbers."""
    found = [t.encode("utf-8", "replace").lower().split() if t else [] for t in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    flat = [word for one in found for word in one]
    if not flat:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    codes, known = pd.factorize(np.array(flat, dtype=object))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))[codes]
    # Documents shorter than a shingle have one, of all their words.
    n = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
    first = spread(offsets(counts)[:-1], n)
    width = np.repeat(np.minimum(counts, words), n)
    value = mixed(width.astype(np.uint64) * STEP)
    for k in range(words):
        there = width > k
        value[there] = mixed(value[there] * STEP + hashes[first[there] + k])
    owner = np.repeat(np.arange(len(texts)), n)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return value[fresh], np.bincount(owner[fresh], minlength=len(texts))


def sketches(values: np.ndarray, sizes: np.ndarray, bins: int, seed: int = 0) -> np.ndarray:
    """One row of coordinates per set; rows of empty sets stay unfilled."""
    values = mixed(values + np.uint64(seed)) if seed else values
    sketch = np.full(len(sizes) * bins, EMPTY)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for turn in range(2 * bins):
        if not len(values):
            break
        hashed = mixed(values + np.uint64(int(STEP) * (turn + 1) % (1 << 64)))
        if turn < bins:
            slot = ((hashed >> np.uint64(HASH)) * np.uint64(bins) >> np.uint64(64 - HASH)).astype(np.int64)
        else:
            slot = turn - bins
        value = (np.uint64(turn) << np.uint64(HASH)) | (hashed & np.uint64((1 << HASH) - 1))
        np.minimum.at(sketch, owner * bins + slot, value)
        unfilled = (sketch.reshape(-1, bins) == EMPTY).any(axis=1)
        stay = unfilled[owner]
        values, owner = values[stay], owner[stay]
    return sketch.reshape(len(sizes), bins)


def band_keys(sketch: np.ndarray, near: Near) -> np.ndarray:
    """One 64-bit key per set and band."""
    parts = sketch.reshape(len(sketch), near.bands, near.rows)
    keys = np.tile(mixed(np.arange(1, near.bands + 1, dtype=np.uint64) * STEP), (len(sketch), 1))
    for k in range(near.rows):
        keys = mixed(keys * STEP + parts[:, :, k])
    return keys


def _row_key() -> dict[str, Column]:
    """What tells rows apart."""
    return {
        "id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        "mark": F.xxhash64(whole("text")),
    }


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(
        pa.array(offsets(sizes).astype(np.int32)), pa.array(values.view(np.int64))
    )


def _signatures(values: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    ends = offsets(sizes)
    return [
        xxhash.xxh3_128_digest(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)
    ]


def sketched(docs: DataFrame, near: Near) -> DataFrame:
    """Per row: doc_id, id, mark, size of its set, signature of its set and band keys."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                values, sizes = shingle_sets(texts, near.words)
                keys = band_keys(sketches(values, sizes, near.bins), near)
                columns = [part.column(n) for n in ("doc_id", "id", "mark")]
                columns += [
                    pa.array(sizes),
                    pa.array(_signatures(values, sizes), pa.binary()),
                    _lists(keys.ravel(), np.full(len(sizes), near.bands)),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "id", "mark", "n", "signature", "bands"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, id string, mark long, n long, signature binary, bands array<long>"
    rows = docs.select("doc_id", "text").withColumns(_row_key())
    return stored(rows.mapInArrow(sketch, schema), "near-sketches")


def full_sets(docs: DataFrame, wanted: DataFrame, near: Near) -> DataFrame:
    """Of the wanted (id, mark, node) rows: node, its set, eight bits of each coordinate
    of a second sketch, and 32 bits of each band key."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of equal id and text meet in one task; one of them will do.
        known: set[int] = set()
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            fresh = [node not in known and not known.add(node) for node in nodes]
            for part, texts in slices(batch.filter(pa.array(fresh)), "text"):
                values, sizes = shingle_sets(texts, near.words)
                longer = mixed(sketches(values, sizes, near.prints, seed=1)).astype(np.uint8)
                keys = band_keys(sketches(values, sizes, near.bins), near).astype(np.uint32)
                columns = [part.column("node"), _lists(values, sizes), _packed(longer), _packed(keys)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "shingles", "prints", "keys"])

    schema = "node long, shingles array<long>, prints binary, keys binary"
    key = ["id", "mark"]
    # Texts move to the few rows wanted, at any size of the table.
    rows = docs.select("doc_id", "text").withColumns(_row_key()).join(wanted.hint("shuffle_hash"), key)
    return stored(rows.select("node", "text").mapInArrow(collect, schema), "near-sets")


def _packed(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows], pa.binary())


def linked(edges: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """The edges (a, b) whose full sets are similar enough."""
    common = F.size(F.array_intersect("shingles", "others"))
    size_a, size_b = F.size("shingles"), F.size("others")
    return (
        edges.join(sets.withColumnRenamed("node", "a"), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("others")), "b")
        .where(100 * F.least(size_a, size_b) >= near.percent * F.greatest(size_a, size_b))
        .where(100 * common >= near.percent * (size_a + size_b - common))
        .select("a", "b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node it reaches, of all nodes with an edge.

    Smallest labels of neighbours, then the label's own label, until nothing changes.
    """
    both = stored(
        edges.union(edges.select("b", "a")).toDF("node", "other").distinct(), "near-edges"
    )
    labels = stored(
        both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "near-labels"
    )
    while True:
        seen = (
            both.join(labels.toDF("other", "theirs"), "other")
            .groupBy("node")
            .agg(F.min("theirs").alias("theirs"))
        )
        step = labels.join(seen, "node").withColumn("best", F.least("label", "theirs"))
        jump = labels.toDF("best", "beyond")
        moved = stored(
            step.join(jump, "best").select(
                "node", "label", F.least("best", "beyond").alias("new_label")
            ),
            "near-labels",
        )
        labels = moved.select("node", F.col("new_label").alias("label"))
        if moved.where("label <> new_label").isEmpty():
            return labels


def _crowded(rows: DataFrame) -> DataFrame:
    """The (bucket, node) rows whose bucket has more than one node."""
    several = rows.groupBy("bucket").agg(F.count("*").alias("k"), F.min("node").alias("leader"))
    return rows.join(stored(several.where("k > 1"), "near-several"), "bucket")


class _Links:
    """Verified links so far and the components they make."""

    def __init__(self, sets: DataFrame, near: Near):
        self.sets, self.near = sets, near
        self.verified: list[DataFrame] = []
        self.tested: list[DataFrame] = []
        self.labels: DataFrame | None = None

    def label(self, rows: DataFrame, node: str, into: str) -> DataFrame:
        """The rows with the component of a node, itself if it has no link."""
        if self.labels is None:
            return rows.withColumn(into, F.col(node))
        known = self.labels.toDF(node, "__label")
        return rows.join(known, node, "left").withColumn(
            into, F.coalesce("__label", node)
        ).drop("__label")

    def test(self, edges: DataFrame) -> bool:
        """Verifies edges that were not tested before; whether any is a link."""
        edges = edges.select("a", "b").distinct()
        if self.tested:
            edges = edges.join(reduce(DataFrame.union, self.tested), ["a", "b"], "left_anti")
        edges = stored(edges, "near-candidates")
        self.tested.append(edges)
        found = stored(linked(edges, self.sets, self.near), "near-links")
        if found.isEmpty():
            return False
        self.verified.append(found)
        self.labels = components(reduce(DataFrame.union, self.verified))
        return True


def _mixed_buckets(rows: DataFrame, links: _Links) -> DataFrame:
    """Rows (bucket, node, label, k, outside, main) of buckets of k nodes that hold
    several components; main tells the nodes of the largest one, outside counts the
    others."""
    labelled = links.label(rows.select("bucket", "node"), "node", "label")
    groups = labelled.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    several = (
        groups.groupBy("bucket")
        .agg(
            F.sum("n").alias("k"),
            F.max(F.struct("n", "label")).alias("top"),
            F.count("*").alias("labels"),
        )
        .where("labels > 1")
        .select(
            "bucket", "k", (F.col("k") - F.col("top.n")).alias("outside"), F.col("top.label").alias("main")
        )
    )
    found = labelled.join(stored(several, "near-mixed"), "bucket")
    return stored(found.withColumn("main", F.col("label") == F.col("main")), "near-mixed")


def _with_members(rows: DataFrame, turn: int, near: Near) -> DataFrame:
    """Pairs (a, b) of nodes outside the largest component of a bucket with a member."""
    rank = F.xxhash64("node", "bucket", F.lit(turn))
    members = rows.where("main").groupBy("bucket").agg(F.min(F.struct(rank, "node")).alias("member"))
    own = Window.partitionBy("node").orderBy(F.xxhash64("bucket", F.lit(turn)), "bucket")
    outside = rows.where("NOT main").withColumn("turn", F.row_number().over(own))
    met = outside.where(F.col("turn") <= near.buckets).join(members, "bucket")
    return met.select(
        F.least("node", "member.node").alias("a"), F.greatest("node", "member.node").alias("b")
    )


def _across(rows: DataFrame) -> DataFrame:
    """All pairs of a bucket that lie in different components."""
    left = rows.select("bucket", F.col("node").alias("a"), F.col("label").alias("la"))
    right = rows.select("bucket", F.col("node").alias("b"), F.col("label").alias("lb"))
    return left.join(right, "bucket").where("a < b AND la <> lb").select("a", "b")


def _block_pairs(bucket: int, sides: tuple, near: Near) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one group that may be similar: across components, in the first
    bucket they share, and close by their second sketch."""
    node, label, seeks, main, prints, keys = sides
    band = int(np.flatnonzero(keys[0] == np.uint32(bucket % (1 << 32)))[0])
    found_a, found_b = [], []
    met = np.flatnonzero(~seeks)
    for i in np.flatnonzero(seeks).tolist():
        # Of two nodes that both seek, the smaller one finds the other.
        other = met[(label[met] != label[i]) & (main[met] | (node[met] > node[i]))]
        other = other[~(keys[other, :band] == keys[i, :band]).any(axis=1)]
        if len(other):
            if near.prints:
                other = other[(prints[other] == prints[i]).sum(axis=1) >= near.least_prints]
            found_a.append(np.full(len(other), node[i]))
            found_b.append(node[other])
    none = [np.empty(0, np.int64)]
    return np.concatenate(found_a or none), np.concatenate(found_b or none)


def _likely(rows: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """Pairs (a, b) of large buckets that their sketches let through.

    The nodes outside a bucket's largest component are dealt to blocks by hash, and so
    are all its nodes; every pair of such blocks is a group. Tasks hold one at a time.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in _with_end(batches):
            if batch is not None:
                rows = pa.Table.from_batches([batch])
                held = rows if held is None else pa.concat_tables([held, rows])
            if held is None or not len(held):
                continue
            group = np.stack([held[c].to_numpy() for c in ("bucket", "i", "j")], axis=1)
            starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(axis=1)])
            ends = np.r_[starts[1:], len(group)]
            ready = len(starts) if batch is None else len(starts) - 1
            for a, b in zip(starts[:ready].tolist(), ends[:ready].tolist(), strict=True):
                part = held.slice(a, b - a)
                sides = (
                    *(part[c].to_numpy() for c in ("node", "label", "seeks", "main")),
                    np.frombuffer(b"".join(part["prints"].to_pylist()), np.uint8).reshape(b - a, near.prints),
                    np.frombuffer(b"".join(part["keys"].to_pylist()), np.uint32).reshape(b - a, near.bands),
                )
                one, other = _block_pairs(int(group[a, 0]), sides, near)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(one, other)), pa.array(np.maximum(one, other))], ["a", "b"]
                )
            held = held.slice(starts[ready]) if ready < len(starts) else None

    place = F.xxhash64("node", "bucket")

    def dealt(some: DataFrame, own: str, other: str, into: tuple[str, str], seeks: bool) -> DataFrame:
        """Each row for its own block of one kind and all blocks of the other."""
        sizes = [F.ceil(F.col(c) / near.block).cast("int") for c in (own, other)]
        return some.select(
            "bucket",
            F.pmod(place, sizes[0]).cast("int").alias(into[0]),
            F.explode(F.sequence(F.lit(0), sizes[1] - 1)).alias(into[1]),
            "node",
            "label",
            F.lit(seeks).alias("seeks"),
            "main",
        )

    dealt_rows = dealt(rows.where("NOT main"), "outside", "k", ("i", "j"), True).unionByName(
        dealt(rows, "k", "outside", ("j", "i"), False)
    )
    group = ["bucket", "i", "j"]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt_rows.join(sets.select("node", "prints", "keys"), "node")
        .repartition(tasks, *group)
        .sortWithinPartitions(*group)
        .mapInArrow(compare, "a long, b long")
    )


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def link_nodes(nodes: DataFrame, docs: DataFrame, near: Near) -> DataFrame | None:
    """Components of (node, id, mark, bands) rows; None without any link."""
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    rows = stored(_crowded(banded), "near-buckets")
    wanted = nodes.select("node", "id", "mark").join(
        rows.select("node").distinct(), "node", "left_semi"
    )
    sets = full_sets(docs, wanted, near)
    links = _Links(sets, near)
    stars = rows.where("node <> leader")
    links.test(stars.select(F.col("leader").alias("a"), F.col("node").alias("b")))
    mixed_rows = _mixed_buckets(rows, links)
    for turn in range(near.rounds):
        if mixed_rows.isEmpty():
            break
        if not links.test(_with_members(mixed_rows, turn, near)):
            break
        mixed_rows = _mixed_buckets(rows, links)
    few = _across(mixed_rows.where(F.col("k") <= near.small))
    many = _likely(mixed_rows.where(F.col("k") > near.small), sets, near)
    links.test(few.union(many))
    return links.labels


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """Per row: doc_id, id, mark, n_shingles, component_id and kept."""
    rows = sketched(docs, near)
    nodes = stored(
        rows.where("n > 0")
        .groupBy("signature")
        .agg(
            F.min("doc_id").alias("smallest"),
            F.first(F.struct("id", "mark")).alias("row"),
            F.first("bands").alias("bands"),
        )
        .select(
            F.monotonically_increasing_id().alias("node"), "signature", "smallest", "row.*", "bands"
        ),
        "near-nodes",
    )
    labels = link_nodes(nodes, docs, near)
    named = nodes.select("node", "signature", "smallest")
    if labels is not None:
        grouped = named.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        least = grouped.groupBy("label").agg(F.min("smallest").alias("component_id"))
        named = grouped.join(least, "label")
    else:
        named = named.withColumn("component_id", F.col("smallest"))
    found = rows.select("doc_id", "id", "mark", "n", "signature").join(
        named.select("signature", "component_id", F.lit(True).alias("__set")), "signature", "left"
    )
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        "id",
        "mark",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """The documents with the smallest id of their component; columns unchanged."""
    stay = stored(near_duplicates(docs, near).where("kept").select("id", "mark"), "near-kept")
    key = {f"__{name}": value for name, value in _row_key().items()}
    stay = stay.toDF(*key)
    return docs.withColumns(key).join(stay, list(key), "left_semi").drop(*key)
