"""Similarity join on n-gram sets by rare-first prefix filtering.

A document's set is its distinct word n-grams as 64-bit hashes; equal sets are one class.
Two classes link if the Jaccard similarity of their sets reaches ``percent``.

1. A class that links shares all but n - ceil(t n) of its n-grams. So a part of the
   n-grams, those with the smallest hashes, is shuffled first: a class with more than
   that many n-grams of its own in this part cannot link and goes no further. Of an
   n-gram of many classes two postings a slice are enough to know it as shared.
2. One text of each class left moves to give its set, and one posting (n-gram, class)
   per n-gram is shuffled by n-gram, which tells how common each one is. Only shared
   ones go on, to their class. In the order of all n-grams, by frequency and then hash,
   those of one class come first.
3. A class's prefix is its first n - ceil(t n) + 1 n-grams in that order. Linked classes
   share an n-gram of both prefixes. A class with less than t n shared n-grams has none
   in its prefix and goes no further.
4. Classes that share a prefix n-gram are candidates if their lengths allow the
   similarity, if the n-grams left after the shared one do (positional filter), and if
   those do by 16 parts of the hash range: the overlap is at most the sum over parts
   of the lesser number of n-grams (suffix filter). In the smaller class the shared one
   must lie where even a class of the same length could still be reached.
5. A candidate pair is verified once, on all shared n-grams. Only components are asked
   for, so not all pairs of a posting list are made: each class meets the first one of
   its list, and links make components. In some ``rounds`` more, the classes outside a
   list's largest component meet one member of it, another one in each list and round.
   Then those still outside meet all others of their list.

An n-gram of very many classes would fill one task in step 2. Counters kept by each task
(Misra and Gries) find all n-grams with more postings than ``crowd``, ``noticed`` per
task and some 2 / ``counters`` of all together; there are at most twice as many as
counters, so their list may be sent to all tasks. Their postings need no count: they
stand last in the order, and are dealt by class too.

Defined cases: a null or empty text, or one without words, has an empty set and links
with nothing; fewer words than an n-gram are one n-gram; rows of equal id or text count
as rows; component ids are the smallest non-null doc_id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.batches import offsets, slices, spread
from orderflow.llm.near_dups import components, shingle_sets
from orderflow.llm.text import stored, whole

#: Parts of the hash range in the suffix filter.
PARTS = 16
#: Rounds go on up to this multiple of those asked for, as long as one finds a link for
#: every so many classes outside.
LONGER, FEW = 4, 50
#: Frequency of n-grams that are not counted.
LAST = (1 << 62) - 1
#: Postings leave a task in batches of about this many rows.
BATCH_ROWS = 500_000


@dataclass(frozen=True)
class Join:
    """words of an n-gram; percent: least similarity; counters of a task; crowd: fewest
    postings of an n-gram that is left uncounted; noticed: fewest of them that a task
    reports; width: part of the n-grams looked at first, as a multiple of those that a
    class may have alone; rounds: see step 5."""

    words: int = 5
    percent: int = 80
    counters: int = 65_536
    crowd: int = 10_000
    noticed: int = 16
    width: float = 1.4
    rounds: int = 3

    @property
    def sample(self) -> float:
        return self.width * (1 - self.percent / 100)


class Frequent:
    """Counters of the most frequent values: each is short by seen / (most + 1) at most."""

    def __init__(self, most: int):
        self.most, self.seen = most, 0
        self.values, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, values: np.ndarray) -> None:
        self.seen += len(values)
        fresh, counts = np.unique(values, return_counts=True)
        self.values, place = np.unique(np.concatenate([self.values, fresh]), return_inverse=True)
        weights = np.concatenate([self.counts, counts])
        self.counts = np.bincount(place, weights, len(self.values)).astype(np.int64)
        if len(self.values) > self.most:
            self.counts -= np.partition(self.counts, -self.most - 1)[-self.most - 1]
            stay = self.counts > 0
            self.values, self.counts = self.values[stay], self.counts[stay]

    def largest(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Those counted ``least`` times, and not so few that all tasks together could
        miss them at little loss."""
        stay = (self.counts >= least) & (4 * self.most * self.counts > self.seen)
        return self.values[stay], self.counts[stay]


def _named(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers per set that stand for it."""
    ends = offsets(sizes)
    digests = [
        xxhash.xxh3_128_digest(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)
    ]
    return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)


class _Fresh:
    """Which sets a task meets for the first time."""

    def __init__(self):
        self.known: set[tuple[int, int]] = set()

    def __call__(self, names: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        fresh = np.zeros(len(names), bool)
        for i, name in enumerate(map(tuple, names.tolist())):
            if sizes[i] and name not in self.known:
                self.known.add(name)
                fresh[i] = True
        return fresh


def _taken(values: np.ndarray, sizes: np.ndarray, some: np.ndarray) -> np.ndarray:
    """The elements of some sets."""
    return values[spread(offsets(sizes)[:-1][some], sizes[some])]


def _row_key() -> dict[str, Column]:
    return {
        "id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        "mark": F.xxhash64(whole("text")),
    }


def classed(docs: DataFrame, join: Join) -> tuple[DataFrame, np.ndarray]:
    """Per row: doc_id, id, mark, n, its class (s1, s2) and whether its task met the class
    for the first time; and the n-grams left uncounted."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "id", "mark", "n", "s1", "s2", "fresh", "gram", "hits", "seen"]

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, fresh, types = Frequent(join.counters), _Fresh(), None
        for batch in batches:
            for part, texts in slices(batch, "text"):
                values, sizes = shingle_sets(texts, join.words)
                named = _named(values, sizes)
                first = fresh(named, sizes)
                frequent.add(_taken(values, sizes, np.flatnonzero(first)))
                keys = [part.column(c) for c in names[:3]]
                keys += map(pa.array, (sizes, named[:, 0], named[:, 1], first))
                types = [k.type for k in keys]
                blank = [pa.nulls(len(sizes), pa.int64())] * 3
                yield pa.RecordBatch.from_arrays([*keys, *blank], names)
        if frequent.seen:
            grams, hits = frequent.largest(join.noticed)
            # The task's number of postings rides on a row of its own.
            seen = np.r_[np.zeros(len(grams), np.int64), frequent.seen]
            blank = [pa.nulls(len(seen), t) for t in types]
            columns = [np.r_[grams.view(np.int64), 0], np.r_[hits, 0], seen]
            yield pa.RecordBatch.from_arrays([*blank, *map(pa.array, columns)], names)

    schema = (
        f"doc_id {kind}, id string, mark long, n long, s1 long, s2 long, fresh boolean, "
        "gram long, hits long, seen long"
    )
    rows = docs.select("doc_id", "text").withColumns(_row_key()).mapInArrow(classify, schema)
    rows = stored(rows, "join-classes")
    counted = rows.where("gram IS NOT NULL")
    seen = counted.agg(F.sum("seen")).head()[0] or 0
    least = max(join.crowd, seen // (2 * join.counters))
    hot = counted.groupBy("gram").agg(F.sum("hits").alias("hits")).where(F.col("hits") >= least)
    grams = np.array([r.gram for r in hot.select("gram").collect()], np.int64)
    return rows.where("n IS NOT NULL").select(names[:7]), np.sort(grams)


def lonely(docs: DataFrame, join: Join) -> DataFrame:
    """(s1, alone): how many n-grams of the smallest hashes no other class has."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, limit = _Fresh(), np.uint64(min(join.sample, 1.0) * ((1 << 64) - 2**11))
        for batch in batches:
            for _, texts in slices(batch, "text"):
                values, sizes = shingle_sets(texts, join.words)
                named = _named(values, sizes)
                some = np.flatnonzero(fresh(named, sizes))
                grams, owner = _taken(values, sizes, some), np.repeat(some, sizes[some])
                low = np.flatnonzero(grams <= limit)
                order = low[np.argsort(grams[low], kind="stable")]
                found = grams[order]
                # All but the first two classes of an n-gram tell nothing more.
                third = np.zeros(len(found), bool)
                third[2:] = found[2:] == found[:-2]
                stay = np.sort(order[~third])
                columns = [grams[stay].view(np.int64), named[owner[stay], 0]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "s1"])

    postings = docs.select("text").mapInArrow(sample, "gram long, s1 long").repartition("gram")
    classes = postings.groupBy("gram").agg(F.min("s1").alias("s1"), F.max("s1").alias("other"))
    return classes.where("s1 = other").groupBy("s1").agg(F.count("*").alias("alone"))


def wanted_classes(rows: DataFrame, docs: DataFrame, join: Join) -> DataFrame:
    """node, s1, s2, n and one row (id, mark) of each class that may have a link."""
    classes = (
        rows.where("fresh").groupBy("s1", "s2").agg(F.first(F.struct("id", "mark", "n")).alias("row"))
    )
    classes = classes.select("s1", "s2", "row.*").join(lonely(docs, join), "s1", "left")
    own = 100 * (F.col("n") - F.coalesce("alone", F.lit(0))) >= join.percent * F.col("n")
    return stored(
        classes.where(own).select(
            F.monotonically_increasing_id().alias("node"), "s1", "s2", "n", "id", "mark"
        ),
        "join-wanted",
    )


def postings(docs: DataFrame, wanted: DataFrame, hot: np.ndarray, join: Join) -> DataFrame:
    """(gram, node) of the wanted classes, with the node again if the n-gram is hot."""
    names = ["gram", "node", "apart"]

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of equal id and text meet in one task.
        known: set[int] = set()
        for batch in batches:
            for part, texts in slices(batch, "text"):
                nodes = part.column("node").to_numpy()
                fresh = [n not in known and not known.add(n) for n in nodes.tolist()]
                texts = [t for t, new in zip(texts, fresh, strict=True) if new]
                values, sizes = shingle_sets(texts, join.words)
                owner = np.repeat(nodes[np.array(fresh, bool)], sizes)
                grams = values.view(np.int64)
                counted = ~np.isin(grams, hot)
                columns = [pa.array(grams), pa.array(owner), pa.array(owner, mask=counted)]
                for k in range(0, len(grams), BATCH_ROWS):
                    yield pa.RecordBatch.from_arrays([c.slice(k, BATCH_ROWS) for c in columns], names)

    rows = docs.select("doc_id", "text").withColumns(_row_key())
    rows = rows.join(wanted.select("id", "mark", "node").hint("shuffle_hash"), ["id", "mark"])
    return rows.select("node", "text").mapInArrow(explode, "gram long, node long, apart long")


def class_lists(posted: DataFrame, wanted: DataFrame, join: Join) -> DataFrame:
    """Classes that may have a link: node, n and their shared n-grams in order."""
    same = "OVER (PARTITION BY gram, apart)"
    hot = F.col("apart").isNotNull()
    shared = (
        posted.withColumn("classes", F.expr(f"count(*) {same}"))
        .where(hot | (F.col("classes") > 1))
        .select("node", "gram", F.when(hot, F.lit(LAST)).otherwise(F.col("classes")).alias("classes"))
    )
    lists = shared.groupBy("node").agg(
        F.sort_array(F.collect_set(F.struct("classes", "gram"))).alias("grams")
    )
    lists = lists.join(wanted.select("node", "n"), "node")
    enough = 100 * F.size("grams") >= join.percent * F.col("n")
    return stored(
        lists.where(enough).select("node", "n", F.col("grams.gram").alias("grams")), "join-lists"
    )


_ENTRY = ["node", "gram", "n", "at", "rest", *(f"part{k}" for k in range(PARTS))]


def prefixes(lists: DataFrame, join: Join) -> DataFrame:
    """Per class and n-gram of its prefix: place in the list, n-grams after it, and how
    many of them lie in each part of the hash range."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            grams = batch.column("grams")
            sizes = np.diff(grams.offsets.to_numpy())
            flat = grams.flatten().to_numpy()
            # Unshared n-grams fill the first n - size places of the prefix.
            length = sizes - (n * join.percent + 99) // 100 + 1
            starts = offsets(sizes)
            at = spread(np.zeros(len(n), np.int64), length)
            owner = np.repeat(np.arange(len(n)), length)
            place = starts[:-1][owner] + at
            columns = [batch.column("node").take(pa.array(owner)), flat[place], n[owner], at]
            columns.append(sizes[owner] - at - 1)
            part = (flat.view(np.uint64) >> np.uint64(60)).astype(np.int64)
            for k in range(PARTS):
                upto = offsets(part == k)
                columns.append(upto[starts[1:]][owner] - upto[place + 1])
            arrays = [c if isinstance(c, pa.Array) else pa.array(c.astype(np.int64)) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, _ENTRY)

    schema = ", ".join(f"{name} long" for name in _ENTRY)
    return stored(lists.select("node", "n", "grams").mapInArrow(cut, schema), "join-prefixes")


def _side(entries: DataFrame, name: str) -> DataFrame:
    return entries.select(
        "gram", *(F.col(c).alias(f"{c}_{name}") for c in [*_ENTRY, "label"] if c in entries.columns and c != "gram")
    )


def _least_overlap(sizes: Column, percent: int) -> Column:
    """Of similar enough sets whose sizes have this sum."""
    rest = F.pmod(percent * sizes, F.lit(100 + percent))
    return ((percent * sizes - rest) / (100 + percent)).cast("long") + (rest > 0).cast("long")


def _need(join: Join) -> Column:
    return _least_overlap(F.col("n_a") + F.col("n_b"), join.percent)


def matching(a: DataFrame, b: DataFrame, join: Join, also: Column) -> DataFrame:
    """Entries of two classes that share an n-gram and pass all filters."""
    before = F.least("at_a", "at_b") + 1
    by_part = sum(F.least(f"part{k}_a", f"part{k}_b") for k in range(PARTS))
    return (
        _side(a, "a")
        .join(_side(b, "b"), "gram")
        .where(also)
        .where(100 * F.least("n_a", "n_b") >= join.percent * F.greatest("n_a", "n_b"))
        .where(before + F.least("rest_a", "rest_b") >= _need(join))
        .where(before + by_part >= _need(join))
    )


def untested(matches: DataFrame, tested: list[DataFrame]) -> DataFrame:
    """Each pair (a, b) of the matches once, without those tested before.

    One grouping of both: an anti-join per round would read the matches again for each,
    and Spark may put it before they are made distinct.
    """
    pairs = matches.select(
        F.least("node_a", "node_b").alias("a"),
        F.greatest("node_a", "node_b").alias("b"),
        F.lit(False).alias("old"),
    )
    for known in tested:
        pairs = pairs.union(known.select("a", "b", F.lit(True)))
    return pairs.groupBy("a", "b").agg(F.bool_or("old").alias("old")).where("NOT old").select("a", "b")


def verified(pairs: DataFrame, lists: DataFrame, join: Join) -> DataFrame:
    """The pairs whose sets are similar enough."""
    left = lists.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
    right = lists.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))
    common = F.size(F.array_intersect("grams_a", "grams_b"))
    enough = 100 * common >= join.percent * (F.col("n_a") + F.col("n_b") - common)
    found = pairs.join(left, "a").join(right, "b").where(enough).select("a", "b")
    return stored(found, "join-links")


def _leaders(entries: DataFrame, rank: Column, *apart: str) -> DataFrame:
    """The lowest entry of each list, or of each part of it that ``apart`` tells; stored,
    so that a join with the entries may split those of a crowded list."""
    held = [c for c in [*_ENTRY, "label"] if c in entries.columns and c != "gram"]
    found = entries.groupBy("gram", *apart).agg(
        F.min(F.struct(rank.alias("rank"), *held)).alias("first"), F.count("*").alias("k")
    )
    first = [f"first.{c}" for c in held]
    return stored(found.select("gram", "k", *first), "join-leaders")


def several_components(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries of lists that hold several components, with their label and whether it
    is the one of most entries."""
    labelled = entries.join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    groups = labelled.groupBy("gram", "label").agg(F.count("*").alias("k"))
    mains = (
        groups.groupBy("gram")
        .agg(F.max(F.struct("k", "label")).alias("top"), F.count("*").alias("labels"))
        .where("labels > 1")
        .select("gram", F.col("top.label").alias("main"))
    )
    rows = labelled.join(stored(mains, "join-mains"), "gram")
    return stored(rows.withColumn("main", F.col("label") == F.col("main")), "join-several")


def across(rows: DataFrame, join: Join) -> DataFrame:
    """Matches of different components, at least one of them outside the largest one."""
    # The smaller class of a pair still needs this many n-grams from the shared one on.
    early = rows.where(F.col("rest") + 1 >= _least_overlap(2 * F.col("n"), join.percent))
    smaller = F.struct("n_a", "node_a") < F.struct("n_b", "node_b")
    apart = (F.col("label_a") != F.col("label_b")) & smaller
    outside = matching(early.where("NOT main"), rows, join, apart)
    return outside.union(matching(early.where("main"), rows.where("NOT main"), join, apart))


def links(lists: DataFrame, join: Join) -> DataFrame | None:
    """Components (node, label) of the classes; None without any link."""
    entries = prefixes(lists, join)
    tested: list[DataFrame] = []
    found: list[DataFrame] = []
    labels = lists.select("node", F.col("node").alias("label")).limit(0)

    def test(matches: DataFrame) -> int:
        nonlocal labels
        tested.append(stored(untested(matches, tested), "join-pairs"))
        linked = verified(tested[-1], lists, join)
        fresh = linked.count()
        if fresh:
            found.append(linked)
            labels = components(reduce(DataFrame.union, found))
        return fresh

    other, apart = F.col("node_a") != F.col("node_b"), F.col("label_a") != F.col("label_b")
    fresh = test(matching(entries, _leaders(entries, F.col("node")).where("k > 1"), join, other))
    for turn in range(LONGER * join.rounds + 1):
        rows = several_components(entries, labels)
        if rows.isEmpty():
            break
        outside = rows.where("NOT main")
        late = turn >= join.rounds and FEW * fresh <= outside.select("node").distinct().count()
        if late or turn == LONGER * join.rounds:
            test(across(rows, join))
            break
        leaders = _leaders(rows, F.xxhash64("node", "gram", F.lit(turn)), "main")
        fresh = test(matching(outside, leaders, join, apart))
    return labels if found else None


def joined(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id."""
    rows, hot = classed(docs, join)
    wanted = wanted_classes(rows, docs, join)
    labels = links(class_lists(postings(docs, wanted, hot, join), wanted, join), join)
    key = ["s1", "s2"]
    smallest = rows.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("component_id"))
    if labels is not None:
        label = wanted.select("node", *key).join(labels, "node").select(*key, "label")
        linked = smallest.join(label, key)
        least = linked.groupBy("label").agg(F.min("component_id").alias("least"))
        least = linked.join(least, "label").select(*key, "least")
        smallest = smallest.join(least, key, "left").select(
            *key, F.coalesce("least", "component_id").alias("component_id")
        )
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(smallest, key, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")
    )
