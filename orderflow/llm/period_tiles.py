"""Periodic runs of words, found in tiles of every scale.

A run is a maximal stretch of words with smallest period q, at least ``repeats``
periods and ``least`` words long. Word x matches for q if it equals word x + q; a run
is a stretch of at least 3 q matches that no neighbour extends.

1. Octave k holds the periods from P = 2**k to 2 P - 1. Every 2 P words there is a
   boundary c. A run of the octave has so many matches that the B = P + 1 words (more in
   the first octaves) from some boundary on lie in it and come again q words later. The
   tile of c is the words from c - 2 P to c + 4 P + B, and a document is exploded into
   the tiles whose block comes again in the octave's reach; other tiles hold nothing.
2. Tiles are solved one by one. The Z-function of the words from the boundary on tells
   for every period how far the matches go right, that of the words before it, read
   backwards, how far they go left. A period is kept if its word is no power of a
   shorter one, and a fragment of matches goes on unless it ends in the tile, too short.
3. Fragments are shuffled by document and period and stitched where they overlap.
   Those of neighbouring boundaries in a run always do, and the first and the last
   reach its ends.

Tiles are rows, written once; only tiles with a repetition exist, so a document of any
length is spread over as many rows and its fragments over its periods. A document's
words move on to its runs only if it has a tile.

Defined cases: a null or empty text has no words and no runs; rows of equal id and text
get equal results, rows of equal id and other text their own; an empty table gives no
rows. Words are compared by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.batches import offsets, slices
from orderflow.llm.text import bound, stored, whole, words

#: Bytes of a word's code. The first has its high bit set, so that a search for codes
#: in codes finds whole ones only.
WIDTH = 4
#: Tiles leave a task in batches of about this many bytes.
BATCH_BYTES = 8_000_000

RUNS = "array<struct<start:bigint,period:bigint,length:bigint>>"


@dataclass(frozen=True)
class RunRules:
    """least: words of a run; repeats: periods of a run, 4 or more."""

    least: int = 6
    repeats: int = 4

    def __post_init__(self):
        if self.repeats < 4:
            raise ValueError("tiles meet runs of four periods or more only")

    def matches(self, q: int) -> int:
        """Fewest matches of a run."""
        return max((self.repeats - 1) * q, self.least - q)

    def block(self, p: int) -> int:
        """Words from the first boundary in a run's matches on that match too."""
        # ``matches`` falls up to about this period and rises after it.
        turn = self.least // self.repeats
        periods = {min(max(q, p), 2 * p - 1) for q in (p, turn, turn + 1, 2 * p - 1)}
        return min(map(self.matches, periods)) - (2 * p - 1)


def coded(numbers: np.ndarray) -> bytes:
    """Word numbers as codes."""
    parts = np.empty((len(numbers), WIDTH), np.uint8)
    for k in range(WIDTH):
        parts[:, k] = (numbers >> (7 * (WIDTH - 1 - k))) & 0x7F
    parts[:, 0] |= 0x80
    return parts.tobytes()


def promising(codes: bytes, n: int, rules: RunRules) -> Iterator[tuple[int, int]]:
    """(octave, boundary) of the tiles whose block comes again in reach."""
    octave, p = 0, 1
    while rules.repeats * p <= n:
        width = rules.block(p)
        for c in range(0, n - width - p + 1, 2 * p):
            block = codes[WIDTH * c : WIDTH * (c + width)]
            if codes.find(block, WIDTH * (c + p), WIDTH * (c + 2 * p - 1 + width)) >= 0:
                yield octave, c
        octave, p = octave + 1, 2 * p


def z_values(seq: list, upto: int) -> list[int]:
    """For each i below ``upto``: the length of the longest common prefix of seq and
    seq[i:]."""
    n = len(seq)
    z = [n] + [0] * (upto - 1)
    left = right = 0
    for i in range(1, upto):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and seq[k] == seq[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def solved(tile: list, pivot: int, p: int, width: int) -> list[tuple[int, int, int]]:
    """(period, first match, end of matches) around the pivot of a tile, for periods
    of the octave whose matches cover the block of this width at the pivot."""
    periods = min(2 * p, len(tile) - pivot)
    ahead = z_values(tile[pivot:], periods)
    found = []
    for q in range(p, periods):
        if ahead[q] >= width and not any(ahead[d] >= q - d for d in _divisors(q)):
            found.append(q)
    if not found or not pivot:
        return [(q, pivot, pivot + ahead[q]) for q in found]
    whole_tile = tile[: pivot + periods][::-1]
    back = z_values(tile[:pivot][::-1] + [-1] + whole_tile, pivot + 1 + periods)
    return [(q, pivot - back[pivot + 1 + periods - q], pivot + ahead[q]) for q in found]


def _divisors(q: int) -> list[int]:
    """Proper divisors that are q over a prime; a power has a root among their words."""
    found, rest, d = [], q, 2
    while d * d <= rest:
        if rest % d == 0:
            found.append(q // d)
            while rest % d == 0:
                rest //= d
        d += 1
    if rest > 1:
        found.append(q // rest)
    return found


def _row_key() -> dict[str, Column]:
    return {
        "id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        "mark": F.xxhash64(whole("text")),
    }


def exploded(docs: DataFrame, rules: RunRules) -> DataFrame:
    """Rows of documents (words joined by one space, number of words and of tiles) and
    of their tiles (octave, at, pivot, codes, ends: whether the document ends there)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    row = f"doc_id {kind}, id string, mark long"
    tile = "octave int, at long, pivot long, ends boolean, codes binary"
    names = ["octave", "at", "pivot", "ends", "codes"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                spoken = [t.encode().split() if t else [] for t in texts]
                ends = offsets(np.fromiter(map(len, spoken), np.int64, len(spoken)))
                flat = [word for one in spoken for word in one]
                numbers = pd.factorize(np.array(flat, dtype=object))[0] if flat else np.empty(0, np.int64)
                codes = coded(numbers)
                keys = part.select(["doc_id", "id", "mark"])
                counts, held, weight = np.zeros(len(texts), np.int64), [], 0
                for i in range(len(texts)):
                    n = int(ends[i + 1] - ends[i])
                    own = codes[WIDTH * int(ends[i]) : WIDTH * int(ends[i + 1])]
                    for octave, c in promising(own, n, rules):
                        p = 1 << octave
                        low, high = max(0, c - 2 * p), min(n, c + 4 * p + rules.block(p))
                        cells = (octave, low, c - low, high == n, own[WIDTH * low : WIDTH * high])
                        held.append((i, *cells))
                        counts[i] += 1
                        weight += len(cells[-1])
                        if weight > BATCH_BYTES:
                            yield tiles(keys, held)
                            held, weight = [], 0
                if held:
                    yield tiles(keys, held)
                joined = [b" ".join(w).decode() for w in spoken]
                cells = [pa.array(joined, pa.string()), pa.array(np.diff(ends)), pa.array(counts)]
                blank = [pa.nulls(len(texts), t) for t in _TILE]
                yield pa.RecordBatch.from_arrays(
                    [*keys.columns, *cells, *blank],
                    [*keys.schema.names, "words", "n_words", "n_tiles", *names],
                )

    def tiles(keys: pa.RecordBatch, held: list) -> pa.RecordBatch:
        owner, *cells = zip(*held, strict=True)
        taken = keys.take(pa.array(owner))
        blank = [pa.nulls(len(held), t) for t in (pa.string(), pa.int64(), pa.int64())]
        columns = [pa.array(c, t) for c, t in zip(cells, _TILE, strict=True)]
        return pa.RecordBatch.from_arrays(
            [*taken.columns, *blank, *columns],
            [*keys.schema.names, "words", "n_words", "n_tiles", *names],
        )

    schema = f"{row}, words string, n_words long, n_tiles long, {tile}"
    rows = docs.select("doc_id", "text").withColumns(_row_key())
    return stored(rows.mapInArrow(cut, schema), "period-tiles", compression="zstd")


_TILE = (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())


def fragments(tiles: DataFrame, rules: RunRules) -> DataFrame:
    """Per tile and period: id, mark, period, start and stop of the matches."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            cells = [batch.column(c).to_pylist() for c in ("octave", "at", "pivot", "ends", "codes")]
            for i, (octave, at, pivot, ends, codes) in enumerate(zip(*cells, strict=True)):
                tile = np.frombuffer(codes, f"<u{WIDTH}").tolist()
                for q, start, stop in solved(tile, pivot, 1 << octave, rules.block(1 << octave)):
                    closed = (start > 0 or at == 0) and (stop + q < len(tile) or ends)
                    if closed and stop - start < rules.matches(q):
                        continue
                    rows.append((i, q, at + start, at + stop))
            owner, *numbers = zip(*rows, strict=True) if rows else [[]] * 4
            keys = batch.select(["id", "mark"]).take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*keys.columns, *(pa.array(c, pa.int64()) for c in numbers)],
                ["id", "mark", "period", "start", "stop"],
            )

    schema = "id string, mark long, period long, start long, stop long"
    return tiles.select("id", "mark", "octave", "at", "pivot", "ends", "codes").mapInArrow(solve, schema)


def stitched(found: DataFrame, rules: RunRules) -> DataFrame:
    """The runs (id, mark, start, period, length) that the fragments make up."""
    key = ["id", "mark", "period"]
    order = Window.partitionBy(*key).orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("start") > before, F.lit(True)).cast("int")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        found.withColumn("fresh", fresh)
        .withColumn("stretch", F.sum("fresh").over(upto))
        .groupBy(*key, "stretch")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .withColumn("length", F.col("stop") - F.col("start") + F.col("period"))
        .where(F.col("length") >= F.greatest(F.lit(rules.least), rules.repeats * F.col("period")))
        .select("id", "mark", "start", "period", "length")
    )


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch, "words"):
            kept = []
            for text, runs in zip(texts, part.column("runs").to_pylist(), strict=True):
                spoken = text.split(" ")
                steps = np.zeros(len(spoken) + 1, np.int64)
                for run in runs:
                    steps[run["start"] + run["period"]] += 1
                    steps[run["start"] + run["length"]] -= 1
                stay = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
                kept.append(" ".join([spoken[i] for i in stay.tolist()]))
            columns = [part.column(c) for c in ("doc_id", "id", "mark", "n_words", "runs")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(kept, pa.string())],
                ["doc_id", "id", "mark", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, rules: RunRules = RunRules()) -> DataFrame:
    """Per row: doc_id, id, mark, n_words, runs by start and period, and ``collapsed``,
    the words that no run repeats: those after its first period go."""
    rows = exploded(docs, rules)
    tiles = rows.where("octave IS NOT NULL")
    runs = stitched(fragments(tiles, rules), rules)
    listed = runs.groupBy("id", "mark").agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs")
    )
    documents = rows.where("octave IS NULL").select(
        "doc_id", "id", "mark", "n_words", "words", "n_tiles"
    )
    none = F.array().cast(RUNS)
    kept = ["doc_id", "id", "mark", "n_words", "runs", "collapsed"]
    plain = documents.where("n_tiles = 0").withColumn("runs", none)
    plain = plain.withColumnRenamed("words", "collapsed").select(kept)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, id string, mark long, n_words long, runs {RUNS}, collapsed string"
    known = (
        documents.where("n_tiles > 0")
        .join(listed, ["id", "mark"], "left")
        .withColumn("runs", F.coalesce("runs", none))
        .mapInArrow(_collapse, schema)
    )
    return plain.union(known)


def strongest(runs: Column) -> Column:
    """The run with the most periods; of equal ones the first. Null without any."""
    more = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    return F.when(
        F.size(runs) > 0,
        F.aggregate(runs, F.get(runs, 0), lambda a, b: F.when(more(a, b), b).otherwise(a)),
    )


def listed(runs: Column) -> Column:
    """start,length,period of each run, a line each."""
    lines = F.transform(
        runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return F.array_join(lines, "")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """The documents (doc_id, text), of which those whose crc32(doc_id) ends in 0 repeat
    a stretch of their words to the end; a null doc_id stays as it is."""
    code = F.crc32(F.col("doc_id").cast("string"))
    part = F.expr("crc32(CAST(doc_id AS STRING)) div 10")

    def repeated(spoken: Column) -> Column:
        n = F.size(spoken).cast("long")
        start = part % n
        period = 1 + F.floor((n - start) / (3 + part % 8))
        return F.concat_ws(
            " ",
            F.transform(
                spoken,
                lambda word, i: F.when(i < start, word).otherwise(
                    F.get(spoken, (start + (i - start) % period).cast("int"))
                ),
            ),
        )

    text = whole("text")
    chosen = (code % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]")
    return docs.select(
        "doc_id", F.when(chosen, bound(words(text), repeated)).otherwise(F.col("text")).alias("text")
    )
