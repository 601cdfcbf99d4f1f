"""SentencePiece encoding with seeded merge dropout, and decoding.

A merge-type model joins the adjacent pair whose joined piece scores best, the
leftmost of equals, until no pair is a piece. With dropout a candidate merge is
skipped when a keyed hash of its document, its copy, its chunk's position, its place
and its two sides falls below the rate. The hash depends on nothing else, so a
candidate is skipped every time it comes up and the segmentation is a function of
seed, document, copy and text.

No piece of such a model has a space after another character, so runs of spaces
with the word behind them ("chunks") are encoded one by one, each occurrence with a
draw of its own. Chunks that come twice or more in a slice are encoded once without
dropout; an occurrence that skips none of the candidates which come up there has
these pieces, and only the others go through the agenda by themselves. Chunks up to ``LONG`` characters go
through it together, one merge per chunk and round; longer ones have a heap each.

Characters that are no piece, and U+2581, which stands for the space inside the
model, become byte pieces, so decoding gives back every text exactly.

Defined cases: null encodes to null and decodes to null, the empty text to no ids;
repeated rows of equal id, and copy if given, get equal ids. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.batches import offsets, slices, spread

SPACE = "▁"
LONG = 64
CHUNK = re.compile(" +[^ ]*")
MASK = (1 << 64) - 1
#: Bytes of text worked on at a time: its chunks, as strings and as arrays, take many times that.
SLICE_BYTES = 1_000_000
#: Odd multipliers of a 64-bit mixing function.
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


@dataclass(frozen=True)
class Dropout:
    """rate: share of candidate merges skipped; 0 gives the model's own pieces."""

    rate: float = 0.1
    seed: str = "pieces"

    def key(self) -> int:
        return int.from_bytes(hashlib.blake2b(self.seed.encode(), digest_size=8).digest(), "little")

    def limit(self) -> int:
        return int(self.rate * (1 << 32))


def _mixed(value):
    """64-bit mix of an int or an array of uint64; the upper 32 bits are uniform."""
    if isinstance(value, int):
        value &= MASK
        value = (value ^ (value >> 30)) * MIX[1] & MASK
        value = (value ^ (value >> 27)) * MIX[2] & MASK
        return value ^ (value >> 31)
    value = (value ^ (value >> np.uint64(30))) * np.uint64(MIX[1])
    value = (value ^ (value >> np.uint64(27))) * np.uint64(MIX[2])
    return value ^ (value >> np.uint64(31))


class Model:
    """Pieces, scores and merges of a merge-type model with byte pieces."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.vocab_size()
        pieces = [model.id_to_piece(i) for i in range(self.size)]
        plain = [
            i
            for i in range(self.size)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        if any(SPACE in pieces[i].lstrip(SPACE) for i in plain):
            raise ValueError("the model has pieces with a space after another character")
        bytes_of = [i for i in range(self.size) if model.is_byte(i)]
        if len(bytes_of) != 256:
            raise ValueError("the model has no byte pieces")
        self.byte_ids = np.zeros(256, np.int32)
        self.raw: list[bytes] = [b""] * self.size
        for i in plain:
            self.raw[i] = pieces[i].replace(SPACE, " ").encode()
        for i in bytes_of:
            value = int(pieces[i][3:5], 16)
            self.byte_ids[value] = i
            self.raw[i] = bytes([value])
        ids = {pieces[i]: i for i in plain}
        # Characters inside pieces that are no piece of their own still take part in merges.
        for char in sorted({c for i in plain for c in pieces[i]} - ids.keys()):
            ids[char] = self.size + len(ids)
        self.base = max(ids.values()) + 1
        self.chars = np.full(0x110000, -1, np.int64)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.chars[ord(piece)] = i
        self.chars[ord(" ")] = self.chars[ord(SPACE)]
        self.chars[ord(SPACE)] = -1
        merges: dict[int, int] = {}
        for i in plain:
            piece = pieces[i]
            for at in range(1, len(piece)):
                left, right = ids.get(piece[:at]), ids.get(piece[at:])
                if left is not None and right is not None:
                    merges[left * self.base + right] = i
        self.merges = merges
        self.bits = max(4, (4 * len(merges)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.joined = np.full(1 << self.bits, -1, np.int64)
        for key, joined in merges.items():
            at = (key * MIX[0] & MASK) >> (64 - self.bits)
            while self.slots[at] >= 0:
                at = (at + 1) % len(self.slots)
            self.slots[at], self.joined[at] = key, joined
        scores = np.array([model.get_score(i) for i in range(self.size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.pieces = pa.array(self.raw, pa.binary())

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pieces that pairs of symbols make, -1 where they make none."""
        keys = left * self.base + right
        at = ((keys.view(np.uint64) * np.uint64(MIX[0])) >> np.uint64(64 - self.bits)).astype(np.int64)
        found = np.where(self.slots[at] == keys, self.joined[at], -1)
        open_ = np.flatnonzero((self.slots[at] != keys) & (self.slots[at] >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.slots)
            held = self.slots[at[open_]]
            hit = held == keys[open_]
            found[open_[hit]] = self.joined[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return found

    def bytes_for(self, code: int) -> np.ndarray:
        return self.byte_ids[list(chr(code).encode("utf-8", "surrogatepass"))]


@lru_cache(4)
def load(path: str) -> Model:
    return Model(path)


def _place_hash(key: int, draw, start, left, right):
    """Keyed hash of a candidate merge, 32 bits; for ints or for arrays."""
    if isinstance(start, int):
        value = _mixed(key + MIX[0] * (draw + 1) + (start << 40))
        return _mixed(value ^ (left << 32) ^ right) >> 32
    value = np.uint64(key) + np.uint64(MIX[0]) * (draw.astype(np.uint64) + np.uint64(1))
    value = _mixed(value + (start.astype(np.uint64) << np.uint64(40)))
    sides = (left.astype(np.uint64) << np.uint64(32)) ^ right.astype(np.uint64)
    return _mixed(value ^ sides) >> np.uint64(32)


def agenda(
    model: Model, codes: list[int], draw: int, drop: Dropout, seen: list | None = None
) -> list[tuple[int, int]]:
    """(symbol, start) of one chunk: a heap of candidate merges, best score first.
    ``seen`` takes the candidates, (start, left, right)."""
    key, limit = drop.key(), drop.limit()
    symbols = model.chars[codes].tolist()
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(left: int) -> None:
        right = after[left] if left >= 0 else n
        if right >= n or symbols[left] < 0 or symbols[right] < 0:
            return
        joined = model.merges.get(symbols[left] * model.base + symbols[right])
        if joined is not None:
            heapq.heappush(heap, (int(model.rank[joined]), left, symbols[left], symbols[right]))
            if seen is not None:
                seen.append((left, symbols[left], symbols[right]))

    for i in range(n - 1):
        offer(i)
    gone = [False] * n
    while heap:
        _, left, a, b = heapq.heappop(heap)
        right = after[left]
        if gone[left] or right >= n or symbols[left] != a or symbols[right] != b:
            continue
        if _place_hash(key, draw, left, a, b) < limit:
            continue
        symbols[left] = model.merges[a * model.base + b]
        gone[right] = True
        after[left] = after[right]
        if after[left] < n:
            before[after[left]] = left
        offer(before[left])
        offer(left)
    return [(s, i) for i, s in enumerate(symbols) if not gone[i]]


def _rounds(model: Model, symbols, owner, start, draw, drop: Dropout, seen: list | None = None):
    """The agendas of many short chunks side by side, one merge each per round.
    ``seen`` takes the candidates, arrays (owner, start, left, right).

    Every symbol knows the piece it makes with its right neighbour, -1 if none or
    skipped; only the neighbours of a merge are looked up again.
    """
    key, limit = drop.key(), np.uint64(drop.limit())

    def offers(at: np.ndarray) -> np.ndarray:
        left, right = symbols[at], symbols[at + 1]
        made = np.full(len(at), -1)
        may = np.flatnonzero((owner[at] == owner[at + 1]) & (left >= 0) & (right >= 0))
        made[may] = model.join(left[may], right[may])
        may = may[made[may] >= 0]
        if seen is not None:
            seen.append((owner[at[may]], start[at[may]], left[may], right[may]))
        if limit and len(may):
            hashed = _place_hash(key, draw[owner[at[may]]], start[at[may]], left[may], right[may])
            made[may[hashed < limit]] = -1
        return made

    done = []
    made = np.append(offers(np.arange(len(symbols) - 1)), -1)
    while True:
        offered = np.flatnonzero(made >= 0)
        if not len(offered):
            done.append((owner, start, symbols))
            break
        of = owner[offered]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        # Best rank, then leftmost: positions grow within an owner.
        order = (model.rank[made[offered]] << 32) | offered
        best = np.minimum.reduceat(order, first) & 0xFFFFFFFF
        symbols[best] = made[best]
        busy = np.zeros(int(owner[-1]) + 1, bool)
        busy[of[first]] = True
        stay = busy[owner]
        if not stay.all():
            done.append((owner[~stay], start[~stay], symbols[~stay]))
        stay[best + 1] = False
        best = np.cumsum(stay)[best] - 1
        symbols, owner, start, made = symbols[stay], owner[stay], start[stay], made[stay]
        made[best] = -1
        near = np.concatenate([best, best[best > 0] - 1])
        near = near[near + 1 < len(symbols)]
        made[near] = offers(near)
    return tuple(map(np.concatenate, zip(*done, strict=True)))


def segment(
    model: Model, chunks: list[str], draws: np.ndarray, drop: Dropout, seen: list | None = None
):
    """Ids of all chunks in one array, and how many each chunk has; ``draws`` is a
    64-bit key of each. ``seen`` takes the candidates, arrays (owner, start, left, right)."""
    lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
    codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
    base = offsets(lengths)[:-1]
    short = lengths <= LONG
    at = spread(base[short], lengths[short])
    owner = np.repeat(np.flatnonzero(short), lengths[short])
    parts = []
    if len(at):
        parts.append(_rounds(model, model.chars[codes[at]], owner, at - base[owner], draws, drop, seen))
    for i in np.flatnonzero(~short).tolist():
        met: list | None = None if seen is None else []
        found = agenda(model, codes[base[i] : base[i] + lengths[i]].tolist(), int(draws[i]), drop, met)
        if met:
            seen.append((np.full(len(met), i), *np.array(met, np.int64).T))
        symbol, start = (np.array(x, np.int64) for x in zip(*found, strict=True))
        parts.append((np.full(len(symbol), i), start, symbol))
    owner, start, symbol = map(np.concatenate, zip(*parts, strict=True))
    order = np.lexsort((start, owner))
    owner, start, symbol = owner[order], start[order], symbol[order]
    strange = (symbol < 0) | (symbol >= model.size)
    if strange.any():
        counts = np.ones(len(symbol), np.int64)
        bytes_of = [model.bytes_for(int(c)) for c in codes[base[owner[strange]] + start[strange]]]
        counts[strange] = list(map(len, bytes_of))
        owner = np.repeat(owner, counts)
        symbol = np.repeat(symbol, counts)
        symbol[np.repeat(strange, counts)] = np.concatenate(bytes_of)
    return symbol.astype(np.int32), np.bincount(owner, minlength=len(chunks))


#: Candidates hashed, and characters encoded, at a time. Many arrays of that length stand side by side.
BLOCK = 1 << 16


def _skipping(key_of: np.ndarray, codes: np.ndarray, seen: list, kinds: int, drop: Dropout):
    """The occurrences that skip a candidate which comes up without dropout; ``codes``
    are their chunks, of which there are ``kinds``."""
    owner, start, left, right = map(np.concatenate, zip(*seen, strict=True))
    order = np.argsort(owner, kind="stable")
    start, left, right = start[order], left[order], right[order]
    counts = np.bincount(owner, minlength=kinds)
    base = offsets(counts)[:-1]
    key, limit = drop.key(), np.uint64(drop.limit())
    ends = np.cumsum(counts[codes])
    skips = np.zeros(len(codes), bool)
    first = 0
    while first < len(codes):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + BLOCK, side="right")))
        of = codes[first:last]
        at = spread(base[of], counts[of])
        who = np.repeat(np.arange(first, last), counts[of])
        hashed = _place_hash(key, key_of[who], start[at], left[at], right[at])
        skips[who[hashed < limit]] = True
        first = last
    return np.flatnonzero(skips)


def _dropped(model: Model, chunks: list[str], draws: np.ndarray, drop: Dropout):
    """``segment`` in parts, so that memory does not follow the number of occurrences."""
    ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
    parts, first = [], 0
    while first < len(chunks):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + BLOCK, side="right")))
        parts.append(segment(model, chunks[first:last], draws[first:last], drop))
        first = last
    return tuple(map(np.concatenate, zip(*parts, strict=True)))


def _drawn(model: Model, words, codes, known, draw, drop: Dropout):
    """Segmentations, as ``segment`` gives them, and the number of each occurrence's own."""
    often = np.bincount(codes) > 1
    shared = np.cumsum(often) - 1
    own, kind = ~often[codes], shared[codes]
    parts: list = []
    if often.any():
        seen: list = []
        common = known[often]
        parts.append(segment(model, common.tolist(), np.zeros(len(common)), Dropout(0.0), seen))
        again = np.flatnonzero(~own)
        if seen:
            own[again[_skipping(draw[again], kind[again], seen, len(common), drop)]] = True
    own = np.flatnonzero(own)
    if len(own):
        kind[own] = int(often.sum()) + np.arange(len(own))
        parts.append(_dropped(model, words[own].tolist(), draw[own], drop))
    return kind, *map(np.concatenate, zip(*parts, strict=True))


def encode_texts(model: Model, texts: list, keys: np.ndarray, drop: Dropout) -> pa.ListArray:
    """Ids of each text; ``keys`` are 64-bit hashes of the documents' ids and copies."""
    found = [CHUNK.findall(" " + t) if t else [] for t in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    flat = [chunk for chunks in found for chunk in chunks]
    ids, ends = np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    if flat:
        words = np.array(flat, dtype=object)
        codes, known = pd.factorize(words)
        if drop.limit():
            place = spread(np.zeros(len(counts), np.int64), counts).astype(np.uint64)
            doc = np.repeat(keys.astype(np.int64).view(np.uint64), counts)
            draw = _mixed((doc ^ np.uint64(drop.key())) + place * np.uint64(MIX[0]))
            kind, pieces, n = _drawn(model, words, codes, known, draw, drop)
        else:
            kind = codes
            pieces, n = segment(model, known.tolist(), np.zeros(len(known)), drop)
        ids = pieces[spread(offsets(n)[kind], n[kind])]
        ends = offsets(n[kind])[offsets(counts)]
    return pa.ListArray.from_arrays(
        pa.array(ends.astype(np.int32)), pa.array(ids), mask=pa.array([t is None for t in texts], pa.bool_())
    )


def decode_ids(model: Model, ids: pa.ListArray) -> pa.Array:
    """Texts of arrays of ids, without the space that encoding puts first."""
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    parts = pa.ListArray.from_arrays(ids.offsets, model.pieces.take(ids.values))
    joined = pc.binary_join(parts, b"").to_pylist()
    missing = ids.is_null().to_pylist()
    texts = [
        None if gone else raw.removeprefix(b" ").decode("utf-8", "replace")
        for raw, gone in zip(joined, missing, strict=True)
    ]
    return pa.array(texts, pa.string())


def encoded(
    docs: DataFrame,
    model_path: str,
    drop: Dropout = Dropout(),
    text: str = "text",
    key: str = "doc_id",
    into: str = "ids",
    copy: str | None = None,
) -> DataFrame:
    """The documents with an array of ids; other columns unchanged, one of that name
    replaced. ``copy`` names a column with the copy's number: rows of equal key and
    different number are segmented apart."""
    docs = docs.drop(into)
    names = docs.columns

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            for part, texts in slices(batch, text, SLICE_BYTES):
                keys = part.column("__key").to_numpy()
                columns = [part.column(n) for n in names]
                columns.append(encode_texts(model, texts, keys, drop))
                yield pa.RecordBatch.from_arrays(columns, [*names, into])

    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.ArrayType(T.IntegerType()))])
    keys = F.xxhash64(key) if copy is None else F.xxhash64(key, copy)
    return docs.withColumn("__key", keys).mapInArrow(encode, schema)


def decoded(
    frame: DataFrame, model_path: str, ids: str = "ids", into: str = "decoded"
) -> DataFrame:
    """The rows with the text of an array of ids; other columns unchanged, one of that
    name replaced."""
    frame = frame.drop(into)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            column = decode_ids(model, batch.column(ids).cast(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, into])

    schema = T.StructType([*frame.schema.fields, T.StructField(into, T.StringType())])
    return frame.mapInArrow(decode, schema)


def round_trip(docs: DataFrame, model_path: str, drop: Dropout = Dropout()) -> DataFrame:
    """doc_id, ids, their number, and whether decoding gives the text back. Encodes
    and decodes in one pass, so texts and ids cross to Python and back once."""

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            for part, texts in slices(batch, "text", SLICE_BYTES):
                ids = encode_texts(model, texts, part.column("__key").to_numpy(), drop)
                back = decode_ids(model, ids).to_pylist()
                same = pa.array([a == b for a, b in zip(texts, back, strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), same, ids], ["doc_id", "lossless", "ids"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("__key"))
    return rows.mapInArrow(both, f"doc_id {kind}, lossless boolean, ids array<int>").select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "lossless", "ids"
    )
