"""Token counts by a linear longest-match automaton.

Greedy word-piece tokenisation takes the longest vocabulary piece at each point of
a word. A trie over the pieces gets a failure link per node: where the text leaves
the trie, the link tells the node to go on from and a precomputed number tells how
many pieces that step completes. Each byte is read once and no piece is built.

Words, normal form and pieces come from a tokenizer file of the word-end kind; a
piece marked as a word's end matches at a word's end only. Bytes that are no piece
make their word one unknown token. Equal words of a slice are counted once.

Defined cases: a null or empty text has no words and no tokens; repeated rows get
equal counts. An empty table gives no rows.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from orderflow.llm.batches import offsets, slices, spread

END = 256
WIDTH = 257


def byte_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabularies write bytes with."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Automaton:
    """Trie with failure links and popped-token counts over sequences of symbols."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        """A bare END counts nothing: it closes words whose last piece has no end mark."""
        edges: dict[int, int] = {}
        parent, symbol, depth, weight = [0], [0], [0], [-1]
        for piece in [*pieces, (END,)]:
            node = 0
            for s in piece:
                child = edges.setdefault(node * WIDTH + s, len(parent))
                if child == len(parent):
                    parent.append(node)
                    symbol.append(s)
                    depth.append(depth[node] + 1)
                    weight.append(-1)
                node = child
            weight[node] = max(weight[node], 0 if piece == (END,) else 1)
        fail, pops = [-1] * len(parent), [0] * len(parent)
        for node in sorted(range(1, len(parent)), key=depth.__getitem__):
            if weight[node] >= 0:
                fail[node], pops[node] = 0, weight[node]
                continue
            at, popped = fail[parent[node]], pops[parent[node]]
            while at >= 0 and at * WIDTH + symbol[node] not in edges:
                popped += pops[at]
                at = fail[at]
            if at >= 0:
                fail[node], pops[node] = edges[at * WIDTH + symbol[node]], popped
        self.keys = np.array(sorted(edges), np.int64)
        self.targets = np.array([edges[k] for k in self.keys.tolist()], np.int64)
        self.fail, self.pops = np.array(fail), np.array(pops)

    def lengths(self, words: list[bytes]) -> np.ndarray:
        """Number of pieces of each word; 1 where some byte is no piece."""
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        order = np.argsort(-size, kind="stable")
        size = size[order]
        at = offsets(size)[:-1]
        symbols = np.full(int(size.sum()), END, np.int64)
        symbols[spread(at, size - 1)] = np.frombuffer(b"".join(words[i] for i in order), np.uint8)
        state, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        lost = np.zeros(len(words), bool)
        active = len(words)
        for step in range(int(size[0]) if len(size) else 0):
            active = int(np.searchsorted(-size, -step, side="left")) if active else 0
            pending = np.flatnonzero(~lost[:active])
            while len(pending):
                wanted = state[pending] * WIDTH + symbols[at[pending] + step]
                found = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
                hit = self.keys[found] == wanted
                state[pending[hit]] = self.targets[found[hit]]
                pending = self._fall(pending[~hit], state, count, lost)
        pending = np.flatnonzero((state != 0) & ~lost)
        while len(pending):
            pending = self._fall(pending, state, count, lost)
            pending = pending[state[pending] != 0]
        result = np.empty(len(words), np.int64)
        result[order] = np.where(lost, 1, count)
        return result

    def _fall(self, words: np.ndarray, state, count, lost) -> np.ndarray:
        """Follows one failure link; words without one are lost."""
        dead = self.fail[state[words]] < 0
        lost[words[dead]] = True
        words = words[~dead]
        count[words] += self.pops[state[words]]
        state[words] = self.fail[state[words]]
        return words


class Vocabulary:
    """Automaton, word pattern and normal form of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, suffix = byte_letters(), spec["model"]["end_of_word_suffix"]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        pattern = next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")
        self.words = regex.compile(pattern).findall
        self.pieces = []
        for piece in spec["model"]["vocab"]:
            end = piece.endswith(suffix) and piece != suffix
            body = piece.removesuffix(suffix) if end else piece
            self.pieces.append((*(letters[c] for c in body), *([END] if end else [])))
        self.automaton = Automaton(self.pieces)

    def split(self, text: str) -> list[str]:
        return self.words(unicodedata.normalize("NFC", text).lower())

    def counts(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Words and tokens of each text."""
        found = [self.split(t) if t else [] for t in texts]
        n_words = np.fromiter(map(len, found), np.int64, len(found))
        flat = [word for words in found for word in words]
        if not flat:
            return n_words, n_words
        codes, known = pd.factorize(np.array(flat, dtype=object))
        pieces = self.automaton.lengths([w.encode("utf-8", "replace") for w in known])
        ends = offsets(pieces[codes])[offsets(n_words)]
        return n_words, np.diff(ends)


@lru_cache(4)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_words and n_tokens of every text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(vocabulary_path)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                n_words, n_tokens = vocabulary.counts(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_words), pa.array(n_tokens)],
                    ["doc_id", "n_words", "n_tokens"],
                )

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_words long, n_tokens long")
