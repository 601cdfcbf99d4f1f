"""Encoding, decoding and token counts against other implementations."""

from __future__ import annotations

import random
import tracemalloc

import corpus_pipeline
import numpy as np
import sentencepiece
from cases import TEXTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderflow.llm import piece_counts, piece_dropout
from orderflow.llm.catalog import PIECE_MODEL, WORD_VOCABULARY
from orderflow.llm.piece_dropout import Dropout

MODEL = piece_dropout.load(PIECE_MODEL)
PLAIN = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
ALPHABET = st.sampled_from(list("thean dor\n.é日🙂0▁"))


def encode(texts, drop, keys=None):
    keys = np.arange(len(texts)) if keys is None else np.asarray(keys)
    return piece_dropout.encode_texts(MODEL, texts, keys, drop)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=200), max_size=5))
def test_no_dropout_equals_the_library_and_all_rates_are_lossless(texts):
    plain = [t.replace("▁", "") for t in texts]
    assert encode(plain, Dropout(rate=0.0)).to_pylist() == [PLAIN.encode(t) for t in plain]
    for rate in (0.0, 0.3, 1.0):
        assert piece_dropout.decode_ids(MODEL, encode(texts, Dropout(rate=rate))).to_pylist() == texts


def test_rounds_equal_the_heap(monkeypatch):
    draw = random.Random(5)
    chunks = [" " * draw.randint(1, 3) + "".join(draw.choices("theandoréin日s", k=draw.randint(0, 40))) for _ in range(800)]
    draws = np.array([draw.randrange(8) for _ in chunks])
    ids, n = piece_dropout.segment(MODEL, chunks, draws, Dropout(rate=0.4))
    monkeypatch.setattr(piece_dropout, "LONG", 0)
    others, m = piece_dropout.segment(MODEL, chunks, draws, Dropout(rate=0.4))
    assert ids.tolist() == others.tolist() and n.tolist() == m.tolist()


def test_seeds_and_documents_vary():
    texts = [" ".join(f"the quick onions interesting another{i} entirely" for i in range(30))] * 3
    one = encode(texts, Dropout(), [1, 2, 1]).to_pylist()
    assert one[0] == one[2] and one[0] != one[1]
    assert encode(texts, Dropout(seed="other"), [1, 2, 1]).to_pylist() != one
    share = [len(encode(texts, Dropout(rate=r)).values) for r in (0.0, 0.5, 1.0)]
    assert share == sorted(share) and share[0] < share[2]


def test_every_occurrence_draws_for_itself():
    texts = ["interesting"] * 3000
    rows = encode(texts, Dropout()).to_pylist()
    alone = [encode([t], Dropout(), [k]).to_pylist()[0] for k, t in enumerate(texts[:300])]
    assert rows[:300] == alone
    assert len(set(map(tuple, rows))) > 8
    for k, row in enumerate(rows[:300]):
        draw = piece_dropout._mixed(np.array([k], np.uint64) ^ np.uint64(Dropout().key()))
        ids, _ = piece_dropout.segment(MODEL, [" interesting"], draw, Dropout())
        assert ids.tolist() == row


def test_copies_are_segmented_apart(spark):
    text = " ".join(f"the quick onions interesting another{i} entirely" for i in range(30))
    docs = documents(spark, [(1, text), (1, text), (2, text)])
    docs = docs.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id").orderBy("source")))
    ids = [tuple(r.ids) for r in corpus_pipeline.encode(spark, docs, "").collect()]
    assert len(set(ids)) == 3
    again = [tuple(r.ids) for r in corpus_pipeline.encode(spark, docs.repartition(3), "").collect()]
    assert sorted(again) == sorted(ids)


def test_awkward_documents(spark):
    rows = piece_dropout.round_trip(documents(spark, extra=True), PIECE_MODEL).collect()
    assert len(rows) == len(TEXTS) and all(r.lossless for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].ids is None and by_id[2].ids == []
    assert piece_dropout.round_trip(documents(spark, []), PIECE_MODEL).count() == 0
    kept = piece_dropout.encoded(documents(spark, extra=True), PIECE_MODEL)
    assert set(kept.columns) == set(documents(spark, extra=True).columns)


def greedy(vocabulary, pieces, word):
    """Longest match first; a word's end counts nothing by itself."""
    end = piece_counts.END
    symbols, at, count = (*word, end), 0, 0
    while at < len(symbols):
        for stop in range(min(len(symbols), at + 130), at, -1):
            if symbols[at:stop] in pieces:
                break
        else:
            return 1
        count += symbols[at:stop] != (end,)
        at = stop
    return count


def test_counts_equal_greedy_matching(spark):
    vocabulary = piece_counts.load(WORD_VOCABULARY)
    pieces = {*vocabulary.pieces, (piece_counts.END,)}
    rows = piece_counts.token_counts(documents(spark), WORD_VOCABULARY).collect()
    expected = []
    for i, text in TEXTS:
        found = [w.encode() for w in vocabulary.split(text)] if text else []
        counts = {w: greedy(vocabulary, pieces, w) for w in set(found)}
        expected.append((i, len(found), sum(counts[w] for w in found)))
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, rows), key=key) == sorted(expected, key=key)
    assert piece_counts.token_counts(documents(spark, []), WORD_VOCABULARY).count() == 0


@settings(max_examples=200, deadline=None)
@given(
    st.sets(st.lists(st.integers(1, 3), min_size=1, max_size=5).map(tuple), min_size=1, max_size=8),
    st.lists(st.lists(st.integers(1, 3), max_size=12).map(bytes), min_size=1, max_size=6),
)
def test_any_vocabulary(pieces, words):
    automaton = piece_counts.Automaton(sorted(pieces))
    known = {*pieces, (piece_counts.END,)}
    assert automaton.lengths(words).tolist() == [greedy(None, known, w) for w in words]


def plain_agenda(chunk, key, drop):
    """Pieces of one chunk: at each step the best pair that was not skipped is merged;
    a pair is judged once for the symbols it is made of."""
    symbols = [(int(MODEL.chars[ord(c)]) if ord(c) < len(MODEL.chars) else -1, i) for i, c in enumerate(chunk)]
    judged = {}

    def skipped(left, right):
        pair = (left[1], left[0], right[0])
        if pair not in judged:
            hashed = piece_dropout._place_hash(
                drop.key(), np.array([key], np.uint64), np.array([left[1]]), np.array([left[0]]), np.array([right[0]])
            )
            judged[pair] = bool(hashed[0] < np.uint64(drop.limit()))
        return judged[pair]

    while True:
        best = None
        for k, (left, right) in enumerate(zip(symbols, symbols[1:], strict=False)):
            if left[0] < 0 or right[0] < 0:
                continue
            made = int(MODEL.join(np.array([left[0]]), np.array([right[0]]))[0])
            if made >= 0 and not skipped(left, right):
                best = min(best or (1 << 60, 0, 0), (int(MODEL.rank[made]), k, made))
        if best is None:
            return [s for s, _ in symbols]
        _, k, made = best
        symbols[k : k + 2] = [(made, symbols[k][1])]


def test_dropout_on_real_texts_against_a_plain_agenda(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    texts = [(r.text or "")[:400] for r in rows[:40]]
    drop = Dropout(rate=0.2)
    keys = np.arange(len(texts)) * 977 + 5
    found = encode(texts, drop, keys).to_pylist()
    changed = 0
    for text, key, ids in zip(texts, keys.tolist(), found, strict=True):
        expected = []
        for place, chunk in enumerate(piece_dropout.CHUNK.findall(" " + text) if text else []):
            start = np.uint64(key) ^ np.uint64(drop.key())
            step = np.uint64(place * int(piece_dropout.MIX[0]) % (1 << 64))
            draw = piece_dropout._mixed(np.array([(int(start) + int(step)) % (1 << 64)], np.uint64))[0]
            for symbol, c in zip(*_with_letters(plain_agenda(chunk, draw, drop), chunk), strict=True):
                expected += [symbol] if 0 <= symbol < MODEL.size else list(MODEL.bytes_for(ord(c)))
        assert ids == expected
        changed += ids != PLAIN.encode(text.replace("▁", ""))
    assert changed > 20


def _with_letters(symbols, chunk):
    """The symbols, and for those without a piece the letter that they stand for."""
    letters, at = [], 0
    for symbol in symbols:
        known = 0 <= symbol < MODEL.size
        letters.append(chunk[at])
        at += len(MODEL.raw[symbol].decode().replace("▁", " ")) if known else 1
    return symbols, letters


def test_memory_does_not_follow_the_length_of_a_text():
    draw = random.Random(5)
    text = " ".join("".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 9))) for _ in range(75_000))
    tracemalloc.start()
    encode([text], Dropout())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 69 MB when a block held all of the text's 488,011 characters.
    assert peak < 40e6
