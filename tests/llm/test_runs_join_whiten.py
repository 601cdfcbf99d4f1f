"""Periodic runs, the n-gram join and whitening against plain versions."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from cases import TEXTS, documents, near_components, shingles, words
from pyspark.sql import functions as F
from test_dedup import order, variants

from orderflow.llm import bit_slices, period_tiles, rare_first


def plain_runs(spoken, least=6, repeats=4):
    """(start, period, length) of all runs, by comparing words at every distance."""
    n, smallest = len(spoken), {}
    for q in range(1, n // repeats + 1):
        x = 0
        while x < n - q:
            if spoken[x] != spoken[x + q]:
                x += 1
                continue
            start = x
            while x < n - q and spoken[x] == spoken[x + q]:
                x += 1
            if x - start + q >= max(least, repeats * q):
                smallest.setdefault((start, x - start + q), q)
    return sorted((s, q, length) for (s, length), q in smallest.items())


def collapsed(spoken, runs):
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(spoken) if i not in gone)


def repetitive(seed, count=150):
    draw, texts = random.Random(seed), []
    for i in range(count):
        n = draw.randrange(1, 200)
        spoken = [f"w{draw.randrange(draw.choice([1, 2, 3, 9]))}" for _ in range(n)]
        for _ in range(draw.randrange(4)):
            start, q = draw.randrange(n), draw.randrange(1, n // 4 + 2)
            for k in range(start + q, draw.randrange(start, n + 1)):
                spoken[k] = spoken[k - q]
        texts.append((i + 100, draw.choice([" ", "\n", " \t"]).join(spoken)))
    return texts


@pytest.mark.parametrize("least,repeats", [(6, 4), (20, 5)])
def test_runs(spark, least, repeats):
    texts = [(i, t) for i, t in TEXTS if len(t or "") < 100_000]
    texts += [(50, "a b " * 3 + "a b"), (50, "a a a a a"), (51, "word " * 3_000), *repetitive(least)]
    rules = period_tiles.RunRules(least, repeats)
    rows = period_tiles.periodic_runs(documents(spark, texts, extra=True), rules).collect()
    expected = []
    for i, t in texts:
        runs = plain_runs(words(t), least, repeats) if i != 51 else [(0, 1, 3_000)]
        expected.append((i, len(words(t)), runs, collapsed(words(t), runs)))
    found = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows]
    assert order(found) == order(expected)
    assert sum(len(x[2]) for x in found) > 15


def test_a_run_across_many_tiles_is_one(spark):
    spoken = [f"w{i % 37}" for i in range(5_000)]
    spoken = ["head", *spoken, "tail", *(f"x{i % 700}" for i in range(3_000))]
    rows = period_tiles.periodic_runs(documents(spark, [(1, " ".join(spoken))])).collect()
    assert [tuple(x) for x in rows[0].runs] == [(1, 37, 5_000), (5_002, 700, 3_000)]
    assert rows[0].collapsed == " ".join(spoken[:38] + ["tail"] + spoken[5_002:5_702])


def test_runs_of_no_documents_and_of_too_few_periods(spark):
    assert period_tiles.periodic_runs(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        period_tiles.RunRules(repeats=3)


def test_the_strongest_run_is_the_first_of_equal_ones(spark):
    runs = [(0, 2, 9), (20, 4, 18), (50, 2, 8)]
    frame = spark.createDataFrame([(runs,)], f"runs {period_tiles.RUNS}")
    row = frame.select(period_tiles.strongest(frame.runs), period_tiles.listed(frame.runs)).head()
    assert tuple(row[0]) == (0, 2, 9) and row[1] == "0,9,2\n20,18,4\n50,8,2\n"


def test_planted_periods(spark):
    texts = [(i, " ".join(f"w{k}" for k in range(i % 50))) for i in range(300)] + [(None, "a b c")]
    frame = period_tiles.with_planted_periods(documents(spark, texts))
    found = {r.doc_id: words(r.text) for r in frame.collect()}
    changed = 0
    for i, t in texts:
        spoken, n = words(t), len(words(t))
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            spoken = [spoken[k] if k < a else spoken[a + (k - a) % p] for k in range(n)]
            changed += spoken != words(t)
        assert found[i] == spoken
    assert changed > 5


@pytest.mark.parametrize("counters,crowd,rounds", [(65_536, 10_000, 3), (16, 5, 0)])
@pytest.mark.parametrize("length,percent", [(60, 85), (25, 80)])
def test_join(spark, counters, crowd, rounds, length, percent):
    texts = TEXTS + [(i + 100, t) for i, t in variants(percent, length=length)]
    noticed = 16 if crowd > 5 else 1
    join = rare_first.Join(4, percent, counters, crowd, noticed, 1.4 * (5 - noticed // 4), rounds)
    rows = rare_first.joined(documents(spark, texts, extra=True), join).collect()
    expected = near_components(texts, 4, percent)
    expected = [(i, len(shingles(t, 4)), c) for (i, t), c in zip(texts, expected, strict=True)]
    assert order(tuple(r) for r in rows) == order(expected)


def test_join_of_none_and_of_unlike_documents(spark):
    assert rare_first.joined(documents(spark, [])).count() == 0
    rows = rare_first.joined(documents(spark, [(1, "a b c d e f"), (2, "g h i j k l"), (3, None)]))
    assert order(tuple(r) for r in rows.collect()) == [(1, 2, 1), (2, 2, 2), (3, 0, 3)]


def test_a_passage_that_all_share_makes_no_pairs(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [(i, passage + " " + " ".join(f"u{i}x{k}" for k in range(20))) for i in range(80)]
    join = rare_first.Join(4, 85)
    docs = documents(spark, texts)
    rows, hot = rare_first.classed(docs, join)
    wanted = rare_first.wanted_classes(rows, docs, rare_first.Join(4, 85, width=0.0))
    posted = rare_first.postings(docs, wanted, hot, join)
    assert rare_first.class_lists(posted, wanted, join).count() == 0 and wanted.count() == 80
    # Their own n-grams among those of the smallest hashes tell already.
    assert rare_first.wanted_classes(rows, docs, rare_first.Join(4, 85, width=7.0)).count() == 0


def test_counters_find_every_frequent_value():
    draw = np.random.default_rng(2)
    values = np.concatenate([np.repeat(np.uint64(7), 900), draw.integers(10, 5_000, 9_000, np.uint64)])
    draw.shuffle(values)
    frequent = rare_first.Frequent(50)
    for part in np.array_split(values, 13):
        frequent.add(part)
    found = dict(zip(*(x.tolist() for x in frequent.largest(16)), strict=True))
    assert 900 - len(values) / 51 <= found[7] <= 900 and len(frequent.values) <= 50


def vectors(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<float>{extra}")


def plain_whitening(rows, most=4):
    kept = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows]
    fit = np.unique([v for _, v in kept], axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    e, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    e, axes = e[::-1][:most], axes[:, ::-1][:, :most]
    deviation = [int(((n * v - sums) ** 2).sum()) for _, v in kept]
    return kept, n, deviation, [(v - sums / n) @ axes / np.sqrt(e) for _, v in kept], e / np.trace(np.cov(fit.T, bias=True))


def test_whitening(spark):
    draw = np.random.default_rng(3)
    good = [(i, [float(np.float32(x)) for x in draw.normal(0, 1 + i % 3, 6)]) for i in range(200)]
    good += [(500 + i, good[i][1]) for i in range(60)] + [(None, good[0][1]), (3, good[9][1])]
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] * 6),
           (903, [float("-inf"), 1.0, 1.0, 1.0, 1.0, 1.0]), (904, [1.0]), (905, [])]
    rows = [(i, v, 1, "c", 2.0) for i, v in good + bad]
    frame = vectors(spark, rows, ", n int, component string, whitened double")
    found = bit_slices.whitened(frame).collect()
    kept, n, deviation, scores, explained = plain_whitening(good)
    assert len(found) == 4 * len(good) and {r.n for r in found} == {n}
    assert {r.identity_error < 1e-9 for r in found} == {True}
    for k in range(4):
        own = [r for r in found if r.component == k + 1]
        mine = order((r.vec_id, r.deviation) for r in own)
        assert mine == order((i, d) for (i, _), d in zip(kept, deviation, strict=True))
        assert {abs(r.explained - explained[k]) < 1e-9 for r in own} == {True}
        got = {r.vec_id: r.whitened for r in own if r.vec_id not in (None, 3)}
        plain = {i: s[k] for (i, _), s in zip(kept, scores, strict=True) if i not in (None, 3)}
        sign = 1 if got[0] * plain[0] > 0 else -1
        assert max(abs(got[i] - sign * plain[i]) for i in plain) < 1e-9


def test_scatter_is_exact_far_from_zero(spark):
    draw = random.Random(4)
    rows = [[draw.randrange(10**14, 10**14 + 2**45) for _ in range(3)] for _ in range(130)]
    fit = spark.createDataFrame([(v, k * 7) for k, v in enumerate(rows)], "x array<long>, row long")
    known = bit_slices.scatter(fit)
    sums = [sum(v[d] for v in rows) for d in range(3)]
    assert known.n == 130 and known.sums == sums
    for i in range(3):
        for j in range(3):
            assert known.centred[i][j] == 130 * sum(v[i] * v[j] for v in rows) - sums[i] * sums[j]
    gaps = fit.select(bit_slices.deviation("x", known).alias("d")).where("d IS NOT NULL")
    assert gaps.count() == 0
    far = spark.createDataFrame([([0], 0), ([2**60], 1)], "x array<long>, row long")
    with pytest.raises(ValueError):
        bit_slices.scatter(far)


def test_whitening_without_variance_or_rows(spark):
    assert bit_slices.whitened(vectors(spark, [])).count() == 0
    assert bit_slices.whitened(vectors(spark, [(1, []), (2, None)])).count() == 0
    found = bit_slices.whitened(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert order((r.vec_id, r.component, r.n, r.deviation, r.whitened) for r in found) == [
        (1, 1, 1, 0, None), (1, 2, 1, 0, None), (2, 1, 1, 0, None), (2, 2, 1, 0, None)]
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]
    found = bit_slices.whitened(vectors(spark, line)).collect()
    assert {(r.component, r.whitened is None) for r in found} == {(1, False), (2, True), (3, True)}
    assert {round(r.explained, 9) for r in found if r.component == 1} == {1.0}


def test_rounds_have_a_leader_outside_the_main_component(spark):
    names = [c for c in rare_first._ENTRY if c not in ("node", "gram")]
    rows = spark.range(12).selectExpr(
        "id AS node", "id % 2 AS gram", *(f"1L AS {c}" for c in names), "id % 3 AS label", "id % 3 = 0 AS main"
    )
    found = rare_first._leaders(rows, F.col("node"), "main").select("gram", "node", "label", "k").collect()
    assert sorted(map(tuple, found)) == [(0, 0, 0, 2), (0, 2, 2, 4), (1, 1, 1, 4), (1, 3, 0, 2)]


def test_pairs_of_later_rounds_meet_the_matches_once(spark):
    pairs = [(1, 2), (2, 1), (1, 2), (3, 4), (5, 6), (6, 5), (8, 7)]
    matches = spark.createDataFrame(pairs, "node_a long, node_b long")
    earlier = [spark.createDataFrame(rows, "a long, b long") for rows in ([(1, 2)], [(5, 6), (9, 10)], [])]
    found = rare_first.untested(matches, earlier)
    assert order(map(tuple, found.collect())) == [(3, 4), (7, 8)]
    # An anti-join per round gave the matches again for each one before it.
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert order(map(tuple, rare_first.untested(matches, []).collect())) == [(1, 2), (3, 4), (5, 6), (7, 8)]
