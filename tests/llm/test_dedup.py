"""Exact, line and near deduplication on awkward rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import TEXTS, documents, kept_lines, near_components, normal

from orderflow.llm import block_names, line_runs, near_dups


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_exact_classes(spark, block):
    texts = [(i, t) for i, t in TEXTS if block > 1 or len(t or "") < 1000]
    rows = block_names.duplicate_classes(documents(spark, texts, extra=True), block).collect()
    sizes, members = Counter(), defaultdict(set)
    for i, t in texts:
        sizes[normal(t)] += 1
        members[normal(t)].add(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in members.items()}
    expected = [
        (i, least[t], sizes[t], i == least[t], hashlib.sha256(t.encode()).hexdigest())
        for t, ids in members.items()
        for i in ids
    ]
    found = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.sha.hex()) for r in rows]
    assert order(found) == order(expected)


def test_exact_keeps_columns_and_one_row(spark):
    docs = documents(spark, extra=True)
    kept = block_names.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert ids[16] == 1 and 6 not in ids and 5 in ids and ids[None] == 1
    assert block_names.deduplicated(documents(spark, [])).count() == 0


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_lines(spark, batches):
    docs = documents(spark, extra=True)
    rules = line_runs.LineRules(batches=batches, fanout=2)
    rows = line_runs.without_repeated_lines(docs, rules)
    assert set(rows.columns) == {*docs.columns, "n_lines", "n_dropped", "kept_text"}
    found = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in rows.collect()]
    expected = [(i, *x) for (i, _), x in zip(TEXTS, kept_lines(TEXTS), strict=True)]
    assert order(found) == order(expected)
    assert sum(x[2] for x in found) > 0


def test_lines_of_documents_with_text_ids(spark):
    line = "This line is long enough to be counted as a repeated one"
    rows = [(f"d{i}", line) for i in range(6)] + [(None, line), ("d10", "short")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = {r.doc_id: (r.n_dropped, r.kept_text) for r in line_runs.without_repeated_lines(docs).collect()}
    assert found["d5"] == (0, line) and found["d10"] == (0, "short")
    assert all(found[i] == (1, "") for i in (None, "d0", "d4"))


def test_lines_of_no_documents(spark):
    assert line_runs.without_repeated_lines(documents(spark, [])).count() == 0


def test_runs_are_compacted_and_read_without_shuffle(spark):
    runs = line_runs.LineRuns(spark, fanout=2)
    rows = spark.sql("SELECT unhex(md5(string(id % 50))) AS hash, id, true AS first, id % 5 AS batch FROM range(200)")
    for batch in range(5):
        runs.add(rows.where(f"batch = {batch}"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    found = {r.top for r in runs.found_in(4).collect()}
    assert found == set(range(150, 200))
    plan = runs._read(runs.runs()[0]).join(runs._read(runs.runs()[1]).hint("merge"), "hash", "left_anti")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    runs.drop()


def variants(seed, groups=6, copies=12, length=60):
    draw = random.Random(seed)
    texts, i = [], 0
    for _ in range(groups):
        base = [f"w{draw.randrange(10_000)}" for _ in range(length)]
        for _ in range(copies):
            text = list(base)
            for _ in range(draw.randrange(4)):
                text[draw.randrange(length)] = f"x{draw.randrange(10_000)}"
            texts.append((i, " ".join(text)))
            i += 1
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("small,block,rounds", [(8, 256, 3), (1, 256, 0), (1, 3, 1)])
def test_near_components(spark, small, block, rounds):
    texts = TEXTS + [(i + 100, t) for i, t in variants(3)]
    near = near_dups.Near(words=4, small=small, block=block, rounds=rounds, buckets=2)
    rows = near_dups.near_duplicates(documents(spark, texts, extra=True), near).collect()
    expected = near_components(texts, 4, 80)
    found = [(r.doc_id, r.component_id, r.kept) for r in rows]
    assert order(found) == order([(i, c, i == c) for (i, _), c in zip(texts, expected, strict=True)])


def test_near_rows_of_equal_id_and_other_text(spark):
    texts = [(1, "a b c d e f"), (1, "q r s t u v"), (0, "q r s t u v"), (2, "a b c d e f")]
    rows = near_dups.near_duplicates(documents(spark, texts)).collect()
    assert order((r.doc_id, r.component_id) for r in rows) == order([(1, 1), (1, 0), (0, 0), (2, 1)])
    docs = documents(spark, texts, extra=True)
    kept = near_dups.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert order((r.doc_id, r.text[0]) for r in kept.collect()) == [(0, "q"), (1, "a")]
    assert near_dups.without_near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("prints", [0, 720])
def test_large_buckets_exactly_and_by_sketch(spark, prints):
    texts = variants(7, groups=2, copies=40)
    near = near_dups.Near(words=4, small=1, block=5, prints=prints, rounds=0)
    rows = near_dups.near_duplicates(documents(spark, texts), near).collect()
    found = order((r.doc_id, r.component_id) for r in rows)
    assert found == order(zip((i for i, _ in texts), near_components(texts, 4, 80), strict=True))


def test_repeated_rows_have_one_set(spark):
    texts = [(i, t) for i, t in variants(9, groups=1, copies=6) for _ in range(50)]
    docs = documents(spark, texts)
    near = near_dups.Near(words=4)
    rows = docs.select("doc_id", "text").withColumns(near_dups._row_key())
    nodes = rows.dropDuplicates(["id", "mark"]).selectExpr("id", "mark", "monotonically_increasing_id() AS node")
    assert near_dups.full_sets(docs, nodes, near).count() == 6
    found = near_dups.near_duplicates(docs, near).collect()
    assert order((r.doc_id, r.component_id) for r in found) == order(
        zip((i for i, _ in texts), near_components(texts, 4, 80), strict=True)
    )


def test_sketches_fill_and_estimate():
    draw = np.random.default_rng(1)
    near = near_dups.Near()
    pool = draw.integers(0, 1 << 62, 400, dtype=np.uint64)
    errors = []
    for shared in (0, 100, 200, 300):
        a, b = np.sort(pool[:300]), np.sort(pool[300 - shared : 600 - shared])
        rows = near_dups.sketches(np.concatenate([a, b]), np.array([len(a), len(b)]), near.bins)
        union = len(np.union1d(a, b))
        errors.append(abs((rows[0] == rows[1]).mean() - len(np.intersect1d(a, b)) / union))
    assert max(errors) < 0.12
    tiny = near_dups.sketches(pool[:1], np.array([1, 0]), near.bins)
    assert (tiny[0] != near_dups.EMPTY).all() and (tiny[1] == near_dups.EMPTY).all()
