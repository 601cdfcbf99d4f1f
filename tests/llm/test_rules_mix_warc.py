"""Quality rules, classifier, mixing, personal data, WARC and the pipeline."""

from __future__ import annotations

import gzip
import hashlib
import math
import os
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from cases import TEXTS, documents, near_components, normal, words
from pyspark.sql import functions as F

from orderflow.llm import catalog, disclosure, mixing, quality_rules, rule_ensemble, warc
from orderflow.llm.piece_dropout import load

SMALL = "/root/testdata/sf0.001"


def order(rows):
    return sorted(rows, key=repr)


# --- rules --------------------------------------------------------------------


def repeated_words(tokens):
    windows = [tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4)]
    count = Counter(windows)
    return len({p for i, w in enumerate(windows) if count[w] > 1 for p in range(i, i + 5)})


def test_rule_statistics(spark):
    texts = TEXTS + [(30, "a b c d e x a b c d e a b c d e f"), (31, "... \n- b\nsame\nsame\n \n ")]
    rows = quality_rules.judged(documents(spark, texts, extra=True)).collect()
    found = [(r.doc_id, r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows]
    expected = []
    for i, t in texts:
        tokens = words(t)
        lines = [x for x in (t or "").split("\n") if words(x)]
        repeat = repeated_words(tokens)
        failed = len(tokens) < 10 or 100 * repeat > 20 * len(tokens)
        expected.append((i, len(tokens), sum(map(len, tokens)), len(lines) - len(set(lines)), repeat, failed))
    assert order(found) == order(expected)
    assert all(not r.kept for r in rows if r.base_failed)
    assert quality_rules.judged(documents(spark, [])).count() == 0


def test_rules_are_one_projection(spark):
    plan = quality_rules.judged(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas", plan)


# --- classifier ---------------------------------------------------------------


def test_classifier_reads_nothing_but_the_text(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    ensemble = rule_ensemble.fit_ensemble(docs, labels)
    assert ensemble.rules and rule_ensemble.fit_ensemble(docs.repartition(3), labels) == ensemble
    hidden = labels.withColumn(
        "quality",
        F.when(rule_ensemble.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")),
    )
    assert rule_ensemble.fit_ensemble(docs, hidden) == ensemble
    rows = documents(spark, extra=True)
    scored = rule_ensemble.scored(rows, ensemble)
    assert set(scored.columns) == set(rows.columns)
    values = scored.select("doc_id", "score").collect()
    assert len(values) == len(TEXTS) and all(0 <= r.score <= 1 for r in values)
    by_id = {r.doc_id: r.score for r in values}
    assert by_id[1] == by_id[2]


def test_scores_equal_the_rules_and_the_sigmoid(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ensemble = rule_ensemble.fit_ensemble(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    frame = rule_ensemble.features(docs).select("doc_id", "__features.*")
    plain = {}
    for r in frame.collect():
        total = ensemble.bias
        for rule, weight in ensemble.rules:
            if all(r[t.feature] > t.threshold if t.above else r[t.feature] <= t.threshold for t in rule):
                total += weight
        plain[r.doc_id] = 1 / (1 + math.exp(-total))
    found = {r.doc_id: r.score for r in rule_ensemble.scored(docs, ensemble).collect()}
    assert found.keys() == plain.keys()
    assert max(abs(found[i] - plain[i]) for i in plain) < 1e-12
    assert 0.3 < sum(s > 0.5 for s in plain.values()) / len(plain) < 0.999


def test_statistics_against_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in rule_ensemble.features(docs).select("doc_id", "__features.*").collect():
        t, w = texts[r.doc_id], words(texts[r.doc_id])
        solid = max(sum(map(len, w)), 1)
        assert r.log_words == pytest.approx(math.log1p(len(w)))
        assert r.mean_word == pytest.approx(sum(map(len, w)) / max(len(w), 1))
        assert r.capitals == pytest.approx(len(re.findall("[A-Z]", t)) / solid)
        assert r.digits == pytest.approx(len(re.findall("[0-9]", t)) / solid)
        assert r.distinct_words == pytest.approx(len(set(w)) / max(len(w), 1))


def test_lasso_meets_its_conditions():
    draw = np.random.default_rng(8)
    flags = (draw.random((3_000, 12)) < draw.random(12)).astype(float)
    flags[:, 11] = flags[:, 3]
    truth = np.array([2.0, -1.5, 0, 0, 1.0, 0, 0, 0, 0, 0, 0, 0])
    labels = (draw.random(3_000) < 1 / (1 + np.exp(-(flags @ truth - 0.3)))).astype(float)
    penalty = 0.01
    bias, weights = rule_ensemble.lasso_weights(flags, labels, penalty)
    spread = flags.std(axis=0)
    slope = flags.T @ (1 / (1 + np.exp(-(bias + flags @ weights))) - labels) / len(labels) / spread
    for g, w in zip(slope, weights, strict=True):
        # The slope of the loss balances the penalty of a weight, or stays below it.
        assert abs(g + penalty * np.sign(w)) < 1e-6 if w else abs(g) <= penalty + 1e-6
    assert weights[0] > 1 and weights[1] < -0.8 and np.count_nonzero(weights) < 8
    assert abs(np.mean(1 / (1 + np.exp(-(bias + flags @ weights))) - labels)) < 1e-6


def test_lasso_on_separable_flags():
    flags = np.array([[1.0, 0.0, 1.0]] * 50 + [[0.0, 1.0, 1.0]] * 50)
    labels = np.r_[np.ones(50), np.zeros(50)]
    bias, weights = rule_ensemble.lasso_weights(flags, labels, 0.002)
    assert np.isfinite(weights).all() and weights[2] == 0
    assert ((bias + flags @ weights > 0) == labels).all()


def test_classifier_without_labels(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert rule_ensemble.fit_ensemble(docs, none) == rule_ensemble.Ensemble(0.0, ())
    odd = spark.createDataFrame([(None, 1), (4, None), (99, 1), (5, 1), (6, 2)], "doc_id long, quality int")
    scored = rule_ensemble.scored(docs, rule_ensemble.fit_ensemble(docs, odd))
    assert {round(r.score, 6) for r in scored.collect()} <= {0.5, round(2 / 3, 6)}


# --- mixing -------------------------------------------------------------------


@pytest.mark.parametrize("bits", [4, 14, 56])
def test_mix_meets_targets(spark, bits):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    mix = mixing.Mix(bits=bits)
    rows = mixing.mix_plan(docs, mix).toPandas()
    assert len(rows) == docs.count()
    total = rows["size"].sum()
    for _, one in rows.groupby("source", dropna=False):
        assert abs(one.taken.sum() - one.target.iloc[0]) <= one["size"].max()
        assert one.target.iloc[0] <= 2 * one["size"].sum() + 1e-6
    assert abs(rows.drop_duplicates("source").target.sum() - 1.5 * total) < 1e-3
    assert (rows.taken <= 2 * rows["size"]).all()
    again = mixing.mix_plan(docs.repartition(5), mix).toPandas()
    assert dict(zip(again.doc_id, again.taken)) == dict(zip(rows.doc_id, rows.taken))


def test_mixed_rows_equal_the_plan(spark):
    docs = documents(spark, extra=True)
    plan = mixing.mix_plan(docs).select("doc_id", "size", "copies").collect()
    found = Counter(r.doc_id for r in mixing.mixed(docs).select("doc_id").collect())
    expected = Counter()
    for r in plan:
        expected[r.doc_id] += r.copies
    assert found == +expected and mixing.mixed(docs).columns == docs.columns
    assert {r.doc_id: r["size"] for r in plan}[1] == 0
    assert mixing.mixed(documents(spark, [])).count() == 0
    assert mixing.mix_plan(documents(spark, [(1, None), (2, "")])).count() == 2


# --- personal data ------------------------------------------------------------


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = []
    for k, (kind, pattern) in enumerate(plain.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda d=digits: 14 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 10 <= len(d) <= 15,
            }[kind]()
            if good:
                found.append((m.start(), k, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


ODD = [
    "a@b.c@d.e _x@y.z-q@r.s", "é🙂 a@b.co", "1.2.3.4.5.6.7.8", "256.1.1.1 1.256.1.1", "000.0.0.0255",
    "+1 2 3 4 5 6 7 8 9 0", "+1((((", "4111-1111-1111-1111 4111111111111112", "+4111 1111 1111 1111",
    "x" * 50_000 + "@" + "1 " * 20_000, "1.1.1.1 " * 3000, "@@.a@b", "a@b.c.d.@e.f", "00 00 00 00 00 00 00",
]


SECRETS = [
    'say token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"### so', "PASSWORD: hunter2hunter2hunter2/x+", "key=short",
    "token=token=aaaaaaaaaaaaaaaasecret=bbbbbbbbbbbbbbbbb", "🙂 key: 4111111111111111",
]


def places(found):
    return [(x.start, x.stop) for x in found]


def test_base_spans(spark):
    texts = TEXTS + [(100 + i, t) for i, t in enumerate(ODD + SECRETS)]
    rows = disclosure.sanitised(documents(spark, texts, extra=True))
    found = [(r.doc_id, r.s) for r in rows.select("doc_id", disclosure.written(F.col("base")).alias("s")).collect()]
    assert order(found) == order([(i, base_spans(t)) for i, t in texts])


def test_secrets_are_entities(spark):
    texts = list(enumerate(SECRETS)) + [(50 + i, "say so of the key or token") for i in range(60)]
    rows = {r.doc_id: r for r in disclosure.sanitised(documents(spark, texts)).collect()}
    secret = disclosure.KINDS.index("secret")
    found = {i: [SECRETS[i][x.start : x.stop] for x in rows[i].spans if x.kind == secret] for i in range(5)}
    assert found == {
        0: ["24be64439e3e49cf46b2d7c90f3602a3d0b907ff"], 1: ["hunter2hunter2hunter2/x+"], 2: [],
        3: ["aaaaaaaaaaaaaaaasecret"], 4: ["4111111111111111"],
    }
    assert rows[0].sanitised == 'say token = "[SECRET]"### so' and not rows[0].base
    # The card number starts at the same place and is named first.
    assert rows[4].sanitised == "🙂 key: [CARD]" and len(rows[4].spans) == 2


def test_terms_that_give_an_entity_away(spark):
    texts = [(i, f"the agent zanzibar writes from bob@x.org the end number{i}") for i in range(4)]
    texts += [(10 + i, "the end of a story that the others tell, from here") for i in range(60)]
    texts += [(90 + i, f"zanzibar alone {i}") for i in range(3)]
    docs = documents(spark, texts, extra=True)
    found = disclosure.sanitised(docs)
    assert set(found.columns) == {*docs.columns, "base", "spans", "sanitised"}
    rows = {r.doc_id: r for r in found.collect()}
    # "agent" and "writes" stand with the address only, "zanzibar" elsewhere too.
    assert rows[0].sanitised == "the  [TERM]  from [EMAIL] the end "
    assert rows[10].sanitised == texts[4][1] and rows[90].sanitised == "zanzibar alone 0"
    assert places(rows[0].spans) == [(4, 9), (10, 18), (19, 25), (31, 40), (49, 56)] and not rows[90].spans
    doubted = disclosure.sanitised(docs, disclosure.Disclosure(doubt=40.0)).where("doc_id = 0").head()
    assert doubted.sanitised == "the agent zanzibar writes from [EMAIL] the end number0"


def test_terms_of_the_whole_document(spark):
    far = "so on and on " * 30
    texts = [
        (1, f"Alice wrote a@x.com, said (Bob's) \"O'Hara-Smith\" 王芳 R2D2 so {far} Alice2 then alice."),
        (2, "éa@y.org Carol"),
        (3, "Dave b@z.org and b@z.org so on"),
        (3, "Dave b@z.org and b@z.org so on"),
        (4, "Erin b@z.org, on Dave then"),
    ]
    texts += [(10 + i, "so on and on wrote said then a") for i in range(60)]
    rows = disclosure.sanitised(documents(spark, texts, extra=True)).collect()
    found = [
        (r.doc_id, [t[x.start : x.stop] for x in r.spans if x.kind == disclosure.TERM_KIND])
        for r in rows for t in [dict(texts)[r.doc_id]]
    ]
    expected = [(i, []) for i, _ in texts[5:]] + [
        (1, ["Alice", "Bob's", "O'Hara-Smith", "王芳", "R2D2", "Alice2", "alice"]),
        (2, ["Carol"]), (3, ["Dave"]), (3, ["Dave"]), (4, ["Erin", "Dave"]),
    ]
    assert order(found) == order(expected)


def plain_told(texts, rule, entities):
    """(row, term) that a plain reading of the rule treats."""
    token = r"[^\W_]+(?:[-'][^\W_]+)*"
    held = [{w.lower() for w in re.findall(token, t or "")} for _, t in texts]
    n, n_t = len(texts), Counter(w for x in held for w in x)
    n_e = Counter(e for x in entities for e in x)
    n_et = Counter((e, w) for x, y in zip(entities, held, strict=True) for e in x for w in y)
    told = lambda e, w: math.log(n * n_et[e, w] / (n_e[e] * n_t[w])) / math.log(n / n_e[e])
    return [{w for w in y for e in x if told(e, w) >= rule.generalise} for x, y in zip(entities, held, strict=True)]


def named_entities(text):
    spans = [x.split(":") for x in base_spans(text).split(",") if x]
    values = [(k, text[int(a) : int(b)]) for k, a, b in spans]
    named = {(k, v.lower() if k in ("email", "ip") else re.sub("[^0-9]", "", v)) for k, v in values}
    return named | {("secret", m[1]) for m in re.finditer(r'token = "([0-9a-f]{16,})', text or "")}


def test_whole_documents_against_plain_counts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    kept = [(r.doc_id, r.text) for r in docs.collect()]
    told = plain_told(kept, disclosure.Disclosure(), [named_entities(t) for _, t in kept])
    expected = dict(zip((i for i, _ in kept), told, strict=True))
    texts, some = dict(kept), 0
    for r in disclosure.sanitised(docs).collect():
        t, named = texts[r.doc_id], [(x.start, x.stop) for x in r.spans if x.kind != disclosure.TERM_KIND]
        want = {
            (m.start(), m.end())
            for m in re.finditer(r"[^\W_]+(?:[-'][^\W_]+)*", t or "")
            if m[0].lower() in expected[r.doc_id] and not any(a < m.end() and m.start() < b for a, b in named)
        }
        assert {(x.start, x.stop) for x in r.spans if x.kind == disclosure.TERM_KIND} == want
        some += len(want)
    assert some


def test_many_entities_and_terms_meet_as_groups(spark):
    """400 addresses and 2,000 words, all in the same two documents, are one pair."""
    text = " ".join([f"a{i}@x.org" for i in range(400)] + [f"word{i}x" for i in range(2_000)])
    docs = documents(spark, [(1, text), (2, text), *((10 + i, "so on") for i in range(60))])
    rows = disclosure.sanitised(docs).where("doc_id < 3").collect()
    assert [len(r.spans) for r in rows] == [2_400, 2_400]
    assert {r.sanitised for r in rows} == {"[EMAIL] " * 400 + " " * 1_999}
    held = docs.where("doc_id < 3").withColumns(disclosure._row_key())
    terms = held.select(*disclosure.ROW, F.explode(F.split("text", " ")).alias("term"))
    groups, _ = disclosure._grouped(terms.withColumn("n_t", F.lit(2)), "term", "n_t")
    assert groups.count() == 2


def test_query_rewrites_the_texts(spark, tmp_path):
    texts = [(1, "🙂 the agent Zanzibar writes from bob@x.org, Zanzibar!"), (2, None)]
    texts += [(10 + i, "the agent writes from here") for i in range(60)]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in catalog.queries()["op6_pii"](spark, str(tmp_path)).collect()}
    clean = "🙂 the agent  writes from [EMAIL], !"
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert rows[1].sanitised_sha256 == digest(clean) and rows[2].sanitised_sha256 == digest("")
    assert rows[1].spans == "term:12:20,email:33:42,term:44:52" and rows[1].n_email == 1
    assert rows[10].spans == "" and len(rows) == len(texts)


def test_long_texts_are_cut_at_span_borders(spark):
    parts = [("é🙂" * 300 + " ", "a@b.co"), (" " + "x" * 255 + " ", "c@d.co"), ("", " e@f.co"), (" " + "y" * 512, "")]
    text = "".join(a + b for a, b in parts)
    docs = documents(spark, [(1, text), *((2 + i, "so") for i in range(200))])
    rows = [r for r in disclosure.sanitised(docs, disclosure.Disclosure(2.0, 2.0)).collect() if r.doc_id == 1]
    assert rows[0].sanitised == re.sub(r"[a-z]@[a-z]\.co", "[EMAIL]", text)


def test_sanitised_overlaps_and_no_rows(spark):
    docs = documents(spark, [(1, "+4111 1111 1111 1111 x"), (2, "🙂 a@b.co!"), (3, None), (3, None)])
    rows = [(r.doc_id, r.sanitised) for r in disclosure.sanitised(docs).collect()]
    one = next(t for i, t in rows if i == 1)
    assert order(rows) == order([(1, one), (2, "🙂 [EMAIL]!"), (3, None), (3, None)])
    assert one.endswith("[CARD] ") and "1111" not in one
    assert disclosure.sanitised(documents(spark, [])).count() == 0


# --- WARC ---------------------------------------------------------------------

PAGES = [
    (1, "http://www.Example.org/a?b=1", "<p>one</p>"),
    (2, "http://example.org:8080/", "<p>one</p>"),
    (3, None, None),
    (4, "", ""),
    (5, "http://user@b.example.org/é x\r\ny", "🙂" * 40_000),
    (6, "http://www.example.org/a?b=1", "other\r\n\r\nWARC/1.1\r\n"),
    (6, "http://www.example.org/a?b=1", "other\r\n\r\nWARC/1.1\r\n"),
    (7, "http://www.example.org/a?b=1", "<p>one</p>"),
    (None, "http://z.org/", "no id"),
]


def damaged(raw, old, new):
    assert raw.count(old) == 1
    return raw.replace(old, new)


def test_damaged_records_are_noticed():
    html = b"<p>" + b"letters " * 100 + b"</p>"
    raw = warc.record(7, "http://a.org/", html, len(html), warc.base32_sha1(html), None, False)
    assert warc.parsed(raw)["payload_bytes"] == len(html)
    # The same block length, a changed letter; then with a block digest that fits.
    changed = raw.replace(b"letters " * 100, b"letters " * 99 + b"lettres ")
    with pytest.raises(warc.DamagedRecord, match="block"):
        warc.parsed(changed)
    block = changed.partition(b"\r\n\r\n")[2][:-4]
    mended = re.sub(rb"(WARC-Block-Digest: sha1:)\w+", rb"\g<1>" + warc.base32_sha1(block).encode(), changed)
    with pytest.raises(warc.DamagedRecord, match="payload"):
        warc.parsed(mended)
    short = warc.record(7, "http://a.org/", html[:-9], len(html), warc.base32_sha1(html), None, False)
    with pytest.raises(warc.DamagedRecord, match="payload"):
        warc.parsed(short)
    revisit = warc.record(8, None, b"", 55, "X" * 32, 7, True)
    assert warc.parsed(revisit)["refers_to"] == 7 and warc.parsed(revisit)["payload"] is None


def test_a_damaged_archive_is_not_read(spark, tmp_path):
    # Archive files are gzip members: change one and pack it again at the same place.
    archive = warc.write_archive(pages(spark, [(1, "http://a.org/", "x" * 400)]))
    folder = archive.folder.removeprefix("file://")
    (name,) = [f for f in os.listdir(folder) if f.startswith("warc")]
    with open(f"{folder}/{name}", "rb") as file:
        raw = gzip.decompress(file.read())
    packed = gzip.compress(damaged(raw, b"x" * 400, b"x" * 399 + b"y"), 6, mtime=0)
    places = spark.read.schema(warc.PLACES).parquet(f"{folder}/places").collect()
    with open(f"{folder}/{name}", "wb") as file:
        file.write(packed.ljust(places[0].length, b"\0")[: places[0].length])
    with pytest.raises(Exception, match="DamagedRecord|error|Error"):
        warc.read_captures(archive, pages(spark, [(1, "http://a.org/", "")])).collect()


@pytest.mark.parametrize("block", [7, 50])
def test_one_url_with_many_captures(spark, block):
    rows = [(i, "http://hot.org/" if i % 3 else f"http://h{i}.org/", f"page {i % 40}") for i in range(900)]
    rows += [(None, "http://hot.org/", "none"), (5, "http://hot.org/", "page 5")]
    archive = warc.write_archive(pages(spark, rows), block_lines=block)
    found = warc.read_captures(archive, pages(spark, rows).select("page_id", "url")).collect()
    assert Counter((r.page_id, r.payload_bytes) for r in found) == Counter((i, len(h)) for i, _, h in rows)
    entries = [r.asDict() for r in spark.read.schema(warc.DIRECTORY).parquet(archive.directory).collect()]
    entries.sort(key=lambda x: (x["first"], x["first_id"]))
    assert len(entries) >= 900 // block
    lasts = [(x["last"], x["last_id"]) for x in entries]
    # A lookup touches the block that holds it, however many its URL has.
    touched = [len(list(warc.blocks_of(entries, lasts, (warc.surt("http://hot.org/"), i)))) for i in range(900)]
    assert max(touched) <= 2 and sum(touched) <= 1.3 * 900


def test_folders_get_the_file_system_of_the_session(spark, tmp_path):
    assert warc._qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert warc._qualified(spark, f"file:{tmp_path}") == f"file://{tmp_path}"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, sha1 string, key string")


@pytest.mark.parametrize("least,block", [(0, 1), (5, 3), (0, 1000)])
def test_archive_round_trip(spark, least, block):
    archive = warc.write_archive(pages(spark, PAGES), least, block)
    found = warc.read_captures(archive, pages(spark, PAGES).select("page_id", "url")).collect()
    first = {}
    for i, _, html in sorted(PAGES, key=lambda x: (x[0] is None, x[0] or 0)):
        first.setdefault(html or "", i)
    expected = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        revisit = len(raw) >= least and first[html or ""] != i
        expected.append(
            (i, None if revisit else raw, len(raw), warc.base32_sha1(raw),
             "revisit" if revisit else "response", first[html or ""] if revisit else None)
        )
    got = [
        (r.page_id, r.payload and bytes(r.payload) if r.payload is not None else None, r.payload_bytes,
         r.payload_digest, r.record_type, r.refers_to)
        for r in found
    ]
    assert order(got) == order(expected)


def test_archive_files_are_plain_warc(spark):
    archive = warc.write_archive(pages(spark, PAGES[:2]))
    names = spark.read.parquet(f"{archive.folder}/places").select("file").distinct().collect()
    raw = b"".join(gzip.open(f"{archive.folder}/{r.file}".removeprefix("file:")).read() for r in names)
    assert raw.count(b"WARC/1.1\r\n") == 2 and b"WARC-Type: revisit" in raw


def test_lookups_of_other_urls_and_no_pages(spark):
    archive = warc.write_archive(pages(spark, PAGES))
    strange = spark.createDataFrame([(1, "http://nowhere.org/"), (99, PAGES[0][1])], "page_id long, url string")
    assert warc.read_captures(archive, strange).count() == 0
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_reversed_host_keys():
    assert warc.surt("http://www.Example.org:80/A?q") == "org,example,www:80)/a?q"
    assert warc.surt(None) == ")/" and warc.surt("http://[bad") == warc.surt("http://[bad")


# --- pipeline -----------------------------------------------------------------


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality", "exact", "near", "mix", "encode"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    good = stage["quality"](spark, docs, SMALL).cache()
    kept = {r.doc_id for r in good.collect()}
    known = [(i, q) for i, q in labels.items()]
    assert sum((i in kept) == bool(q) for i, q in known) >= 0.95 * len(known)

    rows = [(r.doc_id, r.text) for r in good.collect()]
    least = {}
    for i, t in sorted(rows):
        least.setdefault(normal(t), i)
    single = stage["exact"](spark, good, SMALL).cache()
    assert sorted(r.doc_id for r in single.collect()) == sorted(least.values())

    rows = [(r.doc_id, r.text) for r in single.collect()]
    expected = {i for (i, _), c in zip(rows, near_components(rows, 5, 80), strict=True) if i == c}
    apart = stage["near"](spark, single, SMALL).cache()
    assert {r.doc_id for r in apart.collect()} == expected

    plan = {r.doc_id: r.copies for r in mixing.mix_plan(apart).collect()}
    mix = stage["mix"](spark, apart, SMALL).cache()
    assert Counter(r.doc_id for r in mix.collect()) == +Counter(plan)
    for frame in (good, single, apart):
        assert frame.columns == docs.columns
    # The mix numbers the copies, so that encoding needs no shuffle to tell them apart.
    assert mix.columns == [*docs.columns, "copy"]
    numbers = Counter((r.doc_id, r.copy) for r in mix.collect())
    assert set(numbers.values()) == {1} and set(numbers) == {(i, k + 1) for i, n in plan.items() for k in range(n)}
    stored = spark.createDataFrame([], mix.schema)
    assert "Exchange" not in stage["encode"](spark, stored, SMALL)._jdf.queryExecution().executedPlan().toString()

    texts = {r.doc_id: r.text for r in mix.collect()}
    model = load(corpus_pipeline.PIECE_MODEL)
    out = stage["encode"](spark, mix, SMALL).collect()
    assert len(out) == mix.count()
    assert all(b"".join(model.raw[k] for k in r.ids)[1:].decode() == texts[r.doc_id] for r in out)


def test_stages_on_awkward_and_no_rows(spark, tmp_path):
    labels = [(i, int(i > 8)) for i in range(1, 22)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for texts in (TEXTS, []):
        docs = documents(spark, texts, extra=True)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, docs, str(tmp_path))
            assert rows.columns[:5] == corpus_pipeline.COLUMNS and rows.count() <= 2 * len(texts)
        assert corpus_pipeline.encode(spark, docs, str(tmp_path)).count() == len(texts)


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
