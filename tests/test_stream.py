"""Streams fed by several CSV files, one per micro-batch."""

from __future__ import annotations

import random

import pytest
from helpers import at, ids, order, orders, values, write_order_file
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from orderflow import schema as S
from orderflow.operators import aggregates as agg
from orderflow.operators.dedupe import dedupe_orders
from orderflow.operators.derive import derive_columns, normalize_status
from orderflow.operators.enrich import check_dimension, enrich_with_dimensions
from orderflow.operators.quality import rejected_orders, split_cancelled, valid_orders
from orderflow.plans import catalog
from orderflow.plans.stream import (
    ALL_QUERIES,
    StreamTables,
    kept_state,
    replay_batches,
    run_file_stream,
    run_kafka_stream,
    run_record_stream,
    run_stream,
    start_queries,
    start_query,
    start_table,
    wait_and_stop,
)
from orderflow.sources.files import stream_orders_csv
from orderflow.sources.kafka import encode_orders
from orderflow.streaming import deltas, sinks, tables
from orderflow.streaming.clean import clean_and_derive, clean_stream, rejected_stream
from orderflow.streaming.late import read_late_rows, store_late_rows
from orderflow.streaming.progress import ProgressLog

NOW = {"availableNow": True}


def feed(directory, batches, first=0):
    directory.mkdir(exist_ok=True)
    for number, rows in enumerate(batches, first):
        write_order_file(directory, number, rows)
    return str(directory)


def source(spark, directory, per_trigger=1):
    return stream_orders_csv(spark, str(directory), per_trigger)


def collect(frame, mode, checkpoint, columns, name="collect"):
    """Rows of each micro-batch, by batch id."""
    seen = {}

    def keep(batch, batch_id):
        seen[batch_id] = values(batch, *columns)

    query = start_query(frame, name, mode, keep, str(checkpoint), NOW)
    query.awaitTermination()
    return seen


def filled(seen):
    return {k: v for k, v in seen.items() if v}


# Two products over five files: repeats, late rows, missing ids and times.
DEDUPE = [
    [
        order("o1", "10:00", "p1", price=2.0), order("o1", "10:02", "p1", price=2.0),
        order("o2", "10:05", "p2", price=4.0), order(None, "10:05", "p2", price=4.0),
        order("onull", None, "p1", price=100.0),
    ],
    [order("o3", "11:00", "p1", price=8.0), order("o1", "10:04", "p1", price=2.0)],
    [
        order("olate", "10:20", "p1", price=16.0), order("ook", "10:45", "p1", price=32.0),
        order("onull", "11:01", "p1", price=100.0),
    ],
    [order("o9", "13:00", "p2", price=64.0)],
    [order("o1", "13:01", "p1", price=128.0), order("o10", "12:35", "p1", price=256.0)],
]


@pytest.fixture
def stream(spark, tmp_path):
    return source(spark, feed(tmp_path / "in", DEDUPE))


def test_dedupe_within_the_watermark(stream, tmp_path):
    seen = collect(clean_stream(stream), "append", tmp_path / "cp", ["order_id"])
    assert filled(seen) == {
        0: [("o1",), ("o2",), ("onull",)],
        1: [("o3",)],
        2: [("olate",), ("onull",), ("ook",)],
        3: [("o9",)],
        4: [("o1",), ("o10",)],
    }


def test_dedupe_in_parts_changes_no_result(spark, stream, tmp_path):
    columns = S.column_names(S.ORDERS)
    plain = collect(clean_stream(stream), "append", tmp_path / "a", columns)
    parted = collect(clean_stream(stream, parts=3), "append", tmp_path / "b", columns)
    # Of copies within a batch any one may stay; they differ in time only.
    drop_time = lambda seen: {k: sorted((*r[:3], *r[4:]) for r in v) for k, v in filled(seen).items()}
    assert drop_time(plain) == drop_time(parted)


def test_a_hot_id_is_spread_over_tasks(spark, tmp_path):
    # 16 files, each with 50 copies of one order, read by as many tasks.
    files = [[order("hot", "10:00")] * 50 + [order(f"o{i}", "10:01")] for i in range(16)]
    rows = source(spark, feed(tmp_path / "in", files), per_trigger=16)
    with_parts = clean_stream(rows, parts=8)
    settings = {"spark.sql.files.openCostInBytes": str(128 << 20), "spark.sql.files.minPartitionNum": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        counts = {}
        query = start_query(
            with_parts, "hot", "append", lambda b, i: counts.update({i: values(b, "order_id")}),
            str(tmp_path / "cp"), NOW, state_partitions=8,
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(counts[0]) == 17 and counts[0].count(("hot",)) == 1
    state = lambda operator: spark.read.format("statestore").option("operatorId", operator).load(str(tmp_path / "cp" / "hot"))
    held = {n: state(n).where("key.order_id = 'hot'").select("partition_id").distinct().count() for n in (0, 1)}
    # The copies went through several tasks, and the last one saw one from each.
    assert sorted(held.values())[0] == 1 and sorted(held.values())[1] >= 4


def test_windows_in_append_mode(stream, tmp_path):
    frame = agg.windowed_revenue(clean_and_derive(stream))
    columns = ["window_start", "product_id", "orders_count", "total_revenue"]
    assert filled(collect(frame, "append", tmp_path / "cp", columns)) == {
        2: [(at("10:00:00"), "p1", 1, 2.0), (at("10:00:00"), "p2", 1, 4.0), (at("10:20:00"), "p1", 1, 16.0)],
        4: [(at("10:40:00"), "p1", 1, 32.0), (at("11:00:00"), "p1", 2, 108.0)],
    }


def test_windows_in_update_mode(stream, tmp_path):
    frame = agg.windowed_revenue(clean_and_derive(stream))
    columns = ["window_start", "product_id", "orders_count", "total_revenue"]
    assert filled(collect(frame, "update", tmp_path / "cp", columns)) == {
        0: [(at("10:00:00"), "p1", 1, 2.0), (at("10:00:00"), "p2", 1, 4.0)],
        1: [(at("11:00:00"), "p1", 1, 8.0)],
        2: [(at("10:20:00"), "p1", 1, 16.0), (at("10:40:00"), "p1", 1, 32.0), (at("11:00:00"), "p1", 2, 108.0)],
        3: [(at("13:00:00"), "p2", 1, 64.0)],
        4: [(at("12:30:00"), "p1", 1, 256.0), (at("13:00:00"), "p1", 1, 128.0)],
    }


def test_totals_in_complete_mode(stream, tmp_path):
    frame = agg.product_totals(clean_and_derive(stream))
    seen = collect(frame, "complete", tmp_path / "cp", ["product_id", "total_orders", "total_revenue"])
    p1 = [(2, 102.0), (3, 110.0), (6, 258.0), (6, 258.0), (8, 642.0)]
    p2 = [(1, 4.0), (1, 4.0), (1, 4.0), (2, 68.0), (2, 68.0)]
    for batch, (first, second) in enumerate(zip(p1, p2)):
        assert seen[batch] == [("p1", *first), ("p2", *second)]


def test_totals_cannot_be_appended(stream, tmp_path):
    frame = agg.product_totals(clean_and_derive(stream))
    with pytest.raises(AnalysisException):
        collect(frame, "append", tmp_path / "cp", ["product_id"])


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    batches = [[order(i, t)] for i, t in (
        ("a", "10:00"), ("b", "12:00"), ("c", "12:01"), ("late", "11:29"), ("edge", "11:31"), ("f", "12:02"),
    )]
    progress = ProgressLog()
    spark.streams.addListener(progress)
    try:
        frame = clean_stream(source(spark, feed(tmp_path / "in", batches)))
        query = start_query(frame, "late", "append", sinks.store_batches(str(tmp_path / "out")), str(tmp_path / "cp"), NOW)
        query.awaitTermination()
        progress.wait_ended([query.runId])
    finally:
        spark.streams.removeListener(progress)
    out = sinks.read_batches(spark, str(tmp_path / "out"), S.ORDERS)
    assert ids(out) == ["a", "b", "c", "f"]
    row = progress.summary(spark).first()
    assert (row["query"], row.input_rows, row.late_rows) == ("late", 6, 2)
    assert (row.min_event_time, row.max_event_time) == (at("10:00:00"), at("12:02:00"))
    assert row.batches >= 6 and row.rows_per_second > 0


def test_only_valid_rows_move_the_watermark(spark, tmp_path):
    batches = [[order("a", "10:00"), order(None, "15:00"), order("c", "13:00", status="cancelled")]]
    frame = clean_stream(source(spark, feed(tmp_path / "in", batches)))
    query = start_query(frame, "wm", "append", lambda batch, i: batch.count(), str(tmp_path / "cp"), NOW)
    query.awaitTermination()
    marks = [p.eventTime["watermark"] for p in query.recentProgress]
    assert max(marks).startswith("2026-01-01T12:30")


def test_restart_continues_and_replay_starts_over(spark, tmp_path):
    folder = tmp_path / "in"
    frame = clean_stream(source(spark, feed(folder, DEDUPE[:2])))
    first = collect(frame, "append", tmp_path / "cp", ["order_id"])
    feed(folder, [[order("o3", "11:02"), order("new", "11:03")]], first=2)
    again = filled(collect(frame, "append", tmp_path / "cp", ["order_id"]))
    assert list(again.values()) == [[("new",)]] and min(again) > max(filled(first))
    assert collect(frame, "append", tmp_path / "cp", ["order_id"]) == {}
    replay = collect(frame, "append", tmp_path / "fresh", ["order_id"])
    everything = [v for part in (first, again) for rows in part.values() for v in rows]
    assert sorted(v for rows in replay.values() for v in rows) == sorted(everything)


def test_replay_into_the_same_folder(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    frame = clean_stream(source(spark, feed(folder, DEDUPE[:2])))
    for _ in range(2):
        query = start_query(frame, "first", "append", sinks.store_batches(out), str(tmp_path / "cp"), NOW)
        query.awaitTermination()
        feed(folder, DEDUPE[2:], first=2)
    # A batch that no replay reaches.
    sinks.store_batches(out)(orders(spark, [order("stale")]), 99)
    replay_batches(frame, "again", out, str(tmp_path / "cp2"))
    found = values(sinks.read_batches(spark, out, S.ORDERS), "order_id", "product_id", "price")
    fresh = collect(frame, "append", tmp_path / "cp3", ["order_id", "product_id", "price"])
    assert found == sorted((v for rows in fresh.values() for v in rows), key=repr) and len(found) == 10


def test_state_survives_a_restart(spark, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    frame = clean_stream(source(spark, feed(folder, [[order("a", "10:00"), order("b", "10:20")]])))
    collect(frame, "append", checkpoint, ["order_id"], name="held")
    held = kept_state(spark, checkpoint, "held")
    assert values(held, "order_id", "expires_at") == [("a", at("10:30:00")), ("b", at("10:50:00"))]
    feed(folder, [[order("b", "10:21"), order("c", "10:55")]], first=1)
    seen = collect(frame, "append", checkpoint, ["order_id"], name="held")
    assert [v for rows in filled(seen).values() for v in rows] == [("c",)]
    assert values(kept_state(spark, checkpoint, "held"), "order_id") == [("a",), ("b",), ("c",)]


def append(frame, tmp_path, name="rows", **how):
    path = str(tmp_path / f"{name}-out")
    start_table(frame, name, path, str(tmp_path / "cp"), NOW, **how).awaitTermination()
    return path


def test_tables_take_each_batch_once(spark, tmp_path):
    folder = tmp_path / "in"
    frame = rejected_stream(source(spark, feed(folder, [[order(None), order("b", quantity=0)]])))
    path = append(frame, tmp_path, partition_by="reject_reason")
    # The commit of the last batch is lost: it runs again and must add nothing.
    (tmp_path / "cp" / "rows" / "commits" / "0").unlink()
    for crc in (tmp_path / "cp" / "rows" / "commits").glob(".0.crc"):
        crc.unlink()
    feed(folder, [[order("c", quantity=-1)]], first=1)
    append(frame, tmp_path, partition_by="reject_reason")
    # Files that the log does not name do not count.
    orders(spark, [order("ghost")]).write.parquet(f"{path}/reject_reason=invalid_values/x")
    ddl = f"{S.ORDERS}, reject_reason string"
    found = tables.read_table(spark, path, ddl, "reject_reason string")
    expected = [("b", "invalid_values"), ("c", "invalid_values"), (None, "missing_order_id")]
    assert values(found, "order_id", "reject_reason") == sorted(expected, key=repr)
    pruned = found.where("reject_reason = 'invalid_values'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reject_reason" in pruned
    again = tables.stream_table(spark, path, ddl)
    assert [len(v) for v in filled(collect(again, "append", tmp_path / "cp3", ["order_id"])).values()] == [3]


def test_nothing_appended_yet(spark, tmp_path):
    none = tables.read_table(spark, str(tmp_path / "none"), S.ORDERS)
    assert none.count() == 0 and none.columns == S.column_names(S.ORDERS)
    job = StreamTables(spark, str(tmp_path / "none"))
    for rows in (job.cleaned(), job.late_orders(), job.current_windows(), job.product_totals(), job.latest_snapshot()):
        assert rows.count() == 0
    later = tables.stream_table(spark, str(tmp_path / "later"), S.ORDERS)
    assert filled(collect(later, "append", tmp_path / "cp", ["order_id"])) == {}


def window_rows(spark, *products):
    return spark.createDataFrame(
        [(at("10:00:00"), at("10:10:00"), p, 1, 2.0) for p in products], sinks.WINDOWS
    )


def test_repeated_batches_replace_their_output(spark, tmp_path):
    rows = window_rows(spark, "p1")
    path = str(tmp_path / "out")
    store = sinks.store_batches(path, "product_id")
    for batch_id in (0, 1, 1, 1):
        store(rows, batch_id)
    ddl, column = f"{sinks.WINDOWS}, batch_id bigint", "product_id string"
    found = sinks.read_batches(spark, path, ddl, column)
    assert values(found, "batch_id", "product_id") == [(0, "p1"), (1, "p1")]
    # An empty repeat leaves nothing behind.
    store(rows.limit(0), 1)
    assert values(sinks.read_batches(spark, path, sinks.WINDOWS, column), "product_id") == [("p1",)]
    assert (tmp_path / "out" / "batch_id=0" / "product_id=p1").exists()


def totals_of(spark, **n):
    return spark.createDataFrame([(p, k, float(k)) for p, k in n.items()], sinks.TOTALS)


def test_deltas_are_merged_in_levels(spark, tmp_path):
    path = str(tmp_path / "totals")
    store = deltas.store_deltas(path, spark, sinks.TOTALS, ["product_id"], fanout=3)
    read = lambda: values(deltas.read_deltas(spark, path, sinks.TOTALS, ["product_id"]), "product_id", "total_orders")
    assert read() == []
    expected = {}
    for batch_id in range(11):
        changed = {f"p{batch_id % 4}": batch_id, "p9": 100 + batch_id}
        expected |= changed
        for _ in range(1 + batch_id % 2):
            store(totals_of(spark, **changed), batch_id)
        assert dict(read()) == expected
    runs = sorted(p.name for p in (tmp_path / "totals").iterdir())
    assert runs == ["run_000000000000_000000000008", "run_000000000009_000000000009", "run_000000000010_000000000010"]
    # A batch that is in a merged run already, and a merge that ended before its parts went.
    store(totals_of(spark, p9=-1), 5)
    sinks.write_parquet(totals_of(spark, p9=-1), f"{path}/run_000000000003_000000000005")
    assert dict(read()) == expected


def test_deltas_write_what_changed(spark, tmp_path):
    path = str(tmp_path / "totals")
    store = deltas.store_deltas(path, spark, sinks.TOTALS, ["product_id"])
    store(spark.range(50_000).selectExpr("concat('p', id) product_id", "id total_orders", "rand() total_revenue"), 0)
    size = lambda: sum(f.stat().st_size for f in (tmp_path / "totals").rglob("*.parquet"))
    whole = size()
    store(totals_of(spark, p7=1), 1)
    assert size() - whole < whole / 50


def test_upserts_replace_the_days_they_touch(spark, tmp_path):
    path, ddl = str(tmp_path / "days"), "day date, product_id string, n bigint"
    store = lambda: deltas.store_upserts(path, str(tmp_path / "staging"), spark, ddl, ["day", "product_id"], "day")
    batch = lambda *rows: spark.createDataFrame(rows, "d string, product_id string, n bigint").selectExpr(
        "CAST(d AS date) AS day", "product_id", "n"
    )
    read = lambda: values(spark.read.schema(ddl).parquet(path).selectExpr("string(day) d", "product_id", "n"), "d", "product_id", "n")
    store()(batch(("2026-01-01", "a", 1), ("2026-01-02", "a", 2)), 0)
    untouched = {f.name for f in (tmp_path / "days" / "day=2026-01-01").glob("*.parquet")}
    for _ in range(2):
        store()(batch(("2026-01-02", "a", 5), ("2026-01-02", "b", 6)), 1)
    assert read() == [("2026-01-01", "a", 1), ("2026-01-02", "a", 5), ("2026-01-02", "b", 6)]
    assert {f.name for f in (tmp_path / "days" / "day=2026-01-01").glob("*.parquet")} == untouched
    # The batch ended between taking the old day away and putting the new one in place.
    for f in (tmp_path / "days" / "day=2026-01-02").iterdir():
        f.unlink()
    store()(batch(("2026-01-02", "a", 5), ("2026-01-02", "b", 6)), 1)
    store()(batch(("2026-01-03", "c", 1)).limit(0), 2)
    assert read() == [("2026-01-01", "a", 1), ("2026-01-02", "a", 5), ("2026-01-02", "b", 6)]


def test_late_rows_are_stored(spark, tmp_path):
    batches = [[order(i, t)] for i, t in (
        ("a", "10:00"), ("b", "12:00"), ("c", "12:01"), ("late", "11:29"), ("edge", "11:30"), ("f", "12:02"),
    )]
    frame = source(spark, feed(tmp_path / "in", batches))
    path = str(tmp_path / "late")
    store = store_late_rows(path, spark, "30 minutes")
    calls = []

    def twice(batch, batch_id):
        for _ in range(2):
            calls.append(batch_id)
            store(batch, batch_id)

    start_query(frame, "late", "append", twice, str(tmp_path / "cp"), NOW).awaitTermination()
    kept = collect(clean_stream(frame), "append", tmp_path / "cp2", ["order_id"])
    late = ids(read_late_rows(spark, path))
    assert late == ["edge", "late"] and max(calls) == 5
    assert sorted(late + [v for rows in kept.values() for (v,) in rows]) == ["a", "b", "c", "edge", "f", "late"]


def test_stored_reasons_come_back(spark, tmp_path):
    rows = rejected_orders(orders(spark, [order(None), order("b", quantity=0)]))
    sinks.store_batches(str(tmp_path / "q"), "reject_reason")(rows, 0)
    found = sinks.read_batches(
        spark, str(tmp_path / "q"), f"{S.ORDERS}, reject_reason string", "reject_reason string"
    )
    assert values(found, *found.columns) == values(rows, *found.columns)


def test_incomplete_batches_are_not_read(spark, tmp_path):
    totals = spark.createDataFrame([("p1", 1, 2.0)], sinks.TOTALS)
    for batch_id in (0, 1):
        sinks.store_snapshots(str(tmp_path / "s"))(totals.withColumn("total_orders", F.lit(batch_id)), batch_id)
        sinks.store_batches(str(tmp_path / "b"))(totals.withColumn("total_orders", F.lit(batch_id).cast("long")), batch_id)
    (tmp_path / "s" / "batch_0001" / "_SUCCESS").unlink()
    (tmp_path / "b" / "batch_id=1" / "_SUCCESS").unlink()
    for found in (
        sinks.read_latest_snapshot(spark, str(tmp_path / "s")),
        sinks.read_latest_batch(spark, str(tmp_path / "b"), sinks.TOTALS),
        sinks.read_batches(spark, str(tmp_path / "b"), sinks.TOTALS),
    ):
        assert [r.total_orders for r in found.collect()] == [0]


def test_snapshots_may_be_limited(spark, tmp_path):
    store = sinks.store_snapshots(str(tmp_path / "s"), keep=2)
    for batch_id in range(4):
        store(spark.createDataFrame([("p1", batch_id, 2.0)], sinks.TOTALS), batch_id)
    assert sorted(p.name for p in (tmp_path / "s").iterdir()) == ["batch_0002", "batch_0003"]


def test_files_per_batch_are_bounded(spark, tmp_path):
    rows = [[order(f"o{i}", "10:00", f"p{i % 50}") for i in range(400)] + [order("end", "18:00")], [order("x", "18:01")]]
    frame = agg.windowed_revenue(clean_and_derive(source(spark, feed(tmp_path / "in", rows))))
    frame = frame.withColumn("window_date", F.to_date("window_start"))
    path = append(frame, tmp_path, partition_by="window_date", writers=3, state_partitions=16)
    # One day's rows are written by several tasks, but no more than asked for.
    assert [len(list((tmp_path / "rows-out").glob("window_date=*/*.parquet")))] == [3]
    assert tables.read_table(spark, path, sinks.WINDOWS).count() == 50
    append(frame.drop("window_date"), tmp_path, "together", partition_by="product_id", writers=3, together=True)
    assert {len(list(d.glob("*.parquet"))) for d in (tmp_path / "together-out").glob("product_id=*")} == {1}
    assert tables.default_writers(spark) >= 8


def test_console_handlers_skip_empty_batches(spark, capsys):
    totals = spark.createDataFrame([("p1", 1, 2.0), ("p2", 1, 3.0)], sinks.TOTALS)
    for handler in (sinks.show_rows(), sinks.show_top_products(1)):
        handler(totals.limit(0), 0)
    assert capsys.readouterr().out == ""
    sinks.show_top_products(1)(totals, 7)
    text = capsys.readouterr().out
    assert "batch 7" in text and "p2" in text and "p1" not in text


def test_snapshots_are_sorted_and_the_newest_wins(spark, tmp_path):
    path = str(tmp_path / "s")
    store = sinks.store_snapshots(path)
    totals = spark.createDataFrame([("p1", 1, 2.0), ("p2", 1, 3.0)], sinks.TOTALS)
    store(totals, 9_999)
    store(totals.withColumn("total_orders", F.lit(5)), 10_000)
    assert {r.total_orders for r in sinks.read_latest_snapshot(spark, path).collect()} == {5}
    files = list((tmp_path / "s" / "batch_9999").glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text().splitlines() == ["product_id,total_orders,total_revenue", "p2,1,3.0", "p1,1,2.0"]


def test_rejected_rows_keep_their_reason(spark, tmp_path):
    batches = [[order(None), order("a")], [order("b", quantity=0), order("c", quantity=None)]]
    frame = rejected_stream(source(spark, feed(tmp_path / "in", batches)))
    seen = collect(frame, "append", tmp_path / "cp", ["order_id", "reject_reason"])
    assert seen == {
        0: [(None, "missing_order_id")],
        1: [("b", "invalid_values"), ("c", "indeterminate_values")],
    }


def test_stream_equals_batch_on_one_micro_batch(spark, tmp_path):
    rng = random.Random(7)
    rows = [
        order(
            rng.choice([None, *(f"o{i}" for i in range(40))]), f"10:{rng.randrange(60):02d}",
            "p1", rng.choice([-1, 1, 2]), 2.0, rng.choice(["Done", "canceled", "pending"]),
        )
        for _ in range(120)
    ]
    # Copies of an order must agree but for their time: which one survives is open.
    rows = [
        r[:4] + (1 if r[0] and r[4] > 0 else r[4], 2.0, "canceled" if r[0] and r[0].endswith("3") else "Done")
        for r in rows
    ]
    frame = clean_and_derive(source(spark, feed(tmp_path / "in", [rows])))
    seen = collect(agg.product_totals(frame), "complete", tmp_path / "cp", ["product_id", "total_orders", "total_revenue"])
    kept = dedupe_orders(normalize_status(valid_orders(orders(spark, rows))))
    batch = agg.product_totals(derive_columns(split_cancelled(kept).active))
    assert seen[0] == values(batch, *batch.columns)


def lookup_stream(spark, tmp_path):
    customers = spark.createDataFrame([("c1", "Ann", None, "VIP", None)], S.CUSTOMERS)
    products = spark.createDataFrame([("p1", "Lamp", "Home", "BrandA", 9.5)], S.PRODUCTS)
    batches = [[order(f"o{i}", "10:00", "p1" if i % 2 else "p0", customer="c1" if i < 5 else None) for i in range(8)]]
    rows = clean_and_derive(source(spark, feed(tmp_path / "in", batches)))
    expected = sorted((f"o{i}", "Ann" if i < 5 else None, "Lamp" if i % 2 else None) for i in range(8))
    return rows, customers, products, expected


def test_stream_enrichment(spark, tmp_path):
    rows, customers, products, expected = lookup_stream(spark, tmp_path)
    frame = enrich_with_dimensions(rows, customers, products)
    assert frame.columns == S.ENRICHED_COLUMNS
    seen = collect(frame, "append", tmp_path / "cp", ["order_id", "customer_name", "product_name"])
    assert seen[0] == expected


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_enrichment_of_each_batch(spark, tmp_path, limit):
    rows, customers, products, expected = lookup_stream(spark, tmp_path)
    dims = check_dimension(customers, "customer_id"), check_dimension(products, "product_id")
    store, staging = sinks.store_batches(str(tmp_path / "out")), str(tmp_path / "staging")
    plans = []

    def seen(batch, batch_id):
        plans.append(batch._jdf.queryExecution().executedPlan().toString())
        store(batch, batch_id)

    handler = sinks.enriching(seen, *dims, staging, broadcast_limit=limit)
    query = start_query(rows, "enriching", "append", handler, str(tmp_path / "cp"), NOW)
    query.awaitTermination()
    out = sinks.read_batches(spark, str(tmp_path / "out"), "order_id string, customer_name string, product_name string")
    assert values(out, *out.columns) == expected
    assert plans and not any("Generate" in p for p in plans)
    assert all("AdaptiveSparkPlan" in p for p in plans)


def test_stream_meets_dimensions_of_any_size(spark):
    sf = "/root/testdata/sf0.001"
    small, large = catalog.stream_enrich(spark, sf), catalog.stream_enrich(spark, sf, broadcast_limit=0)
    assert small.columns == large.columns
    assert values(large, *large.columns) == values(small, *small.columns)


def test_whole_job(spark, tmp_path, capsys):
    folder = feed(tmp_path / "in", DEDUPE)
    lines = []
    job = run_file_stream(
        spark, folder, str(tmp_path / "out"), str(tmp_path / "cp"), max_files_per_trigger=1,
        names=(*ALL_QUERIES, "current_windows", "snapshots"), available_now=True, log=lines.append,
    )
    columns = ["product_id", "total_orders", "total_revenue"]
    assert values(job.product_totals(), *columns) == [("p1", 8, 642.0), ("p2", 2, 68.0)]
    assert values(job.latest_snapshot(), *columns) == values(job.product_totals(), *columns)
    assert job.cleaned().count() == 10
    closed = values(job.windowed_revenue(), "window_start", "product_id", "orders_count")
    assert set(closed) < set(values(job.current_windows(), "window_start", "product_id", "orders_count"))
    assert values(job.quarantine(), "order_id", "reject_reason") == [(None, "missing_order_id")]
    # As dropped by the cleaning query: every row is in one of the tables.
    assert job.late_orders().count() == 0
    counts = {r.batch_id: r for r in job.batches.where("query = 'clean'").collect()}
    assert [(counts[i].rows_in, counts[i].missing_order_id, counts[i].kept) for i in range(5)] == [
        (5, 1, 3), (2, 0, 1), (3, 0, 3), (1, 0, 1), (2, 0, 2)
    ]
    summary = {r["query"]: r for r in job.summary.collect()}
    assert set(summary) == {*ALL_QUERIES, "current_windows", "snapshots"}
    assert all(r.complete for r in summary.values())
    # The reports read the table of cleaned orders, the input was scanned for "clean" once.
    n_rows = sum(map(len, DEDUPE))
    assert {n: summary[n].input_rows for n in ("clean", "quarantine", "windowed_revenue")} == {
        "clean": n_rows, "quarantine": n_rows, "windowed_revenue": 10
    }
    printed = capsys.readouterr().out
    assert "top 10 products" in printed and "batch 0" in printed
    assert any("[product_totals] batch" in line for line in lines)
    assert not spark.streams.active


def test_one_query_deduplicates(spark, tmp_path):
    folder = feed(tmp_path / "in", DEDUPE)
    started = start_queries(
        source(spark, folder), str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True
    )
    wait_and_stop(started, all_must_end=True)
    state = {
        query.name: {op["operatorName"] for p in query.recentProgress for op in p.stateOperators}
        for query in started
    }
    assert {n for n, ops in state.items() if any("dedupe" in op for op in ops)} == {"clean"}
    assert {n for n, ops in state.items() if ops} == {"clean", "console", "windowed_revenue", "product_totals"}


def test_a_restarted_job_repeats_nothing(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    for first, last in ((0, 3), (3, 5)):
        rows = source(spark, feed(folder, DEDUPE[first:last], first))
        job = run_stream(rows, out, checkpoint, available_now=True)
    assert values(job.product_totals(), "product_id", "total_orders") == [("p1", 8), ("p2", 2)]
    assert sorted(r.order_id for r in job.cleaned().collect()).count("o3") == 1
    windows = job.windowed_revenue().groupBy("window_start", "product_id").count()
    assert windows.where("count > 1").count() == 0 and windows.count() > 0


def test_unknown_queries_are_refused(spark, stream, tmp_path):
    with pytest.raises(ValueError, match="nonsense"):
        start_queries(stream, str(tmp_path / "o"), str(tmp_path / "c"), names=("nonsense",))


def test_state_is_spread_as_asked(spark, stream, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    frame = clean_stream(stream)
    query = start_query(frame, "spread", "append", lambda b, i: b.count(), str(tmp_path / "cp"), NOW, 3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    query.awaitTermination()
    assert {op["numShufflePartitions"] for p in query.recentProgress for op in p.stateOperators} == {3}


def test_kafka_job_needs_the_connector(spark, tmp_path):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        run_kafka_stream(spark, "localhost:1", "orders", str(tmp_path / "o"), str(tmp_path / "c"))
    assert not spark.streams.active


def test_record_stream_keeps_dead_letters(spark, tmp_path):
    good = [order("a", "10:00", price=2.0), order("b", "10:01", price=3.0), order("a", "10:00", price=2.0)]
    payloads = encode_orders(orders(spark, good)).unionByName(
        spark.createDataFrame([(bytearray(b"{bad"),)], "value binary")
    )
    payloads.coalesce(1).write.parquet(str(tmp_path / "in"))
    records = spark.readStream.schema("value binary").parquet(str(tmp_path / "in"))
    tables = run_record_stream(records, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    assert values(tables.product_totals(), *sinks.column_names(sinks.TOTALS)) == [("p1", 2, 5.0)]
    assert values(tables.dead_letters(), "payload", "reason") == [("{bad", "malformed_json")]
    assert values(tables.quarantine(), "reject_reason") == [("missing_order_id",)]


def test_nothing_stored_yet(spark, tmp_path):
    assert sinks.read_latest_snapshot(spark, str(tmp_path / "none")).count() == 0
    assert sinks.read_latest_batch(spark, str(tmp_path / "none"), sinks.TOTALS).count() == 0


def test_triggered_queries_stop_after_the_timeout(spark, tmp_path):
    frame = source(spark, feed(tmp_path / "in", DEDUPE[:1]))
    queries = start_queries(frame, str(tmp_path / "out"), str(tmp_path / "cp"), names=("product_totals",))
    # The totals read the cleaned orders.
    assert [q.name for q in queries] == ["clean", "product_totals"]
    wait_and_stop(queries, timeout=6)
    assert not spark.streams.active


def test_a_failing_query_stops_the_others(spark, tmp_path):
    frame = clean_stream(source(spark, feed(tmp_path / "in", DEDUPE[:1])))

    def fail(batch, batch_id):
        raise RuntimeError("sink is full")

    started = [
        start_query(frame, "fine", "append", lambda b, i: b.count(), str(tmp_path / "cp"), {"processingTime": "1 hour"}),
        start_query(frame, "broken", "append", fail, str(tmp_path / "cp"), {"processingTime": "1 hour"}),
    ]
    with pytest.raises(StreamingQueryException):
        wait_and_stop(started, timeout=60)
    assert not spark.streams.active
