"""Joins, aggregates, files and the batch job."""

from __future__ import annotations

from datetime import date

import pytest
from helpers import at, order, orders, values
from pyspark.sql import functions as F

from orderflow import schema as S
from orderflow.operators import aggregates as agg
from orderflow.operators.derive import derive_columns
from orderflow.operators.enrich import (
    DuplicateKeyError,
    check_dimension,
    enrich_with_customers,
    enrich_with_dimensions,
    enriched_layout,
    hot_keys,
)
from orderflow.operators.metrics import stage_counts
from orderflow.operators.quality import rejected_orders
from orderflow.operators.reconcile import reconcile
from orderflow.plans import batch
from orderflow.plans.batch import open_batch, run_batch
from orderflow.plans.scratch import scratch_dir
from orderflow.settings import session_setting
from orderflow.sinks.files import (
    read_quarantine,
    rebalanced,
    write_cancelled_orders,
    write_parquet,
    write_quarantine,
)
from orderflow.sources.files import read_customers_csv, read_orders_csv, read_products_csv, write_csv
from orderflow.sources.retail import LINE_STATUSES, orders_raw

CUSTOMERS = [("c1", "Ann", "a@x", "VIP", "2025-01-01"), ("c2", "Bob", None, "Basic", None), (None, "?", None, None, None)]
PRODUCTS = [("p1", "Lamp", "Home", "BrandA", 9.5), ("p2", "Pen", "Office", "BrandB", 1.0)]


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(CUSTOMERS, S.CUSTOMERS)


@pytest.fixture
def products(spark):
    return spark.createDataFrame(PRODUCTS, S.PRODUCTS)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def lookup_rows(spark):
    rows = [order(f"o{i}", customer="c1" if i % 3 else "c2", product=f"p{i % 4}") for i in range(40)]
    return derive_columns(orders(spark, [*rows, order("n", customer=None, product=None)]))


def test_unmatched_orders_stay(spark, customers, products):
    frame = enrich_with_dimensions(lookup_rows(spark), customers, products)
    assert frame.columns == S.ENRICHED_COLUMNS
    assert frame.count() == 41
    missing = frame.filter("product_id in ('p0', 'p3') or product_id is null")
    assert {r.product_name for r in missing.collect()} == {None}
    assert values(frame.filter("order_id = 'n'"), "customer_name", "brand") == [(None, None)]
    assert values(frame.filter("order_id = 'o1'"), "customer_name", "product_name") == [("Ann", "Lamp")]


def test_duplicate_dimension_keys_are_refused(spark):
    twice = spark.createDataFrame([CUSTOMERS[0], CUSTOMERS[0]], S.CUSTOMERS)
    with pytest.raises(DuplicateKeyError, match="'c1' occurs 2 times"):
        check_dimension(twice, "customer_id")


def test_null_dimension_keys_may_repeat(spark):
    nobody = spark.createDataFrame([CUSTOMERS[2], CUSTOMERS[2]], S.CUSTOMERS)
    assert check_dimension(nobody, "customer_id").rows == 2


def test_dimension_size_bounds_the_choice_of_join(spark, customers, products):
    frame = lookup_rows(spark)
    small = enrich_with_customers(frame, customers)
    assert "BroadcastHashJoin" in plan_of(small) and "SortMergeJoin" not in plan_of(small)
    large = enrich_with_customers(frame, customers, broadcast_limit=0)
    assert "SortMergeJoin" in plan_of(large)
    both = enrich_with_dimensions(frame, customers, products)
    spread = enrich_with_dimensions(frame, customers, products, broadcast_limit=0)
    assert values(spread, *spread.columns) == values(both, *both.columns)


def test_hot_keys_are_the_frequent_ones(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))
    frame = spark.range(0, 20_000, 1, 8).select(key.alias("customer_id"), F.lit(None).cast("string").alias("product_id"))
    assert hot_keys(frame, "customer_id", "product_id", share=0.01) == {"customer_id": ["hot"], "product_id": []}
    assert hot_keys(frame, "customer_id") == {"customer_id": ["hot"]}
    assert hot_keys(frame.limit(0), "customer_id") == {"customer_id": []}


def test_hot_key_join_on_a_skewed_table(spark):
    key = F.when(F.col("id") % 3 == 0, "c7").otherwise(F.concat(F.lit("c"), F.col("id") % 500))
    frame = spark.range(0, 6_000, 1, 4).select("id", F.when(F.col("id") % 10 != 0, key).alias("customer_id"))
    dim = spark.range(450).select(
        F.concat(F.lit("c"), "id").alias("customer_id"), F.concat(F.lit("n"), "id").alias("customer_name")
    )
    small = enrich_with_customers(frame, dim)
    expected = values(small, *small.columns)
    assert len(expected) == 6_000
    for hot in (None, {"customer_id": []}, {"customer_id": ["c7", "c8", "absent"]}):
        large = enrich_with_customers(frame, dim, broadcast_limit=0, hot=hot)
        assert values(large, *large.columns) == expected


def test_hot_rows_stay_out_of_the_shuffle(spark):
    frame = spark.range(4_000).select("id", F.when(F.col("id") % 4 != 0, F.lit("c7")).alias("customer_id"))
    dim = spark.createDataFrame([("c7", "n7"), ("c8", "n8")], "customer_id string, customer_name string")
    large = enrich_with_customers(frame, dim, broadcast_limit=0, hot={"customer_id": ["c7"]})
    plan = plan_of(large)
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
    assert large.count() == 4_000
    cold = plan[plan.index("SortMergeJoin") : plan.index("BroadcastHashJoin")]
    assert "isnotnull" in cold.lower() or "IN (c7)" in cold or "= c7" in cold


def test_rows_that_are_not_looked_up_stay_out_of_the_shuffle(spark):
    frame = spark.range(400).select("id", F.concat(F.lit("c"), F.col("id") % 9).alias("customer_id"))
    dim = spark.createDataFrame([(f"c{i}", f"n{i}") for i in range(8)], "customer_id string, customer_name string")
    only = F.when(F.col("id") % 5 != 0, F.col("id") % 2 == 0)
    for hot in ([], ["c7"]):
        how = {"only": only, "hot": {"customer_id": hot}}
        small, large = enrich_with_customers(frame, dim, **how), enrich_with_customers(frame, dim, broadcast_limit=0, **how)
        assert values(large, *large.columns) == values(small, *small.columns)
        # The condition is met by every row that the sorted join gets.
        joins = [line for line in plan_of(large).splitlines() if "SortMergeJoin" in line]
        assert len(joins) == 1 and "% 2" not in joins[0]


def test_orders_of_large_lookups_are_made_once(spark, customers, products):
    frame = lookup_rows(spark).distinct()
    both = enrich_with_dimensions(frame, customers, products)
    assert "HashAggregate" in plan_of(both)
    for large in (
        enrich_with_dimensions(frame, customers, products, broadcast_limit=0),
        enrich_with_customers(frame, customers, broadcast_limit=0),
    ):
        assert "HashAggregate" not in plan_of(large)
        assert values(large, "order_id") == values(both, "order_id")


def test_large_dimension_of_a_stream_is_refused(spark, customers):
    stream = spark.readStream.format("rate").load().select(F.lit("c1").alias("customer_id"))
    with pytest.raises(ValueError, match="enrich its batches"):
        enrich_with_customers(stream, customers, broadcast_limit=0)


def test_only_limits_the_lookup(spark, customers):
    frame = enrich_with_customers(lookup_rows(spark), customers, only=F.col("order_id") == "o1")
    assert values(frame.filter("customer_name is not null"), "order_id") == [("o1",)]


def revenue_rows(spark):
    return derive_columns(orders(spark, [
        order("a", "10:00:00", "p1", 2, 5.0), order("b", "10:30:00", "p2", 1, 10.0),
        order("c", "11:00:00", "p1", 1, 1.0), order(None, "11:00:00", "p3", 1, 2.0),
        order("d", None, None, 1, 7.0), order("e", "12:00:00", "p4", None, 7.0),
    ]))


def test_daily_hourly_and_product_revenue(spark):
    rows = revenue_rows(spark)
    day = at("00:00:00").date()
    assert [tuple(r) for r in agg.daily_revenue(rows).collect()] == [(None, 1, 7.0), (day, 4, 23.0)]
    assert [tuple(r) for r in agg.hourly_revenue(rows).collect()] == [
        (None, 1, 7.0), (10, 2, 20.0), (11, 1, 3.0), (12, 1, None),
    ]
    assert [tuple(r) for r in agg.product_revenue(rows).collect()] == [
        ("p1", 2, 11.0), ("p2", 1, 10.0), (None, 1, 7.0), ("p3", 0, 2.0), ("p4", 1, None),
    ]


def test_top_products_break_ties_and_use_top_k(spark):
    rows = derive_columns(orders(spark, [order(p, product=p, price=5.0) for p in ("p3", "p1", "p2")]))
    top = agg.top_products(rows, 2)
    assert [r.product_id for r in top.collect()] == ["p1", "p2"]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_rollup_equals_the_separate_reports(spark):
    rows = revenue_rows(spark).filter("order_id is not null")
    rollup = agg.revenue_rollup(rows)
    for key in agg.REVENUE_KEYS:
        part = agg.rollup_part(rollup, key)
        assert values(part, *part.columns) == values(agg.revenue_by(rows, key), *part.columns)


def test_windowed_revenue(spark):
    frame = agg.windowed_revenue(revenue_rows(spark))
    assert frame.columns == ["window_start", "window_end", "product_id", "orders_count", "total_revenue"]
    assert values(frame.filter("product_id = 'p1'"), "window_start", "window_end", "orders_count", "total_revenue") == [
        (at("10:00:00"), at("10:10:00"), 1, 10.0), (at("11:00:00"), at("11:10:00"), 1, 1.0),
    ]
    assert frame.filter("window_start is null").count() == 0


def test_reconcile_reports_both_directions(spark):
    ddl = "product_id string, total_orders bigint, total_revenue double"
    batch = spark.createDataFrame([("p1", 2, 4.0), ("p2", 1, 1.0), (None, 1, 3.0)], ddl)
    stream = spark.createDataFrame([("p1", 2, 4.0), ("p3", 5, 6.0), (None, 2, 3.0)], ddl)
    assert values(reconcile(batch, stream), "product_id", "orders_diff", "revenue_diff") == [
        ("p1", 0, 0.0), ("p2", -1, -1.0), ("p3", 5, 6.0), (None, 1, 0.0),
    ]


# --- files ------------------------------------------------------------------


def test_csv_parsing(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "order_id,customer_id,product_id,order_timestamp,quantity,price,status\n"
        "o1,c1,p1,2026-01-01 10:00:00,2,1.5, Done \n"
        "o2,c1,p1,garbage,x,1.5,done\n"
        "o3,c1,p1,2026-01-01 10:00:00,2.0,1,done\n"
        ",c1,p1,2026-01-01 10:00:00,1,1,done\n"
    )
    (tmp_path / "b.csv").write_text("order_id,customer_id,product_id,order_timestamp,quantity,price,status\no5,c1\n")
    (tmp_path / "notes.txt").write_text("not,an,order\n")
    frame = read_orders_csv(spark, str(tmp_path))
    assert values(frame, "order_id", "order_timestamp", "quantity", "status") == [
        ("o1", at("10:00:00"), 2, " Done "), ("o2", None, None, "done"),
        ("o3", at("10:00:00"), None, "done"), ("o5", None, None, None),
        (None, at("10:00:00"), 1, "done"),
    ]


def test_dimension_csv(spark, customers, products, tmp_path):
    write_csv(customers, str(tmp_path / "c"))
    write_csv(products, str(tmp_path / "p"))
    read = read_customers_csv(spark, str(tmp_path / "c"))
    assert read.dtypes == customers.dtypes and values(read, *read.columns) == values(customers, *read.columns)
    read = read_products_csv(spark, str(tmp_path / "p"))
    assert read.dtypes == products.dtypes and values(read, *read.columns) == values(products, *read.columns)


def test_csv_keeps_whole_times(spark, tmp_path):
    frame = orders(spark, [order("a", "10:00:00"), order("b", "10:00:00.123456"), order("c", None)])
    write_csv(frame, str(tmp_path / "o"))
    back = read_orders_csv(spark, str(tmp_path / "o"))
    assert values(back, *back.columns) == values(frame, *frame.columns)
    text = "".join(f.read_text() for f in (tmp_path / "o").glob("*.csv"))
    assert "2026-01-01 10:00:00," in text


def test_overwrite_leaves_no_stale_rows(spark, tmp_path):
    path = str(tmp_path / "q")
    frame = rejected_orders(orders(spark, [order(None), order("b", quantity=0), order("c")]))
    write_quarantine(frame, path)
    assert values(read_quarantine(spark, path), "reject_reason") == [("invalid_values",), ("missing_order_id",)]
    write_quarantine(frame.filter("reject_reason = 'invalid_values'"), path)
    assert read_quarantine(spark, path).count() == 1
    write_quarantine(frame.limit(0), path)
    assert read_quarantine(spark, path).count() == 0


def test_quarantine_by_single_reason(spark, tmp_path):
    frame = orders(spark, [order(None)])
    write_quarantine(frame, str(tmp_path), "missing_order_id")
    assert spark.read.parquet(str(tmp_path / "missing_order_id")).columns == frame.columns


def test_cancelled_orders_by_day_and_partition_pruning(spark, tmp_path):
    path = str(tmp_path / "cancelled")
    frame = derive_columns(orders(spark, [order("a", status="cancelled"), order("b", None, status="cancelled")]))
    write_cancelled_orders(frame, path)
    read = spark.read.schema(frame.schema).parquet(path)
    assert values(read, "order_id", "order_date") == [("a", at("00:00:00").date()), ("b", None)]
    assert "PartitionFilters: [isnotnull(order_date" in plan_of(read.filter("order_date = date'2026-01-01'"))


def test_write_restores_the_session_setting(spark, tmp_path):
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key)
    write_parquet(spark.range(3), str(tmp_path / "x"), mode="append", min_partition_size="64KB")
    write_parquet(spark.range(3), str(tmp_path / "x"), mode="append")
    assert spark.conf.get(key) == before
    assert spark.read.parquet(str(tmp_path / "x")).count() == 6


def test_scratch_folder_follows_the_session(spark):
    assert scratch_dir(spark, "a") != scratch_dir(spark, "a")
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert scratch_dir(spark, "a").startswith(root)


# --- the batch job ----------------------------------------------------------

RAW = [
    order(None), order("bad", quantity=-1), order("dim", quantity=None),
    order("a", "10:05:00", "p1", 2, 5.0, "Done"), order("a", "10:00:00", "p1", 2, 5.0, "Done"),
    order("b", "11:00:00", "p2", 1, 3.0, " pending"), order("x", "11:00:00", "p2", 1, 3.0, "Canceled"),
    order("u", "11:00:00", "p2", 1, 3.0, None), order("z", None, "p9", 1, 4.0, "done", "c9"),
]


@pytest.mark.parametrize("limit", [64 * 1024 * 1024, 0])
def test_batch_job(spark, customers, products, tmp_path, limit):
    raw = orders(spark, RAW)
    tables = run_batch(raw, customers, products, str(tmp_path), broadcast_limit=limit)
    day = at("00:00:00").date()
    assert values(tables.quarantine(), "order_id", "reject_reason") == [
        ("bad", "invalid_values"), ("dim", "indeterminate_values"), (None, "missing_order_id"),
    ]
    assert tables.orders().columns == S.ENRICHED_COLUMNS
    assert values(tables.orders(), "order_id", "order_timestamp", "customer_name", "category") == [
        ("a", at("10:00:00"), "Ann", "Home"), ("b", at("11:00:00"), "Ann", "Office"), ("z", None, None, None),
    ]
    assert len(tables.cancelled().columns) == 11
    assert values(tables.cancelled(), "order_id", "total_amount", "order_date") == [("x", 3.0, day)]
    cancelled = tables.all_orders().filter("order_class = 'cancelled'")
    assert values(cancelled, "customer_name", "brand") == [(None, None)]
    assert {tuple(r) for r in tables.daily_revenue().collect()} == {(None, 1, 4.0), (day, 2, 13.0)}
    assert [tuple(r) for r in tables.top_products(2).collect()] == [("p1", 1, 10.0), ("p9", 1, 4.0)]
    assert values(tables.hourly_revenue(), "hour_of_day", "total_orders") == [(10, 1), (11, 1), (None, 1)]
    counts = dict(values(tables.stage_counts(), "stage", "n_rows"))
    direct = dict(values(stage_counts(raw), "stage", "n_rows"))
    assert counts == {**direct, "customers": 3, "products": 2}
    assert counts["input"] == len(RAW) and counts["duplicates"] == 1


def test_large_lookups_move_no_column_that_can_be_derived(spark, customers, products, tmp_path, monkeypatch):
    moved = []

    def lay_out(frame, keys):
        moved.extend(frame.columns)
        return rebalanced(frame, keys)

    monkeypatch.setattr(batch, "rebalanced", lay_out)
    tables = run_batch(orders(spark, RAW), customers, products, str(tmp_path), broadcast_limit=0)
    derived = {"order_day_of_week", "hour_of_day", "total_amount", "order_class"}
    assert "brand" in moved and not derived & set(moved)
    kept = spark.read.parquet(*map(str, tmp_path.glob("run-*/kept"))).columns
    assert sorted(kept) == sorted([*S.column_names(S.ORDERS), "n_copies"])
    written = tables.all_orders()
    again = derive_columns(written.drop(*S.column_names(S.DERIVED)))
    assert values(again, *written.columns) == values(written, *written.columns)


def test_order_lines_meet_their_owner_without_the_supplier(spark, tmp_path):
    line = (1, 2, 3, 7, date(1995, 3, 4), 5.0, 20.0)
    columns = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate date, l_quantity double, l_extendedprice double"
    lines = spark.createDataFrame([line, (8, 1, 4, 8, None, 2.0, 9.0)], columns)
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    owners = spark.createDataFrame([(1, 6)], "o_orderkey long, o_custkey long")
    owners.write.parquet(str(tmp_path / "orders.parquet"))
    raw = orders_raw(spark, str(tmp_path))
    assert values(raw, "order_id", "customer_id", "quantity", "price", "status") == [
        ("o1-2", "c6", -5, -20.0, LINE_STATUSES[3]), ("o8-1", None, 2, 9.0, LINE_STATUSES[9]),
    ]
    above, below = raw._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter")
    # The sign is set below the join.
    assert "AS price" in below and "l_suppkey" not in above


def test_batch_job_without_any_order(spark, customers, products, tmp_path):
    tables = run_batch(orders(spark, []), customers, products, str(tmp_path))
    counts = dict(values(tables.stage_counts(), "stage", "n_rows"))
    assert {v for k, v in counts.items() if k not in ("customers", "products")} == {0}


def test_second_run_replaces_the_first(spark, customers, products, tmp_path):
    run_batch(orders(spark, RAW), customers, products, str(tmp_path))
    tables = run_batch(orders(spark, [order("only")]), customers, products, str(tmp_path), shuffle_partitions=2)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert values(tables.orders(), "order_id") == [("only",)]
    assert tables.quarantine().count() == 0 and tables.cancelled().count() == 0
    assert enriched_layout(tables.orders()).count() == 1


def test_readers_see_the_tables_of_one_run(spark, customers, products, tmp_path, monkeypatch):
    output = str(tmp_path / "out")
    assert open_batch(spark, output) is None
    run_batch(orders(spark, RAW), customers, products, output)
    before = open_batch(spark, output)
    expected = values(before.orders(), "order_id"), values(before.stage_counts(), "stage", "n_rows")
    written = []

    def breaks(frame, path, *rest, **how):
        written.append(path)
        if path.endswith("daily_revenue"):
            raise RuntimeError("the cluster is gone")
        write_parquet(frame, path, *rest, **how)

    # The order table and the roll-up of this run are written, the reports are not.
    monkeypatch.setattr(batch, "write_parquet", breaks)
    with pytest.raises(RuntimeError):
        run_batch(orders(spark, [order("only")]), customers, products, output)
    assert any(path.endswith("revenue_rollup") for path in written)
    found = open_batch(spark, output)
    assert (values(found.orders(), "order_id"), values(found.stage_counts(), "stage", "n_rows")) == expected
    monkeypatch.undo()
    run_batch(orders(spark, [order("only")]), customers, products, output)
    assert values(open_batch(spark, output).orders(), "order_id") == [("only",)]
    # The tables that a reader holds are still there, those of the broken run are not.
    assert values(found.orders(), "order_id") == expected[0]
    assert len(list((tmp_path / "out").glob("run-*"))) == 2
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_file() and not p.name.startswith(".")} == {"CURRENT"}
