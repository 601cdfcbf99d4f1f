"""Row-wise operators, splits and deduplication on small frames."""

from __future__ import annotations

import itertools
import random

from helpers import at, ids, order, orders, values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderflow import schema as S
from orderflow.operators.dedupe import dedupe_orders
from orderflow.operators.derive import classify_orders, derive_columns, normalize_status
from orderflow.operators.metrics import event_stats, stage_counts
from orderflow.operators.quality import (
    rejected_orders,
    split_cancelled,
    split_missing_id,
    split_values,
    valid_orders,
)

VALUE_ROWS = [
    order("a", quantity=1, price=1.0),
    order("b", quantity=None, price=1.0),
    order("c", quantity=None, price=-1.0),
    order("d", quantity=0, price=None),
    order("e", quantity=5, price=None),
    order("f", quantity=0, price=0.0),
    order("g", quantity=1, price=0.0),
    order("h", quantity=1, price=float("nan")),
    order("i", quantity=None, price=None),
]

STATUS_SPELLINGS = [
    "completed", "Completed", "COMPLETED", "Complete", "cancelled", "Cancelled", "CANCELLED", "canceled",
    "pending", "Pending", "PENDING", "processing", "Processing", "PROCESSING", "Done", "done",
]


def test_missing_id_split(spark):
    split = split_missing_id(orders(spark, [order("a"), order(None), order("")]))
    assert ids(split.valid) == ["", "a"]
    assert split.missing.count() == 1


def test_value_split_accounts_for_unknowns(spark):
    split = split_values(orders(spark, VALUE_ROWS))
    assert ids(split.valid) == ["a", "g", "h"]
    assert ids(split.invalid) == ["c", "d", "f"]
    assert ids(split.indeterminate) == ["b", "e", "i"]


def test_reject_reasons_agree_with_the_splits(spark):
    frame = orders(spark, [*VALUE_ROWS, order(None, quantity=-1)])
    assert ids(valid_orders(frame)) == ["a", "g", "h"]
    reasons = dict(values(rejected_orders(frame), "order_id", "reject_reason"))
    assert reasons == {
        None: S.MISSING_ORDER_ID,
        **dict.fromkeys("cdf", S.INVALID_VALUES),
        **dict.fromkeys("bei", S.INDETERMINATE_VALUES),
    }


def test_status_words(spark):
    words = {
        "Done": "completed",
        " done ": "completed",
        "Complete": "completed",
        "COMPLETED": "completed",
        "canceled": "cancelled",
        "CANCELLED": "cancelled",
        "Pending": "pending",
        "\tdone": "\tdone",
        "refunded": "refunded",
        None: None,
    }
    frame = orders(spark, [order(repr(w), status=w) for w in words])
    assert dict(values(normalize_status(frame), "order_id", "status")) == {
        repr(w): n for w, n in words.items()
    }


def test_all_known_spellings_become_valid_statuses(spark):
    frame = orders(spark, [order(w, status=w) for w in STATUS_SPELLINGS])
    assert {s for (s,) in values(normalize_status(frame), "status")} == {"completed", "cancelled", "pending", "processing"}


def test_cancelled_split_and_class(spark):
    frame = orders(spark, [order("a"), order("b", status="cancelled"), order("c", status=None)])
    split = split_cancelled(frame)
    assert [ids(part) for part in split] == [["a"], ["b"], ["c"]]
    classes = dict(values(classify_orders(frame), "order_id", "order_class"))
    assert classes == {"a": S.ACTIVE, "b": S.CANCELLED, "c": S.UNCLASSIFIED}


def test_derived_columns(spark):
    frame = derive_columns(orders(spark, [order("a", "23:59:59", quantity=3, price=2.5), order("b", None)]))
    assert frame.dtypes[-4:] == [
        ("order_date", "date"),
        ("order_day_of_week", "int"),
        ("hour_of_day", "int"),
        ("total_amount", "double"),
    ]
    rows = {r.order_id: r for r in frame.collect()}
    assert (rows["a"].order_date, rows["a"].order_day_of_week) == (at("00:00:00").date(), 5)
    assert (rows["a"].hour_of_day, rows["a"].total_amount) == (23, 7.5)
    assert rows["b"].order_date is None and rows["b"].hour_of_day is None


def test_dedupe_keeps_the_first_event(spark):
    frame = orders(spark, [
        order("a", "10:02:00", "p1"), order("a", "10:00:00", "p2"),
        order("b", "10:00:00", "p2"), order("b", "10:00:00", "p1"),
        order("c", None, "p1"), order("c", "11:00:00", "p9"),
        order("d", None, "p3"),
    ])
    kept = dedupe_orders(frame, copies="n")
    assert kept.columns == [*frame.columns, "n"]
    assert values(kept, "order_id", "product_id", "n") == [
        ("a", "p2", 2), ("b", "p1", 2), ("c", "p9", 2), ("d", "p3", 1),
    ]


def test_dedupe_after_the_value_filter_keeps_the_valid_copy(spark):
    frame = orders(spark, [order("a", "09:59:00", quantity=-1), order("a", "10:00:00")])
    assert values(dedupe_orders(valid_orders(frame)), "order_timestamp") == [(at("10:00:00"),)]


def test_dedupe_ignores_how_rows_are_spread(spark):
    rows = [order(f"o{i % 7}", f"10:{i % 5:02d}:00", f"p{i % 3}", quantity=i % 4 + 1) for i in range(60)]
    expected = None
    for seed, parts in itertools.product((1, 2), (1, 5)):
        random.Random(seed).shuffle(rows)
        kept = dedupe_orders(orders(spark, rows).repartition(parts))
        actual = values(kept, *kept.columns)
        expected = expected or actual
        assert actual == expected
    again = dedupe_orders(kept)
    assert values(again, *kept.columns) == expected


def test_one_id_with_a_third_of_all_rows_ships_one_row_per_task(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("o"), F.col("id")))
    frame = spark.range(0, 30_000, 1, 6).select(
        hot.alias("order_id"), F.lit("c1").alias("customer_id"), F.lit("p1").alias("product_id"),
        F.timestamp_seconds(F.col("id")).alias("order_timestamp"),
        F.lit(1).alias("quantity"), F.lit(1.0).alias("price"), F.lit("done").alias("status"),
    )
    kept = dedupe_orders(frame, copies="n")
    assert kept.count() == 20_001
    assert values(kept.filter("order_id = 'hot'"), "n") == [(10_000,)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and plan.count("Exchange") == 1


def test_valid_filter_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    orders(spark, VALUE_ROWS).write.parquet(path)
    plan = valid_orders(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    for part in ("IsNotNull(order_id)", "GreaterThan(quantity,0)", "GreaterThanOrEqual(price,0.0)"):
        assert part in plan


def test_event_stats(spark):
    row = event_stats(orders(spark, [order("a", "10:00:00"), order("b", "12:00:00"), order("c", None)])).first()
    assert tuple(row) == (3, at("10:00:00"), at("12:00:00"))


maybe = st.one_of
ROWS = st.lists(
    st.builds(
        order,
        maybe(st.none(), st.sampled_from(["o1", "o2", "o3"])),
        st.sampled_from(["10:00:00", "10:01:00", None]),
        st.sampled_from(["p1", "p2", None]),
        maybe(st.none(), st.integers(-1, 2)),
        maybe(st.none(), st.sampled_from([-1.0, 0.0, 2.5])),
        maybe(st.none(), st.sampled_from(["Done", " CANCELED ", "pending"])),
    ),
    max_size=12,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS)
def test_every_row_is_accounted_for(spark, rows):
    counts = dict(values(stage_counts(orders(spark, rows)), "stage", "n_rows"))
    assert counts["input"] == len(rows)
    parts = [
        S.MISSING_ORDER_ID, S.INVALID_VALUES, S.INDETERMINATE_VALUES,
        "duplicates", S.CANCELLED, S.UNCLASSIFIED, S.ACTIVE,
    ]
    assert sum(counts[p] for p in parts) == len(rows)
    assert counts["before_dedupe"] - counts["duplicates"] == counts["after_dedupe"]
