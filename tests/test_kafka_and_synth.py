"""Record encoding and the data generators."""

from __future__ import annotations

import math

import pyspark
import pytest
from helpers import at, order, orders, values
from pyspark.sql import functions as F

from orderflow import schema as S
from orderflow.operators import synth
from orderflow.plans import catalog
from orderflow.sources import kafka
from orderflow.sources.files import read_orders_csv


def records(spark, *payloads):
    rows = [(i, None if p is None else bytearray(p.encode())) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "offset bigint, value binary")


GOOD = '{"order_id": "o1", "order_timestamp": "2026-01-01 10:00:00", "quantity": 2, "price": 3.5, "status": "done"}'
PAYLOADS = [
    GOOD,
    '{"order_id": NaN, "quantity": 2, "price": 3.5}',
    '{"order_id": null, "quantity": 2.0, "price": NaN}',
    "{bad",
    '{"order_id": "o1", "quantity": "x"}',
    '{"order_id": "o2", "order_timestamp": "garbage", "quantity": 1}',
    None,
]


def test_decode(spark):
    frame = kafka.decode_orders(records(spark, *PAYLOADS))
    assert frame.dtypes == orders(spark, []).dtypes
    rows = frame.collect()
    assert (rows[0].order_id, rows[0].order_timestamp, rows[0].quantity) == ("o1", at("10:00:00"), 2)
    assert (rows[1].order_id, rows[1].quantity) == (None, 2)
    assert rows[2].quantity is None and math.isnan(rows[2].price)
    assert set(rows[3]) == {None} and set(rows[6]) == {None}
    assert (rows[4].order_id, rows[4].quantity) == ("o1", None)
    assert (rows[5].order_id, rows[5].order_timestamp) == ("o2", None)


def test_dead_letters(spark):
    payloads = [
        *PAYLOADS, "", "   ", GOOD + " trailing", GOOD + GOOD, GOOD + "," + GOOD, "{}", "[]", "5",
        '{"Order_ID": "o6"}', '{"order_id": NaN}',
    ]
    found = values(kafka.dead_letters(records(spark, *payloads), "offset"), "offset", "payload", "reason")
    reasons = {offset: reason for offset, _, reason in found}
    last = reasons.pop(13), reasons.pop(14)
    assert set(last) <= {"no_known_field", "malformed_json"}
    assert reasons == {
        2: "malformed_json", 3: "malformed_json", 4: "malformed_json", 5: "bad_timestamp", 6: "empty",
        7: "empty", 8: "empty", 9: "trailing_content", 10: "trailing_content", 11: "trailing_content",
        12: "no_known_field", 15: "no_known_field",
    }
    assert all(payload == payloads[i] for i, payload, _ in found)


def test_round_trip_keeps_every_value(spark):
    frame = orders(spark, [
        order("a", quantity=None, price=float("nan"), status=' q"uoted '), order(None, None), order("b", "10:00:00.120000"),
    ])
    back = kafka.decode_orders(kafka.encode_orders(frame))
    assert repr(values(back, *back.columns)) == repr(values(frame, *frame.columns))


def test_record_key_is_optional(spark):
    frame = orders(spark, [order("a")])
    assert kafka.encode_orders(frame).columns == ["value"]
    keyed = kafka.encode_orders(frame, key="order_id")
    assert keyed.dtypes == [("key", "binary"), ("value", "binary")]


def test_source_options():
    options = kafka.source_options("host:9092", "orders")
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "orders",
        "startingOffsets": "earliest", "failOnDataLoss": "false",
    }
    more = kafka.source_options("h", "t", group_id="g", max_offsets_per_trigger=5)
    assert (more["kafka.group.id"], more["maxOffsetsPerTrigger"]) == ("g", "5")
    assert kafka.connector_package().endswith(f"_2.13:{pyspark.__version__}")


@pytest.fixture(scope="module")
def made(spark):
    return synth.synth_orders(spark.range(1, 20_001)).cache()


def test_orders_stay_in_their_domains(spark, made):
    assert made.dtypes == orders(spark, []).dtypes
    low, high = "timestamp'2026-01-01'", "timestamp'2026-01-31'"
    good = made.filter(
        f"quantity between 1 and 10 and price between 5 and 500 and order_timestamp between {low} and {high}"
    )
    assert good.count() == 20_000 and made.select("order_id").distinct().count() == 20_000
    assert made.select("customer_id").distinct().count() == 1000
    assert made.select("product_id").distinct().count() == 50
    assert {r.status for r in made.select("status").distinct().collect()} == set(synth.ORDER_STATUSES)


def test_same_seed_same_rows_however_spread(spark, made):
    again = synth.synth_orders(spark.range(1, 20_001, 1, 3).repartition(7))
    assert again.exceptAll(made).isEmpty()
    assert not synth.synth_orders(spark.range(1, 101), seed=7).exceptAll(made).isEmpty()


def near(value, rate, total=20_000):
    return abs(value / total - rate) < 4 * math.sqrt(rate / total)


def test_defect_rates(made):
    doubled = synth.inject_duplicates(made)
    assert near(doubled.count() - 20_000, 0.02)
    gaps = doubled.groupBy("order_id").agg(
        (F.max("order_timestamp").cast("long") - F.min("order_timestamp").cast("long")).alias("gap")
    ).filter("gap > 0").agg(F.min("gap"), F.max("gap")).first()
    assert 10 <= gaps[0] <= gaps[1] <= 300
    assert near(synth.inject_negative(made, "quantity").filter("quantity < 0").count(), 0.05)
    assert near(synth.inject_negative(made, "price").filter("price < 0").count(), 0.05)
    late = synth.inject_late(made).withColumn(
        "back", (F.col("arrival_time").cast("long") - F.col("order_timestamp").cast("long")) / 60
    ).filter("back > 0")
    assert near(late.count(), 0.05)
    assert late.filter("back < 1 or back > 60").isEmpty()
    assert near(synth.inject_missing_id(made).filter("order_id is null").count(), 0.01)


def test_dimensions(spark):
    customers = synth.synth_customers(spark.range(1, 201))
    assert customers.dtypes == spark.createDataFrame([], S.CUSTOMERS).dtypes
    row = customers.filter("customer_id = 'c7'").first()
    first, last = row.customer_name.split(" ")
    assert row.customer_email == f"{first.lower()}.{last.lower()}7@{synth.MAIL_DOMAIN}"
    assert customers.filter("registration_date not between '2024-02-01' and '2026-01-30'").isEmpty()
    assert {r[0] for r in customers.select("customer_segment").distinct().collect()} == set(synth.SEGMENTS)
    products = synth.synth_products(spark.range(1, 201))
    assert products.dtypes == spark.createDataFrame([], S.PRODUCTS).dtypes
    for p in products.collect():
        item = p.product_name.removeprefix(p.brand + " ").removesuffix(" " + p.category)
        assert item in synth.ITEMS and 10 <= p.list_price <= 600


def test_microbatch_files_follow_arrival(spark, made, tmp_path):
    path = tmp_path / "split"
    rows = synth.inject_late(made.limit(2_000), rate=0.2)
    synth.split_microbatches(rows, str(path), rows_per_file=150, ranges=4)
    files = sorted(path.glob("part-*.csv"))
    parts = [read_orders_csv(spark, str(path)).filter(F.col("_metadata.file_name") == f.name) for f in files]
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 2_000 and max(sizes) == 150
    # Only the very last file is short.
    assert sizes == [150] * 13 + [50]
    ends = [p.agg(F.max("order_timestamp"), F.min("order_timestamp")).first() for p in parts]
    latest = [e[0] for e in ends]
    assert latest == sorted(latest)
    assert any(later[1] < earlier[0] for earlier, later in zip(ends, ends[1:]))


def test_one_shared_time_is_still_split(spark, tmp_path):
    same = synth.synth_orders(spark.range(600)).withColumn("arrival_time", F.lit(at("10:00:00")))
    synth.split_microbatches(same, str(tmp_path / "s"), rows_per_file=100)
    sizes = [len(f.read_text().splitlines()) - 1 for f in (tmp_path / "s").glob("part-*.csv")]
    assert sizes == [100] * 6


def test_microbatch_files_are_opened_once(spark):
    rows = catalog.microbatch_files(spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Scan csv" not in plan and "csv" not in plan.lower()
    assert rows.where("size_kept AND order_kept").count() == rows.count() > 0


def test_a_batch_is_delivered_from_its_own_folder(spark):
    stored = catalog._stored_deliveries(catalog._late_orders(spark, "/root/testdata/sf0.001"))
    plan = stored.where("delivery = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(delivery" in plan
