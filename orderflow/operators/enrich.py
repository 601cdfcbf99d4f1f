"""Left joins of orders with their customer and product dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow import schema as S
from orderflow.plans.scratch import scratch_dir

BROADCAST_LIMIT = 64 * 1024 * 1024


class DuplicateKeyError(ValueError):
    """A dimension key occurs twice and would multiply orders."""


@dataclass(frozen=True)
class Dimension:
    """A dimension whose key is known to be unique and whose size is known."""

    frame: DataFrame
    key: str
    rows: int
    size_bytes: int


def check_dimension(frame: DataFrame, key: str) -> Dimension:
    """Measure a dimension and refuse duplicate keys, in one pass over it.

    The size follows Spark's row format: eight bytes per field plus the text.
    NULL keys match no order, so they may repeat.
    """
    texts = [F.col(n) for n, t in frame.dtypes if t == "string"]
    width = F.lit(8 * (len(frame.columns) + 1))
    for text in texts:
        width = width + F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)
    per_key = frame.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("size")
    )
    stats = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("size"),
        F.max(F.when(F.col(key).isNotNull(), F.struct("n", key))).alias("worst"),
    ).first()
    if stats.worst is not None and stats.worst["n"] > 1:
        raise DuplicateKeyError(f"{key} {stats.worst[key]!r} occurs {stats.worst['n']} times")
    return Dimension(frame, key, stats.n_rows, stats.size)


def _checked(dimension: DataFrame | Dimension, key: str) -> Dimension:
    return dimension if isinstance(dimension, Dimension) else check_dimension(dimension, key)


def _join(orders: DataFrame, frame: DataFrame, key: str, only: Column | None) -> DataFrame:
    lookup = frame.withColumnRenamed(key, "_dim_key")
    matches = F.col(key) == F.col("_dim_key")
    if only is not None:
        matches = matches & only
    return orders.join(lookup, matches, "left").drop("_dim_key")


def hot_share(spark: SparkSession) -> float:
    """A key with more rows than an average shuffle task is hot."""
    return 1 / max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(orders: DataFrame, *keys: str, share: float | None = None) -> dict[str, list]:
    """Per key column, the values above ``share`` of the rows.

    A sketch finds candidates, missing none, and a count removes those that are
    below. At most 1/share values remain, so the result is bounded however large
    the table is. Both are passes over those columns only.
    """
    share = hot_share(orders.sparkSession) if share is None else share
    found = orders.freqItems(list(keys), share).first()
    candidates = {k: {str(v): v for v in items if v is not None} for k, items in zip(keys, found)}
    # All values that are no candidates count as one, so a task sends few rows.
    values = [
        F.struct(
            F.lit(key).alias("key"),
            F.when(F.col(key).isin(list(candidates[key].values())), F.col(key).cast("string")).alias("value"),
        )
        for key in keys
    ]
    counted = orders.select(F.explode(F.array(*values)).alias("x")).groupBy("x.key", "x.value")
    counts = {(r["key"], r["value"]): r["count"] for r in counted.count().collect()}
    n_rows = sum(n for (key, _), n in counts.items() if key == keys[0])
    return {
        key: [v for text, v in candidates[key].items() if counts.get((key, text), 0) > share * n_rows]
        for key in keys
    }


def _join_large(orders: DataFrame, dim: Dimension, only: Column | None, hot: list) -> DataFrame:
    """Join a dimension that is too large to broadcast.

    Orders of a hot key, or of none, and those that ``only`` leaves out stay where they
    are and meet a broadcast of the hot keys' dimension rows, one per key; all others
    are shuffled by key. Both branches read the same source, so an exchange below is
    computed once.
    """
    key = F.col(dim.key)
    # Rows without a key, or not looked up, match nothing; they need no shuffle either.
    stays = key.isNull()
    if only is not None:
        stays = stays | ~F.coalesce(only, F.lit(False))
    if not hot:
        hot_rows = dim.frame.limit(0)
    else:
        stays = stays | key.isin(hot)
        hot_rows = dim.frame.filter(key.isin(hot))
    cold = _join(orders.filter(~stays), dim.frame.hint("shuffle_merge"), dim.key, None)
    return cold.unionByName(_join(orders.filter(stays), F.broadcast(hot_rows), dim.key, only))


def reduced_dimension(dim: Dimension, orders: DataFrame, path: str) -> Dimension:
    """The dimension's rows for the keys of some orders, written to ``path`` and
    measured. Its key is unique already."""
    keys = orders.select(dim.key).distinct()
    dim.frame.join(keys, dim.key, "left_semi").write.mode("overwrite").parquet(path)
    frame = dim.frame.sparkSession.read.schema(dim.frame.schema).parquet(path)
    return check_dimension(frame, dim.key)


def _with_hot_keys(
    orders: DataFrame, dims: list[Dimension], broadcast_limit: int, hot: dict[str, list] | None
) -> tuple[DataFrame, dict[str, list] | None]:
    """The orders, and the hot keys of the dimensions that are too large to broadcast.

    Unless the caller has the hot keys, the orders are written first: they are read for
    the counts and by both branches of each join, and would be made anew each time.
    """
    large = [d for d in dims if d.size_bytes > broadcast_limit]
    if large and orders.isStreaming:
        names = " and ".join(d.key for d in large)
        raise ValueError(f"the dimension of {names} is too large for a stream; enrich its batches")
    if not large or hot is not None:
        return orders, hot
    spark, path = orders.sparkSession, scratch_dir(orders.sparkSession, "lookup-orders")
    orders.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(orders.schema).parquet(path)
    return stored, hot_keys(stored, *(d.key for d in large))


def left_lookup(
    orders: DataFrame,
    dimension: DataFrame | Dimension,
    key: str,
    only: Column | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    hot: dict[str, list] | None = None,
) -> DataFrame:
    """Add a dimension's columns; orders without a match keep NULLs.

    ``only`` restricts which orders are looked up at all. ``hot`` holds the
    result of ``hot_keys`` if the caller has it; without it the orders that meet a
    large dimension are first written below ``spark.checkpoint.dir`` and their key
    column is read for it. It affects speed, never the result.

    A stream cannot be looked up in a large dimension directly: its batches are
    (``streaming.sinks.enriching``), each against the dimension rows it needs.
    """
    dim = _checked(dimension, key)
    if dim.size_bytes <= broadcast_limit:
        joined = _join(orders, F.broadcast(dim.frame), key, only)
    else:
        orders, hot = _with_hot_keys(orders, [dim], broadcast_limit, hot)
        joined = _join_large(orders, dim, only, hot[key])
    added = [c for c in dim.frame.columns if c != key]
    rest = [c for c in orders.columns if c != key]
    return joined.select(key, *rest, *added)


def enrich_with_customers(orders: DataFrame, customers: DataFrame | Dimension, **how) -> DataFrame:
    return left_lookup(orders, customers, "customer_id", **how)


def enrich_with_products(orders: DataFrame, products: DataFrame | Dimension, **how) -> DataFrame:
    return left_lookup(orders, products, "product_id", **how)


def enrich_with_dimensions(
    orders: DataFrame,
    customers: DataFrame | Dimension,
    products: DataFrame | Dimension,
    only: Column | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    hot: dict[str, list] | None = None,
) -> DataFrame:
    """Both lookups, for static and for streaming orders. Hot keys of both come from the
    same written orders."""
    customers, products = _checked(customers, "customer_id"), _checked(products, "product_id")
    orders, hot = _with_hot_keys(orders, [customers, products], broadcast_limit, hot)
    how = {"only": only, "broadcast_limit": broadcast_limit, "hot": hot}
    return enrich_with_products(enrich_with_customers(orders, customers, **how), products, **how)


def enriched_layout(orders: DataFrame) -> DataFrame:
    """Exactly the enriched columns, in order."""
    return orders.select(*S.ENRICHED_COLUMNS)
