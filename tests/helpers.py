"""Small frames in the order layout."""

from __future__ import annotations

import os
from datetime import datetime

from orderflow import schema as S

DAY = "2026-01-01 "


def at(clock: str | None) -> datetime | None:
    return datetime.fromisoformat(DAY + clock) if clock else None


def order(order_id, clock="10:00:00", product="p1", quantity=1, price=1.0, status="pending", customer="c1"):
    time = at(clock if clock is None or clock.count(":") == 2 else clock + ":00")
    return (order_id, customer, product, time, quantity, price, status)


def orders(spark, rows):
    return spark.createDataFrame(rows, S.ORDERS)


def values(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def ids(frame):
    return sorted((r.order_id for r in frame.select("order_id").collect()), key=repr)


CSV_COLUMNS = S.column_names(S.ORDERS)


def write_order_file(directory, number, rows):
    """One CSV file whose modification time follows its number."""
    lines = [",".join(CSV_COLUMNS)]
    for row in rows:
        lines.append(",".join("" if v is None else str(v) for v in row))
    path = directory / f"orders_{number:04d}.csv"
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + number * 10,) * 2)
