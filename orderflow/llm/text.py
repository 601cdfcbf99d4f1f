"""Column expressions shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.plans.scratch import scratch_dir

#: White space as all operators here understand it.
SPACES = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def whole(text: Column | str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column) -> Column:
    """Number of runs without white space, without building the words."""
    marks = F.regexp_replace(F.ltrim(text, F.lit(SPACES)), f"{WORD}++{SPACE}*+", "x")
    return F.length(marks).cast("long")


def words(text: Column) -> Column:
    """The runs without white space."""
    return F.regexp_extract_all(text, F.lit(f"{WORD}++"), F.lit(0))


def stored(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """The frame written below the shared checkpoint folder and read again."""
    spark = frame.sparkSession
    path = scratch_dir(spark, name)
    frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """``join`` of all elements up to and including each one, for an associative join.

    Doubling steps, so n elements cost n log n and nothing leaves the row.
    """

    def step(done: Column, reach: Column) -> Column:
        return F.transform(
            done, lambda v, i: F.when(i >= reach, join(F.get(done, i - reach), v)).otherwise(v)
        )

    def scan(start: Column) -> Column:
        steps = F.ceil(F.log2(F.greatest(F.size(start), F.lit(2)))).cast("int")
        reaches = F.transform(
            F.sequence(F.lit(0), steps - 1), lambda k: F.pow(F.lit(2), k).cast("int")
        )
        return F.aggregate(reaches, start, step)

    return bound(values, scan)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also where body uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def located(text: Column, pattern: str, reach: int = 0) -> Column:
    """Leftmost, non-overlapping matches: array of (value, start, stop, before, after).

    start and stop are in code points; before and after are up to ``reach`` code
    points next to the match, not beyond a neighbouring one.
    """

    def place(found: Column, between: Column) -> Column:
        lengths = F.zip_with(
            F.slice(between, F.lit(1), F.size(found)), found, lambda b, f: F.length(b) + F.length(f)
        )

        def spans(ends: Column) -> Column:
            return F.transform(
                found,
                lambda v, i: F.struct(
                    v.alias("value"),
                    (F.get(ends, i) - F.length(v)).alias("start"),
                    F.get(ends, i).alias("stop"),
                    F.right(F.get(between, i), F.lit(reach)).alias("before"),
                    F.left(F.get(between, i + 1), F.lit(reach)).alias("after"),
                ),
            )

        return bound(running(lengths, lambda a, b: a + b), spans)

    fields = "value:string,start:int,stop:int,before:string,after:string"
    none = F.array().cast(f"array<struct<{fields}>>")
    return bound(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) == 0, none).otherwise(
            bound(F.split(text, pattern, -1), lambda between: place(found, between))
        ),
    )
