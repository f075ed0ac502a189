"""Ordered computations per key (running totals, latest and next values) that survive hot keys.

One application may hold a large share of all rows, so a plain window over the key would sort that
share in one task. Here a key with more rows than ``spark.telescale.rowsPerBlock`` is cut into
consecutive blocks of its order. Rows are shuffled by (key, block), every block is windowed on its
own, and one summary row per block carries totals and values across the block borders. Keys below
the limit keep a null block: for them this is the ordinary window, and the carry branch is empty.

The rows are written to the shared folder first: counting, carrying and windowing then read a narrow
table instead of deriving it three times, and chains of such steps keep short plans.

``has_hot_keys`` asks the data once whether any key is over the limit. Where none is, the operators
take ``hot=False`` and plan plain windows, with one shuffle per key and no second branch.

Bounds: hot keys number at most rows / rowsPerBlock, so their list may be broadcast whatever the
size of the input; a block spans at most rowsPerBlock steps of the coordinate, so with a coordinate
that is unique in its key (line number, distinct millisecond) no task holds more than that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telescale.session import shared_dir

ROWS_KEY = "spark.telescale.rowsPerBlock"
ROWS_DEFAULT = 2_000_000
BLOCK = "_block"


def rows_per_block(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(ROWS_KEY, str(ROWS_DEFAULT)))


def has_hot_keys(df: DataFrame, keys: Sequence[str], fanout: int = 1) -> bool:
    """Whether a key has too many rows for one task, where each row may become ``fanout`` rows later.

    Runs one narrow counting job. A key made of these and further columns is then not hot either.
    """
    limit = rows_per_block(df) // fanout
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return not counts.filter(F.col("_n") > limit).isEmpty()


def written(df: DataFrame) -> DataFrame:
    """The same rows as a table in the shared folder, so that no branch derives them again."""
    path = shared_dir(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocked(df: DataFrame, keys: Sequence[str], coordinate: str, hot: bool = True) -> DataFrame:
    """Add the block number of each row: null for ordinary keys, rising with the coordinate for hot ones."""
    if not hot:
        return df
    limit = rows_per_block(df)
    df = written(df)
    n, low, high = F.col("_n"), F.col("_low"), F.col("_high")
    # Four times as many pieces as needed on average leaves room for uneven density.
    even = F.ceil((high - low + 1) * F.lit(float(limit)) / (n * F.lit(4.0)))
    hot = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(coordinate).alias("_low"), F.max(coordinate).alias("_high"))
        .filter(n > limit)
        .select(*keys, low, F.least(F.greatest(even, F.lit(1)), F.lit(limit)).cast("long").alias("_width"))
    )
    position = F.floor((F.col(coordinate) - low) / F.col("_width"))
    return df.join(F.broadcast(hot), list(keys), "left").withColumn(BLOCK, position).drop("_low", "_width")


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    total: Mapping[str, Column] | None = None,
    last: Mapping[str, Column] | None = None,
    before: Mapping[str, Column] | None = None,
    after: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ordered columns to a frame prepared by ``blocked``; one without blocks gets plain windows.

    ``total``: running sum up to and with the row. ``last``: latest non-null value up to and with
    the row. ``before`` / ``after``: nearest non-null value strictly before / after the row.
    """
    total, last, before, after = (dict(m or {}) for m in (total, last, before, after))
    in_blocks = BLOCK in df.columns
    parts = [*keys, BLOCK] if in_blocks else list(keys)
    upto = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    prior = upto.rowsBetween(Window.unboundedPreceding, -1)
    # A frame to the end of the partition is quadratic in Spark, so look ahead by sorting downwards.
    ahead = (
        Window.partitionBy(*parts).orderBy(*[F.col(c).desc() for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = df.select(
        "*",
        *[F.sum(e).over(upto).alias(f"_t_{n}") for n, e in total.items()],
        *[F.last(e, ignorenulls=True).over(upto).alias(f"_l_{n}") for n, e in last.items()],
        *[F.last(e, ignorenulls=True).over(prior).alias(f"_b_{n}") for n, e in before.items()],
        *[F.last(e, ignorenulls=True).over(ahead).alias(f"_a_{n}") for n, e in after.items()],
    )

    if not in_blocks:
        names = {**{f"_t_{n}": n for n in total}, **{f"_l_{n}": n for n in last}}
        names |= {**{f"_b_{n}": n for n in before}, **{f"_a_{n}": n for n in after}}
        return local.withColumnsRenamed(names)

    place = F.struct(*[F.col(c) for c in order])
    backward = {**{f"_l_{n}": e for n, e in last.items()}, **{f"_b_{n}": e for n, e in before.items()}}
    forward = {f"_a_{n}": e for n, e in after.items()}
    sums = {f"_t_{n}": e for n, e in total.items()}
    summary = (
        df.filter(F.col(BLOCK).isNotNull())
        .groupBy(*parts)
        .agg(
            *[F.sum(e).alias(n) for n, e in sums.items()],
            *[F.max_by(e, F.when(e.isNotNull(), place)).alias(n) for n, e in backward.items()],
            *[F.min_by(e, F.when(e.isNotNull(), place)).alias(n) for n, e in forward.items()],
        )
    )
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.col(BLOCK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *parts,
        *[F.sum(n).over(earlier).alias(f"{n}_in") for n in sums],
        *[F.last(n, ignorenulls=True).over(earlier).alias(f"{n}_in") for n in backward],
        *[F.last(n, ignorenulls=True).over(later).alias(f"{n}_in") for n in forward],
    )
    joined = local.join(carried, parts, "left")
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_t_{n}") + F.coalesce(F.col(f"_t_{n}_in"), F.lit(0))).alias(n)
            for n in total
        ],
        *[F.coalesce(F.col(f"_l_{n}"), F.col(f"_l_{n}_in")).alias(n) for n in last],
        *[F.coalesce(F.col(f"_b_{n}"), F.col(f"_b_{n}_in")).alias(n) for n in before],
        *[F.coalesce(F.col(f"_a_{n}"), F.col(f"_a_{n}_in")).alias(n) for n in after],
    )
