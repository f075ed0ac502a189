"""Ordered passes with and without blocks against a walk over sorted rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from telescale.operators.ordered import ROWS_KEY, blocked, has_hot_keys, scan


def walk(rows):
    """Expected columns of rows (key, t, seq, v), v may be None."""
    out = {}
    for key in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == key)
        for i, r in enumerate(mine):
            values = [x[3] for x in mine]
            known = [v for v in values[: i + 1] if v is not None]
            earlier = [v for v in values[:i] if v is not None]
            later = [v for v in values[i + 1:] if v is not None]
            out[r[:3]] = (
                sum(known), known[-1] if known else None, earlier[-1] if earlier else None,
                later[0] if later else None,
            )
    return out


def test_scan_equals_walk(spark, hot):
    rng = random.Random(3)
    rows, seq = [], 0
    for key, n in ((0, 60), (1, 3), (2, 1), (3, 25)):
        for _ in range(n):
            seq += 1
            rows.append((key, rng.randrange(40), seq, rng.choice([None, rng.randrange(9)])))
    df = spark.createDataFrame(rows, "key int, t long, seq long, v int")
    v = F.col("v")
    prepared = blocked(df, ["key"], "t", hot)
    got = scan(
        prepared, ["key"], ["t", "seq"], total={"s": F.coalesce(v, F.lit(0))}, last={"l": v}, before={"b": v},
        after={"a": v},
    )
    assert {(r.key, r.t, r.seq): (r.s, r.l, r.b, r.a) for r in got.collect()} == walk(rows)
    if hot:
        spread = prepared.groupBy("key").agg(F.countDistinct("_block").alias("n")).collect()
        blocks = {r.key: r.n for r in spread}
        assert blocks[0] > 5 and blocks[1] == 0 and blocks[2] == 0


def test_block_size_is_bounded_for_unique_coordinates(spark):
    spark.conf.set(ROWS_KEY, "10")
    try:
        dense = spark.range(5000).selectExpr("0 key", "id t")
        sparse = spark.range(5000).selectExpr("1 key", "id * id * 1000 t")
        largest = blocked(dense.union(sparse), ["key"], "t").groupBy("key", "_block").count().agg(F.max("count"))
        assert largest.first()[0] <= 10
        assert has_hot_keys(dense, ["key"]) and not has_hot_keys(dense.limit(10), ["key"])
        assert has_hot_keys(dense.limit(10), ["key"], fanout=2)
    finally:
        spark.conf.unset(ROWS_KEY)
