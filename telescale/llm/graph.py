"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telescale.llm.texts import set_checkpoint_dir

#: Over how many keys the links of one node are dealt.
SALTS = 64


def _salted(links: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links (u, v) with a salt; (u, least), the least neighbour of each node; and that for each salt of the node.

    A node of many links is dealt by its salts. What is brought together by node alone has at most a row for each salt.
    """
    salted = links.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    parts = salted.groupBy("u", "salt").agg(F.min("v").alias("part"))
    least = parts.groupBy("u").agg(F.min("part").alias("least"))
    return salted, least, parts.select("u", "salt").join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest of the node and its neighbours."""
    salted, _, least = _salted(links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    return salted.filter("v > u").join(least, ["u", "salt"]).select(F.col("v").alias("u"), F.least("least", "u").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of those."""
    salted, of_node, least = _salted(links)
    moved = salted.join(least, ["u", "salt"]).select(F.col("v").alias("u"), F.col("least").alias("v")).filter("u <> v")
    return moved.union(of_node.toDF("u", "v"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of each node in a link (u, v), root being the smallest node that it is connected to.

    Each round halves the depth of the trees or more; it is written to the checkpoint folder. Neighbours are only
    ever reduced to a minimum, so a node with many links needs no task of its own.
    """
    set_checkpoint_dir(links.sparkSession)
    links = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = links.checkpoint()
    state = None
    while True:
        now = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("sum")).first()
        if now == state or not now.n:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        links = _small_star(_large_star(links).distinct()).distinct().checkpoint()
