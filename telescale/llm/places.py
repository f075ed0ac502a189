"""Places of rows in ordered groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telescale.llm.texts import set_checkpoint_dir


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``place``, the number of a row in its ``tree`` by ``order``, and ``n_tree``, the rows of the tree.

    Rows are sorted by ranges, so that a large tree lies in many partitions; only the counts of each tree in each
    partition are summed up along the tree.
    """
    set_checkpoint_dir(rows.sparkSession)
    order = ["tree", *order]
    rows = rows.checkpoint()  # sorting by ranges reads its input twice
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}).checkpoint()
    runs = rows.groupBy("tree", "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("tree", "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
                       F.sum("_n").over(tree).alias("n_tree"))
    placed = rows.join(runs, ["tree", "_part"]).withColumn("place", F.col("_row") - F.col("_first") + F.col("_before"))
    return placed.drop("_part", "_row", "_first", "_before")
