"""Write the event log of a small application with a failing job: ``python write_log.py DIR plain|rolled|packed``."""

from __future__ import annotations

import sys

from telescale.session import build_session

LAYOUTS = {
    "plain": {"spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"},
    "rolled": {
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "true",
        "spark.eventLog.rolling.maxFileSize": "10m",
    },
    "packed": {"spark.eventLog.compress": "true"},
}


def main() -> None:
    folder, layout = sys.argv[1:]
    spark = build_session(
        app_name="Sort with Params(1, 2)", master="local[4]",
        **{
            "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": folder, "spark.executor.memory": "1g",
            "spark.customExtraListener.datasizeMb": "10.9", **LAYOUTS[layout],
        },
    )
    spark.range(100000).selectExpr("id % 7 k", "id").groupBy("k").count().collect()
    try:
        spark.sparkContext.parallelize(range(4), 4).map(lambda x: 1 // 0).count()
    except Exception as error:  # the failing job belongs to the test
        print(type(error).__name__)
    spark.range(1000).repartition(5).cache().count()
    spark.stop()


if __name__ == "__main__":
    main()
