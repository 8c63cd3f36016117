"""A local session for tests, the benchmark and trying things out.

On a cluster the caller passes its own session; nothing in the package sets
cluster-wide options. Test tables are single files, so their texts are dealt out.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from brooktext.sources.tables import SPREAD_SETTING


def local_session(cores: int | str = "*", app: str = "brooktext", memory: str = "8g") -> SparkSession:
    partitions = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config(SPREAD_SETTING, partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
