"""A session for laptops, tests and the benchmark; clusters bring their own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", **options: str
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("citemill")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in options.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
