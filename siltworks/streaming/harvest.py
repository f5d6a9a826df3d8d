"""The row-local transformations over an unbounded harvest.

Cleaning, identification and URL entities are narrow, so they run unchanged on a
stream; repeated URLs are dropped within a watermark, and counts by standard are
kept in event-time windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import clean
from ..functions.rules import Rule
from ..functions.standards import STANDARD
from ..operators.identify import first_identity, identify


def read_stream(spark: SparkSession, path: str, schema, max_files: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def identified(raw: DataFrame, rules: list[Rule] = STANDARD, at: str = "loaded_at", late: str = "1 day") -> DataFrame:
    """First identity of each harvested response; a URL again within the watermark is dropped."""
    once = raw.withColumn("event_time", F.col(at).cast("timestamp")).withWatermark("event_time", late).dropDuplicatesWithinWatermark(["url"])
    out = identify(clean(once), rules)
    return out.select("url", "event_time", "datatype", first_identity(F.col("identities")).alias("identity"))


def counts_by_standard(stream: DataFrame, window: str = "1 hour") -> DataFrame:
    return stream.groupBy(F.window("event_time", window), F.col("identity.protocol").alias("protocol")).agg(F.count(F.lit(1)).alias("n"))
