"""The row-local part of coding on a stream of stories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.events import lengthen_stories
from eventloom.sources.readers import STORY


def story_stream(spark: SparkSession, path: str, files_a_trigger: int = 100) -> DataFrame:
    """JSON-line stories as they arrive in a folder; pub_ts is the time of publication."""
    stories = spark.readStream.schema(STORY).option("maxFilesPerTrigger", files_a_trigger).json(path)
    return stories.withColumn("pub_ts", F.try_to_timestamp("pub_date"))


def event_stream(stories: DataFrame, late: str = "7 days") -> DataFrame:
    """Events of a story stream, each story once: copies of a story_id within the time that the watermark allows are dropped."""
    once = stories.withWatermark("pub_ts", late).dropDuplicatesWithinWatermark(["story_id"])
    return lengthen_stories(once)


def counts_by_day(events: DataFrame) -> DataFrame:
    """Events per day of publication and type; a day is final when the watermark has passed it."""
    return events.groupBy(F.window("pub_ts", "1 day"), "event_type").agg(F.count("*").alias("n"))
