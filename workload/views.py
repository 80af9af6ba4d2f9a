"""The given tables seen as stories, comments and observations.

The tables hold no threads. These views derive them, each over the whole table:

- observations: events per user and day (score, descendants, first event time)
- replies: conversation turns, each answering the one before
- stories: labelled documents, or all documents
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_DATE = "2024-01-20"
WINDOW_DAYS = 7

# Words that occur in the generated prose, so that every rule has work to do.
LEXICON = {
    "is": 1.5, "it": -1.25, "for": 2.0, "was": -2.5, "on": 0.75, "with": 1.25, "by": -0.5,
    "la": 1.0, "der": -1.75, "que": 0.5, "die": 2.25, "no": -1.0, "this": 3.0, "from": -3.0,
}
DEGREES = {"the": 0.25, "and": -0.25, "en": 0.5, "und": -0.5}
NEGATIONS = ["of", "to", "le", "von", "never", "without"]
CONTRAST = "that"
# Phrases of the prose and planted ones; emoji by the words they are read as.
PHRASES = {"to die for": 3.0, "kiss of death": -1.5, "it is for": 2.5, "on the": -2.0, "broken heart": -2.75}
EMOJI = {"\U0001f600": "this smile", "\U0001f494": "from broken heart"}
PLANTED = [" It was TO die for!", " Yeah, kiss of Death \U0001f494", "\U0001f600it is for you", ""]
STOP_WORDS = ["the", "of", "and", "to", "in", "de"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, ingestion_date, score, descendants, time."""
    daily = (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("user_id").alias("id"),
            F.date_format("ts", "yyyy-MM-dd").alias("ingestion_date"),
        )
        .agg(
            F.sum(F.floor("value").cast("bigint")).alias("score"),
            F.count_if(F.col("event_type").isin("click", "view")).alias("descendants"),
            F.min("ts").alias("_first"),
        )
    )
    first = F.expr("min(_first) over (partition by id)").cast("timestamp")
    return daily.withColumn("time", first).drop("_first")


def reply_id(turn: Column | str = "turn") -> Column:
    """Negative, so that it never meets a story id."""
    turn = F.col(turn) if isinstance(turn, str) else turn
    return -(F.col("conv_id") * 1000 + turn) - 1


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, type, by, text, parent, kids, conv_id, turn."""
    first = F.col("turn") == 0
    return table(spark, sf_dir, "conversations").select(
        reply_id().alias("id"),
        F.lit("comment").alias("type"),
        F.col("role").alias("by"),
        "text",
        F.when(first, F.col("conv_id")).otherwise(reply_id(F.col("turn") - 1)).alias("parent"),
        F.array(reply_id(F.col("turn") + 1)).alias("kids"),
        "conv_id",
        "turn",
    )


def planted_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with a phrase or an emoji at the end of most."""
    planted = F.get(F.array(*map(F.lit, PLANTED)), F.pmod(F.col("conv_id") + F.col("turn"), F.lit(len(PLANTED))).cast("int"))
    return replies(spark, sf_dir).select("id", F.concat(F.coalesce("text", F.lit("")), planted).alias("text"))


def labelled_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
