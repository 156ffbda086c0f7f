"""Threads exported as message_N.json files, one folder a thread, as messages or group messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fix_mojibake, slug

SCHEMA = """participants array<struct<name:string>>, title string, thread_path string,
messages array<struct<sender_name:string, timestamp_ms:bigint, content:string, type:string, is_unsent:boolean, photos:array<string>, videos:array<string>,
audio_files:array<string>, sticker:string, gifs:array<string>, files:array<string>, share:string, call_duration:double>>"""
# Fields that hold media, in order of precedence.
MEDIA = (("photos", "image"), ("videos", "video"), ("audio_files", "voice"), ("gifs", "gif"), ("sticker", "sticker"), ("files", "file"), ("share", "share"), ("call_duration", "call"))


def media_type(m: Column) -> Column:
    """text, or the first medium that a message holds."""
    c = F.when(F.length(m["content"]) > 0, "text")
    for field, name in MEDIA:
        c = c.when(m[field].isNotNull(), name)
    return c.otherwise("unknown")


def threads(spark: SparkSession, roots: list[str]) -> DataFrame:
    """A row for each message of each file below the roots' thread folders, with the folder's name."""
    paths = [f"{r.rstrip('/')}/*/message_*.json" for r in roots]
    d = spark.read.schema(SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(paths)
    d = d.withColumn("file", F.col("_metadata.file_path")).withColumn("folder", F.element_at(F.split("file", "/"), -2))
    return d.select("file", "folder", "title", "participants", F.posexplode("messages").alias("pos", "m"))


def _decoded(d: DataFrame, names: list[str]) -> DataFrame:
    """Drops unsent and event rows and those without text or medium; adds sender and text."""
    who = fix_mojibake(F.col("m.sender_name"))
    d = d.where(~F.coalesce(F.col("m.is_unsent"), F.lit(False)) & ~F.coalesce(F.col("m.type").isin("Subscribe", "Unsubscribe"), F.lit(False)))
    d = d.withColumn("who", who).withColumn("mine", who.isin(names)).withColumn("text", fix_mojibake(F.nullif(F.col("m.content"), F.lit("")))).withColumn("media_type", media_type(F.col("m")))
    return d.where((F.col("media_type") != "unknown") | F.col("text").isNotNull()).withColumn("timestamp", F.timestamp_millis("m.timestamp_ms")).withColumn("seq", F.col("m.timestamp_ms") * 1000 - F.col("pos"))


def others(names: list[str]) -> Column:
    return F.filter(F.transform("participants", lambda p: fix_mojibake(p["name"])), lambda n: ~n.isin(names))


def messages(spark: SparkSession, roots: list[str], me: str, aliases: list[str] = (), platform: str = "messenger") -> DataFrame:
    """Messages of every thread; in a thread of several, all but me are `them`. Order by contact_id, timestamp, seq."""
    names = [me, *aliases]
    d = _decoded(threads(spark, roots), names)
    first = F.get(others(names), F.lit(0))
    return d.select(F.col("folder").alias("contact_id"), F.coalesce(first, F.lit("unknown")).alias("contact_name"), "timestamp", F.when(F.col("mine"), "me").otherwise("them").alias("sender"), "text", "media_type", F.lit(None).cast("timestamp").alias("reply_to_timestamp"), F.lit(platform).alias("platform"), "seq")


def group_messages(spark: SparkSession, roots: list[str], me: str, aliases: list[str] = (), platform: str = "messenger") -> DataFrame:
    """Messages of threads of more than two participants."""
    names = [me, *aliases]
    d = _decoded(threads(spark, roots).where(F.size("participants") > 2), names)
    name = F.coalesce(fix_mojibake(F.col("title")), F.array_join(F.slice(others(names), 1, 3), ", "))
    return d.select(F.col("folder").alias("group_id"), name.alias("group_name"), "timestamp", F.when(F.col("mine"), "me").otherwise("participant").alias("sender"), slug(F.col("who")).alias("participant_id"), F.col("who").alias("participant_name"), "text", "media_type", F.lit(None).cast("timestamp").alias("reply_to_timestamp"), F.lit(platform).alias("platform"), "seq")
