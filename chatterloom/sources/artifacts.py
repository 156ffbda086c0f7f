"""Tables as JSON lines, small JSON documents, folders of results, shards; all through Hadoop's file systems."""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE = "contact_id string, contact_name string, timestamp timestamp, sender string, text string, media_type string, reply_to_timestamp timestamp, platform string, seq bigint"
GROUP_MESSAGE = "group_id string, group_name string, timestamp timestamp, sender string, participant_id string, participant_name string, text string, media_type string, reply_to_timestamp timestamp, platform string, seq bigint"
SIGNAL = "struct<type:string,evidence:string,weight:string>"
CLASSIFIED = f"contact_id string, contact_name string, message_count_total bigint, message_count_from_me bigint, message_count_from_them bigint, first_message_at timestamp, last_message_at timestamp, span_days bigint, label string, confidence double, label_source string, label_source_note string, context_tags array<string>, register_tags array<string>, signals array<{SIGNAL}>, alt_labels array<struct<label:string,confidence:double>>"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _plain(spark: SparkSession, path: str):
    """A file system of one's own without checksum files: people edit these documents by other means."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = spark._jvm.org.apache.hadoop.fs.FileSystem.newInstance(p.toUri(), spark._jsc.hadoopConfiguration())
    fs.setVerifyChecksum(False)
    fs.setWriteChecksum(False)
    return fs, p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether a path with wild cards names anything."""
    fs, p = _path(spark, pattern)
    return bool(len(fs.globStatus(p) or []))


def modified_ms(spark: SparkSession, path: str) -> int | None:
    """Time of the last change, null without such a file."""
    fs, p = _path(spark, path)
    return fs.getFileStatus(p).getModificationTime() if fs.exists(p) else None


def move(spark: SparkSession, source: str, target: str) -> None:
    """source becomes target; what was there goes."""
    fs, a = _path(spark, source)
    _, b = _path(spark, target)
    fs.delete(b, True)
    if not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small document: it is held by the driver."""
    fs, p = _plain(spark, path)
    try:
        stream = fs.open(p)
        try:
            return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()
    finally:
        fs.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _plain(spark, path)
    try:
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
    finally:
        fs.close()


def read_document(spark: SparkSession, path: str) -> Any:
    return json.loads(read_text(spark, path))


def write_document(spark: SparkSession, path: str, value: Any) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2) + "\n")


def read_lines(spark: SparkSession, path: str, schema: str = MESSAGE) -> DataFrame:
    """JSON lines; blank ones are passed over, broken ones are an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("ignoreNullFields", False).json(path)


def write_lines(d: DataFrame, path: str) -> int:
    """Writes a folder of JSON lines and returns the number of rows."""
    d.write.mode("overwrite").option("ignoreNullFields", False).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").json(path)
    return d.sparkSession.read.text(path).count()


def read_results(spark: SparkSession, folder: str, schema: str = CLASSIFIED) -> DataFrame:
    """Rows of every .json file of a folder, each an object, a list of them or one with `contacts`; the file's name is
    the column file, by which later results win. A missing folder has no rows."""
    empty = spark.createDataFrame([], schema + ", file string")
    if not exists(spark, folder):
        return empty
    d = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(folder).select("value", F.col("_metadata.file_name").alias("file"))
    return payload(d, "value", schema).select(*empty.columns)


def payload(d: DataFrame, column: str, schema: str) -> DataFrame:
    """Explodes texts that hold a list of rows, an object with the list as `contacts`, or one row. Broken texts, and
    values of other types than the schema's, are an error."""
    text = F.ltrim(column)
    parsed = lambda kind: F.from_json(column, kind, {"mode": "FAILFAST"})
    has_list = F.get_json_object(column, "$.contacts").startswith("[")
    rows = F.when(text.startswith("["), parsed(f"array<{_struct(schema)}>")).when(has_list, parsed(f"contacts array<{_struct(schema)}>")["contacts"]).otherwise(F.array(parsed(_struct(schema))))
    return d.withColumn("__rows", rows).select(*[c for c in d.columns if c != column], F.inline("__rows"))


def _struct(schema: str) -> str:
    return "struct<" + re.sub(r"(^|, )(\w+) ", r"\1\2:", schema) + ">"


def write_shards(shards: DataFrame, folder: str) -> DataFrame:
    """A folder shard_index=N for each shard in place of those before; returns the tasks of each."""
    shards.write.mode("overwrite").partitionBy("shard_index").json(folder)
    return shards.sparkSession.read.json(folder).groupBy(F.col("shard_index").cast("long").alias("shard_index")).agg(F.count("*").alias("tasks"))
