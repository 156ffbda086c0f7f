"""A training corpus from `documents`: quality classifier, toxicity, near-duplicates, repeated strings, packing.

Each stage works on all that the one before kept. All but the last return the columns of documents.

Defined results: null texts count as empty. Near-duplicates and repeated strings treat every row as a document,
whatever its doc_id: of rows that repeat an id, or have none, only those whose texts are near duplicates go (equal
rows among them; rows without words stay, as they link with nothing), and rows rank by doc_id, null last, then by a
hash of the text. A column of documents may have any name: the columns used inside get names that none bears.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.llm import op02_suffix_dedup, op03_quality_classifier, op06_packing, op09_toxicity, op10_minhash_dedup
from chatterloom.llm.common import forget, free_names, written

VOCABULARY = "word_bpe_49k.json"
LEAST_QUALITY = 0.3
LEAST_TOXIC = 0.7
#: Similarity of near duplicates in per cent; at 38 of 64 equal coordinates a pair at 80 is missed with a probability of 4e-5.
NEAR, NEAR_MATCHES = 80, 38


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def keyed(docs: DataFrame, key: str) -> DataFrame:
    """docs with a column `key`, a long that no two rows share and that ranks them: the doc_id where each row has one
    of its own, else the row's place by (doc_id, null last, hash of the text), written so that it holds still."""
    ids = docs.select(docs["doc_id"].cast("long").alias("id"))
    if ids.groupBy("id").count().where("id is null or count > 1").isEmpty():
        return docs.withColumn(key, docs["doc_id"].cast("long"))
    rank = [docs["doc_id"].isNull(), docs["doc_id"].cast("long"), F.xxhash64(F.coalesce(docs["text"], F.lit("")))]
    return written(docs.repartitionByRange(*rank).sortWithinPartitions(*rank).withColumn(key, F.monotonically_increasing_id()))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (score,) = free_names(docs.columns, "score")
    model = op03_quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return op03_quality_classifier.classify(docs, model, score=score).where(F.col(score) >= LEAST_QUALITY).drop(score)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (score,) = free_names(docs.columns, "score")
    model = op09_toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return op09_toxicity.detect(docs, model, score=score).where(F.col(score) < LEAST_TOXIC).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key, gone = free_names(docs.columns, "row_key", "gone_key")
    rows = keyed(docs, key)
    found = op10_minhash_dedup.groups(rows.select(F.col(key).alias("doc_id"), "text"), NEAR, NEAR_MATCHES)
    late = found.where("doc_id <> component_id").select(F.col("doc_id").alias(gone))
    return rows.join(late, rows[key] == late[gone], "left_anti").drop(key)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key, new = free_names(docs.columns, "row_key", "new_text")
    rows = keyed(docs, key)
    cut = op02_suffix_dedup.dedup(rows.select(F.col(key).alias("doc_id"), "text"), op02_suffix_dedup.texts_kept, op02_suffix_dedup.KEPT)
    cut = cut.select(F.col("doc_id").alias(key), F.col("text").alias(new))
    made = {"text": F.col(new).alias("text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.length(new).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return rows.drop("text").join(cut, key).select(*[made.get(c, column(c)) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return op06_packing.pieces(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), public_tokenizers.path(VOCABULARY))


STAGES = [("quality_classifier", quality), ("toxicity", toxicity), ("minhash_dedup", near_duplicates), ("suffix_dedup", repeated_strings), ("packing", packing)]
ORACLE_SQL = None  # SQL can't express these stages; tests hold them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
        if before is not None:
            forget(before)
        before = docs
    return docs
