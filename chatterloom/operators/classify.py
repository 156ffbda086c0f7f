"""Planning, merging and checking of labels that are made elsewhere, and the rules that bound them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import result_file_name

# The labels in use.
LABELS = "intimate_partner family_close family_extended close_friend friend work_peer work_hierarchy acquaintance unclassified".split()
#: Sources of labels that no result replaces.
USER_SET = ("manual_override", "correction_override")


def tasks(contacts: DataFrame, classified: DataFrame, results: DataFrame, signals: DataFrame | None = None, result_dir: str = "exports/classifications", sample_dir: str = "exports/samples/classify", n: int = 200) -> DataFrame:
    """Contacts without a label or a result: the file that each result goes to, its path, the path of its sample and the
    command that makes it, and the contact's signal from groups (null without one, or without signals)."""
    left = contacts.join(classified.select("contact_id"), "contact_id", "left_anti").join(results.select("contact_id"), "contact_id", "left_anti")
    file = result_file_name(F.col("contact_id"))
    at = F.concat(F.lit(sample_dir + "/"), file)
    command = F.array(*map(F.lit, ("python", "-m", "chatterloom.cli", "sample", "classify", "--contact")), F.col("contact_id"), F.lit("--n"), F.lit(str(n)), F.lit("--out"), at)
    left = left.withColumn("result_file", file).withColumn("result_path", F.concat(F.lit(result_dir + "/"), file)).withColumn("sample_path", at).withColumn("sample_command", command)
    if signals is None:
        return left.withColumn("group_signal", F.lit(None).cast("string"))
    of = signals.select("contact_id", F.struct(*signals.columns).alias("group_signal"))
    return left.join(of, "contact_id", "left")


def shards(t: DataFrame, size: int = 5) -> DataFrame:
    """Numbered shards of `size` tasks, most messages first. A task's place is its place among those with as many
    messages and the number of those with more: the latter comes from a row for each number of messages."""
    size = max(1, size)
    by = "message_count_total"
    more = t.groupBy(by).agg(F.count("*").alias("__k")).withColumn("__one", F.lit(0))
    more = more.select(by, (F.sum("__k").over(Window.partitionBy("__one").orderBy(F.desc(by))) - F.col("__k")).alias("__before"))
    d = t.join(more, by).withColumn("__n", F.col("__before") + F.row_number().over(Window.partitionBy(by).orderBy("contact_id")) - 1)
    return d.withColumn("shard_index", (F.floor(F.col("__n") / size) + 1).cast("long")).select(*t.columns, "shard_index")


def merge(contacts: DataFrame, existing: DataFrame, results: DataFrame) -> DataFrame:
    """For each contact: the row with a label that the user set or corrected, else the last result, else the row it had,
    else missing. All columns of the results come back: those of the row that stands."""
    rest = [c for c in results.columns if c not in ("contact_id", "seq")]
    row = lambda d: F.struct(*[(F.col(c) if c in d.columns else F.lit(None).cast(results.schema[c].dataType)).alias(c) for c in rest])
    last = results.groupBy("contact_id").agg(F.max_by(row(results), "seq").alias("new"), F.count("*").alias("k"))
    if "seq" in existing.columns:  # of several rows of a contact the last
        existing = existing.groupBy("contact_id").agg(F.max_by(F.struct(*[c for c in existing.columns if c != "contact_id"]), "seq").alias("e")).select("contact_id", "e.*")
    had = existing.select("contact_id", row(existing).alias("old"), F.col("label_source").alias("src"))
    d = contacts.select("contact_id").join(had, "contact_id", "left").join(last, "contact_id", "left")
    stands = F.when(F.col("src").isin(*USER_SET), F.col("old")).otherwise(F.coalesce("new", "old"))
    d = d.select("contact_id", stands.alias("row"), F.coalesce(F.col("k") > 1, F.lit(False)).alias("duplicate"))
    return d.select("contact_id", *[F.col("row")[c].alias(c) for c in rest], F.col("row").isNull().alias("missing"), "duplicate")


def progress(contacts: DataFrame, classified: DataFrame) -> DataFrame:
    c = classified.groupBy("contact_id").agg(F.count("*").alias("k"))
    d = contacts.select("contact_id", F.lit(True).alias("a")).join(c.withColumn("b", F.lit(True)), "contact_id", "full")
    on = lambda x: F.coalesce(F.col(x), F.lit(False))
    return d.agg(F.count_if(on("a")).alias("total"), F.count_if(on("a") & on("b")).alias("classified"), F.count_if(~on("a")).alias("extra"), F.count_if(F.col("k") > 1).alias("duplicates"), F.count_if(~on("b")).alias("remaining"))


def waiting(contacts: DataFrame, classified: DataFrame) -> DataFrame:
    """Contacts without a label, those with the most messages first."""
    return contacts.join(classified.select("contact_id"), "contact_id", "left_anti").orderBy(F.desc("message_count_total"), "contact_id")


def manifest(contacts: DataFrame, classified: DataFrame, results: DataFrame, size: int = 5) -> DataFrame:
    n = tasks(contacts, classified, results).agg(F.count("*").alias("remaining"))
    a, b = contacts.agg(F.count("*").alias("total")), classified.agg(F.count("*").alias("existing"))
    c = results.agg(F.countDistinct("contact_id").alias("completed"))
    return a.crossJoin(b).crossJoin(c).crossJoin(n).withColumn("shards", F.ceil(F.col("remaining") / size).cast("long"))  # a row each


def bounded_confidence(confidence: Column, strong: Column, medium: Column, span_days: Column, manual: Column, group_only: Column) -> Column:
    """Manual labels are certain; above 0.7 takes two strong or three medium signals; a short span or groups alone cap at 0.5."""
    c = F.when((strong >= 2) | (medium >= 3), confidence).otherwise(F.least(confidence, F.lit(0.7)))
    c = F.when((span_days < 30) | group_only, F.least(c, F.lit(0.5))).otherwise(c)
    return F.when(manual, F.lit(1.0)).otherwise(c)


def label_summary(classified: DataFrame) -> DataFrame:
    return classified.groupBy("label").agg(F.count("*").alias("contacts"), F.count_if(F.col("label_source") == "manual_override").alias("manual_overrides"))


def decayed(severity: Column, age_days: Column) -> Column:
    """Severity by age: kept below 30 days, a level down to 90, then low."""
    lower = F.when(severity == "high", "medium").otherwise("low")
    return F.when(age_days < 30, severity).when(age_days <= 90, lower).otherwise("low")


def general_terms(counts: DataFrame, least_labels: int = 2) -> DataFrame:
    """Terms (term, label) that are used with contacts of two labels or more."""
    return counts.groupBy("term").agg(F.countDistinct("label").alias("labels")).where(F.col("labels") >= least_labels)


def half_year(ts: Column) -> Column:
    return (F.year(ts) * 2 + F.floor((F.month(ts) - 1) / 2 / 3)).cast("long")


def unique_slugs(d: DataFrame, slug: str = "slug") -> DataFrame:
    """Slugs that several contacts share get the first six digits of a digest of the contact's id."""
    n = F.count("*").over(Window.partitionBy(slug))
    return d.withColumn(slug, F.when(n > 1, F.concat(F.col(slug), F.lit("-"), F.substring(F.sha2("contact_id", 256), 1, 6))).otherwise(F.col(slug)))


def violations(classified: DataFrame) -> DataFrame:
    """contact_id, path, code of each row that breaks the schema's constraints."""
    rules = [("label", "invalid_enum", ~F.coalesce(F.col("label").isin(LABELS), F.lit(False))), ("confidence", "out_of_range", ~F.coalesce(F.col("confidence").between(0, 1), F.lit(False))), ("contact_id", "required", F.col("contact_id").isNull())]
    each = F.array(*[F.when(bad, F.struct(F.lit(p).alias("path"), F.lit(c).alias("code"))) for p, c, bad in rules])
    return classified.select("contact_id", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("v")).select("contact_id", "v.path", "v.code")
