"""Group-chat contexts and weak relationship signals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WS, has_text, normal_identity, tokens, utf16_length
from .counting import counts, parts_of, totalled, uses

# Words that are not counted as terms.
STOPWORDS = "the and you that this for with have not are was but just 啊 吗 吧 呢 的 了 是 我 你 他 她 它 们 在 就 都 和".split()


def as_messages(g: DataFrame) -> DataFrame:
    return g.select(F.col("group_id").alias("contact_id"), F.col("group_name").alias("contact_name"), "timestamp", F.when(F.col("sender") == "me", "me").otherwise("them").alias("sender"), "text", "platform", "seq")


def tone_counts(g: DataFrame) -> DataFrame:
    return g.agg(F.count("*").alias("total_messages"), F.count_if(F.col("sender") == "me").alias("messages_from_me"), F.countDistinct("group_id").alias("groups"))


def contexts(g: DataFrame) -> DataFrame:
    """Groups, those with the most messages first."""
    return g.groupBy("group_id").agg(F.count("*").alias("messages"), F.count_if(F.col("sender") == "me").alias("messages_from_me"), F.countDistinct("participant_id").alias("participants"), F.min("timestamp").alias("first_at"), F.max("timestamp").alias("last_at")).orderBy(F.desc("messages"), "group_id")


def top_participants(g: DataFrame, top: int = 20) -> DataFrame:
    c = g.where("sender <> 'me'").groupBy("group_id", "participant_id").agg(F.count("*").alias("messages"), F.min_by("participant_name", "seq").alias("participant_name"), F.min("seq").alias("seen"))
    w = Window.partitionBy("group_id").orderBy(F.desc("messages"), "seen")
    return c.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= top).drop("seen")


def top_terms(g: DataFrame, top: int = 25, only_me: bool = False, cut: Callable[[Column], Column] = tokens) -> DataFrame:
    """Most used terms of two characters or more that are no stop words; equal counts by first occurrence. Terms are
    counted within tasks, so a group's messages make a row for each term of a part of them, not for each use."""
    g = g.where(has_text(F.col("text")))
    own = (g.where("sender = 'me'") if only_me else g).select("group_id", "seq", parts_of(F.col("text"), cut).alias("t"))
    told = counts(own, ["group_id"], 1, top).where((utf16_length(F.col("term")) > 1) & ~F.col("term").isin(STOPWORDS))
    c = totalled(told, ["group_id"])
    return c.withColumn("rank", F.row_number().over(Window.partitionBy("group_id").orderBy(F.desc("count"), "seen")).cast("long")).where(F.col("rank") <= top).drop("seen")


TOP_ADDRESS_TERMS = 10


def mentions(g: DataFrame, terms: DataFrame) -> DataFrame:
    """Uses of terms (group_id, term) in the own messages of their group: group_id, term, count. Messages stay where they
    are, and each is read once, however many terms its group has."""
    asked = terms.select("group_id", F.regexp_replace("term", f"^{WS}+|{WS}+$", "").alias("term")).where(utf16_length(F.col("term")) >= 2).distinct()
    own = g.where((F.col("sender") == "me") & has_text(F.col("text"))).select("group_id", "text")
    return uses(own, asked, "group_id")


def signals(g: DataFrame, contacts: DataFrame) -> DataFrame:
    """Contacts met in groups, by id or name, with the ids and names that matched (sorted), the groups shared, messages
    and the ten terms that own messages there address them by (term, count; most used first, then by term). A message
    counts once for each of the two keys that match, as the format defines; own messages of shared groups once.
    Evidence of groups is weak."""
    keys = lambda d, a, b, *more: d.select(*more, F.explode(F.array_distinct(F.array(normal_identity(F.col(a)), normal_identity(F.col(b))))).alias("key")).where("key <> ''")
    per = keys(g, "participant_id", "participant_name", "group_id", "participant_id", "participant_name").groupBy("key", "group_id", "participant_id", "participant_name").agg(F.count("*").alias("n"))
    hit = keys(contacts, "contact_id", "contact_name", "contact_id", "contact_name").join(per, "key")
    each = hit.groupBy("contact_id", "contact_name", "group_id", "participant_id", "participant_name").agg(F.sum("n").alias("n"))
    own = g.where("sender = 'me'").groupBy("group_id").agg(F.count("*").alias("own"))
    by_group = each.groupBy("contact_id", "contact_name", "group_id").agg(F.sum("n").alias("n"), F.collect_set("participant_id").alias("ids"), F.collect_set("participant_name").alias("names"))
    people = by_group.join(own, "group_id", "left").groupBy("contact_id", "contact_name").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("matched_participant_ids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("matched_participant_names"),
        F.count("*").alias("shared_groups"),
        F.coalesce(F.sum("own"), F.lit(0)).alias("messages_from_me"),
        F.sum("n").alias("messages_from_participant"),
    )
    trim = lambda c: F.regexp_replace(c, f"^{WS}+|{WS}+$", "")
    names = each.select("contact_id", "group_id", F.explode(F.array("contact_name", "participant_name")).alias("term"))
    names = names.select("contact_id", "group_id", trim("term").alias("term")).distinct()
    # a name is asked of in all groups that its contact shares, whichever it was met in
    names = names.select("contact_id", "term").distinct().join(names.select("contact_id", "group_id").distinct(), "contact_id")
    used = names.join(mentions(g, names.select("group_id", "term")), ["group_id", "term"]).groupBy("contact_id", "term").agg(F.sum("count").alias("count"))
    rank = F.row_number().over(Window.partitionBy("contact_id").orderBy(F.desc("count"), "term"))
    top = used.withColumn("rank", rank).where(F.col("rank") <= TOP_ADDRESS_TERMS).groupBy("contact_id").agg(F.array_sort(F.collect_list(F.struct("rank", "term", "count"))).alias("t"))
    terms = F.coalesce(F.transform("t", lambda x: F.struct(x["term"].alias("term"), x["count"].alias("count"))), F.expr("cast(array() as array<struct<term:string,count:bigint>>)"))
    out = people.join(top, "contact_id", "left").withColumn("address_terms_from_me", terms).drop("t")
    return out.select("*", F.lit("group_chat").alias("evidence_source"), F.lit("weak").alias("weight")).orderBy(F.desc("shared_groups"), F.desc("messages_from_participant"), "contact_id")
