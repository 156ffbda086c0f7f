"""Reproducible samples: strides, time strata, quotas and topics."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..functions.text import HAN, ascii_edges, count_of, has_text, utf16_length

BUCKETS = 5
# The terms of each topic.
TOPICS = {
    "gaming": "game games 游戏 开黑 queue 排队 match 对局 排位 rank ranked voice 语音 teammate 队友 win lose loss 输 赢 role 角色 hero 英雄 steam discord vc",
    "tech": "ip 电脑 server 服务器 代码 github bug 域名 dns vpn linux mac windows api 部署 docker",
    "work": "工作 meeting 会议 deadline project 老板 客户 需求 deliverable handoff offer",
    "school": "学校 上课 作业 考试 老师 同学 class exam assignment semester",
    "family": "爸 妈 父母 家里 家庭 family sister brother parents",
    "logistics": "几点 什么时候 地址 到哪 安排 今天 明天 schedule time where when tomorrow",
    "personal_life": "最近 心情 难过 压力 焦虑 开心 身体 生病 情绪 生活 人生 relationship feel miss",
}


def term_pattern(term: str) -> str:
    return "(?i)" + ascii_edges(term) if term.isascii() else term


@F.pandas_udf(LongType())
def topics_of(texts: pd.Series) -> pd.Series:
    """The topics of which a text (as binary) has a term, a bit each: ASCII terms as whole words of any case, the others as
    substrings. A text is cut into words once, for all topics; bytes know the case of ASCII letters only, as is wanted."""

    def bits(text: bytes) -> int:
        words = set(_WORDS(text.lower()))
        return sum(1 << k for k, (whole, parts) in enumerate(_TERMS) if not whole.isdisjoint(words) or any(x in text for x in parts))

    return texts.map(bits)


_WORDS = re.compile(rb"[A-Za-z0-9_]+").findall
_TERMS = [({w.encode() for w in words.split() if w.isascii()}, [w.encode() for w in words.split() if not w.isascii()]) for words in TOPICS.values()]


def picked(n: Column, count: Column, rank: Column) -> Column:
    """Whether 0-based rank is floor(i * (count / n)) for an i below n, for n below count."""
    step = count.cast("double") / F.greatest(n, F.lit(1))
    i = F.ceil(rank / step)
    near = [F.greatest(F.lit(0), i + k) for k in (-1, 0, 1)]
    hit = F.lit(False)
    for k in near:
        hit = hit | ((k < n) & (F.floor(k * step) == rank))
    return (n > 0) & hit


def uniform_stride(m: DataFrame, scope: list[str], n: int, order: tuple = ("timestamp", "seq")) -> DataFrame:
    w = Window.partitionBy(*scope)
    d = m.withColumn("__n", F.count("*").over(w)).withColumn("__r", F.row_number().over(w.orderBy(*order)) - 1)
    return d.where((F.col("__n") <= n) | picked(F.lit(n), F.col("__n"), F.col("__r"))).drop("__n", "__r")


def with_strata(m: DataFrame, scope: list[str], n: Column, buckets: Column | int, chosen: str, among: Column | None = None) -> DataFrame:
    """m with a flag `chosen`: at most n messages of each scope (of those for which `among` holds), evenly from equal
    spans of time; what sparse spans lack comes from the rest by stride. n is the same for all rows of a scope."""
    among = F.lit(True) if among is None else among
    buckets = F.lit(buckets) if isinstance(buckets, int) else buckets
    ms = F.unix_millis("timestamp")
    d = m.withColumn("__a", among).withColumn("__want", n)
    w = Window.partitionBy(*scope, "__a")
    d = d.withColumn("__n", F.count("*").over(w)).withColumn("__lo", F.min(ms).over(w)).withColumn("__hi", F.max(ms).over(w))
    flat = F.col("__hi") == F.col("__lo")
    size = (F.col("__hi") - F.col("__lo")) / buckets.cast("double")
    d = d.withColumn("__b", F.when(flat, F.lit(0)).otherwise(F.least(buckets - 1, F.floor((ms - F.col("__lo")) / size))).cast("int"))
    bw = Window.partitionBy(*scope, "__a", "__b")
    d = d.withColumn("__k", F.count("*").over(bw)).withColumn("__r", F.row_number().over(bw.orderBy("timestamp", "seq")) - 1)
    want = F.col("__want")
    quota = F.when(flat, want).otherwise(F.floor(want / buckets) + (F.col("__b") < want % buckets).cast("int"))
    take = F.col("__a") & (want > 0) & ((F.col("__n") <= want) | (F.col("__k") <= quota) | picked(quota, F.col("__k"), F.col("__r")))
    d = d.withColumn("__t", F.coalesce(take, F.lit(False)))
    d = d.withColumn("__gap", F.when(F.col("__n") <= want, F.lit(0)).otherwise(F.greatest(F.lit(0), want - F.sum(F.col("__t").cast("long")).over(w))))
    rw = Window.partitionBy(*scope, "__a", "__t")
    d = d.withColumn("__q", F.row_number().over(rw.orderBy("timestamp", "seq")) - 1).withColumn("__m", F.count("*").over(rw))
    extra = F.col("__a") & ~F.col("__t") & (F.col("__gap") > 0) & ((F.col("__m") <= F.col("__gap")) | picked(F.col("__gap"), F.col("__m"), F.col("__q")))
    return d.withColumn(chosen, F.col("__t") | extra).drop("__a", "__want", "__n", "__lo", "__hi", "__b", "__k", "__r", "__t", "__gap", "__q", "__m")


def time_stratified(m: DataFrame, scope: list[str], n: int | Column, buckets: int = BUCKETS) -> DataFrame:
    """At most n messages for each scope, spread over time. n may be a column that is the same for all rows of a scope."""
    return with_strata(m, scope, F.lit(n) if isinstance(n, int) else n, buckets, "__chosen").where("__chosen").drop("__chosen")


def label_quotas(classified: DataFrame, total: int) -> DataFrame:
    """label, contacts, label_quota of a persona sample."""
    quotas = persona_quota(classified.where("label <> 'unclassified'"), total)
    return quotas.groupBy("label").agg(F.count("*").alias("contacts"), F.max("label_quota").alias("label_quota")).orderBy("label")


def persona_quota(classified: DataFrame, total: int) -> DataFrame:
    """total split over labels in order of their first contact, then over each label's contacts; first ones get the rest."""
    first = classified.groupBy("label").agg(F.min("seq").alias("first"), F.count("*").alias("contacts"))
    w = Window.orderBy("first")  # a row for each label
    labels = first.withColumn("i", F.row_number().over(w) - 1).withColumn("n", F.count("*").over(Window.partitionBy()))
    labels = labels.withColumn("label_quota", F.floor(F.lit(total) / F.col("n")) + (F.col("i") < F.lit(total) % F.col("n")).cast("long"))
    d = classified.join(F.broadcast(labels), "label").withColumn("j", F.row_number().over(Window.partitionBy("label").orderBy("seq")) - 1)
    return d.select("contact_id", "label", "label_quota", (F.floor(F.col("label_quota") / F.col("contacts")) + (F.col("j") < F.col("label_quota") % F.col("contacts")).cast("long")).alias("quota"))


TOPIC_OF = {w: t for t, words in TOPICS.items() for w in words.split()}
TOP_TERMS = 10


def topic_terms(text: Column) -> Column:
    """The topics' terms that a text holds, in lower case and as often as it holds them: ASCII ones as whole words by one
    search, the others as substrings, in texts with Han characters only."""
    whole = F.transform(F.regexp_extract_all(text, F.lit(term_pattern("|".join(w for w in TOPIC_OF if w.isascii()))), F.lit(0)), F.lower)
    parts = F.flatten(F.array(*[F.array_repeat(F.lit(w), count_of(text, w).cast("int")) for w in TOPIC_OF if not w.isascii()]))
    return F.when(text.rlike(HAN), F.concat(whole, parts)).otherwise(whole)


def topic_profile(m: DataFrame, scope: list[str]) -> DataFrame:
    """For each scope and topic: messages with a term of it, uses of terms, and the ten most used (term, count), equal
    counts in the order of the terms. Topics that no message has are there with zeros."""
    d = m.where(has_text(F.col("text"))).select(*scope, topic_terms(F.col("text")).alias("terms"))
    of = F.create_map(*[F.lit(x) for pair in TOPIC_OF.items() for x in pair])
    d = d.select(*scope, "terms", F.transform("terms", lambda t: of[t]).alias("topics"))
    # a hit counts its message if it is the first of its topic there; a hit without a topic stands for each scope
    hits = d.select(*scope, F.posexplode_outer("terms").alias("pos", "term"), "topics").withColumn("topic", of[F.col("term")])
    first = F.array_position("topics", F.col("topic")) == F.col("pos") + 1
    counted = hits.groupBy(*scope, "topic", "term").agg(F.count("*").alias("count"), F.count_if(first).alias("messages"))
    every = counted.select(*scope, F.explode(F.array(*map(F.lit, TOPICS))).alias("topic"), F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("count"), F.lit(0).cast("long").alias("messages")).distinct()
    counted = counted.where("topic is not null").unionByName(every)
    pairs = F.collect_list(F.when(F.col("term").isNotNull(), F.struct((-F.col("count")).alias("less"), "term")))  # a topic has few terms
    out = counted.groupBy(*scope, "topic").agg(F.sum("messages").alias("message_count"), F.sum("count").alias("match_count"), F.array_sort(pairs).alias("p"))
    return out.select(*scope, "topic", "message_count", "match_count", F.transform(F.slice("p", 1, TOP_TERMS), lambda x: F.struct(x["term"].alias("term"), (-x["less"]).alias("count"))).alias("top_terms"))


def total_text_chars(m: DataFrame, scope: list[str]) -> DataFrame:
    return m.groupBy(*scope).agg(F.coalesce(F.sum(utf16_length(F.col("text"))), F.lit(0)).alias("chars"))


#: Share of a topic-aware sample that goes by time alone.
BY_TIME = 0.65


def topic_aware(m: DataFrame, n: int, buckets: int = BUCKETS) -> DataFrame:
    """contact_id, seq of samples that keep sparse topics: a share by time, the rest over the contact's topics, those
    with the most messages first, each by stride over all its messages; what is left goes by time again. Each topic's
    share depends on what was chosen before, so there is a pass for each; all are windows over the same partitioning,
    on rows of a few numbers."""
    n = max(1, n)
    own = Window.partitionBy("contact_id")
    d = m.select("contact_id", "seq", "timestamp", topics_of(F.coalesce("text", F.lit("")).cast("binary")).alias("bits"))
    flags = F.array(*[F.col("bits").bitwiseAND(1 << k) != 0 for k in range(len(TOPICS))])
    # rows are few bytes but windows many, so contacts are not put together in one task
    tasks = int(m.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = d.select("contact_id", "seq", "timestamp", flags.alias("flags")).repartition(tasks, "contact_id").withColumn("total", F.count("*").over(own))
    d = with_strata(d, ["contact_id"], F.lit(max(1, int(n * BY_TIME))), buckets, "got")
    numbers = F.array(*[F.struct((-F.sum(F.element_at("flags", k + 1).cast("long")).over(own)).alias("less"), F.lit(k + 1).alias("at")) for k in range(len(TOPICS))])
    d = d.withColumn("ranked", F.array_sort(F.filter(numbers, lambda x: x["less"] < 0))).withColumn("active", F.size("ranked"))
    for i in range(len(TOPICS)):
        d = d.withColumn("left", n - F.sum(F.col("got").cast("long")).over(own))
        d = d.withColumn("is", F.coalesce(F.element_at("flags", F.get("ranked", F.lit(i))["at"]), F.lit(False)))
        w = Window.partitionBy("contact_id", "is")
        d = d.withColumn("k", F.count("*").over(w)).withColumn("r", F.row_number().over(w.orderBy("timestamp", "seq")) - 1)
        quota = F.greatest(F.lit(1), F.ceil(F.col("left") / F.greatest(F.lit(1), F.col("active") - i)))
        d = d.withColumn("got", F.col("got") | F.col("is") & (F.col("left") > 0) & ((F.col("k") <= quota) | picked(quota, F.col("k"), F.col("r"))))
    d = d.withColumn("left", n - F.sum(F.col("got").cast("long")).over(own)).withColumn("had", F.col("got"))
    d = with_strata(d, ["contact_id"], F.col("left"), buckets, "more", ~F.col("had"))
    return d.where((F.col("total") <= n) | F.col("got") | F.col("more")).select("contact_id", "seq")


def sample_plan(m: DataFrame, cutoff: int = 30_000) -> DataFrame:
    """contact_id, chars, strategy (full for contacts of at most `cutoff` characters of text, else by topic and time) and
    topic profile: a row (topic, message_count, match_count, top_terms) for each topic, in the topics' order."""
    strategy = F.when(F.col("chars") <= cutoff, "full").otherwise("topic_time_stratified")
    place = F.array_position(F.array(*map(F.lit, TOPICS)), F.col("topic"))
    rows = topic_profile(m.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" "))), ["contact_id"])  # no text is empty, so no contact is missing
    profile = rows.groupBy("contact_id").agg(F.array_sort(F.collect_list(F.struct(place.alias("at"), "topic", "message_count", "match_count", "top_terms"))).alias("p"))  # seven rows each
    profile = profile.select("contact_id", F.transform("p", lambda x: x.dropFields("at")).alias("topic_profile"))
    return total_text_chars(m, ["contact_id"]).withColumn("strategy", strategy).join(profile, "contact_id", "left")


def contact_sample(m: DataFrame, n: int = 200, cutoff: int = 30_000, buckets: int = BUCKETS) -> DataFrame:
    """contact_id, seq of each contact's sample: all messages with a text of contacts of at most `cutoff` characters, else a
    topic-aware one."""
    m = m.where(F.col("text").isNotNull())
    d = m.join(total_text_chars(m, ["contact_id"]), "contact_id")
    whole = d.where(F.col("chars") <= cutoff).select("contact_id", "seq")
    return whole.unionByName(topic_aware(d.where(F.col("chars") > cutoff), n, buckets))


def persona_sample(m: DataFrame, classified: DataFrame, total: int = 800, buckets: int = BUCKETS) -> DataFrame:
    """contact_id, seq, label: own messages with a text, by time, as many for each contact as its quota says.
    Unclassified contacts give none."""
    quota = persona_quota(classified.where("label <> 'unclassified'"), total).select("contact_id", "label", F.col("quota").alias("__quota"))
    d = m.where((F.col("sender") == "me") & F.col("text").isNotNull()).join(quota, "contact_id")
    return time_stratified(d, ["contact_id"], F.col("__quota"), buckets).select("contact_id", "seq", "label")
