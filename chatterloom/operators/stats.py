"""Contact, language, punctuation, structure and timing statistics. Each takes messages and scope columns: [] for all
messages together, ["contact_id"] for each contact. Only own messages with text count, but for timing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import detect_lang, has_text, is_han, letters, pictographs, right_trim, swear_count, tokens, utf16_length
from .counting import counts, parts_of, totalled

BURST_GAP_MS = 300_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
THRESHOLDS = (100, 50)


def mine(m: DataFrame) -> DataFrame:
    return m.where((F.col("sender") == "me") & has_text(F.col("text")))


def ratio(a: Column, n: Column) -> Column:
    return a.cast("double") / F.greatest(n, F.lit(1))


def contact_stats(m: DataFrame) -> DataFrame:
    first, last = F.min("timestamp"), F.max("timestamp")
    days = (F.unix_millis(last) - F.unix_millis(first)) / 86_400_000.0
    return m.groupBy("contact_id").agg(
        F.min_by("contact_name", F.struct("timestamp", "seq")).alias("contact_name"),
        F.count("*").alias("message_count_total"),
        F.count_if(F.col("sender") == "me").alias("message_count_from_me"),
        F.count_if(F.col("sender") != "me").alias("message_count_from_them"),
        first.alias("first_message_at"),
        last.alias("last_message_at"),
        F.greatest(F.lit(1), F.floor(days + 0.5)).cast("long").alias("span_days"),
    )


def passing(stats: DataFrame, total: int = THRESHOLDS[0], each_way: int = THRESHOLDS[1]) -> DataFrame:
    return stats.where((F.col("message_count_total") >= total) & (F.col("message_count_from_me") >= each_way) & (F.col("message_count_from_them") >= each_way))


def filter_report(stats: DataFrame, total: int, each_way: int) -> DataFrame:
    ok = (F.col("message_count_total") >= total) & (F.col("message_count_from_me") >= each_way) & (F.col("message_count_from_them") >= each_way)
    return stats.agg(F.count("*").alias("total_contacts"), F.count_if(ok).alias("passed_count")).select(F.lit(total).cast("long").alias("total_threshold"), F.lit(each_way).cast("long").alias("each_way_threshold"), "total_contacts", "passed_count")


def totals(m: DataFrame, total: int = THRESHOLDS[0], each_way: int = THRESHOLDS[1]) -> DataFrame:
    s = contact_stats(m)
    ok = (F.col("message_count_total") >= total) & (F.col("message_count_from_me") >= each_way) & (F.col("message_count_from_them") >= each_way)
    return s.agg(F.sum("message_count_total").alias("total_messages"), F.sum("message_count_from_me").alias("total_messages_from_me"), F.count("*").alias("total_contacts"), F.count_if(ok).alias("contacts_above_threshold"))


def top_terms(m: DataFrame, scope: list[str], n: int, top: int, least: int = 1, cut: Callable[[Column], Column] = tokens) -> DataFrame:
    """Most frequent n-grams of the tokens that `cut` makes; equal counts by first occurrence. least is met after the cut
    to `top`."""
    words = mine(m).select(*scope, "seq", parts_of(F.col("text"), cut).alias("t"))
    counted = totalled(counts(words, scope, n, top), scope)
    w = Window.partitionBy(*scope).orderBy(F.desc("count"), "seen")
    return counted.withColumn("rank", F.row_number().over(w).cast("long")).where((F.col("rank") <= top) & (F.col("count") >= least)).drop("seen")


def lexical(m: DataFrame, scope: list[str], cut: Callable[[Column], Column] = tokens) -> DataFrame:
    """Tokens are made once: a row for each, of which a message's first carries the message's own numbers; terms are
    then counted in one group-by, and scopes in a second that only adds numbers."""
    t = mine(m).select(*scope, "text", cut(F.col("text")).alias("t"))
    zh = F.size(F.filter("t", is_han)).cast("long")
    # the numbers stand below the generator, which else has them worked out again for each token
    t = t.select(*scope, "t", F.size("t").cast("long").alias("n"), zh.alias("zh"), swear_count(F.col("text")).alias("swears"))
    t = t.select(*scope, F.posexplode_outer("t").alias("pos", "term"), "n", "zh", "swears")
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    once = lambda c, name: F.sum(F.when(first, c).otherwise(0)).alias(name)
    names = ("messages", "n", "zh", "swears", "mixed")
    mixed = ((F.col("zh") > 0) & (F.col("n") > F.col("zh"))).cast("long")
    terms = t.groupBy(*scope, "term").agg(*(once(c, k) for c, k in zip((F.lit(1), F.col("n"), F.col("zh"), F.col("swears"), mixed), names)))
    s = {k: F.sum(k) for k in names}
    return terms.groupBy(*scope).agg(
        F.coalesce(s["n"], F.lit(0)).alias("total_tokens"),
        F.coalesce(s["swears"], F.lit(0)).alias("swear_count"),
        (1000 * ratio(s["swears"], s["messages"])).alias("swears_per_1k"),
        ratio(s["n"] - s["zh"], s["n"]).alias("en_ratio"),
        ratio(s["zh"], s["n"]).alias("zh_ratio"),
        F.lit(0.0).alias("other_ratio"),
        ratio(s["mixed"], s["messages"]).alias("code_switch_rate"),
        F.count("term").alias("unique_tokens"),
    )


def punctuation(m: DataFrame, scope: list[str]) -> DataFrame:
    t = mine(m).withColumn("last", F.right(right_trim(F.col("text")), F.lit(1)))
    c = F.col("text")
    n = F.count("*")
    share = lambda cond, name: ratio(F.count_if(cond), n).alias(name)
    last = F.col("last")
    return t.groupBy(*scope).agg(
        *[share(last == ch, name) for ch, name in ((".", "end_period"), ("!", "end_exclamation"), ("?", "end_question"), ("…", "end_ellipsis"))],
        share((last != "") & ~last.isin(".", "!", "?", "…"), "end_none"),
        (F.sum(letters(c, UPPER)) / F.greatest(F.sum(letters(c, UPPER + UPPER.lower())), F.lit(1))).alias("caps_rate"),
        *[share(c.contains(a) | c.contains(b), name) for a, b, name in (("...", "…", "ellipsis_rate"), ("?", "？", "question_rate"), ("!", "！", "exclamation_rate"), (",", "，", "comma_rate"))],
    )


def emoji(m: DataFrame, scope: list[str]) -> DataFrame:
    k = F.col("k")
    return mine(m).select(*scope, F.size(pictographs(F.col("text"))).cast("long").alias("k")).groupBy(*scope).agg(F.sum(k).alias("emoji_total"), ratio(F.sum(k), F.count("*")).alias("emoji_per_message"), ratio(F.count_if(k > 0), F.count("*")).alias("emoji_message_ratio"))


def top_emoji(m: DataFrame, scope: list[str], top: int = 25) -> DataFrame:
    e = mine(m).select(*scope, "seq", F.posexplode(pictographs(F.col("text"))).alias("pos", "emoji"))
    counted = e.groupBy(*scope, "emoji").agg(F.count("*").alias("count"), F.min(F.struct("seq", "pos")).alias("seen"))
    return counted.withColumn("rank", F.row_number().over(Window.partitionBy(*scope).orderBy(F.desc("count"), "seen")).cast("long")).where(F.col("rank") <= top).drop("seen")


LENGTH_EDGES = ((0, 10), (11, 25), (26, 50), (51, 100), (101, 200), (201, None))


def structure(m: DataFrame, scope: list[str]) -> DataFrame:
    """Length histogram, mean, median and the value at index min(n - 1, floor(0.9 n)), from counts of equal lengths."""
    t = mine(m).select(*scope, utf16_length(F.col("text")).alias("len"))
    counts = t.groupBy(*scope, "len").agg(F.count("*").alias("k"))
    w = Window.partitionBy(*scope).orderBy("len")
    n = F.sum("k").over(Window.partitionBy(*scope))
    at = F.least(n - 1, F.floor(F.lit(0.9) * n))
    placed = counts.withColumn("upto", F.sum("k").over(w)).withColumn("n", n).withColumn("p", F.when((F.col("upto") > at) & (F.col("upto") - F.col("k") <= at), F.col("len")))
    for name, i in (("lo", F.floor((F.col("n") - 1) / 2)), ("hi", F.floor(F.col("n") / 2))):
        placed = placed.withColumn(name, F.when((F.col("upto") > i) & (F.col("upto") - F.col("k") <= i), F.col("len")))
    bins = [F.coalesce(F.sum(F.when((F.col("len") >= a) & (F.col("len") <= b if b else F.lit(True)), F.col("k"))), F.lit(0)).alias(f"len_{a}_{b or 'up'}") for a, b in LENGTH_EDGES]
    return placed.groupBy(*scope).agg(*bins, (F.sum(F.col("len") * F.col("k")) / F.sum("k")).alias("mean_length"), ((F.max("lo") + F.max("hi")) / 2.0).alias("median_length"), F.max("p").alias("p90_length"))


#: Messages are set in order by spans of time of this size, and the spans are then joined at their ends.
SPAN_MS = 86_400_000


def gaps(m: DataFrame, scope: list[str]) -> DataFrame:
    """scope, gap: the gaps (ms) from each message to the next in order of time, and null for the first. A
    scope's messages are never in one task: gaps are taken within spans of time, then between spans, a row each."""
    ms = F.unix_millis("timestamp")
    d = m.select(*scope, ms.alias("ms"), F.floor(ms / SPAN_MS).alias("span"))
    within = d.select(*scope, (F.col("ms") - F.lag("ms").over(Window.partitionBy(*scope, "span").orderBy("ms"))).alias("gap")).where("gap is not null")
    ends = d.groupBy(*scope, "span").agg(F.min("ms").alias("lo"), F.max("ms").alias("hi"))
    return within.unionByName(ends.select(*scope, (F.col("lo") - F.lag("hi").over(Window.partitionBy(*scope).orderBy("span"))).alias("gap")))


def bursts(m: DataFrame, scope: list[str]) -> DataFrame:
    """Runs of own messages with gaps of five minutes at most: count, mean size, mean gaps within and between (s)."""
    g = gaps(m.where("sender = 'me'"), scope)
    inside = F.col("gap") <= BURST_GAP_MS
    n = F.count("*") - F.count_if(inside)
    return g.groupBy(*scope).agg(n.alias("bursts"), (F.count("*") / n).alias("mean_size"), (F.coalesce(F.avg(F.when(inside, F.col("gap"))), F.lit(0.0)) / 1000).alias("mean_gap_within"), (F.coalesce(F.avg(F.when(~inside, F.col("gap"))), F.lit(0.0)) / 1000).alias("mean_gap_between"))


def burst_ids(m: DataFrame, scope: list[str]) -> DataFrame:
    """Own messages with the number of their burst in the scope, from 1: scope, seq, burst."""
    d = m.where("sender = 'me'").withColumn("ms", F.unix_millis("timestamp")).withColumn("span", F.floor(F.col("ms") / SPAN_MS))
    w = Window.partitionBy(*scope, "span").orderBy("ms", "seq")
    ends = d.groupBy(*scope, "span").agg(F.min("ms").alias("lo"), F.max("ms").alias("hi"))
    before = ends.select(*scope, "span", F.lag("hi").over(Window.partitionBy(*scope).orderBy("span")).alias("before"))
    d = d.join(before, [*scope, "span"])
    gap = F.col("ms") - F.coalesce(F.lag("ms").over(w), F.col("before"))
    d = d.withColumn("new", F.coalesce((gap > BURST_GAP_MS).cast("long"), F.lit(1)))
    begun = d.groupBy(*scope, "span").agg(F.sum("new").alias("n"))
    offset = begun.select(*scope, "span", (F.sum("n").over(Window.partitionBy(*scope).orderBy("span")) - F.col("n")).alias("offset"))
    return d.withColumn("k", F.sum("new").over(w)).join(offset, [*scope, "span"]).select(*scope, "seq", (F.col("offset") + F.col("k")).alias("burst"))


def hours(m: DataFrame, scope: list[str]) -> DataFrame:
    h, d = F.hour("timestamp"), F.dayofweek("timestamp") - 1
    return m.where("sender = 'me'").groupBy(*scope).agg(*[F.count_if(h == k).alias(f"h{k:02d}") for k in range(24)], *[F.count_if(d == k).alias(f"d{k}") for k in range(7)])


def replies(m: DataFrame, asker: str = "them") -> DataFrame:
    """Each message of `asker` with the wait for the next of the other side, in the same contact."""
    # from the end, so that the frame only grows: time in proportion to the messages
    w = Window.partitionBy("contact_id").orderBy(F.desc("timestamp"), F.desc("seq")).rowsBetween(Window.unboundedPreceding, -1)
    nxt = F.last(F.when(F.col("sender") != asker, F.col("timestamp")), ignorenulls=True).over(w)
    return m.withColumn("next", nxt).where((F.col("sender") == asker) & F.col("next").isNotNull()).select("contact_id", "seq", (F.unix_millis("next") - F.unix_millis("timestamp")).alias("wait_ms"))


def reply_latency(m: DataFrame, scope: list[str], asker: str = "them") -> DataFrame:
    return replies(m, asker).groupBy(*scope).agg(F.count("*").alias("pairs"), (F.median("wait_ms") / 1000).alias("median_latency_s"))


def languages(m: DataFrame) -> DataFrame:
    return m.where(has_text(F.col("text"))).groupBy("contact_id", detect_lang(F.col("text")).alias("language")).agg(F.count("*").alias("messages"))


#: Parts of a bundle that are lists: their rank sets the order of (term, count).
LISTS = {"words": (1, 50, 1), "bigrams": (2, 30, 1), "trigrams": (3, 20, 3)}


#: Parts of a bundle that are one struct each.
PARTS = {"lexical": lexical, "punctuation": punctuation, "emoji": emoji, "structure": structure, "bursts": bursts, "hours": hours, "latency": reply_latency}


def bundled(m: DataFrame, scope: list[str], only: tuple[str, ...] = (*PARTS, *LISTS, "top_emoji")) -> DataFrame:
    """A row for each scope that has messages, with its statistics (all, or those of `only`) as nested columns; with
    contact_id as the scope also the name and the number of messages, in order of first appearance. The bounds of n-grams
    are worked out at once, so what is not wanted must not be asked for."""
    parts = {name: f(m, scope) for name, f in PARTS.items() if name in only}
    lists = {name: top_terms(m, scope, *how) for name, how in LISTS.items() if name in only}
    if "top_emoji" in only:
        lists["top_emoji"] = top_emoji(m, scope).withColumnRenamed("emoji", "term")
    if scope == ["contact_id"]:
        out = m.groupBy(*scope).agg(F.min_by("contact_name", "seq").alias("contact_name"), F.count("*").alias("message_count"), F.min("seq").alias("first_seq"))
    else:
        out = m.groupBy(*scope).agg(F.count("*").alias("message_count"))

    def put(d: DataFrame) -> DataFrame:
        return out.join(d, scope, "left") if scope else out.crossJoin(d)  # without a scope each is one row

    for name, d in parts.items():
        out = put(d.select(*scope, F.struct(*[c for c in d.columns if c not in scope]).alias(name)))
    for name, d in lists.items():
        rows = d.groupBy(*scope).agg(F.array_sort(F.collect_list(F.struct("rank", "term", "count"))).alias(name))  # as many as the list is long
        out = put(rows.withColumn(name, F.transform(name, lambda x: F.struct(x["term"].alias("term"), x["count"].alias("count")))))
    return out.orderBy("first_seq").drop("first_seq") if scope == ["contact_id"] else out
