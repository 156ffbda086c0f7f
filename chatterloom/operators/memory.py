"""Rules on what is remembered of contacts: shared jokes, topics, merges of old and new findings, roll-back and archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .classify import half_year

# Sources of a correction, the strongest first; and how each section of a document is merged (open
# threads and sensitivities have rules of their own: merge_threads here, decayed in classify).
CORRECTIONS = "agent_hard agent_soft person_hard person_soft tone_register_hard tone_register_soft tone_hard tone_soft agent_body person_body tone_register_table tone_body".split()
STRATEGIES = {
    "quick rules": "replace",
    "lexical fingerprint": "replace",
    "punctuation and caps": "replace",
    "emoji": "replace",
    "message structure": "replace",
    "conversational moves": "replace",
    "register table": "replace",
    "timing and latency": "replace",
    "hard don'ts": "append",
    "corrections": "preserve",
    "manual notes": "preserve",
    "address terms": "replace",
    "timeline": "append",
    "recurring topics": "replace",
    "inside jokes": "append",
    "communication rhythm": "replace",
    "conflict patterns": "append",
    "last state": "replace",
    "snapshot": "replace",
}


def register_shifts(stats: DataFrame, rates: list[str], least_contacts: int = 2) -> DataFrame:
    """For each label of enough contacts, the mean of each rate over its contacts less the mean over all contacts.
    stats: a row for each contact with its label."""
    d = stats.groupBy("label").agg(F.count("*").alias("contacts"), *[F.sum(r).alias(f"__s_{r}") for r in rates], *[F.count(r).alias(f"__n_{r}") for r in rates])
    whole = Window.partitionBy()  # labels are a small fixed set
    total = {r: F.sum(f"__s_{r}").over(whole) / F.sum(f"__n_{r}").over(whole) for r in rates}
    d = d.select("label", "contacts", *[(F.col(f"__s_{r}") / F.col(f"__n_{r}") - total[r]).alias(f"{r}_shift") for r in rates])
    return d.where(F.col("contacts") >= least_contacts)


def inside_jokes(counts: DataFrame, least: int = 3, elsewhere: int = 2) -> DataFrame:
    """Terms said `least` times with a contact and fewer than `elsewhere` times with any other. counts: contact_id,
    term, count, one row a pair. The two largest counts of a term tell all, so no window over a term is needed."""
    best = counts.groupBy("term").agg(F.max(F.struct("count", "contact_id")).alias("a"), F.count_if(F.col("count") >= elsewhere).alias("k"))
    return best.where((F.col("a.count") >= least) & (F.col("k") == 1)).select(F.col("a.contact_id").alias("contact_id"), "term", F.col("a.count").alias("count"))


def recurring(counts: DataFrame, least: int = 5) -> DataFrame:
    return counts.where(F.col("count") >= least)


def open_threads(threads: DataFrame, now: Column, days: int = 90) -> DataFrame:
    """Threads whose last message is at most `days` days before now."""
    return threads.where(F.datediff(now, F.col("last_message_at")).between(0, days))


def last_messages(messages: DataFrame, n: int = 50) -> DataFrame:
    """The last n messages of each contact."""
    w = Window.partitionBy("contact_id").orderBy(F.desc("timestamp"), F.desc("seq"))
    return messages.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def merge_sections(old: DataFrame, new: DataFrame, strategies: dict[str, str] = STRATEGIES) -> DataFrame:
    """contact_id, section, body (a list of lines) by each section's strategy: replace takes the new lines where
    there are any, append adds new lines that are not there yet, preserve keeps the old lines. Sections without a
    strategy are preserved."""
    o = old.select("contact_id", "section", F.col("body").alias("__o"))
    d = o.join(new.select("contact_id", "section", F.col("body").alias("__n")), ["contact_id", "section"], "full")
    by = lambda s: F.col("section").isin([k for k, v in strategies.items() if v == s])
    none = F.expr("cast(array() as array<string>)")
    added = F.array_distinct(F.concat(F.coalesce("__o", none), F.coalesce("__n", none)))
    body = F.when(by("replace"), F.coalesce("__n", "__o")).when(by("append"), added).otherwise(F.coalesce("__o", "__n"))
    return d.select("contact_id", "section", body.alias("body"))


def merge_threads(old: DataFrame, new: DataFrame) -> DataFrame:
    """contact_id, thread, status, last_seen: threads of the new findings as they are; those that only the old ones have
    stay and are marked as resolved or stale, last seen when they last were. old, new: contact_id, thread, status, last_seen."""
    o = old.select("contact_id", "thread", F.col("last_seen").alias("__seen"))
    d = o.join(new, ["contact_id", "thread"], "full")
    return d.select("contact_id", "thread", F.coalesce("status", F.lit("resolved or stale")).alias("status"), F.coalesce("last_seen", "__seen").alias("last_seen"))


#: Contacts with more messages than this are read in windows of half a year.
CHUNK_TRIGGER = 5000


def chunks(m: DataFrame, trigger: int = CHUNK_TRIGGER) -> DataFrame:
    """contact_id, half, messages, first_at, last_at: the windows in which a contact is read; half is null for a contact
    that is read at once."""
    each = m.groupBy("contact_id", half_year(F.col("timestamp")).alias("h")).agg(F.count("*").alias("k"), F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    large = F.sum("k").over(Window.partitionBy("contact_id")) > trigger
    return each.withColumn("half", F.when(large, F.col("h"))).groupBy("contact_id", "half").agg(F.sum("k").alias("messages"), F.min("a").alias("first_at"), F.max("b").alias("last_at"))


#: Kinds of findings that only the last window tells.
OF_LAST_WINDOW = ("thread", "last_state")


def merge_windows(found: DataFrame) -> DataFrame:
    """Findings of windows (contact_id, half, kind, item, count, first_seen, severity) as those of contacts: equal items are
    one, with counts added, the earliest first_seen and the highest severity; threads and last states of the last
    window only."""
    last = F.max("half").over(Window.partitionBy("contact_id"))
    d = found.withColumn("__last", last).where(~F.col("kind").isin(*OF_LAST_WINDOW) | (F.col("half") == F.col("__last")))
    return d.groupBy("contact_id", "kind", "item").agg(F.sum("count").alias("count"), F.min("first_seen").alias("first_seen"), F.max("severity").alias("severity"))


def roll_back(old: DataFrame, new: DataFrame, labels: float = 0.3, sensitivities: float = 0.5) -> DataFrame:
    """One row: the share of contacts with another label and of sensitivities that went, and whether to roll back.
    old, new: contact_id, label, sensitivities (a count)."""
    o = old.select("contact_id", F.col("label").alias("a"), F.col("sensitivities").alias("s"))
    n = new.select("contact_id", F.col("label").alias("b"), F.col("sensitivities").alias("t"))
    d = o.join(n, "contact_id", "full")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    gone = F.greatest(F.coalesce("s", F.lit(0)) - F.coalesce("t", F.lit(0)), F.lit(0))
    had = F.coalesce(F.sum("s"), F.lit(0))
    d = d.agg((F.count_if(both & (F.col("a") != F.col("b"))) / F.greatest(F.count_if(both), F.lit(1))).alias("changed"), (F.coalesce(F.sum(gone), F.lit(0)) / F.greatest(had, F.lit(1))).alias("deleted"))
    return d.withColumn("roll_back", (F.col("changed") > labels) | (F.col("deleted") > sensitivities))


def confidence_drops(old: DataFrame, new: DataFrame, least: float = 0.15) -> DataFrame:
    d = old.select("contact_id", F.col("confidence").alias("before")).join(new.select("contact_id", F.col("confidence").alias("after")), "contact_id")
    return d.where(F.round(F.col("before") - F.col("after"), 9) > least)


def archived(remembered: DataFrame, passing: DataFrame) -> DataFrame:
    """Contacts that are remembered and no longer pass the threshold."""
    return remembered.select("contact_id").distinct().join(passing.select("contact_id"), "contact_id", "left_anti")


def strongest(corrections: DataFrame, order: list[str] = CORRECTIONS) -> DataFrame:
    """contact_id, field, value, source: of several corrections of a field, the one of the strongest source, then
    the latest (seq). Unknown sources come last."""
    at = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col("source")), F.lit(0)), F.lit(len(order) + 1))
    best = F.min_by(F.struct("value", "source"), F.struct(at, -F.col("seq"))).alias("b")
    return corrections.groupBy("contact_id", "field").agg(best).select("contact_id", "field", "b.value", "b.source")


def anchored_rate(rate: Column) -> Column:
    """A rate as "1 per N messages (X.Y%)"."""
    return F.when(rate > 0, F.format_string("1 per %d messages (%.1f%%)", F.round(1 / F.when(rate > 0, rate)).cast("long"), F.round(rate * 100, 1))).otherwise("never (0.0%)")


def too_long(rows: DataFrame, quote: int = 30, evidence: int = 60) -> DataFrame:
    """Rows (id, kind, text) whose quotation or evidence is longer than allowed."""
    limit = F.when(F.col("kind") == "quote", quote).when(F.col("kind") == "evidence", evidence)
    return rows.where(F.length("text") > limit).select("id", "kind", F.length("text").cast("long").alias("length"))
