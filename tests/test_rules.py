"""Expected values that the message formats state, as literals."""

import random

import pytest
from pyspark.sql import functions as F

from chatterloom.operators import classify, memory, sampling, schemas, stats


def test_user_set_labels_stand(spark):
    contacts = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "contact_id string")
    had = spark.createDataFrame([("a", "friend", "manual_override", 0.9), ("b", "friend", "correction_override", 0.8), ("c", "friend", "classifier", 0.7), ("d", "friend", "classifier", 0.6)], "contact_id string, label string, label_source string, confidence double")
    new = spark.createDataFrame([(x, "acquaintance", "classifier", 0.5, i) for i, x in enumerate("abc")] + [("c", "work_peer", "classifier", 0.4, 9)], "contact_id string, label string, label_source string, confidence double, seq long")
    got = {r["contact_id"]: (r["label"], r["label_source"], r["confidence"], r["missing"], r["duplicate"]) for r in classify.merge(contacts, had, new).collect()}
    assert got == {"a": ("friend", "manual_override", 0.9, False, False), "b": ("friend", "correction_override", 0.8, False, False), "c": ("work_peer", "classifier", 0.4, False, True), "d": ("friend", "classifier", 0.6, False, False), "e": (None, None, None, True, False)}


def test_sample_plan(spark):
    m = spark.createDataFrame([("full", 1, "game game 开黑"), ("full", 2, "meeting about the game"), ("long", 3, "x" * 30_001), ("none", 4, None)], "contact_id string, seq long, text string")
    got = {r["contact_id"]: r for r in sampling.sample_plan(m).collect()}
    assert {k: r["strategy"] for k, r in got.items()} == {"full": "full", "long": "topic_time_stratified", "none": "full"}
    profile = {p["topic"]: p for p in got["full"]["topic_profile"]}
    assert [p["topic"] for p in got["full"]["topic_profile"]] == list(sampling.TOPICS)
    assert (profile["gaming"]["message_count"], profile["gaming"]["match_count"]) == (2, 4) and [tuple(t) for t in profile["gaming"]["top_terms"]] == [("game", 3), ("开黑", 1)]
    assert (profile["work"]["message_count"], profile["family"]["match_count"]) == (1, 0) and got["none"]["topic_profile"][0]["match_count"] == 0


def stride(items, n):
    return items if len(items) <= n else [items[int(i * (len(items) / n))] for i in range(n)]


def strata(items, n):
    if len(items) <= n:
        return items
    lo, hi = items[0][0], items[-1][0]
    if lo == hi:
        return stride(items, n)
    spans = [[x for x in items if min(4, int((x[0] - lo) / ((hi - lo) / 5))) == k] for k in range(5)]
    got = [x for k, s in enumerate(spans) for x in stride(s, n // 5 + (k < n % 5))]
    return got + stride([x for x in items if x not in got], n - len(got)) if len(got) < n else got


@pytest.mark.parametrize("seed", range(4))
def test_topic_aware_against_a_model(spark, seed):
    rng = random.Random(seed)
    words = ["game", "server", "meeting", "exam", "family", "tomorrow", "miss", "word", "other", "text"]
    rows, want = [], set()
    n = rng.choice([7, 20, 33])
    for c in ("a", "b", "c"):
        k = rng.choice([5, 60, 200])
        items = sorted((rng.randint(0, rng.choice([1, 50, 10_000])), i, " ".join(rng.choices(words, weights=[3, 1, 1, 1, 1, 2, 1, 30, 30, 30], k=4))) for i in range(k))
        rows += [(c, i, t, text) for t, i, text in items]
        items = [(t, i, {k for k, w in enumerate(sampling.TOPICS.values()) if set(text.split()) & set(w.split())}) for t, i, text in items]
        got = list(items if len(items) <= n else strata(items, max(1, int(n * 0.65))))
        by = sorted(((-len(s), k, s) for k in range(7) if (s := [x for x in items if k in x[2]])), key=lambda x: x[:2])
        for i, (_, _, s) in enumerate(by):
            if n - len(got) > 0:
                got += [x for x in stride(s, max(1, -(-(n - len(got)) // (len(by) - i)))) if x not in got]
        if len(items) > n > len(got):
            got += strata([x for x in items if x not in got], n - len(got))
        want |= {(c, x[1]) for x in got}
    m = spark.createDataFrame(rows, "contact_id string, seq long, t long, text string").withColumn("timestamp", F.timestamp_millis(F.col("t")))
    assert {tuple(r) for r in sampling.topic_aware(m, n).collect()} == want


def test_bursts_across_spans(spark):
    at = [0, 100, 86_399_900, 86_400_100, 86_400_200, 3 * 86_400_000, 3 * 86_400_000]
    m = spark.createDataFrame([("a", i, t, "me") for i, t in enumerate(at)], "contact_id string, seq long, t long, sender string").withColumn("timestamp", F.timestamp_millis(F.col("t")))
    for scope in ([], ["contact_id"]):
        assert [r["burst"] for r in stats.burst_ids(m, scope).orderBy("seq").collect()] == [1, 1, 2, 2, 2, 3, 3]
        r = stats.bursts(m, scope).first()
        assert r["bursts"] == 3 and r["mean_size"] == pytest.approx(7 / 3) and r["mean_gap_within"] == pytest.approx((100 + 200 + 100 + 0) / 4 / 1000)


def test_merged_findings(spark):
    cols = "contact_id string, thread string, status string, last_seen string"
    old = spark.createDataFrame([("a", "trip", "open", "2024-01"), ("a", "flat", "open", "2024-02")], cols)
    new = spark.createDataFrame([("a", "trip", "stalled", "2024-05"), ("a", "job", "open", "2024-06")], cols)
    assert {tuple(r)[1:] for r in memory.merge_threads(old, new).collect()} == {("trip", "stalled", "2024-05"), ("flat", "resolved or stale", "2024-02"), ("job", "open", "2024-06")}


def good_contact():
    return {
        "contact_id": "a", "contact_name": "A", "username": None, "message_count_total": 3, "message_count_from_me": 1, "message_count_from_them": 2, "first_message_at": "2024-01-01T00:00:00.000Z", "last_message_at": "2024-02-01T00:00:00Z",
        "span_days": 31, "label": "friend", "confidence": 0.5, "label_source": "classifier", "signals": [{"type": "t", "evidence": "e", "weight": "weak"}], "alt_labels": [{"label": "work_peer", "confidence": 1}], "context_tags": ["gaming"],
    }


def test_schemas():
    assert schemas.issues("classified_contacts", [good_contact()]) == []
    bad = good_contact() | {"label": "enemy", "confidence": 1.5, "signals": [{"type": "t", "evidence": "e", "weight": "huge"}], "span_days": 1.5, "first_message_at": "soon"}
    del bad["alt_labels"]
    assert {(p, c) for p, c, _ in schemas.issues("classified_contacts", [good_contact(), bad])} == {("1.label", "invalid_enum_value"), ("1.confidence", "too_big"), ("1.signals.0.weight", "invalid_enum_value"), ("1.span_days", "invalid_type"), ("1.first_message_at", "invalid_date"), ("1.alt_labels", "invalid_type")}
    assert schemas.issues("config", {"platform": "wechat", "export_path": "x", "my_name": "Me"}) == []
    assert [p for p, *_ in schemas.issues("config", {"platform": "pigeon", "export_path": 1, "my_name": "Me", "redaction": {"custom_patterns": [{"pattern": ""}]}})] == ["platform", "export_path", "redaction.custom_patterns.0.pattern", "redaction.custom_patterns.0.added_at"]
    for name in schemas.SCHEMAS:
        assert schemas.issues(name, 7)[0][1] == "invalid_type"
    finding = {"claim": "c", "anchor": {"count": 1, "rate": "r", "denominator": 0}, "examples": ["x" * 31] * 4, "generalizes": True, "register_locked": None}
    names = ("lexical_fingerprint", "punctuation_and_caps", "emoji", "message_structure", "conversational_moves", "hard_donts")
    doc = {"generated_at": "t", "source_stats_path": "p", "categories": dict.fromkeys(names, []) | {"emoji": [finding]}, "register_table": {"friend": {}}}
    assert {c for p, c, _ in schemas.issues("persona_findings", doc) if p.startswith("categories.emoji.0")} == {"too_small", "too_big"}


def test_topics_of_texts(spark):
    """As the terms' patterns, each searched for by itself; all topics by one look at a text."""
    from chatterloom.functions.text import count_of

    rng = random.Random(4)
    parts = [w for words in sampling.TOPICS.values() for w in rng.sample(words.split(), 6)] + ["Game", "VPN", "gamer", "game_", "_game", "ranKed", "linK", "lınux", "é", "\n", "99", "工", "作"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "é", "-"]) for _ in range(rng.randint(0, 5))) for _ in range(400)]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    plainly = [sum((count_of(F.col("text"), sampling.term_pattern(w)) for w in words.split()), F.lit(0)) > 0 for words in sampling.TOPICS.values()]
    rows = d.select(sampling.topics_of(F.col("text").cast("binary")).alias("bits"), F.array(*plainly).alias("want")).collect()
    assert [[r["bits"] >> k & 1 == 1 for k in range(7)] for r in rows] == [r["want"] for r in rows]


def test_contacts_are_dealt_over_tasks(spark):
    rows = [(f"c{k}", i, "game text") for k in range(16) for i in range(30)]
    m = spark.createDataFrame(rows, "contact_id string, seq long, text string").withColumn("timestamp", F.timestamp_seconds("seq"))
    assert sampling.topic_aware(m, 20).select(F.spark_partition_id()).distinct().count() > 1
