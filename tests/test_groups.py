"""Group signals and mentions, by hand and on more terms than a row holds."""

import random
import time

from pyspark.sql import functions as F

from chatterloom.operators import groups


def test_mentions_of_over_a_thousand_terms(spark):
    g = spark.createDataFrame([("g", "me", " ".join(f"<{k}>" for k in range(2500))), ("g", "me", "<7>"), ("g", "them", "<8>"), ("h", "me", "<9>"), ("g", "me", None)], "group_id string, sender string, text string")
    terms = spark.createDataFrame([("g", f" <{k}>\u3000") for k in range(2500)] + [("g", "<7>"), ("g", "none"), ("g", "x"), ("g", None)], "group_id string, term string")
    got = {r["term"]: r["count"] for r in groups.mentions(g, terms).collect()}
    assert got == {f"<{k}>": 1 + (k == 7) for k in range(2500)}


def test_signals(spark):
    rows = [
        ("g1", "wx_a", "Ann Lee", "participant", "hi"), ("g1", "wx_a", "Annie", "participant", "hi"), ("g1", "me", "Me", "me", "Annie and Ann Lee, Annie"), ("g1", "me", "Me", "me", None),
        ("g2", "other", "ann lee", "participant", "x"), ("g2", "me", "Me", "me", "ann lee"), ("g3", "wx_b", "Bo", "participant", "y"), ("g3", "me", "Me", "me", "Annie"),
    ]
    g = spark.createDataFrame(rows, "group_id string, participant_id string, participant_name string, sender string, text string")
    contacts = spark.createDataFrame([("WX_A", " Ann Lee"), ("wx_c", "Cy"), ("wx_b", "B")], "contact_id string, contact_name string")
    got = [r.asDict(recursive=True) for r in groups.signals(g, contacts).collect()]
    assert [r["contact_id"] for r in got] == ["WX_A", "wx_b"]
    a = got[0]
    # one message of Ann Lee matches by id and by name, so it counts twice
    assert (a["shared_groups"], a["messages_from_me"], a["messages_from_participant"]) == (2, 3, 4)
    assert a["matched_participant_ids"] == ["other", "wx_a"] and a["matched_participant_names"] == ["Ann Lee", "Annie", "ann lee"]
    assert a["address_terms_from_me"] == [{"term": "Annie", "count": 2}, {"term": "Ann Lee", "count": 1}, {"term": "ann lee", "count": 1}]
    assert (a["evidence_source"], a["weight"]) == ("group_chat", "weak") and got[1]["address_terms_from_me"] == []


def test_mentions_overlap_and_begin_alike(spark):
    """From the left, without overlaps, for each term by itself; as Python counts."""
    rng = random.Random(3)
    parts = ["a", "aa", "ab", "User 1", "User 12", "é", "éé", "日本", "日", "😀", " ", "\n", "user 1"]
    texts = [(rng.choice("gh"), "".join(rng.choices(parts, k=rng.randint(1, 40)))) for _ in range(300)]
    terms = {x: ["aa", "aaa", "aba", "User 1", "User 12", "User 123", "éé", "日本", "日本日", "😀", "1U", "\\w+", "a.a"][: 13 if x == "g" else 6] for x in "gh"}
    g = spark.createDataFrame([(a, "me", t) for a, t in texts], "group_id string, sender string, text string")
    got = {(r["group_id"], r["term"]): r["count"] for r in groups.mentions(g, spark.createDataFrame([(a, t) for a, ts in terms.items() for t in ts], "group_id string, term string")).collect()}
    want = {(a, t): sum(x.count(t) for b, x in texts if b == a) for a, ts in terms.items() for t in ts}
    assert got == {k: n for k, n in want.items() if n}


def test_mentions_of_a_hundred_thousand_terms(spark):
    """A text is not searched once for each term: that takes minutes here."""
    g = spark.createDataFrame([("g", "me", "User 7 and " * 900) for _ in range(400)], "group_id string, sender string, text string").repartition(8)
    terms = spark.range(100_000).selectExpr("'g' group_id", "concat('User ', id) term")
    began = time.time()
    assert [(r["term"], r["count"]) for r in groups.mentions(g, terms).collect()] == [("User 7", 360_000)]
    assert time.time() - began < 40


def test_messages_are_not_dealt_by_group(spark):
    """Of a few groups, each message would go to one of a few tasks."""
    g = spark.createDataFrame([("g", "me", "a term")] * 50, "group_id string, sender string, text string")
    plan = groups.mentions(g, g.select("group_id", F.lit("term").alias("term")))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan[plan.rindex("MapInArrow") :]
