"""Most frequent n-grams against plain counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatterloom.functions.text import tokens
from chatterloom.operators import counting, groups, stats

SCHEMA = "contact_id string, seq long, sender string, text string"


def said(seed, rows=400):
    rng = random.Random(seed)
    words = ["a", "B", "v1.5", "30%", "99", "我们", "é", "x_y", "K", "the", "The", "no"] + [f"w{k}" for k in range(40)]
    return [(rng.choice(["p", "q", "r", None]), i, "me", " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in rng.sample(range(10**6), rows)] + [("p", 5, "me", None), ("s", 7, "them", "a a a a")]


@pytest.mark.parametrize("n,scope,cut", [(1, ["contact_id"], tokens), (2, ["contact_id"], tokens), (3, ["contact_id"], tokens), (3, [], tokens), (2, [], lambda c: tokens(c))])
def test_top_terms_are_those_of_all_counts(spark, n, scope, cut):
    m = spark.createDataFrame(said(n), SCHEMA).repartition(3)
    count, seen = Counter(), {}
    for r in m.where("sender = 'me' and text is not null").select("contact_id", "seq", tokens(F.col("text")).alias("t")).collect():
        for i in range(len(r["t"]) - n + 1):
            part = r["t"][i : i + n]
            k = (r["contact_id"] if scope else 0, ("" if all(x >= "一" for x in part) else " ").join(part))
            count[k] += 1
            seen[k] = min(seen.get(k, (10**9, 0)), (r["seq"], i))
    want = set()
    for s in {k[0] for k in count}:
        want |= {(*k, count[k], i) for i, k in enumerate(sorted((k for k in count if k[0] == s), key=lambda k: (-count[k], seen[k]))[:30], 1)}
    got = {(r["contact_id"] if scope else 0, r["term"], r["count"], r["rank"]) for r in stats.top_terms(m, scope, n, 30, cut=cut).collect()}
    assert got == want


def test_rare_ngrams_are_not_rows(spark):
    """Of 180,000 n-grams, nearly all of which stand once, those that are given on to be added up."""
    rng = random.Random(1)
    texts = [" ".join(f"x{rng.randrange(10**6)}" for _ in range(100)) + " one two three four" for _ in range(1800)]
    m = spark.createDataFrame([("p", i, "me", t) for i, t in enumerate(texts)], SCHEMA).select("contact_id", "seq", F.col("text").cast("binary").alias("t")).repartition(4)
    for scope in ([], ["contact_id"]):
        rows = counting.counts(m, scope, 3, 2)
        assert rows.where("term = 'one two three'").groupBy("term").sum("count").first()[1] == 1800 and rows.count() < 10_000


def test_tasks_without_messages(spark):
    """As those of a file with fewer row groups than splits."""
    m = spark.createDataFrame([("p", i, "me", "one two one two") for i in range(3)], SCHEMA).repartition(8)
    for scope in ([], ["contact_id"]):
        assert [(r["term"], r["count"]) for r in stats.top_terms(m, scope, 2, 2).orderBy("rank").collect()] == [("one two", 6), ("two one", 3)]


def test_group_terms_are_counted_within_tasks(spark):
    g = spark.createDataFrame([("g", i, "me", "Beta alpha and beta alpha x 我") for i in range(1000)], "group_id string, seq long, sender string, text string").repartition(4)
    parts = counting.counts(g.select("group_id", "seq", F.col("text").cast("binary").alias("t")), ["group_id"], 1, 25)
    assert parts.count() <= 4 * 5  # not a row for each of 7,000 uses
    plan = groups.top_terms(g)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Generate" not in plan
    assert [(r["term"], r["count"], r["rank"]) for r in groups.top_terms(g).orderBy("rank").collect()] == [("beta", 2000, 1), ("alpha", 2000, 2)]


def test_bundles_of_some_parts(spark):
    """What is not asked for is not worked out, the bounds of n-grams at once included."""
    m = spark.createDataFrame(said(9, 40), SCHEMA).where("contact_id is not null").selectExpr("*", "contact_id contact_name", "timestamp_seconds(seq) timestamp")
    whole = stats.bundled(m, ["contact_id"])
    some = stats.bundled(m, ["contact_id"], ("lexical", "words"))
    assert some.columns == ["contact_id", "contact_name", "message_count", "lexical", "words"]
    assert some.collect() == whole.select(some.columns).collect()
