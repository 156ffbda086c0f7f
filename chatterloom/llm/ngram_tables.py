"""Katz models of any order as tables, by DataFrame operations alone: what op8 learns, to keep, query and score other
texts with.

`counts` writes a table (n, context, word, lower, c) partitioned by n: each n-gram of the texts, with its context's own
shorter context. `model` adds Good-Turing discounts, probabilities and exactly normalised backoff weights, from the
lowest order up, as tables (n, context, word, p) and (n, context, alpha), again partitioned by n. `scored` evaluates each
token of each distinct text from the highest order down: a seen n-gram's probability, else its context's weight times
what the next lower order says, at last one unknown word's. Words and contexts are 64-bit hashes.

op8's query has bigrams by homes instead: a row for each token, order and join takes more disk than the check tool grants
(figures in the README).

Defined results: null and empty texts are the end token alone. Without texts to learn from every token has probability
1. Rows that hold the same text have the same score. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hot_join, id_text, written
from .homes import digested
from .op08_katz import TOP, discounts

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORDER = 3


def ngram_rows(texts: DataFrame, order: int, *keep: str) -> DataFrame:
    """A row for each token: keep, word, and context2.. (hashes of the words before it; those before a text are one mark)."""
    words = F.filter(F.split(F.translate(F.coalesce("text", F.lit("")), UPPER, UPPER.lower()), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashed = F.concat(F.transform(words, lambda w: F.xxhash64(w)), F.array(F.xxhash64(F.lit("end"), F.lit(1))))
    padded = F.concat(F.array_repeat(F.xxhash64(F.lit("start"), F.lit(2)), order - 1), hashed)
    rows = texts.select(*keep, padded.alias("padded"), F.posexplode(hashed).alias("pos", "word"))
    context = lambda n: F.xxhash64(F.lit(n), F.slice("padded", F.col("pos") + (order - n + 1), n - 1))
    return rows.select(*keep, "word", *[context(n).alias(f"context{n}") for n in range(2, order + 1)])


def counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(n, context, word, lower, c), written and partitioned by n."""
    rows = ngram_rows(docs, order)
    none = F.lit(0).cast("long")
    out = rows.groupBy("word").agg(F.count("*").alias("c")).select(F.lit(1).alias("n"), none.alias("context"), "word", none.alias("lower"), "c")
    for n in range(2, order + 1):
        lower = F.first(f"context{n - 1}") if n > 2 else F.first(none)
        each = rows.groupBy(F.col(f"context{n}").alias("context"), "word").agg(lower.alias("lower"), F.count("*").alias("c"))
        out = out.unionByName(each.select(F.lit(n).alias("n"), "context", "word", "lower", "c"))
    return written(out, "n")


@dataclass(frozen=True)
class Model:
    order: int
    total: int
    unknown: float
    p: DataFrame
    alpha: DataFrame


def rate(c: Column, d: np.ndarray) -> Column:
    """Count less its discount."""
    return F.element_at(F.array(*map(F.lit, [*d[1:].tolist(), 1.0])), F.least(c, F.lit(TOP + 1)).cast("int")) * c


def model(table: DataFrame, order: int = ORDER) -> Model:
    seen = {(r["n"], r["r"]): r["k"] for r in table.where(F.col("c") <= TOP + 1).groupBy("n", F.col("c").alias("r")).agg(F.count("*").alias("k")).collect()}  # TOP + 1 numbers for each order
    of = {n: discounts(np.array([0, *(seen.get((n, r), 0) for r in range(1, TOP + 2))])) for n in range(1, order + 1)}
    one = table.where("n = 1")
    total = one.agg(F.sum("c")).first()[0] or 0
    free = sum((1 - of[1][r]) * r * seen.get((1, r), 0) for r in range(1, TOP + 1)) / total if total else 1.0
    scale = 1.0
    if total and free <= 0:
        scale, free = total / (total + 1), 1 / (total + 1)
    p = written(one.select(F.lit(1).alias("n"), "context", "word", (scale * rate(F.col("c"), of[1]) / F.lit(max(total, 1))).alias("p")))
    parts, weights = [p], []
    for n in range(2, order + 1):
        own = table.where(F.col("n") == n)
        below = parts[-1].select(F.col("context").alias("lower"), "word", F.col("p").alias("q"))
        joined = own.join(below, ["lower", "word"] if n > 2 else ["word", "lower"])
        sums = joined.groupBy("context").agg(F.sum("c").alias("total"), F.sum(rate(F.col("c"), of[n])).alias("kept"), F.sum("q").alias("q"))
        left = 1 - F.col("kept") / F.col("total")
        bare = left <= 1e-15
        sums = sums.select("context", "total", F.when(bare, F.col("total") / (F.col("total") + 1)).otherwise(1.0).alias("scale"), (F.when(bare, 1 / (F.col("total") + 1)).otherwise(left) / F.greatest(1 - F.col("q"), F.lit(1e-300))).alias("alpha"))
        sums = written(sums)
        parts.append(written(own.join(sums, "context").select(F.lit(n).alias("n"), "context", "word", (F.col("scale") * rate(F.col("c"), of[n]) / F.col("total")).alias("p"))))
        weights.append(sums.select(F.lit(n).alias("n"), "context", "alpha"))
    every = parts[0]
    for x in parts[1:]:
        every = every.unionByName(x)
    alphas = weights[0] if weights else p.select("n", "context", F.col("p").alias("alpha")).where("false")
    for x in weights[1:]:
        alphas = alphas.unionByName(x)
    return Model(order, total, free, written(every, "n"), written(alphas, "n"))


def scored(docs: DataFrame, m: Model) -> DataFrame:
    """doc_id, n_tokens, score (log10 of the text's probability) of each row of docs."""
    docs = id_text(docs)
    keys = digested(docs)
    copies = keys.groupBy("d1", "d2").agg(F.count("*").alias("copies"))
    t = F.coalesce("text", F.lit(""))
    texts = docs.select(F.xxhash64(t).alias("d1"), F.xxhash64(t, t).alias("d2"), "text").dropDuplicates(["d1", "d2"])
    rows = ngram_rows(texts, m.order, "d1", "d2")
    one = m.p.where("n = 1").select("word", F.col("p").alias("p1"))
    rows = rows.join(one, "word", "left")
    p = F.coalesce("p1", F.lit(m.unknown))
    for n in range(2, m.order + 1):
        of = m.p.where(F.col("n") == n).select(F.col("context").alias(f"context{n}"), "word", F.col("p").alias(f"p{n}"))
        back = m.alpha.where(F.col("n") == n).select(F.col("context").alias(f"context{n}"), F.col("alpha").alias(f"alpha{n}"))
        rows = rows.join(of, [f"context{n}", "word"], "left").join(back, f"context{n}", "left")
        p = F.coalesce(f"p{n}", F.coalesce(f"alpha{n}", F.lit(1.0)) * p)
    each = rows.groupBy("d1", "d2").agg(F.count("*").alias("n_tokens"), F.sum(F.log10(F.greatest(p, F.lit(1e-300)))).alias("score"))
    return hot_join(keys, written(each.join(copies, ["d1", "d2"])), ["d1", "d2"], "copies").select("doc_id", "n_tokens", "score")
