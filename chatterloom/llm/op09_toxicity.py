"""Toxicity: a weighted finite-state pattern grammar over clauses.

Five transducers read the classed words of a clause, each a table of (state, class) -> (state, weight, later):

- insult: an insult counts more where another stands before it in the clause; a target that follows it within reach
  completes the pattern, and what is missing of its weight is added then (later);
- threat: a threat counts little by itself, more after an actor, and wholly when a target follows (later);
- target: an insult or threat counts more within reach after a target, less away from one;
- negation: lowers what follows within reach;
- reported speech: lowers the rest of the clause.

Their composition is compiled to one table by the product of their states: weights are multiplied, later weights are
added and lowered by negation and reported speech. A clause's weight is the sum over its matches; a text's score is a
logistic over clause weights. So a word alone has the least of its weights, and a clause that aims it the whole.

Stems: a fixed lexicon, and stems and whole words learnt from labelled rows as prefixes that toxic texts hold far
more often than others (labels don't tell insults from threats: learnt ones are insults unless the lexicon has them as
threats). They are counted on the executors over at most MAX_TRAIN labelled rows outside the held-out fold.

Defined results: null, empty and wordless texts get the score of no match; without labels the fixed lexicon stands
alone. Very long texts are read whole. Repeated rows each get their row. Other columns are not read. The same rows
give the same model however they are dealt.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op10_minhash_dedup
from .common import _LETTER_APART, Words, id_text, lean, text_steps, with_score, written
from .op03_quality_classifier import logistic, sample

MAX_TRAIN = 20_000
#: Learnt stems at most, the weightiest first.
MAX_STEMS = 4_000
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, ACTOR = CLASSES = range(7)
LEXICON = {
    INSULT: "idiot idiots moron morons loser losers scum trash stupid worthless pathetic disgusting clown dumb imbecile filth vermin idiota imbécil estúpido basura tonto crétin débile ordure imbécile trottel dummkopf abschaum",
    THREAT: "kill murder hurt destroy beat burn stab shoot töten umbringen matar tuer",
    TARGET: "you your yours they them he she him her it this that are is du ihr sie tú usted ustedes vous tu ils",
    NEGATION: "not never isn't aren't wasn't nicht kein keine nunca jamais",
    REPORT: "said says say wrote claimed claims called quoted quote sagte schrieb dijo disait déclara",
    ACTOR: "i i'll we we'll will gonna shall ich wir werde werden yo nosotros je nous vais",
}
PREFIXES = range(3, 13)  # bytes
#: Words that a target, a pending insult or threat, an actor and a negation reach.
NEAR_TARGET, PENDING, NEAR_ACTOR, NEGATED = 5, 3, 4, 3

Arc = tuple[int, float, float]


def insults() -> dict[tuple[int, int], Arc]:
    """State: words left in which a target completes the last insult; PENDING + 1 + that: another stood before it."""
    out = {}
    for more in (0, 1):
        for left in range(PENDING + 1):
            for c in CLASSES:
                s = more * (PENDING + 1) + left
                if c == INSULT:
                    out[s, c] = (PENDING + (PENDING + 1), 1.1 if more else 1.0, 0.0)
                elif c == TARGET and left:
                    out[s, c] = (more * (PENDING + 1), 1.0, 0.3)
                else:
                    out[s, c] = (more * (PENDING + 1) + max(0, left - 1), 1.0, 0.0)
    return out


def threats() -> dict[tuple[int, int], Arc]:
    """State: words that an actor still reaches; NEAR_ACTOR + words in which a target completes the last threat."""
    out = {}
    for s in range(NEAR_ACTOR + PENDING + 1):
        pending = max(0, s - NEAR_ACTOR)
        for c in CLASSES:
            rest = 0 if pending == 1 else max(0, s - 1)
            if c == THREAT:
                out[s, c] = (NEAR_ACTOR + PENDING, 0.7 if 0 < s <= NEAR_ACTOR else 0.3, 0.0)
            elif c == ACTOR:
                out[s, c] = (NEAR_ACTOR, 1.0, 0.0)
            elif c == TARGET and pending:
                out[s, c] = (0, 1.0, 0.6)
            else:
                out[s, c] = (rest, 1.0, 0.0)
    return out


def targets() -> dict[tuple[int, int], Arc]:
    """State: words that a target still reaches."""
    return {(s, c): (NEAR_TARGET if c == TARGET else max(0, s - 1), {INSULT: 1.1 if s else 0.8, THREAT: 1.3 if s else 1.0}.get(c, 1.0), 1.0) for s in range(NEAR_TARGET + 1) for c in CLASSES}


def negations() -> dict[tuple[int, int], Arc]:
    """State: words that a negation still reaches."""
    return {(s, c): (NEGATED if c == NEGATION else max(0, s - 1), 0.25 if s and c in (INSULT, THREAT) else 1.0, 0.25 if s else 1.0) for s in range(NEGATED + 1) for c in CLASSES}


def reports() -> dict[tuple[int, int], Arc]:
    """State: whether speech is reported in the clause."""
    return {(s, c): (1 if s or c == REPORT else 0, 0.4 if s and c in (INSULT, THREAT) else 1.0, 0.4 if s else 1.0) for s in range(2) for c in CLASSES}


def composed() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables next, weight and later by [state, class] of the product of the transducers; state 0 starts a clause.
    Only states that can be reached are made."""
    parts = [insults(), threats(), targets(), negations(), reports()]
    index, rows = {(0,) * len(parts): 0}, []
    queue = list(index)
    for s in queue:
        row = []
        for c in CLASSES:
            each = [p[x, c] for p, x in zip(parts, s)]
            to = tuple(e[0] for e in each)
            if to not in index:
                index[to] = len(index)
                queue.append(to)
            row.append((index[to], np.prod([e[1] for e in each]), (each[0][2] + each[1][2]) * each[2][2] * each[3][2] * each[4][2]))
        rows.append(row)
    table = np.array(rows)
    return table[..., 0].astype(np.int32), table[..., 1], table[..., 2]


def stem_keys(w: Words, whole: bool) -> dict[int, np.ndarray]:
    """Hashes of each word's first k bytes, for k of PREFIXES; key 0: the whole word."""
    size = w.end - w.start
    out = {0: w.hash + np.uint64(1)} if whole else {}
    for k in PREFIXES:
        at = np.flatnonzero(size >= k)
        h = np.zeros(len(size), np.uint64)
        h[at] = w.spans(w.start[at], w.start[at] + k)
        out[k] = h
    return out


def lowered(texts: list[bytes]) -> list[bytes]:
    return [x.decode().lower().encode() for x in texts]


def key_of(text: str, whole: bool) -> int:
    w = Words([text.encode()], apart=_LETTER_APART)
    return int(w.hash[0] + np.uint64(1)) if whole else int(w.spans(np.array([0]), np.array([len(text.encode())]))[0])


@dataclass(frozen=True)
class Grammar:
    keys: np.ndarray  # sorted hashes of stems
    weights: np.ndarray
    classes: np.ndarray
    coef: np.ndarray
    next_state: np.ndarray
    weight: np.ndarray
    later: np.ndarray

    def signals(self, column: pa.Array) -> np.ndarray:
        """For each text: log of 1 + its clauses' weights, the largest clause weight, matched clauses, share of matched words."""
        out = np.zeros((len(column), 4))
        for a, _, some in text_steps(column):
            w = Words(lowered(some), apart=_LETTER_APART)
            cls, weight = self.classed(w)
            hot = np.flatnonzero(np.isin(cls, (INSULT, THREAT)))
            stop = np.isin(w.buf, list(b".!?;\n")).cumsum()
            clause = stop[w.start] if len(w.start) else np.zeros(0, int)
            for d in np.unique(w.doc[hot]) if len(hot) else ():
                at = slice(w.first[d], w.last[d])
                sums = self.clauses(cls[at], weight[at], clause[at])
                if sums:
                    v = np.array(sums)
                    out[a + d] = np.log1p(v.sum()), min(v.max(), 12) / 4, np.log1p((v > 0.5).sum()), len(hot[(hot >= w.first[d]) & (hot < w.last[d])]) / max(1, w.n[d])
        return out

    def classed(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        cls, weight = np.zeros(len(w.start), np.int8), np.zeros(len(w.start))
        if len(self.keys):
            for h in stem_keys(w, True).values():
                i = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                hit = np.flatnonzero(self.keys[i] == h)
                better = hit[self.weights[i[hit]] > weight[hit]]
                cls[better], weight[better] = self.classes[i[better]], self.weights[i[better]]
        return cls, weight

    def clauses(self, cls: np.ndarray, weight: np.ndarray, clause: np.ndarray) -> list[float]:
        """Weights of the clauses that hold an insult or threat. What is added later is a share of the last of them."""
        sums: list[float] = []
        to, now, later = self.next_state, self.weight, self.later
        bad = (cls == INSULT) | (cls == THREAT)
        for k in np.unique(clause[bad]):
            lo, hi = np.searchsorted(clause, k), np.searchsorted(clause, k, side="right")
            state, total, last = 0, 0.0, 0.0
            for c, v in zip(cls[lo:hi].tolist(), weight[lo:hi].tolist()):
                if c == INSULT or c == THREAT:
                    total += v * now[state, c]
                    last = v
                elif last:
                    total += last * later[state, c]
                state = to[state, c]
            sums.append(total)
        return sums

    def score(self, column: pa.Array) -> np.ndarray:
        s = self.signals(column)
        return logistic(s @ self.coef[:4] + self.coef[4])


def base_lexicon() -> dict[int, tuple[float, int]]:
    return {key_of(x, True): (3.0 if c in (INSULT, THREAT) else 1e-3, c) for c, words in LEXICON.items() for x in words.split()}


def one_of_each(rows: DataFrame) -> DataFrame:
    """One row of each group of copies and near copies of a label: equal texts, and texts that op10's links (exactly
    confirmed shingle sets) connect. Else every word of a much copied text would look like a sign of its label. The
    row with the least hash of its text stays, however the rows were dealt."""
    text = F.coalesce("text", F.lit(""))
    apart = written(rows.groupBy("y", F.xxhash64("y", text).alias("key"), F.sha2(text, 256).alias("digest")).agg(F.min(text).alias("text")))
    marked = F.when(F.col("y") == 1, F.regexp_replace("text", r"[^\x20\x09-\x0D]+", "$0=1")).otherwise(F.col("text"))  # no links between labels
    near = op10_minhash_dedup.groups(apart.select(F.col("key").alias("doc_id"), marked.alias("text")))
    kept = near.where("doc_id = component_id").select(F.col("doc_id").alias("key"))
    return written(apart.join(kept, "key", "left_semi").select("y", "text"))


def train(docs: DataFrame, labels: DataFrame, folds: int | None = 3, held: int = 1, max_train: int = MAX_TRAIN) -> Grammar:
    spark = docs.sparkSession
    rows = sample(docs, labels, "toxic", folds or 1, held if folds else -1, False, max_train)
    rows = one_of_each(rows.select("y", "text"))

    @lean
    def counted(batches):
        for b in batches:
            y = b.column("y").to_numpy()
            for lo, _, some in text_steps(b.column("text")):
                w = Words(lowered(some), apart=_LETTER_APART)
                for k, h in stem_keys(w, True).items():
                    ok = h != 0
                    pair = np.unique(np.rec.fromarrays([w.doc[ok], h[ok]], names="d,h"))
                    u, inv = np.unique(pair.h, return_inverse=True)
                    toxic = y[lo + pair.d] == 1
                    p, n = np.bincount(inv, toxic, len(u)), np.bincount(inv, ~toxic, len(u))
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(p.astype(np.int64)), pa.array(n.astype(np.int64))], names=["h", "p", "n"])

    sizes = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    P, N = sizes.get(1, 0), sizes.get(0, 0)
    lexicon = base_lexicon()
    tables = composed()
    if P and N:
        got = rows.mapInArrow(counted, "h long, p long, n long").groupBy("h").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
        weight = F.log((F.col("p") + 0.3) / (P + 0.6)) - F.log((F.col("n") + 0.6) / (N + 1.2))
        rate = P / (P + N)
        gain = 2 * F.col("p") * F.log(F.col("p") / ((F.col("p") + F.col("n")) * rate))
        best = got.where("p >= 4").withColumn("w", weight).withColumn("g", gain).where("w >= 1.8 and g >= 19")
        for r in best.orderBy(F.desc("g"), "h").limit(MAX_STEMS).collect():
            k = r["h"] & 0xFFFFFFFFFFFFFFFF
            cls = lexicon.get(k, (0, INSULT))[1]
            if cls in (INSULT, THREAT):
                lexicon[k] = (min(float(r["w"]), 6.0), cls)
    keys = np.array(sorted(lexicon), np.uint64)
    weights = np.array([lexicon[int(k)][0] for k in keys])
    classes = np.array([lexicon[int(k)][1] for k in keys], np.int8)
    coef = np.array([2.0, 1.0, 1.0, 0.0, -4.0])  # of the lexicon alone
    plain = Grammar(keys, weights, classes, coef, *tables)
    if P < 5 or N < 5:
        return plain

    @lean
    def signalled(batches):
        for b in batches:
            s = plain.signals(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("y"), *(pa.array(c) for c in s.T)], names=["y", "a", "b", "c", "d"])

    got = rows.mapInArrow(signalled, "y int, a double, b double, c double, d double").toArrow()
    x = np.column_stack([got[c].to_numpy() for c in "abcd"])
    return Grammar(keys, weights, classes, regression(x, got["y"].to_numpy().astype(float)), *tables)


def regression(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression with weights of 0 or more for all but the offset, by projected Newton steps."""
    order = np.lexsort([*x.T, y])
    a = np.column_stack([x, np.ones(len(x))])[order]
    y = y[order]
    w = np.array([1.0, 1.0, 0.5, 0.0, -3.0])
    ridge = np.array([0.3, 0.3, 0.3, 0.3, 0.01])

    def loss(v: np.ndarray) -> float:
        m = a @ v
        return float((np.logaddexp(0, m) - y * m).sum() + 0.5 * (ridge * v * v).sum())

    for _ in range(200):
        p = logistic(a @ w)
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge) + 1e-6 * np.eye(5)
        step, size, now = np.linalg.solve(h, a.T @ (p - y) + ridge * w), 1.0, loss(w)
        while size > 1e-6:  # the step is halved until it lowers the loss
            new = w - size * step
            new[:4] = np.maximum(new[:4], 0)
            if loss(new) < now:
                break
            size /= 2
        else:
            break
        done = abs(new - w).max() < 1e-7
        w = new
        if done:
            break
    return w


def detect(docs: DataFrame, model: Grammar, score: str = "score", text: str = "text") -> DataFrame:
    """docs with a column `score`; every other column passes through."""
    return with_score(docs, model.score, score, text)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return detect(id_text(docs), model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
