"""Toxicity by weak supervision.

1. A bounded sample of labelled rows (``per_class`` of each label, the first by a hash of doc_id, thinned of copies) proposes
   features: words and word beginnings whose connection with the label is beyond chance.
2. Voters: suspicious words are dealt out to ``WORD_VOTERS`` lexicons and suspicious beginnings to ``PATTERN_VOTERS``
   patterns for each number of repeats, so that words that begin alike stand in different voters; a public list of
   insults and the number of hits vote as well.  No voter sees a label.
3. A generative label model (expectation maximisation from a start by the number of votes) estimates each voter's hit rate
   in either class and the correlations that remain between voters within a class; a voter counts the less the more
   it repeats others.
4. Labels are used to select how strict a voter's words have to be (of ``STRICTNESS``) and to calibrate the model's
   log odds (a slope and an offset), not as a target.
5. A linear classifier is trained on the posteriors; its weights are a table of at most ``vocabulary``
   features, which is broadcast to score every whole text.

Only rows that the caller passes as labelled are learned from, and a score reads nothing but the text.

Defined results: a null or empty text has the score of no features; repeated rows score alike; rows
without a doc_id are scored and are not held out; labels that are null or neither 0 nor 1 are not used,
and of several labels of a doc_id the largest is; without labels of both classes only the public list
decides (0.9 or 0.05); an empty table gives an empty table; other columns play no part, but that score_texts
replaces columns called score and predicted.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.session import materialise, table, unused
from llm.textkernel import mix, shingle_sets

#: Bounds of the fit: labelled rows of each class, features kept.
PER_CLASS = 6000
VOCABULARY = 6000
WORD_VOTERS = 16
PATTERN_VOTERS = 4
#: Least log odds of the words of a voter, of which the labels select one.
STRICTNESS = (2.5, 3.5, 4.5)
THRESHOLD = 0.7
BEGINNINGS = (4, 5, 6)
#: A public list of insults.
INSULTS = (
    "asshole", "bastard", "bitch", "clown", "coward", "crap", "creep", "cretin", "degenerate", "disgusting", "dumb", "filth", "fool",
    "freak", "garbage", "hate", "idiot", "imbecile", "jerk", "kill", "liar", "loser", "moron", "nazi", "parasite", "pathetic", "pig",
    "psycho", "racist", "rat", "scum", "shit", "slut", "stupid", "trash", "ugly", "vermin", "whore", "worthless",
    "arschloch", "dummkopf", "hurensohn", "schwein", "connard", "salope", "imbécile", "cabrón", "idiota", "puta",
)
#: The feature of texts that hold a listed insult.
LISTED = "#listed"
_WORDS = re.compile(r"\w+").findall


def features(text: str | None) -> set[str]:
    """Distinct lower-cased words, beginnings of longer words, and whether an insult is listed.

    A beginning is marked with one star; with two or three where words that begin so stand in the text
    at least twice or four times, as a single word may begin like that by chance.
    """
    counts = Counter(_WORDS(text.lower())) if text else {}
    out = set(counts)
    if not out.isdisjoint(INSULTS):
        out.add(LISTED)
    for n in BEGINNINGS:
        starts: dict[str, int] = {}
        for w, k in counts.items():
            if len(w) >= n:
                starts[w[:n]] = starts.get(w[:n], 0) + k
        for w, k in starts.items():
            out.add(w + "*")
            if k > 1:
                out.add(w + "**")
                if k > 3:
                    out.add(w + "***")
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(labels: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, toxic): at most per_class rows of each label."""
    each = labels.where("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    parts = [each.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    return parts[0].union(parts[1])


def _explode_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 100):
            part = b.slice(at, 100)
            found = [sorted(features(t)) for t in part.column("text").to_pylist()]
            toxic = np.repeat(part.column("toxic").to_numpy(zero_copy_only=False), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array([x for f in found for x in f], pa.string()), pa.array(toxic.astype(np.int32))], names=["f", "toxic"])


def _smallest_shingles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        least: list[list[int]] = [[], [], []]
        for s in shingle_sets(b.column("text")):
            for k, out in enumerate(least):
                out.append(int((s[0] if k == 0 else mix(s ^ np.uint64(k)).min()).view(np.int64)) if len(s) else 0)
        yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(x, pa.int64()) for x in least]], names=[*b.schema.names, "m0", "m1", "m2"])


def _one_of_copies(texts: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) without most copies: of rows of a label with an equal smallest shingle hash, one.

    Three hashes in turn leave a handful of rows of a group of near copies, so that words of one often
    copied text do not pass for signs of its label.
    """
    rows = texts.select("doc_id", "text", "toxic").mapInArrow(_smallest_shingles, "doc_id long, text string, toxic int, m0 long, m1 long, m2 long")
    for m in ("m0", "m1", "m2"):
        rows = rows.groupBy("toxic", m).agg(F.min(F.struct("doc_id", "text", *[x for x in ("m0", "m1", "m2") if x != m])).alias("r")).select("toxic", m, "r.*")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


class Model:
    """Weights by feature and a bias."""

    def __init__(self, weights: dict[str, float], bias: float) -> None:
        self.weights, self.bias = weights, bias

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weights[f] for f in sorted(features(text) & self.weights.keys()))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def ballots(names: list[str], odds: list[float], cols: list[np.ndarray], listed: np.ndarray, strict: float) -> np.ndarray:
    """A 0/1 matrix of rows by voters from each row's features; voters hold the features of at least the odds ``strict``."""
    bad = sorted((i for i, o in enumerate(odds) if o > strict and names[i] != LISTED), key=lambda i: (names[i].rstrip("*")[:4], i))
    voter = np.full(len(names), -1)
    first = 0
    for stars, n in ((0, WORD_VOTERS), (1, PATTERN_VOTERS), (2, PATTERN_VOTERS), (3, PATTERN_VOTERS)):
        own = [i for i in bad if len(names[i]) - len(names[i].rstrip("*")) == stars]
        voter[own] = first + np.arange(len(own)) % n
        first += n
    votes = np.zeros((len(cols), first + 2), dtype=np.int8)
    for k, c in enumerate(cols):
        v = voter[c]
        v = v[v >= 0]
        votes[k, v] = 1
        votes[k, first + 1] = len(v) >= 3
    votes[:, first] = listed > 0
    return votes


def label_model(votes: np.ndarray, share: float | None = None, rounds: int = 30, smooth: float = 1.0, free: float = 0.25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log odds of class 1, hit rates by class and voter, voter weights) from a 0/1 matrix of rows by voters.

    share: of class 1, where it is known.  A voter's weight is one over the sum of its correlations with all voters
    (itself one) within the classes; correlations under ``free`` are taken for traces of rows that stand in the wrong class.
    """
    votes = votes.astype(float)
    hits = votes.sum(axis=1)
    post = np.where(hits >= 3, 0.9, np.where(hits >= 1, 0.3, 0.02))
    rates, weight, z = np.full((2, votes.shape[1]), 0.5), np.ones(votes.shape[1]), np.zeros(len(votes))
    for _ in range(rounds):
        mass = np.array([(1 - post).sum(), post.sum()])
        prior = (mass + smooth) / (mass.sum() + 2 * smooth) if share is None else np.array([1 - share, share])
        usual = smooth * votes.mean(axis=0).clip(1e-4)
        rates = np.stack([((w[:, None] * votes).sum(axis=0) + usual) / (w.sum() + smooth) for w in (1 - post, post)]).clip(1e-5, 1 - 1e-5)
        left = np.zeros((votes.shape[1], votes.shape[1]))
        for y, w in enumerate((1 - post, post)):
            centred = votes - rates[y]
            cov = (centred * w[:, None]).T @ centred / max(mass[y], 1e-9)
            spread = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            left += prior[y] * np.abs(cov / np.outer(spread, spread))
        left = np.maximum(left - free, 0) / (1 - free)
        np.fill_diagonal(left, 1.0)
        weight = 1 / left.sum(axis=1)
        gain = votes * np.log(rates[1] / rates[0]) + (1 - votes) * np.log((1 - rates[1]) / (1 - rates[0]))
        z = np.clip(np.log(prior[1] / prior[0]) + (gain * weight).sum(axis=1), -30, 30)
        post = 1 / (1 + np.exp(-z))
    return z, rates, weight


def calibrated(z: np.ndarray, gold: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """(posteriors, mean log loss): a slope and an offset of the log odds that suit the labels best."""
    x = np.stack([(z - z.mean()) / (z.std() or 1.0), np.ones(len(z))], axis=1)
    a = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        h = (p * (1 - p) + 1e-6)[:, None] * x
        a -= np.linalg.solve(x.T @ h + ridge * np.eye(2), x.T @ (p - gold) + ridge * a)
    p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
    return p, float(-np.log(np.where(gold == 1, p, 1 - p).clip(1e-9)).mean())


def linear_classifier(rows: list[np.ndarray], target: np.ndarray, n: int, ridge: float = 2e-4, steps: int = 800, rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse 0/1 rows with soft targets, by Adam over the whole sample; classes weigh alike."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    share = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    each = np.where(target > 0.5, 0.5 / share, 0.5 / (1 - share)) / len(target)
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, steps + 1):
        z = w[-1] + np.bincount(at, weights=w[col], minlength=len(rows))
        miss = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * each
        g = np.append(np.bincount(col, weights=miss[at], minlength=n), miss.sum()) + ridge * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labelled: DataFrame, per_class: int = PER_CLASS, vocabulary: int = VOCABULARY) -> Model:
    """A model from docs(doc_id, text) and labelled(doc_id, toxic); what is gathered is bounded by the parameters."""
    chosen = materialise(_sample(labelled, per_class))  # at most 2 * per_class rows of two numbers
    have = {r.toxic: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    fallback = Model({w: 5.2 for w in INSULTS}, -3.0)
    if not have.get(0) or not have.get(1):
        return fallback
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = materialise(_one_of_copies(texts))
    counted = texts.select("toxic", "text").mapInArrow(_explode_features, "f string, toxic int")
    total = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if not total.get(0) or not total.get(1):
        return fallback
    rate = total[1] / (total[0] + total[1])
    counts = materialise(
        counted.groupBy("f").agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0")).where("n1 + n0 >= 3")
    )
    # a feature stays if its likelihood ratio against no connection beats the number of features tried
    tried = max(2, counts.count())
    n = F.col("n1") + F.col("n0")
    part = lambda c, r: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (n * r))).otherwise(0.0)
    odds = F.log(((F.col("n1") + 0.5) / (total[1] + 1.0)) / ((F.col("n0") + 0.5) / (total[0] + 1.0)))
    scored = counts.withColumn("odds", odds).withColumn("gain", part("n1", rate) + part("n0", 1 - rate))
    top = scored.where(F.col("gain") >= float(np.log(tried))).orderBy(F.desc("gain"), "f").limit(vocabulary).collect()  # bounded by vocabulary
    if not top:
        return fallback
    names = [r.f for r in top]
    place = {f: i for i, f in enumerate(names)}
    insults = frozenset(INSULTS)
    shared = docs.sparkSession.sparkContext.broadcast((place, insults))

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bad = shared.value
        for b in batches:
            ids, hits = [], []
            for t in b.column("text"):  # one text's features at a time
                own = features(t.as_py())
                ids.append(sorted(known[f] for f in own & known.keys()))
                hits.append(len(own & bad))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(ids, pa.list_(pa.int32())), pa.array(hits, pa.int32())], names=["doc_id", "toxic", "ids", "hits"])

    rows = texts.mapInArrow(index, "doc_id long, toxic int, ids array<int>, hits int").orderBy("doc_id").collect()  # at most 2 * per_class rows
    gold = np.array([r.toxic for r in rows])
    cols = [np.array(r.ids, dtype=np.int64) for r in rows]
    odds = [r.odds if r.n1 >= 3 else 0.0 for r in top]
    listed = np.array([r.hits for r in rows])
    post, _ = min((calibrated(label_model(ballots(names, odds, cols, listed, strict), rate)[0], gold) for strict in STRICTNESS), key=lambda got: got[1])
    w, bias = linear_classifier(cols, post, len(names))
    return Model({f: float(x) for f, x in zip(names, w, strict=True) if abs(x) > 1e-3}, bias)


def _with_score(docs: DataFrame, model: Model, name: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.score
        for b in batches:
            got = [score(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.float64())], names=[*b.schema.names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{schema}, `{name}` double")


def score_texts(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs with ``score`` and ``predicted`` added (docs needs ``text``; other columns stay)."""
    slim = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")])
    return _with_score(slim, model, "score").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the classifier leaves, with all their columns as they are."""
    (name,) = unused(docs, "score")
    return _with_score(docs, model, name).where(F.col(name) < threshold).drop(name)


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return labels.where(~held_out(F.col("doc_id")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents``; learned from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, training_labels(spark, sf_dir))
    scored = score_texts(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
