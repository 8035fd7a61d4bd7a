"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade >= k) = sigmoid(s - t_k) with one score s, a sum of shared weights over the distinct hashed features of the
text, and ordered thresholds t_1 < t_2. Features are words, their first letters, the signs that end them, capitals and
immediate repeats; the whole text counts. Toxic texts stand between poor and good ones: they are whole language, so
what tells poor texts tells little against them, and they are as unwanted.

Weights have either sign, and every feature of the rated rows takes part; an L1 penalty leaves those at 0 that don't pay
(a quasi-Newton method that keeps to one orthant a step). Fitting takes a bounded sample of the rated rows
(SAMPLE, by hash of the id, the same whatever the partitions). Where documents are kept from is chosen on a part of
them that a first fit has not seen: the tail probability at which CLEAN times the share of good texts lost and the
share of others kept are least together. Scoring reads every document once, without a shuffle.
"""

from __future__ import annotations

import math
from itertools import islice
from operator import eq
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Workspace, hash128, python_ready, table

SAMPLE, BUCKETS = 16_384, 1 << 31
#: The penalty is SPARSE over the root of the number of rated rows.
SPARSE, ROUNDS, MEMORY, ENOUGH, PART = 0.04, 60, 8, 1e-4, 1 << 21
CLEAN, HELD, CUT = 10.0, 5, 0.5
GRADES = 3
CACHED, LONGEST_CACHED = 400_000, 64


def bucket(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature) % BUCKETS


def token_features(token: str) -> tuple[int, ...]:
    core = token.strip(punctuation)
    low, tail = core.lower(), token[len(token.rstrip(punctuation)) :]
    out = []
    if low:
        out.append("w" + low)
        out += [f"{k}{low[:k]}" for k in (4, 5) if len(low) > k]
    if tail:
        out.append("p" + tail)
    if len(core) > 1 and core.isupper():
        out.append("capitals")
    return tuple(map(bucket, out))


class Tokens(dict):
    """Features by token, those in `among` only if it is given; emptied when full."""

    def __init__(self, among=None):
        self.among = among

    def __missing__(self, token: str):
        found = token_features(token)
        if self.among is not None:
            found = tuple(x for x in found if x in self.among)
        if len(token) <= LONGEST_CACHED:
            if len(self) >= CACHED:
                self.clear()
            self[token] = found
        return found


REPEATS = (bucket("repeats"), bucket("mostly repeats"))


def text_features(text: str | None, tokens: Tokens) -> set[int]:
    words = (text or "").split()
    found = set().union(*map(tokens.__getitem__, set(words)))
    same = sum(map(eq, words, islice(words, 1, None)))
    if same >= 5:
        found.update(x for x, share in zip(REPEATS, (0.05, 0.25), strict=True) if same > share * len(words))
    return found


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def all_features(texts: pa.Array) -> pa.Array:
    tokens = Tokens()
    return pa.array([sorted(text_features(x, tokens)) for x in texts.to_pylist()], pa.list_(pa.int32()))


def graded(labels: DataFrame) -> DataFrame:
    """`labels(doc_id, quality, toxic)` -> `doc_id, grade`: 0 for poor texts, 1 for toxic ones, 2 for others; the least
    where a document has several ratings. Rows with a null id or rating don't count."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(grade).cast("int").alias("grade"))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def slopes(s: np.ndarray, limits: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of each grade, its derivative by the score, and those by both thresholds."""
    is0, is1, is2 = (grades == k for k in range(GRADES))
    p1, p2 = sigmoid(s - limits[0]), sigmoid(s - limits[1])
    likely = np.maximum(np.where(is0, 1 - p1, np.where(is1, p1 - p2, p2)), 1e-9)
    d1, d2 = p1 * (1 - p1), p2 * (1 - p2)
    by_score = np.where(is0, -d1, np.where(is1, d1 - d2, d2)) / likely
    by_limits = np.array([np.where(is0, d1, np.where(is1, -d1, 0)) / likely, np.where(is1, d2, np.where(is2, -d2, 0)) / likely])
    return np.log(likely), by_score, by_limits


def limits_of(x: np.ndarray) -> np.ndarray:
    """The parameters are the weights, the first threshold and the logarithm of the gap to the second."""
    return np.array([x[-2], x[-2] + np.exp(x[-1])])


def objective(x: np.ndarray, ends: np.ndarray, features: np.ndarray, grades: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood and its gradient. Row k has the features from ends[k - 1] to ends[k]."""
    limits, g, total, at = limits_of(x), np.zeros(len(x)), 0.0, 0
    begins = np.concatenate([[0], ends[:-1]])
    while at < len(grades):
        to = max(at + 1, int(np.searchsorted(ends, begins[at] + PART, side="right")))
        held, row = features[begins[at] : ends[to - 1]], np.repeat(np.arange(to - at), (ends - begins)[at:to])
        likely, by_score, by_limits = slopes(np.bincount(row, x[held], to - at), limits, grades[at:to])
        total -= likely.sum()
        g[:-2] -= np.bincount(held, by_score[row], len(x) - 2)
        g[-2] -= by_limits.sum()
        g[-1] -= by_limits[1].sum() * np.exp(x[-1])
        at = to
    return total / len(grades), g / len(grades)


def fit_ordinal(ends: np.ndarray, features: np.ndarray, grades: np.ndarray, x: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The parameters of least objective() and L1 penalty of the weights, from x on."""
    penalty = np.full(len(x), SPARSE / math.sqrt(len(grades)))
    penalty[-2:] = 0
    loss, g = objective(x, ends, features, grades)
    whole, past = loss + penalty @ np.abs(x), []
    for _ in range(rounds):
        slope = np.where(x > 0, g + penalty, np.where(x < 0, g - penalty, np.where(g + penalty < 0, g + penalty, np.where(g > penalty, g - penalty, 0))))
        down, shares = slope.copy(), []
        for s, y, r in reversed(past):
            shares.append(r * (s @ down))
            down -= shares[-1] * y
        down /= past[-1][2] * (past[-1][1] @ past[-1][1]) if past else max(1.0, np.linalg.norm(slope))
        for (s, y, r), share in zip(past, reversed(shares), strict=True):
            down += (share - r * (y @ down)) * s
        down[down * slope <= 0] = 0
        side, step = np.where(x != 0, np.sign(x), -np.sign(slope)), 1.0
        while True:
            new = x - step * down
            new[:-2][new[:-2] * side[:-2] <= 0] = 0
            loss, h = objective(new, ends, features, grades)
            now = loss + penalty @ np.abs(new)
            if now <= whole + 1e-4 * (slope @ (new - x)) or step < 1e-4:
                break
            step /= 2
        s, y = new - x, h - g
        if s @ y > 1e-12:
            past = [*past, (s, y, 1 / (s @ y))][-MEMORY:]
        done = whole - now < ENOUGH * whole
        x, g, whole = new, h, now
        if done:
            break
    return x


def best_cut(tails: np.ndarray, good: np.ndarray) -> float:
    """Between the tail probabilities of rated rows: where CLEAN times the share of good ones below and the share of
    others above are least; in the middle of where that is so. CUT if all rows are of one kind."""
    if good.all() or not good.any():
        return CUT
    at = np.concatenate([[0.0], np.unique(tails), [1.0]])
    between = (at[:-1] + at[1:]) / 2
    lost = np.searchsorted(np.sort(tails[good]), between) / good.sum()
    kept = 1 - np.searchsorted(np.sort(tails[~good]), between) / (~good).sum()
    cost = CLEAN * lost + kept
    first = int(cost.argmin())
    last = first
    while last + 1 < len(cost) and cost[last + 1] <= cost[first] + 1e-12:
        last += 1
    return float((at[first] + at[last + 1]) / 2)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE):
    """({feature: weight}, thresholds, cut) or None if the rated rows are not of at least two grades.

    Copies of a text count once, with their least grade.
    """
    spark = docs.sparkSession
    python_ready(spark)
    work = Workspace(spark, "quality")
    picked = graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rated = texts.join(F.broadcast(picked), "doc_id").select("grade", "text", *hash128(F.col("text")))
    rated = rated.select("grade", "h1", "h2", all_features("text").alias("features"))
    rated = rated.groupBy("h1", "h2").agg(F.min("grade").alias("grade"), F.first("features").alias("features"))
    found = work.write(rated, "rated").orderBy("h1", "h2").toArrow()
    grades = found.column("grade").to_numpy()
    if len(np.unique(grades)) < 2:
        return None
    ends = np.cumsum(pc.list_value_length(found.column("features")).to_numpy())
    names, features = np.unique(pc.list_flatten(found.column("features")).to_numpy(), return_inverse=True)
    features = features.astype(np.int32)
    # the rows come in order of their hashes, so the last ones are as good a part as any
    seen = len(grades) - len(grades) // HELD
    x = np.zeros(len(names) + 2)
    x[-2:] = -2.5, math.log(0.7)
    x = fit_ordinal(ends[:seen], features, grades[:seen], x)
    scores = np.bincount(np.repeat(np.arange(len(grades)), np.diff(ends, prepend=0)), x[features], len(grades))[seen:]
    cut = best_cut(sigmoid(scores - limits_of(x)[1]), grades[seen:] == GRADES - 1)
    x = fit_ordinal(ends, features, grades, x)
    return {int(names[k]): float(x[k]) for k in np.flatnonzero(x[:-2])}, limits_of(x).tolist(), cut


_tokens: dict = {}


def score_udf(weights: dict[int, float], limits: list[float]):
    @F.arrow_udf(T.StructType([T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_probability", T.DoubleType())]))
    def scores(texts: pa.Array) -> pa.Array:
        key = xxhash.xxh64_intdigest(repr((sorted(weights.items()), limits)))
        if key not in _tokens:
            _tokens.clear()
            _tokens[key] = Tokens(weights)
        tokens = _tokens[key]
        for x in REPEATS:
            weights.setdefault(x, 0.0)
        s = np.array([sum(map(weights.__getitem__, sorted(text_features(x, tokens)))) for x in texts.to_pylist()], float)
        p1, p2 = sigmoid(s - limits[0]), sigmoid(s - limits[1])
        return pa.StructArray.from_arrays([pa.array(p1 + p2), pa.array(p2)], ["expected_grade", "tail_probability"])

    return scores


def rate(docs: DataFrame, fitted, text_col: str = "text", cut: float | None = None) -> DataFrame:
    """All columns of `docs` in a struct `row`, with `expected_grade` (0 to 2), `tail_probability` of the best grade and
    `kept`, whether that is at least `cut`, by default the one that was fitted. Null and empty texts have no feature, so
    they get what a text without evidence gets. With nothing fitted the scores are null and all rows are kept. Repeated rows stay."""
    rows = docs.select(F.struct("*").alias("row"))
    if fitted is None:
        null = F.lit(None).cast("double")
        return rows.select("row", null.alias("expected_grade"), null.alias("tail_probability"), F.lit(True).alias("kept"))
    weights, limits, chosen = fitted
    scored = rows.select("row", score_udf(weights, limits)(F.col(f"row.{text_col}")).alias("s"))
    return scored.select("row", "s.*").withColumn("kept", F.col("tail_probability") >= (chosen if cut is None else cut))


def op2_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = rate(docs, fit(docs, table(spark, sf_dir, "labels")))
    return rated.select("row.doc_id", "expected_grade", "tail_probability", "kept")
