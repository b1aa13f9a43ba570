"""Operator 12: language identification by sparse multinomial logistic regression.

*Features.* A text is lower-cased, every run of code points that are no letters becomes one mark, and its character
n-grams (one to three code points, over marks too) are hashed to ``BUCKETS`` features. A feature's value is
(1 + ln count) x idf, and a document's vector has length 1. The idf comes from all documents to learn from: every task
sums how many of its documents have a feature, and Spark adds these sums.

*Fit.* Follow-the-regularised-leader (per-coordinate rates, elastic-net penalties: the L1 part keeps weights exactly 0)
passes ``EPOCHS`` times over at most ``SAMPLE`` documents, shared evenly by the languages (those with the smallest
hash). A fifth of these stays out, and a temperature is fitted on it by its log loss, so
that the scores are shares of right answers. Every document is scored in place, without a shuffle. A long text is read
block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIZES = (1, 2, 3)
BUCKETS = 1 << 18
#: Documents that the regression is fitted on, at most; passes over them.
SAMPLE, EPOCHS = 4_000, 4
#: Languages that it tells apart, at most (those with the most documents).
LANGUAGES = 64
#: Rate, its offset, and the L1 and L2 penalties.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.1
#: Code points of a text that are handled at once.
BLOCK = 1 << 20
#: What a text without letters, or without anything learned, is.
UNKNOWN = "und"
_MIX = np.uint32(0x9E3779B1)
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters (made once in a worker)."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def _blocks(text: str) -> Iterator[np.ndarray]:
    """Code points of the lower-cased text with one 0 for every run of other code points than letters, in blocks; a block
    starts with the last two of the one before. Texts begin and end with 0."""
    carried = np.zeros(1, np.uint32)
    for at in range(0, len(text), BLOCK):
        points = np.frombuffer(text[at:at + BLOCK].lower().encode("utf-32-le", "replace"), np.uint32)
        points = np.concatenate([carried, np.where(letters()[points], points, 0)])
        keep = np.ones(len(points), bool)
        keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
        points = points[keep]
        yield points
        carried = points[-2:]
    if len(text) and carried[-1]:
        yield np.append(carried, np.uint32(0))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a text, rising, and how often it has each; none if it has no letter."""
    none = np.zeros(0, np.int64)
    if not text:
        return none, none
    total, place, count, old = None, none, none, 0
    for k, points in enumerate(_blocks(text)):
        hashed, mixed = [], np.full(len(points), 1, np.uint32)
        for size in SIZES:  # the n-gram that ends at a place goes on from the one of size - 1 that ends before it
            mixed = mixed[:len(mixed) - 1] if size > 1 else mixed
            mixed = (mixed ^ points[size - 1:]) * _MIX
            mixed ^= mixed >> np.uint32(15)
            new = mixed[max(old - size + 1, 0):]  # those that end in what this block adds
            if size == 1:
                new = new[points[old:] != 0]  # a mark alone says nothing
            hashed.append(new * _MIX >> np.uint32(14))
        every = np.concatenate(hashed)
        every.sort()
        first = np.flatnonzero(np.append(len(every) > 0, every[1:] != every[:-1]))
        here, times = every[first].astype(np.int64), np.diff(np.append(first, len(every)))
        if not k:
            place, count = here, times
        else:
            if total is None:
                total = np.zeros(BUCKETS, np.int64)
                total[place] = count
            total[here] += times
        old = min(2, len(points))
    if total is not None:
        place = np.flatnonzero(total)
        count = total[place]
    return place, count


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A text's features and their values, of length 1."""
    place, count = features(text)
    value = (1 + np.log(count)) * idf[place]
    return place, value / math.sqrt(float(value @ value)) if len(value) else value


@dataclass
class Regression:
    """Weights (features x languages), intercepts, and the temperature that the sums are divided by."""

    languages: list[str]
    weights: np.ndarray
    intercept: np.ndarray
    temperature: float = 1.0

    def table(self, idf: np.ndarray) -> np.ndarray:
        """For each feature idf² and idf x weights: all that a text's score needs of it, in one place."""
        return np.column_stack([idf * idf, idf[:, None] * self.weights]).astype(np.float32)

    def shares(self, text: str, table: np.ndarray) -> np.ndarray:
        """The text's share of each language."""
        place, count = features(text)
        rows, value = table[place], (1 + np.log(count)).astype(np.float32)
        sums = value @ rows[:, 1:] / math.sqrt(max(float(value * value @ rows[:, 0]), 1e-30))
        return softmax((sums + self.intercept) / self.temperature)


def softmax(sums: np.ndarray) -> np.ndarray:
    e = np.exp(sums - sums.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def follow_leader(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n: int, buckets: int = BUCKETS, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Weights and intercepts of ``n`` classes by FTRL-proximal with elastic-net penalties (none on intercepts).

    z holds the sum of gradients less what each step's change of rate would have moved, s the squared gradients; a weight is
    0 while |z| <= l1."""
    z, s = np.zeros((buckets + 1, n)), np.zeros((buckets + 1, n))
    penalty = np.full((buckets + 1, 1), l1)
    penalty[buckets] = 0.0

    def solve(at: np.ndarray) -> np.ndarray:
        part = z[at]
        return -np.sign(part) * np.maximum(np.abs(part) - penalty[at], 0) / ((beta + np.sqrt(s[at])) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, value = np.append(rows[k][0], buckets), np.append(rows[k][1], 1.0)
            w = solve(at)
            error = softmax(value @ w)
            error[y[k]] -= 1
            g = value[:, None] * error
            old = s[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / alpha * w
            s[at] = new
    w = solve(np.arange(buckets + 1))
    return w[:buckets], w[buckets]


def fit_temperature(sums: np.ndarray, y: np.ndarray) -> float:
    """The divisor of ``sums`` with the least log loss, between 1/20 and 20 (golden section over its logarithm)."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        scaled = sums / math.exp(t)
        top = scaled.max(1)
        return float(np.mean(top + np.log(np.exp(scaled - top[:, None]).sum(1)) - scaled[np.arange(len(y)), y]))

    low, high, golden = math.log(0.05), math.log(20), (math.sqrt(5) - 1) / 2
    while high - low > 1e-3:
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def held_out(doc_id: Column) -> Column:
    """Whether crc32(doc_id as text) mod 4 is 2 (null: as empty text, so not)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit_idf(learn: DataFrame) -> np.ndarray:
    """ln((1 + n) / (1 + documents with the feature)) + 1 over all rows of ``learn`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS + 1, np.int64)  # the last: documents
        for batch in batches:
            for text in batch.column("text"):
                seen[features(text.as_py())[0]] += 1
            seen[BUCKETS] += batch.num_rows
        some = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(seen[some])], names=["feature", "n"])

    df = np.zeros(BUCKETS + 1, np.int64)
    found = learn.select("text").mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS + 1 rows
    df[found["feature"]] = found["n"]
    return np.log((1 + df[BUCKETS]) / (1 + df[:BUCKETS])) + 1


def sample(learn: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of ``learn`` (doc_id, text, lang): of every language the same number, with the smallest
    hashes; of the ``LANGUAGES`` languages with the most documents."""
    spark = learn.sparkSession
    sizes = learn.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    # Languages with few documents leave their part to the others.
    left, shares = most, {}
    for k, row in enumerate(sorted(sizes, key=lambda r: (r.n, r.lang))):
        shares[row.lang] = min(row.n, left // (len(sizes) - k))
        left -= shares[row.lang]
    # A threshold on the hash first, so that a few rows of a language meet, whatever its size.
    asked = spark.createDataFrame([(r.lang, min(1.0, 1.5 * (shares[r.lang] + 20) / r.n), shares[r.lang]) for r in sizes if shares[r.lang]], "lang string, below double, most int")
    place = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(7)), 11) * 2.0 ** -53
    near = learn.withColumn("place", place).join(F.broadcast(asked), "lang").where(F.col("place") <= F.col("below"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id", F.xxhash64("text")))
    return near.withColumn("rank", rank).where(F.col("rank") <= F.col("most")).select("doc_id", "text", "lang")


def fit(learn: DataFrame, most: int = SAMPLE) -> tuple[Regression | None, np.ndarray]:
    """The regression and the idf learned from ``learn`` (doc_id, text, lang; no nulls in the last two). None without rows."""
    idf = fit_idf(learn)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [vector(t.as_py(), idf) for t in batch.column("text")]
            yield pa.record_batch([batch.column("lang"), pa.array([p.astype("<i4").tobytes() for p, _ in found], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())], names=["lang", "place", "value"])

    rows = sorted(sample(learn, most).mapInArrow(make, "lang string, place binary, value binary").collect())
    rows = [(r.lang, np.frombuffer(r.place, "<i4").astype(np.int64), np.frombuffer(r.value, "<f4").astype(np.float64)) for r in rows if r.place]
    if not rows:
        return None, idf
    languages = sorted({r[0] for r in rows})
    y = np.array([languages.index(r[0]) for r in rows])
    apart = np.random.default_rng(42).permutation(len(rows)) < len(rows) // 5
    w, b = follow_leader([r[1:] for r, a in zip(rows, apart) if not a], y[~apart], len(languages))
    sums = np.array([r[2] @ w[r[1]] + b for r, a in zip(rows, apart) if a]).reshape(-1, len(languages))
    return Regression(languages, w, b, fit_temperature(sums, y[apart])), idf


def identify(docs: DataFrame, most: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs`` (doc_id, text, lang).

    Learns from the rows that are not held out and have a text and a lang; lang and doc_id are not read in predicting. A
    text that is null or has no letter is ``und`` with score 0, and so is every text if there is nothing to learn from;
    with one language only, all others are it, with score 1. Languages are told apart as they are written (``en`` and
    ``EN`` are two). Equal rows and null ids all stay and count each; an empty table gives an empty result; further
    columns are not read.
    """
    docs = docs.select("doc_id", "text", "lang")
    learn = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model, idf = fit(learn, most)
    scores_of = model and model.table(idf)
    if model is not None:
        model.weights = model.weights[:0]  # the table has them
    shared = docs.sparkSession.sparkContext.broadcast((model, scores_of))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        regression, scores_of = shared.value
        for batch in batches:
            named, scores = [], []
            for text in batch.column("text"):
                text = text.as_py()
                best, share = UNKNOWN, 0.0
                if regression is not None and has_letter(text):
                    shares = regression.shares(text, scores_of)
                    best, share = regression.languages[int(shares.argmax())], float(shares.max())
                named.append(best)
                scores.append(share)
            yield pa.record_batch([batch.column("doc_id"), pa.array(named, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
