"""Operator 10: quality rules, fixed ones and gradient-boosted trees over document statistics.

Every whole text is read once, without a shuffle, for its statistics. The trees are fitted on at most ``SAMPLE``
labelled documents (those with the smallest hash of doc_id, a bound on driver memory whatever the corpus), by histogram
boosting of the logistic loss. Chosen features are monotone: more symbols, repeated lines or repeated words can
never raise a score (``FEATURES``, -1). All trees are flattened into arrays of features, thresholds, children and
values, and whole batches walk down them level by level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasekit.llm.common import slices, utf8, written
from leasekit.llm.words import split_words, windows

#: Words are runs of bytes other than these; symbols of the base rule: fixed values.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
_WORD = bytes(int(b not in SPACE) for b in range(256))
_UPPER, _DIGITS, _MARKS = bytes(range(65, 91)), b"0123456789", b"!?"
_CONTINUATION = bytes(range(128, 192))
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks")
#: Features with their monotonic constraint (-1: more of it never raises the score; 0: free).
FEATURES = {"log_words": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeat_words": -1, "upper": -1, "digits": 0, "marks": -1, "words_per_line": 0}
#: Labelled documents that the trees are fitted on, at most.
SAMPLE = 20_000


def repeated_words(codes: np.ndarray, different: int, counts: np.ndarray, size: int = 3) -> np.ndarray:
    """Words of each text inside windows of ``size`` words that its text has twice or more (the first included)."""
    first, text = windows(counts, size)
    key = np.zeros(len(first), np.int64)
    for k in range(size):
        if different ** 2 >= 1 << 62 or (k == size - 1 and different ** size >= 1 << 63):  # too wide: number the windows so far
            key = np.unique(key, return_inverse=True)[1]
        key = key * different + codes[first + k]
    order = np.lexsort((key, text))
    same = (key[order][1:] == key[order][:-1]) & (text[order][1:] == text[order][:-1])
    again = np.zeros(len(first), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    inside = np.zeros(len(codes) + 1, np.int64)
    for k in range(size):
        inside[1 + first[again] + k] = 1
    ends = np.cumsum(counts)
    total = np.cumsum(inside)
    return total[ends] - total[ends - counts]


def statistics_of(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    words, counts, _ = split_words(data, offsets, _WORD)
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    out = {name: np.zeros(len(counts), np.int64) for name in STATISTICS}
    out["n_words"] = counts.astype(np.int64)
    out["n_repeat_words"] = repeated_words(codes, len(words.dictionary), counts)
    raw = data.tobytes()
    for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        text = raw[a:b]
        size = len(text)
        count = lambda kind: size - len(text.translate(None, kind))  # noqa: B023, E731
        out["word_chars"][k] = len(text.translate(None, SPACE + _CONTINUATION))
        out["n_symbols"][k], out["n_upper"][k], out["n_digits"][k], out["n_marks"][k] = map(count, (SYMBOLS, _UPPER, _DIGITS, _MARKS))
        lines = [line for line in text.split(b"\n") if line.strip()]
        out["n_lines"][k] = len(lines)
        out["n_dup_lines"][k] = len(lines) - len(set(lines))
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and STATISTICS of every whole text (null: no words). Rows stay one to one."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = statistics_of(*utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(found[c]) for c in STATISTICS)], names=["doc_id", *STATISTICS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(measure, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in STATISTICS))


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """One column for each of FEATURES."""
    s = {k: v.astype(np.float64) for k, v in stats.items()}
    chars, words, lines = np.maximum(s["word_chars"], 1), np.maximum(s["n_words"], 1), np.maximum(s["n_lines"], 1)
    return np.stack([np.log1p(s["n_words"]), s["word_chars"] / words, s["n_symbols"] / chars, s["n_dup_lines"] / lines, s["n_repeat_words"] / words, s["n_upper"] / chars, s["n_digits"] / chars, s["n_marks"] / chars, s["n_words"] / lines], 1)


@dataclass
class Forest:
    """All trees as flat node arrays; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality of each row."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, least: int = 10, ridge: float = 1.0) -> Forest:
    """Histogram gradient boosting with monotonic constraints.

    A split on a constrained feature must order its two leaves rightly, and the middle of the two values bounds both
    branches from then on, so the whole tree, and the sum of trees, is monotone.
    """
    nodes: list[list[float]] = []
    roots = []
    share = min(max(y.mean() if len(y) else 1.0, 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], 1) if len(x) else np.zeros(x.shape, np.int64)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        value = lambda gs, hs: np.clip(-gs / (hs + ridge), low, high)
        gain_of = lambda gs, hs, v: -(gs * v + 0.5 * (hs + ridge) * v * v)
        here = len(nodes)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        mine = float(value(total_g, total_h))
        nodes.append([0, np.inf, here, here, rate * mine])
        best = (1e-6, -1, -1, 0.0, 0.0)
        if level < depth and len(rows) >= 2 * least:
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                size = len(e) + 1
                bg, bh, bn = (np.bincount(binned[rows, f], w, size).cumsum()[:-1] for w in (g[rows], h[rows], None))
                vl, vr = value(bg, bh), value(total_g - bg, total_h - bh)
                gain = gain_of(bg, bh, vl) + gain_of(total_g - bg, total_h - bh, vr) - gain_of(total_g, total_h, mine)
                gain[(bn < least) | (len(rows) - bn < least) | ((vr - vl) * monotone[f] < 0)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], f, k, float(vl[k]), float(vr[k]))
        _, f, k, vl, vr = best
        if f >= 0:
            goes = binned[rows, f] <= k
            middle = (vl + vr) / 2
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[monotone[f]]
            left = grow(rows[goes], g, h, level + 1, *bounds[0])
            right = grow(rows[~goes], g, h, level + 1, *bounds[1])
            nodes[here] = [f, edges[f][k], left, right, 0.0]
        return here

    if len(y) and 0 < y.mean() < 1:
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            start = len(nodes)
            roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
            tree = Forest(*_arrays(nodes), np.array([start]), depth, 0.0)
            raw = tree.score(x)
            margin += np.log(raw / (1 - raw))
    return Forest(*_arrays(nodes), np.array(roots, np.int64), depth, base)


def _arrays(nodes: list[list[float]]) -> list[np.ndarray]:
    table = np.array(nodes, np.float64).reshape(-1, 5)
    return [table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3].astype(np.int64), table[:, 4]]


def quality_rules(docs: DataFrame, labels: DataFrame, least_score: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, STATISTICS, ``base_failed``, ``score`` and ``kept`` of every row of ``docs`` (doc_id, text).

    ``base_failed``: under 50 words, or over half of the words repeated; such a document is not kept, whatever its score.
    Else it is kept if the trees' score is at least ``least_score``. Null or empty text has no words and fails. Labels
    with a null id or quality count as none; a document labelled twice is good if all its labels are. Without labels of
    both kinds there are no trees, and the score is the share of good labels (none: 1). Repeated rows stay; an empty table
    gives an empty result; further columns are not read.
    """
    stats = written(document_statistics(docs), "statistics")
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marked = written(stats.where("doc_id is not null").join(marked, "doc_id"), "labelled")
    # The smallest hashes, by a threshold first: otherwise every partition would send as many rows as the whole sample has.
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) * 2.0 ** -53
    near = marked.withColumn("place", place).where(F.col("place") <= 1.5 * sample / max(marked.count(), 1))
    some = near.orderBy("place", "doc_id", *STATISTICS).limit(sample).toPandas()
    forest = fit(features({c: some[c].to_numpy() for c in STATISTICS}), some["quality"].to_numpy(np.float64), list(FEATURES.values()))
    if not len(some):
        forest.base = np.inf

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = forest.score(features({c: batch.column(c).to_numpy() for c in STATISTICS}))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return stats.mapInArrow(judge, f"{fields}, score double").withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= least_score))
