"""Relational TF-IDF and truncated SVD of listing text.

TF-IDF is expressed as joins and aggregations over (doc, term) rows, so it is
plain Spark SQL (checkable in DuckDB) and scales with the number of term
occurrences: tokenise -> drop stop words -> 1- and 2-grams -> explode ->
groupBy(doc, term) -> document frequencies -> vocabulary (top ``max_features``
by corpus count among terms with df >= ``min_df``) -> sublinear tf x smoothed
idf -> L2 normalisation per document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasekit import presets
from leasekit.functions.text import fold_accents
from leasekit.session import materialize

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def tokens(text: Column, stop_words: Sequence[str] = presets.ENGLISH_STOP_WORDS) -> Column:
    """Lower-cased, accent-folded tokens of 2+ word characters, stop words removed."""
    toks = F.regexp_extract_all(fold_accents(F.lower(F.coalesce(text, F.lit("")))), F.lit(TOKEN_PATTERN), 0)
    if not stop_words:
        return toks
    # IN over literals becomes a hash-set lookup (OptimizeIn), not a scan of the list per token.
    return F.filter(toks, lambda t: ~t.isin(list(stop_words)))


def ngrams(toks: Column, n_max: int = 2) -> Column:
    """Unigrams plus contiguous bigrams of the (already filtered) token array."""
    out = toks
    if n_max >= 2:
        big = F.transform(F.sequence(F.lit(1), F.greatest(F.size(toks) - 1, F.lit(1))),
                          lambda i: F.concat(F.element_at(toks, i), F.lit(" "), F.element_at(toks, i + 1)))
        out = F.concat(out, F.when(F.size(toks) >= 2, big).otherwise(F.array().cast("array<string>")))
    return out


def term_counts(docs: DataFrame, doc_id: str, text: str, n_max: int = 2,
                stop_words: Sequence[str] = presets.ENGLISH_STOP_WORDS) -> DataFrame:
    """(doc, term, tf) rows.

    Tokens are projected into their own column first: the n-gram lambda reads
    the array once per position, and an inlined tokeniser would re-run the
    regex over the whole text for each of them.
    """
    toks = docs.select(F.col(doc_id).alias("doc"), tokens(F.col(text), stop_words).alias("_t"))
    # The outer explode: an inner one is tested for its size in a filter that Spark pushes below the projection.
    terms = toks.select("doc", F.explode_outer(ngrams(F.col("_t"), n_max)).alias("term")).where("term is not null")
    return terms.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"))


def fit_vocabulary(tc: DataFrame, min_df: int = presets.TFIDF_MIN_DF,
                   max_features: int = presets.TFIDF_MAX_FEATURES) -> DataFrame:
    """(term, df, cf, idx): terms with df >= min_df, the ``max_features`` most frequent
    by corpus count (ties by term). The top-n is a TakeOrderedAndProject, not a global sort."""
    stats = tc.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    top = stats.filter(F.col("df") >= min_df).orderBy(F.desc("cf"), F.asc("term")).limit(max_features)
    return top


def _weighted(tc: DataFrame, vocab: DataFrame, n_docs: Column) -> DataFrame:
    """``tc``, its terms in the vocabulary only, with ``w`` before normalisation; rows keep their order."""
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    v = F.broadcast(vocab.select("term", idf.alias("idf")))
    return tc.join(v, "term").withColumn("w", (F.lit(1.0) + F.log(F.col("tf"))) * F.col("idf"))


def tfidf(tc: DataFrame, vocab: DataFrame, n_docs: Column) -> DataFrame:
    """(doc, term, weight): (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1), L2-normalised per doc.

    The vocabulary has at most ``max_features`` rows (a proven bound), so it is broadcast.
    """
    w = _weighted(tc, vocab, n_docs).select("doc", "term", "w")
    norms = w.groupBy("doc").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norms, "doc").select("doc", "term", (F.col("w") / F.col("norm")).alias("weight"))


def row_counts(docs: DataFrame, doc_id: str, text: str, n_max: int = 2,
               stop_words: Sequence[str] = presets.ENGLISH_STOP_WORDS) -> DataFrame:
    """(_row, doc, term, tf) of each row by itself, without a shuffle: its terms are sorted, and a run of equal ones is
    counted by the distance of the starts. A row's terms lie next to each other and have one number ``_row``.

    The outer explode keeps Spark from testing the array's size in a filter of its own, which would be pushed below the
    projections and run the tokeniser again for every position.
    """
    toks = docs.select(F.col(doc_id).alias("doc"), tokens(F.col(text), stop_words).alias("_t"))
    terms = toks.select("doc", F.sort_array(ngrams(F.col("_t"), n_max)).alias("_s"))
    new = lambda i: (i == 1) | (F.element_at("_s", i) != F.element_at("_s", F.greatest(i - 1, F.lit(1))))
    starts = terms.withColumns({"_row": F.monotonically_increasing_id(), "_at": F.when(F.size("_s") > 0, F.filter(F.sequence(F.lit(1), F.size("_s")), new))})
    after = lambda k: F.coalesce(F.get("_at", k + 1), F.size("_s") + 1)
    runs = F.transform("_at", lambda i, k: F.struct(F.element_at("_s", i).alias("term"), (after(k) - i).cast("long").alias("tf")))
    return starts.select("_row", "doc", F.explode_outer(runs).alias("r")).select("_row", "doc", "r.*").where("term is not null")


def _unit(batches):
    """Weights of rows that lie next to each other under one ``_row``, divided by their L2 norm."""
    import numpy as np
    import pyarrow as pa

    def scaled(part):
        row, w = part.column("_row").to_numpy(), part.column("w").to_numpy()
        start = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        norm = np.repeat(np.sqrt(np.add.reduceat(w * w, start)), np.diff(np.append(start, len(row))))
        out = pa.table([part.column("doc"), part.column("term"), pa.array(w / norm)], names=["doc", "term", "weight"])
        return out.to_batches()

    held = None  # the last row's terms, at most a vocabulary
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        row = whole.column("_row").to_numpy()
        cut = len(row) - int(np.argmax(row[::-1] != row[-1])) if row[0] != row[-1] else 0
        if cut:
            yield from scaled(whole.slice(0, cut))
        held = whole.slice(cut)
    if held is not None:
        yield from scaled(held)


def tfidf_fit_transform(docs: DataFrame, doc_id: str, text: str, min_df: int = presets.TFIDF_MIN_DF,
                        max_features: int = presets.TFIDF_MAX_FEATURES,
                        stop_words: Sequence[str] = presets.ENGLISH_STOP_WORDS) -> tuple[DataFrame, DataFrame]:
    """Vocabulary (written) and weights. A document that is one row is counted and normalised in its own task, so that only
    term totals are shuffled; the rows of a document id that comes more than once are counted together."""
    ids = docs.groupBy(F.col(doc_id).alias("_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_id")
    repeated = materialize(ids)
    alone, together = docs, None
    if not repeated.isEmpty():
        same = F.col(doc_id).eqNullSafe(F.col("_id"))
        alone, together = (docs.join(repeated, same, how) for how in ("left_anti", "left_semi"))
        together = term_counts(together, doc_id, text, stop_words=stop_words)
    counts = row_counts(alone, doc_id, text, stop_words=stop_words)
    rows = counts.drop("_row")
    vocab = materialize(fit_vocabulary(rows if together is None else rows.unionByName(together), min_df, max_features))
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    kind = docs.schema[doc_id].dataType.simpleString()
    weights = _weighted(counts, vocab, n_docs).select("_row", "doc", "term", "w").mapInArrow(_unit, f"doc {kind}, term string, weight double")
    return vocab, weights if together is None else weights.unionByName(tfidf(together, vocab, n_docs))


def vocabulary_index(vocab: DataFrame) -> DataFrame:
    """The vocabulary with ``j`` = 0, 1, … by falling corpus count (ties by term). It has at most max_features rows, so a
    global window over it is cheap."""
    from pyspark.sql import Window

    return vocab.withColumn("j", (F.row_number().over(Window.orderBy(F.desc("cf"), F.asc("term"))) - 1).cast("int"))


def sparse_rows(weights: DataFrame, index: DataFrame) -> DataFrame:
    """``doc, j, w``: the terms (numbers, rising) and weights of every document with a term; ``index`` is (term, j)."""
    return (weights.join(F.broadcast(index.select("term", "j")), "term")
            .groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("j", "weight"))).alias("e"))
            .select("doc", F.col("e.j").cast("array<int>").alias("j"), F.col("e.weight").alias("w")))


#: Documents whose dense rows are held at once; parts that the terms' sums are dealt to.
_CHUNK, _PARTS = 256, 64


def _products(batch, z):
    """Chunks (terms, weights, owner document, documents x columns of A z) of an Arrow batch of sparse rows."""
    import numpy as np

    for a in range(0, batch.num_rows, _CHUNK):
        b = batch.slice(a, _CHUNK)
        j, w = (b.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("j", "w"))
        sizes = b.column("j").value_lengths().to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        yield b, j, w, np.repeat(np.arange(len(sizes)), sizes), np.add.reduceat(z[j] * w[:, None], starts, 0)


def _one_pass(rows: DataFrame, z):
    """AᵀA z and the R factor of A z, in one distributed pass over the sparse rows.

    Every task adds up its documents' part of Aᵀ(A z) by term and keeps one small R factor of its rows of A z; sums
    are dealt by term, and R factors meet in a tree. The driver holds (terms x columns), bounded by the vocabulary.
    """
    import numpy as np
    import pyarrow as pa

    n, l = z.shape
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(z)

    def part(batches):
        z = sent.value
        total, r, seen = np.zeros((n, l)), np.zeros((0, l)), np.zeros(n, bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            for _, j, w, owner, y in _products(batch, z):
                order = np.argsort(j, kind="stable")
                first = np.flatnonzero(np.append(True, np.diff(j[order]) != 0))
                total[j[order][first]] += np.add.reduceat(y[owner[order]] * w[order][:, None], first, 0)
                seen[j] = True
                r = np.linalg.qr(np.vstack([r, y]), mode="r")
        for some in np.array_split(np.flatnonzero(seen), max(1, int(seen.sum()) // 2048)):
            yield pa.record_batch([pa.array(some % _PARTS, pa.int32()), pa.array(some, pa.int32()), pa.array([x.tobytes() for x in total[some]], pa.binary())], names=["part", "j", "x"])
        if len(r):
            full = np.zeros((l, l))
            full[:len(r)] = r
            place = hash(r.tobytes()) % 16
            yield pa.record_batch([pa.array([-1 - place], pa.int32()), pa.array([-1], pa.int32()), pa.array([full.tobytes()], pa.binary())], names=["part", "j", "x"])

    def whole(group):
        x = np.stack([np.frombuffer(v.as_buffer()) for v in group.column("x")])
        j = group.column("j").to_numpy()
        if j[0] < 0:
            r = np.linalg.qr(x.reshape(-1, l), mode="r")
            full = np.zeros((l, l))
            full[:len(r)] = r
            return pa.table([group.column("part").slice(0, 1), pa.array([-1], pa.int32()), pa.array([full.tobytes()], pa.binary())], names=["part", "j", "x"])
        order = np.argsort(j, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(j[order]) != 0))
        sums = np.add.reduceat(x[order], first, 0)
        return pa.table([pa.array(np.full(len(first), group.column("part")[0].as_py()), pa.int32()), pa.array(j[order][first], pa.int32()), pa.array([v.tobytes() for v in sums], pa.binary())], names=["part", "j", "x"])

    kind = "part int, j int, x binary"
    found = rows.mapInArrow(part, kind).groupBy("part").applyInArrow(whole, kind).collect()  # a row a term, and up to 16 R factors
    total, tops = np.zeros((n, l)), [np.zeros((l, l))]
    for f in found:
        x = np.frombuffer(f.x)
        if f.j < 0:
            tops.append(x.reshape(l, l))
        else:
            total[f.j] = x
    sent.unpersist()
    return total, np.linalg.qr(np.vstack(tops), mode="r")


def randomized_svd(rows: DataFrame, n_terms: int, k: int, oversample: int = 10, power_iter: int = 4, seed: int = presets.SEED):
    """Top-k singular values and right singular vectors (terms x k) of sparse rows by a randomized range finder.

    With A z = Q R, AᵀQ is (AᵀA z) R⁻¹, so every power iteration is one pass and Q is never stored. Passes over the
    data: power_iter + 1, whatever its size.
    """
    import numpy as np

    z = np.random.default_rng(seed).standard_normal((n_terms, min(k + oversample, n_terms)))
    for step in range(power_iter + 1):
        total, r = _one_pass(rows, z)
        u, s, _ = np.linalg.svd(r)  # R⁻¹ without directions that A z does not have
        keep = s > s.max(initial=0) * 1e-10
        _, sr, vt = np.linalg.svd(r, full_matrices=False)
        bt = total @ (vt[keep].T / sr[keep]) @ u[:, :len(sr)][:, keep].T  # AᵀQ
        if step < power_iter:
            z, _ = np.linalg.qr(bt)
    v, s, _ = np.linalg.svd(bt, full_matrices=False)
    # A column's sign is that of its largest entry, so that two fits give the same.
    v = v * np.sign(v[np.abs(v).argmax(0), np.arange(v.shape[1])])
    return s[:k], v[:, :k]


def project(rows: DataFrame, v, prefix: str = "text_svd_") -> DataFrame:
    """``doc`` and the scores A·V of sparse rows; V (terms x components) is bounded by the vocabulary."""
    import numpy as np
    import pyarrow as pa

    names = [f"{prefix}{i}" for i in range(v.shape[1])]
    sent = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(v))

    def scores(batches):
        for batch in batches:
            if batch.num_rows:
                for b, _, _, _, y in _products(batch, sent.value):
                    yield pa.record_batch([b.column("doc"), *(pa.array(y[:, i].copy()) for i in range(len(names)))], names=["doc", *names])

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(scores, f"doc {kind}, " + ", ".join(f"{c} double" for c in names))


def truncated_svd(weights: DataFrame, vocab: DataFrame, k: int = presets.SVD_COMPONENTS, prefix: str = "text_svd_"):
    """Top-k singular triplets of the (doc x term) TF-IDF matrix, not centred. Scores are A·V = U·S with document ids
    kept. Returns (scores DataFrame, singular values, V as numpy array)."""
    n_terms = vocab.count()
    rows = materialize(sparse_rows(weights, vocabulary_index(vocab)))
    s, v = randomized_svd(rows, n_terms, max(1, min(k, n_terms - 1)))
    return materialize(project(rows, v, prefix)), s, v
