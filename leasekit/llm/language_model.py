"""Operator 2: quality classifier by an interpolated modified Kneser-Ney n-gram model.

The model is trained on all trusted texts (labelled good and not toxic) but a fifth held out, as n-grams of ``ORDER``
bytes (UTF-8; a text starts after ``ORDER`` - 1 newlines). Bytes need no tokenizer or vocabulary and suit any language.

*Counts.* Tasks pre-aggregate n-gram counts, which are summed by n-gram. Lower orders count the different longer n-grams
(continuation counts). Context totals and the numbers of n-grams seen once, twice and more often are summed by context,
and join the counts on (order, context), hash-sharded: that gives each n-gram's discounted share and each context's
back-off weight. Nothing passes through the driver but four counts-of-counts an order and the symbols; the joined tables of
shares and weights stay in the shared folder.

*Scoring.* The joined tables are cut into shards of about ``CONTEXTS`` contexts by the last two bytes of a context, so
that everything which decides one position lies in one shard. A shard is of bounded size (``CONTEXTS`` x 256 shares); one
task writes it as a file in the shared folder. Documents are read once and stay where they are: a task holds some of them,
fetches one shard after the other, and adds the log-probabilities of the positions that fall in it. A text of any length is
taken block by block. Nothing of the documents is shuffled. (Joining each text position as a row would shuffle some 20
bytes for each byte of text.)

*Thresholds.* For each language, the ``quantile`` of bits per byte over its n held-out trusted documents, with the weight
n / (n + ``SHRINK``); the rest of the weight is on what is expected of the language without them: the median over all its
own N documents but those trained on (a minority of bad ones hardly moves it; it is itself drawn to the trusted median, its
weight being N / (N + ``SHRINK``)) plus the distance from median to quantile over the held-out documents of all languages. One rule holds from no
trusted document to any number, also for a language of another script. Bits are counted in buckets of 1/1000, so quantiles
are exact on buckets, and no task holds a language's documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leasekit.llm.common import hidden, scratch, slices, utf8, written

ORDER = 4
#: Contexts of a shard; trusted ids up to which the training join broadcasts them (beyond, it is a shuffle join).
CONTEXTS, BROADCAST_IDS = 32_768, 1_000_000
#: Different n-grams that a task gathers before it passes them on.
GATHER = 2_000_000
#: Positions handled at once (some 60 bytes each meanwhile); bytes of rows that one reading of all shards serves.
STEP_BYTES, HELD_BYTES = 1 << 20, 32 << 20
#: The byte before a text; the symbol that marks a context's weight in place of a share.
START, WEIGHT = 10, -2
#: Held-out documents at which a language's own quantile has half of the weight.
SHRINK = 50


def _blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Blocks ``begin, end`` of all positions, each with the ORDER - 1 bytes before every position of its own text, nearest
    first (before a text: START). A text may lie in many blocks, so a long one needs no more memory than a short one."""
    for begin in range(0, len(data), STEP_BYTES):
        end = min(begin + STEP_BYTES, len(data))
        heads = offsets[np.searchsorted(offsets, begin - ORDER, "right"):np.searchsorted(offsets, end)]
        before = []
        for k in range(1, ORDER):
            own = np.full(end - begin, START, np.uint8)
            own[max(k - begin, 0):] = data[max(begin - k, 0):max(end - k, 0)]
            for j in range(k):
                at = heads + j - begin
                own[at[(at >= 0) & (at < end - begin)]] = START
            before.append(own)
        yield begin, end, before


def ngram_counts(texts: DataFrame) -> DataFrame:
    """``gram, n``: all n-grams of ORDER bytes (big-endian number) of ``texts`` (text)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for batch in slices(batches, "text", STEP_BYTES):
            data, offsets = utf8(batch.column("text"))
            for begin, end, before in _blocks(data, offsets):
                key = np.zeros(end - begin, np.uint32)
                for byte in (*before[::-1], data[begin:end]):
                    key = (key << np.uint32(8)) | byte
                new, n = np.unique(key, return_counts=True)
                both = np.concatenate([grams, new])
                grams, where = np.unique(both, return_inverse=True)
                counts = np.bincount(where, np.concatenate([counts, n]), len(grams)).astype(np.int64)
                if len(grams) > GATHER:
                    yield pa.record_batch([pa.array(grams.astype(np.int64)), pa.array(counts)], names=["gram", "n"])
                    grams, counts = grams[:0], counts[:0]
        if len(grams):
            yield pa.record_batch([pa.array(grams.astype(np.int64)), pa.array(counts)], names=["gram", "n"])

    return texts.select("text").mapInArrow(gather, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and from 3 on, kept inside (0, count)."""
    if not (n1 and n2):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.1), k - 0.1) for k, d in enumerate(found, 1)]


def train(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kneser-Ney tables: ``order, context, symbol, share`` and ``order, context, weight``."""
    count = written(ngram_counts(texts), "ngrams")
    orders = [count.select(F.lit(ORDER).alias("order"), "gram", "n")]
    for order in range(ORDER - 1, 0, -1):
        shorter = orders[-1].groupBy(F.col("gram").bitwiseAND((1 << 8 * order) - 1).alias("gram")).agg(F.count("*").alias("n"))
        orders.append(shorter.select(F.lit(order).alias("order"), "gram", "n"))
    every = orders[0]
    for more in orders[1:]:
        every = every.union(more)
    every = written(every.select("order", F.shiftright("gram", 8).alias("context"), F.col("gram").bitwiseAND(255).alias("symbol"), "n"), "ngram-orders")
    is_ = lambda k: F.sum((F.col("n") == k).cast("long")).alias(f"n{k}")
    discounts = {r.order: _discounts(r.n1, r.n2, r.n3, r.n4) for r in every.groupBy("order").agg(*map(is_, range(1, 5))).collect()}
    off = F.lit(0.0)
    for order, ds in discounts.items():
        for k, d in enumerate(ds, 1):
            off = F.when((F.col("order") == order) & ((F.col("n") == k) if k < 3 else (F.col("n") >= 3)), d).otherwise(off)
    cut = every.withColumn("off", off)
    contexts = cut.groupBy("order", "context").agg(F.sum("n").alias("total"), F.sum("off").alias("offs"))
    shares = cut.join(contexts, ["order", "context"]).select("order", "context", "symbol", ((F.col("n") - F.col("off")) / F.col("total")).alias("share"))
    weights = contexts.select("order", "context", (F.col("offs") / F.col("total")).alias("weight"))
    return written(shares, "lm-shares"), written(weights, "lm-weights")


class Shard:
    """Log2-probabilities of every symbol after every context of a shard, as dense rows; contexts not seen share the
    row of their longest seen end. Bytes: four numbers (rows, size, shard, shards), symbols, log, place."""

    def __init__(self, raw: bytes | pa.Buffer):
        rows, self.size, shard, shards = (int(v) for v in np.frombuffer(raw, "<i8", 4))
        self.symbol = np.frombuffer(raw, "<i8", 256, 32)
        self.log = np.frombuffer(raw, "<f4", rows * self.size, 32 + 2048).reshape(rows, self.size)
        self.place = np.frombuffer(raw, "<i4", offset=32 + 2048 + 4 * rows * self.size)
        self.mine = None if shards == 1 else (np.arange(1 << 16) % shards == shard).reshape(256, 256)

    @staticmethod
    def pack(shares: dict[str, np.ndarray], weights: dict[str, np.ndarray], symbols: np.ndarray, shard: int, shards: int) -> bytes:
        """The bytes of a shard from its rows of the joined tables."""
        size = len(symbols) + 1  # the last is any byte never seen
        symbol = np.full(256, size - 1, np.int64)
        symbol[symbols] = np.arange(len(symbols))
        table = np.full((1, size), 1 / 256)
        place = np.zeros(1, np.int32)
        for order in range(1, ORDER + 1):
            contexts, weight = (weights[c][weights["order"] == order] for c in ("context", "weight"))
            if order > 1:
                place = np.tile(place, size)
            at = np.zeros(len(contexts), np.int64)
            for k in range(order - 1):
                at += symbol[(contexts >> (8 * k)) & 255] * size ** k
            new = weight[:, None] * table[place[at]]
            order_at = np.argsort(contexts)
            mine = shares["order"] == order
            row = order_at[np.searchsorted(contexts[order_at], shares["context"][mine])]
            new[row, symbol[shares["symbol"][mine]]] += shares["share"][mine]
            place[at] = len(table) + np.arange(len(contexts))
            table = np.concatenate([table, new])
        head = np.array([len(table), size, shard, shards], "<i8")
        return b"".join(x.tobytes() for x in (head, symbol.astype("<i8"), np.log2(table).astype("<f4"), place.astype("<i4")))

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of this shard's positions of each text."""
        out = np.zeros(len(offsets) - 1)
        for begin, end, before in _blocks(data, offsets):
            context = np.zeros(end - begin, np.int64)
            for k, byte in enumerate(before):
                context += self.symbol[byte] * self.size ** k
            log = self.log[self.place[context], self.symbol[data[begin:end]]].astype(np.float64)
            if self.mine is not None:
                log[~self.mine[before[1], before[0]]] = 0
            total = np.concatenate([[0], np.cumsum(log)])
            some = slice(max(np.searchsorted(offsets, begin, "right") - 1, 0), np.searchsorted(offsets, end))  # texts in this block
            edges = np.clip(offsets[some.start:some.stop + 1], begin, end) - begin
            out[some] += total[edges[:-1]] - total[edges[1:]]
        return out


class Model:
    """Scores texts by the tables of :func:`train`: a task for each shard writes it as one file in the shared folder, and
    only the files' names reach the driver."""

    def __init__(self, spark: SparkSession, shares: DataFrame, weights: DataFrame, contexts: int = CONTEXTS):
        seen = weights.where(F.col("order") == ORDER).count()
        self.shards = shards = max(1, -(-seen // contexts))
        symbols = np.array(sorted(r.symbol for r in shares.where("order = 1").select("symbol").collect()), np.int64)  # at most 256
        self.folder = folder = scratch(spark, "lm-shards")

        def write(key, group):
            shard = int(key[0].as_py())
            rows = {c: group.column(c).to_numpy() for c in ("order", "context", "symbol", "value")}
            share, weight = rows["symbol"] >= 0, rows["symbol"] == WEIGHT
            take = lambda some, **names: {new: rows[old][some] for new, old in names.items()}
            raw = Shard.pack(take(share, order="order", context="context", symbol="symbol", share="value"), take(weight, order="order", context="context", weight="value"), symbols, shard, shards)
            store, top = _store(folder)
            store.create_dir(top, recursive=True)
            name = f"shard-{shard}-{uuid.uuid4().hex[:12]}"  # of this attempt: only files that the result names are read
            with store.open_output_stream(f"{top}/{name}") as f:
                f.write(raw)
            return pa.table([pa.array([shard], pa.int32()), pa.array([name])], names=["shard", "name"])

        every = F.sequence(F.lit(0), F.lit(shards - 1))
        of = F.when(F.col("order") < 3, every).otherwise(F.array((F.col("context").bitwiseAND(0xFFFF) % shards).cast("int")))
        both = shares.select("order", "context", "symbol", F.col("share").alias("value"))
        both = both.union(weights.select("order", "context", F.lit(WEIGHT).cast("long"), "weight"))
        both = both.union(spark.range(1).select(F.lit(0), F.lit(0).cast("long"), F.lit(-1).cast("long"), F.lit(0.0)))  # a shard without rows is one too
        dealt = both.withColumn("shard", F.explode(of))
        self.names = [r.name for r in dealt.groupBy("shard").applyInArrow(write, "shard int, name string").orderBy("shard").collect()]  # a row a shard

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``lm_bits`` and ``lm_bytes`` (null or empty text: 0 and 0). No shuffle; one pass over the texts."""
        schema = T.StructType([*docs.schema.fields, T.StructField("lm_bits", T.DoubleType()), T.StructField("lm_bytes", T.LongType())])
        folder, names = self.folder, self.names

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for some in _gathered(slices(batches, "text", STEP_BYTES)):
                texts = [utf8(batch.column("text")) for batch in some]
                bits = [np.zeros(batch.num_rows) for batch in some]
                for name in names:
                    shard = _shard(folder, name)
                    for total, text in zip(bits, texts):
                        total += shard.bits(*text)
                for batch, total, (_, offsets) in zip(some, bits, texts):
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total), pa.array(np.diff(offsets))], names=schema.names)

        return docs.mapInArrow(add, schema)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Lists of batches of about HELD_BYTES together: every shard is read once for each list."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= HELD_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


_READY: dict[tuple[str, str], Shard] = {}


def _shard(folder: str, name: str) -> Shard:
    """A shard from the shared folder; a worker holds one at a time."""
    if (folder, name) not in _READY:
        _READY.clear()
        store, top = _store(folder)
        with store.open_input_file(f"{top}/{name}") as f:
            _READY[folder, name] = Shard(f.read_buffer())
    return _READY[folder, name]


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def thresholds(scored: DataFrame, quantile: float, fence: float = 0.0) -> DataFrame:
    """``lang, every, threshold, n`` (bits per byte) from n scored documents: the quantile, plus ``fence`` times its distance
    to the median; the row ``every`` true holds for all languages."""
    bucket = F.floor(1000 * F.col("lm_bits") / F.col("lm_bytes"))
    count = scored.where("lm_bytes > 0").groupBy("lang", bucket.alias("bucket")).agg(F.count("*").alias("n"))
    count = count.select("lang", F.lit(False).alias("every"), "bucket", "n").union(count.groupBy("bucket").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string"), F.lit(True), "bucket", "n"))
    group = Window.partitionBy("lang", "every")
    ranked = count.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("all", F.sum("n").over(group))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("bucket") + 1)) / 1000
    found = ranked.groupBy("lang", "every").agg(at(0.5).alias("middle"), at(quantile).alias("high"), F.max("all").alias("n"))
    return found.select("lang", "every", "n", (F.col("high") + fence * (F.col("high") - F.col("middle"))).alias("threshold"))


def limits(every: DataFrame, held_out: DataFrame, quantile: float, fence: float = 0.0) -> DataFrame:
    """``lm_lang, lm_limit`` (bits per byte) of each language of ``every``, all scored documents that the model was not
    trained on, by the scored trusted documents ``held_out``; no rows without such."""
    high, middle = (written(thresholds(held_out, *how), "thresholds") for how in ((quantile, fence), (0.5,)))
    pooled = [found.where("every").select("threshold").first() for found in (high, middle)]
    if not all(pooled):
        return every.select(F.col("lang").alias("lm_lang"), F.lit(0.0).alias("lm_limit")).limit(0)
    top, centre = (F.lit(r.threshold) for r in pooled)
    own = thresholds(every, 0.5).where(~F.col("every")).select(F.col("lang").alias("lm_lang"), F.col("n").alias("own_n"), F.col("threshold").alias("own"))
    trusted = high.where(~F.col("every")).select("lang", "n", "threshold")
    found = own.join(trusted, F.col("lang").eqNullSafe(F.col("lm_lang")), "left").fillna(0, ["n"])
    drawn = lambda value, n, to: to + n / (n + SHRINK) * (value - to)
    expected = drawn(F.col("own"), F.col("own_n"), centre) + top - centre
    return found.select("lm_lang", drawn(F.coalesce("threshold", expected), F.col("n"), expected).alias("lm_limit"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, fence: float = 0.0) -> DataFrame:
    """``docs`` (with text, lang, doc_id and any further columns) plus ``lm_perplexity`` (2 ** bits per byte),
    ``lm_threshold`` and ``lm_kept``; columns of ``docs`` with these three names give way.

    Null or empty texts have no perplexity and are not kept. Labels with a null id or quality count as no label; a label
    given twice counts if every row of it is good. With no trusted text at all, every text with a byte is kept. A null
    language is a language of its own. Repeated rows stay; an empty table gives an empty result.
    """
    spark, given = docs.sparkSession, docs.columns
    docs, _ = hidden(docs, ["doc_id", "lang", "text"])
    trusted = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("lm_id")).agg(F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good")).where("good").select("lm_id")
    trusted = written(trusted, "trusted")
    ids = F.broadcast(trusted) if trusted.count() <= BROADCAST_IDS else trusted
    good = docs.select("doc_id", "lang", "text").join(ids, F.col("doc_id") == F.col("lm_id"), "left_semi")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    model = Model(spark, *train(good.where(~held_out)))
    bits_of = lambda some: written(model.score(some.select("lang", "text")).drop("text"), "lm-bits")
    unseen = docs.select("doc_id", "lang", "text").join(ids, (F.col("doc_id") == F.col("lm_id")) & ~held_out, "left_anti")
    limit = written(limits(bits_of(unseen), bits_of(good.where(held_out)), quantile, fence), "limits")
    languages = limit.count()
    out = model.score(docs).join(F.broadcast(limit) if languages <= 10_000 else limit, F.col("lang").eqNullSafe(F.col("lm_lang")), "left")
    bits = F.try_divide("lm_bits", "lm_bytes")
    # Without held-out texts there is no limit; with them, a language without one has no text but what was trained on.
    most = F.coalesce("lm_limit", F.lit(float("inf")))
    out = out.withColumns({"lm_perplexity": F.pow(F.lit(2.0), bits), "lm_threshold": F.pow(F.lit(2.0), most), "lm_kept": F.coalesce(bits <= most, F.lit(False))})
    own = ["lm_perplexity", "lm_threshold", "lm_kept"]
    return out.select(*(F.col(n).alias(c) for c, n in zip(given, docs.columns) if c not in own), *own)


def keep_good(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, fence: float = 0.0) -> DataFrame:
    """``docs`` without the documents that :func:`classify` does not keep."""
    inner, restore = hidden(docs, ["doc_id", "lang", "text"])  # columns named as classify's own stay as they are
    return restore(classify(inner, labels, quantile, fence).where("lm_kept"))
