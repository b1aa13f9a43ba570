"""Queries of the llm operators, with production parameters over their whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leasekit.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB SQL of the queries that SQL can express; the others are tested against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def tokenizer_file(name: str) -> str:
    """A vocabulary file: in the folder LEASEKIT_TOKENIZERS, else where the public_tokenizers package has it."""
    if folder := os.environ.get("LEASEKIT_TOKENIZERS"):
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leasekit.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), capacity=2048, end_id=0)


@query
def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leasekit.llm.records import token_records

    return token_records(spark, table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=2)


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leasekit.llm.transducer import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), limit=1024)


@query
def op8_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leasekit.llm.simhash import hex_print, near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", hex_print(found.fp).alias("fingerprint"), "component_id")


@query
def op3_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leasekit.llm.contamination import contaminated

    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=5, containment_percent=80)
    return found.select("doc_id", "item_id", "n_shared", "n_shingles", (found.n_shared / found.n_shingles).alias("containment"))


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leasekit.llm.secrets import scan_secrets

    return scan_secrets(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leasekit.llm.language_model import classify

    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), quantile=0.99)
    return found.select("doc_id", "lang", found.lm_perplexity.alias("perplexity"), found.lm_threshold.alias("threshold"), found.lm_kept.alias("kept"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leasekit.llm.quality_rules import quality_rules

    found = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), least_score=0.5)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


@query
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leasekit.llm.main_text import extract

    return extract(table(spark, sf_dir, "pages"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from leasekit.llm.whitening import whiten

    found = whiten(table(spark, sf_dir, "embeddings"), components=8)
    # beyond some millions of rows the exact sum can leave the range of a long: null there
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leasekit.llm.language_id import identify

    return identify(table(spark, sf_dir, "documents"))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leasekit.llm.lexical_search import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
ORACLE_SQL["op13_lexical_search"] = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS t FROM documents WHERE text IS NOT NULL),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS HUGEINT) AS n_terms FROM d WHERE len(t) > 0),
q AS (SELECT item_id, term, count(*) AS n FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
o AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM o, c GROUP BY term),
e AS (SELECT doc_id, term, w, (1000000000 * tf) // (1000 * tf + 8 * CAST(25 + (75 * n * n_docs) // n_terms AS BIGINT)) AS g
  FROM o JOIN w USING (term), c),
s AS (SELECT item_id, doc_id, CAST(sum(q.n * w * g) AS BIGINT) AS score FROM q JOIN e USING (term) GROUP BY ALL),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""


#: The rules of op6, longest fitting one decides.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's labels are those of the document whose number ends its path; bad: low quality or toxic."""
    from pyspark.sql import functions as F

    from leasekit.llm.url_filter import filter_urls, host_and_path

    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    number = F.regexp_extract(host_and_path(F.col("url"))[1], r"/([0-9]{1,18})(?:\.[A-Za-z]+)?/?$", 1)
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("bad"))
    judged = pages.select("url", number.try_cast("long").alias("doc_id"))
    return filter_urls(pages, judged.join(marked, "doc_id").select("url", "bad"), URL_RULES)
