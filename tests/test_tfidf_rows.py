"""TF-IDF: documents of one row are counted and normalised where they lie; repeated ids are counted together."""

from pyspark.sql import functions as F

TEXTS = [(1, "red house red door"), (2, "blue house near red door"), (3, "red red red"), (4, ""), (5, None), (6, "one-word"),
         (7, "house"), (None, "red house"), (None, "blue house"), (8, "red door"), (8, "red door red house"), (9, "zebra only here")]


def test_weights_equal_the_shuffled_ones(spark):
    from leasekit.operators import text_vectors as TV

    for rows in (TEXTS, [r for r in TEXTS if r[0] not in (None, 8)]):
        docs = spark.createDataFrame(rows, "id long, text string").repartition(2)
        tc = TV.term_counts(docs, "id", "text")
        vocab = TV.fit_vocabulary(tc, 2, 50)
        want = TV.tfidf(tc, vocab, F.lit(len(rows)))
        got_vocab, got = TV.tfidf_fit_transform(docs, "id", "text", min_df=2, max_features=50)
        assert sorted(map(tuple, got_vocab.collect())) == sorted(map(tuple, vocab.collect()))
        show = lambda df: sorted((str(r.doc), r.term, round(r.weight, 9)) for r in df.collect())
        assert show(got) == show(want) and got.count()


def test_documents_cut_by_batches(spark):
    from leasekit.operators import text_vectors as TV

    docs = spark.range(40).select("id", F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(30) + F.col("id") % 3), lambda i: F.concat(F.lit("word"), i))).alias("text"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        _, got = TV.tfidf_fit_transform(docs, "id", "text", min_df=1)
        norms = got.groupBy("doc").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(norms) == 40 and all(abs(r.n - 1) < 1e-9 for r in norms)


def test_weights_are_not_shuffled(spark):
    from leasekit.operators import text_vectors as TV

    docs = spark.createDataFrame([(i, f"red house {i % 3}") for i in range(30)], "id long, text string")
    _, got = TV.tfidf_fit_transform(docs, "id", "text", min_df=1)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan, plan
