"""Every stage of the pipeline on what its predecessor kept, against brute force."""

import re

import corpus_pipeline
from leasekit.llm import language_model as lm
from leasekit.llm.common import written
from leasekit.llm.queries import tokenizer_file
from leasekit.llm.secrets import _tokens, scan
from tests.llm.fixtures import documents, empty
from tests.llm.test_filters import brute_model
from tests.llm.test_search import brute_components, brute_contained

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_the_rest(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, kept, after = docs.collect(), [], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, after, SF), "test-stage")
        assert after.columns == docs.columns
        kept.append(sorted(after.collect()))
    good, single, clean, redacted = kept

    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    limits = {r.doc_id: (r.lm_perplexity, r.lm_threshold) for r in lm.classify(docs.select("doc_id", "lang", "text"), spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert good == sorted(r for r in before if limits[r.doc_id][0] <= limits[r.doc_id][1])
    held = {r.doc_id for r in docs.selectExpr("doc_id", "pmod(xxhash64(doc_id), 5) as f").where("f = 0").collect()}
    bits = brute_model([r.text for r in before if r.doc_id in labels and labels[r.doc_id].quality == 1 and not labels[r.doc_id].toxic and r.doc_id not in held])
    for r in before[:40]:
        assert abs(2 ** (bits(r.text) / len(r.text.encode())) / limits[r.doc_id][0] - 1) < 1e-3
    assert sum(r.doc_id in {g.doc_id for g in good} for r in before if r.doc_id in labels and labels[r.doc_id].quality == 1) > 0.9 * sum(x.quality for x in labels.values())

    firsts = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in good])}
    assert single == [r for r in good if r.doc_id in firsts]

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = {i for i, *_ in brute_contained([(r.doc_id, r.text) for r in single], items)}
    assert clean == [r for r in single if r.doc_id not in gone] and gone

    tokens, want = _tokens(tokenizer_file("byte_bpe_50k.tiktoken")), []
    for r in clean:
        text, cover = r.text, sorted({k for s, e, _ in scan(r.text, tokens) for k in range(s, e)})
        marked = "".join("\0" if k in set(cover) else c for k, c in enumerate(text)) if cover else text
        marked = re.sub("\0+", "[SECRET]", marked)
        want.append((r.doc_id, marked, len(marked) if cover else r.n_chars))
    assert [(r.doc_id, r.text, r.n_chars) for r in redacted] == want

    packed = corpus_pipeline.STAGES[-1][1](spark, after, SF).collect()
    assert {p.doc_id for p in packed} == {r.doc_id for r in redacted} and max(p.offset + p.length for p in packed) <= 2048
    whole = corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect()
    assert sorted(whole) == sorted(p[:5] for p in packed)


def test_stages_on_awkward_and_empty_tables(spark):
    for docs in (documents(spark), empty(spark)):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = written(stage(spark, docs, SF), "test-stage")
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
