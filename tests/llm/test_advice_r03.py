"""Cases of the second review: forms and class words, keys beside words, wide token ids, clashing columns of the model."""

import random
import string

import pytest
from pyspark.sql import functions as F

from leasekit.llm import language_model, main_text, secrets
from leasekit.llm.queries import tokenizer_file
from tests.llm.fixtures import documents

ARTICLE = "<h1>Title of it</h1>" + "".join(f"<p>Sentence {k}, one of the many, tells of this and that; it ends here.</p>" for k in range(12))
TEXT = "Title of it " + " ".join(f"Sentence {k}, one of the many, tells of this and that; it ends here." for k in range(12))


@pytest.mark.parametrize("html", [
    f'<body><form action="x"><input type="hidden" name="v"><div>{ARTICLE}</div><input name="q"></form></body>',
    f"<body><article>{ARTICLE}<form><input name=a><textarea></textarea><p>Write, if you like, to us.</p><button>Send it</button></form></article></body>",
    f"<body><article>{ARTICLE}<div><label for=a>Your name</label><button>Press, now.</button></div></article></body>",
    f"<body><article>{ARTICLE.replace('<p>Sentence 3', '<p class=notice>Sentence 3').replace('<p>Sentence 5', '<p class=share-price>Sentence 5')}</article></body>",
    f"<body><form>Search <input name=q> <select><option>x</select></form><article>{ARTICLE}</article></body>",
])
def test_forms_and_class_words(html):
    assert main_text.main_text(html) == TEXT


@pytest.fixture(scope="module")
def tokens():
    return secrets._tokens(tokenizer_file("byte_bpe_50k.tiktoken"))


@pytest.mark.parametrize("frame", ["{}", "/documentation/configuration/production/deployment/{}", "https://hooks.example.com/services/notifications/{}", "configuration.production.{}", "name={}&page"])
def test_keys_beside_words_are_found_as_bare_ones(tokens, frame):
    draw = random.Random(5)
    for _ in range(100):
        key = "".join(draw.choices(string.ascii_letters + string.digits, k=32))
        text = f"see {frame.format(key)} there"
        spans = [text[a:b] for a, b, k in secrets.scan(text, tokens) if k == 3]
        assert len(spans) == 1 and key in spans[0]


def test_words_and_identifiers_are_no_keys(tokens):
    for text in ("/documentation/configuration/production/deployment/readme", "see www.example.com/some/long/path/of/words.html now",
                 "id 3f2504e0-4f89-41d3-9a0c-0305e82c3301/3f2504e0-4f89-41d3-9a0c-0305e82c3302 end", "a.b.c.d.e.f.g.h.i.j.k.l.m.n.o.p.q.r.s.t", "one-two-three-four-five-six-seven", "......................."):
        assert not [s for s in secrets.scan(text, tokens) if s[2] == 3], text


def test_wide_token_ids(spark, tmp_path):
    from leasekit.llm.records import token_records

    docs = documents(spark).select("doc_id", "text")
    narrow, wide = (token_records(spark, docs, tokenizer_file("byte_bpe_50k.json"), end_id=e, files=3).toPandas().sort_values("start") for e in (2, 70_000))
    assert wide["n_tokens"].tolist() == narrow["n_tokens"].tolist() and wide["start"].tolist() == narrow["start"].tolist()
    assert (wide["ids_crc32"].to_numpy() != narrow["ids_crc32"].to_numpy()).all()


def test_model_columns_may_clash(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    plain = language_model.classify(docs, labels)
    odd = docs.withColumns({c: F.lit("x") for c in ("lm_bits", "lm_bytes", "lm_lang", "lm_limit", "lm_id", "lm_kept", "extra_0")})
    clash = language_model.classify(odd, labels)
    assert set(clash.columns) == {*odd.columns, "lm_perplexity", "lm_threshold", "lm_kept"}
    keys = ["doc_id", "lm_perplexity", "lm_threshold", "lm_kept"]
    assert sorted(map(tuple, plain.select(keys).collect())) == sorted(map(tuple, clash.select(keys).collect()))
