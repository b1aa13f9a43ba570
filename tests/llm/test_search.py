"""SimHash classes, connected components and benchmark containment against brute force."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from leasekit.llm import contamination, simhash
from leasekit.llm.graph import components
from leasekit.llm.queries import QUERIES
from tests.llm.fixtures import SCHEMA, TEXTS, documents, empty, rows

SF = "/root/testdata/sf0.001"


def brute_print(text, size=3):
    words = [w.decode() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())]
    parts = [" ".join(words[k:k + size]) for k in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    counts = Counter()
    for p in parts:
        h = xxh64_intdigest(p.encode(), 42)
        counts.update(k for k in range(64) if h >> k & 1)
    return sum(1 << k for k in range(64) if 2 * counts[k] > len(parts))


def brute_classes(prints, bits):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    every = list(root)
    for i, a in enumerate(every):
        for b in every[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    return {p: find(p) for p in every}


def brute_components(table, bits=2):
    prints = [(i, brute_print(t)) for i, t in table]
    classes = brute_classes([p for _, p in prints], bits)
    first = {}
    for i, p in prints:
        if i is not None:
            first[classes[p]] = min(i, first.get(classes[p], i))
    return sorted(((i, f"{p:016x}", first.get(classes[p])) for i, p in prints), key=str)


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(300, 340)] + [(500, 501), (501, 502), (502, 500), (9, 9)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(80)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if sum(x == r for x in root.values()) > 1}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("cell", [256, 1])
@pytest.mark.parametrize("bits", [1, 2, 3])
def test_links_lose_nothing(spark, cell, bits):
    """Random fingerprints with dense neighbourhoods; cell 1 sends every met cell to the finer pivots."""
    rng = random.Random(bits)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for p in list(prints)[:12]:
        for _ in range(10):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6))))
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    found = simhash.links(spark.createDataFrame([(signed(p),) for p in prints], "fp long"), bits, cell).collect()
    mask = (1 << 64) - 1
    assert all(((r.a ^ r.b) & mask).bit_count() <= bits for r in found)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in found:
        root[find(r.a & mask)] = find(r.b & mask)
    want = brute_classes(prints, bits)
    groups = lambda f: sorted(sorted(p for p in prints if f(p) == r) for r in {f(p) for p in prints})
    assert groups(find) == groups(want.get)


def test_op8_equals_brute_force(spark):
    got = sorted((tuple(r) for r in QUERIES["op8_simhash_near_duplicates"](spark, SF).select("doc_id", "fingerprint", "component_id").collect()), key=str)
    assert got == brute_components([(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])


def test_simhash_of_awkward_rows(spark):
    found = simhash.near_duplicates(documents(spark))
    got = sorted((tuple(r) for r in found.select("doc_id", simhash.hex_print(F.col("fp")), "component_id").collect()), key=str)
    assert got == brute_components([(i, t) for i, t, _ in TEXTS])
    assert simhash.near_duplicates(empty(spark)).collect() == []
    kept = simhash.keep_one(documents(spark))
    assert kept.columns == SCHEMA.names
    # 2, 3, 4 and the null row share the fingerprint of no words; 5 is there twice.
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 5, None, 6, 7, 8], key=str)


def test_blocks_of_a_long_text_give_the_same_print(monkeypatch):
    text = " ".join(f"w{k % 89}" for k in range(5000)).encode()
    whole = simhash.fingerprint(text, 3)
    monkeypatch.setattr(simhash, "BLOCK", 1000)
    assert simhash.fingerprint(text, 3) == whole == brute_print(text.decode())


def shingles(text, size=5):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub(r"[À-ÖØ-Þ]", lambda m: m[0].lower(), (text or "").translate({k: k + 32 for k in range(65, 91)})))
    return {tuple(words[k:k + size]) for k in range(len(words) - size + 1)}


def brute_contained(docs, items):
    out = []
    items = [(j, shingles(t)) for j, t in items]
    for i, t in docs:
        have = shingles(t)
        out += [(i, j, len(s & have), len(s)) for j, s in items if s and 5 * len(s & have) >= 4 * len(s)]
    return sorted(set(out), key=str)


def test_op3_equals_brute_force(spark):
    got = QUERIES["op3_benchmark_containment"](spark, SF).select("doc_id", "item_id", "n_shared", "n_shingles").collect()
    read = lambda name, key: [(r[key], r.text) for r in spark.read.parquet(f"{SF}/{name}.parquet").collect()]
    assert sorted((tuple(r) for r in got), key=str) == brute_contained(read("documents", "doc_id"), read("benchmark", "item_id"))


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_containment_at_the_bound(spark, monkeypatch, broadcast):
    """Items with pieces missing or scattered, right at, above and below four fifths; both joins."""
    monkeypatch.setattr(contamination, "BROADCAST_ROWS", broadcast)
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([3, 5, 6, 9, 14, 40, 70])))) for k in range(25)] + [(90, None), (None, "a b c d e f g"), (91, "Same, SAME same; same same same")]
    texts = list(TEXTS)
    for n in range(80):
        mine = (rng.choice(items)[1] or "").split()
        cut = rng.randrange(0, max(1, len(mine) // 3) + 1)
        at = rng.randrange(0, len(mine) + 1)
        mine = mine[cut:at] + rng.choices(words, k=rng.choice([0, 0, 1, 9])) + mine[max(at, cut):]
        texts.append((100 + n, " ".join([*rng.choices(words, k=9), *mine, *rng.choices(words, k=9)]).upper(), "en"))
    texts.append((999, "x a b c d e f g. same same same same same", "en"))
    docs, table = documents(spark, texts), spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, fp string")
    got = contamination.contaminated(docs, table).select("doc_id", "item_id", "n_shared", "n_shingles").collect()
    want = brute_contained([(i, t) for i, t, _ in texts], items)
    assert len(want) > 20 and sorted((tuple(r) for r in got), key=str) == want
    gone = {i for i, *_ in want}
    clean = contamination.decontaminate(docs, table)
    assert clean.columns == SCHEMA.names
    assert sorted(map(str, clean.collect())) == sorted(map(str, spark.createDataFrame(rows([t for t in texts if t[0] not in gone]), SCHEMA).collect()))
    assert contamination.contaminated(empty(spark), table).collect() == []
    assert contamination.decontaminate(docs, table.limit(0)).count() == len(texts)
