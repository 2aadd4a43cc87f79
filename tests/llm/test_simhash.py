"""SimHash components against all pairs compared one by one."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fareflow.llm import simhash
from fareflow.llm.components import connected


def slow_fingerprint(text):
    words = []
    for word in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").split(" "):
        words += [w for w in word.split("\n") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    if not shingles:
        shingles = [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots_of(pairs):
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        label[high] = low
    return {x: root(x) for x in list(label)}


def brute(rows):
    """component_id per row by comparing every two fingerprints."""
    prints = [slow_fingerprint(text) for _, text in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i, len(rows))
             if (prints[i] ^ prints[j]).bit_count() <= 3]
    roots = roots_of(links)
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[roots[i]] = min(key, ids.get(roots[i], key))
    return sorted((repr(key), f"{prints[i]:016x}", repr(ids.get(roots[i]))) for i, (key, _) in enumerate(rows))


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(1, 200))]
        rows.append((1000 - i, " ".join(text)))
        for k in range(rng.randint(0, 3)):
            near = list(text)
            near[rng.randrange(len(near))] = rng.choice(words)
            rows.append((2000 + 10 * i + k, " ".join(near)))
    rows += [(7, None), (8, ""), (9, " \n\t "), (10, "one"), (11, "One two"), (12, "ONE TWO"),
             (13, "Ünï ünï x Äö"), (None, "one two"), (None, None), (10, "one"), (10, "one"),
             (14, "a b c " * 20000)]
    return rows


def test_components_match_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.components(docs.repartition(5)).collect()
    assert sorted((repr(r.doc_id), r.fingerprint, repr(r.component_id)) for r in got) == brute(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.components(docs).collect() == []
    assert simhash.one_of_each(docs).collect() == []


def close_prints(n, seed=3):
    """Fingerprints in a few clouds, so that cells fill up."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)] + [0, 2**64 - 1]
    out = set()
    for _ in range(n):
        x = rng.choice(centres)
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(64)
        out.add(x - 2**64 if x >= 2**63 else x)
    return sorted(out)


@pytest.mark.parametrize("block", [10**6, 8])
def test_grid_links_connect_what_is_close(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "CELL_BLOCK", block)
    prints = close_prints(500)
    u = np.array(prints)
    want = {(a, b) for i, a in enumerate(prints) for b in u[i + 1:][np.bitwise_count((u[i + 1:] ^ a).view(np.uint64)) <= 3].tolist()}
    df = spark.createDataFrame([(x,) for x in prints], "fp long")
    got = {tuple(sorted(r)) for r in simhash.near_pairs(df).collect()}
    assert got <= want and roots_of(got) == roots_of(want)
    if block > 1000:
        assert got == want


def test_components_of_a_long_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(500, 500 + i) for i in range(1, 300)] + [(9, 9)]
    got = connected(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == roots_of(pairs)
    assert len(got) == 341


def test_one_of_each_keeps_columns_and_one_document(spark):
    rows = [(1, "x y z w", 5), (2, "x y z w", 6), (3, "other words here now", 7), (1, "x y z w", 5), (None, "x y z w", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.select(F.coalesce("doc_id", F.lit(-1))).toPandas().iloc[:, 0]) == [-1, 1, 3]


def test_rows_of_one_key_in_different_groups_both_stay(spark):
    one, two = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(5, one, "x"), (5, two, "y"), (5, two, "y"), (7, one, "z"), (None, one, "n"), (9, "c d e", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, FINGERPRINT string")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.where("NOT (doc_id <=> 7)").distinct().collect()))
