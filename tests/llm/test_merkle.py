"""The manifest against a plain recount, and its edge cases."""

import hashlib
import zlib
from itertools import groupby

import pytest

from fareflow.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root, and every leaf's groups of siblings as (before, after)."""
    paths, members = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, up_members = [], []
        for k in range(0, len(nodes), 3):
            run = nodes[k : k + 3]
            for j in range(len(run)):
                for leaf in members[k + j]:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(sha("".join(run)))
            up_members.append(sum(members[k : k + 3], []))
        nodes, members = up, up_members
    return nodes[0], paths


def recount(rows):
    first = lambda v: (v is not None, v if v is not None else 0)
    source = lambda r: (r["source"] is not None, (r["source"] or "").encode())
    rows = sorted(rows, key=lambda r: (source(r), first(r["doc_id"]), leaf_of(r, r["text"])))
    groups = [list(g) for _, g in groupby(rows, key=source)]
    trees = [tree([leaf_of(r, r["text"]) for r in g]) for g in groups]
    root, upper = tree([t[0] for t in trees]) if trees else (None, [])
    out = []
    for group, (subroot, paths), above in zip(groups, trees, upper):
        for r, path in zip(group, paths):
            text = r["text"]
            if r["doc_id"] is not None and text is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf_of(r, text)
            for before, after in path + above:
                folded = sha(before + folded + after)
            proof = sha("".join(b + a for b, a in path + above))
            out.append((r["doc_id"], leaf_of(r, r["text"]), subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def found(df):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = found(merkle.manifest(docs))
    assert got == recount([r.asDict() for r in docs.collect()])
    assert {row[-1] for row in got} == {True, False}


@pytest.mark.parametrize("sizes", [(1,), (82, 1, 3), (730,), (729, 731), tuple([1] * 740)])
def test_heights(spark, sizes):
    rows = [(k, f"t\n{k}", None, f"s{s}", k) for s, n in enumerate(sizes) for k in range(s * 10_000, s * 10_000 + n)]
    got = found(merkle.manifest(spark.createDataFrame(rows, DOCS)))
    assert got == recount([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows])


def test_edges(spark):
    rows = [
        (None, "a\nb", None, None, None), (7, None, "en", None, 3), (7, None, "en", None, 3), (7, "", "en", "", 0),
        (8, "x\n" * 400_000, "de", "é", -1), (9, "\n", None, "z", 1), (9, "\n", None, "z", 1), (9, "y", None, "z", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS first", "'q' AS DIGEST", "2 AS block", "3 AS at")
    want = recount([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows])
    assert found(merkle.manifest(docs)) == want


def test_empty(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS)).collect() == []


def test_settings_stay(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.manifest(spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS))
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
