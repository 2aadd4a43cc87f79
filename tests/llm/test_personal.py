"""Base spans against the plain expressions, the graph against a recount, and what it discovers."""

import hashlib
import random
import re
import time
from collections import defaultdict

from fareflow.llm import personal

DOCS = "doc_id long, text string"
PLAIN = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, shown):
    digits = re.sub("[^0-9]", "", shown)
    if kind == 1:
        return all(int(p) <= 255 for p in shown.split("."))
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == 0 or 9 <= len(digits) <= 15


def plain(text):
    return sorted((m.start(), k, m.end()) for k, rx in enumerate(PLAIN) for m in rx.finditer(text) if holds(k, m.group()))


def listed(spans):
    return ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def recount(rows):
    """All spans by the rules, with dictionaries."""
    texts = [personal.spans_of(text) for _, text in rows]
    held, seeds = defaultdict(dict), defaultdict(set)
    for spans in texts:
        for _, _, kind, bits, instance, patterns in spans:
            if kind >= 0:
                seeds[instance].add(kind)
            for p in patterns:
                held[p][instance] = held[p].get(instance, 0) | bits
    scores = {(i, k): 1_000_000 for i, kinds in seeds.items() for k in kinds}
    for _ in range(personal.ROUNDS):
        sure = {}
        for p, instances in held.items():
            for k in range(4):
                brought = sum(scores.get((i, k), 0) for i in instances)
                if sum(k in seeds.get(i, ()) for i in instances) >= personal.MIN_SEEDS:
                    confidence = brought // (len(instances) + 1)
                    if confidence >= personal.MIN_CONFIDENCE:
                        sure[p, k] = confidence
        best = {}
        for p, instances in held.items():
            for i, bits in instances.items():
                for k in range(4):
                    if i not in seeds and (p, k) in sure and bits >> k & 1:
                        best[i] = max(best.get(i, (0, 0)), (sure[p, k], -k))
        scores = {(i, k): 1_000_000 for i, kinds in seeds.items() for k in kinds}
        scores |= {(i, -k): c for i, (c, k) in best.items()}
    out = []
    for (key, _), spans in zip(rows, texts):
        base = [(a, k, b) for a, b, k, *_ in spans if k >= 0]
        more = []
        for a, b, kind, bits, _, patterns in spans:
            rated = [(sure[p, k], -k) for p in patterns for k in range(4) if (p, k) in sure and bits >> k & 1]
            if kind < 0 and rated:
                more.append((a, -max(rated)[1], b))
        counts = [sum(k == kind for _, k, _ in base) for kind in range(4)]
        out.append((key, *counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(sorted(base + more))))
    return sorted(out, key=str)


def found(df):
    names = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_base_spans_are_the_plain_ones():
    rng = random.Random(5)
    parts = ["a", "b.c", "@", ".", "-", "+", " ", "1", "22", "255", "256", "(", ")", "x@y.z", "4111 1111 1111 1111", "\n", "é", "_", "1.2.3.4", "+49"]
    for _ in range(30_000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 14)))
        assert personal.base_spans(text) == plain(text), text


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = found(personal.judge(docs))
    assert got == recount(rows)
    by_key = {k: hashlib.sha256(listed(plain(t)).encode()).hexdigest() for k, t in rows}
    assert {r[0]: r[5] for r in got} == by_key


def contexts():
    rows = [(k, f"please ring me at +49 30 55{k:05d} any time") for k in range(30)]
    rows += [(100 + k, f"my number is +1 (212) 555-{k:04d} thanks a lot") for k in range(9)]
    rows += [(200, "please ring me at 030 5512345 any time"), (201, "chapter 12 5551234 pages of text")]
    rows += [(300 + k, f"write to user{k}@mail.example.org for help") for k in range(12)]
    rows += [(400, "write to root@localhost for help"), (401, "see you @home for tea")]
    return rows


def test_discovers_by_context(spark):
    rows = contexts()
    got = {r[0]: r for r in found(personal.judge(spark.createDataFrame(rows, DOCS)))}
    assert sorted(got.values(), key=str) == recount(rows)
    assert got[200][-1] == "phone:18:29" and got[200][4] == 0
    assert got[400][-1] == "email:9:23" and got[400][1] == 0
    assert got[201][-1] == "" and got[401][-1] == ""


def test_one_kind_for_mixed_contexts(spark):
    """A context that holds seeds of two kinds is confident of neither."""
    rows = [(k, f"look at +49 30 55{k:05d} then go") for k in range(20)]
    rows += [(50 + k, f"look at u{k}@x.org then go") for k in range(20)]
    rows += [(99, "look at 030 5599999 then go")]
    got = {r[0]: r for r in found(personal.judge(spark.createDataFrame(rows, DOCS)))}
    assert got[99][-1] == "" and sorted(got.values(), key=str) == recount(rows)


def test_edges(spark):
    rows = [(None, None), (1, ""), (1, "a@b.co"), (1, "a@b.co"), (None, "+49 30 1234567"), (2, "x " * 500_000 + "a@b.co")]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS KEY", "2 AS spans", "3 AS row", "'t' AS kind")
    assert found(personal.judge(docs)) == recount(rows)
    assert personal.judge(spark.createDataFrame([], DOCS)).collect() == []


def test_long_runs_take_linear_time():
    start = time.time()
    for text in ("a" * 2_000_000, "1" * 2_000_000, "1." * 1_000_000, "@" * 1_000_000, "a@" * 500_000, "+1" * 500_000,
                 ":" * 1_000_000, "a:" * 500_000, "1 " * 1_000_000, "a@b." * 300_000, "(at)" * 200_000, "x" * 500_000 + "@y.z"):
        personal.spans_of(text)
    assert time.time() - start < 60
