"""The CRF against sums over all label sequences, and by held-out accuracy."""

import itertools
import zlib

import numpy as np
import pytest

from fareflow.llm import crf


def brute_marginals(kinds, codes, sizes, moves):
    """Every label sequence weighed one by one."""
    out, at, count = [], 0, len(moves)
    for size in sizes:
        got = np.zeros((size, count))
        for path in itertools.product(range(count), repeat=size):
            weight = 1.0
            for t, label in enumerate(path):
                weight *= kinds[codes[at + t], label] * (moves[path[t - 1], label] if t else 1.0)
            for t, label in enumerate(path):
                got[t, label] += weight
        out.append(got / got.sum(axis=1, keepdims=True))
        at += size
    return np.concatenate(out)


@pytest.mark.parametrize("block", [1, 2, 3, 32])
def test_forward_backward_in_blocks(monkeypatch, block):
    monkeypatch.setattr(crf, "BLOCK", block)
    rng = np.random.default_rng(block)
    sizes = np.array([1, 5, 2, 7, 3, 6, 1])
    kinds, moves = rng.random((4, 3)) + 0.01, rng.random((3, 3)) + 0.01
    codes = rng.integers(0, 4, sizes.sum())
    got = crf.marginals(kinds, codes, sizes, moves)
    assert np.allclose(got, brute_marginals(kinds, codes, sizes, moves))


def test_long_chain_equals_one_block(monkeypatch):
    rng = np.random.default_rng(0)
    kinds, moves = rng.random((50, 4)) ** 4, rng.random((4, 4)) ** 3
    codes, sizes = rng.integers(0, 50, 5000), np.array([4000, 1000])
    short = crf.marginals(kinds, codes, sizes, moves)
    monkeypatch.setattr(crf, "BLOCK", 5000)
    assert np.allclose(short, crf.marginals(kinds, codes, sizes, moves))


def test_gradient_is_that_of_the_log_likelihood():
    rng = np.random.default_rng(1)
    scores, moves, gold = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3)), rng.integers(0, 3, (2, 4))

    def likelihood(scores, moves):
        total = 0.0
        for s, g in zip(scores, gold):
            def weigh(path):
                return sum(s[t, y] + (moves[path[t - 1], y] if t else 0) for t, y in enumerate(path))
            every = [weigh(p) for p in itertools.product(range(3), repeat=4)]
            total += weigh(g) - np.log(np.exp(every).sum())
        return total

    words, steps = crf._gradient(scores, gold, moves)
    for grad, array in ((words, scores), (steps, moves)):
        for at in np.ndindex(array.shape):
            up, down = array.copy(), array.copy()
            up[at] += 1e-5
            down[at] -= 1e-5
            slope = [likelihood(x, moves) if array is scores else likelihood(scores, x) for x in (up, down)]
            assert abs((slope[0] - slope[1]) / 2e-5 - grad[at]) < 1e-4


def test_held_out_accuracy_and_code_switches(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = crf.judge(docs).collect()
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d in lang if zlib.crc32(str(d).encode()) % 5 == 0}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    model = crf.fit(crf.training_sample(docs))
    texts = {r.lang: crf.words_of(r.text)[:40] for r in docs.where("n_chars > 1000").collect()}
    mixed = texts["de"] + texts["en"]
    shares = dict(zip(model.labels, model.shares([mixed])[0]))
    assert 0.3 < shares["de"] < 0.7 and 0.3 < shares["en"] < 0.7
    assert crf.fit(crf.training_sample(docs)).weights.tolist() == model.weights.tolist()


def test_texts_without_letters_and_odd_rows(spark):
    rows = [(i, f"{'the and of' if i % 2 else 'der die und'} w{i}", "en" if i % 2 else "de", "x") for i in range(60)]
    rows += [(100, None, "en", "x"), (101, "", "de", "x"), (102, "12 34 ² _!", "en", "x"), (None, "the and", "fr", "x"),
             (103, "the " * 50_000, None, "x"), (1, rows[1][1], "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _language string")
    got = crf.judge(docs).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and {r.lang_pred for r in got} == {"de", "en", "und"}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (100, 101, 102))
    assert by[103].lang_pred == "en" and not by[None].held_out
    kept = crf.known_only(docs)
    assert kept.columns == docs.columns and {100, 101, 102} & {r.doc_id for r in kept.collect()} == set()
    assert crf.judge(docs.limit(0)).collect() == []
    blind = crf.judge(docs.where("lang is null"))
    assert [r.lang_pred for r in blind.collect()] == ["und"]


def test_every_label_is_learned(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda k, n: letters[k % 26] * 2 + letters[k // 26] + letters[(k * 7 + n) % 26] + letters[n % 26]
    rows = [(k * 100 + i, " ".join(word(k, (i + j) % 9) for j in range(12)), f"l{k:02d}") for k in range(70) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = crf.fit(crf.training_sample(docs))
    assert len(model.labels) == 70


def test_too_many_labels_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(crf, "MOST_LABELS", 2)
    docs = spark.createDataFrame([(k, "word", f"l{k}") for k in range(20)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="labels"):
        crf.training_sample(docs)


def test_repeated_rows_bring_a_bounded_sample(spark, monkeypatch):
    monkeypatch.setattr(crf, "DOCS_PER_LANGUAGE", 5)
    rows = [(1, f"text {k % 400} of one key", "en") for k in range(2000)] + [(k, "autre texte", "fr") for k in range(2, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = crf.training_sample(docs)
    assert sum(label == "en" for _, label in sample) <= 10 and any(label == "fr" for _, label in sample)


def test_documents_of_three_languages_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang IS NOT NULL AND n_chars > 600")
    parts = [r.text[:400] for r in docs.dropDuplicates(["lang"]).select("text").collect()][:3]
    mixed = spark.createDataFrame([(10**9, " ".join(parts), None, "m", 9)], docs.schema)
    assert len(parts) == 3 and crf.known_only(docs.unionByName(mixed)).where("doc_id = 1000000000").count() == 1
