"""The pipeline stage by stage: each stage's rows against a plain recount of its input."""

import corpus_pipeline
import pytest
from fareflow.llm import crf, mixing, quality
from tests.llm.test_quality import base
from tests.llm.test_simhash import brute as near
from tests.llm.test_suffixes import brute as leaks


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """Every stage's input and output, as pandas frames."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        out[name] = (docs, after)
        docs = after
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_filters_return_whole_documents(steps):
    first = steps["language_id"][0]
    for name, (before, after) in list(steps.items())[:-1]:
        assert after.dtypes == first.dtypes, name
        assert after.subtract(before).count() == 0, name
        assert 0 < after.count() <= before.count(), name


def test_language_stage(steps):
    before, after = steps["language_id"]
    want = [r.doc_id for r in crf.judge(before).collect() if r.lang_pred != "und" and r.sure >= 0.4]
    assert ids(after) == sorted(want)


def test_quality_stage(spark, sf_dir, steps):
    before, after = steps["quality_rules"]
    judged = {r.doc_id: r for r in quality.judge(before, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    assert ids(after) == sorted(k for k, r in judged.items() if r.kept)
    for key, text in pairs(before):
        assert judged[key].base_failed == base(text)[-1]


def test_near_copies_stage(steps):
    before, after = steps["near_duplicates"]
    assert ids(after) == sorted(int(key) for key, _, component in near(pairs(before)) if key == component)


def test_decontamination_stage(spark, sf_dir, steps):
    before, after = steps["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert ids(after) == sorted(row[0] for row in leaks(pairs(before), items) if not row[-1])


def test_mixing_stage(steps):
    before, after = steps["source_mixing"]
    assert sorted(map(repr, after.select("doc_id", "source", "mix.*").collect())) == sorted(
        map(repr, mixing.judge(before).collect())
    )


def test_run_is_the_stages_in_a_row(spark, sf_dir, steps):
    got = corpus_pipeline.run(spark, sf_dir)
    want = steps["source_mixing"][1]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_stages_on_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_stages_keep_clashing_columns(spark, sf_dir):
    names = ("_LANGUAGE", "_Quality_words", "Mix", "mix_block", "_SIMHASH", "_Suffix_Found", "fingerprint", "part", "key")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.withColumns({name: docs.doc_id for name in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns, name
        assert after.where(" OR ".join(f"NOT ({c} <=> doc_id)" for c in names)).isEmpty(), name
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert set(docs.columns) < set(mixed.columns) and not mixed.isEmpty()
