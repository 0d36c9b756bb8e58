"""The pipeline on odd rows, stage by stage, and the registered corpus queries against their SQL."""

import os

import pytest

import corpus_pipeline as pipeline
from boxlake.llm import queries
from boxlake.llm.common import freeze

SF = "/root/testdata/sf0.001"


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "sentencepiece"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("corpus"))
    words = "the ering tion hand eath onal ress"
    text = " ".join(f"{a}{b}" for a in words.split() for b in words.split())
    item = " ".join(f"{b}{a}{b}" for a in words.split() for b in words.split()[:3])
    rows = [(i, f"{text} {chr(97 + i)}ing the end of {i}th" + " tion" * i, "en", "s", 1, "x", i) for i in range(8)]
    rows += [(20, rows[0][1].upper(), "en", None, None, None, None), (21, rows[1][1], None, "s", 1, "x", 1), (21, rows[1][1], None, "s", 1, "x", 1)]
    rows += [(30, None, "en", "s", 0, "x", 1), (31, "", "en", "s", 0, "x", 1), (32, "1234 !!", "en", "s", 0, "x", 1), (None, "the ering hand eath", None, None, None, None, None)]
    rows += [(40, f"the hand {item} ering", "en", "s", 1, "x", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string, `print` int"
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def test_run_on_odd_rows(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in pipeline.STAGES:
        docs = freeze(stage(spark, docs, corpus), "test-stage")
        kept[name] = sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect())
        if name != "sentencepiece":
            assert docs.columns == columns
    ids = {name: [i for none, i in rows if not none] for name, rows in kept.items()}
    assert ids["language_id"] == [0, 1, 2, 3, 4, 5, 6, 7, 20, 21, 21, 40]
    assert ids["exact_dedup"] == [2, 3, 4, 5, 6, 7, 20, 21, 40]
    assert 40 in ids["near_dedup"] and set(ids["decontamination"]) == set(ids["near_dedup"]) - {40}
    result = pipeline.run(spark, corpus)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{corpus}/documents.parquet").collect()}
    assert all(r.decoded == texts[r.doc_id] and r.n_ids == len(r.ids) for r in result.collect())


def test_empty_tables(spark, corpus, tmp_path):
    base = str(tmp_path)
    for table in ("documents", "benchmark"):
        spark.read.parquet(f"{corpus}/{table}.parquet").limit(0).write.parquet(f"{base}/{table}.parquet")
    assert pipeline.run(spark, base).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_native_operators_run_no_python(spark):
    for name in ("op6_benchmark_decontamination", "op10_license_scan"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
