"""The registered queries: their SQL, the guard of the entry module, and the pipeline against plain versions."""

import subprocess
import sys
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lakerisk.llm import leaks, queries, toxicity
from lakerisk.llm.common import ready
from lakerisk.llm.training import labelled
from tests.compare import assert_same
from tests.conftest import SF_SMALL
from tests.llm.cases import AWKWARD, awkward, empty, groups, kept_lines
from tests.llm.test_leaks import distance_in
from tests.llm.test_packing import check

ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, con, name):
    assert_same(queries.QUERIES[name](spark, SF_SMALL), con, queries.ORACLES[name])


def test_entry_works_without_the_subpackage(tmp_path):
    for name in ("lakerisk", "oracles"):
        (tmp_path / name).mkdir()
        for path in (ROOT / name).rglob("*.py"):
            if "llm" not in path.parts:
                to = tmp_path / path.relative_to(ROOT)
                to.parent.mkdir(parents=True, exist_ok=True)
                to.write_text(path.read_text())
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'gold_fraud_risk' in q and 'pipeline' not in q and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_every_stage_against_a_plain_version(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, texts = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.train(*labelled(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"), "toxic", toxicity.BOUNDS))
    items = [leaks.word_hashes(r["text"].encode()).tolist() for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]

    def clean(text):
        words = leaks.word_hashes(text.encode()).tolist()
        return not any(len(set(p) & set(words)) >= 0.6 * len(set(p)) and distance_in(p, words) <= int(leaks.SHARE * len(p)) for p in items)

    def singles(texts):
        roots, _ = groups(texts)
        return {k: t for k, t in texts.items() if roots[k] == k}

    plain = {
        "toxicity": lambda x: {k: t for k, t in x.items() if model.score([t.encode()])[0] < 0.7},
        "line_dedup": lambda x: {k: v[2] for k, v in kept_lines(x).items()},
        "minhash_near_dedup": singles,
        "benchmark_decontamination": lambda x: {k: t for k, t in x.items() if clean(t)},
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        texts = plain[name](texts)
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == texts
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).toPandas()
    assert set(pieces["doc_id"]) == set(texts)
    check(pieces, texts, tokenizer)


def test_awkward_rows_through_all_stages(spark, tmp_path):
    docs = awkward(spark).withColumns({"_copy": F.lit("kept"), "_aside_0": F.lit("too"), "_score": F.lit(7)})
    extra = [c for c in docs.columns if c not in corpus_pipeline.COLUMNS]
    values = {tuple(r[c] for c in extra) for r in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if number < 4:
            assert [c for c in docs.columns if c not in corpus_pipeline.COLUMNS] == extra
            assert {tuple(r[c] for c in extra) for r in docs.collect()} == values
    # 6 lost all its lines and stays as an empty text; 9 is a near copy of 8
    assert {r["doc_id"] for r in docs.collect()} == {r[0] for r in AWKWARD} - {9}


def test_empty_documents_through_all_stages(spark, tmp_path):
    docs = empty(spark)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0


def test_long_texts_reach_workers_in_bounded_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["bytes"])

    texts = ready(spark).range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 1_000_000).alias("text"))
    assert texts.mapInArrow(sizes, "bytes long").agg(F.max("bytes")).first()[0] < 40_000_000
