"""The pipeline, stage by stage against plain versions of what each must do, and the registered SQL."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm import op3_bpe, op8_toxicity
from llm.queries import ORACLES, QUERIES
from test_text_operators import plain_contamination, plain_fingerprint, plain_groups, similar_lines, without

SMALL = "/root/testdata/sf0.001"


def test_names():
    assert sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) == [
        "op1_html", "op2_lines", "op3_bpe", "op4_hmm", "op5_decontaminate",
        "op6_simhash", "op7_language", "op8_toxicity", "op9_embeddings", "op10_substrings",
        "op11_search", "op12_mix", "op13_collocations",
    ]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    base = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = base.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SMALL)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r)) for r in got.select(*columns).collect())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows = docs.collect()
        now = {r.doc_id: r.text for r in rows}
        assert len(now) == len(rows)
        if name == "toxicity":
            labels = spark.read.parquet(f"{SMALL}/labels.parquet")
            scores = op8_toxicity.score(spark.read.parquet(f"{SMALL}/documents.parquet"), labels)
            assert set(now) == {r.doc_id for r in scores.where(F.col("predicted") == 0).collect()}
            assert all(now[d] == texts[d] for d in now)
        elif name == "line dedup":
            gone = similar_lines(sorted(texts.items()))
            assert now == {d: without(t, d, gone) for d, t in texts.items()}
        elif name == "SimHash near-dedup":
            groups = plain_groups([(d, plain_fingerprint(t)) for d, t in texts.items()])
            assert set(now) == {d for d, g in groups if d == g}
            assert all(now[d] == texts[d] for d in now)
        elif name == "benchmark decontamination":
            assert set(now) == set(texts)
            for d, t in texts.items():
                assert now[d] == t if not plain_contamination(t, bench)[1] else len(now[d]) < len(t)
        else:
            library = pytest.importorskip("tokenizers").Tokenizer.from_file(op3_bpe.default_vocabulary())
            for r in rows:
                ids = library.encode(r.text, add_special_tokens=False).ids
                assert r.token_ids == ids and r.n_tokens == len(ids)
                assert r.decoded == library.decode(ids, skip_special_tokens=False)
        if k < 4:
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in rows)
        texts = now
    assert sorted(texts) == sorted(r.doc_id for r in corpus_pipeline.run(spark, SMALL).select("doc_id").collect())


def test_stages_take_odd_documents(spark):
    from test_text_operators import ODD

    rows = [(i, t, "en", "s", len(t or "")) for i, t in ODD]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        n = docs.count()
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SMALL)
            assert out.count() <= n and (k == 4 or out.columns == docs.columns)
