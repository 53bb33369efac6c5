"""Each stage of the pipeline on its own input, and the whole of it."""

import collections
import re

import pyarrow as pa
import pytest
from cases import documents, frame, table, wide

import corpus_pipeline
from strataflow.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Tables like the given ones with the awkward rows and extra columns."""
    at = str(tmp_path_factory.mktemp("tables"))
    wide(spark, documents(12)).write.parquet(f"{at}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


@pytest.mark.parametrize("source", ["given", "awkward"])
def test_stages(spark, tables, source):
    sf = SF if source == "given" else tables
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "tokenize"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.shared_table(stage(spark, docs, sf), name)
        assert out.columns == columns
        before, after = collections.Counter(map(repr, docs.collect())), collections.Counter(map(repr, out.collect()))
        assert after - before == collections.Counter()
        if name == "exact_dedup":
            norm = collections.Counter(re.sub("[ \t-\r]", "", r.text or "") for r in docs.collect())
            assert sum(after.values()) == len(norm)
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.count() == docs.count() and last.filter("NOT round_trip").count() == 0
    whole = corpus_pipeline.run(spark, sf)
    assert table(whole) == table(last)


def test_empty(spark, tables, tmp_path):
    for t in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{tables}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered(spark):
    import oracle

    assert sorted({q.split("_")[0] for q in QUERIES}) == sorted(f"op{n}" for n in range(1, 14))
    con = oracle.connect(SF)
    for name, sql in SQL.items():
        assert oracle.compare(name, QUERIES[name](spark, SF), con, sql) is None


def test_quality_stage_counts_long_trusted_texts(spark, tmp_path, monkeypatch):
    """The stage's model has the grams of trusted texts of over 20,000 characters too."""
    from strataflow.llm import quality

    rows = [(k, " ".join(f"only{k}x{i}" for i in range(2500 if k < 12 else 5)), "en", "s", 1) for k in range(40)]
    spark.createDataFrame([(k, 1, 0) for k in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    made, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda src, trusted: made.append((fit(src, trusted), {r.id for r in trusted.collect()})) or made[0][0])
    corpus_pipeline.quality(spark, frame(spark, rows), str(tmp_path))
    known, (_, ids) = set(quality.Model(made[0][0]).values.key.tolist()), made[0]
    long = [rows[k][1] for k in ids if k < 12]
    tokens, first = quality.tokens_of(pa.array(long))
    assert long and set((quality.grams(tokens, first, 2)[1] & quality.LOW).tolist()) <= known
