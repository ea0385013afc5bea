"""The stages on odd rows: each keeps the columns, and its decisions take effect."""

import pytest

import corpus_pipeline
from linkmill.llm import queries


@pytest.fixture(scope="module")
def folder(odd_docs, spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    docs = odd_docs.withColumnRenamed("score", "n_chars").drop("lang_pred")
    docs.write.parquet(f"{d}/documents.parquet")
    long = next(r["text"] for r in odd_docs.collect() if r["doc_id"] == 5).split()
    spark.createDataFrame([(1, " ".join(long[100:130]))], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        rows = docs.collect()
        counts.append(len(rows))
        if k < 4:
            assert docs.columns == columns
            docs = spark.createDataFrame(rows, docs.schema)
        if k == 2:
            assert 5 not in {r["doc_id"] for r in rows}
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2] - 1 and counts[5] == counts[4]
    assert corpus_pipeline.run(spark, folder).count() == counts[-1]


def test_empty_tables(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs.limit(0), str(tmp_path))
        assert out.count() == 0 and (k == 4 or out.columns == docs.columns)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_names():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names[:10]] == [f"op{k}" for k in range(1, 11)] and names[-1] == "pipeline"
    assert corpus_pipeline.ORACLE_SQL is None and set(queries.oracle_sql()) <= set(names)
