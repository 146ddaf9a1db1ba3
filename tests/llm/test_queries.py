"""Queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from exonlake.llm import jaccard_join, queries


def rows_of(df):
    df = df[sorted(df.columns)]
    whole = lambda v: int(v) if isinstance(v, float) and v.is_integer() else v  # noqa: E731  longs with nulls come as doubles
    return sorted(repr(tuple(map(whole, r))) for r in df.astype(object).where(df.notna(), None).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        db.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    assert rows_of(queries.queries()[name](spark, sf_dir).toPandas()) == rows_of(db.execute(queries.oracle_sql()[name]).df())


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name != "best_fit_packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    order = list(kept.values())
    assert all(b <= a for a, b in zip(order, order[1:], strict=False)) and order[-1] == order[-2] and order[-1]
    first = spark.read.parquet(f"{sf_dir}/documents.parquet").join(spark.createDataFrame([(k,) for k in kept["quality_rules"]], "doc_id long"), "doc_id")
    classes = {r["component_id"] for r in jaccard_join.jaccard_classes(first, 5, 80).collect()}
    assert kept["jaccard_join"] == classes
