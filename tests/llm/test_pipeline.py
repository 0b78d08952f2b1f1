"""The pipeline and the registered queries."""

from collections import Counter

import duckdb

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.conftest import SMALL
from tierhouse.llm import queries


def test_every_number_is_registered_once():
    numbers = Counter(name.split("_")[0] for name in queries.queries())
    assert numbers == {f"op{n}": 1 for n in range(1, 14)}
    assert {*queries.queries(), "pipeline"} <= set(entry.queries())


def test_stages_and_run(spark, table):
    docs = table("documents")
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    assert docs.where("text RLIKE '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+[.][A-Za-z0-9-]+'").isEmpty()
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == [*columns, "copy"]
    assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in docs.collect()}


def test_queries_agree_with_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        got = queries.queries()[name](spark, SMALL)
        names = sorted(got.columns)
        want = con.sql(sql).to_arrow_table().select(names).to_pylist()
        assert Counter(tuple(r[c] for c in names) for r in got.collect()) == Counter(tuple(r[c] for c in names) for r in want)
