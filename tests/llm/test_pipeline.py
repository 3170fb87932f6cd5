"""The pipeline against brute force, stage by stage, on the smallest table and on edge cases."""

import brute
import duckdb
import pytest
from corpus_cases import benchmark, documents, edge, empty, text_rows  # noqa: F401  (fixtures)

import __spark_entry__ as registered
import corpus_pipeline
from contestry.llm import queries, quality_lm
from contestry.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), name))
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "decontamination", "source_mix"]


def test_columns_stay(stages):
    assert all(df.columns == stages[0].columns and df.dtypes == stages[0].dtypes for df in stages)


def test_quality_keeps_what_the_classifier_keeps(stages, spark):
    found = quality_lm.classify(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(stages[1]) == ids(found.filter("kept"))
    assert 0.5 * stages[0].count() < stages[1].count() < stages[0].count()


def test_exact_dedup_keeps_the_largest_id(stages):
    assert ids(stages[2]) == sorted(r[0] for r in brute.exact(rows(stages[1])) if r[3])


def test_near_dedup_keeps_the_smallest_id(stages):
    found = brute.near(rows(stages[2]), k=5)
    assert ids(stages[3]) == sorted(i for i, (_, root) in found.items() if i == root)


def test_decontamination_drops_what_shares_a_window(stages, spark):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert ids(stages[4]) == sorted(i for i, t in rows(stages[3]) if not brute.contaminated(t, bench)[1])


def test_mix_takes_copies_of_what_came_in(stages):
    before = {r.doc_id: r for r in stages[4].collect()}
    copies = stages[5].collect()
    assert all(before[r.doc_id] == r for r in copies)
    want = brute.targets([(r.source, r.text) for r in before.values()])
    taken = dict.fromkeys(want, 0)
    for r in copies:
        taken[r.source] += len(brute.SPACED.findall(r.text or ""))
    total = sum(t for _, t in want.values())
    assert sum(abs(taken[s] - want[s][1]) for s in want) < 0.2 * total


def test_run_is_all_stages(spark, stages):
    again = registered.queries()["pipeline"](spark, SF)
    assert sorted(map(str, rows(again))) == sorted(map(str, rows(stages[-1])))


@pytest.mark.parametrize("docs", ["edge", "empty"])
def test_every_stage_takes_edge_cases(docs, spark, request):
    df = request.getfixturevalue(docs)
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, df, SF), name)
        assert out.columns == df.columns
        assert name == "source_mix" or out.count() <= df.count()


def test_registered():
    names = {n.split("_")[0]: n for n in queries.QUERIES}
    assert set(names) == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(registered.queries())
    assert {names[f"op{i}"] for i in (2, 3, 4, 5, 6, 11, 12, 13)} == set(queries.ORACLE_SQL)
    assert all(registered.oracle_sql()[n] == sql for n, sql in queries.ORACLE_SQL.items())


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sql, name):
    cursor = sql.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    found = queries.QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(cursor.fetchall())
