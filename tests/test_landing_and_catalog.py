"""Landing folders whose files are rewritten; streams from and to catalog tables."""

import datetime as dt
import os
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contestry.sources import landing, schemas
from contestry.streaming import catalog

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
LEAGUE = "MatchId,HomeTeam,AwayTeam,Season,Round,HomeScore,AwayScore,Date,Competition"


def write(folder, name, lines, header="id,name", time=None):
    path = os.path.join(str(folder), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join([header, *lines]) + "\n")
    if time:
        os.utime(path, (time, time))


def changes(inventory):
    return sorted((os.path.basename(r.path), r.change, r._run) for r in inventory.collect())


@pytest.fixture
def store(spark, tmp_path):
    drop, target = tmp_path / "drop", str(tmp_path / "store")
    os.makedirs(drop)
    refresh = lambda **options: landing.refresh_landing(spark, str(drop), target, SCHEMA, **options)
    read = lambda: rows(landing.read_landing(spark, target, SCHEMA), "id", "name")
    return drop, target, refresh, read


def test_only_changed_files_are_read(spark, store):
    drop, target, refresh, read = store
    write(drop, "a.csv", ["1,x", "2,y"], time=1000)
    write(drop, "b.csv", ["3,z", "3,z"], time=1000)
    write(drop, "deep/c [1]*.csv", ["4,"], time=1000)
    write(drop, "notes.txt", ["9,no"])
    assert changes(refresh()) == [("a.csv", "new", 1), ("b.csv", "new", 1), ("c [1]*.csv", "new", 1)]
    assert read() == [(1, "x"), (2, "y"), (3, "z"), (3, "z"), (4, None)]

    write(drop, "a.csv", ["1,w"], time=2000)  # rewritten, other size
    write(drop, "b.csv", ["5,q", "6,z"], time=2000)  # rewritten, same size
    os.remove(drop / "deep" / "c [1]*.csv")
    write(drop, "d.csv", [])
    assert changes(refresh(files_per_job=1)) == [
        ("a.csv", "changed", 2), ("b.csv", "changed", 2), ("c [1]*.csv", "gone", None), ("d.csv", "new", 2)
    ]
    assert read() == [(1, "w"), (5, "q"), (6, "z")]

    write(drop, "e.csv", ["7,e"], time=3000)
    write(drop, "deep/c [1]*.csv", ["8,back"], time=3000)
    refresh()
    third = spark.read.parquet(f"{target}/rows/_run=3")
    assert rows(third, "id") == [(7,), (8,)]  # the others were not read again
    assert read() == [(1, "w"), (5, "q"), (6, "z"), (7, "e"), (8, "back")]


def test_nothing_changed_stores_nothing(spark, store):
    drop, target, refresh, read = store
    write(drop, "a.csv", ["1,x"])
    refresh()
    assert changes(refresh()) == [("a.csv", "new", 1)]
    assert landing.last_run(spark, target) == 1 and not os.path.exists(f"{target}/rows/_run=2")


def test_empty_folder_and_emptied_folder(spark, store):
    drop, target, refresh, read = store
    assert landing.inventory(spark, target).isEmpty()
    assert changes(refresh()) == [] and read() == []
    write(drop, "a.csv", ["1,x"])
    refresh()
    os.remove(drop / "a.csv")
    assert changes(refresh()) == [("a.csv", "gone", None)] and read() == []
    assert changes(refresh()) == [("a.csv", "gone", None)]


def test_a_failed_run_is_written_over(spark, store):
    drop, target, refresh, read = store
    write(drop, "a.csv", ["1,x"], time=1000)
    refresh()
    write(drop, "b.csv", ["2,y"], time=1000)
    write(drop, "wrong.csv", ["2,y"], header="name,id", time=1000)
    with pytest.raises(Exception, match="header|Header|CSV"):
        refresh(files_per_job=1)
    assert landing.last_run(spark, target) == 1 and read() == [(1, "x")]
    write(drop, "wrong.csv", ["3,z"], time=2000)
    refresh()
    assert read() == [(1, "x"), (2, "y"), (3, "z")]


def test_compact_keeps_rows_and_reads_no_file_again(spark, store):
    drop, target, refresh, read = store
    for i in range(4):
        write(drop, f"{i}.csv", [f"{i},a"], time=1000)
        refresh()
    write(drop, "1.csv", ["1,b"], time=2000)
    refresh()
    before = read()
    landing.compact(spark, target, SCHEMA)
    assert read() == before == [(0, "a"), (1, "b"), (2, "a"), (3, "a")]
    assert os.listdir(f"{target}/rows") == ["_run=6"]
    write(drop, "2.csv", ["2,c"], time=2000)
    assert [c for c in changes(refresh()) if c[1] != "same"] == [("2.csv", "changed", 7)]
    assert read() == [(0, "a"), (1, "b"), (2, "c"), (3, "a")]


# ---- catalog tables ----------------------------------------------------------------------


@pytest.fixture
def named(spark):
    made = []

    def name(label):
        made.append(f"{label}_{uuid.uuid4().hex}")
        return made[-1]

    yield name
    for table in made:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_tables_from_files_to_silver(spark, tmp_path, named):
    drop, names = tmp_path / "drop", (named("bronze"), named("results"), named("upcoming"))
    run = lambda: catalog.run_ingest(spark, str(drop), schemas.RESULTS, names, str(tmp_path / "checks"), dt.date(2016, 9, 1))
    write(drop, "a.csv", ["1,Bath Rugby,sale,15/16,1,10,9,01/09/2015,x", "2,wasps,bath,15/16,2,,,08/09/2016,x"], LEAGUE)
    bronze, results, upcoming = run()
    assert rows(bronze, "MatchId") == [(1,), (2,)]
    assert rows(results, "MatchId", "HomeTeam") == [(1, "bath")] and rows(upcoming, "MatchId") == [(2,)]
    write(drop, "b.csv", ["3,sale,wasps,15/16,3,1,2,15/09/2015,x"], LEAGUE)
    for _ in range(2):  # a run without new files adds nothing
        bronze, results, upcoming = run()
        assert rows(results, "MatchId") == [(1,), (3,)] and rows(upcoming, "MatchId") == [(2,)]
    partitioned = [c.name for c in spark.catalog.listColumns(names[0]) if c.isPartition]
    assert partitioned == ["_ingest_date"]


def test_merged_days(spark, tmp_path, named):
    source, table, merged = str(tmp_path / "in"), named("streamed"), named("merged")
    schema = "k int, d date"

    def add(*values):
        spark.createDataFrame(list(values), schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        catalog.append_to(stream, table, str(tmp_path / "check"), "d").awaitTermination()
        spark.catalog.refreshTable(table)

    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    add(*((i, one) for i in range(40)), (99, None))
    assert catalog.merge_days(spark, table, merged, "d") == [one, None]
    assert catalog.merge_days(spark, table, merged, "d") == []
    add((40, one), (1, two))
    whole = sorted([(i, one) for i in range(41)] + [(99, None), (1, two)], key=repr)
    assert rows(catalog.read_days(spark, table, merged, "d"), "k", "d") == whole
    assert catalog.merge_days(spark, table, merged, "d") == [one, two]
    assert rows(spark.table(merged), "k", "d") == whole
    assert rows(catalog.read_days(spark, table, merged, "d"), "k", "d") == whole
    files = spark.table(merged).filter(F.col("d") == one).select(F.input_file_name().alias("f")).distinct()
    assert files.count() == 1


def test_days_are_read_without_a_shuffle_by_day(spark, tmp_path, named):
    """All rows of a day in one task: so a join with the open days would read them."""
    table, merged = named("streamed"), named("merged")
    day = dt.date(2024, 1, 1)
    rows_ = [(1, day), (2, day), (3, None)]
    spark.createDataFrame(rows_, "k int, d date").write.partitionBy("d").saveAsTable(table)
    catalog.merge_days(spark, table, merged, "d")
    for more in ([], [(4, None)], [(5, day)]):
        if more:
            spark.createDataFrame(more, "k int, d date").write.mode("append").partitionBy("d").saveAsTable(table)
        rows_ += more
        found = catalog.read_days(spark, table, merged, "d")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
        assert rows(found, "k", "d") == sorted(rows_, key=repr)
