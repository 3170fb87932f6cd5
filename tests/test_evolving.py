"""Streams whose columns and types follow the files; merged appends; dedupe."""

import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from contestry.sources import tables
from contestry.streaming import evolving

HEADER = "MatchId,HomeTeam,AwayTeam,Season,Round,HomeScore,AwayScore,Date,Competition"
A = ["1,Bath Rugby,sale,15/16,1,10,9,01/09/2015,x", "2,wasps,bath,15/16,2,7,7,08/09/2015,x", "3,bath,,15/16,2,1,2,08/09/2015,x"]
B = ["4,sale,wasps,16/17,1,20,3,01/09/2016,x,1200,2016-08-30", "5,bath,sale,15/16,3,0,5,15/09/2015,x,,"]
C = ["6,wasps,sale,16/17,2,5,6,08/09/2016,x,0.5,2016-09-02"]
D = ["7,bath,wasps,16/17,3,5,6,15/09/2016,x,sold out,soon"]


def write(folder, name, header, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join([header, *lines]) + "\n")


def test_types_widen():
    assert [evolving.wider(*p) for p in (("int", "bigint"), ("double", "int"), ("int", "date"), (None, "date"), ("date", "date"), ("string", "int"))] == [
        "bigint", "double", "string", "date", "date", "string"
    ]


def test_types_of_values(spark):
    df = spark.createDataFrame(
        [("1", "5000000000", "1.5", "2015-01-02", "1", None, "2015"), ("-2", "7", "2", "2016-02-29", "x", None, None), (None,) * 7],
        "a string, b string, c string, d string, e string, f string, g string",
    )
    assert list(evolving.value_types(df).values()) == ["int", "bigint", "double", "date", "string", None, "int"]
    assert evolving.value_types(spark.createDataFrame([("2015-02-30",)], "a string")) == {"a": "string"}


def test_columns_and_types_reach_silver_and_gold(spark, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    wide = HEADER + ",Crowd,Announced"
    write(landing, "a.csv", HEADER, A)
    assert evolving.run_ingest(spark, landing, target) == 1
    gold = f"{target}/gold/season_records"
    first = rows(spark.read.parquet(gold), "Team", "played", "won", "drawn")
    assert first == [("bath", 2, 1, 1), ("sale", 1, 0, 0), ("wasps", 1, 0, 1)]
    write(landing, "b.csv", wide, B)
    evolving.run_ingest(spark, landing, target)
    assert dict(evolving.read_bronze(spark, f"{target}/bronze").dtypes) | {"Crowd": "int", "Announced": "date"} == dict(evolving.read_bronze(spark, f"{target}/bronze").dtypes)
    write(landing, "c.csv", wide, C)
    # silver starts in the version before and stops at the batch that needs the next one
    evolving.store_drops(spark, landing, f"{target}/bronze", f"{target}/_checkpoints/bronze").awaitTermination()
    assert evolving.run_silver(spark, target, version=2) == 2
    silver = evolving.read_silver(spark, target)
    assert dict(silver.dtypes)["Crowd"] == "double" and dict(silver.dtypes)["Announced"] == "date"
    assert rows(silver, "MatchId", "Crowd", "Announced") == [
        (1, None, None), (2, None, None), (4, 1200.0, dt.date(2016, 8, 30)), (5, None, None), (6, 0.5, dt.date(2016, 9, 2)),
    ]
    expected = rows(evolving.season_records(silver))
    assert rows(spark.read.parquet(gold).select(evolving.season_records(silver).columns)) == expected
    history = evolving.read_rule_history(spark, target)
    assert rows(history.filter("rule = 'valid_away_team'"), "passed", "failed") == [(1, 0), (2, 0), (2, 1)]
    assert rows(evolving.schema_history(spark, f"{target}/bronze").filter("name = 'Crowd'"), "version", "type") == [(2, "int"), (3, "double")]
    # texts turn both columns into strings, and nothing stored is lost
    write(landing, "d.csv", wide, D)
    evolving.run_ingest(spark, landing, target)
    bronze = evolving.read_bronze(spark, f"{target}/bronze")
    assert rows(bronze.filter("Crowd IS NOT NULL"), "Crowd", "Announced") == [("0.5", "2016-09-02"), ("1200", "2016-08-30"), ("sold out", "soon")]
    assert evolving.read_silver(spark, target).count() == 6


def test_a_batch_that_failed_is_taken_once(spark, tmp_path, monkeypatch):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    write(landing, "a.csv", HEADER, A)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(evolving, "_refresh_gold", broken)
        with pytest.raises(Exception, match="lost"):
            evolving.run_ingest(spark, landing, target)
    assert evolving.run_ingest(spark, landing, target) == 1
    assert evolving.read_silver(spark, target).count() == 2
    assert evolving.read_rule_history(spark, target).count() == len(evolving.RESULT_RULES)
    assert rows(spark.read.parquet(f"{target}/gold/season_records"), "Team", "played") == [("bath", 2), ("sale", 1), ("wasps", 1)]


def test_append_adds_columns(spark):
    tables.save_table(spark.createDataFrame([(1, "a")], "id int, name string"), "merged")
    tables.append_merged(spark.createDataFrame([(2, 1.5)], "ID int, score double"), "merged")
    stored = tables.append_merged(spark.createDataFrame([("c",)], "name string"), "merged")
    assert stored.columns == ["id", "name", "score"]
    assert rows(stored) == sorted([(1, "a", None), (2, None, 1.5), (None, "c", None)], key=repr)
    spark.sql("DROP TABLE merged")


def test_the_same_contest_in_two_drops_is_kept_once(spark, tmp_path):
    """Until its key is forgotten, past the watermark."""
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "Home string, Away string, seen timestamp"

    def drop(*lines):
        data = [(h, a, dt.datetime(2020, 1, d)) for h, a, d in lines]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        once = evolving.deduplicated_stream(stream, ["Home", "Away"], "seen", "3 days")
        query = once.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        query.awaitTermination()
        return rows(spark.read.schema(schema).parquet(out), "Home", F.dayofmonth("seen"))

    assert drop(("a", "b", 1), ("a", "b", 1)) == [("a", 1)]
    assert drop(("a", "b", 2), ("c", "d", 2)) == [("a", 1), ("c", 2)]
    assert drop(("e", "f", 10)) == [("a", 1), ("c", 2), ("e", 10)]
    assert drop(("a", "b", 11)) == [("a", 1), ("a", 11), ("c", 2), ("e", 10)]


def test_a_text_is_only_cast_if_it_looks_like_a_value(spark):
    """Failed casts throw inside Spark; the look of a text changes nothing in what fits."""
    texts = [
        "1.5", "1.", ".5", " 7 ", "\x7f8\x01", "+3", "-4", "1e5", "1e", "NaN", "+NaN", "inf", "-Infinity", "0x1p3", "1d", "2F",
        "1997-01-02", " 1997-01-02\n", "1997-1-2", "12-05-1997", "", ".", "5\n", "9999999999", "9" * 30, "india", "2001-02-30", "d", "5L", "1,5", None,
    ]
    value = F.col("v")
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for kind in (*evolving.NUMBERS, "date"):
        fits = evolving._fits(value, kind)
        plain = value.try_cast(kind).isNotNull()
        if kind == "date":
            plain = F.coalesce(plain & value.rlike(r"^\s*\d{4}-\d{2}-\d{2}\s*$"), F.lit(False))
        assert df.filter(fits != plain).collect() == [] and df.filter(fits).count() > 0
        text = str(fits).lower()
        assert text.index("rlike") < text.index("cast")


def test_value_checks_do_not_grow_with_the_columns(spark):
    names = [f"c{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(str(i) for i in range(40)), ("x", *[None] * 39)], ", ".join(f"{c} string" for c in names))
    assert evolving.value_types(df) == {"c0": "string", **dict.fromkeys(names[1:], "int")}
    assert evolving.value_types(df.limit(0)) == dict.fromkeys(names)
