import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

from contestry.plans import silver
from contestry.sources import files, literals, schemas, tables
from contestry.streaming import ingest

HEADER = "MatchId,HomeTeam,AwayTeam,Season,Round,HomeScore,AwayScore,Date,Competition"
AS_OF = dt.date(2016, 3, 1)


def write(folder, name, header, *lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join([header, *lines]) + "\n")
    return path


def test_statistics_schema():
    names = schemas.STATISTICS.fieldNames()
    assert len(names) == len(set(names)) == 93
    assert names[7:9] == ["Home22mEntries", "Away22mEntries"] and names[-1] == "AwayMaulWins"
    assert names[47:49] == ["TerritoryHomeTry-Line-22m", "TerritoryHome22m-50m"]
    kinds = [f.dataType for f in schemas.STATISTICS.fields]
    assert kinds.count(T.DoubleType()) == 34


def test_fixed_relations(spark):
    rounds = literals.dim_rounds(spark).collect()
    assert len(rounds) == 33 and [r["RoundId"] for r in rounds] == list(range(1, 34))
    assert tuple(rounds[30]) == ("QF", "Quater Final", 98, "PlayOff", 31)
    assert dict(rows(literals.baselines(spark)))["championship"] == 900.0


def test_csv_with_schema_checks_the_header(spark, tmp_path):
    folder = str(tmp_path)
    write(folder, "a.csv", HEADER, "1,bath,sale,15/16,1,10,9,01/09/2015,Championship")
    write(folder, "b.txt", "not a contest")
    df = files.read_csv(spark, folder, schemas.RESULTS)
    assert df.first()["HomeScore"] == 10 and df.count() == 1
    write(folder, "c.csv", HEADER.replace("HomeScore,AwayScore", "AwayScore,HomeScore"), "2,a,b,15/16,1,1,2,01/09/2015,x")
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.read_csv(spark, folder, schemas.RESULTS).collect()


def test_rewritten_files_are_read_again(spark, tmp_path):
    folder = str(tmp_path)
    write(folder, "a.csv", HEADER, "1,bath,sale,15/16,1,10,9,01/09/2015,x")
    assert files.read_csv(spark, folder, schemas.RESULTS).first()["HomeScore"] == 10
    write(folder, "a.csv", HEADER, "1,bath,sale,15/16,1,12,9,01/09/2015,x", "2,bath,sale,15/16,2,1,9,08/09/2015,x")
    assert rows(files.read_csv(spark, folder, schemas.RESULTS), "HomeScore") == [(1,), (12,)]


def test_drops_are_merged_by_name(spark, tmp_path):
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    write(first, "a.csv", "MatchId,HomeTeam,HomeScore", "1,bath,10")
    write(second, "a.csv", "HomeScore,MatchId,Referee", "7,2,jones")
    df = files.read_csv_drops(spark, [first, second], schemas.RESULTS)
    assert rows(df) == [(1, "bath", 10, None), (2, None, 7, "jones")]
    assert df.schema["HomeScore"].dataType == T.IntegerType()


def test_inference_and_evolution(spark, tmp_path):
    folder = str(tmp_path)
    write(folder, "a.csv", "id,score,name", "1,2.5,x", "2,3,y")
    inferred = files.infer_csv_schema(spark, folder)
    assert [f.dataType.simpleString() for f in inferred] == ["int", "double", "string"]
    assert files.header_columns(spark, folder) == ["id", "score", "name"]
    evolved = files.evolved_schema(inferred, ["name", "extra"])
    assert evolved.fieldNames() == ["id", "score", "name", "extra"]


def test_lineage_columns(spark, tmp_path):
    folder = str(tmp_path / "pro 14")
    write(folder, "a.csv", HEADER, "1,bath,sale,15/16,1,10,9,01/09/2015,")
    df = files.read_csv(spark, folder, schemas.RESULTS)
    located = files.with_file_lineage(files.with_competition(df)).first()
    assert located["Competition"] == "pro 14" and located["source_file"].endswith("/a.csv")
    assert files.with_competition(df, "cup").first()["Competition"] == "cup"
    silver_row = files.with_stage(files.to_silver_lineage(files.with_source_tag(df, "2015")).drop("pipelineStage")).first()
    assert silver_row["sourceFileBronze"] == "2015" and silver_row["pipelineStage"] == "goldTransformation"
    assert silver_row["lastUpload"] >= silver_row["ingestTimestampBronze"]


def test_tables(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    tables.save_table(df, "stored", comment="it's a table", properties={"quality": "silver"})
    tables.append_table(df, "stored")
    assert tables.read_table(spark, "stored").count() == 2
    tables.save_table(df.withColumnRenamed("name", "label"), "stored")  # new schema replaces the old
    assert rows(tables.read_table(spark, "stored")) == [(1, "a")]
    made = tables.create_table_as(spark, "made", "SELECT label, count(*) AS n FROM stored GROUP BY label")
    assert rows(made) == [("a", 1)]


LINES = [
    "1,Bath Rugby,sale,15/16,1,10,9,01/09/2015,Gallagher Premiership",
    "2,wasps rugby,chiefs,15/16,2,,,05/03/2016,Championship",
    "3,sarries,SARACENS,15/16,1,1,2,01/09/2015,x",
    "4,bath,wasps,,1,1,2,01/09/2015,x",
    "5,bath,wasps,15/16,F,3,3,2015-09-01,x",
]


def run(spark, landing, target, schema=schemas.RESULTS):
    return ingest.run_ingest(spark, landing, target, schema, AS_OF)


def test_stream_is_incremental_and_equals_the_batch(spark, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    write(landing, "a.csv", HEADER, *LINES[:2])
    bronze, played, ahead = run(spark, landing, target)
    assert (bronze.count(), played.count(), ahead.count()) == (2, 1, 1)
    write(landing, "b.csv", HEADER, *LINES[2:])
    bronze, played, ahead = run(spark, landing, target)
    assert (bronze.count(), played.count(), ahead.count()) == (5, 2, 1)
    batch = files.with_file_lineage(files.read_csv(spark, landing, schemas.RESULTS))
    assert rows(played.drop("_silver_ingest_timestamp")) == rows(silver.match_results(batch).drop("_silver_ingest_timestamp"))
    assert rows(ahead.drop("_silver_ingest_timestamp")) == rows(silver.upcoming_matches(batch, AS_OF).drop("_silver_ingest_timestamp"))
    # the stream takes new paths only: a rewritten file needs the batch path
    write(landing, "a.csv", HEADER, *LINES[:2], LINES[0])
    assert run(spark, landing, target)[0].count() == 5
    assert files.read_csv(spark, landing, schemas.RESULTS).count() == 6


def test_stream_reads_each_file_by_its_own_header(spark, tmp_path):
    """One folder: a plain file, then one with a column more, one less and another order."""
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    write(landing, "a.csv", HEADER, LINES[0])
    run(spark, landing, target)
    write(landing, "b.csv", "Referee,AwayTeam,HomeTeam,MatchId,AwayScore,HomeScore,Season,Date,Round", "jones,sale,bath,7,3,30,15/16,01/09/2015,2")
    write(landing, "c.csv", HEADER, LINES[4])
    bronze, played, _ = run(spark, landing, target)
    assert rows(bronze, "MatchId", "HomeTeam", "HomeScore", "Competition", "Referee") == rows(
        spark.createDataFrame(
            [(1, "Bath Rugby", 10, "Gallagher Premiership", None), (7, "bath", 30, None, "jones"), (5, "bath", 3, "x", None)],
            "MatchId long, HomeTeam string, HomeScore int, Competition string, Referee string",
        )
    )
    assert rows(played, "MatchId", "Result") == [(1, "HomeWin"), (5, "Draw"), (7, "HomeWin")]
    assert {r[0].rsplit("/", 1)[1] for r in rows(bronze, "source_file")} == {"a.csv", "b.csv", "c.csv"}
    assert run(spark, landing, target)[0].count() == 3


def test_stream_of_an_empty_folder(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    assert [df.count() for df in run(spark, str(landing), str(tmp_path / "target"))] == [0, 0, 0]


def test_plain_stream_stops_at_another_order(spark, tmp_path):
    landing = str(tmp_path / "landing")
    write(landing, "a.csv", "MatchId,AwayTeam,HomeTeam", "1,sale,bath")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("MatchId", "HomeTeam", "AwayTeam")])
    stream = ingest.read_csv_stream(spark, landing, schema)
    with pytest.raises(StreamingQueryException):
        ingest.append_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()


def test_stream_counts_rule_failures(spark, tmp_path):
    landing = str(tmp_path / "landing")
    write(landing, "a.csv", HEADER, *LINES)
    bronze = ingest.bronze_stream(spark, landing, schemas.RESULTS)
    query = ingest.append_stream(ingest.results_stream(bronze), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    seen = [p.observedMetrics["results"] for p in query.recentProgress if "results" in p.observedMetrics][0]
    assert seen.asDict() == {
        "rows": 5, "valid_match_id": 0, "valid_home_team": 0, "valid_away_team": 0, "valid_season": 1,
        "valid_round": 0, "valid_home_team_score": 1, "valid_away_team_score": 1, "valid_scores": 1,
        "different_teams": 1, "valid_date": 1,
    }
