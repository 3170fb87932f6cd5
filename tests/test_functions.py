import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from contestry.functions import names, scoring


def test_team_names_are_cleaned_and_folded(spark):
    df = spark.createDataFrame(
        [(" Bath Rugby ", "SARRIES"), ("unknown fc", None), ("exeter-cheifs", "Bears")],
        "HomeTeam string, AwayTeam string",
    )
    expected = [("bath", "saracens"), ("exeter-chiefs", "bristol"), ("unknown fc", None)]
    assert rows(names.normalise_team_names(df)) == expected
    table = spark.createDataFrame(list(names.TEAM_ALIASES.items()), "alias string, name string")
    assert rows(names.normalise_team_names(df, table)) == expected


def test_aliases_replace_whole_values_only(spark):
    df = spark.createDataFrame([("bath rugby ladies",), ("saints",)], "HomeTeam string")
    folded = names.normalise_team_names(df, columns=["HomeTeam"])
    assert rows(folded) == [("bath rugby ladies",), ("northampton",)]


def test_competition_names(spark):
    df = spark.createDataFrame([("Gallagher Premiership ",), ("RBS 6 Nations",), ("URC",)], "Competition string")
    assert rows(names.normalise_competition_names(df)) == [("premiership",), ("six nations",), ("urc",)]
    # compared in its own case the dictionary matches no lower-cased value
    literal = names.normalise_competition_names(df, fold_aliases=False)
    assert rows(literal) == [("gallagher premiership",), ("rbs 6 nations",), ("urc",)]


@pytest.mark.parametrize(
    "text, day",
    [
        ("25-12-2015", dt.date(2015, 12, 25)),
        ("12-25-2015", dt.date(2015, 12, 25)),
        ("25/12/2015", dt.date(2015, 12, 25)),
        ("12/25/2015", dt.date(2015, 12, 25)),
        ("03-04-2016", dt.date(2016, 4, 3)),  # both orders fit; day first wins
        ("31-02-2016", None),
        ("2016-02-01", None),
        ("1/2/2016", None),
        (" 01/02/2016", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, day):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(scoring.parse_date("d")).first()[0] == day
    plain = F.coalesce(*(F.try_to_date("d", f) for f in scoring.DATE_FORMATS))
    assert df.select(plain).first()[0] == day


def test_parse_date_with_formats_of_other_parts(spark):
    df = spark.createDataFrame([("3 Jan 2016",), ("2016.01.03",)], "d string")
    parsed = df.select(scoring.parse_date("d", ["d MMM yyyy", "yyyy.MM.dd"]))
    assert [r[0] for r in parsed.collect()] == [dt.date(2016, 1, 3)] * 2


def test_result_columns(spark):
    df = spark.createDataFrame([(3, 1), (1, 3), (2, 2), (None, 2)], "HomeScore int, AwayScore int")
    out = df.withColumns(scoring.result_columns())
    assert [tuple(r)[2:] for r in out.collect()] == [
        ("HomeWin", 2, -2, 4, 1, 0, 0),
        ("AwayWin", -2, 2, 4, 0, 1, 0),
        ("Draw", 0, 0, 4, 0, 0, 1),
        ("Draw", None, None, None, 0, 0, 1),
    ]
    spaced = df.select(scoring.result_label(spaced=True))
    assert [r[0] for r in spaced.collect()] == ["Home Win", "Away Win", "Draw", "Draw"]


def test_capped_keeps_value_when_limit_is_unknown(spark):
    df = spark.createDataFrame([(5, 3), (2, 3), (5, None), (None, 3)], "v int, l int")
    assert [r[0] for r in df.select(scoring.capped("v", "l")).collect()] == [3, 2, 5, None]


def test_expected_and_actual_score(spark):
    df = spark.createDataFrame([(1500.0, 1500.0, "HOMEWIN"), (1900.0, 1500.0, "Away Win"), (1500.0, 1900.0, "x")], "h double, a double, Result string")
    out = df.select(scoring.expected_score("h", "a"), scoring.actual_score()).collect()
    assert [r[1] for r in out] == [1.0, 0.0, 0.5]
    assert [r[0] for r in out] == pytest.approx([0.5, 10 / 11, 1 / 11])


def test_neutral(spark):
    df = spark.createDataFrame([("F",), ("SF",), (None,)], "Round string")
    assert [r[0] for r in df.select(scoring.is_neutral()).collect()] == [1, 0, 0]
