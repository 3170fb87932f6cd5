"""Contest feeds derived from the test tables, one row per order with lines.

An order is a contest: the customer's nation is at home, the opponent is another
nation of its region picked by the suppliers, and the scores come from the odd
and even lines. Every order takes part; one without lines has no opponent and no
scores. The raw feed has the flaws of
hand-kept files, each tied to a property of the order (see ``raw_feed``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contestry.functions.names import TEAM_ALIASES
from contestry.sources.schemas import STATISTICS

AS_OF = dt.date(2001, 3, 15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.col("l_linenumber") % 2 == 1
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n_lines"),
            F.max("l_linenumber").alias("top_line"),
            F.sum("l_suppkey").alias("supp"),
            F.sum(F.when(odd, F.col("l_quantity"))).alias("odd_qty"),
            F.sum(F.when(~odd, F.col("l_quantity"))).alias("even_qty"),
        )
    )


def _orders(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    return (
        table(spark, sf_dir, "orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("day", F.col("o_orderdate").cast("date"))
    )


def _spelt(name: Column) -> Column:
    """Five ways to write a team name, by order priority."""
    by = F.col("o_orderpriority")
    return (
        F.when(by == "1-URGENT", name)
        .when(by == "2-HIGH", F.concat(F.lit("  "), name, F.lit(" ")))
        .when(by == "3-MEDIUM", F.concat(name, F.lit(" rugby")))
        .when(by == "4-NOT SPECIFIED", F.concat(F.lower(name), F.lit(" rugby club")))
        .otherwise(F.lower(name))
    )


def _competition() -> Column:
    """A region's league, and one competition that all regions enter."""
    region = F.col("home_region")
    return (
        F.when(F.col("c_mktsegment") == "MACHINERY", "RBS 6 Nations")
        .when(
            region == 0,
            F.when(F.year("day") >= 1998, "Gallagher Premiership").otherwise("Aviva Premiership"),
        )
        .when(region == 1, " Championship")
        .when(region == 2, "URC")
        .when(region == 3, "Pro-14 ")
        .otherwise("RBS 6 Nations")
    )


def _date_text() -> Column:
    day, weekday = F.col("day"), F.weekday("day")
    return (
        F.when((F.col("n_lines") == 7) & (F.col("o_orderstatus") == "P"), None)
        .when(F.dayofmonth(day) == 31, F.date_format(day, "yyyy-MM-dd"))
        .when(weekday.isin(0, 6), F.date_format(day, "dd-MM-yyyy"))
        .when(weekday == 1, F.date_format(day, "MM-dd-yyyy"))
        .when(weekday == 3, F.date_format(day, "MM/dd/yyyy"))
        .otherwise(F.date_format(day, "dd/MM/yyyy"))
    )


def _round() -> Column:
    month = F.month("day")
    return (
        F.when(F.col("n_lines") == 8, "X")
        # one league plays no fourth round, so the round after the third isn't number + 1
        .when((month == 4) & (F.col("home_region") == 3) & (F.col("c_mktsegment") != "MACHINERY"), "5")
        .when(month == 10, "QF")
        .when(month == 11, "SF")
        .when(month == 12, "F")
        .otherwise(month.cast("string"))
    )


def _score(quantity: str) -> Column:
    return F.when(F.col("day") < F.lit(AS_OF), F.col(quantity).cast("int") % 60)


def _copies(df: DataFrame) -> DataFrame:
    """Orders with more lines than their highest line number come in twice."""
    times = F.when(F.col("n_lines") > F.col("top_line"), 2).otherwise(1)
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contests as they arrive, flaws included.

    Teams are spelt in five ways; the opponent is the home team itself for
    customers in debt, and missing for ten or more lines; the season is missing
    for nine lines, the round unknown ("X") for eight; scores are missing without
    odd or even lines, and negative at home for cheap orders; dates come in four
    formats, two of them ambiguous, in an unreadable one on the 31st, or not at
    all; some rows come twice. From ``AS_OF`` on contests have no scores yet.
    """
    nation = table(spark, sf_dir, "nation")
    home = nation.select(
        F.col("n_nationkey").alias("home_key"),
        F.col("n_name").alias("home_name"),
        F.col("n_regionkey").alias("home_region"),
    )
    away = nation.select(F.col("n_nationkey").alias("away_key"), F.col("n_name").alias("away_name"))
    # nations of one region are five keys apart; a step of 0 is the home nation itself
    step = F.when(F.col("c_acctbal") < 0, 0).otherwise(1 + F.col("supp") % 4)
    df = (
        _orders(spark, sf_dir, _line_totals(spark, sf_dir))
        .withColumn("home_key", F.col("c_nationkey"))
        .withColumn("away_key", ((F.col("c_nationkey") + 5 * step) % 25).cast("int"))
        .join(home, "home_key")
        .join(away, "away_key", "left")
    )
    n_lines = F.coalesce("n_lines", F.lit(0))
    return _copies(df).select(
        F.col("o_orderkey").alias("MatchId"),
        _spelt(F.col("home_name")).alias("HomeTeam"),
        F.when(n_lines < 10, _spelt(F.col("away_name"))).alias("AwayTeam"),
        F.when(n_lines != 9, F.year("day").cast("string")).alias("Season"),
        _round().alias("Round"),
        F.when(F.col("o_totalprice") < 10000, -_score("odd_qty"))
        .otherwise(_score("odd_qty"))
        .alias("HomeScore"),
        _score("even_qty").alias("AwayScore"),
        _date_text().alias("Date"),
        _competition().alias("Competition"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed with lineage, as if read from one drop per season."""
    return raw_feed(spark, sf_dir).withColumns(
        {
            "_ingest_date": F.current_date(),
            "source_file": F.concat(F.lit("season-"), F.coalesce("Season", F.lit("unknown"))),
        }
    )


def team_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias table for the nations: two longer spellings each."""
    name = F.lower("n_name")
    return table(spark, sf_dir, "nation").select(
        F.explode(F.array(F.concat(name, F.lit(" rugby")), F.concat(name, F.lit(" rugby club")))).alias("alias"),
        name.alias("name"),
    )


def club_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a contest of two club spellings from the alias dictionary."""
    spellings = F.array(*(F.lit(a) for a in TEAM_ALIASES))
    n = len(TEAM_ALIASES)

    def club(key: Column) -> Column:
        spelling = F.element_at(spellings, (key % n + 1).cast("int"))
        return (
            F.when(F.col("o_orderstatus") == "O", F.upper(spelling))
            .when(F.col("o_orderstatus") == "P", F.concat(F.lit(" "), spelling, F.lit("  ")))
            .otherwise(spelling)
        )

    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("MatchId"),
        club(F.col("o_custkey")).alias("HomeTeam"),
        club(F.col("o_orderkey")).alias("AwayTeam"),
    )


def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many teams in one connected group: every order is a contest of two customers."""
    customers = table(spark, sf_dir, "customer").agg(F.count("*").alias("n"))
    n = customers.first()["n"]
    home = F.col("o_custkey") % n
    odd = F.col("o_orderstatus")
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.col("o_orderkey").alias("MatchKey"),
            home.alias("HomeTeamId"),
            ((F.col("o_custkey") + 1 + (F.col("o_orderkey") * 7919) % (n - 1)) % n).alias("AwayTeamId"),
            F.when(odd == "F", "HomeWin").when(odd == "O", "AwayWin").otherwise("Draw").alias("Result"),
            F.col("o_orderdate").cast("date").alias("Date"),
        )
    )


# ---- statistics --------------------------------------------------------------------------

_ZONES = (
    "l_returnflag = 'A'",
    "l_returnflag = 'N'",
    "l_returnflag = 'R' AND l_linestatus = 'F'",
    "l_returnflag = 'R' AND l_linestatus = 'O'",
)


def _statistics_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    qty = F.col("l_quantity")
    odd = F.col("l_linenumber") % 2 == 1
    sums = {
        "qty": F.lit(True), "odd": odd, "even": ~odd, "open": F.col("l_linestatus") == "O",
    }
    for i, zone in enumerate(map(F.expr, _ZONES), start=1):
        sums |= {f"zone{i}": zone, f"odd_zone{i}": odd & zone, f"even_zone{i}": ~odd & zone}
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n_lines"),
            *(F.sum(F.when(when, qty).otherwise(0.0)).alias(name) for name, when in sums.items()),
        )
    )


def statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 93 statistics columns per order, from its lines.

    Shares are parts of the ordered quantity; for partly shipped orders of six
    lines one share is 0.1 too large. The measures no check reads are counts
    derived from the lines.
    """
    def share(part: str, whole: str) -> Column:
        return F.try_divide(F.col(part), F.col(whole))

    excess = F.when((F.col("o_orderstatus") == "P") & (F.col("n_lines") == 6), 0.1).otherwise(0.0)
    values: dict[str, Column] = {
        "MatchId": F.col("o_orderkey"),
        "HomeTeam": F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")),
        "AwayTeam": F.concat(F.lit("segment-"), F.lower("c_mktsegment")),
        "Season": F.year("day").cast("string"),
        "Round": F.month("day").cast("string"),
        "HomeTerritory": share("open", "qty") + excess,
        "AwayTerritory": 1 - share("open", "qty"),
        "HomePossession": share("odd", "qty"),
        "AwayPossession": share("even", "qty") + excess,
        "HomePossessionLast10": share("zone1", "qty"),
        "AwayPossessionLast10": 1 - share("zone1", "qty") - excess,
    }
    zone_columns = {
        "Territory{}": ("HomeTry-Line-22m", "Home22m-50m", "Away22m-50m", "AwayTry-Line-22m"),
        "HomePossession{}": ("sTryLine-22m", "22m-50m", "Opp50m-22m", "Opp22m-TryLine"),
        "AwayPossession{}": ("sTryLine-22m", "22m-50m", "Opp50m-22m", "Opp22m-TryLine"),
    }
    for (pattern, names), (prefix, whole) in zip(
        zone_columns.items(), (("", "qty"), ("odd_", "odd"), ("even_", "even"))
    ):
        for i, name in enumerate(names, start=1):
            part = share(f"{prefix}zone{i}", whole)
            values[pattern.format(name)] = part + excess if i == 1 else part
    for side, half in (("Home", "odd"), ("Away", "even")):
        score = F.col(half).cast("int") % 60
        rest = score % 5
        values |= {
            f"{side}Score": score,
            f"{side}Tries": F.floor(score / 5).cast("int"),
            f"{side}Conversions": F.when(rest == 2, 1).when(rest == 4, 2).otherwise(0),
            f"{side}PenaltyGoals": F.when(rest == 3, 1).otherwise(0),
            f"{side}DropGoals": F.lit(0),
            f"{side}MetresGained": F.col(half).cast("int"),
            f"{side}PostContactMetres": (F.col(f"{half}_zone1") * 2).cast("int"),
            f"{side}0-3sRuckSpeed": share(f"{half}_zone1", half),
            f"{side}3-6sRuckSpeed": share(f"{half}_zone2", half) + excess,
            f"{side}6s+RuckSpeed": 1 - share(f"{half}_zone1", half) - share(f"{half}_zone2", half),
        }
    for i, field in enumerate(STATISTICS.fields):
        if field.name not in values:
            count = F.col("n_lines") + i
            is_int = isinstance(field.dataType, T.IntegerType)
            values[field.name] = count if is_int else F.col("n_lines") / count
    df = _orders(spark, sf_dir, _statistics_lines(spark, sf_dir))
    return df.select(*(values[f.name].cast(f.dataType).alias(f.name) for f in STATISTICS.fields))
