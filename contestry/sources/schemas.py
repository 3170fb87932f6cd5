"""CSV schemas of contest results and contest statistics."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"int": T.IntegerType(), "long": T.LongType(), "string": T.StringType(), "double": T.DoubleType()}


def _schema(fields: str) -> T.StructType:
    pairs = (line.rsplit(" ", 1) for line in fields.strip().splitlines())
    return T.StructType([T.StructField(name.strip(), _TYPES[kind]) for name, kind in pairs])


# Columns of a results file; Date is text until the silver stage.
# MatchId is 64 bit, since a CSV value too large for its type is read as null.
RESULTS_CORE = _schema("""
MatchId long
HomeTeam string
AwayTeam string
Season string
Round string
HomeScore int
AwayScore int
""")

RESULTS = T.StructType(
    [*RESULTS_CORE.fields, T.StructField("Date", T.StringType()), T.StructField("Competition", T.StringType())]
)

# The measures of a statistics file, each once for the home and once
# for the away side; {} stands for the side.
_MEASURES_BEFORE_ZONES = _schema("""
{}22mEntries int
{}22mConversions double
{}LineBreaks int
{}Carries int
{}Kicks int
{}PostContactMetres int
{}DominateTackles int
{}TacklesMade int
{}TacklesMissed int
{}TurnoversWon int
{}Offloads int
{}0-3sRuckSpeed double
{}3-6sRuckSpeed double
{}6s+RuckSpeed double
{}RucksWon int
{}PenaltyGoals int
{}Tries int
{}Conversions int
{}DropGoals int
{}TurnoversLost int
""")

# Pitch-zone shares, which do not alternate between the sides.
_ZONES = _schema("""
TerritoryHomeTry-Line-22m double
TerritoryHome22m-50m double
TerritoryAway22m-50m double
TerritoryAwayTry-Line-22m double
HomeTerritory double
AwayTerritory double
HomePossessionsTryLine-22m double
HomePossession22m-50m double
HomePossessionOpp50m-22m double
HomePossessionOpp22m-TryLine double
AwayPossessionsTryLine-22m double
AwayPossession22m-50m double
AwayPossessionOpp50m-22m double
AwayPossessionOpp22m-TryLine double
""")

# Measures after the zones, again once per side.
_MEASURES_AFTER_ZONES = _schema("""
{}PossessionLast10 double
{}Possession double
{}Scrums int
{}ScrumWins% double
{}Lineouts int
{}LineoutWin% double
{}RestartsReceived int
{}RestartsReceivedWin% double
{}Passes int
{}PenaltiesConceded int
{}YellowCards int
{}RedCards int
{}TacklesCompletion double
{}MetresGained int
{}DefendersBeaten int
{}MaulWins int
""")


def _both_sides(measures: T.StructType) -> list[T.StructField]:
    return [
        T.StructField(field.name.format(side), field.dataType)
        for field in measures.fields
        for side in ("Home", "Away")
    ]


STATISTICS = T.StructType(
    RESULTS_CORE.fields
    + _both_sides(_MEASURES_BEFORE_ZONES)
    + _ZONES.fields
    + _both_sides(_MEASURES_AFTER_ZONES)
)
