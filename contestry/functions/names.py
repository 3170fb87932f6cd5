"""Name cleaning: case, padding and aliases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contestry.sources.literals import literal

# Spellings of team names and the name each one stands for.
TEAM_ALIASES = {
    "bath rugby": "bath",
    "bath rugby club": "bath",
    "bristol bears": "bristol",
    "bristol rugby club": "bristol",
    "bears": "bristol",
    "chiefs": "exeter-chiefs",
    "exeter-cheifs": "exeter-chiefs",
    "gloucester rugby": "gloucester",
    "gloucester rugby club": "gloucester",
    "cherries": "gloucester",
    "harlequins rugby": "harlequins",
    "harlequins rugby club": "harlequins",
    "leicester tigers": "leicester",
    "leicester tigers rugby club": "leicester",
    "leicester": "leicester",
    "london irish": "london-irish",
    "london irish rugby club": "london-irish",
    "northampton saints": "northampton",
    "northampton saints rugby club": "northampton",
    "northampton": "northampton",
    "saints": "northampton",
    "sale sharks": "sale",
    "sale rugby club": "sale",
    "wasps rugby": "wasps",
    "wasps rugby club": "wasps",
    "saracens rugby": "saracens",
    "saracens rugby club": "saracens",
    "sarries": "saracens",
    "worcester warriors": "worcester",
    "worcester rugby club": "worcester",
    "worcester": "worcester",
    "newcastle falcons": "newcastle",
    "newcastle rugby club": "newcastle",
    "falcons": "newcastle",
    "newcastle red bulls": "newcastle",
    "newcastle red bulls rugby club": "newcastle",
}

# Sponsored competition names and the name each one stands for.
COMPETITION_ALIASES = {
    "Gallagher Premiership": "Premiership",
    "RBS 6 Nations": "Six Nations",
    "Aviva Premiership": "Premiership",
    "Championship": "Championship",
}


def clean_name(name: Column | str) -> Column:
    """Lower case without leading and trailing blanks."""
    return F.trim(F.lower(name))


def replace_names(
    df: DataFrame, columns: Sequence[str], aliases: Mapping[str, str] | DataFrame
) -> DataFrame:
    """Replace whole values by their alias target; other values stay.

    ``aliases`` is a dictionary or a DataFrame with columns ``alias`` (unique) and
    ``name``. Either is left-joined, so a value costs one hash lookup however many
    aliases there are; Spark broadcasts the aliases if their size allows. (A
    dictionary as a CASE expression compares, and cleans, the value once per alias.)
    """
    if not isinstance(aliases, DataFrame):
        aliases = literal(df.sparkSession, "alias string, name string", list(aliases.items()))
    for column in columns:
        lookup = aliases.select(
            F.col("alias").alias(f"_alias_{column}"), F.col("name").alias(f"_name_{column}")
        )
        df = (
            df.join(lookup, F.col(column) == F.col(f"_alias_{column}"), "left")
            .withColumn(column, F.coalesce(f"_name_{column}", column))
            .drop(f"_alias_{column}", f"_name_{column}")
        )
    return df


def normalise_team_names(
    df: DataFrame,
    aliases: Mapping[str, str] | DataFrame = TEAM_ALIASES,
    columns: Sequence[str] = ("HomeTeam", "AwayTeam"),
) -> DataFrame:
    """Clean the team columns and fold aliases."""
    df = df.withColumns({c: clean_name(c) for c in columns})
    return replace_names(df, columns, aliases)


def normalise_competition_names(
    df: DataFrame,
    aliases: Mapping[str, str] | DataFrame = COMPETITION_ALIASES,
    column: str = "Competition",
    fold_aliases: bool = True,
) -> DataFrame:
    """Clean the competition column and fold sponsored names.

    Values are lower-cased first, so the alias dictionary is compared and
    written in lower case too. ``fold_aliases=False`` compares the dictionary
    in its own case instead, which matches nothing once values are lower-case.
    """
    df = df.withColumn(column, clean_name(column))
    if fold_aliases:
        if isinstance(aliases, DataFrame):
            aliases = aliases.select(*(clean_name(c).alias(c) for c in ("alias", "name")))
        else:
            aliases = {a.lower().strip(): n.lower().strip() for a, n in aliases.items()}
    return replace_names(df, [column], aliases)
