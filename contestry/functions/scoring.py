"""Column expressions over one contest row."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date formats in the order they are tried; the first hit wins.
DATE_FORMATS = ("dd-MM-yyyy", "MM-dd-yyyy", "dd/MM/yyyy", "MM/dd/yyyy")

HOME_WIN, AWAY_WIN, DRAW = "HomeWin", "AwayWin", "Draw"


# What the parts of a date format look like in a text.
_DATE_PARTS = {"dd": r"(0[1-9]|[12]\d|3[01])", "MM": r"(0[1-9]|1[0-2])", "yyyy": r"\d{4}"}


def _date_shape(date_format: str) -> str | None:
    """Regular expression for texts of a format; None if it has other parts."""
    parts = re.split("(dd|MM|yyyy)", date_format)
    if re.search("[A-Za-z]", "".join(parts[::2])):
        return None
    return "^" + "".join(_DATE_PARTS.get(p, re.escape(p)) for p in parts) + "$"


def parse_date(text: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that parses; null if none does.

    A format is only tried on texts of its shape: a failed try raises an exception
    inside Spark, which costs far more than the look at the shape.
    """
    text = F.col(text) if isinstance(text, str) else text
    tries = []
    for date_format in formats:
        parsed, shape = F.try_to_date(text, date_format), _date_shape(date_format)
        tries.append(F.when(text.rlike(shape), parsed) if shape else parsed)
    return F.coalesce(*tries)


def result_label(home: str = "HomeScore", away: str = "AwayScore", spaced: bool = False) -> Column:
    """HomeWin / AwayWin / Draw (or "Home Win" ... when ``spaced``)."""
    names = ("Home Win", "Away Win") if spaced else (HOME_WIN, AWAY_WIN)
    return (
        F.when(F.col(home) > F.col(away), names[0])
        .when(F.col(home) < F.col(away), names[1])
        .otherwise(DRAW)
    )


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is unknown)."""
    return F.when(condition, 1).otherwise(0)


def result_columns(home: str = "HomeScore", away: str = "AwayScore") -> dict[str, Column]:
    """Result label, one-hot flags, differences and total of a scored contest."""
    label = result_label(home, away)
    gap = (F.col(home) - F.col(away)).cast("int")
    return {
        "Result": label,
        "HomePointsDifference": gap,
        "AwayPointsDifference": -gap,
        "TotalMatchPoints": (F.col(home) + F.col(away)).cast("int"),
        "HomeWinFlag": flag(label == HOME_WIN),
        "AwayWinFlag": flag(label == AWAY_WIN),
        "DrawFlag": flag(label == DRAW),
    }


def is_neutral(round_code: str = "Round") -> Column:
    """Finals are played at a neutral venue."""
    return flag(F.col(round_code) == "F")


def capped(value: str, limit: str) -> Column:
    """``value``, but ``limit`` where it is larger; unlike ``least``, null limits do not win."""
    return F.when(F.col(value) > F.col(limit), F.col(limit)).otherwise(F.col(value))


def expected_score(home: Column | str, away: Column | str, scale: float = 400.0) -> Column:
    """Elo expectation of the home side."""
    home, away = (F.col(c) if isinstance(c, str) else c for c in (home, away))
    return 1 / (1 + F.pow(F.lit(10.0), (away - home) / scale))


def actual_score(result: Column | str = "Result") -> Column:
    """1 for a home win, 0 for an away win, else one half; case and blanks do not matter."""
    label = F.replace(F.lower(result), F.lit(" "), F.lit(""))
    return F.when(label == "homewin", 1.0).when(label == "awaywin", 0.0).otherwise(0.5)
