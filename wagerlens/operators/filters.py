"""The filters every dashboard page shares."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.operators.skew import salted_join

DATE_COLUMNS = ("detected_at", "transaction_date", "last_transaction")
RISK_COLUMNS = ("risk_level", "risk_classification")
ID_COLUMNS = ("signal_event_id", "transaction_id", "session_id", "affiliate_id", "player_id")


@dataclass(frozen=True)
class Filters:
    """Unset fields do not filter. Dates are inclusive."""

    start: date | None = None
    end: date | None = None
    cities: tuple[str, ...] = ()
    countries: tuple[str, ...] = ()
    devices: tuple[str, ...] = ()
    risks: tuple[str, ...] = ()


def _first_of(df: DataFrame, names: tuple[str, ...]) -> str | None:
    return next((n for n in names if n in df.columns), None)


def between_dates(
    df: DataFrame, column: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    day = F.to_date(column)
    if start is not None:
        df = df.filter(day >= F.lit(start))
    if end is not None:
        df = df.filter(day <= F.lit(end))
    return df


def _of_players(df: DataFrame, chosen: list[DataFrame]) -> DataFrame:
    """Rows of the players that are in every given frame. The players are intersected first, so
    that the rows are joined once."""
    players = chosen[0].select("player_id").distinct()
    for other in chosen[1:]:
        players = players.join(other.select("player_id").distinct(), "player_id", "left_semi")
    return salted_join(
        df,
        players,
        ["player_id"],
        "left_semi",
        spread=[_first_of(df, ID_COLUMNS)],
    )


def apply_filters(
    df: DataFrame,
    filters: Filters,
    players: DataFrame | None = None,
    sessions: DataFrame | None = None,
    affiliates: DataFrame | None = None,
) -> DataFrame:
    """Apply each set filter on the table's own column, or through the player it belongs to."""
    date_column = _first_of(df, DATE_COLUMNS)
    if date_column:
        df = between_dates(df, date_column, filters.start, filters.end)
    risk_column = _first_of(df, RISK_COLUMNS)
    if filters.risks and risk_column:
        df = df.filter(F.col(risk_column).isin(*filters.risks))
    chosen = []
    for values, column, through in (
        (filters.cities, "city", players),
        (filters.countries, "country", affiliates),
        (filters.devices, "device", sessions),
    ):
        if not values:
            continue
        if column in df.columns:
            df = df.filter(F.col(column).isin(*values))
        elif through is not None and "player_id" in df.columns:
            chosen.append(through.filter(F.col(column).isin(*values)))
    return _of_players(df, chosen) if chosen else df


def not_normal(df: DataFrame) -> DataFrame:
    return df.filter(F.col("risk_classification") != "NORMAL")
