"""Players that share one value, such as an address or a device."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.functions.text import list_text
from wagerlens.operators.skew import salted_join

# A list of n players repeated on n rows is n * n ids, so lists stand once per group, whatever its
# size, in pages of about this many players (`player_pages`).
PAGE_PLAYERS = 10_000


def shared_pairs(sessions: DataFrame, key: str) -> DataFrame:
    """One row per (key, player) with first and last time seen.

    A hot key is spread over its players here, and all that follows works on these pairs.
    """
    return (
        sessions.filter(F.col(key).isNotNull())
        .groupBy(key, "player_id")
        .agg(
            F.min("session_timestamp").alias("first_seen"),
            F.max("session_timestamp").alias("last_seen"),
        )
    )


def sharing_groups(pairs: DataFrame, key: str, more_than: int) -> DataFrame:
    """Keys with more than the given number of distinct players."""
    return (
        pairs.groupBy(key)
        .agg(
            F.count("player_id").alias("distinct_players"),
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
        )
        .filter(F.col("distinct_players") > more_than)
    )


def group_members(
    pairs: DataFrame, groups: DataFrame, key: str, min_rows: int | None = None
) -> DataFrame:
    """One row per group and player, with the group's columns."""
    players = pairs.select(key, "player_id").filter(F.col("player_id").isNotNull())
    return salted_join(
        players,
        groups,
        [key],
        weights=(groups, "distinct_players"),
        spread=["player_id"],
        min_rows=min_rows,
    )


def page_of(player: Column | str, pages: Column) -> Column:
    """Page of a player: an even, repeatable spread over the group's pages."""
    head = F.conv(F.substring(F.md5(F.col(player) if isinstance(player, str) else player), 1, 8), 16, 10)
    return F.pmod(head.cast("bigint"), pages).cast("int")


def player_pages(
    members: DataFrame, key: str, page_players: int = PAGE_PLAYERS
) -> DataFrame:
    """The whole lists of all groups, once per group in pages of about equal size."""
    pages = F.ceil(F.col("distinct_players") / F.lit(page_players)).cast("int")
    return (
        members.withColumn("page", page_of("player_id", pages))
        .groupBy(key, "distinct_players", "page")
        .agg(
            F.count(F.lit(1)).alias("page_players"),
            list_text(F.collect_list("player_id")).alias("related_players"),
        )
    )
