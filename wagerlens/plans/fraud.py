"""Fraud signals and the tables next to them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagerlens.functions.text import key_time, money_text, surrogate_key
from wagerlens.functions.times import stamp
from wagerlens.operators.intervals import followed_within
from wagerlens.operators.sharing import (
    PAGE_PLAYERS,
    group_members,
    player_pages,
    shared_pairs,
    sharing_groups,
)
from wagerlens.plans.finance import player_financials
from wagerlens.sources.scratch import WorkTables, kept

# Thresholds and message texts.
IP_PLAYERS_OVER = 1
DEVICE_PLAYERS_OVER = 5
RAPID_MINUTES = 60
IP_TEXT = ("IP compartilhado entre ", " jogadores")
NO_BET_TEXT = ("Depositos totais: $", " sem nenhuma aposta")
DEVICE_TEXT = ("Device ", " usado por ", " jogadores")
RAPID_TEXT = ("Deposito de $", " e saque de $", " em ", " minutos")

SIGNAL_COLUMNS = [
    "player_id",
    "signal_type",
    "signal_description",
    "risk_level",
    "detected_at",
    "related_count",
    "related_group",
    "signal_event_id",
]


def _message(texts: tuple[str, ...], *values: Column | str) -> Column:
    """The texts with a value between each two; a prefix and a suffix for one value."""
    parts = [F.lit(texts[0])]
    for value, text in zip(values, [*texts[1:], ""]):
        parts += [(F.col(value) if isinstance(value, str) else value).cast("string"), F.lit(text)]
    return F.concat(*parts)


def _signal(df: DataFrame, kind: str, risk: str, event: list[str], **cols) -> DataFrame:
    empty = {"related_count": "bigint", "related_group": "string"}
    out = {c: F.lit(None).cast(t) for c, t in empty.items()} | cols
    return df.select(
        "player_id",
        F.lit(kind).alias("signal_type"),
        F.lit(risk).alias("risk_level"),
        surrogate_key([F.lit(kind), "player_id", *event]).alias("signal_event_id"),
        *[c.alias(name) for name, c in out.items()],
    ).select(*SIGNAL_COLUMNS)


def _pairs(sessions: DataFrame, key: str, work: WorkTables | None) -> DataFrame:
    return kept(work, f"{key}_players", shared_pairs(sessions, key))


def ip_sharing(sessions: DataFrame, work: WorkTables | None = None) -> DataFrame:
    """Addresses used by more than one player."""
    return sharing_groups(_pairs(sessions, "ip", work), "ip", IP_PLAYERS_OVER)


def device_sharing(sessions: DataFrame, work: WorkTables | None = None) -> DataFrame:
    """Devices used by more than five players."""
    return sharing_groups(_pairs(sessions, "device", work), "device", DEVICE_PLAYERS_OVER)


def sharing_members(
    sessions: DataFrame,
    key: str,
    more_than: int,
    work: WorkTables | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """Players of each shared value. The pairs are read three times, so they are worth keeping."""
    pairs = _pairs(sessions, key, work)
    return group_members(pairs, sharing_groups(pairs, key, more_than), key, min_rows)


def multi_accounting(
    sessions: DataFrame,
    work: WorkTables | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """One signal per shared address and player on it, dated when the address was first seen."""
    members = sharing_members(sessions, "ip", IP_PLAYERS_OVER, work, min_rows)
    return _signal(
        members,
        "MULTI_ACCOUNTING",
        "HIGH",
        ["ip"],
        signal_description=_message(IP_TEXT, "distinct_players"),
        detected_at=F.col("first_seen"),
        related_count=F.col("distinct_players"),
        related_group=F.col("ip"),
    )


def player_deposits_without_bet(totals: DataFrame) -> DataFrame:
    """Players with deposits who never wagered an amount, from the totals per player."""
    return totals.filter((F.col("total_deposits") > 0) & (F.col("total_bets") == 0)).select(
        "player_id",
        "total_deposits",
        "total_bets",
        "total_withdrawals",
        "deposit_count",
        "bet_count",
    )


def deposit_without_bet(totals: DataFrame, as_of: datetime) -> DataFrame:
    return _signal(
        player_deposits_without_bet(totals),
        "DEPOSIT_WITHOUT_BET",
        "MEDIUM",
        [],
        signal_description=_message(NO_BET_TEXT, money_text("total_deposits")),
        detected_at=stamp(as_of),
    )


def device_signals(
    sessions: DataFrame,
    as_of: datetime,
    work: WorkTables | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """One signal per device over the limit and player on it."""
    members = sharing_members(sessions, "device", DEVICE_PLAYERS_OVER, work, min_rows)
    return _signal(
        members,
        "DEVICE_SHARING",
        "MEDIUM",
        ["device"],
        signal_description=_message(DEVICE_TEXT, "device", "distinct_players"),
        detected_at=stamp(as_of),
        related_count=F.col("distinct_players"),
        related_group=F.col("device"),
    )


def rapid_cycles(tx: DataFrame, min_rows: int | None = None) -> DataFrame:
    """Every withdrawal less than an hour after a deposit of the same player."""

    def side(kind: str, prefix: str) -> DataFrame:
        return tx.filter(
            (F.col("transaction_type") == kind) & F.col("player_id").isNotNull()
        ).select(
            "player_id",
            F.col("transaction_id").alias(f"{prefix}_id"),
            F.col("transaction_timestamp").alias(f"{prefix}_time"),
            F.col("amount").alias(f"{prefix}_amount"),
        )

    return followed_within(
        side("deposit", "deposit"),
        side("withdraw", "withdraw"),
        "player_id",
        "deposit_time",
        "withdraw_time",
        "deposit_id",
        "withdraw_id",
        RAPID_MINUTES,
        min_rows,
    ).withColumn(
        "minutes_between", F.timestamp_diff("MINUTE", F.col("deposit_time"), F.col("withdraw_time"))
    )


def rapid_deposit_withdraw(tx: DataFrame, min_rows: int | None = None) -> DataFrame:
    return _signal(
        rapid_cycles(tx, min_rows),
        "RAPID_DEPOSIT_WITHDRAW",
        "HIGH",
        ["deposit_id", "withdraw_id"],
        signal_description=_message(
            RAPID_TEXT, money_text("deposit_amount"), money_text("withdraw_amount"),
            "minutes_between",
        ),
        detected_at=F.col("deposit_time"),
    )


def fraud_signals(
    sessions: DataFrame,
    tx: DataFrame,
    as_of: datetime,
    work: WorkTables | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """All four signals.

    Rows of shared addresses and devices name their group; related_player_pages() has its players.
    `fraud_signal_id` is built from player, type and time of detection and repeats where those
    do; `signal_event_id` is unique and the same in every run.
    """
    totals = kept(work, "player_totals", player_financials(tx))
    return (
        multi_accounting(sessions, work, min_rows)
        .unionByName(deposit_without_bet(totals, as_of))
        .unionByName(device_signals(sessions, as_of, work, min_rows))
        .unionByName(rapid_deposit_withdraw(tx, min_rows))
        .select(
            surrogate_key(["player_id", "signal_type", key_time("detected_at")]).alias(
                "fraud_signal_id"
            ),
            *SIGNAL_COLUMNS,
            stamp(as_of).alias("_gold_processed_at"),
        )
    )


def related_player_pages(
    sessions: DataFrame,
    work: WorkTables | None = None,
    page_players: int = PAGE_PLAYERS,
) -> DataFrame:
    """Player lists of all shared addresses and devices, once per group."""

    def pages(key: str, more_than: int) -> DataFrame:
        members = sharing_members(sessions, key, more_than, work)
        return (
            player_pages(members, key, page_players)
            .withColumnRenamed(key, "related_group")
            .withColumn("kind", F.lit(key))
        )

    return pages("ip", IP_PLAYERS_OVER).unionByName(pages("device", DEVICE_PLAYERS_OVER))


def multi_accounting_groups(sessions: DataFrame, work: WorkTables | None = None) -> DataFrame:
    """Shared addresses and devices, one row per group."""
    return (
        ip_sharing(sessions, work)
        .select(F.lit("ip").alias("kind"), F.col("ip").alias("shared_value"), *_GROUP_COLUMNS)
        .unionByName(
            device_sharing(sessions, work).select(
                F.lit("device").alias("kind"),
                F.col("device").alias("shared_value"),
                *_GROUP_COLUMNS,
            )
        )
    )


_GROUP_COLUMNS = ["distinct_players", "first_seen", "last_seen"]


def ip_logins_per_hour(sessions: DataFrame) -> DataFrame:
    """Logins and distinct players per address and hour, for hours that start every ten minutes. For bursts
    that begin anywhere see trailing_hour()."""
    # Counted per slot and player first: a busy address is spread over its players, and what is
    # copied to the six hours that hold a slot is a count.
    slot = F.window("session_timestamp", "10 minutes")["start"]
    per_slot = (
        sessions.filter(F.col("ip").isNotNull() & F.col("session_timestamp").isNotNull())
        .groupBy("ip", slot.alias("slot"), "player_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    starts = [F.col("slot") - F.make_dt_interval(mins=F.lit(10 * k)) for k in range(6)]
    per_player = (
        per_slot.withColumn("hour_start", F.explode(F.array(*starts)))
        .groupBy("ip", "hour_start", "player_id")
        .agg(F.sum("n").alias("n"))
    )
    return per_player.groupBy("ip", "hour_start").agg(
        F.sum("n").alias("logins"), F.count("player_id").alias("distinct_players")
    )


TRAILING = 60  # minutes


def trailing_hour(sessions: DataFrame, minutes: int = TRAILING) -> DataFrame:
    """ip, login_time, logins, distinct_players: for every address and time of a login, all logins of
    the address within the time before it (start excluded, login included) and the players behind them.

    A sweep over openings and closings: a login opens a stretch that closes `minutes` later, and what
    is open at a time is the running sum. Stretches of one player that overlap are merged, so open
    stretches are distinct players. Logins of a player within one slot of that length always overlap;
    merging needs the first and last of each slot only, never the single logins of a busy player.
    Running sums are made per address and minute and carried over from minute to minute, so a busy
    address is spread over its minutes. Logins without address or time are left out; those without a
    player count as logins.
    """
    length = F.make_dt_interval(mins=F.lit(minutes))
    logins = sessions.filter(F.col("ip").isNotNull() & F.col("session_timestamp").isNotNull()).select(
        "ip", "player_id", F.col("session_timestamp").alias("time")
    )
    opened = (
        logins.groupBy("ip", "time")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("ip", "time", "n", F.lit(0).cast("long").alias("players"))
    )
    events = (
        opened.withColumn("is_login", F.lit(True))
        .unionByName(
            opened.select("ip", (F.col("time") + length).alias("time"), (-F.col("n")).alias("n"),
                          "players", F.lit(False).alias("is_login"))
        )
        .unionByName(_player_stretches(logins, minutes))
        .groupBy("ip", "time")
        .agg(F.sum("n").alias("n"), F.sum("players").alias("players"), F.max("is_login").alias("is_login"))
        .withColumn("slot", F.date_trunc("minute", "time"))
    )
    before = Window.partitionBy("ip").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = events.groupBy("ip", "slot").agg(F.sum("n").alias("n"), F.sum("players").alias("players")).select(
        "ip", "slot",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n", "players")],
    )
    so_far = Window.partitionBy("ip", "slot").orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    summed = events.withColumns({c: F.sum(c).over(so_far) for c in ("n", "players")})
    return (
        summed.filter("is_login")
        .join(carried, ["ip", "slot"])
        .select(
            "ip", F.col("time").alias("login_time"), (F.col("n") + F.col("n_before")).alias("logins"),
            (F.col("players") + F.col("players_before")).alias("distinct_players"),
        )
    )


def _player_stretches(logins: DataFrame, minutes: int) -> DataFrame:
    """+1 where a stretch of a player on an address opens and -1 where it closes."""
    length = F.make_dt_interval(mins=F.lit(minutes))
    per_slot = (
        logins.filter(F.col("player_id").isNotNull())
        .groupBy("ip", "player_id", F.window("time", f"{minutes} minutes")["start"].alias("slot"))
        .agg(F.min("time").alias("first"), F.max("time").alias("last"))
    )
    along = Window.partitionBy("ip", "player_id").orderBy("slot")
    ends = per_slot.withColumns(
        {"was": F.lag("last").over(along), "next": F.lead("first").over(along)}
    )
    opens = F.col("was").isNull() | (F.col("was") + length <= F.col("first"))
    closes = F.col("next").isNull() | (F.col("last") + length <= F.col("next"))
    both = F.array_compact(
        F.array(
            F.when(opens, F.struct(F.col("first").alias("time"), F.lit(1).alias("players"))),
            F.when(closes, F.struct((F.col("last") + length).alias("time"), F.lit(-1).alias("players"))),
        )
    )
    return ends.select("ip", F.explode(both).alias("e")).select(
        "ip", F.col("e.time").alias("time"), F.lit(0).cast("long").alias("n"),
        F.col("e.players").cast("long").alias("players"), F.lit(False).alias("is_login"),
    )


def busiest_hours(sessions: DataFrame, minutes: int = TRAILING) -> DataFrame:
    """Per address the most logins and the most players within one trailing hour, wherever it begins, and
    when each was reached first."""
    at = trailing_hour(sessions, minutes)
    best = lambda c: F.max(F.struct(F.col(c), -F.unix_micros("login_time")))
    when = lambda c: F.timestamp_micros(-F.col(f"{c}.col2"))
    return (
        at.groupBy("ip")
        .agg(best("logins").alias("l"), best("distinct_players").alias("p"))
        .select(
            "ip", F.col("l.logins").alias("peak_logins"), when("l").alias("peak_logins_at"),
            F.col("p.distinct_players").alias("peak_players"), when("p").alias("peak_players_at"),
        )
    )
