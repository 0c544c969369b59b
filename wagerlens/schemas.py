"""Column lists and types of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
}


def struct(spec: str) -> T.StructType:
    """Schema from `name type, name type`; works without a session."""
    pairs = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Columns as they stand in the source files.
FILE_SCHEMAS = {
    "players": struct("player_id string, email string, city string, created_at date"),
    "sessions": struct(
        "session_id string, player_id string, ip string, device string, timestamp timestamp"
    ),
    "transactions": struct(
        "transaction_id string, player_id string, type string, amount double, timestamp timestamp"
    ),
    "affiliates": struct(
        "affiliate_id string, player_id string, country string, clicks bigint,"
        " registrations bigint, ftd bigint, cpa_value double"
    ),
}

# Bronze keeps the file columns and adds the ingest stamp.
BRONZE = {
    name: T.StructType(s.fields + [T.StructField("_ingested_at", T.TimestampType())])
    for name, s in FILE_SCHEMAS.items()
}

BRONZE_TABLES = {name: f"raw_{name}" for name in FILE_SCHEMAS}

SILVER_KEYS = {
    "dim_players": ["player_id"],
    "dim_sessions": ["session_id"],
    "fct_transactions": ["transaction_id"],
    "dim_affiliates": ["affiliate_id", "player_id"],
}

SILVER_SOURCE = {
    "dim_players": "players",
    "dim_sessions": "sessions",
    "fct_transactions": "transactions",
    "dim_affiliates": "affiliates",
}

GOLD_TABLES = ["fct_fraud_signals", "fct_affiliate_performance", "fct_financial_summary"]

# Fixed values of the domain.
DEVICES = ["android", "ios", "desktop"]
TRANSACTION_TYPES = ["deposit", "withdraw", "bet"]
SIGNAL_TYPES = [
    "MULTI_ACCOUNTING",
    "DEPOSIT_WITHOUT_BET",
    "DEVICE_SHARING",
    "RAPID_DEPOSIT_WITHDRAW",
]
RISK_LEVELS = ["HIGH", "MEDIUM", "LOW"]
RISK_CLASSES = [
    "HIGH_RISK_NO_BETS",
    "HIGH_RISK_OVER_WITHDRAWAL",
    "MEDIUM_RISK_NEW_HIGH_VALUE",
    "NORMAL",
]
