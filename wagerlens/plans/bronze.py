"""Bronze: rename, safe cast, pass the audit columns on. No business rule lives here."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.functions.scalars import safe_date, safe_long, safe_money, safe_timestamp
from wagerlens.schemas import AUDIT_COLUMNS

# target column -> (raw column, cast or None)
Casts = dict[str, tuple[str, Callable[[Column], Column] | None]]

PLAYERS: Casts = {
    "player_id": ("player_id", None),
    "email": ("email", None),
    "city": ("city", None),
    "created_at": ("created_at", safe_date),
}
SESSIONS: Casts = {
    "session_id": ("session_id", None),
    "player_id": ("player_id", None),
    "ip": ("ip", None),
    "device": ("device", None),
    "session_ts": ("timestamp", safe_timestamp),
}
TRANSACTIONS: Casts = {
    "transaction_id": ("transaction_id", None),
    "player_id": ("player_id", None),
    "transaction_type": ("type", None),
    "amount": ("amount", safe_money),
    "txn_ts": ("timestamp", safe_timestamp),
}
AFFILIATE: Casts = {
    "affiliate_id": ("affiliate_id", None),
    "player_id": ("player_id", None),
    "country": ("country", None),
    "clicks": ("clicks", safe_long),
    "registrations": ("registrations", safe_long),
    "ftd": ("ftd", safe_long),
    "cpa_value": ("cpa_value", safe_money),
}


def _conform(raw: DataFrame, casts: Casts) -> DataFrame:
    typed = [
        (cast(F.col(source)) if cast else F.col(source)).alias(target)
        for target, (source, cast) in casts.items()
    ]
    return raw.select(*typed, *[c for c in AUDIT_COLUMNS if c in raw.columns])


def stg_players(raw: DataFrame) -> DataFrame:
    return _conform(raw, PLAYERS)


def stg_sessions(raw: DataFrame) -> DataFrame:
    return _conform(raw, SESSIONS)


def stg_transactions(raw: DataFrame) -> DataFrame:
    return _conform(raw, TRANSACTIONS)


def stg_affiliate_cpa_ftd(raw: DataFrame) -> DataFrame:
    return _conform(raw, AFFILIATE)


def cast_failures(raw: DataFrame, casts: Casts) -> DataFrame:
    """(column_name, failures): values present in raw that the cast turned into NULL."""
    typed = {target: spec for target, spec in casts.items() if spec[1]}
    counts = raw.agg(
        *[
            F.count_if(F.col(source).isNotNull() & cast(F.col(source)).isNull()).alias(target)
            for target, (source, cast) in typed.items()
        ]
    )
    return counts.unpivot([], list(typed), "column_name", "failures")
