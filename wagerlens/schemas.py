"""Raw (all text) schemas, money types and the Gold contracts."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)  # one amount
TOTAL = T.DecimalType(28, 2)  # a sum of amounts
RATIO = T.DecimalType(38, 9)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _text(*names: str) -> T.StructType:
    return _struct(**{name: T.StringType() for name in names})


AUDIT_COLUMNS = ("_ingested_at", "_source_file")

# Source columns, in file order.
RAW = {
    "players": _text("player_id", "email", "city", "created_at"),
    "sessions": _text("session_id", "player_id", "ip", "device", "timestamp"),
    "transactions": _text("transaction_id", "player_id", "type", "amount", "timestamp"),
    "affiliate_cpa_ftd": _text(
        "affiliate_id", "player_id", "country", "clicks", "registrations", "ftd", "cpa_value"
    ),
}

_S, _L, _D, _TS, _B = T.StringType(), T.LongType(), T.DateType(), T.TimestampType(), T.BooleanType()

CORE_SIGNALS = ("s_ghost_ftd", "s_aml_low_play", "s_ip_velocity", "s_ledger_anomaly", "s_net_negative")
SECONDARY_SIGNALS = ("s_structuring", "s_geo_conflict", "s_device_takeover", "s_reg_velocity", "s_dormant")

# The serving contract (names, order, types) of each Gold table.
CONTRACTS = {
    "dim_date": _struct(
        date_day=_D, year=_L, quarter=_L, month=_L, day=_L, day_of_week=_L,
        day_name=_S, year_month=_S, is_weekend=_B,
    ),
    "dim_player": _struct(
        player_id=_S, email=_S, city=_S, registered_at=_D, is_qualified_ftd=_B, first_deposit_ts=_TS,
        acquisition_affiliate_id=_S, acquisition_country=_S, is_one_and_done=_B,
    ),
    "dim_affiliate": _struct(
        affiliate_id=_S, n_players_claimed=_L, n_acquisition_countries=_L, primary_country=_S,
    ),
    "fct_transactions": _struct(
        transaction_id=_S, player_id=_S, txn_ts=_TS, txn_date=_D, transaction_type=_S,
        amount=MONEY, signed_amount=MONEY, running_balance=TOTAL,
    ),
    "fct_sessions": _struct(
        session_id=_S, player_id=_S, ip=_S, device=_S, session_ts=_TS, session_date=_D,
    ),
    "fct_fraud_signals": _struct(
        player_id=_S, **{s: _B for s in CORE_SIGNALS + SECONDARY_SIGNALS},
        value_at_risk=TOTAL, risk_score=_L, risk_tier=_S,
    ),
    "agg_affiliate_performance": _struct(
        affiliate_id=_S, qualified_ftds=_L, cpa_owed=TOTAL, real_revenue=TOTAL, roi=RATIO, ghost_ftds=_L,
    ),
}

# The closed domains of the sources.
TRANSACTION_TYPES = ("deposit", "withdraw", "bet")
DEVICES = ("android", "desktop", "ios")
COUNTRIES = ("AR", "BR", "CL", "CO", "MX")
RISK_TIERS = ("Critical", "High", "Medium", "Low", "No alert")
