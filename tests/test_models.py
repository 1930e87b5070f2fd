"""Business rules on small static inputs."""

from datetime import datetime
from decimal import Decimal


from tests.conftest import rows
from wagerlens.operators.quality import enforce_contract
from wagerlens.params import DEFAULTS
from wagerlens.plans import bronze, gold, signals, silver
from wagerlens.schemas import CONTRACTS, CORE_SIGNALS, SECONDARY_SIGNALS

TX = "transaction_id string, player_id string, txn_ts timestamp, transaction_type string, amount decimal(18,2)"
AFF = "player_id string, affiliate_id string, country string, ftd bigint, cpa_value decimal(18,2)"
TEN = datetime(2024, 1, 1, 10)


def test_qualified_ftd_respects_the_baseline(frame):
    tx = frame(
        TX,
        ("d1", "pA", "2024-01-01 10:00:00", "deposit", 100), ("b1", "pA", "2024-01-01 11:00:00", "bet", 60),
        ("d2", "pB", "2024-01-01 10:00:00", "deposit", 100), ("b2", "pB", "2024-01-01 11:00:00", "bet", 10),
        ("b3", "pC", "2024-01-01 11:00:00", "bet", 500),
    )
    got = silver.qualified_ftd(silver.wallet_profile(tx))
    assert rows(got, "player_id", "first_deposit_ts", "total_bets", "is_qualified") == [
        ("pA", TEN, 60, True), ("pB", TEN, 10, False)
    ]


def test_a_bettor_without_deposit_never_qualifies(frame):
    tx = frame(TX, ("b3", "pC", "2024-01-01 11:00:00", "bet", 500))
    assert rows(silver.wallet_profile(tx), "player_id", "is_qualified") == [("pC", False)]


def test_only_qualified_players_earn_and_the_highest_cpa_wins(frame):
    qualified = frame("player_id string, is_qualified boolean", ("p1", True), ("p2", False))
    aff = frame(AFF, ("p1", "a1", "BR", 1, 30), ("p1", "a2", "AR", 1, 50), ("p2", "a3", "BR", 1, 20))
    got = silver.affiliate_attribution(qualified, aff)
    assert rows(got, "player_id", "affiliate_id", "acquisition_country", "cpa_value") == [("p1", "a2", "AR", 50)]


def test_attribution_ties(frame):
    qualified = frame("player_id string, is_qualified boolean", ("p1", True))
    aff = frame(
        AFF,
        ("p1", "a9", "BR", 1, 50), ("p1", "a2", "MX", 3, 50), ("p1", "a2", "AR", 1, 50),
        ("p1", "a1", "BR", 0, 90), ("p1", "a0", "BR", 1, None),
    )
    got = silver.affiliate_attribution(qualified, aff)
    assert rows(got, "affiliate_id", "acquisition_country", "cpa_value") == [("a2", "AR", 50)]


def test_claim_without_cpa_only_wins_alone(frame):
    qualified = frame("player_id string, is_qualified boolean", ("p1", True))
    got = silver.affiliate_attribution(qualified, frame(AFF, ("p1", "a0", "BR", 1, None)))
    assert rows(got, "affiliate_id", "cpa_value") == [("a0", None)]


def test_financials(frame):
    tx = frame(
        TX,
        ("t1", "p1", "2024-01-01 10:00:00", "deposit", 100), ("t2", "p1", "2024-01-01 11:00:00", "withdraw", 30),
        ("t3", "p1", "2024-01-01 12:00:00", "bet", 40), ("t4", "p2", "2024-01-01 12:00:00", "bet", 40),
    )
    assert rows(silver.player_financials(silver.wallet_profile(tx)), *silver.FINANCIALS) == [
        ("p1", 100, 30, 40, 70, 0.4, 1, 1, 1), ("p2", 0, 0, 40, 0, None, 0, 0, 1)
    ]


def test_ledger_running_balance(frame):
    tx = frame(
        TX,
        ("t3", "p1", "2024-01-01 12:00:00", "withdraw", 20), ("t1", "p1", "2024-01-01 10:00:00", "deposit", 100),
        ("t2", "p1", "2024-01-01 11:00:00", "bet", 40),
    )
    assert rows(silver.player_ledger(tx), "transaction_id", "signed_amount", "running_balance") == [
        ("t1", 100, 100), ("t2", -40, 60), ("t3", -20, 40)
    ]


def test_activity_counts_whole_days(frame):
    sessions = frame(
        "session_id string, player_id string, ip string, device string, session_ts timestamp",
        ("s1", "p1", "i1", "ios", "2024-01-01 23:00:00"), ("s2", "p1", "i2", "ios", "2024-01-03 22:59:59"),
    )
    assert rows(silver.player_activity(sessions), "session_count", "distinct_ips", "distinct_devices", "active_span_days") == [
        (2, 2, 1, 1)
    ]


def test_fraud_signals(frame):
    flag = "player_id string, is_qualified boolean"
    wallet = frame(
        "player_id string, total_deposits decimal(18,2), total_withdrawals decimal(18,2), total_bets decimal(18,2), "
        "net_deposit decimal(18,2), is_qualified boolean, n_round bigint, first_type string",
        ("p_clean", 100, 20, 60, 80, True, 0, "deposit"), ("p_bad", 50, 100, 20, -50, False, 0, "deposit"),
    )
    activity = frame(
        "player_id string, distinct_ips bigint, distinct_devices bigint, active_span_days bigint",
        ("p_clean", 2, 1, 5), ("p_bad", 3, 1, 5),
    )
    players = frame("player_id string, created_at date", ("p_clean", "2024-01-01"), ("p_bad", "2024-01-02"),
                    *[(f"f{i}", "2024-01-03") for i in range(1, 6)])
    got = gold.fct_fraud_signals(players, wallet, activity, frame(AFF, ("p_bad", "a1", "BR", 1, None)))
    enforce_contract(got, CONTRACTS["fct_fraud_signals"])
    by_player = {r.player_id: r.asDict() for r in got.collect()}
    assert set(by_player) == {"p_clean", "p_bad", *(f"f{i}" for i in range(1, 6))}
    clean, bad = by_player["p_clean"], by_player["p_bad"]
    assert not any(clean[s] for s in CORE_SIGNALS + SECONDARY_SIGNALS)
    assert (clean["value_at_risk"], clean["risk_score"], clean["risk_tier"]) == (20, 0, "No alert")
    assert {s for s in CORE_SIGNALS + SECONDARY_SIGNALS if bad[s]} == {"s_ghost_ftd", "s_net_negative"}
    assert (bad["value_at_risk"], bad["risk_score"], bad["risk_tier"]) == (100, 2, "Medium")


def test_affiliate_performance(frame):
    got = gold.agg_affiliate_performance(
        frame(AFF, ("p1", "a1", "BR", 1, 50), ("p1", "a3", "BR", 1, 40), ("p2", "a1", "BR", 1, None), ("p2", "a2", "BR", 1, None), (None, "a1", "BR", 1, 9)),
        frame("player_id string, is_qualified boolean, net_deposit decimal(18,2)", ("p1", True, 200), ("p2", False, 5)),
    )
    enforce_contract(got, CONTRACTS["agg_affiliate_performance"])
    assert rows(got) == [("a1", 1, 50, 200, 4.0, 1)]  # a2 has nothing but a ghost: absent


def test_every_signal_fires_alone(frame):
    """Each rule at its threshold, on either side of it."""
    tx = frame(
        TX,
        ("t1", "low", "2024-01-01 10:00:00", "deposit", 100), ("t2", "low", "2024-01-01 11:00:00", "bet", 19),
        ("t3", "low", "2024-01-01 12:00:00", "withdraw", 1),
        ("u1", "fair", "2024-01-01 10:00:00", "deposit", 100), ("u2", "fair", "2024-01-01 11:00:00", "bet", 20),
        ("u3", "fair", "2024-01-01 12:00:00", "withdraw", 1),
        *[(f"r{i}", "round", "2024-01-01 10:00:00", "deposit", 300) for i in range(3)],
        *[(f"q{i}", "odd", "2024-01-01 10:00:00", "deposit", a) for i, a in enumerate(("100", "200", "250.50"))],
        ("a", "tied", "2024-01-01 10:00:00", "bet", 1), ("b", "tied", "2024-01-01 10:00:00", "deposit", 1),
    )
    flagged = lambda df, name: sorted(r.player_id for r in df.where(name).collect())
    fin = silver.player_financials(silver.wallet_profile(tx))
    assert flagged(signals.aml_low_play(fin), "s_aml_low_play") == ["low"]
    assert flagged(signals.structuring(tx), "s_structuring") == ["round"]
    assert flagged(signals.ledger_anomaly(tx), "s_ledger_anomaly") == ["tied"]  # same instant: id decides
    activity = frame(
        "player_id string, distinct_ips bigint, distinct_devices bigint, active_span_days bigint",
        ("at", 10, 2, 60), ("over", 11, 3, 61),
    )
    assert flagged(signals.ip_velocity(activity), "s_ip_velocity") == ["over"]
    assert flagged(signals.device_takeover(activity), "s_device_takeover") == ["over"]
    assert flagged(signals.dormant(activity), "s_dormant") == ["over"]
    aff = frame(AFF, ("p1", "a1", "BR", 0, 1), ("p1", "a1", "AR", 0, 1), ("p2", "a1", "BR", 2, 1), ("p2", "a2", "BR", 0, 1))
    assert flagged(signals.geo_conflict(aff), "s_geo_conflict") == ["p1"]
    nobody = frame("player_id string, is_qualified boolean", ("x", True))
    assert flagged(signals.ghost_ftd(aff, nobody), "s_ghost_ftd") == ["p2"]


def test_risk_tiers(frame):
    flags = frame(
        "player_id string, " + ", ".join(f"{s} boolean" for s in CORE_SIGNALS),
        *[(str(n), *[i < n for i in range(5)]) for n in range(6)],
    )
    assert [(r.risk_score, r.risk_tier) for r in signals.risk_score(flags).orderBy("player_id").collect()] == [
        (0, "No alert"), (1, "Low"), (2, "Medium"), (3, "High"), (4, "Critical"), (5, "Critical")
    ]


def test_dim_date_spans_both_facts(frame):
    tx = frame(TX, ("t1", "p1", "2024-02-28 10:00:00", "deposit", 1))
    sessions = frame("session_ts timestamp", ("2024-03-02 00:00:00",))
    got = gold.dim_date(tx, sessions).orderBy("date_day").collect()
    assert [str(r.date_day) for r in got] == ["2024-02-28", "2024-02-29", "2024-03-01", "2024-03-02"]
    assert (got[-1].day_of_week, got[-1].day_name, got[-1].is_weekend, got[-1].year_month) == (7, "Saturday", True, "2024-03")
    assert gold.dim_date(tx.limit(0), sessions.limit(0)).count() == 0


def test_dim_player_from_all_or_credited_claims(frame):
    tx = frame(
        TX, ("t1", "p1", "2024-01-01 10:00:00", "deposit", 100), ("t2", "p1", "2024-01-01 11:00:00", "bet", 50),
        ("t3", "p2", "2024-01-02 10:00:00", "deposit", 10), ("t4", "p2", "2024-01-03 10:00:00", "deposit", 10),
    )
    aff = frame(AFF, ("p1", "a1", "BR", 1, 30), ("p2", "a2", "AR", 1, 50))
    people = silver.players_conformed(
        frame("player_id string, email string, city string, created_at date",
              ("p1", "A@X", "c", "2024-01-01"), ("p2", "b@x", "c", "2024-01-01"), ("p3", "c@x", "c", None))
    )
    wallet = silver.wallet_profile(tx)
    whole = gold.dim_player(people, wallet, silver.winning_claims(aff))
    assert rows(gold.dim_player(people, wallet, silver.affiliate_attribution(wallet, aff))) == rows(whole)
    cols = ("player_id", "email", "is_qualified_ftd", "acquisition_affiliate_id", "is_one_and_done")
    assert rows(whole, *cols) == [
        ("p1", "a@x", True, "a1", True), ("p2", "b@x", False, None, False), ("p3", "c@x", False, None, False)
    ]


def test_dim_affiliate_primary_country(frame):
    aff = frame(
        AFF, ("p1", "a1", "MX", 0, 1), ("p2", "a1", "AR", 0, 1), ("p3", "a1", "MX", 0, 1), ("p1", "a1", "AR", 0, 1),
        ("p1", "a2", "CL", 0, 1),
    )
    assert rows(gold.dim_affiliate(aff)) == [("a1", 3, 2, "AR"), ("a2", 1, 1, "CL")]


def test_bronze_casts_are_safe(frame):
    raw = frame(
        "transaction_id string, player_id string, type string, amount string, timestamp string",
        ("t1", "p", "bet", "10.005", "2024-01-01 10:00:00"), ("t2", "p", "bet", "n/a", "2024-01-01T10:00:00.5"),
        ("t3", "p", "bet", None, "10:00:00"), ("t4", "p", "bet", "1", "2024"),
    )
    got = bronze.stg_transactions(raw)
    assert got.columns == ["transaction_id", "player_id", "transaction_type", "amount", "txn_ts"]
    assert rows(got, "transaction_id", "amount", "txn_ts") == [
        ("t1", 10.01, TEN), ("t2", None, datetime(2024, 1, 1, 10, 0, 0, 500000)), ("t3", None, None), ("t4", 1.0, None)
    ]
    assert rows(bronze.cast_failures(raw, bronze.TRANSACTIONS)) == [("amount", 1), ("txn_ts", 2)]
    aff = frame(
        "affiliate_id string, player_id string, country string, clicks string, registrations string, ftd string, cpa_value string",
        ("a", "p", "BR", "12.0", "-3", "x", "5"),
    )
    assert rows(bronze.stg_affiliate_cpa_ftd(aff), "clicks", "registrations", "ftd", "cpa_value") == [(None, -3, None, 5)]
    people = frame("player_id string, email string, city string, created_at string", ("p", "E", "c", "2024"), ("q", "E", "c", "2024-1-5"))
    assert [str(r.created_at) for r in bronze.stg_players(people).orderBy("player_id").collect()] == ["None", "2024-01-05"]


def test_thresholds_are_parameters(frame):
    activity = frame("player_id string, distinct_ips bigint", ("p", 5))
    assert signals.ip_velocity(activity, DEFAULTS.but(max_ips=4)).first().s_ip_velocity
    assert DEFAULTS.qualified_baseline == Decimal("50")
