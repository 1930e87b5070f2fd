"""Report figures on inputs where every line has something to count."""

from tests.conftest import rows
from wagerlens.params import DEFAULTS
from wagerlens.plans import kpis, reports, silver

TX = "transaction_id string, player_id string, txn_ts timestamp, transaction_type string, amount decimal(18,2)"
AFF = (
    "affiliate_id string, player_id string, country string, clicks bigint, registrations bigint, ftd bigint, "
    "cpa_value decimal(18,2)"
)


def test_silver_discovery_counts_orphans_and_impossible_rows(frame):
    players = frame(
        "player_id string, email string, created_at date",
        ("p1", "A@x", "2024-01-02"), ("p2", "b@x", "2024-01-01"), ("p3", None, None),
    )
    sessions = frame("session_id string, player_id string", ("s1", "p1"), ("s2", "gone"), ("s3", "gone"), ("s4", None))
    tx = frame(
        TX,
        ("t1", "p1", "2024-01-01 23:00:00", "withdraw", 5),  # before created_at and before the deposit
        ("t2", "p1", "2024-01-03 00:00:00", "deposit", 5), ("t3", "p1", "2024-01-04 00:00:00", "bet", 60),
        ("t4", "p2", "2024-01-02 00:00:00", "deposit", 5), ("t5", "gone", "2024-01-02 00:00:00", "bet", 5),
    )
    aff = frame(
        AFF, ("a1", "p1", "BR", 9, 3, 4, 1), ("a1", "p1", "AR", 2, 3, 0, 1), ("a2", "gone", "BR", 9, 3, 0, 1),
        ("a2", "gone", "BR", 9, 3, 0, 1),
    )
    report = reports.silver_discovery(players, sessions, tx, aff)
    got = {r.step: (r.n, r.note) for r in report.collect()}
    assert [got[i][0] for i in range(1, 11)] == [1, 5, 2, 1, 1, 1, 1, 1, 1, 2]  # a session without an id has no player either
    assert got[1][1] == "distinct raw=2 = lowercased=2, so no real duplicate"
    assert got[2][1] == "sessions=3, transactions=1, affiliate=1"
    assert got[4][1] == "of 2 that deposited, 1 also placed bets"


def test_reports_on_empty_sources(frame):
    tx = frame(TX, ("t", "p", "2024-01-01 00:00:00", "bet", 1)).limit(0)
    sessions = frame(
        "session_id string, player_id string, ip string, device string, session_ts timestamp",
        ("s", "p", "i", "d", "2024-01-01 00:00:00"),
    ).limit(0)
    aff = frame(AFF, ("a", "p", "BR", 1, 1, 1, 1)).limit(0)
    players = frame("player_id string, email string, created_at date", ("p", "e", "2024-01-01")).limit(0)
    assert {r.n for r in reports.silver_discovery(players, sessions, tx, aff).collect()} == {0}
    assert {r.n for r in reports.silver_feature_scan(tx, sessions).collect()} == {0}
    assert [(r.n, r.note) for r in reports.ledger_reconciliation(tx).collect()][0] == (0, "")
    assert reports.dashboard_metrics(silver.wallet_profile(tx), silver.winning_claims(aff)).count() == 7


def test_retention_has_a_row_for_every_calendar_month(frame):
    tx = frame(
        "player_id string, txn_date date", ("p", "2024-01-05"), ("q", "2024-01-06"), ("p", "2024-02-01"),
        ("p", "2024-02-09"), ("r", "2024-04-01"),
    )
    assert rows(kpis.retention(tx)) == [
        ("2024-01", 2, 0, 0, None), ("2024-02", 1, 2, 1, 0.5), ("2024-03", 0, 1, 0, 0.0), ("2024-04", 1, 0, 0, None)
    ]


def test_fraud_cards_follow_the_slicer(frame):
    fraud = frame(
        "player_id string, risk_score bigint, value_at_risk decimal(18,2)", ("a", 0, 5), ("b", 1, 10), ("c", 3, 20)
    )
    got = kpis.kpi_fraud(fraud, params=DEFAULTS).first()
    assert (got.players_scanned, got.suspicious_accounts, got.value_at_risk, got.high_risk_value_at_risk) == (3, 2, 35, 20)
    assert kpis.kpi_fraud(fraud, fraud.risk_score >= 1).first().players_scanned == 2
