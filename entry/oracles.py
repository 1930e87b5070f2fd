"""The same results in plain SQL on the same Parquet tables, written independently of the models."""

from __future__ import annotations

# Common tables; a query uses those it needs.
BASE = """
WITH players AS (
  SELECT 'pl_' || c_custkey AS player_id,
         CASE WHEN c_custkey % 5 = 0 THEN upper(c_name || '@mail.com') ELSE lower(c_name || '@mail.com') END AS email,
         n_name AS city,
         DATE '1995-01-01' + CAST((c_custkey * c_custkey) % 900 AS INT) AS created_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
transactions AS (
  SELECT 'tx_' || o_orderkey AS transaction_id, 'pl_' || o_custkey AS player_id,
         CASE o_orderstatus WHEN 'F' THEN 'deposit' WHEN 'O' THEN 'withdraw' ELSE 'bet' END AS transaction_type,
         CAST(floor(o_totalprice / 1000) + 1 AS DECIMAL(18,2)) AS amount, o_orderdate AS txn_ts
  FROM orders),
sessions AS (
  SELECT 'ss_' || event_id AS session_id, 'pl_' || user_id AS player_id,
         '10.0.0.' || json_extract_string(props, '$.k') AS ip, event_type AS device, ts AS session_ts
  FROM events),
affiliate_o AS (
  SELECT 'aff_' || l_suppkey AS affiliate_id, 'pl_' || o_custkey AS player_id, n_name AS country,
         CAST(l_quantity AS BIGINT) AS clicks, CAST(10 + l_partkey % 15 AS BIGINT) AS registrations,
         CAST(CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN 1 + l_partkey % 20 ELSE 0 END AS BIGINT) AS ftd,
         CAST(round(l_discount * 1000) AS DECIMAL(18,2)) AS cpa_value, l_orderkey AS file_no, l_linenumber AS line_no
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON n_nationkey = CASE WHEN l_quantity = 50 THEN s_nationkey ELSE c_nationkey END),
affiliate AS (SELECT * EXCLUDE (file_no, line_no) FROM affiliate_o),
raw_tx AS (
  SELECT transaction_id, player_id, transaction_type AS type,
         CASE WHEN amount <= 5 THEN 'n/a' ELSE CAST(amount AS VARCHAR) END AS amount,
         strftime(txn_ts, '%Y-%m-%d %H:%M:%S') AS timestamp FROM transactions),
raw_aff AS (
  SELECT * REPLACE (CASE WHEN clicks = 1 THEN '1.0' ELSE CAST(clicks AS VARCHAR) END AS clicks) FROM affiliate),
first_deposit AS (
  SELECT player_id, min(txn_ts) AS first_deposit_ts, count(*) AS deposit_count, sum(amount) AS total_deposits
  FROM transactions WHERE transaction_type = 'deposit' GROUP BY player_id),
bets AS (SELECT player_id, sum(amount) AS total_bets FROM transactions WHERE transaction_type = 'bet' GROUP BY player_id),
qualified_ftd AS (
  SELECT player_id, first_deposit_ts, coalesce(total_bets, 0) AS total_bets, coalesce(total_bets, 0) >= 800 AS is_qualified
  FROM first_deposit LEFT JOIN bets USING (player_id)),
qualified AS (SELECT player_id FROM qualified_ftd WHERE is_qualified),
claims AS (
  SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY cpa_value DESC, affiliate_id, country) AS pick
  FROM affiliate WHERE ftd > 0),
attribution AS (
  SELECT player_id, affiliate_id, country AS acquisition_country, cpa_value
  FROM claims JOIN qualified USING (player_id) WHERE pick = 1),
fin0 AS (
  SELECT player_id,
         coalesce(sum(amount) FILTER (transaction_type = 'deposit'), 0) AS total_deposits,
         coalesce(sum(amount) FILTER (transaction_type = 'withdraw'), 0) AS total_withdrawals,
         coalesce(sum(amount) FILTER (transaction_type = 'bet'), 0) AS total_bets,
         count(*) FILTER (transaction_type = 'deposit') AS n_deposits,
         count(*) FILTER (transaction_type = 'withdraw') AS n_withdrawals,
         count(*) FILTER (transaction_type = 'bet') AS n_bets
  FROM transactions GROUP BY player_id),
financials AS (
  SELECT *, total_deposits - total_withdrawals AS net_deposit,
         CAST(total_bets AS DOUBLE) / nullif(CAST(total_deposits AS DOUBLE), 0) AS bet_ratio FROM fin0),
activity AS (
  SELECT player_id, count(*) AS session_count, count(DISTINCT ip) AS distinct_ips, count(DISTINCT device) AS distinct_devices,
         min(session_ts) AS first_session_ts, max(session_ts) AS last_session_ts,
         date_sub('day', min(session_ts), max(session_ts)) AS active_span_days
  FROM sessions GROUP BY player_id),
ledger0 AS (
  SELECT *, CASE WHEN transaction_type = 'deposit' THEN amount ELSE -amount END AS signed_amount FROM transactions),
ledger AS (
  SELECT *, sum(signed_amount) OVER (PARTITION BY player_id ORDER BY txn_ts, transaction_id) AS running_balance,
         row_number() OVER (PARTITION BY player_id ORDER BY txn_ts, transaction_id) AS rn FROM ledger0),
opening AS (SELECT player_id, transaction_type FROM ledger WHERE rn = 1),
days AS (
  SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS date_day
  FROM (SELECT txn_ts AS ts FROM transactions UNION ALL SELECT session_ts FROM sessions)),
dim_player AS (
  SELECT p.player_id, lower(p.email) AS email, p.city, p.created_at AS registered_at,
         coalesce(q.is_qualified, false) AS is_qualified_ftd, q.first_deposit_ts,
         t.affiliate_id AS acquisition_affiliate_id, t.acquisition_country, coalesce(f.n_deposits, 0) = 1 AS is_one_and_done
  FROM players p LEFT JOIN qualified_ftd q USING (player_id) LEFT JOIN attribution t USING (player_id)
  LEFT JOIN financials f USING (player_id)),
ghosts AS (
  SELECT affiliate_id, player_id FROM affiliate WHERE ftd > 0 AND player_id NOT IN (SELECT player_id FROM qualified)),
performance AS (
  SELECT affiliate_id, qualified_ftds, cpa_owed, real_revenue,
         CAST(real_revenue AS DOUBLE) / nullif(CAST(cpa_owed AS DOUBLE), 0) AS roi, coalesce(ghost_ftds, 0) AS ghost_ftds
  FROM (SELECT affiliate_id, count(DISTINCT player_id) AS qualified_ftds, sum(cpa_value) AS cpa_owed,
               sum(net_deposit) AS real_revenue
        FROM attribution LEFT JOIN financials USING (player_id) GROUP BY affiliate_id)
  LEFT JOIN (SELECT affiliate_id, count(DISTINCT player_id) AS ghost_ftds FROM ghosts GROUP BY affiliate_id)
  USING (affiliate_id)),
reg_day AS (SELECT created_at, count(*) AS n FROM players GROUP BY created_at),
burst AS (
  SELECT player_id FROM players JOIN reg_day USING (created_at)
  WHERE n >= (SELECT quantile_disc(n, 0.9) FROM reg_day)),
rounds AS (
  SELECT player_id, count(*) FILTER (transaction_type = 'deposit' AND amount % 10 = 0) AS n_round
  FROM transactions GROUP BY player_id),
countries AS (SELECT player_id, count(DISTINCT country) AS n_countries FROM affiliate GROUP BY player_id),
hit_ghost AS (SELECT DISTINCT player_id FROM ghosts),
hit_low_play AS (SELECT player_id FROM financials WHERE total_withdrawals > 0 AND total_deposits > 0 AND bet_ratio < 0.2),
hit_ips AS (SELECT player_id FROM sessions GROUP BY player_id HAVING count(DISTINCT ip) > 48),
hit_opening AS (SELECT player_id FROM opening WHERE transaction_type <> 'deposit'),
hit_negative AS (SELECT player_id FROM financials WHERE total_withdrawals > total_deposits),
hit_rounds AS (SELECT player_id FROM rounds WHERE n_round >= 3),
hit_countries AS (SELECT player_id FROM countries WHERE n_countries > 1),
hit_devices AS (SELECT player_id FROM sessions GROUP BY player_id HAVING count(DISTINCT device) >= 3),
hit_span AS (SELECT player_id FROM activity WHERE active_span_days > 28),
hits AS (
  SELECT player_id, 'ghost' AS rule FROM hit_ghost UNION ALL SELECT player_id, 'low_play' FROM hit_low_play
  UNION ALL SELECT player_id, 'ips' FROM hit_ips UNION ALL SELECT player_id, 'opening' FROM hit_opening
  UNION ALL SELECT player_id, 'negative' FROM hit_negative UNION ALL SELECT player_id, 'rounds' FROM hit_rounds
  UNION ALL SELECT player_id, 'countries' FROM hit_countries UNION ALL SELECT player_id, 'devices' FROM hit_devices
  UNION ALL SELECT player_id, 'span' FROM hit_span UNION ALL SELECT player_id, 'burst' FROM burst),
met AS (SELECT player_id, list(DISTINCT rule) AS rules FROM hits GROUP BY player_id),
ruled AS (SELECT players.player_id, coalesce(met.rules, []) AS rules FROM players LEFT JOIN met USING (player_id)),
withdrawn AS (
  SELECT player_id, sum(amount) AS value FROM transactions WHERE transaction_type = 'withdraw' GROUP BY player_id),
scored AS (
  SELECT ruled.player_id, coalesce(withdrawn.value, 0) AS value_at_risk,
         list_contains(rules, 'countries') AS s_geo_conflict, list_contains(rules, 'devices') AS s_device_takeover,
         list_contains(rules, 'rounds') AS s_structuring, list_contains(rules, 'span') AS s_dormant,
         list_contains(rules, 'burst') AS s_reg_velocity, list_contains(rules, 'ghost') AS s_ghost_ftd,
         list_contains(rules, 'ips') AS s_ip_velocity, list_contains(rules, 'low_play') AS s_aml_low_play,
         list_contains(rules, 'negative') AS s_net_negative, list_contains(rules, 'opening') AS s_ledger_anomaly,
         CAST(len(list_filter(rules, lambda r: r IN ('ghost', 'low_play', 'ips', 'opening', 'negative'))) AS BIGINT) AS risk_score
  FROM ruled LEFT JOIN withdrawn USING (player_id)),
fraud AS (
  SELECT * REPLACE (round(CAST(value_at_risk AS DOUBLE), 6) AS value_at_risk),
         CASE WHEN risk_score >= 4 THEN 'Critical' WHEN risk_score = 3 THEN 'High' WHEN risk_score = 2 THEN 'Medium'
              WHEN risk_score >= 1 THEN 'Low' ELSE 'No alert' END AS risk_tier FROM scored),
depositors AS (SELECT DISTINCT player_id FROM transactions WHERE transaction_type = 'deposit')
"""


def _r(expr: str, name: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {name}"


def _money(*cols: str) -> str:
    return ", ".join(_r(c, c) for c in cols)


_FIN = f"""player_id, {_money("total_deposits", "total_withdrawals", "total_bets", "net_deposit", "bet_ratio")},
n_deposits, n_withdrawals, n_bets"""
_LEDGER = f"transaction_id, player_id, txn_ts, transaction_type, {_money('amount', 'signed_amount', 'running_balance')}"
_SIGNALS = [
    ("s_ghost_ftd", "core"), ("s_aml_low_play", "core"), ("s_ip_velocity", "core"), ("s_ledger_anomaly", "core"),
    ("s_net_negative", "core"), ("s_structuring", "secondary"), ("s_geo_conflict", "secondary"),
    ("s_device_takeover", "secondary"), ("s_reg_velocity", "secondary"), ("s_dormant", "secondary"),
]
_SCAN = [
    ("CORE  affiliate ghost-FTD (claimed, never qualified)", "s_ghost_ftd"),
    ("CORE  AML low-play (bet_ratio < 0.2 AND withdrew)", "s_aml_low_play"),
    ("CORE  IP velocity (> 48 distinct IPs)", "s_ip_velocity"),
    ("CORE  ledger anomaly (money-out before funding)", "s_ledger_anomaly"),
    ("CORE  net-negative (withdrew > deposited)", "s_net_negative"),
    ("CORE  MULTI-SIGNAL (risk_score >= 2, high confidence)", "risk_score >= 2"),
    ("SEC   structuring (>= 3 round deposits)", "s_structuring"),
    ("SEC   geo conflict (> 1 acquisition country)", "s_geo_conflict"),
    ("SEC   device takeover (>= 3 distinct devices)", "s_device_takeover"),
    ("SEC   registration velocity (burst day, top decile)", "s_reg_velocity"),
    ("SEC   dormant reactivation (active span > 28d)", "s_dormant"),
]


def _kpi_fraud(where: str) -> str:
    return f"""SELECT count(*) AS players_scanned, count(*) FILTER (risk_score >= 1) AS suspicious_accounts,
{_r("count(*) FILTER (risk_score >= 1) / count(*)", "pct_suspicious")}, {_r("sum(value_at_risk)", "value_at_risk")},
{_r("sum(value_at_risk) FILTER (risk_score >= 2)", "high_risk_value_at_risk")}, {_r("avg(risk_score)", "avg_risk_score")}
FROM fraud WHERE {where}"""


def _kpi_financial(where: str) -> str:
    return f"""SELECT {_money("total_deposits", "total_withdrawals", "net_deposit")},
{_r("CAST(net_deposit AS DOUBLE) / nullif(CAST(total_deposits AS DOUBLE), 0)", "house_margin")}, {_money("total_bets")}, active_players
FROM (SELECT *, total_deposits - total_withdrawals AS net_deposit FROM (
  SELECT sum(CASE WHEN transaction_type = 'deposit' THEN amount ELSE 0 END) AS total_deposits,
         sum(CASE WHEN transaction_type = 'withdraw' THEN amount ELSE 0 END) AS total_withdrawals,
         sum(CASE WHEN transaction_type = 'bet' THEN amount ELSE 0 END) AS total_bets,
         count(DISTINCT player_id) AS active_players
  FROM transactions WHERE {where}))"""


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _profile(col: str, dtype: str, numeric: bool) -> str:
    nothing = "CAST(NULL AS DOUBLE)"
    low, high, mean = (
        (f"CAST(min({col}) AS DOUBLE)", f"CAST(max({col}) AS DOUBLE)", f"round(avg(CAST({col} AS DOUBLE)), 6)")
        if numeric else (nothing, nothing, nothing)
    )
    values = f"(SELECT CAST({col} AS VARCHAR) AS v, count(*) AS n FROM transactions WHERE {col} IS NOT NULL GROUP BY 1)"
    categories = "CAST(NULL AS VARCHAR)" if numeric else (
        f"(SELECT CASE WHEN count(*) <= 8 THEN string_agg(v || '=' || n, '|' ORDER BY v) END FROM {values})"
    )
    return f"""SELECT '{col}' AS column_name, '{dtype}' AS data_type, count(*) AS n_rows,
count(*) - count({col}) AS n_nulls, count(DISTINCT {col}) AS n_distinct,
(SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT v FROM {values} ORDER BY v LIMIT 3)) AS examples,
{low} AS min_value, {high} AS max_value, {mean} AS mean_value, {categories} AS categories FROM transactions"""


def _cardinality(source: str, table: str, col: str) -> str:
    return f"""SELECT '{source}' AS source, '{col}' AS column_name, count(DISTINCT {col}) AS n_distinct,
CAST(NULL AS VARCHAR) AS value, CAST(NULL AS BIGINT) AS n FROM {table}"""


def _members(source: str, table: str, col: str) -> str:
    return f"""SELECT '{source}', '{col}', (SELECT count(DISTINCT {col}) FROM {table}), CAST({col} AS VARCHAR), count(*)
FROM {table} WHERE {col} IS NOT NULL GROUP BY {col}"""


def _duplicates(name: str, table: str, cols: str) -> str:
    return f"""SELECT '{name}' AS check_name, (SELECT count(*) FROM {table}) AS n_rows, count(*) AS distinct_rows,
(SELECT count(*) FROM {table}) - count(*) AS duplicate_rows FROM (SELECT DISTINCT {cols} FROM {table})"""


def _fresh(source: str, table: str, ts: str, warn_hours: int, error_hours: int) -> str:
    age = "TIMESTAMP '2024-02-01' - max_loaded_at"
    return f"""SELECT '{source}' AS source, max_loaded_at,
date_sub('second', CAST(max_loaded_at AS TIMESTAMP), TIMESTAMP '2024-02-01') AS age_seconds,
CASE WHEN {age} > INTERVAL {error_hours} HOUR THEN 'error' WHEN {age} > INTERVAL {warn_hours} HOUR THEN 'warn'
ELSE 'pass' END AS status FROM (SELECT CAST(max({ts}) AS TIMESTAMP) AS max_loaded_at FROM {table})"""


def _check(name: str, severity: str, failing: str) -> str:
    return f"""SELECT '{name}' AS check_name, '{severity}' AS severity, count(*) AS failures,
CASE WHEN count(*) = 0 THEN 'pass' ELSE '{severity}' END AS status FROM ({failing})"""


def _finding(step: int, label: str, n: str, note: str) -> str:
    return f"SELECT CAST({step} AS BIGINT) AS step, '{label}' AS finding, CAST({n} AS BIGINT) AS n, {note} AS note"


_ORPHANS = {
    "sessions": "(SELECT count(*) FROM sessions s WHERE NOT EXISTS (SELECT 1 FROM players p WHERE p.player_id = s.player_id))",
    "tx": "(SELECT count(*) FROM transactions s WHERE NOT EXISTS (SELECT 1 FROM players p WHERE p.player_id = s.player_id))",
    "aff": "(SELECT count(DISTINCT player_id) FROM affiliate s WHERE NOT EXISTS (SELECT 1 FROM players p WHERE p.player_id = s.player_id))",
}

_DISCOVERY = _union([
    _finding(1, "email uppercase -> normalize (not dedup)",
             "(SELECT count(*) FROM players WHERE regexp_matches(email, '[A-Z]'))",
             "(SELECT 'distinct raw=' || count(DISTINCT email) || ' = lowercased=' || count(DISTINCT lower(email)) || ', so no real duplicate' FROM players)"),
    _finding(2, "orphan child player_ids (referential integrity)", " + ".join(_ORPHANS.values()),
             f"'sessions=' || {_ORPHANS['sessions']} || ', transactions=' || {_ORPHANS['tx']} || ', affiliate=' || {_ORPHANS['aff']}"),
    _finding(3, "real FTD: players with an actual deposit", "(SELECT count(*) FROM depositors)", "'earliest deposit per player'"),
    _finding(4, "qualified FTD: deposited AND bets >= baseline(800)", "(SELECT count(*) FROM qualified)",
             "(SELECT 'of ' || count(*) || ' that deposited, ' || count(b.player_id) || ' also placed bets' FROM depositors d LEFT JOIN bets b USING (player_id))"),
    _finding(5, "transactions before created_at (impossible)",
             "(SELECT count(*) FROM transactions JOIN players USING (player_id) WHERE txn_ts < CAST(created_at AS TIMESTAMP))",
             "'checked on every load'"),
    _finding(6, "withdrawals before first deposit (impossible)",
             "(SELECT count(*) FROM transactions JOIN first_deposit USING (player_id) WHERE transaction_type = 'withdraw' AND txn_ts < first_deposit_ts)",
             "'checked on every load'"),
    _finding(7, "players tagged with >1 country (multi-tagging)", "(SELECT count(*) FROM countries WHERE n_countries > 1)", "'DQ / fraud smell'"),
    _finding(8, "affiliate ftd > registrations (impossible funnel)", "(SELECT count(*) FROM affiliate WHERE ftd > registrations)", "'checked on every load'"),
    _finding(9, "affiliate registrations > clicks (impossible funnel)", "(SELECT count(*) FROM affiliate WHERE registrations > clicks)", "'checked on every load'"),
    _finding(10, "duplicate (affiliate, player) rows (conflated grain)",
             "(SELECT count(*) FROM affiliate) - (SELECT count(*) FROM (SELECT DISTINCT affiliate_id, player_id FROM affiliate))",
             "'resolved by attribution'"),
])

_FEATURES = _union([
    _finding(1, "net-negative players (withdrew > deposited)",
             "(SELECT count(*) FROM financials WHERE total_withdrawals > total_deposits)", "'the house paid out more than it took'"),
    _finding(2, "AML low-play: bet_ratio < 0.2 AND withdrew", "(SELECT count(*) FROM scored WHERE s_aml_low_play)",
             "'deposit, barely bet, cash out'"),
    _finding(3, "deposited but never placed a bet", "(SELECT count(*) FROM financials WHERE total_deposits > 0 AND n_bets = 0)",
             "'money in, no play'"),
    _finding(4, "players with > 48 distinct IPs (IP velocity)", "(SELECT count(*) FROM activity WHERE distinct_ips > 48)",
             "'max distinct IPs for one player = ' || (SELECT max(distinct_ips) FROM activity)"),
    _finding(5, "IPs shared by > 1 player (multi-accounting)",
             "(SELECT count(*) FROM (SELECT ip FROM sessions GROUP BY ip HAVING count(DISTINCT player_id) > 1))",
             "'one address, several accounts'"),
    _finding(6, "players with session span > 28 days (dormancy base)",
             "(SELECT count(*) FROM activity WHERE active_span_days > 28)", "'distance between first and last session'"),
])

_WALLETS = """(SELECT player_id, min(running_balance) AS low, min(txn_ts) AS first_ts,
min(CASE WHEN transaction_type = 'deposit' THEN txn_ts END) AS dep_ts FROM ledger GROUP BY player_id)"""
_RECONCILE = _union([
    _finding(1, "players whose running balance goes NEGATIVE (conservative, no win data)",
             f"(SELECT count(*) FROM {_WALLETS} WHERE low < 0)",
             f"'worst reconstructed balance = ' || (SELECT CAST(CAST(min(low) AS DECIMAL(28,2)) AS VARCHAR) FROM {_WALLETS})"),
    _finding(2, "UNAMBIGUOUS: money-out (bet/withdraw) BEFORE the first deposit",
             f"(SELECT count(*) FROM {_WALLETS} WHERE dep_ts IS NULL OR first_ts < dep_ts)", "'impossible whatever the bets won'"),
    _finding(3, "players who never deposited at all but still transacted",
             f"(SELECT count(*) FROM {_WALLETS} WHERE dep_ts IS NULL)", "'no funding at any time'"),
])

_CREDITED = "(SELECT cpa_value, coalesce(net_deposit, 0) AS net FROM attribution LEFT JOIN financials USING (player_id))"
_DASHBOARD = _union([
    f"SELECT CAST({i} AS BIGINT) AS step, '{label}' AS kpi, {_r(value, 'value')}"
    for i, (label, value) in enumerate([
        ("Affiliate Metrics: CPA owed (R$)", f"(SELECT sum(cpa_value) FROM {_CREDITED})"),
        ("Affiliate Metrics: real revenue of attributed players (R$)", f"(SELECT sum(net) FROM {_CREDITED})"),
        ("Affiliate Metrics: ROI (revenue / CPA)",
         f"(SELECT round(CAST(sum(net) AS DOUBLE) / CAST(sum(cpa_value) AS DOUBLE), 2) FROM {_CREDITED})"),
        ("Financial Signals: total deposits (R$)", "(SELECT sum(total_deposits) FROM financials)"),
        ("Financial Signals: total withdrawals (R$)", "(SELECT sum(total_withdrawals) FROM financials)"),
        ("Financial Signals: house net deposit (R$)", "(SELECT sum(net_deposit) FROM financials)"),
        ("Financial Signals: low-play + withdrew players", "(SELECT count(*) FROM scored WHERE s_aml_low_play)"),
    ], start=1)
])

_PAIR_DUPES = "SELECT affiliate_id, player_id, count(*) AS n_records FROM affiliate GROUP BY ALL HAVING count(*) > 1"
_BAD_DEVICE = """SELECT device AS value, count(*) AS n_records FROM sessions
WHERE device NOT IN ('signup', 'purchase', 'view', 'click') GROUP BY device"""
_FTD_REG = "SELECT affiliate_id, player_id, ftd, registrations FROM affiliate WHERE ftd > registrations"

_PER_PLAYER = """(SELECT a.player_id, min_by(cpa_value, (file_no, line_no, affiliate_id, cpa_value)) AS first_cpa,
count(DISTINCT CASE WHEN ftd > 0 THEN affiliate_id END) AS claimants FROM affiliate_o a GROUP BY a.player_id)"""
_BEST = "(SELECT player_id, cpa_value FROM claims WHERE pick = 1)"
_REAL = "IN (SELECT player_id FROM depositors)"
_RULES = {
    "r1_players": f"SELECT count(*) FROM {_PER_PLAYER}",
    "r1_cpa": f"SELECT sum(first_cpa) FROM {_PER_PLAYER}",
    "r2_players": f"SELECT count(*) FROM {_BEST}",
    "r2_cpa": f"SELECT sum(cpa_value) FROM {_BEST}",
    "r3_players": f"SELECT count(*) FROM {_BEST} WHERE player_id {_REAL}",
    "r3_cpa": f"SELECT sum(cpa_value) FROM {_BEST} WHERE player_id {_REAL}",
    "ghosts_excluded": f"SELECT count(*) FROM {_BEST} WHERE NOT player_id {_REAL}",
    "overcount_avoided": f"SELECT coalesce(sum(cpa_value), 0) FROM {_BEST} WHERE NOT player_id {_REAL}",
    "depositors_without_affiliate": "SELECT count(*) FROM depositors WHERE player_id NOT IN (SELECT player_id FROM affiliate)",
    "tiebreak_decided": f"SELECT count(*) FROM {_PER_PLAYER} WHERE claimants > 1 AND player_id {_REAL}",
}
_ACTIVE_MONTHS = "(SELECT DISTINCT player_id, date_trunc('month', txn_ts) AS m FROM transactions)"

QUERIES: dict[str, str] = {
    "volume_baseline": _union([
        f"SELECT '{name}' AS source, count(*) AS n_rows FROM {table}"
        for name, table in [("players", "players"), ("sessions", "sessions"), ("transactions", "transactions"),
                            ("affiliate_cpa_ftd", "affiliate")]]),
    "incremental_window": f"""SELECT transaction_id, player_id, transaction_type, {_money("amount")}, txn_ts FROM transactions
WHERE txn_ts >= (SELECT max(txn_ts) FROM transactions WHERE transaction_type = 'deposit') - INTERVAL 3 DAY""",
    "merge_upsert": f"""SELECT transaction_id, player_id, transaction_type,
{_r("CASE WHEN transaction_type = 'deposit' THEN amount ELSE amount + 1000 END", "amount")} FROM transactions""",
    "insert_overwrite": """SELECT session_id, player_id, ip, CASE WHEN CAST(session_ts AS DATE) >=
(SELECT max(CAST(session_ts AS DATE)) FROM sessions) - INTERVAL 3 DAY THEN upper(device) ELSE device END AS device,
session_ts, CAST(session_ts AS DATE) AS session_date FROM sessions""",
    "schema_evolution": f"""SELECT transaction_id, {_money("amount")},
CASE WHEN transaction_type <> 'deposit' THEN transaction_type END AS transaction_type FROM transactions""",
    "stg_players": "SELECT player_id, email, city, created_at FROM players",
    "stg_sessions": "SELECT session_id, player_id, ip, device, session_ts FROM sessions",
    "stg_transactions": f"""SELECT transaction_id, player_id, type AS transaction_type,
{_r("TRY_CAST(amount AS DECIMAL(18,2))", "amount")}, TRY_CAST(timestamp AS TIMESTAMP) AS txn_ts FROM raw_tx""",
    "stg_affiliate": f"""SELECT affiliate_id, player_id, country,
CASE WHEN regexp_full_match(clicks, '[0-9]+') THEN TRY_CAST(clicks AS BIGINT) END AS clicks,
registrations, ftd, {_money("cpa_value")} FROM raw_aff""",
    "cast_failures": _union([
        f"SELECT '{c}' AS column_name, {n} AS failures" for c, n in [
            ("amount", "(SELECT count(*) FROM raw_tx WHERE TRY_CAST(amount AS DECIMAL(18,2)) IS NULL)"), ("txn_ts", "0"),
            ("clicks", "(SELECT count(*) FROM raw_aff WHERE clicks LIKE '%.%')"),
            ("registrations", "0"), ("ftd", "0"), ("cpa_value", "0")]]),
    "players_conformed": "SELECT player_id, lower(email) AS email, city, created_at FROM players",
    "first_deposit": f"SELECT player_id, first_deposit_ts, deposit_count, {_money('total_deposits')} FROM first_deposit",
    "qualified_ftd": f"SELECT player_id, first_deposit_ts, {_money('total_bets')}, is_qualified FROM qualified_ftd",
    "affiliate_attribution": f"SELECT player_id, affiliate_id, acquisition_country, {_money('cpa_value')} FROM attribution",
    "player_financials": f"SELECT {_FIN} FROM financials",
    "player_activity": "SELECT * FROM activity",
    "player_ledger": f"SELECT {_LEDGER} FROM ledger",
    "dim_date": """SELECT date_day, year(date_day) AS year, quarter(date_day) AS quarter, month(date_day) AS month,
day(date_day) AS day, dayofweek(date_day) + 1 AS day_of_week, dayname(date_day) AS day_name,
strftime(date_day, '%Y-%m') AS year_month, dayofweek(date_day) IN (0, 6) AS is_weekend FROM days""",
    "dim_player": "SELECT * FROM dim_player",
    "dim_affiliate": """SELECT affiliate_id, count(DISTINCT player_id) AS n_players_claimed,
count(DISTINCT country) AS n_acquisition_countries, any_value(primary_country) AS primary_country
FROM affiliate LEFT JOIN (SELECT affiliate_id, country AS primary_country FROM (
  SELECT affiliate_id, country, row_number() OVER (PARTITION BY affiliate_id ORDER BY count(*) DESC, country) AS rn
  FROM affiliate GROUP BY affiliate_id, country) WHERE rn = 1) USING (affiliate_id) GROUP BY affiliate_id""",
    "fct_transactions": f"SELECT {_LEDGER}, CAST(txn_ts AS DATE) AS txn_date FROM ledger",
    "fct_sessions": "SELECT *, CAST(session_ts AS DATE) AS session_date FROM sessions",
    "affiliate_performance": f"SELECT affiliate_id, qualified_ftds, {_money('cpa_owed', 'real_revenue', 'roi')}, ghost_ftds FROM performance",
    "fraud_signals": "SELECT * FROM fraud",
    "sig_ghost_ftd": """SELECT DISTINCT player_id, player_id IN (SELECT player_id FROM ghosts) AS s_ghost_ftd FROM affiliate""",
    "sig_aml_low_play": "SELECT player_id, s_aml_low_play FROM scored JOIN financials USING (player_id)",
    "sig_ip_velocity": "SELECT player_id, distinct_ips > 48 AS s_ip_velocity FROM activity",
    "sig_ledger_anomaly": "SELECT player_id, transaction_type <> 'deposit' AS s_ledger_anomaly FROM opening",
    "sig_net_negative": "SELECT player_id, net_deposit < 0 AS s_net_negative FROM financials",
    "sig_structuring": "SELECT player_id, n_round >= 3 AS s_structuring FROM rounds",
    "sig_geo_conflict": "SELECT player_id, n_countries > 1 AS s_geo_conflict FROM countries",
    "sig_device_takeover": "SELECT player_id, distinct_devices >= 3 AS s_device_takeover FROM activity",
    "sig_reg_velocity": "SELECT player_id, player_id IN (SELECT player_id FROM burst) AS s_reg_velocity FROM players",
    "sig_dormant": "SELECT player_id, active_span_days > 28 AS s_dormant FROM activity",
    "risk_score": "SELECT player_id, risk_score, risk_tier FROM fraud",
    "silver_discovery": _DISCOVERY,
    "silver_feature_scan": _FEATURES,
    "ledger_reconciliation": _RECONCILE,
    "fraud_signal_scan": _union([
        f"""SELECT CAST({i} AS BIGINT) AS step, '{label}' AS signal, count(*) FILTER ({flag}) AS players_flagged,
{_r(f"coalesce(sum(value_at_risk) FILTER ({flag}), 0)", "value_at_risk")} FROM fraud"""
        for i, (label, flag) in enumerate(_SCAN, start=1)]),
    "dashboard_metrics": _DASHBOARD,
    "dq_unique": _PAIR_DUPES,
    "dq_not_null": """SELECT transaction_id, player_id, type AS transaction_type, CAST(NULL AS DOUBLE) AS amount,
CAST(timestamp AS TIMESTAMP) AS txn_ts FROM raw_tx WHERE TRY_CAST(amount AS DECIMAL(18,2)) IS NULL""",
    "dq_accepted_values": _BAD_DEVICE,
    "dq_relationships": """SELECT player_id AS value, count(*) AS n_records FROM sessions
WHERE player_id NOT IN (SELECT player_id FROM attribution) GROUP BY player_id""",
    "dq_between": "SELECT player_id, value_at_risk FROM fraud WHERE value_at_risk < 0 OR value_at_risk > 1500",
    "dq_freshness": _union([
        _fresh("players", "players", "created_at", 25, 48), _fresh("sessions", "sessions", "session_ts", 25, 48),
        _fresh("transactions", "transactions", "txn_ts", 1, 2)]),
    "dq_volume_anomaly": f"""SELECT day, n_rows, {_r("mean_rows", "mean_rows")}, {_r("sd_rows", "sd_rows")},
{_r("(n_rows - mean_rows) / sd_rows", "z_score")}
FROM (SELECT day, n_rows, count(*) OVER w AS history, avg(n_rows) OVER w AS mean_rows, stddev_samp(n_rows) OVER w AS sd_rows
  FROM (SELECT d.day, coalesce(c.n, 0) AS n_rows FROM (
      SELECT CAST(unnest(generate_series(min(CAST(txn_ts AS DATE)), max(CAST(txn_ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day
      FROM transactions) d
    LEFT JOIN (SELECT CAST(txn_ts AS DATE) AS day, count(*) AS n FROM transactions GROUP BY 1) c USING (day))
  WINDOW w AS (ORDER BY day ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))
WHERE history >= 14 AND sd_rows > 0 AND abs(n_rows - mean_rows) / sd_rows > 3""",
    "dq_suite": _union([
        _check("transaction_id unique", "error", "SELECT transaction_id FROM transactions GROUP BY 1 HAVING count(*) > 1"),
        _check("affiliate pairs unique", "warn", _PAIR_DUPES),
        _check("device accepted", "error", _BAD_DEVICE),
        _check("transaction refers to a player", "error",
               "SELECT DISTINCT player_id FROM transactions WHERE player_id NOT IN (SELECT player_id FROM players)"),
        _check("ftd <= registrations", "warn", _FTD_REG)]),
    "slo_pass_rates": _union([
        f"SELECT '{rule}' AS rule, {_r(rate, 'pass_rate')}" for rule, rate in [
            ("referential integrity", f"CASE WHEN {_ORPHANS['sessions']} + {_ORPHANS['tx']} = 0 THEN 1 ELSE 0 END"),
            ("amount > 0", "(SELECT avg(CAST(amount > 0 AS INT)) FROM transactions)"),
            ("ftd <= registrations", "(SELECT avg(CAST(ftd <= registrations AS INT)) FROM affiliate)"),
            ("no transaction before created_at",
             "(SELECT avg(CAST(CAST(txn_ts AS DATE) >= created_at AS INT)) FROM transactions JOIN players USING (player_id))")]]),
    "assert_amount_positive": f"SELECT transaction_id, {_r('amount - 100', 'amount')} FROM transactions WHERE amount - 100 <= 0",
    "assert_counts_non_negative": f"""SELECT affiliate_id, player_id, clicks - 25 AS clicks, registrations, ftd, {_money("cpa_value")}
FROM affiliate WHERE clicks - 25 < 0 OR registrations < 0 OR ftd < 0 OR cpa_value < 0""",
    "assert_no_future_ts": """SELECT 'stg_sessions' AS model, session_id AS id, session_ts AS ts FROM sessions
WHERE session_ts > TIMESTAMP '2024-01-15' UNION ALL
SELECT 'stg_transactions', transaction_id, txn_ts FROM transactions WHERE txn_ts > TIMESTAMP '2024-01-15'""",
    "assert_ftd_le_registrations": _FTD_REG,
    "assert_registrations_le_clicks": "SELECT affiliate_id, player_id, registrations, clicks FROM affiliate WHERE registrations > clicks",
    "assert_first_txn_deposit": "SELECT player_id, transaction_type FROM opening WHERE transaction_type <> 'deposit'",
    "assert_no_txn_before_created": """SELECT transaction_id, player_id, txn_ts, created_at
FROM transactions JOIN players USING (player_id) WHERE txn_ts < CAST(created_at AS TIMESTAMP)""",
    "assert_qualified_rule": f"""SELECT player_id, {_money("total_bets")} FROM qualified_ftd
WHERE is_qualified AND (first_deposit_ts IS NULL OR total_bets < 900)""",
    "assert_cpa_qualified": """SELECT CAST(agg_total AS BIGINT) AS agg_total, attr_total FROM (
SELECT (SELECT sum(qualified_ftds + 1) FROM performance) AS agg_total, (SELECT count(DISTINCT player_id) FROM attribution) AS attr_total)
WHERE agg_total <> attr_total""",
    "assert_fraud_profile_complete": "SELECT player_id FROM dim_player WHERE player_id NOT IN (SELECT player_id FROM sessions)",
    "assert_risk_score": "SELECT player_id, risk_score + 1 AS risk_score FROM fraud WHERE s_dormant",
    "assert_running_balance": f"""SELECT transaction_id, {_r("running_balance + 1", "running_balance")},
{_r("running_balance", "recomputed")} FROM ledger WHERE transaction_type = 'bet'""",
    "column_profile": _union([
        _profile("transaction_id", "string", False), _profile("player_id", "string", False),
        _profile("transaction_type", "string", False), _profile("amount", "decimal(18,2)", True),
        _profile("txn_ts", "timestamp", False)]),
    "children_per_player": _union([
        f"""SELECT '{name}' AS source, min(n) AS min_children, {_r("avg(n)", "mean_children")}, max(n) AS max_children
FROM (SELECT count(*) AS n FROM {name} GROUP BY player_id)""" for name in ("sessions", "transactions", "affiliate")]),
    "affiliates_per_player": """SELECT max(n) AS max_distinct
FROM (SELECT count(DISTINCT affiliate_id) AS n FROM affiliate GROUP BY player_id)""",
    "coverage_gaps": _union([
        f"""SELECT '{name}' AS source, count(*) AS players_missing FROM players
WHERE player_id NOT IN (SELECT player_id FROM {name})""" for name in ("sessions", "transactions", "affiliate")]),
    "time_windows": _union([
        f"""SELECT '{name}' AS source, CAST(min({ts}) AS DATE) AS first_day, CAST(max({ts}) AS DATE) AS last_day,
date_sub('day', CAST(min({ts}) AS TIMESTAMP), CAST(max({ts}) AS TIMESTAMP)) AS span_days FROM {table}"""
        for name, table, ts in [("players.created_at", "players", "created_at"),
                                ("sessions.session_ts", "sessions", "session_ts"),
                                ("transactions.txn_ts", "transactions", "txn_ts")]]),
    "totals_by_type": f"SELECT transaction_type, count(*) AS n, {_r('sum(amount)', 'total_amount')} FROM transactions GROUP BY 1",
    "money_pivot": f"""SELECT player_id, {_r("total_deposits", "deposit")}, {_r("total_withdrawals", "withdraw")},
{_r("total_bets", "bet")} FROM financials""",
    "impossible_flows": """SELECT count(*) FILTER (total_withdrawals > 0 AND total_deposits = 0) AS withdrew_without_deposit,
count(*) FILTER (total_bets > 0 AND total_deposits = 0) AS bet_without_deposit,
count(*) FILTER (total_withdrawals > total_deposits) AS withdrew_more_than_deposited,
count(*) FILTER (total_deposits > 0 AND total_bets = 0) AS deposited_without_bet FROM financials""",
    "players_per_ip": "SELECT ip, count(DISTINCT player_id) AS n_players FROM sessions GROUP BY ip",
    "multi_account_summary": """SELECT (SELECT count(DISTINCT ip) FROM sessions) AS distinct_ips,
(SELECT count(*) FROM (SELECT ip FROM sessions GROUP BY ip HAVING count(DISTINCT player_id) > 1)) AS shared_ips,
(SELECT count(*) FROM sessions) AS n_sessions,
(SELECT count(*) FROM activity WHERE distinct_ips > 1) AS players_on_many_ips,
(SELECT max(distinct_ips) FROM activity) AS max_ips_per_player,
(SELECT count(*) FROM activity WHERE distinct_devices > 1) AS players_on_many_devices""",
    "claimed_vs_real_ftd": f"""SELECT {_r("(SELECT avg(CAST(ftd > registrations AS INT)) FROM affiliate)", "share_ftd_gt_registrations")},
{_r("(SELECT avg(CAST(registrations > clicks AS INT)) FROM affiliate)", "share_registrations_gt_clicks")},
(SELECT count(*) FROM affiliate WHERE ftd > 0 AND registrations = 0) AS claims_without_registrations,
{_r("(SELECT sum(cpa_value) FROM affiliate)", "naive_cpa")},
(SELECT count(*) FROM (SELECT player_id FROM affiliate GROUP BY 1 HAVING sum(ftd) > 0)) AS claimed_players,
(SELECT count(*) FROM depositors) AS real_depositors,
(SELECT count(*) FROM (SELECT player_id FROM affiliate GROUP BY 1 HAVING sum(ftd) > 0)
 WHERE player_id NOT IN (SELECT player_id FROM depositors)) AS ghost_players,
(SELECT count(*) FROM (SELECT player_id FROM affiliate GROUP BY 1 HAVING count(DISTINCT affiliate_id) > 1)) AS players_with_many_affiliates""",
    "attribution_rules": _union([f"SELECT '{m}' AS metric, {_r(f'({sql})', 'value')}" for m, sql in _RULES.items()]),
    "join_fanout": f"""SELECT (SELECT count(*) FROM transactions) AS rows_before,
{_r("(SELECT sum(amount) FROM transactions)", "sum_before")}, count(*) AS rows_after, {_r("sum(t.amount)", "sum_after")}
FROM transactions t LEFT JOIN affiliate USING (player_id)""",
    "logical_duplicates": _union([
        _duplicates("sessions (player, timestamp)", "sessions", "player_id, session_ts"),
        _duplicates("transactions (player, type, amount, timestamp)", "transactions", "player_id, transaction_type, amount, txn_ts"),
        _duplicates("affiliate (affiliate, player)", "affiliate", "affiliate_id, player_id"),
        _duplicates("affiliate full row", "affiliate", "*")]),
    "affiliate_grain": f"""SELECT min_rows, {_r("median_rows", "median_rows")}, max_rows,
{_r("(SELECT avg(clicks) FROM affiliate)", "mean_clicks")}, players_with_many_rows, players_with_differing_clicks
FROM (SELECT min(n) AS min_rows, median(n) AS median_rows, max(n) AS max_rows FROM (SELECT count(*) AS n FROM affiliate GROUP BY affiliate_id)),
(SELECT count(*) FILTER (n > 1) AS players_with_many_rows, count(*) FILTER (n > 1 AND d > 1) AS players_with_differing_clicks
 FROM (SELECT count(*) AS n, count(DISTINCT clicks) AS d FROM affiliate GROUP BY player_id))""",
    "ts_granularity": """SELECT 'players.created_at' AS source, 'date-only' AS granularity, false AS has_offset, count(*) AS n_rows FROM players
UNION ALL SELECT 'sessions.timestamp', 'sub-second', false, count(*) FROM sessions
UNION ALL SELECT 'transactions.timestamp', 'second', false, count(*) FROM transactions""",
    "load_controls": """SELECT 'players' AS source, count(*) AS n_rows, count(*) = count(DISTINCT player_id) AS unique_key,
'created_at:date' AS watermark, false AS has_updated_at FROM players
UNION ALL SELECT 'sessions', count(*), count(*) = count(DISTINCT session_id), 'session_ts:timestamp', false FROM sessions
UNION ALL SELECT 'transactions', count(*), count(*) = count(DISTINCT transaction_id), 'txn_ts:timestamp', false FROM transactions
UNION ALL SELECT 'affiliate', count(*), count(*) = count(DISTINCT affiliate_id), NULL, false FROM affiliate""",
    "cardinalities": _union([
        _cardinality("players", "players", "player_id"), _members("players", "players", "city"),
        _members("sessions", "sessions", "device"), _cardinality("sessions", "sessions", "ip"),
        _members("transactions", "transactions", "transaction_type"),
        _cardinality("affiliate", "affiliate", "affiliate_id"), _members("affiliate", "affiliate", "country")]),
    "fact_shape": _union([
        f"""SELECT '{name}' AS source, count(*) AS n_rows, max(CAST({ts} AS DATE)) - min(CAST({ts} AS DATE)) AS span_days,
count(DISTINCT player_id) AS n_keys FROM {name}""" for name, ts in [("transactions", "txn_ts"), ("sessions", "session_ts")]]),
    "kpi_fraud": _kpi_fraud("true"),
    "kpi_fraud_sliced": _kpi_fraud("risk_score BETWEEN 2 AND 5"),
    "kpi_investigation": """SELECT player_id, city, acquisition_country, risk_tier, risk_score, value_at_risk
FROM fraud JOIN dim_player USING (player_id)""",
    "kpi_by_signal": _union([
        f"""SELECT '{name}' AS signal, count(*) FILTER ({name}) AS players_flagged, CAST({i} AS BIGINT) AS position, '{group}' AS signal_group
FROM scored""" for i, (name, group) in enumerate(_SIGNALS, start=1)]),
    "kpi_var_by_country": f"""SELECT acquisition_country, {_r("sum(value_at_risk)", "value_at_risk")}
FROM fraud JOIN dim_player USING (player_id) GROUP BY 1""",
    "kpi_acquisition": f"""SELECT registered_players, depositors, {_r("depositors / registered_players", "ftd_rate")},
{_money("turnover")}, {_r("CAST(revenue AS DOUBLE) / active_players", "arpu")}, {_r("one_and_done / depositors", "pct_one_and_done")}
FROM (SELECT (SELECT count(*) FROM dim_player) AS registered_players, (SELECT count(first_deposit_ts) FROM dim_player) AS depositors,
(SELECT count(*) FROM dim_player WHERE is_one_and_done) AS one_and_done, (SELECT sum(total_bets) FROM financials) AS turnover,
(SELECT count(*) FROM financials) AS active_players, (SELECT sum(real_revenue) FROM performance) AS revenue)""",
    "kpi_retention": f"""SELECT strftime(axis.m, '%Y-%m') AS year_month, coalesce(now.n, 0) AS active_players,
       coalesce(past.n, 0) AS previous_active, coalesce(stayed.n, 0) AS retained_players,
       {_r("coalesce(stayed.n, 0) / nullif(coalesce(past.n, 0), 0)", "retention_rate")}
FROM (SELECT CAST(unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS DATE) AS m FROM {_ACTIVE_MONTHS}) axis
LEFT JOIN (SELECT CAST(m AS DATE) AS m, count(*) AS n FROM {_ACTIVE_MONTHS} GROUP BY m) now ON now.m = axis.m
LEFT JOIN (SELECT CAST(m AS DATE) AS m, count(*) AS n FROM {_ACTIVE_MONTHS} GROUP BY m) past ON past.m = axis.m - INTERVAL 1 MONTH
LEFT JOIN (SELECT CAST(c.m AS DATE) AS m, count(*) AS n FROM {_ACTIVE_MONTHS} c
           JOIN {_ACTIVE_MONTHS} p ON c.player_id = p.player_id AND p.m = c.m - INTERVAL 1 MONTH GROUP BY c.m) stayed ON stayed.m = axis.m""",
    "kpi_acquisition_by_country": f"""SELECT acquisition_country, count(*) AS registered_players, count(first_deposit_ts) AS depositors,
{_r("count(first_deposit_ts) / count(*)", "ftd_rate")},
{_r("CAST(sum(CASE WHEN acquisition_affiliate_id IS NOT NULL THEN net_deposit END) AS DOUBLE) / nullif(count(net_deposit), 0)", "arpu")}
FROM dim_player LEFT JOIN financials USING (player_id) GROUP BY acquisition_country""",
    "kpi_affiliate": f"""SELECT CAST(q AS BIGINT) AS qualified_ftds, CAST(g AS BIGINT) AS ghost_ftds, {_r("c", "cpa_owed")},
{_r("r", "real_revenue")}, {_r("g / (g + q)", "ghost_rate")}, {_r("CAST(r AS DOUBLE) / CAST(c AS DOUBLE)", "roi")}
FROM (SELECT sum(qualified_ftds) AS q, sum(ghost_ftds) AS g, sum(cpa_owed) AS c, sum(real_revenue) AS r FROM performance)""",
    "kpi_affiliate_detail": f"""SELECT affiliate_id, qualified_ftds, {_money("cpa_owed", "real_revenue", "roi")}, ghost_ftds,
{_r("ghost_ftds / (ghost_ftds + qualified_ftds)", "ghost_rate")} FROM performance""",
    "kpi_financial": _kpi_financial("true"),
    "kpi_financial_sliced": _kpi_financial("CAST(txn_ts AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"),
    "kpi_daily_flow": f"""SELECT date_day, {_r("coalesce(sum(amount) FILTER (transaction_type = 'deposit'), 0)", "total_deposits")},
{_r("coalesce(sum(amount) FILTER (transaction_type = 'withdraw'), 0)", "total_withdrawals")}
FROM days LEFT JOIN transactions ON CAST(txn_ts AS DATE) = date_day GROUP BY date_day""",
    "kpi_financial_by_country": f"""SELECT acquisition_country, {_r("sum(total_deposits)", "total_deposits")},
{_r("sum(total_withdrawals)", "total_withdrawals")}, {_r("sum(net_deposit)", "net_deposit")}, {_r("sum(total_bets)", "total_bets")}
FROM financials JOIN dim_player USING (player_id) GROUP BY 1""",
}

ORACLES: dict[str, str] = {name: f"{BASE}{sql}" for name, sql in QUERIES.items()}
