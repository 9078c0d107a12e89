"""Independent ANSI-SQL formulation of every registered query, for DuckDB.

Written from the report's definition, not from the Spark plans: plain
GROUP BY / JOIN / EXISTS / window SQL over the fixture views.  DuckDB divides
decimals into DOUBLE, so tonnes are computed as ``x * 0.001`` (exact decimal)
and averages in whole numbers, rounded once.
"""

from __future__ import annotations

from ledgerday.sources.fixtures import duckdb_prelude

# Fixed values of the fixture (see sources.fixtures.FIXTURE_ITEMS).
COAL, MAIZE, ETH = "'MEDIUM'", "'STANDARD'", "'LARGE'"
SCRAP = "('SMALL', 'COMMERCIAL SCRAP')"
D, MS, DAY = "DATE '1998-03-17'", "DATE '1998-03-01'", "17"
TODAY, TARGET = "DATE '1998-03-20'", "DATE '1998-03-19'"
RETAIN = 10
CHANNELS = "(VALUES ('email'), ('whatsapp')) AS c(channel)"
REPORTS = (
    ("coal_availability", "Coal Availability (Email) ", "coal_avail_email", "Power Plant Data Not Available", "coal"),
    ("maize_availability", "Maize Availability (Email)", "maize_avail_email", "Production Details Not Available", "maize"),
    ("monthly_report", "MIS Email Monthly", "mis_email_monthly", "Daily MIS Report", None),
)

P = duckdb_prelude()


def _q(ctes: str, select: str) -> str:
    return f"{P}, {ctes}\n{select}" if ctes else f"{P}{select}"


def prod(x: str, compare_upper: bool = True) -> str:
    key = f"upper({x})" if compare_upper else x
    return f"CASE WHEN {key} = {ETH} THEN 'ETHANOL' ELSE upper({x}) END"


def kg(unit: str) -> str:
    return f"upper({unit}) = 'KGS'"


def tonnes(s: str) -> str:
    return f"round(CAST({s} AS DECIMAL(30,3)) * 0.001, 2)"


def _half_up(s: str, by: str) -> str:
    """``s / by`` rounded once to 2 decimals, half away from zero, in whole numbers.

    ``s`` has 3 decimals: hundredths of the quotient are ``s * 1000 / (10 * by)``, and the
    remainder of that whole division decides the rounding.
    """
    n = f"CAST(CAST({s} AS DECIMAL(30,3)) * 1000 AS HUGEINT)"
    return f"CAST(sign({n}) * ((2 * abs({n}) + 10 * {by}) // (20 * {by})) AS DECIMAL(30,0)) * 0.01"


def avg_kg(s: str, day: str) -> str:
    return _half_up(s, f"(1000 * {day})")


def avg_other(s: str, day: str) -> str:
    return _half_up(s, day)


def tot_val(s: str, u: str) -> str:
    return f"CAST(CASE WHEN {kg(u)} THEN {tonnes(s)} ELSE {s} END AS DOUBLE)"


def avg_val(s: str, u: str, day: str) -> str:
    return f"CAST(CASE WHEN {kg(u)} THEN {avg_kg(s, day)} ELSE {avg_other(s, day)} END AS DOUBLE)"


def unit(u: str) -> str:
    return f"CASE WHEN {kg(u)} THEN 'MT' ELSE {u} END"


def numtext(x: str) -> str:
    s = f"CAST({x} AS VARCHAR)"
    s = rf"regexp_replace({s}, '(\.[0-9]*?)0+$', '\1')"
    s = rf"regexp_replace({s}, '\.$', '')"
    return rf"regexp_replace({s}, '^(-?)0\.', '\1.')"


def qtext(num: str, u: str) -> str:
    return f"(coalesce({numtext(num)}, '') || ' ' || coalesce({u}, ''))"


def tot_text(s: str, u: str) -> str:
    return f"CASE WHEN {kg(u)} THEN {qtext(tonnes(s), chr(39) + 'MT' + chr(39))} ELSE {qtext(s, u)} END"


def avg_text(s: str, u: str, day: str) -> str:
    return (
        f"CASE WHEN {kg(u)} THEN {qtext(avg_kg(s, day), chr(39) + 'MT' + chr(39))} "
        f"ELSE {qtext(avg_other(s, day), u)} END"
    )


def row_tonnes(q: str) -> str:
    return f"CAST(CASE WHEN um = 'KGS' THEN {q} * 0.001 ELSE {q} END AS DOUBLE)"


LEDGER_COLS = (
    "vrno, vrdate, tcode, item_name, item_nature, um, aum, CAST(qtyissued AS DOUBLE) AS qtyissued, "
    "CAST(qtyrecd AS DOUBLE) AS qtyrecd, CAST(aqtyissued AS DOUBLE) AS aqtyissued, acc_name"
)

SALES = (
    "sales AS (SELECT * FROM ledger WHERE tcode = 'S' AND nullif(item_nature, '') NOT IN ('SR') "
    f"AND nullif(upper(trim(item_name)), '') NOT IN {SCRAP} AND nullif(acc_name, '') <> 'CANCEL PARTY')"
)

CALENDAR = (
    "days AS (SELECT CAST(unnest(generate_series(CAST(min(vrdate) AS TIMESTAMP), CAST(max(vrdate) AS TIMESTAMP), "
    "INTERVAL 1 DAY)) AS DATE) AS report_date FROM ledger)"
)
READINESS_ALL = (
    f"{CALENDAR}, q AS (SELECT * FROM ledger WHERE tcode = 'Q'), "
    "rc AS (SELECT d.report_date, "
    f"count(*) FILTER (WHERE item_name = {COAL} AND qtyissued > 0) AS coal_rows, "
    f"count(*) FILTER (WHERE item_name = {MAIZE} AND qtyissued > 0) AS maize_rows, "
    f"count(*) FILTER (WHERE item_name = {ETH} AND qtyrecd > 0) AS ethanol_rows "
    "FROM days d LEFT JOIN q ON q.vrdate = d.report_date GROUP BY d.report_date), "
    "readiness AS (SELECT report_date, CAST(coal_rows AS BIGINT) AS coal_rows, CAST(maize_rows AS BIGINT) AS maize_rows, "
    "CAST(ethanol_rows AS BIGINT) AS ethanol_rows, coal_rows > 0 AND maize_rows > 0 AND ethanol_rows > 0 AS ready FROM rc)"
)


def availability(material: str) -> str:
    if material == "ethanol":
        return _q(
            "",
            f"SELECT vrdate, 'ETHANOL' AS item_name, {row_tonnes('qtyrecd')} AS qty_received FROM ledger "
            f"WHERE tcode = 'Q' AND qtyrecd > 0 AND item_name = {ETH}",
        )
    item = COAL if material == "coal" else MAIZE
    return _q(
        "",
        f"SELECT vrdate, {prod('item_name', compare_upper=False)} AS item_name, {row_tonnes('qtyissued')} AS qty_issued "
        f"FROM ledger WHERE tcode = 'Q' AND qtyissued > 0 AND item_name IN ({item})",
    )


def report_select(day: str, keys: str = "") -> str:
    k = f"m.{keys}, " if keys else ""
    return (
        f"SELECT {k}m.product_name, "
        f"CASE WHEN d.product_name IS NULL THEN CAST(0 AS DOUBLE) ELSE {tot_val('d.d_s', 'd.d_aum')} END AS qty, "
        f"CASE WHEN d.product_name IS NOT NULL THEN {unit('d.d_aum')} END AS day_unit, "
        "CAST(coalesce(d.d_n, 0) AS BIGINT) AS no_of_trucks, "
        f"{tot_val('m.m_s', 'm.m_aum')} AS tot_qty, {avg_val('m.m_s', 'm.m_aum', day)} AS avg_qty, "
        f"{unit('m.m_aum')} AS unit, CAST(m.m_n AS BIGINT) AS tot_no_of_trucks, "
        f"CAST(round(m.m_n / {day}) AS BIGINT) AS avg_no_of_trucks "
    )


SINGLE_SIDES = (
    f"{SALES}, "
    f"d AS (SELECT {prod('item_name')} AS product_name, aum AS d_aum, sum(aqtyissued) AS d_s, count(vrno) AS d_n "
    f"FROM sales WHERE vrdate = {D} GROUP BY item_name, aum), "
    f"mu AS (SELECT upper(item_name) AS iu, aum AS m_aum, sum(aqtyissued) AS m_s, count(vrno) AS m_n "
    f"FROM sales WHERE vrdate BETWEEN {MS} AND {D} GROUP BY upper(item_name), aum), "
    f"m AS (SELECT {prod('iu')} AS product_name, m_aum, m_s, m_n FROM mu)"
)

BY_UNIT_SIDES = (
    f"{SALES}, "
    f"d AS (SELECT {prod('item_name')} AS product_name, upper(aum) AS d_aum, sum(aqtyissued) AS d_s, count(vrno) AS d_n "
    f"FROM sales WHERE vrdate = {D} GROUP BY 1, 2), "
    f"m AS (SELECT {prod('item_name')} AS product_name, upper(aum) AS m_aum, sum(aqtyissued) AS m_s, count(vrno) AS m_n "
    f"FROM sales WHERE vrdate BETWEEN {MS} AND {D} GROUP BY 1, 2)"
)

def multi_sides(dates_cte: str) -> str:
    """Day and month sides for every date of a ``dates(report_date)`` CTE, on raw sales lines."""
    return (
        f"{SALES}, {dates_cte}, "
        f"d AS (SELECT t.report_date, {prod('item_name')} AS product_name, aum AS d_aum, sum(aqtyissued) AS d_s, "
        "count(vrno) AS d_n FROM sales JOIN dates t ON sales.vrdate = t.report_date GROUP BY t.report_date, item_name, aum), "
        "mu AS (SELECT t.report_date, upper(item_name) AS iu, aum AS m_aum, sum(aqtyissued) AS m_s, count(vrno) AS m_n "
        "FROM sales JOIN dates t ON sales.vrdate BETWEEN CAST(date_trunc('month', t.report_date) AS DATE) AND t.report_date "
        "GROUP BY t.report_date, upper(item_name), aum), "
        f"m AS (SELECT report_date, {prod('iu')} AS product_name, m_aum, m_s, m_n FROM mu)"
    )


ALL_DATES = (
    "dates AS (SELECT CAST(unnest(generate_series(CAST(min(vrdate) AS TIMESTAMP), CAST(max(vrdate) AS TIMESTAMP), "
    "INTERVAL 1 DAY)) AS DATE) AS report_date FROM ledger)"
)
MULTI_SIDES = multi_sides(ALL_DATES)
MULTI_JOIN = "FROM m LEFT JOIN d ON m.report_date = d.report_date AND m.product_name = d.product_name"

# The daily job for today = 1998-03-20, look-back 7, target 1998-03-19.
PENDING = (
    f"spine AS (SELECT CAST({TODAY} - CAST(i AS INTEGER) AS DATE) AS report_date FROM range(1, 8) AS r(i)), "
    f"pending AS (SELECT c.channel, s.report_date FROM spine s CROSS JOIN {CHANNELS} "
    "WHERE NOT EXISTS (SELECT 1 FROM send_log l WHERE l.channel = c.channel AND l.sent_date = s.report_date))"
)

RUN = (
    f"{PENDING}, "
    f"due AS (SELECT report_date FROM pending UNION SELECT {TARGET}), "
    # count(*) FILTER, not count_if: DuckDB's count_if gives NULL for a group
    # made only of the NULL-extended row of an unmatched date.
    "rd AS (SELECT due.report_date, "
    f"count(*) FILTER (WHERE l.item_name = {COAL} AND l.qtyissued > 0) AS coal_rows, "
    f"count(*) FILTER (WHERE l.item_name = {MAIZE} AND l.qtyissued > 0) AS maize_rows, "
    f"count(*) FILTER (WHERE l.item_name = {ETH} AND l.qtyrecd > 0) AS ethanol_rows "
    "FROM due LEFT JOIN ledger l ON l.vrdate = due.report_date AND l.tcode = 'Q' GROUP BY due.report_date), "
    "dec AS (SELECT rd.report_date, c.channel, CASE WHEN NOT (coal_rows > 0 AND maize_rows > 0 AND ethanol_rows > 0) "
    "THEN 'not_ready' WHEN EXISTS (SELECT 1 FROM send_log l WHERE l.channel = c.channel AND l.sent_date = rd.report_date) "
    f"THEN 'already_sent' ELSE 'send' END AS decision FROM rd CROSS JOIN {CHANNELS})"
)

USABLE = "email IS NOT NULL AND email <> ''"
RECIPIENT_CONTACTS = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, report_name, '{role}' AS role, email FROM report_contacts "
    f"WHERE {USABLE} AND report_name = '{name}' AND {flag}"
    for kind, name, to_flag, _, _ in REPORTS
    for role, flag in (("to", to_flag), ("cc", "is_cc"), ("bcc", "is_bcc"))
)
RECIPIENTS = (
    f"rcon AS ({RECIPIENT_CONTACTS}), "
    "names AS (SELECT * FROM (VALUES " + ", ".join(f"('{r[0]}', '{r[1]}')" for r in REPORTS) + ") AS n(kind, report_name)), "
    "rec AS (SELECT n.kind, n.report_name, "
    + ", ".join(
        f"(SELECT count(*) FROM rcon c WHERE c.kind = n.kind AND c.role = '{role}') AS n_{role}"
        for role in ("to", "cc", "bcc")
    )
    + ", EXISTS (SELECT 1 FROM rcon c WHERE c.kind = n.kind AND c.role = 'to') AS deliverable FROM names n)"
)

MESSAGES = (
    "msgs AS ("
    + " UNION ALL ".join(
        f"SELECT report_date, '{r[0]}' AS kind, '{r[1]}' AS report_name, '{r[3]}' AS title FROM rd WHERE {r[4]}_rows = 0"
        for r in REPORTS
        if r[4]
    )
    + " UNION ALL "
    + " UNION ALL ".join(
        f"SELECT report_date, '{r[0]}', '{r[1]}', '{r[3]}' FROM dec WHERE channel = 'email' AND decision = 'send'"
        for r in REPORTS
        if not r[4]
    )
    + ")"
)

# The channel's document as a list: old dates by seq, then the new ones by date; the last RETAIN stay,
# numbered from 0.  A channel without a new date keeps its rows.
APPEND = (
    "fresh AS (SELECT channel, report_date AS sent_date FROM dec WHERE decision = 'send'), "
    "grown AS (SELECT DISTINCT channel FROM fresh), "
    "doc AS (SELECT channel, list_concat(coalesce((SELECT list(l.sent_date ORDER BY l.seq) FROM send_log l "
    "WHERE l.channel = g.channel), []), (SELECT list(f.sent_date ORDER BY f.sent_date) FROM fresh f "
    "WHERE f.channel = g.channel)) AS dates FROM grown g), "
    f"kept AS (SELECT channel, dates[greatest(1, len(dates) - {RETAIN} + 1):] AS dates FROM doc)"
)


def text_select(day: str, keys: str = "") -> str:
    k = f"m.{keys}, " if keys else ""
    return (
        f"SELECT {k}m.product_name, "
        f"CASE WHEN d.product_name IS NULL THEN '0' ELSE {tot_text('d.d_s', 'd.d_aum')} END AS qty, "
        "CASE WHEN coalesce(d.d_n, 0) = 0 THEN '' ELSE CAST(d.d_n AS VARCHAR) END AS no_of_trucks, "
        f"{tot_text('m.m_s', 'm.m_aum')} || '/ ' || {avg_text('m.m_s', 'm.m_aum', day)} AS tot_avg_qty, "
        f"CAST(m.m_n AS VARCHAR) || '/ ' || CAST(CAST(round(m.m_n / {day}) AS BIGINT) AS VARCHAR) AS tot_avg_trucks "
    )


ORACLE_SQL: dict[str, str] = {
    "ledger_normalised": _q(
        "",
        f"SELECT {LEDGER_COLS}, {prod('item_name')} AS item, {row_tonnes('qtyissued')} AS qtyissued_mt, "
        f"{row_tonnes('qtyrecd')} AS qtyrecd_mt FROM ledger",
    ),
    "coal_availability": availability("coal"),
    "maize_availability": availability("maize"),
    "ethanol_receipts": availability("ethanol"),
    "report_readiness": _q(READINESS_ALL, "SELECT * FROM readiness"),
    "availability_alerts": _q(
        READINESS_ALL,
        "SELECT report_date, 'coal' AS material FROM readiness WHERE coal_rows = 0 "
        "UNION ALL SELECT report_date, 'maize' FROM readiness WHERE maize_rows = 0",
    ),
    "sales_rows": _q(SALES, f"SELECT {LEDGER_COLS}, {prod('item_name')} AS product_name FROM sales"),
    "sales_day": _q(
        SALES,
        f"SELECT {prod('item_name')} AS product_name, aum, {tot_val('sum(aqtyissued)', 'aum')} AS qty, "
        f"{unit('aum')} AS unit, CAST(count(vrno) AS BIGINT) AS no_of_trucks "
        f"FROM sales WHERE vrdate = {D} GROUP BY item_name, aum",
    ),
    "sales_mtd": _q(
        f"{SALES}, g AS (SELECT upper(item_name) AS iu, aum, sum(aqtyissued) AS s, count(vrno) AS n FROM sales "
        f"WHERE vrdate BETWEEN {MS} AND {D} GROUP BY upper(item_name), aum)",
        f"SELECT {prod('iu')} AS product_name, aum, {tot_val('s', 'aum')} AS tot_qty, {avg_val('s', 'aum', DAY)} AS avg_qty, "
        f"{unit('aum')} AS unit, CAST(n AS BIGINT) AS tot_no_of_trucks, CAST(round(n / {DAY}) AS BIGINT) AS avg_no_of_trucks "
        "FROM g",
    ),
    "sales_report": _q(SINGLE_SIDES, report_select(DAY) + "FROM m LEFT JOIN d ON m.product_name = d.product_name"),
    "sales_report_by_unit": _q(
        BY_UNIT_SIDES,
        report_select(DAY) + "FROM m LEFT JOIN d ON m.product_name = d.product_name AND m.m_aum IS NOT DISTINCT FROM d.d_aum",
    ),
    "sales_report_text": _q(SINGLE_SIDES, text_select(DAY) + "FROM m LEFT JOIN d ON m.product_name = d.product_name"),
    "sales_report_multi": _q(MULTI_SIDES, report_select("day(m.report_date)", "report_date") + MULTI_JOIN),
    "sales_report_multi_text": _q(MULTI_SIDES, text_select("day(m.report_date)", "report_date") + MULTI_JOIN),
    "report_calendar": _q(
        "",
        "SELECT DISTINCT vrdate AS report_date, strftime(vrdate, '%d/%m/%Y') AS date_text, "
        "CAST(date_trunc('month', vrdate) AS DATE) AS month_start, strftime(vrdate, '%d') AS day_of_month FROM ledger",
    ),
    "pending_dates": _q(PENDING, "SELECT channel, report_date FROM pending"),
    "dates_to_process": _q(PENDING, f"SELECT report_date FROM pending UNION SELECT {TARGET}"),
    "send_decisions": _q(
        READINESS_ALL,
        "SELECT r.report_date, c.channel, CASE WHEN NOT r.ready THEN 'not_ready' WHEN EXISTS (SELECT 1 FROM send_log l "
        "WHERE l.channel = c.channel AND l.sent_date = r.report_date) THEN 'already_sent' ELSE 'send' END AS decision "
        f"FROM readiness r CROSS JOIN {CHANNELS}",
    ),
    "send_log_read": _q(
        "",
        "SELECT channel, sent_date, CAST(row_number() OVER (PARTITION BY channel ORDER BY seq) - 1 AS BIGINT) AS seq "
        "FROM send_log",
    ),
    "send_log_retained": _q(
        "",
        "SELECT channel, sent_date, seq FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY seq DESC) AS rn "
        f"FROM send_log) t WHERE rn <= {RETAIN}",
    ),
    "send_log_append": _q(
        f"{RUN}, {APPEND}",
        "SELECT channel, unnest(dates) AS sent_date, unnest(range(len(dates))) AS seq FROM kept "
        "UNION ALL SELECT channel, sent_date, seq FROM send_log WHERE channel NOT IN (SELECT channel FROM grown)",
    ),
    "recipient_contacts": _q("", RECIPIENT_CONTACTS),
    "daily_run_decisions": _q(RUN, "SELECT report_date, channel, decision FROM dec"),
    "daily_run_reports": _q(
        f"{RUN}, "
        + multi_sides("dates AS (SELECT report_date FROM dec WHERE channel = 'email' AND decision = 'send')"),
        report_select("day(m.report_date)", "report_date") + MULTI_JOIN,
    ),
    "report_recipients": _q(RECIPIENTS, "SELECT * FROM rec"),
    "message_outbox": _q(
        f"{RUN}, {RECIPIENTS}, {MESSAGES}",
        "SELECT m.report_date, m.kind, m.report_name, m.title || ' - ' || strftime(m.report_date, '%d/%m/%Y') AS subject, "
        "r.n_to, r.n_cc, r.n_bcc, r.n_to > 0 AS deliverable FROM msgs m JOIN rec r ON m.kind = r.kind",
    ),
}
