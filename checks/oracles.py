"""DuckDB SQL for every query of ``checks.queries``, written independently."""

from __future__ import annotations

from checks.raw import raw_sql

# Columns of the tables as SQL expects them, apart from the library's own lists.

CLICK_COUNTERS = [f"fe_{n}" for n in range(1, 21)]

SIDE_DOUBLES = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Changed_Credit_Limit",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
]

SIDE_INTEGERS = [
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Num_Credit_Inquiries",
]

NUMERIC_FEATURES = [*CLICK_COUNTERS, "Age", *SIDE_DOUBLES, *SIDE_INTEGERS, "Credit_History_Month"]

LOAN_FLAGS = {
    "Auto Loan": "has_Auto_Loan",
    "Credit-Builder Loan": "has_Credit_Builder_Loan",
    "Debt Consolidation Loan": "has_Debt_Consolidation_Loan",
    "Home Equity Loan": "has_Home_Equity_Loan",
    "Not Specified": "has_Not_Specified",
    "Mortgage Loan": "has_Mortgage_Loan",
    "Payday Loan": "has_Payday_Loan",
    "Student Loan": "has_Student_Loan",
    "Personal Loan": "has_Personal_Loan",
}
PART_FLAGS = {"ring": "has_ring", "hot": "has_hot", "small ring": "has_small_ring"}
TEXT_FLAGS = {"the": "has_the", "queque": "has_queque", "Elle": "has_Elle"}

SIDE_CATEGORIES = ["Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour"]
CATEGORIES = ["Occupation", *SIDE_CATEGORIES, *LOAN_FLAGS.values()]

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"


def to_int(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, '{NUMBER}') "
        f"THEN try_cast(trunc(try_cast({x} AS double)) AS int) END"
    )


def bare(x: str) -> str:
    return f"regexp_replace({x}, '_', '', 'g')"


def flags(column: str, named: dict[str, str]) -> str:
    return ", ".join(
        f"CASE WHEN contains({column}, '{t}') THEN 'Yes' ELSE 'No' END AS {name}"
        for t, name in named.items()
    )


MONTHS = (
    "12 * try_cast(nullif(regexp_extract({x}, '(\\d+)\\s+Years?', 1), '') AS int) "
    "+ try_cast(nullif(regexp_extract({x}, '(\\d+)\\s+Months?', 1), '') AS int)"
)

ORDERS_BY_MONTH = (
    "SELECT o_orderkey, o_custkey, o_totalprice, "
    "cast(date_trunc('month', o_orderdate) AS date) AS snapshot_date FROM orders"
)
EVENTS = "event_id, cast(ts AS date) AS snapshot_date"

# --- cleaned tables ---------------------------------------------------------

CLEAN_CLICKSTREAM = f"""
SELECT Customer_ID, {', '.join(f'coalesce({c}, 0) AS {c}' for c in CLICK_COUNTERS)}, snapshot_date
FROM ({raw_sql('clickstream')}) r"""

CLEAN_ATTRIBUTES = f"""
WITH parsed AS (
  SELECT *, {to_int(bare('Age'))} AS age_int FROM ({raw_sql('attributes')}) r),
ranged AS (
  SELECT *, CASE WHEN age_int >= 0 AND age_int <= 120 THEN age_int END AS age_ok FROM parsed),
med AS (
  SELECT snapshot_date AS d, quantile_disc(age_ok, 0.5) AS m FROM ranged GROUP BY 1)
SELECT Customer_ID, Name, cast(coalesce(age_ok, m) AS int) AS Age,
  CASE WHEN regexp_matches(SSN, '^\\d{{3}}-\\d{{2}}-\\d{{4}}$') THEN SSN ELSE 'Unknown' END AS SSN,
  CASE WHEN trim(Occupation) IN ('_______', '') THEN 'Unknown' ELSE Occupation END AS Occupation,
  snapshot_date
FROM ranged JOIN med ON snapshot_date = d"""


def clean_financials(mismatch: str = "Unknown", cards_from: str = "cc") -> str:
    ranged = {
        "Interest_Rate": to_int("Interest_Rate"),
        "Num_of_Loan": to_int(bare("Num_of_Loan")),
        "Num_of_Delayed_Payment": to_int(bare("Num_of_Delayed_Payment")),
        "Num_Credit_Inquiries": to_int("Num_Credit_Inquiries"),
    }
    doubles = {
        name: f"try_cast({bare(name) if name in ('Annual_Income', 'Outstanding_Debt', 'Amount_invested_monthly') else name} AS double)"
        for name in SIDE_DOUBLES
    }
    return f"""
WITH parsed AS (
  SELECT r.*, {to_int('Num_Bank_Accounts')} AS ba, {to_int('Num_Credit_Card')} AS cc,
    {', '.join(f'{e} AS {n}_int' for n, e in ranged.items())} FROM ({raw_sql('financials')}) r),
ranged AS (
  SELECT *, {', '.join(f'CASE WHEN {n}_int BETWEEN 0 AND 100 THEN {n}_int END AS {n}_ok' for n in ranged)}
  FROM parsed),
stats AS (
  SELECT snapshot_date AS d, quantile_disc(ba, 0.5) AS ba_m, quantile_disc(ba, 0.99) AS ba_hi,
    quantile_disc(cc, 0.5) AS cc_m, quantile_disc(cc, 0.99) AS cc_hi,
    {', '.join(f'quantile_disc({n}_ok, 0.5) AS {n}_m' for n in ranged)}
  FROM ranged GROUP BY 1)
SELECT Customer_ID, {', '.join(f'{e} AS {n}' for n, e in doubles.items())},
  cast(CASE WHEN ba > ba_hi THEN ba_m ELSE ba END AS int) AS Num_Bank_Accounts,
  cast(CASE WHEN cc > cc_hi THEN {cards_from}_m ELSE cc END AS int) AS Num_Credit_Card,
  {', '.join(f'cast(coalesce({n}_ok, {n}_m) AS int) AS {n}' for n in ranged)},
  coalesce(Type_of_Loan, 'Unknown') AS Type_of_Loan,
  try_cast(Delay_from_due_date AS int) AS Delay_from_due_date,
  CASE WHEN Credit_Mix = '_' THEN 'Unknown' ELSE Credit_Mix END AS Credit_Mix,
  Credit_History_Age,
  CASE WHEN Payment_of_Min_Amount = 'NM' THEN 'Unknown' ELSE Payment_of_Min_Amount END
    AS Payment_of_Min_Amount,
  CASE WHEN regexp_matches(Payment_Behaviour, '^([a-zA-Z]+_){{4}}[a-zA-Z]+$')
    THEN Payment_Behaviour ELSE '{mismatch}' END AS Payment_Behaviour,
  snapshot_date
FROM ranged JOIN stats ON snapshot_date = d"""


CLEAN_LEDGER = f"""
WITH counted AS (
  SELECT *, installment_num AS mob,
    CASE WHEN overdue_amt IS NULL OR due_amt IS NULL OR due_amt = 0 THEN 0 ELSE cast(greatest(least(
      ceil(overdue_amt / due_amt), 2147483647), -2147483647) AS int) END AS installments_missed
  FROM ({raw_sql('loan_daily')}) r),
filled AS (
  SELECT loan_id, Customer_ID, loan_start_date, coalesce(tenure, 0) AS tenure, installment_num,
    loan_amt, due_amt, paid_amt, coalesce(overdue_amt, 0) AS overdue_amt, balance, snapshot_date,
    mob, installments_missed FROM counted),
dated AS (
  SELECT *, CASE
    WHEN installments_missed > (year(snapshot_date) - 1900) * 12 + month(snapshot_date) - 1
    THEN DATE '1900-01-01' WHEN installments_missed > 0
    THEN cast(snapshot_date - to_months(installments_missed) AS date) END AS first_missed_date
  FROM filled)
SELECT *, cast(CASE WHEN overdue_amt > 0 THEN snapshot_date - first_missed_date ELSE 0 END AS int) AS dpd
FROM dated"""

LABEL_STORE = f"""
SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
  '30dpd_6mob' AS label_def, snapshot_date
FROM ({CLEAN_LEDGER}) s WHERE mob = 6"""

# --- feature store ----------------------------------------------------------

_SIDE_NUMERIC = [*SIDE_DOUBLES, *SIDE_INTEGERS]
_COMPLETE = " AND ".join(f"{c} IS NOT NULL AND NOT isnan(cast({c} AS double))" for c in NUMERIC_FEATURES)


def _vocabulary(c: str) -> str:
    return f"""
{c}_v AS (
  SELECT snapshot_date, {c} AS v,
    cast(row_number() OVER (PARTITION BY snapshot_date ORDER BY count(*) DESC, {c}) - 1 AS int) AS slot
  FROM joined WHERE {c} IS NOT NULL GROUP BY 1, 2),
{c}_n AS (SELECT snapshot_date, cast(count(*) AS int) AS n FROM {c}_v GROUP BY 1)"""


JOINED = f"""
fin AS (
  SELECT Customer_ID, {', '.join(_SIDE_NUMERIC)}, {', '.join(SIDE_CATEGORIES)},
    {flags('Type_of_Loan', LOAN_FLAGS)}, {MONTHS.format(x='Credit_History_Age')} AS Credit_History_Month
  FROM ({clean_financials()}) f),
joined AS (
  SELECT c.*, a.Age, a.Occupation, fin.* EXCLUDE (Customer_ID)
  FROM ({CLEAN_CLICKSTREAM}) c
  JOIN ({CLEAN_ATTRIBUTES}) a ON c.Customer_ID = a.Customer_ID
  JOIN fin ON c.Customer_ID = fin.Customer_ID)"""

# years or months alone are a duration as well
_YEARS, _MONTHS = (
    f"try_cast(nullif(regexp_extract(Credit_History_Age, '([0-9]+) {part}', 1), '') AS int)" for part in ("Year", "Month")
)
JOINED_LENIENT = JOINED.replace(
    MONTHS.format(x="Credit_History_Age"),
    f"CASE WHEN coalesce({_YEARS}, {_MONTHS}) IS NOT NULL "
    f"THEN 12 * coalesce({_YEARS}, 0) + coalesce({_MONTHS}, 0) END",
)

FEATURE_STORE = f"""
WITH {JOINED}, {','.join(_vocabulary(c) for c in CATEGORIES)},
complete AS (SELECT * FROM joined WHERE {_COMPLETE}),
limits AS (
  SELECT snapshot_date AS d,
    {', '.join(f'cast(min({c}) AS double) AS {c}_lo, cast(max({c}) AS double) AS {c}_hi' for c in NUMERIC_FEATURES)}
  FROM complete GROUP BY 1)
SELECT complete.Customer_ID, complete.snapshot_date,
  {', '.join(f'cast({c} AS double) AS {c}' for c in NUMERIC_FEATURES)},
  {', '.join(f'CASE WHEN {c}_hi > {c}_lo THEN (cast({c} AS double) - {c}_lo) / ({c}_hi - {c}_lo) ELSE 0.5 END AS {c}_scaled' for c in NUMERIC_FEATURES)},
  {', '.join(f'coalesce({c}_n.n, 0) AS {c}_size, {c}_v.slot AS {c}_slot' for c in CATEGORIES)}
FROM complete JOIN limits ON snapshot_date = d
{' '.join(f'''
LEFT JOIN {c}_v ON {c}_v.snapshot_date = complete.snapshot_date AND {c}_v.v = complete.{c}
LEFT JOIN {c}_n ON {c}_n.snapshot_date = complete.snapshot_date''' for c in CATEGORIES)}"""


def _latest(rows: str, columns) -> str:
    """One row per customer and date: of several, the greatest in column order."""
    listed = ", ".join(f"{c} DESC NULLS LAST" for c in columns)
    return (
        f"SELECT * FROM ({rows}) q QUALIFY row_number() OVER "
        f"(PARTITION BY Customer_ID, snapshot_date ORDER BY {listed}) = 1"
    )


JOINED_AS_OF = f"""
fin AS (
  SELECT Customer_ID, snapshot_date, {', '.join(_SIDE_NUMERIC)},
    {', '.join(SIDE_CATEGORIES)},
    {flags('Type_of_Loan', LOAN_FLAGS)}, {MONTHS.format(x='Credit_History_Age')} AS Credit_History_Month
  FROM ({clean_financials()}) f),
fin1 AS ({_latest('SELECT * FROM fin', _SIDE_NUMERIC)}),
att1 AS ({_latest(f'SELECT Customer_ID, snapshot_date, Age, Occupation FROM ({CLEAN_ATTRIBUTES}) a', ['Age', 'Occupation'])}),
clicks AS ({CLEAN_CLICKSTREAM}),
joined AS (
  SELECT c.*, a.Age, a.Occupation, f.* EXCLUDE (Customer_ID, snapshot_date)
  FROM clicks c ASOF JOIN att1 a ON c.Customer_ID = a.Customer_ID AND c.snapshot_date >= a.snapshot_date
  ASOF JOIN fin1 f ON c.Customer_ID = f.Customer_ID AND c.snapshot_date >= f.snapshot_date)"""
FEATURE_STORE_AS_OF = FEATURE_STORE.replace(JOINED, JOINED_AS_OF)


def _counted(layer: str, table: str, rows: str) -> str:
    return (
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, snapshot_date, count(*) AS n "
        f"FROM ({rows}) t GROUP BY 3"
    )


BACKFILL_AUDIT = " UNION ALL ".join(
    [
        *[
            _counted(layer, table, raw_sql(table))
            for layer in ("bronze", "silver")
            for table in ("clickstream", "attributes", "financials", "loan_daily")
        ],
        _counted("gold", "feature_store", f"WITH {JOINED} SELECT * FROM joined WHERE {_COMPLETE}"),
        _counted("gold", "label_store", LABEL_STORE),
    ]
)

# --- single operators -------------------------------------------------------

DIRTY_SIZES = """
SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN p_size || '_' WHEN 1 THEN '__' || p_size || '__'
  WHEN 2 THEN p_size || '.7' WHEN 3 THEN '' WHEN 4 THEN p_size || 'e1'
  WHEN 5 THEN '-' || p_size || '00000000000' ELSE cast(p_size AS varchar) END AS raw
FROM part"""

HOLES = """
SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN p_size END AS size,
  CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END AS price,
  CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS type
FROM part"""


def _index(columns: dict[str, str], extra: str = "") -> str:
    exprs = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    ctes, joins, out = [], [], []
    for c in columns:
        ctes.append(
            f"{c}_v AS (SELECT snapshot_date AS d, {c} AS v, cast(row_number() OVER (PARTITION BY "
            f"snapshot_date ORDER BY count(*) DESC, {c}) - 1 AS int) AS slot FROM e "
            f"WHERE {c} IS NOT NULL GROUP BY 1, 2), "
            f"{c}_n AS (SELECT d, cast(count(*) AS int) AS n FROM {c}_v GROUP BY 1)"
        )
        joins.append(
            f"LEFT JOIN {c}_v ON {c}_v.d = e.snapshot_date AND {c}_v.v = e.{c} "
            f"LEFT JOIN {c}_n ON {c}_n.d = e.snapshot_date"
        )
        out.append(f"coalesce({c}_v.slot, {c}_n.n, 0) AS {c}_index")
    return (
        f"WITH e AS (SELECT {EVENTS}, {exprs} FROM events), {', '.join(ctes)} "
        f"SELECT e.*, {', '.join(out)} FROM e {' '.join(joins)}"
    )


EVENT_TYPE = "CASE WHEN event_id % 9 <> 0 THEN event_type END"
INDEX_PROPS = _index(
    {"event_type": "event_type", "props": "CASE WHEN event_id % 9 <> 0 THEN props END"}
)
INDEX_TEXTS = """
WITH t AS (SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, text) - 1 AS slot
  FROM documents WHERE text IS NOT NULL GROUP BY 1, 2),
l AS (SELECT source, lang, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang) - 1 AS slot
  FROM documents WHERE lang IS NOT NULL GROUP BY 1, 2),
tn AS (SELECT source, count(*) AS n FROM t GROUP BY 1), ln AS (SELECT source, count(*) AS n FROM l GROUP BY 1)
SELECT doc_id, d.source, d.lang, cast(coalesce(t.slot, tn.n, 0) AS int) AS text_index,
  cast(coalesce(l.slot, ln.n, 0) AS int) AS lang_index
FROM documents d LEFT JOIN t ON d.source = t.source AND d.text = t.text
LEFT JOIN l ON d.source = l.source AND d.lang = l.lang
LEFT JOIN tn ON d.source = tn.source LEFT JOIN ln ON d.source = ln.source"""
INDEX_FROZEN = f"""
WITH e AS (SELECT {EVENTS}, {EVENT_TYPE} AS event_type FROM events),
v AS (SELECT event_type AS v, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS slot FROM e
  WHERE event_type IS NOT NULL AND snapshot_date = (SELECT min(snapshot_date) FROM e) GROUP BY 1)
SELECT e.*, cast(coalesce(slot, (SELECT count(*) FROM v)) AS int) AS event_type_index
FROM e LEFT JOIN v ON event_type = v"""
FEATURE_JOIN = f"""
SELECT user_id, {EVENTS}, event_type, c_mktsegment, c_acctbal, orders, largest
FROM events JOIN customer ON user_id = c_custkey
JOIN (SELECT o_custkey, count(*) AS orders, max(o_totalprice) AS largest FROM orders GROUP BY 1) o
  ON user_id = o_custkey"""

FANOUT = f"""
SELECT user_id, {EVENTS}, c_mktsegment, c_acctbal, o_orderkey, o_totalprice
FROM events JOIN customer ON user_id = c_custkey JOIN orders ON user_id = o_custkey"""

ORACLES = {
    "q_label_store": LABEL_STORE,
    "q_ledger_dpd": "SELECT loan_id, snapshot_date, installments_missed, first_missed_date, dpd "
    f"FROM ({CLEAN_LEDGER}) s",
    "q_clean_ledger": CLEAN_LEDGER,
    "q_snapshot_slice": f"SELECT * FROM ({ORDERS_BY_MONTH}) o "
    "WHERE snapshot_date IN (DATE '1996-03-01', DATE '1997-10-01')",
    "q_replicated_snapshots": "SELECT c_custkey, c_name, d AS snapshot_date FROM customer, "
    "(VALUES (DATE '2023-01-01'), (DATE '2023-02-01')) v(d)",
    "q_snapshot_audit": f'SELECT snapshot_date, count(*) AS "rows" FROM ({ORDERS_BY_MONTH}) o GROUP BY 1',
    "q_partitioned_roundtrip": ORDERS_BY_MONTH,
    "q_interrupted_publish": f"""
SELECT o_orderkey, o_custkey, CASE WHEN snapshot_date = DATE '1997-10-01' THEN 2 * o_totalprice
  ELSE o_totalprice END AS o_totalprice, snapshot_date
FROM ({ORDERS_BY_MONTH}) o WHERE snapshot_date <> DATE '1992-05-01'""",
    "q_csv_ingest": "SELECT *, DATE '2023-01-01' AS opened FROM customer",
    "q_month_spine_gaps": f"""
WITH o AS ({ORDERS_BY_MONTH}),
spine AS (
  SELECT cast(unnest(generate_series(min(snapshot_date)::timestamp,
    max(snapshot_date)::timestamp + INTERVAL 24 MONTH, INTERVAL 1 MONTH)) AS date) AS snapshot_date FROM o)
SELECT spine.snapshot_date, count(o_orderkey) AS "rows"
FROM spine LEFT JOIN o ON o.snapshot_date = spine.snapshot_date GROUP BY 1""",
    "q_strip_parse_int": f"SELECT p_partkey, {to_int(bare('raw'))} AS size FROM ({DIRTY_SIZES}) p",
    "q_parse_int": f"SELECT p_partkey, {to_int('raw')} AS size FROM ({DIRTY_SIZES}) p",
    "q_strip_parse_float": """
SELECT c_custkey, CASE WHEN c_custkey % 5 IN (1, 2) THEN NULL ELSE c_acctbal END AS balance FROM customer""",
    "q_enforce_schema": """
SELECT o_orderkey AS key, o_totalprice AS price,
  CASE WHEN o_orderkey % 10 <> 0 THEN cast(o_custkey AS int) END AS customer,
  cast(o_orderdate AS date) AS day, o_orderstatus AS status FROM orders""",
    "q_null_out_of_range": "SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_acctbal > 9000 THEN NULL "
    "ELSE c_acctbal END AS balance FROM customer",
    "q_fill_median": f"""
WITH e AS (SELECT {EVENTS}, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events),
m AS (SELECT snapshot_date AS d, quantile_disc(value, 0.5) AS m FROM e GROUP BY 1)
SELECT event_id, snapshot_date, coalesce(value, m) AS value FROM e JOIN m ON snapshot_date = d""",
    "q_replace_above_p99": f"""
WITH e AS (SELECT {EVENTS}, value FROM events),
m AS (SELECT snapshot_date AS d, quantile_disc(value, 0.5) AS m, quantile_disc(value, 0.99) AS hi
  FROM e GROUP BY 1)
SELECT event_id, snapshot_date, CASE WHEN value > hi THEN m ELSE value END AS value
FROM e JOIN m ON snapshot_date = d""",
    "q_replace_above_p99_lineitem": """
WITH l AS (SELECT l_orderkey, cast(date_trunc('month', l_shipdate) AS date) AS snapshot_date,
    l_extendedprice AS price, l_quantity AS quantity FROM lineitem),
m AS (SELECT snapshot_date AS d, quantile_disc(price, 0.5) AS m, quantile_disc(price, 0.99) AS p_hi,
    quantile_disc(quantity, 0.99) AS q_hi FROM l GROUP BY 1)
SELECT l_orderkey, snapshot_date, CASE WHEN price > p_hi THEN m ELSE price END AS price,
  CASE WHEN quantity > q_hi THEN m ELSE quantity END AS quantity FROM l JOIN m ON snapshot_date = d""",
    "q_quantiles_by_month": """
SELECT cast(date_trunc('month', l_shipdate) AS date) AS snapshot_date,
  quantile_disc(l_extendedprice, 0.5) AS price_p50, quantile_disc(l_extendedprice, 0.99) AS price_p99,
  quantile_disc(l_extendedprice, 0.07) AS price_p7, quantile_disc(l_extendedprice, 0.14) AS price_p14,
  quantile_disc(l_partkey, 0.5) AS part_p50, quantile_disc(l_partkey, 0.07) AS part_p7,
  quantile_disc(l_linenumber, 0.5) AS line_p50, quantile_disc(l_linenumber, 0.99) AS line_p99
FROM lineitem GROUP BY 1""",
    "q_approx_median_error": """
WITH lines AS (
  SELECT cast(date_trunc('month', l_shipdate) AS date) AS snapshot_date, l_extendedprice AS price FROM lineitem),
exact AS (SELECT snapshot_date AS d, quantile_disc(price, 0.5) AS median FROM lines GROUP BY 1)
SELECT snapshot_date, count(*) AS "rows", median, count(*) FILTER (price < median) AS below,
  0.0::double AS ranks_beyond
FROM lines JOIN exact ON snapshot_date = d GROUP BY 1, 3""",
    "q_valid_regex_or": """
SELECT c_name AS text, CASE WHEN regexp_matches(c_name, '^Customer#[0-9]+[02468]$') THEN c_name
  ELSE 'Unknown' END AS valid FROM customer
UNION ALL
SELECT url, CASE WHEN regexp_matches(url, '^https?://[a-z]+[.]example[.]com/[a-z]+/[0-9]+$') THEN url
  ELSE 'bad url' END FROM pages""",
    "q_placeholder_to": """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (0, 1, 3) THEN 'Unknown' WHEN o_orderkey % 6 = 2 THEN NULL
    ELSE o_orderpriority END AS priority,
  CASE o_orderkey % 5 WHEN 0 THEN 'Unknown' WHEN 1 THEN ' _' WHEN 2 THEN NULL ELSE o_orderstatus END
    AS status FROM orders""",
    "q_null_to": f"SELECT {EVENTS}, CASE WHEN event_id % 4 = 0 THEN 'Unknown' ELSE event_type END "
    "AS event_type FROM events",
    "q_fill_constants": "SELECT p_partkey, coalesce(size, 0) AS size, price, coalesce(type, '0') AS type "
    f"FROM ({HOLES}) p",
    "q_fill_all_numeric": "SELECT p_partkey, coalesce(size, 0) AS size, coalesce(price, 0) AS price, type "
    f"FROM ({HOLES}) p",
    "q_clean_clickstream": CLEAN_CLICKSTREAM,
    "q_clean_attributes": CLEAN_ATTRIBUTES,
    "q_clean_attributes_strict": "SELECT Customer_ID, Age, coalesce(Occupation, 'Unknown') AS Occupation, "
    f"snapshot_date FROM ({CLEAN_ATTRIBUTES}) a",
    "q_clean_financials_strict": "SELECT * REPLACE (coalesce(Credit_Mix, 'Unknown') AS Credit_Mix, "
    f"coalesce(Payment_of_Min_Amount, 'Unknown') AS Payment_of_Min_Amount) FROM ({clean_financials()}) f",
    "q_derived_financials": f"""
SELECT Customer_ID,
  CASE WHEN list_contains(entries, 'Loan') THEN 'Yes' ELSE 'No' END AS has_Loan,
  CASE WHEN list_contains(entries, 'Auto Loan') THEN 'Yes' ELSE 'No' END AS has_Auto_Loan,
  CASE WHEN list_contains(entries, 'Student Loan') THEN 'Yes' ELSE 'No' END AS has_Student_Loan,
  CASE WHEN list_contains(entries, 'Personal Loan') THEN 'Yes' ELSE 'No' END AS has_Personal_Loan,
  CASE WHEN y IS NOT NULL OR m IS NOT NULL THEN coalesce(12 * y, 0) + coalesce(m, 0) END AS months
FROM (SELECT Customer_ID, string_split(replace(Type_of_Loan, ', and ', ', '), ', ') AS entries,
  try_cast(nullif(regexp_extract(Credit_History_Age, '([0-9]+) Year', 1), '') AS int) AS y,
  try_cast(nullif(regexp_extract(Credit_History_Age, '([0-9]+) Month', 1), '') AS int) AS m
  FROM ({raw_sql('financials')}) r) parts""",
    "q_clean_financials": clean_financials(),
    "q_clean_financials_published": clean_financials("Unkonwn", "ba"),
    "q_membership_flags": f"SELECT p_partkey, {flags('p_name', PART_FLAGS)} FROM part",
    "q_text_flags": f"SELECT doc_id, {flags('text', TEXT_FLAGS)} FROM documents",
    "q_duration_months": """
SELECT p_partkey, cast(CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN 13
  ELSE 12 * p_size + p_partkey % 12 END AS int) AS months FROM part""",
    "q_level_counts": """
SELECT cast(date_trunc('month', o_orderdate) AS date) AS snapshot_date, 'o_orderpriority' AS "column",
  o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1, 3
UNION ALL
SELECT cast(date_trunc('month', o_orderdate) AS date), 'o_orderstatus', o_orderstatus, count(*)
FROM orders GROUP BY 1, 3""",
    "q_index": _index({"event_type": EVENT_TYPE}),
    "q_index_medium": INDEX_PROPS,
    "q_index_large": INDEX_TEXTS,
    "q_index_frozen": INDEX_FROZEN,
    "q_one_hot_vectors": f"""
WITH i AS ({_index({'event_type': EVENT_TYPE})}),
n AS (SELECT snapshot_date AS d, cast(count(DISTINCT event_type) AS int) AS size FROM i GROUP BY 1)
SELECT event_id, snapshot_date, size, CASE WHEN event_type IS NOT NULL THEN event_type_index END AS index,
  CASE WHEN event_type IS NOT NULL THEN cast(1 AS double) END AS value FROM i JOIN n ON snapshot_date = d""",
    "q_one_hot": f"""
WITH i AS ({_index({'event_type': EVENT_TYPE})}),
n AS (SELECT snapshot_date AS d, cast(count(DISTINCT event_type) AS int) AS size FROM i GROUP BY 1)
SELECT event_id, snapshot_date, size,
  {', '.join(f'cast(event_type_index = {k} AS double) AS slot_{k}' for k in range(5))}
FROM i JOIN n ON snapshot_date = d""",
    "q_skip_nulls_minmax": f"""
WITH e AS (SELECT {EVENTS}, value, value * 2 AS twice, 3 AS constant FROM events
  WHERE event_id % 5 <> 0 AND event_id % 7 <> 0),
m AS (SELECT snapshot_date AS d, min(value) AS a, max(value) AS b, min(twice) AS c, max(twice) AS t
  FROM e GROUP BY 1)
SELECT e.*, CASE WHEN b > a THEN (value - a) / (b - a) ELSE 0.5 END AS value_scaled,
  CASE WHEN t > c THEN (twice - c) / (t - c) ELSE 0.5 END AS twice_scaled,
  cast(0.5 AS double) AS constant_scaled FROM e JOIN m ON snapshot_date = d""",
    "q_min_max_limits": f"""
SELECT snapshot_date, min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max,
  cast(min(o_custkey) AS double) AS o_custkey_min, cast(max(o_custkey) AS double) AS o_custkey_max
FROM ({ORDERS_BY_MONTH}) o GROUP BY 1""",
    "q_feature_join": FEATURE_JOIN,
    "q_feature_join_salted": FEATURE_JOIN,
    "q_feature_join_fanout": FANOUT,
    "q_feature_join_fanout_salted": FANOUT,
    "q_feature_join_product_hot": f"""
SELECT e.user_id, event_id, n_nationkey, r_regionkey
FROM (SELECT CASE WHEN event_id % 20 = 0 THEN -1 ELSE event_id % 30 END AS user_id, event_id FROM events) e
JOIN (SELECT CASE n_nationkey % 2 WHEN 0 THEN -1 ELSE n_nationkey END AS user_id, n_nationkey FROM nation) n ON e.user_id = n.user_id
JOIN (SELECT CASE r_regionkey % 2 WHEN 0 THEN -1 ELSE r_regionkey END AS user_id, r_regionkey FROM region) r ON e.user_id = r.user_id""",
    "q_feature_store": FEATURE_STORE,
    "q_feature_store_as_of": FEATURE_STORE_AS_OF,
    "q_dropped_rows": f"""
WITH {JOINED} SELECT snapshot_date, count(*) AS joined, count(*) - count(*) FILTER ({_COMPLETE}) AS dropped
FROM joined GROUP BY 1""",
    "q_dropped_rows_lenient": f"""
WITH {JOINED_LENIENT} SELECT snapshot_date, count(*) AS joined, count(*) - count(*) FILTER ({_COMPLETE}) AS dropped
FROM joined GROUP BY 1""",
    "q_legacy_slices": "SELECT o_orderkey, o_custkey, o_totalprice, "
    "make_date(2023, month(o_orderdate), 1) AS snapshot_date FROM orders",
    "q_backfill_features": FEATURE_STORE,
    "q_backfill_labels": LABEL_STORE,
    "q_backfill_audit": BACKFILL_AUDIT,
}
