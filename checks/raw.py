"""Dirty source tables derived from the driver's tables.

The given tables are clean and have other columns, so each source table of the
lake is derived from a whole given table by expressions that mean the same in
Spark SQL and in DuckDB.  Remainders decide which rows get which dirt; no row
is left out.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_CLICK_SNAPSHOT = (
    "make_date(2023 + CASE WHEN day(ts) % 24 >= 12 THEN 1 ELSE 0 END, "
    "cast(1 + day(ts) % 12 AS int), 1)"
)

# table -> (FROM clause, {column: expression})
RAW: dict[str, tuple[str, dict[str, str]]] = {
    "clickstream": (
        "events",
        {
            "Customer_ID": "concat('CUS_', cast(user_id AS string))",
            **{
                f"fe_{i}": f"CASE WHEN (event_id + {i}) % 11 = 0 THEN NULL "
                f"ELSE cast(floor(value * {i}) AS int) % 97 - {i} END"
                for i in range(1, 21)
            },
            "snapshot_date": _CLICK_SNAPSHOT,
        },
    ),
    # some customers have two rows, in different months
    "attributes": (
        "(SELECT *, 0 AS copy FROM customer UNION ALL "
        "SELECT *, 1 AS copy FROM customer WHERE c_custkey % 4 = 0) AS per_row",
        {
            "Customer_ID": "concat('CUS_', cast(c_custkey AS string))",
            "Name": "c_name",
            "Age": "CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN '-500' "
            "WHEN c_custkey % 19 = 0 THEN '8698_' "
            "WHEN c_custkey % 7 = 0 THEN concat(cast(18 + c_custkey % 60 AS string), '_') "
            "ELSE cast(18 + copy + c_custkey % 60 AS string) END",
            "SSN": "CASE WHEN c_custkey % 9 = 0 THEN '#F%$D@*&8' WHEN c_custkey % 23 = 0 THEN NULL "
            "ELSE concat('123-45-', cast(1000 + c_custkey % 9000 AS string)) END",
            "Occupation": "CASE WHEN c_custkey % 11 = 0 THEN '_______' "
            "WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN '  ' "
            "ELSE c_mktsegment END",
            "snapshot_date": "make_date(2023, cast(1 + (c_nationkey + 5 * copy) % 12 AS int), 1)",
        },
    ),
    # and some have three of these
    "financials": (
        "(" + " UNION ALL ".join(
            "SELECT o_custkey AS k, count(*) AS n, max(o_totalprice) AS hi, min(o_totalprice) AS lo, "
            f"max(o_orderdate) AS last_day, {copy} AS copy FROM orders WHERE {which} GROUP BY o_custkey"
            for copy, which in enumerate(("true", "o_custkey % 3 = 0", "o_custkey % 6 = 0"))
        ) + ") AS per_row",
        {
            "Customer_ID": "concat('CUS_', cast(k AS string))",
            "Annual_Income": "concat(cast(hi AS string), CASE WHEN k % 6 = 0 THEN '_' ELSE '' END)",
            "Monthly_Inhand_Salary": "CASE WHEN k % 37 = 0 THEN NULL ELSE cast(lo AS string) END",
            "Num_Bank_Accounts": "CASE WHEN k % 41 = 0 THEN cast(1000 + k % 700 AS string) "
            "WHEN k % 43 = 0 THEN '-1' ELSE cast(n % 11 AS string) END",
            "Num_Credit_Card": "CASE WHEN k % 47 = 0 THEN cast(1200 + k % 300 AS string) "
            "ELSE cast(1 + (n + k) % 9 AS string) END",
            "Interest_Rate": "CASE WHEN k % 53 = 0 THEN '5789' WHEN k % 59 = 0 THEN NULL "
            "ELSE cast(1 + (k + copy) % 34 AS string) END",
            "Num_of_Loan": "CASE WHEN k % 61 = 0 THEN '-100' "
            "WHEN k % 5 = 0 THEN concat(cast(k % 9 AS string), '_') ELSE cast(k % 9 AS string) END",
            "Type_of_Loan": "CASE k % 8 WHEN 0 THEN NULL "
            "WHEN 1 THEN 'Auto Loan, and Home Equity Loan' WHEN 2 THEN 'Credit-Builder Loan' "
            "WHEN 3 THEN 'Payday Loan, Student Loan, and Personal Loan' "
            "WHEN 4 THEN 'Not Specified' WHEN 5 THEN 'Mortgage Loan, and Debt Consolidation Loan' "
            "WHEN 6 THEN 'Auto Loan' ELSE 'Student Loan' END",
            "Delay_from_due_date": "cast((k + 7 * copy) % 62 - 5 AS string)",
            "Num_of_Delayed_Payment": "CASE WHEN k % 71 = 0 THEN '3318_' WHEN k % 67 = 0 THEN NULL "
            "WHEN k % 4 = 0 THEN concat(cast(k % 28 AS string), '_') ELSE cast(k % 28 AS string) END",
            "Changed_Credit_Limit": "CASE WHEN k % 73 = 0 THEN '_' ELSE cast(lo / 1000 AS string) END",
            "Num_Credit_Inquiries": "CASE WHEN k % 79 = 0 THEN '2000' WHEN k % 83 = 0 THEN NULL "
            "ELSE cast(k % 15 AS string) END",
            "Credit_Mix": "CASE WHEN k % 5 = 0 THEN '_' WHEN k % 89 = 0 THEN NULL "
            "WHEN (k + copy) % 3 = 0 THEN 'Good' WHEN (k + copy) % 3 = 1 THEN 'Standard' ELSE 'Bad' END",
            "Outstanding_Debt": "concat(cast(lo AS string), CASE WHEN k % 21 = 0 THEN '_' ELSE '' END)",
            "Credit_Utilization_Ratio": "cast(20 + (k % 250) / 10 AS string)",
            "Credit_History_Age": "CASE WHEN k % 29 = 0 THEN NULL WHEN k % 97 = 0 THEN '5 Years' "
            "ELSE concat(cast(k % 33 AS string), ' Years and ', cast(k % 12 AS string), ' Months') END",
            "Payment_of_Min_Amount": "CASE WHEN k % 10 = 0 THEN 'NM' WHEN k % 2 = 0 THEN 'Yes' "
            "ELSE 'No' END",
            "Total_EMI_per_month": "cast(hi / 100 AS string)",
            "Amount_invested_monthly": "CASE WHEN k % 20 = 0 THEN '__10000__' "
            "ELSE cast(lo / 50 AS string) END",
            "Payment_Behaviour": "CASE WHEN k % 14 = 0 THEN '!@9#%8' WHEN k % 26 = 1 THEN NULL "
            "ELSE concat(CASE WHEN k % 2 = 0 THEN 'High' ELSE 'Low' END, '_spent_', "
            "CASE k % 3 WHEN 0 THEN 'Small' WHEN 1 THEN 'Medium' ELSE 'Large' END, "
            "'_value_payments') END",
            "Monthly_Balance": "CASE WHEN k % 101 = 0 THEN '__-333333333333333333333333333__' "
            "ELSE cast((hi + lo) / 2 AS string) END",
            "snapshot_date": "make_date(cast(2023 + k % 2 AS int), "
            "cast(1 + (month(last_day) + 5 * copy) % 12 AS int), 1)",
        },
    ),
    "loan_daily": (
        "lineitem",
        {
            "loan_id": "cast(l_orderkey AS string)",
            "Customer_ID": "concat('CUS_', cast(l_suppkey AS string))",
            "loan_start_date": "cast(l_shipdate AS date)",
            "tenure": "CASE WHEN l_partkey % 40 = 0 THEN NULL ELSE 10 END",
            "installment_num": "l_linenumber",
            "loan_amt": "l_extendedprice",
            # instalments so small that months do not reach back, or do not fit an int
            "due_amt": "CASE WHEN l_partkey % 50 = 0 THEN cast(0 AS double) "
            "WHEN l_partkey % 46 = 1 THEN cast(0.001 AS double) "
            "WHEN l_partkey % 46 = 2 THEN cast(0.000001 AS double) ELSE l_extendedprice END",
            "paid_amt": "l_extendedprice * (1 - l_discount)",
            "overdue_amt": "CASE WHEN l_partkey % 33 = 0 THEN cast(NULL AS double) "
            "ELSE l_extendedprice * (cast(l_quantity AS int) % 7 - 2) / 2 END",
            "balance": "l_extendedprice * l_tax",
            "snapshot_date": "make_date(2023 + year(l_shipdate) % 2, month(l_shipdate), 1)",
        },
    ),
}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A derived source table as a DataFrame."""
    source, columns = RAW[table]
    if source.startswith("("):
        (name,) = set(re.findall(r"FROM (\w+)", source))
        query = re.sub(rf"FROM {name}\b", "FROM {given}", source)
        df = spark.sql(f"SELECT * FROM {query}", given=given(spark, sf_dir, name))
    else:
        df = given(spark, sf_dir, source)
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def raw_sql(table: str) -> str:
    """The same table as a SELECT statement."""
    source, columns = RAW[table]
    return f"SELECT {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM {source}"
