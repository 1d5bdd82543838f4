"""Tables of the lake: column names, types and the vocabularies of the rules.

Every table is a ``{column: type}`` mapping, in column order.  The mappings
below give the *clean* types; bronze keeps every column but the dates as text.
"""

from __future__ import annotations

SNAPSHOT = "snapshot_date"
CUSTOMER = "Customer_ID"

# --- fixed values: column names and types of the four input tables ----------

CLICK_COUNTERS = [f"fe_{i}" for i in range(1, 21)]

CLICKSTREAM = {
    **{name: "int" for name in CLICK_COUNTERS},
    "Customer_ID": "string",
    "snapshot_date": "date",
}

ATTRIBUTES = {
    "Customer_ID": "string",
    "Name": "string",
    "Age": "int",
    "SSN": "string",
    "Occupation": "string",
    "snapshot_date": "date",
}

FINANCIALS = {
    "Customer_ID": "string",
    "Annual_Income": "double",
    "Monthly_Inhand_Salary": "double",
    "Num_Bank_Accounts": "int",
    "Num_Credit_Card": "int",
    "Interest_Rate": "int",
    "Num_of_Loan": "int",
    "Type_of_Loan": "string",
    "Delay_from_due_date": "int",
    "Num_of_Delayed_Payment": "int",
    "Changed_Credit_Limit": "double",
    "Num_Credit_Inquiries": "int",
    "Credit_Mix": "string",
    "Outstanding_Debt": "double",
    "Credit_Utilization_Ratio": "double",
    "Credit_History_Age": "string",
    "Payment_of_Min_Amount": "string",
    "Total_EMI_per_month": "double",
    "Amount_invested_monthly": "double",
    "Payment_Behaviour": "string",
    "Monthly_Balance": "double",
    "snapshot_date": "date",
}

LOAN_DAILY = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "double",
    "due_amt": "double",
    "paid_amt": "double",
    "overdue_amt": "double",
    "balance": "double",
    "snapshot_date": "date",
}

# --- fixed values: patterns, placeholders and ranges of the cleaning rules --

SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
PAYMENT_BEHAVIOUR_PATTERN = r"^[a-zA-Z]+_[a-zA-Z]+_[a-zA-Z]+_[a-zA-Z]+_[a-zA-Z]+$"
YEARS_PATTERN = r"(\d+)\s+Years?"
LIST_PATTERN = r"\s*,\s*(?:and\s+)?|\s+and\s+"
MONTHS_PATTERN = r"(\d+)\s+Months?"
OCCUPATION_PLACEHOLDERS = ["_______", ""]
CREDIT_MIX_PLACEHOLDERS = ["_"]
MIN_AMOUNT_PLACEHOLDERS = ["NM"]

AGE_RANGE = (0, 120)
FINANCIAL_RANGES = {
    "Interest_Rate": (0, 100),
    "Num_of_Loan": (0, 100),
    "Num_of_Delayed_Payment": (0, 100),
    "Num_Credit_Inquiries": (0, 100),
}

# --- fixed values: inputs of the feature store ------------------------------

LOAN_TYPES = [
    "Auto Loan",
    "Credit-Builder Loan",
    "Debt Consolidation Loan",
    "Home Equity Loan",
    "Not Specified",
    "Mortgage Loan",
    "Payday Loan",
    "Student Loan",
    "Personal Loan",
]

PLAIN_CATEGORIES = [
    "Occupation",
    "Credit_Mix",
    "Payment_of_Min_Amount",
    "Payment_Behaviour",
]

NUMERIC_FEATURES = [
    *CLICK_COUNTERS,
    "Age",
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
    "Credit_History_Month",
]

PII_COLUMNS = ["Name", "SSN"]
IDENTIFYING_COLUMNS = [*PII_COLUMNS, "Type_of_Loan"]


def flag_name(term: str) -> str:
    """Column name of the membership flag of one loan type."""
    return "has_" + "".join("_" if ch in " -" else ch for ch in term)


CATEGORIES = PLAIN_CATEGORIES + [flag_name(term) for term in LOAN_TYPES]
