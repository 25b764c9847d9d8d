"""Schemas of the loan tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the two kinds of vintage files, in file order.
ORIGINATION_COLUMNS = [
    "CREDIT_SCORE", "FIRST_PAYMENT_DATE", "FIRST_TIME_HOMEBUYER_FLAG", "MATURITY_DATE", "METROPOLITAN_DIVISION", "MORTGAGE_INSURANCE_PERCENTAGE", "NUMBER_OF_UNITS", "OCCUPANCY_STATUS",
    "ORIGINAL_COMBINED_LOAN_TO_VALUE", "ORIGINAL_DEBT_TO_INCOME", "ORIGINAL_UPB", "ORIGINAL_LOAN_TO_VALUE", "ORIGINAL_INTEREST_RATE", "CHANNEL", "PREPAYMENT_PENALTY_MORTGAGE", "AMORTIZATION_TYPE",
    "PROPERTY_STATE", "PROPERTY_TYPE", "POSTAL_CODE", "LOAN_SEQUENCE_NUMBER", "LOAN_PURPOSE", "ORIGINAL_LOAN_TERM", "NUMBER_OF_BORROWERS", "SELLER_NAME",
    "SERVICER_NAME", "SUPER_CONFORMING_FLAG", "PRE_RELIEF_REFINANCE_LOAN_SEQUENCE_NUMBER", "PROGRAM_INDICATOR", "RELIEF_REFINANCE_INDICATOR", "PROPERTY_VALUATION_METHOD", "INTEREST_ONLY_INDICATOR", "MI_CANCELLATION_INDICATOR",
]
PERFORMANCE_COLUMNS = [
    "LOAN_SEQUENCE_NUMBER", "MONTHLY_REPORTING_PERIOD", "CURRENT_ACTUAL_UPB", "CURRENT_LOAN_DELINQUENCY_STATUS", "LOAN_AGE", "REMAINING_MONTHS_TO_LEGAL_MATURITY", "DEFECT_SETTLEMENT_DATE", "MODIFICATION_FLAG",
    "ZERO_BALANCE_CODE", "ZERO_BALANCE_EFFECTIVE_DATE", "CURRENT_INTEREST_RATE", "CURRENT_NON_INTEREST_BEARING_UPB", "DUE_DATE_OF_LAST_PAID_INSTALLMENT", "MI_RECOVERIES", "NET_SALE_PROCEEDS", "NON_MI_RECOVERIES",
    "TOTAL_EXPENSES", "LEGAL_COSTS", "MAINTENANCE_AND_PRESERVATION_COSTS", "TAXES_AND_INSURANCE", "MISCELLANEOUS_EXPENSES", "ACTUAL_LOSS_CALCULATION", "CUMULATIVE_MODIFICATION_COST", "STEP_MODIFICATION_FLAG",
    "PAYMENT_DEFERRAL", "ESTIMATED_LOAN_TO_VALUE", "ZERO_BALANCE_REMOVAL", "DELINQUENT_ACCRUED_INTEREST", "DELINQUENCY_DUE_TO_DISASTER", "BORROWER_ASSISTANCE_STATUS_CODE", "CURRENT_MONTH_MODIFICATION_COST", "INTEREST_BEARING_UPB",
]
# Which of them hold numbers, counted from 1.
ORIGINATION_NUMBERS = [1, 5, 6, 7, 9, 10, 11, 12, 13, 19, 22, 23, 30]
PERFORMANCE_NUMBERS = [3, 5, 6, 9, 11, 12, 14, 16, 17, 18, 19, 20, 21, 22, 23, 26, 27, 28, 31, 32]
# The states whose unemployment series are read.
STATES = "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY".split()
# What the model sees, in this order, and what it predicts.
FEATURES = ["ORIGINAL_LOAN_TERM", "LOAN_AGE", "ORIGINAL_LOAN_TO_VALUE", "ORIGINAL_DEBT_TO_INCOME", "CREDIT_SCORE", "INTEREST_RATE_DIFF", "UNEMPLOYMENT"]
TARGET = "DELINQUENT"

KINDS = ("orig", "perf")
SUFFIX = {"orig": "orig", "perf": "svcg"}
TABLES = {"orig": "origination", "perf": "performance"}


def schema(kind: str) -> T.StructType:
    """The schema of a kind of vintage file; ValueError for other kinds."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}, not {kind!r}")
    names, numbers = (ORIGINATION_COLUMNS, ORIGINATION_NUMBERS) if kind == "orig" else (PERFORMANCE_COLUMNS, PERFORMANCE_NUMBERS)
    return T.StructType([T.StructField(c, T.DoubleType() if i in numbers else T.StringType()) for i, c in enumerate(names, 1)])


PREDICTION = T.StructType([
    T.StructField("LOAN_SEQUENCE_NUMBER", T.StringType()), T.StructField("MONTHLY_REPORTING_PERIOD", T.StringType()), T.StructField("DELINQUENT", T.IntegerType()), T.StructField("DELINQ_PROB", T.DoubleType()),
])
