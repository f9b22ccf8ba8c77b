"""Patterns, word lists, dates, ranges and column names that the
results depend on. They are data, not logic; change one and results change."""

# --- text patterns -----------------------------------------------------------
FIRST_NUMBER = r"([-+]?\d*\.?\d+)"
NON_NUMERIC = r"[^0-9.]"
SSN = r"^\d{3}-\d{2}-\d{4}$"
YEARS_ANY = r"(\d+)\s+Year"
MONTHS_ANY = r"(\d+)\s+Month"
YEARS_PLURAL = r"(\d+) Years"
MONTHS_PLURAL = r"(\d+) Months"
BEHAVIOUR = r"(Low|High)_spent_(Small|Medium|Large)_value"
LEADING_AND = r"(?i)^and\b.*"
RUN_ID_IN_LOG = r"(?i)run_id[:\s]+([a-f0-9]+)"
MACRO_F1_IN_LOG = r"(?i)Macro F1 Score[:\s]+([0-9.]+)"

# --- sentinels ---------------------------------------------------------------
NO_OCCUPATION = "_______"
NO_CREDIT_MIX = "_"
BAD_BEHAVIOUR = "!@9#%8"
NO_LOAN_TYPE = ("NULL", "Not Specified")
CREDIT_MIXES = ("Good", "Bad", "Standard")
HIGH_RISK_GRADES = ("D", "E", "F", "G")

# --- thresholds --------------------------------------------------------------
AGE_MIN, AGE_MAX = 0, 120
AGE_VALID_FROM = 15
CLIP_QUANTILE = 0.97
CLIP_RELATIVE_ERROR = 0.01
LABEL_MOB, LABEL_DPD = 6, 30
FALSE_POSITIVE_COST, FALSE_NEGATIVE_COST = 100, 1000
EMPTY_BIN_SHARE = 0.0001

# --- lifecycle dates ---------------------------------------------------------
STATIC_LOAD_DATE = "2023-01-01"
INITIAL_TRAINING_DATE = "2024-06-01"
RETRAIN_DATES = ("2024-06-01", "2024-09-01", "2024-12-01")
INITIAL_WINDOW = ("2023-07-01", "2024-06-01")

# --- column types of the loan tables ----------------------------------------
CLICK_FEATURES = tuple(f"fe_{i}" for i in range(1, 21))
LMS_TYPES = {
    "loan_id": "string", "customer_id": "string", "loan_start_date": "date",
    "tenure": "int", "installment_num": "int", "loan_amt": "float",
    "due_amt": "float", "paid_amt": "float", "overdue_amt": "float",
    "balance": "float", "snapshot_date": "date",
}
CLICK_TYPES = {**{c: "int" for c in CLICK_FEATURES}, "customer_id": "string", "snapshot_date": "date"}
ATTRIBUTE_TYPES = {
    "customer_id": "string", "name": "string", "age": "int", "ssn": "string",
    "occupation": "string", "snapshot_date": "date",
}
FINANCIAL_TYPES = {
    "annual_income": "float", "monthly_inhand_salary": "float", "num_bank_accounts": "int",
    "num_credit_card": "int", "interest_rate": "int", "num_of_loan": "int",
    "delay_from_due_date": "int", "num_of_delayed_payment": "int",
    "changed_credit_limit": "float", "num_credit_inquiries": "float",
    "outstanding_debt": "float", "credit_utilization_ratio": "float",
    "total_emi_per_month": "float", "amount_invested_monthly": "float", "monthly_balance": "float",
}
NON_NEGATIVE = ("num_of_loan", "delay_from_due_date", "num_of_delayed_payment")
CLIPPED = ("num_bank_accounts", "num_credit_card", "interest_rate", "num_of_loan", "num_of_delayed_payment")
RETROFIT_FLOATS = (
    "monthly_inhand_salary", "interest_rate", "delay_from_due_date", "num_of_delayed_payment",
    "changed_credit_limit", "num_credit_inquiries", "outstanding_debt", "credit_utilization_ratio",
    "total_emi_per_month", "amount_invested_monthly", "monthly_balance",
)
RETROFIT_COUNTS = ("num_bank_accounts", "num_credit_card", "num_of_loan")
ENCODED = ("occupation", "payment_of_min_amount", "credit_mix", "payment_behaviour_spent", "payment_behaviour_value")
RETROFIT_GOLD_DROPS = (
    "credit_mix", "payment_behaviour", "customer_id", "occupation", "label", "label_def",
    "loan_start_date", "installment_num", "first_missed_date",
)
TRAINING_EXCLUDES = ("loan_id", "snapshot_date", "label")
SCORING_EXCLUDES = (
    "id", "loan_id", "customer_id", "snapshot_date", "earliest_cr_date", "snapshot_month",
    "earliest_cr_month", "months_since_earliest_cr_line", "label_def", "grade_encoded",
)
# inputs the label itself is computed from
LABEL_INPUTS = ("dpd", "overdue_amt", "installments_missed", "first_missed_date")

# columns that the main feature store leaves out once they are parsed or encoded
MAIN_GOLD_DROPS = ("name", "ssn", "type_of_loan", "credit_history_age")
# names of lifecycle phases and decisions, availability states and report messages, as stored and read elsewhere
PHASE_SKIP, PHASE_INITIAL, PHASE_MONTHLY = "skip_run", "run_initial_training_flow", "run_monthly_lifecycle_flow"
RETRAIN, NO_RETRAIN = "trigger_retraining", "skip_retraining"
DATA_AVAILABLE, DATA_UNAVAILABLE = "data_available", "data_unavailable"
EVALUATION_SKIPPED = "Week after retraining event, skipping evaluation."
NO_PREVIOUS_METRICS = "No metrics for previous week "
EVALUATED = "success"
