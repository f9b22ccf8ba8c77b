"""Cleaning rules on hand-written edge cases."""

from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import calendar, loans, text
from tidemark.operators import columns as cols
from tidemark.plans import silver

C = F.col


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(C("v"))).first()[0]


@pytest.mark.parametrize("raw, want", [
    ("12", 12), ("12_", 12), ("-500", -500), ("x7.9y", 7), ("", None), (None, None), ("abc", None), ("9999999999", None), ("+3", 3), (".5", 0),
])
def test_first_number_int(spark, raw, want):
    assert one(spark, raw, lambda c: text.first_number(c, "int")) == want


@pytest.mark.parametrize("raw, want", [("34847.84_", 34847.84), ("-5.5", -5.5), ("1.2345678E10", 1.2345678), ("_", None)])
def test_first_number_float(spark, raw, want):
    got = one(spark, raw, lambda c: text.first_number(c, "double"))
    assert got == want if want is None else got == pytest.approx(want)


def test_digits_only_loses_the_sign(spark):
    assert one(spark, "-5.5", lambda c: text.digits_only(c, "double")) == 5.5
    assert one(spark, "--", lambda c: text.digits_only(c, "double")) is None


@pytest.mark.parametrize("raw, want", [("28", 28), ("28_", None), ("12.7", 12), (" 7 ", 7), ("1e5", None), ("NaN", None), ("", None)])
def test_whole_number(spark, raw, want):
    assert one(spark, raw, text.whole_number) == want


@pytest.mark.parametrize("raw, counts", [
    ("Auto Loan, Auto Loan, and Payday Loan", {"auto_loan": 2, "payday_loan": 1}),
    ("Not Specified", {"not_specified": 1}),
    ("Auto Loan and Payday Loan", {"auto_loan": 1, "payday_loan": 1}),
    (" , ,", {}), (None, {}), ("Credit-Builder Loan", {"credit-builder_loan": 1}),
])
def test_loan_type_counts(spark, raw, counts):
    assert one(spark, raw, text.loan_type_counts) == counts


@pytest.mark.parametrize("raw, years, months, total, plural_total", [
    ("22 Years and 1 Months", 22, 1, 265, 265), ("1 Year and 3 Month", 1, 3, 15, None), ("9 Years", 9, None, None, 108), (None, None, None, None, None),
])
def test_durations(spark, raw, years, months, total, plural_total):
    df = spark.createDataFrame([(raw,)], "v string")
    y, m = text.duration_part(C("v"), fv.YEARS_ANY), text.duration_part(C("v"), fv.MONTHS_ANY)
    yp, mp = text.duration_part(C("v"), fv.YEARS_PLURAL), text.duration_part(C("v"), fv.MONTHS_PLURAL)
    got = df.select(y, m, text.total_months(y, m), text.total_months(yp, mp, missing_month_is_zero=True)).first()
    assert tuple(got) == (years, months, total, plural_total)


def test_behaviour(spark):
    assert one(spark, "High_spent_Small_value_payments", text.behaviour_spent) == "High"
    assert one(spark, "High_spent_Small_value_payments", text.behaviour_value) == "Small"
    assert one(spark, "!@9#%8", text.behaviour_spent) is None
    assert one(spark, "!@9#%8", text.behaviour_code) == "0"
    assert one(spark, None, text.behaviour_code) is None


def test_flags_and_sentinels(spark):
    assert one(spark, None, lambda c: text.flag(c == "Yes")) == 0
    assert one(spark, "_", lambda c: text.null_if_in(c, ["_"])) is None
    assert one(spark, None, lambda c: text.equals_flag(c, "a", null_is_zero=False)) is None
    assert one(spark, None, lambda c: text.equals_flag(c, "a", null_is_zero=True)) == 0


def test_json_never_fails(spark):
    assert one(spark, '{"a": "1"}', text.json_map) == {"a": "1"}
    assert one(spark, "['x', broken", text.json_map) == {}
    assert one(spark, '["a","b"]', text.json_list) == ["a", "b"]
    assert one(spark, "{oops", text.json_list) == []


LMS = [
    ("L1", "C1", 6, 100.0, 0.0, "2023-07-01"), ("L2", "C2", 6, 100.0, 100.0, "2023-07-01"), ("L3", "C3", 6, 100.0, 150.0, "2023-07-01"),
    ("L4", "C4", 6, 0.0, 50.0, "2023-07-01"), ("L5", "C5", 6, None, None, "2023-07-01"), ("L6", "C6", 5, 100.0, 100.0, "2023-07-01"),
    ("L7", "C7", 6, 100.0, 100.0, "2023-03-01"),
]


@pytest.fixture(scope="module")
def raw_lms(spark):
    df = spark.createDataFrame(LMS, "LOAN_ID string, Customer_ID string, installment_num int, due_amt double, overdue_amt double, snapshot_date string")
    return df.withColumns({
        "loan_start_date": F.lit("2023-01-01"), "tenure": F.lit(None).cast("int"), "loan_amt": F.lit(1000.0), "paid_amt": F.lit(None).cast("double"),
        "balance": F.lit("bad"),
    })


def test_days_past_due(raw_lms):
    got = rows(silver.lms(raw_lms), "loan_id", "installments_missed", "first_missed_date", "dpd")
    assert got == [
        ("L1", 0, None, 0), ("L2", 1, date(2023, 6, 1), 30), ("L3", 2, date(2023, 5, 1), 61), ("L4", 0, None, None),
        ("L5", 0, None, 0), ("L6", 1, date(2023, 6, 1), 30), ("L7", 1, date(2023, 2, 1), 28),
    ]


def test_zero_fill_covers_every_number(raw_lms):
    filled = silver.lms(raw_lms).where("loan_id = 'L5'").first()
    assert (filled.tenure, filled.paid_amt, filled.balance, filled.due_amt) == (0, 0.0, 0.0, 0.0)
    kept = silver.lms(raw_lms, zero_fill="missed").where("loan_id = 'L5'").first()
    assert (kept.tenure, kept.paid_amt, kept.installments_missed) == (None, None, 0)


def test_label_is_zero_without_dpd(spark):
    df = spark.createDataFrame([(None,), (29,), (30,)], "dpd int")
    assert [r[0] for r in df.select(loans.default_label(C("dpd"))).collect()] == [0, 0, 1]
    assert df.select(loans.label_definition()).first()[0] == "30dpd_6mob"


ATTR = [
    ("1", "Ann", "28", "123-45-6789", "Teacher"), ("2", "Ann ", "28_", "123-45-678", "_______"), ("3", "Bob", "-500", "#F%$D@*&8", ""),
    ("4", None, "121", None, None), ("5", "Eve", "120", "123-45-6789", " Clerk "), ("6", "Dan", "0", "1", "x"), ("7", None, "14", "1", "x"),
]


@pytest.fixture(scope="module")
def raw_attr(spark):
    return spark.createDataFrame(ATTR, "Customer_ID string, Name string, Age string, SSN string, Occupation string").withColumn(
        "snapshot_date", F.lit("2023-01-01")
    )


def test_attributes_main(raw_attr):
    got = rows(silver.attributes_main(raw_attr), "customer_id", "age", "ssn", "occupation")
    assert got == [
        ("1", 28, "123-45-6789", "Teacher"), ("2", 28, None, None), ("3", None, None, ""), ("4", None, None, None),
        ("5", 120, "123-45-6789", " Clerk "), ("6", 0, None, "x"), ("7", 14, None, "x"),
    ]


def test_attributes_retrofit(raw_attr):
    df = silver.attributes_retrofit(raw_attr)
    assert "name" not in df.columns and "ssn" not in df.columns
    got = rows(df, "customer_id", "age_valid", "ssn_valid", "occupation_known", "name_shared_count", "is_name_shared")
    assert got == [
        ("1", 1, 1, 1, 2, 1), ("2", 0, 0, 0, 2, 1), ("3", 0, 0, 0, 1, 0), ("4", 1, 0, 0, None, 0),
        ("5", 1, 1, 1, 1, 0), ("6", 0, 0, 1, 1, 0), ("7", 0, 0, 1, None, 0),
    ]


def _fin(spark, **values):
    base = {c: "1" for c in fv.FINANCIAL_TYPES}
    base.update({"credit_history_age": "9 Years", "payment_behaviour": None, "credit_mix": "_", "payment_of_min_amount": None, "type_of_loan": None})
    data = [{**base, **dict(zip(values, row))} for row in zip(*values.values())]
    schema = ", ".join(f"{c} string" for c in base)
    df = spark.createDataFrame([tuple(d[c] for c in base) for d in data], schema)
    return df.withColumns({"customer_id": F.monotonically_increasing_id().cast("string"), "snapshot_date": F.lit("2023-01-01").cast("date")})


def test_financials_main(spark):
    raw = _fin(spark, num_of_loan=["3_", "-100", None], annual_income=["34847.84_", "-5.5", "x"], credit_mix=["_", "Good", None])
    got = silver.financials_main(raw)
    assert "type_of_loan" not in got.columns and "payment_behaviour" not in got.columns
    assert dict(got.dtypes)["num_of_loan"] == "double"
    assert rows(got, "num_of_loan", "credit_mix") == [(3.0, None), (None, "Good"), (None, None)]


@pytest.mark.parametrize("method", ["approx", "exact"])
def test_clip_caps_at_the_quantile(spark, method):
    raw = _fin(spark, interest_rate=[str(i) for i in range(1, 101)])
    got = [r[0] for r in silver.financials_main(raw, clip_method=method).select("interest_rate").collect()]
    # relative error 0.01 allows the rank to be one off on 100 rows
    assert 96 <= max(got) <= 98 and min(got) == 1 and len(got) == 100
    if method == "exact":
        assert max(got) == 97


def test_clip_without_any_value(spark):
    raw = _fin(spark, interest_rate=[None, None])
    assert rows(silver.financials_main(raw), "interest_rate") == [(None,), (None,)]


def test_loan_types(spark):
    raw = _fin(spark, type_of_loan=["Auto Loan, Auto Loan, and Payday Loan", None, "Not Specified"])
    got = silver.loan_types(raw)
    assert got.columns[3:] == ["auto_loan", "not_specified", "payday_loan"]
    assert rows(got, "auto_loan", "not_specified", "payday_loan") == [(0, 0, 0), (0, 1, 0), (2, 0, 1)]
    fixed = silver.loan_types(raw, names=["auto_loan", "boat_loan"])
    assert rows(fixed, "auto_loan", "boat_loan") == [(0, 0), (0, 0), (2, 0)]


def test_financials_retrofit(spark):
    raw = _fin(
        spark, annual_income=["-5.5", "1", "1"], num_of_loan=["-100", "3_", "2"], payment_behaviour=["!@9#%8", None, "High_X"],
        credit_mix=["_", "Good", None], payment_of_min_amount=["Yes", "NM", None], credit_history_age=["1 Year and 3 Month", "9 Years", None],
        type_of_loan=["Auto Loan, Home-Equity Loan, and Payday Loan", "Not Specified", None],
    )
    got = silver.financials_retrofit(raw)
    picked = rows(got, "annual_income", "num_of_loan", "payment_of_min_amount", "credit_history_total_months", "auto_loan", "home_equity_loan",
                  "not_specified", "credit_mix_good", "valid_credit_mix", "has_valid_payment_behavior", "pb_0", "pb_high_x")
    assert picked == [
        (1.0, 2, 0, None, 0, 0, 0, 0, 0, 1, 0, 1), (1.0, None, 0, 108, 0, 0, 1, 1, 1, 0, None, None), (5.5, -100, 1, None, 1, 1, 0, 0, 0, 1, 1, 0),
    ]
    assert "payday_loan" not in got.columns and "type_of_loan" not in got.columns


def test_substring_indicator_marks_longer_names(spark):
    raw = _fin(spark, type_of_loan=["Personal Loan", "Big Personal Loan"])
    assert rows(silver.financials_retrofit(raw), "big_personal_loan", "personal_loan") == [(0, 1), (1, 1)]


def test_vocabulary_is_never_cut(spark):
    df = spark.range(20).select(C("id").cast("string").alias("v"))
    assert len(cols.vocabulary(df, F.array(C("v")))) == 20
    both = cols.vocabularies(df, {"v": F.array(C("v")), "w": F.array(F.lit("b"), F.lit("a"), F.lit(None))})
    assert len(both["v"]) == 20 and both["w"] == ["a", "b"]


def test_clickstream_drops_null_keys_only_in_retrofit(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), (None, "2024-01-01"), ("b", None)], "customer_id string, snapshot_date string")
    df = df.withColumns({c: F.lit("3") for c in fv.CLICK_FEATURES})
    assert silver.clickstream_main(df).count() == 3
    assert silver.clickstream_retrofit(df).count() == 1
    assert dict(silver.clickstream_main(df).dtypes)["fe_7"] == "int"


def test_unknown_table(spark, raw_attr):
    with pytest.raises(ValueError):
        silver.silver_table("nothing", raw_attr)


def test_calendar(spark):
    day = F.to_date(C("v"))
    window = one(spark, "2024-09-01", lambda c: calendar.training_window(F.to_date(c)))
    assert (len(window), window[0], window[-1]) == (12, date(2023, 9, 1), date(2024, 8, 1))
    assert one(spark, "2023-01-01", lambda c: calendar.trailing_weeks(F.to_date(c), 3)) == [date(2022, 12, 18), date(2022, 12, 25), date(2023, 1, 1)]
    long = one(spark, "2023-01-01", lambda c: calendar.trailing_weeks(F.to_date(c), 51))
    assert (len(long), long[0]) == (51, date(2022, 1, 16))
    days = spark.createDataFrame([("2024-05-01",), ("2024-06-01",), ("2024-07-01",), ("2024-09-01",)], "v string")
    assert [tuple(r) for r in days.select(calendar.lifecycle_phase(day), calendar.retraining_decision(day)).collect()] == [
        ("skip_run", "skip_retraining"), ("run_initial_training_flow", "trigger_retraining"),
        ("run_monthly_lifecycle_flow", "skip_retraining"), ("run_monthly_lifecycle_flow", "trigger_retraining"),
    ]
    assert one(spark, "x/gold_label_store_2023_07_01.parquet", calendar.period_in_path) == date(2023, 7, 1)
    assert one(spark, "no date", calendar.period_in_path) is None


def test_align_features(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert cols.align_features(df, ["b", "zz", "a"]).first().asDict() == {"b": 2, "zz": 0, "a": 1}
    assert cols.align_features(df, []).columns == ["a", "b"]
