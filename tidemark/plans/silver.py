"""Typed and cleaned tables, in two variants.

``main`` repairs numbers, redacts and clips; ``retrofit`` keeps more rows as they
are and adds validity flags and indicator columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import fixed_values as fv
from tidemark.functions import loans, text
from tidemark.operators.columns import cast_columns, drop_null_keys, lower_names, vocabularies, vocabulary
from tidemark.operators.ordered import exact_quantiles
from tidemark.operators.quality import shared_name_counts
from tidemark.sources import snapshots


# --- loans, both variants ----------------------------------------------------
def lms(raw: DataFrame, zero_fill: str = "all") -> DataFrame:
    """Loan snapshots with missed instalments, first missed date and days past due.

    ``zero_fill="all"`` turns every numeric NULL of the row into 0, as the stored
    tables have it; ``"missed"`` only the missed instalments.
    """
    typed = cast_columns(lower_names(raw), fv.LMS_TYPES)
    missed = loans.installments_missed(F.col("overdue_amt"), F.col("due_amt"))
    counted = typed.withColumns({"mob": F.col("installment_num"), "installments_missed": missed})
    counted = counted.fillna(0) if zero_fill == "all" else counted.fillna(0, subset=["installments_missed"])
    dated = counted.withColumn(
        "first_missed_date", loans.first_missed_date(F.col("snapshot_date"), F.col("installments_missed"))
    )
    return dated.withColumn(
        "dpd", loans.days_past_due(F.col("snapshot_date"), F.col("first_missed_date"), F.col("overdue_amt"))
    )


# --- main --------------------------------------------------------------------
def attributes_main(raw: DataFrame) -> DataFrame:
    df = lower_names(raw)
    repaired = {
        "age": text.keep_between(text.first_number(F.col("age"), "int"), fv.AGE_MIN, fv.AGE_MAX),
        "ssn": text.keep_matching(F.col("ssn"), fv.SSN),
        "occupation": text.null_if_in(F.col("occupation"), [fv.NO_OCCUPATION]),
    }
    return cast_columns(df, {k: v for k, v in fv.ATTRIBUTE_TYPES.items() if k not in repaired}).withColumns(repaired)


def clickstream_main(raw: DataFrame) -> DataFrame:
    return cast_columns(lower_names(raw), fv.CLICK_TYPES)


def clip_caps(df: DataFrame, columns: Sequence[str], method: str = "approx", q: float = fv.CLIP_QUANTILE) -> Column:
    """One struct of upper caps: a bounded sketch per column, or the exact ranks of all columns in one pass."""
    if method == "approx":
        accuracy = int(1 / fv.CLIP_RELATIVE_ERROR)
        return df.agg(
            F.struct(*[F.percentile_approx(F.col(c), q, accuracy).cast("double").alias(c) for c in columns]).alias("caps")
        ).scalar()
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(F.explode(pairs).alias("p")).select("p.name", "p.value")
    ranked = exact_quantiles(long, "value", [q], interpolate=False, within=["name"])
    found = {row.name: row.quantiles[0] for row in ranked.collect()}  # one row per clipped column
    return F.struct(*[F.lit(found.get(c)).cast("double").alias(c) for c in columns])


def financials_main(raw: DataFrame, clip_method: str = "approx") -> DataFrame:
    df = lower_names(raw)
    numbers = {c: text.first_number(F.col(c), kind) for c, kind in fv.FINANCIAL_TYPES.items()}
    age, behaviour = F.col("credit_history_age"), F.col("payment_behaviour")
    derived = {
        "credit_history_age_year": text.duration_part(age, fv.YEARS_ANY),
        "credit_history_age_month": text.duration_part(age, fv.MONTHS_ANY),
        "payment_behaviour_spent": text.behaviour_spent(behaviour),
        "payment_behaviour_value": text.behaviour_value(behaviour),
        "credit_mix": text.null_if_in(F.col("credit_mix"), [fv.NO_CREDIT_MIX]),
    }
    # the range check reads a parsed value twice, so parsing stays a projection of its own
    kept = {c: text.keep_at_least(F.col(c)) for c in fv.NON_NEGATIVE}
    cleaned = df.withColumns(numbers).withColumns({**derived, **kept})
    capped = cleaned.withColumn("_caps", clip_caps(cleaned, fv.CLIPPED, clip_method))
    clipped = {c: text.clip_above(F.col(c), F.col("_caps")[c]) for c in fv.CLIPPED}
    return capped.withColumns(clipped).drop("_caps", "payment_behaviour", "type_of_loan")


def loan_types(raw: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One count column per loan type. ``names`` fixes the columns; else they come from the data."""
    df = lower_names(raw).select("customer_id", "snapshot_date", "type_of_loan")
    if names is None:
        names = vocabulary(df, text.loan_type_names(F.col("type_of_loan")))
    counted = df.withColumn("_counts", text.loan_type_counts(F.col("type_of_loan")))
    return counted.select(
        "customer_id", "snapshot_date", "type_of_loan", *[text.count_of(F.col("_counts"), n).alias(n) for n in names]
    )


# --- retrofit ----------------------------------------------------------------
def clickstream_retrofit(raw: DataFrame) -> DataFrame:
    return drop_null_keys(cast_columns(lower_names(raw), fv.CLICK_TYPES), ["customer_id", "snapshot_date"])


def attributes_retrofit(raw: DataFrame) -> DataFrame:
    df = lower_names(raw)
    occupation = text.null_if_in(F.trim("occupation"), [fv.NO_OCCUPATION, ""])
    flagged = df.withColumns({
        "name": F.trim("name"),
        "occupation": occupation,
        "ssn_valid": text.flag(F.col("ssn").rlike(fv.SSN)),
        "occupation_known": text.flag(occupation.isNotNull()),
        "age_valid": text.age_is_valid(F.col("age")),
        "age": text.whole_number(F.col("age")),
    })
    return shared_name_counts(flagged, "name").drop("name", "ssn")


def _loan_pieces() -> Column:
    """List pieces that do not begin with "and"."""
    return F.filter(text.listed_loans(F.col("type_of_loan")), lambda p: ~p.rlike(fv.LEADING_AND) & (p != ""))


def retrofit_loan_names(raw: DataFrame) -> list[str]:
    """Loan names used as indicator columns."""
    return vocabulary(lower_names(raw), _loan_pieces())


def retrofit_behaviours(raw: DataFrame) -> list[str]:
    return vocabulary(lower_names(raw), F.array(text.behaviour_code(F.col("payment_behaviour"))))


def financials_retrofit(
    raw: DataFrame, loan_names: Sequence[str] | None = None, behaviours: Sequence[str] | None = None
) -> DataFrame:
    df = lower_names(raw)
    if loan_names is None or behaviours is None:
        found = vocabularies(df, {"loans": _loan_pieces(), "behaviours": F.array(text.behaviour_code(F.col("payment_behaviour")))})
        loan_names = found["loans"] if loan_names is None else loan_names
        behaviours = found["behaviours"] if behaviours is None else behaviours
    listed, age = F.col("type_of_loan"), F.col("credit_history_age")
    years, months = text.duration_part(age, fv.YEARS_PLURAL), text.duration_part(age, fv.MONTHS_PLURAL)
    mix = text.null_if_in(F.col("credit_mix"), [fv.NO_CREDIT_MIX])
    code = text.behaviour_code(F.col("payment_behaviour"))
    new: dict[str, Column] = {"annual_income": text.digits_only(F.col("annual_income"))}
    new.update({c: F.col(c).cast("string").try_cast("float") for c in fv.RETROFIT_FLOATS})
    new.update({c: text.whole_number(F.col(c)) for c in fv.RETROFIT_COUNTS})
    new["payment_of_min_amount"] = text.flag(F.col("payment_of_min_amount") == "Yes")
    new["credit_history_years"] = years
    new["credit_history_months"] = months
    new["credit_history_total_months"] = text.total_months(years, months, missing_month_is_zero=True)
    # substring test on purpose: a short name also marks longer names that hold it
    new.update({text.column_name(n): text.flag(F.contains(listed, F.lit(n))) for n in loan_names})
    new["credit_mix"] = mix
    new.update({f"credit_mix_{m.lower()}": text.equals_flag(mix, m, null_is_zero=True) for m in fv.CREDIT_MIXES})
    new["valid_credit_mix"] = text.flag(mix.isin(*fv.CREDIT_MIXES))
    new["payment_behaviour"] = code
    new["has_valid_payment_behavior"] = code.isNotNull().cast("int")
    new.update({f"pb_{b}": text.equals_flag(code, b, null_is_zero=False) for b in behaviours})
    return df.withColumns(new).drop("credit_history_age", "type_of_loan")


# --- dispatch ----------------------------------------------------------------
RECIPES: Mapping[str, Mapping] = {
    "main": {
        "attributes": attributes_main, "clickstream": clickstream_main, "financials": financials_main,
        "lms": lms, "loan_type": loan_types,
    },
    "retrofit": {
        "attributes": attributes_retrofit, "clickstream": clickstream_retrofit,
        "financials": financials_retrofit, "lms": lms,
    },
}


def silver_table(table: str, raw: DataFrame, variant: str = "retrofit", **options) -> DataFrame:
    try:
        recipe = RECIPES[variant][table.lower()]
    except KeyError:
        raise ValueError(f"unknown table {table!r} for variant {variant!r}") from None
    return recipe(raw, **options)


def write_silver(spark: SparkSession, bronze: str, silver: str, table: str, day: str, variant: str = "retrofit", **options) -> bool:
    """One table of one month from bronze to stored silver; False when bronze has no rows for it.

    Static tables are loaded once, whatever the day. In the main variant the financials also store the derived ``loan_type`` table.
    """
    name = table.lower()
    raw = snapshots.read_silver(spark, bronze, name, day)
    if raw is None or raw.isEmpty():
        return False
    if name not in snapshots.STATIC_TABLES:
        snapshots.write_snapshot(silver_table(name, raw, variant, **options), f"{silver}/{name}", day)
        return True
    # recipes run jobs when they are called, so a table that is there is not made again
    if not snapshots.is_loaded(spark, f"{silver}/{name}"):
        snapshots.write_once(silver_table(name, raw, variant, **options), f"{silver}/{name}")
    if name == "financials" and "loan_type" in RECIPES[variant] and not snapshots.is_loaded(spark, f"{silver}/loan_type"):
        snapshots.write_once(silver_table("loan_type", raw, variant), f"{silver}/loan_type")
    return True
