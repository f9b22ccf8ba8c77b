"""Cleaning and decoding of dirty text columns, all as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark import fixed_values as fv


def whole_number(text: Column) -> Column:
    """Text to int; a fraction is cut off and anything else unreadable is NULL."""
    clean = F.trim(text.cast("string"))
    return F.when(clean.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)$"), _cut(clean))


def _cut(number: Column) -> Column:
    return number.try_cast("double").try_cast("int")


def parse(text: Column, kind: str) -> Column:
    """Lenient typed read of a text column: a bad value becomes NULL."""
    return whole_number(text) if kind == "int" else text.try_cast(kind)


def first_number(text: Column, kind: str = "float") -> Column:
    """First signed number found anywhere in the text."""
    found = F.regexp_extract(text.cast("string"), fv.FIRST_NUMBER, 1)
    return _cut(found) if kind == "int" else found.try_cast(kind)


def digits_only(text: Column, kind: str = "float") -> Column:
    """Keep digits and dots only, then read; the sign is lost."""
    return parse(F.regexp_replace(text.cast("string"), fv.NON_NUMERIC, ""), kind)


def keep_between(value: Column, low, high) -> Column:
    return F.when(value.between(low, high), value)


def keep_at_least(value: Column, low=0) -> Column:
    return F.when(value >= low, value)


def clip_above(value: Column, cap: Column) -> Column:
    """Cap at ``cap``; NULL stays NULL, and no cap (NULL) changes nothing."""
    value = value.cast("double")
    return F.when(value > cap, cap).otherwise(value)


def keep_matching(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(pattern), text)


def flag(condition: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.when(condition, 1).otherwise(0)


def null_if_in(text: Column, sentinels) -> Column:
    return F.when(text.isin(*sentinels), F.lit(None)).otherwise(text)


def duration_part(text: Column, pattern: str) -> Column:
    return F.regexp_extract(text, pattern, 1).try_cast("int")


def total_months(years: Column, months: Column, missing_month_is_zero: bool = False) -> Column:
    return years * 12 + (F.coalesce(months, F.lit(0)) if missing_month_is_zero else months)


def behaviour_spent(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, fv.BEHAVIOUR, 1), F.lit(""))


def behaviour_value(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, fv.BEHAVIOUR, 2), F.lit(""))


def behaviour_code(text: Column) -> Column:
    """Lower-cased behaviour; the garbage marker becomes the text ``0``."""
    low = F.lower(text)
    return F.when(low == fv.BAD_BEHAVIOUR, F.lit("0")).otherwise(low)


def age_is_valid(text: Column) -> Column:
    return flag(whole_number(text) >= fv.AGE_VALID_FROM)


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def loan_type_names(text: Column) -> Column:
    """``"Auto Loan, and Payday Loan"`` to ``["auto_loan", "payday_loan"]``; NULL gives []."""
    pieces = F.split(F.replace(text, F.lit(" and "), F.lit(",")), ",")
    names = F.transform(pieces, lambda p: F.lower(F.replace(_strip(p), F.lit(" "), F.lit("_"))))
    return F.coalesce(F.filter(names, lambda n: n != ""), F.array().cast("array<string>"))


def loan_type_counts(text: Column) -> Column:
    """Loan-type list to a map of name to number of mentions."""
    names = loan_type_names(text)
    return F.map_from_entries(
        F.transform(
            F.array_distinct(names),
            lambda n: F.struct(n.alias("key"), F.size(F.filter(names, lambda m: m == n)).alias("value")),
        )
    )


def count_of(counts: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(counts, F.lit(name)), F.lit(0))


def listed_loans(text: Column) -> Column:
    """The comma pieces of a loan list, trimmed."""
    return F.transform(F.split(text, r",\s*"), lambda p: F.trim(F.replace(p, F.lit(","), F.lit(""))))


def column_name(value: str) -> str:
    return value.replace(" ", "_").replace("-", "_").lower()


def equals_flag(value: Column, wanted, null_is_zero: bool) -> Column:
    same = value == F.lit(wanted)
    return flag(same) if null_is_zero else same.cast("int")


def first_match(text: Column, pattern: str) -> Column:
    """First capture group or NULL."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def json_map(text: Column, value_type: str = "string") -> Column:
    """JSON object to map; malformed text gives an empty map instead of an error."""
    kind = f"map<string,{value_type}>"
    return F.coalesce(F.from_json(text, kind), F.create_map().cast(kind))


def json_list(text: Column) -> Column:
    kind = "array<string>"
    return F.coalesce(F.from_json(text, kind), F.array().cast(kind))
