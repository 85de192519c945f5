"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def starts_with_any(*patterns: str) -> str:
    """One anchored pattern from several code patterns: `^(a|b|c)`."""
    return f"^({'|'.join(patterns)})"


def sql_literal(value: str | int | float | None) -> str:
    """A value as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def flag(condition: Column) -> Column:
    """A condition as a boolean that is never null (null counts as false)."""
    return F.coalesce(condition, F.lit(False))


def share(value: str, *within: str) -> Column:
    """Share of the value in its group's total; null where the total is zero."""
    return F.try_divide(F.col(value), F.sum(value).over(Window.partitionBy(*within)))


def cap_age(age: Column, top: int = 90) -> Column:
    """Ages above `top` become `top`; null stays null."""
    return F.when(age > top, top).otherwise(age).cast("int")


def coded_age(age: Column, infant_from: int = 7000, top: int = 90) -> Column:
    """Ages from `infant_from` are codes for under one year; others are capped at `top`."""
    return F.when(age >= infant_from, 0).otherwise(cap_age(age, top)).cast("int")


# fixed values: upper bound of each age band and its label
AGE_BANDS = [
    (0, "0"),
    (4, "1-4"),
    (9, "5-9"),
    (15, "10-15"),
    (17, "16-17"),
    (34, "18-34"),
    (49, "35-49"),
    (64, "50-64"),
    (74, "65-74"),
    (84, "75-84"),
]


def age_band(age: Column, bands: Iterable[tuple[int, str]] = AGE_BANDS, last: str = "85+") -> Column:
    """Label of the first band whose upper bound is not below the age; null is `Unknown`."""
    label = F.when(age.isNull(), "Unknown")
    for upper, name in bands:
        label = label.when(age <= upper, name)
    return label.otherwise(last)


def five_year_band(age: Column, top: int = 90) -> Column:
    """`00-04`, `05-09`, ... and `90+`."""
    low = (F.floor(age / 5) * 5).cast("int")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return F.when(age >= top, f"{top}+").otherwise(F.concat(two(low), F.lit("-"), two(low + 4)))


# fixed values: specialties that keep their own code
OWN_SPECIALTIES = [
    "100", "101", "110", "120", "130", "140", "150", "160", "170",
    "300", "301", "320", "330", "340", "400", "410", "430", "502",
]
# fixed values: patterns of the grouped specialties
SURGICAL_SPECIALTY = "^1(?!80|9[02])"
MEDICAL_SPECIALTY = "^(1(80|9[02])|[2346]|5(?!60)|83[134])"


def specialty_group(specialty: Column) -> Column:
    """Listed specialties keep their code, the rest become surgical, medical or other."""
    return (
        F.when(specialty.isin(OWN_SPECIALTIES), specialty)
        .when(specialty.rlike(SURGICAL_SPECIALTY), "Other (Surgical)")
        .when(specialty.rlike(MEDICAL_SPECIALTY), "Other (Medical)")
        .otherwise("Other")
    )


# fixed values: procedures that do not count as having a procedure
UNCOUNTED_PROCEDURES = ["O(1[1-46]|28|3[01346]|4[2-8]|5[23])", "X[6-9]", "[UYZ]"]


def counted_procedure(code: Column) -> Column:
    """True for a procedure code outside the uncounted chapters (null stays null)."""
    return ~code.rlike(starts_with_any(*UNCOUNTED_PROCEDURES))


def quintile(decile: Column) -> Column:
    return (F.floor((decile - 1) / 2) + 1).cast("int")


def fyear_of_year(year: Column) -> Column:
    """Calendar year 2019 to financial year 201920."""
    return (year * 100 + (year + 1) % 100).cast("int")


def year_of_fyear(fyear: Column) -> Column:
    return F.floor(fyear / 100).cast("int")


def row_id(*columns: str) -> Column:
    """Identifier of a group, from its key: the same on every run."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))
