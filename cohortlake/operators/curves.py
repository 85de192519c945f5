"""Activity rates by age, and smooth curves through them."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.functions.expressions import fyear_of_year
from cohortlake.operators.extracts import PRINCIPAL_VARIANT
from cohortlake.operators.population import ENGLISH_DISTRICT

# fixed values
LEFT_OUT_GROUPS = ["birth", "maternity", "paeds", "unknown"]
CHILDRENS_HOSPITALS = ["RBS", "RP4", "REP", "RQ3", "RAE"]
ADULT = 18


def activity_counts(ip: DataFrame, op: DataFrame, ae: DataFrame, years: Sequence[int], place: Sequence[str]) -> DataFrame:
    """Activity of the three extracts by year, place, age, sex and activity group."""
    keys = ["fyear", *place, "age", "sex", "hsagrp"]
    counts = (
        ip.select(*keys, F.lit(1).cast("long").alias("count"))
        .unionByName(op.select(*keys, F.col("attendances").cast("long").alias("count")))
        .unionByName(ae.select(*keys, F.col("arrivals").cast("long").alias("count")))
    )
    return (
        counts.filter(F.col("fyear").isin(list(years)) & ~F.col("hsagrp").isin(LEFT_OUT_GROUPS))
        .groupBy(*keys)
        .agg(F.sum("count").alias("count"))
    )


def _rates(activity: DataFrame, population: DataFrame, place: str) -> DataFrame:
    """Activity per head at every adult age, without the groups that have no activity at all.

    `population`: place, variant, age, sex, year, value.
    """
    activity = activity.filter((F.col("age") >= ADULT) & ~F.col("hsagrp").startswith("op_maternity_"))
    group = [place, "hsagrp", "sex", "fyear"]
    people = population.filter((F.col("variant") == PRINCIPAL_VARIANT) & (F.col("age") >= ADULT)).select(
        place, F.col("year").alias("fyear"), "age", "sex", F.col("value").alias("pop")
    )
    asked = activity.select(place, "sex", "hsagrp").distinct()
    rate = F.try_divide(F.coalesce("count", F.lit(0)), F.col("pop"))
    all_zero = F.bool_and(F.col("activity_rate") == 0).over(Window.partitionBy(*group))
    return (
        people.join(asked, [place, "sex"])
        .join(activity, [*group, "age"], "left")
        .select(*group, "age", rate.alias("activity_rate"))
        .withColumn("_zero", F.coalesce(all_zero, F.lit(False)))
        .filter(~F.col("_zero"))
        .drop("_zero")
    )


def provider_rates(
    ip: DataFrame,
    op: DataFrame,
    ae: DataFrame,
    population: DataFrame,
    years: Sequence[int],
    left_out: Sequence[str] = CHILDRENS_HOSPITALS,
) -> DataFrame:
    """Rates by provider (`dataset`); children's hospitals are left out."""
    activity = activity_counts(ip, op, ae, years, ["dataset"]).filter(~F.col("dataset").isin(list(left_out)))
    return _rates(activity, population.filter(F.col("year").isin(list(years))), "dataset")


def icb_rates(ip: DataFrame, op: DataFrame, ae: DataFrame, population: DataFrame, years: Sequence[int]) -> DataFrame:
    """Rates by ICB, with the population projected for the same year."""
    return _rates(
        activity_counts(ip, op, ae, years, ["icb"]), population.filter(F.col("year").isin(list(years))), "icb"
    )


def national_rates(ip: DataFrame, op: DataFrame, ae: DataFrame, projections: DataFrame, years: Sequence[int]) -> DataFrame:
    """National rates of the ages that have activity, with the population of the same year."""
    people = (
        projections.filter(
            F.col("area_code").rlike(ENGLISH_DISTRICT)
            & (F.col("projection") == PRINCIPAL_VARIANT)
            & (F.col("age") >= ADULT)
            & F.col("year").isin(list(years))
        )
        .groupBy(F.col("year").alias("fyear"), "age", "sex")
        .agg(F.sum("value").alias("pop"))
    )
    return (
        activity_counts(ip, op, ae, years, [])
        .join(people, ["fyear", "age", "sex"])
        .select("hsagrp", "sex", "fyear", "age", F.try_divide(F.col("count"), F.col("pop")).alias("activity_rate"))
    )


# --- smooth curves -------------------------------------------------------------------------------

SPLINES = 20
DEGREE = 3
SMOOTHING = np.logspace(-3, 3, 11)
# effective degrees of freedom count this much in the generalised cross-validation score
GCV_WEIGHT = 1.4


def _basis(x: np.ndarray, low: float, high: float) -> np.ndarray:
    """Cubic B-splines on equal intervals of [low, high]; linear beyond the ends."""
    width = (high - low) / (SPLINES - DEGREE)
    knots = low + width * np.arange(-DEGREE, SPLINES + 1)

    def splines(points: np.ndarray, degree: int) -> np.ndarray:
        at = points[:, None]
        values = ((at >= knots[:-1]) & (at < knots[1:])).astype(float)
        for d in range(1, degree + 1):
            rising = (at - knots[: -d - 1]) / (d * width) * values[:, :-1]
            falling = (knots[d + 1 :] - at) / (d * width) * values[:, 1:]
            values = rising + falling
        return values

    inside = np.clip(x, low, high)
    # the last point belongs to the last interval
    inside = np.where(inside >= high, np.nextafter(high, low), inside)
    values = splines(inside, DEGREE)
    lower = splines(inside, DEGREE - 1)
    slopes = (lower[:, :-1] - lower[:, 1:]) / width
    return values + (x - np.clip(x, low, high))[:, None] * slopes


def smooth_curve(
    ages: np.ndarray, rates: np.ndarray, weights: np.ndarray, at: np.ndarray, spread: float = 0.0
) -> np.ndarray:
    """Penalised spline through the rates, evaluated at the ages `at`.

    The second-difference penalty is chosen from a grid by generalised cross-validation. `weights` are the
    rows behind each rate, `spread` the sum of their squared distances from it.
    """
    if np.unique(ages).size < 2:
        return np.full(at.shape, np.average(rates, weights=weights))
    low, high = float(ages.min()), float(ages.max())
    design = _basis(ages.astype(float), low, high)
    second = np.diff(np.eye(SPLINES), n=2, axis=0)
    gram = design.T @ (weights[:, None] * design)
    target = design.T @ (weights * rates)
    ridge = 1e-9 * np.trace(gram) / SPLINES * np.eye(SPLINES)
    n = weights.sum()
    best = None
    for strength in SMOOTHING:
        inverse = np.linalg.pinv(gram + strength * second.T @ second + ridge)
        coefficients = inverse @ target
        freedom = np.trace(inverse @ gram)
        error = spread + float(np.sum(weights * (rates - design @ coefficients) ** 2))
        score = n * error / max(n - GCV_WEIGHT * freedom, 1e-9) ** 2
        if best is None or score < best[0]:
            best = (score, coefficients)
    return _basis(at.astype(float), low, high) @ best[1]


def fit_curves(rates: DataFrame, keys: Sequence[str], last_age: int = 100) -> DataFrame:
    """Smooth activity at ages 0 to `last_age` for each group; `fyear` becomes a financial year.

    Rates are first reduced to one row per group and age, so a group handed to a task has at most
    one row per year of age.
    """
    keys = list(keys)
    per_age = rates.groupBy(*keys, "age").agg(
        F.avg("activity_rate").alias("rate"),
        F.count("activity_rate").cast("double").alias("weight"),
        (F.var_pop("activity_rate") * F.count("activity_rate")).alias("spread"),
    )
    fields = {f.name: f for f in rates.schema.fields}
    schema = T.StructType(
        [fields[k] for k in keys]
        + [T.StructField("age", T.IntegerType()), T.StructField("activity", T.DoubleType())]
    )

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("age")
        at = np.arange(last_age + 1)
        curve = smooth_curve(
            group["age"].to_numpy(),
            group["rate"].to_numpy(float),
            group["weight"].to_numpy(float),
            at,
            float(group["spread"].sum()),
        )
        return pd.DataFrame({**{k: group[k].iloc[0] for k in keys}, "age": at.astype("int32"), "activity": curve})

    fitted = per_age.filter(F.col("weight") > 0).groupBy(*keys).applyInPandas(fit, schema)
    return fitted.withColumn("fyear", fyear_of_year(F.col("fyear"))) if "fyear" in keys else fitted
