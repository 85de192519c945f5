"""Extracts for the demand model: one year of each table, and projections by provider or ICB."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.expressions import year_of_fyear
from cohortlake.operators.reference import acute_codes

# fixed values: years and variants of the projections that are extracted
PROJECTED_YEARS = range(2023, 2048)
VARIANTS = [
    "migration_category",
    "var_proj_5_year_migration",
    "var_proj_10_year_migration",
    "var_proj_high_intl_migration",
    "var_proj_low_intl_migration",
    "var_proj_zero_net_migration",
]
PRINCIPAL_VARIANT = "migration_category"


def _of_year(df: DataFrame, fyear: int) -> DataFrame:
    """Rows of a financial year, with provider as dataset and the calendar year it starts in as fyear."""
    return (
        df.filter(F.col("fyear") == fyear)
        .withColumnRenamed("provider", "dataset")
        .withColumn("fyear", year_of_fyear(F.col("fyear")))
    )


def ip_extract(ip: DataFrame, fyear: int) -> DataFrame:
    return (
        _of_year(ip, fyear)
        .withColumnRenamed("epikey", "rn")
        .withColumn("sex", F.col("sex").cast("int"))
        .withColumn("sushrg_trimmed", F.substring("sushrg", 1, 4))
    )


def cohort_extract(cohorts: DataFrame, extract: DataFrame, fyear: int, type: str) -> DataFrame:
    """Memberships of one type for the spells of an inpatient extract."""
    return (
        cohorts.filter((F.col("type") == type) & (F.col("fyear") == fyear))
        .select(F.col("provider").alias("dataset"), F.col("epikey").alias("rn"), "strategy", "sample_rate")
        .join(extract.select("dataset", "fyear", "rn"), ["dataset", "rn"])
        .select("dataset", "fyear", "rn", "strategy", "sample_rate")
    )


def op_extract(op: DataFrame, inequalities: DataFrame, fyear: int) -> DataFrame:
    """Outpatient rollup of a year, without HRG and quintile where no inequality was found for them.

    The rows that lose their HRG are added up again (with the lowest index); the others are kept as
    they are, which grouping them by their own index does in the same step.
    """
    found = (
        inequalities.filter(F.col("fyear") == fyear)
        .select("icb", F.col("provider").alias("dataset"), "sushrg_trimmed", F.lit(True).alias("_found"))
        .distinct()
    )
    rows = _of_year(op, fyear).withColumn("is_wla", F.lit(True))
    labels = [c for c in rows.columns if c not in ("index", "attendances", "tele_attendances")]
    kept = F.col("_found").isNotNull()
    return (
        rows.join(found, ["icb", "dataset", "sushrg_trimmed"], "left")
        .withColumn("_own", F.when(kept, F.col("index")))
        .withColumn("sushrg_trimmed", F.when(kept, F.col("sushrg_trimmed")))
        .withColumn("imd_quintile", F.when(kept, F.col("imd_quintile")))
        .groupBy(*labels, "_own")
        .agg(
            F.sum("attendances").alias("attendances"),
            F.sum("tele_attendances").alias("tele_attendances"),
            F.min("index").alias("index"),
        )
        .drop("_own")
    )


def ae_extract(ae: DataFrame, fyear: int) -> DataFrame:
    return _of_year(ae, fyear)


def inequalities_extract(inequalities: DataFrame, ip: DataFrame, fyear: int) -> DataFrame:
    """Inequalities of a year; providers without any get an empty row."""
    providers = ip.filter(F.col("fyear") == fyear).select("provider").distinct()
    return (
        inequalities.filter(F.col("fyear") == fyear)
        .join(providers, "provider", "right")
        .withColumn("fyear", F.lit(fyear // 100))
        .withColumnRenamed("provider", "dataset")
    )


# --- projections ---------------------------------------------------------------------------------


def _wanted(projections: DataFrame, base_year: int, years: Sequence[int], variants: Sequence[str]) -> DataFrame:
    return projections.filter(
        (F.col("projection_year") == base_year)
        & F.col("projection").isin(list(variants))
        & F.col("year").between(min(years), max(years))
    ).withColumnRenamed("projection", "variant")


def provider_population(
    projections: DataFrame,
    split: DataFrame,
    trusts: DataFrame,
    districts: DataFrame,
    fyear: int,
    base_year: int = 2022,
    years: Sequence[int] = PROJECTED_YEARS,
    variants: Sequence[str] = VARIANTS,
) -> DataFrame:
    """Projected population of each acute provider's catchment: dataset, variant, age, sex, year, value."""
    shares = (
        split.filter(F.col("fyear") == fyear)
        .join(acute_codes(trusts), "provider", "left_semi")
        .select("lad23cd", "age", "sex", F.col("provider").alias("dataset"), "lad23_pcnt")
    )
    return (
        _wanted(projections, base_year, years, variants)
        .join(districts.select(F.col("lad22cd").alias("area_code"), "lad23cd"), "area_code")
        .join(shares, ["lad23cd", "age", "sex"])
        .groupBy("dataset", "variant", "age", "sex", "year")
        .agg(F.sum(F.col("value") * F.col("lad23_pcnt")).alias("value"))
    )


def icb_population(
    projections: DataFrame,
    shares: DataFrame,
    base_year: int = 2022,
    years: Sequence[int] = PROJECTED_YEARS,
    variants: Sequence[str] = VARIANTS,
) -> DataFrame:
    """Projected population of each ICB, from the shares of the districts in it."""
    return (
        _wanted(projections, base_year, years, variants)
        .join(shares, "area_code")
        .groupBy("icb", "variant", "age", "sex", "year")
        .agg(F.sum(F.col("value") * F.col("pcnt")).alias("value"))
    )


def by_year(population: DataFrame, years: Sequence[int] = PROJECTED_YEARS) -> DataFrame:
    """One column per year, from a fixed list (so no pass over the data to find the years)."""
    keys = [c for c in population.columns if c not in ("year", "value")]
    return population.groupBy(*keys).pivot("year", list(years)).agg(F.sum("value"))


def birth_factors(
    births: DataFrame,
    split: DataFrame,
    trusts: DataFrame,
    districts: DataFrame,
    fyear: int,
    base_year: int = 2022,
    years: Sequence[int] = PROJECTED_YEARS,
) -> DataFrame:
    """Projected births by mother's age for each provider, one column per year."""
    mothers = births.withColumn("sex", F.lit(2))
    return by_year(provider_population(mothers, split, trusts, districts, fyear, base_year, years), years)


def custom_birth_factors(
    births: DataFrame,
    demographics: DataFrame,
    dataset: str,
    custom: str,
    years: Sequence[int] = PROJECTED_YEARS,
    principal: str = PRINCIPAL_VARIANT,
) -> DataFrame:
    """Birth factors of a provider with a custom variant added.

    The principal births are scaled, by age and year, by the custom over the principal number of
    women aged 15 to 44. Both inputs have one column per year.
    """
    columns = [str(y) for y in years]
    women = demographics.filter((F.col("dataset") == dataset) & (F.col("sex") == 2) & F.col("age").between(15, 44))

    def variant(df: DataFrame, name: str, prefix: str) -> DataFrame:
        return df.filter(F.col("variant") == name).select("age", *[F.col(c).alias(prefix + c) for c in columns])

    own = births.filter(F.col("dataset") == dataset)
    scaled = (
        variant(own, principal, "b")
        .join(variant(women, principal, "p"), "age")
        .join(variant(women, custom, "c"), "age")
        .select(
            F.lit(dataset).alias("dataset"),
            F.lit(custom).alias("variant"),
            "age",
            F.lit(2).alias("sex"),
            *[F.try_divide(F.col(f"b{c}") * F.col(f"c{c}"), F.col(f"p{c}")).alias(c) for c in columns],
        )
    )
    return own.select("dataset", "variant", "age", "sex", *columns).unionByName(scaled)
