"""Population projections: wide files to long tables, and national projections rescaled to areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values
TOTAL_ROW = "All ages"
OPEN_AGE_GROUP = "90 and over"
ENGLISH_DISTRICT = "^E0[6-9]"
# the local variant that national variants are rescaled from, by base year
PRINCIPAL = {2018: "principal_proj", 2022: "migration_category"}
VARIANT_NAMES = {
    "hhh": "high_population",
    "hlh": "young_age_structure",
    "hpp": "high_fertility",
    "lhl": "old_age_structure",
    "lll": "low_population",
    "lpp": "low_fertility",
    "php": "high_life_expectancy",
    "plp": "low_life_expectancy",
    "pnp": "no_mortality_improvement",
    "pph": "high_intl_migration",
    "ppl": "low_intl_migration",
    "ppz": "zero_net_migration",
    "rpp": "replacement_fertility",
    "cnp": "const_fertility_no_mortality_improvement",
    "cpp": "const_fertility",
    "ppr": "half_eu_migration",
    "ppq": "zero_eu_migration",
}


def years_covered(base_year: int) -> range:
    """26 years from the base year, or 27 for the bases before 2022."""
    return range(base_year, base_year + (26 if base_year == 2022 else 27))


def _local(wide: DataFrame, years: range, extra: list[str]) -> DataFrame:
    age = F.when(F.col("AGE_GROUP") == OPEN_AGE_GROUP, 90).otherwise(F.col("AGE_GROUP").try_cast("int"))
    columns = [str(y) for y in years]
    return (
        wide.filter((F.col("AGE_GROUP") != TOTAL_ROW) & F.col("AREA_CODE").rlike(ENGLISH_DISTRICT))
        .select(F.col("AREA_CODE").alias("area_code"), age.alias("age"), *extra, *columns)
        .unpivot(["area_code", "age", *extra], columns, "year", "value")
        .withColumn("year", F.col("year").cast("int"))
        .withColumn("value", F.col("value").cast("double"))
    )


def local_projections(wide: DataFrame, base_year: int, projection: str, sex: int | Column) -> DataFrame:
    """Local population projections of one variant and sex as rows of area, age, year and value."""
    sex = sex if isinstance(sex, Column) else F.lit(sex)
    return _local(wide.withColumn("sex", sex), years_covered(base_year), ["sex"]).select(
        "*", F.lit(projection).alias("projection"), F.lit(base_year).alias("projection_year")
    )


def local_births(wide: DataFrame, base_year: int, projection: str) -> DataFrame:
    """Local births by mother's age; they start one year after the population."""
    return _local(wide, years_covered(base_year)[1:], []).select(
        "*", F.lit(projection).alias("projection"), F.lit(base_year).alias("projection_year")
    )


def national_projection(wide: DataFrame, base_year: int) -> DataFrame:
    """National projection as rows of year, sex (1 male, 2 female), age (capped at 90) and pop.

    Ages are texts such as `105 - 109`; from 2022 the sex is a text too.
    """
    years = [str(y) for y in range(base_year, base_year + 26)]
    age = F.least(F.regexp_extract("Age", r"^\s*(\d+)", 1).cast("int"), F.lit(90))
    sex = F.when(F.col("Sex") == "Males", 1).otherwise(2) if base_year >= 2022 else F.col("Sex").cast("int")
    totals = [F.sum(F.col(y).cast("double")).alias(y) for y in years]
    return (
        wide.groupBy(sex.alias("sex"), age.alias("age"))
        .agg(*totals)
        .unpivot(["sex", "age"], years, "year", "pop")
        .withColumn("year", F.col("year").cast("int"))
    )


def _rescale(local: DataFrame, national: DataFrame, keys: list[str], base_year: int, projection: str) -> DataFrame:
    if base_year not in PRINCIPAL:
        raise ValueError(f"no principal variant for base year {base_year}")
    principal = (F.col("projection") == PRINCIPAL[base_year]) & (F.col("projection_year") == base_year)
    area_share = F.try_divide(F.col("value"), F.sum("value").over(Window.partitionBy(*keys)))
    return (
        local.filter(principal)
        .join(national.select(*keys, "pop"), keys)
        .withColumn("value", F.col("pop") * area_share)
        .withColumn("projection", F.lit(projection))
        .drop("pop")
    )


def rescale_population(local: DataFrame, national: DataFrame, base_year: int, projection: str) -> DataFrame:
    """A national variant at local level: each area keeps its share of the principal variant."""
    return _rescale(local, national, ["year", "sex", "age"], base_year, projection)


def rescale_births(local: DataFrame, national: DataFrame, base_year: int, projection: str) -> DataFrame:
    """The same for births, with the national female population of the mother's age."""
    return _rescale(local, national.filter(F.col("sex") == 2), ["year", "age"], base_year, projection)


def variant_names(df: DataFrame, code: str = "file", name: str = "projection") -> DataFrame:
    """Names of the national variants by file code; other codes are dropped."""
    rows = [f"('{c}', '{n}')" for c, n in VARIANT_NAMES.items()]
    names = df.sparkSession.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({code}, {name})")
    return df.join(names, code)


def births_by_mother(by_sex: DataFrame, years: range) -> DataFrame:
    """Births by area and mother's age, over the sexes of the babies; the total row is dropped."""
    totals = [F.sum(F.col(str(y)).cast("double")).alias(str(y)) for y in years]
    return by_sex.filter(F.col("AGE_GROUP") != TOTAL_ROW).groupBy("AREA_CODE", "AGE_GROUP").agg(*totals)
