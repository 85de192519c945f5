"""Provider, area, ICB and deprivation columns added to records of any kind."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.expressions import flag, quintile
from cohortlake.functions.skew import broadcast_if_small

# fixed values: sites that count towards another provider
SITE_OVERRIDES = {"RW602": "R0A", "RM318": "R0A"}


def add_provider(
    df: DataFrame,
    trusts: DataFrame,
    code: str = "procode3",
    site: str = "sitetret",
    overrides: Mapping[str, str] = SITE_OVERRIDES,
) -> DataFrame:
    """Provider: the site's override, else the successor of the code, else the code itself."""
    successors = trusts.select(F.col("org_from").alias(code), F.col("org_to").alias("_successor"))
    provider = F.coalesce("_successor", code)
    for place, target in overrides.items():
        provider = F.when(F.col(site) == place, target).otherwise(provider)
    return df.join(successors, code, "left").withColumn("provider", provider).drop("_successor")


def add_main_group(df: DataFrame, main: DataFrame, by: str = "provider", of: str = "icb") -> DataFrame:
    """`is_main_icb`: whether the record's ICB is the main one of its provider (null counts as no)."""
    main = broadcast_if_small(main.select(by, F.col("main_icb").alias("_main")))  # few providers have most records
    return (
        df.join(main, by, "left")
        .withColumn("is_main_icb", flag(F.col(of) == F.col("_main")))
        .drop("_main")
    )


def add_icb(
    df: DataFrame, ccg_to_icb: DataFrame, residence: str = "ccg_residence", responsibility: str = "ccg_responsibility"
) -> DataFrame:
    """ICB of the CCG of residence, or else of the responsible CCG."""
    lookup = lambda ccg, name: ccg_to_icb.select(F.col("ccg").alias(ccg), F.col("icb22cdh").alias(name))
    return (
        df.join(lookup(residence, "_first"), residence, "left")
        .join(lookup(responsibility, "_second"), responsibility, "left")
        .withColumn("icb", F.coalesce("_first", "_second"))
        .drop("_first", "_second")
    )


def add_area(df: DataFrame, lookup: DataFrame, area: str = "lsoa11") -> DataFrame:
    """District (`lad23cd`) of the small area."""
    return df.join(lookup.select(F.col("lsoa11cd").alias(area), "lad23cd"), area, "left")


def add_deprivation(df: DataFrame, lookup: DataFrame, area: str = "lsoa11") -> DataFrame:
    """Deprivation decile and quintile of the small area."""
    deciles = lookup.select(F.col("lsoa11").alias(area), F.col("imd19_decile").alias("imd_decile"))
    return df.join(deciles, area, "left").withColumn("imd_quintile", quintile(F.col("imd_decile")))


def first_code(children: DataFrame, order: str, code: str, keys: list[str], name: str) -> DataFrame:
    """The code of order 1 of each record (one row per record, lowest code if repeated)."""
    return children.filter(F.col(order) == 1).groupBy(*keys).agg(F.min(code).alias(name))


def add_primary_codes(
    df: DataFrame,
    diagnoses: DataFrame,
    procedures: DataFrame,
    keys: list[str],
) -> DataFrame:
    """`primary_diagnosis` and `primary_procedure` of each record."""
    first_diagnosis = first_code(diagnoses, "diag_order", "diagnosis", keys, "primary_diagnosis")
    first_procedure = first_code(procedures, "procedure_order", "procedure_code", keys, "primary_procedure")
    return df.join(first_diagnosis, keys, "left").join(first_procedure, keys, "left")
