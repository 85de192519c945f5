"""Outpatient attendances: filters, flags, labels and cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.expressions import SURGICAL_SPECIALTY, age_band, coded_age, specialty_group
from cohortlake.operators.attribution import add_area, add_icb, add_main_group, add_primary_codes, add_provider
from cohortlake.operators.reference import drop_org_types


def attended(opa: DataFrame) -> DataFrame:
    """Attended appointments with their age."""
    return (
        opa.withColumn("age", coded_age(F.col("apptage")))
        .filter(F.col("atentype").isin("1", "2", "21", "22"))
        .filter(F.col("sex").isin("1", "2") & F.col("age").between(0, 90))
    )


def op_flags(opa: DataFrame) -> DataFrame:
    """Attended appointments with their flags.

    `is_surgical_specialty` is true for specialties that start with 1, but not 180, 190 or 192.
    """
    referred = F.col("firstatt").isin("1", "3")
    tele = F.col("atentype").isin("21", "22").cast("int")
    return (
        attended(opa)
        .withColumn("is_surgical_specialty", F.col("tretspef").rlike(SURGICAL_SPECIALTY))
        .withColumn("is_adult", F.col("apptage").between(18, 7000))
        .withColumn("is_gp_ref", (F.col("refsourc") == "03") & referred)
        .withColumn(
            "is_cons_cons_ref", (F.col("refsourc") == "05") & referred & F.col("sushrg").rlike("^WF0[12]B$")
        )
        .withColumn("is_first", F.col("atentype").isin("1", "21"))
        .withColumn("has_procedures", ~F.col("sushrg").rlike("^(WF|U)") & (tele != 1))
        .withColumn("attendance", 1 - tele)
        .withColumn("tele_attendance", tele)
    )


def op_labels(df: DataFrame) -> DataFrame:
    """`type`, `group`, `hsagrp`, `pod`, `demog_type` and `ndggrp`."""
    maternity = F.col("tretspef").isin("424", "501", "505", "560")
    births = F.col("tretspef").isin("501", "560") & (F.col("sex").cast("int") == 2) & F.col("age").between(13, 55)
    who = F.when(F.col("is_adult"), "adult_").otherwise("child_")
    what = F.when(F.col("is_surgical_specialty"), "surgical").otherwise("non-surgical")

    def by_step(procedure: str, first: str, followup: str):
        return F.when(F.col("has_procedures"), procedure).when(F.col("is_first"), first).otherwise(followup)

    return (
        df.withColumn("type", F.when(maternity, "maternity").otherwise(F.concat(who, what)))
        .withColumn("group", by_step("procedure", "first", "followup"))
        .withColumn("hsagrp", F.concat(F.lit("op_"), "type", F.lit("_"), "group"))
        .withColumn("pod", by_step("op_procedure", "op_first", "op_follow-up"))
        .withColumn("demog_type", F.when(births, "births").otherwise("demographics"))
        .withColumn("ndggrp", F.col("group"))
    )


OP_COLUMNS = [
    "attendkey", "fyear", "procode3", "provider", "age", "age_group", "sex", "imd_decile", "imd_quintile",
    "ethnos", "tretspef", "tretspef_grouped", "sitetret", "has_procedures", "sushrg", "resgor_ons", "lsoa11",
    "lad23cd", "icb", "primary_diagnosis", "primary_procedure", "is_main_icb", "is_surgical_specialty",
    "is_adult", "is_gp_ref", "is_cons_cons_ref", "is_first", "attendance", "tele_attendance", "type",
    "group", "hsagrp", "pod", "demog_type", "ndggrp",
]


def op_records(
    opa: DataFrame,
    diagnoses: DataFrame,
    procedures: DataFrame,
    trusts: DataFrame,
    ccg_to_icb: DataFrame,
    areas: DataFrame,
    main_icb: DataFrame,
) -> DataFrame:
    """The outpatient table: every attended appointment, labelled.

    The codes come first, by the only join that moves attendances, so that labels are not moved with them.
    """
    visits = drop_org_types(add_provider(attended(opa), trusts), trusts)
    visits = op_flags(add_primary_codes(visits, diagnoses, procedures, ["attendkey", "fyear", "procode3"]))
    visits = add_area(add_main_group(add_icb(visits, ccg_to_icb), main_icb), areas)
    return op_labels(
        visits.withColumn("tretspef_grouped", specialty_group(F.col("tretspef")))
        .withColumn("age_group", age_band(F.col("age")))
        .withColumn("sex", F.col("sex").cast("int"))
    ).select(*OP_COLUMNS)


# outpatient cohorts: name and the condition that puts an attendance in it
OP_COHORTS = {
    "followup_reduction": "NOT has_procedures AND NOT is_first",
    "consultant_to_consultant_reduction": "is_cons_cons_ref",
    "gp_referred_first_attendance_reduction": "is_gp_ref AND is_first",
    "convert_to_tele": "NOT has_procedures AND tele_attendance = 0",
}


def op_cohorts(op: DataFrame, cohorts: dict[str, str] = OP_COHORTS) -> DataFrame:
    """Cohort membership of attendances, tagged in one pass: the strategy ends with the type."""
    matched = F.array_compact(F.array(*[F.when(F.expr(c), F.lit(name)) for name, c in cohorts.items()]))
    return op.select("fyear", "provider", "attendkey", "type", F.explode(matched).alias("_name")).select(
        "fyear", "provider", "attendkey", F.concat("_name", F.lit("_"), "type").alias("strategy")
    )
