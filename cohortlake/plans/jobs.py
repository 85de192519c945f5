"""The jobs, in the order they run: each reads the tables before it and writes its own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.config import Tables
from cohortlake.operators import curves, extracts, inequalities, inputs, records_ae, records_ip, records_op, reference
from cohortlake.operators.cohort_pass import Lookups, all_cohorts
from cohortlake.sources.snapshots import merge_snapshot, read_snapshot
from cohortlake.sources.sinks import build_if_absent, replace_partitions, write_extract, write_partitioned

ATTENDANCE = ("fyear", "provider")


def reference_data(
    spark: SparkSession,
    tables: Tables,
    mappings: int = reference.EXPECTED_MAPPINGS,
    districts: int = reference.EXPECTED_DISTRICTS,
) -> None:
    """Trusts, area lookups, populations, main ICBs and catchments."""
    orgs, edges = tables.read(spark, "orgs"), tables.read(spark, "org_edges")
    types = reference.latest_per_key(tables.read(spark, "org_types"), "org_code", "fyear")
    trusts = reference.trust_list(orgs, reference.successor_closure(orgs, edges), types)
    trusts.write.mode("overwrite").parquet(tables.path("trusts"))
    trusts = reference.check_single_successor(tables.built(spark, "trusts"))

    areas = build_if_absent(
        spark,
        tables.path("lsoa11_lad23"),
        lambda: reference.resolve_exceptions(
            reference.chain_lookup(tables.read(spark, "lsoa11_lsoa21"), tables.read(spark, "lsoa21_lad23"))
        ),
    )
    reference.assert_mapping(areas, "lsoa11cd", "lad23cd", mappings, districts)
    population = build_if_absent(
        spark,
        tables.path("population_lad23"),
        lambda: reference.population_by_district(
            tables.read(spark, "population_lsoa21"), tables.read(spark, "lsoa21_lad23")
        ),
    )
    spells = records_ip.attributed_spells(tables.read(spark, "apc"), trusts, tables.read(spark, "ccg_icb"), areas)
    reference.main_group(spells).write.mode("overwrite").parquet(tables.path("main_icb"))
    numbered = spells.withColumn("sex", F.col("sex").cast("int"))
    split = build_if_absent(
        spark, tables.path("catchment_split"), lambda: reference.catchment_split(numbered, trusts)
    )
    build_if_absent(
        spark, tables.path("population_provider"), lambda: reference.catchment_population(split, population)
    )


def _lookups(spark: SparkSession, tables: Tables) -> list[DataFrame]:
    return [
        tables.built(spark, "trusts"),
        tables.read(spark, "ccg_icb"),
        tables.built(spark, "lsoa11_lad23"),
    ]


def inpatients(spark: SparkSession, tables: Tables) -> None:
    names = ("apc", "apc_births", "apc_diagnoses", "apc_procedures")
    raw = [tables.read(spark, n) for n in names]
    ip = records_ip.ip_records(*raw, *_lookups(spark, tables), tables.built(spark, "main_icb"))
    write_partitioned(ip, tables.path("ip"), ATTENDANCE)


def outpatients(spark: SparkSession, tables: Tables) -> None:
    raw = [tables.read(spark, n) for n in ("opa", "opa_diagnoses", "opa_procedures")]
    op = records_op.op_records(*raw, *_lookups(spark, tables), tables.built(spark, "main_icb"))
    write_partitioned(op, tables.path("op"), ATTENDANCE)
    op = tables.built(spark, "op")
    write_partitioned(records_op.op_cohorts(op), tables.path("op_cohorts"), ATTENDANCE, ("strategy", "attendkey"))
    write_partitioned(records_ae.op_rollup(op), tables.path("op_rollup"), ATTENDANCE)


def emergency(spark: SparkSession, tables: Tables) -> None:
    """Older system first; the newer one then replaces its own years in the same table."""
    lookups, main = _lookups(spark, tables), tables.built(spark, "main_icb")
    raw = [tables.read(spark, n) for n in ("aae", "aae_diagnoses", "aae_treatments", "aae_investigations")]
    older = records_ae.aae_records(*raw, *lookups, main)
    deprivation = tables.read(spark, "imd")
    newer = records_ae.ecds_records(tables.read(spark, "ecds"), raw[0], *lookups, deprivation, main)
    both = records_ae.union_systems(older, newer.limit(0))
    write_partitioned(both, tables.path("ae"), ATTENDANCE)
    replace_partitions(newer.select(*both.columns), tables.path("ae"), ATTENDANCE)
    write_partitioned(records_ae.ae_rollup(tables.built(spark, "ae")), tables.path("ae_rollup"), ATTENDANCE)


def emergency_year(spark: SparkSession, tables: Tables, fyear: int) -> None:
    """One more year of the newer system, from its own records and the days carried over from the years before.

    The days that the next year needs are written for it. Only if there are none for this year yet are they
    made from all earlier records.
    """
    lookups, main = _lookups(spark, tables), tables.built(spark, "main_icb")
    visits, counts = records_ae.ecds_visits(tables.read(spark, "ecds")), records_ae.ecds_counts()
    this, following = fyear // 100, fyear // 100 + 1
    day = records_ae.ECDS_VISIT[1:]
    begins, ends = date(this, 4, 1), date(following, 4, 1)

    def from_the_start() -> DataFrame:
        older = records_ae.visit_days(records_ae.older_prior(tables.read(spark, "aae")), *day)
        before = visits.filter(F.col("der_financial_year").between("2019/20", f"{this - 1}/{this % 100:02}"))
        return records_ae.carry_days(before, *day, counts, begins, older)

    carried = build_if_absent(spark, tables.path(f"ae_days/{fyear}"), from_the_start)
    deprivation = tables.read(spark, "imd")
    year = records_ae.ecds_year(tables.read(spark, "ecds"), carried, *lookups, deprivation, main, fyear)
    table = tables.built(spark, "ae")
    replace_partitions(records_ae.union_systems(table.limit(0), year).select(*table.columns), tables.path("ae"), ATTENDANCE)
    of_year = visits.filter(F.col("der_financial_year") == f"{this}/{following % 100:02}")
    kept = records_ae.carry_days(of_year, *day, counts, ends, carried)
    kept.write.mode("overwrite").parquet(tables.path(f"ae_days/{following * 100 + (following + 1) % 100}"))
    write_partitioned(records_ae.ae_rollup(tables.built(spark, "ae")), tables.path("ae_rollup"), ATTENDANCE)


def inpatient_cohorts(
    spark: SparkSession,
    tables: Tables,
    alcohol: Mapping[str, DataFrame],
    smoking: DataFrame,
    sdec: DataFrame,
) -> None:
    """All inpatient cohorts merged into one table in versions. The rule tables come from the readers."""
    lookups = Lookups(
        *(tables.read(spark, n) for n in ("frailty_scores", "obesity_fractions")),
        tables.built(spark, "day_procedure_codes"),
        tables.read(spark, "trimpoints"),
        alcohol,
        smoking,
        sdec,
    )
    raw = [tables.read(spark, n) for n in ("apc", "apc_diagnoses", "apc_procedures")]
    everything = all_cohorts(tables.built(spark, "ip"), *raw, lookups)
    merge_snapshot(spark, tables.path("ip_cohorts"), everything)


def day_procedure_codes(spark: SparkSession, tables: Tables, base_year: int) -> None:
    trusts = tables.built(spark, "trusts")
    spells = records_ip.attributed_spells(
        tables.read(spark, "apc"), trusts, tables.read(spark, "ccg_icb"), tables.built(spark, "lsoa11_lad23")
    )
    visits = records_ae.add_provider(tables.read(spark, "opa"), trusts)
    procedures = tables.read(spark, "apc_procedures"), tables.read(spark, "opa_procedures")
    counts = reference.setting_counts(spells, procedures[0], visits, procedures[1], trusts, base_year)
    reference.classify_setting(counts).write.mode("overwrite").parquet(tables.path("day_procedure_codes"))


def model_inputs(spark: SparkSession, tables: Tables, geography: str) -> None:
    """Age and sex table, rates, code lists, baseline and (for providers) flows and inequalities."""
    inputs.check_geography(geography)
    ip, op, ae, trusts, population = (tables.built(spark, n) for n in ("ip", "op", "ae", "trusts", "population_lad23"))
    cohorts = read_snapshot(spark, tables.path("ip_cohorts"))
    diagnoses, procedures = tables.read(spark, "apc_diagnoses"), tables.read(spark, "apc_procedures")
    op_diagnoses, op_procedures = tables.read(spark, "opa_diagnoses"), tables.read(spark, "opa_procedures")
    people = population if geography == "lad23cd" else tables.built(spark, "population_provider")
    codes = tables.built(spark, "day_procedure_codes")

    ip_cells = inputs.ip_age_sex(ip, cohorts, geography)
    op_cells = inputs.op_age_sex(op, geography)
    ae_cells = inputs.ae_age_sex(ae, geography)
    rates = [
        inputs.ae_rates(ae_cells, population, geography),
        inputs.avoidance_rates(ip_cells, people, population, geography),
        inputs.mean_length_of_stay(ip_cells, population, geography),
        inputs.preop_rates(ip, ip_cells, population, geography),
        inputs.day_procedure_rates(ip, op, procedures, op_procedures, codes, ip_cells, population, geography),
        inputs.op_rates(op_cells, population, geography),
    ]
    top_diagnoses = [
        inputs.ae_top(ae, "primary_diagnosis", "diagnosis", geography, weighted=True),
        inputs.ip_top(ip, cohorts, diagnoses, "diag_order", "diagnosis", geography),
        inputs.op_top(op, op_diagnoses, "diag_order", "diagnosis", geography, weighted=True),
    ]
    top_procedures = [
        inputs.ae_top(ae, "primary_treatment", "procedure_code", geography, weighted=False),
        inputs.ip_top(ip, cohorts, procedures, "procedure_order", "procedure_code", geography),
        inputs.op_top(op, op_procedures, "procedure_order", "procedure_code", geography, weighted=False),
    ]
    counts = inputs.activity_counts(ip, op, ae, geography)
    results = {
        "age_sex": inputs.age_sex_table([ae_cells, ip_cells, op_cells], geography, trusts),
        "rates": inputs.rates_table(rates, geography, trusts),
        "diagnoses": inputs.code_table(top_diagnoses, geography, trusts),
        "procedures": inputs.code_table(top_procedures, geography, trusts),
        "baseline": inputs.baseline(counts, geography, trusts),
    }
    if geography == "provider":
        results["expat"] = inputs.expatriation(counts, trusts)
        results["repat_local"] = inputs.repatriation_local(counts, trusts)
        results["repat_nonlocal"] = inputs.repatriation_nonlocal(counts, trusts)
        acute_ip, acute_op = (
            reference.keep_acute(tables.built(spark, name), trusts) for name in ("ip", "op_rollup")
        )
        by_quintile = inequalities.rate_table(tables.read(spark, "population_imd"), acute_ip, acute_op)
        results["inequalities"] = inequalities.adjustments(by_quintile, inequalities.regressions(by_quintile))
    for name, df in results.items():
        df.write.mode("overwrite").parquet(tables.path(f"inputs/{geography}/{name}"))


def model_extracts(spark: SparkSession, tables: Tables, fyear: int) -> None:
    """One year of the record tables, the cohorts and the inequalities, by year and dataset."""
    trusts = tables.built(spark, "trusts")
    acute = lambda name: reference.keep_acute(tables.built(spark, name), trusts)
    cohorts = reference.keep_acute(read_snapshot(spark, tables.path("ip_cohorts")), trusts)
    found = tables.built(spark, "inputs/provider/inequalities")
    write_extract(extracts.ip_extract(acute("ip"), fyear), tables.path("model/ip"), ("rn",))
    ip = tables.built(spark, "model/ip")
    for folder, kind in (("activity_avoidance", "activity_avoidance"), ("efficiencies", "efficiency")):
        rows = extracts.cohort_extract(cohorts, ip, fyear, kind)
        write_extract(rows, tables.path(f"model/ip_{folder}_strategies"), ("rn",))
    write_extract(extracts.op_extract(acute("op_rollup"), found, fyear), tables.path("model/op"))
    write_extract(extracts.ae_extract(acute("ae_rollup"), fyear), tables.path("model/aae"))
    write_extract(extracts.inequalities_extract(found, acute("ip"), fyear), tables.path("model/inequalities"))


def activity_curves(spark: SparkSession, tables: Tables, population: DataFrame, years: Sequence[int]) -> None:
    """Smooth activity by age for each provider; `population` as the projection operators give it."""
    ip, op, ae = (tables.built(spark, f"model/{n}") for n in ("ip", "op", "aae"))
    rates = curves.provider_rates(ip, op, ae, population, years)
    fitted = curves.fit_curves(rates, ["dataset", "hsagrp", "sex", "fyear"])
    write_extract(fitted, tables.path("model/hsa_activity_tables"))
