"""The jobs, table to table, on the smallest data."""

import json

from pyspark.sql import functions as F

from checks import rule_tables
from checks.views import Views
from cohortlake.config import Tables
from cohortlake.operators.cohorts import alcohol_rules, sdec_rules
from cohortlake.operators.extracts import PRINCIPAL_VARIANT
from cohortlake.operators.reference import unpivot_population
from cohortlake.plans import jobs
from cohortlake.sources import snapshots

SOURCES = {
    "orgs": "org", "org_edges": "org_edge", "org_types": "org_type", "lsoa11_lsoa21": "lsoa11_lsoa21",
    "lsoa21_lad23": "lsoa21_lad23", "ccg_icb": "ccg_icb", "imd": "imd", "apc": "apc", "apc_births": "birth",
    "apc_diagnoses": "dx", "apc_procedures": "px", "opa": "opa", "opa_diagnoses": "opa_dx", "opa_procedures": "opa_px",
    "aae": "aae", "aae_diagnoses": "aae_dx", "aae_treatments": "aae_tx", "aae_investigations": "aae_inv", "ecds": "ecds",
    "obesity_fractions": "obesity", "trimpoints": "trimpoint", "population_imd": "pop_quintile",
}


def test_jobs_run_in_order(spark, tmp_path):
    v = Views.of(spark, "/root/testdata/sf0.001")
    tables = Tables(str(tmp_path / "in"), str(tmp_path / "out"))
    for name, view in SOURCES.items():
        v[f"v_{view}"].write.parquet(f"{tables.source}/{name}")
    # small areas of the test lookup that touch two districts are not named exceptions: keep the first
    v.lsoa21_lad23.filter(~F.col("lsoa21cd").endswith("y")).write.mode("overwrite").parquet(f"{tables.source}/lsoa21_lad23")
    unpivot_population(v.pop_wide, "year").write.parquet(f"{tables.source}/population_lsoa21")
    scores = spark.createDataFrame(rule_tables.FRAILTY, "icd10 string, score double")
    scores.write.parquet(f"{tables.source}/frailty_scores")

    areas = v.lsoa11_lad23
    jobs.reference_data(spark, tables, areas.count(), areas.select("lad23cd").distinct().count())
    jobs.inpatients(spark, tables)
    jobs.outpatients(spark, tables)
    jobs.emergency(spark, tables)
    # years taken one by one give what the whole run gave
    of_newer = lambda: sorted(map(str, tables.built(spark, "ae").where("data_source = 'ecds'").collect()))
    whole = of_newer()
    years = sorted(r[0] for r in tables.built(spark, "ae").where("data_source = 'ecds'").select("fyear").distinct().collect())
    for fyear in years:
        jobs.emergency_year(spark, tables, fyear)
    assert years and of_newer() == whole
    jobs.day_procedure_codes(spark, tables, 201920)
    file = lambda content: spark.createDataFrame([(json.dumps(content),)], "value string")
    alcohol = {g: alcohol_rules(file(rule_tables.ALCOHOL), g) for g in ("chronic", "acute")}
    smoking = spark.createDataFrame([(r["pattern"], r["sex"], r["rate"]) for r in rule_tables.SMOKING], "pattern string, sex string, rate double")
    jobs.inpatient_cohorts(spark, tables, alcohol, smoking, sdec_rules(file(rule_tables.SDEC)))
    jobs.model_inputs(spark, tables, "provider")
    jobs.model_extracts(spark, tables, 201920)

    sources = {r[0] for r in tables.built(spark, "ae").select("data_source").distinct().collect()}
    assert sources == {"aae", "ecds"}
    for name in ("ip", "op", "op_rollup", "inputs/provider/rates", "model/ip", "model/op", "model/aae"):
        assert tables.built(spark, name).limit(1).count() == 1, name
    members = snapshots.read_snapshot(spark, tables.path("ip_cohorts"))
    assert members.select("strategy").distinct().count() > 40
    # the same run again finds nothing to change
    jobs.inpatient_cohorts(spark, tables, alcohol, smoking, sdec_rules(file(rule_tables.SDEC)))
    assert snapshots.finished_versions(spark, tables.path("ip_cohorts")) == [1]

    people = tables.built(spark, "population_provider").select(
        F.col("provider").alias("dataset"), F.lit(PRINCIPAL_VARIANT).alias("variant"), "age", "sex",
        F.floor(F.col("fyear") / 100).cast("int").alias("year"), F.col("population").alias("value"),
    )
    jobs.activity_curves(spark, tables, people, [2019])
    assert tables.built(spark, "model/hsa_activity_tables").agg(F.max("age")).first()[0] == 100
