"""Registered queries against their oracle SQL. ALL_QUERIES=1 runs every one of them."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registered
from checks.views import BASE_TABLES

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
SAMPLE = [
    "ref_01_successor_closure", "ref_02_trust_list", "ref_06_resolve_exceptions", "ref_11_catchment_split",
    "ref_15_population_by_deprivation", "ref_16_classify_setting", "raw_04_spell_base", "raw_12_ip_records",
    "raw_15_op_records", "raw_17_frequent_attender_across", "raw_23_union_systems", "agg_01_ae_rollup",
    "coh_04_assembly", "coh_11_alcohol_partially_attributable_chronic", "coh_30_frailty_scores",
    "coh_35_readmission_within_28_days", "coh_36_smoking", "coh_40_day_procedures_usually_op",
    "coh_47_same_day_emergency_care_high", "coh_62_gp_referred_first_attendance_reduction", "inp_05_op_families",
    "inp_10_avoidance_rates", "inp_12_preop_rates", "inp_17_top_procedures_small", "inp_20_repatriation_local",
    "inq_03_regressions", "pop_04_rescale_population", "pop_05_rescale_births", "mod_03_op_extract",
    "mod_07_custom_birth_factors", "mod_09_provider_rates", "syn_03_strategy_rates", "syn_05_coded_labels",
    "snk_02_replace_partitions", "snk_03_merge_cohorts", "snk_03_merge_snapshot", "snk_05_build_if_absent",
    "raw_16_frequent_attender_by_year", "mod_04_inequalities_extract", "inp_18_baseline", "inp_21_repatriation_nonlocal",
]
NAMES = sorted(registered.queries()) if os.environ.get("ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, str):
        return value
    if isinstance(value, (list, tuple)):
        return "|".join(map(_plain, value))
    return f"{float(value) + 0.0:.5f}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = registered.queries()[name](spark, FOLDER)
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in registered.oracle_sql():
        assert found
        return
    cursor = duck.execute(registered.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert found == _rows(columns, cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() > 0
