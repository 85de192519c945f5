"""Statistics, invariants, refusals and sinks."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlake.functions.stats import binomial_upper_tail, t_two_sided
from cohortlake.operators import curves, inequalities, inputs, population, records_ae, reference, release, standardise
from cohortlake.sources import readers, sinks


@pytest.mark.parametrize("n", [1, 7, 60, 400])
@pytest.mark.parametrize("p", [0.05, 0.5])
def test_binomial_tail(n, p):
    ks = np.arange(0, n + 1, max(1, n // 15))
    exact = [sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k, n + 1)) for k in ks]
    assert np.allclose(binomial_upper_tail(ks, np.full(ks.shape, n), p), exact, atol=1e-10)


def test_binomial_tail_of_large_counts():
    assert binomial_upper_tail([50_000_000], [100_000_000], 0.5)[0] == pytest.approx(0.5, abs=1e-3)


def test_t_tail(spark):
    # two-sided 5% points of Student's t
    points = [(12.7062, 1), (4.30265, 2), (3.18245, 3), (-3.18245, 3), (2.77645, 4), (2.228139, 10), (-1.983972, 100)]
    df = spark.createDataFrame(points, "t double, df int")
    for row in df.select(t_two_sided(F.col("t"), F.col("df")).alias("p")).collect():
        assert row["p"] == pytest.approx(0.05, abs=1e-5)


def test_spline_reproduces_lines():
    ages, at = np.arange(18, 91), np.arange(101)
    assert np.allclose(curves.smooth_curve(ages, np.full(73, 2.0), np.ones(73), at), 2, atol=1e-6)
    assert np.allclose(curves.smooth_curve(ages, 0.1 * ages + 1, np.ones(73), at), 0.1 * at + 1, atol=1e-6)
    assert np.allclose(curves.smooth_curve(np.array([40]), np.array([3.0]), np.ones(1), at), 3)


def test_spline_smooths_noise():
    ages = np.arange(18, 91)
    truth = np.sin(ages / 20)
    noisy = truth + np.random.default_rng(0).normal(0, 0.2, ages.size)
    fitted = curves.smooth_curve(ages, noisy, np.ones(ages.size), ages)
    assert np.mean((fitted - truth) ** 2) < 0.3 * np.mean((noisy - truth) ** 2)


ORGS = "org_code string, primary_role string"
EDGES = "org_from string, org_to string, change_date date"


def _edges(spark, pairs):
    text = spark.createDataFrame(pairs, "org_from string, org_to string")
    return text.withColumn("change_date", F.lit("2015-04-01").cast("date"))


def test_closure_follows_chains_and_refuses_loops(spark):
    orgs = spark.createDataFrame([(c, "RO197") for c in "ABCDEFGH"], ORGS)
    chain = _edges(spark, list(zip("ABCDEF", "BCDEFG")))
    closed = {(r["org_from"], r["org_to"]) for r in reference.successor_closure(orgs, chain).collect()}
    assert closed == {(c, "G") for c in "ABCDEFG"} | {("H", "H")}
    with pytest.raises(ValueError, match="loop"):
        reference.successor_closure(orgs, _edges(spark, [("A", "B"), ("B", "A")])).collect()


def test_closure_through_loops(spark):
    """A-B go round with a way out to C, D only comes from itself, E leads into the loop and past a code with an edge to itself."""
    orgs = spark.createDataFrame([(c, "RO197") for c in "ABCDEFGG"], ORGS)
    edges = _edges(spark, [("A", "B"), ("B", "A"), ("B", "C"), ("D", "D"), ("E", "A"), ("E", "F"), ("F", "F"), ("F", "G")])
    closed = reference.successor_closure(orgs, edges, refuse_loops=False).collect()
    assert sorted((r["org_from"], r["org_to"]) for r in closed) == [
        ("A", "C"), ("B", "C"), ("C", "C"), ("E", "C"), ("E", "G"), ("F", "G"), ("G", "G"),
    ]
    with pytest.raises(ValueError, match="loop"):
        reference.successor_closure(orgs, edges)


def test_closure_of_twenty_mergers(spark):
    names = [f"O{k:02d}" for k in range(21)]
    orgs = spark.createDataFrame([(c, "RO197") for c in names], ORGS)
    closed = reference.successor_closure(orgs, _edges(spark, list(zip(names, names[1:])))).collect()
    assert {(r["org_from"], r["org_to"]) for r in closed} == {(c, "O20") for c in names}


def test_skipped_edge(spark):
    orgs = spark.createDataFrame([(c, "RO197") for c in ("RW6", "R0A", "RM3")], ORGS)
    edges = _edges(spark, [("RW6", "R0A"), ("RW6", "RM3")])
    rows = {(r["org_from"], r["org_to"]) for r in reference.successor_closure(orgs, edges).collect()}
    assert rows == {("RW6", "RM3"), ("R0A", "R0A"), ("RM3", "RM3")}


def test_mapping_is_checked(spark):
    lookup = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y")], "k string, v string")
    with pytest.raises(ValueError, match="more than once"):
        reference.assert_mapping(lookup, "k", "v", 3, 2)
    with pytest.raises(ValueError, match="expected"):
        reference.assert_mapping(lookup.limit(2).filter("k = 'a'"), "k", "v", 5, 1)
    assert reference.assert_mapping(lookup.filter("v = 'x'"), "k", "v", 2, 1).count() == 2


def test_named_area_exceptions(spark):
    rows = [("E01008187", "E08000037"), ("E01008187", "E08000001"), ("E01000001", "E09000001")]
    lookup = spark.createDataFrame(rows, "lsoa11cd string, lad23cd string")
    kept = {tuple(r) for r in reference.resolve_exceptions(lookup).collect()}
    assert kept == {("E01008187", "E08000037"), ("E01000001", "E09000001")}


def test_two_successors_are_refused(spark):
    trusts = spark.createDataFrame([("A", "B"), ("A", "C")], "org_code string, org_to string")
    with pytest.raises(ValueError):
        reference.check_single_successor(trusts)


def test_catchment_shares_add_up(spark):
    rows = [(201920, f"P{i % 3}", f"D{i % 4}", "E01000001", i % 5, 1 + i % 2, i % 17) for i in range(200)]
    spells = spark.createDataFrame(
        rows, "fyear int, provider string, lad23cd string, lsoa11 string, age int, sex int, person_id long"
    )
    trusts = spark.createDataFrame([(f"P{i}", "ACUTE - LARGE") for i in range(3)], "org_code string, org_type string")
    split = reference.catchment_split(spells, trusts)
    sums = split.groupBy("fyear", "lad23cd", "age", "sex").agg(F.sum("lad23_pcnt").alias("s")).collect()
    assert len(sums) == 4 * 5 * 2
    assert all(r["s"] == pytest.approx(1) for r in sums)


def test_rescaled_totals_equal_the_national_ones(spark):
    local = spark.createDataFrame(
        [(f"E0600000{a}", 40, 2, 2022 + y, float(10 + a + y), "principal_proj", 2018) for a in range(3) for y in range(2)],
        "area_code string, age int, sex int, year int, value double, projection string, projection_year int",
    )
    national = spark.createDataFrame([(2022, 2, 40, 90.0), (2023, 2, 40, 60.0)], "year int, sex int, age int, pop double")
    totals = population.rescale_population(local, national, 2018, "high_fertility").groupBy("year").agg(F.sum("value").alias("v"))
    assert {r["year"]: round(r["v"], 9) for r in totals.collect()} == {2022: 90.0, 2023: 60.0}
    with pytest.raises(ValueError):
        population.rescale_population(local, national, 2020, "x")


def test_older_projections_have_one_more_year(spark):
    assert list(population.years_covered(2018)) == list(range(2018, 2045))
    assert list(population.years_covered(2022)) == list(range(2022, 2048))
    row = ("E06000001", "90 and over", *["1"] * 27)
    wide = spark.createDataFrame([row], ", ".join(["AREA_CODE string", "AGE_GROUP string", *[f"`{y}` string" for y in range(2018, 2045)]]))
    assert population.local_projections(wide, 2018, "principal_proj", 1).agg({"year": "max"}).first()[0] == 2044
    assert population.local_births(wide, 2018, "principal_proj").count() == 26


def test_national_rate_weighs_ages_without_activity(spark):
    cells = spark.createDataFrame(
        [(201920, "s", "P1", 10, 1, 2.0, 10.0), (201920, "s", "P2", 12, 1, 6.0, 10.0)],
        "fyear int, strategy string, provider string, age int, sex int, n double, d double",
    )
    people = spark.createDataFrame([(201920, a, 1, 100) for a in range(9, 14)], "fyear int, age int, sex int, population long")
    rates = {r["provider"]: r for r in standardise.directly_standardise(cells, people).collect()}
    assert rates["P1"]["std_rate"] == pytest.approx(0.2) and rates["P2"]["std_rate"] == pytest.approx(0.6)
    # ages 10, 11 and 12 carry weight, only two of them have a rate
    assert rates["national"]["std_rate"] == pytest.approx((0.2 + 0.6) / 3)
    assert rates["national"]["crude_rate"] == pytest.approx(0.4)


def test_regression_of_an_exact_line(spark):
    rows = [("Q", "P", q, "H", 2020, 100, 50.0 + q, 0.1 * q + 1) for q in range(1, 6)]
    schema = "icb string, provider string, imd_quintile int, sushrg_trimmed string, fyear int, count long, pop double, activity_rate double"
    fit = inequalities.regressions(spark.createDataFrame(rows, schema)).first()
    assert fit["slope"] == pytest.approx(0.1) and fit["intercept"] == pytest.approx(1) and fit["pvalue"] < 1e-6
    few = spark.createDataFrame(rows[:2], schema)
    assert inequalities.regressions(few).count() == 0


def test_geography_is_checked():
    assert inputs.check_geography("lad23cd") == "lad23cd"
    with pytest.raises(ValueError):
        inputs.check_geography("msoa11")


def test_sample_is_repeatable_and_checked(spark):
    df = spark.range(5000).withColumnRenamed("id", "rn")
    first = {r["rn"] for r in release.sample_fraction(df, "rn", 0.2, 1).collect()}
    again = {r["rn"] for r in release.sample_fraction(df.repartition(7), "rn", 0.2, 1).collect()}
    assert first == again and 850 < len(first) < 1150
    assert first != {r["rn"] for r in release.sample_fraction(df, "rn", 0.2, 2).collect()}
    with pytest.raises(ValueError):
        release.sample_to_size(df, "rn", 6000, 1)


def test_rollup_index_is_unique_and_stable(spark):
    keys = records_ae.AE_ROLLUP
    df = spark.range(50).select(*[(F.col("id") % (i + 2)).cast("string").alias(k) for i, k in enumerate(keys)], F.lit(1).alias("arrival"))
    rolled = records_ae.ae_rollup(df)
    first = sorted(r["index"] for r in rolled.collect())
    assert first == sorted(r["index"] for r in records_ae.ae_rollup(df.repartition(3)).collect())
    assert len(set(first)) == len(first)


def test_merge_is_idempotent(spark, tmp_path):
    schema = "fyear int, provider string, epikey long, type string, strategy string, sample_rate double"
    stored = spark.createDataFrame([(2020, "P", 1, "e", "a", 1.0), (2020, "P", 2, "e", "b", 1.0)], schema)
    current = spark.createDataFrame([(2020, "P", 3, "e", "a", 0.5)], schema)
    path = str(tmp_path / "cohorts")
    sinks.write_partitioned(stored, path)
    once = sinks.merge_into(spark, path, current, [("e", "a")], "v1")
    twice = sinks.merge_into(spark, once, current, [("e", "a")], "v2")
    rows = lambda p: {(r["epikey"], r["strategy"], r["sample_rate"]) for r in spark.read.parquet(p).collect()}
    assert rows(once) == rows(twice) == {(3, "a", 0.5), (2, "b", 1.0)}
    # a recomputed cohort without any row loses its stored rows
    empty = sinks.merge_into(spark, twice, current.limit(0), [("e", "a")], "v3")
    assert rows(empty) == {(2, "b", 1.0)}


def test_build_if_absent_builds_once(spark, tmp_path):
    path, built = str(tmp_path / "t"), []

    def build():
        built.append(1)
        return spark.range(3)

    assert sinks.build_if_absent(spark, path, build).count() == 3
    assert sinks.build_if_absent(spark, path, build).count() == 3
    assert built == [1]


def test_rule_files(spark, tmp_path):
    (tmp_path / "trim.csv").write_text("sushrg,elective,emergency\nAA22C,90,-\n")
    assert tuple(readers.read_trimpoints(spark, str(tmp_path / "trim.csv")).first()) == ("AA22C", 90, None)
    (tmp_path / "smoke.csv").write_text("diagnoses,sex,value\nC34,1,0.5\n")
    assert readers.read_smoking_rules(spark, str(tmp_path / "smoke.csv")) .collect() == [("C34", "1", 0.5)]
    table = {"ages": [16, 25], "data": {"acute": {"g": {"c": {"regex": "W0", "male": [0.5, -0.1], "female": [1.2, 1]}}}}}
    (tmp_path / "alcohol.json").write_text(json.dumps(table, indent=1))
    rules = readers.read_alcohol_rules(spark, str(tmp_path / "alcohol.json"), "acute").orderBy("outcome", "sex").collect()
    assert [(r["sex"], r["outcome"], r["low"], r["high"], r["rate"]) for r in rules] == [
        ("1", "morbidity", 16, 24, 0.5), ("2", "morbidity", 25, None, 1.0),
        ("1", "mortality", 16, 24, 0.5), ("2", "mortality", 25, None, 1.0),
    ]
