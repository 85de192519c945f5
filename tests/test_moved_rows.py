"""What is moved between tasks: wide records once at most, lookups not at all, and nothing twice."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import views as given
from checks.views import VIEWS, Views, dependencies
from cohortlake.operators import attribution, inputs, records_op


@pytest.fixture
def no_guess(spark):
    """Nothing is small enough to be broadcast, but for what is marked."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.debug.maxToStringFields": "1000"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_tables(spark, tmp_path):
    """Repeated and null keys in every table of the outpatient views; codes of areas that two customers share."""
    customers = [(7, 1), (7, 1), (8, 2), (31, None), (None, 1), (305, 3), (9, 2)]
    orders = [(1, 7), (2, 8), (2, 305), (3, None), (None, 9), (4, 31), (5, 9), (6, 404)]
    lines = [(o, p, s, n) for n, o in enumerate([1, 1, 2, 3, None, 4, 5, 5, 6, 2], 1) for p, s in ((n, 2), (n + 30, None), (n * 7, 5))]
    tables = {
        "customer": spark.createDataFrame(customers, "c_custkey int, c_nationkey int"),
        "nation": spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "n_nationkey int, n_regionkey int"),
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey int"),
        "lineitem": spark.createDataFrame(lines * 2, "l_orderkey long, l_partkey int, l_suppkey int, l_linenumber int").withColumn(
            "l_shipdate", F.date_add(F.lit(date(1996, 3, 20)), F.coalesce("l_partkey", F.lit(0)))
        ),
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def as_written(spark, folder, name):
    """A view from its text alone."""
    if name not in VIEWS:
        return spark.read.parquet(f"{folder}/{name}.parquet")
    return spark.sql(VIEWS[name], **{d: as_written(spark, folder, d) for d in dependencies(VIEWS[name])})


def test_outpatient_views_have_the_rows_of_their_text(spark, small_tables):
    views = Views(spark, small_tables)
    for name in ("v_op", "v_opa"):
        found, wanted = views[name], as_written(spark, small_tables, name)
        assert found.dtypes == wanted.dtypes
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect())) and found.count() > 20


def test_line_items_are_moved_once_and_areas_not_at_all(spark, small_tables, no_guess, monkeypatch):
    views, made = Views(spark, small_tables), []
    whole = given.materialise
    monkeypatch.setattr(given, "materialise", lambda df: made.append(plan_of(df)) or whole(df))
    views["v_op"]
    assert len(made) == 1  # without `v_opa` being written first
    assert made[0].count("Exchange hashpartitioning(l_orderkey") == 1 and "Exchange hashpartitioning(lsoa11" not in made[0]
    assert "Exchange hashpartitioning(c#" not in made[0] and "o_custkey" in made[0]


def test_large_stages_are_compiled(spark, small_tables):
    Views(spark, small_tables)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_main_group_moves_no_records(spark, no_guess):
    df = spark.createDataFrame([("P1", "Q1"), ("P1", "Q2"), (None, "Q1")], "provider string, icb string")
    main = spark.createDataFrame([("P1", "Q1")], "provider string, main_icb string")
    found = attribution.add_main_group(df, main)
    assert "Exchange hashpartitioning" not in plan_of(found)
    assert sorted((r["icb"], r["is_main_icb"]) for r in found.collect()) == [("Q1", False), ("Q1", True), ("Q2", False)]


def test_labels_are_made_after_attendances_are_moved(spark, no_guess):
    columns = [
        "attendkey", "procode3", "sitetret", "sex", "atentype", "firstatt", "refsourc", "sushrg", "tretspef", "ethnos", "resgor_ons",
        "lsoa11", "ccg_residence", "ccg_responsibility",
    ]
    opa = spark.createDataFrame(
        [("a", "P1", "P101", "1", "1", "1", "03", "JC42C", "100", "A", "E12", "E01", "C1", "C1")], ", ".join(f"{c} string" for c in columns)
    ).withColumns({"fyear": F.lit(201920), "apptage": F.lit(40), "imd_decile": F.lit(1), "imd_quintile": F.lit(1)})
    codes = lambda order, code: spark.createDataFrame(
        [("a", 201920, "P1", 1, "K"), ("a", 201920, "P1", 1, "J"), ("a", 201920, "P1", 2, "A")],
        f"attendkey string, fyear int, procode3 string, {order} int, {code} string",
    )
    lookups = [
        spark.createDataFrame([("P1", "P2", "ACUTE")], "org_from string, org_to string, org_type string"),
        spark.createDataFrame([("C1", "Q1")], "ccg string, icb22cdh string"),
        spark.createDataFrame([("E01", "E06")], "lsoa11cd string, lad23cd string"),
        spark.createDataFrame([("P2", "Q1")], "provider string, main_icb string"),
    ]
    found = records_op.op_records(opa, codes("diag_order", "diagnosis"), codes("procedure_order", "procedure_code"), *lookups)
    moved = plan_of(found).split("Exchange hashpartitioning(attendkey", 1)[1]
    assert "adult_" not in moved and "op_procedure" not in moved
    row = found.first()
    assert (row["provider"], row["primary_diagnosis"], row["primary_procedure"], row["is_main_icb"]) == ("P2", "J", "J", True)
    assert (row["hsagrp"], row["lad23cd"]) == ("op_adult_surgical_procedure", "E06")


def test_counts_that_are_read_twice_are_written(spark, tmp_path):
    path = f"{tmp_path}/rows"
    rows = [(2020, "P", "s", f"c{k % 9}") for k in range(90)]
    spark.createDataFrame(rows, "fyear int, provider string, strategy string, code string").write.parquet(path)
    found = inputs.top_codes(spark.read.parquet(path), "provider", "code", F.count(F.lit(1)))
    assert not any(path in f for f in found.inputFiles()) and [r["rn"] for r in found.orderBy("rn").collect()] == [1, 2, 3, 4, 5, 6]


def test_day_procedures_and_operations_are_counted_once(spark, tmp_path):
    record = "fyear int, provider string, age int, sex string, epikey long, admimeth string, has_procedure boolean"
    spark.createDataFrame([(201920, "P", 50, "1", k, "11", True) for k in range(4)], record).write.parquet(f"{tmp_path}/ip")
    ip = spark.read.parquet(f"{tmp_path}/ip")
    op = ip.select("fyear", "provider", "age", "sex", F.col("epikey").cast("string").alias("attendkey"))
    first = ip.select("fyear", "epikey", F.lit(1).alias("procedure_order"), F.lit("A1").alias("procedure_code"))
    visits = first.withColumn("attendkey", F.col("epikey").cast("string")).drop("epikey")
    codes = spark.createDataFrame([("usually_dc", "A1"), ("usually_op", "A1")], "strategy string, procedure_code string")
    cells = spark.createDataFrame(
        [(201920, 50, 1, "P", "efficiency", "usually_dc", 1.0, 2), (201920, 50, 1, "P", "efficiency", "pre-op_los_1-day", 1.0, 2)],
        "fyear int, age int, sex int, provider string, type string, strategy string, n double, speldur long",
    )
    people = spark.createDataFrame([(201920, 50, 1, 10)], "fyear int, age int, sex int, population long")
    day = inputs.day_procedure_rates(ip, op, first, visits, codes, cells, people, "provider")
    operated = inputs.preop_rates(ip, cells, people, "provider")
    assert not any(f"{tmp_path}/ip" in f for df in (day, operated) for f in df.inputFiles())
    rates = {(r["strategy"], r["provider"]): r["crude_rate"] for df in (day, operated) for r in df.collect()}
    assert rates["usually_dc", "P"] == 0.2 and rates["usually_op", "national"] == 0 and rates["pre-op_los_1-day", "P"] == 0.25
