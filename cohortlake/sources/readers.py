"""Readers of the packaged rule files and of the population files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.operators.cohorts import alcohol_rules, sdec_rules


def read_csv(spark: SparkSession, path: str, schema: str, missing: str | None = None) -> DataFrame:
    """CSV with a header and a given schema; `missing` is the text of a missing value."""
    reader = spark.read.option("header", "true").option("enforceSchema", "false").schema(schema)
    return (reader.option("nullValue", missing) if missing else reader).csv(path)


def read_frailty_scores(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, "icd10 string, score double")


def read_trimpoints(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, "sushrg string, elective int, emergency int", missing="-")


def read_obesity_fractions(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, "diagnosis string, fraction double")


def read_smoking_rules(spark: SparkSession, path: str) -> DataFrame:
    """Smoking fractions as a rule table: `(pattern, sex, rate)`."""
    rows = read_csv(spark, path, "diagnoses string, sex int, value double")
    return rows.select(F.col("diagnoses").alias("pattern"), F.col("sex").cast("string").alias("sex"), F.col("value").alias("rate"))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON rule file as one row `value`, from any file system Spark can read."""
    return spark.read.text(path, wholetext=True)


def read_alcohol_rules(spark: SparkSession, path: str, group: str) -> DataFrame:
    return alcohol_rules(read_json(spark, path), group)


def read_sdec_rules(spark: SparkSession, path: str) -> DataFrame:
    return sdec_rules(read_json(spark, path))


def read_projections(spark: SparkSession, path: str) -> DataFrame:
    """Wide projection file: AREA_CODE, AGE_GROUP and a text column per year."""
    return spark.read.option("header", "true").csv(path)


def read_population_by_deprivation(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, "lsoa11cd string, age string, sex string, imd19 string, pop string")


def read_partitioned(spark: SparkSession, path: str, fyear: int | None = None) -> DataFrame:
    """A table written by the sinks; with a year, only its partitions are read."""
    df = spark.read.parquet(path)
    return df if fyear is None else df.filter(F.col("fyear") == fyear)
