"""Projections, model extracts, activity curves, release and sinks."""

import uuid

from pyspark.sql import functions as F

from checks.queries_inputs import INQ, inq_rates
from checks.registry import check
from checks.views import VARIANTS
from cohortlake.functions.expressions import fyear_of_year
from cohortlake.functions.materialise import scratch_folder
from cohortlake.operators import curves
from cohortlake.operators import extracts as ex
from cohortlake.operators import inequalities as inq
from cohortlake.operators import population as pop
from cohortlake.operators import records_ae as ae
from cohortlake.operators import release as rel
from cohortlake.sources import sinks, snapshots

ACUTE = "SELECT org_to FROM v_trust WHERE org_type LIKE 'ACUTE%'"


def plain_years(df):
    """Year columns named as in the published files (2022, not y2022)."""
    return df.toDF(*[c[1:] if c[0] == "y" and c[1:].isdigit() else c for c in df.columns])


def unpivot_sql(view: str, ids: str) -> str:
    return f"(UNPIVOT {view} ON COLUMNS(* EXCLUDE ({ids})) INTO NAME cell VALUE v)"


# --- projections ---------------------------------------------------------------------------------
LOCAL = f"""
local AS (SELECT AREA_CODE AS area_code, CASE WHEN AGE_GROUP = '90 and over' THEN 90 ELSE TRY_CAST(AGE_GROUP AS INT) END AS age,
    CAST(sex AS INT) AS sex, CAST(substr(cell, 2) AS INT) AS year, CAST(v AS DOUBLE) AS value, 'migration_category' AS projection, 2022 AS projection_year
  FROM {unpivot_sql('v_snpp', 'AREA_CODE, AGE_GROUP, sex')} WHERE AGE_GROUP <> 'All ages' AND regexp_matches(AREA_CODE, '^E0[6-9]')
    AND CAST(substr(cell, 2) AS INT) BETWEEN 2022 AND 2047)"""
NATIONAL = f"""
national AS (SELECT CASE WHEN Sex = 'Males' THEN 1 ELSE 2 END AS sex, least(CAST(regexp_extract(Age, '^\\s*(\\d+)', 1) AS INT), 90) AS age,
    CAST(substr(cell, 2) AS INT) AS year, sum(CAST(v AS DOUBLE)) AS pop
  FROM {unpivot_sql('v_npp', 'Age, Sex')} WHERE CAST(substr(cell, 2) AS INT) BETWEEN 2022 AND 2047 GROUP BY ALL)"""
BIRTHS = f"""
mothers AS (SELECT AREA_CODE, AGE_GROUP, cell, sum(CAST(v AS DOUBLE)) AS v FROM {unpivot_sql('v_births', 'AREA_CODE, AGE_GROUP, SEX')}
  WHERE AGE_GROUP <> 'All ages' GROUP BY ALL),
births AS (SELECT AREA_CODE AS area_code, CAST(AGE_GROUP AS INT) AS age, CAST(substr(cell, 2) AS INT) AS year, v AS value,
    'migration_category' AS projection, 2022 AS projection_year FROM mothers WHERE regexp_matches(AREA_CODE, '^E0[6-9]'))"""


def local(v):
    return pop.local_projections(plain_years(v.snpp), 2022, "migration_category", F.col("sex").cast("int"))


def national(v):
    return pop.national_projection(plain_years(v.npp), 2022)


def births(v):
    summed = pop.births_by_mother(plain_years(v.births), pop.years_covered(2022)[1:])
    return pop.local_births(summed, 2022, "migration_category")


@check("pop_01_local_projections", f"WITH {LOCAL} SELECT * FROM local")
def _(v):
    return local(v)


@check("pop_02_local_births", f"WITH {BIRTHS} SELECT * FROM births")
def _(v):
    return births(v)


@check("pop_03_national_projection", f"WITH {NATIONAL} SELECT * FROM national")
def _(v):
    return national(v)


@check(
    "pop_04_rescale_population",
    f"""WITH {LOCAL}, {NATIONAL} SELECT l.area_code, l.age, l.sex, l.year, 'high_fertility' AS projection, l.projection_year,
          round(n.pop * l.value / sum(l.value) OVER (PARTITION BY l.year, l.sex, l.age), 6) AS value
        FROM local l JOIN national n USING (year, sex, age)""",
)
def _(v):
    return pop.rescale_population(local(v), national(v), 2022, "high_fertility")


@check(
    "pop_05_rescale_births",
    f"""WITH {BIRTHS}, {NATIONAL} SELECT l.area_code, l.age, l.year, 'high_fertility' AS projection, l.projection_year,
          round(n.pop * l.value / sum(l.value) OVER (PARTITION BY l.year, l.age), 6) AS value
        FROM births l JOIN national n USING (year, age) WHERE n.sex = 2""",
)
def _(v):
    return pop.rescale_births(births(v), national(v), 2022, "high_fertility")


@check(
    "pop_06_variant_names",
    """WITH files AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'hhh' WHEN 1 THEN 'ppz' WHEN 2 THEN 'xxx' ELSE 'ppq' END AS file FROM part)
       SELECT p_partkey, file, CASE file WHEN 'hhh' THEN 'high_population' WHEN 'ppz' THEN 'zero_net_migration' WHEN 'ppq' THEN 'zero_eu_migration' END AS projection
       FROM files WHERE file <> 'xxx'""",
)
def _(v):
    names = F.array(*[F.lit(x) for x in ("hhh", "ppz", "xxx", "ppq")])
    files = v.part.select("p_partkey", F.get(names, (F.col("p_partkey") % 4).cast("int")).alias("file"))
    return pop.variant_names(files)


@check("pop_07_births_by_mother", f"WITH {BIRTHS} SELECT AREA_CODE, AGE_GROUP, CAST(substr(cell, 2) AS INT) AS year, v AS value FROM mothers")
def _(v):
    years = pop.years_covered(2022)[1:]
    wide = pop.births_by_mother(plain_years(v.births), years)
    long = wide.unpivot(["AREA_CODE", "AGE_GROUP"], [str(y) for y in years], "year", "value")
    return long.withColumn("year", F.col("year").cast("int"))


# --- extracts ------------------------------------------------------------------------------------
@check(
    "mod_01_ip_extract",
    """SELECT epikey AS rn, provider AS dataset, 2019 AS fyear, age, CAST(sex AS INT) AS sex, substr(sushrg, 1, 4) AS sushrg_trimmed, hsagrp, speldur
       FROM v_ip WHERE fyear = 201920""",
)
def _(v):
    return ex.ip_extract(v.ip, 201920).select("rn", "dataset", "fyear", "age", "sex", "sushrg_trimmed", "hsagrp", "speldur")


def _cohort_extract(kind: str) -> None:
    @check(
        f"mod_02_cohort_extract_{kind}",
        f"""SELECT c.provider AS dataset, 2019 AS fyear, c.epikey AS rn, c.strategy, round(c.sample_rate, 6) AS sample_rate
            FROM v_cohort c JOIN v_ip i ON i.epikey = c.epikey AND i.provider = c.provider WHERE c.type = '{kind}' AND c.fyear = 201920 AND i.fyear = 201920""",
    )
    def _(v):
        return ex.cohort_extract(v.cohort, ex.ip_extract(v.ip, 201920), 201920, kind)


_cohort_extract("activity_avoidance")
_cohort_extract("efficiency")

OP_ROLL = f"""{INQ},
op_roll AS (SELECT fyear, provider AS dataset, age, sex, imd_quintile, type, "group" AS grp, has_procedures, substr(sushrg, 1, 4) AS sushrg_trimmed, icb,
    is_main_icb, sum(attendance) AS attendances, sum(tele_attendance) AS tele_attendances FROM v_op WHERE fyear = 201920 GROUP BY ALL),
found AS (SELECT DISTINCT icb, provider AS dataset, sushrg_trimmed FROM fits WHERE fyear = 201920 AND pvalue < 0.3 AND slope > 0)"""


def op_rolled(v):
    keys = ["fyear", "provider", "age", "sex", "imd_quintile", "type", "group", "has_procedures", "sushrg_trimmed", "icb", "is_main_icb"]
    short = v.op.withColumn("sushrg_trimmed", F.substring("sushrg", 1, 4))
    sums = [F.sum("attendance").alias("attendances"), F.sum("tele_attendance").alias("tele_attendances")]
    return short.groupBy(*keys).agg(*sums).withColumn("index", ae.row_id(*keys))


def found(v):
    rates = inq_rates(v)
    adjusted = inq.adjustments(rates, inq.regressions(rates, min_count=3), alpha=0.3)
    return adjusted.select("fyear", "icb", "provider", "sushrg_trimmed")


@check(
    "mod_03_op_extract",
    f"""WITH {OP_ROLL}, marked AS (SELECT o.*, f.icb IS NOT NULL AS kept FROM op_roll o LEFT JOIN found f USING (icb, dataset, sushrg_trimmed))
        SELECT dataset, 2019 AS fyear, age, sex, imd_quintile, type, grp AS "group", has_procedures::INT AS has_procedures, sushrg_trimmed, icb, is_main_icb::INT AS is_main_icb,
          CAST(attendances AS BIGINT) AS attendances, CAST(tele_attendances AS BIGINT) AS tele_attendances, 1 AS is_wla FROM marked WHERE kept
        UNION ALL
        SELECT dataset, 2019, age, sex, NULL, type, grp, has_procedures::INT, NULL, icb, is_main_icb::INT, CAST(sum(attendances) AS BIGINT), CAST(sum(tele_attendances) AS BIGINT), 1
        FROM marked WHERE NOT kept GROUP BY dataset, age, sex, type, grp, has_procedures, icb, is_main_icb""",
)
def _(v):
    return ex.op_extract(op_rolled(v), found(v), 201920).drop("index")


@check(
    "mod_04_ae_extract",
    """SELECT provider AS dataset, 2019 AS fyear, age, sex, hsagrp, count(*) AS groups, CAST(sum(arrivals) AS BIGINT) AS arrivals FROM (
         SELECT fyear, provider, age, sex, age_group, sitetret, aedepttype, attendance_category, acuity, tretspef, tretspef_grouped, "group", pod, demog_type, type, hsagrp, ndggrp, icb,
           is_main_icb, is_adult, is_ambulance, is_frequent_attender, is_low_cost_referred_or_discharged, is_left_before_treatment, is_discharged_no_treatment, sum(arrival) AS arrivals
         FROM v_ae GROUP BY ALL) r WHERE fyear = 201920 GROUP BY ALL""",
)
def _(v):
    extract = ex.ae_extract(ae.ae_rollup(v.ae), 201920)
    return extract.groupBy("dataset", "fyear", "age", "sex", "hsagrp").agg(
        F.count("*").alias("groups"), F.sum("arrivals").alias("arrivals")
    )


@check(
    "mod_04_inequalities_extract",
    f"""WITH {OP_ROLL} SELECT p.provider AS dataset, 2019 AS fyear, f.icb, f.sushrg_trimmed
        FROM (SELECT DISTINCT provider FROM v_ip WHERE fyear = 201920) p LEFT JOIN found f ON f.dataset = p.provider""",
)
def _(v):
    return ex.inequalities_extract(found(v).distinct(), v.ip, 201920).select("dataset", "fyear", "icb", "sushrg_trimmed")


YEARS = [2023, 2024, 2035, 2047]
PROJECTED = f"""
projected AS (SELECT s.provider AS dataset, p.projection AS variant, p.age, p.sex, p.year, sum(p.value * s.lad23_pcnt) AS value
  FROM v_proj p JOIN v_proj_lookup l ON l.lad22cd = p.area_code JOIN v_split s ON s.lad23cd = l.lad23cd AND s.age = p.age AND s.sex = p.sex
  WHERE p.projection <> 'unused_variant' AND p.year BETWEEN 2023 AND 2047 AND p.projection_year = 2022 AND s.fyear = 201920 AND s.provider IN ({ACUTE}) GROUP BY ALL)"""
WIDE = ", ".join(f'round(sum(value) FILTER (year = {y}), 6) AS "{y}"' for y in YEARS)


def projected(v):
    return ex.provider_population(v.proj, v.split, v.trust, v.proj_lookup, 201920, years=YEARS)


@check(
    "mod_05_demographic_factors",
    f"WITH {PROJECTED} SELECT dataset, variant, age, sex, {WIDE} FROM projected GROUP BY dataset, variant, age, sex",
)
def _(v):
    return ex.by_year(projected(v), YEARS)


@check(
    "mod_05_demographic_factors_all_years",
    f"""WITH {PROJECTED} SELECT dataset, variant, age, sex, {", ".join(f'round(sum(value) FILTER (year = {y}), 6) AS "{y}"' for y in ex.PROJECTED_YEARS)}
        FROM projected GROUP BY dataset, variant, age, sex""",
)
def _(v):
    return ex.by_year(ex.provider_population(v.proj, v.split, v.trust, v.proj_lookup, 201920))


@check(
    "mod_06_birth_factors",
    f"""SELECT s.provider AS dataset, p.projection AS variant, p.age, 2 AS sex, {WIDE.replace('sum(value)', 'sum(value * lad23_pcnt)')}
        FROM v_proj p JOIN v_split s ON s.lad23cd = p.area_code AND s.age = p.age AND s.sex = 2
        WHERE p.sex = 1 AND p.projection <> 'unused_variant' AND p.year BETWEEN 2023 AND 2047 AND s.provider IN ({ACUTE}) GROUP BY ALL""",
)
def _(v):
    births = v.proj.filter(F.col("sex") == 1).drop("sex")
    return ex.birth_factors(births, v.split, v.trust, v.proj_lookup, 201920, years=YEARS)


CUSTOM_SELECT = ", ".join(f'round(b."{y}" * c."{y}" / nullif(p."{y}", 0), 6) AS "{y}"' for y in YEARS)
KEPT_SELECT = ", ".join(f'round("{y}", 6) AS "{y}"' for y in YEARS)


@check(
    "mod_07_custom_birth_factors",
    f"""WITH {PROJECTED}, wide AS (SELECT dataset, variant, age, sex, {", ".join(f'sum(value) FILTER (year = {y}) AS "{y}"' for y in YEARS)}
          FROM projected GROUP BY dataset, variant, age, sex),
        demo AS (SELECT * FROM wide WHERE dataset = 'P000'),
        born AS (SELECT dataset, variant, age, 2 AS sex, {", ".join(f'"{y}" / 50 AS "{y}"' for y in YEARS)} FROM wide
          WHERE dataset = 'P000' AND sex = 1 AND age BETWEEN 10 AND 50 AND variant = 'migration_category')
        SELECT dataset, variant, age, sex, {KEPT_SELECT} FROM born
        UNION ALL
        SELECT b.dataset, 'var_proj_high_intl_migration', b.age, 2, {CUSTOM_SELECT} FROM born b
        JOIN demo p ON p.age = b.age AND p.sex = 2 AND p.variant = 'migration_category'
        JOIN demo c ON c.age = b.age AND c.sex = 2 AND c.variant = 'var_proj_high_intl_migration' WHERE b.age BETWEEN 15 AND 44""",
)
def _(v):
    wide = ex.by_year(projected(v), YEARS)
    born = wide.filter("dataset = 'P000' AND sex = 1 AND age BETWEEN 10 AND 50 AND variant = 'migration_category'")
    born = born.select("dataset", "variant", "age", F.lit(2).alias("sex"), *[(F.col(str(y)) / 50).alias(str(y)) for y in YEARS])
    return ex.custom_birth_factors(born, wide, "P000", "var_proj_high_intl_migration", YEARS)


@check(
    "mod_08_icb_projections",
    f"""SELECT s.icb, p.projection AS variant, p.age, p.sex, {WIDE.replace('sum(value)', 'sum(value * pcnt)')}
        FROM v_proj p JOIN v_icb_share s USING (area_code) WHERE p.projection <> 'unused_variant' AND p.year BETWEEN 2023 AND 2047 GROUP BY ALL""",
)
def _(v):
    return ex.by_year(ex.icb_population(v.proj, v.icb_share, years=YEARS), YEARS)


# --- curves --------------------------------------------------------------------------------------
CURVE_YEARS = [2018, 2019, 2020]


def activity_sql(place: str, columns: str) -> str:
    return f"""
activity AS (SELECT fyear // 100 AS fyear, {columns} age, sex, hsagrp, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT fyear, provider, icb, age, CAST(sex AS INT) AS sex, hsagrp, 1 AS n FROM v_ip
    UNION ALL SELECT fyear, provider, icb, age, sex, hsagrp, attendance FROM v_op
    UNION ALL SELECT fyear, provider, icb, age, sex, hsagrp, arrival FROM v_ae) a
  WHERE fyear // 100 IN (2018, 2019, 2020) AND hsagrp NOT IN ('birth', 'maternity', 'paeds', 'unknown') {place} GROUP BY ALL)"""


def rates_sql(place: str, people: str) -> str:
    return f"""
adult AS (SELECT * FROM activity WHERE age >= 18 AND hsagrp NOT LIKE 'op_maternity_%'),
people AS ({people}),
rates AS (SELECT p.{place}, k.hsagrp, p.sex, p.fyear, p.age, coalesce(a.n, 0) / nullif(p.pop, 0) AS rate FROM people p
  JOIN (SELECT DISTINCT {place}, sex, hsagrp FROM adult) k ON k.{place} = p.{place} AND k.sex = p.sex
  LEFT JOIN adult a ON a.{place} = p.{place} AND a.sex = p.sex AND a.hsagrp = k.hsagrp AND a.fyear = p.fyear AND a.age = p.age)
SELECT {place}, hsagrp, sex, fyear, age, round(rate, 6) AS activity_rate FROM rates
QUALIFY count(*) FILTER (rate <> 0) OVER (PARTITION BY {place}, hsagrp, sex, fyear) > 0"""


def extracts_of(v):
    year = F.floor(F.col("fyear") / 100).cast("int").alias("fyear")
    common = [F.col("provider").alias("dataset"), "icb", "age", F.col("sex").cast("int").alias("sex"), "hsagrp"]
    return (
        v.ip.select(year, *common),
        v.op.select(year, *common, F.col("attendance").alias("attendances")),
        v.ae.select(year, *common, F.col("arrival").alias("arrivals")),
    )


def people_of(v, place, name):
    year = F.floor(F.col("fyear") / 100).cast("int").alias("year")
    variant = F.lit("migration_category").alias("variant")
    people = v.pop_provider.select(place.alias(name), variant, "age", "sex", year, F.col("population").alias("value"))
    return people.groupBy(name, "variant", "age", "sex", "year").agg(F.sum("value").alias("value"))


def provider_curve_rates(v):
    return curves.provider_rates(*extracts_of(v), people_of(v, F.col("provider"), "dataset"), CURVE_YEARS, left_out=["P002", "RBS"])


PROVIDER_RATES = f"""WITH {activity_sql("AND provider NOT IN ('P002', 'RBS')", "provider AS dataset,")}, {rates_sql(
    "dataset", "SELECT provider AS dataset, age, sex, fyear // 100 AS fyear, sum(population) AS pop FROM v_pop_provider WHERE age >= 18 AND fyear // 100 IN (2018, 2019, 2020) GROUP BY ALL")}"""


@check("mod_09_provider_rates", PROVIDER_RATES)
def _(v):
    return provider_curve_rates(v)


ICB_OF = "'Q' || CAST(CAST(substr(provider, 2) AS INT) % 5 AS VARCHAR)"


def icb_curve_rates(v):
    icb = F.concat(F.lit("Q"), (F.substring("provider", 2, 3).cast("int") % 5).cast("string"))
    return curves.icb_rates(*extracts_of(v), people_of(v, icb, "icb"), CURVE_YEARS)


ICB_RATES = f"""WITH {activity_sql("", "icb,")}, {rates_sql(
        "icb", f"SELECT {ICB_OF} AS icb, age, sex, fyear // 100 AS fyear, sum(population) AS pop FROM v_pop_provider WHERE age >= 18 AND fyear // 100 IN (2018, 2019, 2020) GROUP BY ALL")}"""


@check("mod_10_icb_rates", ICB_RATES)
def _(v):
    return icb_curve_rates(v)


def national_curve_rates(v):
    projections = v.pop_lad.select(
        F.col("lad23cd").alias("area_code"), F.lit("migration_category").alias("projection"), "age", "sex",
        F.floor(F.col("fyear") / 100).cast("int").alias("year"), F.col("population").cast("double").alias("value"),
    )
    return curves.national_rates(*extracts_of(v), projections, CURVE_YEARS)


NATIONAL_RATES = f"""WITH {activity_sql("", "")}, people AS (SELECT fyear // 100 AS fyear, age, sex, sum(population) AS pop FROM v_pop_lad
          WHERE age >= 18 AND regexp_matches(lad23cd, '^E0[6-9]') GROUP BY ALL)
        SELECT a.hsagrp, a.sex, a.fyear, a.age, round(a.n / nullif(p.pop, 0), 6) AS activity_rate FROM activity a JOIN people p USING (fyear, age, sex)"""


@check("mod_11_national_rates", NATIONAL_RATES)
def _(v):
    return national_curve_rates(v)


@check("mod_12_curves_provider")
def _(v):
    return curves.fit_curves(provider_curve_rates(v), ["dataset", "hsagrp", "sex", "fyear"])


@check("mod_12_curves_icb")
def _(v):
    return curves.fit_curves(icb_curve_rates(v), ["icb", "hsagrp", "sex", "fyear"])


@check("mod_12_curves_national")
def _(v):
    return curves.fit_curves(national_curve_rates(v), ["hsagrp", "sex", "fyear"])


def _moments(v, rates, keys):
    """A fit with a second-difference penalty leaves lines free: residuals sum to zero, also when weighted by age."""
    fitted = curves.fit_curves(rates, keys).withColumnRenamed("activity", "_fitted")
    known = rates.filter(F.col("activity_rate").isNotNull()).withColumn("fyear", fyear_of_year(F.col("fyear")))
    gap, size = F.col("activity_rate") - F.col("_fitted"), F.sum(F.abs("activity_rate")) + 1e-9
    return (
        known.join(fitted, [*keys, "age"])
        .groupBy(*keys)
        .agg(
            F.count("*").alias("points"),
            (F.abs(F.sum(gap)) < 1e-6 * size).cast("int").alias("level_kept"),
            (F.abs(F.sum(gap * F.col("age"))) < 1e-4 * size).cast("int").alias("slope_kept"),
        )
    )


def _moments_sql(rates: str, keys: str) -> str:
    return f"""SELECT {keys} fyear * 100 + (fyear + 1) % 100 AS fyear, count(activity_rate) AS points, 1 AS level_kept, 1 AS slope_kept
        FROM ({rates}) r WHERE activity_rate IS NOT NULL GROUP BY ALL"""


@check("mod_12_moments_provider", _moments_sql(PROVIDER_RATES, "dataset, hsagrp, sex,"))
def _(v):
    return _moments(v, provider_curve_rates(v), ["dataset", "hsagrp", "sex", "fyear"])


@check("mod_12_moments_icb", _moments_sql(ICB_RATES, "icb, hsagrp, sex,"))
def _(v):
    return _moments(v, icb_curve_rates(v), ["icb", "hsagrp", "sex", "fyear"])


@check("mod_12_moments_national", _moments_sql(NATIONAL_RATES, "hsagrp, sex,"))
def _(v):
    return _moments(v, national_curve_rates(v), ["hsagrp", "sex", "fyear"])


# --- release -------------------------------------------------------------------------------------
STRATA = 'age_group, sex, classpat, tretspef, hsagrp, "group"'
LARGE = f"large AS (SELECT {STRATA}, count(*) AS count FROM v_ip GROUP BY ALL HAVING count(*) >= 10)"


def released(v):
    return v.ip.withColumnRenamed("epikey", "rn")


@check(
    "syn_01_suppress_small",
    f"""WITH {LARGE} SELECT i.epikey AS rn, i.age_group, i.tretspef FROM v_ip i
        JOIN large l ON l.age_group = i.age_group AND l.sex = i.sex AND l.classpat = i.classpat AND l.tretspef = i.tretspef AND l.hsagrp = i.hsagrp AND l."group" = i."group" """,
)
def _(v):
    return rel.suppress_small(released(v)).select("rn", "age_group", "tretspef")


@check("syn_02_mean_stay", f"SELECT {STRATA}, round(avg(speldur), 6) AS mean_los FROM v_ip GROUP BY ALL")
def _(v):
    return rel.mean_stay(released(v))


@check(
    "syn_03_strategy_rates",
    f"""WITH {LARGE}, joined AS (SELECT i.age_group, i.sex, i.classpat, i.tretspef, i.hsagrp, i."group", c.strategy, c.sample_rate FROM v_ip i JOIN v_cohort c USING (epikey)),
      modes AS (SELECT * EXCLUDE (k) FROM (SELECT {STRATA}, strategy, sample_rate AS mode, row_number() OVER (PARTITION BY {STRATA}, strategy ORDER BY count(*) DESC, sample_rate) AS k
        FROM joined GROUP BY {STRATA}, strategy, sample_rate) m WHERE k = 1),
      summary AS (SELECT {STRATA}, strategy, count(*) AS n, min(sample_rate) AS min, max(sample_rate) AS max FROM joined GROUP BY ALL)
      SELECT {STRATA}, strategy, round(mode, 6) AS mode, round(min, 6) AS min, round(max, 6) AS max, round(n / count, 6) AS r
      FROM summary JOIN modes USING ({STRATA}, strategy) JOIN large USING ({STRATA})""",
)
def _(v):
    cohorts = v.cohort.withColumnRenamed("epikey", "rn")
    return rel.strategy_rates(released(v), cohorts)


@check(
    "syn_04_sample_fraction",
    """SELECT epikey AS rn, age FROM v_ip WHERE CAST('0x' || substr(md5(CAST(epikey AS VARCHAR) || '-7'), 1, 8) AS BIGINT) < CAST(0.3 * 4294967296 AS BIGINT)""",
)
def _(v):
    return rel.sample_fraction(released(v), "rn", 0.3, 7).select("rn", "age")


@check(
    "syn_04_sample_to_size",
    """SELECT epikey AS rn FROM v_ip WHERE CAST('0x' || substr(md5(CAST(epikey AS VARCHAR) || '-11'), 1, 8) AS BIGINT)
         < CAST(floor(100.0::DOUBLE / (SELECT count(*) FROM v_ip) * 4294967296) AS BIGINT)""",
)
def _(v):
    return rel.sample_to_size(released(v), "rn", 100, 11).select("rn")


@check(
    "syn_05_coded_labels",
    """SELECT diagnosis AS code, 'HRG' || CAST(row_number() OVER (ORDER BY count(*) DESC, diagnosis) AS VARCHAR) AS label FROM v_dx GROUP BY diagnosis""",
)
def _(v):
    return rel.coded_labels(v.dx, "diagnosis").withColumnRenamed("diagnosis", "code")


@check(
    "syn_06_coarsen",
    """SELECT fyear, age, sex, imd_quintile, type, "group", has_procedures::INT AS has_procedures, sushrg_trimmed, CASE WHEN is_main_icb THEN 'A' ELSE 'B' END AS icb,
         is_main_icb::INT AS is_main_icb, 'a' AS sitetret, CAST(sum(attendances) AS BIGINT) AS attendances, CAST(sum(tele_attendances) AS BIGINT) AS tele_attendances FROM (
         SELECT fyear, provider, age, sex, imd_quintile, type, "group", has_procedures, substr(sushrg, 1, 4) AS sushrg_trimmed, icb, is_main_icb,
           sum(attendance) AS attendances, sum(tele_attendance) AS tele_attendances FROM v_op GROUP BY ALL) r
       GROUP BY ALL HAVING sum(attendances) >= 3""",
)
def _(v):
    rolled = op_rolled(v).withColumnRenamed("provider", "dataset")
    return rel.coarsen(rolled, ["attendances", "tele_attendances"], minimum=3)


@check(
    "syn_06_coarsen_ae",
    """SELECT fyear, age_group, sex, hsagrp, is_main_icb::INT AS is_main_icb, 'a' AS sitetret, CASE WHEN is_main_icb THEN 'A' ELSE 'B' END AS icb, CAST(sum(arrival) AS BIGINT) AS arrivals
       FROM v_ae GROUP BY ALL HAVING sum(arrival) >= 10""",
)
def _(v):
    keys = ["fyear", "provider", "age_group", "sex", "hsagrp", "is_main_icb", "icb"]
    rolled = v.ae.groupBy(*keys).agg(F.sum("arrival").alias("arrivals")).withColumnRenamed("provider", "dataset")
    return rel.coarsen(rolled, ["arrivals"])


@check(
    "syn_07_average_over_datasets",
    f"""WITH {PROJECTED} SELECT variant, sex, age, {", ".join(f'round(avg(v{y}), 6) AS "{y}"' for y in YEARS)} FROM (
          SELECT dataset, variant, sex, age, {", ".join(f"sum(value) FILTER (year = {y}) AS v{y}" for y in YEARS)} FROM projected GROUP BY dataset, variant, sex, age) w GROUP BY ALL""",
)
def _(v):
    years = [str(y) for y in YEARS]
    return rel.average_over_datasets(ex.by_year(projected(v), YEARS), ["variant", "sex", "age"], years)


@check(
    "syn_07_release_inequalities",
    """WITH labels AS (SELECT substr(sushrg, 1, 4) AS code, 'HRG' || CAST(row_number() OVER (ORDER BY count(*) DESC, substr(sushrg, 1, 4)) AS VARCHAR) AS label
         FROM v_ip WHERE sushrg IS NOT NULL GROUP BY 1),
       sized AS (SELECT provider AS dataset, fyear, icb, imd_quintile, substr(sushrg, 1, 4) AS code, count(*) AS n FROM v_ip WHERE admimeth LIKE '1%' AND sushrg IS NOT NULL GROUP BY ALL)
       SELECT sushrg_trimmed, icb, imd_quintile, fyear, n FROM (
         SELECT l.label AS sushrg_trimmed, s.*, row_number() OVER (PARTITION BY l.label, icb, imd_quintile ORDER BY dataset, fyear, n) AS k FROM sized s JOIN labels l USING (code)) r WHERE k = 1""",
)
def _(v):
    hrg = F.substring("sushrg", 1, 4).alias("sushrg_trimmed")
    coded = v.ip.filter(F.col("sushrg").isNotNull())
    sized = (
        coded.filter(F.col("admimeth").startswith("1"))
        .groupBy(F.col("provider").alias("dataset"), "fyear", "icb", "imd_quintile", hrg)
        .agg(F.count("*").alias("n"))
    )
    return rel.release_inequalities(sized, rel.coded_labels(coded.select(hrg)))


# --- sinks ---------------------------------------------------------------------------------------
def _folder(v) -> str:
    return f"{scratch_folder(v.spark)}/{uuid.uuid4().hex}"


SOME = "SELECT epikey, fyear, provider, age, sex FROM v_ip"


def some(v):
    return v.ip.select("epikey", "fyear", "provider", "age", "sex")


@check("snk_01_write_partitioned", SOME)
def _(v):
    path = _folder(v)
    sinks.write_partitioned(some(v), path, sort=["epikey"])
    return v.spark.read.parquet(path)


@check(
    "snk_02_replace_partitions",
    f"""SELECT epikey, fyear, provider, CASE WHEN fyear >= 201920 AND epikey % 2 = 0 THEN age + 100 ELSE age END AS age, sex FROM v_ip
        WHERE fyear < 201920 OR epikey % 2 = 0
          OR (fyear, provider) NOT IN (SELECT (fyear, provider) FROM v_ip WHERE fyear >= 201920 AND epikey % 2 = 0)""",
)
def _(v):
    path = _folder(v)
    sinks.write_partitioned(some(v), path)
    newer = some(v).filter("fyear >= 201920 AND epikey % 2 = 0").withColumn("age", F.col("age") + 100)
    sinks.replace_partitions(newer, path)
    return v.spark.read.parquet(path)


@check("snk_02_append", f"{SOME} UNION ALL {SOME} WHERE age < 50")
def _(v):
    path = _folder(v)
    sinks.append(some(v), path)
    sinks.append(some(v).filter("age < 50"), path)
    return v.spark.read.parquet(path)


@check(
    "snk_03_merge_into",
    """SELECT fyear, provider, epikey, type, strategy, round(sample_rate, 6) AS sample_rate FROM v_cohort WHERE strategy <> 'smoking'
       UNION ALL SELECT fyear, provider, epikey, type, strategy, round(sample_rate / 2, 6) FROM v_cohort WHERE strategy = 'smoking' AND epikey % 8 <> 1""",
)
def _(v):
    path = _folder(v)
    sinks.write_partitioned(v.cohort, path)
    smoking = v.cohort.filter("strategy = 'smoking' AND epikey % 8 <> 1")
    half = smoking.withColumn("sample_rate", F.col("sample_rate") / 2)
    return v.spark.read.parquet(sinks.merge_into(v.spark, path, half, [("activity_avoidance", "smoking")], "v2"))


@check(
    "snk_03_merge_snapshot",
    """SELECT fyear, provider, epikey, type, strategy, round(sample_rate, 6) AS sample_rate FROM v_cohort WHERE strategy <> 'smoking'
       UNION ALL SELECT fyear, provider, epikey, type, strategy, round(sample_rate / 2, 6) FROM v_cohort WHERE strategy = 'smoking' AND epikey % 8 <> 1""",
)
def _(v):
    path = _folder(v)
    snapshots.merge_snapshot(v.spark, path, v.cohort)
    smoking = v.cohort.filter("strategy = 'smoking' AND epikey % 8 <> 1")
    half = smoking.withColumn("sample_rate", F.col("sample_rate") / 2)
    snapshots.merge_snapshot(v.spark, path, half, [("activity_avoidance", "smoking")])
    return snapshots.read_snapshot(v.spark, path)


@check(
    "snk_04_write_extract",
    """SELECT epikey AS rn, provider AS dataset, 2019 AS fyear, CAST(sex AS INT) AS sex, age FROM v_ip WHERE fyear = 201920""",
)
def _(v):
    path = _folder(v)
    extract = ex.ip_extract(v.ip, 201920).select("rn", "dataset", "fyear", "sex", "age")
    sinks.write_extract(extract, path, sort=["rn"])
    return v.spark.read.parquet(path)


@check("snk_05_build_if_absent", "SELECT provider, count(*) AS n FROM v_ip GROUP BY provider")
def _(v):
    path = _folder(v)
    built = sinks.build_if_absent(v.spark, path, lambda: some(v).groupBy("provider").agg(F.count("*").alias("n")))
    # a finished table is read back, not built again
    again = sinks.build_if_absent(v.spark, path, lambda: built.limit(0))
    return again
