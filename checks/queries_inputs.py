"""Inputs of the demand model and the inequality regressions."""

from pyspark.sql import functions as F

from checks.registry import check
from cohortlake.functions.expressions import five_year_band
from cohortlake.operators import inequalities as inq
from cohortlake.operators import inputs as inp
from cohortlake.operators import records_ae as ae
from cohortlake.operators import records_ip as rip
from cohortlake.operators import reference as ref
from cohortlake.operators import standardise as std
from cohortlake.operators.cohorts import tag
from cohortlake.operators.rules import standard_rules

ACUTE = "SELECT org_to FROM v_trust WHERE org_type LIKE 'ACUTE%'"
BAND5 = "CASE WHEN age >= 90 THEN '90+' ELSE lpad(CAST(age // 5 * 5 AS VARCHAR), 2, '0') || '-' || lpad(CAST(age // 5 * 5 + 4 AS VARCHAR), 2, '0') END"

BASES = """
ip_b AS (SELECT * REPLACE (CAST(sex AS INT) AS sex, tretspef_grouped AS tretspef) FROM v_ip WHERE fyear >= 201516 AND age IS NOT NULL),
op_b AS (SELECT * REPLACE (tretspef_grouped AS tretspef) FROM v_op WHERE fyear >= 201516 AND age IS NOT NULL),
ae_b AS (SELECT * REPLACE (tretspef_grouped AS tretspef) FROM v_ae WHERE fyear >= 201516 AND age IS NOT NULL),
cohorts AS (SELECT * FROM v_cohort UNION ALL
  SELECT fyear, provider, epikey, 'efficiency', 'general_los_reduction_' || CASE WHEN "group" = 'elective' THEN 'elective' ELSE 'emergency' END, 1.0
  FROM ip_b WHERE (admimeth LIKE '1%' OR admimeth LIKE '2%') AND classpat = '1'),
ae_f AS (
  SELECT * REPLACE ('frequent_attenders_' || type AS strategy), 'activity_avoidance' AS kind, is_frequent_attender::INT * arrival AS n, arrival AS d FROM (SELECT *, '' AS strategy FROM ae_b)
  UNION ALL SELECT * REPLACE ('left_before_seen_' || type AS strategy), 'activity_avoidance', is_left_before_treatment::INT * arrival, arrival FROM (SELECT *, '' AS strategy FROM ae_b)
  UNION ALL SELECT * REPLACE ('low_cost_discharged_' || type AS strategy), 'activity_avoidance', is_low_cost_referred_or_discharged::INT * arrival, arrival FROM (SELECT *, '' AS strategy FROM ae_b)
  UNION ALL SELECT * REPLACE ('discharged_no_treatment_' || type AS strategy), 'activity_avoidance', is_discharged_no_treatment::INT * arrival, arrival FROM (SELECT *, '' AS strategy FROM ae_b)),
op_x AS (SELECT *, '' AS strategy FROM op_b WHERE type <> 'maternity'),
op_f AS (
  SELECT * REPLACE ('followup_reduction_' || type AS strategy), 'activity_avoidance' AS kind, (1 - is_first::INT) * attendance AS n, attendance AS d FROM op_x WHERE NOT has_procedures
  UNION ALL SELECT * REPLACE ('consultant_to_consultant_reduction_' || type AS strategy), 'activity_avoidance', is_cons_cons_ref::INT * attendance, attendance FROM op_x
  UNION ALL SELECT * REPLACE ('gp_referred_first_attendance_reduction_' || type AS strategy), 'activity_avoidance', (is_gp_ref AND is_first)::INT * attendance, attendance FROM op_x
  UNION ALL SELECT * REPLACE ('convert_to_tele_' || type AS strategy), 'efficiency', attendance, attendance + tele_attendance FROM op_x WHERE NOT has_procedures)
"""


def cells_sql(g: str) -> str:
    return f"""
ae_c AS (SELECT fyear, age, sex, coalesce({g}, 'unknown') AS {g}, kind AS type, strategy, CAST(sum(n) AS BIGINT) AS n, CAST(sum(d) AS BIGINT) AS d FROM ae_f GROUP BY ALL),
op_c AS (SELECT fyear, age, sex, coalesce({g}, 'unknown') AS {g}, kind AS type, strategy, CAST(sum(n) AS BIGINT) AS n, CAST(sum(d) AS BIGINT) AS d FROM op_f GROUP BY ALL),
ip_c AS (SELECT i.fyear, i.age, i.sex, coalesce(i.{g}, 'unknown') AS {g}, c.type, c.strategy, sum(c.sample_rate) AS n, CAST(sum(i.speldur) AS BIGINT) AS speldur
         FROM ip_b i JOIN cohorts c ON c.fyear = i.fyear AND c.provider = i.provider AND c.epikey = i.epikey GROUP BY ALL)"""


def standard_sql(source: str, g: str, name: str = "rates") -> str:
    """Rates of a cell table by direct standardisation, as CTEs that end in `name`."""
    return f"""
{name}_w AS (SELECT b.fyear, b.strategy, b.sex, p.age, sum(p.population) AS ref
  FROM (SELECT fyear, strategy, sex, min(age) AS lo, max(age) AS hi FROM {source} GROUP BY ALL) b
  JOIN v_pop_lad p ON p.fyear = b.fyear AND p.sex = b.sex AND p.age BETWEEN b.lo AND b.hi GROUP BY ALL),
{name}_j AS (SELECT w.fyear, w.strategy, w.age, w.sex, w.ref, c.{g} AS {g}, c.n, c.d FROM {name}_w w LEFT JOIN {source} c
  ON c.fyear = w.fyear AND c.strategy = w.strategy AND c.age = w.age AND c.sex = w.sex),
{name}_a AS (SELECT fyear, strategy, {g}, coalesce(n, 0) AS n, coalesce(d, 1) AS d, ref FROM {name}_j WHERE {g} IS NOT NULL
  UNION ALL SELECT fyear, strategy, 'national', sum(n), sum(d), ref FROM {name}_j GROUP BY fyear, strategy, age, sex, ref),
{name} AS (SELECT fyear, strategy, {g}, round(sum(n) / nullif(sum(d), 0), 6) AS crude_rate,
    round(sum(n / nullif(d, 0) * ref) / sum(ref), 6) AS std_rate, CAST(sum(d) AS DOUBLE) AS denominator FROM {name}_a GROUP BY ALL)"""


def published_sql(select: str, g: str) -> str:
    acute = f" AND provider IN ({ACUTE})" if g == "provider" else ""
    return f"SELECT * FROM ({select}) x WHERE {g} <> 'unknown'{acute}"


# --- bases ---------------------------------------------------------------------------------------
@check("inp_01_five_year_band", f"SELECT epikey, {BAND5} AS age_group FROM v_ip")
def _(v):
    return v.ip.select("epikey", five_year_band(F.col("age")).alias("age_group"))


@check(
    "inp_02_ip_base",
    f'WITH {BASES} SELECT epikey, fyear, provider, age, {BAND5} AS age_group, sex, tretspef, "group" FROM ip_b',
)
def _(v):
    return inp.ip_base(v.ip).select("epikey", "fyear", "provider", "age", "age_group", "sex", "tretspef", "group")


@check(
    "inp_03_general_los",
    f"WITH {BASES} SELECT fyear, provider, epikey, type, strategy, round(sample_rate, 6) AS sample_rate FROM cohorts",
)
def _(v):
    return inp.ip_cohorts(v.ip, v.cohort)


@check("inp_04_ae_families", f'WITH {BASES} SELECT key, fyear, provider, kind AS type, strategy, CAST(n AS BIGINT) AS n, CAST(d AS BIGINT) AS d FROM ae_f')
def _(v):
    return inp.ae_families(v.ae).select("key", "fyear", "provider", "type", "strategy", "n", "d")


@check("inp_05_op_families", f'WITH {BASES} SELECT attendkey, fyear, provider, kind AS type, strategy, CAST(n AS BIGINT) AS n, CAST(d AS BIGINT) AS d FROM op_f')
def _(v):
    return inp.op_families(v.op).select("attendkey", "fyear", "provider", "type", "strategy", "n", "d")


def ae_cells(v, g):
    return inp.ae_age_sex(v.ae, g)


def op_cells(v, g):
    return inp.op_age_sex(v.op, g)


def ip_cells(v, g):
    return inp.ip_age_sex(v.ip, v.cohort, g)


def _by_geography(g: str) -> None:
    end = "" if g == "provider" else "_lad23cd"
    start = f"WITH {BASES}, {cells_sql(g)}"

    @check(f"inp_06_age_sex_ae{end}", f"{start} SELECT * FROM ae_c")
    def _(v):
        return ae_cells(v, g)

    @check(f"inp_06_age_sex_op{end}", f"{start} SELECT * FROM op_c")
    def _(v):
        return op_cells(v, g)

    @check(f"inp_06_age_sex_ip{end}", f"{start} SELECT * REPLACE (round(n, 6) AS n) FROM ip_c")
    def _(v):
        return ip_cells(v, g)

    group = f"SELECT fyear, {g}, strategy, sex, {BAND5} AS age_group, round(CAST(sum(n) AS DOUBLE), 6) AS n FROM {{}} GROUP BY ALL HAVING sum(n) > 5"

    @check(
        f"inp_07_age_sex_table{end}",
        f"{start} " + published_sql(" UNION ALL ".join(group.format(t) for t in ("ae_c", "ip_c", "op_c")), g),
    )
    def _(v):
        return inp.age_sex_table([ae_cells(v, g), ip_cells(v, g), op_cells(v, g)], g, v.trust)

    @check(f"inp_08_directly_standardise{end}", f"{start}, {standard_sql('ae_c', g)} SELECT * FROM rates")
    def _(v):
        rates = std.directly_standardise(ae_cells(v, g), v.pop_lad, g)
        return rates.withColumn("denominator", F.col("denominator").cast("double"))

    complete = f"""
ages AS (SELECT type, strategy, sex, unnest(range(lo, hi + 1)) AS age FROM (SELECT type, strategy, sex, min(age) AS lo, max(age) AS hi FROM {{0}} GROUP BY ALL)),
wanted AS (SELECT y.fyear, y.type, y.strategy, p.{g}, a.sex, a.age FROM (SELECT DISTINCT fyear, type, strategy FROM {{0}}) y
  JOIN ages a USING (type, strategy) JOIN (SELECT DISTINCT fyear, {g} FROM {{0}}) p USING (fyear)),
complete AS (SELECT w.*, coalesce(c.n, 0) AS n FROM wanted w LEFT JOIN {{0}} c USING (fyear, type, strategy, {g}, sex, age))"""

    @check(f"inp_09_complete_cells{end}", f"{start}, {complete.format('ip_c')} SELECT fyear, type, strategy, {g}, sex, CAST(age AS INT) AS age, round(n, 6) AS n FROM complete")
    def _(v):
        return std.complete_cells(ip_cells(v, g).drop("speldur"), g)

    people = "v_pop_provider" if g == "provider" else "v_pop_lad"
    avoidance = f"""
chosen AS (SELECT * FROM ip_c WHERE type = 'activity_avoidance' OR strategy LIKE 'same_day_emergency_care_%'), {complete.format('chosen')},
avoid_c AS (SELECT c.*, p.population AS d FROM complete c JOIN {people} p ON p.fyear = c.fyear AND p.age = c.age AND p.sex = c.sex AND p.{g} = c.{g}
            WHERE p.population > 0), {standard_sql('avoid_c', g, 'r_avoid')}"""

    @check(f"inp_10_avoidance_rates{end}", f"{start}, {avoidance} SELECT * REPLACE (round(denominator, 6) AS denominator) FROM r_avoid")
    def _(v):
        population = v[people]
        return inp.avoidance_rates(ip_cells(v, g), population, v.pop_lad, g)

    names = ", ".join(f"'{s}'" for s in inp.LENGTH_OF_STAY)
    stay = f"""los_c AS (SELECT fyear, strategy, {g}, age, sex, speldur AS n, n AS d FROM ip_c WHERE strategy IN ({names})), {standard_sql('los_c', g, 'r_los')}"""

    @check(f"inp_11_mean_los{end}", f"{start}, {stay} SELECT * FROM r_los")
    def _(v):
        return inp.mean_length_of_stay(ip_cells(v, g), v.pop_lad, g)

    preop = f"""
operated AS (SELECT fyear, {g}, age, CAST(sex AS INT) AS sex, count(*) AS d FROM v_ip WHERE admimeth LIKE '1%' AND has_procedure GROUP BY ALL),
pre_c AS (SELECT o.fyear, c.strategy, o.{g}, o.age, o.sex, coalesce(c.n, 0) AS n, o.d FROM operated o
  LEFT JOIN (SELECT * FROM ip_c WHERE strategy LIKE 'pre-op_los_%') c ON c.fyear = o.fyear AND c.{g} = o.{g} AND c.age = o.age AND c.sex = o.sex),
{standard_sql('pre_c', g, 'r_pre')}"""

    @check(f"inp_12_preop_rates{end}", f"{start}, {preop} SELECT * FROM r_pre")
    def _(v):
        rates = inp.preop_rates(v.ip, ip_cells(v, g), v.pop_lad, g)
        return rates.withColumn("denominator", F.col("denominator").cast("double"))

    day = f"""
day_d AS (
  SELECT i.fyear, i.{g}, c.strategy, i.age, CAST(i.sex AS INT) AS sex, count(*) AS d FROM v_ip i JOIN v_px p ON p.fyear = i.fyear AND p.epikey = i.epikey
  JOIN v_day_code c ON c.procedure_code = p.procedure_code WHERE i.fyear >= 201516 AND p.procedure_order = 1 AND c.strategy LIKE '%dc' GROUP BY ALL
  UNION ALL
  SELECT i.fyear, i.{g}, c.strategy, i.age, i.sex, count(*) AS d FROM v_op i JOIN v_opa_px p ON p.fyear = i.fyear AND p.attendkey = i.attendkey
  JOIN v_day_code c ON c.procedure_code = p.procedure_code WHERE i.fyear >= 201516 AND p.procedure_order = 1 AND c.strategy LIKE '%op' GROUP BY ALL),
day_c AS (SELECT d.fyear, d.strategy, d.{g}, d.age, d.sex, coalesce(c.n, 0) AS n, coalesce(c.n, 0) + d.d AS d FROM day_d d
  LEFT JOIN ip_c c ON c.fyear = d.fyear AND c.strategy = d.strategy AND c.{g} = d.{g} AND c.age = d.age AND c.sex = d.sex),
{standard_sql('day_c', g, 'r_day')}"""

    @check(f"inp_13_day_procedure_rates{end}", f"{start}, {day} SELECT * FROM r_day")
    def _(v):
        return inp.day_procedure_rates(v.ip, v.op, v.px, v.opa_px, v.day_code, ip_cells(v, g), v.pop_lad, g)

    emergency = standard_sql("ae_c", g, "r_ae")
    visits = f"""op_d AS (SELECT * REPLACE (CASE WHEN strategy LIKE 'followup_reduction_%' THEN d - n ELSE d END AS d) FROM op_c),
op_e AS (SELECT * FROM op_d WHERE d > 0), {standard_sql('op_e', g, 'r_op')}"""

    @check(f"inp_14_ae_rates{end}", f"{start}, {emergency} SELECT * FROM r_ae")
    def _(v):
        return inp.ae_rates(ae_cells(v, g), v.pop_lad, g).withColumn("denominator", F.col("denominator").cast("double"))

    @check(f"inp_14_op_rates{end}", f"{start}, {visits} SELECT * FROM r_op")
    def _(v):
        return inp.op_rates(op_cells(v, g), v.pop_lad, g).withColumn("denominator", F.col("denominator").cast("double"))

    tables = ["r_ae", "r_avoid", "r_los", "r_pre", "r_day", "r_op"]
    kept = f"{g} <> 'unknown'" + (f" AND (provider IN ({ACUTE}) OR provider = 'national')" if g == "provider" else "")

    @check(
        f"inp_15_rates_table{end}",
        f"{start}, {avoidance}, {stay}, {preop}, {day}, {emergency}, {visits} SELECT * REPLACE (round(denominator, 6) AS denominator) FROM ("
        + " UNION ALL ".join(f"SELECT * FROM {t}" for t in tables)
        + f") u WHERE {kept}",
    )
    def _(v):
        cells = ip_cells(v, g)
        rates = [
            inp.ae_rates(ae_cells(v, g), v.pop_lad, g),
            inp.avoidance_rates(cells, v[people], v.pop_lad, g),
            inp.mean_length_of_stay(cells, v.pop_lad, g),
            inp.preop_rates(v.ip, cells, v.pop_lad, g),
            inp.day_procedure_rates(v.ip, v.op, v.px, v.opa_px, v.day_code, cells, v.pop_lad, g),
            inp.op_rates(op_cells(v, g), v.pop_lad, g),
        ]
        return inp.rates_table(rates, g, v.trust)

    def top(select: str, code: str, smallest: int, rest: int) -> str:
        return f"""SELECT fyear, {g}, strategy, {code}, round(n, 6) AS n, round(total, 6) AS total, round(n / nullif(total, 0), 6) AS pcnt, rn FROM (
          SELECT *, sum(n) OVER (PARTITION BY fyear, {g}, strategy) AS total,
                 row_number() OVER (PARTITION BY fyear, {g}, strategy ORDER BY n DESC, {code}) AS rn FROM ({select}) c) r
          WHERE rn <= 6 AND n >= {smallest} AND total - n >= {rest}"""

    def tops(kind: str, smallest: int, rest: int) -> list[str]:
        diag = kind == "diagnosis"
        ip_t, op_t, order = ("v_dx", "v_opa_dx", "diag_order") if diag else ("v_px", "v_opa_px", "procedure_order")
        source = "primary_diagnosis" if diag else "primary_treatment"
        count = "sum(n)" if diag else "count(n)"
        cut = f"substr(k.{kind}, 1, 3) AS {kind}"
        return [
            top(f"SELECT fyear, {g}, strategy, {source} AS {kind}, CAST({count} AS DOUBLE) AS n FROM ae_f WHERE n > 0 AND {source} <> '' GROUP BY ALL", kind, smallest, rest),
            top(f"SELECT i.fyear, i.{g}, c.strategy, {cut}, sum(c.sample_rate) AS n FROM ip_b i JOIN {ip_t} k ON k.epikey = i.epikey AND k.fyear = i.fyear AND k.{order} = 1 "
                f"JOIN cohorts c ON c.fyear = i.fyear AND c.provider = i.provider AND c.epikey = i.epikey GROUP BY ALL", kind, smallest, rest),
            top(f"SELECT i.fyear, i.{g}, i.strategy, {cut}, CAST({count.replace('n', 'i.n').replace('sum', 'sum').replace('coui.nt', 'count')} AS DOUBLE) AS n FROM op_f i JOIN {op_t} k ON k.attendkey = i.attendkey AND k.fyear = i.fyear AND k.{order} = 1 "
                f"WHERE i.n > 0 GROUP BY ALL", kind, smallest, rest),
        ]

    def tables_of(v, kind, **limits):
        diag = kind == "diagnosis"
        source = "primary_diagnosis" if diag else "primary_treatment"
        order = "diag_order" if diag else "procedure_order"
        return [
            inp.ae_top(v.ae, source, kind, g, weighted=diag, **limits),
            inp.ip_top(v.ip, v.cohort, v.dx if diag else v.px, order, kind, g, **limits),
            inp.op_top(v.op, v.opa_dx if diag else v.opa_px, order, kind, g, weighted=diag, **limits),
        ]

    for number, kind, name in ((16, "diagnosis", "diagnoses"), (17, "procedure_code", "procedures")):

        @check(f"inp_{number}_top_{name}{end}", f"WITH {BASES} " + published_sql(" UNION ALL ".join(tops(kind, 5, 5)), g))
        def _(v, kind=kind):
            return inp.code_table(tables_of(v, kind), g, v.trust)

        @check(f"inp_{number}_top_{name}_small{end}", f"WITH {BASES} " + published_sql(" UNION ALL ".join(tops(kind, 2, 1)), g))
        def _(v, kind=kind):
            return inp.code_table(tables_of(v, kind, smallest=2, rest=1), g, v.trust)

    medical = """CASE WHEN "group" = 'maternity' THEN 'Other (Medical)' ELSE tretspef END"""
    base_rows = [
        f"""SELECT fyear, {g}, "group", NULL AS tretspef, count(*) AS count, 'aae' AS activity_type FROM ae_b GROUP BY ALL""",
        f"""SELECT fyear, {g}, "group", {medical} AS tretspef, count(*) AS count, 'ip' AS activity_type FROM ip_b GROUP BY ALL""",
        f"""SELECT fyear, {g}, "group", tretspef, count(*) AS count, 'op' AS activity_type FROM op_b GROUP BY ALL""",
    ]

    @check(f"inp_18_baseline{end}", f"WITH {BASES} " + published_sql(" UNION ALL ".join(base_rows), g))
    def _(v):
        return inp.baseline(inp.activity_counts(v.ip, v.op, v.ae, g), g, v.trust)


_by_geography("provider")
_by_geography("lad23cd")

FLOWS = """
flow AS (
  SELECT fyear, provider, icb, is_main_icb, "group" AS grp, tretspef, arrival AS n, 'aae' AS activity_type FROM ae_b
  UNION ALL SELECT fyear, provider, icb, is_main_icb, "group", CASE WHEN "group" = 'maternity' THEN 'Other (Medical)' ELSE tretspef END, 1, 'ip' FROM ip_b
  UNION ALL SELECT fyear, provider, icb, is_main_icb, '', tretspef, attendance, 'op' FROM op_b),
icb_counts AS (SELECT fyear, icb, is_main_icb, provider, grp, tretspef, activity_type, CAST(sum(n) AS BIGINT) AS count FROM flow
  WHERE icb IS NOT NULL GROUP BY ALL HAVING activity_type <> 'op' OR sum(n) > 0)"""


@check(
    "inp_19_expatriation",
    f"WITH {BASES}, {FLOWS} "
    + published_sql(
        'SELECT fyear, provider, grp AS "group", tretspef, CAST(sum(n) AS BIGINT) AS count, activity_type FROM flow GROUP BY ALL', "provider"
    ),
)
def _(v):
    return inp.expatriation(inp.activity_counts(v.ip, v.op, v.ae), v.trust)


LOCAL_SQL = """SELECT fyear, icb, provider, grp AS "group", tretspef, activity_type, count,
  round(count / sum(count) OVER (PARTITION BY activity_type, icb, fyear, grp, tretspef), 6) AS pcnt FROM (
    SELECT fyear, icb, CASE WHEN is_main_icb THEN provider ELSE 'Other' END AS provider, grp, tretspef, activity_type, CAST(sum(count) AS BIGINT) AS count
    FROM icb_counts GROUP BY ALL) c"""


@check("inp_20_repatriation_local", f"WITH {BASES}, {FLOWS} " + published_sql(LOCAL_SQL, "provider"))
def _(v):
    return inp.repatriation_local(inp.activity_counts(v.ip, v.op, v.ae), v.trust)


@check(
    "inp_21_repatriation_nonlocal",
    f"WITH {BASES}, {FLOWS} "
    + published_sql(
        """SELECT fyear, icb, is_main_icb::INT AS is_main_icb, provider, grp AS "group", tretspef, activity_type, count,
             round(count / sum(count) OVER (PARTITION BY activity_type, provider, fyear, grp, tretspef), 6) AS pcnt FROM icb_counts""",
        "provider",
    ),
)
def _(v):
    return inp.repatriation_nonlocal(inp.activity_counts(v.ip, v.op, v.ae), v.trust)


# --- from raw spells to rates ---------------------------------------------------------------------
@check(
    "inp_08_end_to_end",
    f"""
WITH aged AS (SELECT *, least(CASE WHEN admiage IS NULL OR admiage = 999 THEN CASE WHEN startage > 7000 THEN 0 ELSE startage END ELSE admiage END, 90) AS years FROM v_apc),
successor AS (SELECT org_from, min(org_to) AS org_to FROM v_trust GROUP BY org_from),
spells AS (SELECT a.*, CASE WHEN a.sitetret IN ('RW602', 'RM318') THEN 'R0A' ELSE coalesce(t.org_to, a.procode3) END AS provider
  FROM aged a LEFT JOIN successor t ON t.org_from = a.procode3
  WHERE last_episode_in_spell AND well_baby_ind = 'N' AND (sushrg <> 'PB03Z' OR sushrg IS NULL) AND NOT (tretspef = '424' AND epitype = '3')
    AND NOT (speldur > 730 AND NOT (tretspef LIKE '7%') AND NOT (mainspef LIKE '7%') AND epiorder < 10)
    AND sex IN ('1', '2') AND years BETWEEN 0 AND 90 AND speldur IS NOT NULL),
elderly AS (SELECT fyear, provider, 'emergency_elderly' AS strategy, years AS age, CAST(sex AS INT) AS sex, CAST(sum(speldur) AS DOUBLE) AS n, CAST(count(*) AS DOUBLE) AS d
  FROM spells WHERE admimeth LIKE '2%' AND years >= 75 AND fyear >= 201516
    AND provider NOT IN (SELECT org_to FROM v_trust WHERE org_type IN ('MENTAL HEALTH AND LEARNING DISABILITY', 'CARE TRUST')) GROUP BY ALL),
{standard_sql('elderly', 'provider')} SELECT * FROM rates""",
)
def _(v):
    """Raw spells to labelled spells, cohort, cells and standardised mean stay."""
    ip = rip.ip_records(v.apc, v.birth, v.dx, v.px, v.trust, v.ccg_icb, v.lsoa11_lad23, ref.main_group(v.ip))
    cohort = tag(ip, v.dx, v.px, standard_rules().only("emergency_elderly"))
    cells = inp.ip_age_sex(ip, cohort, "provider").filter(F.col("strategy") == "emergency_elderly")
    return inp.mean_length_of_stay(cells, v.pop_lad, "provider")


# --- inequalities --------------------------------------------------------------------------------
INQ = """
pops AS (SELECT icb, provider, CAST((imd19 + 1) // 2 AS INT) AS imd_quintile, sum(pop) AS pop FROM v_pop_quintile GROUP BY ALL HAVING sum(pop) > 0),
pop_shares AS (SELECT *, pop / sum(pop) OVER (PARTITION BY icb, provider) AS population_share, sum(pop) OVER (PARTITION BY icb, provider) AS total_catchment_pop FROM pops),
activity AS (
  SELECT icb, provider, imd_quintile, substr(sushrg, 1, 4) AS sushrg_trimmed, fyear, count(*) AS n FROM v_ip WHERE admimeth LIKE '1%' GROUP BY ALL
  UNION ALL SELECT icb, provider, imd_quintile, substr(sushrg, 1, 4), fyear, sum(attendance) FROM v_op WHERE has_procedures GROUP BY ALL),
rate AS (SELECT a.icb, a.provider, a.imd_quintile, a.sushrg_trimmed, a.fyear, CAST(sum(n) AS BIGINT) AS count, p.pop, p.population_share, p.total_catchment_pop,
    sum(n) / p.pop AS activity_rate FROM activity a JOIN pop_shares p USING (icb, provider, imd_quintile)
  GROUP BY a.icb, a.provider, a.imd_quintile, a.sushrg_trimmed, a.fyear, p.pop, p.population_share, p.total_catchment_pop),
eligible AS (SELECT icb, provider, fyear, sushrg_trimmed, count(DISTINCT imd_quintile) AS n_quintiles, min(count) AS min_count FROM rate
  GROUP BY ALL HAVING count(DISTINCT imd_quintile) > 2 AND min(count) >= 3),
sums AS (SELECT icb, provider, fyear, sushrg_trimmed, count(*) AS k, sum(pop) AS w, sum(pop * imd_quintile) AS wx, sum(pop * activity_rate) AS wy,
    sum(pop * imd_quintile * imd_quintile) AS wxx, sum(pop * imd_quintile * activity_rate) AS wxy
  FROM rate JOIN eligible USING (icb, provider, fyear, sushrg_trimmed) GROUP BY ALL),
lines AS (SELECT *, (w * wxy - wx * wy) / (w * wxx - wx * wx) AS slope, (wy - (w * wxy - wx * wy) / (w * wxx - wx * wx) * wx) / w AS intercept FROM sums),
errors AS (SELECT l.icb, l.provider, l.fyear, l.sushrg_trimmed, l.k, l.slope, l.intercept,
    abs(l.slope) / sqrt(sum(r.pop * power(r.activity_rate - l.intercept - l.slope * r.imd_quintile, 2)) / (l.k - 2) / (l.wxx - l.wx * l.wx / l.w)) AS t
  FROM lines l JOIN rate r USING (icb, provider, fyear, sushrg_trimmed) GROUP BY l.icb, l.provider, l.fyear, l.sushrg_trimmed, l.k, l.slope, l.intercept, l.wxx, l.wx, l.w),
fits AS (SELECT icb, provider, fyear, sushrg_trimmed, slope, intercept, CASE k - 2 WHEN 1 THEN 1 - 2 / pi() * atan(t) WHEN 2 THEN 1 - t / sqrt(t * t + 2)
    ELSE 1 - 2 / pi() * (atan(t / sqrt(3)) + (t / sqrt(3)) / (1 + t * t / 3)) END AS pvalue FROM errors)"""


def inq_rates(v):
    return inq.rate_table(v.pop_quintile, v.ip, ae.op_rollup(v.op))


@check(
    "inq_01_rate_table",
    f"""WITH {INQ} SELECT * REPLACE (round(pop, 6) AS pop, round(population_share, 6) AS population_share,
        round(total_catchment_pop, 6) AS total_catchment_pop, round(activity_rate, 6) AS activity_rate) FROM rate""",
)
def _(v):
    return inq_rates(v)


@check("inq_02_eligible", f"WITH {INQ} SELECT * FROM eligible")
def _(v):
    return inq.eligible(inq_rates(v), min_count=3)


@check("inq_02_eligible_default", f"WITH {INQ.replace('>= 3),', '>= 50),')} SELECT * FROM eligible")
def _(v):
    return inq.eligible(inq_rates(v))


@check(
    "inq_03_regressions",
    f"WITH {INQ} SELECT icb, provider, fyear, sushrg_trimmed, round(pvalue, 6) AS pvalue, round(slope, 6) AS slope, round(intercept, 6) AS intercept FROM fits",
)
def _(v):
    return inq.regressions(inq_rates(v), min_count=3)


@check(
    "inq_04_adjustments",
    f"""WITH {INQ}, fitted AS (SELECT r.*, f.intercept + f.slope * r.imd_quintile AS line FROM rate r JOIN fits f USING (icb, provider, fyear, sushrg_trimmed)
          WHERE f.pvalue < 0.3 AND f.slope > 0),
        ends AS (SELECT icb, provider, fyear, sushrg_trimmed, max(line) AS hi, min(line) AS lo, avg(line) AS mid, min(imd_quintile) AS q0, max(imd_quintile) AS q1
          FROM fitted GROUP BY ALL)
        SELECT icb, provider, fyear, sushrg_trimmed, imd_quintile, round(activity_rate, 6) AS activity_rate, round(line, 6) AS fitted_line,
          round(CASE WHEN imd_quintile = q1 THEN 1 ELSE hi / activity_rate END, 6) AS level_up,
          round(CASE WHEN imd_quintile = q0 THEN 1 WHEN lo < 0 THEN 0 ELSE lo / activity_rate END, 6) AS level_down,
          round(mid / activity_rate, 6) AS zero_sum
        FROM fitted JOIN ends USING (icb, provider, fyear, sushrg_trimmed)""",
)
def _(v):
    rates = inq_rates(v)
    return inq.adjustments(rates, inq.regressions(rates, min_count=3), alpha=0.3)
