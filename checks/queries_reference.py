"""Organisations, areas, catchments and populations."""

from pyspark.sql import functions as F

from checks.registry import check
from cohortlake.operators import reference as ref

SKIP = [("P013", "P014")]
ROLES = "('RO107', 'RO197', 'RO172')"
OVERRIDES = "lsoa11cd, lad23cd"

CLOSURE = f"""
WITH RECURSIVE walk(org_from, org_to, start_date) AS (
  SELECT org_code, org_code, DATE '1900-01-01' FROM v_org
  UNION
  SELECT w.org_from, e.org_to, e.change_date FROM walk w JOIN v_org_edge e ON w.org_to = e.org_from
  WHERE NOT (e.org_from = 'P013' AND e.org_to = 'P014')
),
closure AS (
  SELECT DISTINCT w.org_from, w.org_to, w.start_date FROM walk w
  WHERE NOT EXISTS (SELECT 1 FROM v_org_edge e WHERE e.org_from = w.org_to)
    AND w.org_from IN (SELECT org_code FROM v_org WHERE primary_role IN {ROLES})
    AND w.org_to IN (SELECT org_code FROM v_org WHERE primary_role IN {ROLES})
)
"""
TRUSTS = (
    CLOSURE
    + f""", latest AS (
  SELECT org_code, org_type FROM (
    SELECT *, row_number() OVER (PARTITION BY org_code ORDER BY fyear DESC) AS rn FROM v_org_type) t WHERE rn = 1
),
trusts AS (
  SELECT o.org_code, c.org_from, c.org_to, o.org_name, o.primary_role, strftime(o.end_date, '%Y-%m-%d') AS end_date,
         o.status, t.org_type
  FROM v_org o JOIN closure c ON o.org_code = c.org_from LEFT JOIN latest t ON t.org_code = c.org_to
  WHERE (o.end_date IS NULL OR o.end_date >= DATE '2008-04-01') AND o.primary_role IN {ROLES}
)"""
)


def trusts(v):
    closure = ref.successor_closure(v.org, v.org_edge, skip=SKIP, refuse_loops=False)
    return ref.trust_list(v.org, closure, ref.latest_per_key(v.org_type, "org_code", "fyear"))


@check(
    "ref_01_successor_closure",
    CLOSURE + "SELECT org_from, org_to, strftime(start_date, '%Y-%m-%d') AS start_date FROM closure",
)
def _(v):
    return ref.successor_closure(v.org, v.org_edge, skip=SKIP, refuse_loops=False).drop("end_date")


@check("ref_02_trust_list", TRUSTS + "SELECT * FROM trusts")
def _(v):
    return trusts(v)


@check(
    "ref_02_duplicate_successors",
    """SELECT org_code, count(*) AS n FROM (
         SELECT org_code FROM v_trust UNION ALL
         SELECT 'P' || lpad(CAST(s_suppkey AS VARCHAR), 3, '0') FROM supplier WHERE s_suppkey % 5 = 2) t
       GROUP BY org_code HAVING count(*) > 1""",
)
def _(v):
    twice = v.trust.filter(F.substring("org_code", -1, 1).isin("2", "7"))
    return ref.duplicate_successors(v.trust.unionByName(twice))


@check(
    "ref_03_latest_type",
    """SELECT org_code, max(fyear) AS fyear, arg_max(org_type, fyear) AS org_type FROM v_org_type GROUP BY org_code""",
)
def _(v):
    return ref.latest_per_key(v.org_type, "org_code", "fyear")


@check(
    "ref_04_keep_acute",
    """SELECT provider, fyear, count(*) AS n FROM v_ip
       WHERE provider IN (SELECT org_to FROM v_trust WHERE org_type LIKE 'ACUTE%') GROUP BY provider, fyear""",
)
def _(v):
    return ref.keep_acute(v.ip, v.trust).groupBy("provider", "fyear").agg(F.count("*").alias("n"))


@check(
    "ref_04_acute_view",
    """SELECT provider, count(*) AS n, sum(arrival) AS arrivals FROM v_ae a
       WHERE EXISTS (SELECT 1 FROM v_trust t WHERE t.org_to = a.provider AND t.org_type LIKE 'ACUTE%')
       GROUP BY provider""",
)
def _(v):
    ref.acute_view(v.ae, v.trust, "default_ae")
    return v.spark.sql("SELECT provider, count(*) AS n, sum(arrival) AS arrivals FROM default_ae GROUP BY provider")


CHAIN = """SELECT DISTINCT a.lsoa11cd, b.lad23cd FROM v_lsoa11_lsoa21 a JOIN v_lsoa21_lad23 b USING (lsoa21cd)
           WHERE a.lsoa11cd LIKE 'E%'"""


@check("ref_05_chain_lookup", CHAIN)
def _(v):
    return ref.chain_lookup(v.lsoa11_lsoa21, v.lsoa21_lad23)


RESOLVED = f"""SELECT c.* FROM ({CHAIN}) c WHERE NOT EXISTS (
                 SELECT 1 FROM v_area_override o WHERE o.lsoa11cd = c.lsoa11cd AND o.lad23cd <> c.lad23cd)"""


@check("ref_06_resolve_exceptions", RESOLVED)
def _(v):
    return ref.resolve_exceptions(ref.chain_lookup(v.lsoa11_lsoa21, v.lsoa21_lad23), v.area_override)


@check(
    "ref_07_mapping_report",
    f"""SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, count(*) FILTER (n > 1) AS repeated_keys,
               (SELECT count(DISTINCT lad23cd) FROM ({CHAIN}) d) AS values
        FROM (SELECT lsoa11cd, count(*) AS n FROM ({CHAIN}) c GROUP BY lsoa11cd) k""",
)
def _(v):
    return ref.mapping_report(ref.chain_lookup(v.lsoa11_lsoa21, v.lsoa21_lad23), "lsoa11cd", "lad23cd")


@check(
    "ref_08_relabel",
    """SELECT p.fyear, p.age, p.sex, p.population, l.lad23cd AS lad23cd
       FROM v_pop_lad p JOIN v_lad22_lad23 l ON p.lad23cd = l.lad22cd""",
)
def _(v):
    return ref.relabel(v.pop_lad, v.lad22_lad23, "lad23cd", "lad22cd", "lad23cd")


LONG_POP = """
WITH pop AS (
  SELECT lsoa21cd, CAST(year * 100 + (year + 1) % 100 AS INT) AS fyear,
         CASE WHEN cell LIKE 'M%' THEN 1 ELSE 2 END AS sex, CAST(substr(cell, 2) AS INT) AS age, population
  FROM (UNPIVOT v_pop_wide ON COLUMNS(* EXCLUDE (lsoa21cd, year)) INTO NAME cell VALUE population)
)"""


@check("ref_09_unpivot_population", LONG_POP + "SELECT * FROM pop")
def _(v):
    return ref.unpivot_population(v.pop_wide, "year")


@check(
    "ref_10_population_by_district",
    LONG_POP
    + """SELECT fyear, lad23cd, age, sex, CAST(sum(population) AS BIGINT) AS population
         FROM pop JOIN v_lsoa21_lad23 USING (lsoa21cd) WHERE lsoa21cd LIKE 'E%' GROUP BY fyear, lad23cd, age, sex""",
)
def _(v):
    return ref.population_by_district(ref.unpivot_population(v.pop_wide, "year"), v.lsoa21_lad23)


SPLIT = """
WITH used AS (
  SELECT fyear, provider, lad23cd, age, sex, count(person_id) AS n
  FROM (SELECT DISTINCT fyear, provider, lad23cd, age, sex, person_id FROM v_ip
        WHERE lsoa11 LIKE 'E%' AND lsoa11 <> 'E99999999'
          AND provider IN (SELECT org_code FROM v_trust WHERE org_type LIKE 'ACUTE%')) d
  GROUP BY ALL
),
default_provider AS (
  SELECT fyear, lad23cd, provider FROM (
    SELECT fyear, lad23cd, provider, row_number() OVER (PARTITION BY fyear, lad23cd ORDER BY sum(n) DESC, provider) AS rn
    FROM used GROUP BY fyear, lad23cd, provider) r WHERE rn = 1
),
filled AS (
  SELECT fyear, lad23cd, age, sex, provider, n, 0 AS added FROM used
  UNION ALL
  SELECT a.fyear, l.lad23cd, a.age, a.sex, d.provider, 1, 1
  FROM (SELECT DISTINCT fyear, age, sex FROM used) a JOIN (SELECT DISTINCT fyear, lad23cd FROM used) l USING (fyear)
  JOIN default_provider d USING (fyear, lad23cd)
  WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.fyear = a.fyear AND u.age = a.age AND u.sex = a.sex AND u.lad23cd = l.lad23cd)
),
split AS (
  SELECT fyear, lad23cd, age, sex, provider, n / nullif(sum(n) OVER (PARTITION BY fyear, lad23cd, age, sex), 0) AS lad23_pcnt, added
  FROM filled
)"""


def people(v):
    """Spells with the columns the catchment operators read."""
    return v.ip.select("fyear", "provider", "lad23cd", "lsoa11", "age", "sex", "person_id")


@check(
    "ref_11_catchment_split",
    SPLIT + "SELECT fyear, lad23cd, age, sex, provider, round(lad23_pcnt, 6) AS lad23_pcnt FROM split",
)
def _(v):
    return ref.catchment_split(people(v), v.trust)


@check(
    "ref_11b_gap_fill",
    SPLIT
    + """SELECT fyear, provider, count(*) AS cells, round(sum(lad23_pcnt), 6) AS share FROM split
         GROUP BY fyear, provider""",
)
def _(v):
    split = ref.catchment_split(people(v), v.trust)
    return split.groupBy("fyear", "provider").agg(F.count("*").alias("cells"), F.sum("lad23_pcnt").alias("share"))


@check(
    "ref_12_main_group",
    """SELECT provider, icb AS main_icb FROM (
         SELECT provider, icb, row_number() OVER (PARTITION BY provider ORDER BY count(*) DESC, icb) AS rn
         FROM v_ip WHERE icb IS NOT NULL GROUP BY provider, icb) r WHERE rn = 1""",
)
def _(v):
    return ref.main_group(v.ip)


@check(
    "ref_13_area_share",
    """SELECT icb, lad23cd AS area_code, round(count(*) / sum(count(*)) OVER (PARTITION BY lad23cd), 6) AS pcnt
       FROM v_lad_icb_lsoa GROUP BY icb, lad23cd""",
)
def _(v):
    return ref.area_share(v.lad_icb_lsoa)


@check(
    "ref_14_catchment_population",
    SPLIT
    + """SELECT s.fyear, s.provider, s.age, CAST(s.sex AS INT) AS sex, round(sum(p.population * s.lad23_pcnt), 6) AS population
         FROM split s JOIN v_pop_lad p ON s.fyear = p.fyear AND s.lad23cd = p.lad23cd AND s.age = p.age AND CAST(s.sex AS INT) = p.sex
         GROUP BY s.fyear, s.provider, s.age, s.sex""",
)
def _(v):
    split = ref.catchment_split(people(v).withColumn("sex", F.col("sex").cast("int")), v.trust)
    return ref.catchment_population(split, v.pop_lad)


@check(
    "ref_15_population_by_deprivation",
    """
WITH bands AS (SELECT i AS age, CASE WHEN i <= 16 THEN '0-16' WHEN i <= 40 THEN '17-40' WHEN i <= 65 THEN '41-65'
                                    WHEN i <= 75 THEN '66-75' ELSE '76+' END AS band FROM range(91) r(i)),
middle AS (SELECT DISTINCT lsoa11, msoa11 FROM v_apc WHERE lsoa11 LIKE 'E%' AND lsoa11 <> 'E99999999'),
pop AS (SELECT m.msoa11, CAST(p.imd19 AS INT) AS imd19, p.sex, b.band, sum(CAST(p.pop AS INT)) AS pop
        FROM v_pop_imd p JOIN bands b ON b.age = CAST(p.age AS INT) JOIN middle m ON m.lsoa11 = p.lsoa11cd
        WHERE p.pop <> 'NA' GROUP BY ALL),
users AS (SELECT s.lsoa11, s.icb, s.provider, b.band, s.sex, count(DISTINCT s.person_id) AS n
          FROM v_ip s JOIN bands b USING (age) WHERE s.fyear = 201920 AND s.admimeth LIKE '1%' AND s.lsoa11 IS NOT NULL
          GROUP BY ALL),
share AS (SELECT icb, provider, msoa11, band, sex, sum(n) / nullif(sum(sum(n)) OVER (PARTITION BY msoa11, band, sex), 0) AS p
          FROM users JOIN middle USING (lsoa11) GROUP BY icb, provider, msoa11, band, sex)
SELECT icb, provider, imd19, round(sum(pop * p), 6) AS pop FROM share JOIN pop USING (msoa11, band, sex) GROUP BY ALL""",
)
def _(v):
    return ref.population_by_deprivation(v.apc, v.ip, v.pop_imd)


SETTING = """
WITH acute AS (SELECT DISTINCT org_to FROM v_trust WHERE org_type LIKE 'ACUTE%'),
ok_px AS (SELECT * FROM v_px WHERE procedure_order = 1
          AND NOT regexp_matches(procedure_code, '^(O(1[1-46]|28|3[01346]|4[2-8]|5[23])|X[6-9]|[UYZ])')),
ok_opa_px AS (SELECT * FROM v_opa_px WHERE procedure_order = 1
          AND NOT regexp_matches(procedure_code, '^(O(1[1-46]|28|3[01346]|4[2-8]|5[23])|X[6-9]|[UYZ])')),
ip AS (SELECT p.procedure_code, count(*) FILTER (s.classpat = '1') AS ip, count(*) FILTER (s.classpat = '2') AS dc
       FROM ok_px p JOIN v_ip s ON p.fyear = s.fyear AND p.procode3 = s.procode3 AND p.epikey = s.epikey
       WHERE s.fyear = 201920 AND s.classpat IN ('1', '2') AND s.admimeth LIKE '1%' AND s.provider IN (SELECT org_to FROM acute)
       GROUP BY p.procedure_code),
op AS (SELECT p.procedure_code, count(*) AS op FROM ok_opa_px p
       WHERE p.fyear = 201920 AND EXISTS (
         SELECT 1 FROM v_opa o WHERE o.fyear = p.fyear AND o.procode3 = p.procode3 AND o.attendkey = p.attendkey
           AND o.sex IN ('1', '2') AND o.apptage IS NOT NULL AND o.atentype IN ('1', '2')
           AND NOT regexp_matches(o.sushrg, '^(WF|U)') AND o.procode3 IN (SELECT org_to FROM acute))
       GROUP BY p.procedure_code),
counts AS (SELECT procedure_code, coalesce(ip, 0) AS ip, coalesce(dc, 0) AS dc, coalesce(op, 0) AS op,
                  coalesce(ip, 0) + coalesce(dc, 0) + coalesce(op, 0) AS total
           FROM ip FULL JOIN op USING (procedure_code))
"""


def settings(v):
    return ref.setting_counts(v.ip, v.px, v.opa.withColumn("provider", F.col("procode3")), v.opa_px, v.trust, 201920)


@check("ref_16_setting_counts", SETTING + "SELECT * FROM counts")
def _(v):
    return settings(v)


def _tail(k: str, p: float) -> str:
    term = f"exp(lgamma(total + 1) - lgamma(i + 1) - lgamma(total - i + 1) + i * ln({p}) + (total - i) * ln(1 - {p}))"
    return f"(list_sum(list_transform(range(CAST({k} AS BIGINT), CAST(total + 1 AS BIGINT)), lambda i: {term})) < 0.001)"


@check(
    "ref_16_classify_setting",
    SETTING
    + f""", tested AS (
  SELECT procedure_code, {_tail("dc", 0.5)} AS udc, {_tail("op", 0.5)} AS uop, {_tail("dc", 0.05)} AS odc, {_tail("op", 0.05)} AS oop
  FROM counts WHERE total >= 20)
SELECT 'day_procedures_usually_dc' AS strategy, procedure_code FROM tested WHERE udc
UNION ALL SELECT 'day_procedures_usually_op', procedure_code FROM tested WHERE uop
UNION ALL SELECT 'day_procedures_occasionally_dc', procedure_code FROM tested WHERE odc AND NOT udc AND NOT uop
UNION ALL SELECT 'day_procedures_occasionally_op', procedure_code FROM tested WHERE oop AND NOT udc AND NOT uop""",
)
def _(v):
    return ref.classify_setting(settings(v), min_total=20)
