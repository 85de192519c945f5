"""Cohorts. The oracle of a rule is built here from the same rule data with semi and anti joins."""

import json

import pyarrow as pa
from pyspark.sql import functions as F

from checks import rule_tables as tables
from checks.registry import check
from cohortlake.operators import cohorts as co
from cohortlake.operators import conditions as cond
from cohortlake.operators import records_op as op
from cohortlake.operators.rules import standard_rules
from cohortlake.operators.cohort_pass import Lookups, all_cohorts

POSITION = {"any": "", "primary": " AND {} = 1", "secondary": " AND {} > 1"}


def to_sql(c) -> str:
    """A condition as a DuckDB predicate on spell `s`."""
    match c:
        case cond.Has(kind, position, pattern):
            table, code, order = {
                "dx": ("v_dx", "diagnosis", "diag_order"),
                "px": ("v_px", "procedure_code", "procedure_order"),
            }[kind]
            where = f"regexp_matches({code}, '{pattern}')" + POSITION[position].format(order)
            return f"((s.epikey, s.fyear) IN (SELECT (epikey, fyear) FROM {table} WHERE {where}))"
        case cond.NoProcedure(True):
            return "((s.epikey, s.fyear) NOT IN (SELECT (epikey, fyear) FROM v_px))"
        case cond.NoProcedure(False):
            return "(s.epikey NOT IN (SELECT epikey FROM v_px))"
        case cond.Where(sql):
            return f"({sql})"
        case cond.Not(part):
            return f"(NOT {to_sql(part)})"
        case cond.All(parts):
            return "(" + " AND ".join(map(to_sql, parts)) + ")"
        case cond.AnyOf(parts):
            return "(" + " OR ".join(map(to_sql, parts)) + ")"
    raise TypeError(c)


def rule_sql(rule) -> str:
    return (
        f"SELECT s.fyear, s.provider, s.epikey, '{rule.type}' AS type, '{rule.strategy}' AS strategy, 1.0::DOUBLE AS sample_rate "
        f"FROM v_ip s WHERE {to_sql(rule.condition)}"
    )


# survey number of each rule-based cohort
NUMBERS = {
    "alcohol_wholly_attributable": 10,
    "ambulatory_care_conditions_acute": 12,
    "ambulatory_care_conditions_chronic": 13,
    "ambulatory_care_conditions_vaccine_preventable": 14,
    "cancelled_operations": 15,
    "eol_care_2_days": 16,
    "eol_care_3_to_14_days": 16,
    "evidence_based_interventions_ent": 18,
    "evidence_based_interventions_general_surgery": 19,
    "evidence_based_interventions_gi_surgical": 20,
    "evidence_based_interventions_msk": 21,
    "evidence_based_interventions_urology": 22,
    "evidence_based_interventions_vascular_varicose_veins": 23,
    "falls_related_admissions": 29,
    "intentional_self_harm": 31,
    "medically_unexplained_related_admissions": 32,
    "raid_ae": 37,
    "emergency_elderly": 41,
    "raid_ip": 46,
    "stroke_early_supported_discharge": 48,
}
PREFIX_NUMBERS = {
    "medicines_related": 33,
    "virtual_wards_activity": 38,
    "zero_los": 39,
    "enhanced_recovery": 42,
    "virtual_wards_efficiencies": 49,
}


def _key(strategy: str) -> str:
    number = NUMBERS.get(strategy) or next(n for p, n in PREFIX_NUMBERS.items() if strategy.startswith(p))
    return f"coh_{number}_{strategy.replace('-', '_')}"


def _register(rule) -> None:
    @check(_key(rule.strategy), rule_sql(rule))
    def _(v):
        return co.tag(v.ip, v.dx, v.px, co.Rules([rule]))


RULES = standard_rules()
for _rule in RULES:
    _register(_rule)


@check(
    "coh_01_rule_registry",
    "SELECT strategy, type, count(*) AS n FROM v_cohort WHERE strategy IN ('emergency_elderly', 'falls_related_admissions') GROUP BY ALL",
)
def _(v):
    """A registry filled through the decorator, with the function name as the default strategy."""
    rules = co.Rules()

    @rules.define("efficiency")
    def _emergency_elderly():
        return cond.all_of(cond.Where("admimeth LIKE '2%'"), cond.Where("age >= 75"))

    @rules.define("activity_avoidance", "falls_related_admissions")
    def _falls():
        return cond.all_of(cond.Where("admimeth LIKE '2%'"), cond.Where("age >= 65"))

    return co.tag(v.ip, v.dx, v.px, rules).groupBy("strategy", "type").agg(F.count("*").alias("n"))


CHEST = cond.all_of(cond.primary_dx("J", "I[25]"), cond.no(cond.secondary_dx("E")))
OPERATED = cond.any_of(cond.primary_px("[A-H]"), cond.secondary_px("Y76|Z"), cond.any_px("W"))


@check("coh_02_has", f"SELECT s.epikey, s.fyear FROM v_ip s WHERE {to_sql(CHEST)} OR {to_sql(OPERATED)}")
def _(v):
    return co.has(v.ip, v.dx, v.px, cond.any_of(CHEST, OPERATED)).select("epikey", "fyear")


@check("coh_03_has_not", f"SELECT s.epikey, s.fyear FROM v_ip s WHERE NOT {to_sql(OPERATED)}")
def _(v):
    return co.has_not(v.ip, v.dx, v.px, OPERATED).select("epikey", "fyear")


@check(
    "coh_17_evidence_based_wrapper",
    "SELECT strategy, count(*) AS n, count(DISTINCT epikey) AS spells FROM ("
    + " UNION ALL ".join(rule_sql(r) for r in RULES if r.strategy.startswith("evidence_based"))
    + ") e GROUP BY strategy",
)
def _(v):
    chosen = co.Rules([r for r in RULES if r.strategy.startswith("evidence_based")])
    tagged = co.tag(v.ip, v.dx, v.px, chosen)
    return tagged.groupBy("strategy").agg(F.count("*").alias("n"), F.countDistinct("epikey").alias("spells"))


#: SQL of the cohorts that are no rules, for the assembly.
OTHERS: list[str] = []


def _cohort(name: str, oracle: str):
    OTHERS.append(oracle)
    return check(name, oracle)


def _members(select: str, kind: str, strategy: str, rate: str) -> str:
    return f"SELECT fyear, provider, epikey, '{kind}' AS type, '{strategy}' AS strategy, {rate} AS sample_rate FROM ({select}) m"


def _file(v, content):
    """A rule file as the readers give it."""
    return v.spark.createDataFrame(pa.table({"value": [json.dumps(content)]}))


def _smoking(v):
    return v.spark.createDataFrame(pa.Table.from_pylist(tables.SMOKING))


def _alcohol(group: str) -> None:
    rules = tables.alcohol_rows(group)
    rows = ", ".join(
        f"('^({r['pattern']})', '{r['sex']}', '{r['outcome']}', {r['low']}, {'NULL' if r['high'] is None else r['high']}, {r['rate']}::DOUBLE)" for r in rules
    )
    strategy = f"alcohol_partially_attributable_{group}"
    select = f"""SELECT s.fyear, s.provider, s.epikey, max(r.rate) AS rate FROM v_ip s JOIN v_dx d ON d.epikey = s.epikey AND d.fyear = s.fyear
      JOIN (VALUES {rows}) r(pattern, sex, outcome, low, high, rate) ON regexp_matches(d.diagnosis, r.pattern) AND r.sex = s.sex
        AND s.age >= r.low AND (r.high IS NULL OR s.age <= r.high) AND r.outcome = CASE WHEN s.dismeth = '4' THEN 'mortality' ELSE 'morbidity' END GROUP BY ALL"""

    @_cohort(f"coh_11_{strategy}", _members(select, "activity_avoidance", strategy, "rate"))
    def _(v):
        return co.alcohol_partly(v.ip, v.dx, co.alcohol_rules(_file(v, tables.ALCOHOL), group), strategy)


_alcohol("chronic")
_alcohol("acute")

FRAILTY_SQL = f"""
WITH scores AS (SELECT * FROM (VALUES {", ".join(f"('{c}', {round(s * 10)})" for c, s in tables.FRAILTY)}) t(icd10, points)),
coded AS (SELECT DISTINCT a.person_id_deid AS person_id, d.epikey, t.icd10, t.points, a.disdate
  FROM v_dx d JOIN scores t ON substr(d.diagnosis, 1, 3) = t.icd10 JOIN v_apc a ON a.epikey = d.epikey
  WHERE length(d.diagnosis) > 3 AND a.last_episode_in_spell),
frail AS (SELECT fyear, provider, epikey, sum(points) AS score FROM (
  SELECT DISTINCT i.fyear, i.provider, i.epikey, c.icd10, c.points FROM v_ip i JOIN coded c ON c.person_id = i.person_id
    AND ((i.admidate > c.disdate AND i.admidate <= c.disdate + 730) OR i.epikey = c.epikey)
  WHERE i.admimeth LIKE '2%' AND i.age >= 75) p GROUP BY ALL)
"""


def _scores(v):
    points = v.spark.createDataFrame(tables.FRAILTY, "icd10 string, score double")
    return co.frailty_scores(v.ip, v.apc, v.dx, points)


@check("coh_30_frailty_scores", FRAILTY_SQL + "SELECT fyear, provider, epikey, CAST(score AS BIGINT) AS score FROM frail")
def _(v):
    return _scores(v)


def _frail(level: str, where: str) -> None:
    strategy = f"frail_elderly_{level}"

    @_cohort(
        f"coh_30_{strategy}",
        FRAILTY_SQL + _members(f"SELECT * FROM frail WHERE {where}", "activity_avoidance", strategy, "1.0::DOUBLE"),
    )
    def _(v):
        return co.frail_elderly(_scores(v)).filter(F.col("strategy") == strategy)


_frail("intermediate", "score BETWEEN 50 AND 150")
_frail("high", "score > 150")


@_cohort(
    "coh_34_obesity_related_admissions",
    _members(
        "SELECT s.fyear, s.provider, s.epikey, o.fraction FROM v_ip s JOIN v_dx d ON d.epikey = s.epikey AND d.fyear = s.fyear "
        "JOIN v_obesity o ON o.diagnosis = d.diagnosis WHERE d.diag_order = 1",
        "activity_avoidance",
        "obesity_related_admissions",
        "fraction",
    ),
)
def _(v):
    return co.obesity(v.ip, v.dx, v.obesity)


@_cohort(
    "coh_35_readmission_within_28_days",
    _members(
        """SELECT r.fyear, r.provider, r.epikey FROM v_ip r WHERE r.admimeth LIKE '2%' AND EXISTS (
             SELECT 1 FROM v_apc p WHERE p.last_episode_in_spell AND p.well_baby_ind = 'N' AND (p.sushrg <> 'PB03Z' OR p.sushrg IS NULL)
               AND NOT (p.tretspef = '424' AND p.epitype = '3') AND p.person_id_deid = r.person_id AND p.epikey <> r.epikey
               AND (r.admidate > p.admidate OR r.disdate > p.disdate) AND (r.admidate - p.disdate) BETWEEN 0 AND 28)""",
        "activity_avoidance",
        "readmission_within_28_days",
        "1.0::DOUBLE",
    ),
)
def _(v):
    return co.readmissions(v.ip, v.apc)


@_cohort(
    "coh_36_smoking",
    _members(
        f"""SELECT s.fyear, s.provider, s.epikey, max(r.rate) AS rate FROM v_ip s JOIN v_dx d ON d.epikey = s.epikey AND d.fyear = s.fyear
            JOIN (VALUES {", ".join(f"('^({r['pattern']})', '{r['sex']}', {r['rate']}::DOUBLE)" for r in tables.SMOKING)}) r(pattern, sex, rate)
              ON regexp_matches(d.diagnosis, r.pattern) AND r.sex = s.sex WHERE d.diag_order = 1 GROUP BY ALL""",
        "activity_avoidance",
        "smoking",
        "rate",
    ),
)
def _(v):
    return co.smoking(v.ip, v.dx, _smoking(v))


def _day_codes(v):
    names = F.array(*[F.lit(f"day_procedures_{k}") for k in ("usually_dc", "usually_op", "occasionally_dc", "occasionally_op")])
    return v.day_code.select(
        F.get(names, F.ascii("procedure_code") % 4).alias("strategy"),
        F.substring("procedure_code", 1, 3).alias("procedure_code"),
    ).distinct()


def _day(kind: str) -> None:
    strategy = f"day_procedures_{kind}"
    classes = "('1')" if kind.endswith("dc") else "('1', '2')"
    parity = {"usually_dc": 0, "usually_op": 1, "occasionally_dc": 2, "occasionally_op": 3}[kind]

    @_cohort(
        f"coh_40_{strategy}",
        _members(
            f"""SELECT DISTINCT s.fyear, s.provider, s.epikey FROM v_ip s JOIN v_px p ON p.epikey = s.epikey AND p.fyear = s.fyear
                WHERE p.procedure_order = 1 AND s.admimeth LIKE '1%' AND s.classpat IN {classes} AND EXISTS (
                  SELECT 1 FROM v_day_code c WHERE ascii(c.procedure_code) % 4 = {parity} AND p.procedure_code LIKE substr(c.procedure_code, 1, 3) || '%')""",
            "efficiency",
            strategy,
            "1.0::DOUBLE",
        ),
    )
    def _(v):
        return co.day_procedures(v.ip, v.px, _day_codes(v)).filter(F.col("strategy") == strategy)


for _kind in ("usually_dc", "usually_op", "occasionally_dc", "occasionally_op"):
    _day(_kind)


def _excess(kind: str, digit: str) -> None:
    strategy = f"excess_beddays_{kind}"

    @_cohort(
        f"coh_44_{strategy}",
        _members(
            f"SELECT s.* FROM v_ip s JOIN v_trimpoint t USING (sushrg) WHERE s.admimeth LIKE '{digit}%' AND s.speldur > t.{kind}",
            "efficiency",
            strategy,
            "1.0::DOUBLE",
        ),
    )
    def _(v):
        return co.excess_beddays(v.ip, v.trimpoint).filter(F.col("strategy") == strategy)


_excess("elective", "1")
_excess("emergency", "2")


def _preop(days: int, name: str) -> None:
    @_cohort(
        f"coh_45_{name.replace('-', '_')}",
        _members(
            f"""SELECT DISTINCT s.fyear, s.provider, s.epikey FROM v_ip s JOIN v_px p ON p.epikey = s.epikey
                WHERE s.admimeth LIKE '1%' AND p.procedure_order = 1
                  AND NOT regexp_matches(p.procedure_code, '^(O(1[1-46]|28|3[01346]|4[2-8]|5[23])|X[6-9]|[UYZ])')
                  AND p.procedure_date BETWEEN s.admidate AND s.disdate AND p.procedure_date - s.admidate = {days}""",
            "efficiency",
            name,
            "1.0::DOUBLE",
        ),
    )
    def _(v):
        return co.preop_los(v.ip, v.px).filter(F.col("strategy") == name)


_preop(1, "pre-op_los_1-day")
_preop(2, "pre-op_los_2-day")


def _sdec(level: str) -> None:
    strategy = f"same_day_emergency_care_{level.replace(' ', '_')}"
    rules = tables.sdec_rows()
    entries = " OR ".join(
        f"(regexp_matches(s.sushrg, '{r['hrg']}') AND regexp_matches(d.diagnosis, '{r['icd10']}'))" for r in rules if r["level"] == level
    )

    @_cohort(
        f"coh_47_{strategy}",
        _members(
            f"""SELECT DISTINCT s.fyear, s.provider, s.epikey FROM v_ip s JOIN v_dx d ON d.epikey = s.epikey AND d.fyear = s.fyear
                WHERE s.age >= 18 AND substr(s.admimeth, 1, 2) IN ('21', '22', '23') AND d.diag_order = 1 AND s.speldur <= 2 AND ({entries})""",
            "efficiency",
            strategy,
            "1.0::DOUBLE",
        ),
    )
    def _(v):
        return co.same_day_emergency_care(v.ip, v.dx, co.sdec_rules(_file(v, tables.SDEC))).filter(F.col("strategy") == strategy)


for _level in ("low", "moderate", "high", "very high"):
    _sdec(_level)


@check("coh_04_assembly", " UNION ALL ".join([*map(rule_sql, RULES), *(f"SELECT * FROM ({sql}) o" for sql in OTHERS)]))
def _(v):
    """All inpatient cohorts: those of the rules and all others."""
    points = v.spark.createDataFrame(pa.table(dict(zip(("icd10", "score"), map(list, zip(*tables.FRAILTY))))))
    alcohol = {group: co.alcohol_rules(_file(v, tables.ALCOHOL), group) for group in ("chronic", "acute")}
    lookups = Lookups(points, v.obesity, _day_codes(v), v.trimpoint, alcohol, _smoking(v), co.sdec_rules(_file(v, tables.SDEC)))
    return all_cohorts(v.ip, v.apc, v.dx, v.px, lookups)


# --- outpatient cohorts --------------------------------------------------------------------------
OP_WHERE = {
    60: ("followup_reduction", "NOT has_procedures AND NOT is_first"),
    61: ("consultant_to_consultant_reduction", "is_cons_cons_ref"),
    62: ("gp_referred_first_attendance_reduction", "is_gp_ref AND is_first"),
    63: ("convert_to_tele", "NOT has_procedures AND tele_attendance = 0"),
}


def _op_cohort(number: int, name: str, where: str) -> None:
    @check(
        f"coh_{number}_{name}",
        f"SELECT fyear, provider, attendkey, '{name}_' || type AS strategy FROM v_op WHERE {where}",
    )
    def _(v):
        return op.op_cohorts(v.op, {name: op.OP_COHORTS[name]})


for _number, (_name, _where) in OP_WHERE.items():
    _op_cohort(_number, _name, _where)


# --- merge ---------------------------------------------------------------------------------------
RECOMPUTED = [("activity_avoidance", "smoking"), ("efficiency", "emergency_elderly")]


@check(
    "snk_03_merge_cohorts",
    """
WITH stored AS (SELECT * FROM v_cohort WHERE epikey % 9 <> 2),
cur AS (SELECT fyear, provider, epikey, type, strategy, CASE WHEN epikey % 10 = 3 THEN sample_rate / 2 ELSE sample_rate END AS sample_rate
        FROM v_cohort WHERE strategy IN ('smoking', 'emergency_elderly') AND epikey % 8 <> 1)
SELECT fyear, provider, epikey, type, strategy, round(sample_rate, 6) AS sample_rate,
       CASE WHEN (fyear, provider, epikey, type, strategy) NOT IN (SELECT (fyear, provider, epikey, type, strategy) FROM stored) THEN 'insert'
            WHEN old <> sample_rate THEN 'update' ELSE 'keep' END AS action
FROM (SELECT c.*, s.sample_rate AS old FROM cur c LEFT JOIN stored s USING (fyear, provider, epikey, type, strategy)) n
UNION ALL
SELECT fyear, provider, epikey, type, strategy, round(sample_rate, 6), CASE WHEN strategy IN ('smoking', 'emergency_elderly') THEN 'delete' ELSE 'keep' END
FROM stored WHERE (fyear, provider, epikey, type, strategy) NOT IN (SELECT (fyear, provider, epikey, type, strategy) FROM cur)""",
)
def _(v):
    stored = v.cohort.filter("epikey % 9 <> 2")
    rate = F.when(F.col("epikey") % 10 == 3, F.col("sample_rate") / 2).otherwise(F.col("sample_rate"))
    current = (
        v.cohort.filter(F.col("strategy").isin("smoking", "emergency_elderly"))
        .filter("epikey % 8 <> 1")
        .withColumn("sample_rate", rate)
    )
    return co.merge_cohorts(stored, current, RECOMPUTED)
