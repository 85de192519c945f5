"""Record-level operators: inpatient, outpatient and emergency, and their rollups."""

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import check
from cohortlake.functions.expressions import age_band, specialty_group
from cohortlake.functions.materialise import materialise
from cohortlake.operators import attribution as attr
from cohortlake.operators import records_ae as ae
from cohortlake.operators import records_ip as ip
from cohortlake.operators import records_op as op
from cohortlake.operators import reference as ref

PROVIDER = """CASE WHEN {site} IN ('RW602', 'RM318') THEN 'R0A'
              ELSE coalesce((SELECT min(t.org_to) FROM v_trust t WHERE t.org_from = {code}), {code}) END"""
BAND = """CASE WHEN age IS NULL THEN 'Unknown' WHEN age = 0 THEN '0' WHEN age <= 4 THEN '1-4' WHEN age <= 9 THEN '5-9'
  WHEN age <= 15 THEN '10-15' WHEN age <= 17 THEN '16-17' WHEN age <= 34 THEN '18-34' WHEN age <= 49 THEN '35-49'
  WHEN age <= 64 THEN '50-64' WHEN age <= 74 THEN '65-74' WHEN age <= 84 THEN '75-84' ELSE '85+' END"""
GROUPED = """CASE WHEN tretspef IN ('100', '101', '110', '120', '130', '140', '150', '160', '170', '300', '301', '320',
  '330', '340', '400', '410', '430', '502') THEN tretspef
  WHEN tretspef LIKE '1%' AND tretspef NOT LIKE '180%' AND tretspef NOT LIKE '190%' AND tretspef NOT LIKE '192%' THEN 'Other (Surgical)'
  WHEN regexp_matches(tretspef, '^(180|19[02]|[2346]|83[134])') OR (tretspef LIKE '5%' AND tretspef NOT LIKE '560%')
  THEN 'Other (Medical)' ELSE 'Other' END"""
SKIPPED_PX = "^(O(1[1-46]|28|3[01346]|4[2-8]|5[23])|X[6-9]|[UYZ])"
MAIN = """main_icb AS (SELECT provider, icb AS main_icb FROM (
  SELECT provider, icb, row_number() OVER (PARTITION BY provider ORDER BY count(*) DESC, icb) AS rn
  FROM v_ip GROUP BY provider, icb) m WHERE rn = 1)"""
GONE = "SELECT org_to FROM v_trust WHERE org_type IN ('MENTAL HEALTH AND LEARNING DISABILITY', 'CARE TRUST')"

BASE = """
aged AS (SELECT *, least(CASE WHEN admiage IS NULL OR admiage = 999 THEN CASE WHEN startage > 7000 THEN 0 ELSE startage END
                              ELSE admiage END, 90) AS age FROM v_apc),
base AS (SELECT * FROM aged WHERE last_episode_in_spell AND well_baby_ind = 'N' AND (sushrg <> 'PB03Z' OR sushrg IS NULL)
  AND NOT (tretspef = '424' AND epitype = '3')
  AND NOT (speldur > 730 AND NOT (tretspef LIKE '7%') AND NOT (mainspef LIKE '7%') AND epiorder < 10)
  AND sex IN ('1', '2') AND age BETWEEN 0 AND 90 AND speldur IS NOT NULL)"""


@check(
    "raw_01_provider",
    f"""SELECT epikey, procode3, sitetret, {PROVIDER.format(site='sitetret', code='procode3')} AS provider FROM v_apc""",
)
def _(v):
    return attr.add_provider(v.apc, v.trust).select("epikey", "procode3", "sitetret", "provider")


@check(
    "raw_02_main_icb",
    f"""WITH {MAIN} SELECT i.epikey, coalesce(i.icb = m.main_icb, false)::INT AS is_main_icb
        FROM v_ip i LEFT JOIN main_icb m USING (provider)""",
)
def _(v):
    return attr.add_main_group(v.ip.drop("is_main_icb"), ref.main_group(v.ip)).select("epikey", "is_main_icb")


@check(
    "raw_03_icb_area",
    """SELECT a.epikey, coalesce(r.icb22cdh, s.icb22cdh) AS icb, g.lad23cd FROM v_apc a
       LEFT JOIN v_ccg_icb r ON a.ccg_residence = r.ccg LEFT JOIN v_ccg_icb s ON a.ccg_responsibility = s.ccg
       LEFT JOIN v_lsoa11_lad23 g ON g.lsoa11cd = a.lsoa11""",
)
def _(v):
    return attr.add_area(attr.add_icb(v.apc, v.ccg_icb), v.lsoa11_lad23).select("epikey", "icb", "lad23cd")


@check("raw_04_spell_base", f"WITH {BASE} SELECT epikey, fyear, age, sex, speldur, tretspef FROM base")
def _(v):
    return ip.spell_base(v.apc).select("epikey", "fyear", "age", "sex", "speldur", "tretspef")


@check("raw_05_specialty_group", f"SELECT epikey, {GROUPED} AS tretspef_grouped FROM v_apc")
def _(v):
    return v.apc.select("epikey", specialty_group(F.col("tretspef")).alias("tretspef_grouped"))


@check("raw_06_age_band", f"SELECT epikey, {BAND} AS age_group FROM (SELECT epikey, admiage AS age FROM v_apc) a")
def _(v):
    return v.apc.select("epikey", age_band(F.col("admiage")).alias("age_group"))


@check("raw_07_drop_org_types", f"SELECT epikey, provider FROM v_ip WHERE provider NOT IN ({GONE})")
def _(v):
    return ref.drop_org_types(v.ip, v.trust).select("epikey", "provider")


MATERNITY = """
births AS (SELECT epikey, fyear, procode3, min(delmeth) AS delmeth, min(delplac) AS delplac FROM v_birth GROUP BY ALL),
typed AS (SELECT a.*, CASE
    WHEN epistat = '3' AND classpat NOT IN ('3', '4') AND epitype IN ('2', '5') AND delplac NOT IN ('1', '5', '6') THEN 1
    WHEN epistat = '3' AND classpat NOT IN ('3', '4') AND epitype IN ('3', '6') AND delplac NOT IN ('1', '5', '6') THEN 2
    WHEN epistat = '3' AND classpat NOT IN ('3', '4') AND epitype IN ('2', '5') AND delplac IN ('1', '5', '6') THEN 3
    WHEN epistat = '3' AND classpat NOT IN ('3', '4') AND epitype IN ('3', '6') AND delplac IN ('1', '5', '6') THEN 4
    WHEN delmeth IS NOT NULL THEN 9 ELSE 99 END AS maternity_episode_type
  FROM v_apc a LEFT JOIN births b ON a.epikey = b.epikey AND a.fyear = b.fyear AND a.procode3 = b.procode3)"""


@check("raw_08_maternity_type", f"WITH {MATERNITY} SELECT epikey, maternity_episode_type FROM typed")
def _(v):
    return ip.maternity_type(v.apc, v.birth).select("epikey", "maternity_episode_type")


@check(
    "raw_09_delivery_in_spell",
    f"""WITH {MATERNITY} SELECT i.epikey, (i.susspellid IN (SELECT susspellid FROM typed WHERE fce = 1
          AND maternity_episode_type = 1))::INT AS maternity_delivery_in_spell FROM v_ip i""",
)
def _(v):
    done = ip.add_delivery(v.ip, ip.delivery_spells(v.apc, v.birth))
    return done.select("epikey", "maternity_delivery_in_spell")


HSAGRP = """CASE WHEN classpat IN ('3', '4') THEN 'reg' WHEN admimeth IN ('82', '83') THEN 'birth' WHEN mainspef = '420' THEN 'paeds'
  WHEN (admimeth LIKE '3%' OR mainspef IN ('501', '560')) AND age BETWEEN 13 AND 55 AND sex = '2' THEN 'maternity'
  WHEN admimeth LIKE '2%' THEN 'emerg' WHEN admimeth = '81' THEN 'transfer'
  WHEN admimeth IN ('11', '12', '13') AND classpat = '1' THEN 'ordelec'
  WHEN admimeth IN ('11', '12', '13') AND classpat = '2' THEN 'daycase' ELSE 'unknown' END"""


@check("raw_10_ip_hsagrp", f"SELECT epikey, {HSAGRP} AS hsagrp FROM v_ip")
def _(v):
    return v.ip.select("epikey", ip.ip_hsagrp().alias("hsagrp"))


LABELS = """
grouped AS (SELECT *, CASE WHEN (tretspef IN ('501', '560') OR admimeth LIKE '3%') AND sex = '2' AND age BETWEEN 13 AND 55 THEN 'maternity'
              WHEN admimeth LIKE '1%' THEN 'elective' ELSE 'non-elective' END AS grp FROM {source}),
labelled AS (SELECT *, CASE classpat WHEN '2' THEN 'ip_elective_daycase' WHEN '3' THEN 'ip_regular_day_attender'
              WHEN '4' THEN 'ip_regular_night_attender' ELSE 'ip_' || grp || '_admission' END AS pod_label,
              CASE WHEN grp = 'maternity' OR (admimeth IN ('82', '83') AND age = 0) THEN 'births' ELSE 'demographics' END AS demog,
              CASE WHEN admimeth IN ('82', '83') AND age = 0 THEN 'maternity' ELSE grp END AS ndg FROM grouped)"""


@check(
    "raw_11_ip_labels",
    f"""WITH {LABELS.format(source='v_ip')} SELECT epikey, grp AS "group", (admimeth = '11')::INT AS is_wla, pod_label AS pod,
        demog AS demog_type, ndg AS ndggrp FROM labelled""",
)
def _(v):
    return ip.ip_labels(v.ip.drop("group", "pod")).select("epikey", "group", "is_wla", "pod", "demog_type", "ndggrp")


FIRST = """
first_dx AS (SELECT epikey, fyear, procode3, min(diagnosis) AS primary_diagnosis FROM v_dx WHERE diag_order = 1 GROUP BY ALL),
first_px AS (SELECT epikey, fyear, procode3, min(procedure_code) AS primary_procedure FROM v_px WHERE procedure_order = 1 GROUP BY ALL)"""


@check(
    "raw_12_primary_codes",
    f"""WITH {FIRST} SELECT i.epikey, d.primary_diagnosis, p.primary_procedure,
          (i.epikey IN (SELECT epikey FROM v_px WHERE procedure_order = 1 AND NOT regexp_matches(procedure_code, '{SKIPPED_PX}')))::INT AS has_procedure
        FROM v_ip i LEFT JOIN first_dx d USING (epikey, fyear, procode3) LEFT JOIN first_px p USING (epikey, fyear, procode3)""",
)
def _(v):
    coded = attr.add_primary_codes(v.ip.drop("has_procedure"), v.dx, v.px, ["epikey", "fyear", "procode3"])
    return ip.add_has_procedure(coded, v.px).select("epikey", "primary_diagnosis", "primary_procedure", "has_procedure")


@check(
    "raw_12_ip_records",
    f"""WITH {BASE}, {MATERNITY}, {FIRST}, {MAIN},
attributed AS (SELECT b.*, {PROVIDER.format(site='b.sitetret', code='b.procode3')} AS provider, coalesce(r.icb22cdh, s.icb22cdh) AS icb, g.lad23cd
  FROM base b LEFT JOIN v_ccg_icb r ON b.ccg_residence = r.ccg LEFT JOIN v_ccg_icb s ON b.ccg_responsibility = s.ccg
  LEFT JOIN v_lsoa11_lad23 g ON g.lsoa11cd = b.lsoa11),
kept AS (SELECT * FROM attributed WHERE provider NOT IN ({GONE})),
{LABELS.format(source='kept')}
SELECT l.epikey, l.susspellid, l.fyear, l.procode3, l.person_id_deid AS person_id, l.admiage, l.age, {BAND} AS age_group, l.sex,
  l.imd_decile, l.imd_quintile, l.ethnos, l.classpat, l.mainspef, l.tretspef, {GROUPED} AS tretspef_grouped, {HSAGRP} AS hsagrp,
  grp AS "group", strftime(l.admidate, '%Y-%m-%d') AS admidate, strftime(l.disdate, '%Y-%m-%d') AS disdate, l.speldur, l.epitype,
  l.admimeth, l.dismeth, l.provider, l.sitetret, l.resgor_ons, l.lsoa11, l.lad23cd, l.sushrg, l.operstat, l.icb,
  (l.admimeth = '11')::INT AS is_wla, coalesce(l.icb = m.main_icb, false)::INT AS is_main_icb,
  (l.epikey IN (SELECT epikey FROM v_px WHERE procedure_order = 1 AND NOT regexp_matches(procedure_code, '{SKIPPED_PX}')))::INT AS has_procedure,
  (l.susspellid IN (SELECT susspellid FROM typed WHERE fce = 1 AND maternity_episode_type = 1))::INT AS maternity_delivery_in_spell,
  d.primary_diagnosis, p.primary_procedure, pod_label AS pod, demog AS demog_type, ndg AS ndggrp
FROM labelled l LEFT JOIN main_icb m USING (provider)
LEFT JOIN first_dx d ON d.epikey = l.epikey AND d.fyear = l.fyear AND d.procode3 = l.procode3
LEFT JOIN first_px p ON p.epikey = l.epikey AND p.fyear = l.fyear AND p.procode3 = l.procode3""",
)
def _(v):
    return ip.ip_records(v.apc, v.birth, v.dx, v.px, v.trust, v.ccg_icb, v.lsoa11_lad23, ref.main_group(v.ip))


# --- outpatients ---------------------------------------------------------------------------------
OP_BASE = """
aged AS (SELECT *, CASE WHEN apptage >= 7000 THEN 0 WHEN apptage > 90 THEN 90 ELSE apptage END AS age,
                (atentype IN ('21', '22'))::INT AS tele FROM v_opa),
flagged AS (SELECT *, (tretspef LIKE '1%' AND substr(tretspef, 1, 3) NOT IN ('180', '190', '192')) AS surgical,
  (apptage >= 18 AND apptage <= 7000) AS adult, (refsourc = '03' AND firstatt IN ('1', '3')) AS gp_ref,
  (refsourc = '05' AND firstatt IN ('1', '3') AND regexp_matches(sushrg, '^WF0[12]B$')) AS cons_ref,
  atentype IN ('1', '21') AS is_first_visit, (NOT regexp_matches(sushrg, '^(WF|U)') AND tele <> 1) AS procs
  FROM aged WHERE atentype IN ('1', '2', '21', '22') AND sex IN ('1', '2') AND age BETWEEN 0 AND 90)"""
OP_LABELLED = (
    OP_BASE
    + """,
labelled AS (SELECT *, CASE WHEN tretspef IN ('424', '501', '505', '560') THEN 'maternity'
    ELSE CASE WHEN adult THEN 'adult' ELSE 'child' END || '_' || CASE WHEN surgical THEN 'surgical' ELSE 'non-surgical' END END AS kind,
  CASE WHEN procs THEN 'procedure' WHEN is_first_visit THEN 'first' ELSE 'followup' END AS grp,
  CASE WHEN procs THEN 'op_procedure' WHEN is_first_visit THEN 'op_first' ELSE 'op_follow-up' END AS pod_label,
  CASE WHEN tretspef IN ('501', '560') AND sex = '2' AND age BETWEEN 13 AND 55 THEN 'births' ELSE 'demographics' END AS demog
  FROM flagged)"""
)


@check(
    "raw_13_op_flags",
    f"""WITH {OP_BASE} SELECT attendkey, age, surgical::INT AS is_surgical_specialty, adult::INT AS is_adult, gp_ref::INT AS is_gp_ref,
        cons_ref::INT AS is_cons_cons_ref, is_first_visit::INT AS is_first, procs::INT AS has_procedures, 1 - tele AS attendance,
        tele AS tele_attendance FROM flagged""",
)
def _(v):
    return op.op_flags(v.opa).select(
        "attendkey", "age", "is_surgical_specialty", "is_adult", "is_gp_ref", "is_cons_cons_ref", "is_first",
        "has_procedures", "attendance", "tele_attendance",
    )


@check(
    "raw_14_op_labels",
    f"""WITH {OP_LABELLED} SELECT attendkey, kind AS type, grp AS "group", 'op_' || kind || '_' || grp AS hsagrp, pod_label AS pod,
        demog AS demog_type, grp AS ndggrp FROM labelled""",
)
def _(v):
    return op.op_labels(op.op_flags(v.opa)).select("attendkey", "type", "group", "hsagrp", "pod", "demog_type", "ndggrp")


@check(
    "raw_15_op_records",
    f"""WITH {OP_LABELLED}, {MAIN},
first_dx AS (SELECT attendkey, fyear, procode3, min(diagnosis) AS primary_diagnosis FROM v_opa_dx WHERE diag_order = 1 GROUP BY ALL),
first_px AS (SELECT attendkey, fyear, procode3, min(procedure_code) AS primary_procedure FROM v_opa_px WHERE procedure_order = 1 GROUP BY ALL),
successor AS (SELECT org_from, min(org_to) AS org_to FROM v_trust GROUP BY org_from),
attributed AS (SELECT b.*, CASE WHEN b.sitetret IN ('RW602', 'RM318') THEN 'R0A' ELSE coalesce(t.org_to, b.procode3) END AS provider,
  coalesce(r.icb22cdh, s.icb22cdh) AS icb, g.lad23cd
  FROM labelled b LEFT JOIN successor t ON t.org_from = b.procode3 LEFT JOIN v_ccg_icb r ON b.ccg_residence = r.ccg
  LEFT JOIN v_ccg_icb s ON b.ccg_responsibility = s.ccg LEFT JOIN v_lsoa11_lad23 g ON g.lsoa11cd = b.lsoa11)
SELECT l.attendkey, l.fyear, l.procode3, l.provider, l.age, {BAND} AS age_group, CAST(l.sex AS INT) AS sex, l.imd_decile, l.imd_quintile,
  l.ethnos, l.tretspef, {GROUPED} AS tretspef_grouped, l.sitetret, procs::INT AS has_procedures, l.sushrg, l.resgor_ons, l.lsoa11,
  l.lad23cd, l.icb, d.primary_diagnosis, p.primary_procedure, coalesce(l.icb = m.main_icb, false)::INT AS is_main_icb,
  surgical::INT AS is_surgical_specialty, adult::INT AS is_adult, gp_ref::INT AS is_gp_ref, cons_ref::INT AS is_cons_cons_ref,
  is_first_visit::INT AS is_first, 1 - tele AS attendance, tele AS tele_attendance, kind AS type, grp AS "group",
  'op_' || kind || '_' || grp AS hsagrp, pod_label AS pod, demog AS demog_type, grp AS ndggrp
FROM attributed l LEFT JOIN main_icb m USING (provider)
LEFT JOIN first_dx d ON d.attendkey = l.attendkey AND d.fyear = l.fyear AND d.procode3 = l.procode3
LEFT JOIN first_px p ON p.attendkey = l.attendkey AND p.fyear = l.fyear AND p.procode3 = l.procode3
WHERE l.provider NOT IN ({GONE})""",
)
def _(v):
    return op.op_records(v.opa, v.opa_dx, v.opa_px, v.trust, v.ccg_icb, v.lsoa11_lad23, ref.main_group(v.ip))


# --- emergency -----------------------------------------------------------------------------------
AAE_FREQUENT = """
older_counted AS (SELECT person_id_deid AS person, arrivaldate AS day, aekey FROM v_aae
  WHERE aeattendcat = '1' AND person_id_deid IS NOT NULL AND fyear < 201920),
older_frequent AS (SELECT a.aekey FROM older_counted a JOIN older_counted b ON a.person = b.person AND a.day > b.day AND a.day <= b.day + 365
  GROUP BY a.aekey HAVING count(*) >= 3)"""
ECDS_FREQUENT = """
newer AS (SELECT * FROM v_ecds WHERE Der_Financial_Year >= '2019/20'),
newer_counted AS (SELECT CAST(Pseudo_NHS_Number_PET AS VARCHAR) AS person, Arrival_Date AS day, EC_Ident FROM newer
  WHERE EC_AttendanceCategory = '1' AND Pseudo_NHS_Number_PET IS NOT NULL),
earlier AS (SELECT person, day FROM newer_counted UNION ALL
  SELECT person_id_deid, arrivaldate FROM v_aae WHERE fyear = 201819 AND aeattendcat = '1' AND person_id_deid IS NOT NULL),
newer_frequent AS (SELECT a.EC_Ident FROM newer_counted a JOIN earlier b ON a.person = b.person AND a.day > b.day AND a.day <= b.day + 365
  GROUP BY a.EC_Ident HAVING count(*) >= 3)"""


@check(
    "raw_16_frequent_attender",
    f"""WITH {AAE_FREQUENT} SELECT aekey, (aekey IN (SELECT aekey FROM older_frequent))::INT AS is_frequent_attender
        FROM v_aae WHERE fyear < 201920""",
)
def _(v):
    aae = v.aae.filter(F.col("fyear") < 201920)
    marked = ae.frequent_attender(aae, "aekey", "person_id_deid", "arrivaldate", F.col("aeattendcat") == "1")
    return marked.select("aekey", "is_frequent_attender")


@check(
    "raw_16_frequent_attender_by_year",
    f"""WITH {AAE_FREQUENT} SELECT aekey, (aekey IN (SELECT aekey FROM older_frequent))::INT AS is_frequent_attender
        FROM v_aae WHERE fyear < 201920""",
)
def _(v):
    """Year by year, each from its own records and the days carried over."""
    visit, counts = ("aekey", "person_id_deid", "arrivaldate"), F.col("aeattendcat") == "1"
    carried, parts = None, []
    for fyear in sorted(r[0] for r in v.aae.filter("fyear < 201920").select("fyear").distinct().collect()):
        year = v.aae.filter(F.col("fyear") == fyear)
        parts.append(ae.frequent_attender(year, *visit, counts, carried=carried).select("aekey", "is_frequent_attender"))
        carried = materialise(ae.carry_days(year, *visit[1:], counts, date(fyear // 100 + 1, 4, 1), carried))
    return reduce(DataFrame.unionByName, parts)


@check(
    "raw_17_frequent_attender_across",
    f"""WITH {ECDS_FREQUENT} SELECT CAST(EC_Ident AS VARCHAR) AS key, (EC_Ident IN (SELECT EC_Ident FROM newer_frequent))::INT AS is_frequent_attender
        FROM newer""",
)
def _(v):
    ecds = ae.lower_names(v.ecds).filter(F.col("der_financial_year") >= "2019/20")
    ecds = ecds.select(
        F.col("ec_ident").cast("string").alias("key"),
        F.col("pseudo_nhs_number_pet").cast("string").alias("token_person_id"),
        "arrival_date",
        "ec_attendancecategory",
    )
    counts = F.col("ec_attendancecategory") == "1"
    marked = ae.frequent_attender(ecds, "key", "token_person_id", "arrival_date", counts, ae.older_prior(v.aae))
    return marked.select("key", "is_frequent_attender")


NO_TREATMENT = """
treated AS (SELECT aekey, fyear, procode3 FROM v_aae_tx WHERE treatment <> '24'
  UNION SELECT aekey, fyear, procode3 FROM v_aae_inv WHERE investigation NOT IN ('22', '99'))"""


@check(
    "raw_18_no_treatment",
    f"""WITH {NO_TREATMENT} SELECT aekey, (t.aekey IS NULL AND (aeattenddisp IS NULL OR aeattenddisp = '03'))::INT AS is_discharged_no_treatment
        FROM v_aae a LEFT JOIN treated t USING (aekey, fyear, procode3)""",
)
def _(v):
    return ae.no_treatment(v.aae, v.aae_tx, v.aae_inv).select("aekey", "is_discharged_no_treatment")


AE_TAIL = """'Other' AS tretspef, 'Other' AS tretspef_grouped, 'aae_type-' || aedepttype AS pod, 'demographics' AS demog_type"""
OLDER = f"""
{AAE_FREQUENT}, {NO_TREATMENT}, {MAIN},
older_dx AS (SELECT aekey, fyear, procode3, min(substr(diagnosis, 1, 2)) AS code FROM v_aae_dx
  WHERE diag_order = 1 AND regexp_matches(substr(diagnosis, 1, 2), '^[0-3][0-9]$') GROUP BY ALL),
older_tx AS (SELECT aekey, fyear, procode3, min(substr(treatment, 1, 2)) AS code FROM v_aae_tx
  WHERE treatment_order = 1 AND regexp_matches(substr(treatment, 1, 2), '^([0-4][0-9]|5[0-7]|99)$') GROUP BY ALL),
successor AS (SELECT org_from, min(org_to) AS org_to FROM v_trust GROUP BY org_from),
older_base AS (SELECT a.*, coalesce(t.org_to, a.procode3) AS provider,
    CASE WHEN activage >= 7000 THEN 0 WHEN activage > 90 THEN 90 ELSE activage END AS age FROM v_aae a
  LEFT JOIN successor t ON t.org_from = a.procode3 WHERE fyear < 201920),
older AS (SELECT a.aekey AS key, 'aae' AS data_source, a.fyear, a.procode3, a.provider, a.age, {BAND} AS age_group, CAST(a.sex AS INT) AS sex,
    a.imd_decile, a.imd_quintile, a.ethnos, a.provider AS sitetret, a.aedepttype, a.aeattendcat AS attendance_category,
    a.arrivaldate AS arrival_date, a.resgor_ons, a.lsoa11, g.lad23cd, coalesce(r.icb22cdh, s.icb22cdh) AS icb,
    coalesce(coalesce(r.icb22cdh, s.icb22cdh) = m.main_icb, false) AS is_main_icb, a.age >= 18 AS is_adult, aearrivalmode = '1' AS is_ambulance,
    a.aekey IN (SELECT aekey FROM older_frequent) AS is_frequent_attender,
    (regexp_matches(sushrg, '^VB(0[69]|1[01])Z$') AND aeattenddisp IN ('02', '03')) AS is_low_cost_referred_or_discharged,
    aeattenddisp = '12' AS is_left_before_treatment,
    (n.aekey IS NULL AND (aeattenddisp IS NULL OR aeattenddisp = '03')) AS is_discharged_no_treatment,
    d.code AS primary_diagnosis, x.code AS primary_treatment, 1 AS arrival
  FROM older_base a LEFT JOIN treated n USING (aekey, fyear, procode3) LEFT JOIN older_dx d USING (aekey, fyear, procode3)
  LEFT JOIN older_tx x USING (aekey, fyear, procode3) LEFT JOIN v_ccg_icb r ON a.ccg_residence = r.ccg
  LEFT JOIN v_ccg_icb s ON a.ccg_responsibility = s.ccg LEFT JOIN v_lsoa11_lad23 g ON g.lsoa11cd = a.lsoa11
  LEFT JOIN main_icb m ON m.provider = a.provider
  WHERE a.sex IN ('1', '2') AND a.age BETWEEN 0 AND 90 AND a.provider NOT IN ({GONE}))"""
NEWER = f"""
{ECDS_FREQUENT}, {MAIN},
successor AS (SELECT org_from, min(org_to) AS org_to FROM v_trust GROUP BY org_from),
newer_base AS (SELECT e.*, CASE WHEN Der_Provider_Site_Code IN ('RW602', 'RM318') THEN 'R0A' ELSE coalesce(t.org_to, Der_Provider_Code) END AS provider,
    least(Age_At_Arrival, 90) AS age FROM newer e LEFT JOIN successor t ON t.org_from = e.Der_Provider_Code WHERE Age_At_Arrival IS NOT NULL),
newer_rows AS (SELECT CAST(EC_Ident AS VARCHAR) AS key, 'ecds' AS data_source, CAST(replace(Der_Financial_Year, '/', '') AS INT) AS fyear,
    Der_Provider_Code AS procode3, a.provider, a.age, {BAND} AS age_group, CAST(Sex AS INT) AS sex, i.imd19_decile AS imd_decile,
    CAST(floor((i.imd19_decile - 1) / 2) + 1 AS INT) AS imd_quintile, Ethnic_Category AS ethnos, Der_Provider_Site_Code AS sitetret,
    EC_Department_Type AS aedepttype, EC_AttendanceCategory AS attendance_category, Arrival_Date AS arrival_date,
    CASE EC_Acuity_SNOMED_CT WHEN '1077251000000100' THEN 'non-urgent' WHEN '1077241000000103' THEN 'standard' WHEN '1064901000000108' THEN 'urgent'
      WHEN '1064911000000105' THEN 'very-urgent' WHEN '1064891000000107' THEN 'immediate-resuscitation' END AS acuity,
    Government_Office_Region AS resgor_ons, Der_Postcode_LSOA_2011_Code AS lsoa11, g.lad23cd, coalesce(r.icb22cdh, s.icb22cdh) AS icb,
    coalesce(coalesce(r.icb22cdh, s.icb22cdh) = m.main_icb, false) AS is_main_icb, a.age >= 18 AS is_adult,
    coalesce(EC_Arrival_Mode_SNOMED_CT IN ('1048031000000100', '1048081000000101', '1048041000000109', '1048021000000102', '1048051000000107'), false) AS is_ambulance,
    EC_Ident IN (SELECT EC_Ident FROM newer_frequent) AS is_frequent_attender,
    coalesce(Discharge_Follow_Up_SNOMED_CT IN ('989501000000106', '3780001') AND regexp_matches(SUS_HRG_Code, '^VB(0[69]|1[01])Z$'), false) AS is_low_cost_referred_or_discharged,
    coalesce(EC_Discharge_Status_SNOMED_CT IN ('1066301000000103', '1066311000000101', '1066321000000107'), false) AS is_left_before_treatment,
    (coalesce(Der_EC_Investigation_All, '1088291000000101') = '1088291000000101' AND coalesce(Der_EC_Treatment_All, '183964008') = '183964008') AS is_discharged_no_treatment,
    EC_Chief_Complaint_SNOMED_CT AS primary_diagnosis,
    CASE WHEN Der_EC_Treatment_All IS NULL THEN NULL WHEN regexp_matches(split_part(Der_EC_Treatment_All, ',', 1), '^[0-9]+$')
      THEN split_part(Der_EC_Treatment_All, ',', 1) ELSE '' END AS primary_treatment, 1 AS arrival
  FROM newer_base a LEFT JOIN v_imd i ON i.lsoa11 = a.Der_Postcode_LSOA_2011_Code LEFT JOIN v_ccg_icb r ON a.Der_Postcode_CCG_Code = r.ccg
  LEFT JOIN v_ccg_icb s ON a.Responsible_CCG_From_General_Practice = s.ccg LEFT JOIN v_lsoa11_lad23 g ON g.lsoa11cd = a.Der_Postcode_LSOA_2011_Code
  LEFT JOIN main_icb m ON m.provider = a.provider
  WHERE a.Sex IN ('1', '2') AND a.age BETWEEN 0 AND 90 AND a.provider NOT IN ({GONE}))"""


def ae_select(source: str, acuity: str | None) -> str:
    mode = "CASE WHEN is_ambulance THEN 'ambulance' ELSE 'walk-in' END"
    kind = f"CASE WHEN is_adult THEN 'adult_' ELSE 'child_' END || {mode}"
    return f"""SELECT key, data_source, fyear, procode3, provider, age, age_group, sex, imd_decile, imd_quintile, ethnos, sitetret, aedepttype,
      attendance_category, strftime(arrival_date, '%Y-%m-%d') AS arrival_date, {'' if acuity is None else acuity + ' AS acuity,'} resgor_ons, lsoa11, lad23cd, icb,
      is_main_icb::INT AS is_main_icb, is_adult::INT AS is_adult, is_ambulance::INT AS is_ambulance, is_frequent_attender::INT AS is_frequent_attender,
      is_low_cost_referred_or_discharged::INT AS is_low_cost_referred_or_discharged, is_left_before_treatment::INT AS is_left_before_treatment,
      is_discharged_no_treatment::INT AS is_discharged_no_treatment, primary_diagnosis, primary_treatment, arrival,
      {mode} AS "group", {kind} AS type, 'aae_' || {kind} AS hsagrp, {AE_TAIL}, {mode} AS ndggrp FROM {source}"""


def older(v):
    return ae.aae_records(
        v.aae, v.aae_dx, v.aae_tx, v.aae_inv, v.trust, v.ccg_icb, v.lsoa11_lad23, ref.main_group(v.ip)
    )


def newer(v):
    return ae.ecds_records(v.ecds, v.aae, v.trust, v.ccg_icb, v.lsoa11_lad23, v.imd, ref.main_group(v.ip))


@check("raw_19_aae_records", f"WITH {OLDER} {ae_select('older', None)}")
def _(v):
    return older(v)


@check("raw_20_ecds_records", f"WITH {NEWER} {ae_select('newer_rows', 'acuity')}")
def _(v):
    return newer(v)


@check(
    "raw_21_deprivation",
    """SELECT e.event_id AS event_id, i.imd19_decile AS imd_decile, CASE WHEN i.imd19_decile <= 2 THEN 1 WHEN i.imd19_decile <= 4 THEN 2
         WHEN i.imd19_decile <= 6 THEN 3 WHEN i.imd19_decile <= 8 THEN 4 WHEN i.imd19_decile <= 10 THEN 5 END AS imd_quintile
       FROM (SELECT e AS event_id, lsoa11 FROM v_event) e LEFT JOIN v_imd i USING (lsoa11)""",
)
def _(v):
    visits = v.event.select(F.col("e").alias("event_id"), "lsoa11")
    return attr.add_deprivation(visits, v.imd).select("event_id", "imd_decile", "imd_quintile")


@check(
    "raw_22_acuity",
    """SELECT EC_Ident AS key, CASE EC_Acuity_SNOMED_CT WHEN '1077251000000100' THEN 'non-urgent' WHEN '1077241000000103' THEN 'standard'
         WHEN '1064901000000108' THEN 'urgent' WHEN '1064911000000105' THEN 'very-urgent' WHEN '1064891000000107' THEN 'immediate-resuscitation' END AS acuity
       FROM v_ecds""",
)
def _(v):
    return v.ecds.select(F.col("EC_Ident").alias("key"), ae.map_codes(F.col("EC_Acuity_SNOMED_CT"), ae.ACUITY).alias("acuity"))


@check(
    "raw_23_union_systems",
    f"WITH {OLDER}, {NEWER.split(MAIN + ',')[0]} {NEWER.split(MAIN + ',')[1].split('),', 1)[1]} "
    f"{ae_select('older', 'NULL')} UNION ALL {ae_select('newer_rows', 'acuity')}",
)
def _(v):
    return ae.union_systems(older(v), newer(v))


# --- rollups -------------------------------------------------------------------------------------
def _rollup_oracle(view: str, keys: list[str], sums: str, renamed: dict[str, str]) -> str:
    source = ", ".join(f"{renamed.get(k, k if k != 'group' else chr(34) + 'group' + chr(34))} AS k{i}" for i, k in enumerate(keys))
    ident = ", ".join(f"coalesce(CAST(k{i} AS VARCHAR), '~')" for i in range(len(keys)))
    flags = {"has_procedures"} | {k for k in keys if k.startswith("is_")}
    named = ", ".join(f'k{i}{"::INT" if k in flags else ""} AS "{k}"' for i, k in enumerate(keys))
    return f"SELECT {named}, {sums}, md5(concat_ws('|', {ident})) AS index FROM (SELECT *, {source} FROM {view}) r GROUP BY ALL"


@check("agg_01_ae_rollup", _rollup_oracle("v_ae", ae.AE_ROLLUP, "CAST(sum(arrival) AS BIGINT) AS arrivals", {}))
def _(v):
    return ae.ae_rollup(v.ae)


@check(
    "agg_02_op_rollup",
    _rollup_oracle(
        "v_op",
        ae.OP_ROLLUP,
        "CAST(sum(attendance) AS BIGINT) AS attendances, CAST(sum(tele_attendance) AS BIGINT) AS tele_attendances",
        {"sushrg_trimmed": "substr(sushrg, 1, 4)"},
    ),
)
def _(v):
    return ae.op_rollup(v.op)
