"""Hand-made spells for the rules: one that meets each condition, and one that just misses it."""

import pytest

from cohortlake.operators import cohorts as co
from cohortlake.operators import conditions as cond
from cohortlake.operators.rules import standard_rules

SPELL = "epikey long, fyear int, provider string, age int, sex string, admimeth string, dismeth string, speldur int, sushrg string"
DEFAULT = {"age": 70, "sex": "1", "admimeth": "21", "dismeth": "1", "speldur": 5, "sushrg": "ZZ01Z"}
EL = {"admimeth": "11"}

# strategy, spell, diagnoses, procedures, expected
CASES = [
    ("alcohol_wholly_attributable", {"age": 16}, "J18 E244", "", True),
    ("alcohol_wholly_attributable", {"age": 15}, "J18 E244", "", False),
    ("ambulatory_care_conditions_acute", {}, "L031", "", True),
    ("ambulatory_care_conditions_acute", {}, "L031", "A011", False),
    ("ambulatory_care_conditions_acute", {}, "I10X R02X", "", True),
    ("ambulatory_care_conditions_acute", EL, "G400", "", False),
    ("ambulatory_care_conditions_chronic", {}, "J201 J441", "", True),
    ("ambulatory_care_conditions_chronic", {}, "J201 J451", "", False),
    ("ambulatory_care_conditions_chronic", {}, "I209", "Y011 A011", True),
    ("ambulatory_care_conditions_vaccine_preventable", {}, "J101", "", True),
    ("ambulatory_care_conditions_vaccine_preventable", {}, "J101 D571", "", False),
    ("cancelled_operations", {"admimeth": "12", "sushrg": "WA14Z"}, "R10", "", True),
    ("cancelled_operations", {"admimeth": "12", "sushrg": "WA14Z", "dismeth": None}, "R10", "", False),
    ("eol_care_2_days", {"dismeth": "4", "speldur": 2}, "I500", "", True),
    ("eol_care_2_days", {"dismeth": "4", "speldur": 2}, "I500 W190", "", False),
    ("eol_care_3_to_14_days", {"dismeth": "4", "speldur": 14}, "I500", "", True),
    ("eol_care_3_to_14_days", {"dismeth": "4", "speldur": 14}, "I500", "A011", False),
    ("evidence_based_interventions_ent", {**EL, "age": 18}, "H660", "D151", True),
    ("evidence_based_interventions_ent", {**EL, "age": 19}, "H660", "D151", False),
    ("evidence_based_interventions_ent", {**EL, "age": 18}, "H660 C501", "D151", False),
    ("evidence_based_interventions_general_surgery", EL, "K640", "H512", True),
    ("evidence_based_interventions_general_surgery", EL, "K640", "H514", False),
    ("evidence_based_interventions_gi_surgical", EL, "R194", "H221", True),
    ("evidence_based_interventions_gi_surgical", EL, "R194", "H221 H681", False),
    ("evidence_based_interventions_msk", EL, "M545 O268", "V382", True),
    ("evidence_based_interventions_msk", EL, "M545 O268 M533", "V382", False),
    ("evidence_based_interventions_msk", EL, "M233 M238", "W714 Y767 Z846", True),
    ("evidence_based_interventions_msk", EL, "M233 M238", "W714 Y767", False),
    ("evidence_based_interventions_urology", EL, "N40X", "M611", True),
    ("evidence_based_interventions_urology", {**EL, "sex": "2"}, "N40X", "M611", False),
    ("evidence_based_interventions_vascular_varicose_veins", EL, "I839", "L841", True),
    ("evidence_based_interventions_vascular_varicose_veins", EL, "I839", "L847", False),
    ("falls_related_admissions", {}, "S720 W010", "", True),
    ("falls_related_admissions", {"age": 64}, "S720 W010", "", False),
    ("falls_related_admissions", {}, "M484 V011", "", False),
    ("intentional_self_harm", {}, "T391 X611", "", True),
    ("intentional_self_harm", EL, "T391 X611", "", False),
    ("medically_unexplained_related_admissions", {}, "R074", "", True),
    ("medically_unexplained_related_admissions", {}, "J18 R074", "", False),
    ("medicines_related_admissions_explicit", {}, "J18 Y400", "", True),
    ("medicines_related_admissions_explicit", {}, "J18 Y580", "", False),
    ("medicines_related_admissions_implicit_anti-diabetics", {}, "E161 E119", "", True),
    ("medicines_related_admissions_implicit_anti-diabetics", {}, "E161 E119 Y401", "", False),
    ("medicines_related_admissions_implicit_benzodiasepines", {}, "R55X F101", "", True),
    ("medicines_related_admissions_implicit_diurectics", {}, "I470 I10X", "", True),
    ("medicines_related_admissions_implicit_nsaids", {}, "K250 M060", "", True),
    ("medicines_related_admissions_implicit_nsaids", {}, "K251 M060", "", False),
    ("raid_ae", {}, "F200", "", True),
    ("raid_ae", {"admimeth": "22"}, "F200", "", False),
    ("virtual_wards_activity_avoidance_ari", {}, "J101", "", True),
    ("virtual_wards_efficiencies_ari", {}, "J101", "A011", False),
    ("virtual_wards_activity_avoidance_heart_failure", {}, "I500", "A011", True),
    ("virtual_wards_efficiencies_heart_failure", {"age": 17}, "I500", "", False),
    ("zero_los_no_procedure_adult", {"speldur": 0, "age": 18}, "R10", "", True),
    ("zero_los_no_procedure_adult", {"speldur": 0, "age": 18}, "R10", "Z011", False),
    ("zero_los_no_procedure_child", {"speldur": 0, "age": 17}, "R10", "", True),
    ("emergency_elderly", {"age": 75}, "R10", "", True),
    ("emergency_elderly", {"age": 74}, "R10", "", False),
    ("enhanced_recovery_bladder", EL, "R10", "M341", True),
    ("enhanced_recovery_breast", EL, "R10", "B261", False),
    ("enhanced_recovery_colectomy", EL, "R10", "H101", True),
    ("enhanced_recovery_hip", EL, "R10", "W371", True),
    ("enhanced_recovery_hysterectomy", {**EL, "sex": "2"}, "R10", "Q071", True),
    ("enhanced_recovery_hysterectomy", EL, "R10", "Q071", False),
    ("enhanced_recovery_knee", EL, "R10", "W402", False),
    ("enhanced_recovery_prostate", EL, "R10", "M611", True),
    ("enhanced_recovery_prostate", {**EL, "sex": "2"}, "R10", "M611", False),
    ("enhanced_recovery_prostate", EL, "R10", "1011", False),
    ("enhanced_recovery_rectum", EL, "R10", "H337", False),
    ("raid_ip", {}, "J18 F200", "", True),
    ("raid_ip", {"dismeth": "4"}, "J18 F200", "", False),
    ("stroke_early_supported_discharge", {"sushrg": "AA35A"}, "I64", "", True),
    ("stroke_early_supported_discharge", {"sushrg": "AA34A"}, "I64", "", False),
]


@pytest.fixture(scope="module")
def tagged(spark):
    spells, dx, px = [], [], []
    for key, (_, spell, diagnoses, procedures, _) in enumerate(CASES):
        values = {**DEFAULT, **spell}
        spells.append((key, 201920, "P1", *[values[c] for c in DEFAULT]))
        dx += [(key, 201920, i, c) for i, c in enumerate(diagnoses.split(), 1)]
        px += [(key, 201920, i, c) for i, c in enumerate(procedures.split(), 1)]
    rows = co.tag(
        spark.createDataFrame(spells, SPELL),
        spark.createDataFrame(dx, "epikey long, fyear int, diag_order int, diagnosis string"),
        spark.createDataFrame(px, "epikey long, fyear int, procedure_order int, procedure_code string"),
        standard_rules(),
    ).collect()
    return {(r["epikey"], r["strategy"]) for r in rows}


@pytest.mark.parametrize("key", range(len(CASES)))
def test_rule(tagged, key):
    strategy, *_, expected = CASES[key]
    assert ((key, strategy) in tagged) is expected


def test_every_rule_has_a_case():
    assert {r.strategy for r in standard_rules()} == {c[0] for c in CASES}
    assert len(standard_rules()) == 39


def test_duplicate_names_are_refused():
    rules = co.Rules([co.Rule("efficiency", "a", cond.Where("true"))])
    rules.add(co.Rule("activity_avoidance", "a", cond.Where("true")))
    with pytest.raises(co.DuplicateCohortError):
        rules.add(co.Rule("efficiency", "a", cond.Where("false")))


def test_codes_of_another_year_do_not_count(spark):
    spells = spark.createDataFrame([(1, 201920, "P1", 80, "1", "21", "1", 3, "X")], SPELL)
    dx = spark.createDataFrame([(1, 201819, 1, "F200")], "epikey long, fyear int, diag_order int, diagnosis string")
    px = dx.selectExpr("epikey", "fyear", "diag_order AS procedure_order", "diagnosis AS procedure_code")
    assert co.has(spells, dx, px, cond.any_dx("F")).count() == 0
    assert co.has_not(spells, dx, px, cond.any_dx("F")).count() == 1
    assert co.has(spells, dx, px, cond.NoProcedure(True)).count() == 1
    assert co.has(spells, dx, px, cond.NoProcedure(False)).count() == 0
