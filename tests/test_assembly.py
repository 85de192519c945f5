"""The assembly holds every inpatient cohort, not only those of the rules."""

import __spark_entry__ as registered
from checks import queries_cohorts as cohorts

FOLDER = "/root/testdata/sf0.001"


def test_assembly_has_the_rows_of_all_cohorts(spark):
    assert len(cohorts.RULES) + len(cohorts.OTHERS) == 58
    found = {(r.type, r.strategy): r["count"] for r in registered.queries()["coh_04_assembly"](spark, FOLDER).groupBy("type", "strategy").count().collect()}
    strategies = {s for _, s in found}
    begins = ("alcohol_partially", "smoking", "obesity", "frail_elderly", "readmission", "day_procedures", "excess_beddays", "pre-op_los", "same_day_emergency")
    assert all(any(s.startswith(b) for s in strategies) for b in begins)
