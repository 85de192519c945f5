"""Patterns taken apart against the regex engine, and the plans of what uses them."""

import random
import re
import string

import pyarrow as pa
import pytest

from checks import rule_tables
from checks.views import Views
from cohortlake.operators import cohort_pass, patterns
from cohortlake.operators.conditions import expand_patterns, patterns_of
from cohortlake.operators.rules import standard_rules

ODD = [
    "^(DZ.*|A.+B?)$", "[^A-C]1", "E86X|K52[289]", "(?!x)a", "a*b", "^([A-F][0-9]{2,3}X?)$", "[J-K]..[0-9]", "A{2,}", "x|",
    "\\d\\.", "(?:A|B)?C$", "", "[]a]", "[a-]", "^^A", "A^B", "A$B", "((A|B)(1|2)){1,2}",
]


def random_codes(count, seed=1):
    rng = random.Random(seed)
    return ["".join([rng.choice(string.ascii_uppercase), *rng.choices("0123456789X", k=rng.randint(0, 5))]) for _ in range(count)]


def test_patterns_match_what_the_regex_matches(spark):
    conditions = [r.condition for r in standard_rules()]
    wanted = [*ODD, *patterns_of(conditions, "dx"), *patterns_of(conditions, "px")]
    codes = sorted({*random_codes(4000), "", "DZ", "DZ1", "aab", "A", "AB", "b", "x", "1.", "C", "AC", "]", "-", "a", "A1B2", "A1A"})
    frame = spark.createDataFrame([(c,) for c in codes] + [(None,), (codes[5],)], "code string")
    rules = spark.createDataFrame(pa.table({"pattern": [*wanted, None], "name": [*map(str, range(len(wanted))), "none"]}))
    found = {tuple(r) for r in expand_patterns(frame, "code", rules).collect()}
    assert found == {(c, str(k)) for k, p in enumerate(wanted) for c in codes if re.search(f"^({p})", c)}


def test_patterns_that_are_not_finite_are_kept_whole():
    assert patterns.compile_pattern("S(22[01]|32)") == [("S(22[01]|32)", "S22", ["01"], True, None), ("S(22[01]|32)", "S32", [], True, None)]
    for pattern in ("(?=A)A", "A*B", "(A)\\1", "[A&&B]"):
        assert patterns.compile_pattern(pattern)[0][-1] == f"^({pattern})"


def test_fifty_thousand_patterns(spark):
    """A table of 50,000 rules is matched by joins; nothing of it gets into the plan's text."""
    rng = random.Random(4)
    made = [f"{rng.choice(string.ascii_uppercase)}{rng.randint(0, 9)}({rng.randint(0, 9)}[{rng.randint(0, 4)}-{rng.randint(5, 9)}]|{rng.randint(0, 9)}{rng.randint(0, 9)})" for _ in range(50_000)]
    codes = random_codes(3000, 2)
    rules = spark.createDataFrame(pa.table({"pattern": made, "rate": [k / 50_000 for k in range(50_000)]}))
    frame = spark.createDataFrame([(c,) for c in codes], "code string")
    matched = expand_patterns(frame, "code", rules)
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 50_000 and "CartesianProduct" not in plan and "NestedLoop" not in plan
    count = matched.groupBy("code").count().collect()
    by_start = {}
    for p in made:
        by_start.setdefault(p[:2], []).append(re.compile(p))
    sample = codes[:150]
    want = {c: sum(1 for p in by_start.get(c[:2], []) if p.match(c)) for c in sample}
    got = {r["code"]: r["count"] for r in count}
    assert {c: got.get(c, 0) for c in sample} == want and sum(want.values()) > 500


@pytest.fixture(scope="module")
def views(spark):
    return Views.of(spark, "/root/testdata/sf0.001")


def test_each_code_table_is_scanned_twice(spark, views, monkeypatch):
    """Once for the distinct codes and once for everything else, in all jobs of the pass."""
    from checks import queries_cohorts as q
    from cohortlake.operators import cohorts as co

    scans = []
    # these lookups of the fixture are made from the records
    obesity, day_codes = (cohort_pass.materialise(df) for df in (views.obesity, q._day_codes(views)))
    paths = {name: frame.inputFiles()[0].rsplit("/", 1)[0] for name, frame in (("dx", views.dx), ("px", views.px))}
    whole = cohort_pass.materialise

    def watched(df):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        files = df._jdf.queryExecution().sparkPlan().toString()
        for name, path in paths.items():
            scans.extend([name] * files.count(path[-40:]))
        assert "CartesianProduct" not in text
        return whole(df)

    monkeypatch.setattr(cohort_pass, "materialise", watched)
    monkeypatch.setattr("cohortlake.functions.skew.materialise", watched)
    monkeypatch.setattr(co, "materialise", watched)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    points = spark.createDataFrame(rule_tables.FRAILTY, "icd10 string, score double")
    alcohol = {g: co.alcohol_rules(q._file(views, rule_tables.ALCOHOL), g) for g in ("chronic", "acute")}
    lookups = cohort_pass.Lookups(
        points, obesity, day_codes, views.trimpoint, alcohol, q._smoking(views), co.sdec_rules(q._file(views, rule_tables.SDEC))
    )
    found = cohort_pass.all_cohorts(views.ip, views.apc, views.dx, views.px, lookups)
    rest = found._jdf.queryExecution().sparkPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for name, path in paths.items():
        scans.extend([name] * rest.count(path[-40:]))
    assert sorted(scans) == ["dx", "dx", "px", "px"]


def test_code_lists_rank_without_whole_groups(spark):
    """The rank's limit is applied before the shuffle, and totals need no window."""
    from pyspark.sql import functions as F

    from cohortlake.operators.inputs import top_codes

    rows = [(2020, "P" if k % 3 else None, "s", f"c{k % 40:02}") for k in range(4000)]
    df = spark.createDataFrame(rows, "fyear int, provider string, strategy string, code string")
    found = top_codes(df, "provider", "code", F.count(F.lit(1)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("+- Window [") == 1
    out = found.collect()
    assert len(out) == 12 and {r["provider"] for r in out} == {"P", None}
    assert all(r["rn"] <= 6 and r["total"] == (2666 if r["provider"] else 1334) for r in out)


def test_flows_read_only_the_written_counts(views):
    """The sources are read once, by the count table; baseline and flows read that."""
    from cohortlake.operators import inputs

    counts = inputs.activity_counts(views.ip, views.op, views.ae)
    known = {*counts.inputFiles(), *views.trust.inputFiles()}
    for made in (
        inputs.baseline(counts, "provider", views.trust),
        inputs.expatriation(counts, views.trust),
        inputs.repatriation_local(counts, views.trust),
        inputs.repatriation_nonlocal(counts, views.trust),
    ):
        assert set(made.inputFiles()) <= known and made.count() > 0
