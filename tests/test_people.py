"""Operators that look at a person's other records, against brute force, with one very frequent person."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cohortlake.functions.skew import left_join_known, rank_all
from cohortlake.operators import cohorts as co
from cohortlake.operators.records_ae import frequent_attender

START = date(2018, 1, 1)


def _person(rng):
    return None if rng.random() < 0.1 else ("hot" if rng.random() < 0.4 else f"p{rng.randrange(12)}")


def test_frequent_attender(spark):
    rng = random.Random(1)
    rows = [
        (f"k{i}", _person(rng), START + timedelta(days=rng.randrange(900)), rng.choice(["1", "1", "2", None]))
        for i in range(500)
    ]
    extra = [(_person(rng), START + timedelta(days=rng.randrange(900))) for _ in range(60)]
    df = spark.createDataFrame(rows, "key string, person string, day date, category string")
    prior = spark.createDataFrame(extra, "person string, day date")
    found = frequent_attender(df, "key", "person", "day", F.col("category") == "1", prior)
    got = {r["key"]: r["is_frequent_attender"] for r in found.collect()}
    pool = [(p, d) for _, p, d, c in rows if c == "1" and p] + [(p, d) for p, d in extra if p]
    for key, person, day, category in rows:
        earlier = sum(1 for p, d in pool if p == person and 0 < (day - d).days <= 365)
        assert got[key] == (category == "1" and person is not None and earlier >= 3), key


ALL = (
    "epikey long, person_id_deid string, admidate date, disdate date, last_episode_in_spell boolean, "
    "well_baby_ind string, sushrg string, tretspef string, epitype string"
)


def _spells(rng, n, backwards=False):
    rows = []
    for key in range(n):
        into = START + timedelta(days=rng.randrange(1500))
        stay = rng.choice([0, 0, 1, 5, 20]) if not (backwards and rng.random() < 0.1) else -3
        rows.append((key, _person(rng), into, into + timedelta(days=stay), rng.random() < 0.9, "N", "AA", "100", "1"))
    return rows


def _targets(spark, all_spells):
    return all_spells.filter("last_episode_in_spell").select(
        "epikey", F.lit(201920).alias("fyear"), F.lit("P1").alias("provider"), F.col("person_id_deid").alias("person_id"),
        "admidate", "disdate", F.when(F.col("epikey") % 3 == 0, "11").otherwise("21").alias("admimeth"), F.lit(80).alias("age"),
    )


def test_readmissions_also_with_dates_the_wrong_way_round(spark):
    rows = _spells(random.Random(2), 300, backwards=True)
    table = spark.createDataFrame(rows, ALL)
    got = {r["epikey"] for r in co.readmissions(_targets(spark, table), table).collect()}
    prior = [r for r in rows if r[4] and r[1]]
    expected = {
        key
        for key, person, into, out, last, *_ in rows
        if last
        and person
        and key % 3
        and any(
            p == person and k != key and (into > i or out > o) and 0 <= (into - o).days <= 28
            for k, p, i, o, *_ in prior
        )
    }
    assert got == expected and expected


def test_frailty_scores(spark):
    rng = random.Random(3)
    rows = _spells(rng, 250)
    points = {"F00": 71, "W19": 32, "R29": 36, "I64": 26}
    codes = [(key, 201920, i + 1, f"{rng.choice([*points, 'J18'])}{rng.choice(['1', '2', ''])}") for key in range(250) for i in range(2)]
    table = spark.createDataFrame(rows, ALL)
    dx = spark.createDataFrame(codes, "epikey long, fyear int, diag_order int, diagnosis string")
    scores = spark.createDataFrame([(c, p / 10) for c, p in points.items()], "icd10 string, score double")
    got = {r["epikey"]: r["score"] for r in co.frailty_scores(_targets(spark, table), table, dx, scores).collect()}
    own = {}
    for key, _, _, code in codes:
        if len(code) > 3 and code[:3] in points:
            own.setdefault(key, set()).add(code[:3])
    for key, person, into, _, last, *_ in rows:
        if not (last and person and key % 3):
            assert key not in got
            continue
        seen = set(own.get(key, ()))
        for k, p, _, out, ended, *_ in rows:
            if ended and p == person and 0 < (into - out).days <= 730:
                seen |= own.get(k, set())
        assert got.get(key, 0) == sum(points[c] for c in seen), key


def test_left_join_with_unknown_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, None)], "id long, k string")
    right = spark.createDataFrame([("a", 10)], "k string, v int")
    joined = left_join_known(left, right, ["k"], spread_by="id")
    assert {(r["id"], r["v"]) for r in joined.collect()} == {(1, 10), (2, None), (3, None), (4, None)}


@pytest.mark.parametrize("top", [9, 2])
def test_rank_all(spark, top):
    rng = random.Random(4)
    rows = [(f"c{i:03d}", rng.randrange(1, top)) for i in range(200)]
    df = spark.createDataFrame(rows, "code string, n long")
    ranked = rank_all(df, order=[F.desc("n"), F.col("code")], name="rank")
    assert "SinglePartition" not in ranked._jdf.queryExecution().toString()
    expected = {c: i for i, (c, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1)}
    assert {r["code"]: r["rank"] for r in ranked.collect()} == expected
