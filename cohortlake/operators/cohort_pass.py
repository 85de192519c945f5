"""All inpatient cohorts in one pass: each code table is read for its distinct codes and once more for everything else.

What a code means to any cohort is a bit: patterns of rules, of the alcohol and smoking fractions, of the same-day
care directory, and the scored frailty codes are numbered together, and every distinct code gets the bits of all
it matches. One aggregate per code table or-s them into a few long columns for each record. A fraction
cohort is then a table of weights, by sex, outcome and age, of which those count whose bit is set.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions.expressions import counted_procedure, sql_literal
from cohortlake.functions.materialise import materialise
from cohortlake.functions.skew import broadcast_if_small, left_join_known
from cohortlake.operators import cohorts as co
from cohortlake.operators.conditions import BITS, KEYS, fold_bits, groups_of, numbered_patterns, patterns_of, position_masks, render
from cohortlake.operators.patterns import compiled, literal_prefixes, match_codes
from cohortlake.operators.rules import standard_rules

#: Weights of later ages are those of this one.
OLDEST = 130
WEIGHT = ["pattern", "position", "strategy", "sex", "outcome", "low", "high", "rate"]
#: More names of day-procedure cohorts than bits in a mask are refused.
MOST_NAMES = BITS


@dataclass(frozen=True)
class Lookups:
    """The published tables that cohorts depend on; see the operators in `cohorts` for their columns."""

    frailty: DataFrame
    obesity: DataFrame
    day_codes: DataFrame
    trimpoints: DataFrame
    alcohol: Mapping[str, DataFrame]
    smoking: DataFrame
    sdec: DataFrame


def weights(lookups: Lookups) -> DataFrame:
    """Rules of all fraction cohorts in one table; null sex, outcome or age means any."""
    smoking = lookups.smoking.select("pattern", F.lit("primary").alias("position"), F.lit("smoking").alias("strategy"), "sex", "rate")
    out = smoking.selectExpr("*", "cast(null as string) as outcome", "cast(null as int) as low", "cast(null as int) as high").select(*WEIGHT)
    for group, rules in lookups.alcohol.items():
        named = rules.withColumns({"position": F.lit("any"), "strategy": F.lit(f"alcohol_partially_attributable_{group}")})
        out = out.unionByName(named.select(*WEIGHT))
    return out


def _features(rule_weights: DataFrame, lookups: Lookups, begin: int) -> tuple[DataFrame, int]:
    """Distinct patterns and scored codes of the lookups, numbered from `begin`, and how many bits there are in all."""
    kinds = [
        rule_weights.select(F.lit("pattern").alias("kind"), "pattern"),
        lookups.sdec.select(F.lit("pattern").alias("kind"), F.col("icd10").alias("pattern")),
        lookups.frailty.where(F.length("icd10") == 3).select(F.lit("scored").alias("kind"), F.col("icd10").alias("pattern")),
    ]
    together = kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).where(F.col("pattern").isNotNull()).distinct()
    # the rules are one short table, so one task may put them in order
    place = F.row_number().over(Window.orderBy("kind", "pattern"))
    numbered = materialise(together.select("kind", "pattern", (place + (begin - 1)).cast("long").alias("number")))
    return numbered, begin + numbered.count()


def _matchers(features: DataFrame) -> DataFrame:
    """Patterns taken apart, and scored codes of which one more character must follow."""
    patterns = features.where("kind = 'pattern'").select("pattern", "number")
    scored = literal_prefixes(features.where("kind = 'scored'").select("pattern", "number"), F.col("pattern"), longer_by=1)
    apart = compiled(patterns).join(patterns, "pattern")
    return apart.unionByName(scored.select(*apart.columns)).drop("pattern")


POSITIONS = ("any", "primary", "secondary")


def _masks(order: str, count: int, prefix: str) -> tuple[list[Column], Column]:
    """Aggregates of a record's bits by position, and the one array that holds them: all of a position, then the next."""
    totals = position_masks(order, count, prefix, POSITIONS)
    parts = [F.coalesce(F.col(f"{prefix}_{p}_{g}"), F.lit(0).cast("long")) for p in POSITIONS for g in groups_of(count)]
    return totals, F.array(*parts).alias(prefix)


def place_of(position: str, number: Column, count: int) -> tuple[Column, Column]:
    """Where a feature's bit is: the place in the array, and the mask within it."""
    place = F.floor(number / BITS) + POSITIONS.index(position) * len(groups_of(count))
    return place.cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (number % BITS).cast("int"))


def _is_set(masks: str, place: Column, bit: Column) -> Column:
    return F.get(F.col(masks), place).bitwiseAND(bit) != 0


def _rule_sql(rule: co.Rule, patterns: Mapping[str, list[str]], counts: Mapping[str, int]) -> str:
    def bit(kind: str, position: str, number: int) -> str:
        place = number // BITS + POSITIONS.index(position) * len(groups_of(counts[kind]))
        return f"((coalesce(get({kind}, {place}), 0L) & {1 << number % BITS}L) != 0L)"

    kind, strategy = sql_literal(rule.type), sql_literal(rule.strategy)
    holds = render(rule.condition, patterns, bit)
    return f"CASE WHEN coalesce({holds}, false) THEN struct({kind} AS type, {strategy} AS strategy, 1.0D AS sample_rate) END"


def summarise_diagnoses(diagnoses: DataFrame, rule_patterns: list[str], features: DataFrame, count: int, obesity: DataFrame) -> DataFrame:
    """The bits of every record's diagnoses as `dx`, and its highest obesity fraction."""
    matchers = numbered_patterns(diagnoses.sparkSession, rule_patterns).unionByName(_matchers(features))
    facts = fold_bits(match_codes(diagnoses, "diagnosis", matchers), "diagnosis", count)
    facts = facts.join(obesity.groupBy("diagnosis").agg(F.max("fraction").alias("obesity")), "diagnosis", "full")
    totals, masks = _masks("diag_order", count, "dx")
    totals.append(F.max(F.when(F.col("diag_order") == 1, F.col("obesity"))).alias("obesity"))
    rows = diagnoses.select(*KEYS, "diagnosis", "diag_order").join(broadcast_if_small(facts), "diagnosis")
    return materialise(rows.groupBy(*KEYS).agg(*totals).select(*KEYS, masks, "obesity"))


def day_names(day_codes: DataFrame) -> list[str]:
    """Names of the day-procedure cohorts, at most as many as there are bits."""
    names = [row[0] for row in day_codes.select("strategy").where("strategy IS NOT NULL").distinct().orderBy("strategy").limit(MOST_NAMES + 1).collect()]
    if len(names) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} names of day-procedure cohorts")
    return names


def summarise_procedures(procedures: DataFrame, rule_patterns: list[str], names: list[str], day_codes: DataFrame, day: str) -> DataFrame:
    """The bits of every record's procedures as `px`, and the days of its counted first procedures.

    Records whose procedures match nothing have a row too: that there is one says that they have a procedure.
    """
    spark = procedures.sparkSession
    number = F.lit(None).cast("long")
    for k, name in enumerate(names):
        number = F.when(F.col("strategy") == name, F.lit(len(rule_patterns) + k).cast("long")).otherwise(number)
    listed = day_codes.where("strategy IS NOT NULL AND procedure_code IS NOT NULL").select(number.alias("number"), "procedure_code").distinct()
    matchers = numbered_patterns(spark, rule_patterns)
    matchers = matchers.unionByName(literal_prefixes(listed, F.col("procedure_code")).select(*matchers.columns))
    count = len(rule_patterns) + len(names)
    facts = fold_bits(match_codes(procedures, "procedure_code", matchers), "procedure_code", count)
    totals, masks = _masks("procedure_order", count, "px")
    counted = (F.col("procedure_order") == 1) & counted_procedure(F.col("procedure_code"))
    totals.append(F.collect_set(F.when(counted, F.col(day))).alias("days"))
    rows = procedures.select(*KEYS, "procedure_code", "procedure_order", day)
    rows = rows.join(broadcast_if_small(facts), "procedure_code", "left")
    return materialise(rows.groupBy(*KEYS).agg(*totals).select(*KEYS, masks, "days"))


def weight_table(rule_weights: DataFrame, features: DataFrame, count: int, strategies: list[str]) -> DataFrame:
    """By sex, outcome and age: for each strategy `(minus, place, bit)`, the highest rates first. As long as the rules of one sex and age."""
    numbers = features.where("kind = 'pattern'").select("pattern", "number")
    sexes, outcomes = F.array(F.lit("1"), F.lit("2")), F.array(F.lit("mortality"), F.lit("morbidity"))
    apart = (
        rule_weights.join(numbers, "pattern")
        .withColumns(
            {
                "low": F.greatest(F.coalesce("low", F.lit(-1)), F.lit(-1)),
                "high": F.least(F.coalesce("high", F.lit(OLDEST)), F.lit(OLDEST)),
            }
        )
        .where("low <= high")
        .withColumn("sex", F.explode(F.when(F.col("sex").isNull(), sexes).otherwise(F.array("sex"))))
        .withColumn("outcome", F.explode(F.when(F.col("outcome").isNull(), outcomes).otherwise(F.array("outcome"))))
        .withColumn("weight_age", F.explode(F.sequence("low", "high")))
    )
    places = {p: place_of(p, F.col("number"), count) for p in ("any", "primary")}
    place, bit = (F.when(F.col("position") == "any", places["any"][k]).otherwise(places["primary"][k]) for k in (0, 1))
    entry = F.struct((-F.col("rate")).alias("minus"), place.alias("place"), bit.alias("bit"))
    lists = [F.array_sort(F.collect_set(F.when(F.col("strategy") == s, entry))).alias(f"weights_{k}") for k, s in enumerate(strategies)]
    return apart.groupBy("sex", "outcome", "weight_age").agg(*lists)


def hrg_table(ip: DataFrame, features: DataFrame, count: int, lookups: Lookups) -> DataFrame:
    """By HRG: the directory entries that it is in, `(level, place, bit)` of their diagnoses, and its trim points."""
    numbers = features.where("kind = 'pattern'").select(F.col("pattern").alias("icd10"), "number")
    place, bit = place_of("primary", F.col("number"), count)
    hrg = lookups.sdec.join(numbers, "icd10").select("level", place.alias("place"), bit.alias("bit"), F.col("hrg").alias("pattern"))
    entries = F.collect_set(F.struct("level", "place", "bit")).alias("entries")  # as many as the directory has at most
    by_hrg = match_codes(ip, "sushrg", compiled(hrg)).distinct().join(hrg, "pattern").groupBy("sushrg").agg(entries)
    trims = lookups.trimpoints.groupBy("sushrg").agg(F.max("elective").alias("elective"), F.max("emergency").alias("emergency"))
    return by_hrg.join(trims, "sushrg", "full")


def all_cohorts(
    ip: DataFrame,
    apc: DataFrame,
    diagnoses: DataFrame,
    procedures: DataFrame,
    lookups: Lookups,
    rules: co.Rules | None = None,
    day: str = "procedure_date",
) -> DataFrame:
    """Membership of every inpatient cohort: what the operators of `cohorts` give one by one."""
    listed = list(rules if rules is not None else standard_rules())
    patterns = {kind: patterns_of([r.condition for r in listed], kind) for kind in ("dx", "px")}
    names = day_names(lookups.day_codes)
    rule_weights = weights(lookups)
    strategies = ["smoking", *(f"alcohol_partially_attributable_{g}" for g in lookups.alcohol)]
    # written tables that don't need each other are written side by side
    with ThreadPoolExecutor(4) as side:
        px = side.submit(summarise_procedures, procedures, patterns["px"], names, lookups.day_codes, day)
        features, dx_bits = _features(rule_weights, lookups, len(patterns["dx"]))
        by_hrg = side.submit(lambda: broadcast_if_small(hrg_table(ip, features, dx_bits, lookups)))
        table = side.submit(lambda: broadcast_if_small(weight_table(rule_weights, features, dx_bits, strategies)))
        dx = summarise_diagnoses(diagnoses, patterns["dx"], features, dx_bits, lookups.obesity)
        frail = side.submit(lambda: co.frail_elderly(co.score_frailty(ip, apc, _scored(dx, features, len(patterns["dx"]), dx_bits, lookups.frailty))))
        px, by_hrg, table, frail = px.result(), by_hrg.result(), table.result(), frail.result()
    counts = {"dx": dx_bits, "px": len(patterns["px"]) + len(names)}

    any_year = px.groupBy("epikey").agg(F.flatten(F.collect_list("days")).alias("days"), F.lit(True).alias("_px_ever"))
    outcome = F.when(F.col("dismeth") == "4", "mortality").otherwise("morbidity")
    spells = (
        ip.join(dx, KEYS, "left")
        .join(px.drop("days").withColumn("_px_year", F.lit(True)), KEYS, "left")
        .join(any_year, "epikey", "left")
        .withColumns({"outcome": outcome, "weight_age": F.least(F.greatest("age", F.lit(-1)), F.lit(OLDEST))})
        .join(table, ["sex", "outcome", "weight_age"], "left")
    )
    spells = left_join_known(spells, by_hrg, ["sushrg"], spread_by="epikey")

    AVOID, EFFICIENT, ONE = F.lit("activity_avoidance"), F.lit("efficiency"), F.lit(1.0)
    member = lambda type, strategy, rate: F.struct(type.alias("type"), strategy.alias("strategy"), rate.alias("sample_rate"))
    found = [F.expr(_rule_sql(r, patterns, counts)) for r in listed]
    for k, strategy in enumerate(strategies):
        # weights are in falling order, so the first that counts is the highest
        held = F.filter(f"weights_{k}", lambda w: _is_set("dx", w["place"], w["bit"]))
        found.append(F.when(F.size(held) > 0, member(AVOID, F.lit(strategy), -F.get(held, F.lit(0))["minus"])))
    found.append(F.when(F.col("obesity").isNotNull(), member(AVOID, F.lit("obesity_related_admissions"), F.col("obesity"))))
    elective, emergency = F.col("admimeth").startswith("1"), F.col("admimeth").startswith("2")
    for k, name in enumerate(names):
        classes = ["1"] if name.endswith("dc") else ["1", "2"]
        listed_code = _is_set("px", *place_of("primary", F.lit(len(patterns["px"]) + k), counts["px"])) & elective & F.col("classpat").isin(classes)
        found.append(F.when(listed_code, member(EFFICIENT, F.lit(name), ONE)))
    for name, kind in (("elective", elective), ("emergency", emergency)):
        found.append(F.when(kind & (F.col("speldur") > F.col(name)), member(EFFICIENT, F.lit(f"excess_beddays_{name}"), ONE)))
    for wait in (1, 2):
        waited = F.exists("days", lambda d: (F.date_diff(d, F.col("admidate")) == wait) & (d <= F.col("disdate")))
        found.append(F.when(elective & waited, member(EFFICIENT, F.lit(f"pre-op_los_{wait}-day"), ONE)))
    shared = F.filter("entries", lambda e: _is_set("dx", e["place"], e["bit"]))
    levels = F.array_distinct(F.transform(shared, lambda e: e["level"]))
    same_day = F.when(F.expr(co.SDEC_SPELL), F.transform(levels, lambda x: member(EFFICIENT, co.sdec_strategy(x), ONE)))
    everything = F.concat(F.array_compact(F.array(*found)), F.coalesce(same_day, F.array().cast("array<struct<type:string,strategy:string,sample_rate:double>>")))
    tagged = spells.select(*co.MEMBER, F.inline(everything))

    return tagged.unionByName(frail).unionByName(co.readmissions(ip, apc))


def _scored(dx: DataFrame, features: DataFrame, begin: int, count: int, scores: DataFrame) -> DataFrame:
    """Distinct `(epikey, icd10, points)` of all records, from the bits of the scored codes."""
    codes = features.where("kind = 'scored'").select(F.col("pattern").alias("icd10"), "number")
    points = co.frailty_points(scores).join(codes, "icd10")
    held = F.filter(F.sequence(F.lit(begin).cast("long"), F.lit(count - 1).cast("long")), lambda n: _is_set("dx", *place_of("any", n, count)))
    numbers = dx.where(F.lit(count > begin)).select("epikey", F.explode(held).alias("number"))
    return numbers.join(points, "number").select("epikey", "icd10", "points").distinct()
