"""Cohort membership: rule registry, one-pass tagging, and the cohorts that need more than a rule."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions.expressions import counted_procedure, sql_literal
from cohortlake.functions.materialise import materialise
from cohortlake.functions.skew import broadcast_if_small, left_join_known
from cohortlake.operators.conditions import Condition, add_flags, expand_patterns
from cohortlake.operators.patterns import compiled, match_codes
from cohortlake.operators.records_ip import not_well_baby

MEMBER = ["fyear", "provider", "epikey"]
COHORT_COLUMNS = [*MEMBER, "type", "strategy", "sample_rate"]


class DuplicateCohortError(ValueError):
    """Two rules of one type have the same name."""


@dataclass(frozen=True)
class Rule:
    type: str
    strategy: str
    condition: Condition


class Rules:
    """Rules by type and name; a name is unique within its type."""

    def __init__(self, rules: Sequence[Rule] = ()) -> None:
        self._rules: dict[tuple[str, str], Rule] = {}
        for rule in rules:
            self.add(rule)

    def add(self, rule: Rule) -> None:
        if (rule.type, rule.strategy) in self._rules:
            raise DuplicateCohortError(f"{rule.strategy} ({rule.type})")
        self._rules[rule.type, rule.strategy] = rule

    def define(self, type: str, strategy: str | None = None) -> Callable:
        """Decorator for a function that returns a condition; its name is the default strategy."""

        def register(function: Callable[[], Condition]) -> Callable[[], Condition]:
            self.add(Rule(type, strategy or function.__name__.lstrip("_"), function()))
            return function

        return register

    def __iter__(self) -> Iterator[Rule]:
        return iter(self._rules.values())

    def __len__(self) -> int:
        return len(self._rules)

    def only(self, *strategies: str) -> Rules:
        return Rules([r for r in self if r.strategy in strategies])


def has(spells: DataFrame, diagnoses: DataFrame, procedures: DataFrame, condition: Condition) -> DataFrame:
    """Spells that meet a condition."""
    flagged = add_flags(spells, diagnoses, procedures, [condition], prefix="_has")
    return flagged.filter("_has0").drop("_has0")


def has_not(spells: DataFrame, diagnoses: DataFrame, procedures: DataFrame, condition: Condition) -> DataFrame:
    """Spells that do not meet a condition."""
    flagged = add_flags(spells, diagnoses, procedures, [condition], prefix="_has")
    return flagged.filter("NOT _has0").drop("_has0")


def tag(spells: DataFrame, diagnoses: DataFrame, procedures: DataFrame, rules: Rules) -> DataFrame:
    """Membership of every rule, from one scan of the spells and one of each code table."""
    listed = list(rules)
    flagged = add_flags(spells, diagnoses, procedures, [r.condition for r in listed])
    rows = [
        f"CASE WHEN _c{i} THEN struct({sql_literal(r.type)} AS type, {sql_literal(r.strategy)} AS strategy) END"
        for i, r in enumerate(listed)
    ]
    matched = F.expr(f"array_compact(array({', '.join(rows)}))")
    return flagged.select(*MEMBER, F.inline(matched)).withColumn("sample_rate", F.lit(1.0))


def members(df: DataFrame, type: str, strategy: str, rate: Column | float = 1.0) -> DataFrame:
    """Membership rows of one cohort from spells already chosen."""
    rate = rate if isinstance(rate, Column) else F.lit(float(rate))
    return df.select(*MEMBER, F.lit(type).alias("type"), F.lit(strategy).alias("strategy"), rate.alias("sample_rate"))


# --- cohorts with attributable fractions ---------------------------------------------------------


#: Layout of the alcohol fraction file: ages, and by group and family the conditions.
_FRACTIONS = "regex: string, male: array<double>, female: array<double>"
_CONDITION = f"struct<{_FRACTIONS}, mortality: struct<{_FRACTIONS}>, morbidity: struct<{_FRACTIONS}>>"
ALCOHOL_FILE = f"struct<ages: array<int>, data: map<string, map<string, map<string, {_CONDITION}>>>>"
SDEC_FILE = "map<string, map<string, struct<group: string, hrg_codes: array<string>, icd10_codes: array<string>>>>"


def alcohol_rules(text: DataFrame, group: str) -> DataFrame:
    """`(pattern, sex, outcome, low, high, rate)` of one group of the alcohol fraction file, given as a row with its JSON in `value`.

    A condition gives fractions by sex for the age bands listed in the file, either for all outcomes
    or separately for mortality and morbidity. Only fractions above 0 and up to 1 are kept. The last
    band has no upper age.
    """
    file = text.select(F.from_json("value", ALCOHOL_FILE).alias("file")).select("file.ages", F.element_at("file.data", group).alias("families"))
    conditions = file.select("ages", F.explode(F.map_values("families")).alias("family"))
    conditions = conditions.select("ages", F.explode(F.map_values("family")).alias("c"))
    apart = F.array(*[F.struct(F.lit(o).alias("outcome"), F.col(f"c.{o}").alias("entry")) for o in ("mortality", "morbidity")])
    alike = F.array(
        *[
            F.struct(F.lit(o).alias("outcome"), F.struct("c.regex", "c.male", "c.female").alias("entry"))
            for o in ("mortality", "morbidity")
        ]
    )
    entries = conditions.select("ages", F.explode(F.when(F.col("c.mortality").isNotNull(), apart).otherwise(alike)).alias("e"))
    by_sex = entries.select(
        "ages",
        "e.outcome",
        F.col("e.entry.regex").alias("pattern"),
        F.explode(F.create_map(F.lit("1"), F.col("e.entry.male"), F.lit("2"), F.col("e.entry.female"))).alias("sex", "rates"),
    )
    bands = by_sex.select("*", F.posexplode("rates").alias("band", "rate")).where("rate > 0 AND rate <= 1 AND band < size(ages)")
    return bands.select(
        "pattern",
        "sex",
        "outcome",
        F.get("ages", F.col("band")).alias("low"),
        (F.get("ages", F.col("band") + 1) - 1).alias("high"),
        "rate",
    )


def alcohol_partly(spells: DataFrame, diagnoses: DataFrame, rules: DataFrame, strategy: str) -> DataFrame:
    """Partly alcohol-attributable spells; the rate is the highest fraction of any diagnosis.

    Each matched code carries its few rules as an array, so the join is on the code alone and the age
    band, sex and outcome are tested on the array.
    """
    fractions = F.collect_list(F.struct("sex", "outcome", "low", "high", "rate")).alias("fractions")
    by_code = expand_patterns(diagnoses, "diagnosis", rules).groupBy("diagnosis").agg(fractions)
    applies = lambda f: (
        (f["sex"] == F.col("sex"))
        & (f["outcome"] == F.col("outcome"))
        & (F.col("age") >= f["low"])
        & (f["high"].isNull() | (F.col("age") <= f["high"]))
    )
    rate = F.array_max(F.transform(F.filter("fractions", applies), lambda f: f["rate"]))
    outcome = F.when(F.col("dismeth") == "4", "mortality").otherwise("morbidity")
    rated = (
        diagnoses.select("epikey", "fyear", "diagnosis")
        .join(broadcast_if_small(by_code), "diagnosis")
        .join(spells.select(*MEMBER, "age", "sex", outcome.alias("outcome")), ["epikey", "fyear"])
        .withColumn("rate", rate)
        .filter(F.col("rate").isNotNull())
        .groupBy(*MEMBER)
        .agg(F.max("rate").alias("rate"))
    )
    return members(rated, "activity_avoidance", strategy, F.col("rate"))


def _first_diagnoses(diagnoses: DataFrame) -> DataFrame:
    return diagnoses.filter(F.col("diag_order") == 1).select("epikey", "fyear", "diagnosis")


def obesity(spells: DataFrame, diagnoses: DataFrame, fractions: DataFrame) -> DataFrame:
    """Spells whose first diagnosis is listed; the rate is its fraction."""
    rated = spells.join(_first_diagnoses(diagnoses).join(fractions, "diagnosis"), ["epikey", "fyear"])
    return members(rated, "activity_avoidance", "obesity_related_admissions", F.col("fraction"))


def smoking(spells: DataFrame, diagnoses: DataFrame, rules: DataFrame) -> DataFrame:
    """Spells whose first diagnosis matches a pattern for their sex; the rate is the highest fraction."""
    first = _first_diagnoses(diagnoses)
    by_code = expand_patterns(first, "diagnosis", rules).groupBy("diagnosis", "sex").agg(F.max("rate").alias("rate"))
    by_code = broadcast_if_small(by_code)
    rated = (
        first.join(by_code, "diagnosis")
        .join(spells.select(*MEMBER, "sex"), ["epikey", "fyear", "sex"])
        .groupBy(*MEMBER)
        .agg(F.max("rate").alias("rate"))
    )
    return members(rated, "activity_avoidance", "smoking", F.col("rate"))


# --- cohorts that look at a person's other spells ------------------------------------------------

FRAILTY_DAYS = 730


def frailty_scores(spells: DataFrame, all_spells: DataFrame, diagnoses: DataFrame, scores: DataFrame) -> DataFrame:
    """Frailty score (times ten) of emergency spells at 75 or over: MEMBER columns and `score`.

    A scored three-character code counts once if the spell has it, or any spell of the person that
    ended in the 730 days before this admission. `all_spells` is the unfiltered table; `scores` has
    icd10 (three characters) and score.

    No pairs of spells are formed. The days on which a person's code counts are cut into intervals
    that do not overlap, each interval adds its score at its start and takes it off after its end,
    and one running sum per person gives the earlier score on any day. Codes of the spell itself are
    added where they are not already counted on that day.
    """
    points = frailty_points(scores)
    scored = (
        diagnoses.filter(F.length("diagnosis") > 3)
        .select("epikey", F.substring("diagnosis", 1, 3).alias("icd10"))
        .join(points, "icd10")
        .distinct()
    )
    return score_frailty(spells, all_spells, scored)


def frailty_points(scores: DataFrame) -> DataFrame:
    return scores.select("icd10", F.round(F.col("score") * 10).cast("int").alias("points"))


def score_frailty(spells: DataFrame, all_spells: DataFrame, scored: DataFrame) -> DataFrame:
    """As `frailty_scores`, from the scored codes of every spell: distinct `(epikey, icd10, points)`.

    No pairs of spells are formed. The days on which a person's code counts are cut into intervals
    that do not overlap, each interval adds its score at its start and takes it off after its end,
    and one running sum per person gives the earlier score on any day. Codes of the spell itself are
    added where they are not already counted on that day.
    """
    people = all_spells.filter(F.col("last_episode_in_spell") & F.col("person_id_deid").isNotNull()).select(
        "epikey", F.col("person_id_deid").alias("person_id"), "disdate"
    )
    coded = materialise(scored.join(people, "epikey"))

    ends = coded.select("person_id", "icd10", "points", F.unix_date("disdate").alias("day")).distinct()
    following = Window.partitionBy("person_id", "icd10").orderBy("day")
    last = F.least(F.col("day") + FRAILTY_DAYS, F.lead("day").over(following))
    intervals = ends.withColumn("last", last)
    change = intervals.select("person_id", (F.col("day") + 1).alias("day"), "points").unionByName(
        intervals.select("person_id", (F.col("last") + 1).alias("day"), (-F.col("points")).alias("points"))
    )

    targets = spells.filter(
        F.col("admimeth").startswith("2") & (F.col("age") >= 75) & F.col("person_id").isNotNull()
    ).select(*MEMBER, "person_id", F.unix_date("admidate").alias("day"))
    days = targets.select("person_id", "day", F.lit(0).alias("points"))
    running = Window.partitionBy("person_id").orderBy("day")
    earlier = (
        change.unionByName(days)
        .groupBy("person_id", "day")
        .agg(F.sum("points").alias("points"))
        .select("person_id", "day", F.sum("points").over(running).alias("earlier"))
    )

    own = targets.join(coded.select("epikey", "person_id", "icd10", "points"), ["epikey", "person_id"])
    seen_days = (
        ends.select("person_id", "icd10", "day", F.lit(True).alias("ended"))
        .unionByName(own.select("person_id", "icd10", "day", F.lit(False).alias("ended")))
        .groupBy("person_id", "icd10", "day")
        .agg(F.bool_or("ended").alias("ended"))
    )
    before = Window.partitionBy("person_id", "icd10").orderBy("day").rangeBetween(-FRAILTY_DAYS, -1)
    counted = seen_days.withColumn("counted", F.coalesce(F.bool_or("ended").over(before), F.lit(False)))
    added = (
        own.join(counted.select("person_id", "icd10", "day", "counted"), ["person_id", "icd10", "day"])
        .filter(~F.col("counted"))
        .groupBy("epikey")
        .agg(F.sum("points").alias("added"))
    )
    total = F.coalesce("earlier", F.lit(0)) + F.coalesce("added", F.lit(0))
    return (
        targets.join(earlier, ["person_id", "day"], "left")
        .join(added, "epikey", "left")
        .select(*MEMBER, total.alias("score"))
        .filter(F.col("score") != 0)
    )


def frail_elderly(scores: DataFrame) -> DataFrame:
    """Intermediate (50 to 150) and high (above 150) frailty."""
    level = F.when(F.col("score") > 150, "high").when(F.col("score") >= 50, "intermediate")
    return (
        scores.withColumn("_level", level)
        .filter(F.col("_level").isNotNull())
        .select(
            *MEMBER,
            F.lit("activity_avoidance").alias("type"),
            F.concat(F.lit("frail_elderly_"), "_level").alias("strategy"),
            F.lit(1.0).alias("sample_rate"),
        )
    )


def readmissions(spells: DataFrame, all_spells: DataFrame, days: int = 28) -> DataFrame:
    """Emergency spells within `days` of an earlier discharge of the same person.

    The other spell must have been admitted or discharged before this one. As the discharge must not
    be after this admission, that holds for some spell in the window if the earliest discharge is
    before this discharge, or the earliest admission is before this admission; so two minima per
    person and day decide, and no pairs of spells are formed.
    """
    others = not_well_baby(all_spells.filter(F.col("last_episode_in_spell") & F.col("person_id_deid").isNotNull()))
    left = others.select(
        F.col("person_id_deid").alias("person_id"),
        F.unix_date("disdate").alias("day"),
        F.unix_date("disdate").alias("out"),
        F.unix_date("admidate").alias("into"),
    )
    targets = spells.filter(F.col("admimeth").startswith("2")).select(
        *MEMBER, "person_id", F.unix_date("admidate").alias("day"), F.unix_date("disdate").alias("_out")
    )
    asked = targets.filter(F.col("person_id").isNotNull()).select(
        "person_id", "day", F.lit(None).cast("int").alias("out"), F.lit(None).cast("int").alias("into")
    )
    daily = left.unionByName(asked).groupBy("person_id", "day").agg(F.min("out").alias("out"), F.min("into").alias("into"))
    window = Window.partitionBy("person_id").orderBy("day").rangeBetween(-days, 0)
    recent = daily.select(
        "person_id", "day", F.min("out").over(window).alias("first_out"), F.min("into").over(window).alias("first_into")
    )
    found = left_join_known(targets, recent, ["person_id", "day"], spread_by="epikey").filter(
        (F.col("first_out") < F.col("_out")) | (F.col("first_into") < F.col("day"))
    )
    return members(found, "activity_avoidance", "readmission_within_28_days")


# --- efficiency cohorts with lookups -------------------------------------------------------------


def day_procedures(spells: DataFrame, procedures: DataFrame, codes: DataFrame) -> DataFrame:
    """Elective spells whose first procedure is listed as done in another setting.

    `codes` has strategy and procedure_code; a listed code also covers longer codes that start with it.
    """
    first = procedures.filter(F.col("procedure_order") == 1).select("epikey", "fyear", "procedure_code")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.length("procedure_code")), lambda n: F.substring(F.col("procedure_code"), 1, n)
    )
    covered = (
        first.select("procedure_code")
        .filter(F.length("procedure_code") > 0)
        .distinct()
        .withColumn("_prefix", F.explode(prefixes))
        .join(codes.select("strategy", F.col("procedure_code").alias("_prefix")), "_prefix")
        .select("procedure_code", "strategy")
        .distinct()
    )
    classes = F.when(F.col("strategy").endswith("dc"), F.col("classpat") == "1").otherwise(
        F.col("classpat").isin("1", "2")
    )
    return (
        spells.filter(F.col("admimeth").startswith("1"))
        .join(first.join(broadcast_if_small(covered), "procedure_code"), ["epikey", "fyear"])
        .filter(classes)
        .select(*MEMBER, F.lit("efficiency").alias("type"), "strategy", F.lit(1.0).alias("sample_rate"))
        .distinct()
    )


def excess_beddays(spells: DataFrame, trimpoints: DataFrame) -> DataFrame:
    """Spells longer than the trim point of their HRG, elective and emergency."""
    kind = F.when(F.col("admimeth").startswith("1"), "elective").when(F.col("admimeth").startswith("2"), "emergency")
    limit = F.when(F.col("_kind") == "elective", F.col("elective")).otherwise(F.col("emergency"))
    return (
        spells.withColumn("_kind", kind)
        .filter(F.col("_kind").isNotNull())
        .join(trimpoints.select("sushrg", "elective", "emergency"), "sushrg")
        .filter(F.col("speldur") > limit)
        .select(
            *MEMBER,
            F.lit("efficiency").alias("type"),
            F.concat(F.lit("excess_beddays_"), "_kind").alias("strategy"),
            F.lit(1.0).alias("sample_rate"),
        )
    )


def preop_los(spells: DataFrame, procedures: DataFrame, day: str = "procedure_date") -> DataFrame:
    """Elective spells whose first procedure was one or two days after admission, within the stay."""
    first = procedures.filter((F.col("procedure_order") == 1) & counted_procedure(F.col("procedure_code")))
    waited = F.date_diff(F.col(day), F.col("admidate"))
    name = F.when(waited == 1, "pre-op_los_1-day").when(waited == 2, "pre-op_los_2-day")
    return (
        spells.filter(F.col("admimeth").startswith("1"))
        .join(first.select("epikey", day), "epikey")
        .filter((F.col(day) >= F.col("admidate")) & (F.col(day) <= F.col("disdate")))
        .withColumn("strategy", name)
        .filter(F.col("strategy").isNotNull())
        .select(*MEMBER, F.lit("efficiency").alias("type"), "strategy", F.lit(1.0).alias("sample_rate"))
        .distinct()
    )


def sdec_rules(text: DataFrame) -> DataFrame:
    """`(level, hrg, icd10)` of the same-day care directory, given as a row with its JSON in `value`: whole-code patterns."""
    whole = lambda codes: F.concat(F.lit("^("), F.array_join(codes, "|"), F.lit(")$"))
    specialties = text.select(F.explode(F.map_values(F.from_json("value", SDEC_FILE))).alias("specialty"))
    entries = specialties.select(F.explode(F.map_values("specialty")).alias("c"))
    return entries.select(
        F.col("c.group").alias("level"), whole(F.col("c.hrg_codes")).alias("hrg"), whole(F.col("c.icd10_codes")).alias("icd10")
    )


def sdec_strategy(level: Column) -> Column:
    return F.concat(F.lit("same_day_emergency_care_"), F.replace(level, F.lit(" "), F.lit("_")))


SDEC_SPELL = "age >= 18 AND rlike(admimeth, '^2[123]') AND speldur <= 2"


def same_day_emergency_care(spells: DataFrame, diagnoses: DataFrame, rules: DataFrame) -> DataFrame:
    """Short emergency stays of adults whose HRG and first diagnosis are in one directory entry.

    Both codes are mapped to the directory's distinct patterns; an entry is a pair of them.
    """
    first = _first_diagnoses(diagnoses)
    short = spells.where(SDEC_SPELL).select(*MEMBER, "sushrg")
    by_hrg = expand_patterns(short, "sushrg", rules, "hrg").groupBy("sushrg")
    by_hrg = by_hrg.agg(F.collect_set(F.struct("level", "icd10")).alias("entries"))  # as many as there are entries at most
    by_code = match_codes(first, "diagnosis", compiled(rules, "icd10")).groupBy("diagnosis")
    by_code = by_code.agg(F.collect_set("pattern").alias("patterns"))
    shared = F.filter("entries", lambda e: F.array_contains(F.col("patterns"), e["icd10"]))
    both = (
        short.join(broadcast_if_small(by_hrg), "sushrg")
        .join(first, ["epikey", "fyear"])
        .join(broadcast_if_small(by_code), "diagnosis")
        .select(*MEMBER, F.explode(F.array_distinct(F.transform(shared, lambda e: e["level"]))).alias("level"))
    )
    named = both.select(*MEMBER, sdec_strategy(F.col("level")).alias("strategy")).distinct()
    return named.select(*MEMBER, F.lit("efficiency").alias("type"), "strategy", F.lit(1.0).alias("sample_rate"))


# --- merge into a stored table -------------------------------------------------------------------

MERGE_KEY = ["fyear", "provider", "epikey", "type", "strategy"]


def merge_cohorts(stored: DataFrame, current: DataFrame, recomputed: Sequence[tuple[str, str]] | None) -> DataFrame:
    """New state of the stored memberships after recomputing some cohorts.

    `recomputed` lists the (type, strategy) pairs that `current` holds, also those it holds no row
    of; None means all cohorts. `action` says what happened to each row: insert, update (the rate changed), keep, or delete
    (a row of a recomputed cohort that is gone). Rows of other cohorts are kept. Write the rows that
    are not deleted.
    """
    replaced = reduce(
        lambda a, b: a | b,
        [(F.col("type") == kind) & (F.col("strategy") == name) for kind, name in recomputed or ()],
        F.lit(recomputed is None),
    )
    old = stored.select(*MERGE_KEY, F.col("sample_rate").alias("_old"), F.lit(True).alias("_stored"))
    new = current.select(*MERGE_KEY, "sample_rate", F.lit(True).alias("_current"))
    action = (
        F.when(F.col("_stored").isNull(), "insert")
        .when(F.col("_current").isNull(), F.when(replaced, "delete").otherwise("keep"))
        .when(F.col("_old") != F.col("sample_rate"), "update")
        .otherwise("keep")
    )
    return old.join(new, MERGE_KEY, "full").select(
        *MERGE_KEY, F.coalesce("sample_rate", "_old").alias("sample_rate"), action.alias("action")
    )
