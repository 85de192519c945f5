"""Cohort conditions as data, and their evaluation in one pass over the coded records.

A condition is a small tree. `Has` asks for a diagnosis or procedure that matches a pattern in a
position (any, primary, secondary); `Where` is a predicate on the spell's own columns.

All `Has` leaves of all rules are evaluated together. Patterns are taken apart and joined with the
distinct codes, not with the records; matches become bits, and a record's codes are or-ed into a few long columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions.expressions import starts_with_any
from cohortlake.functions.skew import broadcast_if_small
from cohortlake.operators.patterns import compiled, compiled_list, match_codes

BITS = 62
KEYS = ["epikey", "fyear"]


@dataclass(frozen=True)
class Has:
    """A code of `kind` ('dx' or 'px') in `position` starts with one of the patterns."""

    kind: str
    position: str
    pattern: str


@dataclass(frozen=True)
class NoProcedure:
    """No procedure recorded in the spell; `same_year` also matches on the year of the record."""

    same_year: bool = True


@dataclass(frozen=True)
class Where:
    """Predicate on spell columns, as SQL."""

    sql: str


@dataclass(frozen=True)
class Not:
    part: Condition


@dataclass(frozen=True)
class All:
    parts: tuple[Condition, ...]


@dataclass(frozen=True)
class AnyOf:
    parts: tuple[Condition, ...]


type Condition = Has | NoProcedure | Where | Not | All | AnyOf


def _has(kind: str, position: str):
    return lambda *codes: Has(kind, position, starts_with_any(*codes))


any_dx, primary_dx, secondary_dx = (_has("dx", p) for p in ("any", "primary", "secondary"))
any_px, primary_px, secondary_px = (_has("px", p) for p in ("any", "primary", "secondary"))


def all_of(*parts: Condition) -> All:
    return All(parts)


def any_of(*parts: Condition) -> AnyOf:
    return AnyOf(parts)


def no(part: Condition) -> Not:
    return Not(part)


def leaves(condition: Condition) -> Iterable[Condition]:
    match condition:
        case Not(part):
            yield from leaves(part)
        case All(parts) | AnyOf(parts):
            for part in parts:
                yield from leaves(part)
        case _:
            yield condition


def expand_patterns(codes: DataFrame, code: str, rules: DataFrame, pattern: str = "pattern") -> DataFrame:
    """Each distinct code with the other fields of every rule whose anchored pattern it matches.

    Codes meet the patterns' literal keys by equality, see `patterns`; the rules stay a table.
    """
    matched = match_codes(codes, code, compiled(rules, pattern)).distinct()
    return matched.withColumnRenamed("pattern", pattern).join(rules, pattern).drop(pattern)


def groups_of(count: int) -> range:
    """Numbers of the long columns that hold `count` bits."""
    return range((count + BITS - 1) // BITS)


def fold_bits(matched: DataFrame, code: str, count: int, number: str = "number") -> DataFrame:
    """A row for each code, with bit i of columns m0, m1, ... set for each of its numbers i."""
    bit = F.expr(f"shiftleft(1L, cast({number} % {BITS} as int))")
    masks = [
        F.coalesce(F.bit_or(F.when(F.floor(F.col(number) / BITS) == g, bit)), F.lit(0).cast("long")).alias(f"m{g}")
        for g in groups_of(count)
    ]
    return matched.groupBy(code).agg(*masks)


def numbered_patterns(spark: SparkSession, patterns: Sequence[str]) -> DataFrame:
    """The patterns taken apart, with the place of each in the list as `number`."""
    numbers = spark.createDataFrame(pa.table({"pattern": pa.array(patterns, pa.string()), "number": pa.array(range(len(patterns)), pa.int64())}))
    return compiled_list(spark, patterns).join(numbers, "pattern").drop("pattern")


def code_masks(codes: DataFrame, code: str, patterns: Sequence[str]) -> DataFrame:
    """Distinct codes that match at least one pattern, with bit i of columns m0, m1, ... for pattern i."""
    matched = match_codes(codes, code, numbered_patterns(codes.sparkSession, patterns))
    return fold_bits(matched, code, len(patterns))


def position_masks(order: str, count: int, prefix: str, positions: Sequence[str] = ("any", "primary", "secondary")) -> list[Column]:
    """Aggregates of the bits of a record's codes: of all, of those of order 1, and of those of a higher order."""
    chosen = {"any": F.lit(True), "primary": F.col(order) == 1, "secondary": F.col(order) > 1}
    return [
        F.bit_or(F.when(chosen[p], F.col(f"m{g}"))).alias(f"{prefix}_{p}_{g}") for g in groups_of(count) for p in positions
    ]


def _record_masks(children: DataFrame, code: str, order: str, kind: str, patterns: Sequence[str]) -> DataFrame:
    """Per record: the bits matched by any, primary (order 1) and secondary (order > 1) codes."""
    masks = broadcast_if_small(code_masks(children, code, patterns))
    totals = position_masks(order, len(patterns), kind)
    return children.select(*KEYS, code, order).join(masks, code).groupBy(*KEYS).agg(*totals)


def patterns_of(conditions: Sequence[Condition], kind: str) -> list[str]:
    """The distinct patterns of one kind of code, in order of appearance; a pattern's place is its bit."""
    needed = (leaf for c in conditions for leaf in leaves(c))
    return list(dict.fromkeys(leaf.pattern for leaf in needed if isinstance(leaf, Has) and leaf.kind == kind))


def render(condition: Condition, patterns: Mapping[str, Sequence[str]], bit: Callable[[str, str, int], str]) -> str:
    """A condition as SQL over a spell's columns and the marks `_px_year` and `_px_ever`; `bit` tests a pattern by kind, position and number."""
    match condition:
        case Has(kind, position, pattern):
            return bit(kind, position, patterns[kind].index(pattern))
        case NoProcedure(same_year):
            return f"({'_px_year' if same_year else '_px_ever'} IS NULL)"
        case Where(sql):
            return f"({sql})"
        case Not(part):
            return f"(NOT {render(part, patterns, bit)})"
        case All(parts):
            return "(" + " AND ".join(render(p, patterns, bit) for p in parts) + ")"
        case AnyOf(parts):
            return "(" + " OR ".join(render(p, patterns, bit) for p in parts) + ")"
    raise TypeError(condition)


def _column_bit(kind: str, position: str, number: int) -> str:
    return f"((coalesce({kind}_{position}_{number // BITS}, 0L) & {1 << number % BITS}L) != 0L)"


def add_flags(
    spells: DataFrame, diagnoses: DataFrame, procedures: DataFrame, conditions: Sequence[Condition], prefix: str = "_c"
) -> DataFrame:
    """Boolean columns `_c0`, `_c1`, ... with the value of each condition for each spell."""
    needed = list(dict.fromkeys(leaf for c in conditions for leaf in leaves(c)))
    patterns = {kind: patterns_of(conditions, kind) for kind in ("dx", "px")}
    df = spells
    added: list[str] = []
    if patterns["dx"]:
        masks = _record_masks(diagnoses, "diagnosis", "diag_order", "dx", patterns["dx"])
        added += [c for c in masks.columns if c not in KEYS]
        df = df.join(masks, KEYS, "left")
    if patterns["px"]:
        masks = _record_masks(procedures, "procedure_code", "procedure_order", "px", patterns["px"])
        added += [c for c in masks.columns if c not in KEYS]
        df = df.join(masks, KEYS, "left")
    if NoProcedure(True) in needed:
        df = df.join(procedures.select(*KEYS).distinct().withColumn("_px_year", F.lit(True)), KEYS, "left")
        added.append("_px_year")
    if NoProcedure(False) in needed:
        df = df.join(procedures.select("epikey").distinct().withColumn("_px_ever", F.lit(True)), "epikey", "left")
        added.append("_px_ever")

    flags = [F.expr(f"coalesce({render(c, patterns, _column_bit)}, false)").alias(f"{prefix}{i}") for i, c in enumerate(conditions)]
    return df.select(*spells.columns, *flags)
