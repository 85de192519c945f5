"""Code patterns as data: each becomes a set of literal prefixes with classes after them, joined by equality.

A pattern over codes is anchored at their start. It is taken apart into sequences of character classes
(`S(22[01]|32)` is S-2-2-01 and S-3-2). The first classes of a sequence are multiplied out into literal
keys, which meet the prefixes of the distinct codes in an equi-join: the keys and prefixes of one length
are one level of the trie of all patterns. The classes that are left are tested on the rows that meet, so neither
the plan nor the number of tests per code grows with the rules. What can't be taken apart (repetition of
anything but any character, look-around, back references) has an empty key and is tested as it is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of a key at most, and keys that one sequence is multiplied out to at most.
KEY_LENGTH = 3
KEYS_PER_SEQUENCE = 256
#: Sequences that a pattern may have before it counts as one that can't be taken apart.
SEQUENCES = 4096
COMPILED = "pattern string, key string, rest array<string>, open boolean, regex string"

ANY, START, END, TAIL = "", "\x02start", "\x02end", "\x02tail"


class NotFinite(ValueError):
    """The pattern has no finite set of class sequences."""


class _Reader:
    """Reads a pattern into its sequences: tuples of classes (characters, `^` and characters, or any) and marks."""

    def __init__(self, text: str) -> None:
        self.text, self.at = text, 0

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1 : self.at]

    def choice(self) -> list[tuple[str, ...]]:
        found = self.sequence()
        while self.peek() == "|":
            self.take()
            found = found + self.sequence()
        return _bounded(found)

    def sequence(self) -> list[tuple[str, ...]]:
        found: list[tuple[str, ...]] = [()]
        while self.peek() not in ("", "|", ")"):
            low, high, part = self.repeated(self.item())
            longer = [()]
            for _ in range(low):
                longer = _bounded(a + b for a in longer for b in part)
            if high is None:
                longer = [s + (TAIL,) for s in longer]
            else:
                last = longer
                for _ in range(high - low):
                    last = _bounded(a + b for a in last for b in part)
                    longer = _bounded(longer + last)
            found = _bounded(a + b for a in found for b in longer)
        return found

    def item(self) -> list[tuple[str, ...]]:
        match self.take():
            case "(":
                if self.peek() == "?":
                    if self.text[self.at : self.at + 2] != "?:":
                        raise NotFinite(self.text)
                    self.at += 2
                found = self.choice()
                if self.take() != ")":
                    raise NotFinite(self.text)
                return found
            case "[":
                return [(self.members(),)]
            case ".":
                return [(ANY,)]
            case "^":
                return [(START,)]
            case "$":
                return [(END,)]
            case "\\":
                return [(self.escaped(),)]
            case "*" | "+" | "?" | "{":
                raise NotFinite(self.text)
            case c:
                return [(c,)]

    def escaped(self) -> str:
        c = self.take()
        if c == "d":
            return "0123456789"
        if not c or c.isalnum():
            raise NotFinite(self.text)
        return c

    def members(self) -> str:
        negated = self.peek() == "^"
        if negated:
            self.take()
        found = ""
        while True:
            c = self.take()
            if c in ("", "[", "&"):
                raise NotFinite(self.text)
            if c == "]" and found:
                break
            c = self.escaped() if c == "\\" else c
            if self.peek() == "-" and self.text[self.at + 1 : self.at + 2] not in ("]", ""):
                self.take()
                last = self.take()
                if last in ("\\", "[") or len(c) != 1:
                    raise NotFinite(self.text)
                c = "".join(map(chr, range(ord(c), ord(last) + 1)))
            found += c
        return "^" * negated + "".join(sorted(set(found)))

    def repeated(self, part: list[tuple[str, ...]]) -> tuple[int, int | None, list[tuple[str, ...]]]:
        low, high = 1, 1
        match self.peek():
            case "?":
                low, high = 0, 1
            case "*":
                low, high = 0, None
            case "+":
                low, high = 1, None
            case "{":
                bounds = self.text[self.at + 1 :].split("}")[0].split(",")
                if not all(b.isdigit() for b in bounds if b) or not bounds[0] or len(bounds) > 2:
                    raise NotFinite(self.text)
                low = int(bounds[0])
                high = low if len(bounds) == 1 else int(bounds[1]) if bounds[1] else None
                self.at = self.text.index("}", self.at)
            case _:
                return low, high, part
        self.take()
        if high is None and part != [(ANY,)]:
            raise NotFinite(self.text)
        if self.peek() in ("?", "+"):
            self.take()  # lazy or possessive: the same codes match, but for what possessive items keep
            if self.text[self.at - 1] == "+":
                raise NotFinite(self.text)
        return low, high, part


def _bounded(found: Iterable[tuple[str, ...]]) -> list[tuple[str, ...]]:
    out = list(dict.fromkeys(found))
    if len(out) > SEQUENCES:
        raise NotFinite
    return out


def sequences(pattern: str) -> Iterator[tuple[tuple[str, ...], bool]]:
    """`(classes, open)` of a pattern: codes that start with one character of each class, and end there unless open."""
    reader = _Reader(pattern)
    found = reader.choice()
    if reader.peek():
        raise NotFinite(pattern)
    for marked in found:
        classes, is_open, possible = [], True, True
        for k, c in enumerate(marked):
            if c == START:
                possible &= not classes and TAIL not in marked[:k]
            elif c == END:
                is_open = is_open and TAIL in marked[:k]
                possible &= all(x == END for x in marked[k:])
            elif c == TAIL:
                if any(x not in (END, TAIL) for x in marked[k:]):
                    raise NotFinite(pattern)
            else:
                classes.append(c)
        if possible:
            yield tuple(classes), is_open


def compile_pattern(pattern: str) -> list[tuple[str, str, list[str], bool, str | None]]:
    """Rows of `COMPILED` for one pattern."""
    try:
        found = list(sequences(pattern))
    except NotFinite:
        return [(pattern, "", [], True, f"^({pattern})")]
    rows: dict[tuple, tuple] = {}
    for classes, is_open in found:
        size, keys = 0, 1
        for c in classes[:KEY_LENGTH]:
            if c == ANY or (len(c) > 1 and c[0] == "^") or keys * len(c) > KEYS_PER_SEQUENCE:
                break
            size, keys = size + 1, keys * len(c)
        rest = list(classes[size:])
        for key in map("".join, product(*classes[:size])):
            rows[key, tuple(rest), is_open] = (pattern, key, rest, is_open, None)
    return list(rows.values())


def _batch(patterns: Iterable[str]) -> pa.RecordBatch:
    rows = [row for p in patterns for row in compile_pattern(p)]
    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.bool_(), pa.string()]
    arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=["pattern", "key", "rest", "open", "regex"])


def compiled(rules: DataFrame, pattern: str = "pattern") -> DataFrame:
    """The distinct patterns of a rule table taken apart. Null patterns match nothing."""

    def run(batches):
        for batch in batches:
            yield _batch(batch.column(0).to_pylist())

    wanted = rules.select(F.col(pattern).alias("pattern")).where(F.col("pattern").isNotNull()).distinct()
    return wanted.mapInArrow(run, COMPILED)


def compiled_list(spark: SparkSession, patterns: Sequence[str]) -> DataFrame:
    """The patterns of rules that are written in the source, taken apart."""
    return spark.createDataFrame(pa.Table.from_batches([_batch(dict.fromkeys(patterns))]))


def literal_prefixes(rules: DataFrame, prefix: Column, longer_by: int = 0) -> DataFrame:
    """`COMPILED` columns, and those of `rules`, for codes that start with a literal and have `longer_by` characters more at least."""
    letters = F.filter(F.split(F.substring(prefix, KEY_LENGTH + 1, 1000), ""), lambda c: c != "")
    return rules.select(
        "*",
        F.substring(prefix, 1, KEY_LENGTH).alias("key"),
        F.concat(letters, F.array_repeat(F.lit(ANY), longer_by)).alias("rest"),
        F.lit(True).alias("open"),
        F.lit(None).cast("string").alias("regex"),
    )


_CLASS_HOLDS = """
CASE WHEN c = '' THEN true
     WHEN length(c) > 1 AND startswith(c, '^') THEN instr(substr(c, 2), substr({code}, length(key) + i + 1, 1)) = 0
     ELSE instr(c, substr({code}, length(key) + i + 1, 1)) > 0 END
"""


def match_codes(codes: DataFrame, code: str, matchers: DataFrame) -> DataFrame:
    """Distinct codes with the other columns of every row of `matchers` (`key, rest, open, regex`, ...) that they match.

    Null codes match nothing. A code that matches several rows with equal other columns has one row for each.
    """
    kept = [c for c in matchers.columns if c not in ("key", "rest", "open", "regex")]
    size = F.length("_code")
    prefixes = F.transform(F.sequence(F.lit(0), F.least(size, F.lit(KEY_LENGTH))), lambda n: F.substring(F.col("_code"), F.lit(1), n))
    asked = codes.select(F.col(code).alias("_code")).where(F.col("_code").isNotNull()).distinct()
    asked = asked.withColumn("key", F.explode(prefixes))
    needed = F.length("key") + F.size("rest")
    fits = F.when(F.col("open"), size >= needed).otherwise(size == needed)
    holds = F.expr(f"forall(transform(rest, (c, i) -> {_CLASS_HOLDS.format(code='_code')}), b -> b)")
    tested = F.col("regex").isNull() | F.expr("rlike(_code, regex)")
    return asked.join(matchers, "key").where(fits & holds & tested).select(F.col("_code").alias(code), *kept)
