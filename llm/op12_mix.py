"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

The words of a source, its documents in an order by hash, are cut into blocks of equal size, and a keyed
permutation orders the blocks. A source's quota is its target in blocks: whole rounds over the
permutation, then its beginning, the last block cut so that the words taken are the target itself.
The tree splits the quotas of all sources among the output shards: each node draws how many blocks of
each source go to its left half, as if blocks were dealt without replacement. A leaf owns, for each
source, an interval of the permuted blocks; the intervals are disjoint and use up the quota. Which
shard a block goes to is therefore known from its position alone: no block is ever listed or moved to
be drawn. Within a shard, blocks are ordered by a hash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.frames import materialise, own, table
from llm.text import mix, weigh, words

WEIGHTS = (5, 2, 1)
#: A target is at most so many times its source's size.
REPEATS = 3
#: Words in a block, fewer in sources of under LEAST_BLOCKS blocks, more where there would be over MOST_BLOCKS in all.
BLOCK_WORDS = 4096
LEAST_BLOCKS = 1024
MOST_BLOCKS = 1 << 27
#: Words in an output shard, unless sources x shards passes the bound of the table that every task gets (32 MB).
SHARD_WORDS = 1 << 24
MOST_QUOTAS = 1 << 22
BATCH_BYTES = 8 << 20
PIECE = "array<struct<shard:bigint,place:bigint,at:bigint,first:bigint,end:bigint>>"

_ODD = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS) -> list[Fraction]:
    """Shares of the sum of `sizes` by weight, none above `REPEATS` times its size; what is cut off is shared out again by weight."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    left, open_weight = Fraction(sum(sizes)), sum(weight)
    out = [Fraction(0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: Fraction(sizes[i], weight[i])):
        # those that reach their limit first come first, so what is left only grows for the rest
        out[i] = min(Fraction(REPEATS * sizes[i]), left * weight[i] / open_weight)
        left -= out[i]
        open_weight -= weight[i]
    return out


@dataclass
class Plan:
    """What every task needs to know of the sources, by their number."""

    block: np.ndarray  #: words in a block
    blocks: np.ndarray
    rounds: np.ndarray  #: whole rounds over all blocks
    extra: np.ndarray  #: blocks of the last round that are drawn
    last: np.ndarray  #: words taken of the last of them
    seed: np.ndarray
    bounds: np.ndarray  #: shard j has the draws bounds[source, j]:bounds[source, j + 1]


def make_plan(sizes: list[int], quotas: list[int], seed: int, shards: int | None, block_words: int) -> Plan:
    size, quota = np.array(sizes, np.int64), np.array(quotas, np.int64)
    total = int(size.sum())
    most = max(block_words, -(-total // MOST_BLOCKS))
    block = np.clip(size // LEAST_BLOCKS, 1, most)
    blocks = -(-size // block)
    rounds = np.where(size > 0, quota // np.maximum(size, 1), 0)
    rest = quota - rounds * size
    keys = np.array([(seed * _ODD + 2 * i + 1) & _ALL for i in range(len(sizes))], np.uint64)
    keys = mix(keys)
    # only a source's last block may be short, so it matters whether that comes before the last draw
    short = blocks * block - size
    place = permute(np.maximum(blocks - 1, 0), np.maximum(blocks, 1), keys)
    extra = -(-rest // block)
    extra = np.where((extra > place) & (extra * block - short < rest), -(-(rest + short) // block), extra)
    before = (extra - 1) * block - np.where(place < extra - 1, short, 0)
    last = np.where(extra > 0, rest - before, 0)
    draws = rounds * blocks + extra
    if shards is None:
        shards = max(1, min(-(-int(quota.sum()) // SHARD_WORDS), MOST_QUOTAS // max(1, len(sizes))))
    leaves = split(draws, shards, seed)
    bounds = np.concatenate([np.zeros((len(sizes), 1), np.int64), np.cumsum(leaves, axis=1)], axis=1)
    return Plan(block, blocks, rounds, extra, last, keys, bounds)


def split(draws: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """How many draws of each source each shard gets: a line for each source. Shards differ by one draw at most for each level."""
    out = np.zeros((len(draws), shards), np.int64)
    nodes = [(0, shards, draws)]
    while nodes:
        low, high, counts = nodes.pop()
        if high - low == 1:
            out[:, low] = counts
            continue
        middle = (low + high) // 2
        share = int(counts.sum()) * (middle - low) // (high - low)
        rng = np.random.default_rng([seed, low, high])
        left = rng.multivariate_hypergeometric(counts, share, method="marginals") if len(counts) else counts
        nodes += [(low, middle, left), (middle, high, counts - left)]
    return out


def permute(x: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of each x < n in a permutation of 0..n-1 that `key` selects: a Feistel network, walked until it falls below n."""
    bits = np.ceil(np.log2(np.maximum(n, 2)) / 2).astype(np.uint64)
    bits = np.where((np.uint64(1) << (2 * bits)) < n.astype(np.uint64), bits + np.uint64(1), bits)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out = x.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> bits[todo], out[todo] & mask[todo]
        for r in range(4):
            left, right = right, left ^ (mix(right + key[todo] + np.uint64((r * _ODD) & _ALL)) & mask[todo])
        out[todo] = (left << bits[todo]) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def ranges(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each of `count` entries, and the entry's number in its row."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)


def draw(plan: Plan, source: np.ndarray, at: np.ndarray, size: np.ndarray) -> dict[str, np.ndarray]:
    """The pieces taken of documents that begin at word `at` of their source: document, shard, place, words first to end."""
    block = plan.block[source]
    count = np.where(size > 0, (at + size - 1) // block - at // block + 1, 0)
    row, k = ranges(count)
    number = at[row] // block[row] + k
    of = source[row]
    place = permute(number, plan.blocks[of], plan.seed[of])
    times = plan.rounds[of] + (place < plan.extra[of])
    part, turn = ranges(times)
    row, of, number, place = row[part], of[part], number[part], place[part]
    nth = turn * plan.blocks[of] + place
    first = np.maximum(number * block[row], at[row])
    stop = (number + 1) * block[row]
    cut = (turn == plan.rounds[of]) & (place == plan.extra[of] - 1)
    stop = np.where(cut, number * block[row] + plan.last[of], stop)
    end = np.minimum(stop, at[row] + size[row])
    some = end > first
    row, of, nth, first, end = row[some], of[some], nth[some], first[some], end[some]
    shard = np.zeros(len(row), np.int64)
    for s in np.unique(of).tolist():
        mine = of == s
        shard[mine] = np.searchsorted(plan.bounds[s], nth[mine], side="right") - 1
    return {
        "row": row,
        "shard": shard,
        "place": mix(plan.seed[of] + nth.astype(np.uint64) * np.uint64(_ODD)).view(np.int64),
        "at": first,
        "first": first - at[row],
        "end": end - at[row],
    }


@dataclass
class Names:
    """Columns that are added to the documents."""

    size: str
    source_size: str
    target: str
    number: str
    at: str


def _placed(docs: DataFrame, doc_id: str, text: str, source: str, seed: int, shards: int | None, block_words: int, names: Names):
    """`docs` with their size, source and first word's place in the source, and the plan."""
    spark = docs.sparkSession
    absent, src, tie, bucket, start = own("absent", "src", "tie", "bucket", "start")
    sized = docs.withColumns(
        {
            names.size: F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long"),
            absent: F.col(f"`{source}`").isNull(),
            src: F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")),
            tie: F.xxhash64(F.col(f"`{doc_id}`").cast("string"), F.col(f"`{text}`"), F.lit(seed)),
        }
    )
    small = materialise(sized.select(F.col(f"`{doc_id}`"), absent, src, tie, names.size))
    # one row for each source; the sources and their weights are the configuration of a mix
    known = small.groupBy(absent, src).agg(F.sum(names.size).alias("n"), F.count(F.lit(1)).alias("rows"))
    known = known.orderBy(absent, src).collect()
    sizes = [row["n"] for row in known]
    goal = targets(sizes)
    quotas = [min(REPEATS * n, int(t + Fraction(1, 2))) for n, t in zip(sizes, goal)]
    plan = make_plan(sizes, quotas, seed, shards, block_words)
    sources = spark.createDataFrame(
        [(r[absent], r[src], i, r["n"], float(t)) for i, (r, t) in enumerate(zip(known, goal))],
        f"{absent} boolean, {src} string, {names.number} long, {names.source_size} long, {names.target} double",
    )
    # neither the rows of a bucket nor the buckets of a source get many
    buckets = 1 + math.isqrt(sum(row["rows"] for row in known))
    dealt = F.pmod(F.shiftright(tie, 20), F.lit(buckets))
    sums = small.withColumn(bucket, dealt).groupBy(absent, src, bucket).agg(F.sum(names.size).alias("n"))
    before = Window.partitionBy(absent, src).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(absent, src, bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    starts = starts.join(sources, [absent, src])
    inside = Window.partitionBy(absent, src, bucket).orderBy(tie, F.col(f"`{doc_id}`"), names.size)
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn(bucket, dealt).withColumn(names.at, F.coalesce(F.sum(names.size).over(inside), F.lit(0)))
    placed = placed.join(starts, [absent, src, bucket]).withColumn(names.at, F.col(names.at) + F.col(start))
    return placed.drop(absent, src, tie, bucket, start), plan


def _drawn(plan: Plan, part: pa.RecordBatch, names: Names) -> dict[str, np.ndarray]:
    return draw(plan, *(part.column(c).to_numpy() for c in (names.number, names.at, names.size)))


def taken(
    docs: DataFrame,
    seed: int = 0,
    shards: int | None = None,
    block_words: int = BLOCK_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """What the mix takes of each document: `doc_id, size, source_size, target, taken, pieces`.

    Sizes are in words. `pieces` has the shard, the order within it (`place`, then `at`), and the words `first`
    to `end` of every piece taken; a document may be taken in part, and up to three times. Null and empty
    texts have size 0 and nothing is taken of them; a null source is a source like others and comes last; repeated rows
    are documents of their own. Equal input gives equal output however it is partitioned. No documents: no rows.
    """
    names = Names(*own("size", "source_size", "target", "number", "at"))
    key, body, group, pieces = own("key", "body", "group", "pieces")
    plain = docs.select(F.col(f"`{doc_id}`").alias(key), F.col(f"`{text}`").alias(body), F.col(f"`{source}`").alias(group))
    placed, plan = _placed(plain, key, body, group, seed, shards, block_words, names)
    placed = placed.select(key, names.size, names.source_size, names.target, names.number, names.at)
    sent = docs.sparkSession.sparkContext.broadcast(plan)
    schema = placed.withColumn(pieces, F.array().cast(PIECE)).schema

    def run(batches):
        for batch in batches:
            found = _drawn(sent.value, batch, names)
            fields = {c: pa.array(found[c]) for c in ("shard", "place", "at", "first", "end")}
            lines = np.searchsorted(found["row"], np.arange(batch.num_rows + 1)).astype(np.int32)
            made = pa.ListArray.from_arrays(pa.array(lines), pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, pieces])

    return placed.mapInArrow(run, schema).select(
        F.col(key).alias(doc_id),
        F.col(names.size).alias("size"),
        F.col(names.source_size).alias("source_size"),
        F.col(names.target).alias("target"),
        F.aggregate(pieces, F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["first"]).alias("taken"),
        F.col(pieces).alias("pieces"),
    )


def mixture(
    docs: DataFrame,
    seed: int = 0,
    shards: int | None = None,
    block_words: int = BLOCK_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mix itself: `shard, place, at, doc_id, text`, a row for each piece that `taken` names, shard by shard in shuffled order.

    A piece runs from the start of its first to the end of its last word, with the white space between them as it
    is; one that has all of a document's words is the whole text. Rows of a shard are sorted by `place` and
    `at`, each shard in one partition: write it with `partitionBy("shard")` for a folder a shard.
    """
    names = Names(*own("size", "source_size", "target", "number", "at"))
    key, body, group = own("key", "body", "group")
    plain = docs.select(F.col(f"`{doc_id}`").alias(key), F.col(f"`{text}`").alias(body), F.col(f"`{source}`").alias(group))
    placed, plan = _placed(plain, key, body, group, seed, shards, block_words, names)
    placed = placed.select(key, body, names.size, names.number, names.at)
    sent = docs.sparkSession.sparkContext.broadcast(plan)
    kind = placed.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in weigh([batch], body, BATCH_BYTES):
                found = _drawn(sent.value, part, names)
                column = part.column(body).cast(pa.large_string()).fill_null("")
                seen = words(column)
                offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
                raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] :]
                offsets = offsets - offsets[0]
                row, size = found["row"], part.column(names.size).to_numpy()
                if not len(row):
                    continue
                begin = seen.starts[seen.first[row] + found["first"]]
                end = seen.ends[seen.first[row] + found["end"] - 1]
                whole = (found["first"] == 0) & (found["end"] == size[row])
                begin, end = np.where(whole, offsets[row], begin), np.where(whole, offsets[row + 1], end)
                texts = [raw[b:e].tobytes().decode() for b, e in zip(begin.tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(found[c]) for c in ("shard", "place", "at")), part.column(key).take(pa.array(row)), pa.array(texts, pa.string())],
                    names=["shard", "place", "at", "doc", "text"],
                )

    out = placed.mapInArrow(run, f"shard bigint, place bigint, at bigint, doc {kind}, text string")
    out = out.repartitionByRange(plan.bounds.shape[1] - 1, "shard").sortWithinPartitions("shard", "place", "at")
    return out.withColumnRenamed("doc", doc_id)


def op12_mix(spark, sf_dir: str) -> DataFrame:
    """What a mix of all sources by weight takes of every document."""
    return taken(table(spark, sf_dir, "documents")).drop("pieces")


QUERIES = {"op12_mix": op12_mix}
#: SQL can't express the tree's draws; tested against a plain version.
ORACLES: dict[str, str] = {}
