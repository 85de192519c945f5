"""SimHash fingerprints, and near-duplicate groups by bit-sliced comparison.

Fingerprints within three bits of each other agree on at least one of four 16-bit bands. Distinct
fingerprints are dealt by band and value; large buckets are cut into blocks and compared block by
block. In a task, a run of fingerprints is stored vertically: one long bit vector per bit position.
Shifting the vectors by d compares every fingerprint with the one d rows later in one go; differences
are added up by a carry-save counter of two bits with an overflow flag, and a comparison is abandoned
once all rows have overflowed. Tasks emit only a spanning forest of the links found, which keeps every
connection without emitting all pairs of a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.components import connected_components
from llm.frames import materialise, own, table
from llm.text import weigh

SHINGLE = 3
SEED = 42
RADIUS = 3
BANDS = 4
#: Fingerprints in one vertical block, and the size above which a bucket is cut into cells.
BLOCK = 4096
BATCH_BYTES = 4 << 20


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of the lower-cased (A-Z) text's word shingles; no words: 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - SHINGLE + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :].tolist())]
    return majority(np.array(hashes, dtype=np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits set in more than half of the hashes."""
    counts = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 65536):
        block = hashes[part : part + 65536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(2 * counts > len(hashes))
    return sum(1 << int(b) for b in bits)


def add_fingerprint(docs: DataFrame, text: str, name: str) -> DataFrame:
    """Append the fingerprint of `text` as a long (two's complement) in column `name`."""
    schema = docs.withColumn(name, F.lit(0).cast("long")).schema

    def run(batches):
        for batch in batches:
            for part in weigh([batch], text, BATCH_BYTES):
                prints = np.array([fingerprint(t) for t in part.column(text).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(prints.view(np.int64))], names=[*part.schema.names, name]
                )

    return docs.mapInArrow(run, schema)


def planes(prints: np.ndarray) -> list[int]:
    """The fingerprints turned by 90 degrees: for each bit position, a vector with one bit per fingerprint."""
    bits = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return [int.from_bytes(row.tobytes(), "little") for row in packed]


def ones(mask: int, size: int) -> np.ndarray:
    """Positions of the set bits."""
    raw = np.frombuffer(mask.to_bytes((size + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little"))


def within(planes_a: list[int], planes_b: list[int], alive: int) -> int:
    """Rows of `alive` whose fingerprints differ in at most `RADIUS` (3) bits."""
    low = high = 0
    for a, b in zip(planes_a, planes_b):
        differ = (a ^ b) & alive
        if differ:
            carry = low & differ
            low ^= differ
            over = high & carry
            high ^= carry
            alive &= ~over
            if not alive:
                return 0
    return alive


def linked_pairs(prints: np.ndarray, ends: np.ndarray, sides: np.ndarray | None = None):
    """Yield index arrays `(i, j)` of linked rows: i < j < ends[i]; with `sides`, only rows of unequal side.

    Rows are one block, ordered by bucket; `ends[i]` is where the bucket of row i ends.
    """
    n = len(prints)
    rows = np.arange(n)
    vertical = planes(prints)
    reach = ends - rows
    for d in range(1, int(reach.max(initial=1))):
        pairs = reach > d
        if sides is not None:
            pairs[: n - d] &= sides[: n - d] != sides[d:]
        alive = int.from_bytes(np.packbits(pairs, bitorder="little").tobytes(), "little")
        if alive:
            found = within(vertical, [p >> d for p in vertical], alive)
            if found:
                i = ones(found, n)
                yield i, i + d


class Forest:
    """Union-find over local row numbers; keeps the links that joined two trees."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        return True


def forest_of_block(keys: np.ndarray, prints: np.ndarray, sides: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest links of a block of whole buckets; `keys` are sorted bucket numbers.

    A cell that pairs two different pieces of a bucket has sides 0 and 1; other rows have side -1.
    """
    out = []
    ends = np.searchsorted(keys, keys, side="right")
    crossing = sides >= 0
    for cross in (False, True):
        rows = np.flatnonzero(crossing == cross)
        if len(rows) < 2:
            continue
        local_ends = np.searchsorted(rows, ends[rows])
        forest = Forest(len(rows))
        label = np.arange(len(rows))
        for i, j in linked_pairs(prints[rows], local_ends, sides[rows] if cross else None):
            news = label[i] != label[j]
            if news.any():
                for x, y in zip(i[news].tolist(), j[news].tolist()):
                    if forest.join(x, y):
                        out.append((int(prints[rows[x]]), int(prints[rows[y]])))
                label = np.array(forest.parent)
                while (label != label[label]).any():
                    label = label[label]
    return out


def _compare(batches):
    """Links within sorted runs of (band, value, cell_a, cell_b, piece, print); a bucket cell is held whole, and is bounded."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held: list[np.ndarray] = []

    def flush(rows: np.ndarray):
        keys = rows[:, :4]
        changed = np.ones(len(rows), bool)
        changed[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        number = np.cumsum(changed)
        sides = np.where(rows[:, 2] == rows[:, 3], -1, (rows[:, 4] == rows[:, 3]).astype(np.int64))
        prints = np.ascontiguousarray(rows[:, 5]).view(np.uint64)
        begins = np.append(np.flatnonzero(changed), len(rows))
        links: list[tuple[int, int]] = []
        begin = 0
        for k in range(1, len(begins)):
            if k + 1 == len(begins) or begins[k + 1] - begins[begin] > BLOCK:
                s, e = begins[begin], begins[k]
                links += forest_of_block(number[s:e], prints[s:e], sides[s:e])
                begin = k
        signed = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[:, 0]), pa.array(signed[:, 1])], schema=schema)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1))
        if sum(map(len, held)) < 4 * BLOCK:
            continue
        rows = np.concatenate(held)
        last = np.flatnonzero((rows[:, :4] != rows[-1, :4]).any(axis=1))
        cut = int(last[-1]) + 1 if len(last) else 0
        held = [rows[cut:]]
        if cut:
            yield flush(rows[:cut])
    if held and sum(map(len, held)):
        yield flush(np.concatenate(held))


def fingerprint_links(prints: DataFrame, name: str) -> DataFrame:
    """Links `(a, b)` between distinct fingerprints in column `name` that keep all connections within the radius."""
    width = 64 // BANDS
    bands = prints.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("band"),
                        F.shiftrightunsigned(F.col(name), width * i).bitwiseAND(F.lit((1 << width) - 1)).alias("value"),
                        F.col(name).alias("print"),
                    )
                    for i in range(BANDS)
                ]
            )
        ).alias("x")
    ).select("x.*")
    pieces = bands.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pieces = pieces.select("band", "value", F.ceil(F.col("n") / F.lit(BLOCK // 2)).cast("long").alias("pieces"))
    cells = bands.join(pieces, ["band", "value"]).withColumn(
        "piece", F.pmod(F.xxhash64("print", F.lit(7)), F.col("pieces"))
    )
    others = F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)
    cells = cells.select("band", "value", "piece", "print", F.explode(others).alias("other"))
    cells = cells.select(
        F.col("band").cast("long").alias("band"),
        "value",
        F.least("piece", "other").alias("cell_a"),
        F.greatest("piece", "other").alias("cell_b"),
        "piece",
        "print",
    )
    cells = cells.repartition("band", "value", "cell_a", "cell_b")
    cells = cells.sortWithinPartitions("band", "value", "cell_a", "cell_b", "print")
    return cells.mapInArrow(_compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns `keep` of `docs` (default: all), `fingerprint` (16 hex digits) and `component_id` (smallest id reachable by links).

    Two documents are linked if their fingerprints differ in at most three bits; equal texts always are.
    Null texts count as empty, and texts without words have fingerprint zero. Repeated ids are kept as
    rows. A null id keeps its row and is nobody's component id. An empty table gives an empty result.
    Existing columns named `fingerprint` or `component_id` are replaced.
    """
    code, smallest, root, key, ident = own("print", "smallest", "root", "key", "id")
    kept = [c for c in (keep or docs.columns) if c not in ("fingerprint", "component_id")]
    coded = docs.select(
        F.col(f"`{doc_id}`").alias(ident), F.col(f"`{text}`").alias(root), *[F.col(f"`{c}`") for c in kept]
    )
    # The text is hashed once, and written only if the caller keeps it.
    coded = materialise(add_fingerprint(coded, root, code).drop(root))
    firsts = materialise(coded.groupBy(code).agg(F.min(ident).alias(smallest)))
    roots = connected_components(fingerprint_links(firsts.select(code), code))
    roots = roots.select(F.col("node").alias(code), F.col("root").alias(root))
    grouped = firsts.join(roots, code, "left").withColumn(root, F.coalesce(F.col(root), F.col(code)))
    tops = grouped.groupBy(root).agg(F.min(smallest).alias(smallest))
    grouped = materialise(grouped.select(code, root).join(tops, root).select(F.col(code).alias(key), smallest))
    return coded.join(grouped, coded[code] == grouped[key], "left").select(
        *[F.col(f"`{c}`") for c in kept], _hex(F.col(code)).alias("fingerprint"), F.col(smallest).alias("component_id")
    )


def _hex(code: Column) -> Column:
    return F.lower(F.lpad(F.hex(code), 16, "0"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay: the one with the smallest id of each group, with the columns of `docs`.

    Rows with a null id stay, as no order says which of them is a copy. Rows that share the smallest id all stay.
    """
    mark, print_ = "component_id", "fingerprint"
    renamed, back = docs, {}
    for c in (mark, print_):
        if c in docs.columns:
            (fresh,) = own(c)
            renamed, back = renamed.withColumnRenamed(c, fresh), back | {fresh: c}
    found = near_duplicates(renamed, doc_id, text)
    found = found.where(F.col(f"`{doc_id}`").isNull() | (F.col(mark) == F.col(f"`{doc_id}`"))).drop(mark, print_)
    for fresh, c in back.items():
        found = found.withColumnRenamed(fresh, c)
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, keep=["doc_id"])


QUERIES = {"op6_simhash": op6_simhash}
ORACLES: dict[str, str] = {}
