"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors with a cosine of 0.9 or more are at most eps = sqrt(0.2) apart, also after projection to leading
principal directions. Vectors are sorted by the cells of a grid of width eps over these directions and cut
into blocks. Pairs of blocks whose cells and bounding boxes are near enough are joined; within a pair, the two
sequences are halved again and again, and intervals that are provably apart are skipped. What is left is compared
in double precision by matrix products. Equal vectors are one class and compared once; tasks emit counts of
links and a spanning forest, not pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.components import connected_components
from llm.frames import materialise, table

COSINE = 0.9
#: Greatest distance of linked unit vectors, with room for rounding.
EPS = float(np.sqrt(2 - 2 * COSINE)) + 1e-6
DIRECTIONS = 8
BLOCK = 4096
LEAF = 256


def _lists(column) -> np.ndarray:
    """A column of equally long lists as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def classes(vectors: DataFrame) -> DataFrame:
    """Distinct usable vectors: `vector`, `dims`, `id` (smallest vec_id) and `members`."""
    value = F.col("vector")
    usable = (
        F.col("vec_id").isNotNull()
        & (F.size(value) > 0)
        & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(value, lambda x: x != 0)
    )
    usable = vectors.where(F.coalesce(usable, F.lit(False)))
    return usable.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("members")).withColumn(
        "dims", F.size("vector")
    )


def directions(found: DataFrame, dims: int) -> np.ndarray:
    """Leading principal directions of the unit vectors of `dims` components; sums over all of them, added up by Spark."""

    def moments(batches):
        total = np.zeros((dims + 1, dims))
        for batch in batches:
            if batch.num_rows:
                unit = _unit(_lists(batch.column(0)))
                total[:dims] += unit.T @ unit
                total[dims] += unit.sum(axis=0)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(total.ravel())],
            names=["i", "j", "value"],
        )

    sums = np.zeros((dims + 1, dims))
    some = found.where(F.col("dims") == dims)
    count = some.count()
    summed = some.select("vector").mapInArrow(moments, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("v"))
    for row in summed.collect():
        sums[row["i"], row["j"]] = row["v"]
    mean = sums[dims] / count
    _, basis = np.linalg.eigh(sums[:dims] / count - np.outer(mean, mean))
    return basis[:, ::-1][:, :DIRECTIONS].copy()


def _unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square over- or underflows."""
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def grid(found: DataFrame, basis: dict[int, np.ndarray]) -> DataFrame:
    """Append the coordinates `at` in the principal directions, and their grid cells `c0`, `c1`, ..."""

    def place(batches):
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            at = np.zeros((batch.num_rows, DIRECTIONS))
            for size in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == size)
                if size in basis:
                    unit = _unit(_lists(batch.column("vector").take(pa.array(rows))))
                    at[rows, : basis[size].shape[1]] = unit @ basis[size]
            cells = np.floor(at / EPS).astype(np.int32)
            offsets = pa.array(np.arange(len(at) + 1) * DIRECTIONS, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(at.ravel())), *[pa.array(c) for c in cells.T]],
                names=[*batch.schema.names, "at", *names],
            )

    names = [f"c{k}" for k in range(DIRECTIONS)]
    schema = found.withColumn("at", F.array().cast("array<double>")).withColumns({c: F.lit(0) for c in names}).schema
    return found.mapInArrow(place, schema)


def blocks(placed: DataFrame) -> DataFrame:
    """Number the vectors in epsilon grid order and cut the order into blocks of `BLOCK`."""
    cells = ["dims", *[f"c{k}" for k in range(DIRECTIONS)]]
    parts = max(1, -(-placed.count() // BLOCK))
    ordered = placed.repartitionByRange(parts, *cells, "id").sortWithinPartitions(*cells, "id")
    ordered = materialise(ordered.withColumn("row", F.monotonically_increasing_id()))
    part = F.shiftright("row", 33).cast("int")
    # One number for each partition, which are about as many as there are blocks.
    sizes = sorted((r["p"], r["n"]) for r in ordered.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    begins, total = [], 0
    for p, n in sizes:
        begins.append((p, total))
        total += n
    begin = ordered.sparkSession.createDataFrame(begins, "p int, begin bigint")
    number = F.col("begin") + F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ordered.withColumn("p", part)
        .join(F.broadcast(begin), "p")
        .withColumn("block", F.floor(number / BLOCK).cast("int"))
        .drop("p", "begin", "row")
    )


def block_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of blocks `(dims, a, b)`, a <= b, that may hold linked vectors; found by the cells of their first direction, then by their boxes."""
    ks = range(DIRECTIONS)
    box = rows.groupBy("block", "dims").agg(
        *[F.min(F.col("at")[k]).alias(f"low{k}") for k in ks],
        *[F.max(F.col("at")[k]).alias(f"high{k}") for k in ks],
        F.min("c0").alias("first"),
        F.max("c0").alias("last"),
    )
    box = materialise(box)
    near = box.select("*", F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1)).alias("cell")).alias("a")
    own = box.select("*", F.explode(F.sequence("first", "last")).alias("cell")).alias("b")
    gap = F.lit(0.0)
    for k in ks:
        apart = F.greatest(F.col(f"a.low{k}") - F.col(f"b.high{k}"), F.col(f"b.low{k}") - F.col(f"a.high{k}"), F.lit(0.0))
        gap = gap + apart * apart
    joined = near.join(own, (F.col("a.cell") == F.col("b.cell")) & (F.col("a.dims") == F.col("b.dims")))
    return (
        joined.where((F.col("a.block") <= F.col("b.block")) & (gap <= EPS * EPS))
        .select("a.dims", F.col("a.block").alias("a"), F.col("b.block").alias("b"))
        .distinct()
    )


class Linker:
    """Joins two sequences of vectors, or one with itself; gathers weighted link counts and a spanning forest."""

    def __init__(self, x: dict, y: dict | None) -> None:
        self.x, self.y = x, y or x
        self.alone = y is None
        self.links_x = np.zeros(len(x["id"]), np.int64)
        self.links_y = self.links_x if self.alone else np.zeros(len(y["id"]), np.int64)
        n = len(x["id"])
        self.shift = 0 if self.alone else n
        self.parent = np.arange(n if self.alone else n + len(y["id"]))
        self.forest: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, a: int, b: int, c: int, d: int) -> None:
        """Rows a to b of x against rows c to d of y."""
        at_x, at_y = self.x["at"][a:b], self.y["at"][c:d]
        if not len(at_x) or not len(at_y):
            return
        apart = np.maximum(at_x.min(axis=0) - at_y.max(axis=0), at_y.min(axis=0) - at_x.max(axis=0)).clip(min=0)
        if (apart * apart).sum() > EPS * EPS:
            return
        if b - a <= LEAF and d - c <= LEAF:
            self.compare(a, b, c, d)
        elif self.alone and (a, b) == (c, d):
            middle = (a + b) // 2
            self.join(a, middle, a, middle)
            self.join(a, middle, middle, b)
            self.join(middle, b, middle, b)
        elif b - a >= d - c:
            middle = (a + b) // 2
            self.join(a, middle, c, d)
            self.join(middle, b, c, d)
        else:
            middle = (c + d) // 2
            self.join(a, b, c, middle)
            self.join(a, b, middle, d)

    def compare(self, a: int, b: int, c: int, d: int) -> None:
        near = self.x["vector"][a:b] @ self.y["vector"][c:d].T
        near /= self.x["norm"][a:b, None] * self.y["norm"][None, c:d]
        i, j = np.nonzero(near >= COSINE)
        same = self.alone and (a, b) == (c, d)
        if same:
            i, j = i[i < j], j[i < j]
        if not len(i):
            return
        i, j = i + a, j + c
        np.add.at(self.links_x, i, self.y["members"][j])
        np.add.at(self.links_y, j, self.x["members"][i])
        root = self.parent
        while (root != root[root]).any():
            root = root[root]
        self.parent = root.copy()
        new = root[i] != root[j + self.shift]
        for p, q in zip(i[new].tolist(), (j[new] + self.shift).tolist()):
            s, t = self.find(p), self.find(q)
            if s != t:
                self.parent[max(s, t)] = min(s, t)
                self.forest.append((int(self.x["id"][p]), int(self.y["id"][q - self.shift])))


def _join_pairs(batches):
    """Rows sorted by pair and side; a pair has two blocks at most. Emits `(a, b, n)`: a link count of a, or a forest link a-b."""

    def side(rows: pa.Table) -> dict:
        vector = _lists(rows["vector"])
        scale = np.abs(vector).max(axis=1, keepdims=True)
        vector = vector / scale
        return {
            "id": rows["id"].to_numpy(),
            "members": rows["members"].to_numpy(),
            "at": _lists(rows["at"]),
            "vector": vector,
            "norm": np.sqrt((vector * vector).sum(axis=1)),
        }

    def flush(rows: pa.Table):
        sides = rows["side"].to_numpy()
        cut = int(np.searchsorted(sides, 1))
        x = side(rows.slice(0, cut))
        y = side(rows.slice(cut)) if cut < rows.num_rows else None
        linker = Linker(x, y)
        linker.join(0, len(x["id"]), 0, len((y or x)["id"]))
        ids, counts = [x["id"]], [linker.links_x]
        if y is not None:
            ids.append(y["id"])
            counts.append(linker.links_y)
        ids, counts = np.concatenate(ids), np.concatenate(counts)
        some = counts > 0
        forest = np.array(linker.forest, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([ids[some], forest[:, 0]])),
                pa.array([None] * int(some.sum()) + forest[:, 1].tolist(), pa.int64()),
                pa.array(np.concatenate([counts[some], np.zeros(len(forest), np.int64)])),
            ],
            names=["a", "b", "n"],
        )

    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        pair = np.stack([batch.column(c).to_numpy() for c in ("dims", "pair_a", "pair_b")], axis=1)
        borders = [0, *(np.flatnonzero((pair[1:] != pair[:-1]).any(axis=1)) + 1).tolist(), len(pair)]
        for begin, end in zip(borders[:-1], borders[1:]):
            if held and tuple(pair[begin]) != key:
                yield from flush(pa.Table.from_batches(held))
                held = []
            key = tuple(pair[begin])
            held.append(batch.slice(begin, end - begin))
    if held:
        yield from flush(pa.Table.from_batches(held))


def links(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of classes: weighted link counts `(a, n)`, and forest links `(a, b)`."""
    spark = found.sparkSession
    sizes = [r["dims"] for r in found.groupBy("dims").count().orderBy(F.desc("count"), "dims").limit(4).collect()]
    # The four most frequent lengths get directions of their own; all others are joined without.
    basis = {d: directions(found, d) for d in sizes}
    rows = blocks(grid(found, basis))
    pairs = materialise(block_pairs(rows))
    ends = [("a", 0, "true"), ("b", 1, "a < b")]
    roles = [
        pairs.where(use).select(
            "dims", F.col(end).alias("block"), F.col("a").alias("pair_a"), F.col("b").alias("pair_b"), F.lit(side).alias("side")
        )
        for end, side, use in ends
    ]
    cells = [f"c{k}" for k in range(DIRECTIONS)]
    key = ["dims", "pair_a", "pair_b"]
    dealt = rows.join(roles[0].unionByName(roles[1]), ["dims", "block"])
    dealt = dealt.repartition(*key).sortWithinPartitions(*key, "side", *cells, "id")
    dealt = dealt.select(*key, "side", "id", "members", "at", "vector")
    out = materialise(dealt.mapInArrow(_join_pairs, "a bigint, b bigint, n bigint"))
    return out.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n")), out.where("b IS NOT NULL").select("a", "b")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per vector `vec_id, n_links, component_id, kept`, by all pairs with a cosine of 0.9 or more.

    Vectors that are null, empty, all zero, or hold null or non-finite components link with nothing, as do
    vectors with a null id and vectors of different lengths. Such a row has no links and is its own component.
    Repeated rows link with each other. An empty table gives an empty result.
    """
    vectors = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").alias("vector"))
    found = materialise(classes(vectors))
    if found.isEmpty():
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts, forest = links(found)
    roots = connected_components(forest)
    done = (
        found.select("vector", "id", "members")
        .join(counts.withColumnRenamed("a", "id"), "id", "left")
        .join(roots.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.col("vector").alias("class"),
            (F.coalesce("n", F.lit(0)) + F.col("members") - 1).cast("long").alias("n_links"),
            F.coalesce("root", "id").alias("component_id"),
        )
    )
    usable = F.col("vec_id").isNotNull()
    joined = vectors.join(done, (F.col("vector") == F.col("class")) & usable, "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def op9_embeddings(spark, sf_dir: str) -> DataFrame:
    """Links and groups of all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


SQL = f"""
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
n AS (
    SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM e
    WHERE len(v) > 0 AND list_count(v) = len(v) AND isfinite(list_sum(v)) AND list_dot_product(v, v) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= {COSINE}),
reach(a, b) AS (SELECT vec_id, vec_id FROM e UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY 1)
SELECT e.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM e JOIN roots USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

QUERIES = {"op9_embeddings": op9_embeddings}
ORACLES = {"op9_embeddings": SQL}
