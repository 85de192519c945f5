"""What the first pass of the collocations holds in a task, and how its hash partitions are dealt."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from llm import op13_collocations


class Given:
    """Stands for a table: keeps what is to run on its batches."""

    def mapInArrow(self, run, schema):
        self.run = run


def test_first_pass_needs_little_memory():
    """Texts of nearly only distinct n-grams: a task stays small, sends rows of bounded size, and loses none of them."""
    rng = np.random.default_rng(5)
    rows = [" ".join(map(str, rng.integers(0, 10**7, 1000).tolist())) for _ in range(1500)]
    batches = [pa.RecordBatch.from_arrays([pa.array(rows), pa.array(["en"] * len(rows))], names=["text", "lang"])]
    docs = Given()
    op13_collocations._summaries(docs, 7)
    mass = sent = longest = 0
    tracemalloc.start()
    for batch in docs.run(batches):
        mass += pc.sum(batch.column("mass")).as_py()
        sizes = pc.binary_length(batch.column("keys")).fill_null(0)
        sent, longest = sent + pc.sum(sizes).as_py() // 4, max(longest, pc.max(sizes).as_py() // 4)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert mass == len(rows) * (1000 + 999 + 998 + 997)
    # pairs and longer n-grams are all distinct, but for chance
    assert 0.98 * len(rows) * (999 + 998 + 997) < sent <= mass
    assert longest <= 1 << 16
    assert most < 100 << 20, most


def test_hash_partitions_are_merged_one_by_one(spark):
    rows = [(" ".join(f"w{i * k % 97}" for i in range(300)), "en") for k in range(1, 40)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    found = op13_collocations.surviving(docs, 23, 5)
    placed = found.select(F.shiftright("id", 32).alias("part"), F.spark_partition_id().alias("task")).distinct().collect()
    assert len(placed) == len({r.part for r in placed}) == len({r.task for r in placed}) == 23
