"""Benchmark decontamination with an FM-index for each shard of documents.

A task cuts its documents into shards of bounded size. The words that occur in a phrase of the
benchmark are the alphabet of the index; a run of other words is one separator, as no phrase can span
it. All phrases are searched backwards at once through the ranks of a wavelet matrix; occurrences are
located by sampled suffix positions, and their words are merged into spans.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.fm_index import FmIndex
from llm.frames import materialise, own, table
from llm.text import IS_ALNUM_WORD, weigh, words

WINDOW = 10
#: Text bytes under one index, and benchmark bytes that are searched (and sent to the tasks) together.
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 8 << 20
SPAN = "struct<first:bigint,end:bigint,first_byte:bigint,end_byte:bigint>"


@dataclass
class Phrases:
    """Distinct windows of a block of items, by length, over the sorted hashes of their words."""

    vocabulary: np.ndarray
    windows: list[np.ndarray]  #: lines of word numbers (from 1), one array for each length
    items: list[list[list[str]]]  #: for each window, the ids of its items


def phrases(ids: list[str], texts: list[str | None]) -> Phrases:
    found = words(pa.array(texts, pa.string()), IS_ALNUM_WORD)
    vocabulary, number = np.unique(found.hashes(), return_inverse=True)
    by_window: dict[tuple[int, ...], list[str]] = {}
    for i, item in enumerate(ids):
        line = (number[found.first[i] : found.first[i + 1]] + 1).tolist()
        for k in range(max(1, len(line) - WINDOW + 1) if line else 0):
            owners = by_window.setdefault(tuple(line[k : k + WINDOW]), [])
            if item not in owners[-1:]:
                owners.append(item)
    lengths = sorted({len(w) for w in by_window})
    groups = [[w for w in by_window if len(w) == size] for size in lengths]
    return Phrases(vocabulary, [np.array(g, np.int64) for g in groups], [[by_window[w] for w in g] for g in groups])


def search_shard(texts: pa.Array, wanted: Phrases) -> list[tuple[int, list[tuple[int, int, int, int]], list[str]]]:
    """For each text: its number of words, the merged hit spans (words and bytes), and the ids of the items found."""
    found = words(texts, IS_ALNUM_WORD)
    n_words = np.diff(found.first)
    out = [(int(n), [], []) for n in n_words]
    if not len(wanted.vocabulary) or not len(found.starts):
        return out
    hashes = found.hashes()
    slot = np.minimum(np.searchsorted(wanted.vocabulary, hashes), len(wanted.vocabulary) - 1)
    kept = np.flatnonzero(wanted.vocabulary[slot] == hashes)
    if not len(kept):
        return out
    text_of = found.text_of()
    gap = np.ones(len(kept), np.int64)
    gap[0] = 0
    gap[1:] = (np.diff(kept) != 1) | (np.diff(text_of[kept]) != 0)
    at = np.arange(len(kept)) + np.cumsum(gap)
    symbols = np.zeros(at[-1] + 2, np.int64)
    symbols[at] = slot[kept] + 1
    origin = np.zeros(len(symbols), np.int64)
    origin[at] = kept
    index = FmIndex(symbols, len(wanted.vocabulary))

    change = np.zeros(len(found.starts) + 1, np.int64)
    owners: dict[int, set[str]] = {}
    for lines, items in zip(wanted.windows, wanted.items):
        low, high = index.search(lines)
        hit = np.flatnonzero(high > low)
        if not len(hit):
            continue
        times = high[hit] - low[hit]
        rows = np.repeat(low[hit] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        begin = origin[index.locate(rows)]
        np.add.at(change, begin, 1)
        np.add.at(change, begin + lines.shape[1], -1)
        pairs = np.unique(np.stack([text_of[begin], np.repeat(hit, times)], axis=1), axis=0)
        for text, window in pairs.tolist():
            owners.setdefault(text, set()).update(items[window])
    covered = np.cumsum(change[:-1]) > 0
    places = np.flatnonzero(covered)
    if len(places):
        new = np.ones(len(places), bool)
        new[1:] = (np.diff(places) != 1) | (np.diff(text_of[places]) != 0)
        begins = places[new]
        ends = places[np.append(np.flatnonzero(new)[1:], len(places)) - 1] + 1
        sizes = pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        bytes_before = np.concatenate([[0], np.cumsum(sizes)])
        for b, e in zip(begins.tolist(), ends.tolist()):
            t = int(text_of[b])
            shift, base = int(found.first[t]), int(bytes_before[t])
            out[t][1].append((b - shift, e - shift, int(found.starts[b]) - base, int(found.ends[e - 1]) - base))
        for t, ids in owners.items():
            out[t][2].extend(sorted(ids))
    return out


def merge_spans(old: list[tuple], new: list[tuple]) -> list[tuple]:
    """Union of spans; those that touch in words become one."""
    merged: list[tuple] = []
    for span in sorted([*old, *new]):
        if merged and span[0] <= merged[-1][1]:
            last = merged[-1]
            merged[-1] = (last[0], max(last[1], span[1]), last[2], max(last[3], span[3]))
        else:
            merged.append(span)
    return merged


def find_spans(docs: DataFrame, benchmark: DataFrame, text: str, names: tuple[str, str, str]) -> DataFrame:
    """Append `(n_words long, spans array, items array<string>)` under the three names.

    The benchmark is read in blocks of bounded size; each block is one pass over the documents, which adds to
    the spans and items of the passes before.
    """
    n_words, spans, items = names
    spark = docs.sparkSession
    out = docs.withColumns(
        {
            n_words: F.lit(0).cast("long"),
            spans: F.array().cast(f"array<{SPAN}>"),
            items: F.array().cast("array<string>"),
        }
    )
    schema = out.schema
    for number, (ids, texts) in enumerate(_blocks(benchmark)):
        if number and number % 8 == 0:
            out = materialise(out)
        sent = spark.sparkContext.broadcast(phrases(ids, texts))
        out = out.mapInArrow(_searcher(sent, text, names), schema)
    return out


def _searcher(sent, text: str, names: tuple[str, str, str]):
    def run(batches):
        for batch in batches:
            for part in weigh([batch], text, SHARD_BYTES):
                column = part.column(text).fill_null("").dictionary_encode()
                results = search_shard(column.dictionary, sent.value)
                picked = [results[i] for i in column.indices.to_pylist()]
                old_spans, old_items = part.column(names[1]), part.column(names[2])
                span_rows, item_rows = [], []
                for i, (_, new, ids) in enumerate(picked):
                    before = [tuple(s.values()) for s in old_spans[i].as_py() or []] if len(old_spans[i]) else []
                    merged = merge_spans(before, new) if before else new
                    span_rows.append([dict(zip(("first", "end", "first_byte", "end_byte"), s)) for s in merged])
                    seen = old_items[i].as_py() if len(old_items[i]) else []
                    item_rows.append(sorted({*seen, *ids}))
                fresh = {
                    names[0]: pa.array([p[0] for p in picked], pa.int64()),
                    names[1]: pa.array(span_rows, old_spans.type),
                    names[2]: pa.array(item_rows, old_items.type),
                }
                columns = [fresh.get(f, part.column(i)) for i, f in enumerate(part.schema.names)]
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return run


def _blocks(benchmark: DataFrame):
    """Ids and texts of the items, in blocks of at most `BLOCK_BYTES` of text (or one item)."""
    size, ids, texts = 0, [], []
    for row in benchmark.toLocalIterator():
        length = len((row[1] or "").encode())
        if ids and size + length > BLOCK_BYTES:
            yield ids, texts
            size, ids, texts = 0, [], []
        size += length
        ids.append(row[0])
        texts.append(row[1])
    yield ids, texts


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    return benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")), F.col(f"`{text}`"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: `doc_id, n_words, n_hit, n_items, items_sha256, contaminated`.

    A window is ten consecutive words of an item, or a shorter item whole. Null and empty texts have no words;
    items without words never occur. Item rows with equal ids count as one item, a null item id as empty
    text. Repeated documents each get their row. Empty tables: no documents give no rows, no items no hits.
    """
    n_words, spans, items, key, body = own("n_words", "spans", "items", "key", "body")
    plain = docs.select(F.col(f"`{doc_id}`").alias(key), F.col(f"`{text}`").alias(body))
    found = find_spans(plain, _items(benchmark, "item_id", "text"), body, (n_words, spans, items)).drop(body)
    hit = F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["first"])
    return found.select(
        F.col(key).alias(doc_id),
        F.col(n_words).alias("n_words"),
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.col(items)), ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def remove_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """`docs` with the hit spans cut out of `text` (from the first to the last hit word), and `n_chars` set for changed texts.

    Documents without a hit keep text and count as they are, nulls included. A text that is one hit becomes
    what stands around it, possibly empty; its row stays.
    """
    n_words, spans, items = own("n_words", "spans", "items")
    found = find_spans(docs, _items(benchmark, "item_id", "text"), text, (n_words, spans, items))
    changed = F.size(spans) > 0
    raw = F.col(f"`{text}`").cast("binary")
    before = F.transform(
        F.col(spans),
        lambda s, i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.element_at(spans, i)["end_byte"]),
    )
    pieces = F.zip_with(F.col(spans)["first_byte"], before, lambda end, begin: F.substring(raw, (begin + 1).cast("int"), (end - begin).cast("int")))
    tail = F.substring(raw, (F.element_at(spans, -1)["end_byte"] + 1).cast("int"), F.octet_length(F.col(f"`{text}`")))
    joined = F.concat(
        F.aggregate(pieces, F.lit("").cast("binary"), lambda a, b: F.concat(a, b)), tail
    )
    cut = F.when(changed, F.decode(joined, "UTF-8")).otherwise(F.col(f"`{text}`"))
    result = found.withColumn(text, cut)
    if n_chars is not None and n_chars in docs.columns:
        count = F.when(changed, F.length(F.col(f"`{text}`")).cast(docs.schema[n_chars].dataType))
        result = result.withColumn(n_chars, F.coalesce(count, F.col(f"`{n_chars}`")))
    return result.select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Contamination of every document by the whole benchmark."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = (
    "coalesce(regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"
)
SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS.format('text')} AS ws FROM documents),
items AS (SELECT item_id, {_WORDS.format('text')} AS ws FROM benchmark),
wanted AS (
    SELECT DISTINCT item_id, least(len(ws), {WINDOW}) AS size,
           array_to_string(ws[i : i + {WINDOW - 1}], ' ') AS win
    FROM items, range(1, greatest(len(ws) - {WINDOW - 1}, 1) + 1) AS r(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT size FROM wanted),
places AS (
    SELECT doc_id, i, size, array_to_string(ws[i : i + size - 1], ' ') AS win
    FROM docs, sizes, range(1, len(ws) - size + 2) AS r(i)),
hits AS (SELECT doc_id, item_id, i, p.size FROM places p JOIN wanted w ON p.win = w.win AND p.size = w.size),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY 1),
hit_items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

QUERIES = {"op5_decontaminate": op5_decontaminate}
ORACLES = {"op5_decontaminate": SQL}
