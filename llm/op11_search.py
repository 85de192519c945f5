"""Ranked lexical search over a length-stratified index.

A first pass counts the corpus: documents, terms, and the document frequency of every query term. In the
second, each task indexes blocks of its documents: a stratum holds the documents of equal normaliser m,
and the postings of a term lie by stratum and then by term frequency. All postings of one stratum and
frequency have one impact, so an impact is computed once for each such pair. An item's strata are
visited in the order of their score bounds, and those whose bound is below the score already reached
by enough documents are left out. Only the best rows of each task are ranked against each other.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.frames import own, table
from llm.text import IS_ALNUM_WORD, weigh, words

TOP = 20
#: Text bytes under one index, and bytes of items that are searched (and sent to the tasks) together.
INDEX_BYTES = 8 << 20
BLOCK_BYTES = 1 << 20
#: Documents that an item's first visit covers at least; the rest is visited only where the bound allows it.
FIRST_VISIT = 256


@dataclass
class Items:
    """A block of items: their rows, the distinct terms, and each item's terms with their repeats."""

    ids: list
    texts: list
    terms: pa.Array  #: distinct terms
    first: np.ndarray  #: terms of item i are at first[i]:first[i + 1]
    term: np.ndarray
    times: np.ndarray


@dataclass
class Corpus:
    documents: int  #: with at least one term
    terms: int
    weight: np.ndarray  #: of each distinct term of the items


def spelled(found) -> pa.Array:
    """The words of a batch as strings."""
    inside = np.zeros(len(found.data) + 1, np.int8)
    np.add.at(inside, found.starts, 1)
    np.add.at(inside, found.ends, -1)
    letters = found.data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
    offsets = np.concatenate([[0], np.cumsum(found.ends - found.starts)])
    return pa.LargeStringArray.from_buffers(len(found.starts), pa.py_buffer(offsets), pa.py_buffer(letters))


def items_of(ids: list, texts: list) -> Items:
    found = words(pa.array(texts, pa.string()), IS_ALNUM_WORD)
    coded = spelled(found).dictionary_encode()
    number = coded.indices.to_numpy().astype(np.int64)
    size = max(1, len(coded.dictionary))
    pair, times = np.unique(found.text_of() * size + number, return_counts=True)
    first = np.searchsorted(pair, np.arange(len(ids) + 1) * size)
    return Items(ids, texts, coded.dictionary, first, pair % size, times.astype(np.int64))


def term_counts(column: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text in all, and `(text, term, tf)` of those among `terms`."""
    found = words(column, IS_ALNUM_WORD)
    coded = spelled(found).dictionary_encode()
    known = pc.index_in(coded.dictionary, value_set=terms).fill_null(-1).to_numpy().astype(np.int64)
    number = known[coded.indices.to_numpy()] if len(known) else np.zeros(0, np.int64)
    kept = number >= 0
    size = max(1, len(terms))
    pair, tf = np.unique(found.text_of()[kept] * size + number[kept], return_counts=True)
    return np.diff(found.first), pair // size, pair % size, tf.astype(np.int64)


def count_corpus(docs: DataFrame, text: str, items: Items) -> Corpus:
    """One pass over all texts; each task sends one row for each query term it has seen."""
    terms = docs.sparkSession.sparkContext.broadcast(items.terms)

    def run(batches):
        total, with_terms, df = 0, 0, np.zeros(len(terms.value), np.int64)
        for batch in batches:
            for part in weigh([batch], text, INDEX_BYTES):
                n, _, term, _ = term_counts(part.column(text), terms.value)
                total += int(n.sum())
                with_terms += int(np.count_nonzero(n))
                df += np.bincount(term, minlength=len(df))
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], seen])), pa.array(np.concatenate([[with_terms, total], df[seen]]))],
            names=["term", "n"],
        )

    counted = docs.select(text).mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    # at most one row for each distinct term of a block of items
    sums = {row["term"]: row["n"] for row in counted.toLocalIterator()}
    n = sums.get(-2, 0)
    df = np.array([sums.get(t, 0) for t in range(len(items.terms))], np.int64)
    weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()]
    return Corpus(n, sums.get(-1, 0), np.array(weight, np.int64))


class Index:
    """Stratified index over the texts of one block."""

    def __init__(self, column: pa.Array, items: Items, corpus: Corpus) -> None:
        n, text, term, tf = term_counts(column, items.terms)
        m = 75 + (25 * n * corpus.documents) // max(1, corpus.terms)
        self.norms, stratum = np.unique(m, return_inverse=True)
        self.members = np.bincount(stratum, minlength=len(self.norms))
        order = np.lexsort((-tf, stratum[text], term))
        self.text, tf = text[order], tf[order]
        stratum, self.term = stratum[text[order]], term[order]
        # the impact of each (stratum, tf)
        code = stratum * (int(tf.max(initial=0)) + 1) + tf
        _, one, back = np.unique(code, return_index=True, return_inverse=True)
        impact = (1_000_000_000 * tf[one]) // (1000 * tf[one] + 12 * self.norms[stratum[one]])
        self.gain = impact[back] * corpus.weight[self.term]
        # lists: the postings of one term in one stratum; their first posting has the highest tf
        key = self.term * max(1, len(self.norms)) + stratum
        self.list_key, self.list_first = np.unique(key, return_index=True)
        self.list_end = np.append(self.list_first[1:], len(key))
        self.list_stratum = self.list_key % max(1, len(self.norms))
        self.list_best = self.gain[self.list_first]
        self.term_first = np.searchsorted(self.list_key, np.arange(len(items.terms) + 1) * max(1, len(self.norms)))

    def best(self, terms: np.ndarray, times: np.ndarray, order: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The `k` best texts for an item, and their scores, all at least `least` and above 0; `order` ranks texts of equal score."""
        size = self.term_first[terms + 1] - self.term_first[terms]
        lists = np.repeat(self.term_first[terms] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        times = np.repeat(times, size)
        bound = np.zeros(len(self.norms), np.int64)
        np.add.at(bound, self.list_stratum[lists], self.list_best[lists] * times)
        visits = np.argsort(-bound, kind="stable")
        enough = int(np.searchsorted(np.cumsum(self.members[visits]), FIRST_VISIT)) + 1
        score = np.zeros(len(order), np.int64)
        self._add(score, lists, times, visits[:enough])
        least = max(least, 1, kth(score, k))
        rest = visits[enough:]
        self._add(score, lists, times, rest[bound[rest] >= least])
        found = np.flatnonzero(score >= max(least, kth(score, k)))
        found = found[np.lexsort((order[found], -score[found]))][:k]
        return found, score[found]

    def _add(self, score: np.ndarray, lists: np.ndarray, times: np.ndarray, strata: np.ndarray) -> None:
        chosen = np.zeros(len(self.norms), bool)
        chosen[strata] = True
        some = chosen[self.list_stratum[lists]]
        lists, times = lists[some], times[some]
        size = self.list_end[lists] - self.list_first[lists]
        posting = np.repeat(self.list_first[lists] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        np.add.at(score, self.text[posting], self.gain[posting] * np.repeat(times, size))


def kth(score: np.ndarray, k: int) -> int:
    """The k-th highest score, 0 if there are fewer."""
    return int(np.partition(score, len(score) - k)[len(score) - k]) if len(score) >= k else 0


def _searcher(items, corpus, key: str, text: str, k: int):
    def run(batches):
        asked, whole = items.value, corpus.value
        least = np.zeros(len(asked.ids), np.int64)
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            for part in weigh([batch], text, INDEX_BYTES):
                index = Index(part.column(text), asked, whole)
                keys = part.column(key)
                order = pc.rank(keys, "ascending", null_placement="at_start", tiebreaker="first").to_numpy().astype(np.int64)
                rows, numbers, scores = [], [], []
                for i in range(len(asked.ids)):
                    span = slice(asked.first[i], asked.first[i + 1])
                    if span.start == span.stop:
                        continue
                    found, score = index.best(asked.term[span], asked.times[span], order, least[i], k)
                    rows.append(found)
                    scores.append(score)
                    numbers.append(np.full(len(found), i, np.int64))
                if not rows:
                    continue
                rows, numbers, scores = map(np.concatenate, (rows, numbers, scores))
                kept.append(
                    pa.RecordBatch.from_arrays([pa.array(numbers), keys.take(pa.array(rows)), pa.array(scores)], names=["item", "doc", "score"])
                )
                if len(kept) == 8:
                    kept = _ranked(kept, k, least)
        yield from _ranked(kept, k, least)

    return run


def _ranked(kept: list[pa.RecordBatch], k: int, least: np.ndarray) -> list[pa.RecordBatch]:
    """The `k` best rows of each item, as one batch; `least` gets the score that an item's next rows must reach."""
    if not kept:
        return []
    batch = pa.Table.from_batches(kept).combine_chunks().to_batches()
    if not batch:
        return []
    batch = batch[0]
    item, score = batch.column("item").to_numpy(), batch.column("score").to_numpy()
    order = pc.rank(batch.column("doc"), "ascending", null_placement="at_start", tiebreaker="first").to_numpy().astype(np.int64)
    ranked = np.lexsort((order, -score, item))
    place = np.arange(len(ranked)) - np.searchsorted(item[ranked], item[ranked])
    last = ranked[place == k - 1]
    least[item[last]] = score[last]
    return [batch.take(pa.array(ranked[place < k]))]


def _blocks(items: DataFrame):
    """Ids and texts of the items, in blocks of at most `BLOCK_BYTES` of text (or one item)."""
    size, ids, texts = 0, [], []
    for row in items.toLocalIterator():
        length = len((row[1] or "").encode())
        if ids and size + length > BLOCK_BYTES:
            yield ids, texts
            size, ids, texts = 0, [], []
        size += length
        ids.append(row[0])
        texts.append(row[1])
    yield ids, texts


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """`(item_id, rank, doc_id, score)`: the `k` best documents of each item, highest score first, equal ones by id.

    Null and empty texts have no terms: such documents are found by nothing and such items find nothing.
    Every document row is ranked for itself, repeats included; a null id comes before all others. Item rows
    that agree in id and text count once, different texts under one id are items of their own. Documents with
    a score of 0 are left out, so an item may have fewer rows than `k` or none. Empty tables: no rows.
    The items pass through the driver in blocks of bounded size, each searched in one pass over the documents.
    """
    spark = docs.sparkSession
    key, body, item, doc, score, rank = own("key", "body", "item", "doc", "score", "rank")
    plain = docs.select(F.col(f"`{doc_id}`").alias(key), F.col(f"`{text}`").alias(body))
    wanted = items.select(F.col(f"`{item_id}`").alias(item), F.col(f"`{item_text}`").alias(body)).distinct()
    kinds = plain.schema[key].dataType.simpleString(), wanted.schema[item]
    out = None
    for ids, texts in _blocks(wanted):
        asked = items_of(ids, texts)
        corpus = spark.sparkContext.broadcast(count_corpus(plain, body, asked))
        found = plain.mapInArrow(
            _searcher(spark.sparkContext.broadcast(asked), corpus, key, body, k),
            f"item bigint, doc {kinds[0]}, score bigint",
        )
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_first())
        found = found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)
        names = spark.createDataFrame(list(enumerate(ids)), f"number bigint, {item} {kinds[1].dataType.simpleString()}")
        # a block of items is small, see BLOCK_BYTES
        found = found.join(F.broadcast(names), found["item"] == names["number"]).select(
            F.col(item).alias(item_id), F.col(rank).alias("rank"), F.col("doc").alias(doc_id), F.col("score").alias("score")
        )
        out = found if out is None else out.unionByName(found)
    return out


def op11_search(spark, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (
    "coalesce(regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), [])"
)
SQL = f"""
WITH docs AS (SELECT doc_id, {_TERMS.format('text')} AS ws FROM documents),
items AS (SELECT item_id, unnest({_TERMS.format('text')}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
corpus AS (SELECT count(*) FILTER (len(ws) > 0)::BIGINT AS docs, sum(len(ws))::BIGINT AS terms FROM docs),
places AS (SELECT doc_id, len(ws)::BIGINT AS n, unnest(ws) AS term FROM docs),
postings AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM places
    WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(c.docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM postings, corpus c GROUP BY term),
gains AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * c.docs) // c.terms))) AS gain
    FROM postings JOIN weights USING (term), corpus c),
scores AS (SELECT item_id, doc_id, sum(gain)::BIGINT AS score FROM items JOIN gains USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= {TOP}
"""

QUERIES = {"op11_search": op11_search}
ORACLES = {"op11_search": SQL}
