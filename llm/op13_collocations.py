"""Phrase collocations: mergeable Misra-Gries summaries find every frequent n-gram, a second pass counts exactly.

First pass: n-grams of one to four words are hashed into partitions. A task sums its own up and sends each
partition a summary; the summaries of a partition are merged under a capacity above its mass divided by
the threshold. A merge that leaves more counters than that takes the next largest count off all of them,
so what is lost stays below the threshold and every frequent n-gram survives. Second pass: only
occurrences whose hash survived are counted, by their words. A count of one hash that belongs to several
phrases can only let more through to it.

Everything after that is on the frequent phrases: all parts of a candidate are frequent themselves, as is
any phrase one word longer that could stand for it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm import bits
from llm.frames import materialise, table
from llm.op11_search import spelled
from llm.text import LOWER, Words, mix, spans, string_buffers, weigh

THRESHOLD = 30
LONGEST = 4
ABSORBED_PERCENT = 80
TOP = 2000
UNKNOWN = "und"
#: Text bytes that a task takes apart at a time: in the first pass, where every n-gram of them is at hand, and in the second.
HASHED_BYTES = 1 << 20
BATCH_BYTES = 2 << 20
#: Distinct n-grams that a task sums up before it sends them.
LOCAL_GRAMS = 1 << 20
#: Counters that make one row, and one Arrow batch.
ROW_GRAMS = 1 << 16
SENT_TOGETHER = 1 << 18
#: Upper bound of the mass (n-gram occurrences) of one hash partition, as far as hashing is even.
PARTITION_MASS = 1 << 24
#: Capacity of a summary as a multiple of mass / threshold.
SLACK = 4
#: Bits of the map of surviving hashes for each of them, and the most bits it may have (32 MB).
BITS_EACH = 16
MOST_BITS = 1 << 28
#: Parts in which each language is ranked before the rest is ranked together.
RANK_PARTS = 128

_ODD = np.uint64(0x9E3779B97F4A7C15)
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(b" \t.,;:!?\n\x0b\x0c\r")] = False
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True


def pieces(column: pa.Array) -> tuple[Words, np.ndarray]:
    """The lower-cased words of a batch, and the number of the piece that each stands in."""
    data, offsets = string_buffers(column)
    data = LOWER[data]
    starts, ends = spans(_IS_WORD[data], offsets)
    found = Words(data, starts, ends, np.searchsorted(starts, offsets))
    return found, np.searchsorted(np.flatnonzero(_IS_BREAK[data]), starts) + found.text_of()


def languages(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Code of each row's language, and the languages; null is `und`."""
    coded = column.cast(pa.string()).fill_null(UNKNOWN).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def gram_hashes(found: Words, piece: np.ndarray, lang: np.ndarray, names: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For n = 1 to 4: the hash of the n-gram that begins at each word, and whether it lies within one piece."""
    seeds = np.array([xxhash.xxh64_intdigest(x, 1) for x in names.to_pylist()], np.uint64)
    word = mix(found.hashes() + np.repeat(seeds[lang], np.diff(found.first)))
    hashes, inside = [word], [np.ones(len(word), bool)]
    for n in range(2, LONGEST + 1):
        size = max(0, len(word) - n + 1)
        hashes.append(mix(hashes[-1][:size] * _ODD + word[n - 1 :]))
        inside.append(piece[:size] == piece[n - 1 :])
    return hashes, inside


def part_and_key(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash partition, which rises with the hash, and the identity within it."""
    part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return part.astype(np.int64), hashes.astype(np.uint32)


def sum_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their total counts. Empties both lists: no array stays longer than it is needed."""
    key = np.concatenate(keys)
    keys.clear()
    order = np.argsort(key, kind="stable")
    key = key[order]
    count = np.concatenate(counts)
    counts.clear()
    count = count[order]
    del order
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


class Summary:
    """Misra-Gries counters of one hash partition; `lost` bounds what any count may lack."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.key, self.count, self.lost = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def merge(self, key: np.ndarray, count: np.ndarray) -> None:
        self.waiting.append((key, count))
        self.size += len(key)
        if self.size > max(self.capacity, 1 << 16):
            self.settle()

    def settle(self) -> None:
        keys, counts = map(list, zip((self.key, self.count), *self.waiting))
        self.waiting, self.size = [], 0
        self.key = self.count = None
        self.key, self.count = sum_up(keys, counts)
        over = len(self.count) - self.capacity
        if over > 0:
            most = np.partition(self.count, over - 1)[over - 1]
            self.count = self.count - most
            kept = self.count > 0
            self.key, self.count = self.key[kept], self.count[kept]
            self.lost += int(most)

    def frequent(self, threshold: int) -> np.ndarray:
        """Keys that may have a count of `threshold`."""
        self.settle()
        return self.key[self.count + self.lost >= threshold]


def _summaries(docs: DataFrame, parts: int) -> DataFrame:
    """Rows by hash partition: `kind` 0 has the mass of a task's share, `kind` 1 its counters."""

    def send(key, count):
        for k in range(0, len(key), SENT_TOGETHER):
            some = count[k : k + SENT_TOGETHER]
            part, low = part_and_key(key[k : k + SENT_TOGETHER], parts)
            begins = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            none = pa.nulls(len(begins), pa.binary())
            yield _rows(part[begins], 0, np.add.reduceat(some, begins), none, none, none)
            # long rows are cut: a row is an object of its own on the other side
            starts = np.union1d(begins, np.arange(0, len(part), ROW_GRAMS))
            cuts = list(zip(starts.tolist(), [*starts[1:].tolist(), len(part)]))
            small = np.minimum(some, 255).astype(np.uint8)
            yield _rows(
                part[starts],
                1,
                np.zeros(len(starts), np.int64),
                pa.array([low[s:e].tobytes() for s, e in cuts], pa.binary()),
                pa.array([small[s:e].tobytes() for s, e in cuts], pa.binary()),
                pa.array([some[s:e][small[s:e] == 255].tobytes() for s, e in cuts], pa.binary()),
            )

    def grams(rows):
        """Distinct hashes of all n-grams of some texts, and how often they occur."""
        found, piece = pieces(rows.column("text"))
        hashes, inside = gram_hashes(found, piece, *languages(rows.column("lang")))
        return np.unique(np.concatenate([h[i] for h, i in zip(hashes, inside)]), return_counts=True)

    def run(batches):
        keys, counts, size = [], [], 0
        for batch in batches:
            for part in weigh([batch], "text", HASHED_BYTES):
                key, count = grams(part)
                keys.append(key)
                counts.append(count.astype(np.int64, copy=False))
                size += len(key)
                del key, count
                if size > LOCAL_GRAMS:
                    key, count = sum_up(keys, counts)
                    keys, counts, size = [key], [count], len(key)
                    if size > LOCAL_GRAMS // 2:
                        yield from send(key, count)
                        keys, counts, size = [], [], 0
        if keys:
            yield from send(*sum_up(keys, counts))

    return docs.mapInArrow(run, "part bigint, kind int, mass bigint, keys binary, small binary, big binary")


def _rows(part, kind, mass, keys, small, big) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(part), pa.array(np.full(len(part), kind, np.int32)), pa.array(mass), keys, small, big],
        names=["part", "kind", "mass", "keys", "small", "big"],
    )


def surviving(docs: DataFrame, parts: int, threshold: int) -> DataFrame:
    """`id` of every n-gram hash that may occur `threshold` times: partition and key in one long. Others may survive too."""
    # a hash partition for each task: all that a task reads may reach Python as one Arrow batch
    dealt = _summaries(docs, parts).repartitionById(parts, F.col("part").cast("int")).sortWithinPartitions("part", "kind")

    def run(batches):
        number, mass, summary = None, 0, None

        def close():
            key = (summary or Summary(1)).frequent(threshold).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array((number << 32) | key)], names=["id"])

        for batch in batches:
            plain = zip(*(batch.column(name).to_pylist() for name in ("part", "kind", "mass")))
            keys, smalls, bigs = (batch.column(name) for name in ("keys", "small", "big"))
            for i, (part, kind, share) in enumerate(plain):
                if part != number:
                    if number is not None:
                        yield close()
                    number, mass, summary = part, 0, None
                if kind == 0:
                    mass += share
                    continue
                summary = summary or Summary(SLACK * mass // threshold + 1)
                count = np.frombuffer(smalls[i].as_buffer(), np.uint8).astype(np.int64)
                count[count == 255] = np.frombuffer(bigs[i].as_buffer(), np.int64)
                summary.merge(np.frombuffer(keys[i].as_buffer(), np.uint32), count)
        if number is not None:
            yield close()

    return dealt.mapInArrow(run, "id bigint")


def _slot(ids: np.ndarray, size: int) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) % np.uint64(size)).astype(np.int64)


def _survivor_map(found: DataFrame) -> tuple[np.ndarray, int]:
    """A bit for each surviving hash; its size has a bound, beyond which more n-grams than needed are counted."""
    size = min(MOST_BITS, max(bits.ROW, 1 << (BITS_EACH * found.count()).bit_length()))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_slot(batch.column("id").to_numpy(), size) + 1)], names=["b"])

    made = found.mapInArrow(run, "b bigint").groupBy((F.bitmap_bucket_number("b") - 1).cast("int").alias("part"))
    made = made.agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits"))
    return bits.as_array(made, size), size


def phrase_counts(docs: DataFrame, parts: int, survivors: np.ndarray, size: int) -> DataFrame:
    """`(lang, n_words, phrase, n)` of each batch: exact counts of phrases whose hash survived; `n_words` 0 counts all words."""
    sent = docs.sparkSession.sparkContext.broadcast(survivors)

    def alive(hashes):
        part, key = part_and_key(hashes, parts)
        return bits.test(sent.value, _slot((part << 32) | key, size))

    def run(batches):
        for batch in batches:
            for rows in weigh([batch], "text", BATCH_BYTES):
                found, piece = pieces(rows.column("text"))
                lang, names = languages(rows.column("lang"))
                hashes, inside = gram_hashes(found, piece, lang, names)
                lang = np.repeat(lang, np.diff(found.first))
                words = spelled(found).dictionary_encode()
                word = words.indices.to_numpy().astype(np.int64)
                yield _counted(names, np.arange(len(names)), 0, [], np.bincount(lang, minlength=len(names)))
                # a phrase's number is exact: it is made of the numbers of its parts
                _, number = np.unique(lang * max(1, len(words.dictionary)) + word, return_inverse=True)
                key, kept = number, alive(hashes[0])
                singles, pairs = number, None
                for n in range(1, LONGEST + 1):
                    if n > 1:
                        span = max(0, len(word) - n + 1)
                        kept = kept[:span] & kept[1 : span + 1] & inside[n - 1]
                        place = np.flatnonzero(kept)
                        kept[place] = alive(hashes[n - 1][place])
                        if n == 2:
                            key = (singles[:span] << 32) | singles[1 : span + 1]
                        elif n == 3:
                            key = (pairs[:span] << 32) | singles[2 : span + 2]
                        else:
                            key = (pairs[:span] << 32) | pairs[2 : span + 2]
                    place = np.flatnonzero(kept)
                    _, first, back, count = np.unique(key[place], return_index=True, return_inverse=True, return_counts=True)
                    if n == 2:
                        pairs = np.full(len(kept), -1, np.int64)
                        pairs[place] = back
                    where = place[first]
                    parts_of = [words.dictionary.take(pa.array(word[where + k])) for k in range(n)]
                    yield _counted(names, lang[where], n, parts_of, count)

    return docs.mapInArrow(run, "lang string, n_words int, phrase string, n bigint")


def _counted(names: pa.Array, lang: np.ndarray, n: int, words: list[pa.Array], count: np.ndarray) -> pa.RecordBatch:
    phrase = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if words else pa.array([""] * len(lang))
    return pa.RecordBatch.from_arrays(
        [names.take(pa.array(lang)), pa.array(np.full(len(lang), n, np.int32)), phrase.cast(pa.string()), pa.array(count.astype(np.int64))],
        names=["lang", "n_words", "phrase", "n"],
    )


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, text: str = "text", lang: str = "lang") -> DataFrame:
    """`(lang, n_words, phrase, n)`: every phrase of one to four words that occurs `threshold` times in a language, and its exact count.

    A row with `n_words` 0 and an empty phrase has the number of all words of the language. Null texts are
    empty, a null language is `und`.
    """
    plain = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    # a word and what follows it take two bytes at least, and begin up to four n-grams
    total = plain.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    parts = 1 + total * LONGEST // 2 // PARTITION_MASS
    survivors, size = _survivor_map(materialise(surviving(plain, parts, threshold)))
    counted = phrase_counts(plain, parts, survivors, size).groupBy("lang", "n_words", "phrase").agg(F.sum("n").alias("n"))
    return materialise(counted.where((F.col("n_words") == 0) | (F.col("n") >= threshold)))


def collocations(
    docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Each language's `top` phrases by cohesion: `lang, rank, phrase, a, l, r, n, score`.

    Candidates have two to four words and occur `threshold` times. Their score is that of the weakest cut, of
    equal ones the first; candidates that one more word nearly always goes with are left out. Equal scores
    rank by count, then by phrase. Null and empty texts have no words, a null language is `und`, repeated
    rows count each time, other columns are not read. Empty tables, or no candidate: no rows.
    """
    known = frequent_phrases(docs, threshold, text, lang)
    phrases = known.where(F.col("n_words") > 0)
    ws = F.split("phrase", " ")

    # a phrase within one that is two words longer is also within one that is one word longer and at least as frequent
    longer = phrases.where(F.col("n_words") > 2)
    within = longer.select(
        "lang",
        F.explode(F.array(F.slice(ws, F.lit(1), F.col("n_words") - 1), F.slice(ws, F.lit(2), F.col("n_words") - 1))).alias("ws"),
        F.col("n").alias("longer"),
    ).select("lang", F.array_join("ws", " ").alias("phrase"), F.lit(None).cast("long").alias("a"), "longer")
    own = phrases.where((F.col("n_words") > 1) & (F.col("n_words") <= LONGEST))
    own = own.select("lang", "phrase", F.col("n").alias("a"), F.lit(0).cast("long").alias("longer"))
    both = own.unionByName(within).groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("longer").alias("longer"))
    wide = "decimal(38,0)"
    kept = both.where(F.col("longer").cast(wide) * 100 < F.col("a").cast(wide) * ABSORBED_PERCENT).drop("longer")

    cut = kept.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size(ws) - 1)).alias("k"))
    cut = cut.withColumns(
        {
            "first": F.array_join(F.slice(ws, F.lit(1), F.col("k")), " "),
            "rest": F.array_join(F.slice(ws, F.col("k") + 1, F.size(ws) - F.col("k")), " "),
        }
    )
    for part, count in (("first", "l"), ("rest", "r")):
        side = phrases.where(F.col("n_words") < LONGEST)
        cut = cut.join(side.select("lang", F.col("phrase").alias(part), F.col("n").alias(count)), ["lang", part])
    score = F.expr(f"cast(2000000 as {wide}) * a div (cast(l as {wide}) + r)").cast("long")
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cut.groupBy("lang", "phrase", "a").agg(weakest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = Window.partitionBy("lang", "bucket").orderBy(*order)
    ranked = scored.withColumn("bucket", bucket).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    words = known.where(F.col("n_words") == 0).select("lang", "n")
    return ranked.where(F.col("rank") <= top).join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    """The 2,000 strongest collocations of every language of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = f"""
WITH pieces AS (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
lines AS (SELECT lang, row_number() OVER () AS line, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
tokens AS (SELECT lang, line, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM lines),
runs AS (
    SELECT lang, w AS p1, p1 || ' ' || lead(w) OVER o AS p2, p2 || ' ' || lead(w, 2) OVER o AS p3, p3 || ' ' || lead(w, 3) OVER o AS p4
    FROM tokens WINDOW o AS (PARTITION BY line ORDER BY i)),
places AS (
    SELECT lang, 1 AS size, p1 AS phrase FROM runs
    UNION ALL SELECT lang, 2, p2 FROM runs WHERE p2 IS NOT NULL
    UNION ALL SELECT lang, 3, p3 FROM runs WHERE p3 IS NOT NULL
    UNION ALL SELECT lang, 4, p4 FROM runs WHERE p4 IS NOT NULL),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM places GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE size > 1 AND f >= {THRESHOLD}),
inner_phrases AS (
    SELECT DISTINCT lang, array_to_string(ws[i : i + k - 1], ' ') AS phrase, a
    FROM (SELECT *, unnest(range(1, size - k + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS k FROM candidates))),
dropped AS (SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN inner_phrases p USING (lang, phrase)
    WHERE 100 * p.a >= {ABSORBED_PERCENT} * c.a),
cuts AS (
    SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.a) // (l.f + r.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
    JOIN counts l ON l.lang = c.lang AND l.size = k AND l.phrase = array_to_string(ws[1 : k], ' ')
    JOIN counts r ON r.lang = c.lang AND r.size = c.size - k AND r.phrase = array_to_string(ws[k + 1 :], ' ')
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM cuts ANTI JOIN dropped USING (lang, phrase) JOIN totals USING (lang)
QUALIFY rank <= {TOP}
"""

QUERIES = {"op13_collocations": op13_collocations}
ORACLES = {"op13_collocations": SQL}
