"""Substring dedup by content-defined chunks.

1. A gear hash rolls over the bytes of a text; a chunk ends where the top bits of the hash are zero, so its
   borders depend on the bytes just before them only, and an insertion shifts no border beyond its own
   neighbourhood.
2. A chunk is a repeat if its digest of 128 bits occurs earlier in the corpus. Chunks that repeat within a batch
   are settled there, so a chunk that is everywhere adds one row for each batch to the shuffle. A whole text has
   a digest too.
3. A run of repeated chunks grows at both ends, byte by byte, for as long as it agrees with what stands around
   the first occurrence of its outermost chunk. Only bytes around such occurrences are sent.
4. Runs of enough words are cut out; a text that is a copy as a whole becomes empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.bits import bucket_of, may_need, needed
from llm.frames import materialise, own, table
from llm.text import IS_SPACED_WORD, mix, span_hashes, string_buffers, weigh

#: Bytes that the rolling hash sees (a power of two), least and greatest chunk, and the bits of a border (one in 32).
WINDOW = 16
MIN_CHUNK, MAX_CHUNK = 16, 256
BORDER_BITS = 5
#: Bytes that a run may grow beyond its chunks at either end: two of the longest.
EXTEND = 2 * MAX_CHUNK
#: Words that a run of repeated chunks must have to be cut out.
MIN_WORDS = 16
#: Scripts without spaces: a word of more bytes than this that is not ASCII counts once for every `BYTES_A_WORD`.
LONG_WORD, BYTES_A_WORD = 48, 6
#: Number that stands for a text as a whole among its chunks.
WHOLE = (1 << 31) - 1
BATCH_BYTES = 2 << 20

GEAR = mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """Gear hash at each byte: the sum of the gears of the last `WINDOW` bytes, each shifted by its distance twice over.

    Built by doubling: the hash of 2k bytes is that of the last k and, shifted, of the k before.
    """
    h = GEAR[data]
    size = 1
    while size < WINDOW:
        older = h[:-size] << np.uint32(2 * size)
        h = h.copy()
        h[size:] += older
        size *= 2
    return h


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the chunks of all texts, and where each text's chunks begin."""
    borders = np.flatnonzero(rolling(data) >> np.uint32(32 - BORDER_BITS) == 0) + 1
    split = np.searchsorted(borders, offsets, side="right")
    ends: list[int] = []
    first = [0]
    for i in range(len(offsets) - 1):
        last, stop = int(offsets[i]), int(offsets[i + 1])
        for b in borders[split[i] : split[i + 1]].tolist():
            if b - last < MIN_CHUNK:
                continue
            while b - last > MAX_CHUNK:
                last += MAX_CHUNK
                ends.append(last)
            if b - last >= MIN_CHUNK or b == stop:
                ends.append(b)
                last = b
        while stop - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last)
        if last < stop:
            ends.append(stop)
        first.append(len(ends))
    return np.array(ends, np.int64), np.array(first, np.int64)


def chunks(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a batch, starts and ends of its chunks, and where each text's chunks begin."""
    data, offsets = string_buffers(column)
    ends, first = chunk_ends(data, offsets)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    return data, starts, ends, first


def _occurrences(docs: DataFrame, doc: str, text: str, mark: str) -> DataFrame:
    """A row for each chunk and each whole text: digests, document, place (mark of the text and number).

    `settled` rows repeat an earlier one of their batch, which `to_doc` and `to_place` name. Empty and null texts give no row.
    """
    kind = docs.schema[doc].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in weigh([batch], text, BATCH_BYTES):
                data, starts, ends, first = chunks(part.column(text))
                number = np.arange(len(ends)) - np.repeat(first[:-1], np.diff(first))
                row = np.repeat(np.arange(part.num_rows), np.diff(first))
                _, offsets = string_buffers(part.column(text))
                some = np.flatnonzero(np.diff(offsets))
                digest, check = (
                    np.concatenate([span_hashes(data, starts, ends, k), span_hashes(data, offsets[some], offsets[some + 1], k + 2)])
                    for k in (0, 1)
                )
                row = np.concatenate([row, some])
                number = np.concatenate([number, np.full(len(some), WHOLE)])
                marks = part.column(mark).to_numpy(zero_copy_only=False).astype(np.int64)
                place = (marks[row] << 32) | number
                ranks = pa.compute.rank(
                    part.column(doc), "ascending", null_placement="at_start", tiebreaker="dense"
                ).to_numpy()
                order = np.lexsort((place, ranks[row], check, digest))
                same = np.zeros(len(order), bool)
                same[1:] = (digest[order[1:]] == digest[order[:-1]]) & (check[order[1:]] == check[order[:-1]])
                head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
                twin = (ranks[row[order]] == ranks[row[head]]) & (place[order] == place[head])
                settled = np.zeros(len(order), bool)
                settled[order[same & ~twin]] = True
                source = np.zeros(len(order), np.int64)
                source[order] = head
                digest = np.where(settled, mix(digest ^ place.astype(np.uint64)), digest)
                docs_ = part.column(doc)
                mask = pa.array(~settled)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(digest.view(np.int64)),
                        pa.array(check.view(np.int64)),
                        docs_.take(pa.array(row)),
                        pa.array(place),
                        docs_.take(pa.array(row[source], mask=~settled)),
                        pa.compute.if_else(mask, pa.scalar(None, pa.int64()), pa.array(place[source])),
                        pa.array(settled),
                    ],
                    names=["digest", "check", "doc", "place", "to_doc", "to_place", "settled"],
                )

    columns = f"digest bigint, check bigint, doc {kind}, place bigint, to_doc {kind}, to_place bigint, settled boolean"
    return docs.mapInArrow(run, columns)


def repeated_chunks(docs: DataFrame, doc: str, text: str, mark: str) -> DataFrame:
    """`(doc, place)` of every chunk that occurs earlier: in a smaller document id, or before it in its own text.

    `to_doc` and `to_place` name its first occurrence or, for `settled` rows, the first of their batch. A number of
    `WHOLE` stands for a text that an earlier one equals.
    """
    rows = _occurrences(docs.select(doc, text, mark), doc, text, mark)
    dealt = rows.repartition("digest").sortWithinPartitions("digest", "check", "settled", "doc", "place")
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches):
        first = None  # the first row of the digest that the last batch ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch if first is None else pa.Table.from_batches([first, batch]).combine_chunks().to_batches()[0]
            digest, check = part.column("digest").to_numpy(), part.column("check").to_numpy()
            settled = part.column("settled").to_numpy(zero_copy_only=False)
            new = np.ones(len(digest), bool)
            new[1:] = (digest[1:] != digest[:-1]) | (check[1:] != check[:-1])
            head = np.maximum.accumulate(np.where(new, np.arange(len(digest)), 0))
            # equal rows of the table are one: they don't repeat each other
            doc, place = part.column("doc"), part.column("place").to_numpy()
            other = doc.take(pa.array(head))
            twin = pa.compute.fill_null(pa.compute.equal(doc, other), False).to_numpy(zero_copy_only=False)
            twin |= (doc.is_null().to_numpy(zero_copy_only=False)) & (other.is_null().to_numpy(zero_copy_only=False))
            twin &= place == place[head]
            again = settled | ~twin
            again[: 0 if first is None else 1] = False
            first = part.slice(int(head[-1]), 1)
            stays = pa.array(settled)
            to_doc = pa.compute.if_else(stays, part.column("to_doc"), other)
            to_place = pa.compute.if_else(stays, part.column("to_place"), pa.array(place[head]))
            out = pa.RecordBatch.from_arrays(
                [doc, part.column("place"), stays, to_doc, to_place], names=["doc", "place", "settled", "to_doc", "to_place"]
            )
            yield out.filter(pa.array(again))

    return dealt.mapInArrow(run, f"doc {kind}, place bigint, settled boolean, to_doc {kind}, to_place bigint")


def _edges(lists: DataFrame) -> DataFrame:
    """The outermost chunks of every run of `lists`, by side (0 before, 1 after), with the occurrence they repeat.

    Texts that are copies as a whole need none, and nothing stands before a text's first chunk.
    """

    def run(batches):
        for batch in batches:
            items = batch.column("items")
            n = pa.compute.list_value_length(items).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = items.flatten()
            number = pa.compute.struct_field(flat, "number").to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(n)), n)
            copies = np.zeros(len(n), bool)
            copies[row[number == WHOLE]] = True
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1])
            at = np.flatnonzero(new & ~copies[row])
            r, k = row[at], number[at]
            joined = (r[1:] == r[:-1]) & (k[1:] == k[:-1] + 1)
            before, after = np.ones(len(at), bool), np.ones(len(at), bool)
            before[1:] &= ~joined
            after[:-1] &= ~joined
            for side, mine in ((0, at[before & (k > 0)]), (1, at[after])):
                picked = flat.take(pa.array(mine))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(row[mine])),
                        batch.column("mark").take(pa.array(row[mine])),
                        pa.array(number[mine].astype(np.int32)),
                        pa.array(np.full(len(mine), side, np.int32)),
                        *(pa.compute.struct_field(picked, c) for c in ("settled", "to_id", "to_place")),
                    ],
                    names=["id", "mark", "number", "side", "settled", "to_id", "to_place"],
                )

    return lists.mapInArrow(run, "id bigint, mark int, number int, side int, settled boolean, to_id bigint, to_place bigint")


def _around(docs: DataFrame, text: str) -> DataFrame:
    """The bytes before (side 0) and after (side 1) the chunks that `asked` lists for each text, `EXTEND` at most."""

    def run(batches):
        for batch in batches:
            for part in weigh([batch], text, BATCH_BYTES):
                data, starts, ends, first = chunks(part.column(text))
                _, offsets = string_buffers(part.column(text))
                asked = part.column("asked")
                n = pa.compute.list_value_length(asked).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = asked.flatten()
                number, side = (pa.compute.struct_field(flat, c).to_numpy() for c in ("number", "side"))
                row = np.repeat(np.arange(len(n)), n)
                chunk = first[row] + number
                low = np.where(side == 1, ends[chunk], np.maximum(starts[chunk] - EXTEND, offsets[row]))
                high = np.where(side == 1, np.minimum(ends[chunk] + EXTEND, offsets[row + 1]), starts[chunk])
                marks = part.column("mark").to_numpy().astype(np.int64)
                raw = data.tobytes()
                for begin in range(0, len(row), 4096):
                    some = slice(begin, begin + 4096)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("to_id").take(pa.array(row[some])),
                            pa.array((marks[row[some]] << 32) | number[some]),
                            pa.array(side[some]),
                            pa.array([raw[i:j] for i, j in zip(low[some].tolist(), high[some].tolist())], pa.binary()),
                        ],
                        names=["to_id", "to_place", "side", "around"],
                    )

    return docs.mapInArrow(run, "to_id bigint, to_place bigint, side int, around binary")


def surroundings(lists: DataFrame, docs: DataFrame, doc: str, text: str, mark: str) -> DataFrame:
    """For each text with runs (`id`, `mark`), what stands around the first occurrences of their outermost chunks."""
    edges = materialise(_edges(lists))
    # A settled chunk names the first of its batch, which may repeat an earlier one itself.
    place = F.shiftleft(F.col("mark").cast("long"), 32).bitwiseOR(F.col("item.number").cast("long"))
    heads = lists.select("id", "mark", F.explode("items").alias("item")).groupBy(
        F.col("id").alias("to_id"), place.alias("to_place")
    ).agg(F.min(F.struct("item.settled", "item.to_id", "item.to_place")).alias("first"))
    again = edges.where("settled").join(heads, ["to_id", "to_place"], "left").select(
        "id", "mark", "number", "side",
        F.coalesce("first.to_id", "to_id").alias("to_id"), F.coalesce("first.to_place", "to_place").alias("to_place"),
    )
    edges = materialise(again.unionByName(edges.where("NOT settled").drop("settled")))
    # Only texts that something was first seen in are sent, once each, to the list of what is asked of them.
    asked = materialise(
        edges.groupBy("to_id", F.shiftrightunsigned("to_place", 32).cast("int").alias("mark")).agg(
            F.collect_set(F.struct(F.col("to_place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("number"), "side")).alias("asked")
        )
    )
    sources = docs.select(F.xxhash64(F.col(f"`{doc}`")).alias("to_id"), F.col(mark).alias("mark"), F.col(f"`{text}`").alias("text"))
    sources = may_need(sources, needed(asked, bucket_of("to_id", "mark")), bucket_of("to_id", "mark"), "flag").where("flag").drop("flag")
    around = _around(sources.dropDuplicates(["to_id", "mark"]).join(asked, ["to_id", "mark"]), "text")
    return edges.join(around, ["to_id", "to_place", "side"]).groupBy("id", "mark").agg(
        F.collect_list(F.struct("number", "side", "around")).alias("around")
    )


def agreement(a: bytes, b: bytes) -> int:
    """Length of the longest common beginning."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return int(differ[0]) if len(differ) else n


def count_words(data: bytes) -> int:
    """White-space words; long ones of scripts without spaces count by their bytes."""
    return sum(1 if len(w) <= LONG_WORD or w.isascii() else len(w) // BYTES_A_WORD for w in data.split())


def whole_words(data: bytes, low: int, high: int) -> tuple[int, int]:
    """The part of a span that holds whole words only; a word that is too long to keep is cut between characters."""
    inside = lambda i: 0 < i < len(data) and IS_SPACED_WORD[data[i - 1]] and IS_SPACED_WORD[data[i]]
    within = lambda i: 0 < i < len(data) and data[i] & 0xC0 == 0x80
    begin, end = low, high
    while begin < high and begin - low <= LONG_WORD and inside(begin):
        begin += 1
    while end > low and high - end <= LONG_WORD and inside(end):
        end -= 1
    if inside(begin):
        begin = low
        while begin < high and within(begin):
            begin += 1
    if inside(end):
        end = high
        while end > begin and within(end):
            end -= 1
    # the words before and after stay apart
    if 0 < begin < end < len(data) and IS_SPACED_WORD[data[begin - 1]] and IS_SPACED_WORD[data[end]]:
        if not IS_SPACED_WORD[data[end - 1]]:
            end -= 1
        elif not IS_SPACED_WORD[data[begin]]:
            begin += 1
    return begin, end


def cut_repeats(
    data: bytes, starts: np.ndarray, ends: np.ndarray, repeats: np.ndarray, around: dict[tuple[int, int], bytes]
) -> bytes:
    """The text without its runs of repeated chunks that hold `MIN_WORDS` whole words or more; only whole words go.

    `around` holds, by chunk and side, the bytes around the first occurrence; runs grow as far as those agree with the text.
    """
    if len(repeats) and repeats[-1] == WHOLE:
        return b""
    flags = np.zeros(len(ends) + 2, np.int8)
    flags[repeats + 1] = 1
    edge = np.flatnonzero(np.diff(flags))
    runs: list[list[int]] = []
    for begin, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
        low, high = int(starts[begin]), int(ends[end - 1])
        low -= agreement(data[max(0, low - EXTEND) : low][::-1], around.get((begin, 0), b"")[::-1])
        high += agreement(data[high : high + EXTEND], around.get((end - 1, 1), b""))
        while runs and low <= runs[-1][1]:
            before = runs.pop()
            low, high = min(low, before[0]), max(high, before[1])
        runs.append([low, high])
    out, at = [], 0
    for low, high in runs:
        low, high = whole_words(data, low, high)
        if count_words(data[low:high]) >= MIN_WORDS:
            out.append(data[at:low])
            at = high
    out.append(data[at:])
    return b"".join(out)


def dedup_substrings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars", removed: str | None = None
) -> DataFrame:
    """`docs` without the passages that repeat earlier ones; `n_chars` is set for changed texts.

    Of equal passages the one in the smallest document id (null first) stays. Null texts stay null and empty
    ones empty; a text that equals an earlier one, however short, becomes empty and its row stays. Rows that agree
    in id and text count as one and stay alike; rows that share an id only are ordered by a hash of the text. An empty table
    gives an empty result. `removed` names a column to append: the characters cut out (long).
    """
    mark, flag, key, list_, around_ = own("mark", "flag", "key", "list", "around")
    columns = [*docs.columns, *([removed] if removed else [])]
    marked = docs.withColumn(mark, F.pmod(F.xxhash64(F.col(f"`{text}`")), F.lit(1 << 31)).cast("int"))
    if removed:
        marked = marked.withColumn(removed, F.lit(0).cast("long"))
    found = repeated_chunks(marked, doc_id, text, mark)
    number = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("number")
    item = F.struct(number, "settled", F.xxhash64("to_doc").alias("to_id"), "to_place")
    # A text is named by a hash of its id (64 bits) and one of its text (31), so that null ids join too.
    lists = materialise(
        found.groupBy(F.xxhash64("doc").alias("id"), F.shiftrightunsigned("place", 32).cast("int").alias("mark")).agg(
            F.sort_array(F.collect_set(item)).alias("items")
        )
    )
    around = surroundings(lists, marked, doc_id, text, mark)
    named = lambda df, column, name: df.select(F.col("id").alias(key), F.col("mark").alias(mark), F.col(column).alias(name))
    # Documents without repeats are not shuffled.
    marked = marked.withColumn(key, F.xxhash64(F.col(f"`{doc_id}`")))
    flagged = may_need(marked, needed(lists, bucket_of("id", "mark")), bucket_of(key, mark), flag)
    touched = flagged.where(F.col(flag)).join(named(lists, "items.number", list_), [key, mark], "left")
    touched = touched.join(named(around, "around", around_), [key, mark], "left")

    counted = n_chars is not None and n_chars in docs.columns

    def run(batches):
        for batch in batches:
            for part in weigh([batch], text, BATCH_BYTES):
                column = part.column(text)
                data, starts, ends, first = chunks(column)
                _, offsets = string_buffers(column)
                raw = data.tobytes()
                texts, gone = column.to_pylist(), [0] * part.num_rows
                asked = part.column(around_)
                for i, repeats in enumerate(part.column(list_).to_pylist()):
                    if repeats:
                        near = {(n["number"], n["side"]): n["around"] for n in asked[i].as_py() or ()}
                        a, b, low = first[i], first[i + 1], offsets[i]
                        whole = raw[low : offsets[i + 1]]
                        cut = cut_repeats(whole, starts[a:b] - low, ends[a:b] - low, np.array(repeats), near)
                        if len(cut) != len(whole):
                            shorter = cut.decode()
                            gone[i] = len(texts[i]) - len(shorter)
                            texts[i] = shorter
                fresh = {text: pa.array(texts, pa.string())}
                if removed:
                    fresh[removed] = pa.array(gone, pa.int64())
                if counted:
                    old = part.column(n_chars)
                    new = pa.array([len(t) if g else None for t, g in zip(texts, gone)], old.type)
                    fresh[n_chars] = pa.compute.coalesce(new, old)
                yield pa.RecordBatch.from_arrays([fresh.get(c, part.column(c)) for c in columns], names=columns)

    quoted = [F.col(f"`{c}`") for c in columns]
    plain = flagged.where(~F.col(flag)).select(*quoted)
    return touched.mapInArrow(run, plain.schema).unionByName(plain)


def op10_substrings(spark, sf_dir: str) -> DataFrame:
    """Every document without the passages that repeat earlier ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return dedup_substrings(docs, removed="n_removed")


QUERIES = {"op10_substrings": op10_substrings}
ORACLES: dict[str, str] = {}
