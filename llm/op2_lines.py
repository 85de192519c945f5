"""Line dedup by an exact set-similarity join over word sets.

1. Words are counted in a table of hashed buckets of fixed size. Its counts give one order of all words,
   rare ones first, and bound how many lines a word can be in.
2. Each line becomes a signature: the digest and size of its word set, a parity bitmap (of twice the bits if
   the set is large), and the first words of the set in rarity order. A set of n words that is similar to
   another shares a word among its first n - ceil(t n) + 1. Words that no other line can have are left out.
   Equal lines of a batch are collapsed at once, those of the corpus after a shuffle by digest.
3. Lines that share a prefix word meet in one task, in document order, and look back for earlier lines that
   pass the length, positional and bitmap filters. Words with many lines are cut into pairs of pieces.
   The postings travel some dozens to a row, and each bucket of them is sorted at once.
   Each look-up stops after a few candidates; lines that none of these explains are asked again without
   that stop, so no match is lost and no group is expanded into all its pairs.
4. Candidates are verified on the whole word sets; lines with an earlier match are removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.bits import as_array, bucket_of, may_need, needed, test
from llm.frames import materialise, own, table
from llm.text import IS_SPACED_WORD, mix, string_buffers, weigh, words

#: Jaccard threshold as a fraction.
SIMILAR = (4, 5)
BUCKET_BITS = 22
BLOCK_BITS = 16
BATCH_BYTES = 1 << 20
#: Lines of one word compared in one task, and candidates (near certain, any) after which a look-up stops.
PIECE = 8192
ENOUGH = (2, 64)
#: Differing words up to which the 64-bit (128-bit) bitmaps of unrelated sets are nearly always further apart.
SURE, SURE_WIDE = 16, 42
#: Words from which a set has a bitmap of 128 bits.
WIDE = 64
#: Lines of a word up to which all of them are compared with those before them at once, step by step.
FEW = 1024
#: Postings sorted in one bucket, dealt out at a time, and sent in one row.
BUCKET, DEAL, CHUNK = 3 << 18, 1 << 18, 64
NEWLINE = 0x0A


def line_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a batch, the line (numbered through the batch) of each, and where each text's lines begin."""
    found = words(column, IS_SPACED_WORD)
    borders, first_line = line_borders(*string_buffers(column))
    line = np.repeat(np.arange(len(borders) - 1), np.diff(np.searchsorted(found.starts, borders)))
    return found.hashes(), line, first_line


def line_borders(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each line of a batch of texts begins, then where the last ends; and the number of each text's first line."""
    breaks = np.flatnonzero(data == NEWLINE)
    first_line = np.searchsorted(breaks, offsets) + np.arange(len(offsets))
    # Where an empty line and the next text begin at one byte, the last of the lines there has the words.
    return np.append(np.sort(np.concatenate([offsets[:-1], breaks + 1])), len(data)).astype(np.int64), first_line


def split_lines(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lines of a batch of texts, each with the break that ends it, and the number of each text's first line."""
    data, offsets = string_buffers(column)
    borders, first_line = line_borders(data, offsets)
    buffers = [None, pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_string(), len(borders) - 1, buffers), first_line


class Counts:
    """Bucket counts of words: an upper bound of the lines that have a word."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts = counts

    @staticmethod
    def bucket(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return self.counts[self.bucket(hashes)].astype(np.int64)

    @staticmethod
    def gather(docs: DataFrame, text: str) -> Counts:
        """Counted over all texts. Tasks emit what they saw in blocks, and blocks are added up in two steps."""

        def count(batches):
            counts = np.zeros(1 << BUCKET_BITS, np.uint32)
            for batch in batches:
                for part in weigh([batch], text, BATCH_BYTES):
                    np.add.at(counts, Counts.bucket(words(part.column(text), IS_SPACED_WORD).hashes()), np.uint32(1))
            blocks = counts.reshape(-1, 1 << BLOCK_BITS)
            rows = [(k, np.flatnonzero(b)) for k, b in enumerate(blocks) if b.any()]
            salt = int(counts.sum() % 61)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _ in rows], pa.int32()),
                    pa.array([salt] * len(rows), pa.int32()),
                    pa.array([at.astype(np.uint16).tobytes() for _, at in rows], pa.binary()),
                    pa.array([blocks[k][at].astype(np.int64).tobytes() for k, at in rows], pa.binary()),
                ],
                names=["block", "salt", "places", "counts"],
            )

        def add(rows: pa.Table) -> pa.Table:
            total = np.zeros(1 << BLOCK_BITS, np.int64)
            for places, counts in zip(rows["places"].to_pylist(), rows["counts"].to_pylist()):
                total[np.frombuffer(places, np.uint16)] += np.frombuffer(counts, np.int64)
            at = np.flatnonzero(total)
            return rows.slice(0, 1).set_column(2, "places", pa.array([at.astype(np.uint16).tobytes()])).set_column(
                3, "counts", pa.array([total[at].tobytes()])
            )

        schema = "block int, salt int, places binary, counts binary"
        parts = docs.select(text).mapInArrow(count, schema)
        for keys in (["block", "salt"], ["block"]):
            parts = parts.groupBy(*keys).applyInArrow(add, schema)
        counts = np.zeros(1 << BUCKET_BITS, np.uint32)
        for row in parts.toLocalIterator():
            begin = row["block"] << BLOCK_BITS
            counts[begin + np.frombuffer(row["places"], np.uint16).astype(np.int64)] = np.minimum(
                np.frombuffer(row["counts"], np.int64), 2**32 - 1
            )
        return Counts(counts)


def rarity_order(hashes: np.ndarray, line: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Order by line, rarity and hash. Rarity is the count to a 64th of its magnitude, so that all three fit one sort key.

    Ties between different hashes of a line would hide repeated words; a batch that has one is sorted in full.
    """
    rarity = (np.log2(weight + 1) * 64).astype(np.uint64)
    if len(line) and int(line[-1]) < 1 << 20:
        key = line.astype(np.uint64) << np.uint64(44) | rarity << np.uint64(32) | hashes >> np.uint64(32)
        order = np.argsort(key)
        key, sorted_ = key[order], hashes[order]
        if not ((key[1:] == key[:-1]) & (sorted_[1:] != sorted_[:-1])).any():
            return order
    return np.lexsort((hashes, rarity, line))


#: Low bits of a token, which hold its place.
MOST_AT = (1 << 24) - 1


def signatures(hashes: np.ndarray, line: np.ndarray, counts: Counts) -> dict[str, np.ndarray]:
    """Of each line with words: number, set size, digest, parity bitmaps, and its prefix words (flat).

    `token` packs the top 40 bits of a prefix word's hash and its place. `wide` is, for large sets, the parity of the words
    that fill one half of a bitmap of 128 bits; `bitmap` is that of all words, both halves laid over each other.
    """
    weight = counts.of(hashes)
    order = rarity_order(hashes, line, weight)
    hashes, line, weight = hashes[order], line[order], weight[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (line[1:] != line[:-1]) | (hashes[1:] != hashes[:-1])
    hashes, line, weight = hashes[new], line[new], weight[new]
    numbers, begin, size = np.unique(line, return_index=True, return_counts=True)
    if not len(numbers):
        return {"line": numbers, "size": size}
    place = np.arange(len(line)) - np.repeat(begin, size)
    top, low = SIMILAR
    prefix = size - (top * size + low - 1) // low + 1
    kept = (place < np.repeat(prefix, size)) & (weight > 1)
    bit = np.uint64(1) << (hashes & np.uint64(63))
    half = np.where((hashes & np.uint64(64) != 0) & (np.repeat(size, size) >= WIDE), bit, np.uint64(0))
    return {
        "line": numbers,
        "size": size,
        "digest": np.add.reduceat(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), begin),
        "bitmap": np.bitwise_xor.reduceat(bit, begin),
        "wide": np.bitwise_xor.reduceat(half, begin),
        # a smaller place only weakens the positional filter
        "token": hashes[kept] & ~np.uint64(MOST_AT) | np.minimum(place[kept], MOST_AT).astype(np.uint64),
        "tokens": np.bincount(np.repeat(np.arange(len(numbers)), size)[kept], minlength=len(numbers)),
    }


def _take(column, rows: np.ndarray) -> pa.Array:
    return column.take(pa.array(rows, pa.int64()))


def pack(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The pieces of `values` between offsets, as bytes: they pass through the JVM in one go."""
    width = values.dtype.itemsize
    buffers = [None, pa.py_buffer((offsets * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def unpack(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of packed pieces one after the other, and how many each has."""
    column = column.cast(pa.large_binary())
    lengths = pa.compute.binary_length(column).to_numpy(zero_copy_only=False)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    if len(raw) != lengths.sum():
        raise ValueError("a packed column must not be null")
    values = np.frombuffer(raw.tobytes(), kind)
    return values, lengths.astype(np.int64) // values.itemsize


def _lines(docs: DataFrame, counts, doc: str, text: str, mark: str) -> DataFrame:
    """One row for each line with words: document, mark of the text and line number in `place`, and the signature.

    Lines that repeat an earlier one of their batch come without a signature (`digest` null).
    """
    kind = docs.schema[doc].dataType.simpleString()
    schema = (
        f"doc {kind}, place bigint, digest bigint, size int, bitmap bigint, wide bigint, token binary"
    )

    def run(batches):
        for batch in batches:
            for part in weigh([batch], text, BATCH_BYTES):
                hashes, line, first_line = line_words(part.column(text))
                sig = signatures(hashes, line, counts.value)
                if not len(sig["line"]):
                    continue
                row = np.searchsorted(first_line, sig["line"], side="right") - 1
                marks = part.column(mark).to_numpy(zero_copy_only=False)
                place = (marks[row].astype(np.int64) << 32) | (sig["line"] - first_line[row])
                docs_ = _take(part.column(doc), row)
                ranks = pa.compute.rank(part.column(doc), "ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
                order = np.lexsort((place, ranks[row], sig["size"], sig["bitmap"], sig["digest"]))
                same = np.zeros(len(order), bool)
                same[1:] = True
                for name in ("digest", "bitmap", "size"):
                    values = sig[name][order]
                    same[1:] &= values[1:] == values[:-1]
                head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
                twin = same & (ranks[row[order]] == ranks[row[head]]) & (place[order] == place[head])
                later = np.zeros(len(order), bool)
                later[order[same & ~twin]] = True
                ends = np.cumsum(sig["tokens"])
                mask = pa.array(later)
                null = lambda column: pa.compute.if_else(mask, pa.scalar(None, column.type), column)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs_,
                        pa.array(place),
                        null(pa.array(sig["digest"].view(np.int64))),
                        pa.array(sig["size"].astype(np.int32)),
                        pa.array(sig["bitmap"].view(np.int64)),
                        pa.array(sig["wide"].view(np.int64)),
                        null(pack(sig["token"], np.concatenate([[0], ends]))),
                    ],
                    names=["doc", "place", "digest", "size", "bitmap", "wide", "token"],
                )

    return docs.mapInArrow(run, schema)


#: A posting that stands for a line whose word set an earlier line has too.
AGAIN = -1


#: The fields of postings that travel as bytes.
PACKED = {"key": np.uint32, "place": np.int64, "meta": np.int64, "bitmap": np.uint64, "wide": np.uint64}


def _dealt(held: list[tuple], parts: int):
    """Postings, given as `(bucket, doc, fields)`, as rows that each hold at most `CHUNK` postings of one bucket."""
    bucket = np.concatenate([h[0] for h in held]).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    doc = _take(pa.concat_arrays([h[1] for h in held]), order)
    fields = {c: np.concatenate([h[2][c] for h in held])[order] for c in PACKED}
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    until = np.append(first[1:], len(bucket))
    rows = -(-(until - first) // CHUNK)
    number = np.arange(int(rows.sum())) - np.repeat(np.cumsum(rows) - rows, rows)
    begin = np.repeat(first, rows) + CHUNK * number
    ends = np.append(begin, len(bucket))
    for i in range(0, len(begin), 1024):
        j = min(len(begin), i + 1024)
        offsets = ends[i : j + 1] - ends[i]
        ids = bucket[begin[i:j]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids % parts, pa.int32()),
                pa.array(ids // parts, pa.int32()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), doc.slice(ends[i], ends[j] - ends[i])),
                *(pack(v[ends[i] : ends[j]], offsets) for v in fields.values()),
            ],
            names=["part", "bucket", "doc", *fields],
        )


def _postings(lines: DataFrame, counts) -> DataFrame:
    """The first line of each word set, once for each prefix word (and for each pair of pieces, if the word has many lines).

    A row holds postings of one `bucket` of the task `part`, each field packed. `key` is of the word's hash, mixed with the
    pair of pieces; `meta` packs whether the line asks, the side in the pair, the set's size and the place of the word. Two
    words that share a key only meet for nothing. Lines that repeat a word set come once, with `AGAIN` as `meta`.
    """
    kind = lines.schema["doc"].dataType.simpleString()
    one = lines.where("digest IS NOT NULL").repartition("digest", "bitmap", "size")
    one = one.sortWithinPartitions("digest", "bitmap", "size", "doc", "place")
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A set's prefix has about a fifth of its words.
    buckets = parts * (1 + int(counts.value.counts.sum(dtype=np.int64)) // (5 * parts * BUCKET))

    def posted(batch: pa.RecordBatch, rows: np.ndarray, key: np.ndarray, meta: np.ndarray) -> tuple:
        fields = {"key": (key >> np.uint64(8)).astype(np.uint32), "meta": meta, "place": batch.column("place").to_numpy()[rows]}
        for name in ("bitmap", "wide"):
            fields[name] = batch.column(name).to_numpy().view(np.uint64)[rows]
        return key % np.uint64(buckets), _take(batch.column("doc"), rows), fields

    def run(batches):
        last, line, past = None, None, False
        held: list[tuple] = []
        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("digest", "bitmap", "size")], axis=1)
            first = np.ones(len(keys), bool)
            first[1:] = (keys[1:] != keys[:-1]).any(axis=1)
            first[0] = last is None or (keys[0] != last).any()
            # A row of the very line that stands for its set is that line.
            doc, place = batch.column("doc"), batch.column("place").to_numpy()
            ranks = pa.compute.rank(doc, "ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
            other = np.zeros(len(keys), bool)
            other[1:] = (ranks[1:] != ranks[:-1]) | (place[1:] != place[:-1])
            other[0] = not first[0] and (past or (doc[0].as_py(), place[0]) != line)
            others = np.cumsum(other & ~first)
            head = np.maximum.accumulate(np.where(first, np.arange(len(keys)), -1))
            later = others > np.where(head < 0, 0, others[head])
            last, line, past = keys[-1], (doc[-1].as_py(), place[-1]), bool(later[-1])
            again = np.flatnonzero(later)
            if len(again):
                key = keys[again, 0].view(np.uint64)
                held.append(posted(batch, again, key, np.full(len(again), AGAIN)))
                count += len(again)
            part = batch.take(pa.array(np.flatnonzero(first)))
            token, n = unpack(part.column("token"), np.uint64)
            row = np.repeat(np.arange(len(n)), n)
            digest = part.column("digest").to_numpy().view(np.uint64)
            asks = part.column("ask").to_numpy(zero_copy_only=False).astype(np.int64)
            packed = asks << 62 | part.column("size").to_numpy().astype(np.int64) << 30
            at = (token & np.uint64(MOST_AT)).astype(np.int64)
            times = -(-counts.value.of(token) // PIECE)
            word = token >> np.uint64(24)
            ends = np.cumsum(times)
            total = int(ends[-1]) if len(ends) else 0
            for begin in range(0, total, DEAL):
                # copy k of posting p pairs its piece with piece k
                number = np.arange(begin, min(total, begin + DEAL))
                p = np.searchsorted(ends, number, side="right")
                other = number - (ends[p] - times[p])
                piece = (digest[row[p]] % times[p].astype(np.uint64)).astype(np.int64)
                low, high = np.minimum(piece, other), np.maximum(piece, other)
                cell = (low << 32 | high).astype(np.uint64)
                key = np.where(high > 0, mix(word[p] ^ mix(cell)) >> np.uint64(24), word[p])
                side = np.where(low == high, 0, np.where(piece == high, 2, 1))
                r = row[p]
                held.append(posted(part, r, key, packed[r] | side << 60 | at[p]))
                count += len(r)
                if count >= DEAL:
                    yield from _dealt(held, parts)
                    held, count = [], 0
        if count:
            yield from _dealt(held, parts)

    schema = f"part int, bucket int, doc array<{kind}>, " + ", ".join(f"{c} binary" for c in PACKED)
    return one.mapInArrow(run, schema).repartitionById(parts, "part").sortWithinPartitions("bucket")


def look_back(group: np.ndarray, meta: np.ndarray, bitmap: np.ndarray, wide: np.ndarray, enough: tuple[int, int]):
    """Pairs `(x, y, more)` of rows of one group, y before x, that pass the filters; only rows that ask look back.

    Where few differences are allowed, the bitmap filter is nearly always right: a row stops after `enough[0]` such pairs, or
    after `enough[1]` of any kind; `more` tells that it had others to look at.
    """
    top, low = SIMILAR
    # Long groups first, so that the rows of those with more than d rows are the first ones.
    length = np.bincount(group)[group]
    order = np.argsort(-length, kind="stable")
    group, meta, bitmap, wide, length = (v[order] for v in (group, meta, bitmap, wide, length))
    side, size, at = meta >> 60 & 3, meta >> 30 & ((1 << 30) - 1), meta & ((1 << 30) - 1)
    large = size >= WIDE
    # Two sets that are similar differ in a share of their sizes; as 64 bits can't say more, so large a size will do.
    weight = np.minimum((low - top) * size, 1 << 16).astype(np.int32)
    new = np.concatenate([[True], group[1:] != group[:-1]])
    room = np.arange(len(group)) - np.maximum.accumulate(np.where(new, np.arange(len(group)), 0))
    sure, found = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
    asks = meta >> 62 & 1 == 1
    out = []

    def look(x: np.ndarray, y: np.ndarray) -> bool:
        """All filters, for pairs that passed the first; whether a row has enough now."""
        total = size[x] + size[y]
        overlap = (top * total + top + low - 1) // (top + low)
        differ = total - 2 * overlap
        both, apart = large[x] & large[y], wide[x] ^ wide[y]
        whole = bitmap[x] ^ bitmap[y]
        apart = np.bitwise_count(apart).astype(np.int64) + np.bitwise_count(apart ^ whole)
        ok = np.where(both, apart, np.bitwise_count(whole)) <= differ
        ok &= low * np.minimum(size[x], size[y]) >= top * np.maximum(size[x], size[y])
        ok &= np.minimum(size[x] - at[x], size[y] - at[y]) >= overlap
        ok &= (side[x] == 0) | (side[x] != side[y])
        x, y = x[ok], y[ok]
        found[x] += 1
        sure[x[(differ <= np.where(both, SURE_WIDE, SURE))[ok]]] += 1
        out.append((x, y))
        full = x[(sure[x] >= enough[0]) | (found[x] >= enough[1])]
        asks[full] = False
        return len(full) > 0

    begin = int(np.searchsorted(-length, -FEW))
    for d in range(1, FEW):
        end = int(np.searchsorted(-length, -d))
        if end - begin <= d:
            break
        apart = np.multiply(np.bitwise_count(bitmap[begin + d : end] ^ bitmap[begin : end - d]), top + low, dtype=np.int32)
        x = np.flatnonzero(apart <= weight[begin + d : end] + weight[begin : end - d]) + begin + d
        x = x[asks[x] & (room[x] >= d)]
        if len(x):
            look(x, x - d)
    x = np.flatnonzero(asks[:begin])
    d = 1
    while len(x := x[room[x] >= d]):
        apart = np.multiply(np.bitwise_count(bitmap[x] ^ bitmap[x - d]), top + low, dtype=np.int32)
        near = x[apart <= weight[x] + weight[x - d]]
        if len(near) and look(near, near - d):
            x = x[asks[x]]
        d += 1
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    xs, ys = np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])
    return order[xs], order[ys], (sure[xs] >= enough[0]) | (found[xs] >= enough[1])


def _candidates(postings: DataFrame, enough: tuple[int, int]) -> DataFrame:
    """Candidate pairs `(doc, place)` with an earlier `(to_doc, to_place)`, and whether the look-up was cut short.

    Lines whose word set an earlier line has come with a null `to_place`.
    """
    kind = next(f.dataType.elementType for f in postings.schema if f.name == "doc").simpleString()
    schema = f"doc {kind}, place bigint, to_doc {kind}, to_place bigint, more boolean"
    names = ["doc", "place", "to_doc", "to_place", "more"]

    def flush(held: list[pa.RecordBatch]):
        doc = pa.concat_arrays([rows.column("doc").flatten() for rows in held])
        fields = {c: np.concatenate([unpack(rows.column(c), t)[0] for rows in held]) for c, t in PACKED.items()}
        key, place, meta = fields["key"], fields["place"], fields["meta"]
        again = np.flatnonzero(meta == AGAIN)
        for begin in range(0, len(again), 1 << 16):
            i = again[begin : begin + (1 << 16)]
            nothing = [pa.nulls(len(i), doc.type), pa.nulls(len(i), pa.int64())]
            yield pa.RecordBatch.from_arrays([_take(doc, i), pa.array(place[i]), *nothing, pa.array(np.zeros(len(i), bool))], names=names)
        one = np.flatnonzero(meta != AGAIN)
        order = one[np.argsort(key[one], kind="stable")]
        same = key[order][1:] == key[order][:-1]
        met = np.zeros(len(order), bool)
        met[1:] |= same
        met[:-1] |= same
        order = order[met]
        if not len(order):
            return
        if pa.types.is_integer(doc.type) and not doc.null_count:
            ranks = doc.to_numpy()[order]
        else:
            ranks = pa.compute.rank(_take(doc, order), "ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
        order = order[np.lexsort((place[order], ranks, key[order]))]
        group = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        x, y, more = look_back(group, meta[order], fields["bitmap"][order], fields["wide"][order], enough)
        x, y = order[x], order[y]
        for begin in range(0, len(x), 1 << 16):
            i, j = x[begin : begin + (1 << 16)], y[begin : begin + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [_take(doc, i), pa.array(place[i]), _take(doc, j), pa.array(place[j]), pa.array(more[begin : begin + (1 << 16)])],
                names=names,
            )

    def run(batches):
        held: list[pa.RecordBatch] = []
        bucket = None
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            borders = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])) if len(buckets) else []
            for begin, end in zip(borders, [*borders[1:], len(buckets)]):
                if held and buckets[begin] != bucket:
                    yield from flush(held)
                    held = []
                bucket = buckets[begin]
                held.append(batch.slice(begin, end - begin))
        if held:
            yield from flush(held)

    return postings.mapInArrow(run, schema)


#: Buckets of lines and of words: a map of two megabytes.
FINE = 1 << 24


def _line_bucket(place):
    """Bucket of a line by its text's mark and its number; for columns and for arrays."""
    if isinstance(place, str):
        mark, line = F.shiftrightunsigned(place, 32), F.col(place).bitwiseAND(F.lit(0xFFFFFFFF))
        return F.pmod(mark * 40503 + line * 1000003, F.lit(FINE))
    return ((place >> 32) * 40503 + (place & 0xFFFFFFFF) * 1000003) % FINE


def _only(lines: DataFrame, open_: DataFrame) -> DataFrame:
    """The signed lines, reduced to the prefix words that a line of `open_` has too."""
    same = F.col("l.doc").eqNullSafe(F.col("o.doc")) & (F.col("l.place") == F.col("o.place"))
    lines = lines.where("digest IS NOT NULL")
    theirs = lines.alias("l").join(open_.alias("o"), same, "left_semi").select("token")

    def each(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(unpack(batch.column("token"), np.int64)[0])], names=["token"])

    words_ = theirs.mapInArrow(each, "token bigint")
    bits = as_array(needed(words_, F.shiftrightunsigned("token", 40)), FINE)
    sent = lines.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            token, n = unpack(batch.column("token"), np.uint64)
            kept = test(sent.value, (token >> np.uint64(40)).astype(np.int64))
            counts = np.bincount(np.repeat(np.arange(len(n)), n)[kept], minlength=len(n))
            fresh = pack(token[kept], np.concatenate([[0], np.cumsum(counts)]))
            columns = [fresh if c == "token" else batch.column(c) for c in batch.schema.names]
            out = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
            yield out.filter(pa.array(counts > 0))

    return lines.mapInArrow(run, lines.schema)


def _sets(docs: DataFrame, doc: str, text: str, mark: str, wanted) -> DataFrame:
    """The whole word set of the lines of `docs` whose bucket is in `wanted`."""
    kind = docs.schema[doc].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in weigh([batch], text, BATCH_BYTES):
                lines, first_line = split_lines(part.column(text))
                marks = part.column(mark).to_numpy(zero_copy_only=False).astype(np.int64)
                all_lines = np.arange(len(lines))
                row = np.searchsorted(first_line, all_lines, side="right") - 1
                places = (marks[row] << 32) | (all_lines - first_line[row])
                kept = np.flatnonzero(test(wanted.value, _line_bucket(places)))
                found = words(_take(lines, kept), IS_SPACED_WORD)
                hashes, line = found.hashes(), kept[found.text_of()]
                order = np.lexsort((hashes, line))
                hashes, line = hashes[order], line[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (line[1:] != line[:-1]) | (hashes[1:] != hashes[:-1])
                hashes, line = hashes[new], line[new]
                numbers, begin = np.unique(line, return_index=True)
                offsets = pa.array(np.append(begin, len(line)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        _take(part.column(doc), row[numbers]),
                        pa.array(places[numbers]),
                        pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64))),
                    ],
                    names=["doc", "place", "words"],
                )

    return docs.mapInArrow(run, f"doc {kind}, place bigint, words array<bigint>")


def _verified(pairs: DataFrame, docs: DataFrame, doc: str, text: str, mark: str) -> DataFrame:
    """The lines `(doc, place)` of `pairs` that are similar to one of their candidates."""
    top, low = SIMILAR
    # Documents by a hash of their id, so that null ids join too and one exchange serves all steps.
    id_, to = F.xxhash64("doc"), F.xxhash64("to_doc")
    both = pairs.select(id_.alias("id"), "place").unionByName(pairs.select(to.alias("id"), F.col("to_place").alias("place")))
    bits = docs.sparkSession.sparkContext.broadcast(as_array(needed(both, _line_bucket("place")), FINE))
    sets = _sets(docs, doc, text, mark, bits).select(id_.alias("id"), "place", "words")
    sets = materialise(sets.join(both.distinct(), ["id", "place"], "left_semi").dropDuplicates(["id", "place"]))
    own_ = sets.withColumnRenamed("words", "own")
    other = sets.select(F.col("id").alias("to"), F.col("place").alias("to_place"), "words")
    joined = pairs.withColumns({"id": id_, "to": to}).join(own_, ["id", "place"]).join(other, ["to", "to_place"])
    shared, total = F.size(F.array_intersect("own", "words")), F.size("own") + F.size("words")
    return joined.where((top + low) * shared >= top * total).select("doc", "place").distinct()


def removed_lines(docs: DataFrame, doc: str, text: str, mark: str) -> DataFrame:
    """Lines to remove as `(doc, place)`; `place` holds the text's mark and the line number."""
    source = docs.select(doc, text, mark)
    counts = docs.sparkSession.sparkContext.broadcast(Counts.gather(source, text))
    lines = materialise(_lines(source, counts, doc, text, mark))
    first = _postings(lines.withColumn("ask", F.lit(True)), counts)
    found = materialise(
        _candidates(first, ENOUGH).groupBy("doc", "place", "to_doc", "to_place").agg(F.max("more").alias("more"))
    )
    exact = found.where("to_place IS NULL").select("doc", "place")
    pairs = found.where("to_place IS NOT NULL")
    similar = materialise(_verified(pairs.drop("more"), source, doc, text, mark))
    same = lambda a, b: F.col(f"{a}.doc").eqNullSafe(F.col(f"{b}.doc")) & (F.col(f"{a}.place") == F.col(f"{b}.place"))
    asking = pairs.where("more").select("doc", "place").distinct()
    open_ = materialise(asking.alias("o").join(similar.alias("s"), same("o", "s"), "left_anti"))
    if not open_.isEmpty():
        asked = _only(lines, open_).alias("p").join(open_.withColumn("ask", F.lit(True)).alias("o"), same("p", "o"), "left")
        asked = asked.select("p.*", F.coalesce("ask", F.lit(False)).alias("ask"))
        rest = _candidates(_postings(asked, counts), (1 << 60, 1 << 60)).where("to_place IS NOT NULL")
        rest = materialise(rest.drop("more").distinct())
        similar = similar.unionByName(_verified(rest, source, doc, text, mark))
    inside = lines.where("digest IS NULL").select("doc", "place")
    return similar.unionByName(exact).unionByName(inside)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """`docs` without the lines that are similar to an earlier line; `n_chars` is set for changed texts.

    Lines are what `\\n` separates; a line is the set of its words, A-Z lower-cased, and similar lines have a
    Jaccard similarity of 0.8 or more. Earlier is by document id (null first), then line number. Lines without
    words stay. A text that loses all lines becomes empty and its row stays; null texts stay null. Rows that
    agree in id and text count as one and keep the same lines; rows that share an id only are ordered by a hash
    of the text. An empty table gives an empty result.
    """
    mark, drop, flag, key, mine = own("mark", "drop", "flag", "key", "mine")
    marked = docs.withColumn(mark, F.pmod(F.xxhash64(F.col(f"`{text}`")), F.lit(1 << 31)).cast("int"))
    gone = materialise(removed_lines(marked, doc_id, text, mark))
    lists = gone.groupBy(F.col("doc").alias(key), F.shiftrightunsigned("place", 32).cast("int").alias(mine)).agg(
        F.collect_set(F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")).alias(drop)
    )
    # Documents that keep all their lines are not shuffled.
    flagged = may_need(marked, needed(lists, bucket_of(key, mine)), bucket_of(doc_id, mark), flag)
    touched = flagged.where(F.col(flag)).join(
        lists, F.col(f"`{doc_id}`").eqNullSafe(F.col(key)) & (F.col(mark) == F.col(mine)), "left"
    )
    kept = F.filter(
        F.split(F.col(f"`{text}`"), "\n", -1), lambda line, i: ~F.array_contains(F.col(drop), i)
    )
    shorter = F.when(F.col(drop).isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(f"`{text}`"))
    touched = touched.withColumn(text, shorter)
    if n_chars is not None and n_chars in docs.columns:
        count = F.when(F.col(drop).isNotNull(), F.length(F.col(f"`{text}`")).cast(docs.schema[n_chars].dataType))
        touched = touched.withColumn(n_chars, F.coalesce(count, F.col(f"`{n_chars}`")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return touched.select(*columns).unionByName(flagged.where(~F.col(flag)).select(*columns))


def op2_lines(spark, sf_dir: str) -> DataFrame:
    """Every document with its lines that have no similar earlier line."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    kept = dedup_lines(docs)
    return kept.select(
        "doc_id", "text", "n_chars", F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long").alias("n_lines")
    )


QUERIES = {"op2_lines": op2_lines}
ORACLES: dict[str, str] = {}
