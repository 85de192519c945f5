"""Language-model scores by a hidden Markov model.

The hidden states emit classes of words: each frequent word is a class, others share one with words of the
same ending, and the end of a text is one. A word has the probability of its class, given the states, times its
share in the class. Word counts come from all training texts. Baum-Welch runs on all of them too: a task
turns its texts into expected counts, which are added up across partitions. Texts are scored by the exact, scaled
forward recursion; that of a long text is cut into pieces, whose products of transition matrices are computed side by
side and then chained.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.frames import crc_part, materialise, table
from llm.text import IS_SPACED_WORD, span_hashes, weigh, words

STATES = 8
#: Classes: 0 is the end of a text, then one for each of the most frequent words, then one for each slot of endings.
FREQUENT, ENDINGS = 2047, 2048
CLASSES = 1 + FREQUENT + ENDINGS
ENDING_BYTES = 3
#: Rounds of Baum-Welch, each on all training texts.
ROUNDS = 12
#: Tokens in a window of training and in a piece of scoring.
WINDOW, PIECE = 256, 256
#: Windows handled side by side in training, and steps between two scalings of them.
SIDE, SCALED = 512, 8
#: Text read at a time; text and distinct words of a chunk, and words in a bucket, about.
BATCH_BYTES = 2 << 20
CHUNK_BYTES, CHUNK_WORDS = 64 << 20, 1 << 20
BUCKET_WORDS = 1 << 19
BATCH_TOKENS = 1 << 18
SEED = 20


# ---- texts to coded rows ------------------------------------------------------------------------


def pack(numbers: np.ndarray) -> bytes:
    """Word numbers below 2**24 as their low halves, then their high bytes, which compress well."""
    return (numbers & 0xFFFF).astype(np.uint16).tobytes() + (numbers >> 16).astype(np.uint8).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    size = len(raw) // 3
    return np.frombuffer(raw, np.uint16, size).astype(np.int64) | (np.frombuffer(raw, np.uint8, size, 2 * size).astype(np.int64) << 16)


class Dictionary:
    """Numbers the distinct words of a chunk in order of appearance, and counts them in training texts."""

    def __init__(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.number = np.zeros(0, np.int64)
        self.hashes: list[np.ndarray] = []
        self.endings: list[np.ndarray] = []
        self.counts = np.zeros(0, np.int64)
        self.bytes = 0

    def add(self, found, train: np.ndarray) -> np.ndarray:
        """Number of each word of `found`; `train` marks words of training texts."""
        distinct, first, local = np.unique(found.hashes(), return_index=True, return_inverse=True)
        slot = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        if len(self.known):
            new = self.known[np.minimum(slot, len(self.known) - 1)] != distinct
        some = np.flatnonzero(new)
        some = some[np.argsort(first[some])]
        starts, ends = found.starts[first[some]], found.ends[first[some]]
        ending = span_hashes(found.data, np.maximum(starts, ends - ENDING_BYTES), ends) % np.uint64(ENDINGS)
        self.hashes.append(distinct[some])
        self.endings.append(ending.astype(np.int16))
        number = np.empty(len(distinct), np.int64)
        number[some] = len(self.counts) + np.arange(len(some))
        number[~new] = self.number[slot[~new]]
        known = np.concatenate([self.known, distinct[some]])
        order = np.argsort(known)
        self.known, self.number = known[order], np.concatenate([self.number, number[some]])[order]
        self.counts = np.concatenate([self.counts, np.zeros(len(some), np.int64)])
        numbers = number[local]
        self.counts += np.bincount(numbers[train], minlength=len(self.counts))
        self.bytes += len(found.data)
        return numbers

    def full(self) -> bool:
        return self.bytes >= CHUNK_BYTES or len(self.counts) >= CHUNK_WORDS


def _code(docs: DataFrame) -> DataFrame:
    """Texts by chunk: `kind` 1 rows with each text's word numbers, and a `kind` 0 row with the chunk's distinct words.

    Of the distinct words, `a` holds the hashes, `b` the slots of their endings, `c` their counts in training texts.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"chunk bigint, kind int, doc_id {kind}, held boolean, a binary, b binary, c binary"

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        book = Dictionary()
        id_type = None

        def close():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([0], pa.int32()),
                    pa.nulls(1, id_type),
                    pa.nulls(1, pa.bool_()),
                    pa.array([np.concatenate(book.hashes).tobytes()], pa.binary()),
                    pa.array([np.concatenate(book.endings).tobytes()], pa.binary()),
                    pa.array([book.counts.tobytes()], pa.binary()),
                ],
                names=["chunk", "kind", "doc_id", "held", "a", "b", "c"],
            )

        for batch in batches:
            for part in weigh([batch], "text", BATCH_BYTES):
                id_type = part.column("doc_id").type
                found = words(part.column("text"), IS_SPACED_WORD)
                held = part.column("held").to_numpy(zero_copy_only=False)
                numbers = book.add(found, np.repeat(~held, np.diff(found.first)))
                n = part.num_rows
                lines = [pack(numbers[s:e]) for s, e in zip(found.first[:-1].tolist(), found.first[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, number)),
                        pa.array(np.ones(n, np.int32)),
                        part.column("doc_id"),
                        part.column("held"),
                        pa.array(lines, pa.binary()),
                        pa.nulls(n, pa.binary()),
                        pa.nulls(n, pa.binary()),
                    ],
                    names=["chunk", "kind", "doc_id", "held", "a", "b", "c"],
                )
                if book.full():
                    yield close()
                    number += 1
                    book = Dictionary()
        if book.bytes or id_type is not None and book.hashes:
            yield close()

    return docs.mapInArrow(run, schema)


# ---- counts -------------------------------------------------------------------------------------


@dataclass
class Counts:
    """What scoring needs of the word counts, without the words themselves."""

    tokens: int
    types: int
    texts: int
    frequent: np.ndarray  #: sorted hashes of the frequent words
    class_tokens: np.ndarray
    class_once: np.ndarray  #: types of each class that occur once

    def classes(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = 1 + FREQUENT + endings.astype(np.int64)
        if len(self.frequent):
            slot = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
            out = np.where(self.frequent[slot] == hashes, 1 + slot, out)
        return out

    def share(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log10 of a word's share in its class; the words of a class not seen in training have the share of those seen once."""
        total = self.class_tokens[classes].astype(float)
        unseen = np.clip((self.class_once[classes] + 0.5) / (total + 1.0), 1e-5, 0.9)
        single = classes <= FREQUENT
        unseen = np.where(total == 0, 1.0, np.where(single, 0.0, unseen))
        with np.errstate(divide="ignore", invalid="ignore"):
            known = (1.0 - unseen) * counts / np.maximum(total, 1.0)
            return np.log10(np.where(counts > 0, known, unseen))

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.types + 1)))

    def unigram(self) -> np.ndarray:
        smooth = self.class_tokens + 0.5
        return smooth / smooth.sum()


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def _add_up(coded: DataFrame, buckets: int) -> DataFrame:
    """Corpus counts of the words of every chunk, bucket by bucket: `(chunk, bucket, counts)`, in the chunk's order.

    A row with a null chunk sums the bucket up: its most frequent words, and tokens, types and words seen once by ending.
    """

    def deal(batches):
        for batch in batches:
            for chunk, a, b, c in zip(*(batch.column(x).to_pylist() for x in ("chunk", "a", "b", "c"))):
                hashes, endings, counts = np.frombuffer(a, np.uint64), np.frombuffer(b, np.int16), np.frombuffer(c, np.int64)
                of = bucket_of(hashes, buckets)
                order = np.argsort(of, kind="stable")
                borders = np.searchsorted(of[order], np.arange(buckets + 1))
                some = [k for k in range(buckets) if borders[k] < borders[k + 1]]
                cut = [order[borders[k] : borders[k + 1]] for k in some]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some, pa.int32()),
                        pa.array([chunk] * len(some), pa.int64()),
                        *[pa.array([x[rows].tobytes() for rows in cut], pa.binary()) for x in (hashes, endings, counts)],
                    ],
                    names=["bucket", "chunk", "a", "b", "c"],
                )

    def add(rows: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, np.uint64) for x in rows["a"].to_pylist()]
        endings = np.concatenate([np.frombuffer(x, np.int16) for x in rows["b"].to_pylist()]).astype(np.int64)
        counts = np.concatenate([np.frombuffer(x, np.int64) for x in rows["c"].to_pylist()])
        distinct, first, number = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, number, counts)
        ends = np.cumsum([len(h) for h in hashes])
        back = [x.tobytes() for x in np.split(total[number], ends[:-1])]
        ending, seen = endings[first], total > 0
        slots = np.stack(
            [
                np.bincount(ending, weights=weight, minlength=ENDINGS).astype(np.int64)
                for weight in (total, seen.astype(np.int64), (total == 1).astype(np.int64))
            ]
        )
        best = np.lexsort((distinct.view(np.int64), -total))[:FREQUENT]
        best = best[total[best] > 0]
        top = np.stack([distinct[best].view(np.int64), total[best], ending[best]])
        bucket = rows["bucket"][0].as_py()
        n = len(back)
        return pa.table(
            {
                "chunk": pa.array([*rows["chunk"].to_pylist(), None], pa.int64()),
                "bucket": pa.array([bucket] * (n + 1), pa.int32()),
                "counts": pa.array([*back, None], pa.binary()),
                "top": pa.array([None] * n + [top.tobytes()], pa.binary()),
                "slots": pa.array([None] * n + [slots.tobytes()], pa.binary()),
            }
        )

    dealt = coded.where("kind = 0").select("chunk", "a", "b", "c")
    dealt = dealt.mapInArrow(deal, "bucket int, chunk bigint, a binary, b binary, c binary")
    return dealt.groupBy("bucket").applyInArrow(add, "chunk bigint, bucket int, counts binary, top binary, slots binary")


def _count(added: DataFrame, texts: int) -> Counts:
    """The whole from the buckets' sums, one at a time."""
    slots = np.zeros((3, ENDINGS), np.int64)
    best = np.zeros((3, 0), np.int64)
    for row in added.where("chunk IS NULL").select("top", "slots").toLocalIterator():
        slots += np.frombuffer(row["slots"], np.int64).reshape(3, ENDINGS)
        best = np.concatenate([best, np.frombuffer(row["top"], np.int64).reshape(3, -1)], axis=1)
        best = best[:, np.lexsort((best[0], -best[1]))[:FREQUENT]]
    tokens, types = int(slots[0].sum()), int(slots[1].sum())
    order = np.argsort(best[0].view(np.uint64))
    frequent = best[:, order]
    np.subtract.at(slots[0], frequent[2], frequent[1])
    np.subtract.at(slots[2], frequent[2], (frequent[1] == 1).astype(np.int64))
    class_tokens, class_once = np.zeros(CLASSES), np.zeros(CLASSES)
    class_tokens[0] = texts
    class_tokens[1 : 1 + frequent.shape[1]] = frequent[1]
    class_tokens[1 + FREQUENT :] = slots[0]
    class_once[1 + FREQUENT :] = slots[2]
    return Counts(tokens + texts, types + (texts > 0), texts, frequent[0].view(np.uint64), class_tokens, class_once)


def _classify(coded: DataFrame, added: DataFrame, counts: Counts, buckets: int) -> DataFrame:
    """Per text: `n_tokens, n_known, base, share` (sums over its tokens) and `classes` (uint16 of each token, the end last)."""
    kind = coded.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held boolean, n_tokens bigint, n_known bigint, base double, share double, classes binary"
    sent = coded.sparkSession.sparkContext.broadcast(counts)
    # of each chunk: its words, then their counts by bucket, then its texts
    own_ = coded.select("chunk", (F.col("kind") * 2).alias("kind"), F.lit(0).alias("bucket"), "doc_id", "held", "a", "b")
    back = added.where("chunk IS NOT NULL").select(
        "chunk", F.lit(1).alias("kind"), "bucket", F.lit(None).cast(kind).alias("doc_id"),
        F.lit(None).cast("boolean").alias("held"), F.col("counts").alias("a"), F.lit(None).cast("binary").alias("b"),
    )
    dealt = own_.unionByName(back).repartition("chunk").sortWithinPartitions("chunk", "kind", "bucket")

    def run(batches):
        counts = sent.value
        end_known = int(counts.texts > 0)
        end_base = float(counts.base(np.array([counts.texts]))[0])
        hashes = endings = of_bucket = total = ready = None
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            texts = np.flatnonzero(kinds == 2)
            out = []
            for i, (kind, bucket, a, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("kind", "bucket", "a", "b")))):
                if kind == 0:
                    hashes, endings, ready = np.frombuffer(a, np.uint64), np.frombuffer(b, np.int16), None
                    total = np.zeros(len(hashes), np.int64)
                    of = bucket_of(hashes, buckets)
                    order = np.argsort(of, kind="stable")
                    of_bucket = np.split(order, np.searchsorted(of[order], np.arange(1, buckets)))
                    continue
                if kind == 1:
                    total[of_bucket[bucket]] = np.frombuffer(a, np.int64)
                    continue
                if ready is None:
                    of = counts.classes(hashes, endings)
                    ready = (of.astype(np.uint16), total > 0, counts.base(total), counts.share(of, total))
                of, known, base, share = ready
                at = unpack(a)
                out.append(
                    (
                        len(at) + 1,
                        int(known[at].sum()) + end_known,
                        float(base[at].sum()) + end_base,
                        float(share[at].sum()),
                        of[at].tobytes() + b"\0\0",
                    )
                )
            if out:
                part = batch.take(pa.array(texts))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("held"),
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int64()),
                        pa.array(columns[2]),
                        pa.array(columns[3]),
                        pa.array(columns[4], pa.binary()),
                    ],
                    names=["doc_id", "held", "n_tokens", "n_known", "base", "share", "classes"],
                )

    return dealt.mapInArrow(run, schema)


# ---- the model ----------------------------------------------------------------------------------


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  #: classes by states

    @staticmethod
    def begin(unigram: np.ndarray) -> Model:
        rng = np.random.default_rng(SEED)
        emit = unigram[:, None] * np.exp(rng.normal(0, 0.5, (CLASSES, STATES)))
        move = np.full((STATES, STATES), 0.3 / STATES) + 0.7 * np.eye(STATES)
        return Model(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))

    @staticmethod
    def from_counts(flat: np.ndarray, unigram: np.ndarray) -> Model:
        """Maximise: normalised expected counts, lightly smoothed so that nothing is impossible."""
        start, move, emit = np.split(flat, [STATES, STATES + STATES * STATES])
        start, move = start + 1.0, move.reshape(STATES, STATES) + 1.0
        emit = emit.reshape(CLASSES, STATES) + 20.0 * unigram[:, None]
        return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def pad(lines: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences as columns of one matrix, longest first, and how many are alive at each step."""
    lines = sorted(lines, key=len, reverse=True)
    sizes = np.array([len(x) for x in lines])
    out = np.zeros((sizes[0], len(lines)), np.int64)
    for k, line in enumerate(lines):
        out[: len(line), k] = line
    alive = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
    return out, alive


def expected_counts(model: Model, lines: list[np.ndarray]) -> np.ndarray:
    """Baum-Welch's expected counts of one batch of sequences: starts, moves and emissions, flat.

    The tokens of all sequences lie step by step, the longest sequence first. The forward values of a sequence are scaled
    at every `SCALED`-th step and at its end, which keeps them far from the limits of doubles; the backward values are
    scaled by the same numbers.
    """
    lines = sorted(lines, key=len, reverse=True)
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    alive = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
    begin = np.concatenate([[0], np.cumsum(alive)])
    step = np.arange(begin[-1]) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    tokens = np.empty(begin[-1], np.int64)
    tokens[begin[step] + np.repeat(np.arange(len(lines)), sizes)] = np.concatenate(lines)
    seen = model.emit.take(tokens, axis=0)
    forward = np.empty((len(tokens), STATES))
    ones, scale = np.ones(STATES), {}
    edges = list(zip(begin[:-1].tolist(), begin[1:].tolist()))
    for t, (b, e) in enumerate(edges):
        now = forward[b:e]
        if t:
            before = edges[t - 1][0]
            np.matmul(forward[before : before + e - b], model.move, out=now)
        else:
            now[:] = model.start
        now *= seen[b:e]
        if t % SCALED == SCALED - 1:
            scale[t] = 1.0 / (now @ ones)[:, None]
            now *= scale[t]
    last = forward[begin[sizes - 1] + np.arange(len(lines))] @ ones
    backward = np.repeat(1.0 / last, STATES).reshape(len(lines), STATES)
    move, back = np.zeros((STATES, STATES)), np.ascontiguousarray(model.move.T)
    for t in range(len(edges) - 1, 0, -1):
        (b, e), before = edges[t], edges[t - 1][0]
        after, later = seen[b:e], backward[: e - b]
        after *= later
        forward[b:e] *= later
        if t in scale:
            after *= scale[t]
        move += forward[before : before + e - b].T @ after
        np.matmul(after, back, out=later)
    forward[: len(lines)] *= backward
    cells = (tokens[:, None] * STATES + np.arange(STATES)).ravel()
    emit = np.bincount(cells, weights=forward.ravel(), minlength=CLASSES * STATES)
    return np.concatenate([forward[: len(lines)].sum(axis=0), (move * model.move).ravel(), emit])


def windows(line: np.ndarray) -> list[np.ndarray]:
    return [line[k : k + WINDOW] for k in range(0, len(line), WINDOW)]


def likelihoods(model: Model, lines: list[np.ndarray]) -> np.ndarray:
    """Exact log10 likelihood of each sequence by the scaled forward recursion."""
    total = np.zeros(len(lines))
    state = np.zeros((len(lines), STATES))
    order = sorted(range(len(lines)), key=lambda k: -min(len(lines[k]), PIECE))
    tokens, alive = pad([lines[k][:PIECE] for k in order])
    now, logs = np.zeros((len(order), STATES)), np.zeros(len(order))
    for t in range(len(tokens)):
        n = alive[t]
        now[:n] = model.emit[tokens[t, :n]] * (model.start if t == 0 else now[:n] @ model.move)
        size = now[:n].sum(axis=1)
        now[:n] /= size[:, None]
        logs[:n] += np.log10(size)
    state[order], total[order] = now, logs
    rest = [(k, b) for k, line in enumerate(lines) for b in range(PIECE, len(line), PIECE)]
    for begin in range(0, len(rest), 1024):
        some = rest[begin : begin + 1024]
        by_size = sorted(range(len(some)), key=lambda i: -min(len(lines[some[i][0]]) - some[i][1], PIECE))
        tokens, alive = pad([lines[some[i][0]][some[i][1] : some[i][1] + PIECE] for i in by_size])
        product = np.broadcast_to(np.eye(STATES), (len(some), STATES, STATES)).copy()
        logs = np.zeros(len(some))
        for t in range(len(tokens)):
            n = alive[t]
            step = (product[:n].reshape(-1, STATES) @ model.move).reshape(n, STATES, STATES)
            step *= model.emit[tokens[t, :n]][:, None, :]
            size = step.max(axis=(1, 2))
            product[:n] = step / size[:, None, None]
            logs[:n] += np.log10(size)
        place = np.empty(len(some), int)
        place[by_size] = np.arange(len(some))
        # pieces of a text come in order, so its state is carried from one to the next
        for i, (k, _) in enumerate(some):
            moved = state[k] @ product[place[i]]
            size = moved.sum()
            state[k] = moved / size
            total[k] += logs[place[i]] + np.log10(size)
    return total


def _batches(batch: pa.RecordBatch):
    """Rows of a batch in runs of about `BATCH_TOKENS` tokens: `(begin, lines)`."""
    begin, lines, total = 0, [], 0
    for i, raw in enumerate(batch.column("classes").to_pylist()):
        line = np.frombuffer(raw, np.uint16)
        if lines and total + len(line) > BATCH_TOKENS:
            yield begin, lines
            begin, lines, total = i, [], 0
        lines.append(line)
        total += len(line)
    if lines:
        yield begin, lines


def _round(texts: DataFrame, model: Model, unigram: np.ndarray) -> Model:
    """One round of Baum-Welch over all of `texts`; tasks emit one vector of counts each, added up in two steps."""
    sent = texts.sparkSession.sparkContext.broadcast(model)
    size = STATES + STATES * STATES + CLASSES * STATES

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            for _, lines in _batches(batch):
                pieces = sorted((w for line in lines for w in windows(line)), key=len, reverse=True)
                for begin in range(0, len(pieces), SIDE):
                    total += expected_counts(sent.value, pieces[begin : begin + SIDE])
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() % 61], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                names=["salt", "counts"],
            )

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(size)
        for counts in rows["counts"].to_pylist():
            total += np.frombuffer(counts)
        return rows.slice(0, 1).set_column(1, "counts", pa.array([total.tobytes()], pa.binary()))

    parts = texts.select("classes").mapInArrow(run, "salt int, counts binary")
    parts = parts.groupBy("salt").applyInArrow(add, "salt int, counts binary")
    # At most 61 vectors of a quarter of a megabyte, in one job instead of one after the other for each partition.
    total = np.zeros(size)
    for row in parts.collect():
        total += np.frombuffer(row["counts"])
    return Model.from_counts(total, unigram)


def train(texts: DataFrame, counts: Counts) -> Model:
    """Every round is on all training texts."""
    unigram = counts.unigram()
    model = Model.begin(unigram)
    if not counts.texts:
        return model
    known = texts.where(~F.col("held"))
    for _ in range(ROUNDS):
        model = _round(known, model, unigram)
    return model


def score(docs: DataFrame) -> DataFrame:
    """Per document `doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score` (sums of log10).

    Learned from texts whose crc32 remainder by 10 is not 0. Null texts count as empty; an empty text is its end.
    Training cuts texts into windows of 256 tokens; scoring is exact for whole texts. As in the base score, all words
    unseen in training count as one. Repeated documents each get a row. Without a training text the start values
    are used; an empty table gives an empty result.
    """
    held = crc_part(F.col("doc_id"), 10) == 0
    coded = materialise(_code(docs.select("doc_id", held.alias("held"), "text")))
    texts = coded.where("kind = 1 AND NOT held").count()
    sizes = coded.where("kind = 0").agg(F.sum(F.octet_length("a")).alias("n")).first()
    buckets = 64 + (sizes["n"] or 0) // 8 // BUCKET_WORDS
    added = materialise(_add_up(coded, buckets))
    counts = _count(added, texts)
    ready = materialise(_classify(coded, added, counts, buckets))
    model = train(ready, counts)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for begin, lines in _batches(batch):
                part = batch.slice(begin, len(lines)).select(["doc_id", "held", "n_tokens", "n_known", "base", "share"])
                chain = pa.array(likelihoods(sent.value, lines))
                yield pa.RecordBatch.from_arrays([*part.columns, chain], names=[*part.schema.names, "chain"])

    schema = f"doc_id {kind}, held boolean, n_tokens bigint, n_known bigint, base double, share double, chain double"
    return ready.mapInArrow(run, schema).select(
        "doc_id",
        F.col("held").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        (F.col("share") + F.col("chain")).alias("score"),
    )


def op4_hmm(spark, sf_dir: str) -> DataFrame:
    """Score of every whole document."""
    return score(table(spark, sf_dir, "documents"))


QUERIES = {"op4_hmm": op4_hmm}
ORACLES: dict[str, str] = {}
