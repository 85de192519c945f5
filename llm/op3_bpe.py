"""BPE encoding and decoding with a public word-level vocabulary, by a segment tree over pair ranks.

Every distinct word of a batch is merged once. Words of similar size are laid side by side, each with a
segment tree whose leaves hold rank and place of the pair that begins there. The root is the leftmost
pair of lowest rank; merging it changes three leaves, each updated on its way to the root, until no
mergeable pair is left. All words of the batch take their next merge in the same vector operations.
"""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.frames import own, table
from llm.text import span_hashes, weigh

#: Text bytes handled together, distinct words remembered between batches, leaves of the trees built together, code points
#: classified together: a worker's memory follows them.
BATCH_BYTES = 1 << 19
CACHE_WORDS = 400_000
LEAVES = 1 << 17
CODE_POINTS = 1 << 12
NONE = np.int64(1) << 60
SPACE, LETTER, NUMBER, OTHER = range(4)


def default_vocabulary() -> str:
    """Place of the public 49k vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point: white space, letter, number, other."""
    out = np.full(0x110000, OTHER, np.uint8)
    for first in range(0, 0x110000, CODE_POINTS):
        every = "".join(chr(c) for c in range(first, first + CODE_POINTS) if not 0xD800 <= c < 0xE000)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for found in regex.finditer(pattern, every):
                out[ord(every[found.start()]) : ord(every[found.end() - 1]) + 1] = kind
    return out


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte value in vocabularies of this kind."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]


@dataclass
class Vocabulary:
    """What encoding and decoding need of a vocabulary file."""

    tokens: np.ndarray  #: text of each id
    special: dict[str, int]
    inner: np.ndarray  #: id of each byte inside a word
    final: np.ndarray  #: id of each byte that ends a word
    pairs: np.ndarray  #: sorted keys of the mergeable pairs
    ranks: np.ndarray  #: rank of each of `pairs`
    merged: np.ndarray  #: id made by each rank

    @staticmethod
    @lru_cache(maxsize=2)
    def read(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        ids, suffix = model["vocab"], model["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        tokens = np.empty(max([*ids.values(), *special.values()]) + 1, dtype=object)
        tokens[:] = ""
        for text, number in [*ids.items(), *special.items()]:
            tokens[number] = text
        symbols = byte_symbols()
        left = np.array([ids[a] for a, _ in model["merges"]], np.int64)
        right = np.array([ids[b] for _, b in model["merges"]], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        return Vocabulary(
            tokens,
            special,
            np.array([ids[s] for s in symbols], np.int64),
            np.array([ids[s + suffix] for s in symbols], np.int64),
            keys[order],
            order.astype(np.int64),
            np.array([ids[a + b] for a, b in model["merges"]], np.int64),
        )

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; `NONE` if it can't be merged or one side is missing (-1)."""
        keys = left << 32 | np.maximum(right, 0)
        slot = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        found = (self.pairs[slot] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[slot], NONE)


class Trees:
    """Segment trees of equal size, one for each word: a node holds the least key below it."""

    def __init__(self, keys: np.ndarray) -> None:
        count, self.leaves = keys.shape
        self.nodes = np.full((count, 2 * self.leaves), NONE, np.int64)
        self.nodes[:, self.leaves :] = keys
        size = self.leaves
        while size > 1:
            half = size // 2
            self.nodes[:, half:size] = np.minimum(self.nodes[:, size : 2 * size : 2], self.nodes[:, size + 1 : 2 * size : 2])
            size = half

    def roots(self, rows: np.ndarray) -> np.ndarray:
        return self.nodes[rows, 1]

    def update(self, rows: np.ndarray, leaf: np.ndarray, keys: np.ndarray) -> None:
        """Set one leaf in each of `rows` and renew the nodes above it."""
        node = leaf + self.leaves
        self.nodes[rows, node] = keys
        step = self.leaves
        while step > 1:
            node = node >> 1
            self.nodes[rows, node] = np.minimum(self.nodes[rows, 2 * node], self.nodes[rows, 2 * node + 1])
            step >>= 1


def merge_words(symbols: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Ids of words after all merges; one line for each word, -1 where there is no symbol (always after the symbols)."""
    count, width = symbols.shape
    symbols = symbols.copy()
    place = np.arange(width)
    after = np.broadcast_to(place + 1, (count, width)).copy()
    before = np.broadcast_to(place - 1, (count, width)).copy()
    follow = np.full((count, width), -1, np.int64)
    follow[:, :-1] = symbols[:, 1:]
    ranks = vocabulary.rank(symbols, follow)
    trees = Trees(np.where(ranks < NONE, ranks * width + place, NONE))

    def symbol(rows, at):
        inside = (at >= 0) & (at < width)
        return np.where(inside, symbols[rows, np.clip(at, 0, width - 1)], -1)

    def keys(rows, left, right):
        ranks = vocabulary.rank(symbol(rows, left), symbol(rows, right))
        return np.where(ranks < NONE, ranks * width + left, NONE)

    rows = np.arange(count)
    while True:
        root = trees.roots(rows)
        rows, root = rows[root < NONE], root[root < NONE]
        if not len(rows):
            return symbols
        at = root % width
        gone = after[rows, at]
        behind = after[rows, gone]
        symbols[rows, at] = vocabulary.merged[root // width]
        symbols[rows, gone] = -1
        after[rows, at] = behind
        there = behind < width
        before[rows[there], behind[there]] = at[there]
        trees.update(rows, gone, np.full(len(rows), NONE))
        trees.update(rows, at, keys(rows, at, behind))
        front = before[rows, at]
        there = front >= 0
        trees.update(rows[there], front[there], keys(rows[there], front[there], at[there]))


def merge_all(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all words, and how many each has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    widths = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    lines: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
    for width in np.unique(widths).tolist():
        members = np.flatnonzero(widths == width)
        step = max(1, LEAVES // width)
        for begin in range(0, len(members), step):
            some = members[begin : begin + step]
            raw = np.frombuffer(b"".join(words[i] for i in some), np.uint8)
            size = sizes[some]
            inside = np.arange(width) < size[:, None]
            symbols = np.full((len(some), width), -1, np.int64)
            symbols[inside] = vocabulary.inner[raw]
            last = raw[np.cumsum(size) - 1]
            symbols[np.arange(len(some)), size - 1] = vocabulary.final[last]
            done = merge_words(symbols, vocabulary)
            counts = (done >= 0).sum(axis=1)
            for i, ids in zip(some.tolist(), np.split(done[done >= 0], np.cumsum(counts)[:-1])):
                lines[i] = ids
    counts = np.fromiter(map(len, lines), np.int64, len(lines))
    return (np.concatenate(lines) if lines else np.zeros(0, np.int64)), counts


def normalise(text: str) -> str:
    """NFC, and each character lower-cased by itself."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def word_spans(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in normalised code points: contractions, letters, single numbers, runs of others."""
    kind = classes()[points]
    solid = kind != SPACE
    n = len(points)
    begin = solid.copy()
    begin[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    for p in np.flatnonzero(begin & (points == 0x27)).tolist():
        if p + 1 < n and kind[p + 1] == LETTER:
            tail = "".join(map(chr, points[p + 1 : p + 3].tolist()))
            size = 1 if tail[0] in "stmd" else 2 if tail in ("re", "ve", "ll") else 0
            if size:
                begin[p + 1] = False
                if p + 1 + size < n and kind[p + 1 + size] == LETTER:
                    begin[p + 1 + size] = True
    end = solid.copy()
    end[:-1] &= begin[1:] | ~solid[1:]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


class Encoder:
    """Encodes batches of texts; remembers a bounded number of distinct words."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary.read(path)
        self.special = regex.compile("|".join(map(regex.escape, self.vocabulary.special)) or r"(?!)")
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.begin = self.count = self.flat = np.zeros(0, np.int64)

    def learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Merge words that aren't known and keep them; `hashes` are sorted."""
        flat, count = merge_all(words, self.vocabulary)
        begin = len(self.flat) + np.cumsum(count) - count
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.begin = np.concatenate([self.begin, begin])[order]
        self.count = np.concatenate([self.count, count])[order]
        self.flat = np.concatenate([self.flat, flat])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and where each text's ids begin (one more than texts)."""
        pieces, owner, marks = [], [], []
        for number, text in enumerate(texts):
            at = 0
            if "<" in text:
                for found in self.special.finditer(text):
                    pieces += [normalise(text[at : found.start()]), ""]
                    owner += [number, number]
                    marks.append((len(pieces) - 1, self.vocabulary.special[found.group()]))
                    at = found.end()
            pieces.append(normalise(text[at:]))
            owner.append(number)
        whole = "\n".join(pieces)
        points = np.frombuffer(whole.encode("utf-32-le", "replace"), np.uint32)
        starts, ends = word_spans(points)
        piece_ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1)
        piece_of = np.searchsorted(piece_ends, starts, side="right")
        distinct, first, number = np.unique(span_hashes(points, starts, ends), return_index=True, return_inverse=True)
        slot = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        if len(self.known):
            new = self.known[np.minimum(slot, len(self.known) - 1)] != distinct
        if len(self.known) + new.sum() > CACHE_WORDS:
            self.forget()
            new[:] = True
        if new.any():
            some = first[new]
            spans = zip(starts[some].tolist(), ends[some].tolist())
            self.learn(distinct[new], [whole[s:e].encode("utf-8", "replace") for s, e in spans])
        slot = np.searchsorted(self.known, distinct)[number]
        begin, count, of = self.begin[slot], self.count[slot], piece_of
        flat_source = self.flat
        if marks:
            flat_source = np.concatenate([self.flat, [m[1] for m in marks]])
            where = np.searchsorted(piece_of, [m[0] for m in marks])
            begin = np.insert(begin, where, len(self.flat) + np.arange(len(marks)))
            count = np.insert(count, where, 1)
            of = np.insert(of, where, [m[0] for m in marks])
        ends_ = np.cumsum(count)
        flat = flat_source[np.repeat(begin - (ends_ - count), count) + np.arange(ends_[-1] if len(ends_) else 0)]
        per_text = np.bincount(np.array(owner, np.int64)[of], weights=count, minlength=len(texts)).astype(np.int64)
        return flat, np.concatenate([[0], np.cumsum(per_text)])


def encode(docs: DataFrame, text: str, ids: str, path: str | None = None) -> DataFrame:
    """Append `ids` (array<int>): the whole text encoded, without added special tokens.

    Null and empty texts, and texts of white space, have no ids. The strings of special tokens in a text become
    their ids. Rows are independent: repeats give equal ids, an empty table an empty result.
    """
    path = path or default_vocabulary()

    def run(batches):
        encoder = Encoder(path)
        for batch in batches:
            for part in weigh([batch], text, BATCH_BYTES):
                flat, offsets = encoder.encode(part.column(text).fill_null("").to_pylist())
                column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, ids])

    return docs.mapInArrow(run, docs.withColumn(ids, F.array().cast("array<int>")).schema)


def decode(docs: DataFrame, ids: str, text: str, path: str | None = None) -> DataFrame:
    """Append `text`: the tokens of `ids` joined by one space, as this vocabulary (which has no decoder) defines it.

    Null ids give null, no ids empty text; an id that isn't in the vocabulary raises. Spark looks the tokens up itself, so
    that no second Python worker stands beside that of `encode`.
    """
    tokens = Vocabulary.read(path or default_vocabulary()).tokens.tolist()
    known = F.from_json(F.lit(json.dumps(tokens)), "array<string>")  # a constant, made once when Spark plans
    missing = lambda i: F.raise_error(F.concat(F.lit("not in the vocabulary: "), F.coalesce(i.cast("string"), F.lit("null"))))
    token = lambda i: F.when(i.between(0, len(tokens) - 1), F.get(known, i)).otherwise(missing(i))
    return docs.withColumn(text, F.array_join(F.transform(F.col(f"`{ids}`"), token), " "))


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per document `doc_id, n_tokens, ids_sha256, decoded_sha256` of `encode` and `decode`."""
    key, body, ids, decoded = own("key", "body", "ids", "decoded")
    plain = docs.select(F.col(f"`{doc_id}`").alias(key), F.col(f"`{text}`").alias(body))
    done = decode(encode(plain, body, ids, path).drop(body), ids, decoded, path)
    joined = F.array_join(F.col(ids).cast("array<string>"), " ")
    return done.select(
        F.col(key).alias(doc_id),
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded).cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    """Round trip of every whole document through the public vocabulary."""
    return round_trip(table(spark, sf_dir, "documents"))


QUERIES = {"op3_bpe": op3_bpe}
ORACLES: dict[str, str] = {}
