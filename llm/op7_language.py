"""Language identification by a string kernel.

A text is the set of the byte n-grams (n from 1 to 3) of its lower-cased letters, each hashed to one of `SLOTS`
slots; two texts are compared by the cosine of their sets (a presence kernel over a blended spectrum).
Landmarks from every language span a Nyström approximation of the kernel, in which one-versus-rest ridge
regressions are solved. Scoring is two matrix products for a batch of texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.frames import crc_part, own, table
from llm.text import string_buffers, weigh

SLOTS = 1 << 14
NGRAMS = (1, 2, 3)
#: Labelled texts used for fitting and landmarks among them (about), shared out evenly to the languages.
SAMPLE, LANDMARKS = 3000, 128
#: With many languages both grow: texts and landmarks that each language has at least, if there are as many.
SAMPLE_EACH, LANDMARKS_EACH = 24, 4
RIDGE = 1e-3
BATCH_BYTES = 1 << 20
BATCH_TEXTS = 256
UNKNOWN = "und"


def _table() -> np.ndarray:
    """Bytes of lower-case letters stay, all other ASCII becomes a space."""
    out = np.full(256, 0x20, np.uint8)
    out[0x61:0x7B] = np.arange(0x61, 0x7B)
    out[0x80:] = np.arange(0x80, 0x100)
    return out


KEPT = _table()


def presence(column: pa.Array) -> np.ndarray:
    """A line of `SLOTS` flags for each text."""
    data, offsets = string_buffers(pa.compute.utf8_lower(column.fill_null("")))
    n = len(offsets) - 1
    out = np.zeros((n, SLOTS), bool)
    data = KEPT[data]
    # runs of spaces count as one
    kept = np.ones(len(data), bool)
    kept[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20)
    kept[offsets[:-1][offsets[:-1] < len(data)]] = True
    text_of = np.repeat(np.arange(n), np.diff(offsets))[kept]
    data = data[kept].astype(np.uint32)
    code = np.zeros(len(data), np.uint32)
    for size in range(1, max(NGRAMS) + 1):
        count = len(data) - size + 1
        if count <= 0:
            break
        code = (code[:count] << np.uint32(8)) | data[size - 1 :]
        if size in NGRAMS:
            inside = text_of[:count] == text_of[size - 1 :]
            slot = ((code + np.uint32(size << 27)) * np.uint32(2654435761)) >> np.uint32(32 - SLOTS.bit_length() + 1)
            out[text_of[:count][inside], slot[inside]] = True
    return out


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of two groups of sets."""
    a, b = a.astype(np.float32), b.astype(np.float32)
    size_a, size_b = np.sqrt(a.sum(axis=1)), np.sqrt(b.sum(axis=1))
    return (a @ b.T) / np.maximum(size_a, 1)[:, None] / np.maximum(size_b, 1)[None, :]


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray  #: landmarks by languages
    bias: np.ndarray

    def decide(self, sets: np.ndarray) -> np.ndarray:
        return kernel(sets, self.landmarks) @ self.weights + self.bias

    @staticmethod
    def fit(sets: np.ndarray, labels: list[str]) -> Model:
        """Landmarks are the first rows of each language; the rows should come in random order."""
        languages = sorted(set(labels))
        place = {name: k for k, name in enumerate(languages)}
        number = np.array([place[x] for x in labels])
        share = max(LANDMARKS_EACH, LANDMARKS // len(languages))
        chosen = np.concatenate([np.flatnonzero(number == k)[:share] for k in range(len(languages))])
        landmarks = sets[chosen]
        values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
        use = values > 1e-6 * max(values.max(), 1e-12)
        project = vectors[:, use] / np.sqrt(values[use])
        z = kernel(sets, landmarks).astype(np.float64) @ project
        counts = np.bincount(number, minlength=len(languages))
        balance = (len(number) / len(languages) / counts)[number]
        target = np.where(number[:, None] == np.arange(len(languages)), 1.0, -1.0)
        mean_z, mean_t = np.average(z, axis=0, weights=balance), np.average(target, axis=0, weights=balance)
        centred = z - mean_z
        gram = (centred * balance[:, None]).T @ centred
        gram += RIDGE * len(z) * np.eye(len(gram))
        solved = np.linalg.solve(gram, (centred * balance[:, None]).T @ (target - mean_t))
        return Model(languages, landmarks, (project @ solved).astype(np.float32), (mean_t - mean_z @ solved).astype(np.float32))


def fit(docs: DataFrame, text: str, lang: str) -> Model | None:
    """Fit on a sample of the rows whose text and language are known, bounded by the number of languages; None if there is none.

    Every language is learned: the text of lowest hash is in the sample, however rare the others.
    """
    known = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull()
    )
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.min(place).alias("least")).orderBy("lang").collect()
    if not counts:
        return None
    each = max(SAMPLE / len(counts), SAMPLE_EACH)
    rates = docs.sparkSession.createDataFrame(
        [(r["lang"], max(r["least"], min(1.0, each / r["count"]))) for r in counts], "lang string, rate double"
    )
    sample = known.join(F.broadcast(rates), "lang").where(place <= F.col("rate")).select("text", "lang", place.alias("place"))

    def run(batches):
        for batch in batches:
            for part in weigh([batch], "text", BATCH_BYTES):
                packed = np.packbits(presence(part.column("text")), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p.tobytes() for p in packed], pa.binary()), part.column("lang"), part.column("place")],
                    names=["bits", "lang", "place"],
                )

    rows = sample.mapInArrow(run, "bits binary, lang string, place double").dropDuplicates(["bits", "lang"])
    # Equal texts are one row, and no more than about `each` different ones of a language are expected.
    rows = rows.orderBy("place", "lang").collect()
    sets = np.unpackbits(np.array([np.frombuffer(r["bits"], np.uint8) for r in rows]), axis=1).astype(bool)
    return Model.fit(sets, [r["lang"] for r in rows])


def add_language(docs: DataFrame, model: Model | None, text: str, lang: str, score: str) -> DataFrame:
    """Append the predicted language of `text`, and how sure it is (0 to 1).

    Null texts, texts without a letter, and all texts if nothing could be learned, are `und` with score 0.
    """
    if model is None:
        return docs.withColumns({lang: F.lit(UNKNOWN), score: F.lit(0.0)})
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.withColumns({lang: F.lit("").cast("string"), score: F.lit(0.0)}).schema

    def run(batches):
        model = sent.value
        for batch in batches:
            for some in weigh([batch], text, BATCH_BYTES):
                for begin in range(0, some.num_rows, BATCH_TEXTS):
                    part = some.slice(begin, BATCH_TEXTS)
                    column = part.column(text)
                    decided = model.decide(presence(column))
                    best = decided.argmax(axis=1)
                    sure = np.clip((decided[np.arange(len(best)), best] + 1) / 2, 0, 1).astype(float)
                    letters = pa.compute.match_substring_regex(column, r"\pL").fill_null(False).to_numpy(zero_copy_only=False)
                    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(names, pa.string()), pa.array(np.where(letters, sure, 0.0))],
                        names=[*part.schema.names, lang, score],
                    )

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """Per document `doc_id, held_out, lang_pred, score`, learned from rows whose crc32 remainder by 3 is not 1.

    Repeated ids each get a row; an empty table gives an empty result.
    """
    key, body, pred, sure = own("key", "body", "pred", "sure")
    model = fit(docs.where(crc_part(F.col("doc_id"), 3) != 1), "text", "lang")
    plain = docs.select(F.col("doc_id").alias(key), F.col("text").alias(body))
    return add_language(plain, model, body, pred, sure).select(
        F.col(key).alias("doc_id"),
        (crc_part(F.col(key), 3) == 1).alias("held_out"),
        F.col(pred).alias("lang_pred"),
        F.col(sure).alias("score"),
    )


def op7_language(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every whole document."""
    return identify(table(spark, sf_dir, "documents"))


QUERIES = {"op7_language": op7_language}
ORACLES: dict[str, str] = {}
