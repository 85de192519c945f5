"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features are densities of learned lexicons (words, and stems that catch inflections), closeness of
lexicon words to a second person, capitals, punctuation and obfuscation. Lexicons, trees and calibration
are fitted on at most `SAMPLE` labelled rows. To keep the training features honest, the rows of one half
get their features from the lexicon of the other half; calibration uses trees that have not seen its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.frames import crc_part, materialise, own, table
from llm.text import IS_SPACED_WORD, span_hashes, string_buffers, weigh, words

#: Labelled rows used for fitting, at most (about); entries of a lexicon, at most.
SAMPLE = 24_000
LEXICON = 4096
MIN_DOCS, MIN_ODDS = 3, 2.0
STEM = 5
TREES, DEPTH = 20, 4
THRESHOLD = 0.7
BATCH_BYTES = 2 << 20
#: Second-person words of the languages covered.
SECOND_PERSON = """you your yours yourself ya u ur thou thee du dich dir dein deine deinen deiner ihr euch euer eure
tu te toi ton ta tes vous votre vos ti tus usted ustedes vosotros vuestro vuestra""".split()
#: Characters that stand for a letter when a letter follows.
LOOKALIKE = {"@": "a", "4": "a", "3": "e", "1": "i", "0": "o", "$": "s", "5": "s", "7": "t"}


def _letters() -> tuple[np.ndarray, np.ndarray]:
    plain = np.zeros(256, np.uint8)
    plain[0x61:0x7B] = np.arange(0x61, 0x7B)
    plain[0x80:] = np.arange(0x80, 0x100)
    mapped = plain.copy()
    for sign, letter in LOOKALIKE.items():
        mapped[ord(sign)] = ord(letter)
    return plain, mapped


PLAIN, MAPPED = _letters()


@dataclass
class Lexicon:
    """Log odds of toxicity of word and stem hashes."""

    words: np.ndarray
    word_odds: np.ndarray
    stems: np.ndarray
    stem_odds: np.ndarray

    @staticmethod
    def look_up(keys: np.ndarray, odds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(hashes))
        slot = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[slot] == hashes, odds[slot], 0.0)


@dataclass
class Cores:
    """The words of a batch reduced to their letters."""

    found: object
    plain: np.ndarray  #: hash of the letters as they are
    mapped: np.ndarray  #: the same with look-alike characters read as letters
    stem: np.ndarray
    long: np.ndarray
    mixed: np.ndarray  #: has a non-letter between letters


def cores(column: pa.Array) -> Cores:
    found = words(pa.compute.utf8_lower(column.fill_null("")), IS_SPACED_WORD)
    data, starts, ends = found.data, found.starts, found.ends
    letter = PLAIN[data] > 0
    followed = np.zeros(len(data), bool)
    if len(data):
        followed[:-1] = letter[1:]
    read = np.where(letter, data, np.where(followed, MAPPED[data], 0)).astype(np.uint8)

    def squeeze(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        before = np.concatenate([[0], np.cumsum(values > 0)])
        return values[values > 0], before[starts], before[ends]

    kept, s, e = squeeze(np.where(letter, data, 0))
    plain = span_hashes(kept, s, e)
    stem = span_hashes(kept, s, np.minimum(e, s + STEM))
    kept_m, s_m, e_m = squeeze(read)
    begins = np.concatenate([[0], np.cumsum(letter & np.concatenate([[True], ~letter[:-1]]))]) if len(data) else np.zeros(1, int)
    runs = begins[ends] - begins[starts] + (letter[starts] & np.concatenate([[False], letter])[starts] if len(starts) else 0)
    return Cores(found, plain, span_hashes(kept_m, s_m, e_m), stem, e - s >= STEM + 2, runs > 1)


FEATURES = 20


def features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One line of `FEATURES` numbers for each text."""
    n = len(column)
    out = np.zeros((n, FEATURES))
    c = cores(column)
    text_of = c.found.text_of()
    total = np.diff(c.found.first).astype(float)
    some = np.maximum(total, 1.0)
    add = lambda values: np.bincount(text_of, weights=values, minlength=n)

    def peak(values):
        top = np.zeros(n)
        np.maximum.at(top, text_of, values)
        return top

    plain = Lexicon.look_up(lexicon.words, lexicon.word_odds, c.plain)
    mapped = Lexicon.look_up(lexicon.words, lexicon.word_odds, c.mapped)
    odds = np.maximum(plain, mapped)
    stems = np.where(c.long, Lexicon.look_up(lexicon.stems, lexicon.stem_odds, c.stem), 0.0)
    strong = (odds >= 3.0) | (stems >= 3.0)
    out[:, 0] = np.log1p(total)
    out[:, 1] = add(odds) / some
    out[:, 2] = np.log1p(add(odds >= MIN_ODDS))
    out[:, 3] = peak(odds)
    out[:, 4] = np.log1p(add(np.maximum(odds, stems)))
    out[:, 5] = add(stems) / some
    out[:, 6] = np.log1p(add(stems >= MIN_ODDS))
    out[:, 7] = peak(stems)
    out[:, 8] = np.log1p(add(strong))
    out[:, 9] = add(strong) / some
    hits = np.flatnonzero(strong)
    if len(hits):
        pairs = np.unique(np.stack([text_of[hits], c.plain[hits].view(np.int64)], axis=1), axis=0)
        out[:, 10] = np.bincount(pairs[:, 0], minlength=n)
        person = np.flatnonzero(np.isin(c.plain, _person()))
        if len(person):
            after = np.searchsorted(person, hits)
            near = np.zeros(len(hits))
            for side in (after - 1, after):
                slot = np.clip(side, 0, len(person) - 1)
                ok = (side >= 0) & (side < len(person)) & (text_of[person[slot]] == text_of[hits])
                near = np.maximum(near, np.where(ok, 1.0 / (1.0 + np.abs(person[slot] - hits)), 0.0))
            np.maximum.at(out[:, 11], text_of[hits], near)
            out[:, 12] = np.bincount(text_of[hits], weights=near >= 1 / 6, minlength=n)
    out[:, 13] = add(c.mixed) / some
    out[:, 14] = add((mapped > plain) & (mapped >= MIN_ODDS))
    raw, offsets = string_buffers(column)
    size = np.maximum(np.diff(offsets), 1).astype(float)

    def rate(mask):
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / size

    upper = (raw >= 0x41) & (raw <= 0x5A)
    sign = ((raw >= 0x21) & (raw <= 0x2F)) | ((raw >= 0x3A) & (raw <= 0x40)) | ((raw >= 0x5B) & (raw <= 0x60))
    out[:, 15] = rate(upper)
    out[:, 16] = rate(upper & np.concatenate([[False], upper[:-1]])) if len(raw) else 0.0
    out[:, 17] = rate(raw == 0x21)
    out[:, 18] = rate(sign)
    out[:, 19] = rate(np.concatenate([[False], raw[1:] == raw[:-1]])) if len(raw) else 0.0
    return out


def _person() -> np.ndarray:
    return np.unique(words(pa.array(SECOND_PERSON), IS_SPACED_WORD).hashes())


def _count(docs: DataFrame, text: str, label: str, fold: str) -> DataFrame:
    """Documents of either label, in either half, that have a word (kind 0) or stem (kind 1)."""

    def run(batches):
        for batch in batches:
            for part in weigh([batch], text, BATCH_BYTES):
                c = cores(part.column(text))
                text_of = c.found.text_of()
                group = 2 * part.column(fold).to_numpy() + part.column(label).to_numpy()
                for kind, hashes, use in ((0, c.plain, None), (0, c.mapped, c.mapped != c.plain), (1, c.stem, c.long)):
                    pairs = np.stack([hashes.view(np.int64), text_of], axis=1)
                    pairs = np.unique(pairs if use is None else pairs[use], axis=0)
                    keys, number = np.unique(pairs[:, 0], return_inverse=True)
                    counts = np.zeros((len(keys), 4), np.int64)
                    np.add.at(counts, (number, group[pairs[:, 1]].astype(np.int64)), 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), *[pa.array(x) for x in counts.T]],
                        names=["kind", "hash", "n0", "n1", "n2", "n3"],
                    )

    schema = "kind int, hash bigint, n0 bigint, n1 bigint, n2 bigint, n3 bigint"
    counted = docs.select(text, label, fold).mapInArrow(run, schema)
    return counted.groupBy("kind", "hash").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(4)])


def _lexicon(counts: DataFrame, clean: str, toxic: str, sizes: tuple[int, int]) -> Lexicon:
    """The entries of highest log odds whose toxic documents are enough; at most `LEXICON` of each kind."""
    odds = F.log((F.expr(toxic) + 0.5) / (sizes[1] + 1.0)) - F.log((F.expr(clean) + 0.5) / (sizes[0] + 1.0))
    rows = counts.select("kind", "hash", F.expr(toxic).alias("toxic"), odds.alias("odds"))
    rows = rows.where((F.col("toxic") >= MIN_DOCS) & (F.col("odds") >= MIN_ODDS))
    out = []
    for kind in (0, 1):
        best = rows.where(F.col("kind") == kind).orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "hash").limit(LEXICON)
        found = best.select("hash", "odds").collect()
        keys = np.array([r["hash"] for r in found], np.int64).view(np.uint64)
        values = np.array([r["odds"] for r in found], float)
        order = np.argsort(keys)
        out += [keys[order], values[order]]
    return Lexicon(*out)


def _with_features(docs: DataFrame, text: str, name: str, pick) -> DataFrame:
    """Append the features of `text`; `pick(batch)` yields (rows, lexicon) that cover the batch."""

    def run(batches):
        for batch in batches:
            for part in weigh([batch], text, BATCH_BYTES):
                out = np.zeros((part.num_rows, FEATURES))
                for rows, lexicon in pick(part):
                    out[rows] = features(part.column(text).take(pa.array(rows)), lexicon)
                offsets = pa.array(np.arange(part.num_rows + 1) * FEATURES, pa.int32())
                column = pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, name])

    return docs.mapInArrow(run, docs.withColumn(name, F.array().cast("array<double>")).schema)


@dataclass
class Model:
    """What scoring needs. Without trees (no row of one of the labels), every score is `rate`."""

    lexicon: Lexicon | None
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    rate: float

    def add_score(self, docs: DataFrame, text: str, name: str) -> DataFrame:
        """Append the calibrated score of `text`, 0 to 1; null counts as empty."""
        if self.trees is None:
            return docs.withColumn(name, F.lit(self.rate))
        columns = docs.columns
        arr, vector, raw, prob, pred, margin = own("arr", "vector", "raw", "prob", "pred", "margin")
        lexicon = docs.sparkSession.sparkContext.broadcast(self.lexicon)
        scored = _with_features(docs, text, arr, lambda part: [(np.arange(part.num_rows), lexicon.value)])
        scored = scored.withColumn(vector, array_to_vector(arr)).drop(arr)
        trees = self.trees.copy().setFeaturesCol(vector).setRawPredictionCol(raw).setProbabilityCol(prob).setPredictionCol(pred)
        scored = trees.transform(scored).withColumn(margin, vector_to_array(raw)[1])
        scored = self.calibration.copy().setFeaturesCol(margin).setPredictionCol(name).transform(scored)
        clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(name)))
        return scored.select(*[F.col(f"`{c}`") for c in columns], clipped.alias(name))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled documents whose crc32 remainder by 3 is not 1, at most about `SAMPLE` of them, picked by a hash of the id.

    Labels that are null are left out; of several labels of one id the highest counts.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc_part(F.col("doc_id"), 3) != 1))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label"))
    rows = known.count()
    part = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 20))
    if rows > SAMPLE:
        known = known.where(part < int((1 << 20) * SAMPLE / rows))
    known = known.select(F.col("doc_id").alias("id"), "label", (part % 2).cast("int").alias("fold"))
    # At most about SAMPLE small rows, so that the documents need no shuffle.
    picked = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("id"))
    sample = materialise(picked.select("text", "label", "fold"))
    sizes = {(r["fold"], r["label"]): r["count"] for r in sample.groupBy("fold", "label").count().collect()}
    n = [[sizes.get((f, y), 0) for y in (0, 1)] for f in (0, 1)]
    clean, toxic = n[0][0] + n[1][0], n[0][1] + n[1][1]
    if not clean or not toxic:
        return Model(None, None, None, toxic / max(1, clean + toxic))
    counts = materialise(_count(sample, "text", "label", "fold"))
    whole = _lexicon(counts, "n0 + n2", "n1 + n3", (clean, toxic))
    halves = [_lexicon(counts, "n2", "n3", tuple(n[1])), _lexicon(counts, "n0", "n1", tuple(n[0]))]

    def pick(part):
        fold = part.column("fold").to_numpy()
        return [(np.flatnonzero(fold == f), halves[f]) for f in (0, 1) if (fold == f).any()]

    ready = _with_features(sample, "text", "values", pick)
    ready = materialise(ready.select(F.col("label").cast("double"), "fold", "values")).withColumn("x", array_to_vector("values"))
    learner = GBTClassifier(
        featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, maxBins=64, stepSize=0.2, seed=7, cacheNodeIds=False
    )
    both = all(all(x) for x in n)
    first = learner.fit(ready.where("fold = 0") if both else ready)
    unseen = first.transform(ready.where("fold = 1") if both else ready)
    margins = unseen.select("label", vector_to_array("rawPrediction")[1].alias("margin"))
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label").fit(margins)
    return Model(whole, learner.fit(ready), calibration, toxic / (clean + toxic))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document `doc_id, held_out, score, predicted`. Null texts count as empty; repeated ids each get a row.

    Without labels of both kinds, every score is the share of toxic labels (0 if there is none).
    """
    scored = fit(docs, labels).add_score(docs.select("doc_id", "text"), "text", "score")
    return scored.select(
        "doc_id",
        (crc_part(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def reject(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The documents whose score is below the threshold, with the columns of `docs`."""
    (name,) = own("score")
    scored = fit(docs.select(F.col("doc_id"), F.col(f"`{text}`").alias("text")), labels).add_score(docs, text, name)
    return scored.where(F.col(name) < THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole document."""
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLES: dict[str, str] = {}
