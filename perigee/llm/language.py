"""Language identification with error-correcting output codes.

Each language has a codeword. For each bit of the code a binary classifier over character
n-grams tells the languages that have the bit from those that have not; a text's language is
the codeword with the least loss against the classifiers' margins, each weighed by how often
its classifier was right on texts it had not learnt from. Where the second codeword comes close, the text is flagged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.code import ship_code
from perigee.session import work_table

FEATURES = 1 << 15
BLOCK = 1 << 19
SPACE = 32
UNKNOWN = "und"
#: About so many texts of a language are learnt from, drawn by hash; a language with fewer gives all.
TRAIN_ROWS = 4000
#: Parts of the sample; each part's texts are judged by classifiers that learnt from the others.
FOLDS = 4
#: Texts of which the best two codewords are nearer than this are flagged.
CLEAR = 0.9


def code_matrix(languages: int) -> np.ndarray:
    """Codewords of 1 and -1, a row per language; no bit is the same for all.

    Up to five languages get the exhaustive code; more get the best of some random codes, with
    bits in proportion to the logarithm of their number.
    """
    if languages < 2:
        return np.zeros((languages, 0), dtype=np.float32)
    if languages <= 5:
        bits = [[(column >> row) & 1 for column in range(1, 1 << (languages - 1))] for row in range(languages - 1)]
        return np.array([[0] * len(bits[0]), *bits], dtype=np.float32) * 2 - 1
    random, width = np.random.default_rng(0), math.ceil(10 * math.log2(languages))
    best, best_distance = None, -1.0
    for _ in range(200):
        code = random.choice(np.array([-1, 1], dtype=np.float32), (languages, width))
        code[0, np.abs(code.sum(0)) == languages] *= -1
        agreement = code @ code.T
        np.fill_diagonal(agreement, -width)
        distance = width - agreement.max()
        if distance > best_distance:
            best, best_distance = code, distance
    return best


@cache
def _folded() -> np.ndarray:
    """For each code point its lower-case letter, or a space if it is none."""
    table = np.full(0x110000, SPACE, dtype=np.uint32)
    for point in range(0x110000):
        character = chr(point)
        if character.isalpha():
            table[point] = ord(character.lower()[0])
    return table


def _pieces(texts: Sequence[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts in blocks of bounded size; a long text comes in several pieces that overlap by two characters."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        text = text or ""
        for at in range(0, max(len(text) - 2, 1), BLOCK):
            part = text[at : at + BLOCK + 2]
            if size and size + len(part) > BLOCK:
                yield rows, parts
                rows, parts, size = [], [], 0
            rows.append(row)
            parts.append(part)
            size += len(part)
    if rows:
        yield rows, parts


def gram_blocks(texts: Sequence[str | None]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Hashed 2- and 3-grams of blocks of texts: the texts' rows, each gram's place in those, its feature.

    Grams are of lower-case letters and single spaces for whatever stands between; none spans two texts.
    """
    for rows, parts in _pieces(texts):
        joined = "\n" + "\n".join(parts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letters = _folded()[points]
        owner = np.repeat(np.arange(len(parts)), [len(part) + 1 for part in parts])
        owner = np.concatenate([[0], owner])
        keep = letters != SPACE
        keep[1:] |= letters[:-1] != SPACE
        keep[0] = True
        letters, owner = letters[keep].astype(np.uint32), owner[keep]
        first, second, third = letters[:-2], letters[1:-1], letters[2:]
        pair = first * np.uint32(0x9E3779B1) ^ second * np.uint32(0x85EBCA77)
        triple = pair * np.uint32(0x27D4EB2F) ^ third * np.uint32(0xC2B2AE3D)
        place = owner[1:-1]
        # The space before a text's first letter may be the one that ends the text before.
        inside2 = (second != SPACE) & (owner[:-2] <= place)
        inside3 = (owner[2:] == place) & (second != SPACE)
        shift = np.uint32(32 - FEATURES.bit_length() + 1)
        features = np.concatenate(
            [(pair[inside2] * np.uint32(0x165667B1)) >> shift, (triple[inside3] * np.uint32(0x165667B1)) >> shift]
        )
        yield rows, np.concatenate([place[inside2], place[inside3]]), features


@dataclass(frozen=True)
class Model:
    """Languages, their code, the classifiers' weights by feature and bit, and each bit's reliability."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    reliability: np.ndarray

    def margins(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Margin of each bit for each text, and the number of its grams."""
        sums, counts = np.zeros((len(texts), self.code.shape[1])), np.zeros(len(texts))
        for rows, places, features in gram_blocks(texts):
            number = np.bincount(places, minlength=len(rows))
            np.add.at(counts, rows, number)
            order = np.argsort(places, kind="stable")
            starts = np.cumsum(number) - number
            some = number > 0
            if some.any() and self.code.shape[1]:
                part = np.add.reduceat(self.weights[features[order]], starts[some], axis=0)
                np.add.at(sums, np.array(rows)[some], part)
        return sums / np.sqrt(np.maximum(counts, 1))[:, None], counts

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """Share of each language for each row of margins: the less the weighed loss, the more."""
        loss = np.zeros((len(margins), len(self.languages)))
        for language, word in enumerate(self.code):
            loss[:, language] = (np.logaddexp(0, -margins * word) * self.reliability).sum(1)
        shares = np.exp(loss.min(1, keepdims=True) - loss)
        return shares / shares.sum(1, keepdims=True)


def learn(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model from texts with a language (text, lang, doc_id).

    A bounded sample is learnt from: about `train_rows` texts of each language. What comes to the driver
    is a vector of gram counts per language and fold. Equal texts are in one fold. A text with several languages counts
    for each; rows without a language or text count for none; of an empty table comes a model that knows none.
    """
    ship_code(docs.sparkSession)
    docs = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    totals = docs.groupBy("lang").agg(F.count("*").alias("total"))
    share = F.least(F.lit(1.0), F.lit(float(train_rows)) / F.col("total"))
    limits = totals.withColumn("limit", F.ceil(share * F.lit(float(1 << 30)))).select("lang", "limit")
    sample = (
        docs.withColumn("draw", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)))
        .join(F.broadcast(limits), "lang")  # one row per language; the model has as many
        .filter(F.col("draw") < F.col("limit"))
        .select("lang", "text", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"))
    )
    sample = work_table(sample, "language-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            langs, texts, folds = (column.to_pylist() for column in batch.columns)
            of = [*zip(langs, folds, strict=True)]
            for place in set(of):
                own = sums.setdefault(place, np.zeros(FEATURES, dtype=np.int64))
                for _, _, features in gram_blocks([t for t, x in zip(texts, of, strict=True) if x == place]):
                    own += np.bincount(features, minlength=FEATURES)
        if sums:
            counts = pa.array([x.tobytes() for x in sums.values()], pa.binary())
            langs, folds = zip(*sums, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(folds, pa.int32()), counts], names=["lang", "fold", "counts"]
            )

    def add(parts):
        total = sum(np.frombuffer(x, dtype=np.int64) for x in parts["counts"])
        return parts.head(1).assign(counts=[total.tobytes()])

    schema = "lang string, fold int, counts binary"
    rows = sample.mapInArrow(count, schema).groupBy("lang", "fold").applyInPandas(add, schema).collect()
    parts = {(row.lang, row.fold): np.frombuffer(row.counts, dtype=np.int64) for row in rows}
    languages = tuple(sorted({lang for lang, _ in parts}))
    code = code_matrix(len(languages))

    def model(*without: int) -> Model:
        counts = {lang: np.zeros(FEATURES, dtype=np.int64) for lang in languages}
        for (lang, fold), own in parts.items():
            if fold not in without:
                counts[lang] = counts[lang] + own
        return Model(languages, code, _log_odds(counts, languages, code), np.ones(code.shape[1]))

    if not code.shape[1]:
        return model()
    return replace(model(), reliability=_reliability(sample, [model(fold) for fold in range(FOLDS)]))


def _log_odds(counts: dict[str, np.ndarray], languages: Sequence[str], code: np.ndarray) -> np.ndarray:
    """Weights of the bits' classifiers: how much likelier a gram is where the bit is set."""
    weights = np.zeros((FEATURES, code.shape[1]), dtype=np.float32)
    if not len(languages):
        return weights
    # Every language weighs the same, however much text of it there is.
    shares = np.array([(counts[x] + 0.5) / (counts[x] + 0.5).sum() for x in languages])
    for bit in range(code.shape[1]):
        has = code[:, bit] > 0
        weights[:, bit] = np.log(shares[has].mean(0)) - np.log(shares[~has].mean(0))
    return weights


def _reliability(sample: DataFrame, models: Sequence[Model]) -> np.ndarray:
    """Share of the sample's texts for which each bit's classifier is right, by the model that left their fold out."""
    held = sample.sparkSession.sparkContext.broadcast(models)
    bits = models[0].code.shape[1]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {language: i for i, language in enumerate(held.value[0].languages)}
        hits, seen = np.zeros(bits, dtype=np.int64), 0
        for batch in batches:
            langs, texts, folds = (column.to_pylist() for column in batch.columns)
            for fold in set(folds):
                own, model = [i for i, x in enumerate(folds) if x == fold], held.value[fold]
                margins, counts = model.margins([texts[i] for i in own])
                words = model.code[[places[langs[i]] for i in own]]
                right = (margins * words > 0)[counts > 0]
                hits, seen = hits + right.sum(0), seen + len(right)
        columns = [pa.array(np.arange(bits), pa.int64()), pa.array(hits, pa.int64()), pa.array(np.full(bits, seen), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["bit", "hits", "seen"])

    sums = sample.mapInArrow(judge, "bit long, hits long, seen long").groupBy("bit").agg(
        F.sum("hits").alias("hits"), F.sum("seen").alias("seen")
    )
    out = np.ones(bits)
    for row in sums.collect():
        out[row.bit] = (row.hits + 1) / (row.seen + 2)
    return out


def identify(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`keep` columns with lang_pred, score (0 to 1) and `ambiguous`, from the whole text alone.

    A null text, one without letters, and any text if nothing was learnt, is `und` with score 0. Equal texts get equal
    results, and the language first by name where two codewords are equally near. A very long text is read whole, in
    pieces. The model is broadcast: its size is bounded by the number of features and of bits.
    """
    ship_code(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*keep).schema.add("lang_pred", "string", False).add("score", "double", False)
    schema = schema.add("ambiguous", "boolean", False)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            margins, counts = model.margins(batch.column(batch.num_columns - 1).to_pylist())
            known = (counts > 0) & bool(model.languages)
            if model.languages:
                shares = model.decode(margins)
                best = shares.argmax(1)
                score = np.where(known, shares.max(1), 0.0)
                second = np.sort(shares, axis=1)[:, -2] if len(model.languages) > 1 else np.zeros(len(best))
                unclear = ~known | (second > (1 - CLEAR) * score)
            else:
                best, score, unclear = np.zeros(len(counts), dtype=int), np.zeros(len(counts)), ~known
            names = [model.languages[i] if ok else UNKNOWN for i, ok in zip(best, known, strict=True)]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(unclear, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*keep, "text").mapInArrow(predict, schema)


def op2_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = learn(docs.filter(~held_out))
    return identify(docs.withColumn("held_out", held_out), model, keep=("doc_id", "held_out"))
