"""Operator 8: languages by error-correcting output codes over binary classifiers of byte n-grams."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .models import SAMPLE_BYTES, bounded_sample, sigmoid, train_in_one_task
from .staging import type_of
from .word_arrays import mix, text_slices

FEATURES = 2048
SIZES = (1, 2, 3)
TRAINING_BOUND = 1000           # documents of each language that the classifiers are fitted on, at most
TRAINING_TOTAL = 40_000         # ... and of all together: each is a dense row of 8 KB in the task that fits them
STEPS, RATE, DECAY = 400, 4.0, 1e-4
MARGIN = 0.5                    # less of a lead over the next codeword, in weighted log loss a bit, is ambiguous
UNDETERMINED = "und"
_U64 = np.uint64


def codewords(languages: int) -> np.ndarray:
    """A row of bits for each language: all splits in two for up to six, else random balanced splits."""
    if languages <= 6:
        return np.array([[split >> i & 1 for split in range(1, 1 << languages - 1)] for i in range(languages)], np.int8).reshape(languages, -1)
    random = np.random.Generator(np.random.PCG64(11))
    columns = [random.permutation(np.arange(languages) % 2) for _ in range(8 * languages.bit_length())]
    return np.unique(np.array(columns, np.int8), axis=0).T


def _letters() -> np.ndarray:
    table = np.full(256, 32, np.uint8)
    table[97:123] = table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


_LETTERS = _letters()


def frequencies(column: pa.Array) -> Iterator[np.ndarray]:
    """Row of square roots of hashed n-gram shares for each text; other bytes than letters count as spaces."""
    for _, data, offsets in text_slices(column):
        letters = np.concatenate([_LETTERS[data], np.full(max(SIZES), 32, np.uint8)]).astype(_U64)
        codes = []
        for size in SIZES:
            gram = np.full(len(data), size, _U64)
            for i in range(size):
                gram = gram * _U64(256) + letters[i:i + len(data)]
            codes.append(np.where(letters[:len(data)] == 32, FEATURES, (mix(gram) >> _U64(53)).astype(np.int64)))
        for begin, end in zip(offsets[:-1], offsets[1:], strict=True):
            counts = sum(np.bincount(code[begin:end], minlength=FEATURES + 1)[:FEATURES] for code in codes)
            yield np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray            # language x bit
    weights: np.ndarray         # feature x bit
    bias: np.ndarray
    trust: np.ndarray           # weight of a bit's loss: how far its classifier is better than chance

    def decode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, ambiguous): the codeword of least weighted loss, its share among all, and whether another is near."""
        if len(self.languages) == 1:
            return np.zeros(len(rows), int), np.ones(len(rows)), np.zeros(len(rows), bool)
        p = np.clip(sigmoid(rows @ self.weights + self.bias), 1e-6, 1 - 1e-6)
        loss = -(np.log(p) * self.trust) @ self.code.T - (np.log(1 - p) * self.trust) @ (1 - self.code.T)
        best = loss.argmin(axis=1)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        nearest = np.sort(loss, axis=1)
        return best, 1 / share.sum(axis=1), nearest[:, 1] - nearest[:, 0] < MARGIN * self.trust.mean()


def _fit(languages: list[str]):
    code = codewords(len(languages))
    number = {name: i for i, name in enumerate(languages)}

    def fit(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        rows, names = [], []
        for batch in batches:
            names += batch.column(0).to_pylist()
            rows += list(frequencies(batch.column(1)))
        if not rows:
            return {}
        x = np.stack(rows)
        target = code[[number[n] for n in names]].astype(np.float32)
        weights, bias = np.zeros((FEATURES, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
        for _ in range(STEPS):
            error = (sigmoid(x @ weights + bias) - target) / len(x)
            weights -= RATE * len(SIZES) * (x.T @ error + DECAY * weights)
            bias -= RATE * error.sum(axis=0)
        right = ((x @ weights + bias > 0) == (target > 0.5)).mean(axis=0)
        return {"weights": weights, "bias": bias, "trust": np.maximum(2 * right - 1, 0.01).astype(np.float32)}

    return fit


def train(docs: DataFrame, bound: int = TRAINING_BOUND, text: str = "text", doc_id: str = "doc_id", lang: str = "lang") -> Model | None:
    """The model of the languages of ``docs``, None without any; languages must be few.

    It is fitted on at most ``bound`` different documents of each, on fewer where languages are so many that these would be more than
    TRAINING_TOTAL, and on at most ``models.SAMPLE_BYTES`` bytes of text.
    """
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where(
        "lang is not null and text is not null")
    languages = sorted(r[0] for r in known.select("lang").distinct().collect())
    if not languages:
        return None
    each = max(1, min(bound, TRAINING_TOTAL // len(languages)))
    sample = bounded_sample(known, ["doc_id", "text"], "text", each, "lang", SAMPLE_BYTES // len(languages))
    if len(languages) == 1:
        empty = np.zeros((FEATURES, 0), np.float32)
        return Model(languages, codewords(1), empty, empty[0], empty[0])
    arrays = train_in_one_task(sample.select("lang", "text", F.xxhash64("doc_id").alias("place")), _fit(languages), ["place", "text", "lang"])
    if not arrays:
        return None
    return Model(languages, codewords(len(languages)), **arrays)


def identify(docs: DataFrame, model: Model | None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of each row.

    Each bit's classifier reads the n-grams of the whole text; decoding weighs the bits' losses. A null text or one
    without a letter is ``und`` with score 0 and not ambiguous; so is any text if there is no model. Ids are passed
    through, null or repeated; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                lettered = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                names, scores, ambiguous = [UNDETERMINED] * part.num_rows, np.zeros(part.num_rows), np.zeros(part.num_rows, bool)
                if model is not None:
                    best, scores, ambiguous = model.decode(np.stack(list(frequencies(part.column(1)))))
                    names = [model.languages[i] if x else UNDETERMINED for i, x in zip(best, lettered, strict=True)]
                    scores, ambiguous = np.where(lettered, scores, 0.0), ambiguous & lettered
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(ambiguous)],
                    names=["doc_id", "lang_pred", "score", "ambiguous"])

    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), has_letter).mapInArrow(
        run, f"doc_id {type_of(docs, doc_id)}, lang_pred string, score double, ambiguous boolean")
