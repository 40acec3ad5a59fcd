"""Operator 7: quality scores by logistic regression on hashed word n-grams, trained with follow-the-regularised-leader."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .models import bounded_sample, sigmoid, train_in_one_task
from .staging import type_of
from .word_arrays import mix, text_slices, window_hashes, words_of

FEATURE_BITS = 18
TRAINING_BOUND = 8000           # labelled documents that the model is fitted on, at most
PASSES, ALPHA, BETA, L1, L2 = 3, 0.3, 1.0, 0.02, 0.1
_U64 = np.uint64
_BIAS, _REPEATED = 0, 1         # features of every text and of a window of three words seen before in the text


def _shape_classes() -> np.ndarray:
    """Bit of a byte's class: lower case, upper case, digit, mark of punctuation, other sign, part of another letter."""
    classes = np.full(256, 16, np.uint8)
    classes[97:123], classes[65:91], classes[48:58], classes[128:] = 1, 2, 4, 32
    classes[[ord(c) for c in ".,;:!?'\"()-"]] = 8
    classes[[9, 10, 11, 12, 13, 32]] = 0
    return classes


_CLASSES = _shape_classes()


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of the n-grams of all texts of a slice; the values of a text's n-grams add up alike.

    N-grams are pairs and single words, and runs of one to three word shapes: which classes of characters a word
    has and about how long it is.
    """
    words = words_of(data, offsets)
    count = len(offsets) - 1
    lengths = np.diff(words.first)
    size_class = np.minimum(np.log2(lengths + 1).astype(np.int64), 20)
    parts = [(np.arange(count), np.full(count, _BIAS), np.ones(count)),
             (np.arange(count), mix(size_class.astype(_U64) + _U64(1 << 40)) >> _U64(64 - FEATURE_BITS), np.ones(count))]
    if len(words.hashes):
        text = words.text_of()
        ends = np.append(words.starts[1:], len(data))
        shape = np.bitwise_or.reduceat(_CLASSES[data], words.starts).astype(_U64)
        shapes = mix(shape * _U64(32) + np.minimum((ends - words.starts) // 4, 5).astype(_U64))
        for kind, (hashes, size) in enumerate(((words.hashes, 1), (words.hashes, 2), (shapes, 1), (shapes, 2), (shapes, 3))):
            places = words.windows(size)
            grams = mix(window_hashes(hashes, places, range(size)) + _U64(kind))
            of = text[places]
            parts.append((of, grams >> _U64(64 - FEATURE_BITS), 1 / lengths[of]))
        places = words.windows(3)
        threes = mix(window_hashes(words.hashes, places, range(3)) ^ mix(text[places].astype(_U64)))
        again = np.ones(len(places), bool)
        again[np.unique(threes, return_index=True)[1]] = False
        of = text[places[again]]
        parts.append((of, np.full(len(of), _REPEATED), 1 / lengths[of]))
    return tuple(np.concatenate([p[i].astype(t) for p in parts]) for i, t in enumerate((np.int64, np.int64, np.float64)))


def _examples(batches: Iterator[pa.RecordBatch]):
    """(label, features, values) of each text, equal features added up."""
    for batch in batches:
        labels = batch.column(0).to_numpy(zero_copy_only=False)
        for begin, data, offsets in text_slices(batch.column(1)):
            text, feature, value = features(data, offsets)
            key, place = np.unique((text << FEATURE_BITS) | feature, return_inverse=True)
            total = np.bincount(place, weights=value)
            bounds = np.searchsorted(key >> FEATURE_BITS, np.arange(len(offsets)))
            for i in range(len(offsets) - 1):
                part = slice(bounds[i], bounds[i + 1])
                yield labels[begin + i], (key[part] & (1 << FEATURE_BITS) - 1).astype(np.int32), total[part]


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The leader's weights: zero where the summed gradient stays within the L1 bound."""
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
    z, n = np.zeros(1 << FEATURE_BITS), np.zeros(1 << FEATURE_BITS)
    examples = list(_examples(batches))
    for _ in range(PASSES):
        for label, feature, value in examples:
            old = n[feature]
            weight = _weights(z[feature], old)
            gradient = (sigmoid(weight @ value) - label) * value
            squared = gradient * gradient
            z[feature] += gradient - (np.sqrt(old + squared) - np.sqrt(old)) / ALPHA * weight
            n[feature] = old + squared
    return {"weights": _weights(z, n).astype(np.float32)}


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_BOUND, text: str = "text", doc_id: str = "doc_id",
          quality: str = "quality") -> np.ndarray:
    """Weights learnt from at most ``bound`` documents with a label of 0 or 1 and at most ``models.SAMPLE_BYTES`` bytes of text.

    Labels of one id count as one, the one that most of them give, 1 in a tie. So many different ids are chosen of them first,
    so they are small enough to be broadcast to the documents whatever their number; of documents that repeat an id the
    different texts are then chosen within the same bound. Null ids have no label; null texts are learnt from as empty ones.
    """
    labels = labels.select(F.col(doc_id).alias("labelled"), F.col(quality).alias("label")).where("label in (0, 1) and labelled is not null")
    ids = labels.groupBy("labelled").agg((F.avg("label") >= 0.5).cast("double").alias("label")).withColumn("no_text", F.lit(""))
    chosen = F.broadcast(bounded_sample(ids, ["labelled"], "no_text", bound))
    sample = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(chosen, F.col("doc_id") == F.col("labelled")).select(
        "label", "text", F.xxhash64("labelled").alias("place"))
    sample = bounded_sample(sample, ["place", "text"], "text", bound)
    return train_in_one_task(sample, fit, ["place", "text"]).get("weights", np.zeros(1 << FEATURE_BITS, np.float32))


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score, predicted) of each row: the sparse dot product of its n-grams with the weights.

    A null text is scored as an empty one. Ids are passed through, null or repeated; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, data, offsets in text_slices(batch.column(1)):
                count = len(offsets) - 1
                of, feature, value = features(data, offsets)
                scores = sigmoid(np.bincount(of, weights=weights[feature] * value, minlength=count))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, count), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {type_of(docs, doc_id)}, score double, predicted int")
