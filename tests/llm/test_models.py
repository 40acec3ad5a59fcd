"""Training samples keep their bounds, and the trained models equal plain Python."""

from math import exp, sqrt

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratinglens.llm import language_id, models, personal_data, quality_classifier


def _sample(df, bound, **options):
    return models.bounded_sample(df, ["doc_id", "text"], "text", bound, **options)


@pytest.mark.parametrize("doc_id", ["7", "null"])
def test_one_id_with_all_rows(spark, doc_id):
    rows = spark.range(40_000, numPartitions=8).select(F.expr(f"cast({doc_id} as bigint)").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    found = _sample(rows, 5000)
    assert found.columns == rows.columns and found.distinct().count() == found.count() == 5000
    assert sorted(_sample(rows.repartition(3), 5000).collect()) == sorted(found.collect())


def test_one_row_over_and_over(spark):
    alike = spark.range(40_000, numPartitions=8).select(F.lit(1).cast("bigint").alias("doc_id"), F.lit("same").alias("text"))
    others = spark.range(2, 12).select(F.col("id").alias("doc_id"), F.lit("other").alias("text"))
    assert _sample(alike, 5000).count() == 1
    assert _sample(alike.union(others), 5000).count() == 11
    assert _sample(alike.limit(0), 5000).count() == 0


def test_bytes_and_strata(spark):
    rows = spark.range(3000, numPartitions=8).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "a").alias("lang"), F.repeat(F.lit("x"), 100).alias("text"))
    found = _sample(rows, 1000, most_bytes=20_000)
    assert found.count() == 200
    by = {r.lang: r["count"] for r in _sample(rows, 300, stratum="lang").groupBy("lang").count().collect()}
    assert by == {"a": 300, None: 300}
    long = spark.createDataFrame([(1, "y" * 2000), (2, "z"), (3, None)], "doc_id bigint, text string")
    assert {r.doc_id for r in _sample(long, 10, most_bytes=20_000).collect()} == {2, 3}


def test_classifiers_learn_from_repeated_and_null_ids(spark):
    texts = spark.range(4000).select(F.lit(5).cast("bigint").alias("doc_id"), F.concat(F.lit("good words here "), "id").alias("text"))
    labels = spark.range(1000).select(F.lit(5).cast("bigint").alias("doc_id"), F.lit(1).alias("quality"))
    assert np.any(quality_classifier.train(texts, labels, bound=500))
    spoken = spark.range(4000).select(
        F.lit(None).cast("bigint").alias("doc_id"), F.when(F.col("id") % 2 == 0, "xx").otherwise("yy").alias("lang"),
        F.concat(F.when(F.col("id") % 2 == 0, "lorem ipsum ").otherwise("kwik brow "), "id").alias("text"))
    model = language_id.train(spoken, bound=100)
    found = language_id.identify(spoken, model).select("lang_pred").groupBy("lang_pred").count().collect()
    assert {r.lang_pred: r["count"] for r in found} == {"xx": 2000, "yy": 2000}


def test_labels_that_differ(spark):
    """The label that most rows of an id give; 1 in a tie."""
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f"), (3, "g h i")], "doc_id int, text string")
    labels = lambda rows: spark.createDataFrame(rows, "doc_id int, quality int")
    mixed = quality_classifier.train(docs, labels([(1, 0), (1, 0), (1, 1), (2, 0), (2, 1), (3, 1), (3, 7), (3, None)]))
    assert np.array_equal(mixed, quality_classifier.train(docs, labels([(1, 0), (2, 1), (3, 1)])))


def test_leader_in_plain_python():
    texts = ["good words stand here", "bad BAD bad bad 1 2 3", "", "more good words, here and there", "bad 99 %% bad bad bad"] * 3
    labels = [1.0, 0.0, 0.0, 1.0, 0.0] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(labels), pa.array(texts)], names=["label", "text"])
    found = quality_classifier.fit(iter([batch]))["weights"]
    examples = [(label, dict(zip(feature.tolist(), value.tolist(), strict=True))) for label, feature, value in quality_classifier._examples([batch])]
    z, n = {}, {}
    alpha, beta, l1, l2 = (getattr(quality_classifier, x) for x in ("ALPHA", "BETA", "L1", "L2"))

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((beta + sqrt(n[i])) / alpha + l2)

    for _ in range(quality_classifier.PASSES):
        for label, row in examples:
            w = {i: weight(i) for i in row}
            p = 1 / (1 + exp(-sum(w[i] * x for i, x in row.items())))
            for i, x in row.items():
                g, old = (p - label) * x, n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (sqrt(old + g * g) - sqrt(old)) / alpha * w[i]
                n[i] = old + g * g
    expected = np.zeros(len(found))
    for i in z:
        expected[i] = weight(i)
    assert np.allclose(found, expected, atol=1e-6) and np.any(found)


def test_decoding_in_plain_python():
    random = np.random.default_rng(4)
    code = language_id.codewords(5)
    model = language_id.Model(list("abcde"), code, random.normal(size=(6, code.shape[1])), random.normal(size=code.shape[1]),
                              random.uniform(0.1, 1, code.shape[1]))
    rows = random.normal(size=(50, 6))
    best, score, ambiguous = model.decode(rows)
    for row, k, s, near in zip(rows.tolist(), best, score, ambiguous, strict=True):
        bits = [1 / (1 + exp(-(sum(x * model.weights[j, b] for j, x in enumerate(row)) + model.bias[b]))) for b in range(code.shape[1])]
        losses = [sum(-t * np.log(p if bit else 1 - p) for t, p, bit in zip(model.trust, bits, word, strict=True)) for word in code]
        first, second = sorted(losses)[:2]
        assert losses.index(first) == k and near == (second - first < language_id.MARGIN * model.trust.mean())
        assert abs(s - 1 / sum(exp(first - x) for x in losses)) < 1e-9


def test_base_spans_of_all_kinds_in_plain_python(docs):
    """Cards and phones against their patterns as stated, with a check sum of its own."""
    import re
    card, phone = re.compile("[0-9]([\\x20-]?[0-9])+"), re.compile("\\+[0-9][\\x20().0-9-]+[0-9]")

    def passes(digits):
        return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0

    texts = [r.text for r in docs.collect() if r.text] + [
        "4111 1111 1111 1111, 4111 1111 1111 1112, 4111-1111-1111-1111 22", "+1 (415) 555-2671 +123456789 +1234567890123456 +44.20 7946 0958."]
    found = 0
    for text in texts:
        expected = [(m.start(), 2, m.end()) for m in card.finditer(text)
                    if 14 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and passes(d)]
        expected += [(m.start(), 3, m.end()) for m in phone.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        assert [tuple(s) for s in personal_data.base_spans(text) if s.order > 1] == sorted(expected)
        found += len(expected)
    assert found > 3
