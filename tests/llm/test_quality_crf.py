import itertools
import zlib

import numpy as np
import pytest
from flowlens.llm.quality_crf import FEATURES, Chain, line_features, score_quality, split_lines, train

from .data import awkward, empty, prose


def chain(seed):
    model, rand = Chain(), np.random.RandomState(seed)
    model.unary[:FEATURES] = rand.standard_normal(FEATURES)
    model.change = rand.standard_normal((2, 2))
    return model


@pytest.mark.parametrize("seed", range(5))
def test_marginals_against_all_labellings(seed):
    model, lines = chain(seed), ["a b c", "", "AAA!!! ### |", "a b c", "x. http://y"][: seed + 1]
    gain = model.unary[line_features(lines)].sum(axis=1)
    total, good = 0.0, np.zeros(len(lines))
    for labels in itertools.product((0, 1), repeat=len(lines)):
        w = np.exp(sum(g for g, y in zip(gain, labels) if y) + sum(model.change[a, b] for a, b in zip(labels, labels[1:])))
        total += w
        good += w * np.array(labels)
    assert np.allclose(model.marginals(line_features(lines)), good / total)


def test_gradient_raises_the_likelihood():
    documents = [(line_features(split_lines(prose(i, 40))), 1) for i in range(10)]
    documents += [(line_features(split_lines(prose(i, 40).upper().replace(" ", "!! ") + "\n###")), 0) for i in range(10)]
    model = Chain()
    model.fit(documents, 60, 0.1, 1e-3)
    assert all((model.marginals(f) > 0.5).all() == bool(y) for f, y in documents)


def labelled(spark):
    rows, labels = [], []
    for i in range(150):
        bad = i % 3 == 0
        text = "\n".join(prose(1000 * i + k, 30) for k in range(4))
        rows.append((i, text.upper().replace(" ", "!! ") if bad else text))
        labels.append((i, 0 if bad else 1))
    labels += [(None, 1), (5, None)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy_and_folds(spark):
    docs, labels = labelled(spark)
    out = score_quality(docs, train(docs, labels)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(r.predicted == (r.score >= 0.3) == (r.doc_id % 3 != 0) for r in out if r.held_out)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = labelled(spark)
    flipped = spark.createDataFrame(
        [(r.doc_id, 1 - r.quality if r.doc_id is not None and r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 else r.quality) for r in labels.collect()],
        labels.schema,
    )
    a, b = train(docs, labels), train(docs, flipped)
    assert np.array_equal(a.unary, b.unary) and np.array_equal(a.change, b.change)


def test_awkward_rows(spark):
    docs, labels = labelled(spark)
    odd = awkward(spark, "score string, held_out int, y int", ("s", 1, 2))
    out = score_quality(odd, train(docs, labels)).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (7, 8)}) == 1
    assert score_quality(empty(spark), Chain()).count() == 0
    assert {r.score for r in score_quality(odd, train(odd, labels.limit(0))).collect()} == {0.5}
    one = train(docs, labels.filter("quality = 1"))
    assert all(r.predicted == 1 for r in score_quality(docs.filter("doc_id % 3 = 1"), one).collect())


def test_the_tail_of_a_long_document_is_trained_on(spark):
    clean = lambda i, n: "\n".join(prose(1000 * i + k, 12) for k in range(n))
    junk = clean(999, 40).upper().replace(" ", "!! ")
    models = []
    for tail in (junk, clean(998, 40)):
        rows = [(i, clean(i, 64) + "\n" + tail if i % 3 == 0 else clean(i, 8)) for i in range(45)]
        labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(45)], "doc_id long, quality int")
        models.append(train(spark.createDataFrame(rows, "doc_id long, text string"), labels, steps=40))
    assert not np.array_equal(models[0].unary, models[1].unary)
    assert models[0].score(junk) < min(0.3, models[1].score(junk))
