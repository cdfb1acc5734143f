import collections
import random

import numpy as np
from flowlens.llm import suffix_dedup as S
from flowlens.llm.suffix_dedup import compare_neighbours, repeated_passages, run_hashes, suffix_array
from pyspark.sql import functions as F

from .data import awkward, empty, prose


def corpus():
    rand = random.Random(5)
    shared = [prose(700 + k, n).replace(".", "") for k, n in enumerate((51, 51, 60, 90, 49, 300))]
    rows = [(i, prose(i, 200)) for i in range(25)]
    for i in range(60):
        parts = [prose(1000 + 3 * i, rand.randrange(1, 40)), shared[i % 6], prose(1001 + 3 * i, rand.randrange(1, 40)), shared[(i * 5 + 1) % 6]]
        rows.append((100 + i, " ".join(parts)))
    rows.append((300, prose(31, 100) + " " + prose(31, 100)))  # repeats in itself only
    return rows


def brute(rows, size=51):
    """Spans of words in runs of ``size`` that another document has."""
    holders = collections.defaultdict(set)
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for a in range(len(w) - size + 1):
            holders[tuple(w[a : a + size])].add(i)
    out = {}
    for i, w in split:
        merged = []
        for a in range(len(w) - size + 1):
            if len(holders[tuple(w[a : a + size])]) > 1:
                if merged and a < merged[-1][1]:
                    merged[-1][1] = a + size
                else:
                    merged.append([a, a + size])
        if merged:
            out[i] = merged
    return out


def check(got, want, slack=9):
    """All passages are found, in no other documents.  An end may be off by
    less than the window: a one-byte hash can take one word for another, the
    neighbour need not be the document that agrees furthest to the left, and
    passages of different documents that overlap are one."""
    assert set(got) == set(want)
    for i, spans in want.items():
        for a, b in spans:
            assert any(x <= a + slack and b - slack <= y for x, y in got[i]), (i, spans, got[i])
        assert sum(y - x for x, y in got[i]) <= sum(b - a for a, b in spans) + 2 * slack * len(spans)


def found(docs, **options):
    return {r.doc_id: [(p.start, p.stop) for p in r.passages] for r in repeated_passages(docs, **options).collect()}


def test_matches_brute_force(spark):
    rows = corpus()
    check(found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)), brute(rows))


def test_groups_across_partitions_are_joined(spark, monkeypatch):
    """As many partitions as there are rows, nearly: every group is cut."""
    rows = corpus()
    monkeypatch.setattr(S, "partitions", lambda spark: 300)
    check(found(spark.createDataFrame(rows, "doc_id long, text string")), brute(rows))


def test_a_passage_in_most_documents(spark):
    common = prose(77, 80)
    rows = [(i, f"{prose(2000 + i, 30)} {common} {prose(4000 + i, 30)}") for i in range(400)]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(got) == 400 and all(any(x <= 30 and 110 <= y for x, y in spans) for spans in got.values())


def test_awkward_rows(spark):
    docs = awkward(spark, "h int, start int, doc string", (1, 2, "d"))
    got = found(docs)
    assert got[7] == got[8] and got[7][0][0] == 0
    assert not {1, 3, 4, 5, 6, 9, 10, 11} & set(got)  # 3 repeats under one id only
    assert set(got) >= {2, -5}
    assert repeated_passages(empty(spark)).count() == 0


def test_run_hashes_depend_on_the_words_alone():
    words = np.random.RandomState(1).randint(0, 4, 400).astype(np.uint64) * np.uint64(0x123456789ABCDEF)
    hashes = run_hashes(words, 5, 0x9E3779B97F4A7C15)
    runs = [tuple(words[i : i + 5].tolist()) for i in range(396)]
    assert len(set(zip(runs, hashes.tolist()))) == len(set(runs)) == len(set(hashes.tolist()))


def test_whole_groups_need_no_edges(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    rows = suffix_array(docs, "text", "doc_id", 8, 10, 42).repartition(4, "h", "g").sortWithinPartitions("h", "g", "near", "doc", "at")
    out = compare_neighbours(rows, 42, True)
    assert out.filter(F.col("start").isNull()).count() == 0 and out.count() > 0


def exact(got, want):
    assert got == {i: [tuple(s) for s in spans] for i, spans in want.items()}


def test_every_stretch_is_found_to_the_word(spark, monkeypatch):
    for parts in (8, 300):
        monkeypatch.setattr(S, "partitions", lambda spark, n=parts: n)
        exact(found(spark.createDataFrame(corpus(), "doc_id long, text string")), brute(corpus()))


def boilerplate_tails():
    """Two documents share a few own words and the boilerplate after (or
    before) them, which stands in very many documents."""
    rows = []
    for t, own in enumerate((5, 10, 14, 20)):
        for mirrored in (0, 1):
            base, tail = 10_000 * (2 * t + mirrored), prose(9000 + 2 * t + mirrored, 51 - own).split()
            texts = [(prose(base + i, 30).split(), prose(base + 500 + i, 30).split()) for i in range(60)]
            for i, (left, right) in enumerate(texts):
                shared = prose(base + 900 if i in (17, 41) else base + 1000 + i, own).split()
                words = [*left, *shared, *tail, *right]
                rows.append((base + i, " ".join(words[::-1] if mirrored else words)))
    return rows


def test_own_words_before_or_after_boilerplate(spark, monkeypatch):
    rows = boilerplate_tails()
    want = brute(rows)
    assert len(want) >= 16
    for parts in (8, 300):
        monkeypatch.setattr(S, "partitions", lambda spark, n=parts: n)
        exact(found(spark.createDataFrame(rows, "doc_id long, text string")), want)
    exact(found(spark.createDataFrame(rows, "doc_id long, text string"), window=10), want)
