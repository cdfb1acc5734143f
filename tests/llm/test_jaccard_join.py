import random

import numpy as np
from flowlens.llm.common import components
from flowlens.llm.jaccard_join import depth_for, intersections, keep_one_of_each, shingles, similar_documents

from .data import awkward, empty, prose


def edited(text, seed, n):
    words = text.split()
    rand = random.Random(seed)
    for _ in range(n):
        words[rand.randrange(len(words))] = f"edit{rand.randrange(10**6)}"
    return " ".join(words)


def brute(rows):
    sets = [frozenset(shingles(t).tolist()) for _, t in rows]
    n = len(rows)
    links = [[j for j in range(n) if j != i and sets[i] and len(sets[i] & sets[j]) * 1.0 >= 0.8 * len(sets[i] | sets[j])] for i in range(n)]
    top = list(range(n))
    for _ in range(n):
        for i in range(n):
            for j in links[i]:
                top[i] = min(top[i], top[j], key=lambda k: rows[k][0])
    return sorted((rows[i][0], rows[top[i]][0], len(links[i])) for i in range(n))


def corpus():
    rows = [(i, prose(i, 150)) for i in range(40)]
    for k in range(40):  # near copies at many similarities, and copies of copies
        base = rows[k % 8][1]
        rows.append((100 + k, edited(base, k, k % 7)))
        if k % 5 == 0:
            rows.append((200 + k, rows[-1][1]))
    rows += [(300 + k, edited(prose(999, 200), k, 2)) for k in range(30)]  # a group without any two equal texts
    return rows + [(400, "a b c"), (401, "a b c"), (402, "a b"), (403, ""), (404, None)]


def test_matches_brute_force(spark):
    rows = corpus()
    got = similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_blocks_give_the_same_result(spark, monkeypatch):
    from flowlens.llm import jaccard_join as J

    whole = J.in_blocks
    monkeypatch.setattr(J, "in_blocks", lambda rows, keys, node, n, size: whole(rows, keys, node, n, J.F.lit(7)))
    rows = corpus()
    got = similar_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_awkward_rows(spark):
    docs = awkward(spark, "digest string, row int, node int", ("d", 1, 2))
    out = similar_documents(docs)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == docs.count()
    by = {r[0]: r[1:] for r in got if r[0] is not None}
    assert by[3] == (3, 1) and by[7] == by[8] == (7, 1) and by[4] == (4, 0) and by[5] == (5, 0) and by[9] == (9, 0)
    assert similar_documents(empty(spark)).count() == 0


def test_keep_one_of_each(spark):
    docs = awkward(spark, "k int, rank int", (1, 2))
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(3) == 1 and 7 in ids and 8 not in ids and {1, 4, 5, 6, 9, 10, 11, 12} <= set(ids)


def test_depth_shortens_until_the_recall_is_met():
    assert depth_for(0.8, 24, 0.9999, 8) == 5
    assert depth_for(0.8, 24, 0.5, 8) == 8
    assert depth_for(0.8, 2, 0.9999, 8) == 1


def test_intersections():
    rand = np.random.RandomState(3)
    sets = [np.unique(rand.randint(0, 300, rand.randint(1, 90))).astype(np.uint64) for _ in range(20)]
    got = intersections(sets, columns=16)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(np.intersect1d(a, b))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000)]
    random.Random(1).shuffle(edges)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
