import random

import numpy as np
from flowlens.llm import decontaminate
from flowlens.llm.decontaminate import Items, align, bare_words, find_contamination, most
from hypothesis import given
from hypothesis import strategies as st

from .data import awkward, empty, prose


def slow_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 0.5, h[i, j - 1] - 0.5)
    return h.max()


@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(-1, 3), max_size=15))
def test_alignment_is_smith_waterman(a, b):
    assert abs(align(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)) - slow_align(a, b)) < 1e-9


def corpus(spark):
    items = [(i, prose(500 + i, 30)) for i in range(8)] + [(90, "two words"), (91, ""), (92, None), (None, prose(1, 20)), (8, prose(500, 30))]
    words = items[3][1].split()
    cut = " ".join(words[:12] + ["inserted", "text"] + words[12:20] + words[21:])
    swapped = " ".join("swap" if i % 9 == 4 else w for i, w in enumerate(items[5][1].split()))
    rows = [(i, prose(i, 120)) for i in range(30)]
    rows += [
        (100, prose(100, 60) + " " + items[0][1].upper() + " " + prose(101, 60)),
        (101, prose(102, 60) + "\n" + cut),
        (102, f"({swapped})"),
        (103, " ".join(words[:9]) + " " + prose(103, 80)),  # under a third of the item
        (104, None),
        (105, ""),
        (106, "They are TWO words, indeed."),
    ]
    rows += [(200 + i, prose(900 + i, 10) + " " + items[7][1]) for i in range(60)]  # an item in very many documents
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def slow(docs, items, min_score=0.5):
    """Full alignment of every item with every document."""
    out = {}
    for d in docs.collect():
        own = bare_words(d.text)
        for i in items.collect():
            words = bare_words(i.text)
            if i.item_id is None or not words:
                continue
            ids = {w: k for k, w in enumerate(dict.fromkeys(words))}
            score = align(np.array([ids[w] for w in words]), np.array([ids.get(w, -1) for w in own], dtype=np.int64)) / len(words) if own else 0
            if score >= min_score:
                out.setdefault(d.doc_id, []).append(i.item_id)
    return {k: sorted(v) for k, v in out.items()}


def test_finds_copied_and_edited_items(spark):
    docs, items = corpus(spark)
    got = {r.doc_id: r["items"] for r in find_contamination(docs, items).collect() if r.contaminated}
    assert got[100] == [0, 8] and got[101] == [3] and got[102] == [5] and got[106] == [90]
    assert all(got[200 + i] == [7] for i in range(60))
    assert got == slow(docs, items)


def test_slices_of_the_benchmark_give_the_same(spark):
    docs, items = corpus(spark)
    one = sorted(map(str, find_contamination(docs, items).collect()))
    assert sorted(map(str, find_contamination(docs, items, slice_words=60).collect())) == one


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark, "items string, score string, item_id int", ("mine", "s", 4))
    _, items = corpus(spark)
    out = find_contamination(docs, items)
    assert out.columns == [*docs.columns, "_items", "_score", "contaminated"]
    assert out.count() == docs.count() and {r["items"] for r in out.collect()} == {"mine"}
    assert find_contamination(docs, items.limit(0)).filter("contaminated").count() == 0
    assert find_contamination(empty(spark), items).count() == 0


def test_an_edited_copy_in_many_documents_is_found(spark):
    item = prose(700, 20).split()
    edited = " ".join("swap" if i in (4, 9, 14) else w for i, w in enumerate(item))
    halves = " ".join(item[:10]) + " other " + " ".join(item[8:])
    rows = [(i, prose(i, 40) + " " + edited + " " + prose(50 + i, 40)) for i in range(25)]
    rows += [(100 + i, " ".join(item[i % 17 : i % 17 + 3]) + " " + prose(200 + i, 30)) for i in range(90)]  # each n-gram is common
    rows += [(300, halves)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item)), (2, prose(701, 25))], "item_id long, text string")
    got = {r.doc_id: r["items"] for r in find_contamination(docs, items).collect() if r.contaminated}
    assert all(got[i] == [1] for i in [*range(25), 300])
    assert got == slow(docs, items)


def test_hits_taken_some_items_at_a_time_give_the_same(monkeypatch):
    items = Items([(i, prose(i % 7, 20 + i % 3)) for i in range(40)], 3)
    own = items.read(" ".join(prose(i, 21) for i in range(9)))
    whole = sorted(items.matches(own, 2, 0.5))
    monkeypatch.setattr(decontaminate, "_HITS", 50)
    assert sorted(items.matches(own, 2, 0.5)) == whole and len({i for i, _ in whole}) == 40


@given(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.lists(st.integers(-1, 5), max_size=15))
def test_no_alignment_scores_over_the_bound(a, b):
    assert slow_align(a, b) <= most(np.isin(np.array(b, dtype=np.int64), a)) + 1e-9


def edited(rand, words, how):
    """Words substituted, inserted or left out, in a regular or random way."""
    out = []
    step = rand.choice([2, 3, 4, 5])
    for i, w in enumerate(words):
        on = i % step == step - 1 if rand.random() < 0.9 else rand.random() < 0.3
        kind = rand.choice(["swap", "add", "drop"]) if how == "mixed" else how
        if on and kind == "swap":
            out.append("swapped")
        elif not (on and kind == "drop"):
            out.append(w)
        if on and kind == "add":
            out.extend(["added"] * rand.choice([1, 1, 2]))
    return out


def test_every_edited_copy_that_scores_is_found():
    """Recall against full alignment is whole for substitutions, insertions and
    deletions, also between every two words."""
    rand = random.Random(3)
    texts = [prose(700 + i, rand.randrange(8, 60)) for i in range(12)]
    items = Items(list(enumerate(texts)), 3)
    scored = 0
    for how in ("swap", "add", "drop", "mixed"):
        for _ in range(60):
            k = rand.randrange(12)
            words = bare_words(texts[k])
            text = " ".join([*prose(rand.randrange(99), 30).split(), *edited(rand, words, how), *prose(rand.randrange(99), 30).split()])
            own = items.read(text)
            want = {(i, align(w, own) / len(w)) for i, w in enumerate(items.words) if align(w, own) >= 0.5 * len(w)}
            assert set(items.matches(own, 2, 0.5)) == want
            scored += len(want)
    assert scored > 120


def test_a_word_after_every_word(spark):
    item = prose(700, 20).split()
    for k in (1, 2):
        text = " ".join(w + (f" extra{i}" if i % k == k - 1 else "") for i, w in enumerate(item))
        found = find_contamination(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(5, " ".join(item))], "item_id long, text string"))
        assert found.first()["items"] == [5]


def test_many_slices_hold_one_worker_a_stage(spark):
    docs, items = corpus(spark)
    plan = find_contamination(docs, items, slice_words=40)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") <= 2  # the node and its type, once
