import random

import duckdb
import numpy as np
import pytest

from flowlens.llm import lexical_search as ls
from flowlens.llm.lexical_search import ORACLE_SQL, Items, Tree, op11_lexical_search, rank_documents, search

from .data import awkward, empty, prose


def sql(documents, benchmark):
    con = duckdb.connect()
    con.register("documents", documents.select("doc_id", "text").toArrow())
    con.register("benchmark", benchmark.select("item_id", "text").toArrow())
    return sorted(con.execute(ORACLE_SQL).fetchall(), key=repr)


def result(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def items_of(spark, extra=()):
    rows = [(1, prose(3, 20)), (2, "The THE the naïve"), (3, prose(5001, 45)), (4, None), (5, ""), (6, "..!"), (7, "notfound"), (None, prose(2, 9)), *extra]
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, doc_id string")


def random_vectors(rand, n, width, top, nnz):
    row, term, value = [], [], []
    for r in range(n):
        for t in rand.choice(width, rand.integers(1, nnz), replace=False):
            row.append(r), term.append(t), value.append(rand.integers(1, top))
    return tuple(np.array(x, np.int64) for x in (row, term, value))


@pytest.mark.parametrize("top", [50, 10**9])
def test_every_pair_that_reaches_its_kth_score_is_found(top):
    """Against the full product, with weights whose sums leave doubles too."""
    rand = np.random.default_rng(top % 97)
    n_items, n_docs, width = 45, 300, 60
    counts = [{int(t): int(rand.integers(1, 4)) for t in rand.choice(width, rand.integers(1, 9), replace=False)} for _ in range(n_items)]
    weight = rand.integers(1, top, width)
    items = Items(list(range(n_items)), counts, weight, rand.integers(1, 100, width))
    assert items.by_term[0][3] == (top == 50)
    row, term, value = random_vectors(rand, n_docs, width, 10**6, 12)
    full = np.zeros((n_items, n_docs), dtype=object)
    for k, i in enumerate(items.ids):
        q = {t: n * int(weight[t]) for t, n in counts[i].items()}
        for r, t, v in zip(row, term, value):
            full[k, r] += q.get(int(t), 0) * int(v)
    kth = np.array([sorted(full[k])[-5] for k in range(n_items)], np.int64)
    i, d, score = search(items, Tree(row, term, value, n_docs, width), kth)
    want = {(k, r): full[k, r] for k in range(n_items) for r in range(n_docs) if full[k, r] >= max(kth[k], 1)}
    assert {(int(a), int(b)): int(s) for a, b, s in zip(i, d, score)} == want


def test_bounds_prune_whole_nodes(monkeypatch):
    """Only the neighbourhood of good documents is scored one by one."""
    rand = np.random.default_rng(1)
    parts = [random_vectors(rand, 256, 40, 100, 8) for _ in range(4)]
    row, term, value = (np.concatenate(x) for x in zip(*[(r + 256 * k, t + 40 * k, v) for k, (r, t, v) in enumerate(parts)]))
    value = np.where(row % 256 < 32, 100 * value, value)
    counts = [{int(t) + 40 * (i // 16): 1 for t in rand.choice(40, 6, replace=False)} for i in range(64)]
    items = Items(list(range(64)), counts, np.ones(160, np.int64), np.arange(160) + 1)
    full = np.zeros((64, 1024), np.int64)
    for k, i in enumerate(items.ids):
        on = np.isin(term, list(counts[i]))
        np.add.at(full[k], row[on], value[on])
    kth = np.sort(full, axis=1)[:, -3]
    scored = []
    whole = Items.bounds

    def counted(self, docs, doc_level, level, nodes):
        if doc_level == level == 0:
            scored.append(len(nodes))
        return whole(self, docs, doc_level, level, nodes)

    monkeypatch.setattr(Items, "bounds", counted)
    i, d, score = search(items, Tree(row, term, value, 1024, 160), kth)
    assert set(zip(i, d)) == set(zip(*np.nonzero(full >= kth[:, None]))) and sum(scored) <= 256


def test_awkward_tables_equal_sql(spark):
    docs = awkward(spark, "item_id int, rank string, score double, text_ string", (1, "r", 2.0, "t"))
    ties = spark.createDataFrame([(100 + k, "naïve " + prose(3, 20)) for k in range(30)], "doc_id long, text string")
    docs = docs.unionByName(ties, allowMissingColumns=True)
    items = items_of(spark)
    got = result(rank_documents(docs, items))
    assert got == sql(docs, items) and len(got) > 60


def test_repeated_items(spark):
    items = items_of(spark, [(1, prose(3, 20)), (1, prose(12, 20))])
    docs = awkward(spark)
    assert result(rank_documents(docs, items)) == sql(docs, items)


def test_empty_tables(spark):
    assert rank_documents(empty(spark), items_of(spark)).count() == 0
    assert rank_documents(awkward(spark), items_of(spark).limit(0)).count() == 0


def test_slices_blocks_and_seeds_do_not_matter(spark, monkeypatch):
    rand = random.Random(4)
    docs = spark.createDataFrame([(i, prose(rand.randrange(400), rand.randrange(1, 60))) for i in range(600)], "doc_id long, text string")
    items = spark.createDataFrame([(i, prose(i, 25)) for i in range(40)], "item_id long, text string")
    want = sql(docs, items)
    assert result(rank_documents(docs, items)) == want
    assert result(rank_documents(docs, items, slice_bytes=2_000)) == want
    for name, value in (("BLOCK", 7), ("SEED", 2), ("_CELLS", 50), ("_CHUNK", 16), ("_BLOCK_ENTRIES", 40)):
        monkeypatch.setattr(ls, name, value)
    assert result(rank_documents(docs, items)) == want


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    assert result(op11_lexical_search(spark, sf)) == sql(docs, items)
