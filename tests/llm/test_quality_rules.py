import duckdb
from flowlens.llm.quality_rules import ORACLE_SQL, WINDOW, distance, judge_quality, repeated_words

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from .data import awkward, empty, prose


@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
def test_repeated_words_against_brute_force(words):
    windows = [tuple(words[i : i + WINDOW]) for i in range(len(words) - WINDOW + 1)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(WINDOW)}
    assert repeated_words(words) == len(covered)


def test_distance_bounds():
    assert distance(np.array([1.0, 0]), np.array([5.0, 0])) == 0
    assert abs(distance(np.array([1.0, 0]), np.array([0, 2.0])) - 1) < 1e-12


def test_matches_sql_on_awkward_rows(spark):
    docs = awkward(spark, "kept string, n_words int", ("k", 1))
    got = judge_quality(docs)
    assert got.columns[-9:] == ["_n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "_kept"]
    one = judge_quality(docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))
    documents = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).toPandas()  # noqa: F841
    cols = ["doc_id", "_n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "_kept"]
    assert sorted(tuple(r[c] for c in cols) for r in one.collect()) == sorted(duckdb.sql(ORACLE_SQL).fetchall())
    assert got.count() == docs.count()


def test_junk_goes_and_prose_stays(spark):
    clean = [(i, prose(i, 600), "en") for i in range(60)]
    junk = [(100, prose(100, 200).upper().replace(" ", "!! "), "en"), (101, prose(101, 200).replace(" ", "### "), "en")]
    out = {r.doc_id: r.kept for r in judge_quality(spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")).collect()}
    assert all(out[i] for i in range(60)) and not out[100] and not out[101]


def test_a_language_without_a_reference_is_judged_by_the_others(spark):
    """Junk gets the same verdict under any tag, and so does clean prose."""
    words = " ".join(f"ord{i % 97}" for i in range(90))
    signs = prose(101, 200).replace(" ", "### ")
    rows = [(i, prose(i, 600), "en") for i in range(60)] + [(200 + i, prose(900 + i, 600).replace("a", "ö"), "de") for i in range(60)]
    for at, tag in ((100, "en"), (110, "xx"), (120, None)):
        rows += [(at, words, tag), (at + 1, signs, tag), (at + 2, prose(500, 400), tag)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in judge_quality(docs, lang_share=100).collect()}
    for at in (100, 110, 120):
        assert [got[at + k].kept for k in range(3)] == [False, False, True]
    assert got[112].word_distance == got[102].word_distance and got[122].char_distance is not None


def test_small_languages_equal_sql(spark):
    rows = [(i, prose(i, 900), "en") for i in range(60)] + [(100 + i, prose(500 + i, 900).replace("a", "ö"), "de") for i in range(60)]
    rows += [(200, prose(700, 60), "xx"), (201, prose(701, 60).upper(), None), (202, "### " * 30, "yy"), (203, prose(703, 70).replace("a", "ö"), "zz"), (204, None, "qq")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = sorted(tuple(r) for r in judge_quality(documents).select(*cols).collect())
    documents = documents.toPandas()  # noqa: F841
    assert got == sorted(duckdb.sql(ORACLE_SQL).fetchall())


def test_min_length_guards(spark):
    rows = [(i, prose(i, 200), "en") for i in range(30)] + [(50, " ".join(["QX"] * 21), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    # too short for either distance: only the base rule on repeats decides
    got = {r.doc_id: (r.base_failed, r.kept) for r in judge_quality(docs, max_repeated=100).collect()}
    assert got[50] == (False, True)


def test_empty_table(spark):
    assert judge_quality(empty(spark)).count() == 0
