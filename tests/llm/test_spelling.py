import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from flowlens.llm import spelling
from flowlens.llm.spelling import near_pairs, one_letter_short, op13_spelling_variants, spelling_variants, word_counts

from .data import awkward, empty


def lower(run):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in run)


def counted(rows, every=None):
    """Runs counted one by one, with the query's missing letters."""
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return out


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(counts, ratio=2):
    near = {w: {v for v in counts if one_edit(w, v)} for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, n, len(near[w]), form[w], counts[form[w]] if form[w] is not None else None, root(w)) for w, n in counts.items()}


def table_of(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def result(df):
    return {tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()}


@pytest.mark.parametrize("letters", ["ab", "aeimqu", "abcdefghijklmnopqrstuvwxyzéüñ", "aé漢🙂"])
def test_equals_comparing_every_two_words(spark, letters):
    """Few letters (one or two symbols: everything collides), many, and code
    points beyond Latin-1."""
    rand = random.Random(len(letters))
    words = {"".join(rand.choice(letters) for _ in range(rand.randrange(0, 8))) for _ in range(150)}
    counts = {w: rand.choice([1, 1, 2, 3, 5, 8, 40]) for w in words}
    assert result(spelling_variants(table_of(spark, counts))) == expected(counts)


def test_a_full_bit_map_loses_nothing(spark, monkeypatch):
    rand = random.Random(3)
    counts = {"".join(rand.choice("aeiou") for _ in range(rand.randrange(3, 7))): rand.randrange(1, 30) for _ in range(200)}
    want = expected(counts)
    monkeypatch.setattr(spelling, "BITS", 7)
    assert result(spelling_variants(table_of(spark, counts))) == want


def test_every_insertion_deletion_and_replacement_is_near(spark):
    word = "aaabcdee"
    around = {word[:i] + c + word[i:] for i in range(9) for c in "abz"} | {word[:i] + word[i + 1 :] for i in range(8)}
    around |= {word[:i] + c + word[i + 1 :] for i in range(8) for c in "aeyz"}
    around.discard(word)
    counts = {word: 100, **{w: 1 for w in around}}
    pairs = near_pairs(table_of(spark, counts)).filter("word = 'aaabcdee'").collect()
    assert {r.near for r in pairs} == around and len(pairs) == len(around)


def test_very_long_words(spark):
    long = "".join(random.Random(1).choice("abcdefgh") for _ in range(50_000))
    counts = {long: 9, long[:25_000] + long[25_001:]: 4, long[:-1] + "z": 2, long + "y": 1, "x" * 50_000: 3, "x" * 49_999: 7}
    got = {r.word: (r.n_near, r.form_n, r.root) for r in spelling_variants(table_of(spark, counts)).collect()}
    assert got[long] == (3, None, long) and got[long[:-1] + "z"][1:] == (9, long)
    assert got["x" * 50_000] == (1, 7, "x" * 49_999)


def test_nothing_that_grows_with_the_vocabulary_is_broadcast(spark, monkeypatch):
    """Tables this small fit any threshold: only a hint keeps them apart."""
    plans, kept = [], {"staged": spelling.staged, "staged_with_count": spelling.staged_with_count}

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    for name, function in kept.items():
        monkeypatch.setattr(spelling, name, lambda df, to, function=function: function(noted(df), to))
    counts = {"a" * k: 2**k for k in range(1, 9)}
    variants = spelling_variants(table_of(spark, counts))
    assert result(variants) == expected(counts)
    noted(variants)
    assert sum(p.count("SortMergeJoin") for p in plans) >= 5
    assert not any("Broadcast" in p for p in plans)


def test_chains_lead_to_their_end(spark):
    counts = {"a" * k: 2**k for k in range(1, 40)}
    got = {r.word: r.root for r in spelling_variants(table_of(spark, counts)).collect()}
    assert set(got.values()) == {"a" * 39}


def test_counts_with_and_without_missing_letters(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for every in (None, 7):
        change = one_letter_short(every) if every else None
        got = {r.word: r.n for r in word_counts(docs, change=change).collect()}
        assert got == dict(counted(rows, every))
    assert word_counts(empty(spark)).count() == 0


def test_counts_across_chunks_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_CHUNK", 50)
    monkeypatch.setattr(spelling, "_HELD_WORDS", 20)
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert {r.word: r.n for r in word_counts(docs).collect()} == dict(counted(rows))


def test_awkward_tables(spark):
    rows = [("word", 4), ("word", 5), (None, 3), ("", 2), ("a", 1), ("wordy", 3)]
    words = spark.createDataFrame([(w, n, "x", 1.0) for w, n in rows], "word string, n long, form string, key double")
    assert result(spelling_variants(words)) == {("word", 9, 1, None, None, "word"), ("wordy", 3, 1, "word", 9, "word"), ("", 2, 1, None, None, ""), ("a", 1, 1, "", 2, "")}
    assert spelling_variants(words.limit(0)).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    rand = random.Random(8)
    stems = ["gardens", "garden", "gardeners", "hard", "ñandúes", "straße", "Window"]
    docs = [(i, " ".join(rand.choice(stems) + rand.choice(["", "", "s", "-", "1"]) for _ in range(60))) for i in range(40)]
    spark.createDataFrame([*docs, (None, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = {w: n for w, n in counted(docs, 97).items() if len(w) >= 5 and n >= 3}
    got = result(op13_spelling_variants(spark, str(tmp_path)))
    assert got == expected(counts) and any(r[3] for r in got)
