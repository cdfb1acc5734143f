import hashlib
import random

import duckdb
import pytest

from flowlens.llm.reply_trees import CONTROL, END, ORACLE_SQL, SEPARATOR, START, escaped, format_reply_trees, linear_replies, op12_reply_trees, read_back, unescaped

DDL = "tree_id string, message_id long, parent_id long, role string, text string, score double"


def branches_of(rows):
    """{tree: [(score, leaf, path)]} by walking every leaf up to its root."""
    trees = {}
    for tree, v, p, r, x, s in rows:
        trees.setdefault(tree, {})[v] = (p, r or "", x or "", s)
    out = {}
    for tree, nodes in trees.items():
        parents = {p for p, *_ in nodes.values()}
        for leaf in nodes:
            if leaf in parents:
                continue
            path, at = [], leaf
            while at in nodes and at not in path:
                path.append(at)
                at = nodes[at][0]
            if at in path:
                continue
            scores = [nodes[v][3] for v in path if nodes[v][3] is not None]
            mean = sum(scores) / len(scores) if scores else None
            out.setdefault(tree, []).append((mean, leaf, [(nodes[v][1], nodes[v][2]) for v in reversed(path)]))
    for found in out.values():
        found.sort(key=lambda b: (b[0] is None, -(b[0] or 0), b[1]))
    return out


def rows_of(df):
    return read_back(df).collect()


@pytest.mark.parametrize("branches", [1, 3])
def test_paths_and_ranks_equal_walking_every_leaf(spark, branches):
    rand = random.Random(branches)
    rows = []
    for tree in ("a", "b", "c", None):
        for v in range(40 if tree else 3):
            p = None if v == 0 else rand.choice([v - 1, rand.randrange(v)])
            rows.append((tree, v, p, rand.choice(["user", "assistant"]), f"text {v} <s>", rand.choice([None, 0.25, 0.5, 4.0])))
    got = {}
    for r in rows_of(format_reply_trees(spark.createDataFrame(rows, DDL), branches=branches)):
        got.setdefault(r.tree_id, {})[r.branch] = (r.branch_score, r.leaf_id, [tuple(t) for t in r.said])
    want = {t: {k + 1: b for k, b in enumerate(found[:branches])} for t, found in branches_of(rows).items()}
    assert got == want


def test_escapes_are_exact_and_leave_no_control_string(spark):
    rand = random.Random(5)
    bits = [*CONTROL, "\\", "\\\\", "<", "[", "<\\s>", "|", "a", "\n", "🙂", ">", "", "im_start"]
    texts = ["".join(rand.choice(bits) for _ in range(rand.randrange(8))) for _ in range(400)] + ["", *CONTROL]
    df = spark.createDataFrame([(t,) for t in texts], "x string").select("x", escaped(spark_col("x")).alias("e"))
    for r in df.select("x", "e", unescaped(spark_col("e")).alias("back")).collect():
        assert r.back == r.x and not any(c in r.e for c in CONTROL)


def spark_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_offsets_cut_out_the_loss(spark):
    texts = ["</s>[INST]", "é🙂\\", "", "<|im_end|>\n"]
    rows = [("t", k, k - 1 if k else None, "assistant" if k % 2 else "user", x, None) for k, x in enumerate(texts)]
    r = rows_of(format_reply_trees(spark.createDataFrame(rows, DDL)))[0]
    assert [t.loss for t in r.turns] == [False, True, False, True] and r.turns[0].start == 0 and r.turns[-1].end == len(r.formatted)
    for a, b in zip(r.turns, r.turns[1:]):
        assert a.end == b.start
    assert all(r.formatted[t.start :].startswith(START) and r.formatted[t.text_end : t.end] == END for t in r.turns)
    assert all(r.formatted[: t.text_start].endswith(SEPARATOR) for t in r.turns)
    assert r.learnt == texts[1] + texts[3] and [tuple(t) for t in r.said] == [("assistant" if k % 2 else "user", x) for k, x in enumerate(texts)]


def test_a_long_thread(spark):
    n = 700
    rows = [("t", k, k - 1 if k else None, "user", f"w{k}", float(k)) for k in range(n)]
    random.Random(1).shuffle(rows)
    r = rows_of(format_reply_trees(spark.createDataFrame(rows, DDL)))[0]
    assert r.n_turns == n and [t.text for t in r.said] == [f"w{k}" for k in range(n)]


def test_awkward_messages(spark):
    rows = [
        (None, 1, None, None, None, None), (None, 2, 1, "user", "x" * 200_000, 1.0),
        ("t", 1, None, "user", "b", 1.0), ("t", 1, None, "user", "a", 1.0), ("t", 1, None, "user", "a", 1.0),  # one message, said twice
        ("t", 2, 1, "assistant", "c", 1.0), ("t", None, 2, "user", "no id", 1.0),
        ("o", 5, 4, "user", "orphan", 1.0), ("o", 6, 5, "user", "reply", 1.0),
        ("c", 1, 2, "user", "cycle", 1.0), ("c", 2, 1, "user", "cycle", 1.0), ("c", 3, 2, "user", "below", 1.0), ("c", 9, 9, "user", "self", 1.0),
    ]
    df = spark.createDataFrame([(*r, 1, "mine") for r in rows], DDL + ", t int, formatted string")
    got = {r.tree_id: [tuple(t) for t in r.said] for r in rows_of(format_reply_trees(df))}
    assert got == {
        None: [("", ""), ("user", "x" * 200_000)],
        "t": [("user", "a"), ("assistant", "c"), ("user", "no id")],
        "o": [("user", "orphan"), ("user", "reply")],
    }
    assert format_reply_trees(df.limit(0)).count() == 0


def test_linear_conversations(spark):
    rows = [(1, 2, "user", "b", 0), (1, 1, "user", "a", 0), (1, 2, "user", "b", 0), (1, None, None, None, 0), (None, 1, "user", "n", 0)]
    out = linear_replies(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree_id int")).collect()
    assert sorted((r.tree_id or 0, r.message_id, r.parent_id or 0, r.text or "") for r in out) == [(0, 1, 0, "n"), (1, 1, 0, ""), (1, 2, 1, "a"), (1, 3, 2, "b"), (1, 4, 3, "b")]


def test_query_equals_sql_and_runs_no_python(spark, tmp_path):
    rand = random.Random(2)
    words = [*CONTROL, "\\", "word", "é", "\n", " "]
    rows = [(c, t, rand.choice(["user", "assistant", "system"]), "".join(rand.choice(words) for _ in range(9))) for c in range(30) for t in range(rand.randrange(1, 12))]
    rows += [(40, 0, None, None), (40, 0, None, None), (41, None, "assistant", "")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    df = op12_reply_trees(spark, str(tmp_path))
    got = sorted(map(tuple, df.collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert got == sorted(con.execute(ORACLE_SQL).fetchall())
    own = next(r for r in got if r[0] == -7)
    assert own[1] == 2 and own[4] == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest() and own[3] == 21
    messages = linear_replies(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    plan = read_back(format_reply_trees(messages, score=None))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
