"""Reply trees: root-to-leaf paths, ranked branches, one conversation a path.

Messages reply to messages of their tree.  Iterative self-joins double the
steps that every message knows of its way up (its ancestor 1, 2, 4, ... steps
above, with the scores in between), so a thread of n messages takes log2(n)
joins on (tree, message), however the messages lie in trees.  A message that
nobody replied to ends a branch; a branch scores the mean of its messages'
scores, and each tree keeps its ``branches`` best (ties: the smaller leaf id;
without any score last).  The kept leaves walk back over the same ancestor
tables from the longest step to the shortest, which lists each message of a
path once, with its place.  Texts are joined to the kept paths only.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` for every turn.  In roles
and texts a backslash is put after every backslash and after the first character
of every control string (``CONTROL``), so none of them is left in a text, and
taking these backslashes out again restores it exactly (``unescaped``).
``turns`` holds, for each turn, the code points where it, its escaped text, and
both end, and whether the text is under the loss mask (role ``loss_role``).

Everything is DataFrame functions.  Intermediate tables are staged.  A formatted
conversation is one string, so its size is bounded by Spark's 2 GB for a value;
everything before it works on single messages.

Cases: a null parent, or one that the tree has not, makes a message a root; a
null tree is a tree, a null message id a message that no reply can name; rows
with the same id are one message with the smallest (parent, score) and (role,
text), nulls first; messages on or below a cycle have no root and are in no
conversation; null roles and texts read as empty; an empty table gives an empty
one; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import staged_with_count
from .common import staged, table

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"

#: Control strings of public chat templates.
CONTROL = (
    START, SEPARATOR, END, "<|endoftext|>", "<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>", "<bos>", "<eos>", "<pad>", "<unk>",
)

_QUOTED = [(re.escape(c[0]), re.escape(c[1:])) for c in CONTROL]
_BREAK = r"\\|" + "|".join(rf"{first}(?={rest})" for first, rest in _QUOTED)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_BREAK), F.lit(r"$0\\"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"\\(\\?)"), F.lit("$1"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _ancestors(links: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(steps, ways): ``steps[i]`` has (t, v, up), the message 2**i above v for
    every v that has one; ``ways`` has (t, v, n, total, scored), the number of
    messages from v to its root and the sum and number of their scores."""
    parents = links.select(F.col("t").alias("pt"), F.col("v").alias("pv"))
    start = links.join(parents, _same("t", "pt") & (F.col("p") == F.col("pv")), "left").select(
        "t", "v", F.col("pv").alias("up"), F.lit(1).cast("long").alias("n"), F.coalesce("s", F.lit(0.0)).alias("total"), F.col("s").isNotNull().cast("long").alias("scored")
    )
    rows, count = staged_with_count(start, "replies")
    done, steps = rows.filter("up IS NULL"), []
    active = rows.filter("up IS NOT NULL")
    while 2 ** len(steps) <= count and not active.isEmpty():
        steps.append(active.select("t", "v", "up"))
        above = active.unionByName(done).select(*[F.col(c).alias(f"a_{c}") for c in ("t", "v", "up", "n", "total", "scored")])
        met = active.join(above, _same("t", "a_t") & (F.col("up") == F.col("a_v")))
        rows = staged(
            met.select("t", "v", F.col("a_up").alias("up"), (F.col("n") + F.col("a_n")).alias("n"), (F.col("total") + F.col("a_total")).alias("total"), (F.col("scored") + F.col("a_scored")).alias("scored")),
            "replies",
        )
        done = done.unionByName(rows.filter("up IS NULL"))
        active = rows.filter("up IS NOT NULL")
    return steps, done.drop("up")


def reply_paths(links: DataFrame, branches: int = 1) -> DataFrame:
    """(t, branch, leaf, branch_score, n_turns, v, position) of the messages on
    the kept paths of ``links`` (t, v, p, s); positions count from 1."""
    links = staged(links.groupBy("t", "v").agg(F.min(F.struct("p", "s")).alias("x")).select("t", "v", "x.p", "x.s"), "links")
    steps, ways = _ancestors(links)
    leaves = ways
    if steps:
        named = steps[0].select(F.col("t").alias("pt"), F.col("up").alias("pv")).distinct()
        leaves = ways.join(named, _same("t", "pt") & (F.col("v") == F.col("pv")), "left_anti")
    score = F.try_divide("total", "scored")
    best = Window.partitionBy("t").orderBy(F.desc_nulls_last("branch_score"), F.asc_nulls_first("v"))
    kept = leaves.withColumn("branch_score", score).withColumn("branch", F.row_number().over(best)).filter(F.col("branch") <= int(branches))
    path = kept.select("t", "branch", F.col("v").alias("leaf"), "branch_score", F.col("n").alias("n_turns"), "v", F.lit(0).cast("long").alias("up_by"))
    for i in range(len(steps) - 1, -1, -1):
        step = steps[i].select(F.col("t").alias("st"), F.col("v").alias("sv"), "up")
        higher = F.struct(F.col("up").alias("v"), (F.col("up_by") + F.lit(2**i)).alias("up_by"))
        both = F.when(F.col("up").isNull(), F.array(F.struct("v", "up_by"))).otherwise(F.array(F.struct("v", "up_by"), higher))
        met = path.join(step, _same("t", "st") & _same("v", "sv"), "left")
        path = met.select("t", "branch", "leaf", "branch_score", "n_turns", F.inline(both))
    return path.withColumn("position", F.col("n_turns") - F.col("up_by")).drop("up_by")


def format_reply_trees(
    messages: DataFrame,
    tree: str = "tree_id",
    message: str = "message_id",
    parent: str = "parent_id",
    role: str = "role",
    text: str = "text",
    score: str | None = "score",
    branches: int = 1,
    loss_role: str = "assistant",
) -> DataFrame:
    """(tree_id, branch, leaf_id, branch_score, n_turns, formatted, turns) for
    the ``branches`` best branches of every tree; ``turns`` is an array of
    (start, text_start, text_end, end, loss)."""
    col = lambda name: F.col(f"`{name}`")
    points = F.lit(None).cast("double") if score is None else col(score).cast("double")
    path = reply_paths(messages.select(col(tree).alias("t"), col(message).alias("v"), col(parent).alias("p"), points.alias("s")), branches)
    empty = F.lit("")
    said = messages.select(
        col(tree).alias("mt"), col(message).alias("mv"), F.coalesce(col(role), empty).alias("r"), F.coalesce(col(text), empty).alias("x")
    )
    rows = path.join(said, _same("t", "mt") & _same("v", "mv")).drop("mt", "mv", "v")
    rows = rows.repartition(F.col("t"), F.col("branch"))
    group = Window.partitionBy("t", "branch")
    copy = F.lag("position").over(group.orderBy("position", "r", "x"))
    rows = rows.withColumn("copy", copy).filter("copy IS NULL OR copy <> position")
    rows = rows.withColumns({"x": escaped(F.col("x")), "loss": F.col("r") == F.lit(loss_role)})
    rows = rows.withColumn("piece", F.concat(F.lit(START), escaped(F.col("r")), F.lit(SEPARATOR), F.col("x"), F.lit(END)))
    size, mark = F.length("piece").cast("long"), F.lit(len(END))
    rows = rows.withColumn("end", F.sum(size).over(group.orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    place = F.struct(
        (F.col("end") - size).alias("start"),
        (F.col("end") - mark - F.length("x")).alias("text_start"),
        (F.col("end") - mark).alias("text_end"),
        "end",
        "loss",
    )
    whole = rows.groupBy("t", "branch").agg(
        F.first("leaf").alias("leaf_id"),
        F.first("branch_score").alias("branch_score"),
        F.first("n_turns").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("position", "piece", place.alias("place")))).alias("pieces"),
    )
    return whole.select(
        F.col("t").alias("tree_id"),
        "branch",
        "leaf_id",
        "branch_score",
        "n_turns",
        F.array_join(F.col("pieces.piece"), "").alias("formatted"),
        F.col("pieces.place").alias("turns"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with what its text says: ``said``, an array of (role, text)
    per turn, and ``learnt``, the texts under the loss mask, one after another."""
    pieces = F.slice(F.split("formatted", re.escape(END)), F.lit(1), F.size("turns"))
    inner = lambda piece: F.split(F.substring(piece, len(START) + 1, 2**31 - 1), re.escape(SEPARATOR), 2)
    turn = lambda two: F.struct(unescaped(two[0]).alias("role"), unescaped(two[1]).alias("text"))
    under = lambda piece, at: F.when(
        at["loss"], unescaped(piece.substr((at["text_start"] - at["start"] + 1).cast("int"), (at["text_end"] - at["text_start"]).cast("int")))
    ).otherwise(F.lit(""))
    return formatted.withColumns(
        {
            "said": F.transform(F.transform(pieces, inner), turn),
            "learnt": F.array_join(F.zip_with(pieces, "turns", under), ""),
        }
    )


def linear_replies(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns of conversations as replies to the turn before (tree_id,
    message_id, parent_id, role, text); equal turns by role and text, nulls
    first."""
    order = Window.partitionBy("tree_id").orderBy("turn", "role", "text")
    rows = turns.select(*[F.col(f"`{c}`").alias(name) for c, name in ((conversation, "tree_id"), (turn, "turn"), (role, "role"), (text, "text"))])
    rows = rows.withColumn("message_id", F.row_number().over(order).cast("long"))
    return rows.select("tree_id", "message_id", F.nullif(F.col("message_id") - 1, F.lit(0)).alias("parent_id"), "role", "text")


def op12_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and what is read back from the output."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    messages = staged(linear_replies(given.unionByName(own)), "turns")
    out = read_back(staged(format_reply_trees(messages, score=None), "formatted"))
    told = F.transform("said", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return out.select(
        F.col("tree_id").alias("conv_id"),
        F.size("said").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _oracle() -> str:
    """DuckDB: the same from the table itself; the formatted length by counting
    what escaping adds."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    added = lambda c: " + ".join(
        [f"(length({c}) - length(replace({c}, '\\', '')))", *(f"((length({c}) - length(replace({c}, {quote(s)}, ''))) // {len(s)})" for s in CONTROL)]
    )
    marks = len(START) + len(SEPARATOR) + len(END)
    return rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS said,
    coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) FILTER (WHERE r = 'assistant'), '') AS learnt,
    CAST(sum({marks} + length(r) + length(x) + {added('r')} + {added('x')}) AS BIGINT) AS formatted_chars
  FROM given GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256, formatted_chars FROM whole
"""


ORACLE_SQL = _oracle()
