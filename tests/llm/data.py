"""Small documents with every awkward case, shared by the tests."""

import random

WORDS = [a + b + c for a in ("ka", "lo", "mi", "tu", "re") for b in ("na", "se", "do", "pi") for c in ("x", "r", "n", "l", "")]


def prose(seed: int, n: int) -> str:
    rand = random.Random(seed)
    out = []
    for i in range(n):
        out.append(rand.choice(WORDS))
        if i % 17 == 16:
            out[-1] += "."
    return " ".join(out)


def awkward(spark, extra: str = "", values: tuple = ()):
    """doc_id, text, lang, source and extra columns (a DDL string and their
    values): nulls, empty and very long texts, ties, repeated rows."""
    shared = "\n".join(["This line is shared by very many documents.", "  THIS line is Shared by very many documents.\t"])
    long = "\n".join(prose(5000 + s, 400) for s in range(60))
    rows = [
        (1, "alpha beta\n" + shared, "en", "a"),
        (2, shared + "\n" + prose(2, 90), "en", None),
        (3, prose(3, 120) + "\n" + shared, "de", "a"),
        (3, prose(3, 120) + "\n" + shared, "de", "a"),
        (4, None, "en", "a"),
        (5, "", "en", "a"),
        (6, "\n\n", None, "a"),
        (7, long, "en", "a"),
        (8, long, "en", "a"),
        (None, "one text without an id\n" + shared, "en", "a"),
        (None, None, None, None),
        (9, " \t\x0b\x0c\r ", "en", "a"),
        (10, "x" * 50_000, "en", "a"),
        (11, "the " * 3000, "en", "a"),
        (12, "naïve Straße ﬁn İstanbul 🙂 " + prose(12, 80), "fr", "a"),
        (-5, prose(2, 90), "en", "a"),
    ]
    ddl = "doc_id long, text string, lang string, source string" + (f", {extra}" if extra else "")
    return spark.createDataFrame([(*r, *values) for r in rows], ddl)


def empty(spark, ddl: str = "doc_id long, text string, lang string, source string"):
    return spark.createDataFrame([], ddl)
