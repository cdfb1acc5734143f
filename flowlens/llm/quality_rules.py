"""Quality rules: distribution divergence from language references.

Per language (the ``lang`` column) the whole corpus gives two references: the
histogram of character classes, and that of its common words.  A word is
common if it makes up ``1 / common_share`` of the language's words or more, so
a language has at most ``common_share`` of them; the rest is one bin.  A
language has references if it holds ``1 / lang_share`` of all words or more (so
at most ``lang_share`` languages do).  Documents of the others (rare, mistyped
or missing tags) are judged too: each distance is the smallest to any
language's reference, so clean text under a wrong tag stays and junk goes.
Both bounds are arithmetic, so the references can be collected whatever the
corpus' size.

A document is rejected if the Jensen-Shannon distance (base 2, 0 to 1) of its
character classes to the reference is over ``max_char_distance``, or that of
its words over ``word_distance + word_noise / sqrt(n_words)``: the sampling
noise of a histogram shrinks with the root of its length.  Guards: the first
test needs ``min_chars`` characters, the second ``min_words`` words.

Base rules come first: under ``base_words`` words, or over 30 % of the words in
repeated 8-word windows.

Cases: null text has no words and fails the base rules; null ``lang`` is a
language of its own; repeated rows are judged alike; empty tables give empty
results; input columns stay, result columns get underscores in front where
their names are taken.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import encoded, free_name, staged, table, texts, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 8
STOPS = ".,;:!?'\"()-"
SYMBOLS = "#*$%&|<>"
N_CLASSES = 9
_FLUSH = 200_000


def char_class(code: int) -> int:
    """0 lower, 1 upper, 2 other letter, 3 number, 4 space, 5 stop, 6 other
    punctuation, 7 symbol, 8 the rest."""
    ch = chr(code)
    if ch in " \t\n\x0b\x0c\r":
        return 4
    if ch in STOPS:
        return 5
    kind = unicodedata.category(ch)
    if kind == "Ll":
        return 0
    if kind == "Lu":
        return 1
    return {"L": 2, "N": 3, "P": 6, "S": 7}.get(kind[0], 8)


def _class_table() -> np.ndarray:
    return np.array([char_class(i) for i in range(0x110000)], dtype=np.uint8)


def char_classes(text: str) -> np.ndarray:
    """Counts of a text's characters by class."""
    classes = worker_cache("character classes", _class_table)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.bincount(classes[codes], minlength=N_CLASSES)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of 8 words found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    rank = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    if len(numbers) == len(words):
        return 0
    for step in (1, 2, 4):  # ranks of the windows of 2, 4, 8 words
        pair = rank[:-step] * (len(words) + 1) + rank[step:]
        _, rank, counts = np.unique(pair, return_inverse=True, return_counts=True)
        if step < 4 and len(counts) == len(rank):
            return 0
    starts = np.flatnonzero(counts[rank] > 1)
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + WINDOW, -1)
    return int((np.cumsum(marks) > 0).sum())


def base_features(text: str | None, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    chars = len(text) - sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(words), chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(words)


def distance(counts: np.ndarray, reference: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two histograms of counts."""
    p, q = counts / counts.sum(), reference / reference.sum()
    m = (p + q) / 2
    part = lambda a: float((a[a > 0] * np.log2(a[a > 0] / m[a > 0])).sum())
    return math.sqrt(max(0.0, (part(p) + part(q)) / 2))


class References:
    """Per language: character classes and the counts of common words; the
    last word bin holds the rest."""

    def __init__(self, rows: list):
        self.chars: dict[str, np.ndarray] = {}
        self.bins: dict[str, dict[bytes, int]] = {}
        self.words: dict[str, np.ndarray] = {}
        for lang in sorted({r.lang for r in rows}):
            own = [r for r in rows if r.lang == lang]
            self.chars[lang] = np.zeros(N_CLASSES)
            for r in own:
                if r.kind == 0:
                    self.chars[lang][int(r.token)] = r.n
            common = sorted((bytes(r.token), r.n) for r in own if r.kind == 1)
            total = sum(r.n for r in own if r.kind == 2)
            self.bins[lang] = {w: i for i, (w, _) in enumerate(common)}
            self.words[lang] = np.array([n for _, n in common] + [total - sum(n for _, n in common)], dtype=float)

    def distances(self, lang: str | None, text: str, words: list[bytes]) -> tuple[float, float] | tuple[None, None]:
        lang = f"={lang}" if lang is not None else ""
        if not self.chars:
            return None, None
        held: Counter = Counter()
        for word, n in Counter(words).items():
            held[word.lower()] += n
        classes = char_classes(text)
        found = [self._to(own, classes, held) for own in ([lang] if lang in self.chars else self.chars)]
        return min(c for c, _ in found), min(w for _, w in found)

    def _to(self, lang: str, classes: np.ndarray, held: Counter) -> tuple[float, float]:
        bins, counts = self.bins[lang], np.zeros(len(self.words[lang]))
        for word, n in held.items():
            counts[bins.get(word, len(counts) - 1)] += n
        return distance(classes, self.chars[lang]), distance(counts, self.words[lang])


def language_references(docs: DataFrame, text: str, lang: str, common_share: int, lang_share: int) -> References:
    """Counts over all documents; languages are keyed ``=name``, null as an
    empty string."""

    def run(batches):
        held: Counter = Counter()

        def rows():
            out = list(held.items())
            held.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k, _ in out], pa.string()),
                    pa.array([k[1] for k, _ in out], pa.int32()),
                    pa.array([k[2] for k, _ in out], pa.binary()),
                    pa.array([n for _, n in out], pa.int64()),
                ],
                ["lang", "kind", "token", "n"],
            )

        for batch in batches:
            for t, of in zip(texts(batch.column(0)), texts(batch.column(1))):
                if not t:
                    continue
                of = "" if of is None else f"={of}"
                words = encoded(t).lower().split()
                for w, n in Counter(words).items():
                    held[of, 1, w] += n
                held[of, 2, b""] += len(words)
                for i, n in enumerate(char_classes(t).tolist()):
                    if n:
                        held[of, 0, b"%d" % i] += n
                if len(held) > _FLUSH:
                    yield rows()
        yield rows()

    counts = docs.select(F.col(text), F.col(lang).cast("string")).mapInArrow(run, "lang string, kind int, token binary, n long")
    counts = staged(counts.groupBy("lang", "kind", "token").agg(F.sum("n").alias("n")), "lang-counts")
    totals = counts.filter("kind = 2").groupBy("lang").agg(F.sum("n").alias("total"))
    words = counts.filter("kind = 2").agg(F.sum("n")).first()[0] or 0
    own = {r.lang: r.total for r in totals.filter(F.col("total") * lang_share >= words).collect()}
    if not own:
        return References([])
    least = F.create_map(*[F.lit(x) for k, n in own.items() for x in (k, n)])[F.col("lang")]
    kept = counts.filter(F.col("lang").isin(*own)).filter((F.col("kind") != 1) | (F.col("n") * common_share >= least))
    return References(kept.collect())


def judge_quality(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    base_words: int = 20,
    max_repeated: int = 30,
    max_char_distance: float = 0.27,
    min_chars: int = 200,
    word_distance: float = 0.28,
    word_noise: float = 1.4,
    min_words: int = 50,
    common_share: int = 1000,
    lang_share: int = 1000,
) -> DataFrame:
    """``docs`` with the base features, base_failed, char_distance,
    word_distance (null where there are no words) and kept."""
    references = language_references(docs, text, lang, common_share, lang_share)
    wanted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"]
    names = [free_name(docs.columns, n) for n in wanted]
    kinds = ["long"] * 5 + ["boolean", "double", "double", "boolean"]
    at, of = docs.columns.index(text), docs.columns.index(lang)

    def run(batches):
        for batch in batches:
            out = []
            for t, l in zip(texts(batch.column(at)), texts(batch.column(of))):
                words = encoded(t).split()
                base = base_features(t, words)
                failed = base[0] < base_words or 100 * base[4] > max_repeated * base[0]
                by_char = by_word = None
                kept = not failed
                if words:
                    by_char, by_word = references.distances(None if l is None else str(l), t, words)
                if by_char is not None:
                    if len(t) >= min_chars and by_char > max_char_distance:
                        kept = False
                    if len(words) >= min_words and by_word > word_distance + word_noise / math.sqrt(len(words)):
                        kept = False
                out.append((*base, failed, by_char, by_word, kept))
            types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            new = [pa.array([x[i] for x in out], k) for i, k in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *names])

    schema = docs.withColumns({n: F.lit(None).cast(k) for n, k in zip(names, kinds)}).schema
    return docs.mapInArrow(run, schema)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge_quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce('=' || lang, '') AS lang FROM documents),
w AS (
  SELECT doc_id, lang, u.word, u.pos FROM (
    SELECT doc_id, lang, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d) s,
    LATERAL (SELECT unnest(ws) AS word, generate_subscripts(ws, 1) AS pos) u),
nw AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY doc_id),
grams AS (
  SELECT doc_id, pos, count(*) OVER v AS n, list(word) OVER v AS g FROM w
  WINDOW v AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
twice AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, g) AS k FROM grams WHERE n = 8) WHERE k > 1),
rep AS (SELECT doc_id, count(DISTINCT pos + o) AS n FROM twice, range(8) r(o) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT d.doc_id, d.lang, d.text, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words,
    coalesce(n_words, 0) < 20 OR 100 * coalesce(rep.n, 0) > 30 * coalesce(n_words, 0) AS base_failed
  FROM d LEFT JOIN nw USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)),
lw AS (
  SELECT doc_id, lang, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word, count(*) AS c
  FROM w GROUP BY ALL),
total AS (SELECT lang, sum(c) AS n FROM lw GROUP BY lang),
big AS (SELECT lang FROM total WHERE n * 1000 >= (SELECT sum(n) FROM total)),
m AS (SELECT lang, lang AS ref FROM big UNION ALL SELECT t.lang, b.lang FROM total t, big b WHERE t.lang NOT IN (SELECT lang FROM big)),
k0 AS (
  SELECT doc_id, lang, length(text) AS n_chars, length(regexp_replace(text, '[^\p{Ll}]', '', 'g')) AS c0,
    length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS c1, length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters,
    length(regexp_replace(text, '[^\p{N}]', '', 'g')) AS c3, length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')) AS c4,
    length(regexp_replace(text, '[^.,;:!?''"()\-]', '', 'g')) AS c5,
    length(regexp_replace(text, '[^\p{P}]', '', 'g')) AS p, length(regexp_replace(text, '[^\p{S}]', '', 'g')) AS c7 FROM d),
k AS (
  SELECT doc_id, lang, n_chars, unnest([0, 1, 2, 3, 4, 5, 6, 7, 8]) AS b,
    unnest([c0, c1, letters - c0 - c1, c3, c4, c5, p - c5, c7, n_chars - letters - c3 - c4 - p - c7]) AS c FROM k0 WHERE n_chars > 0),
kref AS (SELECT lang, b, sum(c) / sum(sum(c)) OVER (PARTITION BY lang) AS q FROM k JOIN big USING (lang) GROUP BY lang, b),
kjs AS (SELECT doc_id, min(js) AS js, any_value(n_chars) AS n_chars FROM (
  SELECT doc_id, ref, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS js, any_value(n_chars) AS n_chars
  FROM (SELECT doc_id, m.ref, n_chars, k.c / n_chars AS p, q FROM k JOIN m USING (lang) JOIN kref ON kref.lang = m.ref AND kref.b = k.b)
  GROUP BY doc_id, ref) GROUP BY doc_id),
common AS (SELECT lang, word, sum(c) AS c FROM lw GROUP BY lang, word HAVING sum(c) * 1000 >= (SELECT n FROM total WHERE total.lang = lw.lang)),
wref AS (
  SELECT lang, word, c / n AS q FROM common JOIN total USING (lang)
  UNION ALL
  SELECT lang, '' AS word, (n - coalesce((SELECT sum(c) FROM common WHERE common.lang = total.lang), 0)) / n FROM total),
wdoc AS (
  SELECT doc_id, m.ref, coalesce(common.word, '') AS word, sum(lw.c) AS c
  FROM lw JOIN m USING (lang) LEFT JOIN common ON common.lang = m.ref AND common.word = lw.word GROUP BY ALL),
wjs AS (SELECT doc_id, min(js) AS js FROM (
  SELECT doc_id, ref, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS js
  FROM (
    SELECT b.doc_id, m.ref, coalesce(x.c, 0) / b.n_words AS p, r.q
    FROM base b JOIN m ON m.lang = b.lang JOIN wref r ON r.lang = m.ref
    LEFT JOIN wdoc x ON x.doc_id = b.doc_id AND x.ref = m.ref AND x.word = r.word WHERE b.n_words > 0)
  GROUP BY doc_id, ref) GROUP BY doc_id)
SELECT base.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(n_chars >= 200 AND kjs.js > 0.27, FALSE)
    AND NOT coalesce(n_words >= 50 AND wjs.js > 0.28 + 1.4 / sqrt(n_words), FALSE) AS kept
FROM base LEFT JOIN kjs USING (doc_id) LEFT JOIN wjs USING (doc_id)
"""
