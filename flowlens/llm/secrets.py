"""Secret scan: fixed patterns, and novelty under a dictionary-primed
compressor.

The identifiers of all documents are counted; those that make up
``1 / common_share`` of them or more (at most ``common_share``, by arithmetic)
become the content of a zstandard dictionary, the commonest last, cut to
``dictionary_bytes``.  A candidate is a string of 16 characters or more with
digits and letters, not inside a pattern's span, with a sensitive word in the
``reach`` characters before it: on its line, or on an earlier one if no other
value stands between.  A value's further lines are candidates too, and so is
all that a PEM key block holds.  A candidate's novelty is the number of
compressed bytes that it adds to the surrounding text, per byte: names, words
and repeated strings are matched in the dictionary or the surroundings and cost
little, random ones cost nearly all of their bytes, or, where they are long and
their alphabet is small, their characters' entropy.  Candidates of
``min_novelty`` or more, or of nearly what as many random characters of their
alphabet cost (``random_cost``), are reported, as kind ``novel``.

Patterns (kinds assign, access, hex) are leftmost, non-overlapping per kind,
and matches that are too short are dropped after matching.

Cases: null or empty text has no spans; spans of different kinds may overlap;
repeated rows are scanned alike; an empty table gives an empty result; result
columns get underscores in front where their names are taken.
"""

from __future__ import annotations

import random
import re
import sys
from collections import Counter

import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import encoded, free_name, staged, table, texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of [0-9a-f]+ with 16 or more
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = re.compile(
    r"passw|passphrase|pwd|secret|token|key|auth|bearer|credential|private|signature|session|cookie|login", re.IGNORECASE | re.ASCII
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
PEM_KEY = re.compile(r"-----BEGIN [A-Z0-9 ]*KEY[A-Z ]*-----")
BETWEEN_LINES = re.compile(r"""[\s"'\\+,;|>#*]*\n[\s"'\\+,;|>#*]*""")
#: Alphabets of random strings, the smallest first: hex, base 32, base 36 and 62; signs are added.
ALPHABETS = [
    (re.compile(f"[{chars}]*"), size)
    for chars, size in (("0-9a-f", 16), ("0-9A-F", 16), ("0-9a-fA-F", 22), ("A-Z2-7", 32), ("a-z2-7", 32), ("a-z0-9", 36), ("A-Z0-9", 36), ("A-Za-z0-9", 62))
]
SIGNS = re.compile(r"[+/_.=-]")
_SLACK, _DRAWN = 0.95, 4096  # random strings' costs differ by less; beyond so many characters a byte's cost hardly falls
IDENTIFIER = re.compile(rb"[A-Za-z_][A-Za-z0-9_]{2,63}")
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_CONTEXT_HINTS = ("passw", "passphrase", "pwd", "secret", "token", "key", "auth", "bearer", "credential", "private", "signature", "session", "cookie", "login")
_FLUSH = 300_000


def pattern_spans(text: str, low: str) -> list[tuple[int, int, str]]:
    """(start, end, kind).  ``low``, the text in lower case, only decides
    whether a pattern can occur at all."""
    out = []
    if any(h in low for h in _ASSIGN_HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


class Novelty:
    """Marginal compressed size: what a string costs when the identifiers and
    its surroundings are the compressor's dictionary."""

    def __init__(self, content: bytes, level: int = 9):
        self.content, self.level = content, level
        self.random: dict[tuple[int, int], float] = {}
        self.empty = len(zstandard.ZstdCompressor(level=level, write_content_size=False).compress(b""))

    def __call__(self, before: str, string: str, after: str) -> float:
        """Bytes that ``string`` costs, per byte: 1 if nothing of it is known."""
        known = self.content + b" " + encoded(after) + b"\n" + encoded(before)
        primed = zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(known) >= 8 else None
        model = zstandard.ZstdCompressor(level=self.level, dict_data=primed, write_content_size=False)
        return (len(model.compress(encoded(string))) - self.empty) / len(string)

    def random_cost(self, size: int, length: int) -> float:
        """Nearly what ``length`` random characters out of ``size`` cost."""
        key = size, min(length, _DRAWN)
        if key not in self.random:
            drawn = bytes(random.Random(0).choices(range(size), k=key[1]))
            model = zstandard.ZstdCompressor(level=self.level, write_content_size=False)
            self.random[key] = _SLACK * (len(model.compress(drawn)) - self.empty) / key[1]
        return self.random[key]


def alphabet_size(string: str) -> int:
    plain = SIGNS.sub("", string)
    size = next(size for kind, size in ALPHABETS if kind.fullmatch(plain))
    return size + len(set(SIGNS.findall(string.rstrip("="))))


def key_blocks(text: str) -> list[tuple[int, int]]:
    """(start, end) of what PEM key blocks hold."""
    out, at = [], 0
    while m := PEM_KEY.search(text, at):
        at = text.find("-----END", m.end())
        if at < 0:
            break
        out.append((m.end(), at))
    return out


def novel_spans(text: str, low: str, taken: list[tuple[int, int, str]], novelty: Novelty, reach: int, context: int, min_novelty: float) -> list[tuple[int, int, str]]:
    if not any(h in low for h in _CONTEXT_HINTS):
        return []
    out = []
    blocks = key_blocks(text)
    values = sorted((y, kind) for _, y, kind in taken)
    begun = sorted((x, y) for x, y, _ in taken)
    covered = inside = 0  # how far the spans reach that have begun, and their number
    block = value = end = 0  # end: of the last value
    wraps = False  # it was in context, so its further lines are
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        s = m[0]
        while inside < len(begun) and begun[inside][0] <= a:
            covered = max(covered, begun[inside][1])
            inside += 1
        if b <= covered or not (any(c.isdigit() for c in s) and any(c.isalpha() for c in s)):
            continue
        while value < len(values) and values[value][0] <= a:
            if values[value][0] > end:
                end, wraps = values[value][0], values[value][1] != "hex"
            value += 1
        while block < len(blocks) and blocks[block][1] <= a:
            block += 1
        line = text.rfind("\n", max(0, a - reach), a) + 1
        if not (
            SENSITIVE.search(text, max(line, a - reach), a)
            or SENSITIVE.search(text, max(end, a - reach), a)
            or (wraps and a - end <= context and BETWEEN_LINES.fullmatch(text, end, a))
            or (block < len(blocks) and blocks[block][0] <= a)
        ):
            continue
        cost = novelty(text[max(0, a - context) : a], s, text[b : b + context])
        if cost >= min_novelty or cost >= novelty.random_cost(alphabet_size(s), len(s)):
            out.append((a, b, "novel"))
            end, wraps = b, True
    return out


def identifier_dictionary(docs: DataFrame, text: str, common_share: int, dictionary_bytes: int) -> bytes:
    """The commonest identifiers of all documents, the commonest last."""

    def run(batches):
        held: Counter = Counter()

        def rows():
            names: Counter = Counter()
            for word, n in held.items():
                for name in IDENTIFIER.findall(word):
                    names[name] += n
            total = sum(names.values())
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([None, *names], pa.binary()), pa.array([total, *names.values()], pa.int64())], ["name", "n"]
            )

        for batch in batches:
            for t in texts(batch.column(0)):
                held.update(encoded(t).split())
                if len(held) > _FLUSH:
                    yield rows()
        yield rows()

    counts = docs.select(text).mapInArrow(run, "name binary, n long")
    counts = staged(counts.groupBy("name").agg(F.sum("n").alias("n")), "identifiers")
    total = counts.filter("name IS NULL").agg(F.sum("n")).first()[0] or 0
    common = counts.filter("name IS NOT NULL").filter(F.col("n") * common_share >= F.lit(total)).collect()
    names = [bytes(r.name) for r in sorted(common, key=lambda r: (r.n, r.name))]
    return b" ".join(names)[-dictionary_bytes:]


def scan_secrets(
    docs: DataFrame,
    text: str = "text",
    common_share: int = 20_000,
    dictionary_bytes: int = 1 << 16,
    reach: int = 40,
    context: int = 256,
    min_novelty: float = 0.75,
) -> DataFrame:
    """``docs`` with spans: array of (start, end, kind) by start, then kind as
    listed, then end; code points, end exclusive."""
    content = identifier_dictionary(docs, text, common_share, dictionary_bytes)
    name, at = free_name(docs.columns, "spans"), docs.columns.index(text)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches):
        novelty = Novelty(content)
        for batch in batches:
            out = []
            for t in texts(batch.column(at)):
                t = t or ""
                low = t.lower()
                spans = pattern_spans(t, low)
                spans += novel_spans(t, low, spans, novelty, reach, context, min_novelty)
                spans.sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
                out.append([{"start": a, "end": b, "kind": k} for a, b, k in spans])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], [*batch.schema.names, name])

    schema = docs.withColumn(name, F.lit(None).cast("array<struct<start:long,end:long,kind:string>>")).schema
    return docs.mapInArrow(run, schema)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
