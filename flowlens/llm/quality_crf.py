"""Quality classifier: a linear-chain CRF over a document's lines.

Every line is labelled good or bad from features of itself and of its two
neighbours; the chain's transitions tie neighbouring labels.  A document's
score is the mean of the lines' forward-backward marginals of "good", weighted
by line length.

Training takes a bounded sample of labelled documents: ``sample_docs`` ids in
the order of a hash, cut over their whole length into runs of up to
``sample_lines`` lines, and of these as many runs by hash.  All lines of a
document carry its label.  The weights are fitted by gradient ascent on the
chain's log-likelihood with an L2 penalty.  Every document is scored, over all
of its lines.

Held-out documents (crc32 of the id's text divisible by ``folds``) are never
trained on.  Only ``text`` enters a score.

Cases: null or empty text is one empty line and gets a score; a null doc_id
counts as an empty id text; of several labels of a doc_id the smallest holds,
null labels are ignored; with no labelled documents, or one label only, the
model is fitted to what there is (no label at all: score 0.5); repeated rows
get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import int_lists, table, texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SYMBOLS = "#*$%&|<>"
STOPS = (".", "!", "?", ":", ";", '"')
#: Upper edges of the bins that a measure is cut into.
EDGES = {
    "words": (0.5, 3.5, 8.5, 20.5, 60.5),
    "symbols": (0.001, 0.01, 0.05, 0.15),
    "upper": (0.005, 0.06, 0.2, 0.6),
    "digits": (0.001, 0.02, 0.1, 0.3),
    "stutter": (0.001, 0.05, 0.2, 0.5),
    "distinct": (0.3, 0.5, 0.7, 0.9),
    "length": (2.5, 4.0, 5.5, 7.5),
    "marks": (0.001, 0.02, 0.1),
}
FLAGS = ("stop", "repeat", "url", "cell")
OWN = 1 + len(FLAGS) + sum(len(e) + 1 for e in EDGES.values())
FEATURES = 3 * OWN  # the line, the one before, the one after


def measures(line: str, seen: set[str]) -> list[float]:
    """Values of EDGES' measures, then FLAGS."""
    words, n = line.split(), max(1, len(line))
    letters = max(1, sum(map(len, words)))
    upper = sum(map(str.isupper, line)) if not line.islower() else 0
    digits = sum(line.count(c) for c in "0123456789")
    stutter = sum(a == b for a, b in zip(words, words[1:]))
    out = [
        len(words),
        sum(line.count(c) for c in SYMBOLS) / n,
        upper / letters,
        digits / n,
        stutter / max(1, len(words)),
        len(set(words)) / max(1, len(words)),
        letters / max(1, len(words)),
        line.count("!") / n,
        line.rstrip().endswith(STOPS),
        bool(words) and line in seen,
        "://" in line or "www." in line,
        " | " in line,
    ]
    seen.add(line)
    return out


def line_features(lines: list[str]) -> np.ndarray:
    """Ids of the active features of each line: binned measures, flags and a
    bias of its own; the same for the neighbours (their bias tells that there
    is one).  -1 fills the rows."""
    seen: set[str] = set()
    values = np.array([measures(x, seen) for x in lines], dtype=float)
    columns, at = [np.zeros(len(lines), dtype=np.int64)], 1
    for i, edges in enumerate(EDGES.values()):
        columns.append(at + np.searchsorted(edges, values[:, i], side="right"))
        at += len(edges) + 1
    for i in range(len(FLAGS)):
        columns.append(np.where(values[:, len(EDGES) + i] > 0, at, -1))
        at += 1
    own = np.stack(columns, axis=1)
    out = np.full((len(lines), 3 * own.shape[1]), -1, dtype=np.int64)
    width = own.shape[1]
    out[:, :width] = own
    out[1:, width : 2 * width] = np.where(own[:-1] >= 0, own[:-1] + OWN, -1)
    out[:-1, 2 * width :] = np.where(own[1:] >= 0, own[1:] + 2 * OWN, -1)
    return out


WIDTH = 3 * (1 + len(EDGES) + len(FLAGS))


def split_lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


class Chain:
    """Weights: ``unary`` (score of good over bad; the last entry, for -1, is
    0) and ``change`` (2 x 2, from label to label)."""

    def __init__(self):
        self.unary = np.zeros(FEATURES + 1)
        self.change = np.zeros((2, 2))

    def marginals(self, features: np.ndarray) -> np.ndarray:
        """P(good) of each line, by scaled forward-backward."""
        odds = np.exp(np.clip(self.unary[features].sum(axis=1), -30, 30)).tolist()
        (bb, bg), (gb, gg) = np.exp(self.change).tolist()
        n = len(odds)
        ahead = [0.0] * n  # P(good | lines so far)
        p = odds[0] / (1 + odds[0])
        ahead[0] = p
        for i in range(1, n):
            bad, good = (1 - p) * bb + p * gb, ((1 - p) * bg + p * gg) * odds[i]
            p = good / (bad + good)
            ahead[i] = p
        out = np.empty(n)
        back_bad = back_good = 1.0
        for i in range(n - 1, -1, -1):
            bad, good = (1 - ahead[i]) * back_bad, ahead[i] * back_good
            out[i] = good / (bad + good)
            to_bad, to_good = back_bad, back_good * odds[i]
            back_bad, back_good = bb * to_bad + bg * to_good, gb * to_bad + gg * to_good
            total = back_bad + back_good
            back_bad, back_good = back_bad / total, back_good / total
        return out

    def score(self, text: str | None) -> float:
        lines = split_lines(text)
        weights = np.array([len(x) + 1 for x in lines], dtype=float)
        return float(min(1.0, max(0.0, (self.marginals(line_features(lines)) * weights).sum() / weights.sum())))

    def fit(self, documents: list[tuple[np.ndarray, int]], steps: int, rate: float, penalty: float) -> None:
        """Gradient ascent (Adam) on the mean log-likelihood of the label
        chains, all documents at once, padded to the longest."""
        if not documents:
            return
        documents = sorted(documents, key=lambda d: -len(d[0]))
        n, longest = len(documents), len(documents[0][0])
        sizes = np.array([len(f) for f, _ in documents])
        labels = np.array([y for _, y in documents])
        ids = np.full((longest, n, WIDTH), FEATURES, dtype=np.int64)
        for d, (f, _) in enumerate(documents):
            ids[: len(f), d] = np.where(f >= 0, f, FEATURES)
        active = [int((sizes > t).sum()) for t in range(longest)]
        params = np.zeros(FEATURES + 1 + 4)
        m, v = np.zeros_like(params), np.zeros_like(params)
        lse = np.logaddexp
        for step in range(1, steps + 1):
            unary, change = params[: FEATURES + 1], params[FEATURES + 1 :].reshape(2, 2)
            gain = [unary[ids[t, :k]].sum(axis=1) for t, k in enumerate(active)]
            ahead = [np.stack([np.zeros(active[0]), gain[0]])]
            for t in range(1, longest):
                a = ahead[-1][:, : active[t]]
                ahead.append(np.stack([lse(a[0] + change[0, 0], a[1] + change[1, 0]), lse(a[0] + change[0, 1], a[1] + change[1, 1]) + gain[t]]))
            slope, turns = np.zeros(FEATURES + 1), np.zeros((2, 2))
            back = np.zeros((2, n))
            for t in range(longest - 1, -1, -1):
                k = active[t]
                both = ahead[t] + back[:, :k]
                total = lse(both[0], both[1])
                rest = labels[:k] - np.exp(both[1] - total)
                slope += np.bincount(ids[t, :k].ravel(), weights=np.repeat(rest, WIDTH), minlength=FEATURES + 1)
                if t:
                    onward = np.stack([back[0, :k], back[1, :k] + gain[t]])
                    for i in range(2):
                        for j in range(2):
                            expected = np.exp(ahead[t - 1][i, :k] + change[i, j] + onward[j] - total)
                            turns[i, j] += ((labels[:k] == i) & (i == j)).sum() - expected.sum()
                    new = np.zeros((2, n))
                    for i in range(2):
                        new[i, :k] = lse(change[i, 0] + onward[0], change[i, 1] + onward[1])
                    back = new
            slope[FEATURES] = 0
            grad = np.concatenate([slope, turns.ravel()]) / n - penalty * params
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            params = params + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.unary, self.change = params[: FEATURES + 1].copy(), params[FEATURES + 1 :].reshape(2, 2).copy()
        self.unary[FEATURES] = 0


def held_out(doc_id: Column, folds: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
    folds: int = 5,
    sample_docs: int = 4000,
    sample_lines: int = 64,
    steps: int = 150,
    rate: float = 0.1,
    penalty: float = 1e-3,
) -> Chain:
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).dropna().filter(~held_out(F.col("id"), folds))
    known = known.groupBy("id").agg(F.min("y").alias("y"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(sample_docs).collect()
    if not sample:
        return Chain()
    ids = docs.sparkSession.createDataFrame([(r.id, r.y) for r in sample], known.schema)

    def run(batches):
        for batch in batches:
            found, rows, part = [], [], []
            for i, t in enumerate(texts(batch.column(0))):
                own = line_features(split_lines(t))
                runs = [own[a : a + sample_lines] for a in range(0, len(own), sample_lines)]
                found += runs
                rows += [i] * len(runs)
                part += range(len(runs))
            flat = np.concatenate([f.ravel() for f in found]) if found else np.zeros(0, dtype=np.int64)
            y, ids = (batch.column(c).take(pa.array(rows, pa.int64())) for c in (1, 2))
            lists = int_lists(flat, [f.size for f in found], pa.int64()).cast(pa.list_(pa.int16()))
            yield pa.RecordBatch.from_arrays([lists, y, ids, pa.array(part, pa.int64())], ["features", "y", "id", "part"])

    own = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(ids), "id")  # sample_docs rows
    rows = own.select("text", "y", F.col("id").cast("long").alias("id")).mapInArrow(run, "features array<smallint>, y int, id long, part long")
    rows = rows.dropDuplicates(["id", "part"]).orderBy(F.xxhash64("id", "part"), "id", "part").limit(sample_docs).toArrow()
    documents = []
    order = np.lexsort((rows.column("part").to_numpy(), rows.column("id").to_numpy()))
    for i in order.tolist():
        f = np.array(rows.column("features")[i].values, dtype=np.int64).reshape(-1, WIDTH)
        documents.append((f, int(rows.column("y")[i].as_py() > 0)))
    model = Chain()
    model.fit(documents, steps, rate, penalty)
    return model


def score_quality(docs: DataFrame, model: Chain, text: str = "text", doc_id: str = "doc_id", folds: int = 5, least: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""

    def run(batches):
        for batch in batches:
            scores = [model.score(t) for t in texts(batch.column(2))]
            predicted = pa.array([int(s >= least) for s in scores], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), predicted], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(F.col(doc_id), folds).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op5_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, train(docs, table(spark, sf_dir, "labels")))
