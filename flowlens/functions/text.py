"""Text features: flatten, length, Shannon entropy and UTF-8 byte histograms.

Flatten and length are native expressions (inside whole-stage codegen).
Entropy and the byte histograms are Arrow-batched UDFs, vectorised
over the whole batch with numpy (one sort / one ``bincount`` per batch, no
per-row Python loop beyond encoding).  Spark has no native "histogram into
256 bins"; for entropy a native higher-order fold exists
(``text_entropy_native``) but lambdas are interpreted, not code-generated:
measured at sf0.1 it took 17 s vs 4 s on the session fields and 244 s vs
2.6 s on long documents, with equal results (within 3e-15).
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import UNIGRAM_BINS

# Ship this module's UDF bodies by value, so executors need no installed copy
# of the package (works from any working directory and on any cluster).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def text_flatten(c: Column, dtype: T.DataType | None = None) -> Column:
    """NULL -> ``''``; a list -> its elements joined by one space; a string
    is unchanged."""
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.array_join(c.cast("array<string>"), " ", "None"), F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))


def text_length(c: Column) -> Column:
    """Length in Unicode code points (0 for the empty string)."""
    return F.length(c)


def _entropies(values: pd.Series) -> pd.Series:
    """Shannon entropy (bits) per string over code points, for a whole Arrow
    batch with one sort: (row, code point) keys -> run counts -> -p log2 p
    summed per row.  NULL/empty -> 0.0."""
    texts = ["" if v is None else v for v in values]
    n = len(texts)
    if n == 0:
        return pd.Series([], dtype="float64")
    cps = [np.frombuffer(t.encode("utf-32-le", errors="surrogatepass"), dtype=np.uint32) for t in texts]
    lengths = np.fromiter((len(c) for c in cps), dtype=np.int64, count=n)
    if lengths.sum() == 0:
        return pd.Series(np.zeros(n))
    rows = np.repeat(np.arange(n, dtype=np.int64), lengths)
    keys = (rows << 21) | np.concatenate(cps).astype(np.int64)
    uniq, counts = np.unique(keys, return_counts=True)
    owner = uniq >> 21
    p = counts / lengths[owner]
    h = np.bincount(owner, weights=-p * np.log2(p), minlength=n)
    return pd.Series(h + 0.0)


text_entropy_arrow = F.pandas_udf(_entropies, T.DoubleType())
text_entropy_arrow.__doc__ = "Arrow UDF: Shannon entropy in bits over code points (NULL/empty -> 0.0)."


def text_entropy(c: Column) -> Column:
    """Shannon entropy in bits over the code points of ``c`` (Arrow UDF);
    NULL or empty text gives 0.0, a one-symbol text 0.0 (never -0.0)."""
    return text_entropy_arrow(c)


def text_entropy_native(c: Column) -> Column:
    """Shannon entropy in bits over the code points of ``c``, JVM-only.

    NULL or empty text gives 0.0; a one-symbol text gives 0.0 (never -0.0).
    The code points are sorted once and run lengths are folded in a single
    pass, so the cost is O(n log n) per value with no shuffle.
    """
    chars = F.array_sort(F.split(c, ""))
    n = F.size(chars).cast("double")
    init = F.struct(
        F.lit(None).cast("string").alias("prev"),
        F.lit(0).cast("bigint").alias("run"),
        F.lit(0.0).alias("h"),
    )

    def term(run: Column) -> Column:
        p = run.cast("double") / n
        return F.when(run > 0, -p * F.log2(p)).otherwise(F.lit(0.0))

    def step(acc: Column, x: Column) -> Column:
        same = acc["prev"].isNotNull() & (acc["prev"] == x)
        return F.struct(
            x.alias("prev"),
            F.when(same, acc["run"] + 1).otherwise(F.lit(1).cast("bigint")).alias("run"),
            F.when(same, acc["h"]).otherwise(acc["h"] + term(acc["run"])).alias("h"),
        )

    folded = F.aggregate(chars, init, step, lambda acc: acc["h"] + term(acc["run"]))
    h = F.when(F.coalesce(F.length(c), F.lit(0)) > 0, folded).otherwise(F.lit(0.0))
    # -p*log2(p) with p == 1 is -0.0; adding 0.0 normalises the sign.
    return h + F.lit(0.0)


def _count_matrix(values: pa.Array) -> np.ndarray:
    """(rows, 256) UTF-8 byte counts for a batch of strings, via one
    ``bincount`` over the column's own bytes (NULL -> zeros)."""
    n = len(values)
    if values.null_count:
        values = values.fill_null("")
    values = values.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    if n == 0 or data is None:
        return np.zeros((n, UNIGRAM_BINS), dtype=np.int64)
    ends = np.frombuffer(offsets, dtype=np.int64)[values.offset : values.offset + n + 1]
    flat = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]]
    rows = np.repeat(np.arange(0, n * UNIGRAM_BINS, UNIGRAM_BINS), np.diff(ends))
    return np.bincount(rows + flat, minlength=n * UNIGRAM_BINS).reshape(n, UNIGRAM_BINS)


def _lists(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(matrix.reshape(-1)))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def byte_counts(values: pa.Array) -> pa.Array:
    """Arrow UDF: ``ARRAY<INT>`` of 256 UTF-8 byte counts (NULL -> zeros)."""
    return _lists(_count_matrix(values).astype(np.int32))


@F.arrow_udf(T.ArrayType(T.FloatType()))
def unigram_vector(values: pa.Array) -> pa.Array:
    """Arrow UDF: 256 byte frequencies (count / total bytes, as float32) as
    ``ARRAY<FLOAT>``; all zeros for NULL or empty text."""
    counts = _count_matrix(values)
    totals = counts.sum(axis=1, keepdims=True)
    return _lists(np.divide(counts, totals, out=np.zeros(counts.shape), where=totals > 0).astype(np.float32))


#: The type of ``present_bins``.
PRESENT = T.StructType([T.StructField("bins", T.ArrayType(T.ShortType())), T.StructField("frequencies", T.ArrayType(T.FloatType()))])
_TOTALS = T.StructType([T.StructField("n_bins", T.IntegerType()), T.StructField("n_bytes", T.LongType()), T.StructField("moment", T.LongType())])


def _present(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The places and values above zero of lists of ``lengths``."""
    kept = np.flatnonzero(values > 0)
    starts = np.cumsum(lengths) - lengths
    row = np.searchsorted(starts, kept, side="right") - 1
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lengths)))]).astype(np.int32))
    bins = pa.ListArray.from_arrays(offsets, pa.array((kept - starts[row]).astype(np.int16)))
    return pa.StructArray.from_arrays([bins, pa.ListArray.from_arrays(offsets, pa.array(values[kept]))], names=["bins", "frequencies"])


@F.arrow_udf(PRESENT)
def present_bins(vectors: pa.Array) -> pa.Array:
    """Arrow UDF: the places and values above zero of each array of
    frequencies, in the order of the places."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    return _present(vectors.flatten().to_numpy(zero_copy_only=False), lengths)


def present_columns(wide: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(``key``, ``<field>_v``): ``present_bins`` of the columns ``<field>_u0 ..
    <field>_u255``.  The columns go to Python as they are: an expression that
    makes arrays of 1,280 columns is too long for the JVM to compile."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            out = [batch.column(key)]
            for f in fields:
                cells = [batch.column(f"{f}_u{i}").to_numpy(zero_copy_only=False) for i in range(UNIGRAM_BINS)]
                out.append(_present(np.column_stack(cells).reshape(-1), np.full(n, UNIGRAM_BINS)))
            yield pa.RecordBatch.from_arrays(out, [key, *[f"{f}_v" for f in fields]])

    return wide.mapInArrow(run, T.StructType([wide.schema[key], *[T.StructField(f"{f}_v", PRESENT) for f in fields]]))


@F.arrow_udf(_TOTALS)
def bin_totals(present: pa.Array, n_bytes: pa.Array) -> pa.Array:
    """Arrow UDF: of each ``present_bins`` of a text of ``n_bytes`` bytes, how
    many byte values it has, their counts' sum, and the sum of count times
    byte value."""
    bins, frequencies = present.field("bins"), present.field("frequencies")
    n, lengths = len(present), bins.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(n), lengths)
    exact = frequencies.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * n_bytes.to_numpy(zero_copy_only=False)[row]
    counts = np.floor(exact + 0.5).astype(np.int64)
    moments = counts * bins.flatten().to_numpy(zero_copy_only=False)

    def per_row(values: np.ndarray) -> np.ndarray:
        ends = np.cumsum(np.concatenate([[0], values]))
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return np.diff(ends[upto])

    columns = [per_row(counts > 0).astype(np.int32), per_row(counts).astype(np.int64), per_row(moments).astype(np.int64)]
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["n_bins", "n_bytes", "moment"])


def _text_entries(column: pa.Array, first: int, bins: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, index, value) of a field's model inputs: length and entropy at
    ``first`` and ``first + 1``, the byte frequencies present from ``bins``."""
    values = column.to_pandas()
    n = len(values)
    rows = np.arange(n)
    lengths = np.fromiter((len(v or "") for v in values), dtype=np.float64, count=n)
    counts = _count_matrix(column)
    row, byte = np.nonzero(counts)
    totals = counts.sum(axis=1)
    freqs = (counts[row, byte] / totals[row]).astype(np.float32).astype(np.float64)
    return [
        (rows, np.full(n, first), lengths),
        (rows, np.full(n, first + 1), _entropies(values).to_numpy()),
        (row, bins + byte, freqs),
    ]


def model_vector(numbers: Column, texts: list[Column], n_numbers: int) -> Column:
    """One sparse ML vector: ``numbers`` (an array of ``n_numbers`` doubles),
    then length and entropy per text, then 256 byte frequencies per text, of
    which only those present are stored (about a tenth).  One Arrow round trip
    for everything."""
    width = n_numbers + (2 + UNIGRAM_BINS) * len(texts)
    n_texts = len(texts)

    @F.arrow_udf(VectorUDT())
    def build(numbers: pa.Array, *texts: pa.Array) -> pa.Array:
        n = len(numbers)
        scalars = numbers.flatten().to_numpy(zero_copy_only=False)
        parts = [(np.repeat(np.arange(n), n_numbers), np.tile(np.arange(n_numbers), n), scalars)]
        for k, column in enumerate(texts):
            parts += _text_entries(column, n_numbers + 2 * k, n_numbers + 2 * n_texts + UNIGRAM_BINS * k)
        row, index, value = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.argsort(row * width + index, kind="stable")
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32))
        indices = pa.ListArray.from_arrays(offsets, pa.array(index[order].astype(np.int32)))
        values = pa.ListArray.from_arrays(offsets, pa.array(value[order].astype(np.float64)))
        kind, size = pa.array(np.zeros(n, dtype=np.int8)), pa.array(np.full(n, width, dtype=np.int32))
        return pa.StructArray.from_arrays([kind, size, indices, values], names=["type", "size", "indices", "values"])

    return build(numbers, *texts)
