"""Text-field features for the five HTTP strings.

Per field: the flattened text (NULL -> ''), its length, Shannon entropy and
256-bin UTF-8 byte frequencies.  Flatten and length are native; entropy and
the byte histograms are vectorised Arrow UDFs (see ``functions.text``), all
evaluated in one Arrow round trip per projection.  The sparse long form is
built row-locally from the byte counts, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.text import byte_counts, text_entropy, text_flatten, text_length, unigram_vector


def flatten_text_fields(df: DataFrame, fields: list[str] = S.TEXT_FIELDS) -> DataFrame:
    """Replace each text field by its flattened string (never NULL)."""
    return df.withColumns({f: text_flatten(F.col(f), df.schema[f].dataType) for f in fields})


def text_lengths(df: DataFrame, fields: list[str] = S.TEXT_FIELDS) -> DataFrame:
    """T4: ``<field>_len`` in code points, after flattening (NULL -> 0)."""
    flat = flatten_text_fields(df, fields)
    return flat.withColumns({f"{f}_len": text_length(F.col(f)) for f in fields})


def text_entropies(df: DataFrame, fields: list[str] = S.TEXT_FIELDS) -> DataFrame:
    """T5: ``<field>_entropy``, Shannon entropy in bits (NULL/empty -> 0.0)."""
    flat = flatten_text_fields(df, fields)
    return flat.withColumns({f"{f}_entropy": text_entropy(F.col(f)) for f in fields})


def with_byte_counts(df: DataFrame, fields: list[str] = S.TEXT_FIELDS) -> DataFrame:
    """``<field>_bytes``: ``ARRAY<INT>`` of 256 UTF-8 byte counts (one Arrow
    pass for all fields)."""
    flat = flatten_text_fields(df, fields)
    return flat.withColumns({f"{f}_bytes": byte_counts(F.col(f)) for f in fields})


def unigram_vectors(df: DataFrame, fields: list[str] = S.TEXT_FIELDS) -> DataFrame:
    """``<field>_unigram``, 256 byte frequencies as ``ARRAY<FLOAT>``."""
    flat = flatten_text_fields(df, fields)
    return flat.withColumns({f"{f}_unigram": unigram_vector(F.col(f)) for f in fields})


def unigram_long(df: DataFrame, key: str = S.SESSION_ID, fields: list[str] = S.TEXT_FIELDS) -> DataFrame:
    """Sparse long form ``(key, field, byte_value, byte_count, frequency)``, one row
    per byte value present.  Built row-locally from the byte counts, so it
    needs no shuffle."""
    counted = with_byte_counts(df.select(key, *fields), fields)
    # only the byte values present leave the array: about 50 rows a session,
    # not 256 per field
    present = lambda f: F.filter(
        F.transform(f"{f}_bytes", lambda n, i: F.struct(i.cast("int").alias("byte_value"), n.cast("bigint").alias("byte_count"))),
        lambda x: x["byte_count"] > 0,
    )
    per_field = F.array(
        *[F.struct(F.lit(f).alias("field"), present(f).alias("cells"), F.octet_length(F.col(f)).cast("bigint").alias("total")) for f in fields]
    )
    long = counted.select(key, F.inline(per_field)).filter(F.size("cells") > 0)
    return long.select(key, "field", "total", F.inline("cells")).select(
        key, "field", "byte_value", "byte_count", (F.col("byte_count") / F.col("total")).alias("frequency")
    )


def text_features(df: DataFrame, fields: list[str] = S.TEXT_FIELDS, unigrams: bool = True) -> DataFrame:
    """Length, entropy and (optionally) the unigram vector for every field."""
    flat = flatten_text_fields(df, fields)
    cols = {}
    for f in fields:
        cols[f"{f}_len"] = text_length(F.col(f))
        cols[f"{f}_entropy"] = text_entropy(F.col(f))
    out = flat.withColumns(cols)
    if unigrams:
        out = out.withColumns({f"{f}_unigram": unigram_vector(F.col(f)) for f in fields})
    return out


def unigram_wide(df: DataFrame, key: str = S.SESSION_ID, fields: list[str] = S.TEXT_FIELDS) -> DataFrame:
    """The 1,280-column export view ``<field>_u0 .. <field>_u255`` built
    in a single projection (an export format only; the model path keeps the
    arrays)."""
    vec = unigram_vectors(df.select(key, *fields), fields)
    cols = [F.col(f"{f}_unigram")[i].alias(f"{f}_u{i}") for f in fields for i in range(S.UNIGRAM_BINS)]
    return vec.select(key, *cols)
