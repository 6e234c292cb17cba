"""Words and row keys shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x20\\x09-\\x0D]+"  # a word is a run of anything but ASCII white space


def lower_ascii(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, UPPER, LOWER)


def count_words(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(text: str) -> Column:
    """A text as its UTF-8 bytes, an empty string when null.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` splits on ASCII white space only, which
    is how words are defined here.
    """
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def id_crc(column: str) -> Column:
    """crc32 of an id written as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def row_key(columns: list[str]) -> list[Column]:
    """128 bits over all columns, nulls marked; equal rows, and only those, share it."""
    parts = [p for c in columns for p in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(*parts).alias("_k1"), F.xxhash64(F.lit("second"), *parts).alias("_k2")]
