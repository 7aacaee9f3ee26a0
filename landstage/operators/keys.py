"""Surrogate ids for staging rows when the sink does not assign them, and their packed form for shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstage.functions.util import as_col


def id_from_hash(hash_col="hash_key") -> Column:
    """Text id from an 80-character staging hash: the whole sha1 digest it encodes (160 bits).

    Stable across runs and computed per row (no shuffle, no global counter).
    """
    return F.decode(F.unhex(as_col(hash_col)), "UTF-8")


def with_surrogate_id(df: DataFrame, name: str, hash_col: str = "hash_key") -> DataFrame:
    return df.select(id_from_hash(hash_col).alias(name), "*")


def pack(c) -> Column:
    """A text as bytes, half as many if it is lower-case hex as ids are; equal texts, and only those, have equal bytes.

    The first byte says which of the two it is.  Null stays null.  The order of texts is not kept.
    """
    c = as_col(c)
    return F.when(F.lower(F.hex(F.unhex(c))) == c, F.concat(F.lit(b"\x01"), F.unhex(c))).otherwise(F.concat(F.lit(b"\x00"), c.cast("binary")))


def unpack(c) -> Column:
    """The text that ``pack`` was given."""
    c = as_col(c)
    rest = F.substring(c, 2, 2**31 - 1)
    return F.when(F.substring(c, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
