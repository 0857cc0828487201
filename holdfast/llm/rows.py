"""Row keys and tables that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands in for a missing id wherever ids are compared: smaller than every other.
NO_ID = -(1 << 63)


def key_columns(id_value: Column, text_value: Column) -> list[Column]:
    """``_id``: the id, or ``NO_ID`` where it is null. ``_key`` tells rows of one id with different
    texts apart; rows equal in both are repeats and get equal results."""
    text = F.coalesce(text_value.cast("string"), F.lit(""))
    return [
        F.coalesce(id_value.cast("bigint"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64(text).alias("_key"),
    ]


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, _key, text`` of each row, whatever other columns there are; a null text is empty."""
    return docs.select(
        *key_columns(F.col(id_col), F.col(text_col)),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, _key, row``: whole rows under one name, so that no column of theirs can clash."""
    return docs.select(
        *key_columns(F.col(id_col), F.col(text_col)), F.struct("*").alias("row")
    )


def named_id(name: str = "doc_id"):
    """The id as it came in."""
    return F.when(F.col("_id") != F.lit(NO_ID), F.col("_id")).alias(name)
