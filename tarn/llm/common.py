"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import dropped, shared_dir, written

__all__ = ["WHITE", "documents", "dropped", "fresh", "keyed", "shared_dir", "whole_ids", "written"]

#: White space of all word-based operators: space and U+0009 to U+000D. Fixed values.
WHITE = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table `documents`."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, by fixed names, so that no other column can clash. A null text counts as empty."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def fresh(df: DataFrame) -> DataFrame:
    """df with new column identities, so that it can be joined with itself."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def whole_ids(df: DataFrame, id_col: str) -> DataFrame:
    """df, refused unless its ids are whole numbers."""
    if not isinstance(df.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} is {df.schema[id_col].dataType.simpleString()}; this operator tells documents apart by whole numbers, so number the rows first")
    return df
