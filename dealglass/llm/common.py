"""Column helpers shared by the text operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealglass.session import shared_folder

SPACE_WORD = r"[^\x20\x09-\x0D]+"  # words between ASCII white space
FOLD = 4  # doc_ids are dealt to this many folds by CRC-32
HELD_OUT_FOLD = 2


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern in order; an empty array for a null text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def fold(doc_id: Column) -> Column:
    """CRC-32 of the id as text, modulo four; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLD


def held_out(doc_id: Column) -> Column:
    """Rows never learned from. A null id counts as not held out."""
    return F.coalesce(fold(doc_id) == HELD_OUT_FOLD, F.lit(False))


def learnable(doc_id: Column) -> Column:
    """Rows that may be learned from. A row without an id is not."""
    return F.coalesce(fold(doc_id) != HELD_OUT_FOLD, F.lit(False))


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Writes to the shared folder and reads back, which cuts the lineage."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or with as many underscores as no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
