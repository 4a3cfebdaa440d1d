"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package from where the driver has it, unless told otherwise.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: Column) -> Column:
    """The bytes of a text; a null text has none."""
    return F.coalesce(text.cast("binary"), F.lit(b"").cast("binary"))


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key is an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def batches(values: pd.Series, most: int = 1 << 21):
    """Slices of consecutive texts of about ``most`` bytes; one long text is a slice of its own."""
    ends = np.cumsum(np.fromiter((len(v) for v in values), np.int64, len(values)))
    start = 0
    while start < len(values):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield start, stop
        start = stop
