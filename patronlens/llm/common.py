"""What the text operators share: reading tables, lower-casing, word patterns, row keys."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.session import materialise

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Words between the six ASCII spaces, and words of letters, digits and everything beyond ASCII.
SPACES = r"[\x20\x09-\x0D]+"
SPACED_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TO_LOWER = str.maketrans(UPPER, LOWER)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: str) -> str:
    """Only A-Z change, so offsets and the number of code points stay."""
    return text.translate(_TO_LOWER) if not text.isascii() else text.lower()


def lowered(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def spaced_words(col: Column) -> Column:
    """The words of a text between ASCII spaces; no words for an empty or null text."""
    return F.expr("array_remove(split(coalesce({}, ''), '[\\\\x20\\\\x09-\\\\x0D]+'), '')".format(_name(col)))


def _name(col: Column | str) -> str:
    return col if isinstance(col, str) else col._jc.toString()


def fold(seed_column: str, parts: int) -> Column:
    """crc32 of the column as text, modulo ``parts``; a null counts as the text ''."""
    return F.crc32(F.coalesce(F.col(seed_column).cast("string"), F.lit("")).cast("binary")) % parts


def with_row_key(df: DataFrame, columns: list[str], key: str = "row_key") -> DataFrame:
    """``columns`` of ``df`` with a key that is unique for each row, written once so that it never changes.

    Repeated rows and rows without an id stay apart in later joins on the key.
    """
    return materialise(df.select(*columns).withColumn(key, F.monotonically_increasing_id()))


def sliced(batches: Iterator[pa.RecordBatch], column: int, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of the text in ``column``, so that a task's memory stays even."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        total = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64())).to_numpy()
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int((total <= before + size).sum()))
            yield batch.slice(start, stop - start)
            start = stop
