"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import discard, materialise, new_path, shared_dir, table

__all__ = ["DOCUMENT_COLUMNS", "ascii_lower", "discard", "hold_out", "materialise", "new_path", "sampled", "shared_dir", "table"]

#: Columns of the documents table, in order.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Translation that lower-cases the ASCII capitals only.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def hold_out(id_column: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo modulus, equals remainder; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


#: Standard deviations by which a sample's expected size stays below its limit.
MARGIN = 6


def sampled(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most `most` of rows, all of them if there are so few, else those whose key's hash is below a threshold.

    Reruns choose the same rows and no rows are ordered or gathered for it; the
    threshold makes a size beyond the limit as unlikely as MARGIN deviations are.
    """
    n = rows.count()
    if n <= most:
        return rows
    share = max(0.0, most - MARGIN * most**0.5) / n
    return rows.where(F.shiftrightunsigned(F.xxhash64(F.lit("sample"), key), 11) < int(share * (1 << 53)))
