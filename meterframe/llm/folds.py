"""Which rows may be learned from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_training(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text is no multiple of ``folds``; a null id counts as
    empty text and is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds != 0
