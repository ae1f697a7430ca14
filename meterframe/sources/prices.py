"""Rows of a day-ahead price page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = r"(?is)<td[^>]*>(.*?)</td>"


def table_cells(html: Column) -> Column:
    """Texts of the cells of one table row, without inner tags."""
    cells = F.regexp_extract_all(html, F.lit(CELL), F.lit(1))
    return F.transform(cells, lambda c: F.trim(F.regexp_replace(c, "<[^>]*>", "")))


def clean_price_rows(df: DataFrame, row: str = "row_html", keep: tuple[str, ...] = ()) -> DataFrame:
    """(delivery_period, price_EUR_MWh) of rows with exactly two cells whose
    second is a number, written with a decimal comma or point."""
    cells = df.select(*keep, table_cells(F.col(row)).alias("__cells")).where(F.size("__cells") == 2)
    price = F.replace(F.col("__cells")[1], F.lit(","), F.lit(".")).try_cast("double")
    return cells.select(
        *keep, F.col("__cells")[0].alias("delivery_period"), price.alias("price_EUR_MWh")
    ).where(F.col("price_EUR_MWh").isNotNull())
