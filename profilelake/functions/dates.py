"""Date bounds of a query, read once on the driver so that they reach the scan as literals."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted formats, tried in this order.
DATE_FORMATS = ["%Y-%m-%d", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S", "%Y-%m"]


def parse_date(text: str | None) -> datetime | None:
    for fmt in DATE_FORMATS:
        try:
            return datetime.strptime(text or "", fmt)
        except ValueError:
            pass
    return None


def date_filter(start: str | None = None, end: str | None = None, c: str = "timestamp") -> Column:
    """Inclusive range on a timestamp column; a bound that cannot be read is left out."""
    keep = F.lit(True)
    for bound, compare in ((parse_date(start), ">="), (parse_date(end), "<=")):
        if bound is not None:
            keep = keep & F.expr(f"{c} {compare} timestamp_ntz'{bound:%Y-%m-%d %H:%M:%S}'")
    return keep


def dated(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows within the dates; a table stored by ``year`` opens the years they reach only."""
    rows = df.where(date_filter(start, end))
    if "year" in df.columns:
        for bound, compare in ((parse_date(start), ">="), (parse_date(end), "<=")):
            if bound is not None:
                rows = rows.where(f"year {compare} {bound.year}")
    return rows
