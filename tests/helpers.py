"""Small helpers shared by the tests."""

from pyspark.sql import functions as F


def rows(df, *columns):
    """Rows as sorted tuples, for comparison without an order."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


def days(df, *columns):
    """Date columns as text."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def day(text):
    return F.lit(text).cast("date")
