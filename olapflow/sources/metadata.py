"""Reading files whose layout is itself data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: type names used in field metadata
TYPE_NAMES = {
    "String": "string",
    "Integer": "bigint",
    "Number": "double",
    "BigNumber": "decimal(38,10)",
    "Date": "date",
    "Timestamp": "timestamp",
    "Boolean": "boolean",
}


def read_by_metadata(spark: SparkSession, files: DataFrame, fields: DataFrame) -> dict[str, DataFrame]:
    """One frame per described file group.

    ``files``: file_id, path, delimiter, enclosure, has_header. ``fields``: file_id,
    position, field_name, field_type, field_format, null_representation. The
    descriptions are read by the driver, since each group is a frame of its own, the files
    are not. A group without fields raises an error.
    """
    shape = F.array_sort(
        F.collect_list(F.struct("position", "field_name", "field_type", "field_format", "null_representation"))
    )
    groups = files.join(fields.groupBy("file_id").agg(shape.alias("fields")), "file_id", "left")
    out = {}
    for row in groups.toLocalIterator():
        if not row.fields:
            raise ValueError(f"file group {row.file_id} has no fields")
        raw = T.StructType([T.StructField(f.field_name, T.StringType()) for f in row.fields])
        df = (
            spark.read.schema(raw)
            .option("sep", row.delimiter)
            .option("quote", row.enclosure or '"')
            .option("header", bool(row.has_header))
            .option("ignoreLeadingWhiteSpace", True)
            .option("ignoreTrailingWhiteSpace", True)
            .csv(row.path)
        )
        typed = []
        for f in row.fields:
            c = F.col(f"`{f.field_name}`")
            if f.null_representation:
                c = F.nullif(c, F.lit(f.null_representation))
            kind = TYPE_NAMES[f.field_type]
            if kind == "date" and f.field_format:
                c = F.try_to_date(c, f.field_format)
            elif kind == "timestamp" and f.field_format:
                c = F.try_to_timestamp(c, F.lit(f.field_format))
            else:
                c = c.try_cast(kind)
            typed.append(c.alias(f.field_name))
        out[row.file_id] = df.select(*typed)
    return out
