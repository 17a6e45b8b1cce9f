"""File readers and writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from olapflow.operators.window import row_index


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | T.StructType | None = None,
    sep: str = ",",
    header: bool = True,
    trim: bool = True,
    date_format: str | None = None,
    enclosure: str = '"',
    null_value: str | None = None,
) -> DataFrame:
    """Delimited text; paths may hold wildcards. Without a schema types are inferred,
    which reads the input once more."""
    reader = (
        spark.read.option("sep", sep)
        .option("header", header)
        .option("quote", enclosure)
        .option("ignoreLeadingWhiteSpace", trim)
        .option("ignoreTrailingWhiteSpace", trim)
    )
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text lines in a column ``value``."""
    return spark.read.text(path)


def split_typed(schema: str | T.StructType, sep: str = ",", column: str = "value"):
    """Transform that splits a line into typed fields; missing or unfit ones become null."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def apply(df: DataFrame) -> DataFrame:
        parts = F.split(F.col(column), F.concat(F.lit("\\Q"), F.lit(sep), F.lit("\\E")))
        picked = [
            F.nullif(F.trim(F.try_element_at(parts, F.lit(i))), F.lit("")).try_cast(f.dataType).alias(f.name)
            for i, f in enumerate(fields, 1)
        ]
        return df.select(*[c for c in df.columns if c != column], *picked)

    return apply


def read_json(
    spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType, multi_line: bool = False
) -> DataFrame:
    """JSON lines, or whole documents when ``multi_line``."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def from_json_struct(column: Column, schema: str | T.StructType) -> Column:
    """Parse a JSON text by a declared schema; unreadable text gives nulls."""
    return F.from_json(column, schema)


def _nested(paths: Sequence[tuple[list[str], T.DataType]]) -> T.StructType:
    """Struct type that holds a value of the given type at every path."""
    heads = dict.fromkeys(path[0] for path, _ in paths)
    out = []
    for head in heads:
        below = [(path[1:], kind) for path, kind in paths if path[0] == head]
        leaf = next((kind for path, kind in below if not path), None)
        out.append(T.StructField(head, leaf or _nested(below)))
    return T.StructType(out)


def read_xml_loop(
    df: DataFrame, column: str, loop_path: str, fields: Mapping[str, tuple[str, str]], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per node matched by ``loop_path`` (``/root/a/b``) in an XML text column.

    ``fields`` maps names to (path below the node, type); ``@x`` is an attribute. Every
    step of the loop path may repeat.
    """
    _, _root, *steps = loop_path.split("/")
    paths = {n: [p.replace("@", "_") for p in path.split("/")] for n, (path, _) in fields.items()}
    kinds = {n: T.StructType.fromDDL(f"x {kind}")["x"].dataType for n, (_, kind) in fields.items()}
    node: T.DataType = _nested([(paths[n], kinds[n]) for n in fields])
    for step in reversed(steps):
        node = T.StructType([T.StructField(step, T.ArrayType(node))])
    rows = df.select(*keep, F.from_xml(F.col(column), node.simpleString()).alias("__n"))
    for step in steps:
        rows = rows.select(*keep, F.explode(f"__n.{step}").alias("__n"))
    return rows.select(*keep, *[F.col(".".join(["__n", *paths[n]])).alias(n) for n in fields])


def write_delimited(
    df: DataFrame, path: str, sep: str = ",", header: bool = True, single_file: bool = False, mode: str = "error"
) -> None:
    """Delimited part files. ``single_file`` writes through one task: for small results."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("sep", sep).option("header", header).csv(path)


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "error") -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Avro files; needs the spark-avro package on the class path."""
    return spark.read.format("avro").load(path)


def write_avro(df: DataFrame, path: str, mode: str = "error") -> None:
    """Avro files; needs the spark-avro package on the class path."""
    df.write.format("avro").mode(mode).save(path)


def to_json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    """One JSON object per row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))


def to_json_blocks(
    df: DataFrame, order: Sequence[str], block: int, chunk: Column | None = None, name: str = "json"
) -> DataFrame:
    """One JSON array per ``block`` rows, numbered in order."""
    fields = df.columns
    numbered = row_index(df, [], order, "__i", chunk=chunk)
    item = F.struct(F.col("__i"), F.to_json(F.struct(*fields)).alias("j"))
    texts = F.transform(F.array_sort(F.collect_list(item)), lambda x: x.j)
    return (
        numbered.groupBy(F.expr(f"__i div {int(block)}").alias("block_no"))
        .agg(F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")).alias(name))
    )


def to_json_document(df: DataFrame, order: Sequence[str], chunk: Column | None = None) -> DataFrame:
    """All rows as one JSON array, one line per row.

    The lines joined in ``line_no`` order are the document, so no task or cell ever
    holds it whole.
    """
    fields = df.columns
    numbered = row_index(df, [], order, "line_no", 1, chunk)
    body = F.concat(
        F.when(F.col("line_no") > 1, F.lit(",")).otherwise(F.lit("")), F.to_json(F.struct(*fields))
    )
    lines = numbered.select("line_no", body.alias("line"))
    size = df.agg(F.count(F.lit(1)).alias("n"))
    head = size.select(F.lit(0).cast("bigint").alias("line_no"), F.lit("[").alias("line"))
    tail = size.select((F.col("n") + 1).alias("line_no"), F.lit("]").alias("line"))
    return head.unionByName(lines).unionByName(tail)


def write_xml(df: DataFrame, path: str, row_tag: str = "row", root_tag: str = "rows", mode: str = "error") -> None:
    """XML part files, each a complete document."""
    df.write.format("xml").mode(mode).option("rowTag", row_tag).option("rootTag", root_tag).save(path)


def to_xml_rows(df: DataFrame, row_tag: str = "row", name: str = "xml") -> DataFrame:
    """One XML element per row."""
    return df.select(F.to_xml(F.struct(*df.columns), {"rowTag": row_tag, "indent": ""}).alias(name))
