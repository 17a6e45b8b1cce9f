"""Table-like sources and sinks, services, profiles and generators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_sql(
    spark: SparkSession, url: str, query: str, split_by: str | None = None, bounds: tuple | None = None, parts: int = 1,
    **options: str,
) -> DataFrame:
    """Table or query over JDBC; ``split_by`` with its bounds reads in parallel parts."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if split_by is None:
        return reader.option("query", query).load()
    reader = reader.option("dbtable", f"({query}) q").option("partitionColumn", split_by)
    return reader.option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts).load()


def write_table(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append, truncate and insert, or fail when the target holds rows."""
    if mode == "fail_if_not_empty":
        try:
            held = df.sparkSession.read.parquet(path).limit(1).count()
        except Exception as error:  # no such table yet
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            held = 0
        if held:
            raise ValueError(f"{path} is not empty")
        mode = "append"
    df.write.mode({"append": "append", "truncate": "overwrite"}[mode]).parquet(path)


def write_atomic(df: DataFrame, path: str, constraints: Mapping[str, Column], mode: str = "append") -> None:
    """Write all rows or none: a row that breaks a constraint fails the job before commit."""
    fault = F.lit(None).cast("string")
    for label, rule in constraints.items():
        broken = F.raise_error(F.lit(f"constraint {label} is broken")).cast("string")
        fault = F.when(~F.coalesce(rule, F.lit(False)), broken).otherwise(fault)
    df.where(fault.isNull()).write.mode(mode).parquet(path)


def pending_files(listing: DataFrame, processed: DataFrame, pattern: str, name: str = "filename") -> DataFrame:
    """Files whose name carries a version number and that no log lists yet, by version."""
    versions = listing.where(F.col(name).rlike(pattern)).withColumn(
        "version", F.regexp_extract(name, pattern, 1).cast("bigint")
    )
    return versions.join(processed.select(name), name, "left_anti").orderBy("version", name)


#: Size of a sketch (2^bits entries) and its error: three standard deviations of 1.04 / sqrt(2^bits).
SKETCH_BITS, SKETCH_ERROR = 14, 0.025


def sketches(df: DataFrame, parts: Sequence[str] = ()) -> DataFrame:
    """What a profile is made of, one row per value of ``parts`` (a file, a day): per column
    the rows, nulls, a sketch of the distinct values, minimum and maximum. Rows of several
    parts or runs can be kept and merged later."""
    aggs = []
    for i, field in enumerate(f for f in df.schema if f.name not in parts):
        c = F.col(f"`{field.name}`")
        aggs += [
            F.count(F.lit(1)).alias(f"rows{i}"), F.count_if(c.isNull()).alias(f"nulls{i}"),
            F.hll_sketch_agg(c.cast("string"), F.lit(SKETCH_BITS)).alias(f"sketch{i}"), F.min(c).alias(f"min{i}"), F.max(c).alias(f"max{i}"),
        ]
    return df.groupBy(*parts).agg(*aggs)


def merge_sketches(parts: DataFrame) -> DataFrame:
    """One row of sketches from many."""
    aggs = []
    for i in range(sum(c.startswith("sketch") for c in parts.columns)):
        aggs += [
            F.sum(f"rows{i}").alias(f"rows{i}"), F.sum(f"nulls{i}").alias(f"nulls{i}"),
            F.hll_union_agg(f"sketch{i}", F.lit(False)).alias(f"sketch{i}"), F.min(f"min{i}").alias(f"min{i}"), F.max(f"max{i}").alias(f"max{i}"),
        ]
    return parts.agg(*aggs)


def profile_of(merged: DataFrame, schema: T.StructType) -> DataFrame:
    """The profile table of one row of sketches over columns of ``schema``."""
    rows = [
        F.struct(
            F.lit(f.name).alias("column"), F.lit(i).alias("position"), F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"rows{i}").alias("rows"), F.col(f"nulls{i}").alias("nulls"),
            F.coalesce(F.hll_sketch_estimate(f"sketch{i}"), F.lit(0)).cast("bigint").alias("distinct_values"),
            F.col(f"min{i}").cast("string").alias("minimum"), F.col(f"max{i}").cast("string").alias("maximum"),
        )
        for i, f in enumerate(schema)
    ]
    return merged.select(F.inline(F.array(*rows)))


def profile(df: DataFrame, approx: bool = True, exact: Sequence[str] = ()) -> DataFrame:
    """One row per column: position, type, rows, nulls, distinct values, minimum, maximum.

    Distinct values come from a sketch per column (see ``SKETCH_ERROR``), so a profile
    costs one pass and no shuffle of values. Columns named in ``exact`` are counted
    instead, or all with ``approx`` off: their equal values are put together on the map
    side, and what is left is spread by the hash of column and value.
    """
    exact = exact if approx else df.columns
    out = profile_of(sketches(df), df.schema)
    if not exact:
        return out
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("v")) for c in exact])
    values = df.select(F.inline(cells)).where("v is not null").distinct()
    counted = values.groupBy("column").agg(F.count(F.lit(1)).alias("__n"))
    named = F.coalesce("__n", F.when(F.col("column").isin(list(exact)), F.lit(0)), "distinct_values").cast("bigint")
    return out.join(counted, "column", "left").withColumn("distinct_values", named).drop("__n")


def inline(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small data written in the program, as a local relation: Spark knows its size and does
    not shuffle a large table by its few keys to join it."""
    df = spark.createDataFrame(list(rows), schema)
    return spark.createDataFrame(df.toArrow(), df.schema)


def generate_rows(spark: SparkSession, n: int, **constants: object) -> DataFrame:
    """``n`` equal rows with a row number."""
    return spark.range(n).select(F.col("id").alias("row_no"), *[F.lit(v).alias(k) for k, v in constants.items()])


def _draw(seed: int, label: str, bound: int) -> Column:
    """Number in [0, bound) fixed by row id, seed and field."""
    return F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(label)), F.lit(bound))


def generate_fields(ids: DataFrame, fields: Mapping[str, tuple], seed: int = 42) -> DataFrame:
    """Synthetic fields for each ``id``, the same for any partitioning.

    Field kinds: ``("id",)``, ``("enum", values)``, ``("range", lo, hi)``, and
    ``("ref", rows)``, an id of another table with that many rows.
    """
    out = []
    for name, (kind, *spec) in fields.items():
        if kind == "id":
            column = F.col("id")
        elif kind == "enum":
            column = F.element_at(F.array(*[F.lit(v) for v in spec[0]]), (_draw(seed, name, len(spec[0])) + 1).cast("int"))
        elif kind == "range":
            column = _draw(seed, name, spec[1] - spec[0] + 1) + F.lit(spec[0])
        elif kind == "ref":
            column = _draw(seed, name, spec[0])
        else:
            raise ValueError(f"unknown field kind {kind}")
        out.append(column.alias(name))
    return ids.select(*out)


def generate_tables(spark: SparkSession, model: Mapping[str, tuple[int, Mapping[str, tuple]]], seed: int = 42) -> dict[str, DataFrame]:
    """Related synthetic tables; ``("ref", "users")`` draws ids of the table ``users``."""
    sizes = {name: n for name, (n, _) in model.items()}
    out = {}
    for name, (n, fields) in model.items():
        fixed = {f: ("ref", sizes[s[1]]) if s[0] == "ref" else s for f, s in fields.items()}
        out[name] = generate_fields(spark.range(n), fixed, seed)
    return out


def read_properties(df: DataFrame, key: str, value: str, names: Sequence[str]) -> DataFrame:
    """Key/value rows to one row of variables."""
    return df.agg(*[F.max(F.when(F.col(key) == n, F.col(value))).alias(n) for n in names])


def register_service(df: DataFrame, name: str) -> DataFrame:
    """Name a pipeline's output for SQL; filters on it are pushed into its sources."""
    df.createOrReplaceTempView(name)
    return df


def blend(spark: SparkSession, left: str, right: str, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two named services, whatever their sources are."""
    return spark.table(left).join(spark.table(right), list(on), how)
