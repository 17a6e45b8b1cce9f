"""Row-wise operators: projections, filters, routing, text and JSON shaping, cloning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from olapflow.operators.window import row_index
from olapflow.session import scratch_path


def select_values(
    df: DataFrame,
    select: Sequence[str] | None = None,
    rename: Mapping[str, str] | None = None,
    remove: Sequence[str] = (),
    cast: Mapping[str, str] | None = None,
) -> DataFrame:
    """Pick, drop, rename and retype fields; fields not named pass through unchanged.

    A value that does not fit its new type becomes null.
    """
    if select:
        df = df.select(*select)
    df = df.drop(*remove)
    if cast:
        df = df.withColumns({c: F.col(c).try_cast(kind) for c, kind in cast.items()})
    return df.withColumnsRenamed(dict(rename or {}))


def with_expr(df: DataFrame, **exprs: str | Column) -> DataFrame:
    """Add columns from SQL text or columns."""
    return df.withColumns({n: F.expr(e) if isinstance(e, str) else e for n, e in exprs.items()})


def split_rows(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the condition and all others; an unknown (null) outcome is a miss."""
    return df.where(cond), df.where(~F.coalesce(cond, F.lit(False)))


def adjust_when(df: DataFrame, cond: Column, column: str, value: Column) -> DataFrame:
    """Replace ``column`` where the condition holds."""
    return df.withColumn(column, F.when(cond, value).otherwise(F.col(column)))


def route(
    df: DataFrame, column: str, cases: Mapping[object, str], default: str
) -> dict[str, DataFrame]:
    """One output per case value plus the default output.

    The source is read once: its rows are written to the shared folder by target, and each
    output reads its own part only. On a stream the outputs are filters, since Spark reads
    a stream per query anyway.
    """
    marked = df.withColumn("__to", map_column(F.col(column), cases, F.lit(default)))
    names = dict.fromkeys([*cases.values(), default])
    if not df.isStreaming:
        path = scratch_path(df.sparkSession, "routed")
        marked.write.partitionBy("__to").parquet(path)
        marked = df.sparkSession.read.schema(marked.schema).parquet(path)
    return {name: marked.where(F.col("__to") == name).drop("__to") for name in names}


def map_column(column: Column, mapping: Mapping[object, object], default: Column | None = None) -> Column:
    """Look a value up in a fixed mapping; without a default the rest becomes null."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    hit = F.try_element_at(F.create_map(*pairs), column)
    return hit if default is None else F.coalesce(hit, default)


def map_values(df, column, mapping, default=None, name=None) -> DataFrame:
    """Code to label; values outside the mapping take ``default`` or stay as they are."""
    rest = F.col(column).cast("string") if default is None else F.lit(default)
    return df.withColumn(name or column, map_column(F.col(column), mapping, rest))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null when b is zero or null."""
    return F.try_divide(a, b)


def calc(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Calculator steps; a later step may use the result of an earlier one."""
    for name, column in steps.items():
        df = df.withColumn(name, column)
    return df


def flag(df: DataFrame, name: str, condition: str) -> DataFrame:
    """1 where the SQL condition holds, else 0."""
    return df.withColumn(name, F.coalesce(F.expr(f"int({condition})"), F.lit(0)))


def if_null(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def regex_fields(df: DataFrame, column: str, pattern: str, fields: Mapping[str, str]) -> DataFrame:
    """Capture groups to typed fields (name -> type), null where the pattern does not match."""
    hit = F.col(column).rlike(pattern)
    out = {"matches": hit.cast("int")}
    for i, (name, kind) in enumerate(fields.items(), 1):
        text = F.regexp_extract(column, pattern, i)
        out[name] = F.when(hit, text).try_cast(kind)
    return df.withColumns(out)


def concat_fields(df: DataFrame, columns: Sequence[str], sep: str, name: str) -> DataFrame:
    """Fields joined to one line; a null gives an empty place and keeps its separator."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.withColumn(name, F.concat_ws(sep, *parts))


def tokenize(df: DataFrame, column: str, name: str = "word", keep: Sequence[str] = ()) -> DataFrame:
    """One row per lower-cased word, split on ASCII non-word characters."""
    parts = F.explode(F.split(F.lower(F.col(column)), r"\W+"))
    return df.select(*keep, parts.alias(name)).where(F.col(name) != "")


def word_count(df: DataFrame, column: str) -> DataFrame:
    """Occurrences of each word; equal words are summed before the shuffle."""
    return tokenize(df, column).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def split_to_rows(df: DataFrame, column: str, sep: str, name: str | None = None) -> DataFrame:
    """One row per part of a delimited field. ``sep`` is plain text."""
    parts = F.split(F.col(column), F.concat(F.lit("\\Q"), F.lit(sep), F.lit("\\E")))
    return df.withColumn(name or column, F.explode(parts))


def add_sequence(df, order_by, start=0, name="seq", chunk=None) -> DataFrame:
    """Consecutive numbers over the whole frame in a stated order, without a one-task sort."""
    return row_index(df, [], order_by, name, start, chunk)


def add_uuid(df: DataFrame, name: str = "uuid") -> DataFrame:
    return df.withColumn(name, F.expr("uuid()"))


def add_random(df: DataFrame, keys: Sequence[str], seed: int, name: str = "random") -> DataFrame:
    """Number in [0, 1) that depends on the row's keys and the seed only."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11)
    return df.withColumn(name, bits / F.lit(float(1 << 53)))


def add_audit(df: DataFrame, **constants: object) -> DataFrame:
    """Load time and constant columns."""
    return df.withColumns({"load_time": F.current_timestamp(), **{k: F.lit(v) for k, v in constants.items()}})


def zip_lists_to_structs(
    df: DataFrame, name: str, lists: Mapping[str, str], sep: str = ",", members: Mapping[str, str] | None = None
) -> DataFrame:
    """Parallel delimited lists to an array of structs.

    ``lists`` maps struct fields to text columns. ``members`` adds a flag per element:
    whether its first field occurs in another delimited column.
    """
    arrays = [F.split(F.col(c), sep) for c in lists.values()]
    fields = list(lists)
    zipped = F.arrays_zip(*[a.alias(f) for a, f in zip(arrays, fields)])

    def element(item):
        parts = [item.getField(f).alias(f) for f in fields]
        for flag_name, column in (members or {}).items():
            owned = F.split(F.coalesce(F.col(column), F.lit("")), sep)
            parts.append(F.array_contains(owned, item.getField(fields[0])).alias(flag_name))
        return F.struct(*parts)

    return df.withColumn(name, F.transform(zipped, element))


def append_document(df: DataFrame, column: str, schema: str, new: Column) -> DataFrame:
    """Append a struct to a JSON array held as text; no text means an empty array."""
    old = F.from_json(F.coalesce(F.col(column), F.lit("[]")), f"array<{schema}>")
    return df.withColumn(column, F.to_json(F.concat(old, F.array(new))))


def json_to_pairs(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Key/value rows of a flat JSON object."""
    pairs = F.explode(F.from_json(F.col(column), "map<string,string>"))
    return df.select(*keep, pairs.alias("key", "value"))


_PIECES = r"(\$\{[^}]+\}|[^$]+|\$)"  # a reference, plain text, or a lone dollar


def _fill_in(text: Column, values: Column) -> Column:
    def piece(p):
        name = F.regexp_extract(p, r"^\$\{([^}]+)\}$", 1)
        return F.coalesce(F.try_element_at(values, name), p)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_PIECES), F.lit(1)), piece), "")


def substitute_vars(df: DataFrame, column: str, variables: DataFrame) -> DataFrame:
    """Replace ``${NAME}`` in a text from a (name, value) table; unknown names stay.

    Every distinct text meets only the variables it names, and the filled texts are
    joined back on the text itself. A name with several values takes the smallest.
    """
    named = F.array_distinct(F.regexp_extract_all(column, F.lit(r"\$\{([^}]+)\}"), F.lit(1)))
    used = df.select(F.col(column).alias("__text"), F.explode(named).alias("name")).distinct()
    single = variables.groupBy("name").agg(F.min("value").alias("value"))
    filled = (
        used.join(single, "name")
        .groupBy("__text")
        .agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("__vars"))
        .select("__text", _fill_in(F.col("__text"), F.col("__vars")).alias("__filled"))
    )
    out = df.join(filled, F.col(column) == F.col("__text"), "left")
    return out.withColumn(column, F.coalesce("__filled", column)).drop("__text", "__filled")


def row_to_json(df: DataFrame, columns: Sequence[str] | None = None, name: str = "json") -> DataFrame:
    """Each row as one JSON object, and nothing else."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias(name))


def clone_rows(df: DataFrame, n: int | Column | str = 2, index: str | None = None) -> DataFrame:
    """``n`` copies of each row: a number, a column name or an expression.

    Zero, negative or null gives none. ``index`` numbers the copies from 0.
    """
    times = F.col(n) if isinstance(n, str) else n if isinstance(n, Column) else F.lit(n)
    times = times.cast("int")
    out = df.where(times > 0).withColumn(index or "__clone", F.explode(F.sequence(F.lit(0), times - 1)))
    return out if index else out.drop("__clone")


def flatten_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows of an array of structs, as columns."""
    return df.select(*[c for c in df.columns if c != column], F.inline(column))
