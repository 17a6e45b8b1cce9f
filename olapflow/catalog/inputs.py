"""Readers, writers, profiles, checks and user functions."""

from pyspark.sql import functions as F

from olapflow.catalog.base import iso_day, money, query, total
from olapflow.operators import quality, udf
from olapflow.session import scratch_path
from olapflow.sources import files, messages, metadata, tables
from olapflow.streaming import batches

SQL_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders"
ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date"


def _orders(t):
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate")
    )


@query("a01_delimited_scan", SQL_ORDERS)
def a01(t):
    path = scratch_path(t.spark, "orders-csv")
    files.write_delimited(_orders(t), path, sep=";")
    out = files.read_delimited(t.spark, f"{path}/part-*", ORDER_SCHEMA, sep=";", date_format="yyyy-MM-dd")
    return out.withColumn("o_orderdate", iso_day("o_orderdate"))


@query("a01_delimited_scan_inferred", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def a01_inferred(t):
    path = scratch_path(t.spark, "customer-csv")
    files.write_delimited(t.customer.select("c_custkey", "c_name", "c_acctbal"), path)
    out = files.read_delimited(t.spark, path)
    return out.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("a02_lines_to_typed_fields", """
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS note FROM orders""")
def a02(t):
    path = scratch_path(t.spark, "order-lines")
    note = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    t.orders.select(F.concat_ws("|", "o_orderkey", "o_totalprice", note).alias("value")).write.text(path)
    return files.read_lines(t.spark, path).transform(
        files.split_typed("o_orderkey bigint, o_totalprice double, note string", "|")
    )


@query("a03_metadata_driven_scan", """
SELECT 'customer' AS file_id, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS total FROM customer
UNION ALL SELECT 'supplier', count(*), CAST(sum(CAST(s_acctbal AS DECIMAL(12,2))) AS DOUBLE) FROM supplier""")
def a03(t):
    path = scratch_path(t.spark, "described")
    files.write_delimited(t.customer.select("c_custkey", "c_acctbal"), f"{path}/customer")
    files.write_delimited(t.supplier.select("s_suppkey", "s_acctbal"), f"{path}/supplier", sep="|", header=False)
    described = t.spark.createDataFrame(
        [("customer", f"{path}/customer", ",", '"', True), ("supplier", f"{path}/supplier", "|", '"', False)],
        "file_id string, path string, delimiter string, enclosure string, has_header boolean",
    )
    fields = t.spark.createDataFrame(
        [
            ("customer", 1, "id", "Integer", None, None),
            ("customer", 2, "balance", "Number", None, None),
            ("supplier", 1, "id", "Integer", None, None),
            ("supplier", 2, "balance", "Number", None, None),
        ],
        "file_id string, position int, field_name string, field_type string, field_format string, null_representation string",
    )
    frames = metadata.read_by_metadata(t.spark, described, fields)
    counts = [
        df.agg(F.count("*").alias("n"), total("balance").alias("total")).select(F.lit(name).alias("file_id"), "n", "total")
        for name, df in sorted(frames.items())
    ]
    return counts[0].unionByName(counts[1])


@query("a05_xml_loop", "SELECT o_custkey, o_orderkey, o_orderstatus AS status FROM orders")
def a05(t):
    """One document per order pair: orders of a customer, split in blocks, read back node by node."""
    from olapflow.operators import join

    parents = t.orders.select("o_custkey").distinct()
    nested = join.nest_children(parents, t.orders, "o_custkey", ["o_orderkey", "o_orderstatus"], ["o_orderkey"], "items")
    inner = F.transform(
        "items",
        lambda x: join.xml_element(
            "order", {"key": x.o_orderkey}, F.concat(F.lit("<status>"), x.o_orderstatus, F.lit("</status>"))
        ),
    )
    docs = nested.select(
        "o_custkey", F.concat(F.lit("<doc><orders>"), F.array_join(inner, ""), F.lit("</orders></doc>")).alias("xml")
    )
    fields = {"o_orderkey": ("@key", "bigint"), "status": ("status", "string")}
    return files.read_xml_loop(docs, "xml", "/doc/orders/order", fields, keep=["o_custkey"])


def _count_after(t, mode, times=1):
    path = scratch_path(t.spark, "table")
    for _ in range(times):
        tables.write_table(t.nation, path, mode)
    return t.spark.read.parquet(path).groupBy("n_regionkey").agg(F.count("*").alias("n"))


@query("a07_table_append", "SELECT n_regionkey, 2 * count(*) AS n FROM nation GROUP BY 1")
def a07(t):
    return _count_after(t, "append", 2)


@query("a07_table_truncate", "SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def a07_truncate(t):
    return _count_after(t, "truncate", 2)


@query("a07_table_fail_if_not_empty", "SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def a07_fail(t):
    return _count_after(t, "fail_if_not_empty")


@query("a08_atomic_insert", "SELECT count(*) AS n FROM orders")
def a08(t):
    path = scratch_path(t.spark, "atomic")
    tables.write_atomic(t.orders, path, {"key": F.col("o_orderkey").isNotNull(), "price": F.col("o_totalprice") >= 0})
    return t.spark.read.parquet(path).agg(F.count("*").alias("n"))


@query("a09_delimited_sink", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def a09(t):
    path = scratch_path(t.spark, "flags")
    counts = t.lineitem.groupBy("l_returnflag").agg(F.count("*").alias("n"))
    files.write_delimited(counts, path, single_file=True)
    return files.read_delimited(t.spark, path, "l_returnflag string, n bigint")


@query("a10_parquet_round_trip", """
SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""")
def a10(t):
    path = scratch_path(t.spark, "orders-parquet")
    files.write_parquet(t.orders, path, ["o_orderstatus"])
    return files.read_parquet(t.spark, path).where("o_orderstatus <> 'P'").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("a11_json_rows", """SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}' AS json FROM nation""")
def a11(t):
    return files.to_json_rows(t.nation.select("n_nationkey", "n_name"))


@query("a11_json_document", """
WITH j AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS i, '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS j FROM orders)
SELECT 0::BIGINT AS line_no, '[' AS line UNION ALL SELECT i, CASE WHEN i > 1 THEN ',' ELSE '' END || j FROM j
UNION ALL SELECT (SELECT count(*) FROM orders) + 1, ']'""")
def a11_document(t):
    return files.to_json_document(t.orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"])


@query("a11_json_blocks", """
WITH j AS (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS b, o_orderkey, '{"o_orderkey":' || o_orderkey || '}' AS j FROM orders)
SELECT b AS block_no, '[' || string_agg(j, ',' ORDER BY o_orderkey) || ']' AS json FROM j GROUP BY b""")
def a11_blocks(t):
    return files.to_json_blocks(t.orders.select("o_orderkey"), ["o_orderkey"], 100)


@query("a12_xml_sink", "SELECT p_partkey, p_name, p_size FROM part")
def a12(t):
    path = scratch_path(t.spark, "part-xml")
    files.write_xml(t.part.select("p_partkey", "p_name", "p_size"), path, "part", "parts")
    reader = t.spark.read.format("xml").option("rowTag", "part").schema("p_partkey bigint, p_name string, p_size int")
    return reader.load(path)


@query("a12_xml_rows")
def a12_rows(t):
    return files.to_xml_rows(t.nation, "nation")


@query("a13_kafka_records_decoded", "SELECT CAST(event_id AS VARCHAR) AS key, event_type AS message, user_id % 4 AS partition FROM events")
def a13(t):
    raw = t.events.select(
        F.encode(F.col("event_id").cast("string"), "UTF-8").alias("key"),
        F.encode("event_type", "UTF-8").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 4).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )
    return messages.decode_kafka(raw).select("key", "message", "partition")


@query("a14_kafka_rows", """
SELECT CAST(user_id AS VARCHAR) AS key, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS value FROM events""")
def a14(t):
    return messages.to_kafka_rows(t.events, F.col("user_id"), F.to_json(F.struct("event_id", "event_type")))


@query("a15_new_file_ingestion", SQL_ORDERS)
def a15(t):
    path = scratch_path(t.spark, "arrivals")
    orders = _orders(t)
    for status in ("O", "F", "P"):  # each landing is loaded once, by its own run
        files.write_delimited(orders.where(F.col("o_orderstatus") == status), f"{path}/in", mode="append")
        run = batches.ingest_new_files(t.spark, f"{path}/in", ORDER_SCHEMA, f"{path}/out", f"{path}/checkpoint")
        run.awaitTermination()
    out = t.spark.read.parquet(f"{path}/out").drop("source_file")
    return out.withColumn("o_orderdate", iso_day("o_orderdate"))


@query("a16_pending_files", r"""
WITH f AS (SELECT p_partkey, p_size, CASE WHEN p_type = 'ECONOMY' THEN 'readme_' ELSE '' END || p_partkey || '_' || replace(p_name, ' ', '_') || '.sql' AS filename FROM part)
SELECT filename, CAST(regexp_extract(filename, '^([0-9]+)_.+', 1) AS BIGINT) AS version FROM f
WHERE regexp_matches(filename, '^([0-9]+)_.+') AND filename NOT IN (SELECT filename FROM f WHERE p_size < 25)""")
def a16(t):
    prefix = F.when(F.col("p_type") == "ECONOMY", "readme_").otherwise("")
    name = F.concat(prefix, F.col("p_partkey").cast("string"), F.lit("_"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".sql"))
    listing = t.part.select(name.alias("filename"), "p_size")
    done = listing.where("p_size < 25")
    return tables.pending_files(listing.drop("p_size"), done, "^([0-9]+)_.+")


@query("a17_document_sink", """
SELECT 'people' AS index, CAST(c_custkey AS VARCHAR) AS id, '{"key":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}' AS document
FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def a17(t):
    key = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey"))
    good, _ = messages.to_documents(t.customer.select(key.alias("key"), "c_mktsegment"), "people", "key")
    return good


@query("a17_rejected_documents", "SELECT c_mktsegment, 'no id' AS reason FROM customer WHERE c_mktsegment = 'BUILDING'")
def a17_bad(t):
    key = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey"))
    _, bad = messages.to_documents(t.customer.select(key.alias("key"), "c_mktsegment"), "people", "key")
    return bad.select("c_mktsegment", "reason")


@query("a17_document_stream", """
SELECT 'people' AS index, CAST(c_custkey AS VARCHAR) AS id, 'documents' AS went_to FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT NULL, NULL, 'rejected' FROM customer WHERE c_mktsegment = 'BUILDING'""")
def a17_stream(t):
    """Documents and rejected rows of a stream, each in its own folder."""
    path, key = scratch_path(t.spark, "documents"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey"))
    fed = t.stream("customer").select(key.alias("key"), "c_mktsegment")
    batches.for_each_batch(fed, messages.document_writer(path, "people", "key"), f"{path}/checkpoint").awaitTermination()
    good = t.spark.read.parquet(f"{path}/documents").select("index", "id", F.lit("documents").alias("went_to"))
    none = F.lit(None).cast("string")
    return good.union(t.spark.read.parquet(f"{path}/rejected").select(none, none, F.lit("rejected")))


PROFILED = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "note": "string"}


def _noted(t):
    note = F.when(F.col("o_totalprice") > 300000, F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", note.alias("note"))


@query("a18_profile", "WITH x AS (SELECT *, CASE WHEN o_totalprice > 300000 THEN o_orderpriority END AS note FROM orders) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST({i} AS INTEGER) AS position, '{k}' AS type, count(*) AS rows, count(*) - count({c}) AS nulls, "
    f"count(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS minimum, CAST(max({c}) AS VARCHAR) AS maximum FROM x"
    for i, (c, k) in enumerate(PROFILED.items())).replace("AS column", "AS \"column\""))
def a18(t):
    return tables.profile(_noted(t), exact=list(PROFILED))


@query("a18_profile_approx", "WITH x AS (SELECT *, CASE WHEN o_totalprice > 300000 THEN o_orderpriority END AS note FROM orders) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST({i} AS INTEGER) AS position, '{k}' AS type, count(*) AS rows, count(*) - count({c}) AS nulls, "
    f"true AS within_error, CAST(min({c}) AS VARCHAR) AS minimum, CAST(max({c}) AS VARCHAR) AS maximum FROM x"
    for i, (c, k) in enumerate(PROFILED.items())).replace("AS column", "AS \"column\""))
def a18_approx(t):
    """Sketches of twelve parts of the orders, merged, against exact counts."""
    df = _noted(t)
    parts = tables.sketches(df.withColumn("part", F.col("o_orderkey") % 12), ["part"])
    sketched = tables.profile_of(tables.merge_sketches(parts), df.schema)
    exact = tables.profile(df, exact=list(PROFILED)).select("column", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= tables.SKETCH_ERROR * F.col("exact")
    return sketched.join(exact, "column").withColumn("within_error", near).drop("distinct_values", "exact")


@query("a19_inline_rows", """
SELECT label, count(*) AS n FROM orders JOIN (VALUES ('O', 'open'), ('F', 'finished'), ('P', 'partial')) v(code, label) ON o_orderstatus = code GROUP BY 1""")
def a19(t):
    grid = tables.inline(t.spark, [("O", "open"), ("F", "finished"), ("P", "partial")], "o_orderstatus string, label string")
    return t.orders.join(grid, "o_orderstatus").groupBy("label").agg(F.count("*").alias("n"))


@query("a20_related_tables", "SELECT 3 * count(*) AS orders, CAST(0 AS BIGINT) AS orphans FROM customer")
def a20_related(t):
    """Synthetic users and orders, as many as there are customers; every order finds its user."""
    n = t.customer.count()
    made = tables.generate_tables(t.spark, {
        "users": (n, {"user_id": ("id",), "tier": ("enum", ["gold", "silver"])}),
        "orders": (3 * n, {"order_id": ("id",), "user_id": ("ref", "users")}),
    })
    found = made["orders"].join(made["users"].withColumn("known", F.lit(1)), "user_id", "left")
    return found.agg(F.count("*").alias("orders"), F.count_if(F.col("known").isNull()).alias("orphans"))


@query("a20_generated_fields", "SELECT c_custkey, 1 AS fits FROM customer")
def a20(t):
    """Synthetic attributes for every customer, with a reference drawn from as many accounts."""
    ids = t.customer.select(F.col("c_custkey").alias("id"))
    fields = {"c_custkey": ("id",), "tier": ("enum", ["gold", "silver", "bronze"]), "age": ("range", 18, 90), "account": ("ref", 1000)}
    fits = F.expr("tier IN ('gold', 'silver', 'bronze') AND age BETWEEN 18 AND 90 AND account BETWEEN 0 AND 999")
    return tables.generate_fields(ids, fields).select("c_custkey", fits.cast("int").alias("fits"))


@query("a21_properties_to_variables", """
SELECT max(r_regionkey) FILTER (r_name = 'ASIA') AS "ASIA", max(r_regionkey) FILTER (r_name = 'EUROPE') AS "EUROPE" FROM region""")
def a21(t):
    return tables.read_properties(t.region, "r_name", "r_regionkey", ["ASIA", "EUROPE"])


@query("a22_named_service", """
SELECT c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '2000-01-01' GROUP BY 1""")
def a22(t):
    tables.register_service(t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")), "customer_orders")
    return t.spark.sql(
        "SELECT c_mktsegment, count(*) AS n FROM customer_orders WHERE o_orderdate >= timestamp_ntz'2000-01-01 00:00:00' GROUP BY c_mktsegment"
    )


@query("a23_blended_services", """
SELECT c_custkey, c_name, events, orders FROM customer
JOIN (SELECT user_id, count(*) AS events FROM events GROUP BY 1) ON user_id = c_custkey
JOIN (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def a23(t):
    path = scratch_path(t.spark, "visits-json")
    t.events.select("user_id", "event_type").write.json(path)
    visits = files.read_json(t.spark, path, "user_id bigint, event_type string")
    visits = visits.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("events"))
    tables.register_service(visits, "visit_service")
    bought = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    tables.register_service(bought, "order_service")
    both = tables.blend(t.spark, "visit_service", "order_service", ["c_custkey"])
    return t.customer.select("c_custkey", "c_name").join(both, "c_custkey")


# ---------------------------------------------------------------- functions and checks


@query("u01_row_function", "SELECT c_custkey, c_acctbal * 2 AS doubled FROM customer")
def u01(t):
    def double(pdf):
        return pdf.assign(doubled=pdf.c_acctbal * 2)[["c_custkey", "doubled"]]

    return udf.map_rows(t.customer.select("c_custkey", "c_acctbal"), double, "c_custkey bigint, doubled double")


@query("u02_rows_function", "SELECT p_partkey, unnest(range(p_size)) AS copy FROM part")
def u02(t):
    def copies(pdf):
        out = pdf.loc[pdf.index.repeat(pdf.p_size)]
        return out.assign(copy=out.groupby("p_partkey").cumcount())[["p_partkey", "copy"]]

    return udf.flat_map_rows(t.part.select("p_partkey", "p_size"), copies, "p_partkey bigint, copy bigint")


@query("u04_custom_window_aggregate", """
SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS window_start, event_type, count(*) AS n, max(value) - min(value) AS spread
FROM events GROUP BY 1, 2""")
def u04(t):
    def reduce_batch(pdf):
        grouped = pdf.groupby(["window_start", "event_type"], as_index=False)
        return grouped.agg(n=("value", "size"), lo=("value", "min"), hi=("value", "max"))

    out = udf.apply_window(
        t.events.select("ts", "event_type", "value"), "ts", "1 day", ["event_type"], reduce_batch,
        "window_start timestamp_ntz, event_type string, n bigint, lo double, hi double",
        [F.sum("n").alias("n"), (F.max("hi") - F.min("lo")).alias("spread")],
    )
    return out.withColumn("window_start", iso_day("window_start"))


@query("u05_registered_sql_functions", """
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS key, CASE WHEN o_custkey <> 0 THEN o_totalprice / o_custkey END AS share FROM orders""")
def u05(t):
    udf.register_functions(t.spark)
    return t.orders.select(
        "o_orderkey",
        F.expr("date_key_of(cast(o_orderdate AS date))").alias("key"),
        F.expr("safe_ratio(o_totalprice, cast(o_custkey AS double))").alias("share"),
    )


@query("u06_function_per_group", """
SELECT user_id, (i - 1) // 20 AS block_no, count(*) AS n, arg_min(event_id, i) AS first_event, arg_max(event_id, i) AS last_event
FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events) GROUP BY 1, 2""")
def u06(t):
    import pandas as pd

    def summarise(pdf):
        user, no, event = pdf["user_id"], pdf["block_no"], pdf["event_id"]
        row = {"user_id": user.iat[0], "block_no": no.iat[0], "n": len(pdf), "first_event": event.iat[0], "last_event": event.iat[-1]}
        return pd.DataFrame(row, index=[0])

    return udf.per_group(
        t.events.select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"], summarise,
        "user_id bigint, block_no bigint, n bigint, first_event bigint, last_event bigint", block=20,
    )


SQL_CHECKED = """c AS (SELECT o_orderkey, o_totalprice >= 50000 AS a, nullif(o_orderstatus, 'P') IN ('O', 'F') AS b FROM orders)"""


def _checked(t):
    df = t.orders.withColumn("s", F.nullif("o_orderstatus", F.lit("P")))
    return quality.with_errors(df, {"price": F.col("o_totalprice") >= 50000, "status": F.col("s").isin("O", "F")})


@query("u07_rows_without_errors", f"WITH {SQL_CHECKED} SELECT o_orderkey FROM c WHERE a AND b")
def u07(t):
    good, _ = _checked(t)
    return good.select("o_orderkey")


@query("u07_rows_with_errors", f"""WITH {SQL_CHECKED}
SELECT o_orderkey, CAST((NOT a)::INT + (NOT coalesce(b, false))::INT AS INTEGER) AS error_count,
       concat_ws(',', CASE WHEN NOT a THEN 'price' END, CASE WHEN NOT coalesce(b, false) THEN 'status' END) AS error_codes
FROM c WHERE NOT (a AND coalesce(b, false))""")
def u07_bad(t):
    _, bad = _checked(t)
    return bad.select("o_orderkey", "error_count", "error_codes")


@query("u08_golden_diff", """
WITH a AS (SELECT p_brand, p_size FROM part WHERE p_size > 3), g AS (SELECT p_brand, p_size FROM part WHERE p_size < 48),
u AS (SELECT *, 1 AS s FROM a UNION ALL SELECT *, -1 FROM g)
SELECT p_brand AS brand, p_size AS size, CAST(sum(s) AS BIGINT) AS surplus FROM u GROUP BY 1, 2 HAVING sum(s) <> 0""")
def u08(t):
    actual = t.part.where("p_size > 3").select("p_brand", "p_size")
    golden = t.part.where("p_size < 48").select(F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    return quality.golden_diff(actual, golden, {"p_brand": "brand", "p_size": "size"})


@query("u08_conservation_check", """
SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS a, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS b, CAST(1 AS INTEGER) AS equal FROM orders""")
def u08_conserved(t):
    whole = t.orders.agg(F.sum(money("o_totalprice")).alias("v"))
    parts = t.orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("v")).agg(F.sum("v").alias("v"))
    out = quality.conserved(whole, parts, "v")
    return out.select(F.col("a").cast("double"), F.col("b").cast("double"), F.col("equal").cast("int"))


@query("u12_chosen_partitioning", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1")
def u12(t):
    return udf.repartition_by(t.lineitem.select("l_suppkey"), 16, "l_suppkey").groupBy("l_suppkey").agg(F.count("*").alias("n"))
