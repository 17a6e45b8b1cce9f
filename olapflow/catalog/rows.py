"""Projections, filters, text, JSON, dates and cloning."""

from pyspark.sql import functions as F

from olapflow.catalog.base import iso_day, query
from olapflow.functions import dates
from olapflow.operators import shape
from olapflow.plans import dims

def _day():
    return F.to_date("o_orderdate")


@query("b01_select_values", """
SELECT l_orderkey AS order_key, l_linenumber AS line, CAST(l_quantity AS INTEGER) AS qty,
       l_returnflag, l_linestatus, l_partkey, l_suppkey, TRY_CAST(l_returnflag AS INTEGER) AS flag_as_int
FROM lineitem""")
def b01(t):
    df = t.lineitem.withColumn("flag_as_int", F.col("l_returnflag"))
    return shape.select_values(
        df,
        rename={"l_orderkey": "order_key", "l_linenumber": "line", "l_quantity": "qty"},
        remove=["l_extendedprice", "l_discount", "l_tax", "l_shipdate"],
        cast={"l_quantity": "int", "flag_as_int": "int"},
    )


@query("b02_column_arithmetic", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 2 AS double_qty,
       l_extendedprice * (1 - l_discount) AS net FROM lineitem""")
def b02(t):
    df = shape.with_expr(
        t.lineitem,
        double_qty="l_quantity * 2",
        net="l_extendedprice * (1 - l_discount)",
    )
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "double_qty", "net")


@query("b03_date_key", """
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
       strftime(o_orderdate, '%Y-%m-%d') AS back FROM orders""")
def b03(t):
    key = dates.date_key(iso_day("o_orderdate"))
    return t.orders.select("o_orderkey", key.alias("date_key"), iso_day(dates.key_date(key)).alias("back"))


@query("b04_split_rows", """
SELECT o_orderkey, CASE WHEN (o_totalprice > 200000 AND contains(o_orderpriority, 'URGENT')) OR s IS NULL
                        THEN 'hit' ELSE 'miss' END AS output
FROM (SELECT *, nullif(o_orderstatus, 'P') AS s FROM orders)""")
def b04(t):
    df = t.orders.withColumn("s", F.nullif("o_orderstatus", F.lit("P")))
    cond = ((F.col("o_totalprice") > 200000) & F.contains("o_orderpriority", F.lit("URGENT"))) | F.col("s").isNull()
    hit, miss = shape.split_rows(df, cond)
    out = hit.withColumn("output", F.lit("hit")).unionByName(miss.withColumn("output", F.lit("miss")))
    return out.select("o_orderkey", "output")


@query("b04_null_goes_to_miss", """
SELECT o_orderkey, CASE WHEN s = 'O' THEN 'hit' ELSE 'miss' END AS output
FROM (SELECT *, nullif(o_orderstatus, 'P') AS s FROM orders)""")
def b04_null(t):
    df = t.orders.withColumn("s", F.nullif("o_orderstatus", F.lit("P")))
    hit, miss = shape.split_rows(df, F.col("s") == "O")
    out = hit.withColumn("output", F.lit("hit")).unionByName(miss.withColumn("output", F.lit("miss")))
    return out.select("o_orderkey", "output")


@query("b05_adjust_when", """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag,
       CASE WHEN l_returnflag = 'R' THEN l_quantity + 2 ELSE l_quantity END AS l_quantity FROM lineitem""")
def b05(t):
    df = shape.adjust_when(t.lineitem, F.col("l_returnflag") == "R", "l_quantity", F.col("l_quantity") + 2)
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity")


@query("b06_route", """
SELECT CASE event_type WHEN 'view' THEN 'reading' WHEN 'click' THEN 'reading'
                       WHEN 'purchase' THEN 'buying' ELSE 'rest' END AS output, count(*) AS n
FROM events GROUP BY 1""")
def b06(t):
    outputs = shape.route(
        t.events, "event_type", {"view": "reading", "click": "reading", "purchase": "buying"}, "rest"
    )
    parts = [df.groupBy(F.lit(name).alias("output")).agg(F.count("*").alias("n")) for name, df in outputs.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("b07_calculator", """
SELECT o_orderkey, CAST(100 AS INTEGER) AS base, o_totalprice + 100 AS raised,
       (o_totalprice + 100) / nullif(o_custkey, 0) AS per_customer FROM orders""")
def b07(t):
    steps = {
        "base": F.lit(100),
        "raised": F.col("o_totalprice") + F.col("base"),
        "per_customer": shape.ratio(F.col("o_totalprice") + F.col("base"), F.col("o_custkey")),
    }
    return shape.calc(t.orders, steps).select("o_orderkey", *steps)


@query("b08_expression_flag", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS is_building FROM customer""")
def b08(t):
    return shape.flag(t.customer, "is_building", "c_mktsegment = 'BUILDING'").select("c_custkey", "is_building")


@query("b09_null_replacement", """
SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def b09(t):
    df = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return shape.if_null(df, {"quality": -1, "toxic": -1})


@query("b10_value_mapper", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'finished' ELSE 'other' END AS status FROM orders""")
def b10(t):
    out = shape.map_values(t.orders, "o_orderstatus", {"O": "open", "F": "finished"}, "other", "status")
    return out.select("o_orderkey", "status")


@query("b11_regex_fields", """
SELECT p_partkey, p_brand, CASE WHEN regexp_matches(p_brand, '^Brand#([0-9])([0-9]*)$') THEN 1 ELSE 0 END AS matches,
       TRY_CAST(regexp_extract(p_brand, '^Brand#([0-9])([0-9]*)$', 1) AS INTEGER) AS maker,
       regexp_extract(p_brand, '^Brand#([0-9])([0-9]*)$', 2) AS line FROM part""")
def b11(t):
    out = shape.regex_fields(t.part, "p_brand", "^Brand#([0-9])([0-9]*)$", {"maker": "int", "line": "string"})
    return out.select("p_partkey", "p_brand", "matches", "maker", "line")


@query("b12_concat_fields", """
SELECT n_nationkey, n_name || ';' || n_regionkey || ';' AS line FROM nation""")
def b12(t):
    df = t.nation.withColumn("note", F.lit(None).cast("string"))
    return shape.concat_fields(df, ["n_name", "n_regionkey", "note"], ";", "line").select("n_nationkey", "line")


@query("b13_word_count", r"""
SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^0-9A-Za-z_]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def b13(t):
    return shape.word_count(t.documents, "text")


@query("b13_tokenize", r"""
SELECT conv_id, turn, word FROM (
  SELECT conv_id, turn, unnest(regexp_split_to_array(lower(text), '[^0-9A-Za-z_]+')) AS word FROM conversations)
WHERE word <> ''""")
def b13_tokenize(t):
    return shape.tokenize(t.conversations, "text", keep=["conv_id", "turn"])


@query("b14_split_to_rows", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part""")
def b14(t):
    return shape.split_to_rows(t.part, "p_name", " ", "word").select("p_partkey", "word")


@query("b15_add_sequence", """
SELECT event_id, row_number() OVER (ORDER BY ts, event_id) + 99 AS seq FROM events""")
def b15(t):
    return shape.add_sequence(t.events, ["ts", "event_id"], start=100).select("event_id", "seq")


@query("b15_sequence_per_key", """
SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS seq FROM orders""")
def b15_per_key(t):
    from olapflow.operators.window import row_index

    chunk = F.date_trunc("year", F.col("o_orderdate"))
    out = row_index(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "seq", chunk=chunk)
    return out.select("o_custkey", "o_orderkey", "seq")


@query("b16_uuid_and_random", "SELECT c_custkey, 36 AS uuid_length, 1 AS in_range FROM customer")
def b16(t):
    df = shape.add_random(shape.add_uuid(t.customer), ["c_custkey"], seed=7)
    return df.select("c_custkey", F.length("uuid").alias("uuid_length"), F.expr("int(random >= 0 AND random < 1)").alias("in_range"))


@query("b17_audit_columns", "SELECT n_nationkey, 'nation' AS source, 1 AS batch, 1 AS ok FROM nation")
def b17(t):
    df = shape.add_audit(t.nation, source="nation", batch=1)
    return df.select("n_nationkey", "source", "batch", (F.col("load_time") > F.lit("2020-01-01")).cast("int").alias("ok"))


@query("b18_calendar_fields", """
SELECT o_orderkey, year(d) AS the_year, quarter(d) AS the_quarter, month(d) AS the_month, day(d) AS the_day,
       isoyear(d) AS iso_year, week(d) AS iso_week, isodow(d) AS iso_day, isoyear(d) * 100 + week(d) AS iso_week_key,
       'Q' || quarter(d) AS quarter_caption, strftime(d, '%b') AS month_caption, strftime(d, '%a') AS day_caption,
       CAST(isodow(d) < 6 AS BIGINT) AS is_working_day
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def b18(t):
    fields = dates.calendar_fields(_day())
    text = ["quarter_caption", "month_caption", "day_caption"]
    numbers = "the_year the_quarter the_month the_day iso_year iso_week iso_day iso_week_key is_working_day".split()
    return t.orders.select(
        "o_orderkey",
        *[fields[n].cast("bigint").alias(n) for n in numbers],
        *[fields[n].alias(n) for n in text],
    )


@query("b19_date_difference", """
SELECT event_id, date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') AS days,
       ((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts)) // 1000000) / CAST(86400 AS DOUBLE) AS fractional,
       strftime(CAST(ts AS DATE) + CAST(user_id AS INTEGER), '%Y-%m-%d') AS moved FROM events""")
def b19(t):
    end = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return t.events.select(
        "event_id",
        dates.days_between(F.to_date("ts"), F.lit("2024-01-31").cast("date")).cast("bigint").alias("days"),
        dates.fractional_days_between(F.col("ts"), end).alias("fractional"),
        iso_day(dates.add_days(F.to_date("ts"), F.col("user_id").cast("int"))).alias("moved"),
    )


@query("b20_relative_date_key", """
SELECT o_orderkey, CAST(strftime(CAST(o_orderdate AS DATE) - 30, '%Y%m%d') AS INTEGER) AS key_30_days_before FROM orders""")
def b20(t):
    return t.orders.select("o_orderkey", dates.date_key_offset(_day(), -30).alias("key_30_days_before"))


@query("b21_working_days", """
WITH cal AS (SELECT d, sum(CASE WHEN isodow(d) < 6 THEN 1 ELSE 0 END) OVER (ORDER BY d) AS no
             FROM (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem), INTERVAL 1 DAY)) AS DATE) AS d)),
s AS (SELECT l_orderkey, max(l_shipdate) AS ship FROM lineitem GROUP BY 1)
SELECT o_orderkey, CAST(b.no - a.no AS BIGINT) AS working_days
FROM orders JOIN s ON o_orderkey = l_orderkey
LEFT JOIN cal a ON a.d = CAST(o_orderdate AS DATE) LEFT JOIN cal b ON b.d = CAST(ship AS DATE)""")
def b21(t):
    first = t.orders.agg(F.min(F.to_date("o_orderdate")).alias("lo"))
    last = t.lineitem.agg(F.max(F.to_date("l_shipdate")).alias("hi"))
    calendar = dims.add_working_days(dims.date_dim_of(first.withColumn("hi", last.scalar()), "lo", "hi"))
    ship = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max(F.to_date("l_shipdate")).alias("ship"))
    spans = t.orders.select("o_orderkey", _day().alias("placed")).join(ship, "o_orderkey")
    return dims.working_days_between(spans, "placed", "ship", calendar).select("o_orderkey", "working_days")


@query("b22_time_zones", """
SELECT event_id, strftime(timezone('America/New_York', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') AS new_york,
       strftime(timezone('UTC', timezone('Asia/Tokyo', ts)), '%Y-%m-%d %H:%M:%S') AS read_as_tokyo FROM events""")
def b22(t):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    pattern = "yyyy-MM-dd HH:mm:ss"
    return t.events.select(
        "event_id",
        F.date_format(dates.to_zone(dates.parse_ts(text, pattern), "America/New_York"), pattern).alias("new_york"),
        F.date_format(dates.parse_ts(text, pattern, "Asia/Tokyo"), pattern).alias("read_as_tokyo"),
    )


@query("b23_parse_long_timestamp", """
SELECT event_id, epoch_ms(date_trunc('second', ts)) - 7200000 AS millis FROM events""")
def b23(t):
    text = F.date_format(F.col("ts"), "EEE MMM dd HH:mm:ss '+0200' yyyy")
    return t.events.select("event_id", dates.parse_long_ts(text).alias("millis"))


@query("b24_epoch_seconds", """
SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS seconds,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS back FROM events""")
def b24(t):
    seconds = dates.to_epoch_seconds(F.col("ts"))
    back = F.date_format(dates.from_epoch_seconds(seconds), "yyyy-MM-dd HH:mm:ss")
    return t.events.select("event_id", seconds.alias("seconds"), back.alias("back"))


@query("b25_format_duration", """
WITH s AS (SELECT o_orderkey, o_orderkey * 977 AS sec FROM orders),
p AS (SELECT *, sec // 604800 AS w, (sec // 86400) % 7 AS d, (sec // 3600) % 24 AS h, (sec // 60) % 60 AS m, sec % 60 AS s FROM s)
SELECT o_orderkey, CASE WHEN sec = 0 THEN '0sec' ELSE concat_ws(' ',
  CASE WHEN w <> 0 THEN w || 'w' END, CASE WHEN d <> 0 THEN d || 'd' END, CASE WHEN h <> 0 THEN h || 'h' END,
  CASE WHEN m <> 0 THEN m || 'min' END, CASE WHEN s <> 0 THEN s || 'sec' END) END AS duration FROM p""")
def b25(t):
    seconds = F.col("o_orderkey") * 977
    return t.orders.select("o_orderkey", dates.format_duration(seconds).alias("duration"))


@query("b26_zip_lists_to_structs", """
SELECT p_partkey, '[' || string_agg('{"word":"' || w || '","size":"' || s || '","in_type":' ||
       CASE WHEN w IN ('red', 'small') THEN 'true' ELSE 'false' END || '}', ',' ORDER BY i) || ']' AS items
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, unnest([CAST(p_size AS VARCHAR), CAST(p_size + 1 AS VARCHAR)]) AS s,
             unnest([1, 2]) AS i FROM part) GROUP BY p_partkey""")
def b26(t):
    df = t.part.select(
        "p_partkey",
        F.replace("p_name", F.lit(" "), F.lit(",")).alias("names"),
        F.concat_ws(",", "p_size", F.col("p_size") + 1).alias("sizes"),
        F.lit("red,small").alias("chosen"),
    )
    out = shape.zip_lists_to_structs(df, "items", {"word": "names", "size": "sizes"}, members={"in_type": "chosen"})
    return out.select("p_partkey", F.to_json("items").alias("items"))


@query("b27_append_document", """
SELECT event_id, '[' || CASE WHEN event_type = 'click' THEN props || ',' ELSE '' END || '{"k":' || user_id || '}]' AS doc
FROM (SELECT event_id, user_id, event_type, replace(props, ': ', ':') AS props FROM events)""")
def b27(t):
    old = F.when(F.col("event_type") == "click", F.concat(F.lit("["), F.col("props"), F.lit("]")))
    df = t.events.withColumn("doc", old)
    return shape.append_document(df, "doc", "struct<k:bigint>", F.struct(F.col("user_id").alias("k"))).select("event_id", "doc")


@query("b28_json_to_pairs", """
SELECT event_id, unnest(json_keys(props)) AS key, json_extract_string(props, '$.k') AS value FROM events""")
def b28(t):
    return shape.json_to_pairs(t.events, "props", keep=["event_id"])


@query("b29_substitute_vars", """
SELECT c_custkey, c_name || ' in ' || r_name || ' of ${' || c_mktsegment || '} for $5' AS text
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def b29(t):
    text = F.concat(
        "c_name", F.lit(" in ${NATION_"), F.col("c_nationkey").cast("string"), F.lit("} of ${"), "c_mktsegment",
        F.lit("} for $5"),
    )
    names = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    names = names.select(F.col("n_name").alias("name"), F.col("r_name").alias("value"))
    return shape.substitute_vars(t.customer.select("c_custkey", text.alias("text")), "text", names)


@query("b31_row_to_json", """
SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS json FROM events""")
def b31(t):
    return shape.row_to_json(t.events, ["event_id", "user_id", "event_type"])


@query("d01_clone_fixed", "SELECT c_custkey FROM customer, range(2)")
def d01(t):
    return shape.clone_rows(t.customer.select("c_custkey"), 2)


@query("d02_clone_conditionally", """
SELECT c_custkey, c_mktsegment FROM customer, range(2) r(i) WHERE i < CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 2 END""")
def d02(t):
    times = F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(2)
    return shape.clone_rows(t.customer.select("c_custkey", "c_mktsegment"), times)


@query("d03_clone_by_column", """
SELECT p_partkey, CAST(i AS INTEGER) AS clone_no FROM part, range(60) r(i) WHERE i < p_size - 10""")
def d03(t):
    df = t.part.select("p_partkey", (F.col("p_size") - 10).alias("n"))
    return shape.clone_rows(df, "n", "clone_no").select("p_partkey", "clone_no")


@query("d04_clone_by_repeat", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem, range(7) r(i) WHERE i < l_linenumber""")
def d04(t):
    return shape.clone_rows(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_linenumber")


@query("d05_clone_number_to_date", """
SELECT p_partkey, strftime(DATE '2024-01-01' + CAST(i AS INTEGER), '%Y-%m-%d') AS day FROM part, range(60) r(i) WHERE i < p_size""")
def d05(t):
    df = shape.clone_rows(t.part.select("p_partkey", "p_size"), "p_size", "i")
    return df.select("p_partkey", iso_day(F.date_add(F.lit("2024-01-01").cast("date"), F.col("i"))).alias("day"))


@query("d06_flatten_structs", """
SELECT n_nationkey, unnest(['name', 'region']) AS field, unnest([n_name, CAST(n_regionkey AS VARCHAR)]) AS value FROM nation""")
def d06(t):
    def pair(label, column):
        return F.struct(F.lit(label).alias("field"), F.col(column).cast("string").alias("value"))

    df = t.nation.select("n_nationkey", F.array(pair("name", "n_name"), pair("region", "n_regionkey")).alias("f"))
    return shape.flatten_rows(df, "f")


SQL_CALENDAR = """days AS (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d)"""


def _order_calendar(t):
    bounds = t.orders.agg(F.min(_day()).alias("lo"), F.max(_day()).alias("hi"))
    return dims.date_dim_of(bounds, "lo", "hi")


@query("g17_date_dimension", f"""WITH {SQL_CALENDAR}
SELECT strftime(d, '%Y-%m-%d') AS the_date, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, year(d) AS the_year,
       quarter(d) AS the_quarter, month(d) AS the_month, isoyear(d) AS iso_year, week(d) AS iso_week, isodow(d) AS iso_day FROM days""")
def g17(t):
    numbers = "date_key the_year the_quarter the_month iso_year iso_week iso_day".split()
    dim = _order_calendar(t)
    return dim.select(iso_day("the_date").alias("the_date"), *[F.col(c).cast("bigint").alias(c) for c in numbers])


@query("g18_date_level_attributes", f"""WITH {SQL_CALENDAR}
SELECT DISTINCT year(d) * 10 + quarter(d) AS quarter_key, 'Q' || quarter(d) AS quarter_caption,
       year(d) * 100 + month(d) AS month_key, strftime(d, '%b') AS month_caption, month(d) AS month_order FROM days""")
def g18(t):
    return (
        _order_calendar(t)
        .select(
            F.col("quarter_key").cast("bigint"),
            "quarter_caption",
            F.col("month_key").cast("bigint"),
            "month_caption",
            F.col("the_month").cast("bigint").alias("month_order"),
        )
        .distinct()
    )


@query("g17_role_playing_dates", f"""WITH {SQL_CALENDAR}
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS ship_date_key, month(d) AS ship_the_month FROM days""")
def g17_roles(t):
    role = dims.role_playing(_order_calendar(t), "ship")
    return role.select("ship_date_key", F.col("ship_the_month").cast("bigint"))


@query("g19_assign_keys_with_attributes", """
WITH f AS (SELECT c_mktsegment AS seg, min(c_nationkey) AS nation FROM customer GROUP BY 1)
SELECT CAST(7 AS BIGINT) AS sk, 'BUILDING' AS seg, CAST(-1 AS BIGINT) AS nation, 'old' AS note
UNION ALL SELECT 7 + row_number() OVER (ORDER BY seg), seg, nation, NULL FROM f WHERE seg <> 'BUILDING'""")
def g19_attributes(t):
    """Known members keep all their columns, new ones bring theirs."""
    incoming = t.customer.select(F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").cast("bigint").alias("nation"))
    dim = incoming.where("seg = 'BUILDING'").select(
        F.lit(7).cast("bigint").alias("sk"), "seg", F.lit(-1).cast("bigint").alias("nation"), F.lit("old").alias("note")
    ).distinct()
    return dims.assign_keys(dim, incoming, ["seg"], "sk", ["seg"], attributes=["nation"])


@query("g19_assign_keys", """
WITH known AS (SELECT DISTINCT c_nationkey AS nk, c_mktsegment AS seg FROM customer WHERE c_acctbal > 9000),
dim AS (SELECT nk, seg, row_number() OVER (ORDER BY nk, seg) AS sk FROM known),
fresh AS (SELECT DISTINCT c_nationkey AS nk, c_mktsegment AS seg FROM customer ANTI JOIN dim ON c_nationkey = nk AND c_mktsegment = seg)
SELECT nk, seg, sk FROM dim UNION ALL
SELECT nk, seg, row_number() OVER (ORDER BY nk, seg) + (SELECT max(sk) FROM dim) FROM fresh""")
def g19(t):
    def pairs(df):
        return df.select(F.col("c_nationkey").alias("nk"), F.col("c_mktsegment").alias("seg"))

    natural, rich = pairs(t.customer), pairs(t.customer.where("c_acctbal > 9000"))
    empty = natural.limit(0).select(F.lit(None).cast("bigint").alias("sk"), "nk", "seg")
    order = ["nk", "seg"]
    dim = dims.assign_keys(empty, rich, order, "sk", order, F.col("nk"))
    return dims.assign_keys(dim, natural, order, "sk", order, F.col("nk"))


@query("u03_sql_expression_step", """
SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN upper(o_orderpriority) ELSE lower(o_orderpriority) END AS label FROM orders""")
def u03(t):
    label = "if(o_totalprice > 250000, upper(o_orderpriority), lower(o_orderpriority))"
    return shape.with_expr(t.orders, label=label).select("o_orderkey", "label")


@query("a04_json_path_and_struct", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text FROM events""")
def a04(t):
    from olapflow.sources.files import from_json_struct

    parsed = from_json_struct(F.col("props"), "k bigint")
    return t.events.select(
        "event_id", parsed.getField("k").alias("k"), F.get_json_object("props", "$.k").alias("k_text")
    )


