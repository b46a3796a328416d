"""Projection, filter, row shaping (PRJ) and scalar functions (FN)."""

from pyspark.sql import functions as F

from corvid.functions import nested, parse, text
from corvid.operators import shape
from corvid.operators.joins import equi_join
from corvid.operators.windows import dense_index
from corvid.plans.registry import query
from corvid.sources.tables import Tables


@query("prj_select", sql="SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def prj_select(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_totalprice")


@query("prj_alias", sql="SELECT o_orderkey AS order_id, o_totalprice AS total FROM orders")
def prj_alias(spark, d):
    return Tables(spark, d).orders.select(F.expr("o_orderkey AS order_id"), F.expr("o_totalprice AS total"))


@query("prj_selectexpr", sql="SELECT *, (l_returnflag = l_linestatus) AS flags_equal FROM lineitem")
def prj_selectexpr(spark, d):
    return Tables(spark, d).lineitem.selectExpr("*", "(l_returnflag = l_linestatus) AS flags_equal")


@query("prj_withcolumn", sql="""
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
           l_quantity * l_extendedprice AS amount FROM lineitem""")
def prj_withcolumn(spark, d):
    return (Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
            .withColumn("amount", F.expr("l_quantity * l_extendedprice")))


@query("prj_flag", sql="""
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) > 50000 AS big_line
    FROM lineitem""")
def prj_flag(spark, d):
    return (Tables(spark, d).lineitem
            .select("l_orderkey", "l_linenumber",
                    F.expr("l_extendedprice * (1 - l_discount) > 50000").alias("big_line")))


@query("prj_rename", sql="SELECT c_custkey, c_name AS customer_name, c_nationkey FROM customer")
def prj_rename(spark, d):
    return (Tables(spark, d).customer.select("c_custkey", "c_name", "c_nationkey")
            .withColumnRenamed("c_name", "customer_name"))


@query("prj_rename_all", sql="""
    SELECT p_partkey AS partkey, p_name AS name, p_brand AS brand, p_type AS type,
           p_size AS size, p_retailprice AS retailprice FROM part""")
def prj_rename_all(spark, d):
    return shape.rename_all(Tables(spark, d).part, lambda c: shape.without_blanks(c).removeprefix("p_"))


@query("prj_drop", sql="SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def prj_drop(spark, d):
    return Tables(spark, d).customer.drop("c_acctbal")


@query("flt_sql", sql="SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 50000")
def flt_sql(spark, d):
    return Tables(spark, d).orders.filter("o_orderstatus = 'F' AND o_totalprice < 50000")


@query("flt_col", sql="SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def flt_col(spark, d):
    return Tables(spark, d).customer.filter(F.col("c_mktsegment") == "BUILDING")


@query("flt_null", sql="""
    SELECT c.c_custkey, c.c_name FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
    WHERE o.o_orderkey IS NULL""")
def flt_null(spark, d):
    t = Tables(spark, d)
    o = t.orders.select("o_custkey", "o_orderkey")
    j = equi_join(t.customer, o, "c_custkey", "o_custkey", "left")
    return j.where(F.col("o_orderkey").isNull()).select("c_custkey", "c_name")


@query("flt_even", sql="SELECT o_orderkey, o_orderkey * 2 AS doubled FROM orders WHERE o_orderkey % 2 = 0")
def flt_even(spark, d):
    return shape.even_keys(Tables(spark, d).orders, "o_orderkey").select(
        "o_orderkey", (F.col("o_orderkey") * 2).alias("doubled"))


@query("prj_flatmap", sql=r"""
    SELECT doc_id, word FROM (
      SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS word FROM documents)
    WHERE word <> ''""")
def prj_flatmap(spark, d):
    return Tables(spark, d).documents.select("doc_id", F.explode(text.tokens("text")).alias("word"))


@query("prj_distinct", sql="SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def prj_distinct(spark, d):
    return Tables(spark, d).lineitem.select("l_returnflag", "l_linestatus").distinct()


@query("prj_lit", sql="SELECT c_custkey, 'tpch' AS source, 1 AS version FROM customer")
def prj_lit(spark, d):
    return Tables(spark, d).customer.select("c_custkey", F.lit("tpch").alias("source"),
                                            F.lit(1).alias("version"))


@query("prj_derived", sql="""
    SELECT p_partkey, p_size, p_size > 25 AS is_large, 50 - p_size AS remaining,
           CASE WHEN p_size IS NULL THEN NULL WHEN p_size >= 40 THEN 'L' WHEN p_size >= 20 THEN 'M'
                ELSE 'S' END AS size_class
    FROM part""")
def prj_derived(spark, d):
    s = F.col("p_size")
    return Tables(spark, d).part.select(
        "p_partkey", "p_size", (s > 25).alias("is_large"), (F.lit(50) - s).alias("remaining"),
        F.when(s.isNull(), None).when(s >= 40, "L").when(s >= 20, "M").otherwise("S").alias("size_class"))


@query("prj_rowid", sql="SELECT row_number() OVER (ORDER BY o_orderkey) AS row_id, o_orderkey FROM orders")
def prj_rowid(spark, d):
    return dense_index(Tables(spark, d).orders.select("o_orderkey"), ["o_orderkey"], "row_id", start=1)


@query("flt_dropna", sql="""
    SELECT c.c_custkey, c.c_name, o.o_orderkey FROM customer c
    LEFT JOIN orders o ON c.c_custkey = o.o_custkey WHERE o.o_orderkey IS NOT NULL""")
def flt_dropna(spark, d):
    t = Tables(spark, d)
    j = equi_join(t.customer.select("c_custkey", "c_name"), t.orders.select("o_custkey", "o_orderkey"),
                  "c_custkey", "o_custkey", "left")
    return shape.drop_null_rows(j.select("c_custkey", "c_name", "o_orderkey"), "any")


@query("kv_keyby", sql="SELECT substr(p_name, 1, 1) AS k, p_name AS v FROM part")
def kv_keyby(spark, d):
    return shape.key_by(Tables(spark, d).part, F.substring("p_name", 1, 1), "p_name")


@query("kv_lookup", sql="SELECT c_name AS v FROM customer WHERE c_mktsegment = 'MACHINERY'")
def kv_lookup(spark, d):
    pairs = shape.key_by(Tables(spark, d).customer, F.col("c_mktsegment"), "c_name")
    return shape.lookup(pairs, "MACHINERY")


# ---- scalar functions -------------------------------------------------------------------

@query("fn_split_explode", sql="""
    SELECT word, count(*) AS n FROM (
      SELECT unnest(string_split(text, ' ')) AS word FROM conversations)
    GROUP BY word""")
def fn_split_explode(spark, d):
    words = Tables(spark, d).conversations.select(F.explode(F.split("text", " ")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query("fn_case", sql="SELECT c_custkey, lower(c_name) AS name_lc, upper(c_mktsegment) AS seg_uc FROM customer")
def fn_case(spark, d):
    return Tables(spark, d).customer.select("c_custkey", F.lower("c_name").alias("name_lc"),
                                            F.upper("c_mktsegment").alias("seg_uc"))


@query("fn_contains", sql="""
    SELECT doc_id, starts_with(text, 'The') AS starts_the, contains(text, 'data') AS has_data
    FROM documents""")
def fn_contains(spark, d):
    t = F.col("text")
    return Tables(spark, d).documents.select("doc_id", t.startswith("The").alias("starts_the"),
                                             t.contains("data").alias("has_data"))


@query("fn_length", sql="SELECT doc_id, CAST(length(text) AS INTEGER) AS len, n_chars FROM documents")
def fn_length(spark, d):
    return Tables(spark, d).documents.select("doc_id", F.length("text").alias("len"), "n_chars")


@query("fn_chars", sql="SELECT p_partkey, unnest(string_split(p_name, '')) AS ch FROM part")
def fn_chars(spark, d):
    return Tables(spark, d).part.select("p_partkey", F.explode(text.characters("p_name")).alias("ch"))


@query("fn_strip_punct", sql=r"""
    SELECT doc_id, md5(regexp_replace(text, '[^\p{L}\p{N}_ \t\n\x0B\f\r]', '', 'g')) AS clean_md5,
           CAST(length(regexp_replace(text, '[^\p{L}\p{N}_ \t\n\x0B\f\r]', '', 'g')) AS INTEGER) AS clean_len
    FROM documents""")
def fn_strip_punct(spark, d):
    c = text.strip_punct("text")
    return Tables(spark, d).documents.select("doc_id", F.md5(c).alias("clean_md5"),
                                             F.length(c).alias("clean_len"))


@query("fn_parse_pair", sql="""
    SELECT c_custkey, c_name AS key, c_acctbal AS value FROM customer""")
def fn_parse_pair(spark, d):
    line = F.concat_ws(",", "c_name", F.col("c_acctbal").cast("string"))
    return (Tables(spark, d).customer.select("c_custkey", parse.parse_pair(line).alias("p"))
            .select("c_custkey", "p.key", "p.value"))


@query("fn_format", sql="SELECT printf('%s is customer no. %06d', c_name, c_custkey) AS line FROM customer")
def fn_format(spark, d):
    return Tables(spark, d).customer.select(F.format_string("%s is customer no. %06d", "c_name", "c_custkey").alias("line"))


@query("fn_address", sql="""
    SELECT c.c_custkey, n.n_name AS city, r.r_name AS state
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey""")
def fn_address(spark, d):
    t = Tables(spark, d)
    addr = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", F.concat_ws(", ", "c_name", "n_name", "r_name").alias("address")))
    parts = F.split("address", ", ")
    return addr.select("c_custkey", F.try_element_at(parts, F.lit(-2)).alias("city"),
                       F.try_element_at(parts, F.lit(-1)).alias("state"))


@query("fn_to_timestamp", sql="SELECT o_orderkey, date_trunc('minute', o_orderdate) AS ts FROM orders")
def fn_to_timestamp(spark, d):
    o = Tables(spark, d).orders
    as_text = F.date_format("o_orderdate", "M/d/yyyy H:mm")
    return o.select("o_orderkey", parse.to_ts(as_text, "M/d/yyyy H:mm").alias("ts"))


@query("fn_date", sql="SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def fn_date(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("fn_month_year", sql="""
    SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def fn_month_year(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", F.month("o_orderdate").alias("month"),
                                          F.year("o_orderdate").alias("year"))


@query("fn_birth_year", sql="SELECT p_partkey, CAST(2024 - p_size AS INTEGER) AS birth_year FROM part")
def fn_birth_year(spark, d):
    return Tables(spark, d).part.select("p_partkey", parse.birth_year("p_size", "2024-06-30").alias("birth_year"))


@query("fn_arith", sql="""
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
           l_extendedprice * 0.2 AS points FROM lineitem""")
def fn_arith(spark, d):
    return Tables(spark, d).lineitem.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"),
        (F.col("l_extendedprice") * 0.2).alias("points"))


@query("fn_case_when", sql="""
    SELECT event_id, CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS buys,
           CASE WHEN event_type = 'click' THEN value ELSE 0 END AS sells FROM events""")
def fn_case_when(spark, d):
    e = Tables(spark, d).events
    return e.select("event_id",
                    F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0).alias("buys"),
                    F.expr("CASE WHEN event_type = 'click' THEN value ELSE 0 END").alias("sells"))


@query("fn_cast", sql="""
    SELECT c_custkey, decode(encode(c_name)) AS name_from_binary, CAST(c_custkey AS VARCHAR) AS key_text
    FROM customer""")
def fn_cast(spark, d):
    return Tables(spark, d).customer.select(
        "c_custkey", F.encode("c_name", "UTF-8").cast("string").alias("name_from_binary"),
        F.col("c_custkey").cast("string").alias("key_text"))


@query("fn_from_json", sql="SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def fn_from_json(spark, d):
    e = nested.parse_json(Tables(spark, d).events, "props", "k INT")
    return e.select("event_id", F.col("data.k").alias("k"))


@query("fn_to_json", sql="""
    SELECT c_custkey, json_object('c_custkey', c_custkey, 'c_name', c_name, 'c_nationkey', c_nationkey,
                                  'c_mktsegment', c_mktsegment) AS js FROM customer""")
def fn_to_json(spark, d):
    return Tables(spark, d).customer.select(
        "c_custkey", nested.json_of("c_custkey", "c_name", "c_nationkey", "c_mktsegment").alias("js"))


@query("fn_nested", sql="SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def fn_nested(spark, d):
    o = Tables(spark, d).orders.select(
        "o_orderkey", F.struct("o_custkey", "o_orderstatus").alias("info"))
    return nested.flatten_struct(o, "info", keep=["o_orderkey"])


@query("fn_explode_struct", sql="""
    SELECT o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_extendedprice
    FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
def fn_explode_struct(spark, d):
    from corvid.sources.documents import nested_orders
    t = Tables(spark, d)
    docs = nested_orders(t.orders, t.lineitem)
    items = nested.explode_items(docs, "items", ["o_orderkey", "o_custkey"])
    return items.select("o_orderkey", "o_custkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


@query("fn_array", sql="""
    SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dims, list_max(embedding) AS max_val,
           CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS n_pos,
           list_contains(embedding, CAST(0 AS FLOAT)) AS has_zero
    FROM embeddings""")
def fn_array(spark, d):
    e = F.col("embedding")
    return Tables(spark, d).embeddings.select(
        "vec_id", F.size(e).alias("dims"), F.array_max(e).alias("max_val"),
        F.size(F.filter(e, lambda x: x > 0)).alias("n_pos"),
        F.array_contains(e, F.lit(0.0).cast("float")).alias("has_zero"))


@query("fn_parse_ids", sql="""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderkey END AS invoice_no,
           o_custkey AS customer_id FROM orders""")
def fn_parse_ids(spark, d):
    """Identifiers exported as text: cancelled invoices carry a ``C`` prefix and customer ids
    a ``.0`` suffix. Parsed with try-casts: the prefixed ones become NULL, the rest bigint."""
    o = Tables(spark, d).orders
    raw = o.select("o_orderkey",
                   F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("C"), F.col("o_orderkey").cast("string")))
                   .otherwise(F.col("o_orderkey").cast("string")).alias("invoice_text"),
                   F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("customer_text"))
    return raw.select("o_orderkey", parse.to_int_id("invoice_text").alias("invoice_no"),
                      parse.to_int_id("customer_text").alias("customer_id"))
