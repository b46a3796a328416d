"""Sources and sinks (SRC, SNK): each query writes a whole table in a format to shared
scratch storage and reads it back through the operator under test."""

from pyspark.sql import functions as F

from corvid.functions.numeric import money
from corvid.operators import kv, shape
from corvid.operators.joins import dimension_with_counts
from corvid.operators.partition import at_least
from corvid.session import scratch_path
from corvid.sources import files
from corvid.plans.registry import query
from corvid.sources.tables import Tables

ORDERS_SCHEMA = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
                 "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")
LINEITEM_SCHEMA = ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                   "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                   "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ")
EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


@query("src_csv_header", sql="""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""")
def src_csv_header(spark, d):
    path = files.write_csv(Tables(spark, d).customer, scratch_path(spark, "csv-header"))
    return files.read_csv(spark, path, header=True)


@query("src_csv_infer", sql="""
    SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def src_csv_infer(spark, d):
    path = files.write_csv(Tables(spark, d).customer, scratch_path(spark, "csv-infer"))
    return files.read_csv(spark, path, header=True, infer=True)


@query("src_csv_schema", sql="SELECT * FROM orders")
def src_csv_schema(spark, d):
    path = files.write_csv(Tables(spark, d).orders, scratch_path(spark, "csv-schema"))
    return files.read_csv(spark, path, header=True, schema=ORDERS_SCHEMA)


@query("src_tsv", sql="SELECT * FROM part")
def src_tsv(spark, d):
    path = files.write_csv(Tables(spark, d).part, scratch_path(spark, "tsv"), sep="\t")
    return files.read_csv(spark, path, header=True, sep="\t",
                          schema="p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
                                 "p_retailprice DOUBLE")


@query("src_csv_headerless", sql="SELECT * FROM supplier")
def src_csv_headerless(spark, d):
    path = files.write_csv(Tables(spark, d).supplier, scratch_path(spark, "csv-noheader"), header=False)
    raw = files.read_csv(spark, path, header=False, names=["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    return raw.select(F.col("s_suppkey").try_cast("bigint").alias("s_suppkey"), "s_name",
                      F.col("s_nationkey").try_cast("int").alias("s_nationkey"),
                      F.col("s_acctbal").try_cast("double").alias("s_acctbal"))


@query("src_csv_dropmalformed", sql="SELECT * FROM orders")
def src_csv_dropmalformed(spark, d):
    """One directory of CSV parts, some with malformed lines (a non-numeric price, a line
    with missing fields), read with a schema in DROPMALFORMED mode."""
    o = Tables(spark, d).orders
    path = scratch_path(spark, "csv-malformed")
    files.write_csv(o, path, header=False)
    bad = o.where("o_orderstatus = 'P'").select(
        F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", F.lit("n/a"),
                    F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "o_orderpriority").alias("line"))
    short = o.where("o_orderstatus = 'P'").select(F.concat_ws(",", "o_orderkey", "o_custkey").alias("line"))
    bad.unionByName(short).write.mode("append").text(path)
    return files.read_csv(spark, path, header=False, schema=ORDERS_SCHEMA, mode="DROPMALFORMED")


@query("src_csv_date", sql="SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders")
def src_csv_date(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))
    path = files.write_csv(o, scratch_path(spark, "csv-date"), date_format="M/d/yyyy")
    back = files.read_csv(spark, path, header=True, schema="o_orderkey BIGINT, o_orderdate DATE",
                          date_format="M/d/yyyy")
    return back.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"))


@query("src_csv_glob", sql="SELECT * FROM lineitem")
def src_csv_glob(spark, d):
    path = files.write_csv(at_least(Tables(spark, d).lineitem, 4), scratch_path(spark, "csv-glob"))
    return files.read_csv(spark, path + "/*.csv", header=True, schema=LINEITEM_SCHEMA)


@query("src_json", sql="SELECT * FROM events")
def src_json(spark, d):
    path = files.write_json(Tables(spark, d).events, scratch_path(spark, "json"))
    return files.read_json(spark, path, schema=EVENTS_SCHEMA)


@query("src_parquet", sql="SELECT * FROM lineitem")
def src_parquet(spark, d):
    path = files.write_parquet(Tables(spark, d).lineitem, scratch_path(spark, "parquet"))
    return spark.read.format("parquet").load(path)


@query("src_range", sql="""
    SELECT number, (o_orderkey IS NOT NULL) AS is_order
    FROM (SELECT unnest(range(lo, hi + 1)) AS number FROM (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders))
    LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders) ON number = o_orderkey""")
def src_range(spark, d):
    """All whole numbers from the smallest to the largest order key, and which of them are orders."""
    keys = Tables(spark, d).orders.select("o_orderkey").distinct()
    numbers = files.number_range(keys, "o_orderkey", "number")
    return numbers.join(keys, F.col("number") == F.col("o_orderkey"), "left") \
        .select("number", F.col("o_orderkey").isNotNull().alias("is_order"))


@query("src_text", sql="""
    SELECT md5(line) AS line_md5, CAST(length(line) AS INTEGER) AS len
    FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""")
def src_text(spark, d):
    path = files.write_text(Tables(spark, d).documents, "text", scratch_path(spark, "text"))
    lines = files.read_lines(spark, path)
    return lines.select(F.md5("value").alias("line_md5"), F.length("value").alias("len"))


@query("src_wholetext", sql="""
    SELECT lang, CAST(sum(length(text) + 1) AS BIGINT) AS n_chars FROM documents GROUP BY lang""")
def src_wholetext(spark, d):
    docs = Tables(spark, d).documents
    path = files.write_text(docs, "text", scratch_path(spark, "wholetext"), partition_by=["lang"],
                            max_records_per_file=200)
    whole = files.read_whole_files(spark, path)
    return (whole.select(F.regexp_extract("path", r"lang=([^/]+)", 1).alias("lang"),
                         F.length("content").alias("len"))
            .groupBy("lang").agg(F.sum("len").alias("n_chars")))


@query("src_table", sql="SELECT count(*) AS n, count(DISTINCT c_nationkey) AS n_nations FROM customer")
def src_table(spark, d):
    import uuid
    name = f"corvid_customer_{uuid.uuid4().hex[:8]}"
    t = files.save_table(Tables(spark, d).customer, name, scratch_path(spark, "table"))
    return t.agg(F.count("*").alias("n"), F.count_distinct("c_nationkey").alias("n_nations"))


@query("src_row_values", sql="SELECT c_name AS value FROM customer")
def src_row_values(spark, d):
    return Tables(spark, d).customer.select(F.col("c_name").alias("value"))


@query("sink_csv", sql="""
    SELECT s.s_suppkey, s.s_name, a.n_returned FROM supplier s
    LEFT JOIN (SELECT l_suppkey, count(*) AS n_returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) a
      ON s.s_suppkey = a.l_suppkey""")
def sink_csv(spark, d):
    t = Tables(spark, d)
    res = dimension_with_counts(t.supplier.select("s_suppkey", "s_name"), "s_suppkey",
                                {"n_returned": (t.lineitem.where("l_returnflag = 'R'"), "l_suppkey")})
    path = files.write_csv(res, scratch_path(spark, "sink-csv"))
    return files.read_csv(spark, path, schema="s_suppkey BIGINT, s_name STRING, n_returned BIGINT")


@query("job_avg_amount", sql="""
    SELECT o.o_custkey AS c_custkey,
           CAST(sum(CAST(l.l_quantity AS DECIMAL(12,2)) * CAST(l.l_extendedprice AS DECIMAL(12,2))) AS DOUBLE)
             / count(*) AS avg_amount
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey""")
def job_avg_amount(spark, d):
    t = Tables(spark, d)
    amount = money("l_quantity") * money("l_extendedprice")
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.sum(amount).alias("amount"), F.count(amount).alias("n"))
    amounts = per_order.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    res = (amounts.groupBy(F.col("o_custkey").alias("c_custkey"))
           .agg((F.sum("amount").cast("double") / F.sum("n")).alias("avg_amount")))
    path = files.write_json(res, scratch_path(spark, "sink-json"))
    return files.read_json(spark, path, schema="c_custkey BIGINT, avg_amount DOUBLE")


@query("sink_text", sql=r"""
    SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS word
    FROM conversations) WHERE word <> '' GROUP BY word""")
def sink_text(spark, d):
    wc = kv.word_count(Tables(spark, d).conversations)
    lines = wc.select(F.concat_ws("\t", "word", F.col("n").cast("string")).alias("line"))
    path = files.write_text(lines, "line", scratch_path(spark, "sink-text"), compression="gzip")
    back = files.read_lines(spark, path)
    parts = F.split("value", "\t")
    return back.select(F.get(parts, 0).alias("word"), F.get(parts, 1).try_cast("bigint").alias("n"))


@query("sink_binary", sql="SELECT l_orderkey AS k, l_partkey AS v FROM lineitem")
def sink_binary(spark, d):
    pairs = Tables(spark, d).lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("v"))
    path = files.write_parquet(pairs, scratch_path(spark, "sink-binary"))
    return spark.read.parquet(path)


@query("act_count", sql="SELECT count(*) AS n FROM orders")
def act_count(spark, d):
    return Tables(spark, d).orders.agg(F.count("*").alias("n"))


@query("act_take", sql="SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5")
def act_take(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(5)


@query("act_first", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1")
def act_first(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(1)


@query("inspect_schema", sql="""
    SELECT 'l_orderkey' AS "column", 'bigint' AS type, true AS nullable, count(l_orderkey) AS non_null FROM lineitem UNION ALL
    SELECT 'l_partkey' AS "column", 'bigint' AS type, true AS nullable, count(l_partkey) AS non_null FROM lineitem UNION ALL
    SELECT 'l_suppkey' AS "column", 'bigint' AS type, true AS nullable, count(l_suppkey) AS non_null FROM lineitem UNION ALL
    SELECT 'l_linenumber' AS "column", 'int' AS type, true AS nullable, count(l_linenumber) AS non_null FROM lineitem UNION ALL
    SELECT 'l_quantity' AS "column", 'double' AS type, true AS nullable, count(l_quantity) AS non_null FROM lineitem UNION ALL
    SELECT 'l_extendedprice' AS "column", 'double' AS type, true AS nullable, count(l_extendedprice) AS non_null FROM lineitem UNION ALL
    SELECT 'l_discount' AS "column", 'double' AS type, true AS nullable, count(l_discount) AS non_null FROM lineitem UNION ALL
    SELECT 'l_tax' AS "column", 'double' AS type, true AS nullable, count(l_tax) AS non_null FROM lineitem UNION ALL
    SELECT 'l_returnflag' AS "column", 'string' AS type, true AS nullable, count(l_returnflag) AS non_null FROM lineitem UNION ALL
    SELECT 'l_linestatus' AS "column", 'string' AS type, true AS nullable, count(l_linestatus) AS non_null FROM lineitem UNION ALL
    SELECT 'l_shipdate' AS "column", 'timestamp_ntz' AS type, true AS nullable, count(l_shipdate) AS non_null FROM lineitem""")
def inspect_schema(spark, d):
    return files.schema_profile(Tables(spark, d).lineitem)


@query("flt_header_rows", sql="""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""")
def flt_header_rows(spark, d):
    """CSV parts written with a header each, read as plain rows: the repeated header lines
    become data and are removed."""
    c = Tables(spark, d).customer
    path = files.write_csv(at_least(c, 4), scratch_path(spark, "csv-headers"), header=True)
    raw = files.read_csv(spark, path, header=False, names=c.columns)
    return shape.drop_repeated_headers(raw)

