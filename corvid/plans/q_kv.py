"""Key-value (pair-RDD style) jobs, word count and text statistics (KV)."""

from pyspark.sql import functions as F

from corvid.operators import agg, kv
from corvid.plans.registry import query
from corvid.sources.tables import Tables

WS = r"[ \t\n\x0B\f\r]+"
CLEAN_WORDS = r"""
    SELECT unnest(regexp_split_to_array(
             regexp_replace(lower(text), '[^\p{L}\p{N}_ \t\n\x0B\f\r]', '', 'g'), '[ \t\n\x0B\f\r]+')) AS word
    FROM documents"""
RAW_WORDS = r"SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS word FROM documents"


@query("kv_reduce", sql="SELECT round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders")
def kv_reduce(spark, d):
    return Tables(spark, d).orders.agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("n"))


@query("kv_longest", sql=f"""
    SELECT word AS longest, CAST(length(word) AS INTEGER) AS len
    FROM ({RAW_WORDS}) WHERE word <> '' ORDER BY length(word) DESC, word LIMIT 1""")
def kv_longest(spark, d):
    w = kv.words(Tables(spark, d).documents)
    return kv.longest(w, "word").select("longest", F.length("longest").alias("len"))


@query("kv_reduce_by_key", sql="SELECT source AS k, CAST(sum(n_chars) AS BIGINT) AS total_chars FROM documents GROUP BY source")
def kv_reduce_by_key(spark, d):
    pairs = Tables(spark, d).documents.select(F.col("source").alias("k"), F.col("n_chars").alias("v"))
    return pairs.groupBy("k").agg(F.sum("v").alias("total_chars"))


@query("kv_group_by_key", sql="""
    SELECT l_orderkey AS k, chunk, count(*) AS n,
           string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts
    FROM (SELECT *, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey NULLS FIRST) - 1) // 10000 AS chunk
          FROM lineitem) GROUP BY l_orderkey, chunk""")
def kv_group_by_key(spark, d):
    pairs = Tables(spark, d).lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("v"))
    g = agg.collect_bounded(pairs, ["k"], "v", out="vs")
    return g.select("k", "chunk", "n", F.concat_ws(",", F.col("vs").cast("array<string>")).alias("parts"))


@query("kv_count_by_key", sql="SELECT l_returnflag AS k, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def kv_count_by_key(spark, d):
    return Tables(spark, d).lineitem.groupBy(F.col("l_returnflag").alias("k")).agg(F.count("*").alias("n"))


@query("kv_aggregate", sql="""
    SELECT l_orderkey, sum(l_quantity) AS qty, count(*) AS n, round(product(1 - l_discount), 6) AS keep_factor
    FROM lineitem GROUP BY l_orderkey""")
def kv_aggregate(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("qty"), F.count("*").alias("n"),
        F.round(F.product(1 - F.col("l_discount")), 6).alias("keep_factor"))


@query("kv_aggregate_by_key", sql="""
    SELECT l_suppkey, sum(l_quantity) AS qty, count(*) AS n, round(avg(l_quantity), 6) AS mean_qty
    FROM lineitem GROUP BY l_suppkey""")
def kv_aggregate_by_key(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_suppkey").agg(
        F.sum("l_quantity").alias("qty"), F.count("*").alias("n"),
        F.round(F.sum("l_quantity") / F.count("*"), 6).alias("mean_qty"))


@query("kv_combine", sql="""
    SELECT l_partkey AS k, chunk, count(*) AS n, sum(l_quantity) AS total_qty,
           string_agg(CAST(l_quantity AS VARCHAR), ',' ORDER BY l_quantity) AS qtys
    FROM (SELECT *, (row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity NULLS FIRST) - 1) // 10000 AS chunk
          FROM lineitem) GROUP BY l_partkey, chunk""")
def kv_combine(spark, d):
    pairs = Tables(spark, d).lineitem.select(F.col("l_partkey").alias("k"), F.col("l_quantity").cast("int").alias("v"))
    g = agg.collect_bounded(pairs, ["k"], "v", out="vs")
    return g.select("k", "chunk", "n", F.aggregate("vs", F.lit(0).cast("bigint"), lambda a, x: a + x)
                    .cast("double").alias("total_qty"),
                    F.concat_ws(",", F.transform("vs", lambda x: F.format_string("%d.0", x))).alias("qtys"))


@query("kv_fold", sql="SELECT l_returnflag AS k, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1")
def kv_fold(spark, d):
    return (Tables(spark, d).lineitem.groupBy(F.col("l_returnflag").alias("k"))
            .agg(F.round(F.sum("l_extendedprice"), 2).alias("total")))


@query("kv_min_by", sql="""
    SELECT c_nationkey, min(c_acctbal) AS min_bal, first(c_name ORDER BY c_acctbal, c_custkey) AS poorest
    FROM customer GROUP BY c_nationkey""")
def kv_min_by(spark, d):
    return Tables(spark, d).customer.groupBy("c_nationkey").agg(
        F.min("c_acctbal").alias("min_bal"), F.min_by("c_name", F.struct("c_acctbal", "c_custkey")).alias("poorest"))


@query("kv_mean", sql="SELECT p_brand, round(avg(p_size), 6) AS mean_size FROM part GROUP BY p_brand")
def kv_mean(spark, d):
    return Tables(spark, d).part.groupBy("p_brand").agg(F.round(F.avg("p_size"), 6).alias("mean_size"))


@query("kv_fail_counts", sql="""
    WITH c AS (SELECT l_returnflag, count(*) FILTER (WHERE l_discount < 0.05) AS n_fail
               FROM lineitem GROUP BY l_returnflag)
    SELECT l_returnflag, n_fail, n_fail = (SELECT max(n_fail) FROM c) AS is_max FROM c""")
def kv_fail_counts(spark, d):
    return kv.fail_counts(Tables(spark, d).lineitem, "l_returnflag", F.col("l_discount") < 0.05)


@query("kv_tagged_union", sql="""
    SELECT key, tag, count(*) AS n, round(sum(value), 2) AS total FROM (
      SELECT c_nationkey AS key, 'customer' AS tag, c_acctbal AS value FROM customer
      UNION ALL SELECT s_nationkey, 'supplier', s_acctbal FROM supplier)
    GROUP BY key, tag""")
def kv_tagged_union(spark, d):
    t = Tables(spark, d)
    u = kv.tagged_union({"customer": t.customer.withColumnRenamed("c_nationkey", "k").withColumnRenamed("c_acctbal", "v"),
                         "supplier": t.supplier.withColumnRenamed("s_nationkey", "k").withColumnRenamed("s_acctbal", "v")},
                        "k", "v")
    return u.groupBy("key", "tag").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("kv_tagged_regroup", sql="""
    SELECT key, chunk, count(*) AS n, string_agg(v, ',' ORDER BY v) AS members FROM (
      SELECT key, v, (row_number() OVER (PARTITION BY key ORDER BY v) - 1) // 1000 AS chunk FROM (
        SELECT c_nationkey AS key, 'customer:' || c_custkey AS v FROM customer
        UNION ALL SELECT s_nationkey, 'supplier:' || s_suppkey FROM supplier))
    GROUP BY key, chunk""")
def kv_tagged_regroup(spark, d):
    t = Tables(spark, d)
    u = kv.tagged_union({"customer": t.customer.select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("v")),
                         "supplier": t.supplier.select(F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("v"))},
                        "k", "v")
    g = agg.collect_bounded(u, ["key"], F.concat_ws(":", "tag", "value"), max_items=1000, out="vs")
    return g.select("key", "chunk", "n", F.concat_ws(",", "vs").alias("members"))


@query("wc_raw", sql=f"SELECT word, count(*) AS n FROM ({RAW_WORDS}) WHERE word <> '' GROUP BY word")
def wc_raw(spark, d):
    return kv.word_count(Tables(spark, d).documents)


@query("wc_clean", sql=f"SELECT word, count(*) AS n FROM ({CLEAN_WORDS}) WHERE word <> '' GROUP BY word")
def wc_clean(spark, d):
    return kv.word_count(Tables(spark, d).documents, clean=True)


@query("txt_stats", sql=r"""
    WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
    w AS (SELECT word FROM (SELECT unnest(regexp_split_to_array(line, '[ \t\n\x0B\f\r]+')) AS word FROM lines)
          WHERE word <> '')
    SELECT (SELECT count(*) FROM lines) AS n_lines,
           (SELECT CAST(max(length(line)) AS INTEGER) FROM lines) AS longest_line,
           (SELECT CAST(sum(length(line)) AS BIGINT) FROM lines) AS total_chars,
           (SELECT count(*) FROM lines WHERE contains(line, 'data')) AS lines_with_needle,
           (SELECT CAST(count(*) AS BIGINT) FROM w) AS n_words,
           (SELECT word FROM w ORDER BY length(word) DESC, word LIMIT 1) AS longest_word,
           (SELECT CAST(count(*) AS BIGINT) FROM w WHERE length(word) > 6) AS long_words""")
def txt_stats(spark, d):
    return kv.text_stats(Tables(spark, d).documents)


@query("txt_top_words", sql=f"""
    SELECT word, CAST(length(word) AS INTEGER) AS len FROM (SELECT DISTINCT word FROM ({RAW_WORDS}) WHERE word <> '')
    ORDER BY length(word) DESC, word LIMIT 3""")
def txt_top_words(spark, d):
    return kv.top_longest_words(Tables(spark, d).documents, 3)


@query("kv_even_sum", sql="""
    SELECT CAST(sum(o_orderkey) FILTER (WHERE o_orderkey % 2 = 0) AS BIGINT) AS even_sum,
           count(*) FILTER (WHERE o_orderkey % 3 = 0) AS multiples_of_3 FROM orders""")
def kv_even_sum(spark, d):
    k = F.col("o_orderkey")
    return Tables(spark, d).orders.agg(F.sum(F.when(k % 2 == 0, k)).alias("even_sum"),
                                       F.count_if(k % 3 == 0).alias("multiples_of_3"))
