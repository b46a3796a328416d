"""Sampling, partitioning and persistence queries (PAR)."""

from pyspark.sql import functions as F

from corvid.operators import partition as par
from corvid.operators import pipe
from corvid.plans.registry import query
from corvid.session import ensure_checkpoint_dir
from corvid.sources.tables import Tables

_HASH = "('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT"


@query("par_hash_split", sql=f"""
    SELECT o_orderkey, CASE WHEN {_HASH} < 1717986918 THEN 0 ELSE 1 END AS part FROM orders""")
def par_hash_split(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey")
    a, b = par.hash_split(o, "o_orderkey", [0.4, 0.6])
    return a.withColumn("part", F.lit(0)).unionByName(b.withColumn("part", F.lit(1)))


@query("par_random_split")
def par_random_split(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey")
    a, b = par.random_split(o, [0.4, 0.6], seed=7)
    return a.withColumn("part", F.lit(0)).unionByName(b.withColumn("part", F.lit(1)))


@query("par_sample_n")
def par_sample_n(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    return par.sample_n_with_replacement(o, 100, o.count(), seed=11)


@query("par_sample_by_key")
def par_sample_by_key(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    return par.sample_by_key(li, "l_returnflag", {"A": 0.1, "N": 0.05, "R": 0.2}, seed=6, with_replacement=True)


_ROW_HASH = "(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)), 1, 8))::BIGINT)"


@query("par_sample_by_key_hash", sql=f"""
    SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
    WHERE {_ROW_HASH} < CASE l_returnflag WHEN 'A' THEN 0.1 WHEN 'N' THEN 0.05 WHEN 'R' THEN 0.2 ELSE 0 END * 4294967296""")
def par_sample_by_key_hash(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    return par.hash_sample_by_key(li, "l_returnflag", {"A": 0.1, "N": 0.05, "R": 0.2}, ["l_orderkey", "l_linenumber"])


@query("par_sample_n_hash", sql=f"""
    SELECT l_orderkey, l_linenumber FROM lineitem
    ORDER BY {_ROW_HASH} % 1073741824, l_orderkey, l_linenumber LIMIT 100""")
def par_sample_n_hash(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber")
    return par.hash_sample_n(li, 100, ["l_orderkey", "l_linenumber"])


@query("par_coalesce", sql="SELECT * FROM lineitem")
def par_coalesce(spark, d):
    li = Tables(spark, d).lineitem
    return li.coalesce(max(1, li.rdd.getNumPartitions() // 2))


@query("par_repartition", sql="SELECT * FROM orders")
def par_repartition(spark, d):
    o = Tables(spark, d).orders
    return o.repartition(2 * par.cluster_parallelism(o))


@query("par_by_key", sql="SELECT l_suppkey, CAST(1 AS BIGINT) AS n_partitions, count(*) AS n FROM lineitem GROUP BY l_suppkey")
def par_by_key(spark, d):
    parted = Tables(spark, d).lineitem.repartition("l_suppkey").withColumn("pid", F.spark_partition_id())
    return parted.groupBy("l_suppkey").agg(F.count_distinct("pid").alias("n_partitions"), F.count("*").alias("n"))


@query("par_sort_within", sql="""
    SELECT o_orderkey, CAST(o_orderkey % 2 AS INTEGER) AS partition,
           row_number() OVER (PARTITION BY o_orderkey % 2 ORDER BY o_orderkey) AS pos FROM orders""")
def par_sort_within(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey")
    return par.positions_within_buckets(o, (F.col("o_orderkey") % 2).cast("int"), ["o_orderkey"]) \
        .select("o_orderkey", "partition", F.col("pos").cast("bigint").alias("pos"))


@query("par_count", sql="SELECT 6 AS n_partitions, count(*) AS n_rows FROM lineitem")
def par_count(spark, d):
    """Partitions of a known layout (``repartitionById``), and the rows in them."""
    laid = par.laid_out(Tables(spark, d).lineitem.select("l_orderkey"), "l_orderkey", 6)
    return laid.select(F.lit(laid.rdd.getNumPartitions()).alias("n_partitions")).groupBy("n_partitions").agg(
        F.count("*").alias("n_rows"))


@query("par_sizes", sql="""
    SELECT CAST(o_orderkey % 16 AS INTEGER) AS partition, count(*) AS n FROM orders GROUP BY 1""")
def par_sizes(spark, d):
    return par.partition_sizes(par.laid_out(Tables(spark, d).orders, "o_orderkey", 16))


@query("par_glom", sql="""
    SELECT partition, chunk, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS held FROM (
      SELECT CAST(o_orderkey % 16 AS INTEGER) AS partition, o_orderkey,
             CAST((row_number() OVER (PARTITION BY o_orderkey % 16 ORDER BY o_orderkey) - 1) // 500 AS BIGINT) AS chunk
      FROM orders) GROUP BY partition, chunk""")
def par_glom(spark, d):
    """What each physical partition holds, as arrays of at most 500 elements in its own order."""
    laid = par.laid_out(Tables(spark, d).orders.select("o_orderkey"), "o_orderkey", 16)
    held = par.contents(laid.sortWithinPartitions("o_orderkey"), "o_orderkey", max_items=500)
    return held.select("partition", "chunk", F.concat_ws(",", F.col("values").cast("array<string>")).alias("held"))


@query("par_map_partitions", sql="SELECT count(*) AS n, round(sum(l_quantity), 2) AS total FROM lineitem")
def par_map_partitions(spark, d):
    parts = par.partial_sums(par.at_least(Tables(spark, d).lineitem, 4), "l_quantity")
    return parts.agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query("par_pipe", sql="SELECT count(*) AS n_lines FROM documents")
def par_pipe(spark, d):
    """Every partition of the documents through ``wc -l``; the counts of all partitions added up."""
    docs = par.at_least(Tables(spark, d).documents, 4)
    lines = pipe.pipe(docs, ["wc", "-l"], cols=["doc_id", "text"])
    return lines.agg(F.sum(F.trim("line").cast("bigint")).alias("n_lines"))


@query("par_pipe_text", sql=r"""
    SELECT doc_id, regexp_replace(text, '[0-9]+', '<\0>', 'g') AS marked FROM documents""")
def par_pipe_text(spark, d):
    """Whole texts through a line editor that marks their numbers."""
    docs = Tables(spark, d).documents.select("doc_id", "text")
    return pipe.pipe_column(docs, ["sed", "s/[0-9][0-9]*/<&>/g"], "text", "marked").select("doc_id", "marked")


@query("par_cache", sql="""
    SELECT l_returnflag, count(*) AS n, round(count(*) / (SELECT count(*) FROM lineitem), 6) AS share
    FROM lineitem GROUP BY 1""")
def par_cache(spark, d):
    """Lines read once, kept, and used for the total and for the groups; then given back."""
    return par.shares(Tables(spark, d).lineitem, ["l_returnflag"])


@query("par_checkpoint", sql="SELECT l_linestatus, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1")
def par_checkpoint(spark, d):
    ensure_checkpoint_dir(spark)
    cut = par.checkpointed(Tables(spark, d).lineitem.select("l_linestatus", "l_extendedprice"))
    return cut.groupBy("l_linestatus").agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))
