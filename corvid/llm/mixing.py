"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame functions only.

Targets: the sources share ``sum(size)`` words by weight; a target stops at ``max_repeat``
times its source's size and the excess is shared anew by weight until none is above.

Every source is dealt into shards of about ``shard_words`` words by a seeded hash of its
documents and, for rows that are equal, their number, so copies of a row don't share a shard. A shard's documents, in seeded order, lie end to end and are cut into blocks of
equally many words (about ``block_words``). The blocks to take are apportioned to (source,
shard) cells by highest quotients ``v / (2 q + 1)``, v being the cell's blocks times its
source's target over its size. A cell with quota q over n blocks takes every block
``q // n`` times and the ``q % n`` blocks of smallest seeded hash once more.

Defined results: null texts have size 0; null sources are one source, last in order. Texts
without words take 0. Rows that are equal in id, source and text are told apart by position,
and it doesn't matter which is which. An empty table, or one without words, takes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import SPACE, SPACE_CLASS, WORD_CLASS, discard, fresh, kth_largest, materialise
from corvid.operators.windows import dense_index, running

#: The weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_WORDS = 128
SHARD_WORDS = 262_144
SEED = 31


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS + "+")), F.lit(0)).cast("long")


def _targets(sources: DataFrame, max_repeat: int) -> DataFrame:
    """``sources`` (a stored table: source, rank, source_size, weight) with ``target``.

    A source is full when its size over its weight is at most c, where c solves
    sum(min(max_repeat * size, weight * level)) = sum(size); level is found by running sums over
    the sources in order of ``max_repeat * size / weight``, spread over tasks however many sources
    there are.
    """
    all_size, all_weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    cap = F.col("source_size") * F.lit(float(max_repeat))
    found = sources.withColumn("cap", cap).withColumn("cap_level", F.col("cap") / F.col("weight"))
    found = running(found, [], ["cap_level", "rank"], {"cap_upto": ("sum", "cap"), "weight_upto": ("sum", "weight")})
    found = found.withColumn("level", (F.lit(all_size) - F.col("cap_upto") + F.col("cap"))
                             / (F.lit(all_weight) - F.col("weight_upto") + F.col("weight")))
    # the first source in order that isn't filled fixes the level of all behind it
    first = found.where("cap_level >= level").agg(F.min(F.struct("cap_level", "rank", "level")).alias("f")).first()["f"]
    level = F.col("cap_level") if first is None else F.lit(first["level"])
    return found.withColumn("target", F.least("cap", F.col("weight") * level).cast("double"))


def _quotas(cells: DataFrame, max_repeat: int, seed: int) -> DataFrame:
    """``cells`` (a stored table) with ``quota``, their integer number of blocks.

    A cell surely gets the seats that it has at a divisor too large for all seats together;
    the seats that are left go to the highest quotients among those above a divisor too
    small, fewer than three times the cells. These are found by exact selection, without
    sorting them in one task; quotients equal in 32 binary digits go by a seeded hash.
    """
    votes, n = cells.agg(F.sum("votes"), F.count("*")).first()
    seats = round(votes or 0.0)
    if not seats:
        return cells.withColumn("quota", F.lit(0).cast("long"))

    def seats_at(divisor: float) -> Column:
        return F.floor((F.col("votes") / F.lit(divisor) + 1) / 2).cast("long")

    sure = F.greatest(F.lit(0).cast("long"), seats_at(votes / (2 * seats - n))) if 2 * seats > n else F.lit(0).cast("long")
    cells = cells.withColumn("sure", sure).withColumn("may", F.greatest("sure", seats_at(votes / (2 * seats + n))))
    left = seats - cells.agg(F.sum("sure")).first()[0]
    seat = (cells.where("may > sure").withColumn("k", F.explode(F.sequence("sure", F.col("may") - 1)))
            .withColumn("quotient", F.col("votes") / (2 * F.col("k") + 1)))
    draw = F.pmod(F.xxhash64(F.lit(seed + 3), "rank", "shard", "k"), F.lit(1024))
    seat = materialise(seat.select("rank", "shard", (F.floor(F.col("quotient") * float(1 << 32)) * 1024 + draw)
                                   .cast("long").alias("key")), "seats")
    cut = kth_largest(seat, "key", left)
    won = seat.where(F.lit(False) if left < 1 else F.lit(True) if cut is None else F.col("key") >= cut)
    won = won.groupBy("rank", "shard").agg(F.count("*").alias("won"))
    quota = F.least(F.col("sure") + F.coalesce("won", F.lit(0)), F.col("blocks") * F.lit(max_repeat))
    return cells.join(won, ["rank", "shard"], "left").withColumn("quota", quota)


def _plan(rows: DataFrame, weights, max_repeat: int, block_words: int, shard_words: int, seed: int):
    """Rows with the figures of their sources, and pieces: runs of words of a row, with the
    number of ``times`` that they are taken."""
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = dense_index(per_source, [F.col("source").asc_nulls_last()], "rank", start=1)
    ranked = materialise(ranked.withColumn("rank", F.col("rank").cast("int")).withColumn("weight", weight), "ranked")
    sources = materialise(_targets(ranked, max_repeat).select(
        "source", "rank", "source_size", "target",
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long").alias("shards")), "sources")
    discard(ranked)
    full = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    # copies of a row (equal in id, source and text) are dealt apart by their number
    full = running(full, ["rank", "draw"], ["row"], {"copy": ("count", "row")})
    full = materialise(full.withColumn("shard", F.pmod(F.xxhash64("draw", "copy"), F.col("shards"))).drop("copy"), "rows")

    with_words = full.where("size > 0")
    laid = Window.partitionBy("rank", "shard").orderBy("draw2", "row").rowsBetween(Window.unboundedPreceding, 0)
    placed = with_words.withColumn("stop", F.sum("size").over(laid)).withColumn("start", F.col("stop") - F.col("size"))
    cells = (with_words.groupBy("rank", "shard", "source_size", "target").agg(F.sum("size").alias("words"))
             .withColumn("blocks", F.greatest(F.lit(1), F.round(F.col("words") / block_words)).cast("long"))
             .withColumn("votes", F.col("blocks") * F.col("target") / F.col("source_size")))
    cells = _quotas(materialise(cells, "cells"), max_repeat, seed)
    cells = materialise(cells.select("rank", "shard", "words", "blocks", "quota"), "quotas")

    drawn = Window.partitionBy("rank", "shard").orderBy("_draw", "block")
    taken = (cells.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumn("_draw", F.xxhash64(F.lit(seed + 1), "rank", "shard", "block"))
             .withColumn("_place", F.row_number().over(drawn))
             .withColumn("times", F.floor(F.col("quota") / F.col("blocks"))
                         + F.when(F.col("_place") <= F.col("quota") % F.col("blocks"), 1).otherwise(0))
             .where("times > 0").select("rank", "shard", "block", "times"))
    # block b of n covers the words from b * words div n up to (b + 1) * words div n
    pieces = (placed.join(cells, ["rank", "shard"])
              .withColumn("_from", F.expr("(start * blocks) div words"))
              .withColumn("_to", F.expr("least(((stop - 1) * blocks) div words + 1, blocks - 1)"))
              .withColumn("block", F.explode(F.sequence(F.greatest(F.lit(0), F.col("_from") - 1), F.col("_to"))))
              .withColumn("_lo", F.greatest("start", F.expr("(block * words) div blocks")))
              .withColumn("_hi", F.least("stop", F.expr("((block + 1) * words) div blocks")))
              .where("_lo < _hi")
              .select("rank", "shard", "block", "row", (F.col("_lo") - F.col("start")).alias("first"),
                      (F.col("_hi") - F.col("_lo")).alias("length"))
              # the blocks grow with the input, but their size is estimated from the few cells
              .join(taken.hint("merge"), ["rank", "shard", "block"]))
    return full, pieces.select("row", "block", "first", "length", "times")


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, row: Column, seed: int) -> DataFrame:
    same = [F.col(id_col), F.xxhash64(F.col(text_col))]
    return docs.select(row.alias("row"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       n_words(F.col(text_col)).alias("size"), F.xxhash64(F.lit(seed), *same).alias("draw"),
                       F.xxhash64(F.lit(seed + 2), *same).alias("draw2"))


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights=WEIGHTS, max_repeat: int = MAX_REPEAT, block_words: int = BLOCK_WORDS,
               shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: ``id_col``, ``size``, ``source_size``, ``target``, ``taken``."""
    rows = materialise(_rows(docs, id_col, text_col, source_col, F.monotonically_increasing_id(), seed), "sizes")
    full, pieces = _plan(rows, weights, max_repeat, block_words, shard_words, seed)
    taken = pieces.groupBy("row").agg(F.sum(F.col("length") * F.col("times")).alias("taken"))
    return (full.join(taken, "row", "left")
            .select(F.col("id").alias(id_col), "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, max_repeat: int = MAX_REPEAT, block_words: int = BLOCK_WORDS,
        shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """The mix itself: a row of ``docs`` for the n-th time that words of it are taken, whose
    text is those words with the white space between them. Documents of which no word is
    taken go; a document taken whole, once, stays as it is."""
    row, size, runs, copy = (fresh(docs, c) for c in ("row_", "size_", "runs_", "copy_"))
    held = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "mix-docs")
    rows = materialise(_rows(held, id_col, text_col, source_col, F.col(row), seed), "sizes")
    full, pieces = _plan(rows, weights, max_repeat, block_words, shard_words, seed)
    copies = (pieces.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
              .groupBy("row", "copy").agg(F.sort_array(F.collect_list(F.struct("first", "length"))).alias("runs"),
                                          F.sum("length").alias("words")))
    copies = copies.select(F.col("row").alias(row), F.col("copy").alias(copy), F.col("runs").alias(runs),
                           F.col("words").alias(size))
    words = F.regexp_extract_all(F.col(text_col), F.lit(f"{SPACE_CLASS}*{WORD_CLASS}+"), 0)
    cut = F.array_join(F.flatten(F.transform(F.col(runs), lambda r: F.slice(
        words, (r["first"] + 1).cast("int"), r["length"].cast("int")))), "")
    whole = n_words(F.col(text_col)) == F.col(size)
    text = F.when(whole, F.col(text_col)).otherwise(F.ltrim(cut, F.lit(SPACE)))
    return held.join(copies, row).withColumn(text_col, text).select(*docs.columns)
