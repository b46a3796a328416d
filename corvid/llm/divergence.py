"""Source divergence: how far apart the sources of a language are in the terms they use.

A language keeps the terms that at least ``min_docs`` of its documents hold; V is their number.
A group is a (lang, source) that occurs. A group's, or a language's, figure for a kept term it
holds ``count`` times is ``p = 1 + floor(10**9 * (count + 5) / (N + 5 * V))``, N being the sum of
its counts of kept terms. Two sources differ by the sum of ``abs(p - q)`` over all kept terms; a
term tells a source by how far its p exceeds the language's.

Every task folds its whole documents into stripes, (lang, term) to document frequency and counts
by source, and hands them on when it holds many. Stripes of the same key are merged as they
arrive sorted, so a key has at most a row for each time that a task handed on. The merged stripes
directly give the divergences: each task adds up, for every two sources, how far its terms move
them from the distance of two absent terms, and keeps its best terms of every group. What is
shuffled then is a row per pair or best term and task.

Group totals are broadcast a portion at a time: languages in order, one with many sources in blocks of
them, so that a task's sums of every two sources and its totals take about ``PORTION`` numbers. The
result itself has a row for every two sources of a language.

Defined results: null text, lang and source read as ''. Terms are maximal runs of bytes of
A-Z, a-z and non-ASCII characters, with A-Z lower-cased. Repeated rows and ids count each as a
document. A group without kept terms has N = 0; a language without kept terms has pairs of value
0 and no terms. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import discard, materialise, remove, text_portions
from corvid.session import scratch_path

MIN_DOCS, TOP = 30, 50
#: Fixed values of the smoothed shares.
SCALE, PRIOR = 1_000_000_000, 5
#: A task hands on its stripes when they hold so many counts, or after so many characters.
HELD, HELD_CHARS = 600_000, 1 << 26
#: Numbers of a portion: block sources by all sources, and SOURCE for each source.
PORTION, SOURCE = 4_000_000, 64
#: Counts of terms by sources that a task turns into shares at a time.
CELLS = 1 << 20

#: Every byte of a term, A-Z lower-cased; all others become blanks.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_COUNT = T.StructType([T.StructField("source", T.StringType()), T.StructField("n", T.LongType())])
STRIPES = T.StructType([T.StructField("lang", T.StringType()), T.StructField("term", T.StringType()),
                        T.StructField("df", T.LongType()), T.StructField("counts", T.ArrayType(_COUNT))])
_FOUND = T.StructType([T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("item", T.StringType()), T.StructField("term", T.BooleanType()),
                       T.StructField("moved", T.LongType()), T.StructField("shared", T.LongType())])


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Stripes:
    """In-mapper stripes of one task: per language the document frequency of every term, and its
    counts by source."""

    def __init__(self):
        self.df: dict[str, Counter] = {}
        self.counts: dict[str, dict[str, Counter]] = {}
        self.room = 0

    def add(self, lang: str, source: str, words: list[bytes]) -> None:
        """Fold a whole document."""
        if not words:
            return
        if lang not in self.df:
            self.df[lang], self.counts[lang] = Counter(), {}
        counts = self.counts[lang].setdefault(source, Counter())
        before = len(counts)
        counts.update(words)
        self.df[lang].update(set(words))
        self.room += len(counts) - before

    def rows(self) -> Iterator[pa.RecordBatch]:
        for lang, df in self.df.items():
            place = dict(zip(df, range(len(df))))
            sources = list(self.counts[lang])
            held = [self.counts[lang][s] for s in sources]
            at = np.concatenate([np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for c in held])
            n = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in held])
            source = np.repeat(np.arange(len(held)), [len(c) for c in held])
            order = np.argsort(at, kind="stable")
            names = pa.array(sources, pa.string()).take(pa.array(source[order]))
            ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(df)))]).astype(np.int32)
            counts = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([names, pa.array(n[order])],
                                                                                         names=["source", "n"]))
            words = pa.array(list(df), pa.binary()).cast(pa.string())
            columns = [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(df), np.int64))), words,
                       pa.array(np.fromiter(df.values(), np.int64, len(df))), counts]
            yield from pa.Table.from_arrays(columns, names=STRIPES.names).to_batches(max_chunksize=20_000)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes of whole documents (lang, source, text)."""
    held, chars = Stripes(), 0
    for batch in batches:
        langs, sources = (batch.column(i).to_pylist() for i in (0, 1))
        at = 0
        for part in text_portions(batch.column(2)):
            for lang, source, text in zip(langs[at:], sources[at:], part):
                held.add(lang, source, terms(text))
                chars += len(text)
                if held.room > HELD or chars > HELD_CHARS:
                    yield from held.rows()
                    held, chars = Stripes(), 0
            at += len(part)
    yield from held.rows()


class Merged:
    """Merged stripes of the terms that are kept, on their way out."""

    def __init__(self):
        self.out: list[tuple] = []
        self.size = 0

    def add(self, lang: str, term: str, df: int, counts: dict[str, int]) -> None:
        self.out.append((lang, term, df, counts))
        self.size += len(counts)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.out:
            langs, words, dfs, counts = zip(*self.out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(dfs, pa.int64()),
                 pa.array([[{"source": s, "n": n} for s, n in c.items()] for c in counts],
                          pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())])))], names=STRIPES.names)
        self.out, self.size = [], 0


def _add(counts: dict[str, int], stripes: pa.Array) -> None:
    flat = stripes.flatten()
    for source, n in zip(flat.field(0).to_pylist(), flat.field(1).to_pylist()):
        counts[source] = counts.get(source, 0) + n


def _merged(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Stripes that arrive sorted by (lang, term), merged by key; those of terms in fewer than
    ``min_docs`` documents end here. Keys that lie within a batch are summed as arrays, and only the
    kept ones are looked at one by one; a key that goes on from batch to batch adds up."""
    out, key, df, counts = Merged(), None, 0, {}
    for batch in batches:
        if not batch.num_rows:
            continue
        lang, term, dfs, stripes = batch.columns
        new = np.ones(batch.num_rows, dtype=bool)
        new[0] = (lang[0].as_py(), term[0].as_py()) != key
        changes = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1]))
        new[1:] = changes.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        dfs = dfs.to_numpy()
        if not len(starts) or starts[0] > 0:  # the open key goes on
            end = int(starts[0]) if len(starts) else batch.num_rows
            df += int(dfs[:end].sum())
            _add(counts, stripes.slice(0, end))
        if len(starts):
            if key and df >= min_docs:
                out.add(*key, df, counts)
            ends = np.append(starts[1:], batch.num_rows)
            sums = np.add.reduceat(dfs, starts)
            for j in np.flatnonzero(sums[:-1] >= min_docs).tolist():
                start, found = int(starts[j]), {}
                _add(found, stripes.slice(start, int(ends[j]) - start))
                out.add(lang[start].as_py(), term[start].as_py(), int(sums[j]), found)
            start = int(starts[-1])
            key, df, counts = (lang[start].as_py(), term[start].as_py()), int(sums[-1]), {}
            _add(counts, stripes.slice(start))
        if out.size > HELD // 4:
            yield from out.rows()
    if key and df >= min_docs:
        out.add(*key, df, counts)
    yield from out.rows()


def stripes(docs: DataFrame, min_docs: int = 1) -> DataFrame:
    """``lang``, ``term``, ``df``, ``counts`` of the terms in at least ``min_docs`` documents: documents that
    hold the term, occurrences by source. ``docs`` has lang, source and text, the first two without
    nulls."""
    folded = docs.select("lang", "source", "text").mapInArrow(_fold, STRIPES)
    return (folded.repartition("lang", "term").sortWithinPartitions("lang", "term")
            .mapInArrow(lambda batches: _merged(batches, min_docs), STRIPES))


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * counts / total)``, exact: long division by thousands, as the product
    would not fit; ``counts <= total < 2**53``."""
    out, rest = np.zeros(np.broadcast(counts, total).shape, np.int64), counts
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digit
    return out + 1


class Lang:
    """The sources of one language, and what a task has found about those of a block, ``own``."""

    def __init__(self, sources: list[str], totals: list[int], v: int, own: range):
        self.sources, self.own = sources, own
        self.at = {s: i for i, s in enumerate(sources)}
        self.total = np.array(totals, dtype=np.int64) + PRIOR * v
        self.all = np.array(sum(totals) + PRIOR * v, dtype=np.int64)
        self.absent = shares(np.full(len(sources), PRIOR, dtype=np.int64), self.total)
        self.moved = np.zeros((len(own), len(sources)), dtype=np.int64)
        self.shared = np.zeros_like(self.moved)
        self.best: list[list[tuple[int, bytes]]] = [[] for _ in own]
        self.words: list[bytes] = []
        self.places: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, word: bytes, sources: list[str], counts: list[int]) -> None:
        self.words.append(word)
        self.places.append(np.array([self.at[s] for s in sources]))
        self.counts.append(np.array(counts, dtype=np.int64))
        if len(self.words) * len(self.sources) >= CELLS:
            self.close()

    def close(self) -> None:
        """Work in the terms held."""
        if not self.words:
            return
        held = np.zeros((len(self.words), len(self.sources)), dtype=np.int64)
        held[np.repeat(np.arange(len(self.words)), [len(p) for p in self.places]), np.concatenate(self.places)] = \
            np.concatenate(self.counts)
        p = shares(held + PRIOR, self.total)
        q = shares(held.sum(axis=1) + PRIOR, self.all)
        for k, i in enumerate(self.own):
            own = np.flatnonzero(held[:, i])
            if not len(own):
                continue
            # how far the terms of source i move it from each other source, beside two absent terms
            gap = np.abs(p[own] - p[own, i:i + 1]) - np.abs(self.absent - self.absent[i])
            self.moved[k] += gap.sum(axis=0)
            self.shared[k] += np.where(held[own] > 0, gap, 0).sum(axis=0)
            above = p[own, i] - q[own]
            found = [(-int(above[j]), self.words[own[j]]) for j in np.flatnonzero(above > 0)]
            self.best[k] = heapq.nsmallest(TOP, self.best[k] + found)
        self.words, self.places, self.counts = [], [], []

    def rows(self, lang: str) -> Iterator[tuple]:
        self.close()
        for k, i in enumerate(self.own):
            source = self.sources[i]
            for j in np.flatnonzero((self.moved[k] != 0) | (self.shared[k] != 0)).tolist():
                yield lang, source, self.sources[j], False, int(self.moved[k, j]), int(self.shared[k, j])
            for below, word in self.best[k]:
                yield lang, source, word.decode("utf-8", "surrogatepass"), True, -below, 0


def _portions(groups: DataFrame) -> Iterator[dict[str, tuple[list[str], list[int], int, range]]]:
    """The groups of languages with kept terms, some languages or a block of one at a time."""
    def blocks(sources, totals, v):
        rows = max(1, (PORTION - SOURCE * len(sources)) // len(sources))
        for first in range(0, len(sources), rows):
            own = range(first, min(first + rows, len(sources)))
            yield (SOURCE + len(own)) * len(sources), (sources, totals, v, own)

    def languages():
        lang, sources, totals, v = None, [], [], 0
        for r in groups.where("v > 0").orderBy("lang", "source").toLocalIterator():
            if r.lang != lang and sources:
                yield lang, sources, totals, v
                sources, totals = [], []
            lang, v = r.lang, r.v
            sources.append(r.source)
            totals.append(r.total)
        if sources:
            yield lang, sources, totals, v

    held, size = {}, 0
    for lang, *about in languages():
        for cost, block in blocks(*about):
            if held and (lang in held or size + cost > PORTION):
                yield held
                held, size = {}, 0
            held[lang], size = block, size + cost
    if held:
        yield held


def _emit(kept: DataFrame, groups) -> DataFrame:
    """What each task finds in the kept stripes about the groups of a portion."""
    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {lang: Lang(*about) for lang, about in groups.value.items()}
        for batch in batches:
            lists = batch.column(3)
            flat, end = lists.flatten(), 0
            sources, ns = flat.field(0).to_pylist(), flat.field(1).to_pylist()
            words = batch.column(1).cast(pa.binary()).to_pylist()
            for lang, word, n in zip(batch.column(0).to_pylist(), words, lists.value_lengths().to_pylist()):
                start, end = end, end + n
                if lang in known:
                    known[lang].add(word, sources[start:end], ns[start:end])
        rows = (row for lang, about in known.items() for row in about.rows(lang))
        part: list[tuple] = []
        for row in rows:
            part.append(row)
            if len(part) == 20_000:
                yield _found(part)
                part = []
        if part:
            yield _found(part)

    return kept.mapInArrow(emitted, _FOUND)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_FOUND.names)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: per group its distance to every
    other source of the language (part ``pair``), and its ``TOP`` most telling terms (``term``)."""
    spark = docs.sparkSession
    read = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = materialise(stripes(read, min_docs), "stripes")
    totals = (kept.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source"))
              .agg(F.sum("c.n").alias("total")))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    groups = materialise(
        read.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v")),
        "groups")

    path = scratch_path(spark, "divergences")
    _emit(kept.limit(0), spark.sparkContext.broadcast({})).write.parquet(path)
    for portion in _portions(groups):
        some = kept.where(F.col("lang").between(min(portion), max(portion)))
        _emit(some, spark.sparkContext.broadcast(portion)).write.mode("append").parquet(path)
    found = spark.read.schema(_FOUND).parquet(path)

    term = (found.where("term").select("lang", "source", F.lit("term").alias("part"), "item",
                                       F.col("moved").alias("value")))
    # pairs: every two sources of a language, at the distance of terms that both lack, and moved by
    # the terms that either has; terms that both have were counted from either side
    sums = found.where("not term").groupBy("lang", "source", "item").agg(F.sum("moved").alias("moved"),
                                                                         F.sum("shared").alias("shared"))
    absent = F.lit(1) + F.expr(f"cast({SCALE * PRIOR} as bigint) div (total + {PRIOR} * v)")
    left = groups.withColumn("p", F.when(F.col("v") > 0, absent).otherwise(0))
    right = left.select("lang", F.col("source").alias("item"), F.col("p").alias("q"))
    back = sums.select("lang", F.col("source").alias("item"), F.col("item").alias("source"),
                       F.col("moved").alias("moved_back"))
    zero = F.lit(0)
    pair = (left.join(right, "lang").where("source <> item").join(sums, ["lang", "source", "item"], "left")
            .join(back, ["lang", "source", "item"], "left")
            .select("lang", "source", F.lit("pair").alias("part"), "item",
                    (F.col("v") * F.abs(F.col("p") - F.col("q")) + F.coalesce("moved", zero)
                     + F.coalesce("moved_back", zero) - F.coalesce("shared", zero)).alias("value")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    # a task's best terms are at most TOP per group; a group has as many pairs as its language has sources
    out = materialise(pair.unionByName(term).withColumn("rank", F.row_number().over(order))
                      .where((F.col("part") == "pair") | (F.col("rank") <= TOP)), "audit")
    discard(kept, groups)
    remove(spark, path)
    return out
