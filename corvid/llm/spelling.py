"""Spelling variants: words one code point apart, and the far commoner word that each stands for.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. A
word's form is its near word of most occurrences if these are ``RATIO`` times its own or more; its
root is the end of the chain of forms.

Near words share a half: if a has m code points and b m or m + 1, they have the first ``m // 2``
code points in common or the last ``m - m // 2``. So every word goes to the slices of its first
and its last half, for m its length and one less. Inside a slice stands a bit-sliced position
index: for each (position, letter) a bitset of the slice's words that have the letter there. A
word runs over its own letters once; word-parallel recurrences on these bitsets keep the words
that match so far without an error, and those that match with one replaced, one inserted
(positions shifted up) or one deleted (shifted down) letter. The bits are in order of occurrences,
so the number of bits set and the lowest one are all that is needed; no pair of words is written.
A pair that shares both halves counts in the slice of the first half only.

A slice with more words than ``SLICE`` is cut into indexes of about ``SLICE`` words by a hash;
each word asks all of them, and only the words of one index are held at a time.

Defined results: null texts hold no words; a null id is read as '' where places to delete a
letter are dealt. Repeated rows count again. An empty table gives no rows. Further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import discard, materialise

MIN_CHARS, MIN_COUNT, RATIO = 6, 5, 5
#: Words of one index.
SLICE = 16_384
#: Letters of a word, and how often a letter goes.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
EVERY = 199

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEYS = ["tail", "m", "half", "part"]
_NEAR = T.StructType([T.StructField("word", T.StringType()), T.StructField("near", T.LongType()),
                      T.StructField("best", T.StringType()), T.StructField("best_n", T.LongType())])


def noisy(run: Column, doc_id: Column) -> Column:
    """The lower-cased run; in one of ``EVERY`` (document, run) pairs without one of its letters."""
    h = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % EVERY == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``word``, ``n``: words of at least ``min_chars`` code points and ``min_count`` occurrences."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{min_chars},}}"), F.lit(0))
    read = docs.select(F.col(id_col).alias("d"), F.explode(runs).alias("run"))
    read = read.select("d", F.translate("run", _UPPER, _LOWER).alias("run"))
    return (read.select(noisy(F.col("run"), F.col("d")).alias("word")).where(F.length("word") >= min_chars)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def _slices(words: DataFrame) -> DataFrame:
    """``words`` (word, n) in the slices of their halves: ``tail`` tells which half, ``m`` the length
    of the slice's shorter words."""
    length = F.length("word")
    places = []
    for shorter in (length, length - 1):
        head = F.floor(shorter / 2).cast("int")
        places.append(F.struct(F.lit(False).alias("tail"), shorter.alias("m"),
                               F.substring("word", F.lit(1), head).alias("half")))
        places.append(F.struct(F.lit(True).alias("tail"), shorter.alias("m"),
                               F.substring("word", length - (shorter - head) + 1, length).alias("half")))
    return words.select("word", "n", F.explode(F.array(*places)).alias("s")).select("s.*", "word", "n")


def _parted(rows: DataFrame, slice_words: int) -> DataFrame:
    """``rows`` with the index ``part`` they ask, and ``own``, whether they stand in it."""
    key = ["tail", "m", "half"]
    sizes = rows.groupBy(*key).agg(F.count("*").alias("size")).where(F.col("size") > 1)
    rows = rows.join(sizes, key).withColumn("parts", F.ceil(F.col("size") / F.lit(slice_words)).cast("int"))
    mine = F.pmod(F.xxhash64("word"), F.col("parts").cast("long")).cast("int")
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.withColumn("own", F.col("part") == mine).drop("size", "parts")


class Index:
    """Bit-sliced index of words of ``m`` and ``m + 1`` letters that share a half. Bit b stands for
    word b. Words that share the last half are indexed from behind."""

    def __init__(self, tail: bool, m: int, words: list[str], counts: list[int]):
        self.tail, self.m, self.head = tail, m, m // 2
        self.same = m - self.head if tail else self.head
        self.words, self.counts = words, counts
        self.all = (1 << len(words)) - 1
        at: dict[tuple[int, str], list[int]] = {}
        heads: dict[str, list[int]] = {}
        longer = []
        for b, word in enumerate(words):
            for i, letter in enumerate(word[::-1] if tail else word):
                if i >= self.same:
                    at.setdefault((i, letter), []).append(b)
            if tail:
                heads.setdefault(word[: self.head], []).append(b)
            if len(word) > m:
                longer.append(b)
        self.at = {k: _bits(v, len(words)) for k, v in at.items()}
        self.heads = {k: _bits(v, len(words)) for k, v in heads.items()}
        self.longer = _bits(longer, len(words))

    def near(self, word: str) -> int:
        """Bits of the near words."""
        get, m = self.at.get, self.m
        letters = word[::-1] if self.tail else word
        exact, one = self.all, 0
        if len(word) == m:
            more = 0
            for i in range(self.same, m):
                here = get((i, letters[i]), 0)
                one = (one & here) | (exact & ~here)
                more = (more | exact) & get((i + 1, letters[i]), 0)
                exact &= here
            found = (one & ~self.longer) | ((more | exact) & self.longer)
        else:
            for i in range(self.same, m + 1):
                one = (one & get((i - 1, letters[i]), 0)) | exact
                exact &= get((i, letters[i]), 0)
            found = one & ~self.longer
        return found & ~self.heads.get(word[: self.head], 0) if self.tail else found


def _bits(places: list[int], n: int) -> int:
    mask = bytearray(n // 8 + 1)
    for b in places:
        mask[b >> 3] |= 1 << (b & 7)
    return int.from_bytes(mask, "little")


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of every row in its index. The rows of an index come first, commonest first."""
    key, words, counts, index, found = None, [], [], None, []

    def answer(word: str) -> None:
        bits = index.near(word)
        if bits:
            first = (bits & -bits).bit_length() - 1
            found.append((word, bits.bit_count(), index.words[first], index.counts[first]))

    def build() -> None:
        nonlocal index
        index = Index(key[0], key[1], words, counts)
        for word in words:
            answer(word)

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (*_KEYS, "own", "word", "n")]
        for *here, own, word, n in zip(*columns):
            if here != key:
                if key and index is None:
                    build()
                key, words, counts, index = here, [], [], None
            if own:
                words.append(word)
                counts.append(n)
                continue
            if index is None:
                build()
            answer(word)
        if len(found) > 20_000:
            yield _found(found)
            found.clear()
    if key and index is None:
        build()
    if found:
        yield _found(found)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_NEAR.names)


def near_words(words: DataFrame, slice_words: int = SLICE) -> DataFrame:
    """``word``, ``n_near``, ``best``, ``best_n``: for the words that have near ones, their number and
    the commonest (the first in order among equals). ``words`` is a stored table (word, n)."""
    rows = _parted(_slices(words), slice_words).repartition(*_KEYS)
    rows = rows.sortWithinPartitions(*_KEYS, F.col("own").desc(), F.col("n").desc(), "word")
    commonest = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best")))
    return (rows.mapInArrow(_ask, _NEAR).groupBy("word").agg(F.sum("near").alias("n_near"), commonest.alias("b"))
            .select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.less")).alias("best_n")))


def _roots(links: DataFrame) -> DataFrame:
    """A stored table of ``word``, ``to``: the ends of the chains of ``links`` (word, to). A link goes to a word ``RATIO``
    times as common, so chains end; every round doubles the steps that a link spans."""
    stored = None
    while True:
        ahead = links.select(F.col("word").alias("to"), F.col("to").alias("further"))
        spanned = links.join(ahead, "to", "left").select("word", F.coalesce("further", "to").alias("to"),
                                                         F.col("further").isNotNull().alias("moved"))
        last, stored = stored, materialise(spanned, "roots")
        if last:
            discard(last)
        if stored.where("moved").isEmpty():
            return stored
        links = stored.select("word", "to")


def group_variants(words: DataFrame, ratio: int = RATIO, slice_words: int = SLICE) -> DataFrame:
    """``words`` (word, n; each word once) with ``n_near``, ``form``, ``form_n`` and ``root``."""
    words = materialise(words.select("word", "n"), "vocabulary")
    near = near_words(words, slice_words)
    has_form = F.col("best_n") >= F.lit(ratio) * F.col("n")
    formed = materialise(
        words.join(near, "word", "left")
        .select("word", F.when(has_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                F.when(has_form, F.col("best_n")).alias("form_n")), "forms")
    roots = _roots(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("to")))
    out = materialise(formed.join(roots, "word", "left")
                      .select("word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n"),
                      "variants")
    discard(words, formed, roots)
    return out
