"""Token counts of texts under a SentencePiece BPE model, without token ids of any document.

A text is cut into pre-tokens wherever no piece of the vocabulary could join the two sides:
before a run of spaces, on both sides of every character that no piece of several characters
holds, and between a letter and a sign that no piece holds behind a letter. Merges never cross such
a cut, so a text's count is the sum over its pre-tokens. Three steps:

1. every task counts the pre-tokens of its texts; ``groupBy`` adds them up, and the library
   encodes each distinct pre-token once;
2. the texts' own pre-token frequencies meet those counts: pre-tokens that make up at least one
   in ``HOT`` of all occurrences (so there are at most ``HOT`` of them) are broadcast, 12 bytes each,
   and summed where the text is read; the others are rows that a shuffle joins with the counts.
   The broadcast names a pre-token by a 64-bit hash that no other pre-token of the input has;
3. the rows of a text are summed and added to its first sum.

``docs`` is read twice and must give the same rows both times. A stored row is told from its
copies by its position, so repeated rows and ids count each for itself.

Defined results: null and empty texts have 0 bytes and 0 tokens; rows that are equal stay
apart; an empty table gives no rows; new columns whose names are taken get underscores before
them. Working memory grows with the longest text, and with the longest run of characters
without a cut in step 1.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import discard, fresh, materialise, text_portions

#: A pre-token is broadcast if it makes up at least one in HOT of all occurrences.
HOT = 4_000_000
#: Pre-tokens whose counts a worker remembers by name.
KNOWN = 200_000
#: A task hands on its counts when it holds so many pre-tokens, or after so many characters.
HELD, HELD_CHARS = 200_000, 1 << 26
MAX_TOKENS = 4096
#: Fixed value: the character that stands for a space in the pieces.
MARK = "▁"

_COUNTS = T.StructType([T.StructField("piece", T.StringType()), T.StructField("n", T.LongType())])


def _any_of(chars: set[str]) -> str:
    return "[" + "".join(map(re.escape, sorted(chars))) + "]" if chars else "(?!)"


def _hash(piece: str) -> int:
    """64 bits, signed."""
    return xxhash.xxh3_64_intdigest(piece.encode("utf-8", "surrogatepass")) - (1 << 63)


class Hot:
    """Tokens of the pre-tokens that were broadcast, by hash."""

    def __init__(self, hashes: np.ndarray, tokens: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.tokens = hashes[order], tokens[order]
        self.known: dict[str, int] = {}

    def find(self, pieces: list[str]) -> np.ndarray:
        """Tokens of ``pieces``, -1 where a piece was not broadcast."""
        if not len(self.hashes):
            return np.full(len(pieces), -1, dtype=np.int64)
        asked = np.fromiter(map(_hash, pieces), dtype=np.int64, count=len(pieces))
        at = np.minimum(np.searchsorted(self.hashes, asked), len(self.hashes) - 1)
        found = np.where(self.hashes[at] == asked, self.tokens[at], -1)
        if len(self.known) < KNOWN:
            self.known.update((p, n) for p, n in zip(pieces, found.tolist()) if n >= 0)
        return found


class PreTokens:
    """The cuts and the counts of one model."""

    def __init__(self, content: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        size = range(self.model.get_piece_size())
        plain = [self.model.id_to_piece(i) for i in size
                 if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))]
        joined = [p for p in plain if len(p) > 1]
        self._check(joined, any(self.model.is_byte(i) for i in size))
        inner = {c for p in joined for c in p} - {MARK}
        behind = {b for p in joined for a, b in zip(p, p[1:]) if a.isalpha()}
        signs = {c for c in inner if not c.isalpha()} - behind
        sign, other = _any_of(signs), _any_of(inner - signs)
        # signs stand before letters here, never behind them: what comes behind begins anew
        self.cut = re.compile(f" *{sign}*{other}+| *{sign}+| +|[^ ]")
        self.anchor = next(c for c in map(chr, [10, *range(1, 0xD800)]) if c not in inner and c not in (" ", MARK))
        self.base = len(self.model.encode(self.anchor))

    def _check(self, joined: list[str], bytes_known: bool) -> None:
        """The model must be one for which the cuts are right."""
        probe = " Ａ é x  y\t​\n "
        if self.model.normalize(probe) != (MARK + probe).replace(" ", MARK):
            raise ValueError("the model changes texts before it cuts them")
        if not bytes_known:
            raise ValueError("the model has no pieces for bytes: unknown characters side by side would join")
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in joined):
            raise ValueError("the model joins a word with the space behind it")

    def split(self, text: str) -> list[str]:
        """Pre-tokens; the first one of a text has the space that the library puts before it."""
        return self.cut.findall(" " + text.replace(MARK, " ")) if text else []

    def count(self, pieces: list[str]) -> list[int]:
        """Tokens of each pre-token. It is encoded behind a character that joins with nothing."""
        return [len(ids) - self.base for ids in self.model.encode([self.anchor + p for p in pieces], num_threads=1)]


_MODELS: dict[str, PreTokens] = {}
_HOT: dict[str, Hot] = {}


def _model(shared) -> PreTokens:
    name, content = shared.value
    if name not in _MODELS:
        _MODELS[name] = PreTokens(content)
    return _MODELS[name]


def _hot(shared) -> Hot:
    """This worker's table of the last broadcast."""
    name, hashes, tokens = shared.value
    if name not in _HOT:
        _HOT.clear()
        _HOT[name] = Hot(hashes, tokens)
    return _HOT[name]


def _tally(texts: DataFrame, shared) -> DataFrame:
    """``piece``, ``n``: occurrences of the pre-tokens, a row for each task that holds one."""
    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, chars = _model(shared).split, Counter(), 0
        for batch in batches:
            for part in text_portions(batch.column(0)):
                for text in part:
                    held.update(split(text))
                    chars += len(text)
                    if len(held) > HELD or chars > HELD_CHARS:
                        yield from _counts_of(held)
                        held, chars = Counter(), 0
        yield from _counts_of(held)

    return texts.mapInArrow(tallied, _COUNTS)


def _counts_of(held: Counter) -> Iterator[pa.RecordBatch]:
    table = pa.table({"piece": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})
    yield from table.to_batches(max_chunksize=20_000)


def _encoded(pieces: DataFrame, shared) -> DataFrame:
    """``pieces`` with ``tokens`` and ``hash``: each distinct pre-token is encoded once."""
    schema = T.StructType([*pieces.schema.fields, T.StructField("tokens", T.LongType()),
                           T.StructField("hash", T.LongType())])
    at = pieces.columns.index("piece")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, hashes = [], []
            for part in text_portions(batch.column(at)):
                tokens += _model(shared).count(part)
                hashes += map(_hash, part)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.int64()), pa.array(hashes, pa.int64())],
                                             names=schema.names)

    return pieces.mapInArrow(counted, schema)


def _frequencies(docs: DataFrame, text_col: str, shared, hot, new: list[str], keep_text: bool) -> DataFrame:
    """Per text its bytes, the tokens of its hot pre-tokens, and the others with their frequency."""
    at = docs.columns.index(text_col)
    kept = [i for i in range(len(docs.columns)) if keep_text or i != at]
    rare = T.ArrayType(T.StructType([T.StructField("piece", T.StringType()), T.StructField("f", T.LongType())]))
    schema = T.StructType([*(docs.schema.fields[i] for i in kept), T.StructField(new[0], T.LongType()),
                           T.StructField(new[1], T.LongType()), T.StructField(new[2], rare)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, table = _model(shared).split, _hot(hot)
        known = table.known.get
        for batch in batches:
            done = 0
            for part in text_portions(batch.column(at)):
                size, tokens, of, pieces, times = [], [], [], [], []
                for i, text in enumerate(part):
                    total = 0
                    for piece, f in Counter(split(text)).items():
                        n = known(piece)
                        if n is None:
                            of.append(i)
                            pieces.append(piece)
                            times.append(f)
                        else:
                            total += n * f
                    size.append(len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass")))
                    tokens.append(total)
                found, of, times = table.find(pieces), np.array(of, dtype=np.int64), np.array(times, dtype=np.int64)
                near = np.array(tokens, dtype=np.int64)
                np.add.at(near, of[found >= 0], (found * times)[found >= 0])
                far = np.flatnonzero(found < 0)
                rows = pa.StructArray.from_arrays([pa.array([pieces[j] for j in far.tolist()], pa.string()),
                                                   pa.array(times[far])], names=["piece", "f"])
                ends = np.searchsorted(of[far], np.arange(len(part) + 1)).astype(np.int32)
                here = batch.slice(done, len(part))
                done += len(part)
                yield pa.RecordBatch.from_arrays(
                    [*(here.column(i) for i in kept), pa.array(size, pa.int64()), pa.array(near),
                     pa.ListArray.from_arrays(pa.array(ends), rows)], names=schema.names)

    return docs.mapInArrow(read, schema)


def count_tokens(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS, text_col: str = "text",
                 keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` as the model file ``path`` gives them without
    begin and end tokens, and ``over_limit``, whether these are more than ``max_tokens``."""
    with open(path, "rb") as file:
        content = file.read()
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((hashlib.sha256(content).hexdigest(), content))

    pieces = _tally(docs.select(text_col), shared).groupBy("piece").agg(F.sum("n").alias("n"))
    pieces = materialise(_encoded(pieces, shared), "piece-counts")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    # a hash that two pre-tokens share names neither
    often = (pieces.groupBy("hash").agg(F.count("*").alias("names"), F.max("n").alias("n"), F.max("tokens").alias("tokens"))
             .where((F.col("names") == 1) & (F.col("n") * HOT >= total)))
    table = often.select("hash", F.col("tokens").cast("int").alias("tokens")).toArrow()
    hot = context.broadcast((uuid.uuid4().hex, *(table.column(c).to_numpy() for c in ("hash", "tokens"))))

    n_bytes, n_tokens, over = (fresh(docs, c) for c in ("n_bytes", "n_tokens", "over_limit"))
    near, far, rare, row = (fresh(docs, c) for c in ("_near", "_far", "_rare", "_row"))
    read = _frequencies(docs, text_col, shared, hot, [n_bytes, near, rare], keep_text)
    read = materialise(read.withColumn(row, F.monotonically_increasing_id()), "piece-frequencies")
    rows = read.select(row, F.explode(rare).alias("r")).select(row, "r.piece", "r.f")
    known = F.when(F.col("tokens").isNull(), F.raise_error(F.lit("docs gave other texts when read again")))
    sums = (rows.join(pieces.select("piece", "tokens"), "piece", "left")
            .groupBy(row).agg(F.sum(F.col("f") * known.otherwise(F.col("tokens"))).alias(far)))
    out = read.drop(rare).join(sums, row, "left")
    out = out.withColumn(n_tokens, F.col(near) + F.coalesce(far, F.lit(0))).drop(near, row, far)
    out = materialise(out.withColumn(over, F.col(n_tokens) > max_tokens), "token-counts")
    discard(pieces, read)
    return out
