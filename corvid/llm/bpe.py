"""Byte-level BPE encoding and decoding with recursive DuckDB queries in each partition.

Encoding: a pattern splits a text into pieces; the bytes of the pieces that a task hasn't
met before become rows (word, position, token). A recursive query joins neighbouring tokens with
the merge table, finds each word's pair of lowest rank, leftmost on ties, contracts it, and ends when
no word has a pair left. Pieces that are tokens themselves are taken as they are.

A recursive query holds the rows of all its steps. Pieces of more than ``LONG`` bytes take another
one, which contracts in a step all pairs that are sure to be contracted as they are, and is started
again from its last rows every few steps, so that it holds ``STEP_ROWS`` rows or those of two steps.
A pair of tokens is sure if its rank is below that of any pair that its first token can be in with
a token that ends as the one before does (that one may still grow), no higher than that of any
pair of its second token and one that begins as the one behind, and below those that its
contraction can be in. Where no token can reach across, a word falls into parts of their own. The
pairs of a part's lowest rank are sure from the left on, without overlap, up to the first whose
contraction can be in a lower one.

Decoding: rows (document, position, id) join the vocabulary; an aggregation in order of the
positions strings the tokens' bytes together.

Work is bounded per task: texts are taken in portions, new pieces in batches, and the memory
of known pieces is emptied by half when it holds ``KNOWN`` pieces. DuckDB runs in the task's
process on one thread, in memory only: it has no folder to spill to.

Defined results: null and empty texts have no ids and decode to no bytes. Repeated rows are
encoded each. Lone surrogates can't occur in Spark strings. Ids without a token raise an error
in decoding; a null id array decodes to no bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corvid.llm.common import add_columns, fresh, portions, text_portions

#: Pieces that a task remembers, and new pieces merged at a time.
KNOWN = 300_000
NEW_PIECES = 50_000
#: Bytes from which on a piece is long, and rows that the query of the long ones holds.
LONG = 48
STEP_ROWS = 2_000_000

# The scripts' classes for texts below U+0250, where they are small: letters,
# numbers and white space as the split pattern's classes have them.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"
_BEYOND = re.compile("[ɐ-\U0010ffff]")
_QUICK = re.compile(f" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")

MERGE_SQL = """
WITH RECURSIVE step(n, w, p, nx, t, t2) AS (
  SELECT 0, w, p, nx, t, t2 FROM base
  UNION ALL
  (WITH best AS (
     SELECT s.w, arg_min(struct_pack(p := s.p, nx := s.nx, r := m.r), m.r::BIGINT * 2147483648 + s.p) AS b
     FROM step s JOIN merges m ON m.a = s.t AND m.b = s.t2 GROUP BY s.w),
   gone AS (
     SELECT best.w, b.p AS bp, b.nx AS bn, b.r AS br, s.nx AS gnx, s.t2 AS gt2
     FROM best JOIN step s ON s.w = best.w AND s.p = best.b.nx)
   SELECT n + 1, s.w, s.p, CASE WHEN s.p = bp THEN gnx ELSE s.nx END,
          CASE WHEN s.p = bp THEN br ELSE s.t END,
          CASE WHEN s.p = bp THEN gt2 WHEN s.nx = bp THEN br ELSE s.t2 END
   FROM step s JOIN gone USING (w) WHERE s.p <> bn))
SELECT w, string_agg(t::VARCHAR, ',' ORDER BY p) AS ids
FROM step JOIN (SELECT w, max(n) AS n FROM step GROUP BY w) USING (w, n) GROUP BY w
"""
LONG_SQL = """
CREATE OR REPLACE TABLE stepped AS
WITH RECURSIVE step(n, w, g, p, t) AS (
  SELECT 0, w, g, p, t FROM pieces
  UNION ALL
  (WITH tokens AS (
     SELECT *, row_number() OVER o AS i, lag(t) OVER o AS t0, lead(t) OVER o AS t2, lead(t, 2) OVER o AS t3
     FROM step WHERE n < $steps WINDOW o AS (PARTITION BY w, g ORDER BY p)),
   parts AS (
     SELECT s.*, max(CASE WHEN x.a IS NULL THEN p END) OVER (PARTITION BY w, g ORDER BY p ROWS UNBOUNDED PRECEDING) AS h
     FROM tokens s LEFT JOIN across x ON x.a = t0 AND x.b = t),
   pairs AS (
     SELECT w, g, h, i, m.r, (e.r IS NULL OR m.r < e.r) AND (v.r IS NULL OR m.r < v.r) AS safe,
            safe AND (x.r IS NULL OR m.r < x.r) AND (y.r IS NULL OR m.r <= y.r) AS sure
     FROM parts JOIN merges m ON m.a = t AND m.b = t2
       LEFT JOIN before x ON x.a = t0 AND x.b = t LEFT JOIN behind y ON y.a = t2 AND y.b = t3
       LEFT JOIN before e ON e.a = t0 AND e.b = m.r LEFT JOIN behind v ON v.a = m.r AND v.b = t3),
   lowest AS (
     SELECT w, g, h, i, r, safe, row_number() OVER (PARTITION BY w, h ORDER BY i) AS k
     FROM pairs JOIN (SELECT w, h, min(r) AS r FROM pairs GROUP BY w, h) USING (w, h, r)),
   chosen AS (
     SELECT w, g, i, r FROM pairs WHERE sure
     UNION
     SELECT w, g, i, r FROM (
       SELECT *, row_number() OVER (PARTITION BY w, h, i - k ORDER BY i) AS place,
              min(k) FILTER (WHERE NOT safe) OVER (PARTITION BY w, h) AS last FROM lowest)
     WHERE place % 2 = 1 AND (last IS NULL OR k <= last))
   SELECT n + 1, s.w, h, p, coalesce(c.r, t)
   FROM parts s LEFT JOIN chosen c ON c.w = s.w AND c.g = s.g AND c.i = s.i
     LEFT JOIN chosen d ON d.w = s.w AND d.g = s.g AND d.i = s.i - 1
   WHERE d.i IS NULL AND (s.w, s.g) IN (SELECT (w, g) FROM chosen)))
SELECT w, g, n, p, t FROM step JOIN (SELECT w, g, max(n) AS n FROM step GROUP BY w, g) USING (w, g, n)
"""
DECODE_SQL = """
SELECT d, string_agg(s, '' ORDER BY p) AS s, count(s) AS n
FROM tokens LEFT JOIN vocabulary USING (id) GROUP BY d
"""


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: lines of a base64 token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


class Codec:
    """Encoder and decoder of one rank file, held by a Python worker."""

    def __init__(self, content: bytes, pattern: str):
        self.ranks = read_ranks(content)
        self.exact = regex.compile(pattern)
        self.pattern = pattern
        self.known: dict[str, str] = {}
        ranks = self.ranks
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks]
        a, b, r = (pa.array(x, pa.int32()) for x in zip(*pairs)) if pairs else [pa.array([], pa.int32())] * 3
        self.tables = {"merges": pa.table({"a": a, "b": b, "r": r})}
        # a byte is a character of the same number, so tokens are strings that join as bytes do
        self.tables["vocabulary"] = pa.table({"id": pa.array(list(ranks.values()), pa.int32()),
                                              "s": pa.array([t.decode("latin-1") for t in ranks])})
        self.threats: dict[str, pa.Table] = {}
        self.connection = None
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)

    @property
    def duck(self) -> duckdb.DuckDBPyConnection:
        """A database in memory with the merge table and the vocabulary, until ``rest``."""
        if self.connection is None:
            self.connection = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
            for name, table in self.tables.items():
                self.connection.register("given", table)
                self.connection.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
                self.connection.unregister("given")
        return self.connection

    def rest(self) -> None:
        """Give back the database's memory; known pieces stay."""
        if self.connection is not None:
            self.connection.close()
            self.connection = None

    def split(self, text: str) -> list[str]:
        quick = self.pattern == _GPT_PATTERN and not _BEYOND.search(text)
        return _QUICK.findall(text) if quick else self.exact.findall(text)

    def _threats(self) -> dict[str, pa.Table]:
        """The lowest rank of the pairs that neighbours ``a`` and ``b`` can become: ``before`` if only
        ``a`` still grows, ``behind`` if only ``b`` does, ``across`` if both may."""
        if not self.threats:
            token, ranks = {r: t for t, r in self.ranks.items()}, self.ranks
            ends = {r: [ranks[t[i:]] for i in range(len(t)) if t[i:] in ranks] for r, t in token.items()}
            starts = {r: [ranks[t[:i]] for i in range(1, len(t) + 1) if t[:i] in ranks] for r, t in token.items()}
            before: dict[tuple[int, int], int] = {}
            behind: dict[tuple[int, int], int] = {}
            across: dict[tuple[int, int], int] = {}
            for r, a, b in sorted(zip(*(self.tables["merges"][c].to_pylist() for c in "rab"))):
                for end in ends[a]:
                    before.setdefault((end, b), r)
                    for start in starts[b]:
                        across.setdefault((end, start), r)
                for start in starts[b]:
                    behind.setdefault((a, start), r)
            for name, lowest in (("before", before), ("behind", behind), ("across", across)):
                columns = zip(*((a, b, r) for (a, b), r in lowest.items())) if lowest else [[]] * 3
                self.threats[name] = pa.table({c: pa.array(x, pa.int32()) for c, x in zip("abr", columns)})
        return self.threats

    def _merge_long(self, pieces: list[bytes]) -> dict[int, str]:
        """Ids of ``pieces`` by number."""
        for name, table in self._threats().items():
            self.duck.register("given", table)
            self.duck.execute(f"CREATE TABLE IF NOT EXISTS {name} AS SELECT * FROM given")
        token = self.byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        word = np.repeat(np.arange(len(pieces), dtype=np.int32), [len(b) for b in pieces])
        self.duck.register("given", pa.table({"w": word, "p": np.arange(len(token), dtype=np.int64), "t": token}))
        self.duck.execute("CREATE OR REPLACE TABLE pieces AS SELECT w, min(p) OVER (PARTITION BY w) AS g, p, t FROM given")
        self.duck.execute("CREATE OR REPLACE TABLE ended (w INT, p BIGINT, t INT)")
        self.duck.unregister("given")
        rows = len(token)
        while rows:
            steps = max(1, STEP_ROWS // rows - 1)
            self.duck.execute(LONG_SQL, {"steps": steps})
            self.duck.execute("INSERT INTO ended SELECT w, p, t FROM stepped WHERE n < $steps", {"steps": steps})
            rows = self.duck.execute("CREATE OR REPLACE TABLE pieces AS SELECT w, g, p, t FROM stepped "
                                     "WHERE n = $steps", {"steps": steps}).fetchone()[0]
        out = self.duck.execute("SELECT w, string_agg(t::VARCHAR, ',' ORDER BY p) FROM ended GROUP BY w").fetchall()
        self.duck.execute("DROP TABLE pieces; DROP TABLE stepped; DROP TABLE ended")
        return dict(out)

    def _merge(self, pieces: list[str]) -> None:
        """Learn the ids of ``pieces``."""
        raw = [p.encode() for p in pieces]
        self.known.update((p, str(self.ranks[b])) for p, b in zip(pieces, raw) if b in self.ranks)
        longest = [i for i, b in enumerate(raw) if b not in self.ranks and len(b) > LONG]
        if longest:
            for i, ids in self._merge_long([raw[i] for i in longest]).items():
                self.known[pieces[longest[i]]] = ids
        long = [i for i, b in enumerate(raw) if b not in self.ranks and len(b) <= LONG]
        if not long:
            return
        length = np.array([len(raw[i]) for i in long])
        token = self.byte[np.frombuffer(b"".join(raw[i] for i in long), dtype=np.uint8)]
        word = np.repeat(np.arange(len(long), dtype=np.int32), length)
        place = (np.arange(len(token)) - np.repeat(np.cumsum(length) - length, length)).astype(np.int32)
        after = np.where(place == np.repeat(length, length) - 1, -1, np.append(token[1:], -1)).astype(np.int32)
        self.duck.register("base", pa.table({"w": word, "p": place, "nx": (place + 1).astype(np.int32),
                                             "t": token, "t2": after}))
        for w, ids in self.duck.execute(MERGE_SQL).fetchall():
            self.known[pieces[long[w]]] = ids
        self.duck.unregister("base")

    def encode(self, texts: list[str]) -> list[str]:
        """Per text the decimal ids joined by commas."""
        if len(self.known) > KNOWN:
            for piece in list(self.known)[: len(self.known) // 2]:
                del self.known[piece]
        split = [self.split(t) for t in texts]
        new = list({p for pieces in split for p in pieces if p not in self.known})
        for part in portions(sorted(new, key=len), chars=8 * NEW_PIECES):
            self._merge(part)
        known = self.known
        return [",".join([known[p] for p in pieces]) for pieces in split]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """Per array of ids the bytes of its tokens."""
        length = np.array([len(x) for x in ids], dtype=np.int64)
        total = int(length.sum())
        out = [b""] * len(ids)
        if not total:
            return out
        self.duck.register("tokens", pa.table({
            "d": np.repeat(np.arange(len(ids), dtype=np.int32), length), "p": np.arange(total, dtype=np.int64),
            "id": np.concatenate(ids).astype(np.int32)}))
        for d, s, n in self.duck.execute(DECODE_SQL).fetchall():
            if n != length[d]:
                raise ValueError("an id has no token in the vocabulary")
            out[d] = s.encode("latin-1")
        self.duck.unregister("tokens")
        return out


#: Fixed value: the split pattern that the quick form above equals below U+0250.
_GPT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CODECS: dict[tuple[str, str], Codec] = {}


def _codec(shared, pattern: str) -> Codec:
    """This worker's codec of a broadcast rank file."""
    name, content = shared.value
    if (name, pattern) not in _CODECS:
        _CODECS[name, pattern] = Codec(content, pattern)
    return _CODECS[name, pattern]


def _rest() -> None:
    for codec in _CODECS.values():
        codec.rest()


def _ship(df: DataFrame, path: str):
    """Broadcast the rank file (a vocabulary, about 1 MB) with a name for its content."""
    with open(path, "rb") as file:
        content = file.read()
    return df.sparkSession.sparkContext.broadcast((hashlib.sha256(content).hexdigest(), content))


def _id_array(joined: str) -> np.ndarray:
    return np.fromstring(joined, dtype=np.int64, sep=",") if joined else np.zeros(0, dtype=np.int64)


def encode(docs: DataFrame, path: str, pattern: str, out: str = "ids", text_col: str = "text") -> DataFrame:
    """``docs`` with ``out``, the array of token ids of every text."""
    shared, at = _ship(docs, path), docs.columns.index(text_col)

    def encoded(batch):
        codec, arrays = _codec(shared, pattern), []
        for texts in text_portions(batch.column(at)):
            arrays += [_id_array(x) for x in codec.encode(texts)]
        return [pa.array(arrays, pa.list_(pa.int64()))]

    return add_columns(docs, encoded, [T.StructField(fresh(docs, out), T.ArrayType(T.LongType()))], _rest)


def decode(docs: DataFrame, path: str, pattern: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out``, the bytes of the tokens of ``ids_col``."""
    shared, at = _ship(docs, path), docs.columns.index(ids_col)

    def decoded(batch):
        ids = [np.array([] if x is None else x, dtype=np.int64) for x in batch.column(at).to_pylist()]
        return [pa.array(_codec(shared, pattern).decode(ids), pa.binary())]

    return add_columns(docs, decoded, [T.StructField(fresh(docs, out), T.BinaryType())], _rest)


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text",
               with_ids: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas) and
    ``decoded_sha256`` (of the bytes that the ids decode to), in one pass over the texts; with
    ``ids`` too if wanted."""
    shared, at = _ship(docs, path), docs.columns.index(text_col)

    def tripped(batch):
        codec, counts, of_ids, of_bytes, kept = _codec(shared, pattern), [], [], [], []
        for texts in text_portions(batch.column(at), 1 << 20):
            joined = codec.encode(texts)
            arrays = [_id_array(x) for x in joined]
            counts += [len(a) for a in arrays]
            of_ids += [hashlib.sha256(x.encode()).hexdigest() for x in joined]
            of_bytes += [hashlib.sha256(x).hexdigest() for x in codec.decode(arrays)]
            kept += arrays if with_ids else []
        out = [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
        return out + [pa.array(kept, pa.list_(pa.int64()))] * with_ids

    fields = [T.StructField(fresh(docs, "n_tokens"), T.LongType()),
              T.StructField(fresh(docs, "ids_sha256"), T.StringType()),
              T.StructField(fresh(docs, "decoded_sha256"), T.StringType())]
    ids = [T.StructField(fresh(docs, "ids"), T.ArrayType(T.LongType()))] * with_ids
    return add_columns(docs, tripped, fields + ids, _rest)
