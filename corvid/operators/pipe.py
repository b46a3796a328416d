"""Rows through an external command (PAR-12, ``pipe``).

Every task starts the command once, feeds it the rows of its partition as lines of text and
reads its output lines at the same time, so neither side waits for the other's buffer. Line ends
and backslashes inside values are escaped, so that a row is always one line; NULL is ``\\N``. A
command that ends with another code than 0 fails the task (Spark then retries it), also when
it had already given output. The command must exist on every executor.
"""

from __future__ import annotations

import subprocess
import tempfile
from collections import deque
from collections.abc import Callable, Iterator
from threading import Thread

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Output lines handed on at a time, bytes read at a time, and bytes of rows held as Python objects
#: at a time, in and out: Spark's Arrow batches go by rows first, which may be long.
BATCH_LINES, READ_BYTES, PIECE_BYTES = 10_000, 1 << 16, 1 << 20


def escaped(col: Column) -> Column:
    """Text on one line without tabs: backslash, tab, line feed and carriage return as backslash and
    a letter."""
    for char, code in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        col = F.replace(col, F.lit(char), F.lit(code))
    return col


def unescaped(col: Column) -> Column:
    """Inverse of ``escaped``; ``\\N`` alone is NULL."""
    def plain(part: Column) -> Column:
        for char, code in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            part = F.replace(part, F.lit(code), F.lit(char))
        return part

    # between doubled backslashes a single one always belongs to the letter behind it
    parts = F.transform(F.split(col, "\\\\\\\\", -1), plain)
    return F.when(col != "\\N", F.array_join(parts, "\\"))


def as_line(df: DataFrame, cols: list[str] | None = None, sep: str = "\t") -> DataFrame:
    """One text column ``line`` per row: the values of ``cols`` with ``sep`` between."""
    parts = [F.coalesce(escaped(F.col(c).cast("string")), F.lit("\\N")) for c in cols or df.columns]
    return df.select(F.concat_ws(sep, *parts).alias("line"))


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch (no copies) of about ``PIECE_BYTES``."""
    rows = max(1, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _lines(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


class _Child:
    """The command of one task. Lines are fed by a thread while the task reads."""

    def __init__(self, command: list[str], batches: Iterator, lines_of: Callable, env: dict | None):
        self.errors = tempfile.TemporaryFile()  # what the command says about itself, for the message
        self.run = subprocess.Popen(command, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=self.errors, env=env)
        self.command, self.failure = command, None
        self.feeder = Thread(target=self._feed, args=(batches, lines_of), daemon=True)
        self.feeder.start()

    def _feed(self, batches, lines_of) -> None:
        try:
            for batch in batches:
                for piece in _pieces(batch):
                    for line in lines_of(piece):
                        self.run.stdin.write(line + b"\n")
                self.run.stdin.flush()
        except BrokenPipeError:
            pass  # the command needs no more; its exit code tells whether that is an error
        except BaseException as error:  # of the rows themselves
            self.failure = error
        finally:
            try:
                self.run.stdin.close()
            except BrokenPipeError:
                pass

    def lines(self) -> Iterator[list[str]]:
        """Output lines in portions, until the command has ended; raises if it failed."""
        rest = b""
        while chunk := self.run.stdout.read1(READ_BYTES):
            *whole, rest = (rest + chunk).split(b"\n") if b"\n" in chunk else (rest + chunk,)
            if whole:
                yield [line.decode("utf-8", "replace") for line in whole]
        if rest:
            yield [rest.decode("utf-8", "replace")]
        code = self.run.wait()
        self.feeder.join()
        if self.failure is not None:
            raise self.failure
        if code:
            self.errors.seek(0)
            said = self.errors.read()[-500:].decode("utf-8", "replace").strip()
            raise RuntimeError(f"{' '.join(self.command)} ended with code {code}: {said}")

    def close(self) -> None:
        """Also when the task is stopped early."""
        if self.run.poll() is None:
            self.run.kill()
            self.run.wait()
        self.run.stdout.close()
        self.errors.close()


def pipe(df: DataFrame, command: list[str], cols: list[str] | None = None, sep: str = "\t",
         env: dict[str, str] | None = None, check: bool = True) -> DataFrame:
    """Output lines of ``command``, run once per partition on the rows of ``df`` (column ``line``).
    ``check=False`` takes the output of a command that fails, too. A partition without
    rows runs the command on no lines, unless Spark has optimised the empty plan away."""
    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        child = _Child(command, batches, lambda b: _lines(b.column(0)), env)
        held: list[str] = []
        size = 0
        try:
            try:
                for part in child.lines():
                    held += part
                    size += sum(map(len, part))
                    if len(held) >= BATCH_LINES or size >= PIECE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["line"])
                        held, size = [], 0
            except RuntimeError:
                if check or child.failure is not None:
                    raise
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["line"])
        finally:
            child.close()

    return as_line(df, cols, sep).mapInArrow(through, "line string")


def pipe_column(df: DataFrame, command: list[str], col: str, out: str, env: dict[str, str] | None = None) -> DataFrame:
    """``df`` with ``out``: ``col`` (text) after ``command``, which must give exactly one line per
    line, in order (``sed``, ``tr``, a model's line server). Rows wait in memory only as long as the
    command holds their lines back; a command that gives more or fewer lines fails the task."""
    fed = df.withColumn(out, F.coalesce(escaped(F.col(col).cast("string")), F.lit("\\N")))
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])
    n = len(df.columns)

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: deque[pa.RecordBatch] = deque()

        def lines_of(batch):
            waiting.append(batch)
            return _lines(batch.column(n))

        def done(batch, values):
            return pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(values, pa.string())], names=schema.names)

        child = _Child(command, batches, lines_of, env)
        held: list[str] = []
        try:
            for part in child.lines():
                held += part
                while waiting and len(held) >= waiting[0].num_rows:
                    batch = waiting.popleft()
                    yield done(batch, held[: batch.num_rows])
                    held = held[batch.num_rows:]
            left = sum(b.num_rows for b in waiting)
            if held or left:
                raise RuntimeError(f"{' '.join(command)} gave {len(held)} lines for the last {left} rows")
        finally:
            child.close()

    return fed.mapInArrow(through, schema).withColumn(out, unescaped(F.col(out)))
