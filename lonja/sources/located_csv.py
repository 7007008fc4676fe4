"""CSV with the exact position of every record.

Spark's own reader neither gives line numbers nor keeps blank lines, and reads a multi-line file in one
task. Here a file is cut at line starts into chunks of bounded size, whatever the quoting:

1. Every chunk is probed once for its number of lines and for whether it ends inside a quoted field, for
   both cases of how it may begin.
2. The probes of a file, one small row per chunk, are chained in order, which tells how each chunk begins.
3. Every chunk is parsed on its own; it owns the records that start in it. A chunk without any quote is handed to
   Spark as text, in pieces of whole lines, and split there; the others go through the csv module.

A line ends with LF, CRLF or a single CR, as for the csv module.
"""

from __future__ import annotations

import csv
import re
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lonja.sources.files import BLOCK, MAX_TASKS, list_files, open_file

CHUNK = 32 << 20
ROWS_PER_BATCH = 5_000
#: Bytes of lines that Spark splits at once.
PIECE = 1 << 20
LINE_END = re.compile(rb"\r\n|\r|\n")
# Order of a record: number of its file times more than any position in a file, plus its position.
POSITIONS = Decimal(2**63)
ORD = "decimal(38,0)"
BOM = b"\xef\xbb\xbf"

PROBE = pa.schema(
    [
        ("path", pa.string()),
        ("start", pa.int64()),
        ("lines", pa.int64()),
        ("open_after_closed", pa.bool_()),
        ("open_after_open", pa.bool_()),
        ("plain", pa.bool_()),
    ]
)
RECORD = pa.schema(
    [
        ("path", pa.string()),
        ("position", pa.int64()),
        ("start_line", pa.int64()),
        ("end_line", pa.int64()),
        ("cells", pa.list_(pa.string())),
        ("problem", pa.string()),
        ("text", pa.string()),
        ("file", pa.int32()),
    ]
)


def _line_start(stream, offset: int, length: int) -> int:
    """The first start of a line at or after the offset."""
    if offset <= 0:
        return 0
    position = offset - 1
    stream.seek(position)
    while position < length:
        block = stream.read(BLOCK)
        if not block:
            break
        found = LINE_END.search(block)
        if found:
            # The LF of a CRLF may be the first byte of the next block.
            cut = found.end() == len(block) and block.endswith(b"\r")
            return position + found.end() + (cut and stream.read(1) == b"\n")
        position += len(block)
    return length


def _region(stream, start: int, chunk: int, length: int) -> tuple[int, bytes]:
    first = _line_start(stream, start, length)
    last = _line_start(stream, min(start + chunk, length), length)
    stream.seek(first)
    return first, stream.read(max(0, last - first))


def _ends_open(data: bytes, quoted_field: re.Pattern) -> bool:
    """Whether the data, which begins at a record start, ends inside a quoted field."""
    is_open = False
    for match in quoted_field.finditer(data):
        is_open = match.group(1) == b""
    return is_open


def _probe(chunk: int, separator: str):
    mark = re.escape(separator.encode())

    def run(batches):
        quoted_field = re.compile(
            rb'(?:(?<=[' + mark + rb'\r\n])|\A)"(?:[^"]+|"")*+("|\Z)', re.DOTALL
        )
        for batch in batches:
            rows = []
            for path, start, length in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                with open_file(path) as stream:
                    _, data = _region(stream, start, chunk, length)
                lines = data.count(b"\n") + data.count(b"\r") - data.count(b"\r\n")
                body = data[len(BOM):] if start == 0 and data.startswith(BOM) else data
                closed, opened = _ends_open(body, quoted_field), _ends_open(b'"' + body, quoted_field)
                rows.append(dict(zip(PROBE.names, (path, start, lines, closed, opened, b'"' not in data))))
            yield pa.RecordBatch.from_pylist(rows, schema=PROBE)

    return run


def _chain(probes: DataFrame) -> DataFrame:
    """How each chunk begins: open or closed, and how many lines lie before it."""
    after_closed = F.col("open_after_closed").cast("int")
    fixed = F.col("open_after_closed") == F.col("open_after_open")
    swaps = ~fixed & F.col("open_after_closed")
    order = Window.partitionBy("path").orderBy("start")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    turned = probes.withColumn("_turns", F.sum(swaps.cast("int")).over(so_far) % 2)
    base = turned.withColumn(
        "_base",
        F.last(F.when(fixed, (after_closed + F.col("_turns")) % 2), ignorenulls=True).over(so_far),
    )
    ended = base.withColumn("_open", (F.coalesce("_base", F.lit(0)) + F.col("_turns")) % 2)
    return ended.select(
        "path", "start", "plain",
        F.coalesce(F.lag("_open").over(order), F.lit(0)).alias("opens"),
        F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("lines_before"),
    )


class _Lines:
    """Lines of a file from a position on, as decoded text, counting what was handed out."""

    def __init__(self, stream, position: int, data: bytes, encoding: str, inside: bool):
        self.stream, self.position, self.encoding = stream, position, encoding
        self.end = position + len(data)
        self.count = 0
        self.pending = data.splitlines(keepends=True)[::-1]
        self.prefix = '"' if inside else ""
        self.rest = b""

    def _refill(self) -> bool:
        lines: list[bytes] = []
        while not lines:
            data = self.stream.read(BLOCK)
            lines = (self.rest + data).splitlines(keepends=True)
            self.rest = b""
            if not data:
                break
            if not lines[-1].endswith(b"\n"):  # a line that goes on, or a CR whose LF may follow
                self.rest = lines.pop()
        self.pending = lines[::-1]
        return bool(lines)

    def __iter__(self):
        return self

    def __next__(self) -> str:
        if not self.pending and not self._refill():
            raise StopIteration
        line = self.pending.pop()
        if self.position == 0 and self.encoding == "utf-8" and line.startswith(BOM):
            text = line[len(BOM):].decode(self.encoding)
        else:
            text = line.decode(self.encoding)
        self.position += len(line)
        self.count += 1
        prefix, self.prefix = self.prefix, ""
        return prefix + text


def _pieces(path, start, first, data, lines_before, separator, encoding, header):
    """Whole lines of a chunk without quotes, as text for Spark to split; None where the csv module must judge."""
    limit = csv.field_size_limit()
    lines = data.splitlines(keepends=True)
    if lines and max(map(len, lines)) >= limit:
        return None
    try:
        texts = data.removeprefix(BOM if start == 0 and encoding == "utf-8" else b"").decode(encoding)
    except UnicodeError:
        return None
    position, line, rows = first, lines_before + 1, []
    if start == 0:
        head = LINE_END.split(texts.encode(encoding), maxsplit=1)[0].decode(encoding)
        if head.split(separator) != header:
            return None
        position, line, lines = position + len(lines[0]), 2, lines[1:]
    at = 0
    while at < len(lines):
        stop, size = at, 0
        while stop < len(lines) and size < PIECE:
            size += len(lines[stop])
            stop += 1
        text = b"".join(lines[at:stop])
        # The end of the last line would begin another one.
        last = lines[stop - 1]
        text = text[: len(text) - (len(last) - len(last.rstrip(b"\r\n")) if last.strip(b"\r\n") else len(last))]
        rows.append((path, position, line, line, None, None, text.decode(encoding)))
        position, line, at = position + size, line + stop - at, stop
    return rows


def _records(path, start, length, opens, lines_before, plain, chunk, separator, encoding, header):
    """The records that start in one chunk; a structural problem ends the chunk with one marked row."""
    with open_file(path) as stream:
        first, data = _region(stream, start, chunk, length)
        if plain and not opens and (pieces := _pieces(path, start, first, data, lines_before, separator, encoding, header)) is not None:
            yield from pieces
            return
        lines = _Lines(stream, first, data, encoding, bool(opens))
        end = lines.end
        reader = csv.reader(lines, delimiter=separator, strict=True)
        at = lines_before + 1
        position = first
        try:
            if start == 0:
                found = next(reader, None)
                if found != header:
                    yield path, 0, 1, max(1, lines.count), None, "INVALID_HEADER", None
                    return
            elif opens:
                next(reader, None)
            while lines.position < end:
                position = lines.position
                at = lines_before + lines.count + 1
                cells = next(reader, None)
                if cells is None:
                    return
                yield path, position, at, lines_before + lines.count, cells, None, None
        except UnicodeError:
            yield path, position, at, at, None, "INVALID_ENCODING", None
        except csv.Error:
            yield path, position, at, max(at, lines_before + lines.count), None, "INVALID_CSV", None


def _parse(chunk: int, separator: str, encoding: str, header: list[str]):
    def run(batches):
        for batch in batches:
            rows = []
            for *chunk_row, file in zip(*[column.to_pylist() for column in batch.columns]):
                for row in _records(*chunk_row, chunk, separator, encoding, header):
                    rows.append((*row, file))
                    if len(rows) >= ROWS_PER_BATCH:
                        yield _to_batch(rows)
                        rows = []
            if rows:
                yield _to_batch(rows)

    return run


def _to_batch(rows) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), RECORD.types)]
    return pa.RecordBatch.from_arrays(columns, schema=RECORD)


def read_located_csv(
    spark: SparkSession,
    path: str,
    header: list[str],
    separator: str,
    encoding: str,
    chunk: int = CHUNK,
) -> DataFrame:
    """Records below a path: ``ord, locator, cells, problem``.

    ``ord`` grows with the file and the position in it. ``locator`` is the line or line range, with the
    file name before it if there are several files. Rows with a ``problem`` are no records; any of them
    makes the source unusable.
    """
    files = list_files(spark, path)
    totals = files.agg(
        F.count("*").alias("files"),
        F.sum(F.ceil(F.greatest("length", F.lit(1)) / chunk)).alias("chunks"),
    ).first()
    if not totals["files"]:
        # Spark lists no empty files; a source without any content has no header either.
        return spark.range(1).selectExpr(
            f"cast(id as {ORD}) as ord", "'1' as locator", "1L as start_line", "1L as end_line",
            "cast(null as array<string>) as cells", "'INVALID_HEADER' as problem",
        )
    tasks = max(1, min(MAX_TASKS, totals["chunks"]))
    # One small row per file.
    numbered = files.withColumn("file", F.row_number().over(Window.orderBy("path")) - 1)
    last = F.greatest(F.col("length") - 1, F.lit(0))
    chunks = files.select(
        "path", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(chunk).cast("bigint"))).alias("start"), "length"
    ).repartition(tasks, "path", "start")
    probes = chunks.mapInArrow(
        _probe(chunk, separator),
        "path string, start bigint, lines bigint, open_after_closed boolean, open_after_open boolean, plain boolean",
    )
    located = (
        _chain(probes)
        .join(numbered, "path")
        .select("path", "start", "length", "opens", "lines_before", "plain", "file")
        .repartition(tasks, "path", "start")
    )
    records = located.mapInArrow(
        _parse(chunk, separator, encoding, header),
        "path string, position bigint, start_line bigint, end_line bigint, cells array<string>, problem string, text string, file int",
    )
    # Nothing is joined to the records: Spark takes them for as small as the chunks' rows, and would broadcast them.
    # The lines of a piece: the n-th one begins at least n bytes after the piece, so its position may count lines.
    records = records.select("*", F.posexplode_outer(F.split("text", "\r\n|\r|\n")).alias("_n", "_line"))
    own = F.when(F.col("_line") == "", F.array().cast("array<string>")).otherwise(F.split("_line", re.escape(separator)))
    number = F.coalesce("_n", F.lit(0))
    records = records.select(
        "path", (F.col("position") + number).alias("position"), (F.col("start_line") + number).alias("start_line"),
        (F.col("end_line") + number).alias("end_line"), F.when(F.col("text").isNull(), F.col("cells")).otherwise(own).alias("cells"), "problem", "file",
    )
    line = F.when(
        F.col("start_line") == F.col("end_line"), F.col("start_line").cast("string")
    ).otherwise(F.concat_ws("-", "start_line", "end_line"))
    name = F.element_at(F.split("path", "/"), -1)
    return records.select(
        (F.col("file").cast("decimal(18,0)") * F.lit(POSITIONS) + F.col("position")).cast(ORD).alias("ord"),
        (F.concat_ws(":", name, line) if totals["files"] > 1 else line).alias("locator"),
        "start_line",
        "end_line",
        "cells",
        "problem",
    )
