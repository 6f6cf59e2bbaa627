"""Records of large JSON array files, read by many tasks.

A feed file is one array, ``[{...}, {...}]``, often on a single line, so a reader of lines or of whole files gives it to one
task. Here Spark's text reader cuts the files into its usual byte ranges, with ``}`` as the end of a line; what a
range means depends on what stands before it: whether it begins inside a string, and how deep in brackets. The first scan
sums up each range for both cases, quotes and brackets; windows over these few rows then tell every range its start. The second
scan cuts the records out. A record that goes over a border comes out in parts, which are put together by the range in
which it begins.

Files that hold one object, or objects one after the other, are read as well. Text is never held beyond one batch and one record.
A record that breaks off at the end of its file gets the closing brace that is missing there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_END = "}"
#: A string, closed or open at the end of the text, or a bracket.
_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*("?)|[{\[]|[}\]]', re.S)
_REST_OF_STRING = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*("?)', re.S)


class Lexer:
    """Brackets outside of strings, over texts that follow each other."""

    def __init__(self, in_string: bool = False):
        self.in_string = in_string

    def brackets(self, text: str) -> Iterator[tuple[int, int]]:
        """(place, +1 or -1) of each bracket."""
        at = 0
        if self.in_string:
            rest = _REST_OF_STRING.match(text)
            self.in_string, at = not rest[1], rest.end()
        for token in _TOKEN.finditer(text, at):
            first = text[token.start()]
            if first == '"':
                self.in_string = not token[1]
            else:
                yield token.start(), 1 if first in "{[" else -1


def _blocks(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple[tuple, str]]:
    """((file, block, *more), text) of each run of rows of one byte range."""
    for batch in batches:
        files = batch.column("file").dictionary_encode().indices.to_numpy()
        blocks = batch.column("block").to_numpy()
        lines = batch.column("line").to_pylist()
        changes = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        edges = [0, *changes.tolist(), len(lines)]
        for start, end in zip(edges, edges[1:]):
            if end > start:
                yield tuple(batch.column(c)[start].as_py() for c in ("file", "block", *more)), _END.join(lines[start:end]) + _END


def byte_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, line``: the files' text, cut after each closing brace; lines of a range are in order."""
    text = spark.read.option("lineSep", _END).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each byte range, begun outside (0) and inside (1) of a string: end, change of depth, least depth."""
    names = ["file", "block", "first", "inside0", "depth0", "least0", "inside1", "depth1", "least1"]
    types = [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
    current, first, lexers, depth, least = None, "", (), [], []

    def row() -> pa.RecordBatch:
        values = [*current, first, *(v for k in (0, 1) for v in (lexers[k].in_string, depth[k], least[k]))]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    for key, text in _blocks(batches):
        if key != current:
            if current is not None:
                yield row()
            current, first, lexers, depth, least = key, "", (Lexer(False), Lexer(True)), [0, 0], [0, 0]
        first = first or text.lstrip(" \t\r\n\ufeff")[:1]
        for k, lexer in enumerate(lexers):
            for _, step in lexer.brackets(text):
                depth[k] += step
                least[k] = min(least[k], depth[k])
    if current is not None:
        yield row()


def range_starts(ranges: DataFrame) -> DataFrame:
    """``file, block, inside, depth, base, begun``: how each byte range starts.

    ``base`` is the depth at which records stand, 1 in an array. ``begun`` is the range in which the record begins that is
    open at the start; null if none is.
    """
    sums = ranges.mapInArrow(
        _summed,
        "file string, block long, first string, inside0 boolean, depth0 long, least0 long, inside1 boolean, depth1 long, least1 long",
    )
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # a range ends inside or outside whatever it began with, or as it began, or the other way round
    fixed, turns = F.col("inside0") == F.col("inside1"), F.col("inside0") & ~F.col("inside1")
    sums = sums.withColumn("turned", F.sum(turns.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    since = F.coalesce(F.last("turned").over(before), F.lit(0)) - F.coalesce(F.last(F.when(fixed, F.col("turned")), ignorenulls=True).over(before), F.lit(0))
    inside = F.coalesce(F.last(F.when(fixed, F.col("inside0")), ignorenulls=True).over(before), F.lit(False)) != (since % 2 == 1)
    opened = F.when(F.col("inside"), F.col("depth1")).otherwise(F.col("depth0"))
    least = F.when(F.col("inside"), F.col("least1")).otherwise(F.col("least0"))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = (
        sums.withColumn("inside", inside)
        .withColumn("depth", F.coalesce(F.sum(opened).over(before), F.lit(0)))
        .withColumn("base", F.when(F.first("first").over(whole) == "[", 1).otherwise(0))
    )
    free = (F.col("depth") <= F.col("base")) | (F.col("depth") + least <= F.col("base"))  # at some place in the range
    starts = known.withColumn("begun", F.last(F.when(free, F.col("block")), ignorenulls=True).over(before))
    return starts.select("file", "block", "inside", "depth", "base", F.when(F.col("depth") > F.col("base"), F.col("begun")).alias("begun"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``file, begun, block, record``: whole records (begun null), and parts of records that go over a border."""
    current, depth, base, lexer, parts = None, 0, 0, Lexer(), []
    begun: int | None = None  # of the record that is open, if it began in an earlier range

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        columns = zip(*rows) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["file", "begun", "block", "record"])

    def left() -> list[tuple]:
        """The open record at the end of a range: a part."""
        return [(current[0], current[1] if begun is None else begun, current[1], "".join(parts))] if depth > base and parts else []

    for (file, block, inside, start_depth, start_base, start_begun), text in _blocks(batches, "inside", "depth", "base", "begun"):
        rows = []
        if (file, block) != current:
            rows += left()
            current, depth, base, lexer, parts, begun = (file, block), start_depth, start_base, Lexer(inside), [], start_begun
        start = 0  # where the open record goes on in this text
        for place, step in lexer.brackets(text):
            if depth == base and step > 0:
                start, parts, begun = place, [], None
            depth += step
            if depth == base and step < 0:
                record = "".join((*parts, text[start : place + 1]))
                rows.append((file, begun, block, record))
                parts, begun = [], None
        if depth > base:
            parts.append(text[start:])
        yield batch(rows)
    if current is not None:
        yield batch(left())


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the JSON text of each element of array files, each once; elements without brackets are no records."""
    ranges = byte_ranges(spark, path)
    starts = F.broadcast(range_starts(ranges))  # a row for each byte range of the scan
    placed = ranges.join(starts, ["file", "block"]).select("file", "block", "inside", "depth", "base", "begun", "line")
    pieces = placed.mapInArrow(_cut, "file string, begun long, block long, record string")
    parts = pieces.where("begun is not null").groupBy("file", "begun").agg(F.array_sort(F.collect_list(F.struct("block", "record"))).alias("parts"))
    joined = parts.select(F.array_join(F.transform("parts", lambda p: p["record"]), "").alias("record"))
    return pieces.where("begun is null").select("record").unionByName(joined)
