"""CSV whose quoted fields hold line breaks, read by many tasks a file.

Spark's multi-line reader gives a whole file to one task. Here files are read
as lines, in byte ranges like any text. Whether a range begins inside quotes
follows from the number of quotes before it, so a first pass counts quotes
per range, and a running sum over a file's ranges (one small row each) tells every
range its start. The second pass puts lines together to records; only those
of several lines are touched one by one. A record that goes over the end of a range
comes out in fragments, one or two a range, which are joined afterwards: a third
pass goes over the ranges that begin or end inside quotes, few of all.

Files must be UTF-8 with quotes as RFC 4180 has them: around whole fields,
doubled inside. A quote inside an unquoted field would count as one, so such
files fail in parsing. Lines may end in LF or CRLF.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_BYTES

_WHOLE, _BEGINS, _GOES_ON = 0, 1, 2
_QUOTE = '"'
# Bytes of a range's row in the table of starts.
_RANGE_BYTES = 64


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``value, file, start``: lines in order within a range of a file."""
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _starts(lines: DataFrame) -> DataFrame:
    """``file, start, inside, torn``: whether a range begins inside quotes, and whether
    it begins or ends so."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit(_QUOTE), F.lit("")))
    ranges = lines.groupBy("file", "start").agg(F.sum(quotes).alias("n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1
    return ranges.select("file", "start", "n", inside.alias("inside")).select(
        "file", "start", "inside", (F.col("inside") | (F.col("n") % 2 == 1)).alias("torn"))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of ranges, in order, to records and fragments: ``file, start, seq, kind, value``."""
    import pyarrow.compute as pc
    where, seq = None, 0
    held: list[str] = []  # lines of a record that is not closed yet
    held_kind, inside = _BEGINS, False

    def rows(seqs, kinds, values):
        return pa.record_batch([pa.array(np.full(len(seqs), where[0], np.int64)), pa.array(np.full(len(seqs), where[1], np.int64)),
                                pa.array(seqs, pa.int64()), pa.array(kinds, pa.int32()), values],
                               names=["file", "start", "seq", "kind", "value"])

    for batch in batches:
        keys = np.stack([batch.column(1).to_numpy(), batch.column(2).to_numpy()])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            here = (int(keys[0, a]), int(keys[1, a]))
            if here != where:
                if held:
                    yield rows([seq], [held_kind], pa.array(["\n".join(held)], pa.string()))
                where, seq, held = here, 0, []
                inside = bool(batch.column(3)[a].as_py())
                held_kind = _GOES_ON if inside else _BEGINS
            values = batch.column(0).slice(a, b - a)
            closed = (np.cumsum(pc.count_substring(values, _QUOTE).to_numpy(zero_copy_only=False)) + inside) % 2 == 0
            alone = closed & np.append(not inside, closed[:-1])  # a line that is a record
            # The other lines one by one: only those of quoted line breaks.
            joined, kinds = [], []
            others = pa.array(~alone)
            for line, end in zip(values.filter(others).to_pylist(), closed[~alone].tolist()):
                held.append(line)
                if end:
                    joined.append("\n".join(held))
                    kinds.append(_GOES_ON if held_kind == _GOES_ON else _WHOLE)
                    held, held_kind = [], _BEGINS
            inside = not bool(closed[-1])
            ends = np.flatnonzero(closed)  # of records, in order
            if len(ends):
                single = alone[ends]
                kind = np.full(len(ends), _WHOLE, np.int32)
                kind[~single] = kinds
                at = np.where(single, np.cumsum(single) - 1, int(single.sum()) + np.cumsum(~single) - 1)
                out = pa.concat_arrays([values.filter(pa.array(alone)), pa.array(joined, values.type)]).take(pa.array(at))
                if pc.any(pc.ends_with(out, "\r")).as_py():
                    out = pc.replace_substring_regex(out, "\r\\z", "")
                yield rows(np.arange(seq, seq + len(ends)), kind, out)
                seq += len(ends)
    if held:
        yield rows([seq], [held_kind], pa.array(["\n".join(held)], pa.string()))


def _marked(lines: DataFrame, starts: DataFrame, small: bool) -> DataFrame:
    """``value, file, start, inside``: the lines of the ranges in ``starts``, each range's in order."""
    if small:
        return lines.join(F.broadcast(starts), ["file", "start"]).select("value", "file", "start", "inside")
    # Ranges too many to broadcast: lines are brought back into order.
    return lines.withColumn("at", F.monotonically_increasing_id()).join(starts, ["file", "start"]) \
        .repartition("file", "start").sortWithinPartitions("file", "start", "at").select("value", "file", "start", "inside")


def quoted_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``value``: the records of the files, without each file's first (its header) and
    without empty ones."""
    lines, starts = _lines(spark, paths), _starts(_lines(spark, paths))
    # A split has a range or more, each of a file of its own; no line is read to know that.
    ranges = lines.rdd.getNumPartitions() + len(lines.inputFiles())
    small = ranges * _RANGE_BYTES <= MAX_BROADCAST_BYTES
    fields = "file bigint, start bigint, seq bigint, kind int, value string"
    whole = _marked(lines, starts, small).mapInArrow(_assemble, fields).where(F.col("kind") == _WHOLE).select("start", "seq", "value")
    parts = _marked(lines, starts.where("torn"), small).mapInArrow(_assemble, fields)
    order = Window.partitionBy("file").orderBy("start", "seq")
    torn = parts.where(F.col("kind") != _WHOLE).withColumn("record", F.sum((F.col("kind") == _BEGINS).cast("int")).over(order))
    mended = torn.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("start", "seq", "value"))).alias("p")).select(
        F.col("p")[0]["start"].alias("start"), F.col("p")[0]["seq"].alias("seq"),
        F.regexp_replace(F.array_join(F.transform("p", lambda x: x["value"]), "\n"), "\r$", "").alias("value"))
    return whole.unionByName(mended).where("not (start = 0 and seq = 0) and trim(value) <> ''").select("value")


def read_quoted_csv(spark: SparkSession, paths: Sequence[str], header: Sequence[str], sep: str, mode: str = "FAILFAST") -> DataFrame:
    """Files with the same header, all columns as text."""
    fields = ", ".join("`" + c.replace("`", "``") + "` string" for c in header)
    row = F.from_csv("value", fields, {"sep": sep, "quote": _QUOTE, "escape": _QUOTE, "mode": mode})
    return quoted_records(spark, paths).select(row.alias("r")).select("r.*")
