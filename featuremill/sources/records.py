"""Multi-line CSV read in parallel: records that span lines, without one task a file.

With ``multiLine`` a file is one task, because only a reader that has seen all quotes before a
line feed knows whether the feed ends a record. That knowledge is one bit, the parity of the
quotes so far, and parities add up: a first pass counts the quotes of every byte range (the
lines of one split of the file), a running sum over the ranges, one small row each, gives the
parity at which each range begins, and a second pass over the same ranges then finds
every record boundary inside its range alone. Only a record that crosses ranges is put together
by its pieces, at most two a range, which a third pass over the ranges picks out. The records are
parsed by Spark's own CSV expression. No row is shuffled but those pieces and one row a range.

Quoting is as in RFC 4180: a quote inside a quoted field is doubled (so it does not change the
parity), and quotes enclose whole fields. Line feeds end records, and a carriage return before
one belongs to it. A file that ends inside quotes gives its open rest as one record.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: What a row of a range holds: a whole record, the beginning of one that goes on in the next
#: range, the end of one that began before, or a piece of one that does both.
WHOLE, TAIL, HEAD, THROUGH = 0, 1, 2, 3


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines with the file and the byte range that holds them, in the file's order inside
    each task, and their number of quotes."""
    text = spark.read.option("lineSep", "\n").text(path)
    line = F.col("value")
    return text.select(F.xxhash64("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("range"), line.alias("line"),
                       (F.length(line) - F.length(F.replace(line, F.lit('"')))).alias("quotes"))


def begins_inside_quotes(lines: DataFrame) -> DataFrame:
    """(file, range, inside): whether each range begins inside a quoted field. One row a range."""
    ranges = lines.groupBy("file", "range").agg(F.sum("quotes").alias("quotes"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.select("file", "range", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _pieces(batches, header: bool, crossing: bool):
    """The records that a range holds whole, or its pieces of records that cross ranges. With ``header``
    the first record of a file is left out."""
    at, parity, inside, held, first = None, 0, False, [], True

    def rest() -> list[tuple]:
        """What is left at the end of a range: a record that goes on."""
        if not held or not crossing:
            return []
        return [(*at, THROUGH if first and inside else TAIL, "\n".join(held))]

    for batch in batches:
        if not batch.num_rows:
            continue
        out = []
        files, ranges, inside_of = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "range", "inside"))
        odd = batch.column("quotes").to_numpy() % 2
        lines = batch.column("line").to_pylist()
        edge = np.flatnonzero(np.concatenate([[True], (files[1:] != files[:-1]) | (ranges[1:] != ranges[:-1])])).tolist()
        for a, b in zip(edge, [*edge[1:], len(lines)]):
            if at != (files[a], ranges[a]):
                if at is not None:
                    out += rest()
                at, inside, held, first = (files[a], ranges[a]), bool(inside_of[a]), [], True
                parity = int(inside)
            after = (parity + np.cumsum(odd[a:b])) % 2
            begin = a
            for k in (np.flatnonzero(after == 0) + a + 1).tolist():  # a record ends with each line that ends outside quotes
                piece = HEAD if first and inside else WHOLE
                if (piece != WHOLE) == crossing and not (header and first and at[1] == 0):
                    own = [*held, *lines[begin:k]]
                    out.append((*at, piece, own[0] if len(own) == 1 else "\n".join(own)))
                begin, held, first = k, [], False
            held += lines[begin:b]
            parity = int(after[-1])
        if out:
            yield _batch(out)
    if at is not None and (out := rest()):
        yield _batch(out)


def _batch(rows) -> pa.RecordBatch:
    file, range_, piece, record = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(file, pa.int64()), pa.array(range_, pa.int64()), pa.array(piece, pa.int32()),
                                       pa.array(record, pa.string())], names=["file", "range", "piece", "record"])


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(record): every record's text, whichever lines it spans, without the files' headers."""
    lines = _lines(spark, path)
    # one row a byte range, 17 bytes: a ten-millionth of the input at 128 MB a range
    known = (lines.join(F.broadcast(begins_inside_quotes(lines)), ["file", "range"])
             .select("file", "range", "line", "quotes", "inside"))
    found = "file long, range long, piece int, record string"
    whole = known.mapInArrow(lambda b: _pieces(b, header, False), found).select("record")
    crossing = known.mapInArrow(lambda b: _pieces(b, header, True), found)
    # a record that crosses ranges begins with a tail; what follows up to the next tail is its own
    order = [F.col("range"), F.col("piece") == TAIL]
    so_far = Window.partitionBy("file").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = crossing.withColumn("number", F.count_if(F.col("piece") == TAIL).over(so_far))
    own = F.array_sort(F.collect_list(F.struct("range", "record")))
    joined = numbered.groupBy("file", "number").agg(
        F.array_join(F.transform(own, lambda p: p["record"]), "\n").alias("record"))
    return whole.union(joined.select("record"))


def read_multiline_csv(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",",
                       header: bool = True) -> DataFrame:
    """The CSV files at ``path`` (RFC 4180, one header line each) as typed rows, read in parallel also
    inside a file. An unquoted empty field is null, and so is a value that its type does not hold; blank
    records are left out."""
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    # an unquoted empty field is read as ``nullValue``; a value of its own keeps it apart from ""
    options = {"sep": sep, "quote": '"', "escape": '"', "nullValue": "\x00null", "emptyValue": "", "mode": "PERMISSIVE"}
    record = F.regexp_replace("record", r"\r\z", "")
    rows = csv_records(spark, path, header).select(record.alias("record")).where("record <> ''")
    return rows.select(F.from_csv("record", ddl, options).alias("r")).select("r.*")
