"""Multi-line CSV read by many tasks a file.

A quoted field may hold line breaks, so where a byte range begins, a reader
can't tell whether it stands inside quotes.  Quotes inside a field are
doubled, so a line break ends a record exactly where the number of quotes
before it is even.

1. Ranges of every file are read as lines, and their quotes are counted: one
   number a range.
2. Its prefix sum over the ranges of a file (a window over one row a range)
   gives the state in which each range begins.
3. Ranges are cut to records on their own, each from its state.  Records that
   lie in one range are whole; the last one of a range may go on in the next
   ranges, whose first lines are then its pieces.
4. Pieces, two a range at most, meet by the range in which their record
   begins.  Records are parsed by the engine's own CSV expression.

The cut records are written once, with their place ``(file, range, number)``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prioritext.operators.common import BROADCAST_MAX_ROWS, EngineError
from prioritext.session import scratch_path, ship_package
from prioritext.sources.files import CSV_OPTIONS, csv_header

WHOLE, FIRST_PIECE, NEXT_PIECE = 0, 1, 2


def ranges_of(spark: SparkSession, path: str) -> DataFrame:
    """``(value, file, start)``: the lines of all files, in order within a range, which begins at byte ``start``."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def opening_states(lines: DataFrame) -> DataFrame:
    """``(file, start, inside)``: whether a range begins inside quotes; one row a range."""
    quotes = lines.groupBy("file", "start").agg(F.sum(F.regexp_count("value", F.lit('"')).cast("bigint")).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return quotes.select("file", "start", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int").alias("inside"))


def cut_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of ranges, each with its state, to records and pieces of records.

    A record that is not finished at the end of a batch is held until it is.
    """
    here: tuple[str, int] | None = None
    inside, number, begun, held = 0, 0, False, []

    def row(kind: int) -> dict:
        return {"file": here[0], "start": here[1], "number": number, "kind": kind, "record": "\n".join(held)}

    for batch in batches:
        files, starts = batch.column("file"), batch.column("start").to_numpy()
        same = np.asarray(pc.equal(files[1:], files[:-1])) & (starts[1:] == starts[:-1]) if batch.num_rows > 1 else np.zeros(0, bool)
        bounds = [0, *(np.flatnonzero(~same) + 1).tolist(), batch.num_rows]
        out: list[dict] = []
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            if low == high:
                continue
            key = (files[low].as_py(), int(starts[low]))
            if key != here:
                if here is not None and held:
                    out.append(row(FIRST_PIECE if begun else NEXT_PIECE))
                here, inside, number, held = key, batch.column("inside")[low].as_py(), 0, []
                begun = not inside
            values = batch.column("value").slice(low, high - low)
            odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2
            ends = (np.cumsum(odd) + inside) % 2 == 0  # no quote is open behind the line
            for text, end in zip(values.to_pylist(), ends.tolist(), strict=True):
                held.append(text)
                if end:
                    out.append(row(WHOLE if begun else NEXT_PIECE))
                    number, begun, held = number + 1, True, []
            inside = int(not ends[-1])
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_RECORDS)
    if here is not None and held:
        yield pa.RecordBatch.from_pylist([row(FIRST_PIECE if begun else NEXT_PIECE)], schema=_RECORDS)


_RECORDS = pa.schema(
    [("file", pa.string()), ("start", pa.int64()), ("number", pa.int64()), ("kind", pa.int32()), ("record", pa.string())]
)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, number, record)``: every record's text, and the place where it begins."""
    ship_package(spark)
    lines = ranges_of(spark, path)
    held = scratch_path(spark, f"csv-ranges-{uuid.uuid4().hex}")
    opening_states(lines).write.parquet(held)
    states = spark.read.parquet(held)
    if states.count() > BROADCAST_MAX_ROWS:
        raise EngineError(f"{path}: more than {BROADCAST_MAX_ROWS} ranges; raise spark.sql.files.maxPartitionBytes")
    target = scratch_path(spark, f"csv-records-{uuid.uuid4().hex}")
    lines.join(F.broadcast(states), ["file", "start"]).select("file", "start", "inside", "value").mapInArrow(
        cut_records, "file string, start long, number long, kind int, record string"
    ).write.parquet(target)
    cut = spark.read.parquet(target)
    pieces = cut.filter(F.col("kind") != WHOLE)
    # a piece belongs to the last record begun before it; in a range the piece that ends one comes before the one that begins one
    order = Window.partitionBy("file").orderBy("start", F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    begun = F.when(F.col("kind") == FIRST_PIECE, F.struct("start", "number"))
    owned = pieces.select("file", "start", "kind", F.last(begun, ignorenulls=True).over(order).alias("of"))
    joined = (
        pieces.join(owned, ["file", "start", "kind"])
        .groupBy("file", "of")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("start"), (-F.col("kind")).alias("last"), "record"))).alias("parts"))
        .select("file", "of.start", "of.number", F.array_join("parts.record", "\n").alias("record"))
    )
    return cut.filter(F.col("kind") == WHOLE).select("file", "start", "number", "record").union(joined)


def read_csv_ranges(
    spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] | None = None, with_place: bool = False
) -> DataFrame:
    """Scan quoted multi-line CSV with an explicit schema, a file being read by many tasks.

    Columns are found by their names in the header, which all files share;
    missing ones (of ``required``, else of the schema) raise.  Blank lines
    between records are left out.  ``with_place`` adds ``_file``, ``_start``
    and ``_number``, which order the records as the files hold them.
    """
    header = csv_header(spark, path).columns
    missing = sorted(set(required or schema.names) - set(header))
    if missing:
        raise EngineError(f"{path}: missing column(s) {missing}")
    typed = {f.name: f.dataType.simpleString() for f in schema}
    ddl = ", ".join(f"`{c}` {typed.get(c, 'string')}" for c in header)
    found = records(spark, path).withColumn("record", F.regexp_replace("record", "\r$", ""))
    is_header = (F.col("start") == 0) & (F.col("number") == 0)
    heads = [r["record"] for r in found.filter(is_header).select("record").distinct().limit(2).collect()]
    if len(heads) > 1:
        raise EngineError(f"{path}: files with different headers")
    options = {k: v for k, v in CSV_OPTIONS.items() if k in ("escape", "quote")} | {"mode": "PERMISSIVE"}
    rows = found.filter(~is_header & (F.col("record") != "")).withColumn("_row", F.from_csv("record", ddl, options))
    place = [F.col("file").alias("_file"), F.col("start").alias("_start"), F.col("number").alias("_number")] if with_place else []
    return rows.select(
        *(F.col(f"_row.`{f.name}`") if f.name in header else F.lit(None).cast(f.dataType).alias(f.name) for f in schema), *place
    )
