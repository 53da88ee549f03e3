"""Rows as CSV text and back.

Reading. A quoted field may hold line breaks, so where a record begins depends on all text before it. Files
are read as lines, many splits a file. First every split tells, from its lines with quotes, whether it
ends within a quoted field if it begins outside of one and if it begins inside; a row a split goes to
the driver, which follows them through each file. Then every split knows where its first record begins
and puts its records together. Only pieces of a record that crosses a split's end meet in a shuffle, and
only where the first step found one. Spark's own CSV expression parses the records.
"""

from __future__ import annotations

import re
import sys
import uuid
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A quote opens a field at its very beginning only; elsewhere it is an ordinary sign.
OPENING = re.compile(r'(?:\A|,)"')


def csv_line(*fields: Column) -> Column:
    """The fields as one line, quoted where a comma, a quote or a line break asks for it.

    A null is an empty field and an empty string an empty quoted one. Spark reads both as null.
    """
    named = [field.cast("string").alias(f"f{i}") for i, field in enumerate(fields)]
    return F.to_csv(F.struct(*named), {"escape": '"', "ignoreLeadingWhiteSpace": "false",
                                       "ignoreTrailingWhiteSpace": "false"})


@contextmanager
def passing_text(lines: DataFrame) -> Iterator[str]:
    """A folder with one column of lines as text, deleted at the end of the block.

    It is that of a managed table, so the catalog places and deletes it.
    """
    spark, name = lines.sparkSession, f"creditloom_text_{uuid.uuid4().hex}"
    try:
        lines.write.format("text").saveAsTable(name)
        details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
        yield details.where("col_name = 'Location'").first()["data_type"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line that begins outside or inside of one."""
    at = 0
    while True:
        if not inside:
            opening = OPENING.search(line, at)
            if opening is None:
                return False
            at = opening.end()
        at = line.find('"', at)
        if at < 0:
            return True
        # Two quotes stand for one.
        inside = line.startswith('""', at)
        at += 2 if inside else 1


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """``(value, file, block)``: lines, and the split of the file that each is in."""
    return spark.read.text(folder).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _open_splits(lines: DataFrame) -> dict[str, tuple[list[int], list[bool]]]:
    """Per file its splits with quotes, in order, and whether a field is open at their ends.

    Files in which no split ends inside a field are left out.
    """

    def follow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[tuple[str, int], tuple[bool, bool]] = {}
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for line, file, block in zip(*columns):
                outside, inside = ends.get((file, block), (False, True))
                ends[file, block] = ends_inside(line, outside), ends_inside(line, inside)
        keys, values = list(ends), list(ends.values())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([file for file, _ in keys], pa.string()),
                pa.array([block for _, block in keys], pa.int64()),
                pa.array([outside for outside, _ in values], pa.bool_()),
                pa.array([inside for _, inside in values], pa.bool_()),
            ],
            ["file", "block", "outside", "inside"],
        )

    quoted = lines.where(F.contains("value", F.lit('"')))
    schema = "file string, block bigint, outside boolean, inside boolean"
    found: dict[str, tuple[list[int], list[bool]]] = {}
    # One row a split at most. A split lies within one task, so none comes twice.
    for file, block, outside, inside in sorted(quoted.mapInArrow(follow, schema).collect()):
        blocks, states = found.setdefault(file, ([], []))
        blocks.append(block)
        states.append(inside if states and states[-1] else outside)
    return {file: state for file, state in found.items() if any(state[1])}


def csv_records(spark: SparkSession, folder: str) -> DataFrame:
    """``(record)``: the records of all files as text, line breaks within fields as line feeds."""
    lines = _lines(spark, folder)
    states = _open_splits(lines)

    def begins_inside(file: str, block: int) -> bool:
        blocks, after = states.get(file, ([], []))
        earlier = bisect_left(blocks, block)
        return bool(earlier) and after[earlier - 1]

    def assemble(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, inside, part = None, False, None
        held: list[str] = []
        for batch in batches:
            values = batch.column(0)
            has_quote = pc.match_substring(values, '"')
            files, blocks = batch.column(1), batch.column(2)
            same = len(batch) and (files[0].as_py(), blocks[0].as_py()) == here
            if same and not inside and not pc.any(has_quote).as_py():
                # All of one split, or of several; without quotes each line is a record anyway.
                last = (files[-1].as_py(), blocks[-1].as_py())
                if last == here:
                    yield rows([], values)
                    continue
            done: list[tuple] = []
            columns = (c.to_pylist() for c in (values, has_quote, files, blocks))
            for line, quoted, file, block in zip(*columns):
                if (file, block) != here:
                    if held:
                        done.append((*here, part or 0, "\n".join(held)))
                    here, inside, held = (file, block), begins_inside(file, block), []
                    # Pieces are numbered: what ends an earlier split's record comes first.
                    part = 1 if inside else None
                if not inside:
                    if quoted and ends_inside(line, False):
                        inside, part, held = True, 2, [line]
                    else:
                        done.append((file, block, None, line))
                    continue
                held.append(line)
                if quoted and not ends_inside(line, True):
                    done.append((file, block, 1 if part == 1 else None, "\n".join(held)))
                    inside, part, held = False, None, []
            yield rows(done)
        if held:
            yield rows([(*here, part, "\n".join(held))])

    def rows(done: list[tuple], records: pa.Array | None = None) -> pa.RecordBatch:
        if records is not None:
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), records],
                names,
            )
        columns = list(zip(*done)) if done else [[]] * 4
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)], names
        )

    names = ["file", "block", "part", "record"]
    found = lines.mapInArrow(assemble, "file string, block bigint, part int, record string")
    # An empty line is no record.
    whole = found.where("part IS NULL AND record != ''").select("record")
    if not states:
        return whole
    # A record begins in the last split before with a piece of kind 2 and goes on in pieces of kind 1.
    order = Window.partitionBy("file").orderBy("block", "part")
    pieces = found.where("part IS NOT NULL").withColumn(
        "begin", F.last(F.when(F.col("part") == 2, F.col("block")), ignorenulls=True).over(order)
    )
    parts = F.array_sort(F.collect_list(F.struct("block", "part", "record")))
    joined = F.array_join(F.transform(parts, lambda piece: piece["record"]), "\n")
    return whole.unionAll(pieces.groupBy("file", "begin").agg(joined.alias("record")).select("record"))


def read_csv(
    spark: SparkSession, folder: str, schema: StructType, corrupt: str | None = None
) -> DataFrame:
    """Records of any width as ``schema``: short ones are filled with nulls, extra fields dropped.

    Empty fields are null. Fields may hold line breaks, which come back as line feeds. ``corrupt`` names a
    further column with the text of records that have another number of fields or a value that is not of
    its type; it is null in all others. A quote that is never closed takes the rest of its file.
    A file is read by as many tasks as it has splits; a record is one value and has to fit into a task.
    """
    wanted, options = schema, {"escape": '"'}
    if corrupt:
        wanted = StructType([*schema.fields, StructField(corrupt, StringType())])
        options["columnNameOfCorruptRecord"] = corrupt
    parsed = F.from_csv("record", wanted.toDDL(), options)
    return csv_records(spark, folder).select(parsed.alias("row")).select("row.*")
