"""Quoted CSV files read by many tasks each, also where fields hold line breaks.

Spark cuts a file into blocks at line ends, without knowing whether a line end lies inside quotes.
Whether it does depends on everything before it, but only through one bit: inside or outside. So one
pass finds for each block where it would end if it began outside, and if it began inside; a prefix
over these small rows tells how each block really begins; a second pass cuts the blocks into records.
Records cut by a block's end are put together from their pieces, which are few and the only rows
shuffled. Each complete record is then parsed by Spark's own CSV parser.
"""

from __future__ import annotations

import csv

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulgrain.session import run_folder

#: Blocks of all files up to which how they begin is sent to every task, at under 40 bytes each.
BROADCAST_BLOCKS = 500_000
#: Fields keep their spaces; a record of the wrong length is an error.
PARSING = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}
WHOLE, OPEN, REST = 0, 1, 2


def ends_quoted(line: str, quoted: bool) -> bool:
    """Whether the end of a line lies in a quoted field, given whether its start does.

    A quote opens a field only as its first character; elsewhere in an open field it is text. In a
    quoted field two quotes are one, and after the closing quote text counts up to the next comma.
    """
    at = 0
    while True:
        if not quoted:
            if not line.startswith('"', at):
                at = line.find(',"', at) + 1
                if not at:
                    return False
            at += 1
        while True:
            at = line.find('"', at)
            if at < 0:
                return True
            if not line.startswith('"', at + 1):
                break
            at += 2
        quoted = False
        at = line.find(",", at + 1) + 1
        if not at:
            return False


def _segments(batches):
    """(file, start, columns beyond them, lines, new) for stretches of lines of one block."""
    before = None
    for batch in batches:
        files, starts = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        n = len(files)
        cuts = [0, *((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])).nonzero()[0] + 1, n] if n else []
        for a, b in zip(cuts, cuts[1:]):
            key = int(files[a]), int(starts[a])
            yield *key, batch.slice(a, b - a), key != before
            before = key


def _blocks(batches):
    """How each block ends from either beginning, and the first record of each file."""
    def done():
        return pa.RecordBatch.from_pylist(
            [{"file": key[0], "start": key[1], "from_outside": outside, "from_inside": inside,
              "header": None if open_header else header}],
            schema=pa.schema([("file", pa.int64()), ("start", pa.int64()), ("from_outside", pa.bool_()),
                              ("from_inside", pa.bool_()), ("header", pa.string())]))

    key = None
    for file, start, part, new in _segments(batches):
        lines = part.column(0)
        if new:
            if key:
                yield done()
            key, outside, inside, header, open_header = (file, start), False, True, None, start == 0
        quoted = pc.indices_nonzero(pc.match_substring(lines, '"')).to_pylist()
        if open_header:
            for line in lines.to_pylist():
                if header is None and line.rstrip("\r") == "":
                    continue
                header_inside = ends_quoted(line, header is not None)
                header = line if header is None else f"{header}\n{line}"
                if not header_inside:
                    open_header = False
                    break
        for line in lines.take(pa.array(quoted, pa.int64())).to_pylist():
            outside, inside = ends_quoted(line, outside), ends_quoted(line, inside)
    if key:
        yield done()


def _records(wanted):
    """Records of blocks of known beginning; ``wanted`` kinds of them."""
    schema = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("kind", pa.int32()), ("record", pa.string())])

    def run(batches):
        key, held, out = None, [], []

        def add(kind, text):
            if kind in wanted:
                out.append((*key, kind, text))

        def close():
            """The end of a block: what is held goes on in the next one."""
            if key and (held or inside):
                add(REST if rest else OPEN, "\n".join(held))

        def flush():
            columns = list(zip(*out)) or [[]] * 4
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)
            out.clear()
            return batch

        for file, start, part, new in _segments(batches):
            lines = part.column(0)
            if new:
                close()
                # ``rest``: lines still belong to a record of an earlier block.
                key, held = (file, start), []
                inside = rest = part.column(3)[0].as_py()
                skip = start == 0
            quoted = set(pc.indices_nonzero(pc.match_substring(lines, '"')).to_pylist())
            for i, line in enumerate(lines.to_pylist()):
                if i in quoted:
                    ends = ends_quoted(line, inside)
                elif inside:
                    ends = True
                else:
                    text = line.rstrip("\r") if line.endswith("\r") else line
                    if not text:
                        continue
                    if skip:
                        skip = False
                    else:
                        add(WHOLE, text)
                    continue
                held.append(line)
                inside = ends
                if not inside:
                    text = "\n".join(held)
                    text = text[:-1] if text.endswith("\r") else text
                    if rest:
                        add(REST, text)
                    elif skip:
                        skip = False
                    else:
                        add(WHOLE, text)
                    held, rest = [], False
            if out:
                yield flush()
        close()
        if out:
            yield flush()

    return run


def _beginnings(blocks: DataFrame) -> DataFrame:
    """Whether each block begins and ends inside quotes.

    A block either leaves the bit alone, flips it, or sets it. After a block the bit is the value last
    set, flipped by the flips since; before any, outside flipped by all flips.
    """
    sets = F.col("from_outside") == F.col("from_inside")
    flips = F.when(~sets & F.col("from_outside"), 1).otherwise(0)
    order = Window.partitionBy("file").orderBy("start")
    flipped = blocks.withColumn("flips", F.sum(flips).over(order) % 2)
    # The set value and the flips up to there cancel, so that later flips can simply be added.
    base = F.last(F.when(sets, (F.col("from_outside").cast("int") + F.col("flips")) % 2), ignorenulls=True).over(order)
    ended = flipped.withColumn("ends", (F.coalesce(base, F.lit(0)) + F.col("flips")) % 2 == 1)
    return ended.withColumn("begins", F.coalesce(F.lag("ends").over(order), F.lit(False))).withColumn(
        "last", F.lead("start").over(order).isNull())


def _header(blocks: DataFrame, lines: DataFrame, path: str) -> list[str]:
    def named(file: int) -> str:
        return lines.where(F.col("file") == file).select("path").first()["path"]

    broken = blocks.where("last AND ends").first()
    if broken:
        raise ValueError(f"{named(broken['file'])}: a quoted field is never closed")
    first = blocks.where("start = 0")
    cut = first.where("header IS NULL AND from_outside").first()
    if cut:
        raise ValueError(f"{named(cut['file'])}: the header is longer than a block")
    columns, owner = None, None
    # Spellings of the header, such as with and without quotes.
    for row in first.where("header IS NOT NULL").groupBy("header").agg(F.min("file").alias("file")).toLocalIterator():
        try:
            parsed = next(csv.reader([row["header"].removeprefix("\ufeff").rstrip("\r")], strict=True))
        except csv.Error as e:  # such as lines that end in carriage returns only
            raise ValueError(f"{named(row['file'])}: unreadable header: {e}") from e
        if columns is not None and parsed != columns:
            raise ValueError(f"headers differ: {named(owner)} and {named(row['file'])}")
        columns, owner = parsed, row["file"]
    if columns is None:
        raise ValueError(f"{path}: no header")
    columns = [c or f"_c{i}" for i, c in enumerate(columns)]
    if len({c.lower() for c in columns}) < len(columns):
        raise ValueError(f"{path}: columns of one name: {columns}")
    return columns


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with a header, all columns as text; quoted fields may hold commas, quotes and line ends.

    Records end at a line feed, with or without a carriage return before it. Empty lines are no records.
    Empty fields are null, empty quoted ones empty text. All files have the same header; a field that is
    never closed, a header that differs, or a record of another length is an error. Text is UTF-8.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_path").alias("path"))
    narrow = lines.select("value", "file", "start")
    found = narrow.mapInArrow(_blocks, "file long, start long, from_outside boolean, from_inside boolean, header string")
    folder = f"{run_folder(spark)}/csv_blocks"
    _beginnings(found).write.parquet(folder)
    blocks = spark.read.parquet(folder)
    columns = _header(blocks, lines, path)

    known = blocks.select(F.col("file").alias("_file"), F.col("start").alias("_start"), "begins", "ends")
    if blocks.count() <= BROADCAST_BLOCKS:
        known = F.broadcast(known)
    placed = narrow.join(known, (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start")), "left")
    # Blocks are cut the same way in both passes; one that is not known must not pass unseen.
    begins = F.coalesce("begins", F.raise_error(F.lit("a block was not seen by the first pass")).cast("boolean"))
    schema = "file long, start long, kind int, record string"

    def records(rows: DataFrame, *kinds: int) -> DataFrame:
        return rows.select("value", "file", "start", begins.alias("begins")).mapInArrow(_records(kinds), schema)

    whole = records(placed, WHOLE).select("record")
    if not blocks.where("begins").isEmpty():
        whole = whole.unionByName(_joined(records(placed.where("coalesce(begins OR ends, true)"), OPEN, REST)))
    return _parsed(whole, F.col("record"), columns)


def _joined(pieces: DataFrame) -> DataFrame:
    """Records that blocks cut: an open piece and the rest pieces of the blocks after it."""
    order = Window.partitionBy("file").orderBy("start", F.desc("kind"))
    numbered = pieces.withColumn("number", F.sum((F.col("kind") == OPEN).cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("start", "record")))
    return numbered.groupBy("file", "number").agg(parts.alias("parts")).select(
        F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))


def _parsed(records: DataFrame, record: Column, columns: list[str]) -> DataFrame:
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    fields = records.select(F.from_csv(record, schema, PARSING).alias("row"))
    return fields.select("row.*").toDF(*columns)
