"""Reading one huge CSV file in parallel although fields hold line ends.

Spark splits a file by lines, and a line may be part of a record only. Whether a line begins
a record depends on whether the text before it ends inside a quoted field. So each line, and
then each split, is a function of that state: it may set it, keep it or turn it over.

1. Every split is read once for its function: one row per split.
2. The functions are combined along each file, which gives the state at the start of every split.
3. With that state a split is read again and its whole records leave the task that read them as
   they are. Only what a split has of a record that began before it or ends after it, at most
   two pieces, is brought together with the other pieces of that record.

No exchange carries whole text. The states of the splits are broadcast up to ``MOST_SPLITS`` of
them; a table of more is joined, after which each split's lines are put in order again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrina.session import materialize
from vitrina.sources.readers import read_csv

_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}
_SPLIT = ["file", "block"]
#: Splits whose states, some hundred bytes each, are broadcast.
MOST_SPLITS = 1 << 17
#: Pieces: a whole record, the end of one from an earlier split, all of a split inside one, a start.
WHOLE, END, MIDDLE, START = range(4)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted field, given where it begins.

    A quote opens a field at the field's start only; inside, the next single quote closes it.
    Doubled quotes change nothing in either place.
    """
    text = line if inside else "," + line
    for part in text.replace('""', "").split('"')[:-1]:
        inside = not inside and part.endswith(",")
    return inside


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all splits; those of a split are read in order by one task."""
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            "value",
        )
    )


def _changes(values: pa.Array) -> list[int]:
    """Places at which a column has another value than before."""
    return (pc.indices_nonzero(pc.not_equal(values[1:], values[:-1])).to_numpy() + 1).tolist()


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: where it ends if it begins outside a quoted field, and inside."""
    last, told = None, []

    def rows() -> pa.RecordBatch:
        names = ["file", "block", "from_out", "from_in", "crlf"]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
        columns = zip(*told) if told else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for batch in batches:
        files, blocks, values = batch.columns
        # A task may read several splits one after another.
        starts = {0, *_changes(files), *_changes(blocks)} if batch.num_rows else set()
        quoted = set(pc.indices_nonzero(pc.match_substring(values, '"')).to_pylist())
        for at in sorted(quoted | starts):
            key = (files[at].as_py(), blocks[at].as_py())
            if key != last:
                last = key
                told.append([*key, False, True, values[at].as_py().endswith("\r")])
            if at in quoted:
                line, state = values[at].as_py(), told[-1]
                state[2], state[3] = ends_inside(line, state[2]), ends_inside(line, state[3])
    yield rows()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each split and the pieces of records at its ends, headers left out."""
    last, inside, open_, continued, header, record = None, False, False, False, False, []
    found: list[tuple] = []

    def rows() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()]
        names = ["file", "block", "kind", "header", "crlf", "value"]
        columns = zip(*found) if found else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def leave() -> None:
        if record:
            found.append((*last, MIDDLE if continued else START, header, crlf, "\n".join(record)))

    crlf = False
    for batch in batches:
        columns = (batch.column(batch.schema.get_field_index(name)).to_pylist() for name in (
            "file", "block", "value", "inside", "open", "ends"))
        for file, block, value, state, unclosed, ends in zip(*columns):
            if (file, block) != last:
                leave()
                if unclosed:
                    raise ValueError(f"the file ends inside a quoted field: {file}")
                last, inside, continued, record, crlf = (file, block), state, state, [], ends
                header = block == 0
            after = ends_inside(value, inside) if '"' in value else inside
            if inside or after:
                record.append(value)
            if not after:
                text = "\n".join(record) if record else value
                if continued:
                    found.append((file, block, END, False, crlf, text))
                elif not header:
                    found.append((file, block, WHOLE, False, crlf, text))
                continued, header, record = False, False, []
            inside = after
        yield rows()
        found.clear()
    leave()
    yield rows()


def _states(functions: DataFrame) -> DataFrame:
    """Per split: whether it begins ``inside``, whether its file is ``open`` at the end, line ends."""
    along = Window.partitionBy("file").orderBy("block")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    through = along.rowsBetween(Window.unboundedPreceding, 0)
    whole_file = Window.partitionBy("file")
    splits = functions.select(
        *_SPLIT,
        "crlf",
        F.when(F.col("from_out") == F.col("from_in"), F.col("from_out")).alias("set_to"),
        (F.col("from_out") & ~F.col("from_in")).cast("int").alias("turn"),
    ).withColumn("turned", F.sum("turn").over(through))

    def state_over(window) -> Column:
        """The state after the splits of a window; a file begins outside."""
        last = F.last(
            F.when(F.col("set_to").isNotNull(), F.struct("set_to", "turned")), ignorenulls=True
        ).over(window)
        turned = F.coalesce(F.max("turned").over(window), F.lit(0))
        since = (turned - F.coalesce(last["turned"], F.lit(0))) % 2 == 1
        return F.coalesce(last["set_to"], F.lit(False)) != since

    return (
        splits.withColumn("inside", state_over(earlier))
        .withColumn("after", state_over(through))
        .withColumn("open", F.max_by("after", "block").over(whole_file))
        # The first line tells how the lines of a file end.
        .withColumn("ends", F.min_by("crlf", "block").over(whole_file))
        .select(*_SPLIT, "inside", "open", "ends")
    )


def _placed(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Lines with the state of their split, those of a split in order in one task."""
    if states.count() <= MOST_SPLITS:
        return lines.join(F.broadcast(states), _SPLIT)
    numbered = lines.withColumn("line", F.monotonically_increasing_id())
    return numbered.join(states, _SPLIT).repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "line").drop("line")


def record_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row ``record`` per CSV record, headers left out.

    Fails, naming the file, when a file ends inside a quoted field.
    """
    lines = _lines(spark, path)
    functions = lines.mapInArrow(
        _functions, "file string, block bigint, from_out boolean, from_in boolean, crlf boolean"
    )
    states = materialize(_states(functions), "csv-splits")
    pieces = _placed(lines, states).mapInArrow(
        _pieces, "file string, block bigint, kind int, header boolean, crlf boolean, value string"
    )
    whole = pieces.filter(F.col("kind") == WHOLE).select("crlf", "value")
    # The pieces of a record that spans splits belong to the split where it starts.
    upto = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("kind") == START, F.col("block")), ignorenulls=True).over(upto)
    stitched = (
        pieces.filter(F.col("kind") != WHOLE)
        .withColumn("owner", owner)
        .groupBy("file", "owner")
        .agg(
            F.first("crlf").alias("crlf"),
            F.bool_or("header").alias("header"),
            F.sort_array(F.collect_list(F.struct("block", "kind", "value"))).alias("pieces"),
        )
        .filter(~F.col("header"))
        .select("crlf", F.array_join(F.col("pieces.value"), "\n").alias("value"))
    )
    texts = whole.unionByName(stitched)
    # As the CSV reader does, line ends inside fields become those of one character.
    plain = F.replace("value", F.lit("\r\n"), F.lit("\n"))
    text = F.when(F.col("crlf"), F.regexp_replace(plain, r"\r\z", "")).otherwise(F.col("value"))
    return texts.select(text.alias("record")).filter("record <> ''")


def read_csv_split(spark: SparkSession, path: str) -> DataFrame:
    """The same table as ``readers.read_csv``, with every file split over many tasks."""
    columns = read_csv(spark, path, multiline=True).columns
    schema = ", ".join(f"`{name}` string" for name in columns)
    parsed = F.from_csv("record", F.lit(schema), _OPTIONS)
    return record_texts(spark, path).select(parsed.alias("row")).select("row.*")
