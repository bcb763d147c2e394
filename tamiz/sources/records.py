"""Records of CSV files whose quoted cells run over lines, put together by many tasks per file.

Lines are read in splits, so a task does not know whether its first line begins inside a quoted cell. A
line tells for both cases how it ends: it leaves things as they were, ends outside, ends inside, or turns
one into the other. These four maps are composed along each split, then along the splits of a file,
which gives the case for every split; then each split numbers its records, and lines of one record are
joined wherever they were read.

Lines end with a line feed, alone or after a carriage return; encodings have to hold ASCII as it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamiz.session import materialize

_FILE_BITS, _GROUP_BITS = 40, 58  # lines of a file below, its number above, and the group of files


def _open_at_end(line: Column) -> Column:
    """Whether a line that begins outside a quoted cell ends inside one; ``line`` has no doubled quotes."""
    rest = F.regexp_replace(line, r'(^|,)"[^"]*+"(?=,|$)', "$1")
    return F.when(line.contains('"'), rest.rlike(r'(^|,)"')).otherwise(False)


def _lines(spark: SparkSession, files: Sequence[str], encoding: str) -> DataFrame:
    """file, split, id (ascends within a split) and text of every line, without the ends of lines."""
    found = spark.read.option("lineSep", "\n").text(list(files)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"), F.col("value"),
    )
    text = F.col("value")
    if encoding.upper().replace("_", "-") not in ("UTF-8", "UTF8"):
        text = F.decode(F.col("value").cast("binary"), encoding)
    return found.select("file", "split", "id", text.alias("text"))


def _ends(text: Column) -> tuple[Column, Column]:
    """Does a line end inside a quoted cell, if it begins outside one, and if it begins inside one."""
    single = F.replace(F.rtrim(text, F.lit("\r")), F.lit('""'), F.lit(""))
    close = F.instr(single, '"')
    after = F.concat(F.lit("x"), F.substr(single, close + 1))
    return _open_at_end(single), F.when(close == 0, True).otherwise(_open_at_end(after))


def _composed(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Add ``out0`` and ``out1``: the state after each row along its group, from outside and from inside.

    Rows hold the maps ``e0`` and ``e1``; ``order`` is a number that ascends within each group.
    """
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fixed, turn = F.col("e0") == F.col("e1"), (F.col("e0") & ~F.col("e1")).cast("int")
    counted = df.withColumn("__turns", F.sum(turn).over(window))
    # Of the rows so far the last that fixes the state tells what it is; every turn since then changes it.
    mark = F.max(F.when(fixed, F.struct(F.col(order), F.col("e0").alias("state"), F.col("__turns").alias("at")))).over(window)
    marked = counted.withColumn("__mark", mark)
    odd = F.pmod(F.col("__turns") - F.coalesce(F.col("__mark.at"), F.lit(0)), F.lit(2)) == 1
    return marked.select(
        *df.columns,
        (F.coalesce(F.col("__mark.state"), F.lit(False)) != odd).alias("out0"),
        (F.coalesce(F.col("__mark.state"), F.lit(True)) != odd).alias("out1"),
    )


@dataclass(frozen=True)
class Splits:
    """``splits``: file, split, inside (at its beginning), lines before it, first line of the record it begins in.

    ``bare`` are the files in which a carriage return ends lines by itself.
    """

    splits: DataFrame
    bare: list[str]


def find_splits(spark: SparkSession, files: Sequence[str], encoding: str = "UTF-8") -> Splits:
    """How every split of the files begins, from two numbers per line."""
    lines = _lines(spark, files, encoding)
    e0, e1 = _ends(F.col("text"))
    bare = F.rtrim(F.col("text"), F.lit("\r")).contains("\r")
    blank = F.btrim("text", F.lit(" \t\r")) == ""
    narrow = materialize(
        lines.select("file", "split", "id", *(c.alias(n) for c, n in ((e0, "e0"), (e1, "e1"), (bare, "bare"), (blank, "blank")))),
        "csv-lines",
    )
    # One row per file, as in the list of files.
    odd = [r["file"] for r in narrow.filter("bare").select("file").distinct().collect()]
    within = materialize(_composed(narrow.drop("bare"), ["file", "split"], "id"), "csv-states")
    maps = within.groupBy("file", "split").agg(
        F.max_by("out0", "id").alias("e0"), F.max_by("out1", "id").alias("e1"), F.count(F.lit(1)).alias("lines"),
    )
    # One row per split of the input from here on.
    along = Window.partitionBy("file").orderBy("split")
    entered = _composed(maps, ["file"], "split").select(
        "file", "split", F.coalesce(F.lag("out0").over(along), F.lit(False)).alias("inside"),
        F.coalesce(F.sum("lines").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )
    numbered = _numbered(within.join(entered, ["file", "split"]))
    firsts = numbered.groupBy("file", "split").agg(
        F.max(F.when(F.col("begins"), F.col("line"))).alias("last_begin"),
        F.min(F.when(~F.col("blank"), F.col("line"))).alias("written"),
    )
    header = Window.partitionBy("file")
    carried = F.max("last_begin").over(along.rowsBetween(Window.unboundedPreceding, -1))
    numbers = F.dense_rank().over(Window.orderBy("file")) - 1
    found = entered.join(firsts, ["file", "split"]).select(
        "file", "split", "inside", "before", carried.alias("carried"), F.min("written").over(header).alias("header"),
        numbers.cast("long").alias("number"),
    )
    return Splits(materialize(found, "csv-splits"), odd)


def _numbered(lines: DataFrame) -> DataFrame:
    """Add ``line``, its number in the file, and ``begins``: whether a record begins with it."""
    window = Window.partitionBy("file", "split").orderBy("id")
    after = F.when(F.col("inside"), F.col("out1")).otherwise(F.col("out0"))
    return lines.select(
        "*", (F.col("before") + F.row_number().over(window)).alias("line"),
        (~F.coalesce(F.lag(after).over(window), F.col("inside"))).alias("begins"),
    )


def quoted_records(
    spark: SparkSession, files: Sequence[str], splits: DataFrame, encoding: str = "UTF-8", group: int = 0
) -> DataFrame:
    """``at, record``: every record but the header of each file, as text; ``at`` ascends along each file.

    ``splits`` are those that ``find_splits`` found for the very same files. Blank lines between records are
    left out. ``group`` below 32 keeps the numbers of several sets of files apart.
    """
    e0, e1 = _ends(F.col("text"))
    lines = _lines(spark, files, encoding).withColumns({"e0": e0, "e1": e1})
    states = _composed(lines, ["file", "split"], "id").drop("e0", "e1").join(splits, ["file", "split"], "left")
    # Splits follow from the files and the settings of the session; other ones would tear records apart.
    changed = F.raise_error(F.lit("the files or the sizes of their splits have changed since they were looked at"))
    states = states.withColumn("inside", F.when(F.col("number").isNull(), changed.cast("boolean")).otherwise(F.col("inside")))
    so_far = Window.partitionBy("file", "split").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.max(F.when(F.col("begins"), F.col("line"))).over(so_far)
    placed = _numbered(states).select(
        "number", "header", "line", "text", F.coalesce(own, F.col("carried")).alias("first")
    )
    pieces = F.array_sort(F.collect_list(F.struct("line", "text")))
    joined = placed.filter(F.col("first") != F.col("header")).groupBy("number", "first").agg(
        F.array_join(pieces["text"], "\n").alias("record")
    )
    return joined.select(
        (F.lit(group << _GROUP_BITS) + F.shiftleft("number", _FILE_BITS) + F.col("first")).alias("at"),
        F.rtrim(F.col("record"), F.lit("\r")).alias("record"),
    ).filter(F.btrim("record", F.lit(" \t")) != "")
