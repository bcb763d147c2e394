"""Raw CSV files as all-text tables."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions import NA_TOKENS, null_if_token
from tamiz.operators.columns import normalize_headers
from tamiz.sources.records import find_splits, quoted_records

_RECORD, _AT = "__record", "__at"
_END = "\u0001end\u0001"


def inspect_files(spark: SparkSession, path: str) -> dict[str, tuple[bool, bool, bool]]:
    """Per file: whether every line is valid UTF-8, some hold null bytes, and a quoted cell runs over lines.

    A quote inside a cell that does not begin with one opens nothing. Files
    without lines do not appear.
    """
    line = F.col("value")
    # Doubled quotes go first; without them the pattern needs no recursion, however long a cell is.
    single = F.replace(line, F.lit('""'), F.lit(""))
    rest = F.regexp_replace(single, r'(^|,)"[^"]*+"(?=,|$)', "$1")
    rows = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.bool_and(F.is_valid_utf8(line)).alias("utf8"), F.bool_or(line.contains("\0")).alias("nulls"),
        F.bool_or(rest.rlike(r'(^|,)"')).alias("multiline"),
    )
    # One row per file, as in the list of files that the reader itself keeps.
    return {unquote(r["file"]): (r["utf8"], r["nulls"], r["multiline"]) for r in rows.collect()}


def inspect_text(spark: SparkSession, path: str) -> tuple[bool, bool]:
    """(every line of all files is valid UTF-8, some quoted cell runs over several lines)."""
    found = inspect_files(spark, path).values()
    return all(utf8 for utf8, _, _ in found), any(multiline for _, _, multiline in found)


def first_fitting(encodings: Sequence[str], utf8: bool, nulls: bool) -> str:
    """The first encoding that the bytes can be in; the last one if none fits.

    Null bytes speak for two- or four-byte encodings, valid UTF-8 without them for UTF-8;
    one-byte encodings take all other bytes.
    """
    for encoding in encodings:
        name = encoding.upper().replace("_", "-")
        wide = name.startswith(("UTF-16", "UTF-32"))
        if wide == nulls and (utf8 or name not in ("UTF-8", "UTF8", "ASCII", "US-ASCII")):
            return encoding
    return encodings[-1]


def read_raw_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    encodings: Sequence[str] = ("UTF-8",),
    bad_lines: str = "error",
    multiline: bool | None = None,
    remove_from_header: str = "",
    row_order: str | None = None,
) -> DataFrame:
    """Read a CSV with header into text columns; missing-value texts become null.

    ``encodings``: each file is read in the first of them that fits its bytes (see
    ``first_fitting``). ``bad_lines``: lines with too many cells raise an ``error`` or are
    left out with ``skip``; short lines are padded with nulls. ``multiline``
    None looks whether quoted cells span lines: in files where they do records are put together
    from lines (see ``records.py``), by many tasks per file; only wide encodings and files whose
    lines end with a carriage return alone are read whole, by one task each, as are all files with
    ``multiline=True``. ``row_order`` names a column that ascends with the lines of each file.
    """
    if bad_lines not in ("error", "skip"):
        raise ValueError(f"bad_lines must be error or skip, not {bad_lines!r}")
    groups: dict[tuple[str, bool], list[str]] = {}
    spread: dict[str, list[str]] = {}
    if multiline is None or len(encodings) > 1:
        for file, (utf8, nulls, spans) in sorted(inspect_files(spark, path).items()):
            encoding = first_fitting(encodings, utf8, nulls)
            # The reader finds the line ends of wide encodings only in whole files.
            if multiline is None and spans and not nulls:
                spread.setdefault(encoding, []).append(file)
            else:
                groups.setdefault((encoding, nulls or bool(multiline)), []).append(file)
    known = {}
    for encoding, files in list(spread.items()):
        known[encoding] = find_splits(spark, files, encoding)
        whole = {unquote(f) for f in known[encoding].bare}
        spread[encoding] = [f for f in files if f not in whole]
        if whole:
            groups.setdefault((encoding, True), []).extend(sorted(whole))
        if whole and spread[encoding]:
            known[encoding] = find_splits(spark, spread[encoding], encoding)
    spread = {encoding: files for encoding, files in spread.items() if files}
    if len(groups) < 2 and not spread:
        # All files alike: the path as it was given.
        alike = next(iter(groups), (encodings[0], bool(multiline)))
        groups = {alike: [path]}

    def reader(encoding: str, whole: bool) -> DataFrameReader:
        return spark.read.options(
            header=True, quote='"', escape='"', encoding=encoding, multiLine=whole,
            mode="PERMISSIVE", columnNameOfCorruptRecord=_RECORD, columnPruning=False,
        )

    if columns:
        header = list(columns)
    else:
        everything = [*groups.items(), *(((encoding, True), files) for encoding, files in spread.items())]
        kind, files = min(everything, key=lambda g: g[1][0])
        header = reader(*kind).csv(files).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _RECORD]])
    parts = []
    for kind, files in groups.items():
        part = reader(*kind).schema(schema).csv(files)
        parts = [parts[0].unionByName(part) if parts else part]
    # Ascends along each file; a retried task gives its rows the same numbers.
    parts = [part.withColumn(_AT, F.monotonically_increasing_id()) for part in parts]
    for number, (encoding, files) in enumerate(spread.items(), 1):
        records = quoted_records(spark, files, known[encoding].splits, encoding, number)
        ddl = ", ".join("`{}` STRING".format(name.replace("`", "``")) for name in schema.names)
        parsed = F.from_csv("record", ddl, {
            "quote": '"', "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": _RECORD,
        })
        # As the rows of a generator, the cells of a record are parsed together and once.
        parts.append(records.select("at", F.inline(F.array(parsed))).withColumnRenamed("at", _AT))
    df = parts[0]
    for part in parts[1:]:
        df = df.unionByName(part)
    df = df.withColumnRenamed(_AT, row_order) if row_order else df.drop(_AT)
    fits = _has_no_extra_cell(header)
    if bad_lines == "skip":
        df = df.filter(fits)
    else:
        message = F.lit(f"a line of {path} has more than {len(header)} cells")
        df = df.filter(F.when(fits, True).otherwise(F.raise_error(message).cast("boolean")))
    df = df.select(
        *[null_if_token(F.col(f"`{c}`"), NA_TOKENS).alias(c) for c in header],
        *([row_order] if row_order else []),
    )
    ordered = normalize_headers(df.select(*[F.col(f"`{c}`") for c in header]), remove_from_header).columns
    return df.toDF(*ordered, *([row_order] if row_order else []))


def _has_no_extra_cell(header: Sequence[str]) -> Column:
    """Whether a line has no more cells than the header.

    Spark keeps the text of each line whose number of cells is not the
    header's. One more cell is appended to that text: if it then comes up
    within the header's columns, the line was too short, not too long.
    """
    cells = [f"c{i}" for i in range(len(header))]
    schema = ", ".join(f"{c} string" for c in cells)
    longer = F.concat(F.col(_RECORD), F.lit("," + _END))
    parsed = F.from_csv(longer, schema, {"quote": '"', "escape": '"', "multiLine": "true"})
    short = F.coalesce(F.array_contains(F.array(*[parsed[c] for c in cells]), _END), F.lit(False))
    # The last test never holds; it makes every query name a column of the file.
    return F.col(_RECORD).isNull() | short | F.col(f"`{header[0]}`").eqNullSafe(_END)


def normalize_null_tokens(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Missing-value texts in any text column become null."""
    return df.select(*[
        null_if_token(F.col(f.name), tokens).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])
