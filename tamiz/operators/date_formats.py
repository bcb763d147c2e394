"""The date format of a text column, by a vote over the shapes of its values.

Digits are counted, not parsed: one scan groups the values of all columns by their shape and by whether the
two numbers beside the year can be a month. Of ``05/01/2024`` both can, of ``25/01/2024`` only the second:
such values decide between day first and month first for the whole column. The format that most values fit
wins, and the column is then read with that one format alone, so that no column is read in two ways.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions import DAY_FIRST, parse_dates, percent_of, strip_spaces

_TIMES = ("", " HH:mm", " HH:mm:ss", "'T'HH:mm:ss")


def candidate_formats() -> list[tuple[str, str]]:
    """(format, order of its fields) in the order in which ties are settled."""
    found = [(f"yyyy{sep}MM{sep}dd{time}", "ymd") for sep in "-/." for time in _TIMES]
    found.append(("yyyyMMdd", "ymd"))
    for order, fields in (("dmy", ("dd", "MM")), ("mdy", ("MM", "dd"))):
        found += [(sep.join((*fields, "yyyy")) + time, order) for sep in "/-." for time in _TIMES[:3]]
    return found


def shape_of(text: Column) -> Column:
    """The text with each digit as 9 and each letter as A; a fraction of seconds is left out."""
    plain = F.regexp_replace(strip_spaces(text), r"(:\d\d)\.\d{1,9}$", "$1")
    return F.regexp_replace(F.regexp_replace(plain, r"\d", "9"), r"\p{L}", "A")


def _shape(pattern: str) -> str:
    return "".join("9" if c in "yMdHms" else "A" if c == "T" else c for c in pattern if c != "'")


def infer_date_formats(df: DataFrame, columns: Sequence[str], day_first: bool = DAY_FIRST) -> DataFrame:
    """column, format, order, values, fitting, pct, ambiguous, contrary: one row per text column, from one scan.

    ``values`` are the texts that are not blank and ``fitting`` those that the chosen ``format`` fits, by shape
    and by the range of month and day; ``pct`` is their share. ``ambiguous`` of them would fit with day and
    month swapped as well, and ``contrary`` further values would fit only so. Where as many values speak for
    one order as for the other, ``day_first`` decides. A column without a fitting value has no format.
    """
    cells = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "text")
    given = cells.filter(strip_spaces(F.col("text")) != "").select("column", strip_spaces(F.col("text")).alias("text"))
    shaped = given.withColumn("shape", shape_of(F.col("text")))
    year_last, compact = F.col("shape").rlike("^99[^9]99[^9]9999"), F.col("shape").rlike("^9{8}$")
    year_first = F.col("shape").rlike("^9999[^9]99[^9]99")

    def number(*places: tuple[Column, int]) -> Column:
        found = F.lit(None).cast("int")
        for where, begin in places:
            found = F.when(where, F.substring("text", begin, 2).try_cast("int")).otherwise(found)
        return found

    one, two = number((year_last, 1), (compact, 5), (year_first, 6)), number((year_last, 4), (compact, 7), (year_first, 9))
    votes = shaped.select("column", "shape", one.alias("one"), two.alias("two")).select(
        "column", "shape", (F.col("one").between(1, 12) & F.col("two").between(1, 31)).alias("month_first"),
        (F.col("two").between(1, 12) & F.col("one").between(1, 31)).alias("day_first"),
    ).groupBy("column", "shape", "month_first", "day_first").agg(F.count(F.lit(1)).alias("n"))
    # From here on a row per shape, and a row per candidate.
    preferred = ("dmy", "mdy") if day_first else ("mdy", "dmy")
    ranked = sorted(candidate_formats(), key=lambda c: ("ymd", *preferred).index(c[1]))
    kinds = F.array(*[
        F.struct(F.lit(i).alias("rank"), F.lit(f).alias("format"), F.lit(o).alias("order"), F.lit(_shape(f)).alias("shape"))
        for i, (f, o) in enumerate(ranked)
    ])
    candidates = df.sparkSession.range(1).select(F.inline(kinds))
    swapped = F.col("order") == "dmy"
    fits = F.when(swapped, F.col("day_first")).otherwise(F.col("month_first"))
    other = F.when(swapped, F.col("month_first")).otherwise(F.col("day_first")) & (F.col("order") != "ymd")
    sums = votes.join(candidates, "shape").groupBy("column", "rank", "format", "order").agg(
        F.coalesce(F.sum(F.when(fits, F.col("n"))), F.lit(0)).alias("fitting"),
        F.coalesce(F.sum(F.when(fits & other, F.col("n"))), F.lit(0)).alias("ambiguous"),
        F.coalesce(F.sum(F.when(~fits & other, F.col("n"))), F.lit(0)).alias("contrary"),
    )
    best = Window.partitionBy("column").orderBy(F.desc("fitting"), "rank")
    chosen = sums.filter(F.col("fitting") > 0).withColumn("place", F.row_number().over(best)).filter("place = 1")
    totals = votes.groupBy("column").agg(F.sum("n").alias("values"))
    names = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("column"))
    joined = names.join(totals, "column", "left").join(chosen, "column", "left")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("values", "fitting", "ambiguous", "contrary")}
    return joined.select(
        "column", "format", "order", counts["values"].alias("values"), counts["fitting"].alias("fitting"),
        F.coalesce(percent_of(counts["fitting"], counts["values"]), F.lit(0.0)).alias("pct"),
        counts["ambiguous"].alias("ambiguous"), counts["contrary"].alias("contrary"),
    )


def inferred_formats(df: DataFrame, columns: Sequence[str], day_first: bool = DAY_FIRST) -> dict[str, str | None]:
    """The format of each column."""
    found = infer_date_formats(df, columns, day_first).select("column", "format").collect()  # a row per column
    return {r["column"]: r["format"] for r in found}


def parse_inferred_dates(df: DataFrame, columns: Sequence[str], day_first: bool = DAY_FIRST) -> DataFrame:
    """Read each text column with the one format inferred for it; what does not fit becomes null."""
    formats = inferred_formats(df, columns, day_first)
    return df.withColumns({
        c: parse_dates(F.col(c), [_with_fraction(f)]) if f else F.lit(None).cast("timestamp_ntz")
        for c, f in formats.items()
    })


def _with_fraction(pattern: str) -> str:
    return pattern + "[.SSSSSS]" if pattern.endswith(":ss") else pattern
