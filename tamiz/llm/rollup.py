"""Token counts kept up to date by signed changes.

A rollup is a folder with one partition per committed batch. A batch holds the sums of its signed
changes by source, language and tokenizer version: an insert adds a document and its tokens, a delete
takes them away, a revised count takes the old one away and adds the new one. Totals are the sums
over all batches, so batches can be committed in any order. Committing a batch again replaces its
partition as a whole: a repeated or broken-off commit cannot count twice. Every batch also holds a row of
zeros, so that a batch committed again without any change replaces its old sums too.

Null sources, languages and versions are groups of their own, null token counts count as 0 tokens.
An empty batch adds nothing; a rollup without batches has no totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.sources.zones import path_exists

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, docs bigint, tokens bigint, batch_id string"


def changes(rows: DataFrame, tokens: Column, sign: int, tokenizer: str) -> DataFrame:
    """Signed changes of whole documents: ``sign`` is 1 for inserts and -1 for deletes."""
    return rows.select(
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("bigint").alias("docs"),
        (F.coalesce(tokens, F.lit(0)) * sign).cast("bigint").alias("tokens"),
    )


def revisions(rows: DataFrame, old: Column, new: Column, tokenizer: str) -> DataFrame:
    """Changes for revised counts: the document stays, its tokens change by ``new - old``."""
    return changes(rows, F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0)), 1, tokenizer).withColumn(
        "docs", F.lit(0).cast("bigint")
    )


class TokenRollup:
    """Totals by source, language and tokenizer version below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def commit(self, batch_id: str, *signed: DataFrame) -> None:
        """Sum the signed changes and store them as the batch's partition, in place of any earlier one."""
        all_rows = signed[0]
        for more in signed[1:]:
            all_rows = all_rows.unionByName(more)
        # Each task sums what it reads, so a source with a third of all rows sends one row per task.
        sums = all_rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        zeros = self.spark.createDataFrame([(None, None, None, 0, 0)], SCHEMA.rpartition(",")[0])
        sums = sums.unionByName(zeros)
        sums.withColumn("batch_id", F.lit(batch_id)).coalesce(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(self.path)

    def batches(self) -> DataFrame:
        """The summed changes of every committed batch."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("basePath", self.path).parquet(self.path)

    def totals(self) -> DataFrame:
        """Documents and tokens now; groups from which everything was taken away are left out."""
        return self.batches().groupBy(*KEYS).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        ).filter("docs <> 0 OR tokens <> 0")

    def compact(self, path: str, batch_id: str = "compacted") -> TokenRollup:
        """A rollup at a new path with the same totals in a single batch."""
        other = TokenRollup(self.spark, path)
        other.commit(batch_id, self.totals())
        return other
