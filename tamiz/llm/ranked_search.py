"""Ranked lexical search by the Best Position Algorithm.

Documents are split into shards of bounded size, each with one list per query term, in order of the
term's impact on its documents. For an item the lists of its terms are read side by side from the top.
Each document met is looked up in all of them (direct access): that gives its whole score, and the
positions at which the other lists hold it count as seen. A list's best position is the last one up to
which all are seen, which can lie far below the last one read. No unseen document can score more than
the sum of the impacts at the best positions; the search of a shard stops as soon as that is strictly
below the k-th score, so that equal scores are all met. Tasks carry the k best from shard to
shard, and one window merges the best of all tasks.

Scores are whole numbers: a term weighs ``w = floor(1000 * ln((2N+2) / (2df+1)))`` and adds
``w * ((10^9 * tf) div (1000 * tf + 12 * m))``, with ``m = 75 + (25 * n * N) div L``; N counts the
documents with a term, L all terms, n those of one document, df the documents that hold the term.

Items are taken in blocks whose terms a worker can hold, each block against all documents. What is sent
to the workers is the terms of a block with their weights; document terms stay where they are.

Odd input: null and empty texts have no terms, a null document id comes last among equal scores, repeated
rows are ranked each by itself, items without a known term give no rows, repeated items are answered
each. An empty table of either kind gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.llm.base import map_batches
from tamiz.llm.bpe import spread
from tamiz.session import materialize

BLOCK_TERMS = 500_000  # terms of the items that are searched together
SHARD_DOCS = 1 << 14
SHARD_POSTINGS = 1 << 21
FIRST_STEP, LAST_STEP = 16, 1 << 12
TEXT_SLICE = 4 << 20

# Letters A-Z become small; ASCII characters other than letters and digits separate terms.
_LETTERS = {c: c for c in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100))}
_FOLD = bytes(_LETTERS.get(c, _LETTERS.get(c + 32, 32) if 0x41 <= c <= 0x5A else 32) for c in range(256))


def words(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a whole text (UTF-8), in lists of bounded size."""
    data, begin = (text or b"").translate(_FOLD), 0
    while begin < len(data):
        stop = data.find(b" ", begin + TEXT_SLICE)
        stop = len(data) if stop < 0 else stop
        yield data[begin:stop].split()
        begin = stop


def _raw(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_row, item_id, term, times``, stored; every row of ``items`` has a number of its own."""
    named = materialize(
        items.select(
            F.monotonically_increasing_id().alias("item_row"), F.col(item_id).alias("item_id"),
            F.col(text).alias("text"),
        ),
        "search-items",
    )

    def run(batch):
        out = {"item_row": [], "item_id": [], "term": [], "times": []}
        for row, name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _raw(batch.column(2))):
            counts = Counter()
            for some in words(data):
                counts.update(some)
            out["item_row"] += [row] * len(counts)
            out["item_id"] += [name] * len(counts)
            out["term"] += counts.keys()
            out["times"] += counts.values()
        return out

    kind = named.schema["item_id"].dataType.simpleString()
    found = map_batches(named, "text", run, f"item_row long, item_id {kind}, term binary, times long")
    return materialize(found, "search-item-terms")


def document_terms(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n, terms, tf`` of every document with a term: all its terms counted, those of the vocabulary listed."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # no more than BLOCK_TERMS

    def run(batch):
        find = shared.value.get
        keep, n, sizes, terms, tf = [], [], [], [], []
        for i, data in enumerate(_raw(batch.column(1))):
            total, found = 0, []
            for some in words(data):
                total += len(some)
                found += [t for t in map(find, some) if t is not None]
            if not total:
                continue
            ids, times = np.unique(np.array(found, np.int32), return_counts=True)
            keep.append(i)
            n.append(total)
            sizes.append(len(ids))
            terms.append(ids)
            tf.append(times)
        ends = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
        lists = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (terms, tf)]
        return {
            "doc_id": batch.column(0).take(pa.array(keep, pa.int64())), "n": n,
            "terms": pa.ListArray.from_arrays(ends, pa.array(lists[0], pa.int32())),
            "tf": pa.ListArray.from_arrays(ends, pa.array(lists[1], pa.int64())),
        }

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    found = map_batches(narrow, "text", run, f"doc_id {kind}, n long, terms array<int>, tf array<bigint>")
    return materialize(found, "search-terms")


class Top:
    """The k best documents so far: highest score first, then the smaller id, null last."""

    def __init__(self, k: int):
        self.k = k
        self.rows: list[tuple[int, bool, object]] = []

    @property
    def bar(self) -> int:
        """The k-th score, below any score while there are fewer."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 0

    def add(self, scores: np.ndarray, ids: list, places: np.ndarray) -> None:
        good = np.flatnonzero(scores >= max(1, self.bar))
        if len(good) > 4 * self.k:  # only those that reach the k-th of the new ones, ties included
            cut = np.partition(scores[good], len(good) - self.k)[len(good) - self.k]
            good = good[scores[good] >= cut]
        new = [(-int(s), ids[p] is None, 0 if ids[p] is None else ids[p]) for s, p in zip(scores[good], places[good])]
        self.rows = sorted(self.rows + new)[:self.k]


class Shard:
    """Impact lists and document rows of a bounded number of documents."""

    def __init__(self, ids: list, sizes: np.ndarray, terms: np.ndarray, impact: np.ndarray, vocabulary: int):
        self.ids, self.terms, self.impact = ids, terms, impact
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.sizes = sizes
        owner = np.repeat(np.arange(len(ids)), sizes)
        order = np.lexsort((owner, -impact, terms))
        self.list_doc, self.list_impact = owner[order], impact[order]
        self.place = np.empty(len(order), np.int64)  # where a document's posting is among the lists
        self.place[order] = np.arange(len(order))
        self.list_ends = np.cumsum(np.bincount(terms, minlength=vocabulary))
        self.list_begins = np.r_[0, self.list_ends[:-1]]

    def search(self, terms: np.ndarray, gains: np.ndarray, weight: np.ndarray, top: Top) -> int:
        """Bring the shard's best for one item into ``top``; how many documents were looked up.

        ``weight`` is a zero vector over the vocabulary, lent for the item's gains and given back as zeros.
        """
        held = (self.list_ends[terms] > self.list_begins[terms]) & (gains > 0)
        terms, gains = terms[held], gains[held]
        begins, ends = self.list_begins[terms], self.list_ends[terms]
        bar = top.bar
        if not len(terms) or int((gains * self.list_impact[begins]).sum()) < bar:
            return 0
        weight[terms] = gains
        seen = np.zeros(len(self.place), bool)
        met = np.zeros(len(self.ids), bool)
        best = begins.copy()  # the first position of each list that is not seen
        read, step, looked = 0, FIRST_STEP, 0
        while True:
            at = np.minimum(begins + read, ends)
            docs = self.list_doc[spread(at, np.minimum(step, ends - at))]
            docs = np.unique(docs[~met[docs]])
            if len(docs):
                met[docs] = True
                looked += len(docs)
                rows = spread(self.begins[docs], self.sizes[docs])  # direct access to all lists at once
                seen[self.place[rows]] = True
                parts = weight[self.terms[rows]] * self.impact[rows]
                firsts = np.cumsum(self.sizes[docs]) - self.sizes[docs]
                top.add(np.add.reduceat(parts, firsts), self.ids, docs)
            read += step
            step = min(2 * step, LAST_STEP)
            for i in range(len(best)):
                best[i] = _first_unseen(seen, int(best[i]), int(ends[i]))
            open_lists = best < ends
            if not open_lists.any():
                break
            limit = int((gains * self.list_impact[best - 1])[open_lists].sum())
            if limit < top.bar:
                break
        weight[terms] = 0
        return looked


def _first_unseen(seen: np.ndarray, at: int, end: int) -> int:
    width = 64
    while at < end:
        part = seen[at:min(end, at + width)]
        first = int(part.argmin())
        if not part[first]:
            return at + first
        at += len(part)
        width *= 4
    return end


def _shards(batches: Iterator[pa.RecordBatch], most_docs: int, most_postings: int) -> Iterator[pa.Table]:
    """Rows gathered to shards, none with more documents or postings than the limits (one row at least)."""
    held, docs, postings = [], 0, 0
    for batch in batches:
        ends = np.cumsum(np.array(batch.column("terms").value_lengths(), np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = int(ends[begin - 1]) if begin else 0
            stop = int(np.searchsorted(ends, before + most_postings - postings, side="right"))
            stop = min(stop, begin + most_docs - docs, batch.num_rows)
            if stop <= begin and held:
                yield pa.Table.from_batches(held)
                held, docs, postings = [], 0, 0
                continue
            stop = max(stop, begin + 1)
            held.append(batch.slice(begin, stop - begin))
            docs, postings, begin = docs + stop - begin, postings + int(ends[stop - 1]) - before, stop
    if held:
        yield pa.Table.from_batches(held)


def _search_block(docs: DataFrame, rows: list, k: int, doc_id: str, text: str, shard_docs: int) -> DataFrame | None:
    """``item_row, doc_id, score``: the best of every task for the items whose terms are ``rows``."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    items: dict[int, tuple[list[int], list[int]]] = {}
    for r in rows:
        ids, times = items.setdefault(r["item_row"], ([], []))
        ids.append(vocabulary.setdefault(bytes(r["term"]), len(vocabulary)))
        times.append(r["times"])
    found = document_terms(docs, vocabulary, doc_id, text)
    n_docs, total = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return None
    df = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ratio = F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1)
    weights = np.zeros(len(vocabulary), np.int64)
    # One row per term of the block.
    for r in df.select("term", F.floor(1000 * F.log(ratio)).alias("w")).collect():
        weights[r["term"]] = r["w"]
    lists = {}
    for row, (ids, times) in items.items():
        terms = np.array(ids, np.int64)
        lists[row] = (terms, weights[terms] * np.array(times, np.int64))
    shared = spark.sparkContext.broadcast(lists)
    size = len(vocabulary)

    def run(batches):
        tops = {row: Top(k) for row in shared.value}
        weight = np.zeros(size, np.int64)
        for table in _shards(batches, shard_docs, SHARD_POSTINGS):
            n, sizes = table.column("n").to_numpy(), np.array(table.column("terms").combine_chunks().value_lengths())
            terms = table.column("terms").combine_chunks().flatten().to_numpy().astype(np.int64)
            tf = table.column("tf").combine_chunks().flatten().to_numpy()
            m = 75 + (25 * n * n_docs) // total
            impact = (1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, sizes))
            full = np.flatnonzero(sizes > 0)  # rows without a posting would break the sums by row
            ids = table.column("doc_id").take(pa.array(full)).to_pylist()
            shard = Shard(ids, sizes[full].astype(np.int64), terms, impact, size)
            for row, (wanted, gains) in shared.value.items():
                shard.search(wanted, gains, weight, tops[row])
        out = [(row, None if null else name, -score) for row, t in tops.items() for score, null, name in t.rows]
        yield pa.RecordBatch.from_arrays([
            pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], kind),
            pa.array([o[2] for o in out], pa.int64()),
        ], names=["item_row", "doc_id", "score"])

    from tamiz.llm.base import _arrow_schema

    schema = f"item_row long, doc_id {found.schema['doc_id'].dataType.simpleString()}, score long"
    kind = _arrow_schema(found, schema).field("doc_id").type
    return found.mapInArrow(run, schema)


def search(
    items: DataFrame, docs: DataFrame, k: int = 20, item_id: str = "item_id", doc_id: str = "doc_id",
    text: str = "text", shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents with the highest scores above 0 for every item.

    ``shard_docs`` is the number of documents whose lists a task holds at a time; it does not change the result.
    """
    wanted = item_terms(items, item_id, text)
    blocks = max(1, -(-wanted.count() // BLOCK_TERMS))
    parts = []
    for block in range(blocks):
        # A bounded part of the items; all blocks together are all items.
        some = wanted.filter(F.pmod(F.xxhash64("item_row"), F.lit(blocks)) == block).select("item_row", "term", "times")
        part = _search_block(docs, some.collect(), k, doc_id, text, shard_docs)
        if part is not None:
            parts.append(part)
    names = wanted.select("item_row", "item_id").distinct()
    if not parts:
        kind = docs.schema[doc_id].dataType
        none = docs.limit(0).select(F.lit(0).cast("long").alias("item_row"), F.lit(None).cast(kind).alias("doc_id"),
                                    F.lit(0).cast("long").alias("score"))
        parts = [none]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("item_row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(names, "item_row").select("item_id", "rank", "doc_id", "score")
