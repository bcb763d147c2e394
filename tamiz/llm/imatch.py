"""I-Match document fingerprints over randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a band: terms in too many
documents say nothing, terms in hardly any are noise. A document keeps its distinct terms that are
in the lexicon, in sorted order. They are hashed as a whole, and again for several families of
nested random subsets of the lexicon, of which each holds a quarter of the terms of the one before. A
change of a few terms leaves those hashes alone whose subsets hold none of them, so the share of
equal hashes tells how alike two documents are.

Document frequencies are exact counts over all documents. Since they add up to the number of distinct
terms of all documents, at most (mean distinct terms) / (least share) terms reach the band,
whatever the number of documents; the lexicon's size is checked all the same before it is sent out.

Texts without a term of the lexicon are fingerprinted by all their terms, texts without terms (null,
empty, only punctuation) have the empty fingerprint. Two empty fingerprints are alike (1), an
empty and another one are not (0). Equal texts always have equal fingerprints. Rows without id
come last in order; rows that repeat an id stand next to each other, by text. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm.base import map_batches, narrow, own_columns, texts

LEAST_SHARE, MOST_SHARE = 0.001, 0.1  # idf between ln 10 and ln 1000
MOST_TERMS = 5_000_000
FAMILIES, LEVELS, DIGITS = 32, 6, 3
GAP = "." * DIGITS
CELLS = [f"{i:0{DIGITS}x}" for i in range(16**DIGITS)]
BOUNDS = [np.uint64(1 << (62 - 2 * depth)) for depth in range(LEVELS + 1)]
MULTIPLIERS = np.random.Generator(np.random.PCG64(19)).integers(1, 2**63, FAMILIES, np.uint64) | np.uint64(1)
TERM = re.compile(r"\w+")
FLUSH = 300_000


def terms(text: str) -> set[str]:
    return set(TERM.findall(text.lower()))


def lexicon(docs: DataFrame, text: str = "text", least: float = LEAST_SHARE, most: float = MOST_SHARE) -> frozenset[str]:
    """Terms in at least ``least`` and at most ``most`` of all documents."""

    def count(batches):
        seen: Counter[str] = Counter()

        def out():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"]
            )

        for batch in narrow(batches, text):
            for item in texts(batch.column(0)):
                seen.update(terms(item))
            if len(seen) > FLUSH:
                yield from out()
                seen.clear()
        yield from out()

    total = docs.count()
    per_term = docs.select(F.col(text).alias(text)).mapInArrow(count, "term string, n long")
    band = per_term.groupBy("term").agg(F.sum("n").alias("df")).filter(
        (F.col("df") >= math.ceil(least * total)) & (F.col("df") <= max(1, math.floor(most * total)))
    )
    found = band.select("term").limit(MOST_TERMS + 1).toArrow().column(0).to_pylist()
    if len(found) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms are in the band; raise its least share")
    return frozenset(found)


def hashed(known: Iterable[str]) -> dict[str, int]:
    """The digest of every term of a lexicon."""
    return {t: xxhash.xxh3_64_intdigest(t) for t in known}


def fingerprint(text: str, known: frozenset[str], digest_of: Mapping[str, int] | None = None) -> str:
    """Hashes of the whole lexicon and of every random subset, in a fixed order; empty without terms.

    ``digest_of`` may hold the digests of the lexicon's terms (see ``hashed``), which spares taking them again.
    """
    own = terms(text)
    kept = sorted(own & known)
    if kept and digest_of is not None:
        digests = np.fromiter(map(digest_of.__getitem__, kept), np.uint64, len(kept))
    else:
        kept = kept or sorted(own)
        if not kept:
            return ""
        digests = np.array([xxhash.xxh3_64_intdigest(t) for t in kept], np.uint64)
    cells = [[_cell(digests.tobytes())]] + [[] for _ in range(FAMILIES)]
    # A quarter of the terms reach each next level of a family: those whose draw has two more leading zeros.
    draws = MULTIPLIERS[:, None] * digests
    family, term = np.nonzero(draws < BOUNDS[0])
    draws = draws[family, term]
    for depth in range(LEVELS):
        # The subsets of all families stand one after the other, each in the order of terms.
        chosen = digests[term].tobytes()
        ends = (8 * np.cumsum(np.bincount(family, minlength=FAMILIES))).tolist()
        begin = 0
        for own_cells, end in zip(cells[1:], ends):
            own_cells.append(_cell(chosen[begin:end]) if end > begin else GAP)
            begin = end
        deeper = draws < BOUNDS[depth + 1]
        family, term, draws = family[deeper], term[deeper], draws[deeper]
    return "".join(map("".join, cells))


def _cell(chosen: bytes) -> str:
    return CELLS[xxhash.xxh3_64_intdigest(chosen) % len(CELLS)]


def likeness(left: str, right: str) -> float:
    """Share of equal hashes among the subsets that hold a term of either document."""
    if left == right:
        return 1.0
    if not left or not right:
        return 0.0
    a, b = (np.frombuffer(x.encode("ascii"), f"S{DIGITS}") for x in (left, right))
    gap = GAP.encode("ascii")
    held = (a != gap) | (b != gap)
    return int(((a == b) & held).sum()) / int(held.sum())


def with_next(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows in partitions by ``part``, sorted by ``part, follower, place``, each range closed by the next one's first row.

    Ranges of ids are cut at ids that exist, so a range's follower is the row with the next range's first
    id; the last range is followed by the first id of all.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = 4 * partitions
    placed = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1)).alias("place"),
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
    )
    cuts = placed.agg(
        F.min("place").alias("least"),
        F.percentile_approx("place", [i / ranges for i in range(1, ranges)], 20 * ranges).alias("cuts"),
    ).first()
    bounds = sorted({cuts["least"], *(cuts["cuts"] or [])} - {None})
    width = max(1, math.isqrt(len(bounds)))

    def constant(values):
        return F.split(F.lit(",".join(map(str, values or [0]))), ",").cast("array<bigint>")

    def below(values):
        return F.size(F.filter(values, lambda x: x <= F.col("place"))) - 1

    coarse = below(constant(bounds[::width]))
    placed = placed.withColumn("coarse", coarse)
    fine = below(F.slice(constant(bounds), F.col("coarse") * width + 1, F.lit(width)))
    placed = placed.withColumn("part", F.col("coarse") * width + fine)
    first = F.array_contains(F.slice(constant(bounds), F.col("part") + 1, F.lit(1)), F.col("place"))
    before = F.when(F.col("part") == 0, F.lit(max(0, len(bounds) - 1))).otherwise(F.col("part") - 1)
    copies = F.when(first, F.array(
        F.struct(F.col("part").alias("part"), F.lit(0).alias("follower")),
        F.struct(before.alias("part"), F.lit(1).alias("follower")),
    )).otherwise(F.array(F.struct(F.col("part").alias("part"), F.lit(0).alias("follower"))))
    placed = placed.withColumn("copy", F.explode(copies))
    placed = placed.select("copy.part", "copy.follower", "place", "doc_id", "text")
    return placed.repartition(partitions, "part").sortWithinPartitions("part", "follower", "place", "text")


def edited_fingerprints(
    docs: DataFrame, known: frozenset[str], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next text's are.

    The edited text has its last half (rounded down) replaced by as many of the next text's first code
    points, or all of them; the next text is that of the next higher id, after the last the first one's.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)
    columns = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")

    def run(batches):
        lexis, waiting = shared.value, None
        digest_of = hashed(lexis)
        for batch in narrow(batches, "text"):
            rows = []
            for part, follower, name, item in zip(
                batch.column("part").to_pylist(), batch.column("follower").to_pylist(),
                batch.column("doc_id").to_pylist(), texts(batch.column("text")),
            ):
                if waiting is None and follower:
                    continue
                mark = fingerprint(item, lexis, digest_of)
                if waiting is not None and waiting[0] == part:
                    _, own_id, own, own_mark = waiting
                    half = len(own) // 2
                    edited = own[:len(own) - half] + item[:half]
                    other = fingerprint(edited, lexis, digest_of)
                    rows.append((
                        own_id, len(own), hashlib.sha256(edited.encode("utf-8")).hexdigest(), own_mark, other,
                        likeness(own_mark, other), likeness(own_mark, mark),
                    ))
                waiting = None if follower else (part, name, item, mark)
            kinds = (
                batch.column("doc_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=list(columns)
            )

    kind = dict(docs.dtypes)[doc_id]
    return with_next(docs, doc_id, text).mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )


def fingerprints(docs: DataFrame, known: frozenset[str], text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Add each whole text's fingerprint to all columns of ``docs``; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    docs = docs.select(*(F.col(f"`{c}`") for c in own_columns(docs, (name,))))

    def run(batch):
        out = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        out[name] = [fingerprint(t, shared.value) for t in texts(batch.column(text))]
        return out

    return map_batches(docs, text, run, T.StructType(docs.schema.fields + [T.StructField(name, T.StringType())]))
