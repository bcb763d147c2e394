"""Near-duplicate documents by a chosen-path set similarity join.

Every distinct set of word shingles gets a table of minwise tokens. Independent trees branch the
sets: a node draws one coordinate at random, and with probability 1/similarity - 1 a second one, and
each of its sets goes on to the child named by its token there. Pairs of sets within small nodes are
compared exhaustively, larger nodes branch again; a pair at the similarity keeps about one common
child per level, and the trees together find it. Candidates pass a filter on 256 sketch bits and are
confirmed on the full shingle sets.

Two things keep dense groups linear without losing a link between components. Documents with equal
sets are one class from the start. And every set is first compared with one drawn set of each of its
nodes (the pivot); sets that are linked this way need no further comparison among each other, so a node
whose sets all belong to one component is done, in a node with few sets outside its largest
component those few are compared with all others, and in a dense node with many of them the same
is done in blocks, on the full sets.

Defined results: null, empty and blank texts have no shingles and are linked with nothing; rows with
equal texts always share a component; rows that repeat an id and text get equal results, and are
compared once however often they come; an id with two texts links what either is linked with; a row
without id takes its class's component. An empty table gives an empty result.

No node is left out: the few and the dense ones of all trees are compared, the others branch, and at the
last level whatever is left is compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.llm.base import in_few_tasks, map_batches, release, release_driver, texts
from tamiz.llm.components import components
from tamiz.session import materialize

COORDINATES = 64  # that nodes branch by
SKETCH = 256  # that give a sketch bit each
TREES = 12
SMALL = 24  # sets outside a node's largest component up to which the node is compared exhaustively
DEEPEST = 12
BLOCK = 512  # sets of a dense node that one task compares with as many
BITS = 51  # of 256 sketch bits: sets at 0.8 differ in 26 on average, with a deviation of 5
MULTIPLIERS = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, SKETCH, np.uint64) | np.uint64(1)
POLYNOMIAL = np.uint64(0xD6E8FEB86659FD93)
WORDS = ["sk0", "sk1", "sk2", "sk3"]


class _Hashes(dict):
    def __missing__(self, word):
        if len(self) > 65_536:  # a few megabytes in each Python worker
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def words_of(text: str) -> list[bytes]:
    """Words with A-Z in lower case; other letters stay."""
    return text.encode("utf-8").lower().split()


def shingle_set(text: str, width: int) -> set[tuple[bytes, ...]]:
    """The runs of ``width`` words themselves (of all words when there are fewer)."""
    words = words_of(text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width))))


def similar(left: set, right: set, percent: int) -> bool:
    common = len(left & right)
    return bool(common) and 100 * common >= percent * (len(left) + len(right) - common)


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """Distinct hashes of the runs of ``width`` words (of all words when there are fewer), ascending."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = max(1, len(codes) - width + 1)
    out = codes[:n].copy()
    for i in range(1, min(width, len(codes))):
        out = out * POLYNOMIAL + codes[i:i + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def minwise(hashes: np.ndarray) -> np.ndarray:
    """The least 32-bit value of each coordinate."""
    least = np.full(SKETCH, 2**64 - 1, np.uint64)
    for begin in range(0, len(hashes), 512):
        np.minimum(least, (hashes[begin:begin + 512, None] * MULTIPLIERS).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def sketches(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """``doc_id, n, set_lo, set_hi, sketch, sk0..sk3`` of every row; nulls where there are no shingles."""
    def run(batch):
        n, ends, mins, sets = [], [0], [], []
        for item in texts(batch.column(1)):
            hashes = shingle_hashes(item, width)
            n.append(len(hashes))
            if len(hashes):
                mins.append(minwise(hashes))
                sets.append(xxhash.xxh3_128_digest(hashes.tobytes()))
            ends.append(len(mins) * COORDINATES)
        has = np.array(n) > 0
        place = np.where(has, np.cumsum(has) - 1, 0)
        table = np.array(mins, np.uint32).reshape(-1, SKETCH)
        bits = np.packbits((table & np.uint32(1)).astype(np.uint8), axis=1).view(np.int64)
        tokens = table[:, :COORDINATES].ravel().view(np.int32)
        digest = np.frombuffer(b"".join(sets), np.int64).reshape(-1, 2)

        def column(values):
            if not len(values):
                return pa.nulls(len(n), pa.int64())
            return pa.array(values[place], pa.int64(), mask=~has)

        out = {"doc_id": batch.column(0), "n": pa.array(n, pa.int64())}
        out["set_lo"], out["set_hi"] = column(digest[:, 0]), column(digest[:, 1])
        out["sketch"] = pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array(tokens, pa.int32())
        )
        for i, name in enumerate(WORDS):
            out[name] = column(bits[:, i])
        return out

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(
        narrow, "text", run,
        "doc_id long, n long, set_lo long, set_hi long, sketch array<int>, " + ", ".join(f"{w} long" for w in WORDS),
    )


def _children(node: Column, sketch: Column, similarity: float) -> Column:
    """The children that a set goes to from ``node``: by one coordinate, at times by a second."""
    first = F.pmod(F.xxhash64(node, F.lit(1)), F.lit(COORDINATES)).cast("int")
    second = F.pmod(F.xxhash64(node, F.lit(2)), F.lit(COORDINATES)).cast("int")
    both = (F.pmod(F.xxhash64(node, F.lit(3)), F.lit(1000)) < int(1000 * (1 / similarity - 1))) & (first != second)
    child = lambda c: F.xxhash64(node, c, F.get(sketch, c))
    return F.when(both, F.array(child(first), child(second))).otherwise(F.array(child(first)))


def _apart(left: str, right: str) -> Column:
    """Differing sketch bits of two aliased rows."""
    total = F.lit(0)
    for w in WORDS:
        total = total + F.bit_count(F.col(f"{left}.{w}").bitwiseXOR(F.col(f"{right}.{w}")))
    return total


def _like_sizes(left: str, right: str, percent: int) -> Column:
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    return (a * 100 >= b * percent) & (b * 100 >= a * percent)


def confirm(
    pairs: DataFrame, most: int, docs: DataFrame, doc_id: str, text: str, width: int, percent: int
) -> DataFrame:
    """Those of the pairs (two columns of distinct ids) whose full shingle sets are as similar as asked, as ``a, b``.

    ``most`` is what the pairs number at most.
    """
    x, y = pairs.columns
    pairs = pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()
    pairs = materialize(in_few_tasks(pairs, most), "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    ids = materialize(in_few_tasks(ids, 2 * pairs.count()), "pair-ids")
    own = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    held = materialize(own.join(ids, "id", "left_semi"), "pair-texts")
    left = held.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = held.select(F.col("id").alias("b"), F.col("text").alias("text_b"))

    def run(batch):
        last, right_set, good = None, set(), []
        for x, y in zip(texts(batch.column("text_a")), texts(batch.column("text_b"))):
            if y != last:
                last, right_set = y, shingle_set(y, width)
            good.append(similar(shingle_set(x, width), right_set, percent))
        kept = batch.filter(pa.array(good, pa.bool_()))
        return {"a": kept.column("a"), "b": kept.column("b")}

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return materialize(map_batches(joined, "text_b", run, "a long, b long"), "links")


def _joined(labels: DataFrame, more: DataFrame) -> DataFrame:
    """Components with more links: the old ones come as stars, so their links need not be followed again."""
    return components(more.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def _more_links(labels, pairs, most, docs, *options):
    """Confirm further pairs; new components only where there are any."""
    more = confirm(pairs, most, docs, *options)
    labels = labels if more.isEmpty() else _joined(labels, more)
    release_driver(docs.sparkSession)
    return labels


def _with_components(rows: DataFrame, labels: DataFrame | None, rep: str = "rep", name: str = "comp") -> DataFrame:
    if labels is None:
        return rows.withColumn(name, F.col(rep))
    named = labels.select(F.col("node").alias("labelled"), F.col("component").alias("label"))
    joined = rows.join(named, F.col(rep) == F.col("labelled"), "left")
    return joined.withColumn(name, F.coalesce("label", rep)).drop("labelled", "label")


def _dense_groups(rows: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``whole, node`` with its sets, and how many they are and how many lie outside ``main``.

    The sets of a dense group meet in nodes of every tree. Nodes with the same main component become one (``whole``,
    named by that component) where comparing the sets of all of them once takes fewer comparisons than node by node.
    """
    dense = materialize(rows.join(nodes.select("node", "main"), "node"), "dense-rows")
    singly = nodes.groupBy("main").agg(F.sum(F.col("members") * (F.col("members") - F.col("most"))).alias("singly"))
    outside = F.col("comp") != F.col("main")
    once = dense.groupBy("main").agg(
        F.count_distinct("rep").alias("members"), F.count_distinct(F.when(outside, F.col("rep"))).alias("others")
    )
    once = once.join(singly, "main").filter("members * others <= singly").select("main", "members", "others")
    once = materialize(in_few_tasks(once, nodes.count()), "dense-wholes")
    sizes = nodes.join(once, "main", "left_anti").select(
        F.lit(False).alias("whole"), "node", "members", (F.col("members") - F.col("most")).alias("others")
    ).unionByName(once.select(F.lit(True).alias("whole"), F.col("main").alias("node"), "members", "others"))
    sets = dense.join(once, "main", "left_anti").withColumn("whole", F.lit(False)).unionByName(
        dense.join(once, "main", "left_semi").withColumn("whole", F.lit(True)).withColumn("node", F.col("main"))
        .distinct()
    )
    return sets, sizes


def _common(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many of the ascending hashes ``own`` each of the others holds; none of all these is empty."""
    held = np.concatenate(others)
    found = own[np.minimum(np.searchsorted(own, held), len(own) - 1)] == held
    sizes = np.fromiter(map(len, others), np.int64, len(others))
    return np.add.reduceat(found.astype(np.int64), np.cumsum(sizes) - sizes)


def _dense_links(rows, nodes, texts_of, width, percent):
    """Links of sets outside a dense node's largest component with any set of the node, confirmed on the spot.

    Both sides come in blocks, so a node of any size is spread over tasks; only links leave them.
    """
    parts = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    dense, sizes = _dense_groups(rows, nodes)
    spread = sizes.select("whole", "node", parts(F.col("members")).alias("m_parts"), parts(F.col("others")).alias("o_parts"))
    held = materialize(texts_of.join(dense.select("rep").distinct(), "rep", "left_semi"), "dense-texts")
    own = dense.join(spread, ["whole", "node"]).join(held, "rep").select(
        "whole", "node", "main", "m_parts", "o_parts", "rep", "comp", "n", *WORDS, "text"
    )
    draw = F.xxhash64("rep", "node")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = own.withColumn("m", F.pmod(draw, F.col("m_parts")).cast("int")).withColumn("o", every("o_parts"))
    others = own.filter("comp <> main").withColumn("o", F.pmod(draw, F.col("o_parts")).cast("int")).withColumn(
        "m", every("m_parts")
    )

    # New column identities, since both sides stem from one table.
    members = members.toDF(*members.columns)

    def sketches_of(table):
        return np.stack([table.column(w).to_numpy() for w in WORDS], axis=1).view(np.uint64)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        if left.num_rows and right.num_rows:
            marks, sizes = sketches_of(right), right.column("n").to_numpy()
            comps, reps = right.column("comp").to_numpy(), right.column("rep").to_numpy()
            others = texts(right.column("text").combine_chunks())
            # Hashes of a block's shingles are small; the shingles themselves are made for two texts at a time.
            hashes, joined = {}, set()
            for mark, n, comp, rep, item in zip(
                sketches_of(left), left.column("n").to_numpy(), left.column("comp").to_numpy(),
                left.column("rep").to_numpy(), texts(left.column("text").combine_chunks()),
            ):
                near = np.bitwise_count(marks ^ mark).sum(axis=1) <= BITS
                near &= (comps != comp) & (sizes * 100 >= n * percent) & (sizes * percent <= n * 100)
                own_hashes = shingle_hashes(item, width) if near.any() else ()
                near = np.flatnonzero(near)
                for at in near:
                    if at not in hashes:
                        hashes[at] = shingle_hashes(others[at], width)
                # An id may have another text that is blank.
                near = np.array([at for at in near if len(own_hashes) and len(hashes[at])], np.int64)
                if not len(near):
                    continue
                # Equal shingles have equal hashes, so no similar pair fails here but by colliding hashes.
                common = _common(own_hashes, [hashes[at] for at in near])
                both = len(own_hashes) + np.array([len(hashes[at]) for at in near]) - common
                for at in near[100 * common >= percent * both]:
                    pair = (min(comp, comps[at]), max(comp, comps[at]))
                    if pair not in joined and similar(shingle_set(item, width), shingle_set(others[at], width), percent):
                        joined.add(pair)  # further links between both components would change nothing
                        a.append(min(rep, reps[at]))
                        b.append(max(rep, reps[at]))
            others = hashes = joined = None
            release()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    by = ("whole", "node", "m", "o")
    return materialize(
        others.groupBy(*by).cogroup(members.groupBy(*by)).applyInArrow(run, "a long, b long"), "dense-links"
    )


def _candidates(reps, rows, labels, texts_of, width: int, similarity: float, percent: int):
    """Pairs between components that meet in a small node (``a < b`` with ``apart``), and links of dense nodes.

    A node is dense if at least half of its sets are in one component. Those of all trees are compared.
    """
    rows = _with_components(rows, labels)
    all_rows, all_nodes, kinds = None, None, set()
    for level in range(DEEPEST + 1):
        n_rows = rows.count()
        per = rows.groupBy("node", "comp").agg(F.count("*").alias("n_comp"))
        nodes = in_few_tasks(per, n_rows).groupBy("node").agg(
            F.sum("n_comp").alias("members"), F.max("n_comp").alias("most"), F.max_by("comp", "n_comp").alias("main"),
        ).filter("members > most")
        few = (F.col("members") - F.col("most") <= SMALL) | F.lit(level == DEEPEST)
        dense = F.col("most") * 2 >= F.col("members")
        kind = F.when(few, "few").when(dense, "dense").otherwise("many")
        nodes = materialize(in_few_tasks(nodes.withColumn("kind", kind), n_rows), "nodes")
        own = set(nodes.agg(F.collect_set("kind")).first()[0])  # three at most
        kinds |= own
        all_rows = rows if all_rows is None else all_rows.unionByName(rows)
        all_nodes = nodes if all_nodes is None else all_nodes.unionByName(nodes)
        if "many" not in own:
            break
        if level % 3 == 2:
            release_driver(rows.sparkSession)
        tokens = reps.select("rep", "sketch")
        grown = rows.join(nodes.filter("kind = 'many'").select("node"), "node").join(tokens, "rep")
        children = F.explode(_children(F.col("node"), F.col("sketch"), similarity))
        rows = materialize(in_few_tasks(grown.withColumn("node", children).drop("sketch"), 2 * n_rows), "branches")

    # Nodes have names of their own in all trees and levels, so those to be compared meet at once.
    others = all_rows.join(all_nodes.filter("kind = 'few'").select("node", "main"), "node").filter("comp <> main").drop("main")
    o, r = others.alias("o"), all_rows.alias("r")
    pairs = o.join(
        r,
        (F.col("o.node") == F.col("r.node")) & (F.col("o.comp") != F.col("r.comp"))
        & _like_sizes("o", "r", percent) & (_apart("o", "r") <= BITS),
    ).select(
        F.least("o.rep", "r.rep").alias("a"), F.greatest("o.rep", "r.rep").alias("b"),
        _apart("o", "r").alias("apart"),
    )
    found = pairs.groupBy("a", "b").agg(F.min("apart").alias("apart"))
    links = []
    if "dense" in kinds:
        links.append(_dense_links(all_rows, all_nodes.filter("kind = 'dense'"), texts_of, width, percent))
    return found, links


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, similarity: float = 0.8,
    trees: int = TREES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``docs``.

    Documents are linked whose sets of ``width``-word shingles have a Jaccard similarity of at least
    ``similarity`` (in whole hundredths). ``component_id`` is the smallest id reachable over links.
    """
    percent = round(similarity * 100)
    marks = materialize(sketches(docs, doc_id, text, width), "sketches")
    with_set = marks.filter("n > 0")
    classes = materialize(with_set.groupBy("set_lo", "set_hi").agg(F.min("doc_id").alias("rep")), "classes")
    firsts = classes.filter("rep IS NOT NULL").select(
        F.col("set_lo").alias("lo"), F.col("set_hi").alias("hi"), F.col("rep")
    )
    reps = materialize(
        with_set.join(
            firsts, (F.col("doc_id") == F.col("rep")) & (F.col("set_lo") == F.col("lo")) & (F.col("set_hi") == F.col("hi"))
        ).select("rep", "n", "sketch", *WORDS),
        "representatives",
    )

    if not with_set.groupBy("doc_id").count().filter("count > 1").isEmpty():
        # Each text of an id is there once: rows that repeat it would meet each other as pairs.
        reps = materialize(reps.dropDuplicates(["rep", "sketch"]), "distinct-representatives")
        docs = materialize(docs.select(doc_id, text).distinct(), "distinct-texts")

    # The first level of all trees; nodes with a single set need no more attention.
    roots = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: _children(F.xxhash64(t, F.lit("tree")), F.col("sketch"), similarity),
    )
    rows = reps.select("rep", "n", *WORDS, F.explode(F.flatten(roots)).alias("node"))
    # A node's pivot is drawn anew for each node, so a dense group has many.
    drawn = F.min(F.struct(F.xxhash64("rep", "node").alias("draw"), "rep")).alias("drawn")
    shared = rows.groupBy("node").agg(F.count("*").alias("members"), drawn).filter("members > 1")
    rows = materialize(rows.join(shared.select("node", F.col("drawn.rep").alias("pivot")), "node"), "level-1")

    # Links to pivots: each set's likeliest, then the likeliest between components and all of sets still alone.
    release_driver(docs.sparkSession)
    other = reps.select("rep", "n", *WORDS).alias("p")
    to_pivots = rows.filter("rep <> pivot").select("rep", "n", *WORDS, "pivot").distinct().alias("r")
    to_pivots = materialize(to_pivots.join(
        other, (F.col("r.pivot") == F.col("p.rep")) & _like_sizes("r", "p", percent) & (_apart("r", "p") <= BITS)
    ).select("r.rep", "r.pivot", _apart("r", "p").alias("apart")), "pivots")
    most = to_pivots.count()
    best = to_pivots.groupBy("rep").agg(F.min(F.struct("apart", "pivot")).alias("best"))
    labels = components(confirm(best.select("rep", "best.pivot"), most, docs, doc_id, text, width, percent))
    crossing = _with_components(_with_components(to_pivots, labels), labels, "pivot", "other").filter("comp <> other")
    likeliest = crossing.groupBy(
        F.least("comp", "other").alias("c1"), F.greatest("comp", "other").alias("c2")
    ).agg(F.min(F.struct("apart", "rep", "pivot")).alias("best")).select("best.rep", "best.pivot")
    tried = likeliest.unionByName(crossing.filter("comp = rep").select("rep", "pivot"))
    labels = _more_links(labels, tried, 2 * most, docs, doc_id, text, width, percent)

    # What is left between components: the likeliest pair of each two first, then all others.
    own = docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).alias("text"))
    rest, dense = _candidates(reps, rows.drop("pivot"), labels, own, width, similarity, percent)
    release_driver(docs.sparkSession)
    rest = materialize(rest, "rest")
    most = rest.count()
    for more in dense:
        labels = labels if more.isEmpty() else _joined(labels, more)
    for only_best in (True, False):
        crossing = _with_components(_with_components(rest, labels, "a", "ca"), labels, "b", "cb").filter("ca <> cb")
        if only_best:
            crossing = crossing.groupBy(
                F.least("ca", "cb").alias("c1"), F.greatest("ca", "cb").alias("c2")
            ).agg(F.min(F.struct("apart", "a", "b")).alias("best")).select("best.a", "best.b")
        labels = _more_links(labels, crossing.select("a", "b"), most, docs, doc_id, text, width, percent)

    known = _with_components(classes, labels, "rep", "component_id").select(
        F.col("set_lo").alias("lo"), F.col("set_hi").alias("hi"), "component_id"
    )
    joined = with_set.select("doc_id", "n", "set_lo", "set_hi").join(
        known, (F.col("set_lo") == F.col("lo")) & (F.col("set_hi") == F.col("hi"))
    ).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    blank = marks.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    return joined.unionByName(blank).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
