"""Byte-level BPE by rounds over length-bucketed, padded matrices.

The pre-tokenizer's distinct pieces of a batch are laid out as rows of padded id matrices, one
matrix per length bucket. In each round every row merges its leftmost pair of least rank; ranks of
pairs come from an open-addressing hash table, and a row's cells are compacted after its merge.
Rows without a mergeable pair leave the matrix.

Texts: a null is taken as the empty text and has no ids. Very long pieces have a bucket of their
own; there a round merges all occurrences of the least pair from left to right, as long as no new
pair ranks as low (otherwise only the leftmost), which gives the same ids in fewer rounds.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm.base import map_batches, own_columns, texts

NONE = np.int32(2**31 - 1)
EMPTY = np.uint64(2**64 - 1)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
CELLS = 1 << 20
WIDE = 128


class PairTable:
    """Rank of a pair of ids, by hashing with linear probing in two numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(left)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, EMPTY, np.uint64)
        self.ranks = np.full(1 << bits, NONE, np.int32)
        key = self._key(left, right)
        slot, waiting = (key * MULTIPLIER) >> self.shift, np.arange(len(key))
        while len(waiting):
            free = self.keys[slot[waiting]] == EMPTY
            trying = waiting[free]
            # Of several keys for one slot the last write stays; the others go on to the next slot.
            self.keys[slot[trying]] = key[trying]
            placed = self.keys[slot[waiting]] == key[waiting]
            self.ranks[slot[waiting[placed]]] = rank[waiting[placed]]
            waiting = waiting[~placed]
            slot[waiting] = (slot[waiting] + np.uint64(1)) & self.mask

    @staticmethod
    def _key(left, right):
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = self._key(left, right)
        slot = (key * MULTIPLIER) >> self.shift
        seen = self.keys[slot]
        out = np.where(seen == key, self.ranks[slot], NONE)
        waiting = np.flatnonzero((seen != key) & (seen != EMPTY))
        while len(waiting):
            slot[waiting] = (slot[waiting] + np.uint64(1)) & self.mask
            seen = self.keys[slot[waiting]]
            hit = seen == key[waiting]
            out[waiting[hit]] = self.ranks[slot[waiting[hit]]]
            waiting = waiting[~hit & (seen != EMPTY)]
        return out


class Vocabulary:
    """Ranks of byte sequences; a sequence's rank is its id."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.ranks = ranks
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.ends = np.cumsum([len(t) for t in tokens]).astype(np.int64)
        self.starts = self.ends - np.array([len(t) for t in tokens], np.int64)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        self.pairs = PairTable(np.array(left, np.int64), np.array(right, np.int64), np.array(rank, np.int32))

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each piece has."""
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        counts = np.ones(len(pieces), np.int64)
        lengths = np.array([len(p) for p in pieces], np.int64)
        todo = np.flatnonzero(whole < 0)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        bucket = np.ceil(np.log2(np.maximum(2, lengths[todo]))).astype(np.int64)
        for b in np.unique(bucket):
            rows, width = todo[bucket == b], 1 << int(b)
            if width > WIDE:
                for i in rows:
                    ids = self._merge_long(self.byte_ids[np.frombuffer(pieces[i], np.uint8)])
                    parts.append((np.array([i]), np.array([len(ids)]), ids))
                continue
            step = max(1, CELLS // width)
            for begin in range(0, len(rows), step):
                parts.extend(self._merge_rows(rows[begin:begin + step], pieces, lengths, width))
        for rows, n, _ in parts:
            counts[rows] = n
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        starts = ends - counts
        known = whole >= 0
        out[starts[known]] = whole[known]
        for rows, n, ids in parts:
            out[spread(starts[rows], n)] = ids
        return out, counts

    def _merge_rows(self, rows, pieces, lengths, width):
        n = lengths[rows].copy()
        raw = np.frombuffer(b"".join(pieces[i] for i in rows), np.uint8)
        inside = np.arange(width) < n[:, None]
        ids = np.full((len(rows), width), -1, np.int32)
        ids[inside] = self.byte_ids[raw]
        ranks = np.full((len(rows), width), NONE, np.int32)
        paired = inside[:, 1:]
        ranks[:, :-1][paired] = self.pairs.find(ids[:, :-1][paired], ids[:, 1:][paired])
        while len(rows):
            at = ranks.argmin(axis=1)
            line = np.arange(len(rows))
            best = ranks[line, at]
            done = best == NONE
            if done.any():
                cells = np.arange(ids.shape[1]) < n[done][:, None]
                yield rows[done], n[done], ids[done][cells]
                keep = ~done
                rows, n, ids, ranks, at, best = rows[keep], n[keep], ids[keep], ranks[keep], at[keep], best[keep]
                if not len(rows):
                    return
                width = int(n.max())
                ids, ranks, line = ids[:, :width], ranks[:, :width], np.arange(len(rows))
            ids[line, at] = best
            after = np.arange(ids.shape[1] - 1) > at[:, None]
            ids[:, :-1] = np.where(after, ids[:, 1:], ids[:, :-1])
            after = np.arange(ids.shape[1] - 1) >= at[:, None]
            ranks[:, :-1] = np.where(after, ranks[:, 1:], ranks[:, :-1])
            ids[:, -1], ranks[:, -1] = -1, NONE
            n -= 1
            right = at + 1 < n
            r, a = line[right], at[right]
            ranks[r, a] = self.pairs.find(ids[r, a], ids[r, a + 1])
            ranks[line[~right], at[~right]] = NONE
            left = at > 0
            r, a = line[left], at[left]
            ranks[r, a - 1] = self.pairs.find(ids[r, a - 1], ids[r, a])

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        ranks = self.pairs.find(ids[:-1], ids[1:])
        while len(ranks):
            best = ranks.min()
            if best == NONE:
                break
            found = np.flatnonzero(ranks == best)
            # In a run of overlapping pairs every second one is taken, from the left.
            run = np.cumsum(np.r_[True, np.diff(found) > 1])
            first = found[np.searchsorted(run, run)]
            found = found[(found - first) % 2 == 0]
            merged, kept = self._replace(ids, found, best)
            place = found - np.arange(len(found))
            right = found[found + 2 < len(ids)]
            left = place[place > 0]
            if (self.pairs.find(np.full(len(right), best), ids[right + 2]) <= best).any() or (
                self.pairs.find(merged[left - 1], merged[left]) <= best
            ).any():
                found = found[:1]
                merged, kept = self._replace(ids, found, best)
            ids = merged
            ranks = self.pairs.find(ids[:-1], ids[1:])
        return ids

    @staticmethod
    def _replace(ids, at, value):
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        out = ids.copy()
        out[at] = value
        return out[keep], keep

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of all ids one after the other."""
        return self.bytes[spread(self.starts[ids], self.ends[ids] - self.starts[ids])]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions ``start, start + 1, ...`` of every run, one run after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


@lru_cache(maxsize=4)
def load_ranks(path: str) -> Vocabulary:
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


class _Places(dict):
    """Numbers new keys in the order of their coming."""

    def __missing__(self, key):
        place = self[key] = len(self)
        return place


def encode_texts(vocabulary: Vocabulary, pattern, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and how many each text has."""
    places = _Places()
    find = places.__getitem__
    per_text = [np.fromiter(map(find, pattern.findall(t)), np.int64) for t in items]
    ids, counts = vocabulary.encode_pieces([p.encode("utf-8") for p in places])
    starts = np.cumsum(counts) - counts
    sizes = np.array([counts[p].sum() for p in per_text], np.int64)
    order = np.concatenate(per_text) if per_text else np.zeros(0, np.int64)
    return ids[spread(starts[order], counts[order])], sizes


def encode(docs: DataFrame, vocabulary: Vocabulary, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the column ``ids`` (array of int): the BPE ids of each whole text.

    All rows and columns stay; a column that is called like the new one is replaced. A null text
    has no ids (an empty array). Repeated rows are encoded alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by the vocabulary
    kept = own_columns(docs, (ids,))
    if text not in kept:
        raise ValueError(f"{text} is not a column besides {ids}")

    def run(batch):
        out = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        values, sizes = encode_texts(shared.value, regex.compile(pattern), texts(batch.column(text)))
        offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
        out[ids] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
        return out

    docs = docs.select(*(F.col(f"`{c}`") for c in kept))
    schema = T.StructType(docs.schema.fields + [T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return map_batches(docs, text, run, schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """Add the binary column ``data``: the bytes that the ids stand for; null ids give null."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    kept = own_columns(encoded, (data,))

    def run(batch):
        out = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        column = batch.column(ids)
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        counts = np.array(column.value_lengths().fill_null(0))
        vocab = shared.value
        lengths = (vocab.ends - vocab.starts)[values]
        ends = np.r_[0, np.cumsum(lengths)][np.r_[0, np.cumsum(counts)]].astype(np.int32)
        raw = vocab.decode_bytes(values)
        whole = pa.BinaryArray.from_buffers(
            pa.binary(), len(column), [None, pa.py_buffer(ends), pa.py_buffer(raw)]
        )
        if column.null_count:
            whole = pc.if_else(column.is_valid(), whole, pa.scalar(None, pa.binary()))
        out[data] = whole
        return out

    encoded = encoded.select(*(F.col(f"`{c}`") for c in kept))
    schema = T.StructType(encoded.schema.fields + [T.StructField(data, T.BinaryType())])
    # The positions of a batch's bytes take some 24 bytes each while it is put together.
    return map_batches(encoded, ids, run, schema, most=1 << 20)
