"""Token ids in binary files of patched frame-of-reference blocks.

A file is a row of chunks. A chunk holds up to ``CHUNK`` consecutive ids as blocks of 128: a block's
minimum is subtracted, the differences are packed at the width that nine tenths of them need, and the
high bits of the others go to an exception list of positions and values. A chunk's head tells its part
and place, which documents start in it and where, and the byte at which each block starts; a check sum
covers all of it. So a document or a range of ids is read from its blocks alone.

    chunk  head | document ids (int64) | null flags (uint8) | document starts (uint32)
           | block starts (uint32, one more than blocks) | blocks | line feed
    block  minimum (uint32) | width (uint8) | exceptions (uint8) | packed low bits
           | exception positions (uint8) | exception high bits (uint32)

Documents follow one another by ascending id, then by a digest of their texts; parts are the ranges of
one sort over the cluster, and chunks of a part follow one another. Spark writes and reads the
files (its text writer puts the line feed after each chunk), so any file system of the cluster will do.

Odd input: a null text is the empty one, which is the end id alone; a null document id comes first;
repeated rows are documents of their own; a document longer than a chunk goes on in the next ones; an
empty table gives an empty folder and an index without rows. Extra columns are not written.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamiz.llm.base import narrow, texts
from tamiz.llm.bpe import spread
from tamiz.session import materialize

BLOCK = 128
CHUNK = 1 << 18
CHUNKS_PER_FILE = 16
PERCENTILE = 0.9
TEXT_BATCH = 6 << 20
MEMO_WORDS, WORDS_AT_ONCE = 800_000, 2_000
CLOSING = ".,;:!?"
# Letters of Latin-1 and Latin Extended-A; the dotted capital I becomes two characters when made small.
LETTERS = "".join(c for c in map(chr, range(0x80, 0x180)) if c.isalpha() and c != "\u0130")
PLAIN = re.compile(f"[a-zA-Z{LETTERS}]+")
BLANK = re.compile(r"[ \n]")
# Magic, part, ids of the part before it, ids, documents that start, blocks; the document that comes in
# from the chunk before (id, null flag, start in the part); does the last one go on; bytes left; check sum.
HEAD = struct.Struct("<4sIQIIIqBQBII")
MAGIC = b"PFOR"
POLYNOMIAL = 0xEDB88320


# Blocks


def pack_blocks(ids: np.ndarray, share: float = PERCENTILE) -> tuple[np.ndarray, np.ndarray]:
    """Block starts (one more than blocks) and the bytes of all blocks of unsigned 32-bit ids."""
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(1, np.uint32), np.zeros(0, np.uint8)
    table = np.pad(ids.astype(np.uint32), (0, blocks * BLOCK - len(ids)), mode="edge").reshape(blocks, BLOCK)
    low = table.min(axis=1)
    delta = table - low[:, None]
    place = min(BLOCK - 1, int(np.ceil(share * BLOCK)) - 1)
    # The exponent of a float is the number of bits of the whole number it stands for.
    width = np.frexp(np.partition(delta, place, axis=1)[:, place].astype(np.float64))[1].astype(np.int64)
    high = delta.astype(np.uint64) >> width[:, None].astype(np.uint64)
    row, column = np.nonzero(high)
    extra = np.bincount(row, minlength=blocks)
    ends = np.cumsum(6 + BLOCK // 8 * width + 5 * extra)
    starts = np.r_[0, ends]
    out = np.zeros(int(ends[-1]), np.uint8)
    at = starts[:-1]
    out[at[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(blocks, 4)
    out[at + 4], out[at + 5] = width, extra
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        bits = (delta[rows][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)
        packed = np.packbits(bits.astype(np.uint8).reshape(len(rows), BLOCK * w), axis=1, bitorder="little")
        out[(at[rows] + 6)[:, None] + np.arange(BLOCK // 8 * w)] = packed
    rank = np.arange(len(row)) - (np.cumsum(extra) - extra)[row]
    lists = at[row] + 6 + BLOCK // 8 * width[row]
    out[lists + rank] = column
    values = high[row, column].astype("<u4").view(np.uint8).reshape(len(row), 4)
    out[(lists + extra[row] + 4 * rank)[:, None] + np.arange(4)] = values
    return starts.astype(np.uint32), out


def unpack_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """All ids (whole blocks) of the blocks that begin at ``starts`` in ``data``."""
    at = starts.astype(np.int64)
    if not len(at):
        return np.zeros(0, np.uint32)
    low = np.ascontiguousarray(data[at[:, None] + np.arange(4)]).view("<u4").ravel()
    width, extra = data[at + 4].astype(np.int64), data[at + 5].astype(np.int64)
    out = np.zeros((len(at), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        packed = data[(at[rows] + 6)[:, None] + np.arange(BLOCK // 8 * w)]
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows), BLOCK, w)
        out[rows] = bits @ (np.uint32(1) << np.arange(w, dtype=np.uint32))
    row = np.repeat(np.arange(len(at)), extra)
    rank = np.arange(len(row)) - (np.cumsum(extra) - extra)[row]
    lists = at[row] + 6 + BLOCK // 8 * width[row]
    column = data[lists + rank]
    values = np.ascontiguousarray(data[(lists + extra[row] + 4 * rank)[:, None] + np.arange(4)]).view("<u4").ravel()
    out[row, column] |= (values.astype(np.uint64) << width[row].astype(np.uint64)).astype(np.uint32)
    return (out + low[:, None]).ravel()


# Chunks


class ChunkWriter:
    """Cuts the ids of the documents of one part into chunks."""

    def __init__(self, part: int, size: int = CHUNK):
        self.part, self.size = part, size
        self.first = 0  # ids of the part before the chunk that is being filled
        self.held: list[np.ndarray] = []
        self.count = 0
        self.docs: list[tuple[int | None, int]] = []
        self.carried: tuple[int | None, int] = (None, 0)

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[bytes]:
        start, begin = self.first + self.count, 0
        self.docs.append((doc_id, self.count))
        while begin < len(ids):
            taken = ids[begin:begin + self.size - self.count]
            self.held.append(taken)
            self.count += len(taken)
            begin += len(taken)
            if self.count == self.size:
                more = begin < len(ids)
                yield self._chunk(more)
                if more:
                    self.carried = (doc_id, start)

    def close(self) -> Iterator[bytes]:
        if self.count:
            yield self._chunk(False)

    def _chunk(self, more: bool) -> bytes:
        starts, data = pack_blocks(np.concatenate(self.held))
        names = np.array([0 if d is None else d for d, _ in self.docs], "<i8")
        nulls = np.array([d is None for d, _ in self.docs], np.uint8)
        places = np.array([p for _, p in self.docs], "<u4")
        rest = b"".join(x.tobytes() for x in (names, nulls, places, starts.astype("<u4"), data))
        doc_id, start = self.carried
        head = HEAD.pack(
            MAGIC, self.part, self.first, self.count, len(self.docs), len(starts) - 1, doc_id or 0, doc_id is None,
            start, more, len(rest), zlib.crc32(rest),
        )
        self.first += self.count
        self.held, self.count, self.docs = [], 0, []
        return head + rest


def heads(content: bytes) -> Iterator[tuple[int, tuple]]:
    """Place and fields of every chunk head of a file."""
    at = 0
    while at < len(content):
        fields = HEAD.unpack_from(content, at)
        if fields[0] != MAGIC:
            raise ValueError("a chunk does not begin where the one before it ends")
        yield at, fields
        at += HEAD.size + fields[10] + 1


def chunk_pieces(content: bytes, at: int, fields: tuple, low: int = 0, high: int | None = None):
    """Pieces of documents in a chunk: (doc_id, start in the part, offset in the document, closed, ids).

    Only blocks with ids from place ``low`` up to ``high`` of the part are unpacked; pieces are cut to them.
    """
    _, _, first, count, docs, blocks, carried, null, begun, more, size, check = fields
    rest = memoryview(content)[at + HEAD.size:at + HEAD.size + size]
    if zlib.crc32(rest) != check:
        raise ValueError("a chunk is damaged")
    names = np.frombuffer(rest, "<i8", docs)
    nulls = np.frombuffer(rest, np.uint8, docs, 8 * docs)
    places = np.frombuffer(rest, "<u4", docs, 9 * docs).astype(np.int64)
    starts = np.frombuffer(rest, "<u4", blocks + 1, 13 * docs)
    data = np.frombuffer(rest, np.uint8, -1, 13 * docs + 4 * (blocks + 1))
    begin, end = max(0, low - first), count if high is None else min(count, high - first)
    if begin >= end:
        return
    one, last = begin // BLOCK, -(-end // BLOCK)
    ids = unpack_blocks(data, starts[one:last])
    edges = np.r_[0, places, count]
    for i in range(len(edges) - 1):
        a, b = max(begin, int(edges[i])), min(end, int(edges[i + 1]))
        if a >= b:
            continue
        doc_id, start = (carried, begun) if i == 0 else (int(names[i - 1]), first + int(places[i - 1]))
        if null if i == 0 else nulls[i - 1]:
            doc_id = None
        closed = b == edges[i + 1] and not (more and i == len(edges) - 2)
        yield doc_id, start, first + a - start, bool(closed), ids[a - one * BLOCK:b - one * BLOCK]


# Tables


class WordEncoder:
    """Ids of texts by the tokenizers library; what comes again is not encoded again.

    With ``by_word``, texts are cut at blanks and line feeds. The words of a batch are looked up together in
    a memo of bounded size, kept in flat arrays; new words are cut once more before the closing marks
    ``.,;:!?`` and encoded: words of Latin letters, made small, by the tokenizer's model directly, all others
    by the whole tokenizer.
    """

    def __init__(self, definition: str, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model, self.by_word = self.tokenizer.model, by_word
        # How the model's vocabulary spells the bytes of a letter, for the letters that it is given directly.
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelled = {ord(c): spell(c)[0][0] for c in LETTERS}
        # The memo: words, and for each where its ids begin and how many they are.
        self.words = pa.array([], pa.large_string())
        self.starts, self.sizes, self.ids = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def _library(self, texts: list[str]) -> list[bytes]:
        # Encodings take far more memory than their ids, so few are under way at a time.
        out = []
        for begin in range(0, len(texts), WORDS_AT_ONCE):
            found = self.tokenizer.encode_batch_fast(texts[begin:begin + WORDS_AT_ONCE], add_special_tokens=False)
            out += [array("I", f.ids).tobytes() for f in found]
        return out

    def _encode_cores(self, cores: list[str]) -> list[bytes]:
        parts = dict.fromkeys(cores)
        tokenize = self.model.tokenize
        for w in filter(PLAIN.fullmatch, cores):
            tokens = tokenize(w if w.isascii() else w.lower().translate(self.spelled))
            parts[w] = array("I", [t.id for t in tokens]).tobytes()
        other = [w for w, ids in parts.items() if ids is None]
        parts.update(zip(other, self._library(other)))
        return list(parts.values())

    def _learn(self, words: pa.Array) -> None:
        """Put distinct new words into the memo."""
        core, tail, distinct = _cores(words)
        units = self._encode_cores(distinct)
        sizes = np.fromiter(map(len, units), np.int64, len(units)) // 4
        order = np.stack([core, tail], axis=1).ravel()
        ids = np.frombuffer(b"".join(units), "<u4")[spread((np.cumsum(sizes) - sizes)[order], sizes[order])]
        self._add(words, sizes[core] + sizes[tail], ids)

    def _add(self, words: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        starts = (len(self.ids) + np.cumsum(sizes, dtype=np.int64) - sizes).astype(np.int32)
        self.starts, self.sizes = np.r_[self.starts, starts], np.r_[self.sizes, sizes.astype(np.int32)]
        self.words = pa.concat_arrays([self.words, words])
        self.ids = np.r_[self.ids, ids]

    def _forget(self, used: np.ndarray) -> None:
        """Keep only the words at the places ``used``."""
        places = np.unique(used)
        words, sizes = self.words.take(pa.array(places)), self.sizes[places]
        ids = self.ids[spread(self.starts[places], sizes)]
        self.words, self.starts, self.sizes, self.ids = words[:0], self.starts[:0], self.sizes[:0], ids[:0]
        self._add(words, sizes, ids)

    def encode(self, items: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has; a null is the empty text."""
        if not self.by_word:
            found = [x for item in texts(items) for x in self._library([item])]
            return np.frombuffer(b"".join(found), "<u4"), np.array([len(x) // 4 for x in found], np.int64)
        flat, pieces = _slices(pc.fill_null(items.cast(pa.large_string()), ""))
        split = pc.split_pattern(pc.replace_substring(flat, "\n", " "), " ")
        counts, words = split.value_lengths().to_numpy(), split.flatten()
        del flat, split
        places = pc.index_in(words, value_set=self.words)
        word = places.fill_null(-1).to_numpy(writable=True, zero_copy_only=False)
        if places.null_count:
            missing = np.flatnonzero(word < 0)
            new = words.take(pa.array(missing)).dictionary_encode()
            word[missing] = len(self.words) + new.indices.to_numpy()
            self._learn(new.dictionary)
        del words, places
        sizes = self.sizes[word]
        ids = self.ids[_spread(self.starts[word], sizes)]
        ends = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
        per_text = np.r_[0, np.cumsum(np.add.reduceat(counts, pieces))] if len(pieces) else np.zeros(1, np.int64)
        if len(self.words) > MEMO_WORDS:
            self._forget(word)
        return ids, np.diff(ends[per_text])


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``spread`` in 32 bits, for the ids of one batch."""
    ends = np.cumsum(counts, dtype=np.int32)
    out = np.repeat((starts - (ends - counts)).astype(np.int32), counts)
    out += np.arange(len(out), dtype=np.int32)
    return out


def _cores(words: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Each word as its core and its closing marks: places in a list of distinct strings.

    After a letter or digit a closing mark begins a token; after another mark it need not, and then stays
    with its word. ASCII cores are in small letters.
    """
    core = pc.utf8_rtrim(words, characters=CLOSING)
    apart = pc.match_substring_regex(core, r"[\p{L}0-9]$")
    core = pc.if_else(apart, core, words)
    cut = pc.binary_length(core).to_numpy(zero_copy_only=False)
    whole = pc.binary_length(words).to_numpy(zero_copy_only=False)
    core = pc.if_else(pc.string_is_ascii(core), pc.ascii_lower(core), core).dictionary_encode()
    distinct = core.dictionary.to_pylist()
    places = {s: i for i, s in enumerate(distinct)}
    tail = np.full(len(words), places.setdefault("", len(places)), np.int64)
    ended = np.flatnonzero(whole > cut)
    # Closing marks are one byte each.
    for i, w, n in zip(ended.tolist(), words.take(pa.array(ended)).to_pylist(), (whole - cut)[ended].tolist()):
        tail[i] = places.setdefault(w[-n:], len(places))
    return core.indices.to_numpy().astype(np.int64), tail, list(places)


def _slices(items: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts in parts of bounded length, cut at blanks, and the place of each text's first part."""
    sizes = pc.binary_length(items).to_numpy(zero_copy_only=False)
    if not len(sizes) or sizes.max() <= TEXT_BATCH:
        return items, np.arange(len(items))
    parts, firsts = [], []
    for text in items.to_pylist():
        firsts.append(len(parts))
        begin = 0
        while len(text) - begin > TEXT_BATCH:
            found = BLANK.search(text, begin + TEXT_BATCH)
            if found is None:
                break
            parts.append(text[begin:found.start()])
            begin = found.start()
        parts.append(text[begin:])
    return pa.array(parts, pa.large_string()), np.array(firsts)


@lru_cache(maxsize=2)
def _encoder(definition: str, by_word: bool) -> WordEncoder:
    return WordEncoder(definition, by_word)


def in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text`` in ranges of ascending ids over the cluster; rows of one id by a digest of their texts."""
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", "digest"]
    placed = named.withColumn("digest", F.xxhash64(F.coalesce("text", F.lit(""))))
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")


def _encoded(batches: Iterator[pa.RecordBatch], definition: str, end: int, by_word: bool) -> Iterator[pa.RecordBatch]:
    """Batches of ``doc_id, ids`` from batches of ``doc_id, text``."""
    encoder = _encoder(definition, by_word)
    for batch in narrow(batches, "text", TEXT_BATCH):
        ids, counts = encoder.encode(batch.column(1))
        whole = np.insert(ids, np.cumsum(counts), end).astype("<u4")
        ends = np.r_[0, np.cumsum(counts + 1)].astype(np.int64) * 4
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(whole)]
        held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), buffers)
        yield pa.RecordBatch.from_arrays([batch.column(0), held], names=["doc_id", "ids"])


def _chunked(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of chunks from batches of ``doc_id, ids``, all of one part."""
    from pyspark import TaskContext

    writer = ChunkWriter(TaskContext.get().partitionId(), size)
    for batch in batches:
        for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
            for chunk in writer.add(doc_id, np.frombuffer(ids.as_buffer(), "<u4")):
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.binary())], names=["chunk"])
    yield pa.RecordBatch.from_arrays([pa.array(list(writer.close()), pa.binary())], names=["chunk"])


def encode(docs: DataFrame, definition: str, end: int, by_word: bool = False) -> DataFrame:
    """``doc_id, ids`` of ``doc_id, text`` rows: unsigned 32-bit little-endian ids, the end id after each document's.

    ``definition`` is the text of a tokenizer file. ``by_word`` encodes the words of a text by themselves, and
    each once for many (see ``WordEncoder``). That gives the same ids faster, for tokenizers that turn letters
    small, keep each run of letters together and apart from other characters, and drop blanks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)  # bounded by the vocabulary

    def run(batches):
        for batch in _encoded(batches, shared.value, end, by_word):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.binary())], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def write_ids(encoded: DataFrame, path: str, chunk: int = CHUNK) -> None:
    """Write ``doc_id, ids`` below ``path`` (which has to be new) as files of chunks and an index of them.

    Rows are written in the order in which they are, partition after partition (see ``in_order``).
    ``chunk`` is the number of ids in a chunk, of which a file has up to ``CHUNKS_PER_FILE``.
    """
    _store(encoded.select("doc_id", "ids").mapInArrow(lambda batches: _chunked(batches, chunk), "chunk binary"), path)


def write_documents(
    docs: DataFrame, path: str, definition: str, end: int, by_word: bool = False, chunk: int = CHUNK
) -> None:
    """``encode`` and ``write_ids`` in one pass of each task, over ``doc_id, text`` rows as they are ordered."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches):
        return _chunked(_encoded(batches, shared.value, end, by_word), chunk)

    _store(docs.select("doc_id", "text").mapInArrow(run, "chunk binary"), path)


def _store(chunks: DataFrame, path: str) -> None:
    writer = chunks.select(F.col("chunk").cast("string").alias("value")).write
    writer = writer.option("lineSep", "\n").option("compression", "none").option("maxRecordsPerFile", CHUNKS_PER_FILE)
    writer.text(f"{path}/chunks")
    _index(_files(chunks.sparkSession, f"{path}/chunks")).write.parquet(f"{path}/index")


def _files(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.format("binaryFile").load(list(paths)).filter("length > 0").select("path", "content")


def _index(files: DataFrame) -> DataFrame:
    """path, part, first_in_part, first and ids of each chunk, from the heads alone."""
    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = [(path, f[1], f[2], f[3]) for _, f in heads(content.as_buffer().to_pybytes())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*found)], names=["path", "part", "first_in_part", "ids"]
                )

    schema = "path string, part long, first_in_part long, ids long"
    chunks = materialize(files.mapInArrow(run, schema), "packed-heads")
    # One row per partition of the write: no more than a task can hold.
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = chunks.groupBy("part").agg(F.sum("ids").alias("ids")).select(
        "part", F.coalesce(before, F.lit(0)).alias("before")
    )
    return chunks.join(parts, "part").select(
        "path", "part", "first_in_part", (F.col("before") + F.col("first_in_part")).alias("first"), "ids"
    )


PIECE = "doc_id long, part long, start_in_part long, offset long, closed boolean, ids binary"


def read_pieces(spark: SparkSession, path: str, start: int = 0, stop: int | None = None) -> DataFrame:
    """``doc_id, start, offset, closed, ids`` of all documents, in pieces that end with their chunks.

    ``start`` is the number of ids before the document in the whole set, ``offset`` that before the piece in
    the document; ``closed`` pieces end their document. With ``start`` and ``stop`` only the files, chunks
    and blocks that hold those ids are read, and pieces are cut to the range.
    """
    index = spark.read.parquet(f"{path}/index")
    files = [f"{path}/chunks"]
    offsets = index.select("part", (F.col("first") - F.col("first_in_part")).alias("before")).distinct()
    ranged = start > 0 or stop is not None
    if ranged:
        wanted = index.filter(F.col("first") + F.col("ids") > start)
        wanted = wanted if stop is None else wanted.filter(F.col("first") < stop)
        # As many as the range needs.
        files = [r["path"] for r in wanted.select("path").distinct().collect()]
        if not files:
            return spark.createDataFrame([], "doc_id long, start long, offset long, closed boolean, ids binary")
    before = {}
    if ranged:
        named = wanted.select("part", (F.col("first") - F.col("first_in_part")).alias("before")).distinct()
        before = {r["part"]: r["before"] for r in named.collect()}

    def run(batches):
        for batch in batches:
            for content in batch.column(1):
                content = content.as_buffer().to_pybytes()
                for at, fields in heads(content):
                    part, low, high = fields[1], 0, None
                    if ranged:
                        if part not in before:
                            continue
                        low, high = start - before[part], None if stop is None else stop - before[part]
                    rows = list(chunk_pieces(content, at, fields, low, high))
                    if rows:
                        yield pa.RecordBatch.from_arrays([
                            pa.array([r[0] for r in rows], pa.int64()), pa.array([part] * len(rows), pa.int64()),
                            pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                            pa.array([r[3] for r in rows], pa.bool_()),
                            pa.array([r[4].astype("<u4").tobytes() for r in rows], pa.binary()),
                        ], names=["doc_id", "part", "start_in_part", "offset", "closed", "ids"])

    pieces = _files(spark, *files).mapInArrow(run, PIECE)
    return pieces.join(offsets, "part").select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "offset", "closed", "ids"
    )


def _times(a: int, b: int) -> int:
    """Product of two polynomials of the check sum, by its polynomial."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return out


def joined_crc32(first: int, second: int, length: int) -> int:
    """crc32 of two byte strings one after the other, from their own; ``length`` is that of the second."""
    power, base, n = 1 << 31, 1 << 30, 8 * length
    while n:
        if n & 1:
            power = _times(power, base)
        base = _times(base, base)
        n >>= 1
    return _times(power, first) ^ second


def document_digests(pieces: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every whole document, from its pieces.

    Pieces are reduced to their length and crc32 where they are read; only those of documents that reach
    over chunks are brought together, and their check sums are joined without their ids.
    """
    size = (F.octet_length("ids") / 4).cast("long")
    small = materialize(
        pieces.select("doc_id", "start", "offset", "closed", size.alias("n_tokens"), F.crc32("ids").alias("ids_crc32")),
        "packed-digests",
    )
    alone = F.col("closed") & (F.col("offset") == 0)
    names = ("doc_id", "start", "n_tokens", "ids_crc32")
    # No two documents have the same start, as each has at least its end id.
    grouped = small.filter(~alone).groupBy("start").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "n_tokens", "ids_crc32"))).alias("parts"),
    )

    def run(batches):
        for batch in batches:
            sums = []
            for parts in batch.column("parts").to_pylist():
                total = 0
                for part in parts:
                    total = joined_crc32(total, part["ids_crc32"], 4 * part["n_tokens"])
                sums.append(total)
            columns = [batch.column(n) for n in names[:3]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], names=list(names))

    long = grouped.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return small.filter(alone).select(*names).unionByName(long)
