"""Language identification by unigrams over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability
in a language is the sum over all ways to cut it into pieces, by a forward recursion that runs over
many words at once; a text's is the product over its words. Probabilities are learned by
expectation maximisation: expected counts of pieces over all segmentations (forward and backward),
summed by Spark per language, normalised with a small addend.

The model is fitted on a bounded sample of labelled documents per language (``per_language``);
everything else covers whole texts. Runs without white space longer than ``CHUNK`` are scored in
consecutive parts of that length. Letters outside the vocabulary have one small fixed probability.

Defined results: a null text or one without any letter is ``und`` with score 0; ties go to the first
language by name; without any labelled document every text is ``und``.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm.base import map_batches, narrow, own_columns, texts
from tamiz.llm.bpe import NONE, PairTable, _Places
from tamiz.session import materialize

PER_LANGUAGE = 2000  # documents per language that the model is fitted on, on average at most
ROUNDS = 3
CHUNK = 256
UNKNOWN = 1e-7
ADDEND = 0.01
BASE = np.uint64(0x100000001B3 * 2 + 0x9E3779B9)
START = "▁"
LOW = np.uint64(0xFFFFFFFF)


class Pieces:
    """A vocabulary of text pieces, looked up by a rolling hash of their code points."""

    def __init__(self, pieces: list[str]):
        chosen = sorted({p for p in pieces if p and p == p.lower()})
        self.size = len(chosen)
        self.longest = max(map(len, chosen), default=1)
        hashes = np.zeros(len(chosen), np.uint64)
        for i, piece in enumerate(chosen):
            h = 0
            for c in piece:
                h = (h * int(BASE) + ord(c) + 1) & (2**64 - 1)
            hashes[i] = h
        self.table = PairTable(hashes >> np.uint64(32), hashes & LOW, np.arange(len(chosen), dtype=np.int32))

    def lattice(self, words: np.ndarray, lengths: np.ndarray) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """For each start and length: the rows whose piece there is known, and the piece.

        Single code points outside the vocabulary get the number ``size``.
        """
        n, width = words.shape
        out = []
        for start in range(width):
            alive = np.flatnonzero(lengths > start)
            hashes, cells = np.zeros(len(alive), np.uint64), []
            for span in range(1, min(self.longest, width - start) + 1):
                inside = lengths[alive] >= start + span
                alive, hashes = alive[inside], hashes[inside]
                hashes = hashes * BASE + words[alive, start + span - 1] + np.uint64(1)
                found = self.table.find(hashes >> np.uint64(32), hashes & LOW)
                if span == 1:
                    cells.append((alive, np.where(found == NONE, self.size, found)))
                else:
                    hit = found != NONE
                    cells.append((alive[hit], found[hit]))
            out.append(cells)
        return out


@lru_cache(maxsize=2)
def load_pieces(path: str) -> Pieces:
    """The pieces of a public vocabulary file, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return Pieces([model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))])


def words_of(text: str) -> list[str]:
    """Lower-case words with the start mark, long runs in parts."""
    out = []
    for word in text.lower().split():
        word = START + word
        if len(word) <= CHUNK:
            out.append(word)
        else:
            out.extend(word[i:i + CHUNK] for i in range(0, len(word), CHUNK))
    return out


def _buckets(words: list[str], rows: int):
    """Places and padded code points of words of about the same length."""
    lengths = np.array([len(w) for w in words], np.int64)
    bucket = np.ceil(np.log2(np.maximum(4, lengths))).astype(int)
    for b in np.unique(bucket):
        places = np.flatnonzero(bucket == b)
        step = max(1, (rows * 16) >> int(b))
        for begin in range(0, len(places), step):
            part = places[begin:begin + step]
            width = int(lengths[part].max())
            raw = np.frombuffer("".join(words[i] for i in part).encode("utf-32-le", "surrogatepass"), np.uint32)
            table = np.zeros((len(part), width), np.uint64)
            table[np.arange(width) < lengths[part][:, None]] = raw
            yield part, table, lengths[part]


def _forward(cells, lengths, prob):
    """Scaled forward values and log scales by position; ``prob`` is pieces x languages."""
    n, width, langs = len(lengths), len(cells), prob.shape[1]
    alpha = np.zeros((width + 1, n, langs))
    scale = np.zeros((width + 1, n))
    alpha[0] = 1.0
    for start in range(width):
        if start:
            most = alpha[start].max(axis=1)
            live = most > 0
            alpha[start][live] /= most[live, None]
            scale[start] += np.log(np.where(live, most, 1.0))
        for span, (rows, piece) in enumerate(cells[start], 1):
            if not len(rows):
                continue
            end = start + span
            if span == 1:
                # The first arrival from the place before sets the scale that others are brought to.
                fresh = alpha[end][rows].max(axis=1) == 0
                scale[end][rows[fresh]] = scale[start][rows[fresh]]
            elif (alpha[end][rows].max(axis=1) == 0).any():
                empty = rows[alpha[end][rows].max(axis=1) == 0]
                scale[end][empty] = scale[start][empty]
            shift = np.exp(scale[start][rows] - scale[end][rows])
            alpha[end][rows] += alpha[start][rows] * prob[piece] * shift[:, None]
    return alpha, scale


def word_scores(pieces: Pieces, prob: np.ndarray, words: list[str], rows: int = 20_000) -> np.ndarray:
    """Log probability of each word in each language, over all segmentations."""
    out = np.zeros((len(words), prob.shape[1]))
    for places, table, lengths in _buckets(words, rows):
        alpha, scale = _forward(pieces.lattice(table, lengths), lengths, prob)
        line = np.arange(len(places))
        last = np.maximum(alpha[lengths, line], 1e-300)
        out[places] = np.log(last) + scale[lengths, line][:, None]
    return out


def expected_counts(pieces: Pieces, prob: np.ndarray, words: list[str], weights: np.ndarray) -> np.ndarray:
    """Expected uses of each piece; ``prob`` is one language's column, ``weights`` how often a word comes."""
    out = np.zeros(pieces.size + 1)
    prob = prob.reshape(-1, 1)
    for places, table, lengths in _buckets(words, 4_000):
        cells = pieces.lattice(table, lengths)
        alpha, scale = _forward(cells, lengths, prob)
        n, width = len(places), len(cells)
        line = np.arange(n)
        total = np.log(np.maximum(alpha[lengths, line, 0], 1e-300)) + scale[lengths, line]
        # Log backward values, position by position from the end.
        beta = np.full((width + 1, n), -np.inf)
        beta[lengths, line] = 0.0
        logs = np.log(prob[:, 0])
        for start in range(width - 1, -1, -1):
            for span, (rows, piece) in enumerate(cells[start], 1):
                if len(rows):
                    beta[start][rows] = np.logaddexp(beta[start][rows], logs[piece] + beta[start + span][rows])
            ahead = np.log(np.maximum(alpha[start, :, 0], 1e-300)) + scale[start]
            for span, (rows, piece) in enumerate(cells[start], 1):
                if len(rows):
                    share = np.exp(np.minimum(0.0, ahead[rows] + logs[piece] + beta[start + span][rows] - total[rows]))
                    out += np.bincount(piece, share * weights[places[rows]], minlength=len(out))
    return out


class LanguageModel:
    """Piece probabilities of every language and how frequent the languages are."""

    def __init__(self, pieces: Pieces, languages: list[str], prob: np.ndarray, prior: np.ndarray):
        self.pieces, self.languages, self.prob, self.prior = pieces, languages, prob, prior

    def predict(self, items: list[str]) -> tuple[list[str], np.ndarray]:
        places = _Places()
        found = [np.fromiter(map(places.__getitem__, words_of(t)), np.int64) for t in items]
        scores = word_scores(self.pieces, self.prob, list(places))
        total = np.tile(np.log(self.prior), (len(items), 1))
        for i, words in enumerate(found):
            if len(words):
                total[i] += scores[words].sum(axis=0)
        share = np.exp(total - total.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        best = total.argmax(axis=1)
        letters = [any(map(str.isalpha, t)) for t in items]
        names = [self.languages[b] if has else "und" for b, has in zip(best, letters)]
        return names, np.round(np.where(letters, share[np.arange(len(items)), best], 0.0), 9)


def fit(
    docs: DataFrame, pieces: Pieces, learn: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
    per_language: int = PER_LANGUAGE, rounds: int = ROUNDS,
) -> LanguageModel | None:
    """Learn from rows where ``learn`` holds and text and language are known; None without any."""
    spark = docs.sparkSession
    named = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in named.groupBy(lang).count().collect()}  # one row per language
    if not counts:
        return None
    languages = sorted(counts)
    share = F.create_map(*(F.lit(x) for l in languages for x in (l, min(1.0, per_language / counts[l]))))
    drawn = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(1_000_000)) < share[F.col(lang)] * 1_000_000

    def count(batches):
        for batch in narrow(batches, "text"):
            seen: dict[str, Counter[str]] = {}
            for name, item in zip(batch.column(1).to_pylist(), texts(batch.column(0))):
                seen.setdefault(name, Counter()).update(words_of(item))
            for name, words in seen.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(words)), pa.array(list(words)), pa.array(list(words.values()), pa.int64())],
                    names=["lang", "word", "n"],
                )

    sample = named.filter(drawn).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    words = sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = materialize(words, "language-words")
    prob = np.full((pieces.size + 1, len(languages)), 1.0 / (pieces.size + 1))
    prob[-1] = UNKNOWN
    place = {l: i for i, l in enumerate(languages)}
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((pieces, prob))  # bounded by vocabulary and languages

        def expect(batches):
            own, now = shared.value
            sums: dict[str, np.ndarray] = {}
            for batch in batches:
                names = np.array(batch.column(0).to_pylist(), object)
                items, n = np.array(batch.column(1).to_pylist(), object), batch.column(2).to_numpy()
                for name in set(names):
                    chosen = names == name
                    got = expected_counts(own, now[:, place[name]], list(items[chosen]), n[chosen].astype(float))
                    sums[name] = sums.get(name, 0) + got
            for name, total in sums.items():
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(used)), pa.array(used, pa.int64()), pa.array(total[used])],
                    names=["lang", "piece", "n"],
                )

        summed = words.mapInArrow(expect, "lang string, piece long, n double").groupBy("lang", "piece").agg(
            F.sum("n").alias("n")
        ).toArrow()
        counted = np.full((pieces.size, len(languages)), ADDEND)
        at = np.array([place[x] for x in summed.column(0).to_pylist()], int)
        piece = summed.column(1).to_numpy()
        known = piece < pieces.size
        counted[piece[known], at[known]] += np.round(summed.column(2).to_numpy()[known], 6)
        prob = np.vstack([counted / counted.sum(axis=0), np.full((1, len(languages)), UNKNOWN)])
    prior = np.array([counts[l] for l in languages], float)
    return LanguageModel(pieces, languages, prob, prior / prior.sum())


def identify(
    docs: DataFrame, model: LanguageModel | None, text: str = "text", pred: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (the language's posterior) to all columns; same names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(*(F.col(f"`{c}`") for c in own_columns(docs, (pred, score))))

    def run(batch):
        out = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        items = texts(batch.column(text))
        if shared.value is None:
            out[pred], out[score] = ["und"] * len(items), np.zeros(len(items))
        else:
            out[pred], out[score] = shared.value.predict(items)
        return out

    return map_batches(docs, text, run, T.StructType(
        docs.schema.fields + [T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())]
    ))
