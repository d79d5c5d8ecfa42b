"""Language identification by segmentation-marginalised unigrams.

Every language has probabilities for the pieces of a fixed public vocabulary.  A word's
probability is the sum over all its segmentations into pieces, by the forward algorithm; a
text's is the product over its words.  Training runs the forward-backward algorithm: pieces
are credited with their expected counts over all segmentations, summed over the cluster.

Words are runs of ASCII letters and non-ASCII bytes of the lower-cased text, of any length.
Every byte is a piece by itself, so any text can be segmented.  Words of up to ``LONGEST``
bytes are handled many at a time, position by position; a longer one by itself, with only the
last positions at hand and their probabilities rescaled as they shrink, so that no segmentation
is left out and no product underflows.

Training takes at most about ``train_rows`` rows, chosen by a hash of the identifier.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; ties go to the
language that sorts first; with no training rows every text is ``und``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.llm.words import LETTER, find_words, flat, pieces
from pontualis.sources.scratch import materialize

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
LONGEST = 64
_START = 1  # the byte that stands for a word's start
_R = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 18  # bytes of texts whose words are found and scored at once
_BYTES = 1 << 20  # bytes of words of one length that are handled at once
_AT_ONCE = 1 << 14  # positions of a long word whose pieces are looked up at once


def vocabulary(path: str) -> list[bytes]:
    """Letter pieces of a SentencePiece model, lower-cased, and all single bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).lower()
        letters = piece.removeprefix("▁")
        if letters.isalpha():
            found.add((b"\x01" if letters != piece else b"") + letters.encode())
    return sorted(found)


class Pieces:
    """Finds pieces by the polynomial hash of their bytes."""

    def __init__(self, vocab: list[bytes]) -> None:
        self.longest = max(map(len, vocab))
        self.size = len(vocab)
        keys = np.array([self._hash(p) for p in vocab], np.uint64)
        self.tables, left = [], np.arange(len(vocab))
        multiplier = 0xD6E8FEB86659FD93
        while len(left):
            bits = max(8, (len(left) * 32).bit_length())
            shift = np.uint64(64 - bits)
            ids = np.zeros(1 << bits, np.int32)
            slot = (keys[left] * np.uint64(multiplier)) >> shift
            ids[slot] = left
            held = np.full(1 << bits, 0, np.uint64)
            used = np.unique(slot)
            held[used] = keys[ids[used]]
            self.tables.append((np.uint64(multiplier), shift, ids, held))
            left = left[ids[slot] != left]
            multiplier = multiplier * 0xBF58476D1CE4E5B9 % (1 << 64) | 1

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_R) + b + 1) % (1 << 64)
        return h

    def find(self, h: np.ndarray) -> np.ndarray:
        """The piece of each hash; ``size`` where there is none."""
        out = np.full(len(h), self.size, np.int32)
        for multiplier, shift, ids, held in self.tables:
            slot = (h * multiplier) >> shift
            hit = held[slot] == h
            out[hit] = ids[slot[hit]]
        return out

    def spans(self, letters: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(from, to, piece) for each span of the words of equal length, by rising end."""
        n, length = letters.shape
        prefix = np.zeros((length + 1, n), np.uint64)
        for j in range(length):
            prefix[j + 1] = prefix[j] * _R + letters[:, j].astype(np.uint64) + np.uint64(1)
        for j in range(1, length + 1):
            power = 1
            for i in range(j - 1, max(-1, j - 1 - self.longest), -1):
                power = power * int(_R) % (1 << 64)
                yield i, j, self.find(prefix[j] - prefix[i] * np.uint64(power))


    def long_spans(self, word: np.ndarray) -> Iterator[tuple[int, list[int], np.ndarray]]:
        """(to, froms, pieces) for each end of a span of one long word, in order."""
        for low in range(0, len(word), _AT_ONCE):
            begin = max(0, low - self.longest)
            part = word[begin:low + _AT_ONCE].astype(np.uint64) + np.uint64(1)
            ends = np.arange(low - begin, len(part))
            h, power = np.zeros(len(ends), np.uint64), 1
            found = np.full((len(ends), self.longest), self.size, np.int32)
            for length in range(1, self.longest + 1):
                first = ends - length + 1
                there = first >= 0
                h[there] += part[first[there]] * np.uint64(power)
                power = power * int(_R) % (1 << 64)
                found[there, length - 1] = self.find(h[there])
            rows, lengths = np.nonzero(found < self.size)
            edges = np.searchsorted(rows, np.arange(len(ends) + 1))
            ids = found[rows, lengths]
            starts = (ends[rows] - lengths + begin).tolist()
            for k in range(len(ends)):
                a, b = edges[k], edges[k + 1]
                yield low + k + 1, starts[a:b], ids[a:b]


@dataclass
class Model:
    languages: list[str]
    pieces: Pieces
    probability: np.ndarray  # (piece, language); the last row, for no piece, is 0

    def word_scores(self, letters: np.ndarray) -> np.ndarray:
        """Log probabilities, (word, language), of words of equal length."""
        n, length = letters.shape
        if length > LONGEST:
            return np.stack([forward_sums(self.pieces, self.probability, word)[0] for word in letters])
        forward = np.zeros((length + 1, n, len(self.languages)))
        forward[0] = 1
        for i, j, piece in self.pieces.spans(letters):
            hit = np.flatnonzero(piece < self.pieces.size)
            if len(hit) > n // 2:
                forward[j] += forward[i] * self.probability[piece]
            elif len(hit):
                forward[j][hit] += forward[i][hit] * self.probability[piece[hit]]
        return np.log(np.maximum(forward[length], 1e-300))

    def with_no_language(self) -> Model:
        """The model with one more column, in which all pieces are equally likely."""
        even = np.full((len(self.probability), 1), 1 / self.pieces.size)
        even[-1] = 0
        return Model([*self.languages, ""], self.pieces, np.hstack([self.probability, even]))

    def text_scores(self, texts: pa.Array) -> np.ndarray:
        """Log probabilities, (text, language)."""
        return self.text_scores_and_sizes(texts)[0]

    def text_scores_and_sizes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same, and how many bytes the words of each text have, start marks included."""
        out = np.zeros((len(texts), len(self.languages)))
        sizes = np.zeros(len(texts))
        for low, high in pieces(flat(texts)[1], _CHUNK):
            # Lowered piece by piece, so that there is no second copy of a whole batch.
            doc, code, words = unique_words(*flat(pc.utf8_lower(texts.slice(low, high - low))))
            scores = np.zeros((sum(len(x) for _, x in words), len(self.languages)))
            length = np.zeros(len(scores))
            for where, letters in words:
                scores[where] = self.word_scores(letters)
                length[where] = letters.shape[1]
            for k in range(len(self.languages)):
                out[low:high, k] = np.bincount(doc, scores[code, k], high - low)
            sizes[low:high] = np.bincount(doc, length[code], high - low)
        return out, sizes


def forward_sums(found: Pieces, probability: np.ndarray, word: np.ndarray,
                 keep: bool = False) -> tuple[np.ndarray, list, list]:
    """Log probabilities of one long word, for each column of ``probability``; with ``keep`` also the
    rescaled sums up to each position, and the logarithms of their scales."""
    size = found.longest + 1
    ring = np.zeros((size, probability.shape[1]))
    ring[0] = 1
    scale = np.zeros(probability.shape[1])
    sums, scales = [ring[0].copy()], [scale.copy()]
    now = ring[0]
    for j, starts, pieces_here in found.long_spans(word):
        now = (ring[[i % size for i in starts]] * probability[pieces_here]).sum(axis=0)
        ring[j % size] = now
        if now.min() < 1e-100:
            factor = np.maximum(now, 1e-300)
            ring /= factor
            scale += np.log(factor)
            now = ring[j % size]
        if keep:
            sums.append(now.copy())
            scales.append(scale.copy())
    return np.log(np.maximum(now, 1e-300)) + scale, sums, scales


def long_counts(model: Model, language: int, weight: float, word: np.ndarray, out: np.ndarray) -> None:
    """Adds to ``out`` the expected uses of the pieces in ``weight`` copies of one long word."""
    one = model.probability[:, language:language + 1]
    total, sums, scales = forward_sums(model.pieces, one, word, keep=True)
    n, ends = len(word), list(model.pieces.long_spans(word))
    # What is after each position, in units that change as it shrinks; positions that may still
    # be added to are no further than the longest piece.
    after, unit = {n: 1.0}, 0.0
    for j, starts, here in reversed(ends):
        behind = after.pop(j)
        if behind < 1e-100 and behind > 0:
            after = {i: x / behind for i, x in after.items()}
            unit += float(np.log(behind))
            behind = 1.0
        for i, piece in zip(starts, here.tolist(), strict=True):
            chance = float(one[piece, 0])
            after[i] = after.get(i, 0.0) + behind * chance
            use = float(sums[i][0]) * chance * behind
            if use > 0:
                log = np.log(use) + float(scales[i][0]) + unit - float(total[0])
                out[piece, language] += weight * float(np.exp(log))


def unique_words(data: np.ndarray, offsets: np.ndarray):
    """Documents and word numbers of all words, and (numbers, bytes) of the distinct words by
    length, the start mark before each."""
    found = find_words(data, offsets, LETTER)
    doc, start, length, h = found.doc, found.start, found.length, found.hash
    _, first, code = np.unique(h, return_index=True, return_inverse=True)
    words, size = [], length[first]
    for n in np.unique(size):
        where = np.flatnonzero(size == n)
        letters = np.empty((len(where), n + 1), np.uint8)
        letters[:, 0] = _START
        letters[:, 1:] = data[start[first[where]][:, None] + np.arange(n)]
        words.append((where, letters))
    return doc, code, words


def expected_counts(model: Model, language: np.ndarray, weight: np.ndarray,
                    letters: np.ndarray) -> np.ndarray:
    """Expected uses (piece, language) of the pieces in ``weight`` copies of each word."""
    n, length = letters.shape
    if length > LONGEST:
        out = np.zeros((model.pieces.size + 1, len(model.languages)))
        for word, of, copies in zip(letters, language.tolist(), weight.tolist(), strict=True):
            long_counts(model, of, copies, word, out)
        return out
    spans = [(i, j, p, model.probability[p, language]) for i, j, p in model.pieces.spans(letters)]
    forward, backward = np.zeros((length + 1, n)), np.zeros((length + 1, n))
    forward[0] = backward[length] = 1
    for i, j, _, chance in spans:
        forward[j] += forward[i] * chance
    for i, j, _, chance in reversed(spans):
        backward[i] += backward[j] * chance
    scale = weight / np.maximum(forward[length], 1e-300)
    out = np.zeros((model.pieces.size + 1) * len(model.languages))
    for i, j, p, chance in spans:
        use = forward[i] * chance * backward[j] * scale
        hit = use > 0
        out += np.bincount(p[hit] * len(model.languages) + language[hit], use[hit], len(out))
    return out.reshape(-1, len(model.languages))


def train(rows: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
          language_column: str = "lang", path: str = VOCABULARY, train_rows: int = 10_000,
          rounds: int = 2, smoothing: float = 0.05) -> Model:
    """Fits a model to ``rows``; the number of model parameters that reach the driver is that
    of the pieces times the languages."""
    spark = rows.sparkSession
    rows = rows.filter(F.col(language_column).isNotNull() & F.col(text_column).isNotNull())
    share = min(1.0, train_rows / max(1, rows.count()))
    chosen = F.pmod(F.xxhash64(id_column, F.lit("train")), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = rows.filter(chosen).select(F.col(language_column).alias("lang"),
                                        F.col(text_column).alias("text"))

    def count(batches):
        for batch in batches:
            counts: Counter = Counter()
            languages = batch.column(0).to_pylist()
            data, offsets = flat(pc.utf8_lower(batch.column(1)))
            for low, high in pieces(offsets, _CHUNK):
                part = data[offsets[low]:offsets[high]]
                doc, code, words = unique_words(part, offsets[low:high + 1] - offsets[low])
                text = [b""] * sum(len(x) for _, x in words)
                for where, letters in words:
                    for k, raw in zip(where.tolist(), letters, strict=True):
                        text[k] = raw.tobytes()
                pairs, n = np.unique(np.stack([doc, code]), axis=1, return_counts=True)
                for d, c, k in zip(pairs[0].tolist(), pairs[1].tolist(), n.tolist(), strict=True):
                    counts[languages[low + d], text[c]] += k
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in counts], pa.string()),
                pa.array([k[1] for k in counts], pa.binary()),
                pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])

    words = (sample.mapInArrow(count, "lang string, word binary, n long")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    words = materialize(words, "language_words")
    languages = sorted(r.lang for r in words.select("lang").distinct().collect())
    found = Pieces(vocabulary(path))
    probability = np.full((found.size + 1, max(1, len(languages))), 1 / found.size)
    probability[-1] = 0
    model = Model(languages, found, probability)
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast(model)

        def expect(batches, shared=shared):
            now = shared.value
            total = np.zeros((now.pieces.size + 1, len(now.languages)))
            index = {x: i for i, x in enumerate(now.languages)}
            for batch in batches:
                language = np.array([index[x] for x in batch.column(0).to_pylist()], np.int64)
                data, offsets = flat(batch.column(1))
                size = np.diff(offsets)
                weight = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
                for n in np.unique(size):
                    where = np.flatnonzero(size == n)
                    for some in np.array_split(where, -(-len(where) * int(n) // _BYTES)):
                        letters = data[offsets[some][:, None] + np.arange(n)]
                        total += expected_counts(now, language[some], weight[some], letters)
            piece, language = np.nonzero(total[:-1])
            yield pa.RecordBatch.from_arrays([
                pa.array(piece, pa.int32()), pa.array(language, pa.int32()),
                pa.array(total[piece, language])], ["piece", "language", "n"])

        summed = (words.mapInArrow(expect, "piece int, language int, n double")
                  .groupBy("piece", "language").agg(F.sum("n").alias("n")))
        counts = np.full((found.size + 1, len(languages)), smoothing)
        counts[-1] = 0
        got = summed.toPandas()
        counts[got["piece"], got["language"]] += got["n"]
        model = Model(languages, found, counts / counts.sum(axis=0))
    return model


def _lettered(texts: pa.Array) -> np.ndarray:
    """Whether each text has a letter."""
    ascii_letter = pc.fill_null(pc.match_substring_regex(texts, "[A-Za-z]"), False)
    out = ascii_letter.to_numpy(zero_copy_only=False).copy()
    for k in np.flatnonzero(~out):
        out[k] = any(map(str.isalpha, texts[k].as_py() or ""))
    return out


def has_letter(text: Column) -> Column:
    """What any text needs to have a language, for when none was learned."""
    @F.arrow_udf("boolean")
    def lettered(texts: pa.Array) -> pa.Array:
        return pa.array(_lettered(texts), pa.bool_())

    return lettered(text)


def predictor(spark, model: Model):
    """A column function: text -> struct(lang, score)."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double")
    def identify(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        now = shared.value
        for array in texts:
            array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
            if not now.languages or not len(array):
                yield _answers([None] * len(array), np.zeros(len(array)))
                continue
            scores = now.text_scores(array)
            best = scores.argmax(axis=1)
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            posterior = scores.max(axis=1) / scores.sum(axis=1)
            letter = _lettered(array)
            languages = [now.languages[b] if x else None
                         for b, x in zip(best.tolist(), letter.tolist(), strict=True)]
            yield _answers(languages, np.where(letter, posterior, 0.0))

    return identify


def _answers(languages: list[str | None], scores: np.ndarray) -> pa.Array:
    lang = pa.array([x or "und" for x in languages], pa.string())
    return pa.StructArray.from_arrays([lang, pa.array(scores, pa.float64())], ["lang", "score"])


def gain(spark, model: Model):
    """A column function: by how much, in nats a byte, a text's best language explains it better than
    a model in which all pieces are equally likely; NULL for a text without letters.

    Text in a language that was learned is far above zero.  One that was not is made of pieces that
    no language has, each less likely than an even chance, so it is as far below.
    """
    shared = spark.sparkContext.broadcast(model.with_no_language())

    @F.arrow_udf("double")
    def gains(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        now = shared.value
        for array in texts:
            array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
            if not len(array):
                yield pa.array([], pa.float64())
                continue
            scores, sizes = now.text_scores_and_sizes(array)
            best = scores[:, :-1].max(axis=1) - scores[:, -1]
            yield pa.array(best / np.maximum(sizes, 1), mask=~_lettered(array))

    return gains


def held_out(id_column: str) -> Column:
    return F.crc32(F.col(id_column).cast("string")) % 5 == 0


def identify(df: DataFrame, model: Model, name: str, text_column: str = "text") -> DataFrame:
    """Adds ``name``, a struct of ``lang`` and ``score``."""
    return df.withColumn(name, predictor(df.sparkSession, model)(F.col(text_column)))
