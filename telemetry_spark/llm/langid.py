"""Language identification with segmentation-marginalised unigrams.

Method. Every language has a probability for each piece of a fixed public vocabulary. A word's probability is the sum over all its
segmentations into pieces, found by a forward recursion over its letters; a text's is the product over its words. The
piece probabilities come from expectation maximisation over word counts: each round is one Spark job that adds up expected piece
counts (forward-backward), smoothed by what all languages share.

The model is fitted on a bounded sample of labelled documents, ``docs_per_language`` for each language by a hash of the id; it holds at
most ``pieces * max_languages`` numbers. Scoring covers every letter of every text.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if there is nothing to
learn from; a tie goes to the first language in alphabetical order; a null id is in no fold, so it trains nothing and is not held
out; rows that repeat an id are scored each by itself; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_spark.llm.common import crc_mod, share, written

START = "▁"
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Longer runs of letters (scripts without spaces) go through rescaled recursions of their own, learning so many letters at a time.
LONG_WORD, LONG_LOT = 40, 65_536
#: Texts are scored in lots of about so many characters, whatever Arrow's batches; at most so many words are remembered, or learned from at once.
LOT_CHARS, MEMORY_WORDS, LOT_WORDS = 2_000_000, 500_000, 8192
#: So many numbers are held of the words that are remembered and of those in the recursion: the more languages, the fewer words.
MEMORY_CELLS, LOT_CELLS = 8_000_000, 32_768


def load_pieces(path: str) -> list[str]:
    """The distinct lower-cased pieces of a sentencepiece vocabulary, without its control and byte pieces."""
    import sentencepiece

    vocabulary = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = (
        vocabulary.id_to_piece(i).lower()
        for i in range(vocabulary.get_piece_size())
        if not (vocabulary.is_control(i) or vocabulary.is_byte(i) or vocabulary.is_unknown(i))
    )
    return list(dict.fromkeys(p for p in kept if WORD.fullmatch(p.lstrip(START)) or p == START))


class Slots:
    """Pieces by the hash of their letters, found for many spans of letters at once."""

    FACTOR, SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: list[str]):
        self.bits = max(4, (4 * len(pieces)).bit_length())
        self.keys, self.ids = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int64)
        for i, piece in enumerate(pieces):
            h = np.zeros(1, np.uint64)
            for letter in piece:
                h = self.longer(h, np.array([ord(letter)], np.uint64))
            at = int(self.first(h)[0])
            while self.ids[at] >= 0:
                at = (at + 1) % len(self.ids)
            self.keys[at], self.ids[at] = h[0], i

    def longer(self, hashes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        return (hashes ^ (letters + np.uint64(1))) * self.FACTOR

    def first(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * self.SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1. A 64-bit hash stands for the letters."""
        at, out = self.first(hashes), np.full(len(hashes), -1, np.int64)
        ids, same = self.ids[at], self.keys[at] == hashes
        out[same] = ids[same]
        left = np.flatnonzero(~same & (ids >= 0))  # taken by another piece: go on with the next slot
        while len(left):
            at[left] = (at[left] + 1) % len(self.ids)
            ids, same = self.ids[at[left]], self.keys[at[left]] == hashes[left]
            out[left[same]] = ids[same]
            left = left[~same & (ids >= 0)]
        return out


@dataclass
class Model:
    """``table[i, l]`` is the probability of piece i in language l; the last row stands for a letter that is no piece."""

    languages: list[str]
    pieces: list[str]
    table: np.ndarray

    def __post_init__(self):
        self.index = {p: i for i, p in enumerate(self.pieces)}
        self.slots = Slots(self.pieces)
        self.longest = max(map(len, self.pieces), default=1)

    def spans(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
        """All (begin, end) spans of words of one length, with each word's piece there, or -1."""
        size = len(words[0])
        letters = np.array(words, f"<U{size}").view(np.uint32).reshape(len(words), size).T.astype(np.uint64)
        hashes = np.zeros((size, len(words)), np.uint64)
        for end in range(1, size + 1):
            for begin in range(max(0, end - self.longest), end):
                hashes[begin] = self.slots.longer(hashes[begin], letters[end - 1])
                ids = self.slots.find(hashes[begin])
                if end - begin == 1:
                    ids[ids < 0] = len(self.pieces)
                yield begin, end, ids

    def forward(self, words: list[str], columns: slice | int = slice(None)) -> tuple[np.ndarray, list]:
        """Sums over the segmentations of every beginning of each word, and the spans that are pieces."""
        width = self.table[:, columns].reshape(len(self.table), -1).shape[1]
        table = self.table[:, columns].reshape(len(self.table), width)
        alpha = np.zeros((len(words[0]) + 1, len(words), width))
        alpha[0] = 1
        used = []
        for begin, end, ids in self.spans(words):
            have = np.flatnonzero(ids >= 0)
            if len(have):
                alpha[end, have] += alpha[begin, have] * table[ids[have]]
                used.append((begin, end, have, ids[have]))
        return alpha, used

    def long_word(self, word: str) -> np.ndarray:
        """Log probability of a long run of letters; the recursion is rescaled at each letter."""
        window, log = [np.ones(len(self.languages))], np.zeros(len(self.languages))
        for end in range(1, len(word) + 1):
            total = np.zeros(len(self.languages))
            for back in range(1, min(self.longest, end) + 1):
                i = self.index.get(word[end - back : end], len(self.pieces) if back == 1 else None)
                if i is not None:
                    total += window[-back] * self.table[i]
            window = [w / total for w in window[-self.longest + 1 :]] + [np.ones_like(total)]
            log += np.log(total)
        return log

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Log probability of each word (with its start mark) in each language, over all segmentations."""
        out, by_size = np.zeros((len(words), len(self.languages))), {}
        for at, word in enumerate(words):
            if len(word) > LONG_WORD:
                out[at] = self.long_word(word)
            else:
                by_size.setdefault(len(word), []).append(at)
        lot = max(1, min(LOT_WORDS, LOT_CELLS // max(1, len(self.languages))))
        for places in by_size.values():
            for some in (places[i : i + lot] for i in range(0, len(places), lot)):
                alpha, _ = self.forward([words[i] for i in some])
                out[some] = np.log(alpha[-1])
        return out

    def pieces_from(self, letters: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """The piece of each length at each of the letters ``lo`` to ``hi`` of a long run, or -1."""
        ids, hashes = np.full((hi - lo, self.longest), -1, np.int64), np.zeros(hi - lo, np.uint64)
        for more in range(min(self.longest, len(letters) - lo)):
            ends = letters[lo + more : hi + more]
            hashes = self.slots.longer(hashes[: len(ends)], ends)
            ids[: len(ends), more] = self.slots.find(hashes)
        ids[ids[:, 0] < 0, 0] = len(self.pieces)
        return ids

    def expected_long(self, word: str, language: int) -> np.ndarray:
        """Expected counts of the pieces in a long run of letters.

        The forward sums are rescaled at each letter. Backward goes the probability that a piece begins at a letter:
        that of a span is the one of its end, times the share that the span has in the forward sum there.
        """
        size, longest = len(word), self.longest
        letters = np.array([word], f"<U{size}").view(np.uint32).astype(np.uint64)
        column = np.append(self.table[:, language], 0.0)  # the last for spans that are no piece
        lots = [(lo, min(lo + LONG_LOT, size)) for lo in range(0, size, LONG_LOT)]
        grown, ahead = np.empty(size), np.zeros(longest + 1)
        for lo, hi in lots:
            for at, own in enumerate(column[self.pieces_from(letters, lo, hi)], lo):
                ahead[:-1] += own
                grown[at] = ahead[0]
                ahead[:-1] = ahead[1:] / ahead[0]
        grown = np.append(np.log(grown), np.zeros(longest))
        begins = np.zeros(size + 1 + longest)
        begins[size] = 1
        out, steps = np.zeros(len(self.table)), np.arange(1, longest + 1)
        for lo, hi in reversed(lots):
            ids, at = self.pieces_from(letters, lo, hi), np.arange(lo, hi)
            logs = np.append(0.0, np.cumsum(grown[lo : hi + longest]))
            shares = column[ids] * np.exp(logs[at - lo, None] - logs[at[:, None] - lo + steps])
            for i in range(hi - 1, lo - 1, -1):
                begins[i] = shares[i - lo] @ begins[i + 1 : i + 1 + longest]
            shares *= begins[at[:, None] + steps]
            out += np.bincount(ids[ids >= 0], shares[ids >= 0], len(out))
        return out

    def expected(self, words: list[str], counts: np.ndarray, language: int) -> np.ndarray:
        """Expected counts of the pieces in words of one language."""
        out, by_size = np.zeros(len(self.table)), {}
        for at, word in enumerate(words):
            if len(word) > LONG_WORD:
                out += counts[at] * self.expected_long(word, language)
            else:
                by_size.setdefault(len(word), []).append(at)
        column = self.table[:, language]
        for places in (own[i : i + LOT_WORDS] for own in by_size.values() for i in range(0, len(own), LOT_WORDS)):
            alpha, used = self.forward([words[i] for i in places], language)
            beta = np.zeros_like(alpha)
            beta[-1] = 1
            for begin, end, have, ids in reversed(used):
                beta[begin, have, 0] += column[ids] * beta[end, have, 0]
            weight = counts[places] / alpha[-1, :, 0]
            for begin, end, have, ids in used:
                value = alpha[begin, have, 0] * column[ids] * beta[end, have, 0] * weight[have]
                out += np.bincount(ids, value, len(out))
        return out


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def lots(batches: Iterator, texts_of: Callable, most_rows: int | None = None) -> Iterator:
    """Batches put together until they hold ``LOT_CHARS`` characters or ``most_rows`` rows: work on arrays pays only where these are long."""
    held, chars, rows = [], 0, 0
    for batch in batches:
        held.append(batch)
        chars += sum(len(t) for t in texts_of(batch) if t)
        rows += len(batch)
        if chars >= LOT_CHARS or (most_rows is not None and rows >= most_rows):
            yield pd.concat(held, ignore_index=True)
            held, chars, rows = [], 0, 0
    if held:
        yield pd.concat(held, ignore_index=True)


class WordLogs:
    """Log probabilities of words, remembered until there are too many of them."""

    def __init__(self, model: Model):
        self.model = model
        self.limit = max(1, min(MEMORY_WORDS, MEMORY_CELLS // max(1, len(model.languages))))
        self.forget()

    def forget(self) -> None:
        self.places, self.table = {}, np.zeros((0, len(self.model.languages)))

    def learn(self, words: set[str]) -> None:
        new = list(words.difference(self.places))
        if len(self.places) + len(new) > self.limit:
            self.forget()
            new = list(words)
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new)), strict=True))
        self.table = np.concatenate([self.table, self.model.log_probabilities([START + w for w in new])])

    def known(self, words: list[str]) -> np.ndarray:
        return self.table[np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))].sum(axis=0)

    def sums(self, texts: list[list[str]]) -> Iterator[np.ndarray]:
        """The sum over each text's words. Texts meet in groups of at most ``limit`` words; a longer one goes by itself, in slices of its own."""
        group, size = [], 0
        for words in [*texts, None]:
            if group and (words is None or size + len(words) > self.limit):
                self.learn(set().union(*group))
                yield from map(self.known, group)
                group, size = [], 0
            if words is None:
                return
            if len(words) <= self.limit:
                group.append(words)
                size += len(words)
                continue
            total = np.zeros(len(self.model.languages))
            for some in (words[i : i + self.limit] for i in range(0, len(words), self.limit)):
                self.learn(set(some))
                total += self.known(some)
            yield total


def labelled_sample(docs: DataFrame, docs_per_language: int, max_languages: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Labelled documents of the training folds, about ``docs_per_language`` for each language."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (crc_mod(F.col(id_col), 5) != 0))
    sizes = rows.groupBy(F.col(lang_col).alias("lang")).count().limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages are labelled")
    picked = F.lit(False)
    for lang, n in sorted(sizes):
        picked = picked | ((F.col(lang_col) == lang) & share(F.col(id_col), docs_per_language / n, 2))
    return rows.where(picked).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))


def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Word counts by language, passed on whenever many words are held."""
    counts = Counter()
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            counts.update((lang, w) for w in words_of(text))
            if len(counts) > MEMORY_WORDS:
                yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["lang", "word", "n"])
                counts.clear()
    yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["lang", "word", "n"])


def fit(
    docs: DataFrame, pieces_path: str, docs_per_language: int = 2000, rounds: int = 3, smoothing: float = 2000.0,
    max_languages: int = 512, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Model:
    """Piece probabilities of each labelled language, by ``rounds`` rounds of expectation maximisation."""
    sample = labelled_sample(docs, docs_per_language, max_languages, id_col, text_col, lang_col)
    counted = sample.mapInPandas(count_words, "lang string, word string, n bigint")
    words = written(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    languages = sorted(r[0] for r in words.select("lang").distinct().collect())
    pieces = load_pieces(pieces_path)
    size = len(pieces) + 1
    model = Model(languages, pieces, np.full((size, len(languages)), 1 / size))
    for _ in range(rounds if languages else 0):
        model.table = smoothed(expected_counts(words, model), smoothing)
    return model


def expected_counts(words: DataFrame, model: Model) -> np.ndarray:
    """Expected piece counts of all languages: each task adds up its words, Spark the tasks' sums."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(model.table), len(model.languages)))
        for batch in lots(batches, lambda b: b["word"], LOT_WORDS * len(model.languages)):
            for lang, own in batch.groupby("lang"):
                at = model.languages.index(lang)
                sums[:, at] += model.expected([START + w for w in own["word"]], own["n"].to_numpy(float), at)
        piece, lang = np.nonzero(sums)
        yield pd.DataFrame({"piece": piece, "lang": lang, "n": sums[piece, lang]})

    total = words.mapInPandas(run, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(model.table), len(model.languages)))
    counts[total["piece"], total["lang"]] = total["n"]
    return counts


def smoothed(counts: np.ndarray, weight: float) -> np.ndarray:
    """Probabilities, with ``weight`` counts' worth of what the languages share added to each."""
    shared = (counts / np.maximum(counts.sum(axis=0), 1)).mean(axis=1) + 1e-3 / len(counts)
    shared /= shared.sum()
    return (counts + weight * shared[:, None]) / (counts.sum(axis=0) + weight)


def annotated(docs: DataFrame, model: Model, column: str, text_col: str = "text") -> DataFrame:
    """Add ``struct(lang_pred, score)``: the likeliest language and its share of all languages' likelihood."""

    def decide(logs: np.ndarray, n: int) -> tuple[str, float]:
        if not n or not len(logs):
            return "und", 0.0
        best = int(np.argmax(logs))
        return model.languages[best], float(1 / np.exp(logs - logs[best]).sum())

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        logs = WordLogs(model)
        for texts in lots(batches, lambda b: b):
            words = [words_of(text) for text in texts]
            found = [decide(total, len(own)) for total, own in zip(logs.sums(words), words, strict=True)]
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    return docs.withColumn(column, run(F.col(text_col)))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each document."""
    held_out = F.coalesce(crc_mod(F.col(id_col), 5) == 0, F.lit(False))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    return annotated(rows, model, "found").select("doc_id", "held_out", "found.lang_pred", "found.score")
