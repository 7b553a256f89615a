"""SentencePiece encoding and decoding for merge-type vocabularies.

Method. A text's letters are symbols in a row. An agenda holds every pair of adjacent symbols that together make a piece, the highest
score first and of equal scores the leftmost; the best pair is merged and its new neighbours are proposed, until the agenda is
empty. Symbols that are no piece are spelled in bytes. Where no piece has a space mark after another letter, nothing is ever merged over
such a place: texts are cut there, the cuts of a lot of texts that are new go through their agendas side by side, one merge of each a
round, and the ids of short cuts are remembered. Longer cuts, and those with letters that are no piece, have a heap for their agenda.
Decoding joins the pieces' texts, takes off the mark in front and reads runs of bytes as UTF-8.

Every text is checked against the ``sentencepiece`` library, in the same Arrow batch: ``agrees`` says whether its ids and its decoding
are the library's. What is returned is always what the agenda found.

Defined results: a null or empty text has no ids and decodes to an empty text; a null list of ids decodes to null; ids outside the
vocabulary, null ones too, read as the unknown piece; bytes that are no UTF-8 become U+FFFD, one each; every row stands for itself,
rows that repeat included; other columns stay as they are. Vocabularies of another kind than merges, with a normalizer that changes letters, or
with user-defined or unused pieces are refused.
"""

from __future__ import annotations

import codecs
import functools
import gc
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: A cut: what stands between two places where a space mark follows another letter.
CUT = regex.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Cuts of up to so many letters are remembered, and at most twice so many of them.
SHORT_LETTERS, MEMORY_CUTS = 32, 400_000
#: Texts are encoded in lots of about so many letters.
LOT_LETTERS = 3_000_000
CODED = "ids array<int>, decoded string, agrees boolean"


def _one_by_one(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


class Vocabulary:
    """Pieces with their scores, and what each id stands for in a text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        codecs.register_error("one-by-one", _one_by_one)
        self.library, proto = SentencePieceProcessor(model_file=path), ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        kinds = ModelProto.SentencePiece.Type
        odd = {kinds.Value("USER_DEFINED"), kinds.Value("UNUSED")}
        rules, trained = proto.normalizer_spec, proto.trainer_spec
        if trained.model_type != trained.BPE or not trained.byte_fallback or any(p.type in odd for p in proto.pieces):
            raise ValueError("only merge-type vocabularies with bytes and without user-defined or unused pieces are supported")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or trained.treat_whitespace_as_suffix:
            raise ValueError("only vocabularies whose normalizer leaves texts as they are are supported")
        self.prefix = MARK if rules.add_dummy_prefix else ""
        self.ids, self.scores, self.bytes, self.surfaces = {}, {}, {}, []
        #: Ids without a text, and ids whose text may begin with a space that is the dummy prefix.
        self.silent, self.marked = set(), set()
        for i, piece in enumerate(proto.pieces):
            if piece.type == kinds.Value("NORMAL"):
                self.ids[piece.piece], self.scores[piece.piece] = i, piece.score
                self.surfaces.append(piece.piece.replace(MARK, " ").encode())
                if self.prefix and piece.piece.startswith(MARK):
                    self.marked.add(i)
            elif piece.type == kinds.Value("BYTE"):
                self.bytes[int(piece.piece[1:-1], 16)] = i
                self.surfaces.append(bytes([int(piece.piece[1:-1], 16)]))
            elif piece.type == kinds.Value("CONTROL"):
                self.silent.add(i)
                self.surfaces.append(b"")
            else:
                self.unknown = i
                self.surfaces.append(trained.unk_surface.encode())
        self.costs = {p: -s for p, s in self.scores.items()}
        self.cut = bool(self.prefix) and all(CUT.fullmatch(p) for p in self.ids)
        self._pairs()

    def _pairs(self) -> None:
        """Every pair of pieces that together make a piece, for looking up many pairs at once; every letter's symbol, which is its piece or,
        past all ids, the letter itself; and all pieces' texts in one row."""
        self.symbols = len(self.surfaces) + 0x110000
        found = sorted(
            (self.ids[p[:i]] * self.symbols + self.ids[p[i:]], self.costs[p], own)
            for p, own in self.ids.items() for i in range(1, len(p)) if p[:i] in self.ids and p[i:] in self.ids
        )
        keys, costs, own_ids = zip(*[*found, (-1, np.inf, 0)], strict=True)
        # Scores are 32-bit numbers in the vocabulary's file already.
        keys, self.pair_costs, self.pair_ids = np.array(keys), np.array(costs, np.float32), np.array(own_ids, np.int32)
        # Open addressing: each slot has the number of a pair, an empty one that of the last, which is none.
        self.shift = np.uint64(64 - max(4, (6 * len(keys)).bit_length()))
        slots = 1 << (64 - int(self.shift))
        self.slot_keys, self.slot_pairs = np.full(slots, -1), np.full(slots, len(found), np.int32)
        left = np.arange(len(found))
        at = self.slot(keys[left])
        while len(left):
            free = self.slot_pairs[at] == len(found)
            self.slot_pairs[at[free]] = left[free]  # of several for one slot the last one written has it
            self.slot_keys[at[free]] = keys[left[free]]
            out = self.slot_pairs[at] != left
            left, at = left[out], (at[out] + 1) % slots
        self.letters = np.arange(len(self.surfaces), self.symbols, dtype=np.int32)
        for piece, own in self.ids.items():
            if len(piece) == 1:
                self.letters[ord(piece)] = own
        self.row = np.frombuffer(b"".join(self.surfaces), np.uint8)
        self.ends = np.cumsum([0, *map(len, self.surfaces)])

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def proposed(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cost of merging pairs of symbols (infinite if they make no piece), and what they make."""
        keys = left * np.int64(self.symbols) + right
        at = self.slot(keys)
        there, pairs = self.slot_keys[at], self.slot_pairs[at]
        none = len(self.pair_costs) - 1
        # Few slots hold another pair: those go on to the next one.
        row = np.nonzero((there != keys) & (there >= 0))
        pairs[row] = none
        while len(row[0]):
            at[row] = (at[row] + 1) % len(self.slot_keys)
            there = self.slot_keys[at[row]]
            found = there == keys[row]
            hit = tuple(r[found] for r in row)
            pairs[hit] = self.slot_pairs[at[hit]]
            row = tuple(r[~found & (there >= 0)] for r in row)
        return self.pair_costs[pairs], self.pair_ids[pairs]

    def merged_together(self, cuts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Cuts, without the mark in front, and their ids (as 32-bit integers). Those of one length keep one length: each round merges
        the best pair of every row, and rows without a pair are done."""
        if not cuts:
            return
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        order = np.argsort(sizes, kind="stable")
        sizes, bounds = np.unique(sizes[order], return_index=True)
        for size, names in zip(sizes.tolist(), np.split(np.array(cuts, object)[order], bounds[1:]), strict=True):
            if size >= SHORT_LETTERS:
                yield from ((n, self.packed(self.merged(MARK + n))) for n in names)
                continue
            symbols = np.empty((len(names), size + 1), np.int32)
            symbols[:, 0] = self.letters[ord(MARK)]
            if size:
                symbols[:, 1:] = self.letters[np.array(names, f"<U{size}").view(np.uint32).reshape(len(names), size)]
            for done, ids in self.rows_merged(symbols):
                yield from zip(names[done], ids, strict=True)

    def rows_merged(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """Numbers and ids of rows of symbols, all of one length, as they are done."""
        number = np.arange(len(symbols))
        cost, whole = self.proposed(symbols[:, :-1], symbols[:, 1:])
        while len(number):
            width, rows = symbols.shape[1], np.arange(len(number))
            at = cost.argmin(axis=1) if width > 1 else np.zeros(len(number), np.int64)
            done = np.isinf(cost[rows, at]) if width > 1 else np.ones(len(number), bool)
            if done.any():
                ready = symbols[done]
                if (ready >= len(self.surfaces)).any():
                    yield number[done], [self.packed([i for symbol in row for i in self.spelled(symbol)]) for row in ready.tolist()]
                else:
                    yield number[done], ready.view(f"V{width * 4}").ravel().tolist()
                number, symbols, cost, whole, at = (x[~done] for x in (number, symbols, cost, whole, at))
                rows = rows[: len(number)]
            if not len(number):
                break
            places = np.arange(width)
            symbols[rows, at] = whole[rows, at]
            symbols = symbols[places != at[:, None] + 1].reshape(len(number), width - 1)
            left_over = places[:-1] != at[:, None]
            cost, whole = (x[left_over].reshape(len(number), width - 2) for x in (cost, whole))
            after, before = np.nonzero(at < width - 2)[0], np.nonzero(at > 0)[0]
            row, place = np.concatenate([after, before]), np.concatenate([at[after], at[before] - 1])
            cost[row, place], whole[row, place] = self.proposed(symbols[row, place], symbols[row, place + 1])

    def spelled(self, symbol: int) -> list[int]:
        """A symbol's id, or the bytes of a letter that is no piece."""
        if symbol < len(self.surfaces):
            return [symbol]
        return [self.bytes[b] for b in chr(symbol - len(self.surfaces)).encode()]

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"{len(ids)}i", *ids)

    def merged(self, letters: str) -> list[int]:
        """Ids of one cut. The agenda is a heap; a pair that has lost a side to another merge, or whose sides have grown, is out of date."""
        symbols, costs, agenda = list(letters), self.costs, []
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]

        def propose(left: int, right: int) -> None:
            pair = symbols[left] + symbols[right]
            if pair in costs:
                heapq.heappush(agenda, (costs[pair], left, right, pair))

        for right in range(1, len(symbols)):
            propose(right - 1, right)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != len(pair):
                continue
            symbols[left], symbols[right], following = pair, "", after[right]
            after[left] = following
            if following >= 0:
                before[following] = left
                propose(left, following)
            if before[left] >= 0:
                propose(before[left], left)
        out = []
        for symbol in filter(None, symbols):
            known = self.ids.get(symbol)
            out += [known] if known is not None else [self.bytes[b] for b in symbol.encode()]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, all of them inside the vocabulary."""
        sizes = self.ends[ids + 1] - self.ends[ids]
        shift = self.ends[ids] - np.concatenate([[0], np.cumsum(sizes)[:-1]])
        joined = self.row[np.repeat(shift, sizes) + np.arange(sizes.sum())].tobytes() if len(ids) else b""
        first = next((i for i in map(int, ids) if i not in self.silent), None)
        return joined[first in self.marked :].decode("utf-8", "one-by-one")

    def inside(self, ids: list[int | None]) -> np.ndarray:
        """Ids with the unknown piece in place of those outside the vocabulary."""
        return np.array([i if i is not None and 0 <= i < len(self.surfaces) else self.unknown for i in ids], np.int32)


class Encoder:
    """Ids of whole texts. It remembers the ids of cuts, each without the mark in front that every cut has. When it holds too many it
    starts anew and takes over from what it held only those that come again."""

    def __init__(self, vocabulary: Vocabulary, limit: int = MEMORY_CUTS):
        self.vocabulary, self.limit, self.known, self.before = vocabulary, limit, {}, {}

    def cuts(self, text: str) -> list[str]:
        marked = text.replace(" ", MARK)
        if MARK * 2 in marked or marked.startswith(MARK) or marked.endswith(MARK):
            return [c[1:] for c in CUT.findall(MARK + marked)]
        return marked.split(MARK)

    def learn(self, new: set[str]) -> dict[str, bytes]:
        """The ids of cuts that are not remembered yet. Those short enough are remembered from now on."""
        if len(self.known) + len(new) > self.limit:
            self.before, self.known = self.known, {}
        found = {c: self.before[c] for c in new if c in self.before}
        found.update(self.vocabulary.merged_together([c for c in new if c not in found]))
        self.known.update(found)
        for c in [c for c in found if len(c) >= SHORT_LETTERS]:
            del self.known[c]
        return found

    def of_all(self, texts: list[str]) -> list[np.ndarray]:
        if not self.vocabulary.cut:
            return [np.array(self.vocabulary.merged(self.vocabulary.prefix + t.replace(" ", MARK)) if t else [], np.int32) for t in texts]
        # Long lists of texts and no cycles: the collector would walk them again and again.
        collects = gc.isenabled()
        gc.disable()
        try:
            return self.looked_up([self.cuts(t) if t else [] for t in texts])
        finally:
            if collects:
                gc.enable()

    def looked_up(self, each: list[list[str]]) -> list[np.ndarray]:
        """Ids of texts given as their cuts. Every cut is looked up once, and learned only if it is not remembered."""
        ids = [list(map(self.known.get, own)) for own in each]
        new = [[k for k, i in enumerate(known) if i is None] if None in known else [] for known in ids]
        found = self.learn({own[k] for own, places in zip(each, new, strict=True) for k in places})
        for own, known, places in zip(each, ids, new, strict=True):
            for k in places:
                known[k] = found[own[k]]
        return [np.frombuffer(b"".join(known), np.int32) for known in ids]

    def lots(self, texts: Iterator[str]) -> Iterator[tuple[str, np.ndarray]]:
        """Texts with their ids, encoded a lot at a time."""
        lot, letters = [], 0
        for text in texts:
            lot.append(text)
            letters += len(text)
            if letters >= LOT_LETTERS:
                yield from zip(lot, self.of_all(lot), strict=True)
                lot, letters = [], 0
        yield from zip(lot, self.of_all(lot), strict=True)

    def ids(self, text: str) -> np.ndarray:
        return self.of_all([text])[0]


@functools.lru_cache(maxsize=1)
def shared_encoder(path: str) -> Encoder:
    """A worker's encoder: the tasks that it runs one after the other read the vocabulary once and share what is remembered."""
    return Encoder(Vocabulary(path))


def coded(docs: DataFrame, vocabulary: str, column: str = "coded", text_col: str = "text") -> DataFrame:
    """Add ``struct(ids, decoded, agrees)``: a text's ids, what they decode to, and whether the library finds the same."""

    @F.arrow_udf(CODED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = shared_encoder(vocabulary)
        known = encoder.vocabulary
        for texts in batches:
            ids, decoded, agrees = [], [], []
            whole = ((raw.as_py() or b"").decode("utf-8", "one-by-one") for raw in texts.cast("binary"))
            for text, own in encoder.lots(whole):
                ids.append(own)
                decoded.append(known.decode(own))
                theirs = known.library.encode(text, return_type="numpy")
                agrees.append(np.array_equal(own, theirs) and decoded[-1] == known.library.decode(own))
            ends = np.cumsum([0, *map(len, ids)])
            values = np.concatenate(ids) if ids else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
            yield pa.StructArray.from_arrays([lists, pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())], ["ids", "decoded", "agrees"])

    return docs.withColumn(column, run(F.col(text_col)))


def decoded(docs: DataFrame, vocabulary: str, column: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add the text that a column of ids stands for."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared_encoder(vocabulary).vocabulary
        for lists in batches:
            yield pa.array([None if x is None else known.decode(known.inside(x)) for x in lists.to_pylist()], pa.string())

    return docs.withColumn(column, run(F.col(ids_col)))


def ids_text(ids: Column) -> Column:
    """Ids as decimal numbers joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
