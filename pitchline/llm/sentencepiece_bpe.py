"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is laid out as symbols, one a character. An agenda holds every adjacent pair of symbols
that forms a piece, best score first and leftmost among equals; the top pair is merged, its new
neighbours join the agenda, and pairs whose symbols are gone are passed over. Characters without a
piece become byte pieces. Where no piece has a space mark behind other characters, merges never
cross into the next space-led chunk, so each distinct chunk is encoded once per worker.

The short atoms that are new in a lot of texts are merged side by side: their agendas lie in one array, and
in every turn each atom merges its own top pair.

In every Arrow batch the ids of all chunks that are new to the worker are checked against the
sentencepiece library; ``matches_library`` tells the texts all of whose chunks agree.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import process_cache, texts

#: Fixed value: the character that stands for a space inside pieces.
SPACE = "▁"
#: Chunks, and as many atoms, that a worker remembers; it starts anew when there are more.
CACHE_ENTRIES = 600_000
#: Texts that are encoded, checked and sent on in one go.
ROWS = 256
#: Characters of texts whose new chunks are encoded together, but for the last text.
LOT = 1 << 20
#: Characters of atoms that are merged side by side; longer ones get a heap each.
SHORT = 64
#: Rank of a pair that is no piece.
NEVER = 2**31 - 1

_CHUNK = re.compile(r" +[^ ]*")


class Codec:
    """Encodes and decodes with the pieces and scores of a model file."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(sp.get_piece_size())
        if any(sp.is_unused(i) for i in ids):
            raise ValueError("vocabularies with unused pieces are not supported")
        special = {i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        piece = {i: sp.id_to_piece(i) for i in ids}
        self.rank = {piece[i]: -sp.get_score(i) for i in ids if i not in special}  # least is merged first
        self.id = {piece[i]: i for i in ids if i not in special}
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(i == sp.unk_id() for i in self.byte_id):
            raise ValueError("vocabularies without byte pieces are not supported")
        self.piece_bytes = [b"" if sp.is_control(i) else bytes([int(piece[i][3:5], 16)]) if sp.is_byte(i)
                            else piece[i].replace(SPACE, " ").encode() for i in ids]
        #: Pairs of characters that stand side by side in some piece.
        self.pairs = {a + b for p in self.rank for a, b in zip(p[:-1], p[1:], strict=True)}
        self.chunked = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self.pairs)
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.unchecked: list[str] = []
        self.wrong: set[str] = set()
        self.chunks: dict[str, bytes] = {}
        self.atoms: dict[str, bytes] = {}

    def merge(self, text: str) -> list[str]:
        """Pieces of a text whose spaces are marked."""
        symbol, n, rank = list(text), len(text), self.rank.get
        joints = [a + b for a, b in zip(text[:-1], text[1:], strict=True)]
        agenda = [(r, left, left + 1, joint) for left, (r, joint) in enumerate(zip(map(rank, joints), joints, strict=True)) if r is not None]
        if not agenda:
            return symbol
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapify(agenda)
        while agenda:
            _, left, right, joint = heappop(agenda)
            a, b = symbol[left], symbol[right]
            if not a or not b or len(a) + len(b) != len(joint):
                continue  # one of the two has been merged since
            symbol[left], symbol[right] = joint, ""
            next_ = after[left] = after[right]
            if next_ < n:
                before[next_] = left
                pair = joint + symbol[next_]
                r = rank(pair)
                if r is not None:
                    heappush(agenda, (r, left, next_, pair))
            previous = before[left]
            if previous >= 0:
                pair = symbol[previous] + joint
                r = rank(pair)
                if r is not None:
                    heappush(agenda, (r, previous, left, pair))
        return [s for s in symbol if s]

    def _atom(self, text: str) -> bytes:
        ids: list[int] = []
        for piece in self.merge(text):
            known = self.id.get(piece)
            ids += [known] if known is not None else [self.byte_id[b] for b in piece.encode()]
        return array("I", ids).tobytes()

    @cached_property
    def _joints(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(symbol of each code point, -1 if in no piece; id of each symbol and of -1, -1 if none; pairs of symbols that form a
        piece, sorted, and one that is none; the piece's rank and symbol)."""
        number = {s: i for i, s in enumerate(dict.fromkeys([*self.rank, *(c for p in self.rank for c in p)]))}
        symbol = np.full(sys.maxunicode + 1, -1, np.int64)
        for s, i in number.items():
            if len(s) == 1:
                symbol[ord(s)] = i
        order = {r: i for i, r in enumerate(sorted(set(self.rank.values())))}
        pairs = sorted((number[p[:k]] << 32 | number[p[k:]], order[r], number[p])
                       for p, r in self.rank.items() for k in range(1, len(p)) if p[:k] in number and p[k:] in number)
        key, rank, joint = np.array([*pairs, (2**62, NEVER, 0)], np.int64).T.copy()
        return symbol, np.array([*(self.id.get(s, -1) for s in number), -1], np.int64), key, rank, joint

    @cached_property
    def _beside(self) -> np.ndarray:
        """Pairs of symbols of one character that stand side by side in some piece, sorted, and one that is none."""
        symbol = self._joints[0]
        return np.array(sorted([*(int(symbol[ord(a)]) << 32 | int(symbol[ord(b)]) for a, b in self.pairs), 2**62]), np.int64)

    def _side_by_side(self, atoms: list[str]) -> Iterator[tuple[str, bytes]]:
        """(atom, packed ids) of atoms of one character or more, but for those left with a character that is no piece."""
        symbol, id_of, keys, ranks, joints = self._joints

        def agenda(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            pair = left << 32 | right
            at = np.searchsorted(keys, pair)
            return np.where(keys[at] == pair, ranks[at], NEVER), joints[at]

        count = np.fromiter(map(len, atoms), np.int64, len(atoms))
        symbols = symbol[np.frombuffer("".join(atoms).encode("utf-32-le"), np.uint32)]
        which, first = np.arange(len(atoms)), np.cumsum(count) - count
        rank, joint = agenda(symbols, np.append(symbols[1:], -1))
        rank[first + count - 1] = NEVER
        ready: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(which):
            top = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), first)
            go = top < NEVER << 32
            left = top[go] & 0xFFFFFFFF
            symbols[left] = joint[left]
            over = np.repeat(~go, count)
            ready.append((which[~go], count[~go], symbols[over]))
            stay = ~over
            stay[left + 1] = False
            left = (np.cumsum(stay) - 1)[left]
            symbols, rank, joint, which, count = symbols[stay], rank[stay], joint[stay], which[go], count[go] - 1
            first = np.cumsum(count) - count
            for at in (left[left + 1 < first + count], left[left > first] - 1):
                rank[at], joint[at] = agenda(symbols[at], symbols[at + 1])
            rank[first + count - 1] = NEVER
        which, count, symbols = (np.concatenate(x) for x in zip(*ready, strict=True))
        ids = id_of[symbols]
        end = np.cumsum(count)
        whole = np.minimum.reduceat(ids, end - count) >= 0
        packed = ids.astype(np.uint32).tobytes()
        for k, e, n in zip(which[whole].tolist(), end[whole].tolist(), count[whole].tolist(), strict=True):
            yield atoms[k], packed[4 * (e - n) : 4 * e]

    def _cut(self, chunks: list[str]) -> tuple[list[str], list[int]]:
        """The atoms of chunks, one after the other, and their number in each chunk: no piece joins characters of
        two of them."""
        symbol, beside = self._joints[0], self._beside
        text = "".join([SPACE + c for c in chunks]).replace(" ", SPACE)
        symbols = symbol[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        pair = symbols[:-1] << 32 | symbols[1:]
        count = np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1
        first = np.cumsum(count) - count
        cuts = np.append(True, beside[np.searchsorted(beside, pair)] != pair)
        cuts[first] = True
        at = np.flatnonzero(cuts).tolist()
        return [text[s:e] for s, e in zip(at, [*at[1:], len(text)], strict=True)], np.add.reduceat(cuts.astype(np.int64), first).tolist()

    def _learn(self, chunks: list[str]) -> None:
        """Encodes chunks that are new."""
        if not chunks:
            return
        atoms, count = self._cut(chunks)
        new = set(atoms).difference(self.atoms)
        short = [a for a in new if len(a) <= SHORT]
        if short:
            self.atoms.update(self._side_by_side(short))
        self.atoms.update([(a, self._atom(a)) for a in new if a not in self.atoms])
        coded = map(self.atoms.__getitem__, atoms)
        self.chunks.update((c, next(coded) if n == 1 else b"".join(islice(coded, n))) for c, n in zip(chunks, count, strict=True))
        self.unchecked += chunks

    def _chunks(self, text: str) -> list[str]:
        """The text cut before each run of spaces, less the first space of each chunk."""
        if SPACE in text:
            text = text.replace(SPACE, " ")
        if not text:
            return []
        if not self.chunked:
            return [text]
        if text[0] == " " or "  " in text:
            return [c[1:] for c in _CHUNK.findall(" " + text)]
        return text.split(" ")

    def round_trip(self, some: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids with begin and end as unsigned 32-bit integers, text decoded from them) of texts."""
        for learned in (self.chunks, self.atoms):
            if len(learned) > CACHE_ENTRIES:
                learned.clear()
        return [(ids, self._decoded(array("I", ids))) for ids in self._coded(some)]

    def _coded(self, some: list[str]) -> Iterator[bytes]:
        begin, end, find = array("I", [self.bos]).tobytes(), array("I", [self.eos]).tobytes(), self.chunks.__getitem__
        lot: list[list[str]] = []
        characters = 0
        for k, text in enumerate(some, 1):
            lot.append(self._chunks(text))
            characters += len(text)
            if characters >= LOT or k == len(some):
                self._learn(list(set().union(*lot).difference(self.chunks)))
                yield from (begin + b"".join(map(find, chunks)) + end for chunks in lot)
                lot, characters = [], 0

    def _decoded(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.piece_bytes.__getitem__, ids)).removeprefix(b" ")

    def decode(self, ids: list[int]) -> str:
        """Text of any ids: begin and end count nothing, the space put in front goes, bytes that
        form no character become U+FFFD."""
        return self._decoded(ids).decode("utf-8", "replace")

    def library_agrees(self, some: list[str]) -> list[bool]:
        """Whether the library gives the same ids for every chunk of each text. Chunks are checked
        once, in the batch that a worker first meets them in."""
        new, self.unchecked = [c for c in self.unchecked if c], []  # the library has no ids for an empty text
        theirs = self.library.encode(new, num_threads=1) if new else []
        self.wrong.update(c for c, ids in zip(new, theirs, strict=True) if array("I", ids).tobytes() != self.chunks[c])
        if not self.wrong:
            return [True] * len(some)
        return [self.wrong.isdisjoint(self._chunks(t)) for t in some]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, decoded, matches_library) for every row of ``docs``.

    ``ids`` holds all ids, begin and end included, as little-endian unsigned 32-bit integers;
    ``decoded`` is the text they stand for. ``docs`` needs ``doc_id`` and ``text``; other columns
    are ignored. A null text counts as empty, whose ids are begin and end alone. Rows with a null
    id and repeated rows are encoded like others; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = process_cache("sentencepiece", model, lambda: Codec(model))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                some = texts(part)
                mine = codec.round_trip(some)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([i for i, _ in mine], pa.binary()),
                     pa.array([t for _, t in mine], pa.binary()).cast(pa.string()),
                     pa.array(codec.library_agrees(some))], ["doc_id", "ids", "decoded", "matches_library"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, ids binary, decoded string, matches_library boolean")
