"""Byte-level BPE by dynamic programming over prefixes.

Merging a byte string by rank ends in one token sequence, so each of its prefixes has one last
token. A sequence is what merging gives exactly if every two neighbours, merged from their bytes,
come out as those two; hence the last token of a prefix is the one token ending there that stands
validly behind the last token of what it leaves over. ``prefix_tokens`` fills that table from left
to right: an entry never changes with what follows, so appending goes on where the table ends, and
after an edit the table is as before once as many entries as the longest token has bytes agree.
The ids are read off by stepping back through the table.

Whether two tokens may be neighbours is told by their schedules, the merges that build each alone:
the pair is invalid if, in the order of merging, the parts that touch at their border ever form a
token whose turn comes before the next merge of either side.

Texts are cut by the pre-tokenizer's pattern first. Every distinct match is worked on once a worker.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from array import array
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.byte_tokens import PATTERN
from pitchline.llm.common import process_cache, texts

#: Matches and pairs that a worker remembers; it starts anew when there are more.
CACHE_ENTRIES = 600_000
#: Texts that are encoded and sent on in one go.
ROWS = 256

Merge = tuple[int, bytes]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Vocabulary:
    """Tokens, their merges and the validity of neighbours."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        import ahocorasick

        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("vocabularies without a token for every byte are not supported")
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.never = max(self.token) + 1  # no merge has this rank
        self.finder = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.finder.add_word(token.decode("latin-1"), (rank, len(token)))
        self.finder.make_automaton()
        self.schedules: dict[int, tuple[list[Merge], list[Merge]] | None] = {}
        self.valid: dict[tuple[int, int], bool] = {}

    def schedule(self, rank: int) -> tuple[list[Merge], list[Merge]] | None:
        """For the merges that build a token from its bytes, in order: (rank, first part after it)
        and (rank, last part after it). None if merging its bytes gives other tokens."""
        if rank in self.schedules:
            return self.schedules[rank]
        token = self.token[rank]
        cuts = list(range(len(token) + 1))
        first: list[Merge] = [(-1, token[:1])]
        last: list[Merge] = [(-1, token[-1:])]
        while len(cuts) > 2:
            ranked = [(r, i) for i in range(len(cuts) - 2) if (r := self.ranks.get(token[cuts[i] : cuts[i + 2]])) is not None]
            if not ranked:
                break
            lowest, at = min(ranked)
            del cuts[at + 1]
            first.append((lowest, token[: cuts[1]]))
            last.append((lowest, token[cuts[-2] :]))
        self.schedules[rank] = (first, last) if len(cuts) == 2 else None
        return self.schedules[rank]

    def neighbours(self, a: int, b: int) -> bool:
        """Whether merging the bytes of both tokens gives these two."""
        pair = (a, b)
        known = self.valid.get(pair)
        if known is None:
            known = self.valid[pair] = self._neighbours(a, b)
        return known

    def _neighbours(self, a: int, b: int) -> bool:
        left, right = self.schedule(a), self.schedule(b)
        if left is None or right is None:
            return False
        edges, others, rank, never = left[1], right[0], self.ranks.get, self.never
        i = j = 1
        while True:
            own = edges[i][0] if i < len(edges) else never
            other = others[j][0] if j < len(others) else never
            joint = rank(edges[i - 1][1] + others[j - 1][1])
            if joint is not None and joint < own and joint <= other:
                return False
            if own == other == never:
                return True
            if own <= other:
                i += 1
            else:
                j += 1

    def prefix_tokens(self, data: bytes, known: Sequence[int] = ()) -> list[int]:
        """The last token of each prefix of ``data``, shortest first; ``known`` are the first of them."""
        return self._filled(data, known, (), 0, 0)

    def edited(self, data: bytes, table: Sequence[int], start: int, stop: int, insert: bytes) -> tuple[bytes, list[int], int]:
        """``data`` with ``insert`` in place of its bytes from ``start`` to ``stop``, its table, and
        how many entries of it were worked out anew."""
        new = data[:start] + insert + data[stop:]
        out = self._filled(new, table[:start], table, len(insert) - (stop - start), start + len(insert))
        return new, out, self.worked

    def _filled(self, data: bytes, known: Sequence[int], old: Sequence[int], shift: int, touched: int) -> list[int]:
        last = [-1, *known]
        last += [-1] * (len(data) + 1 - len(last))
        valid, neighbours, have, agreed, self.worked = self.valid, self.neighbours, len(known), 0, 0
        text = data.decode("latin-1")
        found = self.finder.iter(text, max(0, have - self.longest)) if have else self.finder.iter(text)
        for end, (rank, size) in found:
            i = end + 1
            if last[i] >= 0 or i <= have:
                continue
            j = i - size
            if j:
                before = last[j]
                fits = valid.get((before, rank))
                if fits is None:
                    fits = neighbours(before, rank)
            else:
                fits = self.schedule(rank) is not None
            if not fits:
                continue
            last[i] = rank
            self.worked += 1
            if len(old) and i > touched:
                agreed = agreed + 1 if old[i - shift - 1] == rank else 0
                if agreed >= self.longest:
                    last[i + 1 :] = list(old[i - shift :])
                    break
        return last[1:]

    def ids(self, data: bytes, table: Sequence[int]) -> list[int]:
        """Ids of a match: itself if it is a token, otherwise the table's steps from its end."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        out, at, token = [], len(data), self.token
        while at:
            rank = table[at - 1]
            out.append(rank)
            at -= len(token[rank])
        return out[::-1]


def _newer(pattern: str) -> tuple[str, str]:
    """Letters and numbers to the regex library that tiktoken's older character tables don't know.
    Both libraries' tables hold all that Python's own does, so only characters new to it are tried."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    letters, numbers = ([c for c in regex.findall(rf"\p{{{kind}}}", every) if unicodedata.category(c) == "Cn"] for kind in "LN")
    ranks = {bytes([b]): b for b in range(256)}
    for lead, some in (("a", letters), ("1", numbers)):
        ranks |= {(lead + c).encode(): len(ranks) + n for n, c in enumerate(some)}
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return tuple("".join(c for c in some if len(probe.encode_ordinary(lead + c)) > 1) for lead, some in (("a", letters), ("1", numbers)))


def _ranges(characters: str) -> str:
    """The inside of a character class, neighbours drawn together."""
    codes = np.array(sorted(map(ord, characters)), np.int64)
    starts = np.flatnonzero(np.concatenate(([True], np.diff(codes) > 1)))
    ends = np.append(starts[1:], len(codes)) - 1
    return "".join(f"{chr(codes[a])}-{chr(codes[z])}" for a, z in zip(starts, ends, strict=True))


class Splitter:
    """The matches of ``PATTERN`` as tiktoken finds them."""

    def __init__(self) -> None:
        letters, numbers = _newer(PATTERN)
        blank = "\\t-\\r "
        ascii_ = PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{blank}A-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
        self.ascii = re.compile(ascii_.replace(r"\s", f"[{blank}]").replace(r"\S", f"[^{blank}]")).findall
        self.plain = regex.compile(PATTERN).findall
        self.newer, self.strict = None, self.plain
        if letters + numbers:
            self.newer = re.compile(f"[{_ranges(letters + numbers)}]").search
            letter = rf"[\p{{L}}--[{_ranges(letters)}]]" if letters else r"\p{L}"
            number = rf"[\p{{N}}--[{_ranges(numbers)}]]" if numbers else r"\p{N}"
            other = rf"(?:[^\s\p{{L}}\p{{N}}]|[{_ranges(letters + numbers)}])"
            pattern = PATTERN.replace(r"[^\s\p{L}\p{N}]", "OTHER").replace(r"\p{L}", letter).replace(r"\p{N}", number)
            self.strict = regex.compile("(?V1)" + pattern.replace("OTHER", other)).findall

    def matches(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii(text)
        if self.newer is None or not self.newer(text):
            return self.plain(text)
        return self.strict(text)


class Codec:
    """Encodes, decodes and re-encodes texts."""

    def __init__(self, path: str) -> None:
        self.words = Vocabulary(load_ranks(path))
        self.split = Splitter().matches
        self.known = _Matches(self.words)

    def tidy(self) -> None:
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        if len(self.words.valid) > 4 * CACHE_ENTRIES:
            self.words.valid.clear()

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.known.__getitem__, self.split(text)))

    def decoded(self, packed: bytes) -> bytes:
        return b"".join(map(self.words.token.__getitem__, array("I", packed)))

    def table(self, text: str) -> np.ndarray:
        """The last token of every byte prefix of every match."""
        rows = [self.words.prefix_tokens(m.encode()) for m in self.split(text)]
        return np.array([t for row in rows for t in row], "<u4")

    def reencoded(self, text: str, packed: bytes, table: np.ndarray, start: int, stop: int, insert: str) -> tuple[str, bytes, np.ndarray, int]:
        """(text, ids, table, bytes worked on) after characters ``start`` to ``stop`` give way to
        ``insert``. Matches never reach from other characters into white space, so the text is cut
        where such a step lies outside the edit on either side; only what lies between is encoded,
        its first match from the edit on."""
        low = max((m.start() + 1 for m in _STEP.finditer(text, max(0, start - _NEAR), start) if m.start() + 1 < start), default=-1)
        if low < 0:
            low = max((m.start() + 1 for m in _STEP.finditer(text, 0, start) if m.start() + 1 < start), default=0)
        after = _STEP.search(text, stop)
        high = after.start() + 1 if after else len(text)
        old, new = text[low:high], text[low:start] + insert + text[stop:high]
        a = len(text[:low].encode())
        b = a + len(old.encode())
        ids = np.frombuffer(packed, "<u4")
        ends = np.cumsum([len(self.words.token[i]) for i in ids.tolist()], dtype=np.int64)
        head, tail = np.searchsorted(ends, a, "right"), np.searchsorted(ends, b, "right")
        rows, coded, worked = [], [], 0
        olds = self.split(old)
        for n, match in enumerate(self.split(new)):
            data = match.encode()
            if n == 0 and olds:
                before = olds[0].encode()
                same = next((i for i, (x, y) in enumerate(zip(before, data, strict=False)) if x != y), min(len(before), len(data)))
                rest = min(len(before), len(data)) - same
                end = next((i for i in range(rest) if before[-1 - i] != data[-1 - i]), rest)
                data, row, fresh = self.words.edited(before, table[a : a + len(before)].tolist(), same, len(before) - end, data[same : len(data) - end])
            else:
                row = self.words.prefix_tokens(data)
                fresh = len(row)
            rows.append(np.array(row, "<u4"))
            coded += self.words.ids(data, row)
            worked += fresh
        middle = np.concatenate(rows) if rows else np.zeros(0, "<u4")
        out = np.concatenate([ids[:head], np.array(coded, "<u4"), ids[tail:]])
        return text[:start] + insert + text[stop:], out.tobytes(), np.concatenate([table[:a], middle, table[b:]]), worked


#: Where white space follows another character, and how far back it is first looked for.
_STEP = regex.compile(r"\S(?=\s)")
_NEAR = 4096


class _Matches(dict):
    """Packed ids of the matches met so far."""

    def __init__(self, words: Vocabulary) -> None:
        super().__init__()
        self.words = words

    def __missing__(self, match: str) -> bytes:
        data = match.encode()
        whole = self.words.ranks.get(data)
        ids = [whole] if whole is not None else self.words.ids(data, self.words.prefix_tokens(data))
        value = array("I", ids).tobytes()
        if len(data) <= 256:  # longer ones hardly come again
            self[match] = value
        return value


def _codec(path: str) -> Codec:
    return process_cache("prefix_bpe", path, lambda: Codec(path))


def encode(docs: DataFrame, path: str, prefixes: bool = False) -> DataFrame:
    """(doc_id, ids, decoded), and with ``prefixes`` the table of last tokens, for every row.

    ``path`` is a file of tokens in base 64 with their ranks, which every executor can read. Each
    match of the pre-tokenizer's pattern is encoded separately, without special tokens. ``ids`` and
    ``prefixes`` hold little-endian unsigned 32-bit integers; ``decoded`` is the bytes that the ids
    stand for. ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null text counts
    as empty, which has no ids. Rows with a null id and repeated rows are encoded like others; an
    empty table gives an empty result. Texts of any length are encoded whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                codec.tidy()
                some = texts(part)
                ids = [codec.packed(t) for t in some]
                columns: list[Any] = [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(codec.decoded, ids), pa.binary())]
                if prefixes:
                    columns.append(pa.array([codec.table(t).tobytes() for t in some], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded", "prefixes"][: len(columns)])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, ids binary, decoded binary" + (", prefixes binary" if prefixes else ""))


def reencode(edits: DataFrame, path: str) -> DataFrame:
    """(doc_id, text, ids, prefixes, worked) after one edit of each row's text.

    ``edits`` needs ``doc_id``, ``text`` and the ``ids`` and ``prefixes`` that ``encode`` gave for
    it, and the edit: characters from ``start`` to ``stop`` give way to ``insert``; an append has
    start = stop = the text's length. ``worked`` counts the bytes that were encoded anew. Null
    texts and inserts count as empty; places outside the text are drawn in to its ends, null ones
    to its end; ``stop`` before ``start`` counts as ``start``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                codec.tidy()
                done = []
                for r in part.to_pylist():
                    text, size = r["text"] or "", len(r["text"] or "")
                    start = size if r["start"] is None else min(max(r["start"], 0), size)
                    stop = max(start, size if r["stop"] is None else min(r["stop"], size))
                    done.append(codec.reencoded(text, r["ids"] or b"", np.frombuffer(r["prefixes"] or b"", "<u4"), start, stop, r["insert"] or ""))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.binary()),
                     pa.array([d[2].tobytes() for d in done], pa.binary()), pa.array([d[3] for d in done], pa.int64())],
                    ["doc_id", "text", "ids", "prefixes", "worked"])

    return edits.select(F.col("doc_id").cast("long"), "text", F.col("ids").cast("binary").alias("ids"), F.col("prefixes").cast("binary").alias("prefixes"),
                        F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), "insert").mapInArrow(
        run, "doc_id long, text string, ids binary, prefixes binary, worked long")
