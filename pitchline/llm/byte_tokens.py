"""Exact byte-level BPE ids of whole texts as the tokenizers library gives them.

The merges are the library file's own. Texts in Latin-1 go through tiktoken, which runs the same
merges three times as fast; other texts, where the two libraries' Unicode tables might differ, and
files whose merges aren't in the order of their ids go through tokenizers itself.
"""

from __future__ import annotations

import json
import os
from array import array

import numpy as np

from pitchline.llm.common import process_cache

#: Fixed value: the pre-tokenizer's pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_symbol() -> dict[str, int]:
    """The alphabet of byte-level BPE: printable bytes stand for themselves, the others follow
    from code point 256 on in their order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Encoder:
    """``packed(texts)``: each text's ids as little-endian unsigned 32-bit integers. As the library does
    by itself, strings of tokens that the file adds to the vocabulary become those tokens."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, pre = file["model"], file["pre_tokenizer"] or {}
        self.added = [t["content"] for t in file.get("added_tokens") or []]
        byte = _byte_of_symbol()
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        in_order = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                    and file["normalizer"] is None and file["post_processor"] is None
                    and [model["vocab"][m] for m in merged] == list(range(256, 256 + len(merged))))
        self.fast = tiktoken.Encoding(
            "own", pat_str=PATTERN, special_tokens={},
            mergeable_ranks={bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if i < 256 + len(merged)},
        ) if in_order else None

    def _one(self, text: str) -> bytes:
        if self.fast is not None and not any(t in text for t in self.added):
            try:
                text.encode("latin-1")
                ids = self.fast.encode_ordinary(text)
                return array("I", ids).tobytes() if array("I").itemsize == 4 else np.array(ids, "<u4").tobytes()
            except UnicodeEncodeError:
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def packed(self, texts: list[str]) -> list[bytes]:
        return [self._one(t) for t in texts]


def encoder(path: str) -> Encoder:
    return process_cache("byte_bpe", path, lambda: Encoder(path))
