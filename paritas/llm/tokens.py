"""Token ids of whole texts by a public tokenizer file, its words remembered within a task.

A byte-level tokenizer cuts a text into pieces before it merges, and merges each piece on its own. A space between two
characters that are no blanks always begins a piece, so the text's ids are those of its space-separated words in order,
and a word has to be encoded only when it is not remembered. What is remembered is bounded.
"""

from __future__ import annotations

import json
import re
import sys
import types
from array import array
from collections.abc import Callable, Iterator
from itertools import islice

#: Fixed value of the byte-level vocabulary: its one special string.
BYTE_SPECIAL = "<|endoftext|>"
REMEMBERED = 500_000


def once_per_worker(key: str, make: Callable[[], object]) -> object:
    """``make()``, made once in a Python worker and kept for its later tasks."""
    kept = sys.modules.setdefault("_paritas_worker", types.ModuleType("_paritas_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def byte_alphabet() -> dict[str, int]:
    """The printable characters by which byte-level vocabulary files write the 256 bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class ByteEncoder:
    """Ids that ``tokenizers`` gives by a byte-level file, without added special tokens; special strings in texts are special.

    The merging is done by ``tiktoken`` over the same file's vocabulary, several times as fast; ids are in order of
    their merges, so both give the same, which tests/llm compares.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters, special = byte_alphabet(), {x["content"]: x["id"] for x in content["added_tokens"]}
        self.special = self._packed([special[BYTE_SPECIAL]])
        ranks = {bytes(map(letters.__getitem__, token)): i for token, i in content["model"]["vocab"].items() if token not in special}
        self.merge = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.uneven = re.compile(r"\s | \s").search
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _ids(self, text: str) -> bytes:
        return self._packed(self.merge(text))

    def _part(self, text: str) -> bytes:
        if self.uneven(text):
            return self._ids(text)
        words = text.split(" ")
        get = self.known.__getitem__
        try:
            return self._ids(words[0]) + b"".join(map(get, islice(words, 1, None)))
        except KeyError:
            new = set(words[1:]).difference(self.known)
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = set(words[1:])
            self.known.update((word, self._ids(" " + word)) for word in new)
            return self._ids(words[0]) + b"".join(map(get, islice(words, 1, None)))

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the text."""
        return self.special.join(map(self._part, text.split(BYTE_SPECIAL)))


def text_groups(texts: list[str], most: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) of runs of about ``most`` characters."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]
