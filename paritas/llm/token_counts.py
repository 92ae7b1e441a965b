"""Token counts of whole texts by a word-level tokenizer file, huge texts by overlap resynchronisation.

Texts up to ``HUGE`` characters are counted word by word: the tokenizer never merges across blanks, and what it does before merging
(composition, lower case) is local to a word, so counts of blank-separated words add up, and a word is encoded once while it is
remembered (bounded).

Longer texts are encoded in chunks of ``CHUNK`` characters that overlap. In the overlap both encodings know the same
characters, and a token that starts right after a blank there starts in both: where such starts agree, and the tokens
that follow up to the overlap's end agree too, the encodings are spliced. If no such boundary is found, the overlap is widened until
one is, or until the rest of the text is one chunk. Only one chunk's tokens are held at a time.

Defined results: null text is empty, with 0 bytes and 0 tokens; special strings in texts count as the library's default
does, one token each; repeated rows are counted one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from paritas.llm.tokens import once_per_worker

VOCABULARY, HUGE = "word_bpe_49k.json", 32_768
CHUNK, OVERLAP = 8_192, 256
REMEMBERED = 500_000
BLANK = frozenset("\t\n\x0b\x0c\r ")


def boundary(text: str, left: list[tuple[int, int]], right: list[tuple[int, int]], begin: int, end: int) -> int | None:
    """The first place in text[begin:end] where both encodings start a token after a blank and agree from there to ``end``.

    ``left`` and ``right`` are (start, id) of tokens by place in the text; ``end`` is where the left chunk ends.
    """
    ours, theirs = [t for t in left if t[0] >= begin], [t for t in right if begin <= t[0] < end]
    for k, (start, _) in enumerate(theirs):
        if start > begin and text[start - 1] in BLANK:
            tail = theirs[k:]
            mine = [t for t in ours if t[0] >= start]
            settled = _last_blank(text, start, end)  # the last word of the left chunk may be cut off
            if [t for t in mine if t[0] < settled] == [t for t in tail if t[0] < settled] and settled > start:
                return start
    return None


def _last_blank(text: str, begin: int, end: int) -> int:
    place = end
    while place > begin and (place >= len(text) or text[place - 1] not in BLANK):
        place -= 1
    return place


def spliced_count(text: str, encode, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of the text, encoded chunk by chunk. ``encode(part)`` gives (start in part, id) pairs."""
    total, begin, end, step = 0, 0, min(chunk, len(text)), chunk
    tokens = encode(text[:end])
    while end < len(text):
        width = overlap
        while True:
            start = max(begin, end - width)
            next_end = min(len(text), end + step)
            following = [(start + at, i) for at, i in encode(text[start:next_end])]
            splice = boundary(text, tokens, following, start, end)
            if splice is not None:
                total += sum(at < splice for at, _ in tokens)
                tokens = [t for t in following if t[0] >= splice]
                begin, end, step = splice, next_end, chunk
                break
            if start == begin:  # no blank in the whole chunk: take it together with a next one of its size
                tokens, end, step = following, next_end, 2 * step
                break
            width *= 2
    return total + len(tokens)


class WordCounter:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = re.compile("[^ \t\n\x0b\x0c\r]+").findall
        self.known: dict[str, int] = {}

    def encode(self, part: str) -> list[tuple[int, int]]:
        found = self.tokenizer.encode(part, add_special_tokens=False)
        return [(start, i) for (start, _), i in zip(found.offsets, found.ids, strict=True)]

    def count(self, text: str, huge: int = HUGE) -> int:
        if len(text) > huge:
            return spliced_count(text, self.encode)
        words = self.words(text)
        try:
            return sum(map(self.known.__getitem__, words))
        except KeyError:
            new = list(set(words).difference(self.known))
            if len(self.known) + len(new) > REMEMBERED:
                self.known, new = {}, list(set(words))
            self.known.update(zip(new, map(len, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)), strict=True))
            return sum(map(self.known.__getitem__, words))


def _counted(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        counter = once_per_worker(f"words:{vocabulary}", lambda: WordCounter(public_tokenizers.path(vocabulary)))
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                n_bytes.append(len(text.encode()))
                n_tokens.append(counter.count(text))
            others = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=[*others, "n_bytes", "n_tokens"])
    return run


def counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns of ``docs(text, ...)`` without the text, with n_bytes and n_tokens."""
    others = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), "n_bytes bigint, n_tokens bigint"])
    return docs.mapInArrow(_counted(vocabulary), schema)
