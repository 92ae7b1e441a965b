"""Language-model scores by logistic context mixing, over the words of a text and within words.

A text is its lower-cased words and an end word, read in order. Up to ``TREE`` of the most frequent words have a binary code of their own (by
frequency); all others share one, the escape. Every bit is predicted by the contexts none, the word before and the two words
before, across the text. Each context's counts give a prediction; the predictions are mixed in the logistic domain by
weights that a gate selects (how much the contexts have seen). What is learned comes from all training texts:

1. words are counted (per task, then by a shuffle that grows with the corpus);
2. every training text is read in order: each task predicts with what it has seen so far, moves its weights by the error and then counts
   the bits in hashed tables, whose size follows the number of words up to ``MOST_BITS``. The tables are merged slot by slot, the weights averaged.

What stands behind an escape is spelled byte by byte with its closing blank, bytes in a fixed binary code, and every bit is predicted by
several hashed contexts within the word (the last one to four bytes, and the whole prefix), mixed likewise and refined by a table that
maps the mixture, per gate, to what has come true. This is learned from the counted words. One mixer learns words as they were seen; a
second one, for unseen words, predicts each word as if it had been seen once less. A spelling depends on the word alone, so each
distinct word is spelled once. Up to ``HOT`` of the most frequent words are handed to the tasks that read the texts; all others are joined.

Within a text the model adapts as it reads: a word's probability moves from the mixer's p at that place to what the text has shown, (k + b p) / (t + b)
after k occurrences in t tokens; the strength b is averaged over ``STRENGTHS``. As in the base, every unseen word is one event (its share of
the escapes is that of words seen once); the bits that spell unseen words are added in ``bits_per_byte``, which is a complete code length.

Defined results: null text is empty (one token, the end); a null id counts as the empty text for the fold; repeated rows get equal
results each; without training texts N is 0 and every word is unseen; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import stored, text_of
from paritas.llm.near_dedup import INVERSE, MIX, MULTIPLIER, PLAIN, scramble

END_WORD, HOT = b"\n", 250_000
OWN = b"\t"  # begins the key of a text's own row; no word has a blank
#: log2 of the slots of each context's table: 1 to 4 bytes, whole prefix.
TABLE_BITS = (17, 20, 21, 22, 22)
SLOTS = sum(1 << b for b in TABLE_BITS)
CHUNK = 1 << 17
GATES, INPUTS, CELLS = 64, len(TABLE_BITS) + 1, 33
WORDS_AT_ONCE, FLUSH, MERGERS = 2_000, 400_000, 16
STRENGTHS = (30.0, 120.0, 500.0, 2000.0)
#: Words with a code of their own; log2 of the most slots of the tables for one and two words before.
TREE, MOST_BITS = 32_768, (22, 23)
WORD_GATES, WORD_INPUTS, PIECE, TOKENS_AT_ONCE, TOKENS_PER_STEP = 16, 4, 1 << 14, 40_000, 4_000

# Counts are kept as one byte each, on a logarithmic scale; these say what a byte stands for.
COUNT_OF = np.exp2(np.arange(256) / 8.0) - 1.0
_ZEROS, _ONES = np.repeat(COUNT_OF, 256), np.tile(COUNT_OF, 256)
STRETCHED = np.clip(np.log((_ONES + 0.05) / (_ZEROS + 0.05)), -8.0, 8.0).astype(np.float32)
CONFIDENCE = np.searchsorted([0.5, 2.5, 16.5], _ZEROS + _ONES).astype(np.int64)


def packed_counts(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(8.0 * np.log2(1.0 + n)), 255.0).astype(np.uint8)


_LESS, _STATE = packed_counts(np.maximum(COUNT_OF - 1.0, 0.0)).astype(np.uint16), np.arange(1 << 16, dtype=np.uint16)
#: A state with one zero less, for every state; then with one one less.
ONE_LESS = np.concatenate([(_STATE & 0xFF) | _LESS[_STATE >> 8] << 8, (_STATE & 0xFF00) | _LESS[_STATE & 0xFF]])


def byte_code(frequencies: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, codes) of a Huffman code for the 256 bytes."""
    heap = [(n + 1, b, (b,)) for b, n in enumerate(frequencies)]
    heapq.heapify(heap)
    lengths, codes = [0] * 256, [0] * 256
    while len(heap) > 1:
        low, high = heapq.heappop(heap), heapq.heappop(heap)
        for bit, (_, _, symbols) in enumerate((low, high)):
            for b in symbols:
                codes[b] |= bit << lengths[b]
                lengths[b] += 1
        heapq.heappush(heap, (low[0] + high[0], low[1], low[2] + high[2]))
    return np.array(lengths), np.array(codes, dtype=np.int64)


def bits_of(words: list[str], code: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(word of each bit, the bit, its slot in the joint table per context) of all words."""
    data = np.frombuffer((" ".join(words) + " ").encode(), np.uint8)
    n = len(data)
    closing = data == 0x20
    word = np.cumsum(closing) - closing
    first = np.concatenate([[0], np.flatnonzero(closing)[:-1] + 1])
    at = np.arange(n) - first[word]
    value = data.astype(np.uint64)
    contexts, context = [], np.zeros(n, np.uint64)
    for k in range(1, 5):
        before = np.zeros(n, np.uint64)
        before[k:] = value[:-k] + np.uint64(1)
        before[at < k] = 0
        context = context | before << np.uint64(9 * (k - 1))
        contexts.append(context)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(n + 1, MULTIPLIER, np.uint64))
        back = np.cumprod(np.full(n + 1, INVERSE, np.uint64))
        total = np.concatenate([[np.uint64(0)], np.cumsum(scramble(value + np.uint64(1)) * powers[:-1], dtype=np.uint64)])
        contexts.append((total[:-1] - total[first[word]]) * back[first[word]] + at.astype(np.uint64))
        length = code[0][data]
        rows = np.repeat(np.arange(n), length)
        depth = np.arange(len(rows)) - np.repeat(np.cumsum(length) - length, length)
        left = length[rows] - depth
        letters = code[1][data][rows]
        bit = (letters >> (left - 1)) & 1
        node = scramble(((np.int64(1) << depth) | (letters >> left)).astype(np.uint64))
        slots, base = [], 0
        for k, (context, size) in enumerate(zip(contexts, TABLE_BITS, strict=True)):
            hashed = scramble(context * MULTIPLIER + np.uint64(k))[rows]
            slots.append(base + ((hashed ^ node) * MULTIPLIER >> np.uint64(64 - size)).astype(np.int64))
            base += 1 << size
    return word[rows], bit, slots


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[list[str], np.ndarray]]:
    words, counts = batch.column("word").to_pylist(), batch.column("c").to_numpy()
    for i in range(0, len(words), WORDS_AT_ONCE):
        yield words[i:i + WORDS_AT_ONCE], counts[i:i + WORDS_AT_ONCE]


# ---------------------------------------------------------------- counting


def _texts(words: list[bytes | None]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc rows (text, learns) -> word, c: training occurrences; words of other texts come with 0."""
    seen: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([_texts(list(seen)), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])

    for batch in batches:
        for text, learns in zip(batch.column("text"), batch.column("learns").to_pylist(), strict=True):
            words = plain_words(text.as_py())
            if learns:
                seen.update(words)
                seen[END_WORD] += 1
            else:
                seen.update(dict.fromkeys(words, 0))
                seen[END_WORD] += 0
            if len(seen) > FLUSH:
                yield out()
                seen.clear()
    if seen:
        yield out()


def plain_words(text: str) -> list[bytes]:
    """The words, A-Z lowered, in UTF-8."""
    return text.encode().translate(PLAIN).split()


def _byte_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(256, np.int64)
    for batch in batches:
        for words, _ in _batches(batch):
            total += np.bincount(np.frombuffer((" ".join(words) + " ").encode(), np.uint8), minlength=256)
    yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(total)], names=["byte", "n"])


def _tables(code):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """word, c -> for each chunk of the joint table that was touched: slots, zeros and ones seen there."""
        seen = np.zeros((SLOTS, 2), np.float32)
        for batch in batches:
            for words, counts in _batches(batch):
                word, bit, slots = bits_of(words, code)
                weight = counts[word].astype(np.float32)
                for slot in slots:
                    np.add.at(seen.reshape(-1), 2 * slot + bit, weight)
        for chunk in range(-(-SLOTS // CHUNK)):
            part = seen[chunk * CHUNK:(chunk + 1) * CHUNK]
            used = np.flatnonzero(part[:, 0] + part[:, 1]).astype(np.int32)
            if len(used):
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk]), pa.array([used.tobytes()], pa.binary()),
                    pa.array([part[used, 0].tobytes()], pa.binary()), pa.array([part[used, 1].tobytes()], pa.binary()),
                ], names=["chunk", "used", "zeros", "ones"])
    return run


def _merged(key, pdf):
    """All parts of one chunk -> its packed states."""
    import pandas as pd

    zeros, ones = np.zeros(CHUNK), np.zeros(CHUNK)
    for used, zero, one in zip(pdf["used"], pdf["zeros"], pdf["ones"], strict=True):
        at = np.frombuffer(used, np.int32)
        zeros[at] += np.frombuffer(zero, np.float32)
        ones[at] += np.frombuffer(one, np.float32)
    state = packed_counts(zeros).astype(np.uint16) << 8 | packed_counts(ones)
    return pd.DataFrame({"chunk": [key[0]], "state": [state.tobytes()]})


# ---------------------------------------------------------------- mixing


def predicted(states: list[np.ndarray], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, gate, mixture in the logistic domain) of bits with the given states."""
    states = [s.astype(np.intp) for s in states]
    inputs = np.stack([*(STRETCHED.take(s, mode="clip") for s in states), np.full(len(states[0]), 0.3, np.float32)])
    gate = CONFIDENCE.take(states[4], mode="clip") * 16 + CONFIDENCE.take(states[3], mode="clip") * 4 + CONFIDENCE.take(states[2], mode="clip")
    mixed = weights[:, 0].take(gate, mode="clip") * inputs[0]
    for k in range(1, INPUTS):
        mixed += weights[:, k].take(gate, mode="clip") * inputs[k]
    return inputs, gate, np.clip(mixed, -11.0, 11.0, out=mixed)


def _cell(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower cell of the refinement and the share of the upper one."""
    place = np.clip((mixed + 8.0) * 2.0, 0.0, CELLS - 1.001)
    low = place.astype(np.int64)
    return low, place - low


def refined(gate: np.ndarray, mixed: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Probability of a one: the mean of the mixture and of what the refinement knows about it."""
    low, share = _cell(mixed)
    known = table[gate, low] * (1.0 - share) + table[gate, low + 1] * share
    return np.clip(0.5 * (known + 1.0 / (1.0 + np.exp(-mixed))), 1e-6, 1.0 - 1e-6)


def first_weights() -> np.ndarray:
    return np.tile(np.array([0.1, 0.15, 0.2, 0.25, 0.4, 0.0]), (GATES, 1))


def _learned(model, code):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """word, c -> the sums of both mixers: words as they were seen, and as if seen once less."""
        table, turn = model.value, 0
        mixers = [(first_weights(), np.zeros(GATES), np.zeros((GATES, CELLS)), np.zeros((GATES, CELLS))) for _ in range(2)]
        for batch in batches:
            for words, counts in _batches(batch):
                word, bits, slots = bits_of(words, code)
                weight = counts[word].astype(np.float64)
                found = [table[slot] for slot in slots]
                for part in range(0, len(bits), 65_536):
                    cut, turn = slice(part, part + 65_536), turn + 1
                    bit, seen, states = bits[cut], weight[cut], [x[cut] for x in found]
                    less = [ONE_LESS.take(x + (bit << 16), mode="clip") for x in states]
                    for given, (weights, mass, hits, tries) in zip((states, less), mixers, strict=True):
                        inputs, gate, mixed = predicted(given, weights)
                        low, share = _cell(mixed)
                        for cell, w in ((low, 1.0 - share), (low + 1, share)):
                            zeros, ones = np.bincount((gate * CELLS + cell) * 2 + bit, seen * w, GATES * CELLS * 2).reshape(GATES, CELLS, 2).transpose(2, 0, 1)
                            tries += zeros + ones
                            hits += ones
                        error = (bit - 1.0 / (1.0 + np.exp(-mixed))) * seen
                        here = np.bincount(gate, seen, GATES)
                        slope = np.stack([np.bincount(gate, error * x, GATES) for x in inputs], axis=1)
                        weights += 0.3 / math.sqrt(turn) * slope / np.maximum(here, 1.0)[:, None]
                        mass += here
        sums = np.concatenate([x.ravel() for weights, mass, hits, tries in mixers for x in (weights * mass[:, None], mass, hits, tries)])
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % MERGERS]), pa.array([sums.tobytes()], pa.binary())], names=["merger", "sums"])
    return run


def _added(key, pdf):
    import pandas as pd

    return pd.DataFrame({"sums": [np.sum([np.frombuffer(x) for x in pdf["sums"]], axis=0).tobytes()]})


def _mixers(known: DataFrame, model, code) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, refinement) of both mixers, averaged over the tasks; ``MERGERS`` rows of fixed size reach the driver."""
    learned = known.mapInArrow(_learned(model, code), "merger bigint, sums binary").groupBy("merger").applyInPandas(_added, "sums binary")
    sums = np.zeros(2 * GATES * (INPUTS + 1 + 2 * CELLS))
    for row in learned.collect():
        sums += np.frombuffer(row["sums"])
    middle, mixers = 1.0 / (1.0 + np.exp(8.0 - np.arange(CELLS) / 2.0)), []
    for own in np.split(sums, 2):
        weights, mass, hits, tries = np.split(own, np.cumsum([GATES * INPUTS, GATES, GATES * CELLS]))
        weights, hits, tries = weights.reshape(GATES, INPUTS), hits.reshape(GATES, CELLS), tries.reshape(GATES, CELLS)
        weights = np.where(mass[:, None] > 0, weights / np.maximum(mass, 1e-9)[:, None], first_weights())
        mixers.append((weights, (hits + 8.0 * middle) / (tries + 8.0)))
    return mixers


def _spelled(model, code, seen: tuple[np.ndarray, np.ndarray], unseen: tuple[np.ndarray, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.value

        def log10_p(words: list[str], mixer: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
            if not words:
                return np.zeros(0)
            word, bit, slots = bits_of(words, code)
            _, gate, mixed = predicted([table[x] for x in slots], mixer[0])
            one = refined(gate, mixed, mixer[1])
            return np.bincount(word, np.log10(np.where(bit == 1, one, 1.0 - one)), len(words))

        for batch in batches:
            scores = []
            for words, counts in _batches(batch):
                found, new = np.zeros(len(words)), counts == 0
                for mask, mixer in ((~new, seen), (new, unseen)):
                    found[mask] = log10_p([words[i] for i in np.flatnonzero(mask)], mixer)
                scores.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                names=["word", "c", "log10_p"])
    return run


def word_scores(words: DataFrame) -> DataFrame:
    """``words(word, c)`` with log10_p, the model's probability of each word, learned from those with c > 0.

    The driver holds the merged tables (``SLOTS`` slots of two bytes), the weights and the refinement: a fixed size.
    """
    spark, known = words.sparkSession, words.where("c > 0")
    counts = known.mapInArrow(_byte_counts, "byte int, n bigint").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    frequencies = [0] * 256
    for row in counts:
        frequencies[row["byte"]] = row["n"]
    code = byte_code(frequencies)
    parts = known.mapInArrow(_tables(code), "chunk bigint, used binary, zeros binary, ones binary")
    merged = parts.groupBy("chunk").applyInPandas(_merged, "chunk bigint, state binary")
    table = np.zeros(-(-SLOTS // CHUNK) * CHUNK, np.uint16)
    for row in merged.collect():  # SLOTS slots of two bytes, whatever the corpus
        table[row["chunk"] * CHUNK:(row["chunk"] + 1) * CHUNK] = np.frombuffer(row["state"], np.uint16)
    model = spark.sparkContext.broadcast(table)
    seen, unseen = _mixers(known, model, code)
    return words.mapInArrow(_spelled(model, code, seen, unseen), "word string, c bigint, log10_p double")


# ---------------------------------------------------------------- words of a text


def word_code(counts: list[int]) -> tuple[np.ndarray, ...]:
    """(lengths, starts, turns, stretched, hashes) of a Huffman code: symbol s takes ``turns[starts[s]:][:lengths[s]]``, each 2 * node + bit.

    ``stretched`` is what the counts alone say of each node, in the logistic domain. Hashes of nodes that follow each other differ
    in the last four bits only, four levels at a time, so their counts stand side by side.
    """
    heap = [(n + 1, s) for s, n in enumerate(counts)]
    heapq.heapify(heap)
    up, sums = {}, []
    while len(heap) > 1:
        (zeros, low), (ones, high) = heapq.heappop(heap), heapq.heappop(heap)
        up[low], up[high] = 2 * len(sums), 2 * len(sums) + 1
        heapq.heappush(heap, (zeros + ones, len(counts) + len(sums)))
        sums.append((zeros, ones))
    lengths, turns = [], []
    for s in range(len(counts)):
        path, at = [], s
        while at in up:
            path.append(up[at])
            at = len(counts) + (up[at] >> 1)
        lengths.append(len(path))
        turns += reversed(path)
    place, level = [(len(sums) - 1, 1)] * len(sums), [0] * len(sums)  # (first node of the four levels, place below it)
    for node in range(len(sums) - 2, -1, -1):
        turn = up[len(counts) + node]
        level[node] = level[turn >> 1] + 1
        head, at = place[turn >> 1]
        place[node] = (head, 2 * at + (turn & 1)) if level[node] % 4 else (node, 1)
    heads, at = np.array(place).T
    with np.errstate(over="ignore"):
        hashes = scramble((heads + 1).astype(np.uint64) * MIX).view(np.int64) & ~15 | at
    lengths, (zeros, ones) = np.array(lengths), np.array(sums, np.float64).T
    return lengths, np.cumsum(lengths) - lengths, np.array(turns), np.clip(np.log(ones / zeros), -8.0, 8.0).astype(np.float32), hashes


def table_bits(n: int) -> tuple[int, int]:
    """log2 of the slots for one and two words before: about one slot for each of the ``n`` training words, and two."""
    return tuple(max(12, min(most, n.bit_length() + k)) for k, most in enumerate(MOST_BITS))


def before(symbols: np.ndarray, offsets: np.ndarray, start: int) -> list[np.ndarray]:
    """Hashes of the word before and of the two words before each place; ``start`` stands before each text."""
    one = np.concatenate([[start], symbols[:-1]])
    one[offsets[:-1]] = start
    two = np.concatenate([[start], one[:-1]])
    two[offsets[:-1]] = start
    with np.errstate(over="ignore"):
        first = scramble((one + 1).astype(np.uint64) * MULTIPLIER)
        return [x.view(np.int64) for x in (first, scramble(first + (two + 1).astype(np.uint64) * MULTIPLIER))]


def turns_of(symbols: np.ndarray, contexts: list[np.ndarray], code: tuple[np.ndarray, ...], bits: tuple[int, ...]):
    """(first turn of each symbol, node and bit of each turn, its slot in the table of each context)."""
    lengths = code[0][symbols]
    first = np.cumsum(lengths) - lengths
    turn = code[2].take(np.arange(first[-1] + lengths[-1]) + np.repeat(code[1][symbols] - first, lengths), mode="clip")
    node = turn >> 1
    hashed = code[4].take(node, mode="clip")
    return first, node, turn & 1, [(np.repeat(c, lengths) ^ hashed) & ((1 << size) - 1) for c, size in zip(contexts, bits, strict=True)]


def first_word_weights() -> np.ndarray:
    return np.tile(np.array([0.3, 0.3, 0.3, 0.0], np.float32), (WORD_GATES, 1))


def mixed_words(inputs: list[np.ndarray], gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The mixture in the logistic domain; the last weight stands alone."""
    total = weights[:, -1].take(gate, mode="clip")
    for k, x in enumerate(inputs):
        total += weights[:, k].take(gate, mode="clip") * x
    return np.clip(total, -11.0, 11.0, out=total)


def _slices(batch: pa.RecordBatch, known: dict[bytes, int]) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray, list[int]]]:
    """Runs of texts with about ``TOKENS_AT_ONCE`` words: the first row, all words, their ids (-1: not known here), where each text's begin, bytes."""
    column, begin, words, ids, ends, n_bytes = batch.column("text").cast(pa.binary()), 0, [], [], [0], []
    for row in range(len(column)):
        text = column[row].as_py()
        own = text.translate(PLAIN).split()
        own.append(END_WORD)
        words += own
        ids += map(known.get, own, repeat(-1))
        ends.append(len(words))
        n_bytes.append(len(text))
        if len(words) >= TOKENS_AT_ONCE or row == len(column) - 1:
            yield begin, words, np.array(ids), np.array(ends), n_bytes
            begin, words, ids, ends, n_bytes = row + 1, [], [], [0], []


def _read(tree, bits: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Training texts, read in order -> pieces of the tables of counts that were touched, and one row with the weights."""
        known, code = tree.value
        escape = len(code[0]) - 2
        tables, weights, mass, step = [np.zeros((1 << b, 2), np.int32) for b in bits], first_word_weights(), np.zeros(WORD_GATES), 0
        for batch in batches:
            for _, _, ids, offsets, _ in _slices(batch, known):
                symbols = np.where(ids < 0, escape, ids)
                contexts = before(symbols, offsets, escape + 1)
                for part in range(0, len(symbols), TOKENS_PER_STEP):
                    cut, step = slice(part, part + TOKENS_PER_STEP), step + 1
                    _, node, bit, slots = turns_of(symbols[cut], [c[cut] for c in contexts], code, bits)
                    inputs, gates = [code[3].take(node, mode="clip")], []
                    for table, slot in zip(tables, slots, strict=True):
                        zeros, ones = table.view(np.int64).ravel().take(slot, mode="clip").view(np.int32).reshape(-1, 2).T.astype(np.float32)
                        both = zeros + ones
                        gates.append((both > 0).view(np.int8) + (both > 2) + (both > 16))
                        inputs.append(np.clip(np.log((ones + np.float32(0.05)) / (zeros + np.float32(0.05))), -8.0, 8.0))
                    gate = (gates[0] * np.int8(4) + gates[1]).astype(np.int64)
                    error = bit.astype(np.float32) - 1.0 / (1.0 + np.exp(-mixed_words(inputs, gate, weights)))
                    here = np.bincount(gate, minlength=WORD_GATES)
                    slope = np.stack([np.bincount(gate, error if x is None else error * x, WORD_GATES) for x in (*inputs, None)], axis=1)
                    weights += (0.3 / math.sqrt(step) * slope / np.maximum(here, 1.0)[:, None]).astype(np.float32)
                    mass += here
                    for table, slot in zip(tables, slots, strict=True):
                        np.add.at(table.reshape(-1), 2 * slot + bit, np.int32(1))
        names = ["piece", "low", "at", "high"]
        for piece, counts in enumerate(part.ravel() for table in tables for part in np.split(table, len(table) // min(PIECE, len(tables[0])))):
            if counts.any():
                at = np.flatnonzero(counts > 255).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([piece]), *(pa.array([x.tobytes()], pa.binary()) for x in (counts.astype(np.uint8), at, counts[at] >> 8))], names=names)
        sums = np.concatenate([(weights * mass[:, None]).ravel(), mass])
        yield pa.RecordBatch.from_arrays([pa.array([-1 - TaskContext.get().partitionId() % MERGERS]), pa.array([sums.tobytes()], pa.binary()),
                                          pa.array([b""], pa.binary()), pa.array([b""], pa.binary())], names=names)
    return run


def _pieces(key, pdf):
    """All parts of one piece -> its packed states; sums of weights are added up."""
    import pandas as pd

    if key[0] < 0:
        return pd.DataFrame({"piece": [key[0]], "state": [np.sum([np.frombuffer(x) for x in pdf["low"]], axis=0).tobytes()]})
    total = np.zeros(len(pdf["low"].iloc[0]))
    for low, at, high in zip(pdf["low"], pdf["at"], pdf["high"], strict=True):
        total += np.frombuffer(low, np.uint8)
        total[np.frombuffer(at, np.int32)] += 256.0 * np.frombuffer(high, np.int32)
    state = packed_counts(total[::2]).astype(np.uint16) << 8 | packed_counts(total[1::2])
    return pd.DataFrame({"piece": [key[0]], "state": [state.tobytes()]})


def learned_words(texts: DataFrame, tree, bits: tuple[int, int]) -> tuple[list[np.ndarray], np.ndarray]:
    """(tables of packed states, weights) from the training ``texts(text)``; the driver gets two bytes a slot, whatever the corpus."""
    parts = texts.mapInArrow(_read(tree, bits), "piece bigint, low binary, at binary, high binary")
    whole, sums = np.zeros(sum(1 << b for b in bits), np.uint16), np.zeros(WORD_GATES * (WORD_INPUTS + 1))
    size = min(PIECE, 1 << bits[0])
    for row in parts.groupBy("piece").applyInPandas(_pieces, "piece bigint, state binary").collect():
        if row["piece"] < 0:
            sums += np.frombuffer(row["state"])
        else:
            whole[row["piece"] * size:(row["piece"] + 1) * size] = np.frombuffer(row["state"], np.uint16)
    weights, mass = sums[:WORD_GATES * WORD_INPUTS].reshape(WORD_GATES, WORD_INPUTS), sums[WORD_GATES * WORD_INPUTS:]
    weights = np.where(mass[:, None] > 0, weights / np.maximum(mass, 1e-9)[:, None], first_word_weights())
    return np.split(whole, [1 << bits[0]]), weights.astype(np.float32)


GATE_OF = CONFIDENCE.astype(np.uint8)


def ln_p(symbols: np.ndarray, offsets: np.ndarray, code: tuple[np.ndarray, ...], tables: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """ln of the mixer's probability of each symbol after those before it in its text."""
    bits = [len(table).bit_length() - 1 for table in tables]
    contexts, out = before(symbols, offsets, len(code[0]) - 1), np.empty(len(symbols))
    for part in range(0, len(symbols), TOKENS_PER_STEP):
        cut = slice(part, part + TOKENS_PER_STEP)
        first, node, bit, slots = turns_of(symbols[cut], [c[cut] for c in contexts], code, bits)
        states = [table.take(slot, mode="clip").astype(np.intp) for table, slot in zip(tables, slots, strict=True)]
        gate = (GATE_OF.take(states[0], mode="clip") * np.uint8(4) + GATE_OF.take(states[1], mode="clip")).astype(np.intp)
        mixed = mixed_words([code[3].take(node, mode="clip"), *(STRETCHED.take(s, mode="clip") for s in states)], gate, weights)
        odds = np.exp(mixed * (1 - 2 * bit).astype(np.float32)).astype(np.float64)  # of the other bit
        out[cut] = -np.log(np.multiply.reduceat(1.0 + odds, first))
    return out


# ---------------------------------------------------------------- texts


URNS = [f"urn_{k}" for k in range(len(STRENGTHS))]
PLACES = "array<struct<place: int, escape: double>>"


def urn_sum(p: float, times: int, strength: float) -> float:
    """ln of the product over i < times of (i + strength p): what ``times`` occurrences of one probability add to a text's score."""
    first = strength * p
    return math.log(first) if times == 1 else math.lgamma(first + times) - math.lgamma(first)


def earlier(keys: np.ndarray) -> np.ndarray:
    """How often each key stands at an earlier place."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    out = np.empty(len(keys), np.int64)
    out[order] = np.arange(len(keys)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    return out


def _summed(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc rows, read in order -> one row with the sums over words that are known here, and one for each other word with its places."""
        known, base_of, p_of, code, tables, weights = model.value
        escape = len(code[0]) - 2
        for batch in batches:
            ids, fps = batch.column("doc_id"), batch.column("fp")
            for begin, words, found, offsets, n_bytes in _slices(batch, known):
                texts, sizes = np.arange(len(n_bytes)), np.diff(offsets)
                of_text = np.repeat(texts, sizes)
                here = found >= 0
                symbols = np.where(here & (found < escape), found, escape)
                p = np.exp(ln_p(symbols, offsets, code, tables, weights)).astype(np.float32).astype(np.float64)
                hits = np.flatnonzero(here)
                own, of_hit = found[hits], of_text[hits]
                k, chance = earlier(of_hit * len(p_of) + own), p[hits] * p_of[own]
                urns = [np.bincount(of_hit, np.log(k + b * chance), len(texts)) - [urn_sum(1.0, n, b) for n in sizes.tolist()] for b in STRENGTHS]
                rest: dict[tuple[int, bytes], list[int]] = {}
                for i in np.flatnonzero(~here).tolist():
                    rest.setdefault((of_text[i], words[i]), []).append(i)
                n = np.array([1] * len(texts) + [len(x) for x in rest.values()])
                places = np.array([i for x in rest.values() for i in x], np.int64)
                prints = fps.slice(begin, len(texts)).to_pylist()
                take = pa.array(begin + np.concatenate([texts, np.array([t for t, _ in rest], np.int64)]))
                listed = pa.StructArray.from_arrays([pa.array((places - offsets[of_text[places]]).astype(np.int32)), pa.array(p[places])], names=["place", "escape"])
                ends = np.concatenate([np.zeros(len(texts) + 1, np.int64), np.cumsum(n[len(texts):])]).astype(np.int32)
                sums = (sizes, np.array(n_bytes), np.bincount(of_hit, minlength=len(texts)), np.bincount(of_hit, base_of[own], len(texts)).astype(np.float64), *urns)
                yield pa.RecordBatch.from_arrays([
                    ids.take(take), fps.take(take), _texts([b"%s%x" % (OWN, x & 0xFFFFFFFFFFFFFFFF) for x in prints] + [w for _, w in rest]),
                    pa.array(n), pa.ListArray.from_arrays(pa.array(ends), listed), *(pa.concat_arrays([pa.array(x), pa.nulls(len(rest), pa.array(x).type)]) for x in sums),
                ], names=["doc_id", "fp", "word", "n", "places", "n_tokens", "n_bytes", "n_known", "base_score", *URNS])
    return run


def frequent(scored: DataFrame, most: int = HOT) -> list[tuple[str, float, float]]:
    """word, base, p of the words whose count has at least so many binary digits that at most ``most`` do."""
    by_digits = {row["digits"]: row["n"] for row in scored.where("c > 0").groupBy(
        F.length(F.bin("c")).alias("digits")).agg(F.count("*").alias("n")).collect()}  # 63 rows at most
    total, least = 0, 64
    for digits in sorted(by_digits, reverse=True):
        total += by_digits[digits]
        if total > most:
            break
        least = digits
    rows = scored.where((F.col("c") > 0) & (F.length(F.bin("c")) >= least)).select("word", "base", "p").toArrow()
    return list(zip(*(rows.column(k).to_pylist() for k in range(3)), strict=True))


def _grown(places, p, strength: float):
    """What the occurrences at ``places`` add to a text's score: ln of the product of (i + strength p escape)."""
    step = lambda i, x: F.log(i + x["escape"] * p * strength)
    return F.when(F.size(places) == 1, step(F.lit(0), places[0])).when(F.size(places) > 1, F.aggregate(
        F.transform(places, lambda x, i: step(i, x)), F.lit(0.0), lambda total, x: total + x))


def score(docs: DataFrame, learns: str, hot: int = HOT) -> DataFrame:
    """doc_id, fp, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte per row of ``docs``.

    ``learns`` names the boolean column that marks training texts.
    """
    spark, text = docs.sparkSession, text_of(F.col("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    words = docs.select(text.alias("text"), F.col(learns).alias("learns")).mapInArrow(_counted, "word string, c bigint") \
        .groupBy("word").agg(F.sum("c").alias("c"))
    words = stored(words, "words")
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v"), F.count_if(F.col("c") == 1).alias("once")).first()
    own = words.where("c > 1").orderBy(F.desc("c"), "word").limit(TREE).collect()  # words with a code of their own
    vocabulary, rare = {row["word"].encode(): s for s, row in enumerate(own)}, total["n"] - sum(row["c"] for row in own)
    code = word_code([*(row["c"] for row in own), rare, 0])
    unseen = (total["once"] + 1) / (rare + 2)  # of the escapes
    tables, weights = learned_words(docs.where(learns).select(text.alias("text")), spark.sparkContext.broadcast((vocabulary, code)), table_bits(total["n"]))
    log_all = math.log10(total["n"] + total["v"] + 1)
    scored = word_scores(words).withColumn("base", F.log10(F.col("c") + 1) - F.lit(log_all))
    least = (own[-1]["c"], own[-1]["word"]) if own else (None, None)
    in_tree = F.coalesce((F.col("c") > least[0]) | ((F.col("c") == least[0]) & (F.col("word") <= least[1])), F.lit(False))
    scored = stored(scored.withColumn("p", F.pow(F.lit(10.0), "log10_p")).withColumn("in_tree", in_tree), "word-scores")
    spelled = scored.where("in_tree").agg(F.coalesce(F.sum("p"), F.lit(0.0)).alias("p")).first()["p"]
    scored = scored.where("not in_tree").withColumn("p", F.col("p") * ((1 - unseen) / max(1.0 - spelled, 1e-9)))
    more = frequent(scored, hot)
    known = vocabulary | {word.encode(): len(own) + 2 + k for k, (word, _, _) in enumerate(more)}
    own_base = [math.log10(row["c"] + 1) - log_all for row in own]
    base_of = np.array([*own_base, 0.0, 0.0, *(base for _, base, _ in more)])
    p_of = np.array([1.0] * (len(own) + 2) + [p for _, _, p in more])
    parts = docs.select("doc_id", F.xxhash64(text).alias("fp"), text.alias("text")).mapInArrow(
        _summed(spark.sparkContext.broadcast((known, base_of, p_of, code, tables, weights))), f"doc_id {kind}, fp bigint, word string, n bigint, places {PLACES}, "
        "n_tokens bigint, n_bytes bigint, n_known bigint, base_score double, " + ", ".join(f"{u} double" for u in URNS))
    values = scored.select(F.col("word").alias("scored_word"), "c", "base", "p", "log10_p")
    rows = parts.join(values, F.col("word") == F.col("scored_word"), "left")
    own, known = F.col("word").startswith(OWN.decode()), F.col("c") > 0
    either = lambda mine, each: F.sum(F.when(own, F.col(mine)).otherwise(each)).alias(mine)
    sums = rows.groupBy("doc_id", "fp").agg(
        F.count_if(own).alias("times"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_bytes").alias("n_bytes"),
        either("n_known", F.when(known, F.col("n")).otherwise(0)), either("base_score", F.col("n") * F.coalesce("base", F.lit(-log_all))),
        *[either(u, F.when(known, _grown(F.col("places"), F.col("p"), b)).otherwise(0.0)) for u, b in zip(URNS, STRENGTHS, strict=True)],
        F.sort_array(F.flatten(F.collect_list(F.when(~own & ~known, F.col("places"))))).alias("new"),
        F.sum(F.when(~own & ~known, F.col("n") * F.col("log10_p")).otherwise(0.0)).alias("spelled"))
    whole = ("n_tokens", "n_known", "n_bytes")
    # A repeated row repeats each place of an unseen word.
    new = lambda b: F.aggregate(F.transform("new", lambda x, i: F.log(F.floor(i / F.col("times")) + x["escape"] * (unseen * b))), F.lit(0.0), lambda sum_, x: sum_ + x)
    each = sums.withColumns({u: F.col(u) + new(b) for u, b in zip(URNS, STRENGTHS, strict=True)})
    each = each.withColumns({c: F.col(c) / F.col("times") for c in (*whole, "base_score", "spelled", *URNS)}).withColumns({c: F.col(c).cast("long") for c in whole})
    top = F.greatest(*URNS)
    mean = top + F.log(sum((F.exp(F.col(u) - top) for u in URNS), F.lit(0.0)) / len(URNS))
    each = each.withColumn("score", mean / math.log(10.0))
    again = F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))).alias("row")
    bits = -(F.col("score") + F.col("spelled")) / math.log10(2.0)
    return each.select(
        "doc_id", "fp", *whole, F.lit(total["n"]).cast("long").alias("train_tokens"), "base_score", "score",
        F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")).alias("bits_per_byte"), again).drop("row")
