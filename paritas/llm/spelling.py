"""Spelling variants by finite-state composition.

The vocabulary is an acceptor, minimised by sharing equal right languages. It is composed with a transducer of
exactly one edit (a code point inserted, deleted or replaced) and with the acceptor again; what the composition
accepts are the pairs of near words. Before the edit both tapes are in the same state, so the composition's states
are an acceptor state before the edit and a pair of them behind it; each is expanded once, whatever the number of
paths through it.

The composition is cut by initial state: a partition holds the words that share their first ``HEAD`` code points and
starts in the state these lead to, which finds the pairs whose edit lies behind them. Pairs with an earlier edit share their last
``HEAD`` code points, as words have at least ``2 * HEAD``, and are found likewise over the reversed words. A partition
of more than ``BLOCK`` words is composed block by block, so a head that holds a third of the vocabulary is no task of its own.
A partition gives sums and a best form for each word, not its pairs.

Defined results: words of fewer than ``2 * HEAD`` code points and null words are no part of the vocabulary; repeated
words count together; ties of frequency go to the first in code-point order; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import stored, text_of

HEAD, BLOCK = 3, 20_000
#: A form is so many times as frequent as its variant.
TIMES = 5
RUNS = r"[A-Za-zÀ-ÿ]+"
#: A frequency grows by TIMES with every form, so a chain of forms within 64 bits has fewer than 2^5 steps.
DOUBLINGS = 5


def low_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(text.rlike("[A-Z]"), F.translate(text, upper, lower)).otherwise(text)


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, run: every run of letters of every text, lower-cased."""
    found = docs.select("doc_id", F.explode(F.regexp_extract_all(text_of(F.col("text")), F.lit(RUNS), F.lit(0))).alias("run"))
    return found.select("doc_id", low_ascii(F.col("run")).alias("run"))


class Acceptor:
    """The minimal deterministic acceptor of some words: ``arcs[state]`` leads on by code point, ``final`` says which accept."""

    def __init__(self, words: list[str]) -> None:
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        path, spelt = [(False, {})], ""
        for word in sorted(set(words)):
            same = 0
            while same < min(len(word), len(spelt)) and word[same] == spelt[same]:
                same += 1
            self._close(path, spelt, same)
            path += [(False, {}) for _ in word[same:]]
            path[-1] = (True, path[-1][1])
            spelt = word
        self._close(path, spelt, 0)
        self.start = self._state(path[0])

    def _close(self, path: list, spelt: str, keep: int) -> None:
        """States of the path beyond ``keep`` code points get no further arcs: share or add them."""
        for at in range(len(spelt), keep, -1):
            path[at - 1][1][spelt[at - 1]] = self._state(path.pop())

    def _state(self, made: tuple[bool, dict[str, int]]) -> int:
        final, arcs = made
        key = (final, tuple(arcs.items()))
        if key not in self._known:
            self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return self._known[key]


class OneEdit:
    """The composition of an acceptor, the transducer of one edit, and the acceptor."""

    def __init__(self, acceptor: Acceptor) -> None:
        self.a, self._both, self._here, self._live = acceptor, {}, {}, {}

    def both(self, s: int, t: int) -> tuple[str, ...]:
        """Behind the edit: what is accepted from ``s`` and from ``t``."""
        key = (s, t) if s < t else (t, s)
        if key not in self._both:
            left, right = self.a.arcs[s], self.a.arcs[t]
            out = [""] if self.a.final[s] and self.a.final[t] else []
            for c in left if len(left) < len(right) else right:
                if c in left and c in right:
                    out += [c + rest for rest in self.both(left[c], right[c])]
            self._both[key] = tuple(out)
        return self._both[key]

    def here(self, s: int) -> list[tuple[str, str]]:
        """Pairs of continuations of ``s`` that differ by one edit of the next code point.

        A code point inserted into a run of its kind is taken as the run's last, so each pair is found once.
        """
        if s not in self._here:
            arcs, out = list(self.a.arcs[s].items()), []
            for k, (c, after) in enumerate(arcs):
                out += [(c + rest, rest) for rest in self.both(after, s) if rest[:1] != c]
                for d, other in arcs[:k]:
                    out += [(c + rest, d + rest) for rest in self.both(after, other)]
            self._here[s] = out
        return self._here[s]

    def live(self, s: int) -> bool:
        """Is an edit possible in ``s`` or behind it?"""
        if s not in self._live:
            self._live[s] = bool(self.here(s)) or any([self.live(t) for t in self.a.arcs[s].values()])
        return self._live[s]

    def pairs(self):
        """All accepted pairs, each once."""
        stack = [(self.a.start, "")]
        while stack:
            s, head = stack.pop()
            for left, right in self.here(s):
                yield head + left, head + right
            stack += [(t, head + c) for c, t in self.a.arcs[s].items() if self.live(t)]


def near_pairs(words: list[str]):
    """Pairs of ``words`` that differ by exactly one edit."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 10_000, 8 * max(map(len, words), default=0)))
    return OneEdit(Acceptor(words)).pairs()


FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _composed(cell: pa.Table) -> pa.Table:
    """A partition (or two blocks of one): for each word with near words their number and the most frequent one."""
    if cell.num_rows < 2:
        return FOUND.empty_table()
    tails, sizes, blocks = cell["tail"].to_pylist(), cell["n"].to_pylist(), cell["block"].to_pylist()
    head, backward, across = cell["head"][0].as_py(), cell["backward"][0].as_py(), cell["i"][0] != cell["j"][0]
    n, block = dict(zip(tails, sizes)), dict(zip(tails, blocks))
    written = (lambda tail: (head + tail)[::-1]) if backward else (lambda tail: head + tail)
    near, best = defaultdict(int), {}
    for u, v in near_pairs(tails):
        if across and block[u] == block[v]:
            continue
        a, b = written(u), written(v)
        if backward and a[:HEAD] == b[:HEAD]:
            continue  # found forward
        for mine, other, size in ((a, b, n[v]), (b, a, n[u])):
            near[mine] += 1
            if mine not in best or (-size, other) < best[mine]:
                best[mine] = (-size, other)
    return pa.table([list(near), list(near.values()), [-best[w][0] for w in near], [best[w][1] for w in near]], schema=FOUND)


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best_n, best for the words of ``words(word, n)``, each once, that have near words."""
    ways = F.array(F.struct(F.lit(False).alias("backward"), F.col("word").alias("spelt")),
                   F.struct(F.lit(True).alias("backward"), F.reverse("word").alias("spelt")))
    rows = words.select("n", F.inline(ways)).select(
        "backward", F.substring("spelt", 1, HEAD).alias("head"), F.expr(f"substring(spelt, {HEAD + 1})").alias("tail"), "n")
    key = ["backward", "head"]
    blocks = rows.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("members")).where("members > 1")
    rows = rows.join(blocks.drop("members"), key).withColumn("block", F.pmod(F.xxhash64("tail"), F.col("blocks")).cast("int"))
    cell = lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j"))
    rows = rows.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), cell))).select(
        *key, "cell.i", "cell.j", "block", "tail", "n")
    found = rows.groupBy(*key, "i", "j").applyInArrow(_composed, "word string, n_near bigint, best_n bigint, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("order"), F.col("best"))).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select("word", "n_near", (-F.col("first.order")).alias("best_n"), "first.best")


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, n, n_near, form, form_n, root for ``words(word, n)``.

    The form is the most frequent near word if it is ``times`` as frequent; the root is where the forms lead.
    """
    if times < 4:
        raise ValueError("with times below 4 a chain of forms may be longer than is followed")
    vocabulary = words.where(F.length("word") >= 2 * HEAD).groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = stored(vocabulary, "vocabulary")
    is_form = F.col("best_n") >= times * F.col("n")
    rows = vocabulary.join(near_words(vocabulary), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    rows = stored(rows, "variants")
    roots = rows.where("form IS NOT NULL").select(F.col("word").alias("of"), F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        on = roots.select(F.col("of").alias("step"), F.col("root").alias("beyond"))
        roots = stored(roots.join(on, F.col("root") == F.col("step"), "left").select("of", F.coalesce("beyond", "root").alias("root")), "roots")
    return rows.join(roots, F.col("word") == F.col("of"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
