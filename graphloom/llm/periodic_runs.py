"""Periodic run detection: every stretch of words that repeats with some period, at least three times, and what is left without it.

A run with period q is a stretch in which words q apart are identical, that neither neighbour extends, whose smallest period is
q, of at least ``max(LEAST, 3 * q)`` words. ``SquareCatcher`` finds them online, by dyadic catching: words are appended, and
each block of 2^k words that is complete becomes the catcher of its level. As words come, the suffix of 2^k words that ends
with each of them is compared with the one catcher that lies 2^k to 2^(k+1) - 1 words before it; equal ones show a square,
or part of one, of that period. Caught squares of one period that follow each other merge, are carried on by comparing
words at both ends, and are runs if they are long enough. Every run is caught: its first ``length - q`` words are all
found again q later, and they hold a whole block of the level of q (of 8 words for q below 16). Stretches that reach the last word
are carried on when more are appended.

Blocks are compared by 64-bit values made from the values of their halves, then word by word, so results are exact. The work is
some machine operations for each word and level, whatever repeats. Documents of a batch are one stream of words, divided by words of their own that
nothing equals; each of them lies whole in it, and a document larger than a batch is a batch.

Null and empty texts have no words and no runs. Repeated rows give repeated results, ties of exponents go to the smallest
start, then period; other columns pass by; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from graphloom.llm.shared import text_batches
from graphloom.llm.words import mix, texts_of

#: The fewest words of a run, and the level of the smallest catchers (8 words).
LEAST, LOW = 24, 3
_ODD = np.uint64(0x9E3779B97F4A7C15)


class SquareCatcher:
    """Online detection of runs: ``append`` words (as numbers) as often as needed, and read ``runs`` at any time.

    ``longest`` bounds the words of one document, so periods over a third of it are not looked for.
    """

    def __init__(self, longest: int | None = None):
        self.words, self.longest = np.zeros(0, np.int64), longest
        self.compared: dict[int, int] = {}  # by level: the suffixes that begin before this place have met their catchers
        self.stretches: dict[int, list[list[int]]] = {}  # by period q: [begin, end) of words that equal those q later
        self.growing: set[int] = set()  # periods whose last stretch reaches the last word

    def append(self, words: np.ndarray) -> None:
        self.words = np.concatenate([self.words, np.asarray(words, np.int64)])
        n = self.words.size
        for q in sorted(self.growing):
            self._carry_on(q)
        most = n if self.longest is None else self.longest // 3  # a square of any size can still become a run
        levels = [k for k in range(LOW, n.bit_length()) if (1 << k) <= max(most, 1 << LOW)]
        if not levels or n < 1 << LOW:
            return
        # From here on all blocks are needed that the new suffixes of any level meet.
        low = min(max(0, ((self.compared.get(k, 0) >> k) - 1) << k) for k in levels) >> levels[-1] << levels[-1]
        value = mix(self.words[low:].astype(np.uint64) + _ODD)
        for k in range(levels[-1] + 1):
            if k in levels:
                self._catch(k, value, low, most)
            if value.size <= 1 << k:
                break
            value = mix(value[: -(1 << k)] * _ODD + value[1 << k :])  # a block's value from those of its halves

    def _catch(self, level: int, value: np.ndarray, low: int, most: int) -> None:
        """Compares the block at each new place with the catcher before it."""
        size, done = 1 << level, self.compared.get(level, 0)
        self.compared[level] = low + value.size
        catcher = np.repeat(value[::size], size)
        pairs = [np.stack([at // size * size, at + size]) for at in [np.flatnonzero(catcher[: max(value.size - size, 0)] == value[size:])]]
        if level == LOW:  # the lowest ones also catch the periods below their size
            at = np.flatnonzero(catcher[: value.size] == value)
            pairs.append(np.stack([at // size * size, at])[:, at % size > 0])
        block, at = np.concatenate(pairs, axis=1) + low
        ok = (at >= done) & (at - block <= most)
        block, period = self._beside_known(block[ok], (at - block)[ok], size)
        order = np.lexsort((block, period))
        block, period = block[order], period[order]
        # Blocks of one period that follow each other are one stretch.
        first = np.flatnonzero((np.diff(period, prepend=-1) != 0) | (np.diff(block, prepend=-1) != size))
        last = np.append(first[1:], block.size) - 1
        for q, b, e in zip(period[first].tolist(), block[first].tolist(), (block[last] + size if first.size else last).tolist(), strict=False):
            self._merge(q, b, e)

    def _beside_known(self, block: np.ndarray, period: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Without pairs inside a known run whose period divides theirs: their stretch is the same one."""
        if self.stretches and block.size and len(known := self.runs()):
            begin, length, q = known.T
            at = np.maximum(np.searchsorted(begin, block, "right") - 1, 0)
            beside = (begin[at] > block) | (begin[at] + length[at] < block + period + size) | (period % q[at] != 0) | (period == q[at])
            block, period = block[beside], period[beside]
        return block, period

    def _merge(self, q: int, begin: int, end: int) -> None:
        """Takes up the stretch around a caught one, unless it is the last one's."""
        if not (self.words[begin:end] == self.words[begin + q : end + q]).all():
            for a in range(begin, end, 1 << LOW):  # values that are equal by chance: the words decide, block by block
                b = min(a + (1 << LOW), end)
                if end - begin > 1 << LOW and (self.words[a:b] == self.words[a + q : b + q]).all():
                    self._merge(q, a, b)
            return
        mine = self.stretches.setdefault(q, [])
        if mine and begin < mine[-1][1]:
            return
        mine.append([self._left(q, begin), end])
        self._carry_on(q)
        if not mine:
            del self.stretches[q]

    def _carry_on(self, q: int) -> None:
        """Advances the last stretch of period q to its first different word; it goes if it is no run."""
        mine = self.stretches[q]
        mine[-1][1] = self._right(q, mine[-1][1])
        self.growing.discard(q)
        if mine[-1][1] == self.words.size - q:
            self.growing.add(q)
        elif mine[-1][1] - mine[-1][0] + q < max(LEAST, 3 * q):
            mine.pop()

    def _left(self, q: int, x: int) -> int:
        w, step = self.words, 32
        while x > 0:
            a = max(0, x - step)
            differ = np.flatnonzero(w[a:x] != w[a + q : x + q])
            if differ.size:
                return a + int(differ[-1]) + 1
            x, step = a, step * 2
        return x

    def _right(self, q: int, x: int) -> int:
        w, step = self.words, 32
        n = w.size - q
        while x < n:
            b = min(n, x + step)
            differ = np.flatnonzero(w[x:b] != w[x + q : b + q])
            if differ.size:
                return x + int(differ[0])
            x, step = b, step * 2
        return x

    def runs(self) -> np.ndarray:
        """(start, length, period) of the runs in the words so far, by start, then period."""
        found: dict[tuple[int, int], int] = {}
        for q in sorted(self.stretches):
            for begin, end in self.stretches[q]:
                if end - begin + q >= max(LEAST, 3 * q):
                    found.setdefault((begin, end + q), q)  # a stretch also has the multiples of its smallest period
        return np.array(sorted((b, e - b, q) for (b, e), q in found.items()), np.int64).reshape(-1, 3)


def runs_of(documents: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each list of words, all found in one stream."""
    sizes = np.array([len(x) for x in documents], np.int64)
    code = {w: i for i, w in enumerate(set().union(*documents))}
    stream = np.full(int(sizes.sum()) + len(documents), -1, np.int64)
    ends = np.cumsum(sizes + 1)
    stream[ends - 1] = -np.arange(1, len(documents) + 1)  # equal to nothing
    for words, end, size in zip(documents, ends.tolist(), sizes.tolist(), strict=True):
        stream[end - 1 - size : end - 1] = np.fromiter(map(code.__getitem__, words), np.int64, size)
    catcher = SquareCatcher(int(sizes.max()) if len(documents) else 0)
    catcher.append(stream)
    runs = catcher.runs()
    own = np.searchsorted(ends, runs[:, 0], "right")
    runs[:, 0] -= (ends - sizes - 1)[own]
    cut = np.searchsorted(own, np.arange(len(documents) + 1))
    return [runs[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """``words`` without those that any run repeats: all after its first period."""
    if not len(runs):
        return words
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


RUNS = ArrayType(StructType([StructField("start", LongType()), StructField("length", LongType()), StructField("period", LongType())]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(id, n_words, runs by start and period, collapsed text) of every row; words are runs of bytes outside 0x20 and 0x09-0x0D, and
    ``prepare`` may change a document's words first."""
    text_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            documents = [x.encode().split() for x in texts_of(batch.column(1)).to_pylist()]
            if prepare:
                documents = [prepare(i, x) for i, x in zip(ids.to_pylist(), documents, strict=True)]
            runs = runs_of(documents)
            every = np.concatenate([np.zeros((0, 3), np.int64), *runs])
            offsets = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
            listed = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(every[:, k]) for k in range(3)], ["start", "length", "period"])).cast(kind)
            texts = [b" ".join(collapse(x, r)).decode() for x, r in zip(documents, runs, strict=True)]
            yield pa.RecordBatch.from_arrays([ids, pa.array([len(x) for x in documents], pa.int64()), listed, pa.array(texts, pa.string())], ["id", "n_words", "runs", "collapsed"])

    schema = StructType([StructField("id", LongType()), StructField("n_words", LongType()), StructField("runs", RUNS), StructField("collapsed", StringType())])
    found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    return found.withColumnRenamed("id", id_col)
