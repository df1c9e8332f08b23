"""Scores of whole texts under a smoothed trigram model held in Elias-Fano tries.

A text is its words and one end; two ends stand before the first word. With c for training counts, ``p(w | u v)`` is

    p1(w)       = (c(w) + 0.1) / (N + 0.1 * (V + 1))
    p2(w | v)   = (c(v w) - d) / c(v) + g(v) * p1(w)
    p3(w | u v) = (c(u v w) - d) / c(u v) + g(u v) * p2(w | v)

with the discount d of ``DISCOUNTS`` for a count of 1, 2 or more (0 for none), and g the mass that the discounts of a context
leave over. After a context that training never saw, the shorter one decides. Each sums to 1 over the V words and one
unknown word.

The levels are files in the shared folder, and tasks map them into memory:

* words: sorted 64-bit hashes and, as a second monotone sequence, their counts added up. A word's id is its place.
* triples: the contexts v in order; monotone pointers to where each one's successors begin; the successors w of each v; for
  each the quantised ``(c - d) / c(v)``, and for each v the quantised g. Under each v its left words u, which make the contexts
  u v; monotone pointers to where each one's successors begin; the successors, not by word id but by place among the successors
  of the shorter context v, so that few bits are left; the quantised ``(c - d) / c(u v)`` and g.
* pairs: contexts v, their successors, probabilities and g as above, but only of those v whose triples lie in several shards.

A search finds v and w's place among its successors, which gives p2, then u among the left words of v, and then that place among
the successors of u v.
Probabilities are rounded down to steps of 1/4096 of a power of ten. Those of pairs take 16 bits; those of triples 8 bits, as
places in a table of the shard's values: exact up to 256 of them, else rounded down to 256 classes of equally many.

Shards of pairs and triples are cut by tokens: contexts stand in order of v, each as wide as its count. A frequent v is split by
w in the pairs. In the triples it is split by u, each u as wide as its count lets expect, and a frequent u v by w in the same
way (before the first word, u is always the end, so w alone splits). So a word with a third of all tokens lies in a third of the
shards, and so does the start of all texts. A context that stands on a shard's border has its counts in several; their sums are
gathered, two contexts a shard at most. A context u v more frequent than its words let expect has that many times a shard's rows
at most, and they are summed in each task first. Pairs follow from the triples, once these are summed: in place for a v whose
triples are all in one shard, else they are sent on as pairs. Words are told apart by 64 bits of hash.

Null texts are empty and hold the end alone. Without training rows every count is 0. Rows with null ids are scored like
others; repeated rows count as often as they occur; further columns are not read, and kept columns with a result's name give way.
Long texts are scored whole, in steps of bounded tokens. No rows to score give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.elias_fano import EliasFano, encode
from graphloom.llm.shared import kept_files, make_dirs, map_file, put_file, shared_dir, text_batches
from graphloom.llm.words import hashed_steps, texts_of

#: Bytes of training text for each shard, and tokens taken at once.
SHARD_BYTES, STEP_TOKENS = 12 << 20, 1 << 20
RUN_BYTES = 32 << 20  # of the rows that these tokens come from
SEARCHED = 1 << 18  # triples searched for at once; as they are sorted, few shards are asked twice
END = np.uint64(0x9FB21C651E98DF25)
ADD, STEPS = 0.1, 4096  # STEPS: quantisation steps of a probability in a power of ten
#: Taken off counts of 1, 2 and more.
DISCOUNTS = (0.9, 1.1, 1.4)
PAIRS, TRIPLES = 2, 3
_POWERS = 10.0 ** (np.arange(1 << 16) / -STEPS)
ELSEWHERE = -2  # a pair's place among the successors of v, where each shard of triples has its own
_BORDER = pa.struct([("key", pa.int64()), ("tokens", pa.int64()), ("taken", pa.float64())])


def discount(n: np.ndarray) -> np.ndarray:
    return np.array([0.0, *DISCOUNTS])[np.minimum(n, 3)]


def _code(p: np.ndarray) -> bytes:
    return np.minimum(np.ceil(-np.log10(np.maximum(p, 1e-300)) * STEPS), 65535).astype("<u2").tobytes()


def _short_code(p: np.ndarray) -> bytes:
    """Codes of one byte and a table of theirs: exact for up to 256 values, else rounded down to 256 classes of equal size."""
    code = np.frombuffer(_code(p), "<u2")
    count = np.bincount(code, minlength=1)
    values = np.flatnonzero(count)
    kind = np.arange(values.size) if values.size <= 256 else (np.cumsum(count[values]) - 1) * 256 // code.size
    table = np.zeros(256, "<u2")
    np.maximum.at(table, kind, values)  # the largest code of a class: the least probability
    short = np.zeros(count.size, np.uint8)
    short[values] = kind
    return _pack(table.tobytes(), short[code].tobytes())


def _pack(*parts: bytes) -> bytes:
    """Byte strings in one, each at a multiple of 8."""
    padded = [x + bytes(-len(x) % 8) for x in parts]
    return np.array([len(parts), *map(len, padded)], "<i8").tobytes() + b"".join(padded)


def _unpack(data: np.ndarray) -> list[np.ndarray]:
    n = int(data[:8].view("<i8")[0])
    ends = 8 + 8 * n + np.cumsum(data[8 : 8 + 8 * n].view("<i8"))
    return [data[a:z] for a, z in zip([8 + 8 * n, *ends.tolist()], ends.tolist(), strict=False)]


def _pack_counts(n: np.ndarray) -> bytes:
    """Counts of one byte each, with the larger ones apart."""
    large = np.flatnonzero(n > 254)
    return _pack(np.array([n.size], "<i8").tobytes(), np.where(n > 254, 255, n).astype(np.uint8).tobytes(), n[large].astype("<i8").tobytes())


def _counts(data: np.ndarray) -> np.ndarray:
    size, small, large = _unpack(data)
    out = small[: int(size.view("<i8")[0])].astype(np.int64)
    out[out == 255] = large.view("<i8")
    return out


def _summed(order: np.ndarray, columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of ``columns``, which ``order`` sorts, with their summed counts."""
    columns, n = [c[order] for c in columns], n[order]
    new = np.ones(n.size, bool)
    if n.size:
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.add.reduceat(n, first) if first.size else n


def _tokens(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes with an end after each row's, bounds of each row's)."""
    for row, _, words, bounds in hashed_steps(column):
        n = bounds.size - 1
        ends = bounds[1:] + np.arange(n)
        out = np.empty(words.size + n, np.uint64)
        is_end = np.zeros(out.size, bool)
        is_end[ends] = True
        out[is_end], out[~is_end] = END, words
        yield row, out, np.concatenate([[0], ends + 1])


def _row_runs(pieces: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Pieces (their rows or None, tokens, bounds of each row's) gathered to runs of whole rows of ``STEP_TOKENS`` tokens and
    ``RUN_BYTES`` at most; a longer row is a run of its own. What is equal in a run is searched for once."""
    held, room, space = [], STEP_TOKENS, RUN_BYTES
    for rows, tokens, bounds in pieces:
        row = 0
        while row < bounds.size - 1:
            end = max(int(np.searchsorted(bounds, bounds[row] + room, "right")) - 1, row + 1)
            some, size = rows and rows.slice(row, end - row), int(bounds[end] - bounds[row])
            if held and (size > room or some and some.nbytes > space):
                yield held
                held, room, space = [], STEP_TOKENS, RUN_BYTES
                continue
            held.append((some, tokens[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]))
            room, space, row = room - size, space - (some.nbytes if some else 0), end
    if held:
        yield held


def _contexts(tokens: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct hashes, and the places of u, v and w of each token among them, for runs of whole rows' tokens."""
    before = np.concatenate([[END, END], tokens])
    for a in range(0, tokens.size, STEP_TOKENS):
        distinct, place = np.unique(np.concatenate([[END], before[a : a + STEP_TOKENS + 2]]), return_inverse=True)
        end, v = place[0], place[2:-1]
        yield distinct, np.where(v == end, end, place[1:-2]), v, place[3:]


class Vocabulary:
    """Ids, counts and counts added up of words; id V is the unknown word with count 0."""

    def __init__(self, folder: str, bits: int, sizes: list[tuple[int, int, int]]):
        self.folder, self.bits = folder, bits
        n, mass = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for shard, words, tokens in sizes:
            n[shard], mass[shard] = words, tokens
        self.first, self.before = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(mass)])
        self.size, self.tokens = int(self.first[-1]), int(self.before[-1])
        self.width = np.uint64(self.size + 1)

    def lookup(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, counts and the counts of all words before, of sorted words."""
        ids, counts, before = np.full(words.size, self.size, np.int64), np.zeros(words.size, np.int64), np.zeros(words.size, np.int64)
        shard = (words >> np.uint64(64 - self.bits)).astype(np.int64)
        for s in np.unique(shard).tolist():
            if self.first[s + 1] > self.first[s]:
                at = np.flatnonzero(shard == s)
                keys, sums = _words(f"{self.folder}/words-{s}")
                found = keys.find(words[at])
                at, found = at[found >= 0], found[found >= 0]
                low = sums.at(found).astype(np.int64)
                ids[at], before[at] = self.first[s] + found, self.before[s] + low
                counts[at] = sums.at(found + 1).astype(np.int64) - low
        return ids, counts, before

    def counts(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of sorted known ids, and the counts of all words before."""
        counts, before = np.zeros(ids.size, np.int64), np.zeros(ids.size, np.int64)
        cuts = np.searchsorted(ids, self.first)
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            sums, at = _words(f"{self.folder}/words-{s}")[1], ids[cuts[s] : cuts[s + 1]] - self.first[s]
            low = sums.at(at).astype(np.int64)
            before[cuts[s] : cuts[s + 1]] = self.before[s] + low
            counts[cuts[s] : cuts[s + 1]] = sums.at(at + 1).astype(np.int64) - low
        return counts, before

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADD) / (self.tokens + ADD * (self.size + 1))

    def shard(self, counts: np.ndarray, before: np.ndarray, other: np.ndarray, shards: int) -> np.ndarray:
        """Shard of a context word with these counts, and of the other word's id."""
        place = before + counts * (other / float(self.size + 1))
        return np.minimum((place * (shards / max(1, self.tokens))).astype(np.int64), shards - 1)

    def reach(self, counts: np.ndarray, before: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last shard that ``triple_shard`` can give for context words v with these counts."""
        every = max(1, self.tokens)
        return tuple(np.minimum((x * (shards / every)).astype(np.int64), shards - 1) for x in (before, before + counts))

    def triple_shard(self, v: tuple[np.ndarray, np.ndarray], u: tuple[np.ndarray, np.ndarray], w: np.ndarray, starts: np.ndarray, shards: int) -> np.ndarray:
        """Shard of triples: (counts, counts of all words before) of v and of u, and the latter of w. It never falls as (v, u, w)
        grow, as no step of the reckoning does. ``starts``: where v is the end, so u is too."""
        every = max(1, self.tokens)
        share = w / every
        inner = np.where(starts, share, (u[1] + u[0] * share) / every)
        return np.minimum(((v[1] + v[0] * inner) * (shards / every)).astype(np.int64), shards - 1)


def _file(name: str) -> list[np.ndarray]:
    return _unpack(np.frombuffer(map_file(name), np.uint8))


@kept_files
def _words(name: str) -> tuple[EliasFano, EliasFano]:
    keys, sums = _file(name)
    return EliasFano(keys), EliasFano(sums)


@kept_files
def _pairs(name: str):
    """(contexts, successors, probabilities, weights) of a shard of pairs."""
    v, w, p, g = _file(name)
    return EliasFano(v), EliasFano(w), p.view("<u2"), g.view("<u2")


@kept_files
def _triples(name: str):
    """(contexts v, successors of v, their probabilities, weights) and (pointers, contexts u v, pointers, successors of u v, their
    probabilities, weights)."""
    *levels, p, g, pair_p, pair_g = _file(name)
    contexts, pointers, successors, *more = map(EliasFano, levels)
    codes = ((_POWERS[table.view("<u2")], short) for table, short in map(_unpack, (p, g)))
    return (contexts, successors, pair_p.view("<u2"), pair_g.view("<u2")), (pointers, *more, *(lambda at, t=table, s=short: t[s[at]] for table, short in codes))


def _vocabulary(texts: DataFrame, folder: str, bits: int) -> Vocabulary:
    def count(batches):
        for b in batches:
            for _, tokens, _ in _tokens(texts_of(b.column(0))):
                words, n = np.unique(tokens, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

    def write(group):
        words, n = group.column("word").to_numpy().view(np.uint64), group.column("n").to_numpy()
        order = np.argsort(words)
        sums = np.concatenate([[0], np.cumsum(n[order])])
        shard = group.column("shard")[0].as_py()
        put_file(folder, f"words-{shard}", [_pack(encode(words[order], 1 << 64), encode(sums, int(sums[-1]) + 1))])
        return pa.table({"shard": pa.array([shard], pa.int32()), "words": [words.size], "tokens": [int(sums[-1])]})

    counted = texts.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    placed = counted.select("word", "n", F.shiftrightunsigned("word", 64 - bits).cast("int").alias("shard"))
    rows = placed.groupBy("shard").applyInArrow(write, "shard int, words long, tokens long").collect()  # a row a shard
    return Vocabulary(folder, bits, [tuple(r) for r in rows])


def _narrow(x: np.ndarray, width: int) -> bytes:
    """Numbers in ``width`` bytes each."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _wide(data: np.ndarray, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = data[: n * width].reshape(n, width)
    return out.reshape(-1).view("<i8")


def _blocks(shard: np.ndarray, keys: np.ndarray, last: np.ndarray | None, n: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """A block for each shard of sorted keys (and, under equal keys, last words) with counts."""
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [shard.size]]).tolist() if shard.size else []
    for a, z in zip(cuts, cuts[1:], strict=False):
        some = keys[a:z]
        parts = [_pack_counts(n[a:z]), some[:1].astype("<u8").tobytes()]
        if last is not None:
            first, width = _runs(some), max(1, (int(last[a:z].max()).bit_length() + 7) // 8)
            parts += [np.array([width], "<i8").tobytes(), _narrow(last[a:z], width), _pack_counts(np.diff(np.append(first, z - a)))]
            some = some[first]
        yield int(shard[a]), _pack(*parts, encode(some - some[0], int(some[-1] - some[0]) + 1))


def _read_block(block: bytes) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """(keys, last words, counts)."""
    parts = _unpack(np.frombuffer(block, np.uint8))
    n, keys = _counts(parts[0]), EliasFano(parts[-1]).values() + parts[1].view("<u8")[0]
    if len(parts) == 3:
        return keys, None, n
    return np.repeat(keys, _counts(parts[4])), _wide(parts[3], n.size, int(parts[2].view("<i8")[0])), n


def _block_rows(blocks: list[tuple[int, bytes | None]]) -> list[pa.Array]:
    return [pa.array([s for s, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())]


def _triple_blocks(texts: DataFrame, vocabulary, shards: int) -> DataFrame:
    """(shard, block) of the triples of each run of tokens."""

    def blocks(words: Vocabulary, tokens: np.ndarray):
        for distinct, u, v, w in _contexts(tokens):
            ids, counts, before = words.lookup(distinct)
            code, mask = np.int64(21), np.int64((1 << 21) - 1)
            key, n = np.unique((v << code | u) << code | w, return_counts=True)
            last, left, context = key & mask, (key >> code) & mask, key >> (2 * code)
            starts = context == np.searchsorted(distinct, END)
            shard = words.triple_shard((counts[context], before[context]), (counts[left], before[left]), before[last], starts, shards)
            found = list(_blocks(shard, ids[context].astype(np.uint64) * words.width + ids[left].astype(np.uint64), ids[last], n))
            yield pa.RecordBatch.from_arrays(_block_rows(found), ["shard", "block"])

    def run(batches):
        pieces = ((None, tokens, bounds) for b in batches for _, tokens, bounds in _tokens(texts_of(b.column(0))))
        for held in _row_runs(pieces):
            yield from blocks(vocabulary.value, np.concatenate([x[1] for x in held]))

    return texts.mapInArrow(run, "shard int, block binary")


def _pair_blocks(words: Vocabulary, shards: int, pairs: np.ndarray, n: np.ndarray) -> list[tuple[int, bytes]]:
    """Blocks of sorted pairs with their counts."""
    if not pairs.size:
        return []
    context, w = np.divmod(pairs, words.width)
    begin = _runs(context)
    counts, before = (np.repeat(x, np.diff(np.append(begin, pairs.size))) for x in words.counts(context[begin].astype(np.int64)))
    return list(_blocks(words.shard(counts, before, w.astype(np.int64), shards), pairs, None, n))


def _runs(x: np.ndarray) -> np.ndarray:
    """Where each run of equal values of a sorted array begins."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))


def write_pairs(words: Vocabulary, folder: str, shard: int, shards: int, keys: np.ndarray, n: np.ndarray) -> list[tuple[int, float]]:
    """Writes a shard of pairs from sorted keys and their counts; returns (v, its part of g) of words that lie in other shards too."""
    context, w = np.divmod(keys, words.width)
    first = _runs(context)
    v = context[first].astype(np.int64)
    counts, before = words.counts(v)
    owner = np.repeat(np.arange(v.size), np.diff(np.append(first, keys.size)))
    taken = discount(n)
    g = np.add.reduceat(taken, first) / counts
    successors = encode(owner.astype(np.uint64) * words.width + w, v.size * int(words.width))
    put_file(folder, f"pairs-{shard}", [_pack(encode(v, int(words.width)), successors, _code((n - taken) / counts[owner]), _code(g))])
    lowest, highest = (words.shard(counts, before, np.full(v.size, x), shards) for x in (0, words.size))
    return [(int(v[i]), float(g[i])) for i in np.flatnonzero(lowest < highest)]


def write_triples(words: Vocabulary, folder: str, shard: int, shards: int, keys: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple[list[tuple[int, int, float]], np.ndarray, np.ndarray]:
    """Writes a shard of triples, and the pairs of their v, from rows sorted by context key (v, u) and last word; returns (key,
    tokens, what discounts took) of the contexts that may lie in other shards too, whose probabilities are written as if the shard
    had all of them, and keys and counts of the pairs of every v that may lie in others, whose pairs are not read here."""
    first = _runs(keys)
    total, taken = np.add.reduceat(n, first), discount(n)
    g = np.add.reduceat(taken, first) / total
    owner = np.repeat(np.arange(first.size), np.diff(np.append(first, keys.size)))
    of_v, u = np.divmod(keys[first], words.width)
    begin = _runs(of_v)
    v = np.repeat(np.arange(begin.size), np.diff(np.append(begin, of_v.size)))  # of each context u v
    successors, place = np.unique(v[owner].astype(np.uint64) * words.width + w.astype(np.uint64), return_inverse=True)
    pointers = np.searchsorted(successors, np.arange(begin.size + 1, dtype=np.uint64) * words.width)
    every_v = of_v[begin].astype(np.int64)
    counts, before = words.counts(every_v)
    each = np.repeat(np.arange(begin.size), np.diff(pointers))  # of each pair
    pair_n = np.bincount(place, n).astype(np.int64)
    pair_taken = discount(pair_n)
    pair_codes = _code((pair_n - pair_taken) / counts[each]), _code(np.add.reduceat(pair_taken, pointers[:-1]) / counts)
    starts = np.concatenate([[0], np.cumsum(np.diff(pointers)[v])])
    inner = starts[owner] + place - pointers[v[owner]]
    levels = [
        encode(every_v, int(words.width)), encode(pointers, successors.size + 1), encode(successors, begin.size * int(words.width)),
        encode(v.astype(np.uint64) * words.width + u, begin.size * int(words.width)), encode(starts, int(starts[-1]) + 1), encode(inner, int(starts[-1])),
    ]
    put_file(folder, f"triples-{shard}", [_pack(*levels, _short_code((n - taken) / total[owner]), _short_code(g), *pair_codes)])
    end, border = words.lookup(np.array([END]))[0][0], []
    for i in {0, first.size - 1}:
        a, b = int(of_v[i]), int(u[i])
        of_a, of_b = words.counts(np.array([a])), words.counts(np.array([b]))
        lowest, highest = (words.triple_shard(of_a, of_b, np.array([x]), np.array([a == end]), shards)[0] for x in (0, words.tokens))
        if lowest < highest:
            border.append((int(keys[first[i]]), int(total[i]), float(g[i] * total[i])))
    lowest, highest = words.reach(counts, before, shards)
    sent = np.flatnonzero((lowest < highest)[each])
    return border, successors[sent] + (every_v - np.arange(begin.size))[each[sent]].astype(np.uint64) * words.width, pair_n[sent]


class Trie:
    """Log10 probabilities of tokens after their contexts."""

    def __init__(self, words: Vocabulary, folder: str, shards: int, present: np.ndarray, split: dict[int, float], border: list[tuple[int, int, int, float]]):
        self.words, self.folder, self.shards, self.present, self.split = words, folder, shards, present, split
        # Contexts u v of several shards: their keys and g, and each part's shard, place among the keys and share of the tokens.
        shard, key = np.array([x[0] for x in border], np.int64), np.array([x[1] for x in border], np.uint64)
        tokens, taken = np.array([x[2] for x in border], np.float64), np.array([x[3] for x in border], np.float64)
        self.contexts, place = np.unique(key, return_inverse=True)
        total = np.bincount(place, tokens, self.contexts.size)
        self.weights = np.bincount(place, taken, self.contexts.size) / total
        order = np.argsort(shard, kind="stable")
        self.part_shard, self.part_key, self.part_share = shard[order], key[order], (tokens / total[place])[order]

    def _by_shard(self, kind: int, shard: np.ndarray):
        cuts = np.searchsorted(shard, np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            if self.present[kind - PAIRS, s]:
                yield s, slice(cuts[s], cuts[s + 1])

    @staticmethod
    def _each(*sorted_columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each run of equal rows begins, and each row's run."""
        new = np.zeros(sorted_columns[0].size, bool)
        new[:1] = True
        for c in sorted_columns:
            new[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(new), np.cumsum(new) - 1

    def _pair_search(self, kind: int, v: np.ndarray, w: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Discounted probability of each sorted pair, g of its v, and its place in the shard or -1."""
        p, g, place = np.zeros(v.size), np.zeros(v.size), np.full(v.size, -1)
        for s, some in self._by_shard(kind, shard):
            contexts, successors, codes, weights = _pairs(f"{self.folder}/pairs-{s}") if kind == PAIRS else _triples(f"{self.folder}/triples-{s}")[0]
            run, each = self._each(v[some])
            at = contexts.find(v[some][run])[each]
            found = successors.find(np.maximum(at, 0).astype(np.uint64) * self.words.width + w[some].astype(np.uint64))
            place[some] = found = np.where(at >= 0, found, -1)
            p[some] = np.where(found >= 0, _POWERS[codes[np.maximum(found, 0)]], 0.0)
            g[some] = np.where(at >= 0, _POWERS[weights[np.maximum(at, 0)]], 0.0)
        if kind == PAIRS and self.split:
            ids = np.array(sorted(self.split))
            at = np.minimum(np.searchsorted(ids, v), ids.size - 1)
            g = np.where(ids[at] == v, np.array([self.split[i] for i in ids.tolist()])[at], g)
        return p, g, place

    def _triple_search(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, pair: np.ndarray, places: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Discounted probability of each sorted triple, and g of its context (1 where it is unknown). ``pair`` numbers the pairs v w
        in order; ``places`` has their places among the successors of v, or ELSEWHERE."""
        p, g = np.zeros(v.size), np.ones(v.size)
        for s, some in self._by_shard(TRIPLES, shard):
            (contexts, successors, *_), (pointers, lefts, starts, inner, codes, weights) = _triples(f"{self.folder}/triples-{s}")
            # Each v, and each u under it, is searched for once.
            own, each_v = self._each(v[some])
            first = contexts.find(v[some][own])
            begins = pointers.at(np.maximum(first, 0))
            run, each = self._each(v[some], u[some])
            key = np.maximum(first, 0).astype(np.uint64) * self.words.width
            left = lefts.find(key[each_v[run]] + u[some][run].astype(np.uint64))
            left[first[each_v[run]] < 0] = -1
            weight, start = np.ones(left.size), np.zeros(left.size, np.uint64)
            some_left = np.flatnonzero(left >= 0)
            weight[some_left], start[some_left] = weights(left[some_left]), starts.at(left[some_left])
            g[some] = weight[each]
            hit = np.flatnonzero(left[each] >= 0)
            place = places[pair[some][hit]]
            other = np.flatnonzero(place == ELSEWHERE)
            if other.size:  # so is each v w, though it comes under several u
                number = pair[some][hit[other]]
                low = number.min()
                one = np.full(number.max() - low + 1, -1)
                one[number - low] = other
                asked = np.flatnonzero(one >= 0)
                member = hit[one[asked]]
                one[asked] = successors.find(key[each_v[member]] + w[some][member].astype(np.uint64))
                place[other] = one[number - low]
            hit, place = hit[place >= 0], place[place >= 0].astype(np.uint64)
            found = inner.find(start[each[hit]] + place - begins[each_v[hit]])
            p[hit[found >= 0] + some.start] = codes(found[found >= 0])
            for i in range(*np.searchsorted(self.part_shard, [s, s + 1])):
                a, b = (int(x) for x in divmod(self.part_key[i], self.words.width))
                p[some][(v[some] == a) & (u[some] == b)] *= self.part_share[i]
        if self.contexts.size:
            keys = v.astype(np.uint64) * self.words.width + u.astype(np.uint64)
            at = np.minimum(np.searchsorted(self.contexts, keys), self.contexts.size - 1)
            g = np.where(self.contexts[at] == keys, self.weights[at], g)
        return p, g

    def _probabilities(self, key: np.ndarray, distinct: np.ndarray, ids: np.ndarray, counts: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Probability of each of these sorted triples of places among the ``distinct`` hashes."""
        code, mask = np.int64(21), np.int64((1 << 21) - 1)
        base = self.words.base(counts)
        near = np.maximum.accumulate(np.where(counts > 0, ids, 0))  # an unknown word goes where the known one before it would: shards stay in order
        left, word, context = (key >> code) & mask, key & mask, key >> (2 * code)
        value = base[word]
        seen = counts[context] > 0
        pair, at = np.unique(context[seen] << code | word[seen], return_inverse=True)
        a, b = pair >> code, pair & mask
        lowest, highest = self.words.reach(counts[a], before[a], self.shards)
        split = lowest < highest
        p, g, places = np.zeros(pair.size), np.zeros(pair.size), np.full(pair.size, ELSEWHERE)
        p[~split], g[~split], places[~split] = self._pair_search(TRIPLES, ids[a[~split]], ids[b[~split]], lowest[~split])
        in_pairs = self.words.shard(counts[a[split]], before[a[split]], near[b[split]], self.shards)
        p[split], g[split], _ = self._pair_search(PAIRS, ids[a[split]], ids[b[split]], in_pairs)
        value[seen] = (p + g * base[b])[at]
        number = np.zeros(key.size, np.int64)
        number[seen] = at
        seen = np.flatnonzero(seen & (counts[left] > 0))
        a, b = context[seen], left[seen]
        known_before = np.maximum.accumulate(before)[word[seen]]
        shard = self.words.triple_shard((counts[a], before[a]), (counts[b], before[b]), known_before, a == np.searchsorted(distinct, END), self.shards)
        p, g = self._triple_search(ids[b], ids[a], ids[word[seen]], number[seen], places, shard)
        value[seen] = p + g * value[seen]
        return value

    def score(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts, and log10 of base and full probability, of whole rows' tokens."""
        out, code = [], np.int64(21)
        for distinct, u, v, w in _contexts(tokens):
            looked_up = self.words.lookup(distinct)
            key, inverse = np.unique((v << code | u) << code | w, return_inverse=True)
            del u, v
            value = np.concatenate([self._probabilities(key[a : a + SEARCHED], distinct, *looked_up) for a in range(0, key.size, SEARCHED)])
            counts = looked_up[1]
            out.append((counts[w], np.log10(self.words.base(counts))[w], np.log10(value)[inverse]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def build(docs: DataFrame, text_col: str = "text") -> Trie:
    """Counts all of ``docs`` and writes the tries into the shared folder."""
    spark = docs.sparkSession
    text_batches(spark)
    folder = shared_dir(spark)
    make_dirs(folder)
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(8, -(-size // SHARD_BYTES))
    words = _vocabulary(texts, folder, bits=max(3, shards.bit_length() // 2 + 1))
    sent = spark.sparkContext.broadcast(words)  # two numbers a shard of words

    def rows_of(group):
        keys, last, n = zip(*(_read_block(x) for x in group.column("block").to_pylist() if x is not None), strict=True)
        return np.concatenate(keys), last, np.concatenate(n)

    def triples(group):
        shard = group.column("shard")[0].as_py()
        keys, last, n = rows_of(group)
        last = np.concatenate(last)
        (keys, last), n = _summed(np.lexsort((last, keys)), [keys, last], n)
        border, *of_pairs = write_triples(sent.value, folder, shard, shards, keys, last, n)
        found = [(shard, None)] * (1 + len(border)) + _pair_blocks(sent.value, shards, *of_pairs)
        of_border = [None, *({"key": k, "tokens": m, "taken": x} for k, m, x in border)]
        of_border = pa.array(of_border + [None] * (len(found) - len(of_border)), _BORDER)
        return pa.table([*_block_rows(found), of_border], ["shard", "block", "border"])

    def pairs(group):
        shard, blocks = group.column("shard")[0].as_py(), group.column("block")
        split = []
        if blocks.null_count < len(blocks):
            keys, _, n = rows_of(group)
            (keys,), n = _summed(np.argsort(keys, kind="stable"), [keys], n)
            split = write_pairs(sent.value, folder, shard, shards, keys, n)
        border = [x for x in group.column("border").to_pylist() if x is not None]
        return pa.table({"shard": pa.array([shard], pa.int32()), "pairs": [blocks.null_count < len(blocks)], "triples": [blocks.null_count > 0], "words": pa.array([[x for x, _ in split]], pa.list_(pa.int64())), "parts": pa.array([[x for _, x in split]], pa.list_(pa.float64())), "border": pa.array([border], pa.list_(_BORDER))})

    # A shard of triples also sends rows without a block: one that says that it exists, and its contexts that others may hold too.
    of_border = "struct<key:long,tokens:long,taken:double>"
    made = _triple_blocks(texts, sent, shards).groupBy("shard").applyInArrow(triples, f"shard int, block binary, border {of_border}")
    made = made.groupBy("shard").applyInArrow(pairs, f"shard int, pairs boolean, triples boolean, words array<long>, parts array<double>, border array<{of_border}>")
    present, split, border = np.zeros((2, shards), bool), {}, []
    for r in made.collect():  # a row a shard, with two words and two contexts at most that other shards hold too
        present[:, r["shard"]] = r["pairs"], r["triples"]
        border += [(r["shard"], *x) for x in r["border"]]
        for v, g in zip(r["words"], r["parts"], strict=True):
            split[v] = split.get(v, 0.0) + g
    return Trie(words, folder, shards, present, split, border)


def score(docs: DataFrame, trie: Trie, keep: list[Column], text_col: str = "text") -> DataFrame:
    """``keep`` columns with n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    text_batches(spark)
    sent = spark.sparkContext.broadcast(trie)  # some numbers a shard
    rows = docs.select(F.struct(*keep).alias("kept"), F.col(text_col).alias("text"))

    def run(batches):
        model = sent.value
        pieces = ((b.slice(row, bounds.size - 1), tokens, bounds) for b in batches for row, tokens, bounds in _tokens(texts_of(b.column(1))))
        for held in _row_runs(pieces):
            scored, tokens, bounds = zip(*held, strict=True)
            counts, base, full = model.score(np.concatenate(tokens))
            n = np.concatenate([np.diff(x) for x in bounds])
            begins = np.cumsum(n) - n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([x.column(0) for x in scored]),
                    pa.array(n),
                    pa.array(np.add.reduceat((counts > 0).astype(np.int64), begins)),
                    pa.array(np.full(n.size, model.words.tokens, np.int64)),
                    pa.array(np.add.reduceat(base, begins)),
                    pa.array(np.add.reduceat(full, begins)),
                ],
                ["kept", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    kept, result = rows.schema["kept"].dataType, ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    given = [f"kept.`{c}`" for c in kept.names if c not in result]
    return rows.mapInArrow(run, f"kept {kept.simpleString()}, n_tokens long, n_known long, train_tokens long, base_score double, score double").select(*given, *result)
