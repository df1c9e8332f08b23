"""Benchmark decontamination by SimHash over item-sized windows.

A document is slid over by windows as long as each benchmark item, in words. A document that is shorter than an item is one
window as a whole, if its length still allows the wanted similarity. A window's fingerprint has in each of 128 bits the sign
of the weighted sum of its five-word shingles' bits; a shingle's weight is how often it occurs in the window. Fingerprints
are cut into 8 blocks of 16 bits: two within ``RADIUS`` bits differ by ``RADIUS // BLOCKS`` bits or fewer in one block at
least. Items stand in sorted tables under all block values up to ``ITEM_REACH`` bits away from theirs, and a window asks for
all values up to ``WINDOW_REACH`` bits away from its own, so the tables miss no item within the radius. Candidates within the
radius are then compared exactly by weighted Jaccard: the sum of the lesser over the sum of the greater weights.

At similarity 0.8 two windows of one length have a cosine of 0.89; the expected distance is 19.4 bits with a deviation of
4.1, so a radius of 31 misses about one in a thousand of such pairs and fewer above. Of random pairs the tables let 8 %
through, and the radius none in practice.

Windows are skipped before that by an exact bound: a window needs as many shingles that occur in items of its length as the
similarity asks for. Items with fewer words than a shingle are one shingle as a whole, found in windows of their own length
only. Items and documents that are null or without words match nothing. Repeated items are reported each, those with a null
id under null; repeated rows of documents too. Items are sent to the tasks in chunks of bounded size, however large the
benchmark is: each chunk is a pass over the documents. A long text is slid over whole, in steps of bounded windows. Without documents
or items nothing is found; columns of the documents beside id and text are not read, and ``clean`` gives them back as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.shared import text_batches
from graphloom.llm.words import SHINGLE, hashed_steps, mix, shingles, texts_of

BITS, BLOCKS, RADIUS = 128, 8, 31
ITEM_REACH, WINDOW_REACH = 1, 2  # bits; together RADIUS // BLOCKS
#: Bytes and number of items that are sent at once, windows fingerprinted at once, and windows that ask the tables at once.
CHUNK_BYTES, CHUNK_ITEMS, WINDOW_STEP, ASK_STEP = 16 << 20, 1 << 16, 1 << 13, 256


def _within(bits: int) -> np.ndarray:
    """All 16-bit masks of so many bits at most."""
    masks = np.arange(1 << 16, dtype=np.uint32)
    return masks[np.bitwise_count(masks) <= bits].astype(np.uint16)


_ITEM_MASKS, _WINDOW_MASKS = _within(ITEM_REACH), _within(WINDOW_REACH)


def _signs(grams: np.ndarray) -> np.ndarray:
    """+1 or -1 for each fingerprint bit of each shingle."""
    hashes = np.stack([grams, mix(grams ^ np.uint64(0x9E3779B97F4A7C15))], axis=1)
    return np.unpackbits(hashes.view(np.uint8), axis=1).astype(np.int16) * 2 - 1


def fingerprint(sums: np.ndarray) -> np.ndarray:
    """The fingerprints of rows of weighted bit sums, as two 64-bit numbers each; a zero sum counts as a set bit."""
    return np.packbits(sums >= 0, axis=1).view(np.uint64).reshape(-1, BITS // 64)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1)


class Items:
    """Benchmark items of one chunk: shingles, fingerprints and the block tables."""

    def __init__(self, ids: list[int | None], words: list[np.ndarray]):
        order = sorted(range(len(ids)), key=lambda i: words[i].size)
        self.ids = [ids[i] for i in order]
        self.lengths = np.array([words[i].size for i in order], np.int64)
        self.shingles = [np.sort(shingles(words[i])) for i in order]
        self.prints = np.concatenate([np.zeros((0, BITS // 64), np.uint64), *[fingerprint(_signs(s).sum(0, dtype=np.int64)[None]) for s in self.shingles]])
        self.sizes = np.unique(self.lengths)
        # A key is (window length, block, block value).
        near = self.prints.view(np.uint16).reshape(-1, BLOCKS)[:, :, None] ^ _ITEM_MASKS
        keys = self._keys(np.searchsorted(self.sizes, self.lengths), near).reshape(len(order), -1)
        owner = np.repeat(np.arange(len(order)), keys.shape[1])
        place = np.argsort(keys.reshape(-1), kind="stable")
        self.keys, self.owners = keys.reshape(-1)[place], owner[place]
        # The shingles of all items of a shingle width, and of those of one length.
        width = np.minimum(self.lengths, SHINGLE)
        union = lambda some: np.unique(np.concatenate([self.shingles[i] for i in np.flatnonzero(some)]))
        self.anchors = {int(k): union(width == k) for k in np.unique(width)}
        self.sized = {int(n): union(self.lengths == n) for n in self.sizes}

    def _keys(self, size: np.ndarray, values: np.ndarray) -> np.ndarray:
        return ((size[:, None, None] * BLOCKS + np.arange(BLOCKS)[None, :, None]) << 16) | values.astype(np.int64)

    def candidates(self, length: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius in order, found through the block tables."""
        size = np.searchsorted(self.sizes, length)
        first, last = np.searchsorted(self.keys, np.array([size, size + 1]) * BLOCKS << 16)
        table = self.keys[first:last]
        found = [np.zeros((2, 0), np.int64)]
        for a in range(0, len(prints), ASK_STEP):
            asked = prints[a : a + ASK_STEP].view(np.uint16).reshape(-1, BLOCKS)[:, :, None] ^ _WINDOW_MASKS
            keys = self._keys(np.full(len(asked), size), asked).reshape(-1)
            low = np.searchsorted(table, keys, "left")
            hit = np.flatnonzero(table[np.minimum(low, table.size - 1)] == keys)
            low, n = low[hit], np.searchsorted(table, keys[hit], "right") - low[hit]
            at = first + np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            window = a + np.repeat(hit, n) // (keys.size // len(asked))
            pairs = np.unique(window * len(self.ids) + self.owners[at])
            found.append(np.stack(np.divmod(pairs, max(1, len(self.ids)))))
        window, item = np.concatenate(found, axis=1)
        keep = distance(prints[window], self.prints[item]) <= RADIUS
        return window[keep], item[keep]


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted multisets."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], m[j]).sum())
    return both / (a.size + b.size - both) if a.size + b.size else 0.0


def _anchored(anchors: np.ndarray, grams: np.ndarray) -> np.ndarray:
    return anchors[np.minimum(np.searchsorted(anchors, grams), anchors.size - 1)] == grams


def hopeful(items: Items, words: np.ndarray, bounds: np.ndarray, least: float) -> np.ndarray:
    """Rows (of words in ``bounds``) with enough shingles of items for one of them at least."""
    out = np.zeros(bounds.size - 1, bool)
    for k, anchors in items.anchors.items():
        if words.size < k:
            continue
        seen = np.concatenate([[0], np.cumsum(_anchored(anchors, shingles(words, k)))])
        own = np.diff(bounds) >= k
        have = seen[np.maximum(bounds[1:] - k + 1, 0)] - seen[np.minimum(bounds[:-1], seen.size - 1)]
        fewest = int(items.lengths[np.minimum(items.lengths, SHINGLE) == k].min()) - k + 1
        out |= own & (have >= least * fewest - 1e-9)
    return out


def matches(items: Items, words: np.ndarray, least: float) -> list[tuple[int | None, int, int, float]]:
    """(item id, first word, words, similarity) of the best window of each item that reaches ``least``."""
    best: dict[int, tuple[float, int]] = {}
    for k in items.anchors:
        if words.size < k:
            continue
        grams = shingles(words, k)
        for length in items.sizes[np.minimum(items.sizes, SHINGLE) == k].tolist():
            full, span = length - k + 1, min(length, words.size) - k + 1
            if grams.size < least * full - 1e-9:
                continue
            seen = np.concatenate([[0], np.cumsum(_anchored(items.sized[length], grams))])
            need = least / (1 + least) * (full + span) - 1e-9  # shared shingles that the similarity takes
            begins = np.flatnonzero(seen[span:] - seen[:-span] >= need)
            for at in np.split(begins, np.flatnonzero(np.diff(begins // WINDOW_STEP)) + 1) if begins.size else []:
                low, high = int(at[0]), int(at[-1]) + span
                sums = np.concatenate([np.zeros((1, BITS), np.int32), np.cumsum(_signs(grams[low:high]), axis=0, dtype=np.int32)])
                window, item = items.candidates(length, fingerprint(sums[at - low + span] - sums[at - low]))
                for w, i in zip(at[window].tolist(), item.tolist(), strict=True):
                    if i in best and best[i][0] == 1.0:
                        continue
                    found = weighted_jaccard(grams[w : w + span], items.shingles[i])
                    if found >= least and (i not in best or found > best[i][0]):
                        best[i] = (found, w)
    return [(items.ids[i], w, min(int(items.lengths[i]), words.size), s) for i, (s, w) in sorted(best.items())]


def _chunks(benchmark: DataFrame, item_col: str, text_col: str):
    """The benchmark's items, at most about ``CHUNK_BYTES`` of text at a time."""
    rows = benchmark.where(F.col(text_col).isNotNull()).select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    size, n = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    chunks = max(-(-(size or 0) // CHUNK_BYTES), -(-n // CHUNK_ITEMS))
    for c in range(chunks):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(chunks)) == c).toArrow()
        ids, words = [], []
        for row, end, hashes, bounds in hashed_steps(texts_of(part.column(1))):
            for i in range(row, end):
                own = hashes[bounds[i - row] : bounds[i - row + 1]]
                if own.size:
                    ids.append(part.column(0)[i].as_py())
                    words.append(own)
        if ids:
            yield Items(ids, words)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item_id, first_word, n_words, similarity) for each document and item with a window of ``least`` similarity: the
    best window, the first among equals. Further columns of ``docs`` are not read."""
    spark = docs.sparkSession
    text_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    fields = "id long, item_id long, first_word long, n_words long, similarity double"
    found = spark.createDataFrame([], fields)
    for items in _chunks(benchmark, item_col, item_text_col):
        sent = spark.sparkContext.broadcast(items)

        def run(batches, sent=sent):
            for b in batches:
                ids = b.column(0).to_pylist()
                out = []
                for row, end, words, bounds in hashed_steps(texts_of(b.column(1))):
                    for i in (row + np.flatnonzero(hopeful(sent.value, words, bounds, least))).tolist():
                        out += [(ids[i], *m) for m in matches(sent.value, words[bounds[i - row] : bounds[i - row + 1]], least)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64()] * 4 + [pa.float64()], strict=True)], ["id", "item_id", "first_word", "n_words", "similarity"])

        found = found.unionAll(rows.mapInArrow(run, fields))
    return found.withColumnRenamed("id", id_col)


def clean(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, id_col: str = "doc_id", **columns) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item. Rows with a null id are kept only if no such row is contaminated."""
    bad = contaminated(docs, benchmark, least, id_col, **columns).select(F.col(id_col).alias("_bad")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_bad"]), "left_anti")
