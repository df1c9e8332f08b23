"""Language of whole texts by multilingual mixture inference.

Training counts byte trigrams of words (with their edges) for each label over every training text; a smoothed trigram
model for each language follows. A document is a mixture: each word comes from language l with probability p_l, and
expectation-maximisation finds the proportions from the words' likelihoods. Languages join the document's set one at a
time while the penalised likelihood (BIC) improves. The prediction is the language with the largest proportion, and that
proportion is the score.

A null text, or one without a letter, is ``und`` with score 0. Labels that are null don't train. Ties go to the label that
sorts first. Without training texts every document is ``und``. Repeated rows are judged alike; further columns are not read,
and kept columns with a result's name give way. Long texts are judged by all their words. No rows to judge give none.

The model holds every trigram that occurs (2^24 at most), in two files in the shared folder that tasks write by ranges of trigrams and
workers map: 4 bytes for each trigram and label. Only labels and their totals reach the driver.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.shared import make_dirs, map_file, put_file, shared_dir, text_batches, written
from graphloom.llm.words import _BLANK, STEP_BYTES, raw_bytes, texts_of

ALPHA = 0.5
#: Rounds of expectation-maximisation at most, the change at which they end (far earlier), and a second language's first share.
EM_ROUNDS, EM_TOLERANCE = 500, 1e-4
#: Bits of a trigram's code that name its file.
RANGE_BITS = 6
START_SHARE = 0.05
#: Counts that a task holds before it sends them, and likelihoods of trigrams that it holds at once.
HELD_COUNTS, HELD_LOGS = 1 << 20, 1 << 20
UNKNOWN = "und"
RESULT = ("lang_pred", "score", "lang_mix")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_EDGE = 32  # a blank stands for a word's edge


def word_grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram codes of all words in order, each word's first code, and the bounds of each row's words."""
    n = bounds.size - 1
    # Each row gets two blanks before and one after it, so that edges fall out of a plain scan.
    padded = np.full(data.size + 3 * n + 2, _EDGE, np.uint8)
    at = np.arange(data.size) + 2 + 3 * np.repeat(np.arange(n), np.diff(bounds))
    padded[at] = _LOWER[data]
    padded[_BLANK[padded]] = _EDGE
    codes = (padded[:-2].astype(np.int32) << 16) | (padded[1:-1].astype(np.int32) << 8) | padded[2:]
    inside = padded[1:-1] != _EDGE  # the middle byte belongs to a word
    first = inside & (padded[:-2] == _EDGE)
    codes, starts = codes[inside], np.cumsum(inside)[first] - 1
    row_begin = bounds[:-1] + 3 * np.arange(n) + 1
    places = np.flatnonzero(first)
    return codes, starts, np.append(np.searchsorted(places, row_begin), places.size)


def _steps(column: pa.Array):
    data, bounds = raw_bytes(column)
    row, n = 0, len(column)
    while row < n:
        end = min(n, max(int(np.searchsorted(bounds, bounds[row] + STEP_BYTES // 2, "right")) - 1, row + 1))
        yield row, end, *word_grams(data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row])
        row = end


def gram_counts(docs: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """(label, gram, n) over every labelled text, counted in each task first."""
    text_batches(docs.sparkSession)

    def count(batches):
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting = 0
        for b in batches:
            labels = np.array(b.column(1).to_pylist(), object)
            for label in set(labels.tolist()):
                some = b.column(0).filter(pa.array(labels == label))
                for _, _, codes, _, _ in _steps(texts_of(some)):
                    held.setdefault(label, []).append(np.unique(codes, return_counts=True))
                    waiting += held[label][-1][0].size
                    if waiting > HELD_COUNTS:
                        held = {name: [merged(parts)] for name, parts in held.items()}
                        waiting = sum(parts[0][0].size for parts in held.values())
                        if waiting > HELD_COUNTS // 2:
                            yield from flush(held)
                            held, waiting = {}, 0
        yield from flush(held)

    def merged(parts):
        grams, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return grams, np.bincount(place, weights=np.concatenate([n for _, n in parts])).astype(np.int64)

    def flush(held):
        for label, parts in held.items():
            grams, n = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([label] * grams.size, pa.string()), pa.array(grams.astype(np.int32)), pa.array(n)], ["label", "gram", "n"])

    rows = docs.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(label_col).alias("label"))
    return rows.mapInArrow(count, "label string, gram int, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Log likelihood of a word's trigrams in each language."""

    def __init__(self, labels: list[str], totals: list[int], distinct: int, files: list[str]):
        self.labels, self.files, self.totals, self.distinct = labels, files, totals, distinct

    @functools.cached_property
    def _levels(self) -> tuple[np.ndarray, np.ndarray]:
        """The trigrams in order, and a row of logarithms for each of them after one for a trigram that never occurred; both mapped
        from their files where the shared folder is mounted, so a machine's workers share them."""
        grams, logs = (np.frombuffer(map_file(name), np.uint8) for name in self.files)
        return grams.view("<i4"), logs.view("<f4").reshape(-1, len(self.labels))

    @property
    def grams(self) -> np.ndarray:
        return self._levels[0]

    @property
    def logs(self) -> np.ndarray:
        return self._levels[1]

    @functools.cached_property
    def pages(self) -> tuple[np.ndarray, np.ndarray]:
        """Page of a trigram's first two bytes (0: none), and the rows of its 256 trigrams in each page."""
        first, at = np.unique(self.grams >> 8, return_inverse=True)
        page = np.zeros(1 << 16, np.int32)
        page[first] = np.arange(1, first.size + 1) << 8
        row = np.zeros((first.size + 1) << 8, np.int32)
        row[((at + 1) << 8) | (self.grams & 255)] = np.arange(1, self.grams.size + 1)
        return page, row

    def words(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log likelihood of each word in each language."""
        (page, row), logs = self.pages, self.logs
        out, ends = np.zeros((starts.size, len(self.labels))), np.append(starts[1:], codes.size)
        a = 0
        while a < starts.size:
            z = max(a + 1, int(np.searchsorted(ends, starts[a] + HELD_LOGS // len(self.labels), "right")))
            some = codes[starts[a] : ends[z - 1]]
            out[a:z] = np.add.reduceat(logs[row[page[some >> 8] | (some & 255)]].astype(float), starts[a:z] - starts[a], axis=0)
            a = z
        return out


def _em(like: np.ndarray, rows: np.ndarray, n_rows: int, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihood of each row whose words have these scaled likelihoods; sets: languages of each row."""
    lengths = np.bincount(rows, minlength=n_rows)
    share = sets / sets.sum(1, keepdims=True)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    for _ in range(EM_ROUNDS):
        part = share[rows] * like
        part /= part.sum(1, keepdims=True)
        new = np.add.reduceat(part, begins, axis=0) / lengths[:, None]
        moved = np.abs(new - share).max(initial=0)
        share = new
        if moved < EM_TOLERANCE:
            break
    return share, np.add.reduceat(np.log((share[rows] * like).sum(1)), begins)


def _pairs(logs, base, owner, lengths, needed):
    """The best second language of each row: (its number or -1, its proportion, gain in log likelihood).

    With ratio r of a word's likelihoods in the second and the first language, a round of expectation-maximisation moves
    the proportion p by p * (1 - p) * slope / words, where slope = sum((r - 1) / (1 + p * (r - 1))) is the derivative of
    the log likelihood. That is concave in p, so its tangent bounds what any p can gain: rows whose bound is below what
    the penalty asks for are done, mostly in the first round. owner: each word's row; needed: the gain asked for.
    """
    n_rows = lengths.size
    second, share, gained = np.full(n_rows, -1), np.zeros(n_rows), np.zeros(n_rows)
    for other in range(logs.shape[1]):
        extra = np.expm1(np.clip(logs[:, other] - base, -60.0, 60.0))
        live, at = np.arange(n_rows), owner
        p = np.full(n_rows, START_SHARE)
        for turn in range(EM_ROUNDS):
            counts = lengths[live]
            begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
            q = 1 + np.repeat(p[live], counts) * extra
            slope, value = np.add.reduceat(extra / q, begins), np.add.reduceat(np.log(q), begins)
            now = p[live]
            bound = value + np.maximum(-slope * now, slope * (1 - now))
            step = now * (1 - now) * slope / counts
            least = needed[live] + np.maximum(gained[live] - needed[live], 0)
            hopeful = bound > least + 1e-9
            done = hopeful & ((np.abs(step) < EM_TOLERANCE) | (turn == EM_ROUNDS - 1)) & (value > least + 1e-9)
            won = live[done]
            second[won], share[won], gained[won] = other, now[done], value[done]
            p[live] = now + step
            stay = hopeful & (np.abs(step) >= EM_TOLERANCE)
            if not stay.any():
                break
            mask = np.repeat(stay, counts)
            extra, live = extra[mask], live[stay]
    return second, share, gained


def infer(logs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Proportions of the languages in each row; rows without words get zeros."""
    n_rows, n_langs = bounds.size - 1, logs.shape[1]
    lengths = np.diff(bounds)
    shares = np.zeros((n_rows, n_langs))
    full = np.flatnonzero(lengths)
    if not full.size:
        return shares
    begins, counts = bounds[:-1][full], lengths[full]
    single = np.add.reduceat(logs, begins, axis=0)
    best = single.argmax(1)
    shares[full, best] = 1.0
    penalty = 0.5 * np.log(counts)
    owner = np.repeat(np.arange(full.size), counts)
    base = logs[np.arange(len(logs)), best[owner]]
    second, share, gained = _pairs(logs, base, owner, counts, penalty)
    mixed = np.flatnonzero(second >= 0)
    shares[full[mixed], best[mixed]], shares[full[mixed], second[mixed]] = 1 - share[mixed], share[mixed]
    for row in mixed.tolist():  # few documents: try further languages one at a time
        words = logs[begins[row] : begins[row] + counts[row]]
        shares[full[row]] = _grow(words, shares[full[row]], single[row, best[row]] + gained[row] - penalty[row], penalty[row])
    return shares


def _grow(words: np.ndarray, share: np.ndarray, score: float, penalty: float) -> np.ndarray:
    """The proportions after adding languages to a set of two, as long as the penalised likelihood improves."""
    top = words.max(1, keepdims=True)
    like, rows = np.exp(np.maximum(words - top, -60.0)), np.zeros(len(words), np.int64)
    have = share > 0
    while not have.all():
        trials = []
        for other in np.flatnonzero(~have).tolist():
            chosen = have.copy()
            chosen[other] = True
            new, value = _em(like, rows, 1, chosen[None].astype(float))
            trials.append((float(value[0] + top.sum() - penalty * (chosen.sum() - 1)), -other, new[0], chosen))
        value, _, new, chosen = max(trials, key=lambda t: t[:2])
        if value <= score + 1e-9:
            break
        score, share, have = value, new, chosen
    return share


def _mass(totals, distinct: int) -> np.ndarray:
    """What a smoothed count of each label is divided by: all occurring trigrams and one that stands for the others."""
    return np.array(totals, float) + ALPHA * (distinct + 1)


def train(docs: DataFrame, text_col: str = "text", label_col: str = "lang") -> Model | None:
    """The model of every labelled text, with every trigram."""
    counts = written(gram_counts(docs, text_col, label_col))
    totals = sorted((r.label, r.n) for r in counts.groupBy("label").agg(F.sum("n").alias("n")).collect())  # a row a language
    if not totals:
        return None
    labels, sums = [x for x, _ in totals], [n for _, n in totals]
    distinct = counts.select("gram").distinct().count()
    folder = shared_dir(docs.sparkSession)
    make_dirs(folder)

    def write(group):
        codes, n = group.column("gram").to_numpy(), group.column("n").to_numpy()
        grams, place = np.unique(codes, return_inverse=True)
        counted = np.zeros((grams.size, len(labels)))
        counted[place, np.searchsorted(np.array(labels, object), np.array(group.column("label").to_pylist(), object))] = n
        logs = np.log((counted + ALPHA) / _mass(sums, distinct))
        part = group.column("part")[0].as_py()
        names = [put_file(folder, f"{kind}-{part:03d}", [x.tobytes()]) for kind, x in (("grams", grams.astype("<i4")), ("logs", logs.astype("<f4")))]
        return pa.table({"part": pa.array([part], pa.int32()), "grams": [names[0]], "logs": [names[1]]})

    def join(kinds):
        for b in kinds:
            for kind, names in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                none = np.log(ALPHA / _mass(sums, distinct)).astype("<f4").tobytes() if kind == "logs" else b""
                parts = (memoryview(map_file(x)) for x in names)  # one after the other
                yield pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([put_file(folder, kind, itertools.chain([none], parts))])], ["kind", "name"])

    ranges = counts.withColumn("part", F.shiftright("gram", 24 - RANGE_BITS)).groupBy("part").applyInArrow(write, "part int, grams string, logs string")
    rows = sorted(map(tuple, ranges.collect()))  # a row a range
    lists = docs.sparkSession.createDataFrame([("grams", [r[1] for r in rows]), ("logs", [r[2] for r in rows])], "kind string, names array<string>")
    whole = dict(map(tuple, lists.repartition(2, "kind").mapInArrow(join, "kind string, name string").collect()))
    return Model(labels, sums, distinct, [whole["grams"], whole["logs"]])


def predict(docs: DataFrame, model: Model | None, keep: list[Column], text_col: str = "text") -> DataFrame:
    """``keep`` columns with lang_pred, score and lang_mix (label -> proportion) of every row.

    A kept column of the text's name is the text itself: it is sent to the tasks once.
    """
    spark = docs.sparkSession
    text_batches(spark)
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    kept = docs.select(*keep)
    given = [f"kept.`{c}`" for c in kept.columns if c not in RESULT]
    kept = kept.schema
    inside = kept.names.index(text_col) if text_col in kept.names else None
    rows = docs.select(F.struct(*keep).alias("kept"), letters.alias("letters"), *([F.col(text_col).alias("text")] if inside is None else []))
    if model is None:
        return rows.select(*given, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("map<string,double>").alias("lang_mix"))
    sent = spark.sparkContext.broadcast(model)
    kind = kept.simpleString()

    def run(batches):
        m = sent.value
        labels = np.array([*m.labels, UNKNOWN], object)
        for b in batches:
            texts = texts_of(b.column(2) if inside is None else b.column(0).field(inside))
            texts = pc.if_else(b.column(1), texts, pa.scalar("", texts.type))
            shares = [infer(m.words(codes, starts), bounds) for _, _, codes, starts, bounds in _steps(texts)]
            share = np.concatenate(shares) if shares else np.zeros((0, len(m.labels)))
            score = np.minimum(share.max(1, initial=0), 1.0)
            pick = np.where(score > 0, share.argmax(1), len(m.labels)) if len(share) else np.zeros(0, int)
            row, col = np.nonzero(share > 0)
            ends = np.searchsorted(row, np.arange(len(share) + 1)).astype(np.int32)
            mixed = pa.MapArray.from_arrays(pa.array(ends), pa.array(labels[col].tolist(), pa.string()), pa.array(share[row, col]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(labels[pick].tolist(), pa.string()), pa.array(score), mixed], ["kept", "lang_pred", "score", "lang_mix"])

    return rows.mapInArrow(run, f"kept {kind}, lang_pred string, score double, lang_mix map<string,double>").select(*given, *RESULT)
