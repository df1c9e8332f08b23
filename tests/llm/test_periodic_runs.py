"""Periodic runs against brute force: whole appends, words one by one, batches of documents, and the query's digests."""

import hashlib

import numpy as np
import pytest

from graphloom.llm import periodic_runs, queries
from graphloom.llm.periodic_runs import LEAST, SquareCatcher, collapse, runs_of


def brute(w):
    n, out = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(LEAST, 3 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((b, e - b, q) for (b, e), q in out.items())


def made(rng):
    n = int(rng.integers(0, 300))
    w = rng.integers(0, int(rng.choice([1, 2, 3, 50])), n)
    for _ in range(int(rng.integers(0, 4)) if n > 5 else 0):
        a = int(rng.integers(0, n))
        m = int(rng.integers(1, n - a + 1))
        w[a : a + m] = w[a + np.arange(m) % (1 + m // int(rng.integers(3, 11)))]
    return w


@pytest.mark.parametrize("most", [1, 7, 64, 1 << 20])
def test_runs_do_not_depend_on_how_words_are_appended(most):
    rng = np.random.default_rng(most)
    for _ in range(80):
        w, catcher, i = made(rng), SquareCatcher(), 0
        while i < w.size:
            step = int(rng.integers(1, most + 1))
            catcher.append(w[i : i + step])
            i += step
        assert [tuple(x) for x in catcher.runs().tolist()] == brute(w.tolist())


def test_runs_of_documents_in_one_stream():
    rng = np.random.default_rng(0)
    documents = [[b"%d" % x for x in made(rng)] for _ in range(200)]
    documents += [documents[-1], documents[-1]]  # neighbours alike: no run crosses them
    for words, runs in zip(documents, runs_of(documents), strict=True):
        assert [tuple(x) for x in runs.tolist()] == brute(words)


def test_equal_values_of_other_words_are_no_square(monkeypatch):
    """Blocks compare by values; where these say too much, the words decide."""
    monkeypatch.setattr(periodic_runs, "mix", lambda x: x * np.uint64(0))
    rng = np.random.default_rng(4)
    for _ in range(40):
        w, catcher = made(rng), SquareCatcher()
        catcher.append(w)
        assert [tuple(x) for x in catcher.runs().tolist()] == brute(w.tolist())


def test_one_word_many_times_is_one_run():
    catcher = SquareCatcher()
    catcher.append(np.zeros(50_000))
    assert catcher.runs().tolist() == [[0, 50_000, 1]]


def by_hand(doc_id, text):
    words = queries.looped(doc_id, (text or "").encode().split())
    runs = brute(words)
    gone = {i for b, n, q in runs for i in range(b + q, b + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    digest = lambda x: hashlib.sha256(x).hexdigest()
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], digest("".join(f"{b},{n},{q}\n" for b, n, q in runs).encode()), digest(kept))


def test_query_against_brute_force(spark, tmp_path):
    rng = np.random.default_rng(7)
    line = "a license line that is long enough to be told apart from all others "
    texts = [None, "", " \t\n", "x" * 70_000, line * 9, line * 3 + "no " * 30 + line * 4, "à l'été " * 20, "ab " * 7, "ab cd " * 30]
    rows = [(i, t, 0.5, "old") for i, t in enumerate(texts + [" ".join(map(str, made(rng))) for _ in range(120)])]
    rows += [rows[4], rows[4], (None, line * 5, 0.5, "old"), (None, None, 0.5, "old")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, length double, period string")
    frame.repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    found = sorted([tuple(r) for r in got.collect()], key=str)
    assert found == sorted([by_hand(i, t) for i, t, *_ in rows], key=str)
    assert any(i is not None and queries.looped(i, ["x"] * 40 + list("abcdefgh") * 8) != ["x"] * 40 + list("abcdefgh") * 8 for i, *_ in rows)
    assert periodic_runs.periodic_runs(frame.where("false")).count() == 0
    runs = {r.doc_id: r for r in periodic_runs.periodic_runs(frame.where("doc_id = 4")).collect()}
    assert runs[4].collapsed == line.strip() and [tuple(x) for x in runs[4].runs] == [(0, 14 * 9, 14)]


def test_collapse_keeps_the_first_period():
    words = list(b"0 1 2 3".split()) * 8
    assert collapse(words, runs_of([words])[0]) == words[:4]
