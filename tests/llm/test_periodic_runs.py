"""Periodic runs against a plain search of every lag."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as contract
from trendlake.llm.periodic_runs import _seeds, collapse_runs, collapsed, find_runs, mark_runs, runs_of

SF = "/root/testdata/sf0.001"


def plain(words, least=12):
    seen = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            start = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            if i > start and i - start + q >= max(least, 2 * q):
                seen.setdefault((start, i - start + q), q)
            i += i == start
    return sorted((s, n, q) for (s, n), q in seen.items())


def rows_of_words():
    rng = random.Random(1)
    for _ in range(1500):
        letters, n = rng.choice([1, 2, 3, 4]), rng.choice([0, 5, 11, 12, 13, 30, 60, 120, 250])
        words = [rng.randrange(letters) for _ in range(n)]
        mode = rng.random()
        if mode < 0.5 and n:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if mode < 0.2:
            part = [rng.randrange(2) for _ in range(rng.randint(1, 9))] * rng.randint(1, 6) + [rng.randrange(2) for _ in range(3)]
            words = part * rng.randint(1, 5) + [1] + part * 2
        if mode > 0.93:
            a, b = [0], [0, 1]
            while len(b) < n:
                a, b = b, b + a
            words = b
        yield words, rng.choice([12, 12, 12, 2, 3, 5, 13])


def test_runs_equal_a_plain_search():
    for words, least in rows_of_words():
        want = plain(words, least)
        assert find_runs(np.array(words, np.int64), least) == want
        text = " ".join(map(str, words))
        assert runs_of(text, least) == want
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert collapsed(text, want) == " ".join(str(w) for i, w in enumerate(words) if i not in gone)


def test_seeds_grow_with_the_words_not_with_pairs():
    rng = np.random.default_rng(0)
    same, few = np.zeros(50_000, np.int64), rng.integers(0, 3, 50_000)
    assert len(_seeds(same, 1, 12, 0)[0]) <= 11 * len(same) and len(_seeds(same, 96, 192, 48)[0]) <= 200
    assert all(len(_seeds(few // (few.max() + 1), k, 2 * k, k // 2)[0]) <= 4 * len(few) for k in (12, 24, 48))
    assert find_runs(same) == [(0, 50_000, 1)]


ROWS = [
    (1, None, "u"), (1, "", "u"), (2, "a b c", "u"), (3, "la " * 30, "u"), (3, "la " * 30, "u"),
    (4, "x " + "one two three " * 5 + "y", "u"), (None, "long" * 40_000 + " " + "b c " * 90_000, "u"),
]


def test_rows(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, _found string")
    rows = mark_runs(df).collect()
    assert [(r.doc_id, r._found, [tuple(x) for x in r.runs]) for r in rows] == [
        (k, u, plain((t or "").split()) if k else [(1, 180_000, 2)]) for k, t, u in ROWS
    ]
    assert [r.collapsed for r in rows][:6] == ["", "", "a b c", "la", "la", "x one two three y"]
    cut = collapse_runs(df.withColumnRenamed("_found", "runs"))
    assert cut.columns == ["doc_id", "text", "runs"] and [r.text for r in cut.collect()][:3] == [None, "", "a b c"]
    assert mark_runs(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def query_rows(spark):
    return sorted(tuple(r) for r in contract.queries()["op13_periodic_runs"](spark, SF).collect())


def test_query(query_rows):
    want, planted = [], 0
    for row in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        words = (row["text"] or "").encode().split()
        n, h = len(words), zlib.crc32(str(row["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = plain(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        figures = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        sha = lambda data: hashlib.sha256(data).hexdigest()
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()
        want.append((row["doc_id"], len(runs), *figures, sha(listed), sha(b" ".join(w for i, w in enumerate(words) if i not in gone))))
    assert planted and query_rows == sorted(want)
