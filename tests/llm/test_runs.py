"""Runs of words against brute force."""

import hashlib
import os
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from sparkraster.llm import runs
from sparkraster.llm.common import ship

DATA = "/root/testdata/sf0.001"


def brute(words, least):
    """(start, length, period) of all runs, by their definition."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and (i, j + q - i) not in found:
                found[i, j + q - i] = q
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_sorted(words, least):
    return sorted(brute(words, least), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = np.random.default_rng(4)
    for turn in range(1500):
        texts = []
        for _ in range(rng.integers(1, 4)):
            size = int(rng.integers(0, 70))
            words = rng.integers(0, rng.integers(1, 4), size)
            if size and turn % 3:  # plant powers of words that are powers inside
                root = np.tile(rng.integers(0, 2, rng.integers(1, 12)), 1 + turn % 2)
                words = np.concatenate([words[: size // 3], np.resize(root, rng.integers(1, 60)), words[size // 3 :]])
            texts.append(words)
        least = int(rng.choice([2, 5, 12]))
        counts = np.array([len(t) for t in texts])
        start, length, period = runs.find(np.concatenate(texts), counts, least)
        begins = np.cumsum(counts) - counts
        wanted = [(int(b) + s, n, q) for b, t in zip(begins, texts) for s, n, q in brute_sorted(t.tolist(), least)]
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == wanted


def test_one_word_over_and_over():
    start, length, period = runs.find(np.zeros(5000, np.int64), np.array([5000]))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [5000], [1])


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def described(words, least=12):
    found = brute_sorted(words, least)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    listed, left = "".join(f"{s},{n},{q}\n" for s, n, q in found), " ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(found), *best, 1000 * best[1] // best[2] if found else None, digest(listed), digest(left))


def test_texts_of_all_kinds(spark):
    ship(spark)
    long = " ".join(str(i) for i in range(30000))
    texts = [None, "", " \n", "a", "a " * 12, "a " * 11, "\x0ba b\x0ca b\r" * 6, "x y z " * 40 + "x", "é ü " * 9, long, "a b " * 12, "a " * 12]
    rows = [(i if i % 3 else None, t, "k", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, n_runs int")
    for r in runs.periodic_runs(df, with_all=True).collect():
        assert digest(r["collapsed"]) == r["collapsed_sha256"] and len(r["runs"]) == r["n_runs"]
    short = [(i, t) for i, t in enumerate(texts) if t is not long]
    df = spark.createDataFrame(short, "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in runs.periodic_runs(df).collect()}
    assert got == {i: described(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in short}
    assert runs.periodic_runs(df.limit(0)).collect() == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_query_equals_brute_force(spark):
    docs = pq.read_table(f"{DATA}/documents.parquet").to_pylist()
    got = {r[0]: tuple(r)[1:8] for r in entry.queries()["op12_periodic_runs"](spark, DATA).collect()}
    assert set(got) == {d["doc_id"] for d in docs}
    planted = 0
    for d in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")
        n, h = len(words), zlib.crc32(str(d["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        if n <= 1500:
            assert got[d["doc_id"]] == described(words), d["doc_id"]
    assert planted
