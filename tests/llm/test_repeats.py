"""Suffix arrays and repeated bytes against brute force."""

import hashlib

import numpy as np
import pytest

from sparkraster.llm import repeats
from sparkraster.llm.common import ship, stored
from sparkraster.llm.suffix import lyndon_groups, suffix_arrays


def test_suffix_arrays_equal_sorting():
    rng = np.random.default_rng(1)
    for _ in range(300):
        strings = [rng.integers(0, rng.integers(1, 4) + 1, rng.integers(0, 18)) for _ in range(rng.integers(1, 6))]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
        wanted = [a + j for a, s in zip(offsets, strings) for j in sorted(range(len(s)), key=lambda j, s=s.tolist(): s[j:])]
        assert suffix_arrays(np.concatenate(strings), offsets).tolist() == wanted


def test_groups_are_longest_lyndon_prefixes():
    rng = np.random.default_rng(2)
    for _ in range(200):
        s = rng.integers(0, 3, rng.integers(1, 16))
        text = s.tolist()
        first, prefix = lyndon_groups(s, np.array([0, len(s)]))
        for i in range(len(text)):
            tail = text[i:]
            lyndon = max(n for n in range(1, len(tail) + 1) if all(tail[:n] < tail[j:n] for j in range(1, n)))
            assert prefix[i] == lyndon
        words = [text[i : i + prefix[i]] for i in range(len(text))]
        assert all((first[i] < first[j]) == (words[i] < words[j]) for i in range(len(text)) for j in range(len(text)))


def test_segments_hold_every_window_once():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (0, 99, 100, 101, 700, 3, 2500)] + [b"a" * 400]
    raw, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for chunk in (128, 1 << 18):
        first, last, hashes = repeats.segments(raw, offsets, chunk)
        windows = [w for a, b in zip(first, last) for w in range(a, b + 1)]
        assert windows == [w for a, b in zip(offsets, offsets[1:]) for w in range(a, b - 99)]
        # Equal windows have one anchor.
        anchors = {}
        for a, b, h in zip(first, last, hashes):
            for w in range(a, b + 1):
                assert anchors.setdefault(raw[w : w + 100].tobytes(), h) == h


def brute(rows):
    """(n_bytes, n_removed, n_spans, sha256) by key; rows are (key, text)."""
    ordered = sorted(((k is None, k or 0, i), (t or "").encode()) for i, (k, t) in enumerate(rows))
    seen, out = set(), []
    for place, raw in ordered:
        gone = [False] * len(raw)
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = [True] * 100
            seen.add(raw[i : i + 100])
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((None if place[0] else place[1], len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(map(str, out))


def odd_rows():
    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("abcdé \n"), n))
    passage, line = word(900), "x" * 260
    rows = [(None, None), (1, ""), (2, None), (3, "short"), (4, passage), (5, passage), (6, "a" * 350), (7, "ab" * 300), (8, line + "\n" + line)]
    for i in range(9, 60):
        a, b = sorted(rng.integers(0, 900, 2))
        rows.append((int(i), word(int(rng.integers(0, 150))) + passage[a:b] + word(int(rng.integers(0, 150))) + line * int(rng.integers(0, 2))))
    rows += [(60, passage * 3), (None, passage[::-1]), (2**63 - 1, passage[:500]), (-5, passage[300:600]), (-5, passage[300:600])]
    return rows


@pytest.mark.parametrize("lane, block, together", [(64, 4_000_000, 64), (3, 700, 64), (2, 400, 2)])
def test_equals_brute_force(spark, lane, block, together):
    ship(spark)
    rows = odd_rows()
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), "docs")
    got = repeats.remove_repeats(docs, with_kept=True, block=block, lane=lane, together=together).collect()
    assert sorted(str((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in got) == brute(rows)
    for r in got:
        assert r["n_spans"] == len(r["spans"]) and sum(b - a for a, b in r["spans"]) == r["n_removed"]
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]


def test_empty_table_and_clashing_columns(spark):
    ship(spark)
    docs = spark.createDataFrame([], "doc_id long, text string, part int, block string, keys int")
    assert repeats.remove_repeats(docs).collect() == []
    docs = spark.createDataFrame([(1, "a" * 120, 3, "x", 4)], docs.schema)
    assert [tuple(r)[:4] for r in repeats.remove_repeats(docs).collect()] == [(1, 120, 119, 1)]
