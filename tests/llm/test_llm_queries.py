"""The registered queries of the training-data operators over the smallest tables: SQL, libraries or brute force."""

import base64
import hashlib
import os
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
tokens = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{DATA}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def result(spark):
    held = {}

    def of(name):
        if name not in held:
            held[name] = {r[0]: r for r in entry.queries()[name](spark, DATA).collect()}
        return held[name]

    return of


@pytest.mark.parametrize("name", ["op1_warc", "op4_exact_dedup", "op8_minhash", "op9_mixing"])
def test_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = entry.queries()[name](spark, DATA)
    names = sorted(df.columns)
    ref = c.execute(entry.oracle_sql()[name])
    at = [[x[0] for x in ref.description].index(n) for n in names]
    assert sorted("|".join(str(r[n]) for n in names) for r in df.collect()) == sorted("|".join(str(r[i]) for i in at) for r in ref.fetchall())


def test_sharding_as_registered(result, documents):
    got, places, sums = result("op2_sharding"), {}, {}
    assert set(got) == {d["doc_id"] for d in documents}
    for d in documents:
        r, raw = got[d["doc_id"]], (d["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        places.setdefault(r["shard"], []).append(r["slot"])
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["size"]
    assert set(places) <= set(range(40)) and all(sorted(x) == list(range(len(x))) for x in places.values())
    # The largest slot is placed first: no shard has more than the mean and one slot above it.
    assert max(sums.values()) <= sum(sums.values()) / 40 + max(r["size"] for r in got.values()) * 2


def test_encodings_as_registered(result, documents):
    import tiktoken
    from tokenizers import Tokenizer

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokens.path("byte_bpe_50k.tiktoken"), "rb"))}
    first = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    second, start = Tokenizer.from_file(tokens.path("byte_bpe_50k.json")), 0
    for d in sorted(documents, key=lambda d: d["doc_id"]):
        text = d["text"] or ""
        ids, r = first.encode_ordinary(text), result("op3_bpe")[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        ids, r = [*second.encode(text, add_special_tokens=False).ids, 0], result("op7_wavelet")[d["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_sources_of_fifty_documents_meet_their_targets(spark):
    sums = {}
    for r in entry.queries()["op9_mixing"](spark, "/root/testdata/sf0.01").collect():
        target, taken = sums.get(r["source_size"], (r["target"], 0))
        sums[r["source_size"]] = (target, taken + r["taken"])
    assert len(sums) == 20 and all(abs(taken - target) <= 0.01 * target for target, taken in sums.values())


def test_held_out_accuracy_on_documents(result, documents):
    got, hits = result("op5_langid"), []
    for d in documents:
        r = got[d["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        letters = any(c.isalpha() for c in d["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        if r["held_out"] and d["lang"] is not None and letters:
            hits.append(r["lang_pred"] == d["lang"])
    assert len(hits) > 20 and np.mean(hits) >= 0.97


def test_fingerprints_as_registered(result, documents):
    got, near = result("op10_fingerprint"), []
    ordered = sorted(documents, key=lambda d: -d["doc_id"])
    by_text = {}
    for d, following in zip(ordered, ordered[1:] + ordered[:1]):
        text, after, r = d["text"] or "", following["text"] or "", got[d["doc_id"]]
        n = len(text) // 3
        changed = text[: len(text) - n] + after[:n]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        if changed != text:
            near.append((r["near_edited"], r["near_next"]))
    assert np.median([a for a, _ in near]) > 0.55 and np.mean([a > b for a, b in near]) > 0.9


def test_pages_as_registered(result):
    pages = pq.read_table(f"{DATA}/pages.parquet").to_pylist()
    got = result("op6_html")
    assert set(got) == {p["page_id"] for p in pages}
    for p in pages:
        r, html = got[p["page_id"]], p["html"] or ""
        assert r["url"] == p["url"] and r["n_chars"] == len(r["text"]) and "<" not in r["text"].replace("< ", "")
        if "<article>" in html:
            assert r["text"]
            assert html[html.index("<nav>") :].split("</nav>")[0].split(">")[-2].split("<")[0] not in r["text"].split("\n")


def test_pipeline_takes_an_empty_table_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    import corpus_pipeline
    from sparkraster.llm.common import stored

    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(40)
    clashing = docs.withColumns({c: F.lit(1) for c in ("_id", "size", "rank", "kept", "lang_pred", "a", "copies", "n_shingles")})
    for rows in (docs.limit(0), stored(clashing, "clashing")):
        wanted, previous = rows.columns, rows
        for name, stage in corpus_pipeline.STAGES:
            previous = stored(stage(spark, previous, DATA), name)
            assert name == "bpe" or sorted(previous.columns) == sorted(wanted), name
        assert previous.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
        assert all(r["n_tokens"] == len(r["ids"]) for r in previous.collect())
