"""Training-data operators against brute force, and their defined results in odd cases."""

import base64
import hashlib
import json
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkraster.llm import bpe, common, exact_dedup, fingerprint, htmlext, langid, minhash, mixing, pretokens, sharding, warc, wavelet

tokens = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the a river stone light over under house tree bird cloud small large green door walks runs seen heard never always".split()


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Null, empty, blank, very long, short and repeated texts; copies, near copies and a chain; null sources and labels."""
    rng = random.Random(7)
    texts = [None, "", " \n\t", "one", "two words", "é ñ 中文  x", "A'S don't we'll  x\n\ny 12,5!", sentence(rng, 20000)]
    base = sentence(rng, 120)
    for k in range(30):
        words = base.split(" ")
        for i in rng.sample(range(120), k // 3):
            words[i] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [base, base.replace(" ", "  "), base.upper(), base + "\n"] * 3
    chain = [f"link{i}" for i in range(140)]
    texts += [" ".join(chain[i * 3 : i * 3 + 100]) for i in range(8)]
    texts += [sentence(rng, rng.randrange(1, 60)) for _ in range(60)]
    langs, sources = ["en", "fr", None], ["s1", "s0", None, "s2"]
    return [(i * 3 + 1, t, langs[i % 3], sources[i % 4 if i % 7 else 0], len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


def by_id(df, key="doc_id"):
    out = {r[key]: r for r in df.collect()}
    return out


def test_pretokens_equal_the_pattern():
    regex = pytest.importorskip("regex")
    pattern, rng = regex.compile(tokens.PATTERN), random.Random(1)
    signs = "aB'sstredvlm  \n\t1!é' 　中٣.\U0001f600"
    for _ in range(3000):
        texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(1, 4))]
        points, offsets = pretokens.code_points(texts)
        begin = pretokens.cuts(points, offsets).tolist()
        whole = "".join(texts)
        assert [whole[a:b] for a, b in zip(begin, [*begin[1:], len(whole)])] == [w for t in texts for w in pattern.findall(t)]
        found = pretokens.Distinct(texts)
        words = found.words()
        assert [words[i] for i in found.index] == [w for t in texts for w in pattern.findall(t)]


def test_bpe_equals_the_library(spark, docs, rows):
    import tiktoken

    path = tokens.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_id(bpe.encode_decode(docs.unionByName(docs.limit(5)), path, tokens.PATTERN, with_ids=True, with_bytes=True))
    for doc_id, text, *_ in rows:
        ids, r = library.encode_ordinary(text or ""), got[doc_id]
        assert list(r["ids"]) == ids and bytes(r["decoded"]) == (text or "").encode()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert bpe.encode_decode(docs.limit(0), path, tokens.PATTERN).count() == 0


def test_wavelet_matrix_answers():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 513, 3000):
        ids = rng.integers(0, 60, n).astype(np.uint32) * 700
        matrix, keys, known, counts = wavelet.from_file(wavelet.to_file(ids, np.arange(2), np.array([n, 0]), 16))
        assert not matrix.planes.open and (matrix.tokens() == ids).all() and known.all() and keys.tolist() == [0, 1] and counts.tolist() == [n, 0]
        for i in range(0, n, 97):
            assert matrix.access(i) == ids[i] and matrix.rank(int(ids[i]), i) == (ids[:i] == ids[i]).sum()
        for t in (0, 700, 1400, 50000):
            places = np.flatnonzero(ids == t)
            assert matrix.count(t) == len(places) and [matrix.select(t, k) for k in range(len(places))] == places.tolist()


@pytest.mark.parametrize("shard", [8_000_000, 500])
def test_token_files_equal_the_library(spark, docs, rows, shard):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.path("byte_bpe_50k.json"))
    wavelet.SHARD, before = shard, wavelet.SHARD  # travels with the function of each task
    try:
        write = wavelet._writer
        files = docs.select(F.col("doc_id").alias("key"), "text").repartitionByRange(4, "key").sortWithinPartitions("key", "text")

        def small(batches):
            wavelet.SHARD = shard
            wavelet.BLOCK = min(shard, 4_000_000)
            yield from write(tokens.path("byte_bpe_50k.json"), 16, 0)(batches)

        files = common.stored(files.mapInArrow(small, "part int, turn int, first_key long, n_ids long, file binary"), "files")
    finally:
        wavelet.SHARD = before
    assert files.count() > (10 if shard == 500 else 0)
    got, start = by_id(wavelet.read_tokens(files)), 0
    for doc_id, text, *_ in sorted(rows):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        r = got[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert wavelet.read_tokens(wavelet.write_tokens(docs.limit(0), tokens.path("byte_bpe_50k.json"))).count() == 0


def test_token_files_keep_added_tokens(spark):
    from tokenizers import Tokenizer

    path, sign = tokens.path("byte_bpe_50k.json"), "<|endoftext|>"
    library = Tokenizer.from_file(path)
    texts = [f"a {sign} b", sign, f"{sign}{sign}", f" x  {sign}\n\n{sign}y's", f"<|endof{sign}text|>", "plain words", None, "", "<|endoftext |>", f"é{sign} 中 "]
    texts += [f"word{i} {sign * (i % 3)} it's " * (i % 5) for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got, start = by_id(wavelet.read_tokens(wavelet.write_tokens(df, path))), 0
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text
        start += len(ids)


def squeezed(text):
    return "".join(c for c in text or "" if c not in common.SPACES)


def test_exact_dedup_equals_brute_force(spark, docs, rows):
    got = by_id(exact_dedup.exact_dedup(docs.withColumn("kept", F.lit("clash"))))
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(squeezed(text), []).append((-len(text or ""), doc_id))
    for doc_id, text, *_ in rows:
        keep, r = min(groups[squeezed(text)])[1], got[doc_id]
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (keep, len(groups[squeezed(text)]), keep == doc_id, hashlib.sha256(squeezed(text).encode()).hexdigest())
        assert r["text"] == text
    twice = docs.unionByName(docs)
    assert exact_dedup.exact_dedup(twice).where("kept").count() == len(groups)
    odd = spark.createDataFrame([(None, "x", None, None, 1), (None, "x", None, None, 1), (-5, "x ", None, None, 2)], DOCS)
    assert [(r["doc_id"], r["keep_id"]) for r in exact_dedup.exact_dedup(odd).where("kept").collect()] == [(-5, -5)]
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def shingles(text, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in common.SPACES:
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, docs, rows, words, percent):
    got = by_id(minhash.near_duplicates(docs.unionByName(docs.limit(4)).withColumn("n_shingles", F.lit("clash")), words=words, percent=percent))
    sets = {doc_id: shingles(text, words) for doc_id, text, *_ in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    for i in ids:
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(sets[i]), top(i), top(i) == i)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_an_id_with_several_texts_keeps_its_rows(spark):
    rng = random.Random(4)
    base = sentence(rng, 60)
    made = [(5, base), (5, "quite another text of some words"), (5, None), (7, base + " more"), (7, base + " more"), (None, base), (None, base), (2, "x y z"), (9, base)]
    for rows in (made, [r for r in made if r[0] != 9]):
        got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), words=3, percent=85).collect()
        assert sorted((str(r["doc_id"]), r["text"] or "", r["n_shingles"]) for r in got) == sorted((str(i), t or "", len(shingles(t, 3))) for i, t in rows)
        assert {r["component_id"] for r in got if r["doc_id"] is None} == {None} and all(r["kept"] for r in got if r["doc_id"] is None)
        assert len({r["component_id"] for r in got if r["doc_id"] == 5}) == 1


def test_a_hub_is_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HELD", 3)
    rng, base = random.Random(8), [f"w{i}" for i in range(200)]
    made = []
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(200), rng.randrange(6)):
            words[k] = f"n{rng.randrange(10**6)}"
        made.append((i, " ".join(words)))
    got = by_id(minhash.near_duplicates(spark.createDataFrame(made, "doc_id long, text string").repartition(5), words=3, percent=85))
    sets, root = {i: shingles(t, 3) for i, t in made}, {i: i for i, _ in made}
    for _ in made:  # labels spread until they rest
        for i in sets:
            for j in sets:
                if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    root[i] = min(root[i], root[j])
    assert {i: got[i]["component_id"] for i in sets} == root


CLASHES = ("_id", "id", "_longest", "_ahead", "ahead", "_s", "_letters", "letters", "size", "rank", "mark", "norm", "salt", "tag", "part", "name", "none", "at", "virtual_slot", "row", "a", "b", "n", "component", "in_0", "with space", "do.t")
OPERATORS = {
    "sharding": lambda df: sharding.shard_by_bytes(df, 3, slots=16),
    "bpe": lambda df: bpe.encode_decode(df, tokens.path("byte_bpe_50k.tiktoken"), tokens.PATTERN),
    "exact_dedup": exact_dedup.exact_dedup,
    "langid": lambda df: langid.predict(df, langid.train(df)),
    "wavelet": lambda df: wavelet.read_tokens(wavelet.write_tokens(df, tokens.path("byte_bpe_50k.json"))),
    "minhash": minhash.near_duplicates,
    "mixing": mixing.mix,
    "fingerprint": fingerprint.fingerprint_edits,
    "warc": lambda df: warc.read_warc(warc.write_warc(df, "doc_id", "source", "text")),
    "html": lambda df: htmlext.extract(df, "doc_id", "source", "text"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_names_null_ids_repeated_rows_and_empty_tables(spark, name):
    made = [(1, "some text here", "en", "s"), (1, "some text here", "en", "s"), (None, "other", "fr", None), (None, None, None, None), (None, "other", "fr", None), (-(2**63), "lowest", "en", "s"), (2**63 - 1, "highest", "en", "s"), (4, "", "fr", "t"), (4, "unlike", "fr", "t")]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string, source string").repartition(2)
    plain = OPERATORS[name](df)
    clashing = OPERATORS[name](df.withColumns({c: F.lit("mine") for c in CLASHES}))
    assert plain.count() == len(made)
    found = [c for c in plain.columns if c not in ("size", "virtual_slot", "text", "bundle", "frame", "offset")] if name != "sharding" else ["doc_id", "size", "shard", "slot"]
    assert sorted(map(str, clashing.select(*found).collect())) == sorted(map(str, plain.select(*found).collect()))
    own = {"sharding": {"size", "virtual_slot"}, "mixing": {"size"}}.get(name, set())
    if len(clashing.columns) > 20:
        left = [c for c in CLASHES if c not in own]
        assert set(left) <= set(clashing.columns) and {tuple(r) for r in clashing.select(*[f"`{c}`" for c in left]).collect()} == {("mine",) * len(left)}
    assert OPERATORS[name](df.limit(0)).count() == 0
    keys = sorted(str(r[0]) for r in plain.select(next(c for c in ("doc_id", "page_id") if c in plain.columns)).collect())
    assert keys == sorted(str(r[0]) for r in made)


def test_mixing_stays_near_its_targets(spark, docs, rows):
    got = mixing.mix(docs.withColumn("taken", F.lit("clash"))).collect()
    assert {(r["doc_id"], r["taken"]) for r in mixing.mix(docs.repartition(7)).collect()} == {(r["doc_id"], r["taken"]) for r in got}
    sizes, targets = {}, {}
    for r in got:
        sizes.setdefault(r["source"], []).append((r["size"], r["taken"]))
        targets[r["source"]] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    total = {s: sum(x for x, _ in sizes[s]) for s in order}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, free = dict.fromkeys(order, 0.0), set(order)
    left = 1.5 * sum(total.values())
    while True:  # shares of what is left, again and again
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * total[s]}
        if not over:
            break
        for s in over:
            want[s] = 2.0 * total[s]
            left -= want[s]
        free -= over
    want |= {s: weight[s] * level for s in free}
    for s in order:
        assert targets[s] == pytest.approx(want[s])
        assert abs(sum(t for _, t in sizes[s]) - want[s]) <= 2 * max(x for x, _ in sizes[s])
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(spark.createDataFrame([(1, None, None, None, 0)], DOCS)).first()["taken"] == 0


def test_shards_hold_even_bytes(spark, docs, rows):
    got = sharding.shard_by_bytes(docs.withColumn("shard", F.lit("clash")), shards=5, slots=64)
    placed, byte_sums = {}, {}
    for r in got.collect():
        assert r["size"] == len((r["text"] or "").encode()) + 16
        placed.setdefault(r["shard"], []).append(r["slot"])
        byte_sums[r["shard"]] = byte_sums.get(r["shard"], 0) + r["size"]
    assert set(placed) <= set(range(5)) and all(sorted(v) == list(range(len(v))) for v in placed.values())
    assert sum(map(len, placed.values())) == len(rows)
    sized = sharding.with_slot(docs, slots=64)
    stats = sharding.slot_bytes(sized, 64)
    loads = [r["b"] for r in stats.join(sharding.first_map(stats, 5), "virtual_slot").groupBy("shard").agg(F.sum("slot_bytes").alias("b")).collect()]
    assert max(loads) - min(loads) <= stats.agg(F.max("slot_bytes")).first()[0]
    path = common.shared_dir(spark, "map")
    sharding.save_map(sharding.first_map(stats, 5), path)
    sharding.save_map(sharding.grown_map(sharding.load_map(spark, path), stats), path)
    old, new = sharding.load_map(spark, path, 1), sharding.load_map(spark, path)
    moved = old.alias("o").join(new.alias("n"), "virtual_slot").where("o.shard <> n.shard").select("n.shard").distinct().collect()
    assert [r[0] for r in moved] == [5]
    mean = stats.agg(F.sum("slot_bytes")).first()[0] / 5
    even = sharding.first_map(stats, 5, "slot_rows")
    counts = [r["n"] for r in stats.join(even, "virtual_slot").groupBy("shard").agg(F.sum("slot_rows").alias("n")).collect()]
    assert max(counts) - min(counts) <= stats.agg(F.max("slot_rows")).first()[0]
    path = common.shared_dir(spark, "map")
    sharding.save_map(even, path)
    sharding.save_map(sharding.rebalanced_map(sharding.load_map(spark, path), stats, 5), path)
    old, new = sharding.load_map(spark, path, 1), sharding.load_map(spark, path)
    assert new.count() == 64 and {r[0] for r in new.select("version").distinct().collect()} == {2}
    loads = {r["shard"]: r["b"] for r in stats.join(new, "virtual_slot").groupBy("shard").agg(F.sum("slot_bytes").alias("b")).collect()}
    assert max(loads.values()) <= mean + stats.agg(F.max("slot_bytes")).first()[0]
    both = old.alias("o").join(new.alias("n"), "virtual_slot")
    assert 0 < both.where("o.shard <> n.shard").count() < 64
    # What has left a shard would have made it heavier than the mean; a slot that stays was taken in first.
    again = {(r["virtual_slot"], r["shard"]) for r in sharding.rebalanced_map(new, stats, 5).collect()}
    assert len(again) == 64
    assert sharding.shard_by_bytes(docs.limit(0), 3).count() == 0


def test_language_codes_and_held_out_accuracy(spark):
    rng = random.Random(3)
    alphabets = {"aa": "abcdefg", "bb": "hijklmn", "cc": "opqrstu", "dd": "acegikm"}
    made = [(i, " ".join("".join(rng.choice(alphabets[lang]) for _ in range(5)) for _ in range(30)), lang) for i in range(400) for lang in [list(alphabets)[i % 4]]]
    made += [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !", "bb"), (1003, "abcdefg " * 60000, None)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string")
    model = langid.train(df.where("doc_id % 4 <> 2 or doc_id >= 1000").where("doc_id < 300 or doc_id >= 1000"))
    got = by_id(langid.predict(df.withColumn("score", F.lit("clash")), model))
    held = [i for i in range(300, 400)]
    assert np.mean([got[i]["lang_pred"] == made[i][2] for i in held if made[i][2] in model.languages]) > 0.95
    for i in (1000, 1001, 1002):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["ambiguous"]) == ("und", 0.0, False)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    for n in (2, 4, 7, 12):
        codes = langid.codewords(n)
        distance = [(codes[i] != codes[j]).sum() for i in range(n) for j in range(i)]
        assert min(distance) >= 1 and len(codes) == n
    none = langid.train(df.limit(0))
    assert {r["lang_pred"] for r in langid.predict(df, none).collect()} == {"und"}
    one = langid.train(df.where("lang = 'aa'"))
    assert by_id(langid.predict(df, one))[1]["lang_pred"] == "aa"


def cut_bytes(text, scale):
    """Chunks of one text, byte by byte."""
    table = [int(x) >> 32 for x in common.random_words(41, 256)]
    out, a = [], 0
    while a < len(text):
        end = min(len(text), a + scale.most)
        for i in range(a + scale.least, end):  # a border may stand before byte i
            seen = text[max(0, i - scale.seen) : i]
            value = sum(table[c] << (len(seen) - 1 - k) for k, c in enumerate(seen)) & 0xFFFFFFFF
            bits = scale.hard if i - a <= scale.normal else scale.easy
            if value >> 32 - bits == 0:
                end = i
                break
        out.append(text[a:end])
        a = end
    return out


def shared_bytes(one, other):
    """The share of the bytes of ``one`` whose chunks ``other`` has, too."""
    scale = fingerprint.FINE if max(len(one), len(other)) <= fingerprint.SHORT else fingerprint.COARSE
    own, theirs = Counter(), Counter()
    for counts, text in ((own, one), (theirs, other)):
        for chunk in cut_bytes(text, scale):
            counts[chunk] += len(chunk)
    return sum(min(n, theirs[c]) for c, n in own.items()) / sum(own.values()) if own and theirs else float(not own and not theirs)


def test_chunks_are_those_of_a_loop_over_bytes():
    rng = random.Random(9)
    texts = [b"", b"a", b"x" * 700, sentence(rng, 300).encode(), "é中😀 ".encode() * 90] + [bytes(rng.randrange(256) for _ in range(rng.randrange(400))) for _ in range(30)]
    for scale in (fingerprint.COARSE, fingerprint.FINE):
        raw, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        starts, ends, counts = fingerprint.borders(raw, offsets, scale)
        # A gear hash sees the text before, too: no border depends on it beyond the bytes that it sees.
        alone = [fingerprint.borders(np.frombuffer(t, np.uint8), np.array([0, len(t)]), scale) for t in texts if t]
        assert [e - s for s, e in zip(starts, ends)] == [e - s for x in alone for s, e in zip(x[0], x[1])] or scale.seen > scale.least
        for t, (s, e, n) in zip([t for t in texts if t], alone):
            assert [t[a:b] for a, b in zip(s, e)] == cut_bytes(t, scale)


def test_fingerprints_equal_brute_force(spark, docs, rows):
    got = by_id(fingerprint.fingerprint_edits(docs))
    ordered = sorted(rows, key=lambda r: -r[0])
    by_text = {}
    for (doc_id, text, *_), (_, following, *_) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following, r = text or "", following or "", got[doc_id]
        n = len(text) // 3
        changed = text[: len(text) - n] + following[:n]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(shared_bytes(text.encode(), changed.encode()))
        assert r["near_next"] == pytest.approx(shared_bytes(text.encode(), following.encode()))
        own, other = fingerprint.read(r["fingerprint"]), fingerprint.read(r["edited_fingerprint"])
        assert r["near_edited"] == fingerprint.containment(own, other) and sum(own.coarse.values()) == len(text.encode())
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    long = got[rows[7][0]]
    assert 0.6 < long["near_edited"] < 0.72 and long["near_next"] == 0 and len(long["fingerprint"]) < 0.3 * long["n_chars"]
    shifted = fingerprint.fingerprints([rows[7][1].encode(), b"some words before " + rows[7][1].encode()])
    assert fingerprint.containment(*shifted) > 0.99
    alone = fingerprint.fingerprint_edits(docs.limit(1)).first()
    assert alone["near_next"] == 1.0
    assert fingerprint.fingerprint_edits(docs.limit(0)).count() == 0
    with_null = docs.limit(3).unionByName(spark.createDataFrame([(None, "last", None, None, 4)], DOCS))
    assert fingerprint.fingerprint_edits(with_null).count() == 4


def test_short_texts_keep_what_an_edit_leaves(spark):
    rng = random.Random(2)
    made = [(i, sentence(rng, 6)[:40]) for i in range(40)]
    got = fingerprint.fingerprint_edits(spark.createDataFrame(made, "doc_id long, text string").repartition(3)).collect()
    assert np.mean([r["near_edited"] for r in got]) > 0.5 and min(r["near_edited"] for r in got) > 0.2
    assert np.mean([r["near_next"] for r in got]) < 0.2


def test_archives_can_be_sought_and_read_whole(spark):
    import zstandard

    html = "<p>" + "x" * 200 + "</p>"
    pages = [(5, "http://a/", html), (2, "http://b/", html), (9, None, html), (3, "u", "short"), (4, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", "é" * 400_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    bundles = warc.write_warc(df)
    got = by_id(warc.read_warc(bundles), "page_id")
    for page_id, url, text in pages:
        raw, r = (text or "").encode(), got[page_id]
        refers = 2 if text == html and page_id != 2 else None
        assert (r["payload_bytes"], r["payload_digest"], r["refers_to"]) == (len(raw), hashlib.sha256(raw).hexdigest(), refers)
        assert r["record_type"] == ("response" if refers is None else "revisit") and r["url"] == url
    for row in bundles.collect():
        data = bytes(row["data"])
        plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert plain.count(b"WARC/1.1\r\n") == len(row["records"])
        for place in row["records"]:
            headers, block = warc.read_record(data, place["frame"], place["offset"])
            assert headers["WARC-Record-ID"] == f"<urn:page:{place['page_id']}>"
            if headers["WARC-Type"] == "response":
                assert hashlib.sha256(block.split(b"\r\n\r\n", 1)[1]).hexdigest() == got[place["page_id"]]["payload_digest"]
    sought = by_id(warc.find_records(bundles, spark.createDataFrame([(5,), (8,), (3,), (99,), (5,)], "page_id long")), "page_id")
    assert sorted(sought) == [3, 5, 8] and sought[5]["refers_to"] == 2 and sought[5]["payload"] is None
    assert (bytes(sought[8]["payload"]), bytes(sought[3]["payload"])) == (("é" * 400_000).encode(), b"short")
    assert warc.read_warc(warc.write_warc(df.limit(0))).count() == 0


PAGE = """<html><head><title>{t}</title></head><body><nav><a href=x>Home {t}</a></nav><div class="cookie-notice">We use cookies {t}</div>
<div class="content"><h2>{t}</h2><div class="legal">All rights of this site are kept.</div><p>Text of <i>{t}</i> &amp; more &eacute;.<br>Line<p>Second {t}<script>var a="<p>no</p>"</script></div>
<form><label>Name {t}</label></form><section id="comments"><p>Nice {t}</p></section><aside>side {t}</aside><footer>foot {t}</footer></body></html>"""


def test_wrappers_tell_template_from_content(spark):
    pages = [(i, f"http://h{i % 2}.example/{i}", PAGE.format(t=f"title{i}")) for i in range(12)]
    pages += [(20, None, None), (21, "http://x/", ""), (22, "http://x/", "<div>" * 500 + "deep <b>text"), (23, "http://y/", "<article><p>One &amp two<p>Three</article><p>out"), (24, "http://y/", "<p>cut off <a hr"),
        (25, "http://z/", '<div class="has-sidebar"><div class="sidebar"><p>side</div><main><div class="post-header"><h1>Head</h1></div><p>Body</p><div id="comments"><article><p>Comment</article></div></main></div>')]
    got = by_id(htmlext.extract(spark.createDataFrame(pages, "page_id long, url string, html string")), "page_id")
    for i in range(12):
        assert got[i]["text"] == f"title{i}\nText of title{i} & more é. Line\nSecond title{i}"
        assert got[i]["n_chars"] == len(got[i]["text"])
    assert [got[i]["text"] for i in range(20, 26)] == ["", "", "deep text", "One & two\nThree", "cut off", "Head\nBody"]
    size, pairs = htmlext.match(["a", 0, [["b", 1, []], ["c", 2, []]]], ["a", 0, [["x", 1, []], ["b", 2, []], ["c", 3, []]]])
    assert size == 3 and len(pairs) == 3
    assert htmlext.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_copies_of_an_article_are_no_template(spark):
    page = "<html><head><title>same</title></head><body><div><p>The same article everywhere.</p></div></body></html>"
    df = spark.createDataFrame([(i, "http://copies.example/", page) for i in range(30)], "page_id long, url string, html string")
    assert {r["text"] for r in htmlext.extract(df).collect()} == {"The same article everywhere."}


def test_copies_in_several_shapes_are_no_template(spark):
    text = "The same article in every shape."
    more = ["", "<table><tr><td></td></tr></table>", "<ul><li></li></ul>", "<section></section>"]
    bodies = [f"<html><head><title>same</title></head><body><div><p>{text}</p></div>{x}</body></html>" for x in more]
    fixed = "<html><head><title>{t}</title></head><body><div><p>Fixed line.</p><h2>{t}</h2></div>{x}</body></html>"
    pages = [(i, "http://copies.example/", bodies[i % 4]) for i in range(12)]
    pages += [(20 + i, "http://three.example/", fixed.format(t=f"t{i}", x=more[i])) for i in range(3)]
    pages += [(30 + i, "http://two.example/", fixed.format(t=f"t{i % 2}", x=more[i % 4])) for i in range(8)]
    got = by_id(htmlext.extract(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)), "page_id")
    assert {got[i]["text"] for i in range(12)} == {text}
    assert [got[20 + i]["text"] for i in range(3)] == ["t0", "t1", "t2"]
    assert [got[30 + i]["text"] for i in range(8)] == [f"Fixed line.\nt{i % 2}" for i in range(8)]


def texts_of(page):
    root, _, marked = htmlext.parse(page)
    return [t for t, _, _ in htmlext.blocks(root, marked)[0]]


@pytest.mark.parametrize("around", ["<div>", "<font>", "<div><font>", "<section><span class=x>"])
@pytest.mark.parametrize("times", [1, 59, 119, 120, 121, 300, 20000])
def test_nesting_has_no_bound(around, times):
    deep = around * times
    assert texts_of(f"<p>before</p>{deep}<nav>Menu<p>item</p></nav><main><p>In <b>bold</b> and<p>more<div>inner</div>tail<aside>side</aside>end</main>out") == ["In bold and", "more", "inner", "tail", "end"]
    assert texts_of(f"{deep}<nav>Menu<p>item</p></nav><form><div>name</div></form><p>One<br>line</p>two<footer>foot</footer>") == ["One line", "two"]
    assert texts_of(f"<div id=a>{deep}<footer><p>foot</p></footer>{'</div>' * times}</div><p>last") == ["last"]


def test_pages_of_many_shapes(spark):
    pages = [(i, f"http://h{i % 2}.example/{i}", PAGE.format(t=f"é&amp;title{i}") + "<div><b>x</b></div><table></table>" * (i % 7)) for i in range(60)]
    pages += [(100, None, None), (101, None, None), (101, None, None), (102, "http://h0.example/", ""), (None, "http://y/", "<p>cut off <a hr")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    rows = htmlext.extract(df).collect()
    assert len(rows) == len(pages) and {r["n_chars"] == len(r["text"]) for r in rows} == {True}
    for r in rows:
        if r["page_id"] is not None and r["page_id"] < 60:
            lines = r["text"].split("\n")
            assert lines[:3] == [f"é&title{r['page_id']}", f"Text of é&title{r['page_id']} & more é. Line", f"Second é&title{r['page_id']}"]


def tree(rng, depth):
    return [rng.choice("abc"), 0, [tree(rng, depth - 1) for _ in range(rng.randrange(4) if depth else 0)]]


def largest(a, b):
    """Simple tree matching as it is defined, pair by pair."""
    if a[0] != b[0]:
        return 0
    best = {}
    for i in range(len(a[2]) + 1):
        for j in range(len(b[2]) + 1):
            best[i, j] = max(best[i - 1, j], best[i, j - 1], best[i - 1, j - 1] + largest(a[2][i - 1], b[2][j - 1])) if i and j else 0
    return best[len(a[2]), len(b[2])] + 1


def test_matching_equals_brute_force(monkeypatch):
    rng = random.Random(5)
    for grid in (htmlext.GRID, 0):
        monkeypatch.setattr(htmlext, "GRID", grid)
        for _ in range(300):
            a, b = tree(rng, 3), tree(rng, 3)
            size, pairs = htmlext.match(a, b)
            assert size == len(pairs) and (size == largest(a, b) if grid else size <= largest(a, b))
            assert all(x[0] == y[0] for x, y in pairs)
            inner = {id(y): x for x, y in pairs}
            for x, y in pairs:  # children keep their order and their parents
                at = [next(i for i, c in enumerate(x[2]) if c is inner[id(d)]) for d in y[2] if id(d) in inner]
                assert at == sorted(set(at))


def test_long_lists_of_siblings_take_seconds():
    def page(n, extra):
        rows = [["h2" if i % 2 else "p", i, []] for i in range(n)]
        rows[n // 2 : n // 2] = [["table", n + k, []] for k in range(extra)]
        return ["div", -1, rows]

    began = time.monotonic()
    assert htmlext.match(page(20000, 0), page(19000, 0))[0] == 19001
    assert htmlext.match(page(20000, 3), page(19990, 1))[0] == 19992
    htmlext.match(["div", -1, [["p" if i % 3 else "h2", i, []] for i in range(20000)]], page(20000, 0))
    wrapper, other = htmlext._facts(page(20000, 0), {}), htmlext._facts(page(20000, 2), {})
    htmlext.merge(wrapper, other)
    assert len(wrapper[2]) == 20002 and time.monotonic() - began < 20


def siblings(rng, n):
    """A list of ``n`` children of few kinds, none of which is there once."""
    kinds = [["p", 0, []], ["h2", 0, []], ["ul", 0, [["li", 0, []]]], ["ul", 0, [["li", 0, [["a", 0, []]]], ["li", 0, []]]], ["div", 0, [["p", 0, []], ["h3", 0, []]]], ["div", 0, [["h3", 0, []], ["p", 0, []], ["b", 0, []]]]]
    return ["div", 0, [json.loads(json.dumps(rng.choice(kinds))) for _ in range(n)]]


def largest_of_lists(a, b):
    """``largest`` for long lists of few kinds."""
    named = [[json.dumps(c) for c in x[2]] for x in (a, b)]
    both = {(x, y): largest(json.loads(x), json.loads(y)) for x in set(named[0]) for y in set(named[1])}
    above = [0] * (len(named[1]) + 1)
    for x in named[0]:
        row = [0]
        for j, y in enumerate(named[1]):
            row.append(max(above[j + 1], row[j], above[j] + both[x, y]))
        above = row
    return above[-1] + 1


@pytest.mark.parametrize("n", [5, 40, 60, 520, 900])
def test_the_largest_match_is_found_however_long_the_lists_are(n, monkeypatch):
    rng = random.Random(n)
    a, b = siblings(rng, n), siblings(rng, n)
    size, pairs = htmlext.match(a, b)
    assert size == len(pairs) == largest_of_lists(a, b)
    assert htmlext.match(a, ["div", 0, [["table", 0, []] for _ in range(n)]])[0] == 1
    for grid, cells in ((0, 16_000_000), (0, 50), (10**9, 50)):  # either way of making the table, in parts or whole
        monkeypatch.setattr(htmlext, "GRID", grid)
        monkeypatch.setattr(htmlext, "CELLS", cells)
        assert {(id(x), id(y)) for x, y in htmlext.match(a, b)[1]} == {(id(x), id(y)) for x, y in pairs}


def test_texts_do_not_depend_on_how_long_pages_are(spark):
    """What the site says on two pages of one shape and a third of another is template, with few siblings around it as with many."""
    pages, wanted = [], {}
    for h, n in enumerate((6, 600)):
        for i in range(3):
            said = [f"<h2>Head {h} {i} {k}</h2><p>Text {h} {i} {k}</p>" for k in range(n)]
            for k in (n // 3, 2 * n // 3):
                said[k] += "<ul><li>Said by the site</li></ul>"
            notes = "<section>One {0}</section><hr><section>Two {0}</section><hr>".format(i)
            body = notes + "".join(said) if i < 2 else "".join(said) + notes
            pages.append((10 * h + i, f"http://h{h}.example/{i}", f"<html><head><title>{h} {i}</title></head><body>{body}</body></html>"))
            own, shown = [x for k in range(n) for x in (f"Head {h} {i} {k}", f"Text {h} {i} {k}")], [f"One {i}", f"Two {i}"]
            wanted[10 * h + i] = "\n".join(shown + own if i < 2 else own + shown)
    got = by_id(htmlext.extract(spark.createDataFrame(pages, "page_id long, url string, html string")), "page_id")
    for k, text in wanted.items():
        assert got[k]["text"] == text, k


def test_words_alone_take_no_article_away():
    assert texts_of('<div class="social-history"><p>A history</p></div><p class="notice-board">On the board</p><table class="tags"><tr><td>Tags of prose</table>') == ["A history", "On the board", "Tags of prose"]
    assert texts_of('<ul class="tags"><li><a href=x>one</a><li><a href=y>two</a></ul><div class="social-links"><a href=z>share this</a></div><p>Body') == ["Body"]
    assert texts_of('<div class="comment-list"><p>Nice</div><div id="site-header"><p>Site</div><div class="cookie-notice">We</div><div class=adBox>Buy</div><p>Body') == ["Body"]
    assert texts_of("<main></main><p>Outside") == ["Outside"]
    assert texts_of("<main> <nav>Menu</nav></main><div><p>Outside</div>") == ["Outside"]


LONG = "A sentence of the story that goes on for a while, with {t} in it and no end in sight. " * 3
#: Bodies around an article, and what stays of them.
HOSTS = {
    "form": ('<form id="aspnetForm"><nav>Menu {t}</nav><div class="story"><h1>{t}</h1><p>' + LONG + '</p></div><input name=q><button>Go</button></form>', "{t}\n" + LONG),
    "teaser": ('<div class="story"><h1>{t}</h1><p>' + LONG + '</p></div><div class="more"><article class="card"><p><a href=x>Read also {t}</a></p></article></div>', None),
    "comments": ('<div class="story"><h1>{t}</h1><p>' + LONG + '</p></div><div class="post-comments"><div class="user-comment"><b>Ann {t}</b><p>' + LONG + LONG + '</p></div></div><div class="google-ad">Buy {t}</div>', "{t}\n" + LONG),
    "reply": ('<nav>Menu {t}</nav><div class="reply"><p>' + LONG + "</p></div>", LONG),
    "alert": ('<nav>Menu {t}</nav><div class="alert"><p>' + LONG + "</p></div>", LONG),
    "login": ('<nav>Menu {t}</nav><div id="login"><p>' + LONG + "</p></div>", LONG),
    "small boxes": ('<div class="alert">Note {t}</div><form>Search {t}</form><dialog open>Accept {t}?</dialog><div class="story"><p>' + LONG + '</p></div><div id="respond">Say {t}</div>', LONG),
    "dialog": ("<dialog open><p>" + LONG + "</p></dialog><footer>{t}</footer>", LONG),
    "hidden": ('<p>' + LONG + '</p><p style="color: red; display:none">hidden {t}</p><div style="visibility : hidden"><p>too {t}</div>', LONG),
    "standfirst": ("<header><p>{t} today</p><h1>{t}</h1><p>What {t} is about</p></header><div><p>" + LONG + "</p></div>", "{t}\nWhat {t} is about\n" + LONG),
    "marked": ('<main><p>' + LONG + '</p></main><div><p>Not of {t}</p></div>', LONG),
    "state": ('<div class="has-comments with-ads"><h2>{t}</h2><p>' + LONG + "</p></div>", "{t}\n" + LONG),
}


def test_boxes_are_judged_by_what_they_hold(spark):
    """Whole hosts, made by hand, against what a reader would take out of them."""
    pages, wanted = [], {}
    for h, (name, (body, text)) in enumerate(HOSTS.items()):
        for i in range(6):
            title = f"title {h} {i}"
            pages.append((10 * h + i, f"http://{name.replace(' ', '-')}.example/{i}", f"<html><head><title>{title}</title></head><body>{body.format(t=title)}</body></html>"))
            wanted[10 * h + i] = None if text is None else "\n".join(" ".join(line.split()) for line in text.format(t=title).split("\n"))
    got = by_id(htmlext.extract(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)), "page_id")
    for k, text in wanted.items():
        if text is None:
            assert got[k]["text"].startswith(f"title {k // 10} {k % 10}\nA sentence of the story")
        else:
            assert got[k]["text"] == text, (k, list(HOSTS)[k // 10])


def test_a_headline_in_the_header_stays_if_it_varies(spark):
    page = "<html><head><title>{t}</title></head><body><header><h1><a href=/>{h}</a></h1><p>Motto</p></header><div><p>Text of {t}.</p></div></body></html>"
    pages = [(i, "http://own.example/", page.format(t=f"t{i}", h=f"Head {i}")) for i in range(5)]
    pages += [(10 + i, "http://site.example/", page.format(t=f"t{i}", h="The site")) for i in range(5)]
    pages += [(20 + i, "http://few.example/", page.format(t=f"t{i}", h=f"Head {i}")) for i in range(2)]
    got = by_id(htmlext.extract(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)), "page_id")
    assert [got[i]["text"] for i in range(5)] == [f"Head {i}\nText of t{i}." for i in range(5)]
    assert [got[10 + i]["text"] for i in range(5)] == [f"Text of t{i}." for i in range(5)]
    assert [got[20 + i]["text"] for i in range(2)] == [f"Text of t{i}." for i in range(2)]


def test_what_an_article_is_filed_under_excludes_nothing():
    text = texts_of
    for classes in ("post category-comment tag-search", "category-social", "hentry product_cat-widgets post_tag-ads", "Tag-Newsletter type-post"):
        assert text(f"<div>out</div><article class='{classes}'><h1>Head</h1><p>Body</article>") == ["Head", "Body"]
        assert text(f"<div role=main class='{classes}'><p>Body</div>") == ["Body"]
    assert text("<p>Body</p><article class='comment'><p>Nice</article>") == ["Body"]
    assert text("<p>Body</p><article class='comment-body category-news'><p>Nice</article>") == ["Body"]


def test_pipeline_keeps_its_columns_and_decisions(spark, docs, rows):
    import corpus_pipeline

    df = docs.select(*[F.col(c) for c in ("doc_id", "text", "lang", "source", "n_chars")])
    previous = df
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, previous, "")
        if name != "bpe":
            assert result.columns == df.columns, name
        previous = common.stored(result, name)
    assert previous.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert previous.count() > 0
    kept = {r[0] for r in previous.select("doc_id").collect()}
    assert not kept & {r[0] for r in rows if not any(c.isalpha() for c in r[1] or "")}
