"""The registered queries over the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, fingerprint, htmlext, langid, minhash, mixing, repeats, runs, sharding, warc, wavelet, whitening
from .common import WORD, ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the archives."""
    bundles = warc.write_warc(_table(spark, sf_dir, "pages"))
    return warc.read_warc(bundles).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH t AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest, min(page_id) OVER (PARTITION BY h) AS first FROM t)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to FROM g
"""


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards of nearly equal bytes."""
    docs = _table(spark, sf_dir, "documents").withColumn("text_crc32", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))
    out = sharding.shard_by_bytes(docs, shards=40)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "version"
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and its text decoded from them, as digests."""
    docs = _table(spark, sf_dir, "documents")
    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy that stays."""
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm, length(coalesce(text, '')) AS n FROM documents),
g AS (SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""


def held_out(key: str = "doc_id") -> Column:
    """The documents that nothing is learned from."""
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(4)) == 2


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's predicted language."""
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
    model = langid.train(docs.where("not held_out"))
    return langid.predict(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return htmlext.extract(_table(spark, sf_dir, "pages"))


def op7_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the token files, its number of ids and their checksum."""
    files = wavelet.write_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return wavelet.read_tokens(files)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate component."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, words=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


OP8_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]) WHEN len(w) > 0 THEN [w] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 185 * common >= 85 * (x.n + y.n)),
e AS (SELECT a AS u, b AS v FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS reached FROM documents UNION SELECT r.node, e.v FROM r JOIN e ON e.u = r.reached),
k AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, k.component_id, d.doc_id = k.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN k ON k.node = d.doc_id
"""


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = rf"""
WITH t AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source IS NULL, source) - 1) AS turn FROM t GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][turn % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS most FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::BIGINT * 1.5::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY most / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT *, min_by(level, (most / weight, turn)) FILTER (WHERE weight * level <= most) OVER () AS final FROM l),
a AS (SELECT source, source_size, least(most, coalesce(weight * final, most)) AS target FROM f),
q AS (SELECT t.doc_id, t.source, t.size, a.source_size, a.target, row_number() OVER (PARTITION BY t.source ORDER BY t.size, t.doc_id % 64, t.doc_id) AS rank, count(*) OVER (PARTITION BY t.source) AS n,
        CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0.0::DOUBLE END AS each
      FROM t JOIN a ON t.source IS NOT DISTINCT FROM a.source),
r AS (SELECT *, CASE WHEN 2 * rank > n THEN 2 * (n - rank) + 1 ELSE 2 * rank END AS spot FROM q),
o AS (SELECT k, (k + {mixing.offset(7)!r}::DOUBLE) / {mixing.OFFSETS}::DOUBLE AS u FROM range({mixing.OFFSETS}) x(k)),
c AS (SELECT source, target, k, u, sum((floor(spot * each + u) - floor((spot - 1) * each + u)) * size) AS words FROM r, o GROUP BY ALL),
b AS (SELECT source, arg_min(u, (abs(words - target), k)) AS u FROM c GROUP BY source)
SELECT r.doc_id, r.size, r.source_size, r.target,
  (least(floor(spot * each + u) - floor((spot - 1) * each + u), 2) * size)::BIGINT AS taken FROM r JOIN b ON r.source IS NOT DISTINCT FROM b.source
"""


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and how near that and the next document are."""
    return fingerprint.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op11_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that a 100-byte string covers which also starts earlier."""
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


def _periodic(docs: DataFrame) -> DataFrame:
    """Documents, of whose texts a tenth is made periodic from some word on: with h = crc32(doc_id), g = h div 10 and n words, from word
    a = g mod n on the words repeat every p = 1 + (n - a) div (3 + g mod 8)."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    # Columns of their own, so that words are taken once.
    docs = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    docs = docs.withColumn("n", F.coalesce(F.size("words"), F.lit(0))).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    docs = docs.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    changed = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), again), F.lit(1), F.col("n"))
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs of words, and its text without what they repeat."""
    return runs.periodic_runs(_periodic(_table(spark, sf_dir, "documents")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector in whitened coordinates."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_warc": op1_warc, "op2_sharding": op2_sharding, "op3_bpe": op3_bpe, "op4_exact_dedup": op4_exact_dedup, "op5_langid": op5_langid, "op6_html": op6_html, "op7_wavelet": op7_wavelet, "op8_minhash": op8_minhash, "op9_mixing": op9_mixing, "op10_fingerprint": op10_fingerprint, "op11_suffix_array": op11_suffix_array, "op12_periodic_runs": op12_periodic_runs, "op13_whitening": op13_whitening}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1_SQL, "op4_exact_dedup": OP4_SQL, "op8_minhash": OP8_SQL, "op9_mixing": OP9_SQL}
