"""The registered queries of the operators, at production settings over whole tables."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.llm import (
    bm25_leaks,
    byte_bpe,
    cover_topk,
    covering_simhash,
    hyper_language,
    license_scan,
    line_chunks,
    norm_buckets,
    packing,
    suffix_repeats,
    trie_join,
    warc,
    whitening,
)
from zonalis.sources.session import shared_folder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """Rows that language profiles never learn from."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1


def op1_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_repeats.repeated_spans(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_line_passages(spark: SparkSession, folder: str) -> DataFrame:
    return line_chunks.dedup_line_passages(table(spark, folder, "documents"))


def op2_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return line_chunks.dedup_line_chunks(table(spark, folder, "documents"))


def op2_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    return line_chunks.dedup_line_runs(table(spark, folder, "documents"))


def op3_bm25_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return bm25_leaks.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    place = f"{shared_folder(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"
    warc.write_arc(table(spark, folder, "pages"), f"{place}/arc")
    warc.convert_archives(spark, f"{place}/arc", f"{place}/warc")
    records = warc.load_warc(spark, f"{place}/warc")
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to")).distinct()
    return records.join(responses, "refers_to_record", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack_sequences(table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN)
    return packed.select(
        "shard", "sequence", "doc_ids", "offsets", "cu_seqlens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("positions", 256).alias("positions_sha256"))


def op6_hyper_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    profiles = hyper_language.fit_prototypes(docs.filter(~F.coalesce(held_out(), F.lit(True))))
    return hyper_language.predict_languages(docs, profiles).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, folder, "documents"))


def op8_cover_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return cover_topk.exact_topk(vectors, vectors.filter("vec_id % 20 = 0"))


def op9_trie_join(spark: SparkSession, folder: str) -> DataFrame:
    return trie_join.ngram_components(table(spark, folder, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    encoded = byte_bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(table(spark, folder, "documents"))


def op11_norm_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return norm_buckets.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_covering_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return covering_simhash.near_duplicates(table(spark, folder, "documents"))


QUERIES = {
    "op1_suffix_repeats": op1_suffix_repeats,
    "op2_line_passages": op2_line_passages,
    "op2_line_chunks": op2_line_chunks,
    "op2_line_runs": op2_line_runs,
    "op3_bm25_leaks": op3_bm25_leaks,
    "op4_warc": op4_warc,
    "op5_packing": op5_packing,
    "op6_hyper_language": op6_hyper_language,
    "op7_license_scan": op7_license_scan,
    "op8_cover_topk": op8_cover_topk,
    "op9_trie_join": op9_trie_join,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_norm_buckets": op11_norm_buckets,
    "op12_whitening": op12_whitening,
    "op13_covering_simhash": op13_covering_simhash,
}

ORACLES: dict[str, str] = {
    "op2_line_chunks": f"""
WITH lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
hashed AS (SELECT *, list_transform(ls, lambda x: CAST('0x' || substr(md5(x), 1, 8) AS BIGINT)
                                                  % {line_chunks.MODULUS}) AS hs FROM lines),
cut AS (SELECT doc_id, ls, list_filter(range(1, len(hs) + 1), lambda i: i = len(hs) OR
          (((CASE WHEN i > 1 THEN hs[i - 1] ELSE 0 END) * {line_chunks.BASE} + hs[i]) % {line_chunks.MODULUS})
          % {line_chunks.DIVISOR} = 0) AS ends FROM hashed),
bounds AS (SELECT doc_id, ls, unnest(ends) AS e, unnest(list_concat([0], ends[:-2])) AS s,
                  unnest(range(0, len(ends))) AS no FROM cut),
chunks AS (SELECT doc_id, no, e - s AS n, array_to_string(ls[s + 1:e], chr(10)) AS chunk FROM bounds),
first AS (SELECT chunk, min({{'d': doc_id, 'n': no}}) AS f FROM chunks WHERE n >= {line_chunks.MIN_LINES}
          GROUP BY chunk),
marked AS (SELECT c.*, coalesce(c.n >= {line_chunks.MIN_LINES} AND {{'d': c.doc_id, 'n': c.no}} <> f.f, false) AS gone
           FROM chunks c LEFT JOIN first f ON c.chunk = f.chunk AND c.n >= {line_chunks.MIN_LINES}),
kept AS (SELECT doc_id, coalesce(string_agg(chunk, chr(10) ORDER BY no) FILTER (NOT gone), '') AS kept_text,
                count(*) FILTER (gone) AS n_removed, coalesce(sum(n) FILTER (gone), 0)::BIGINT AS removed_lines
         FROM marked GROUP BY doc_id)
SELECT d.doc_id, k.kept_text, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.removed_lines, 0) AS removed_lines
FROM documents d LEFT JOIN kept k USING (doc_id)""",
    "op2_line_runs": """
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS l, unnest(range(0, len(ls))) AS no FROM split),
pairs AS (SELECT *, lead(l) OVER (PARTITION BY doc_id ORDER BY no) AS l2 FROM lines),
first AS (SELECT l, l2, min({'d': doc_id, 'n': no}) AS f FROM pairs WHERE l2 IS NOT NULL GROUP BY l, l2),
again AS (SELECT doc_id, no FROM pairs p JOIN first USING (l, l2) WHERE doc_id <> f.d OR no - f.n >= 2),
gone AS (SELECT doc_id, no FROM again UNION SELECT doc_id, no + 1 FROM again),
marked AS (SELECT p.*, g.no IS NOT NULL AS gone FROM pairs p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.no = g.no),
begun AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY no), false) AS begins FROM marked),
kept AS (SELECT doc_id, coalesce(string_agg(l, chr(10) ORDER BY no) FILTER (NOT gone), '') AS kept_text,
                count(*) FILTER (begins) AS n_removed, count(*) FILTER (gone) AS removed_lines FROM begun GROUP BY doc_id)
SELECT d.doc_id, k.kept_text, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.removed_lines, 0) AS removed_lines
FROM documents d LEFT JOIN kept k USING (doc_id)""",
    "op4_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
kept AS (SELECT html, max(page_id) AS keeper FROM p WHERE strlen(html) >= {warc.REVISIT_BYTES} GROUP BY html)
SELECT page_id, strlen(p.html)::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN kept ON p.html = kept.html""",
    "op8_cover_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20""",
    "op11_norm_buckets": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
totals AS (SELECT count(*) FILTER (len(ts) > 0) AS nd, sum(len(ts))::BIGINT AS l FROM d),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
df AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
       FROM tf, totals GROUP BY t),
asked AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
m AS (SELECT r, doc_id, 10 + (90 * len(ts)::BIGINT * nd) // l AS m FROM d, totals WHERE len(ts) > 0),
scores AS (SELECT item_id, text, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
           FROM asked JOIN tf USING (t) JOIN df USING (t) JOIN m USING (r) GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER)
                     AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
ORACLES["op2_line_passages"] = ORACLES["op2_line_runs"]  # the rule is the same, the way is not
