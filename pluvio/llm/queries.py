"""The registered queries of this subpackage and the SQL of those that SQL can express."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.llm import (exact_dedup, hard_negatives, language_id, minhash, mixing, packing, periodic_runs, secrets, sharding,
                        suffix_dedup, url_filter, vector_dedup, warc_audit)
from pluvio.llm.common import store

#: Rules of the URL query: (verdict, host, path). Fixed values.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark, sf_dir):
    """Near-duplicate components at three words and 85 percent."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), k=3, percent=85)


def op2_exact_dedup(spark, sf_dir):
    """Groups of documents whose texts are equal but for white space."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_groups(docs, keep_text=False)


def op3_secret_scan(spark, sf_dir):
    """Base and linked spans of every document."""
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(secrets.joined(secrets.base_only(F.col("spans"))), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"), "n_linked")


def op4_embedding_near_dedup(spark, sf_dir):
    """Links and components of embeddings with equal labels."""
    return vector_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op5_sharding(spark, sf_dir):
    """Eight shards whose row counts differ by one at most."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_crc32").asc(), F.col("size").asc()]
    return (sharding.assign_shards(docs, 8, order).withColumn("law", F.lit("rows"))
            .withColumn("grown_shard", F.lit(None).cast("int")))


def op6_language_id(spark, sf_dir):
    """Predicted language of every document."""
    return (language_id.identify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
            .select("doc_id", "held_out", "lang_pred", "score"))


def op7_mixing(spark, sf_dir):
    """Words that the mix takes of each document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text", mixing.word_count(F.col("text")).alias("size"))
    mix, rows = mixing.fit_stored(mixing.with_draws(docs))
    return (mixing.apply(rows, mix, F.col("size"), F.col("draw"))
            .select("doc_id", "size", "source_size", "target", "taken", "copies", "rate"))


def _replicas(spark, sf_dir):
    """Stand-in input: the pages as WARC records of files of 4,096 pages, and a second
    replica in which some records are damaged, moved or lost."""
    pages = _table(spark, sf_dir, "pages")
    rows = pages.select(F.col("page_id").alias("record_id"),
                        F.concat(F.lit("crawl-"), F.expr("page_id div 4096").cast("string"), F.lit(".warc")).alias("file"),
                        warc_audit.record_bytes(F.col("page_id"), F.col("url"), F.col("html")).alias("payload"))
    before = Window.partitionBy("file").orderBy("record_id").rowsBetween(Window.unboundedPreceding, -1)
    first = rows.withColumn("offset", F.coalesce(F.sum(F.octet_length("payload")).over(before), F.lit(0)).cast("long"))
    rid = F.col("record_id")
    second = (first.filter(rid % 499 != 7)
              .withColumn("payload", F.when(rid % 211 == 5, F.encode(F.concat(F.decode("payload", "UTF-8"), F.lit("~")), "UTF-8"))
                          .otherwise(F.col("payload")))
              .withColumn("offset", F.when(rid % 997 == 3, F.col("offset") + 1).otherwise(F.col("offset"))))
    return first, second


def _replica_leaves(spark, sf_dir):
    """The leaves of ``_replicas``: every record, and its damaged form, is hashed where it
    is read, and offsets are sums of lengths alone."""
    pages = _table(spark, sf_dir, "pages")
    rid, payload = F.col("record_id"), warc_audit.record_bytes(F.col("page_id"), F.col("url"), F.col("html"))
    bad = F.concat(payload, F.lit(b"~"))
    rows = store(pages.select(
        F.col("page_id").cast("long").alias("record_id"),
        F.coalesce(F.concat(F.lit("crawl-"), F.expr("page_id div 4096").cast("string"), F.lit(".warc")), F.lit("")).alias("file"),
        F.octet_length(payload).cast("long").alias("length"), F.sha2(payload, 256).alias("digest"),
        F.when(F.col("page_id") % 211 == 5, F.sha2(bad, 256)).alias("bad")))
    before = Window.partitionBy("file").orderBy("record_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    first = store(rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")))
    second = (first.filter(rid % 499 != 7)
              .withColumn("length", F.col("length") + F.col("bad").isNotNull().cast("long"))
              .withColumn("digest", F.coalesce("bad", "digest"))
              .withColumn("offset", F.when(rid % 997 == 3, F.col("offset") + 1).otherwise(F.col("offset"))))
    cols = ["record_id", "file", "offset", "length", "digest"]
    return first.select(*cols), store(second.select(*cols))


def op8_warc_fixity_audit(spark, sf_dir):
    """Status of every record of two replicas."""
    got = warc_audit.audit_leaves(*_replica_leaves(spark, sf_dir))
    return got.select("record_id", "file", "offset", "length", "digest", "status")


def op9_url_filter(spark, sf_dir):
    """Verdict of every page's URL. Stand-in for the list: the URLs of every tenth page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.filter(F.col("page_id") % 10 == 0).select("url")
    return url_filter.filter_urls(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def tokenizer_paths() -> tuple[str, str]:
    """The public vocabulary, as a tokenizer file and as ranks."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op10_vector_packing(spark, sf_dir):
    """Pieces of all documents in sequences of at most 1,024 tokens."""
    pieces = packing.token_pieces(_table(spark, sf_dir, "documents"), *tokenizer_paths())
    return packing.pack(pieces.drop("ids")).drop("loss")


def op11_hard_negatives(spark, sf_dir):
    """Three hard negatives for each of five positives of every fiftieth embedding, some
    of whose labels are moved on by one first."""
    rows = _table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op12_periodic_runs(spark, sf_dir):
    """Periodic runs of every document, some of which get a periodic end first."""
    docs = periodic_runs.repeat_tails(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.collapse_runs(docs)
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return (found.withColumn("top", top)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
                    F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
                    F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


def op13_suffix_dedup(spark, sf_dir):
    """Bytes of every document in strings of 400 bytes that start anywhere else."""
    found = suffix_dedup.repeated_spans(_table(spark, sf_dir, "documents"), length=400)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.when(F.col("kept").isNull(), F.col("text_sha256")).otherwise(F.sha2("kept", 256)).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_exact_dedup, op3_secret_scan, op4_embedding_near_dedup, op5_sharding, op6_language_id,
    op7_mixing, op8_warc_fixity_audit, op9_url_filter, op10_vector_packing, op11_hard_negatives, op12_periodic_runs,
    op13_suffix_dedup)}

_UPPER, _LOWER = url_filter.UPPER, url_filter.LOWER
_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)

def _sharding_sql(shards: int = 8, seed: int = 0) -> str:
    """Row number, Feistel rounds with cycle walking, shard and slot; CRC-32 by bytes."""
    step = "SELECT row_number, CAST(p // side AS UHUGEINT) AS left_, CAST(p % side AS UHUGEINT) AS right_, side, n FROM walk WHERE turn = 0 OR p >= n"
    two64 = "18446744073709551615::UHUGEINT"
    for key in sharding._keys(seed):
        x = f"(right_ + {key}::UHUGEINT) & {two64}"
        a = f"SELECT *, {x} AS x0 FROM ({step})"
        b = f"SELECT *, (xor(x0, x0 >> 30) * {0xBF58476D1CE4E5B9}::UHUGEINT) & {two64} AS x1 FROM ({a})"
        c = f"SELECT *, (xor(x1, x1 >> 27) * {0x94D049BB133111EB}::UHUGEINT) & {two64} AS x2 FROM ({b})"
        step = (f"SELECT row_number, right_ AS left_, (left_ + xor(x2, x2 >> 31) % side) % side AS right_, side, n FROM ({c})")
    return rf"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda b: list_reduce([b::BIGINT, 1, 1, 1, 1, 1, 1, 1, 1],
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
u AS (SELECT doc_id, text, list_transform(string_split(coalesce(text, ''), ''), lambda c: unicode(c)::BIGINT) AS points FROM documents),
bytes AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, CASE WHEN coalesce(text, '') = '' THEN []::BIGINT[] ELSE
  flatten(list_transform(points, lambda p: CASE WHEN p < 128 THEN [p] WHEN p < 2048 THEN [192 + (p >> 6), 128 + (p & 63)]
    WHEN p < 65536 THEN [224 + (p >> 12), 128 + ((p >> 6) & 63), 128 + (p & 63)]
    ELSE [240 + (p >> 18), 128 + ((p >> 12) & 63), 128 + ((p >> 6) & 63), 128 + (p & 63)] END)) END AS b FROM u),
crc AS (SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM bytes CROSS JOIN tab),
num AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST, text_crc32, size) - 1 AS row_number, count(*) OVER () AS n FROM crc),
sided AS (SELECT row_number, n, CAST(floor(sqrt(greatest(n - 1, 0))) AS BIGINT) + 1 AS side FROM num),
walk AS (SELECT row_number, CAST(row_number AS UHUGEINT) AS p, CAST(side AS UHUGEINT) AS side, CAST(n AS UHUGEINT) AS n, 0 AS turn FROM sided
  UNION ALL SELECT row_number, left_ * side + right_, side, n, 1 FROM ({step}))
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p % {shards} AS INTEGER) AS shard, CAST(p // {shards} AS BIGINT) AS slot, NULL::INTEGER AS grown_shard
FROM num JOIN walk USING (row_number) WHERE turn = 1 AND p < walk.n"""


ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ 	-
]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) END) AS shingles FROM w),
u AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
n AS (SELECT doc_id, count(*) AS n FROM u GROUP BY 1),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(id, near) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.near = l.a)
SELECT s.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, min(near) AS component_id, s.doc_id = min(near) AS kept
FROM s JOIN reach ON s.doc_id = reach.id GROUP BY s.doc_id, shingles""",
    "op5_sharding": _sharding_sql(),
    "op2_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)""",
    "op4_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_sum(list_transform(embedding, lambda x: x * x)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(id, near) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.near = l.a)
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, min(near) AS component_id, id = min(near) AS kept
FROM reach GROUP BY id""",
    "op8_warc_fixity_audit": r"""
WITH raw AS (SELECT page_id AS record_id, 'crawl-' || (page_id // 4096) || '.warc' AS file,
  'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>'
  || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))
  || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS payload FROM pages),
a AS (SELECT record_id, file, CAST(coalesce(sum(strlen(payload)) OVER (PARTITION BY file ORDER BY record_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset", payload FROM raw),
b AS (SELECT record_id, file, CASE WHEN record_id % 997 = 3 THEN "offset" + 1 ELSE "offset" END AS "offset",
  CASE WHEN record_id % 211 = 5 THEN payload || '~' ELSE payload END AS payload FROM a WHERE record_id % 499 <> 7)
SELECT coalesce(a.record_id, b.record_id) AS record_id, file, "offset", strlen(coalesce(a.payload, b.payload)) AS length,
  sha256(coalesce(a.payload, b.payload)) AS digest,
  CASE WHEN b.record_id IS NULL THEN 'missing' WHEN a.record_id IS NULL THEN 'added'
       WHEN a.payload = b.payload THEN 'intact' ELSE 'corrupt' END AS status
FROM a FULL JOIN b USING (file, "offset")""",
    "op9_url_filter": f"""
WITH r AS (SELECT *, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, url, regexp_extract(rest, '^[^/?#]*', 0) AS raw_host, rest FROM r),
p AS (SELECT page_id, url, translate(raw_host, '{_UPPER}', '{_LOWER}') AS host,
  regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*', 0) AS path FROM h),
q AS (SELECT *, regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') AS site, split_part(url, '#', 1) AS bare FROM p),
c AS (SELECT *, list_sort(list_filter(string_split(CASE WHEN instr(bare, '?') > 0 THEN substr(bare, instr(bare, '?') + 1) ELSE '' END, '&'),
  lambda x: x <> '' AND NOT regexp_matches(x, '{url_filter.TRACKING}'))) AS params FROM q),
k AS (SELECT *, CASE WHEN host <> '' THEN site || regexp_replace(path, '/+$', '')
  || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canon FROM c),
rules(verdict, h, path) AS (VALUES {_RULES}),
fit AS (SELECT page_id, arg_max(rules.h || rules.path, length(rules.h || rules.path)) AS rule,
  arg_max(rules.verdict, length(rules.h || rules.path)) AS verdict
  FROM k JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(k.path, rules.path) GROUP BY page_id)
SELECT k.page_id, host, path, rule, coalesce(verdict, CASE WHEN canon IN (SELECT canon FROM k WHERE page_id % 10 = 0 AND canon IS NOT NULL)
  THEN 'block' ELSE 'allow' END) AS verdict
FROM k LEFT JOIN fit USING (page_id)""",
}
