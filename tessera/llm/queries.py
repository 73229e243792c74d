"""The registered queries of the training-data operators, bound to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table, unsigned_crc32
from tessera.llm.concurrency import open_sales, sweep
from tessera.llm.decontamination import digest, matches
from tessera.llm.line_dedup import dedup_runs
from tessera.llm.mixing import cycle_quotas, mix, word_count
from tessera.llm.packing import pack
from tessera.llm.sharding import shard_records
from tessera.llm.simhash import near_duplicates
from tessera.llm.sketches import edited_likeness
from tessera.llm.spelling import variants, word_counts
from tessera.llm.suffix_dedup import digest as repeats_digest
from tessera.llm.token_counts import count_tokens, default_model
from tessera.llm.token_store import default_ranks, records
from tessera.llm.toxicity import fit, fold, score

SHARDS = 40


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_runs(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    out = mix(sized, F.col("doc_id").cast("string"), F.col("size"), F.array("source"), cycle_quotas((5, 2, 1), 1.5, 2.0))
    return out.select("row.doc_id", "size", "source_size", "target", "taken")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(matches(docs, table(spark, sf_dir, "benchmark")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")), spans=None)
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    rows = docs.select("doc_id", size.alias("size"), unsigned_crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("key").alias("law"))
    out = shard_records(rows, "doc_id", [1.0] * SHARDS, grown="grown_shard")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_digest(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return count_tokens(docs, default_model()).withColumn("over_limit", F.col("n_tokens") > 4096)


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(table(spark, sf_dir, "documents"), default_ranks())


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), default_ranks())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(word_counts(table(spark, sf_dir, "documents"), slip_every=199))


def op13_peak_concurrency(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = open_sales(*(table(spark, sf_dir, t) for t in ("sales", "sale_lines", "clients")))
    return sweep(spans).select(F.col("key").alias("nation_id"), "from_s", "to_s", "n_open", F.col("open_amount").alias("open_cents"), "high_open", "is_peak")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_line_dedup": op1_line_dedup, "op2_mixing": op2_mixing, "op3_simhash": op3_simhash, "op4_decontamination": op4_decontamination, "op5_toxicity": op5_toxicity, "op6_sharding": op6_sharding, "op7_fingerprints": op7_fingerprints, "op8_suffix_dedup": op8_suffix_dedup, "op9_token_counts": op9_token_counts, "op10_token_store": op10_token_store, "op11_packing": op11_packing, "op12_spelling_variants": op12_spelling_variants, "op13_peak_concurrency": op13_peak_concurrency}


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
#: Windows of documents and items as joined words, met by equality.
OP4_SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {WORDS} AS w FROM benchmark),
i AS (SELECT item, w, least(len(w), 10) AS m FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, m, array_to_string(w[p:p + m - 1], ' ') AS s FROM (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM i)),
sizes AS (SELECT DISTINCT m FROM win),
dw AS (SELECT r, m, p, array_to_string(w[p:p + m - 1], ' ') AS s FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, sizes)),
found AS (SELECT dw.r, dw.m, dw.p, win.item FROM dw JOIN win ON win.m = dw.m AND win.s = dw.s),
hit AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + m)) AS q FROM (SELECT DISTINCT r, m, p FROM found)) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)"""


#: The crc32 by its table of bytes; near words by what they share without one letter, at one place or as a word.
OP12_SQL = f"""WITH RECURSIVE bytes AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc FROM range(256) AS r(i)),
runs AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS w FROM documents) WHERE length(w) >= 6 GROUP BY 1, 2),
hexed AS (SELECT w, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM runs),
hashed AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(x), 2), lambda p: CAST('0x' || substr(x, p, 2) AS BIGINT))), lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1])), 4294967295) AS h FROM hexed, bytes),
words AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w, n FROM hashed),
v AS (SELECT w, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(w) >= 6 GROUP BY w HAVING sum(n) >= 5),
less AS (SELECT w, i, substr(w, 1, i - 1) || substr(w, i + 1) AS d FROM (SELECT w, unnest(range(1, length(w) + 1)) AS i FROM v)),
near AS (SELECT a.w, b.w AS o FROM less a JOIN less b ON a.d = b.d AND a.i = b.i AND a.w <> b.w UNION SELECT w, d FROM less WHERE d IN (SELECT w FROM v) UNION SELECT d, w FROM less WHERE d IN (SELECT w FROM v)),
best AS (SELECT near.w, count(*) AS n_near, arg_min(o, (-v.n, o)) AS o, max(v.n) AS o_n FROM near JOIN v ON v.w = near.o GROUP BY near.w),
forms AS (SELECT v.w, n, coalesce(n_near, 0) AS n_near, CASE WHEN o_n >= 5 * n THEN o END AS form, CASE WHEN o_n >= 5 * n THEN o_n END AS form_n FROM v LEFT JOIN best USING (w)),
follow AS (SELECT w, w AS root, form AS next FROM forms UNION ALL SELECT follow.w, forms.w, forms.form FROM follow JOIN forms ON forms.w = follow.next)
SELECT w AS word, form, root, n, n_near, form_n FROM forms JOIN (SELECT w, root FROM follow WHERE next IS NULL) USING (w)"""
#: All moments of a nation in one running sum.
OP13_SQL = """WITH shipped AS (SELECT sale_id, max(shipped_at) AS s FROM sale_lines WHERE shipped_at IS NOT NULL GROUP BY 1),
nations AS (SELECT client_id, min(nation_id) AS nation FROM clients GROUP BY 1),
spans AS (SELECT coalesce(nation, -1) AS nation_id, 60 * CAST(floor(epoch(sold_at) / 60) AS BIGINT) AS a, 60 * CAST(floor(epoch(s) / 60) AS BIGINT) + 604800 AS b, coalesce(CAST(floor(100 * total + 0.5) AS BIGINT), 0) AS cents
  FROM sales LEFT JOIN shipped USING (sale_id) LEFT JOIN nations USING (client_id) WHERE sold_at IS NOT NULL),
kept AS (SELECT * FROM spans WHERE b IS NULL OR b > a),
doubled AS (SELECT * FROM kept UNION ALL SELECT -2, a, b, cents FROM kept),
moves AS (SELECT nation_id, a AS t, 1 AS n, cents FROM doubled UNION ALL SELECT nation_id, b, -1, -cents FROM doubled WHERE b IS NOT NULL),
moments AS (SELECT nation_id, t, sum(n) AS n, sum(cents) AS cents FROM moves GROUP BY 1, 2 HAVING sum(n) <> 0 OR sum(cents) <> 0),
swept AS (SELECT nation_id, t, lead(t) OVER w AS to_s, sum(n) OVER w AS n_open, sum(cents) OVER w AS open_cents FROM moments WINDOW w AS (PARTITION BY nation_id ORDER BY t))
SELECT CAST(nation_id AS INTEGER) AS nation_id, t AS from_s, to_s, CAST(n_open AS BIGINT) AS n_open, CAST(open_cents AS BIGINT) AS open_cents,
  CAST(max(n_open) OVER (PARTITION BY nation_id ORDER BY t) AS BIGINT) AS high_open, n_open = max(n_open) OVER (PARTITION BY nation_id) AS is_peak FROM swept"""


def oracle_sql() -> dict[str, str]:
    return {"op4_decontamination": OP4_SQL, "op12_spelling_variants": OP12_SQL, "op13_peak_concurrency": OP13_SQL}
