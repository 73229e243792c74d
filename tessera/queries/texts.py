"""Text, privacy, time and parser functions over the driver's tables, and page and reply handling."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from tessera.functions import parsers, privacy, text, timefn
from tessera.operators import classify, gazetteer
from tessera.plans import ingest
from tessera.queries import query
from tessera.sources import pages

KEY = b"an example key"
IPAD, OPAD = (bytes(b ^ x for b in KEY.ljust(64, b"\0")).hex() for x in (0x36, 0x5C))


@query("SELECT doc_id, sha1(trim(regexp_replace(text, '[\\s\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{0085}\\x0B]+', ' ', 'g'))) AS digest FROM documents")
def collapse_ws(t):
    return t("documents").select("doc_id", F.sha1(F.encode(text.collapse_ws(F.col("text")), "UTF-8")).alias("digest"))


@query("""SELECT c_custkey, trim(regexp_replace(regexp_replace(lower(c_name), '[^0-9a-z ]+', ' ', 'g'), ' +', ' ', 'g')) AS title_key FROM customer""")
def title_key(t):
    return t("customer").select("c_custkey", text.title_key(F.col("c_name")).alias("title_key"))


@query("""WITH raw AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'PT. ' || s_name || ' Tbk' WHEN 1 THEN 'CV ' || s_name WHEN 2 THEN 'Group Indonesia' ELSE s_name || ' (Persero)' END AS name FROM supplier),
w AS (SELECT s_suppkey, regexp_replace(lower(name), '[^0-9a-z ]+', ' ', 'g') AS w FROM raw),
s AS (SELECT s_suppkey, w, trim(regexp_replace(regexp_replace(w, '\\b(pt|cv|tbk|persero|perseroan terbatas|ud|pd|koperasi|yayasan|ltd|inc|co|corp|group|grup|indonesia|id)\\b', ' ', 'g'), ' +', ' ', 'g')) AS short FROM w)
SELECT s_suppkey, CASE WHEN short <> '' THEN short ELSE trim(regexp_replace(w, ' +', ' ', 'g')) END AS company_key FROM s""")
def company_key(t):
    name = F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("PT. "), "s_name", F.lit(" Tbk"))).when(F.col("s_suppkey") % 4 == 1, F.concat(F.lit("CV "), "s_name")).when(F.col("s_suppkey") % 4 == 2, "Group Indonesia").otherwise(F.concat("s_name", F.lit(" (Persero)")))
    return t("supplier").select("s_suppkey", text.company_key(name).alias("company_key"))


@query("""WITH c AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS w FROM documents)
SELECT doc_id, CASE WHEN length(w) <= 200 THEN w ELSE regexp_replace(regexp_replace(left(w, 200), ' [^ ]*$', ''), '[,.;:-]+$', '') || '…' END AS short FROM c""")
def truncate_desc(t):
    return t("documents").select("doc_id", text.truncate(F.col("text"), 200).alias("short"))


@query("""WITH k AS (SELECT doc_id, trim(regexp_replace(regexp_replace(lower(regexp_replace(left(text, 500), '[^\\x00-\\x7F]', '', 'g')), '[^0-9a-z ]+', ' ', 'g'), ' +', ' ', 'g')) AS d FROM documents)
SELECT doc_id, sha1('doc ' || doc_id || '||' || '|' || d) AS content_hash, 'v' || left(sha1(CAST(doc_id AS VARCHAR)), 10) AS short_id FROM k""")
def content_hash(t):
    none = F.lit(None).cast("string")
    docs = t("documents").select("doc_id", F.regexp_replace(F.left("text", F.lit(500)), r"[^\x00-\x7F]", "").alias("d"))
    return docs.select("doc_id", text.content_hash(F.concat(F.lit("doc "), "doc_id"), none, none, F.col("d")).alias("content_hash"), text.short_id(F.col("doc_id").cast("string")).alias("short_id"))


@query(f"""SELECT c_custkey, left(sha256(unhex('{OPAD}') || unhex(sha256(unhex('{IPAD}') || encode(trim(regexp_replace(regexp_replace(lower(c_name), '[^0-9a-z ]+', ' ', 'g'), ' +', ' ', 'g')))))), 12) AS pseudonym FROM customer""")
def hmac_pseudonym(t):
    return t("customer").select("c_custkey", privacy.pseudonym(F.col("c_name"), KEY).alias("pseudonym"))


@query(r"""SELECT doc_id, sha1(regexp_replace(regexp_replace(text, '(?i)(?:https?://)?(?:wa\.me|api\.whatsapp\.com|chat\.whatsapp\.com|t\.me|line\.me)/\S+', '[disamarkan]', 'g'), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[disamarkan]', 'g')) AS digest,
(CASE WHEN regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') THEN 1 ELSE 0 END) AS has_email FROM documents""")
def mask_email_link(t):
    masked = F.regexp_replace(F.regexp_replace("text", privacy.CONTACT_LINK, privacy.MASK), privacy.EMAIL, privacy.MASK)
    return t("documents").select("doc_id", F.sha1(F.encode(masked, "UTF-8")).alias("digest"), F.array_contains(privacy.find_pii(F.col("text")), "email").cast("int").alias("has_email"))


@query()
def mask_all(t):
    return t("documents").select("doc_id", F.sha1(F.encode(privacy.mask_text(F.col("text")), "UTF-8")).alias("digest"), F.size(privacy.find_pii(F.col("text"))).alias("kinds"))


@query("""SELECT c_custkey, regexp_replace('Staf ' || c_name || ' di ' || lower(c_name), '(?i)' || regexp_escape(c_name), '[perusahaan]', 'g') AS title FROM customer""")
def hide_entity(t):
    title = F.concat(F.lit("Staf "), "c_name", F.lit(" di "), F.lower("c_name"))
    return t("customer").select("c_custkey", privacy.hide_name(title, F.col("c_name")).alias("title"))


@query("""SELECT event_id, strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS iso, CAST(DATE '2024-02-01' - CAST(ts + INTERVAL 7 HOUR AS DATE) AS BIGINT) AS days FROM events""")
def jakarta_iso(t):
    iso = timefn.to_iso(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    return t("events").select("event_id", iso.alias("iso"), timefn.days_ago(iso, F.lit("2024-02-01").cast("date")).cast("long").alias("days"))


@query("""SELECT o_orderkey FROM orders WHERE date_diff('day', CAST(o_orderdate AS DATE), (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) <= 60 OR o_orderdate IS NULL""")
def age_window(t):
    from tessera.operators.relational import age_window as window

    today = t("orders").agg(F.to_date(F.max("o_orderdate")).alias("today"))
    return window(t("orders").crossJoin(today), F.to_date("o_orderdate"), F.col("today")).select("o_orderkey")


PAY = """CASE o_orderkey % 7 WHEN 0 THEN 'Rp ' || k || '.000.000 - Rp ' || (k + 2) || '.000.000' WHEN 1 THEN k || '-' || (k + 3) || ' jt' WHEN 2 THEN k || ',5 juta / bulan'
WHEN 3 THEN (100 + k) || ' rb per hari' WHEN 4 THEN 'IDR ' || (k * 12) || '000000/year' WHEN 5 THEN 'Gaji kompetitif' ELSE 'USD ' || k || '000' END"""


@query("""WITH n AS (SELECT o_orderkey, o_orderkey % 7 AS m, 2 + CAST(floor(o_totalprice) AS BIGINT) % 17 AS k FROM orders)
SELECT o_orderkey, CAST(CASE m WHEN 0 THEN k * 1000000 WHEN 1 THEN k * 1000000 WHEN 2 THEN k * 1000000 + 500000 WHEN 3 THEN (100 + k) * 22000 WHEN 4 THEN k * 1000000 END AS BIGINT) AS low,
CAST(CASE m WHEN 0 THEN (k + 2) * 1000000 WHEN 1 THEN (k + 3) * 1000000 WHEN 2 THEN k * 1000000 + 500000 WHEN 3 THEN (100 + k) * 22000 WHEN 4 THEN k * 1000000 END AS BIGINT) AS high,
CASE m WHEN 0 THEN 'month' WHEN 1 THEN 'month' WHEN 2 THEN 'month' WHEN 3 THEN 'day' WHEN 4 THEN 'year' END AS period FROM n""")
def salary_parse(t):
    raw = t("orders").withColumn("k", 2 + F.floor("o_totalprice") % 17).select("o_orderkey", F.expr(PAY).alias("raw"))
    pay = parsers.parse_salary(F.col("raw"))
    return raw.select("o_orderkey", pay["min"].alias("low"), pay["max"].alias("high"), pay["period"].alias("period"))


EDUCATION = ("Minimal D3/S1", "S1 Teknik", "SMA/SMK sederajat", "Magister", "PhD", "SMP", "elementary", "bebas", "Sarjana atau Diploma")
EXPERIENCE = ("Fresh graduate", "2 tahun", "1-3 tahun", "1,5 thn", "18 bulan", "3 months", "5", "lama")
EMPLOYMENT = ("Full-time", "Magang", "Kontrak / tetap", "tetap, kontrak", "paruh waktu", "freelance", "lain")


def _choice(values, by: str):
    return F.element_at(F.array(*(F.lit(v) for v in values)), (F.col(by) % len(values) + 1).cast("int"))


def _answers(by: str, values) -> str:
    return f"CASE {by} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


@query(f"""SELECT c_custkey, {_answers('c_custkey', ["'D1-D3'", "'D4/S1'", "'SMA/SMK'", "'S2'", "'S3'", "'SMP'", "'SD'", "NULL", "'D1-D3'"])} AS level,
{_answers('c_custkey', [0, 2, 1, 1, 2, 0, 5, 'NULL'])} AS years,
{_answers('c_custkey', ["'full_time'", "'internship'", "'contract'", "'full_time'", "'part_time'", "'freelance'", "NULL"])} AS kind FROM customer""")
def education_experience_employment(t):
    return t("customer").select(
        "c_custkey",
        parsers.parse_education(_choice(EDUCATION, "c_custkey")).alias("level"),
        parsers.parse_experience(_choice(EXPERIENCE, "c_custkey")).alias("years"),
        parsers.parse_employment(_choice(EMPLOYMENT, "c_custkey")).alias("kind"),
    )


def _gazetteer(t):
    """Nations as cities of regions, which are provinces; every fifth name is a regency's instead."""
    nations = t("nation").select(F.lpad((1000 + F.col("n_nationkey")).cast("string"), 4, "0").alias("region_code"), F.concat(F.when(F.col("n_nationkey") % 5 == 0, "KAB. ").otherwise("KOTA "), F.upper(F.replace("n_name", F.lit("_"), F.lit(" ")))).alias("name"), F.lit("regency").alias("level"), F.when(F.col("n_nationkey") % 5 == 0, "kab").otherwise("kota").alias("kind"), F.lpad((10 + F.col("n_regionkey")).cast("string"), 2, "0").alias("province_code"))
    regions = t("region").select(F.lpad((10 + F.col("r_regionkey")).cast("string"), 2, "0").alias("region_code"), F.upper("r_name").alias("name"), F.lit("province").alias("level"), F.lit(None).cast("string").alias("kind"), F.lpad((10 + F.col("r_regionkey")).cast("string"), 2, "0").alias("province_code"))
    aliases = t("nation").filter("n_nationkey = 3").select(F.lit("third place").alias("alias"), F.lit("1003").alias("region_code"))
    return gazetteer.build(nations.unionByName(regions), aliases)


@query("""WITH raw AS (SELECT c_custkey, c_nationkey AS n, n_regionkey AS r, c_custkey % 5 AS m FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT c_custkey, CAST(CASE m WHEN 0 THEN 1000 + n WHEN 1 THEN 1000 + n WHEN 2 THEN 1003 WHEN 3 THEN 10 + r END AS VARCHAR) AS region_code,
CAST(CASE m WHEN 0 THEN 10 + r WHEN 1 THEN 10 + r WHEN 2 THEN 10 + (SELECT n_regionkey FROM nation WHERE n_nationkey = 3) WHEN 3 THEN 10 + r END AS VARCHAR) AS province_code, m = 4 AS is_remote FROM raw""")
def region_resolve(t):
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    name = F.replace("n_name", F.lit("_"), F.lit(" "))
    raw = F.when(F.col("c_custkey") % 5 == 0, F.concat(name, F.lit(", "), "r_name")).when(F.col("c_custkey") % 5 == 1, F.concat(F.lit("unknown spot | "), name)).when(F.col("c_custkey") % 5 == 2, "Third  Place").when(F.col("c_custkey") % 5 == 3, F.concat(F.lit("Provinsi "), "r_name")).otherwise("Kerja dari rumah")
    named = c.select("c_custkey", raw.alias("raw"))
    return named.join(gazetteer.resolve(named, _gazetteer(t)), "raw").select("c_custkey", "region_code", "province_code", "is_remote")


@query("""SELECT c_custkey, CAST(CASE WHEN c_custkey % 2 = 0 THEN 1000 + c_nationkey ELSE 10 + n_regionkey END AS VARCHAR) AS region_code FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def region_refine(t):
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    code = F.lpad((10 + F.col("n_regionkey")).cast("string"), 2, "0")
    street = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("Jl. Satu 5, "), F.replace("n_name", F.lit("_"), F.lit(" ")), F.lit(", 12345"))).otherwise("Jl. Dua")
    rows = c.select("c_custkey", code.alias("region_code"), code.alias("province_code"), street.alias("street"))
    return gazetteer.refine(rows, "street", _gazetteer(t)).select("c_custkey", "region_code")


@query("""SELECT 0.5 * 0 + round_even(avg(CASE WHEN o_orderkey % 2 = 0 THEN 1.0 ELSE 0 END), 3) AS salary_min, round_even(avg(CASE WHEN o_orderkey % 3 = 0 THEN 1.0 ELSE 0 END), 3) AS education_level, round_even(avg(CASE WHEN o_orderkey % 4 = 0 THEN 1.0 ELSE 0 END), 3) AS experience_years,
round_even(avg(CASE WHEN o_orderkey % 5 = 0 THEN 1.0 ELSE 0 END), 3) AS employment_type, round_even(avg(CASE WHEN o_orderkey % 2 = 1 THEN 1.0 ELSE 0 END), 3) AS region_code, round_even(avg(CASE WHEN o_orderkey % 4 = 1 THEN 1.0 ELSE 0 END), 3) AS regency_level FROM orders""")
def coverage(t):
    k = F.col("o_orderkey")
    rows = t("orders").select(F.when(k % 2 == 0, 1).alias("salary_min"), F.when(k % 3 == 0, "S1").alias("education_level"), F.when(k % 4 == 0, 1).alias("experience_years"), F.when(k % 5 == 0, "x").alias("employment_type"), F.when(k % 4 == 1, "1234").when(k % 2 == 1, "12").alias("region_code"))
    return ingest.coverage(rows)


@query(r"""WITH s AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g') AS h FROM pages)
SELECT page_id, sha1(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(h, '(?s)<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g'))) AS digest FROM s""")
def html_text(t):
    return t("pages").select("page_id", F.sha1(F.encode(text.strip_tags(F.col("html")), "UTF-8")).alias("digest"))


@query()
def html_lines(t):
    return t("pages").select("page_id", text.html_to_text("html").alias("text"))


@query(r"""SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '/([^/?#]+)/?$', 1) AS tail FROM pages""")
def url_parts(t):
    return t("pages").select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), F.coalesce(pages.id_from_url(F.col("url"), "/([^/?#]+)/?$"), F.lit("")).alias("tail"))


@query("""WITH e AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"#]+)"', 1)) AS link FROM pages) SELECT DISTINCT link FROM e""")
def link_discovery(t):
    return pages.links(t("pages"), "html", 'href="([^"#]+)"', "page_id")


@query()
def structured_pages(t):
    """Every page through the structured-data reader: postings, or the error that says why there is none."""
    return pages.structured(t("pages"), "html", "url").select("url", "error", "title")


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_props(t):
    return t("events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query("""SELECT d.doc_id, CAST(l.quality AS BIGINT) AS quality, CAST(l.toxic AS BIGINT) AS toxic FROM documents d JOIN labels l ON l.doc_id = d.doc_id""")
def label_join(t):
    return t("documents").select("doc_id").join(t("labels"), "doc_id").select("doc_id", F.col("quality").cast("long"), F.col("toxic").cast("long"))


@query("""WITH a AS (SELECT conv_id AS batch, turn, CASE WHEN turn % 4 = 3 THEN 'nobody' ELSE role END AS second, role AS unit, CASE WHEN conv_id % 7 = 0 AND turn = 1 THEN 1.5 ELSE 0.25 * (turn % 5) END AS confidence FROM conversations),
v AS (SELECT *, bool_and(unit IN ('user', 'assistant') AND confidence BETWEEN 0 AND 1) OVER (PARTITION BY batch) AS ok FROM a)
SELECT batch, turn AS ref, unit, CASE WHEN second IN ('user', 'assistant') THEN second END AS second, CAST(confidence AS DOUBLE) AS confidence FROM v WHERE ok""")
def validate_batch(t):
    c = t("conversations")
    answers = c.select(F.col("conv_id").alias("batch"), F.col("turn").alias("ref"), F.col("role").alias("unit"), F.when(F.col("turn") % 4 == 3, "nobody").otherwise(F.col("role")).alias("second"), F.when((F.col("conv_id") % 7 == 0) & (F.col("turn") == 1), 1.5).otherwise(0.25 * (F.col("turn") % 5)).alias("confidence"))
    return classify.valid_batches(answers, c.sparkSession.createDataFrame([("user",), ("assistant",)], "unit string"))


@query(r"""WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS ws FROM conversations), e AS (SELECT conv_id, turn * 100000 + i AS place, ws[i] AS raw FROM w, LATERAL (SELECT unnest(range(1, len(ws) + 1)) AS i)),
k AS (SELECT conv_id, place, raw, regexp_replace(regexp_replace(lower(trim(regexp_replace(raw, '\s+', ' ', 'g'))), '^[ .;:-]+', ''), '[ .;:-]+$', '') AS norm FROM e)
SELECT conv_id, norm AS skill_norm, arg_max(raw, place) AS skill_raw FROM k WHERE norm <> '' GROUP BY 1, 2""")
def skills_dedupe(t):
    c = t("conversations")
    rows = c.groupBy("conv_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: F.split(x["text"], " "))).alias("skills"))
    return classify.skills_of(rows, "skills", "conv_id")


UNITS, CODES = ("1111", "2222"), ("1111.01", "2222.02")


def stub(step: str, system: str, items: list[dict]) -> str:
    """A deterministic stand-in for the model: codes by the text's digest; some documents make the filter reject their batch."""
    import json

    out = []
    for x in items:
        n = int(hashlib.md5(x["description"].encode()).hexdigest()[:8], 16)
        if n % 97 == 0:
            raise classify.Filtered
        code = f"{system}.0{1 + UNITS.index(system)}" if step == "code" else None
        out.append({"ref": x["ref"], "unit": UNITS[n % 2], "second": None, "code": code, "confidence": (n % 100) / 100, "skills": ["Excel"], "pii_found": n % 83 == 0})
    return json.dumps(out)


@query(r"""WITH c AS (SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(trim(regexp_replace(text, '\s+', ' ', 'g')), '') AS w FROM documents),
d AS (SELECT id, CASE WHEN length(w) <= 800 THEN w ELSE regexp_replace(regexp_replace(left(w, 800), ' [^ ]*$', ''), '[,.;:-]+$', '') || '…' END AS t FROM c),
n AS (SELECT id, CAST('0x' || left(md5(t), 8) AS BIGINT) AS n FROM d)
SELECT id, CASE WHEN n % 97 <> 0 THEN CASE WHEN n % 2 = 0 THEN '1111' ELSE '2222' END END AS unit, CASE WHEN n % 97 <> 0 THEN CASE WHEN n % 2 = 0 THEN '1111.01' ELSE '2222.02' END END AS code,
CASE WHEN n % 97 <> 0 THEN 'ok' ELSE 'failed' END AS status, n % 97 = 0 OR n % 100 < 70 OR n % 83 = 0 AS needs_review FROM n""")
def two_step_classify(t):
    """Both steps of coding over all documents, with the stand-in model; a filtered batch loses only the documents at fault."""
    s = classify.Settings()
    docs = t("documents")
    spark = docs.sparkSession
    items = docs.select(F.col("doc_id").cast("string").alias("id"), F.lit(None).cast("string").alias("group"), classify.item({}, F.col("text"), s.description_chars).alias("item"))
    first = classify.unit_step(spark.createDataFrame([(u,) for u in UNITS], "unit string"), lambda g: "units", s.max_skills)
    second = classify.code_step(spark.createDataFrame([(c,) for c in CODES], "code string"), lambda g: g)
    found, _, _ = classify.two_steps(items, stub, first, second, s)
    return found.select("id", "unit", "code", "status", "needs_review")


# Texts of documents, some of them with a phone, a link or an address put behind.
SQL_CONTACTS = r"""SELECT doc_id, lang, source, coalesce(text, '') || CASE WHEN doc_id % 7 = 0 THEN ' telp. (021) 555-' || (1000 + doc_id % 9000) ELSE '' END || CASE WHEN doc_id % 11 = 0 THEN ' +62 812 3456 ' || (100 + doc_id % 900) || ';' ELSE '' END
|| CASE WHEN doc_id % 13 = 0 THEN ' Chat.WhatsApp.com/' || doc_id ELSE '' END || CASE WHEN doc_id % 17 = 0 THEN ' hrd' || doc_id || '@mail.co.id' ELSE '' END || CASE WHEN doc_id % 19 = 0 THEN ' 5.000.' || (100 + doc_id % 900) ELSE '' END AS t FROM documents"""
# A phone's surroundings are matched along with it: the other engine can't look behind.
SQL_KINDS = r"""(CASE WHEN regexp_matches(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') THEN 'email ' ELSE '' END)
|| (CASE WHEN regexp_matches(t, '(^|[^\p{L}\p{M}\p{Nd}_.])((\+?62|0)[\s.-]?8\d{1,3}([\s.-]?\d{2,4}){2,3}|\(?0\d{1,3}\)?[\s.-]?\d{3,4}[\s.-]?\d{3,4})($|[^\p{L}\p{M}\p{Nd}_])') THEN 'phone ' ELSE '' END)
|| (CASE WHEN regexp_matches(t, '(?i)(https?://)?(wa\.me|api\.whatsapp\.com|chat\.whatsapp\.com|t\.me|line\.me)/\S+') THEN 'contact_link ' ELSE '' END)"""


def with_contacts(docs):
    k = F.col("doc_id")
    put = lambda n, *parts: F.when(k % n == 0, F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))).otherwise("")
    added = (put(7, " telp. (021) 555-", k % 9000 + 1000), put(11, " +62 812 3456 ", k % 900 + 100, ";"), put(13, " Chat.WhatsApp.com/", k), put(17, " hrd", k, "@mail.co.id"), put(19, " 5.000.", k % 900 + 100))
    return docs.withColumn("t", F.concat(F.coalesce("text", F.lit("")), *added))


@query(f"SELECT doc_id, trim({SQL_KINDS}) AS kinds FROM ({SQL_CONTACTS})")
def contact_kinds(t):
    return with_contacts(t("documents")).select("doc_id", F.array_join(privacy.find_pii(F.col("t")), " ").alias("kinds"))


@query("""SELECT o_orderkey, 'Gaji 5.000.000, ' || CASE o_orderkey % 4 WHEN 0 THEN 'hubungi Bapak [disamarkan]' WHEN 1 THEN 'CP: [disamarkan]' WHEN 2 THEN 'a.n. [disamarkan]' ELSE 'hubungi kami atau kontak [disamarkan]' END || ', [disamarkan] / [disamarkan], ' || CASE WHEN o_orderkey % 3 = 0 THEN '[disamarkan] ya' ELSE 'kode ' || o_custkey END AS masked FROM orders""")
def masked_contacts(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    cue = F.when(k % 4 == 0, "hubungi Bapak Budi Santoso").when(k % 4 == 1, "CP: Rina").when(k % 4 == 2, "a.n. Sari Dewi Putri").otherwise("hubungi kami atau kontak Budi")
    phone = F.concat(F.lit(", 0812-3456-"), F.lpad((k % 10_000).cast("string"), 4, "0"), F.lit(" / hrd."), c, F.lit("@mail.co.id, "))
    last = F.when(k % 3 == 0, F.concat(F.lit("https://wa.me/62"), c, F.lit(" ya"))).otherwise(F.concat(F.lit("kode "), c))
    return t("orders").select("o_orderkey", privacy.mask_text(F.concat(F.lit("Gaji 5.000.000, "), cue, phone, last)).alias("masked"))
