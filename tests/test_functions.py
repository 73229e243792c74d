import hashlib
import hmac
import math
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tessera.functions import parsers, privacy, text, timefn


def values(spark, column, inputs, kind="string"):
    rows = [(i, x) for i, x in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, x {kind}").coalesce(1)
    return [r["y"] for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def check(spark, column, cases):
    got = values(spark, column, [a for a, _ in cases])
    assert got == [b for _, b in cases]


def test_text(spark):
    check(spark, text.collapse_ws, [(None, ""), ("  a \n\t b\u00a0c ", "a b c")])
    for exact in (True, False):
        check(spark, lambda c, e=exact: text.company_key(c, e), [("PT. Maju Jaya Tbk", "maju jaya"), ("Indonesia Group", "indonesia group"), ("Café-Größe", "cafe groe"), (None, "")])
        check(spark, lambda c, e=exact: text.title_key(c, e), [("Staf  Admin (Gudang)", "staf admin gudang"), (None, "")])
    check(spark, lambda c: text.truncate(c, 10), [("short", "short"), ("one two three", "one two…"), ("abcdefghij klm", "abcdefghij…"), ("one two,  three", "one two…"), (None, "")])
    check(spark, text.region_label, [("KOTA ADM. JAKARTA SELATAN", "Kota Adm. Jakarta Selatan"), ("DKI JAKARTA", "DKI Jakarta"), ("di yogyakarta", "DI Yogyakarta")])
    check(spark, text.skill_key, [("  Data  Entry. ", "data entry"), (" - ", "")])
    check(spark, text.short_id, [("a", "v" + hashlib.sha1(b"a").hexdigest()[:10])])
    check(spark, text.safe_id, [("a/b c?d", "a_b_c_d"), ("é-1.x", "é-1.x"), ("", hashlib.sha1(b"").hexdigest()[:16])])
    check(spark, text.html_to_text, [(None, ""), ("a &amp;  b", "a & b"), ("<p>One</p><ul><li>two <b>x</b></li><li>three</li></ul>a<br>b", "One\ntwo x\nthree\na\nb"), ("<script>x</script><div> </div>y", "y")])
    check(spark, text.strip_fences, [("```json\n[1]\n```", "[1]"), (" [2] ", "[2]")])
    item = "struct<ref:string,n:int>"
    got = values(spark, lambda c: text.json_items(c, item), ['[{"ref":"a","n":1}]', '```json\n{"results":[{"ref":"b","n":2}]}\n```', '{"x":1}', "no"])
    assert [[tuple(x) for x in g] if g is not None else None for g in got] == [[("a", 1)], [("b", 2)], None, None]


def test_fold_equals_the_decomposition_of_every_character(spark):
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(chars[i : i + 64]) for i in range(0, len(chars), 64)] + [c for c in chars if unicodedata.decomposition(c)]
    texts += ["", "plain", "x\uff21\ufb03 \u00bd caf\u0065\u0301 \U0001d400", None]
    plain = [None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    assert values(spark, text.ascii_fold, texts) == plain
    df = spark.createDataFrame([("x",)], "x string").select(text.ascii_fold(F.col("x")))
    assert "Python" not in df._jdf.queryExecution().toString()


MUST = ["mail a.b@c.co.id now", "WA 0812-3456-7890", "+62 812 3456 789", "telp (021) 555 1234", "https://wa.me/62812345", "t.me/someone", "hubungi Budi Santoso segera", "CP: Rina", "a.n. Sari Dewi"]
MUST_NOT = ["gaji Rp 5.000.000", "5.000.000 - 7.500.000", "hubungi kami sekarang", "tahun 2024", "kode 12345"]


def test_privacy(spark):
    assert all(privacy.MASK in x for x in values(spark, privacy.mask_text, MUST))
    assert values(spark, privacy.mask_text, [*MUST_NOT, None]) == [*MUST_NOT, ""]
    assert values(spark, privacy.mask_text, ["hubungi kami atau hubungi Budi"]) == ["hubungi kami atau hubungi [disamarkan]"]
    assert values(spark, privacy.find_pii, ["x@y.id 0812 3456 7890", "wa.me/1", "none"]) == [["email", "phone"], ["contact_link"], []]
    got = values(spark, lambda c: privacy.pseudonym(c, b"key"), ["PT Maju", "", None, "maju"])
    want = hmac.new(b"key", b"maju", hashlib.sha256).hexdigest()[:12]
    assert got == [want, None, None, want]
    df = spark.createDataFrame([("Kerja di PT Maju (Jaya) dan maju jaya!", "PT Maju (Jaya)"), ("ab cd", "ab"), (None, "x"), ("x", None)], "t string, n string").coalesce(1)
    assert [r[0] for r in df.select(privacy.hide_name(F.col("t"), F.col("n"))).collect()] == ["Kerja di [perusahaan] dan [perusahaan]!", "ab cd", None, "x"]


def test_contact_details_by_brute_force(spark):
    rnd = random.Random(5)
    bits = ["a.b", "@", "c.co", ".id", "x_y", "%", " ", "\n", "0812", " 0812-3456-", "+62 812", "+62 ", "62", "(021)", "-", ".", "3456", "789", "WA.me/", "t.me/", "https://", "line.me", "/z", "Hubungi", "CP", "a.n.", "atas nama", "kontak", ":", " ibu ", "Budi", " Santoso", "dan", "Sari", "x"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 40))) for _ in range(4000)]
    texts += ["a@b.com_x@y.id", "a@b.comx@y.id", "a" * 100_000, "a" * 50_000 + "@b.id", "@@a@b.c a@b.cd@e.fg", "\u212aontak Budi", "", *MUST, *MUST_NOT]
    python = lambda p: re.compile(p.replace("(?iU)", "(?i)").replace("(?U)", ""))
    link, email, phone, name = map(python, (privacy.CONTACT_LINK, privacy.EMAIL, privacy.PHONE, privacy.CONTACT_NAME))
    want, kinds = [], []
    for t in texts:
        kinds.append([k for k, p in (("email", email), ("phone", phone), ("contact_link", link)) if len(t) < 1000 and p.search(t)])
        out = t
        for p in (link, email, phone) if len(t) < 1000 else ():
            out = p.sub(privacy.MASK, out)
        want.append(name.sub(lambda m: m[1] + privacy.MASK, out))
    want[4003], kinds[4003] = privacy.MASK, ["email"]
    assert values(spark, privacy.mask_text, texts) == want
    assert values(spark, privacy.find_pii, texts) == kinds
    assert sum(privacy.MASK in w for w in want) > 1000 and all(sum(k in x for x in kinds) > 100 for k in ("email", "phone", "contact_link"))


def test_time(spark):
    check(spark, timefn.to_iso, [(None, None), ("", None), ("2026-10-01", "2026-10-01"), ("2026-13-01", None), ("2026-10-01T00:00:00Z", "2026-10-01T07:00:00+07:00"), ("2026-10-01T10:00:00", "2026-10-01T10:00:00+07:00"), ("2026-10-01T00:00:00.5+0700", "2026-10-01T00:00:00+07:00"), ("2026-10-01T23:30:00+00:00", "2026-10-02T06:30:00+07:00"), ("soon", None)])
    assert values(spark, timefn.from_epoch, [0, 86399], "long") == ["1970-01-01T07:00:00+07:00", "1970-01-02T06:59:59+07:00"]
    assert values(spark, lambda c: timefn.days_ago(c, F.lit("2026-10-10").cast("date")), ["2026-10-01T07:00:00+07:00", "2026-10-10", "x", None]) == [9, 0, None, None]


SALARIES = [
    ("Rp 5.000.000 - Rp 7.500.000", (5_000_000, 7_500_000, "month")),
    ("5-7 jt", (5_000_000, 7_000_000, "month")),
    ("3,5 juta / bulan", (3_500_000, 3_500_000, "month")),
    ("150 rb per hari", (3_300_000, 3_300_000, "day")),
    ("IDR 60000000-84000000/year", (5_000_000, 7_000_000, "year")),
    ("25.000/jam", (4_325_000, 4_325_000, "hour")),
    ("1 juta per minggu", (4_333_000, 4_333_000, "week")),
    ("Rp4,500,000", (4_500_000, 4_500_000, "month")),
    ("UMR 4.9 million", (4_900_000, 4_900_000, "month")),
    ("min 2 tahun, 6000000", (500_000, 500_000, "month")),
]
NO_SALARY = ["", None, "Gaji kompetitif", "nego", "USD 2000", "100 ribu", "S$ 300 juta sgd", "dirahasiakan 5 jt"]


def salary(raw):
    return None if raw is None else raw


def test_salary(spark):
    got = values(spark, parsers.parse_salary, [a for a, _ in SALARIES[:-1]])
    assert [tuple(g) for g in got] == [b for _, b in SALARIES[:-1]]
    assert {tuple(g) for g in values(spark, parsers.parse_salary, NO_SALARY)} == {(None, None, None)}


def test_levels(spark):
    check(spark, parsers.parse_education, [("Minimal D3/S1", "D1-D3"), ("S1 Teknik", "D4/S1"), ("SMA/SMK sederajat", "SMA/SMK"), ("Magister", "S2"), ("PhD", "S3"), ("SMP", "SMP"), ("elementary", "SD"), ("bebas", None), (None, None), ("S1 di bidang", "D1-D3"), ("D-IV", "D4/S1")])
    assert values(spark, lambda c: parsers.parse_education(c, True), ["S1 di bidang"]) == ["D4/S1"]
    check(spark, parsers.parse_experience, [("Fresh graduate", 0), ("2 tahun", 2), ("1-3 tahun", 1), ("1,5 thn", 1), ("18 bulan", 2), ("3 months", 0), ("6 bulan", 1), ("5", 5), ("lama", None), ("", None), (None, None), ("12 bulan", 1)])
    check(spark, parsers.parse_employment, [("Full-time", "full_time"), ("Magang", "internship"), ("Kontrak / tetap", "contract"), ("tetap, kontrak", "full_time"), ("paruh waktu", "part_time"), ("freelance", "freelance"), ("International", "internship"), ("x", None), (None, None)])
    assert math.floor(18 / 12 + 0.5) == 2


def test_pseudonym_needs_a_key(monkeypatch):
    monkeypatch.delenv("HMAC_SECRET", raising=False)
    with pytest.raises(RuntimeError):
        privacy.pseudonym(F.lit("x"))
