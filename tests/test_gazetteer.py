from pyspark.sql import functions as F

from tessera.operators import gazetteer

REGIONS = [
    ("31", "DKI JAKARTA", "province", None, None), ("32", "JAWA BARAT", "province", None, None), ("36", "BANTEN", "province", None, None), ("19", "KEPULAUAN BANGKA BELITUNG", "province", None, None), ("35", "JAWA TIMUR", "province", None, None),
    ("3171", "KOTA ADM. JAKARTA SELATAN", "regency", "kota", "31"), ("3204", "KAB. BANDUNG", "regency", "kab", "32"), ("3273", "KOTA BANDUNG", "regency", "kota", "32"),
    ("3603", "KAB. TANGERANG", "regency", "kab", "36"), ("3671", "KOTA TANGERANG", "regency", "kota", "36"), ("3276", "KOTA DEPOK", "regency", "kota", "32"), ("3578", "KOTA SURABAYA", "regency", "kota", "35"),
    ("3699", "KAB. SERUPA", "regency", "kab", "36"), ("3299", "KAB. SERUPA", "regency", "kab", "32"),
]
ALIASES = [("jaksel", "3171"), ("jabar", "32")]
CASES = [
    ("Kota Bandung", "3273", "32", False), ("Bandung", "32", "32", False), ("Bandung City", "3273", "32", False), ("Bandung Regency, West Java", "3204", "32", False),
    ("Depok, Jawa Barat", "3276", "32", False), ("Depok", "3276", "32", False), ("Jaksel", "3171", "31", False), ("Tangerang, Banten 15141", "36", "36", False),
    ("Provinsi Banten", "36", "36", False), ("Bangka Belitung", "19", "19", False), ("Kep. Bangka Belitung", "19", "19", False), ("Depok, Banten", "36", "36", False),
    ("Nowhere | Surabaya", "3578", "35", False), ("Remote", None, None, True), ("Depok (remote)", None, None, True), ("Remote, Jabar", "32", "32", True),
    ("Serupa", None, None, False), ("Serupa, Jawa Barat", "3299", "32", False), ("", None, None, False), (None, None, None, False), (" , | ,", None, None, False),
    ("Kab Bandung", "3204", "32", False), ("Unknown place, Jawa Timur", "35", "35", False),
]


def places(spark):
    return gazetteer.build(spark.createDataFrame(REGIONS, "region_code string, name string, level string, kind string, province_code string").withColumn("province_code", F.coalesce("province_code", "region_code")), spark.createDataFrame(ALIASES, "alias string, region_code string"))


def test_resolve(spark):
    raws = spark.createDataFrame([(c[0],) for c in CASES] * 2, "raw string")
    got = {r["raw"]: (r["region_code"], r["province_code"], r["is_remote"]) for r in gazetteer.resolve(raws, places(spark)).collect()}
    assert got == {c[0]: c[1:] for c in CASES}


def test_refine(spark):
    rows = [(1, "32", "32", "Jl. Satu, Cipondoh, Bandung City, 40111"), (2, "32", "32", "Jl. Dua, Tangerang City"), (3, "3276", "32", "Kota Bandung"), (4, None, None, "Kota Bandung"), (5, "36", "36", None)]
    df = spark.createDataFrame(rows, "id int, region_code string, province_code string, street string")
    got = {r["id"]: r["region_code"] for r in gazetteer.refine(df, "street", places(spark)).collect()}
    assert got == {1: "3273", 2: "32", 3: "3276", 4: None, 5: "36"}


def test_kind(spark):
    df = spark.createDataFrame([("KOTA BATAM",), ("Kab. X",), ("KABUPATEN Y",), ("Z",)], "n string").coalesce(1)
    assert [r[0] for r in df.select(gazetteer.regency_kind(F.col("n"))).collect()] == ["kota", "kab", "kab", None]
