"""Place names to region codes: a gazetteer table and resolution of distinct raw strings by joins with it.

A gazetteer is one table: key, and what the key may stand for: an alias' code, a regency's full name, a province,
and the regencies that bear the bare name. Its rows come from two reference files of known size; it is broadcast
only while its row count is below MAX_BROADCAST.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import ascii_fold, collapse_ws, none_if_empty

# Words around place names.
REMOTE = r"(?iU)\bremote\b|work from home|\bwfh\b|kerja dari rumah|jarak jauh|anywhere"
REGENCY_PREFIX = r"(?iU)^(kab|kabupaten|regency)\b\.?\s*(adm\.?\s*)?"
CITY_PREFIX = r"(?iU)^(kota|city of|kodya|kotamadya)\b\.?\s*(adm\.?\s*)?"
KIND_SUFFIX = r"(?iU)\s+(city|regency)$"
PROVINCE_PREFIX = r"(?iU)^(provinsi|propinsi|prov\.?|province of)\s+"
CITY_NAMES, REGENCY_NAMES = ("kota", "kota adm"), ("kabupaten", "kab", "kab adm")
MAX_BROADCAST = 200_000


def place_key(text: Column, exact: bool = False) -> Column:
    """Folded words without punctuation and five-digit post codes."""
    plain = F.replace(F.lower(ascii_fold(F.coalesce(text, F.lit("")), exact)), F.lit("kep."), F.lit("kepulauan "))
    return collapse_ws(F.regexp_replace(F.regexp_replace(plain, r"\b\d{5}\b", " "), "[^a-z0-9 ]+", " "))


def regency_kind(name: Column) -> Column:
    """City or regency by the name's prefix."""
    return F.when(F.upper(name).rlike(r"^KOTA[ .]"), "kota").when(F.upper(name).rlike(r"^(KAB[. ]|KABUPATEN )"), "kab")


def regions(provinces: DataFrame, regencies: DataFrame) -> DataFrame:
    """(region_code, name, level, kind, province_code) from two code lists: provinces (code, name), regencies (code, name, parent)."""
    top = provinces.select(F.col("code").alias("region_code"), "name", F.lit("province").alias("level"), F.lit(None).cast("string").alias("kind"), F.col("code").alias("province_code"))
    return top.unionByName(regencies.select(F.col("code").alias("region_code"), "name", F.lit("regency").alias("level"), regency_kind(F.col("name")).alias("kind"), F.col("parent").alias("province_code")))


def build(regions: DataFrame, aliases: DataFrame) -> DataFrame:
    """(key, alias, full, province, bare): codes by key; bare: sorted array of (code, its province).

    regions: region_code, name, level, kind, province_code; aliases: alias, region_code.
    """
    key = place_key(F.col("name"))
    provinces = regions.filter("level = 'province'")
    names = provinces.select(key.alias("key"), "region_code").unionByName(provinces.select(F.replace(key, F.lit("kepulauan "), F.lit("")).alias("key"), "region_code"))
    named = [names.groupBy("key").agg(F.max("region_code").alias("code")).select("key", F.lit("province").alias("what"), "code", F.col("code").alias("of"))]
    regencies = regions.filter("level <> 'province'")
    bare = F.regexp_replace(F.regexp_replace(F.lower("name"), REGENCY_PREFIX, ""), CITY_PREFIX, "")
    core = place_key(F.replace(bare, F.lit("adm."), F.lit("")))
    forms = F.when(F.col("kind") == "kota", F.array(*(F.concat(F.lit(f"{p} "), core) for p in CITY_NAMES))).otherwise(F.array(*(F.concat(F.lit(f"{p} "), core) for p in REGENCY_NAMES)))
    full = regencies.select(F.explode(F.array_append(forms, key)).alias("key"), "region_code", "province_code")
    named.append(full.groupBy("key").agg(F.max("region_code").alias("code"), F.max_by("province_code", "region_code").alias("of")).select("key", F.lit("full").alias("what"), "code", "of"))
    named.append(regencies.select(core.alias("key"), F.lit("bare").alias("what"), F.col("region_code").alias("code"), F.col("province_code").alias("of")))
    of = regions.select(F.col("region_code").alias("__c"), "province_code")
    with_of = aliases.join(of, F.col("region_code") == F.col("__c"), "left").select(place_key(F.col("alias")).alias("key"), F.lit("alias").alias("what"), F.col("region_code").alias("code"), F.coalesce("province_code", F.left("region_code", F.lit(2))).alias("of"))
    named.append(with_of.groupBy("key", "what").agg(F.max("code").alias("code"), F.max_by("of", "code").alias("of")))
    rows = named[0]
    for more in named[1:]:
        rows = rows.unionByName(more)

    def one(what: str) -> Column:
        return F.max(F.when(F.col("what") == what, F.struct("code", "of"))).alias(what)

    return rows.groupBy("key").agg(one("alias"), one("full"), one("province"), F.array_sort(F.collect_set(F.when(F.col("what") == "bare", F.struct("code", "of")))).alias("bare"))


def _with_lookups(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """Adds what a piece's three keys find: __suffix (code, of), and __alias, __full, __province, __bare."""
    kind = F.lower(F.regexp_extract("piece", KIND_SUFFIX, 1))
    stem = F.regexp_replace("piece", KIND_SUFFIX, "")
    keyed = pieces.withColumns(
        {
            "__k1": F.when(kind != "", place_key(F.concat(F.when(kind == "city", "kota ").otherwise("kabupaten "), stem))),
            "__k2": none_if_empty(place_key(stem)),
            "__k3": none_if_empty(place_key(F.regexp_replace("piece", PROVINCE_PREFIX, ""))),
        }
    )
    small = places.count() <= MAX_BROADCAST
    hint = F.broadcast if small else (lambda df: df)
    out = keyed.join(hint(places.select(F.col("key").alias("__k1"), F.col("full").alias("__suffix"))), "__k1", "left")
    out = out.join(hint(places.select(F.col("key").alias("__k2"), F.col("alias").alias("__alias"), F.col("full").alias("__full"), F.col("bare").alias("__bare"))), "__k2", "left")
    return out.join(hint(places.select(F.col("key").alias("__k3"), F.col("province").alias("__province"))), "__k3", "left")


def _code(hint: Column) -> Column:
    """struct(code, of) of a piece under a province hint (null: none), by precedence."""
    bare = F.coalesce(F.col("__bare"), F.array().cast("array<struct<code:string,of:string>>"))
    only = F.get(bare, F.lit(0))
    inside = F.filter(bare, lambda b: b["of"] == hint)
    provinces = F.array_distinct(F.transform(bare, lambda b: b["of"]))
    as_province = lambda p: F.struct(p.alias("code"), p.alias("of"))
    several = F.when(hint.isNotNull(), F.when(F.size(inside) == 1, F.get(inside, F.lit(0))).otherwise(as_province(hint))).when(F.size(provinces) == 1, as_province(F.get(provinces, F.lit(0))))
    return F.coalesce(
        F.col("__suffix"),
        F.when(
            F.col("__k2").isNotNull(),
            F.coalesce(
                F.col("__alias"),
                F.col("__full"),
                F.col("__province"),
                F.when((F.size(bare) == 1) & (hint.isNull() | (only["of"] == hint)), only).when(F.size(bare) > 1, several),
            ),
        ),
    )


def resolve(raws: DataFrame, places: DataFrame, raw: str = "raw") -> DataFrame:
    """(raw, region_code, province_code, is_remote) for each distinct raw string.

    Alternatives stand between bars; of "place, ..., province" the right-most province is the hint for the places
    before it; the first place that resolves wins, else the hint.
    """
    distinct = raws.select(F.col(raw).alias("raw")).distinct()
    remote = F.coalesce(F.col("raw").rlike(REMOTE), F.lit(False))
    only_remote = remote & ~F.regexp_replace(F.lower("raw"), REMOTE, "").rlike("[a-z]{4,}")
    parts = distinct.filter(~F.coalesce(only_remote, F.lit(False))).select("raw", F.posexplode(F.split("raw", r"\|")).alias("part", "text"))
    split = F.filter(F.transform(F.split("text", ","), lambda p: F.trim(F.regexp_replace(p, r"(?U)^\s+|\s+$", ""))), lambda p: p != "")
    pieces = parts.select("raw", "part", F.posexplode(split).alias("at", "piece"))
    found = _with_lookups(pieces, places)
    free = _code(F.lit(None).cast("string"))
    of_part = Window.partitionBy("raw", "part")
    # the hint: the right-most two-digit code behind the first piece
    hint = F.max(F.when((F.col("at") > 0) & (F.length(free["code"]) == 2), F.struct("at", free["code"].alias("code")))).over(of_part)["code"]
    hinted = found.withColumn("__hint", hint)
    coded = hinted.withColumn("__found", _code(F.col("__hint")))
    best = coded.groupBy("raw", "part").agg(F.min(F.when(F.col("__found").isNotNull(), F.struct("at", "__found"))).alias("first"), F.max("__hint").alias("hint"))
    code = F.coalesce(F.col("first")["__found"]["code"], F.col("hint"))
    of = F.coalesce(F.col("first")["__found"]["of"], F.col("hint"))
    per_raw = best.groupBy("raw").agg(F.min(F.when(code.isNotNull(), F.struct("part", code.alias("code"), of.alias("of")))).alias("best"))
    per_raw = per_raw.select(F.col("raw").alias("__raw"), F.col("best")["code"].alias("region_code"), F.col("best")["of"].alias("province_code"))
    return distinct.join(per_raw, F.col("raw") == F.col("__raw"), "left").select("raw", "region_code", "province_code", remote.alias("is_remote"))


def refine(located: DataFrame, address: str, places: DataFrame) -> DataFrame:
    """Rows known only to their province get the regency in it that their street address names first; others stay."""
    todo = located.filter((F.length("region_code") == 2) & F.col(address).isNotNull()).select("province_code", F.col(address).alias("__a")).distinct()
    pieces = todo.select("province_code", "__a", F.posexplode(F.split("__a", ",")).alias("at", "piece")).withColumn("piece", F.trim("piece"))
    found = _with_lookups(pieces, places).withColumn("__c", _code(F.col("province_code")))
    inside = (F.length(F.col("__c")["code"]) == 4) & (F.col("__c")["of"] == F.col("province_code"))
    best = found.filter(inside).groupBy("province_code", "__a").agg(F.min_by(F.col("__c")["code"], "at").alias("__code"))
    keyed = located.withColumn("__a", F.when(F.length("region_code") == 2, F.col(address)))
    return keyed.join(best, ["province_code", "__a"], "left").withColumn("region_code", F.coalesce("__code", "region_code")).select(*located.columns)
