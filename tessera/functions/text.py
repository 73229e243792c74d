"""Text functions as Columns: white space, folding, keys, cutting, hashing. Null rules are each function's own."""

from __future__ import annotations

import html
import unicodedata
from functools import cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that company keys leave out.
COMPANY_SUFFIXES = ("pt", "cv", "tbk", "persero", "perseroan terbatas", "ud", "pd", "koperasi", "yayasan", "ltd", "inc", "co", "corp", "group", "grup", "indonesia", "id")
# Latin letters with marks and the letters that compatibility decomposition leaves of them.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def collapse_ws(text: Column) -> Column:
    """Runs of white space become one space, none at the ends; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def none_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


@cache
def fold_table() -> tuple[str, str, str, list[str]]:
    """What compatibility decomposition leaves in ASCII of single characters: those that leave one and what they leave; those
    that leave more, longest first, and for each place what stands there (only the first of them reach a later place)."""
    left = {}
    for char in map(chr, range(0x80, 0x110000)):
        if unicodedata.decomposition(char):
            left[char] = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
    one = [c for c, plain in left.items() if len(plain) == 1]
    many = sorted((c for c, plain in left.items() if len(plain) > 1), key=lambda c: -len(left[c]))
    longest = len(left[many[0]])
    return "".join(one), "".join(left[c] for c in one), "".join(many), ["".join(left[c][i] for c in many if len(left[c]) > i) for i in range(longest)]


def ascii_fold(text: Column, exact: bool = True) -> Column:
    """Compatibility decomposition without what is not ASCII; null stays null. exact=False knows Latin-1 letters only.

    Characters decompose one by one, so a table of all that leave anything in ASCII is enough. ASCII texts do not meet
    it; texts are taken apart into characters only where one of them leaves several.
    """
    if not exact:
        return F.regexp_replace(F.translate(text, ACCENTED, PLAIN), r"[^\x00-\x7F]", "")
    one, plain, many, places = fold_table()
    in_many = lambda c: F.translate(c, many, "") != c
    spread = F.transform(F.split(text, ""), lambda c: F.when(in_many(c), F.concat(*(F.translate(c, many, p) for p in places))).otherwise(c))
    whole = F.when(in_many(text), F.array_join(spread, "")).otherwise(text)
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.translate(whole, one, plain), r"[^\x00-\x7F]+", "")).otherwise(text)


def _plain_words(text: Column, exact: bool) -> Column:
    return F.regexp_replace(F.lower(ascii_fold(F.coalesce(text, F.lit("")), exact)), "[^0-9a-z ]+", " ")


def company_key(name: Column, exact: bool = True) -> Column:
    """A company's name without marks, punctuation and legal words; the whole name if nothing else is in it."""
    words = _plain_words(name, exact)
    short = collapse_ws(F.regexp_replace(words, rf"\b({'|'.join(COMPANY_SUFFIXES)})\b", " "))
    return F.coalesce(none_if_empty(short), collapse_ws(words))


def title_key(title: Column, exact: bool = True) -> Column:
    return collapse_ws(_plain_words(title, exact))


def truncate(text: Column, limit: int) -> Column:
    """At most `limit` characters of whole words, with an ellipsis where any are left out."""
    whole = collapse_ws(text)
    cut = F.regexp_replace(F.left(whole, F.lit(limit)), " [^ ]*$", "")
    return F.when(F.length(whole) <= limit, whole).otherwise(F.concat(F.regexp_replace(cut, r"[,.;:\-]+$", ""), F.lit("…")))


def short_id(value: Column) -> Column:
    return F.concat(F.lit("v"), F.substring(F.sha1(F.encode(value, "UTF-8")), 1, 10))


def content_hash(title: Column, company: Column, location: Column, description: Column, chars: int = 500, exact: bool = True) -> Column:
    """What makes two listings the same: their title, company, place and the beginning of the description."""
    parts = (title_key(title, exact), company_key(company, exact), title_key(location, exact), title_key(F.left(description, F.lit(chars)), exact))
    return F.sha1(F.concat_ws("|", *parts))


def region_label(name: Column) -> Column:
    """Capitalised words; DKI and DI stay in capitals."""
    words = F.split(F.trim(F.regexp_replace(name, r"\s+", " ")), " ")
    return F.array_join(F.transform(words, lambda w: F.when(F.upper(w).isin("DKI", "DI"), F.upper(w)).otherwise(F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substring(w, 2, 1 << 20))))), " ")


def skill_key(skill: Column) -> Column:
    return F.regexp_replace(F.lower(collapse_ws(skill)), r"^[ .;:\-]+|[ .;:\-]+$", "")


def safe_id(value: Column) -> Column:
    """A path-safe id of at most 120 characters."""
    safe = F.left(F.regexp_replace(value, r"(?U)[^\p{L}\p{N}\-_.]", "_"), F.lit(120))
    return F.coalesce(none_if_empty(safe), F.left(F.sha1(value), F.lit(16)))


BLOCKS = {"br", "p", "li", "div", "h1", "h2", "h3", "h4", "tr"}


class _Lines(HTMLParser):
    """Text of a page; a block's end, and a void block, end a line."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        if tag == "br":
            self.parts.append("\n")

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCKS:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        if tag in BLOCKS:
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def html_lines(value: str | None) -> str:
    """Plain text: one line without markup, else a line for each block; empty lines are dropped."""
    if not value:
        return ""
    if "<" not in value:
        return " ".join(html.unescape(value).split())
    parser = _Lines()
    parser.feed(value)
    parser.close()
    lines = (" ".join(line.split()) for line in "".join(parser.parts).splitlines())
    return "\n".join(line for line in lines if line)


@F.pandas_udf(T.StringType())
def html_to_text(value: pd.Series) -> pd.Series:
    return value.map(html_lines)


def strip_tags(value: Column) -> Column:
    """The JVM's own subset of html_to_text: one line, five named entities, scripts and styles left out."""
    text = F.regexp_replace(value, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    text = F.regexp_replace(text, "(?s)<[^>]*>", " ")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return collapse_ws(text)


def strip_fences(text: Column) -> Column:
    """The content of a fenced block, or the text itself."""
    inner = F.regexp_extract(F.trim(text), r"(?s)^```(?:json)?\s*(.*?)\s*```$", 1)
    return F.when(F.trim(text).rlike(r"(?s)^```(?:json)?\s*(.*?)\s*```$"), inner).otherwise(F.trim(text))


def json_items(content: Column, item: str) -> Column:
    """A reply's array of objects (DDL `item`): fenced or not, bare or the only array of an object; null if there is none."""
    body = strip_fences(content)
    bare = F.from_json(body, f"array<{item}>", {"mode": "PERMISSIVE"})
    fields = F.from_json(body, "map<string,string>")
    arrays = F.filter(F.map_values(fields), lambda v: F.trim(v).startswith("["))
    inside = F.from_json(F.get(arrays, F.lit(0)), f"array<{item}>")
    return F.when(body.startswith("["), bare).when(body.startswith("{") & (F.size(arrays) == 1), inside)
