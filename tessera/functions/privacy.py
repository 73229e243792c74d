"""Masking of contact details and keyed pseudonyms, as Columns."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import company_key, none_if_empty

MASK, NAME_MASK = "[disamarkan]", "[perusahaan]"
# What counts as a contact detail.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(?U)(?<![\w.])(?:(?:\+?62|0)[\s.-]?8\d{1,3}(?:[\s.-]?\d{2,4}){2,3}|\(?0\d{1,3}\)?[\s.-]?\d{3,4}[\s.-]?\d{3,4})(?![\w])"
CONTACT_LINK = r"(?iU)(?:https?://)?(?:wa\.me|api\.whatsapp\.com|chat\.whatsapp\.com|t\.me|line\.me)/\S+"
CUES = r"hubungi|menghubungi|a\.n\.?|atas nama|cp|contact person|kontak|narahubung"
TITLES = r"bapak|ibu|bpk|bu|pak|mr|mrs|ms|sdr|sdri"
# A cue, and one to three words of which the first begins with a capital; the cue stays. A lower-case word behind a
# cue is not consumed, so a real name right after it is still found.
CONTACT_NAME = rf"(?U)((?i:\b(?:{CUES})\s*[:.]?\s*(?:(?:{TITLES})\.?\s+)?))([A-Z](?i:[a-z]+)(?i:\s+[A-Z][a-z]+){{0,2}})"


# The same matches, sought only where one can begin: an address at the beginning of its run of characters or behind the
# last match (a long run is read once, not from each of its characters), a phone or a cue at its possible first characters.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL_RUN = EMAIL.replace(f"{_LOCAL}+@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@")
PHONE_START = PHONE.replace("(?U)", "(?U)(?=[+(06])")
NAME_START = CONTACT_NAME.replace("(?U)(", "(?U)(?=[achkmnACHKMN\u212a])(", 1)
# What every contact link holds.
LINK_HOST = r"(?i)\.(?:me|com)/"


def mask_text(text: Column) -> Column:
    """Links, e-mails, phones and names behind a contact cue, each replaced; null becomes empty.

    Masks hold neither an at sign nor a host, so the text as it came tells which patterns have anything to find.
    """
    out = F.coalesce(text, F.lit(""))
    out = F.when(text.rlike(LINK_HOST), F.regexp_replace(out, CONTACT_LINK, MASK)).otherwise(out)
    out = F.when(text.contains("@"), F.regexp_replace(out, EMAIL_RUN, MASK)).otherwise(out)
    return F.regexp_replace(F.regexp_replace(out, PHONE_START, MASK), NAME_START, f"$1{MASK}")


def find_pii(text: Column) -> Column:
    """Kinds of contact details in a text, in fixed order."""
    found = {"email": text.contains("@") & text.rlike(EMAIL_RUN), "phone": text.rlike(PHONE_START), "contact_link": text.rlike(LINK_HOST) & text.rlike(CONTACT_LINK)}
    return F.array_compact(F.array(*(F.when(has, F.lit(kind)) for kind, has in found.items())))


def hmac_sha256(key: bytes, message: Column) -> Column:
    """HMAC-SHA256 in hex, by the definition, over two SHA-256 Columns; the padded keys are literals of the plan."""
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.unhex(F.lit(bytes(b ^ pad for b in key).hex())) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(message, "UTF-8")), 256))), 256)


def pseudonym(name: Column, key: bytes | None = None, exact: bool = True) -> Column:
    """Twelve hex digits for a company; null for an empty name. The key comes from HMAC_SECRET unless given."""
    if key is None:
        if not os.environ.get("HMAC_SECRET"):
            raise RuntimeError("HMAC_SECRET is not set")
        key = os.environ["HMAC_SECRET"].encode()
    return F.left(hmac_sha256(key, none_if_empty(company_key(name, exact))), F.lit(12))


def name_patterns(name: Column, exact: bool = True) -> Column:
    """Patterns (first, second) of a company's own name and key, longer one first; null for names under three characters."""
    pattern = lambda what: F.when(F.length(what) >= 3, F.concat(F.lit(r"(?iU)(?<!\w)"), F.regexp_replace(what, r"([^\p{L}\p{N}\s])", r"\\$1"), F.lit(r"(?!\w)")))
    names = F.array(F.struct(F.trim(name).alias("raw"), company_key(name, exact).alias("key")))  # a lambda's argument is computed once
    longer = lambda x: F.length(x["key"]) > F.length(x["raw"])
    both = lambda x: F.struct(pattern(F.when(longer(x), x["key"]).otherwise(x["raw"])).alias("first"), pattern(F.when(longer(x), x["raw"]).otherwise(x["key"])).alias("second"))
    return F.transform(names, both)[0]


def hide_patterns(text: Column, patterns: Column) -> Column:
    """A text without what the patterns of `name_patterns` find."""
    for which in ("first", "second"):
        text = F.when(patterns[which].isNotNull(), F.regexp_replace(text, patterns[which], NAME_MASK)).otherwise(text)
    return text


def hide_name(text: Column, name: Column, exact: bool = True) -> Column:
    """A text without the company's own name and key, longer one first; names under three characters stay."""
    return F.when(text.isNull() | name.isNull() | (F.length(name) == 0), text).otherwise(hide_patterns(text, name_patterns(name, exact)))
