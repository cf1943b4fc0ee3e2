"""Normalisation of business names and addresses, as expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Legal forms, name rewrites, address rewrites.
LEGAL_TOKENS = [
    "pvt", "private", "ltd", "limited", "llc", "llp", "lp", "inc", "incorporated", "corp", "corporation", "co", "company", "plc", "pllc", "pc", "gmbh",
    "ag", "sarl", "sas", "sasu", "sa", "eurl", "sci", "snc", "the", "dba", "opc", "pty", "bv", "nv", "srl", "spa", "cie",
]
NAME_MAP = {
    "&": "and", "intl": "international", "mfg": "manufacturing", "svcs": "services", "svc": "services", "ent": "enterprises", "bros": "brothers",
    "assoc": "associates", "tech": "technologies", "techs": "technologies", "sys": "systems", "mgmt": "management", "dept": "department",
    "ctr": "center", "centre": "center", "st": "saint", "ste": "sainte",
}
ADDR_MAP = {
    "rd": "road", "st": "street", "str": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "bd": "boulevard", "bld": "building",
    "bldg": "building", "dr": "drive", "ln": "lane", "ct": "court", "pl": "place", "sq": "square", "hwy": "highway", "pkwy": "parkway",
    "fwy": "freeway", "cir": "circle", "ste": "suite", "apt": "apartment", "fl": "floor", "flr": "floor", "nr": "near", "opp": "opposite",
    "mkt": "market", "ngr": "nagar", "clny": "colony", "sec": "sector", "ph": "phase", "no": "number", "chs": "chemin", "rte": "route",
    "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest",
}


@lru_cache(None)
def accent_table() -> tuple[str, str, dict[str, str], str]:
    """(characters, their bases, characters with several bases, a pattern of those) of compatibility decomposition without marks.

    Characters without a base come last in the first string: translate() removes them.  Hangul syllables are in the
    pattern only: their parts follow from their number.
    """
    one, base, gone, many = [], [], [], {}
    for c in range(0x80, 0x30000):
        if 0xD800 <= c < 0xE000 or 0xAC00 <= c < 0xD7A4:
            continue
        ch = chr(c)
        plain = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if plain == ch:
            continue
        if not plain:
            gone.append(ch)
        elif len(plain) == 1:
            one.append(ch)
            base.append(plain)
        else:
            many[ch] = plain
    starts = [c for c in many if chr(ord(c) - 1) not in many]
    ranges = [(c, next(chr(x) for x in range(ord(c), 0x30001) if chr(x + 1) not in many)) for c in starts]
    return "".join(one + gone), "".join(base), many, "[\uac00-\ud7a3" + "".join(f"{a}-{b}" for a, b in ranges) + "]"


def _jamo(ch: Column) -> Column:
    """The parts of a Hangul syllable, by arithmetic on its number; any other character as it is."""
    row = lambda first, n, skip: F.array(*[F.lit("" if skip and not k else chr(first + k)) for k in range(n)])
    k = F.ascii(ch) - 0xAC00
    at = lambda xs, x: F.get(xs, x.cast("int"))
    parts = F.concat(at(row(0x1100, 19, False), F.floor(k / 588)), at(row(0x1161, 21, False), F.floor(k % 588 / 28)), at(row(0x11A7, 28, True), k % 28))
    return F.when((ch >= "\uac00") & (ch <= "\ud7a3"), parts).otherwise(ch)


def strip_accents(c: Column) -> Column:
    """Compatibility decomposition without marks.

    Texts of ASCII alone are as they are.  In others, characters with one base are translated, and each distinct
    character of several bases is replaced in one pass (the bases hold none, so their order is of no account); only
    distinct characters are tried against the long pattern.
    """
    src, dst, many, pattern = accent_table()
    out, other = F.translate(c, src, dst), "[^\\x00-\\x7F]"
    spelt = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in many.items())), F.lit("\x01"), F.lit("\x02"))
    held = F.filter(F.array_distinct(F.regexp_extract_all(out, F.lit(other), F.lit(0))), lambda ch: ch.rlike(pattern))
    whole = F.aggregate(held, out, lambda acc, ch: F.replace(acc, ch, F.coalesce(F.try_element_at(spelt, ch), _jamo(ch))))
    return F.when(c.rlike(other), whole).otherwise(c)


def basic_clean(c: Column) -> Column:
    out = F.replace(F.lower(strip_accents(F.coalesce(c, F.lit("")))), F.lit("&"), F.lit(" and "))
    out = F.regexp_replace(out, r"(?<=[a-z])\.(?=[a-z])", "")
    return F.trim(F.regexp_replace(out, "[^a-z0-9]+", " "))


def tokens(c: Column) -> Column:
    return F.array_remove(F.split(c, " "), "")


def rewrite(toks: Column, mapping: dict[str, str]) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.transform(toks, lambda t: F.coalesce(F.try_element_at(pairs, t), t))


def norm_name(c: Column) -> Column:
    return F.array_join(rewrite(tokens(basic_clean(c)), NAME_MAP), " ")


def core_of(name_n: Column) -> Column:
    """Without legal forms; a name of legal forms alone stays."""
    legal = F.array(*[F.lit(t) for t in LEGAL_TOKENS])
    core = F.array_join(F.filter(tokens(name_n), lambda t: ~F.array_contains(legal, t)), " ")
    return F.when(core == "", name_n).otherwise(core)


def norm_addr(c: Column) -> Column:
    return F.array_join(rewrite(tokens(basic_clean(c)), ADDR_MAP), " ")


def postal_codes(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?U)\b(\d{5,6})\b"), F.lit(1)))


def numbers(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?U)(\d+)"), F.lit(1)))


def full(name_core: Column, addr_n: Column) -> Column:
    return F.concat(name_core, F.lit(" | "), addr_n)


def normalised(records: DataFrame) -> DataFrame:
    """Records with name_n, name_core, addr_n, full_n, postal, nums, postal1, country_n."""
    raw = F.coalesce("business_address", F.lit(""))
    out = records.withColumns({"name_n": norm_name(F.col("business_name")), "addr_n": norm_addr(F.col("business_address"))})
    out = out.withColumn("name_core", core_of(F.col("name_n")))
    return out.withColumns(
        {
            "full_n": full(F.col("name_core"), F.col("addr_n")),
            "postal": postal_codes(raw),
            "nums": numbers(raw),
            "country_n": basic_clean(F.col("country")),
        }
    ).withColumn("postal1", F.coalesce(F.array_min(F.transform("postal", lambda x: x.cast("int"))), F.lit(0)))
