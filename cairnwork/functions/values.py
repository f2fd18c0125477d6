"""Column functions on numbers, years, places, URLs, arrays, maps, vectors and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- years -----------------------------------------------------------------------------------


def year_strict(c: Column, low: int = 1800, high: int = 2199) -> Column:
    """A text that is a year and nothing else."""
    y = F.regexp_extract(c, "^\\s*([0-9]{4})\\s*$", 1).try_cast("int")
    return F.when(y.between(low, high), y)


def year_anywhere(c: Column, low: int = 1800, high: int = 2100) -> Column:
    y = F.regexp_extract(c, "(?:^|[^0-9])([12][0-9]{3})(?:[^0-9]|$)", 1).try_cast("int")
    return F.when(y.between(low, high), y)


def year_leading(c: Column) -> Column:
    return F.regexp_extract(c, "^([0-9]{4})", 1).try_cast("int")


def years_in(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit("(?<![0-9])((?:1[89]|20)[0-9]{2})(?![0-9])"), 1))


# The first year after each era, and its label. Years from 9999 on have none.
ERAS = ((1900, "Pre-1900"), (1945, "1900-1945"), (1980, "1945-1980"), (2000, "1980-2000"), (2015, "2000-2015"), (9999, "2015+"))


def era(y: Column) -> Column:
    """The era of a year of completion, null without one."""
    out = F.when(y.isNull(), F.lit(None).cast("string"))
    for upper, label in ERAS:
        out = out.when(y < upper, label)
    return out


def year_kind(y: Column, now: int) -> Column:
    """The current year is a parameter: a query never reads the clock."""
    return F.when(y.isNull(), "unknown").when(y > now, "future").otherwise("completed")


def interval_gap(a_min: Column, a_max: Column, b_min: Column, b_max: Column) -> Column:
    """Years between two intervals; 0 if they touch; null if either is unknown."""
    known = a_min.isNotNull() & a_max.isNotNull() & b_min.isNotNull() & b_max.isNotNull()
    return F.when(known, F.greatest(F.lit(0), a_min - b_max, b_min - a_max))


def number_of(c: Column) -> Column:
    """1.234,5 and 1,234.5 and 1234: the last mark followed by other than three digits is the decimal one."""
    t = F.regexp_replace(F.trim(c), "[^0-9.,-]", "")
    comma_last = t.rlike(",[0-9]{1,2}$") | t.rlike("\\.[0-9]{3},[0-9]+$")
    return F.when(comma_last, F.regexp_replace(F.regexp_replace(t, "\\.", ""), ",", ".")).otherwise(F.regexp_replace(t, ",", "")).try_cast("double")


def square_metres(c: Column) -> Column:
    """Area text in square metres; null where the unit is unknown."""
    n = number_of(F.regexp_extract(c, "([0-9][0-9.,]*)", 1))
    unit = F.lower(c)
    return F.when(unit.rlike("sq\\.? ?f|ft2|ft²|square f"), F.round(n * 0.09290304, 2)).when(unit.rlike("hectare|\\bha\\b"), n * 10000).when(unit.rlike("m2|m²|sqm|sq\\.? ?m|square m"), n)


def place_parts(c: Column) -> Column:
    """(city, region, country) of a comma-separated place."""
    p = F.transform(F.split(c, ","), lambda x: F.trim(x))
    n = F.size(p)
    return F.struct(F.when(n >= 1, F.get(p, F.lit(0))).alias("city"), F.when(n >= 3, F.get(p, F.lit(1))).alias("region"), F.when(n >= 2, F.get(p, n - 1)).alias("country"))


# --- URLs ------------------------------------------------------------------------------------


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def source_label(url: Column, labels: list[tuple[str, str]]) -> Column:
    """The first label whose part the host contains."""
    out = F.lit("other")
    for part, label in reversed(labels):
        out = F.when(host(url).contains(part), label).otherwise(out)
    return out


def https(url: Column) -> Column:
    return F.when(url.startswith("//"), F.concat(F.lit("https:"), url)).otherwise(F.regexp_replace(url, "^http://", "https://"))


def asset_key(url: Column) -> Column:
    """uuid, else long hex run, else the last path segment."""
    u = F.nullif(F.regexp_extract(url, "([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})", 1), F.lit(""))
    h = F.nullif(F.regexp_extract(url, "([0-9a-f]{16,})", 1), F.lit(""))
    return F.coalesce(u, h, F.nullif(F.regexp_extract(url, "([^/?#]+)(?:[?#].*)?$", 1), F.lit("")))


def rewrite_host(url: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(url, pattern, replacement)


def slug(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.rtrim(F.regexp_replace(url, "[?#].*$", ""), F.lit("/")), "([^/]+)$", 1))


def compare_key(url: Column) -> Column:
    """Percent-decoded, without scheme, www, query and trailing slash."""
    bare = F.regexp_replace(F.regexp_replace(url, "^[a-zA-Z]+://(www\\.)?", ""), "[?#].*$", "")
    return F.lower(F.rtrim(F.coalesce(F.try_url_decode(bare), bare), F.lit("/")))


def is_raster(url: Column) -> Column:
    return F.lower(F.regexp_replace(url, "[?#].*$", "")).rlike("\\.(jpe?g|png|webp|tiff?)$")


# --- vectors ---------------------------------------------------------------------------------


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column, eps: float = 1e-12) -> Column:
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(eps))


def normalized(a: Column) -> Column:
    """Null for a vector of norm 0."""
    n = norm(a)
    return F.when(n > 0, F.transform(a.cast("array<double>"), lambda x: x / n))


def softmax(a: Column) -> Column:
    e = F.transform(a.cast("array<double>"), lambda x: F.exp(x - F.array_max(a)))
    total = F.aggregate(e, F.lit(0.0), lambda s, x: s + x)
    return F.transform(e, lambda x: x / total)


def vector_text(a: Column, digits: int = 6) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(a.cast("array<double>"), lambda x: F.format_string(f"%.{digits}f", x)), ","), F.lit("]"))


def vector_parse(c: Column) -> Column:
    return F.from_json(c, "array<double>")


# --- arrays and maps ---------------------------------------------------------------------------


def array_of(c: Column) -> Column:
    """A JSON array of texts; a text that is none becomes its single element; blank is empty."""
    parsed = F.when(F.trim(c).startswith("["), F.from_json(c, "array<string>"))
    blank = c.isNull() | (F.trim(c) == "")
    return F.coalesce(parsed, F.when(blank, F.array().cast("array<string>")).otherwise(F.array(c)))


def list_length(c: Column) -> Column:
    """Length of a JSON array; 0 for whatever else, null and broken texts among it."""
    return F.coalesce(F.when(F.trim(c).startswith("["), F.json_array_length(c)), F.lit(0))


def ordered_union(a: Column, b: Column) -> Column:
    """a, then what b adds, first seen first; null counts as empty."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(a, empty), F.coalesce(b, empty)))


def merged_maps(a: Column, b: Column) -> Column:
    """Maps of arrays, key by key united."""
    return F.map_zip_with(a, b, lambda k, x, y: ordered_union(x, y))


def is_present(c: Column, kind: str) -> Column:
    """Neither null nor blank nor empty."""
    return F.coalesce(F.size(c) > 0 if kind.startswith(("array", "map")) else F.trim(c) != "" if kind == "string" else c.isNotNull(), F.lit(False))


# --- hashes ------------------------------------------------------------------------------------


def canonical_hash(**fields: Column) -> Column:
    """SHA-256 of the fields as JSON, in the order of their names; null fields stand as null."""
    return F.sha2(F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"}), 256)


def joined_hash(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\0", *parts), 256)


def edge_id(a: Column, b: Column) -> Column:
    """The same for (a, b) and (b, a)."""
    x, y = a.cast("string"), b.cast("string")
    return F.sha2(F.concat_ws("\0", F.least(x, y), F.greatest(x, y)), 256)


def parity_coin(c: Column) -> Column:
    """0 or 1 from the sum of the text's code points."""
    return F.pmod(F.aggregate(F.split(c, ""), F.lit(0), lambda s, x: s + F.when(x == "", 0).otherwise(F.ascii(x))), F.lit(2))


# --- perceptual hashes -------------------------------------------------------------------------


def hex_distance(a: Column, b: Column, digits: int = 64) -> Column:
    """Bits that differ between two hexadecimal texts, in limbs of 32 bits."""
    limb = lambda c, i: F.conv(F.substring(c, i, 8), 16, 10).cast("long")
    return sum((F.bit_count(limb(a, i).bitwiseXOR(limb(b, i))) for i in range(1, digits + 1, 8)), F.lit(0))


def interleaved_bands(bits: Column, n: int, bands: int) -> Column:
    """band:bits of every band; band k has the places k, k + bands, ... So distance below `bands` means a shared band."""
    return F.array(*(F.concat(F.lit(f"{k}:"), *(F.substring(bits, i + 1, 1) for i in range(k, n, bands))) for k in range(bands)))


def distance_class(d: Column, same_block: Column) -> Column:
    return F.when(d <= 8, "strong").when((d <= 16) & same_block, "review").otherwise("rejected")
