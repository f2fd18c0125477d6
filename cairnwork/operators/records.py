"""Serving records: the projection that is published, the reasons a record is held back, and the checks over whole tables of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnwork.functions import values as V

# What is no material, and which of it names an element.
MATERIAL_NOISE = (
    "balconies", "columns", "courtyard", "courtyards", "curtains", "facade", "facade cladding", "furniture", "garden", "garden planting",
    "grass", "greenery", "green roof", "landscape", "landscaping", "light", "lighting", "planting", "plants", "skylights",
    "stairs", "terrace", "terraces", "trees", "vegetation", "walls", "water", "window frames", "windows",
)
ELEMENT_OF = {
    "balconies": "Balcony", "columns": "Column", "courtyard": "Courtyard", "courtyards": "Courtyard", "facade": "Facade", "facade cladding": "Facade",
    "garden": "Garden", "green roof": "Roof", "skylights": "Skylight", "stairs": "Stair", "terrace": "Terrace", "terraces": "Terrace",
}
# Words that do not tell one record's name from another's.
GENERIC_NAMES = (
    "a", "an", "and", "apartment", "apartments", "building", "casa", "center", "centre", "gallery", "garden", "home", "house", "housing", "in", "of",
    "office", "pavilion", "private", "project", "residence", "school", "social", "summer", "the", "tower", "villa",
)
# Tiers, image types and the reason given to a record whose materials were all noise.
TIERS = ("T1", "T2", "T3")
IMAGE_TYPES = ("exterior", "interior", "drawing", "aerial", "detail")
NOISE_ONLY = "material_noise_only"
# Area bands in square feet by slug.
SIZE_BANDS = {
    "sqft_0_1": (0, 1000), "sqft_1_3": (1000, 3000), "sqft_3_5": (3000, 5000), "sqft_5_10": (5000, 10000), "sqft_10_25": (10000, 25000),
    "sqft_25_100": (25000, 100000), "sqft_100_300": (100000, 300000), "sqft_300_500": (300000, 500000), "sqft_500_1000": (500000, 1000000), "sqft_1000": (1000000, None),
}


def lits(values) -> Column:
    return F.array(*map(F.lit, values))


def lookup(table: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))


def _texts(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def reclassified(material: Column, elements: Column) -> Column:
    """struct(material, elements, gained): noise leaves the materials; what of it is an element joins the elements once, in order. Null counts as empty."""
    raw, held = _texts(material), _texts(elements)
    low = lambda v: F.lower(F.trim(v))
    named = F.filter(F.transform(F.filter(raw, lambda v: low(v).isin(*MATERIAL_NOISE)), lambda v: F.element_at(lookup(ELEMENT_OF), low(v))), lambda e: e.isNotNull())
    gained = F.array_except(F.array_distinct(named), held)
    return F.struct(F.filter(raw, lambda v: ~low(v).isin(*MATERIAL_NOISE)).alias("material"), F.concat(held, gained).alias("elements"), gained.alias("gained"))


def publish_reasons(name: Column, refs: Column, urls: Column, images: Column, cover: Column) -> Column:
    """Why a record may not be shown; an empty array if it may."""
    none = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    rules = {"missing_name": blank(name), "missing_source_refs": none(refs), "missing_source_urls": none(urls), "missing_all_images": none(images), "missing_display_cover_url": blank(cover)}
    return F.array_compact(F.array(*(F.when(bad, reason) for reason, bad in rules.items())))


def generic_name(name: Column) -> Column:
    """At most one distinctive word of two characters or more; a name without words is not generic."""
    words = F.regexp_extract_all(F.lower(name), F.lit("[a-z0-9]+"), 0)
    own = F.filter(words, lambda w: ~w.isin(*GENERIC_NAMES) & (F.length(w) > 1))
    return F.coalesce((F.size(words) > 0) & (F.size(own) <= 1), F.lit(False))


def serving_rows(df: DataFrame, axes: dict[str, Column] | None = None) -> DataFrame:
    """The published projection of records.

    Needs id, name, city, country, year, material, elements, reasons (array), publishable, images, cover, tier, n_sources. Materials are
    reclassified; a record whose materials were noise alone, and gave no element, is withheld with that reason. The era always comes
    from the year. `axes` are overlays: their values go before the record's own columns of that name.
    """
    new = df.withColumn("__m", reclassified(F.col("material"), F.col("elements")))
    hollow = (F.coalesce(F.size("material"), F.lit(0)) > 0) & (F.size("__m.material") == 0) & (F.size("__m.gained") == 0)
    reasons = _texts(F.col("reasons"))
    noted = F.when(hollow & ~F.array_contains(reasons, NOISE_ONLY), F.array_append(reasons, NOISE_ONLY)).otherwise(reasons)
    own = [F.coalesce(c, F.col(a)).alias(a) if a in df.columns else c.alias(a) for a, c in (axes or {}).items()]
    return new.select(
        "id", "name", "city", "country", "year", F.col("__m.material").alias("material"), F.col("__m.elements").alias("elements"), _texts(F.col("images")).alias("images"), "cover", "tier", "n_sources",
        (F.coalesce("publishable", F.lit(False)) & ~hollow).alias("publishable"), noted.alias("reasons"), V.era(F.col("year")).alias("era"), *own,
    )


def tally(df: DataFrame, kind: str, rules: dict[str, Column]) -> DataFrame:
    """(kind, rule, n): how many rows break each rule, all rules in one pass; a null counts as kept."""
    counts = df.agg(*(F.count_if(F.coalesce(bad, F.lit(False))).alias(f"__{i}") for i, bad in enumerate(rules.values())))
    rows = F.array(*(F.struct(F.lit(kind).alias("kind"), F.lit(rule).alias("rule"), F.col(f"__{i}").alias("n")) for i, rule in enumerate(rules)))
    return counts.select(F.inline(rows))


def repeated(df: DataFrame, column: str) -> DataFrame:
    """(column, n) of values, not null, that stand in two rows or more."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def upload_checks(rows: DataFrame) -> DataFrame:
    """(kind, rule, n) over serving rows: failures bar an upload, warnings do not."""
    empty = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    hollow = empty("material") & ~F.array_contains("reasons", NOISE_ONLY) & empty("elements")
    failures = tally(rows, "failure", {
        "missing_required": F.col("id").isNull() | blank("name") | F.col("tier").isNull(), "invalid_confidence_tier": ~F.coalesce(F.col("tier").isin(*TIERS), F.lit(False)), "bad_material_visual": hollow,
        "bad_architectural_elements": F.exists("elements", lambda e: ~e.isin(*sorted(set(ELEMENT_OF.values())))), "publishable_missing_image": F.col("publishable") & (empty("images") | blank("cover")),
    })
    warnings = tally(rows, "warning", {
        "nonpublishable_rows": ~F.col("publishable"), "empty_all_images": empty("images"), "missing_display_cover_url": blank("cover"), "missing_location_country": blank("country"),
        "missing_location_city": blank("city"), "missing_project_year": F.col("year").isNull(), "genericish_name_rows": generic_name(F.col("name")),
    })
    key = repeated(rows, "id").agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).select(F.lit("failure").alias("kind"), F.lit("duplicate_pk").alias("rule"), "n")
    cover = repeated(rows.where("publishable"), "cover").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("failure").alias("kind"), F.lit("display_cover_url_reused").alias("rule"), "n")
    names = repeated(rows.select(F.nullif(F.lower(F.trim(F.regexp_replace("name", "\\s+", " "))), F.lit("")).alias("name")), "name")
    groups = names.agg(F.count("*").alias("duplicate_name_groups"), F.count_if(generic_name(F.col("name"))).alias("generic_duplicate_name_groups"))
    groups = groups.select(F.inline(F.array(*(F.struct(F.lit("warning").alias("kind"), F.lit(c).alias("rule"), F.col(c).alias("n")) for c in groups.columns))))
    return reduce(DataFrame.union, (failures, key, cover, warnings, groups))


def coverage(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """(field, filled, pct) of each field's presence, in one pass; pct is null for an empty table."""
    counts = df.agg(F.count("*").alias("__n"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(f) for f, c in fields.items()))
    rows = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("filled"), F.round(F.try_divide(F.col(f), F.col("__n")), 4).alias("pct")) for f in fields))
    return counts.select(F.inline(rows))


def tag_checks(stats: DataFrame, centroids: DataFrame, labels: DataFrame, total: DataFrame, vocabulary: list, label_from: int) -> DataFrame:
    """(check, bad, status) of tag tables: stats (tag, doc_freq, total_n, idf), centroids (tag, centroid, n), labels (tag) and one row total (n).

    Sums, formula, keys, counts, unit lengths and vocabulary fail; a missing label of a frequent tag warns.
    """
    one = F.broadcast(total.select(F.col("n").alias("__n")))  # one row
    gone = lambda a, b: a.join(b.select("tag"), "tag", "left_anti").agg(F.count("*").alias("bad"))
    apart = lambda bad: F.count_if(F.coalesce(bad, F.lit(True))).alias("bad")
    checks = [
        ("total_n", stats.join(one).agg(apart(F.col("total_n") != F.col("__n"))), "FAIL"),
        ("sum_doc_freq", stats.agg(F.coalesce(F.sum("doc_freq"), F.lit(0)).alias("s")).join(one).select((F.col("s") != F.col("__n")).cast("long").alias("bad")), "FAIL"),
        ("idf_formula", stats.agg(apart(F.abs(F.col("idf") - F.ln(F.col("total_n") / (F.col("doc_freq") + 1))) > 1e-9)), "FAIL"),
        ("stats_without_centroid", gone(stats, centroids), "FAIL"), ("centroid_without_stats", gone(centroids, stats), "FAIL"), ("stats_without_label", gone(stats, labels), "FAIL"),
        ("count_of_centroid", stats.join(centroids, "tag").agg(apart(F.col("doc_freq") != F.col("n"))), "FAIL"),
        ("unit_length", centroids.agg(apart(F.abs(V.norm(F.col("centroid")) - 1) > 1e-5)), "FAIL"),
        ("out_of_vocabulary", stats.agg(apart(~F.col("tag").isin(*vocabulary))), "FAIL"),
        ("frequent_without_label", gone(stats.where(F.col("doc_freq") >= label_from), labels), "WARN"),
    ]
    return reduce(DataFrame.union, (df.select(F.lit(name).alias("check"), F.col("bad").cast("long").alias("bad"), F.when(F.col("bad") == 0, "PASS").otherwise(grade).alias("status")) for name, df, grade in checks))


def review_status(critical: Column, other: Column) -> Column:
    return F.when(critical > 0, "fail").when(other > 0, "warning").otherwise("pass")


def requeue(text_bad: Column, image_bad: Column) -> Column:
    """Which stage must do a record again: the text stage goes first, null if neither."""
    return F.when(F.size(text_bad) > 0, "enrichment").when(F.size(image_bad) > 0, "image_analysis")


# --- names, places, links -----------------------------------------------------------------------

# What tells an article about a building from its name, and the longest name.
ARTICLE_VERBS = r"(?i)\b(?:wins?|won|announces?|announced|reveals?|revealed|applies|applied|uses?|used|opens?|opened|presents?|presented|launches?|launched|unveil(?:s|ed)?|debuts?|debuted|nominates?|nominated)\b"
EVENT_WORDS = r"(?i)\b(?:biennale|symposium|conference|lecture|award|nominat|finalist|winner|competition\s+for|short\s*list|long\s*list|prize)\b"
LONGEST_NAME = 70


def article_title(name: Column) -> Column:
    """The reason why a name is an article's title, null if it is none."""
    return F.when(F.coalesce(name, F.lit("")) == "", "empty_name").when(F.length(name) > LONGEST_NAME, "name_too_long").when(name.rlike(ARTICLE_VERBS), "action_verb").when(name.rlike(EVENT_WORDS), "non_building_keyword")


def reality(name: Column, many_sources: Column, firm_known: Column, signals: dict[str, Column]) -> Column:
    """struct(decision, tier, reason): sources first, then the name, then the firm, then structural facts; without any a record is deferred."""
    title, known = article_title(name), {k: F.coalesce(c, F.lit(False)) for k, c in signals.items()}
    found = F.concat_ws("+", *(F.when(c, k) for k, c in known.items()))
    any_known = reduce(lambda a, b: a | b, known.values())
    row = lambda d, t, r: F.struct(F.lit(d).alias("decision"), F.lit(t).cast("string").alias("tier"), r.alias("reason"))
    out = F.when(many_sources, row("KEEP", "T1", F.lit("L1_cross_source"))).when(title.isNotNull(), row("DROP", None, F.concat(F.lit("L2_"), title)))
    out = out.when(~F.coalesce(firm_known, F.lit(False)), row("DROP", None, F.lit("L3_no_architect_link"))).when(any_known, row("KEEP", "T2", F.concat(F.lit("L3_struct_signal:"), found)))
    return out.otherwise(row("DEFER_L4", None, F.lit("L3_no_struct_defer_to_L4")))


def country_of(text: Column, known: list[str], names: list[str]) -> Column:
    """The known country that a text is or ends with (its last one to four words); null for digits, for unknown ones and for a person's or firm's name."""
    bare = F.regexp_replace(F.trim(text), r"[\s\-,/.;:]+$", "")
    words = F.split(bare, r"\s+")
    tails = F.transform(F.sequence(F.lit(1), F.least(F.lit(4), F.size(words))), lambda n: F.array_join(F.slice(words, -n, n), " "))
    first = F.get(F.filter(F.concat(F.array(bare), tails), lambda t: t.isin(*known)), F.lit(0))
    return F.when(bare.rlike("^[0-9]*$") | F.lower(first).isin(*names), None).otherwise(first)


def city_of(text: Column, country: Column, known: list[str], names: list[str]) -> Column:
    """A city's name; null for blanks, digits, one letter, a country, and names of people or firms, whole or word by word."""
    s = F.trim(text)
    low = F.lower(s)
    words = F.filter(F.split(low, r"[\s,;.&|/]+"), lambda w: F.length(w) >= 3)
    leaked = (F.size(words) > 0) & F.forall(words, lambda w: w.isin(*names))
    bad = (s == "") | s.rlike(r"^[\d\s\-]+$|^[A-Za-z]$") | F.coalesce(low == F.lower(country), F.lit(False)) | s.isin(*known) | low.isin(*names) | leaked
    return F.when(~bad, s)


def own_link(url: Column, brands: str) -> Column:
    """A social link, null if blank, without a host or of one of the brands that publish the sources (a pattern)."""
    u = F.trim(url)
    at = F.regexp_extract(F.when(u.contains("://"), u).otherwise(F.concat(F.lit("https://"), u)), "^[^:]+://([^/?#]*)", 1)
    return F.when((u != "") & (at != "") & ~F.lower(u).rlike(brands), u)


def without_boilerplate(text: Column, pattern: str) -> Column:
    """struct(text, status, removed): text without what a site's controls put into it."""
    n = F.regexp_count(text, F.lit(pattern))
    bare = F.trim(F.regexp_replace(F.regexp_replace(text, pattern, " "), r"\s+", " "))
    blank = F.coalesce(F.trim(text), F.lit("")) == ""
    status = F.when(blank, "missing").when(bare == "", "rejected_ui_only").when(n > 0, "ui_removed").otherwise("clean")
    return F.struct(F.nullif(bare, F.lit("")).alias("text"), status.alias("status"), F.coalesce(n, F.lit(0)).cast("int").alias("removed"))


def size_band(slug: Column, display: Column) -> Column:
    """struct(min_sqft, max_sqft, is_open, status): a known slug is confirmed unless the display disagrees (review); a display alone is a candidate."""
    numbers = F.transform(F.regexp_extract_all(display, F.lit(r"[0-9][0-9,]*"), 0), lambda x: F.regexp_replace(x, ",", "").cast("int"))
    n = F.coalesce(F.size(numbers), F.lit(0))
    open_ = (n == 1) & display.contains("+")
    low, high, shown = F.get(numbers, F.lit(0)), F.when(n >= 2, F.get(numbers, F.lit(1))), F.coalesce((n >= 2) | open_, F.lit(False))
    band = F.element_at(F.create_map(*(x for k, (a, b) in SIZE_BANDS.items() for x in (F.lit(k), F.struct(F.lit(a).alias("a"), F.lit(b).cast("int").alias("b"))))), F.lower(F.coalesce(slug, F.lit(""))))
    differs = shown & ~((low == band["a"]) & high.eqNullSafe(band["b"]))
    status = F.when(band.isNotNull(), F.when(differs, "review").otherwise("confirmed")).when(shown, "candidate").otherwise("review")
    a, b = F.when(band.isNotNull(), band["a"]).when(shown, low), F.when(band.isNotNull(), band["b"]).when(shown, high)
    return F.struct(a.alias("min_sqft"), b.alias("max_sqft"), (b.isNull() & a.isNotNull()).alias("is_open"), status.alias("status"))


# --- vocabularies --------------------------------------------------------------------------------


def first_program(tags: Column, programs: dict[str, str]) -> Column:
    """struct(program, reason) of the first tag that names one."""
    hit = F.get(F.filter(_texts(tags), lambda x: x.isin(*programs)), F.lit(0))
    reason = F.when(F.size(_texts(tags)) == 0, "no_tags").when(hit.isNull(), "no_typology_tag_match").otherwise(F.concat(F.lit("matched:"), hit))
    return F.struct(F.coalesce(F.element_at(lookup(programs), hit), F.lit("Other")).alias("program"), reason.alias("reason"))


def bucket_of(slug: Column, known: list[str], buckets: dict[str, list[str]]) -> Column:
    """typology for a known tag, else the first bucket one of whose stems starts a word of it, else drop."""
    n = F.regexp_replace(F.lower(F.trim(slug)), "[-_]+", " ")
    out = F.when(n.isin(*known), "typology")
    starts = lambda stems: lambda w: reduce(lambda a, b: a | b, (w.startswith(x) for x in stems))
    for name, stems in buckets.items():
        out = out.when(F.exists(F.split(n, " "), starts(stems)), name)
    return out.otherwise("drop")


def migrated(value: Column, vocabulary: list[str], legacy: dict[str, str | None], aliases: dict[str, str] | None = None) -> Column:
    """struct(value, reason): kept, its case mended, migrated or dropped by the legacy table.

    What remains is unknown and null; with `aliases` it goes by the first alias it contains, else it stays.
    """
    low = F.lower(F.trim(value))
    row = lambda v, r: F.struct(v.cast("string").alias("value"), F.lit(r).cast("string").alias("reason"))
    out = F.when(F.coalesce(value, F.lit("")) == "", row(value if aliases is not None else F.lit(None), None)).when(value.isin(*vocabulary), row(value, None))
    out = out.when(low.isin(*(v.lower() for v in vocabulary)), row(F.element_at(lookup({v.lower(): v for v in vocabulary}), low), "case_normalized"))
    for old, new in legacy.items():
        out = out.when(low == old, row(F.lit(new), "legacy_dropped" if new is None else "legacy_migrated"))
    for part, new in (aliases or {}).items():
        out = out.when(low.contains(part), row(F.lit(new), "loose_alias"))
    return out.otherwise(row(F.lit(None), "unknown_value") if aliases is None else row(value, None))


def primary_type(counts: DataFrame, key: str, tag: str, n: str, context: list[str], ancillary: list[str], order: list[str]) -> DataFrame:
    """(key, tag) of the primary type: context types only where nothing else is, then the higher count, main uses before ancillary ones, then the stated order."""
    place = F.coalesce(F.array_position(lits(order), F.col(tag)), F.lit(0))
    rank = F.struct(~F.col(tag).isin(*context), F.col(n), ~F.col(tag).isin(*ancillary), -F.when(place > 0, place).otherwise(1000))
    return counts.groupBy(key).agg(F.max_by(tag, rank).alias(tag))


def axis_values(text: dict[str, Column], vision: dict[str, Column], vision_first: set[str]) -> dict[str, Column]:
    """axis -> struct(value, source): the text's value, or the image's for the axes where it goes first; the other one fills gaps."""
    out = {}
    for a, x in text.items():
        y = vision.get(a, F.lit(None).cast("string"))
        first, second = (y, x) if a in vision_first else (x, y)
        names = ("vision", "text") if a in vision_first else ("text", "vision")
        out[a] = F.struct(F.coalesce(first, second).alias("value"), F.when(first.isNotNull(), names[0]).when(second.isNotNull(), names[1]).alias("source"))
    return out


# Words of file names by image type, in the order in which they are tried.
IMAGE_WORDS = {
    "drawing": ("plan", "section", "elevation", "axonometr", "diagram", "sketch", "drawing", "constructive", "isometric"),
    "aerial": ("aerial", "drone", "birdseye", "bird-eye", "topdown", "top-down", "rooftop"),
    "interior": ("interior", "indoor", "lobby", "kitchen", "bedroom", "living", "bathroom", "hall", "atrium", "corridor"),
    "detail": ("detail", "closeup", "close-up", "texture", "joint", "macro"),
}


def image_type(url: Column, alt: Column, hint: Column) -> Column:
    """struct(type, confidence) by the source's hint, then by words of URL and caption; exterior with low confidence without any."""
    text = F.lower(F.concat_ws(" ", url, alt))
    row = lambda k, c: F.struct(F.lit(k).alias("type"), F.lit(c).alias("confidence"))
    out = F.when(hint == "drawing", row("drawing", "high"))
    for kind, words in IMAGE_WORDS.items():
        out = out.when(text.rlike("|".join(words)), row(kind, "high"))
    return out.otherwise(row("exterior", "low"))


# Axes of an image that name its legacy class.
AERIAL = ("aerial_oblique", "aerial_top_down")
CLOSE = ("element_detail", "material_detail")
ARCHIVED = ("construction_visible", "ruin_or_abandoned_visible", "demolition_visible")
DRAWN = ("drawing", "rendering", "physical_model")


def image_class(in_scope: Column, medium: Column, context: Column, framing: Column, camera: Column, state: Column, unsure: Column) -> Column:
    """struct(class, others, usage): the legacy class and what else an image shows, from orthogonal axes, and whether it may be used."""
    drawn, aerial, close = medium.isin(*DRAWN), camera.isin(*AERIAL), framing.isin(*CLOSE)
    main = F.when(~in_scope, "unknown").when(drawn, "drawing").when(medium != "photograph", "unknown").when(aerial, "aerial").when(close, "detail").when(context.isin("interior", "exterior"), context).otherwise("unknown")
    shown = {"drawing": drawn, "aerial": aerial, "detail": close, "interior": context.isin("interior", "threshold"), "exterior": context.isin("exterior", "threshold")}
    others = F.array_compact(F.array(*(F.when(in_scope & c & (main != k), k) for k, c in shown.items())))
    review = (main == "unknown") | medium.isin("mixed", "other", "unknown") | (context == "threshold") | unsure
    usage = F.when(~in_scope, "rejected").when(state.isin(*ARCHIVED), "archive_only").when(review, "review_required").otherwise("eligible")
    return F.struct(main.alias("class"), others.alias("others"), usage.alias("usage"))
