"""Records from landed directory pages: profile pages, search results, sections, and records that a crawler already took apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.functions.text import squeeze
from dossier.functions.values import ordered_union, strict_phone
from dossier.operators.extract import linked_data, strip_markup

#: Networks by what their links hold, in the order in which they are tried. Fixed values.
NETWORKS = [("linkedin", ["linkedin"]), ("twitter", ["twitter", "x.com"]), ("facebook", ["facebook"]), ("instagram", ["instagram"])]
#: Link texts that are no names. Fixed values.
NO_NAMES = ["view profile", "view lawyerprofile", "contact", "reviews", "email lawyer", "call lawyer"]
#: What makes the first part of an address a firm (anywhere in it). Fixed values.
FIRM_MARKS = ["LLP", "LLC", "PC", "PA", "INC", "PLLC", "LAW", "P.C.", "L.L.P.", "P.A."]


def _full(text: Column) -> Column:
    return F.nullif(squeeze(text), F.lit(""))


def is_placeholder_image(url: Column) -> Column:
    return F.coalesce(url.rlike("no-photo|no_photo|/amos_assets/"), F.lit(False))


def is_error_page(url: Column, html: Column) -> Column:
    """The address is that of an error page, or the first heading says error."""
    heading = F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    return F.coalesce(url.contains("error.html"), F.lit(False)) | F.coalesce(F.lower(heading).contains("error"), F.lit(False))


def firm_from_address(address: Column) -> Column:
    """The first comma part of an address of several, if one of ``FIRM_MARKS`` is in it."""
    first = F.trim(F.substring_index(address, ",", 1))
    marks = F.exists(F.array(*[F.lit(m) for m in FIRM_MARKS]), lambda m: F.upper(first).contains(m))
    return F.when(address.contains(",") & marks, first)


def address_from_lines(lines: Column, city: Column, state: Column, zip_: Column) -> Column:
    """One address of lines with <br> between them, town, state and zip; null where there is nothing."""
    text = F.regexp_replace(F.regexp_replace(lines, r"(?i)<br\s*/?>", "\n"), r"(?s)<[^>]*>", "\n")
    parts = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    town = F.concat_ws(", ", F.nullif(city, F.lit("")), F.nullif(state, F.lit("")))
    tail = F.trim(F.concat_ws(" ", town, F.nullif(zip_, F.lit(""))))
    return F.nullif(F.array_join(F.concat(F.coalesce(parts, F.array().cast("array<string>")), F.filter(F.array(tail), lambda x: x != "")), ", "), F.lit(""))


def visible_lines(html: Column) -> Column:
    """The text of a page, one line an element, white space squeezed and blank lines gone."""
    text = F.regexp_replace(strip_markup(html), r"(?s)<[^>]*>", "\n")
    lines = F.filter(F.transform(F.split(text, "\n"), squeeze), lambda x: x != "")
    return F.array_join(lines, "\n")


def section(text: Column, start: str, *ends: str) -> Column:
    """What stands between the line ``start`` and the first of the lines ``ends`` that follows (the end of the text otherwise); null if blank."""
    parts = [F.nullif(F.trim(F.regexp_extract(text, rf"(?is)(?:^|\n){start}\n(.*?)(?:\n{end}\n|\z)", 1)), F.lit("")) for end in ends]
    return F.coalesce(*parts)


def listed(text: Column, cut: str = r"\n|\s{2,}|•|\|") -> Column:
    """The different items of a text that bullets, bars, wide gaps or lines part, in order."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), cut), squeeze), lambda x: x != ""))


def networks(links: Column) -> Column:
    """map<network, link>: the last link to each network."""
    kind = lambda u: F.coalesce(*[F.when(F.exists(F.array(*[F.lit(m) for m in marks]), lambda m: u.contains(m)), F.lit(name)) for name, marks in NETWORKS])  # noqa: B023, E731
    pairs = F.filter(F.transform(F.coalesce(links, F.array().cast("array<string>")), lambda u: F.struct(kind(u).alias("key"), u.alias("value"))), lambda p: p["key"].isNotNull())
    start = F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))
    return F.aggregate(pairs, start, lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["key"]), F.map_from_entries(F.array(p))))


def profile_record(html: Column, url: Column) -> Column:
    """struct of a profile page: its JSON-LD first, the longer of both biographies, licence from its own section; null without a name.

    Empty values are null, a placeholder picture and "not available" are none.
    """
    ld = linked_data(html, "LocalBusiness")
    at = lambda path: _full(F.get_json_object(ld, path))
    by_class = lambda mark: squeeze(F.regexp_replace(F.regexp_extract(html, rf"(?is)<(\w+)[^>]*class=[\"'][^\"']*{mark}[^\"']*[\"'][^>]*>(.*?)</\1>", 2), r"(?s)<[^>]*>", " "))
    licence = by_class("(?:license-info|license-status|profile-license-summary|license-section|bar-admission-info)")
    said = lambda pattern: _full(F.regexp_extract(licence, pattern, 1))
    told, written = at("$.description"), _full(by_class("(?:show-less-bio|about-section-bio)"))
    image = F.coalesce(at("$.image.url"), F.when(~at("$.image").startswith("{"), at("$.image")))
    phone = at("$.telephone")
    areas = F.array_distinct(F.filter(F.transform(F.from_json(F.get_json_object(ld, "$.knowsAbout"), "array<string>"), squeeze), lambda x: x != ""))
    return F.when(
        at("$.name").isNotNull(),
        F.struct(
            at("$.name").alias("full_name"),
            F.when(told.isNull() | (F.length(written) > F.length(told)), written).otherwise(told).alias("bio"),
            F.when(~is_placeholder_image(image), image).alias("photo_url"),
            F.when(F.lower(phone) != "not available", phone).alias("phone"),
            at("$.address.streetAddress").alias("line1"), at("$.address.addressLocality").alias("city"), at("$.address.addressRegion").alias("state"), at("$.address.postalCode").alias("zip"),
            F.when(F.size(areas) > 0, areas).alias("practice_areas"),
            networks(F.from_json(F.get_json_object(ld, "$.sameAs"), "array<string>")).alias("social_links"),
            said(r"(?i)state\s*:?\s*([^·•|]+)").alias("license_state"), said(r"(?i)status\s*:?\s*([^·•|]+)").alias("license_status"),
            said(r"(?i)licensed[^·•|]*?(\d{4})").alias("admission_year"), F.coalesce(said(r"(?i)bar[^·•|]*#\s*(\d+)"), _full(F.get_json_object(linked_data(html, "Attorney"), "$.barNumber"))).alias("bar_number"),
            url.alias("source_profile_url"),
        ),
    )


def best_named(found: DataFrame, url: str = "url", name: str = "name", position: str = "pos") -> DataFrame:
    """One row a url, that with the longest name (the first of several); urls that only nameless links lead to go."""
    row = F.struct(*[F.col(c) for c in found.columns])
    best = found.where(F.length(name) > 0).groupBy(F.col(url).alias("_u")).agg(F.max_by(row, F.struct(F.length(name), -F.col(position))).alias("row"))
    return best.select("row.*")


def search_cards(pages: DataFrame) -> DataFrame:
    """(page_id, pos, url, name, location): the cards of each search page ``pages(page_id, html)``; the name is that of the card's JSON-LD, else its
    first link text that is one. Cards without a profile link or name go."""
    cards = pages.select("page_id", F.posexplode(F.slice(F.split("html", "serp-card organic-card"), 2, 1_000_000)).alias("pos", "card"))
    links = F.regexp_extract_all("card", F.lit(r"(?is)<a[^>]*href=[\"']([^\"'#]*/attorneys/[^\"'#]*)[\"']"), F.lit(1))
    texts = F.transform(F.regexp_extract_all("card", F.lit(r"(?is)<a[^>]*href=[\"'][^\"']*/attorneys/[^\"']*[\"'][^>]*>(.*?)</a>"), F.lit(1)), lambda x: squeeze(F.regexp_replace(x, r"(?s)<[^>]*>", " ")))
    shown = F.get(F.filter(texts, lambda t: (F.length(t) >= 3) & ~F.lower(t).isin(NO_NAMES)), F.lit(0))
    ld = linked_data(F.col("card"))
    place = lambda key: F.coalesce(F.get_json_object(ld, f"$.worksFor.address.{key}"), F.get_json_object(ld, f"$.address.{key}"))
    made = cards.select("page_id", "pos", F.get(links, F.lit(0)).alias("url"), F.coalesce(_full(F.get_json_object(ld, "$.name")), shown).alias("name"), F.concat_ws(", ", F.nullif(place("addressLocality"), F.lit("")), F.nullif(place("addressRegion"), F.lit(""))).alias("location"))
    return made.where("url is not null and name is not null")


def profile_anchors(pages: DataFrame, mark: str) -> DataFrame:
    """(page_id, pos, url, name, location): links that hold ``mark``, item by item of each list page; the location is the item's last
    line of 64 letters or less that has a letter. Links with no text of their own have an empty name."""
    items = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?is)<(?:li|article)[^>]*>(.*?)</(?:li|article)>"), F.lit(1))).alias("item", "body"))
    lines = F.filter(F.transform(F.split(F.regexp_replace("body", r"(?s)<[^>]*>", "\n"), "\n"), squeeze), lambda x: x.rlike("[A-Za-z]") & (F.length(x) <= 64))
    links = F.regexp_extract_all("body", F.lit(rf"(?is)<a[^>]*href=[\"']([^\"']*{mark}[^\"']*)[\"']"), F.lit(1))
    texts = F.regexp_extract_all("body", F.lit(rf"(?is)<a[^>]*href=[\"'][^\"']*{mark}[^\"']*[\"'][^>]*>(.*?)</a>"), F.lit(1))
    each = items.select("page_id", "item", F.element_at(lines, -1).alias("location"), F.posexplode(F.arrays_zip(links.alias("url"), texts.alias("text"))).alias("at", "x")).where(~F.col("x.url").rlike("client-review|contact|vcard|#"))
    name = squeeze(F.regexp_replace("x.text", r"(?s)<[^>]*>", " "))
    shown = F.when((F.length(name) >= 3) & ~F.lower(name).isin(NO_NAMES), name).otherwise("")
    return each.select("page_id", (F.col("item") * 1000 + F.col("at")).alias("pos"), F.col("x.url").alias("url"), shown.alias("name"), "location")


def section_record(html: Column, url: Column) -> Column:
    """struct<bio, practice_areas, languages, school, bar_number, source_profile_url> of a page whose headings part its text."""
    text = visible_lines(html)
    languages = F.filter(F.transform(listed(section(text, "Languages", "Professional Experience", "Education"), r"\n"), lambda x: F.trim(F.substring_index(x, ":", 1))), lambda x: (x != "") & (F.length(x) <= 30))
    return F.struct(
        section(text, "Biography", "Practice Areas", "Fees").alias("bio"),
        listed(section(text, "Practice Areas", "Fees", "Jurisdictions Admitted to Practice")).alias("practice_areas"),
        F.array_distinct(languages).alias("languages"),
        F.get(listed(section(text, "Education", "Professional Associations", "Websites & Blogs"), r"\n"), F.lit(0)).alias("school"),
        F.nullif(F.regexp_extract(text, r"(?i)State Bar\s*#\s*([0-9]{4,})", 1), F.lit("")).alias("bar_number"),
        url.alias("source_profile_url"),
    )


def experience_entries(html: Column) -> Column:
    """array<struct<years, title, description>> of the repeated "experience" parts of a page: first paragraph, bold text, and the rest."""
    plain = lambda x: squeeze(F.regexp_replace(x, r"(?s)<[^>]*>", " "))
    parts = F.slice(F.split(html, r"class=[\"']experience[\"'][^>]*>"), 2, 1_000_000)

    def entry(x: Column) -> Column:
        x = F.regexp_extract(x, r"(?is)^(.*?)(?:</div>|\z)", 1)
        years, title = plain(F.regexp_extract(x, r"(?is)<p[^>]*>(.*?)</p>", 1)), F.rtrim(plain(F.regexp_extract(x, r"(?is)<strong[^>]*>(.*?)</strong>", 1)), F.lit(", "))
        rest = plain(F.regexp_replace(F.regexp_replace(x, r"(?is)<p[^>]*>.*?</p>", " "), r"(?is)<strong[^>]*>.*?</strong>", " "))
        return F.struct(F.nullif(years, F.lit("")).alias("years"), F.nullif(title, F.lit("")).alias("title"), F.nullif(rest, F.lit("")).alias("description"))

    return F.filter(F.transform(parts, entry), lambda e: F.coalesce(e["years"], e["title"], e["description"]).isNotNull())


def first_key(document: Column, *keys: str) -> Column:
    """The first value among the keys of a JSON text that is neither null, empty text, [] nor {}."""
    found = [F.get_json_object(document, f"$.{key}") for key in keys]
    return F.coalesce(*[F.when(~v.isin("", "[]", "{}"), v) for v in found])


def crawled_record(item: Column) -> Column:
    """struct of a crawler's profile record (JSON text), whichever of its names a value goes by; a single value counts as a list of one, and
    practice areas may be texts or objects with a name."""
    text = lambda *keys: _full(first_key(item, *keys))
    several = lambda value: F.when(value.startswith("["), F.from_json(value, "array<string>")).when(value.isNotNull(), F.array(value))
    named = F.transform(several(first_key(item, "practiceAreas", "practice_areas")), lambda x: squeeze(F.when(x.startswith("{"), first_key(x, "name", "title", "practiceArea")).otherwise(x)))
    full = lambda a: F.filter(F.coalesce(a, F.array().cast("array<string>")), lambda x: x != "")
    areas = ordered_union(full(named), full(F.transform(several(first_key(item, "specialties")), squeeze)))
    phone = text("primary_phone", "phone", "phoneNumber")
    return F.struct(
        text("name", "full_name").alias("full_name"), text("bioSummary", "jobTitle", "bio", "about").alias("bio"), F.when(F.size(areas) > 0, areas).alias("practice_areas"),
        F.coalesce(strict_phone(phone), phone).alias("phone"), text("city").alias("city"), text("state", "licenseState").alias("license_state"), first_key(item, "rating").try_cast("double").alias("rating"),
        first_key(item, "reviewCount", "reviewsCount", "review_count").try_cast("int").alias("review_count"), text("website", "websiteUrl").alias("website_url"), text("url").alias("source_profile_url"), text("id").alias("directory_id"),
    )


def last_page(links: Column, listing: Column) -> Column:
    """The largest page number among the links to a listing's own pages, sorted views apart; null without one."""
    base = F.substring_index(listing, "?", 1)
    own = F.filter(links, lambda u: u.startswith(F.concat(base, F.lit("?"))) & ~u.contains("sort="))
    return F.array_max(F.transform(own, lambda u: F.nullif(F.regexp_extract(u, r"[?&]page=(\d+)", 1), F.lit("")).cast("int")))
