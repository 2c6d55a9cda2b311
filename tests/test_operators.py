"""Operators on small tables: ties, nulls, repeated rows, empty tables, extra columns."""

import os
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from dossier import session
from dossier.operators import areas, dedupe, extract, match, merge, pages, rank, score
from dossier.plans import operators
from dossier.session import table
from dossier.sources import readers, registry, writers


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_dedupe_by_licence(spark):
    df = spark.createDataFrame([(1, "100", "CA", 10), (2, "#100", "ca", 50), (3, " 100 ", "CA", 50), (4, None, "CA", 1), (5, "", "CA", 1)], "id long, bar_number string, license_state string, completeness_score int")
    assert rows(dedupe.dedupe_by_licence(df), "id") == [(2,), (4,), (5,)]
    assert dedupe.dedupe_by_licence(df.limit(0)).count() == 0


def test_survivors_and_children(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 9), (3, "a", 9), (4, None, 1)], "id long, k string, s int")
    moves = dedupe.survivors(df, ["k"], F.struct("s", -F.col("id")))
    assert rows(moves, "winner", "loser") == [(2, 1), (2, 3)]
    children = spark.createDataFrame([(1, "x"), (3, "x"), (2, "y"), (1, "y"), (9, "z")], "pid long, src string")
    assert rows(dedupe.repoint_children(children, moves, "pid", "src"), "pid", "src") == [(2, "x"), (2, "y"), (9, "z")]


def test_rank_with_quota_drops_groups_without_one(spark):
    df = spark.createDataFrame([("CA", 1, 5.0), ("CA", 2, 7.0), ("CA", 3, 7.0), ("NY", 4, 9.0), ("WI", 5, 9.0)], "state string, id long, s double")
    quotas = spark.createDataFrame([("CA", 2), ("WI", 0)], "state string, quota int")
    assert rows(rank.rank_with_quota(df, "state", [F.col("s").desc(), F.col("id")], quotas), "id", "rank") == [(2, 1), (3, 2)]


def test_stop_after_overshoots_by_one_row(spark):
    df = spark.createDataFrame([("a", 1, 60), ("a", 2, 60), ("a", 3, 60)], "g string, at int, n int")
    assert rows(rank.stop_after(df, ["g"], [F.col("at")], F.col("n"), 100), "at") == [(1,), (2,)]


def test_ordered_distinct(spark):
    df = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("a", "x", 0), ("a", None, 3)], "k string, v string, at int")
    assert rank.ordered_distinct(df, ["k"], "v", "at").first()["values"] == ["x", "y"]


def claims(spark, data):
    rows = [(key, field, value, source, layer, pos, [field] if locked is True else locked or None) for key, field, value, source, layer, pos, locked in data]
    return spark.createDataFrame(rows, "key string, field string, value string, source string, layer int, pos int, locked array<string>")


def merged(spark, data):
    return {r.field: r for r in merge.rule_merge(claims(spark, data)).collect()}


def test_rule_merge(spark):
    got = merged(spark, [
        ("k", "bio", '"old"', "justia", 3, 0, False), ("k", "bio", '"new"', "lawdex", 3, 1, False),
        ("k", "email", '"a@x"', "justia", 3, 0, False), ("k", "email", '" A@X "', "lawdex", 3, 1, False),
        ("k", "areas", '["a","b","c","d"]', "justia", 3, 0, False), ("k", "areas", '["A","B","C","D","e"]', "lawdex", 3, 1, False),
        ("k", "full_name", '"Ann"', "justia", 3, 0, False), ("k", "full_name", '"Bea"', "lawdex", 3, 1, False),
        ("k", "fax", '"1"', "justia", 3, 0, True), ("k", "firm", '"x"', "justia", 3, 0, False), ("k", "firm", '"y"', "justia", 3, 1, False),
        ("k", "empty", '""', "justia", 3, 0, False), ("k", "empty", None, "justia", 3, 1, False),
    ])
    assert got["bio"].value == '"old"' and got["bio"].needs_review and got["bio"].conflicts == {"justia": '"old"', "lawdex": '"new"'}
    assert not got["email"].needs_review and got["email"].action == "duplicate"
    assert got["areas"].action == "duplicate"
    assert got["full_name"].value == '"Ann"' and got["full_name"].action == "identity"
    assert got["fax"].value is None and got["fax"].action == "curated"
    assert got["firm"].value == '"y"' and got["firm"].action == "refreshed"
    assert got["empty"].value is None


def test_listing_phone_settles_the_conflict_unless_curated(spark):
    base = [("k", "phone", '"1"', "justia", 3, 0, False), ("k", "phone", '"2"', "lawdex", 3, 1, False), ("k", "formatted_phone", '"3"', "maps", 4, 2, False)]
    got = merged(spark, base)["phone"]
    assert got.value == '"3"' and not got.needs_review and got.source == "maps"
    listing = (*base[2][:6], ["phone"])
    # The lock is the profile's, whether or not a source sends the field itself.
    for sent in ([("k", "phone", '"1"', "justia", 3, 0, True), listing], [listing]):
        locked = merged(spark, sent)["phone"]
        assert locked.value is None and locked.action == "curated"


def test_priority_merge(spark):
    data = [("k", "bar_number", "9", "google_places", 3, 0, False), ("k", "bar_number", "7", "state_bars", 1, 1, False), ("k", "bio", " ", "justia", 3, 0, False), ("k", "other", "b", "y", 3, 1, False), ("k", "other", "a", "x", 3, 0, False)]
    assert rows(merge.priority_merge(claims(spark, data), merge.SOURCE_PRIORITY), "field", "value", "source") == [("bar_number", "7", "state_bars"), ("other", "a", "x")]


def test_upsert_policies(spark):
    old = spark.createDataFrame([(1, "a", 2, True), (2, "b", 2, False), (3, "c", None, None)], "id int, v string, level int, locked boolean")
    new = spark.createDataFrame([(1, "x", 3), (2, "y", 1), (3, "z", 0), (4, "w", 1)], "id int, v string, level int")
    got = merge.upsert(old, new, "id", {"v": merge.guarded("v", F.col("o.locked"), "level"), "level": merge.largest("level")})
    assert rows(got, "id", "v", "level") == [(1, "a", 3), (2, "b", 2), (3, "z", 0), (4, "w", 1)]


def test_deep_merge(spark):
    df = spark.createDataFrame([({"a": "1", "b": '""'}, {"b": "2", "c": "3", "a": "9"})], "w map<string,string>, l map<string,string>")
    assert df.select(merge.deep_merge(F.col("w"), F.col("l"))).first()[0] == {"a": "1", "b": "2", "c": "3"}


def test_scores(spark):
    columns = {f: F.lit("x") for f in ["bar_number", "license_state", "full_name", "bio", "photo_url", "phone", "email"]}
    tests = score.tier_tests(columns | {"bio": F.lit("None"), "email": F.lit(None).cast("string")}, F.array(F.lit("a")), F.lit(True))
    assert spark.range(1).select(score.tier_score(tests)).first()[0] == 15 * 4 + 10 + 10 + 5


@pytest.mark.parametrize(
    "cand, target, expected",
    [
        (("Ann Doe", "Any Town, CA", None), ("Ann Doe", "Ann", "Doe", "Any Town", "ca", "california", None), 1.0),
        (("Bob Doe", "Any Town, CA", None), ("Ann Doe", "Ann", "Doe", "Any Town", "ca", "california", None), 0.0),
        (("X", None, " ab1 "), ("Ann Doe", None, None, None, "", "", "AB1"), 1.0),
        (("A Doe", "Elsewhere", None), ("Ann Doe", "Ann", "Doe", "Any Town", "ca", "california", None), 0.6),
        ((None, None, None), ("Ann Doe", "Ann", "Doe", "Any Town", "ca", "california", None), 0.0),
    ],
)
def test_score_candidates(spark, cand, target, expected):
    schema = "name string, location string, bar_number string, full_name string, first_name string, last_name string, city string, state_code string, state_name string, target_bar string"
    assert match.score_candidates(spark.createDataFrame([cand + target], schema)).first().confidence == expected


def test_possible_pairs_are_all_that_reach_the_cut(spark):
    data = "/root/testdata/sf0.001"
    more = [
        (-1, "Ann Doe", "Ann", "Doe", "Any Town", "ca", "", "7"), (-2, "Ann Roe Doe", None, None, "St. Mary's", "ny", "", None), (-3, None, None, None, None, None, "", " A9 "),
        (-4, "Doe Ann", "Ann", "Doe", None, None, "", None), (-5, "Johnathan Smithers", "Johnathan", "Smithers", "New Any Town", "tx", "", ""),
    ]
    own = table(spark, data, "lawyer_enrichment").select("id", "full_name", "first_name", "last_name", "city", F.lower("state").alias("state_code"), F.lit("").alias("state_name"), F.col("bar_number").alias("target_bar"))
    own = own.union(spark.createDataFrame(more, own.schema))
    finds = [
        (-1, "Ann Doe", None, None), (-2, None, None, "7"), (-3, "X", "CA", "a9"), (-4, "Doe, A.", "1 Main St, Any Town, CA", None), (-5, "A Deo", "Any Town, CA", None), (-6, "Doe Ann", "CA", "n/a"), (-7, "Johnathan Smihters", "New Any Town, TX", ""),
        (-8, "J Smithersen", "new any town, tx", None), (-9, "Ann Roe", "St. Mary's, NY", None), (-10, "Hohnathan Smithers", "TX", None), (-11, "", "", ""),
    ]
    found = table(spark, data, "discovery_candidate").select("candidate_id", "name", "location", "bar_number")
    found = found.union(spark.createDataFrame(finds, found.schema))
    whole = match.score_candidates(own.crossJoin(found)).where("confidence >= 0.6").select("id", "candidate_id").collect()
    pairs = {tuple(r) for r in match.possible_pairs(own, found, "id", "candidate_id").collect()}
    assert {tuple(r) for r in whole} <= pairs and len(pairs) < own.count() * found.count() / 10
    assert {(-1, -1), (-1, -2), (-3, -3), (-5, -7), (-5, -10)} <= {tuple(r) for r in whole}
    best = operators.candidate_confidences(spark, data).select("candidate_id", "id").collect()
    want = match.best_candidate(match.score_candidates(own.where("id > 0").crossJoin(found.where("candidate_id > 0"))), "candidate_id", "id", 0.6).select("candidate_id", "id").collect()
    assert sorted(best) == sorted(want)


def test_best_targets_are_those_of_all_pairs_scored(spark, monkeypatch):
    """Few names, many places and all kinds of agreement; no pair may be joined, and one is scored for each find."""
    schema = "id long, full_name string, first_name string, last_name string, city string, state_code string, state_name string, target_bar string"
    chance, pick = random.Random(5), lambda xs: chance.choice(xs)
    firsts, lasts, towns, states = ["Ann", "Anna", "A", "Johnathan", "Jonathan", ""], ["Doe", "Roe", "De Roe", "Smithers", "Smithersen", "Li", ""], ["Any Town", "St. Mary's", "New Any Town", "", None, "West New Any Town"], ["ca", "ny", "", None]
    typed = lambda f, x: pick([f"{f} {x}", f"{f} B. {x}", f"{x}, {f}", f"{f} {x} Jr.", f"Dr. {f} {x}"])
    own = []
    for i in range(150):
        f, x = pick(firsts), pick(lasts)
        own.append((i, pick([typed(f, x), typed(f, x), None]), pick([f, None]), pick([x, None]), pick(towns), pick(states), pick(["", "New York"]), pick([None, None, "A1", "n/a", " B2 "])))
    finds = [(i, pick([typed(pick(firsts), pick(lasts)), "", None]), pick([f"{pick(towns)}, {pick(['CA', 'NY', 'New York'])}", "1 Main St, West New Any Town", "", None]), pick([None, None, None, "a1", "N/A", "b2"])) for i in range(200)]
    own, found = spark.createDataFrame(own, schema), spark.createDataFrame(finds, "candidate_id long, name string, location string, bar_number string")
    want = match.best_candidate(match.score_candidates(own.crossJoin(found)), "candidate_id", "id", 0.6).select("candidate_id", "id").collect()
    monkeypatch.setattr(match, "MANY", 3)
    assert sorted(match.best_targets(own, found, "id", "candidate_id").collect()) == sorted(want) and len(want) > 100
    kinds = {r for _, r in match.score_candidates(own.crossJoin(found)).where("confidence >= 0.6").select("candidate_id", "confidence").distinct().collect()}
    assert {0.6, 0.7, 0.8, 0.9, 1.0} <= kinds


def test_candidates_are_found_without_their_pairs(spark, tmp_path, monkeypatch):
    """Names that all share a last name and a state: the pairs would be 4,000,000."""
    n = 2_000
    spelt = lambda c: F.concat(F.translate(F.lpad(F.hex(c), 6, "0"), "0123456789ABCDEF", "ghjklmnpqrstvwxz"), F.lit(" Doe"))
    spark.range(n).select("id", spelt(F.col("id")).alias("full_name"), F.lit(None).cast("string").alias("first_name"), F.lit("Doe").alias("last_name"), F.lit("Any Town").alias("city"), F.lit("CA").alias("state"), F.lit(None).cast("string").alias("bar_number")).write.parquet(str(tmp_path / "lawyer_enrichment.parquet"))
    spark.range(n).select(F.col("id").alias("candidate_id"), spelt(F.col("id") * 7919).alias("name"), F.lit("Elsewhere, CA").alias("location"), F.lit(None).cast("string").alias("bar_number")).write.parquet(str(tmp_path / "discovery_candidate.parquet"))
    scored = []
    score = match.score_candidates
    monkeypatch.setattr(match, "score_candidates", lambda pairs: scored.append(pairs.count()) or score(pairs))
    best = operators.candidate_confidences(spark, str(tmp_path))
    assert best.count() == scored[0] <= n


def test_sequence_ratio_keeps_the_argument_order(spark):
    pairs = [("ann doe", "doe ann"), ("doe ann", "ann doe"), ("", None)]
    got = [r[0] for r in spark.createDataFrame(pairs, "a string, b string").select(match.sequence_ratio("a", "b")).collect()]
    assert got == [SequenceMatcher(None, a, b or "").ratio() for a, b in pairs]


def test_extraction(spark):
    html = "<script>var x='of 9 entries'</script><link rel=x><p>Showing 1 to 50 of 1,251 entries</p><p>State Bar # 12345</p><p>Admitted on June 1, 1999</p>"
    row = spark.createDataFrame([(html,)], "h string").select(extract.page_text(F.col("h")).alias("t")).select(extract.total_pages(F.col("t"), 50), extract.bar_number(F.col("t")), extract.admission_year(F.col("t"))).first()
    assert tuple(row) == (26, "12345", 1999)
    links = spark.createDataFrame([(["https://x/a-12.html?p=1", "https://x/b-12.html", "https://x/c.html"],)], "l array<string>").select(extract.listing_links(F.col("l"))).first()[0]
    assert links == {"12": "https://x/a-12.html"}
    assert extract.listing_rows(spark.createDataFrame([(1, None), (2, "<table><tr><th>a")], "page_id long, html string"), ["a", "b"], ["x"]).count() == 0


def test_registry(spark, tmp_path):
    for day, status in (("2024", "Deceased"), ("2025", "Currently registered")):
        (tmp_path / f"r{day}.csv").write_text("﻿" + ",".join(readers.REGISTRY_COLUMNS) + f"\n7,ANN,B,DOE,jr,DOE LLP,1 MAIN ST,,ANY TOWN,ny,10017,United States of America,,212,1999,ANY SCHOOL,{status}\n8,,,,,,,,,,,,,,,,Currently registered\n")
    got = readers.registry_records(readers.registry_csv(spark, str(tmp_path / "*.csv"))).collect()
    assert [(r.full_name, r.bar_number, r.address, r.admission_year, r.license_status, r.firm_name) for r in got] == [("Ann B Doe JR", "7", "1 Main St, Any Town, NY 10017", 1999, "Active", "Doe LLP")]


def test_checkpoints_of_both_shapes(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"state": "NC", "last_page": {"lawyers": [{"n": "1"}]}}')
    (tmp_path / "b.json").write_text('{"state": "CA", "lawyers": [{"n": "2"}, {"n": "3"}]}')
    (tmp_path / "c.json").write_text('{"state": ')
    assert rows(readers.checkpoint_records(spark, str(tmp_path)), "state", F.col("record")["n"].alias("n")) == [("CA", "2"), ("CA", "3"), ("NC", "1")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "id int, v string")
    good, bad = writers.split_valid(df, {"no_value": F.col("v").isNotNull(), "small": F.col("id") < 9})
    assert good.count() == 2 and [r.error_type for r in bad.collect()] == ["no_value"]
    assert rows(writers.violations(df, ["id"]), "id", "n") == [(2, 2)]
    assert spark.read.parquet(writers.write_snapshot(df, str(tmp_path), "1")).count() == 3
    writers.export_json(df, str(tmp_path / "j"), source="x")
    assert spark.read.json(str(tmp_path / "j/header")).first()["count"] == 3


def test_cut_tables_can_be_dropped(spark):
    df = session.cut_lineage(spark.range(5))
    assert df.count() == 5
    folder = session.shared_folder(spark)
    before = len(os.listdir(folder))
    session.drop_cut(df, df.select("id"))
    assert len(os.listdir(folder)) == before - 1


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        applicationId, master = "app-cluster", "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_page_records(spark):
    ld = '{"@type": "LocalBusiness", "name": " Ann  Doe ", "description": "Short.", "image": {"url": "https://x/no-photo-1.png"}, "telephone": "Not Available", "sameAs": ["https://linkedin.example/a", "https://x.com/a"], "address": {"addressLocality": "Any Town"}, "knowsAbout": ["A", "A", "B"]}'
    html = f'<h1>Ann</h1><script type="application/ld+json">{ld}</script><div class="license-info">Licensed since 1999 · State: CA | Status: Active • Bar #123</div><div class="show-less-bio">A longer <b>biography</b>.</div>'
    exp = '<div class="experience"><p>1999</p><strong>Clerk, </strong> Court</div>'
    df = spark.createDataFrame([(html, "u"), ("<h1>Error</h1>", "v"), (None, None)], "h string, u string")
    got = df.select(pages.profile_record(F.col("h"), F.col("u")).alias("p"), pages.is_error_page(F.col("u"), F.col("h")).alias("e"), pages.experience_entries(F.lit(exp)).alias("x")).collect()
    p = got[0].p
    assert (p.full_name, p.bio, p.photo_url, p.phone, p.city, p.practice_areas, p.license_state, p.license_status, p.admission_year, p.bar_number) == ("Ann Doe", "A longer biography .", None, None, "Any Town", ["A", "B"], "CA", "Active", "1999", "123")
    assert p.social_links == {"linkedin": "https://linkedin.example/a", "twitter": "https://x.com/a"} and got[1].p is None and got[2].p is None and [r.e for r in got] == [False, True, False]
    assert tuple(got[0].x[0]) == ("1999", "Clerk", "Court")


def test_cards_anchors_and_sections(spark):
    card = '<div class="serp-card organic-card"><a href="/attorneys/1#r">x</a><a href="/attorneys/1">View Profile</a><a href="/attorneys/1">Ann Doe</a></div>'
    named = '<div class="serp-card organic-card"><a href="/attorneys/2">Bob</a><script type="application/ld+json">{"name": "Bob Roe", "worksFor": {"address": {"addressLocality": "Any Town", "addressRegion": "CA"}}}</script></div>'
    df = spark.createDataFrame([(1, card + named + named), (2, None), (3, "")], "page_id long, html string")
    assert rows(pages.best_named(pages.search_cards(df)), "url", "name", "location") == [("/attorneys/1", "Ann Doe", ""), ("/attorneys/2", "Bob Roe", "Any Town, CA")]
    item = '<li><a href="/lawyer/a"><img></a><a href="/lawyer/a">Ann Doe</a><a href="/lawyer/a/contact">Contact</a><span>Any Town, CA</span></li>'
    assert rows(pages.best_named(pages.profile_anchors(df.select("page_id", F.lit(item).alias("html")), "/lawyer/")), "url", "name", "location") == [("/lawyer/a", "Ann Doe", "Any Town, CA")]
    text = "<h2>Biography</h2><p>Likes law.</p><h2>Practice Areas</h2><p>Tax • Wills</p><p>Tax</p><h2>Fees</h2><p>State Bar # 12345</p><h2>Languages</h2><p>English: spoken</p><h2>Professional Experience</h2><p>Clerk</p><h2>Education</h2><p>Any School</p>"
    got = df.select(pages.section_record(F.lit(text), F.lit("u")).alias("s")).first().s
    assert tuple(got) == ("Likes law.", ["Tax", "Wills"], ["English"], "Any School", "12345", "u")
    links = df.select(pages.last_page(F.array(F.lit("l?page=3"), F.lit("l?page=9&sort=a"), F.lit("m?page=7")), F.lit("l?page=1"))).first()[0]
    assert links == 3


def test_crawled_records(spark):
    item = '{"name": "", "full_name": "Ann  Doe", "practiceAreas": [{"name": "Tax"}, "tax", "Wills"], "specialties": "Probate", "phone": "(212) 555-0100", "rating": "4.5", "reviewCount": [], "reviewsCount": 7}'
    got = spark.createDataFrame([(item,), ("{",), (None,)], "j string").select(pages.crawled_record(F.col("j")).alias("r")).collect()
    assert (got[0].r.full_name, got[0].r.practice_areas, got[0].r.phone, got[0].r.rating, got[0].r.review_count) == ("Ann Doe", ["Tax", "Wills", "Probate"], "+12125550100", 4.5, 7)


def test_areas_by_rule_cache_and_model(spark):
    raw = spark.createDataFrame([("DUI",), ("Family Law",), ("estate-planning",), ("odd",), ("odder",), (None,), (" ",)], "raw string")
    cache = spark.createDataFrame([("odd", "tax-law"), ("odder", "no such area")], "raw string, area string")
    got = rows(areas.classify_rest(raw, cache, lambda df: df.withColumn("area", F.lit("sports-law"))), "raw", "area", "how")
    assert got == [("DUI", "criminal-defense", "rule"), ("Family Law", "sports-law", "model"), ("estate-planning", "estate-planning", "rule"), ("odd", "tax-law", "cache"), ("odder", "sports-law", "model")]


def test_exclusive_matches_are_those_of_taking_turns(spark):
    rng = random.Random(11)
    scored = [(t, c, rng.choice([0.8, 0.9, 0.95, 1.0])) for t in range(25) for c in range(20) if rng.random() < 0.3]
    taken, want = set(), []
    for t in range(25):
        open_ = [(s, -c) for a, c, s in scored if a == t and s >= 0.85 and c not in taken]
        if open_:
            s, c = max(open_)
            taken.add(-c)
            want.append((t, -c))
    df = spark.createDataFrame(scored, "t int, c int, score double")
    assert rows(match.exclusive_matches(df, "t", "c", 0.85), "t", "c") == sorted(want, key=repr)
    assert match.exclusive_matches(df.limit(0), "t", "c", 0.85).count() == 0


@pytest.mark.parametrize(
    "place, target, expected",
    [
        (("Other Law Group", "1 Elm St, Any Town, CA 90001"), ("Ann Doe", "Ann", "Doe", None, None, "Any Town", "ca", "california"), 0.0),
        (("Ann Doe", "1 Elm St, Any Town, CA 90001"), ("Ann Mary Roe Doe", "Ann", "Doe", None, None, "Any Town", "ca", "california"), 0.65),
        (("Homveld & Roe Law", "12 Main Street, Any Town, CA"), ("Ann Doe", "Ann", "Doe", "Homveld Roe LLP", "12 Main St", "Any Town", "ca", "california"), 1.0),
        (("Doe Law Office", "Elsewhere"), ("Ann Doe", "Ann", "Doe", None, None, "Any Town", "ca", "california"), 0.3),
        (("Doe Plumbing", "Elsewhere"), ("Ann Doe", "Ann", "Doe", None, None, "Any Town", "ca", "california"), 0.0),
        ((None, None), (None, None, None, None, None, None, None, None), 0.0),
    ],
)
def test_place_confidence(spark, place, target, expected):
    schema = "place_name string, formatted_address string, full_name string, first_name string, last_name string, firm_name string, line1 string, city string, state_code string, state_name string"
    assert match.place_confidence(spark.createDataFrame([place + target], schema)).first().confidence == expected


def test_decisions_and_signatures(spark):
    df = spark.createDataFrame([("a", 0.9), ("a", 0.2), ("b", 0.5), ("c", 0.5), ("c", 0.4), ("d", 0.0), ("e", None)], "k string, confidence double")
    assert rows(match.decisions(df, "k", 0.8), "k", "decision") == [("a", "found"), ("b", "found"), ("c", "candidates"), ("d", "not_found"), ("e", "not_found")]
    s = lambda *v: match.signature(*[F.lit(x).cast("string") for x in v])
    score = match.signature_score(s("Ann Doe", None, None, "Any Town", "CA"), s("A. Doe", None, None, "any town", "NY"), F.lit(0.5))
    assert abs(spark.range(1).select(score).first()[0] - 0.9) < 1e-9


def test_plugins_and_settings(spark):
    plugins = registry.Registry()
    plugins.add(registry.Source("a", 3, lambda df: df.withColumn("by", F.lit("a"))))
    plugins.add(registry.Source("off", 3, lambda df: df, enabled=False))
    plugins.add(registry.Source("*", 4, lambda df: df.withColumn("by", F.lit("*")), details=False))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "off")], "id int, s string")
    assert rows(plugins.run(df, "s"), "id", "by", "layer") == [(1, "a", 3), (2, "*", 4), (3, "*", 4)]
    assert [s.key for s in plugins.of_layer(3)] == ["a"] and [s.key for s in plugins.with_details()] == ["a"]
    with pytest.raises(ValueError):
        plugins.add(registry.Source("a", 1, lambda df: df))
    assert registry.settings({"a": {"b": 1, "c": None}}, "a.b") == 1 and registry.settings({"a": {"c": None}}, "a.c.d", 80) == 80


def test_json_equality_by_kind(spark):
    pairs = [('"A "', '" a"', True), ("1", '"1"', False), ('["a","b","c","d"]', '["A","B","C","D","e"]', True), ('["a"]', '["b"]', False), ('{"a":1,"b":2}', '{"b":2,"a":1}', True), ("1", "1.0", False), (None, '"a"', False)]
    df = spark.createDataFrame(pairs, "a string, b string, same boolean")
    assert all(r[0] == r.same for r in df.select(merge.same_json(F.col("a"), F.col("b")), "same").collect())


def test_writers_change_show_and_resume(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, v string, n int")
    changes = spark.createDataFrame([(2, "c"), (9, "d")], "id int, v string")
    assert rows(writers.changed_columns(old, changes, "id", ["v"]), "id", "v", "n") == [(1, "a", 1), (2, "c", 2)]
    with pytest.raises(ValueError):
        writers.changed_columns(old, changes, "id", ["n"])
    assert writers.write_or_show(old, str(tmp_path / "w"), dry_run=True).count() == 2 and not (tmp_path / "w").exists()
    writers.write_or_show(old, str(tmp_path / "w"))
    writers.write_or_show(old, str(tmp_path / "w"))
    assert spark.read.parquet(str(tmp_path / "w")).count() == 4
    folder = str(tmp_path / "c")
    assert writers.load_checkpoint(spark, folder, "id int, v string, n int") is None
    writers.save_checkpoint(old, folder, prefix="ab")
    saved, state = writers.load_checkpoint(spark, folder, "id int, v string, n int")
    assert rows(saved, "id", "v") == [(1, "a"), (2, "b")] and state == {"prefix": "ab"}
    writers.clear_checkpoint(spark, folder)
    assert writers.load_checkpoint(spark, folder, "id int") is None
    assert writers.usage_lines({"calls": 3, "cost": 0.051}) == ["calls  3", "cost   0.05"]
