"""The training-data operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing extra columns."""

import random
import re
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from dossier.llm import canonical, golden, graph, linkage, mixing, packing, people, places, subjects, templates, tokens, topn
from dossier.llm.addresses import parse_place
from dossier.llm.names import last_match, name_match, readings, within
from dossier.session import cut_lineage

PROFILE = (
    "id long, full_name string, first_name string, last_name string, bar_number string, license_state string, firm_name string, city string, state string, admission_date date,"
    " photo_url string, bio string, merged_data string, raw_data_by_source string, manually_curated_fields array<string>, updated_at timestamp_ntz, rep long, lawyer long, key string"
)
PARSED = "parse_id long, lawyer_enrichment_id long, middle_name string, parsed_at timestamp_ntz"


def profiles(spark, *rows):
    names = [c.split()[0] for c in PROFILE.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], PROFILE)


def found(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# --- P1 ---------------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize(
    "bio, bad",
    [
        ("JAVASCRIPT IS DISABLED", True), ("Query expired. Status 503...", True), ("This listing was removed or its address changed", True), ("Meet {first_name}, an attorney with many years of work behind them.", True),
        ("Ann sits on a board. Offices in *|city|*.", True), ("lorem ipsum dolor sit amet", True), ("dummy blah blah here test words words", True), ("Biography coming soon", True), ("xxxxxxxx", True), ("N/A", True), ("{}", True),
        ("Service of process was found lacking, and the motion [docket no. 277] was granted.", False), ("The office is in room 404 of the old mill; the page boy statue at the door is hard to miss.", False),
        ("Hugo advises software makers on JavaScript licences and open source notices.", False), ("Ann won an access case after a wheelchair user was denied entry to a courthouse in 1982.", False), ("", False), (None, False), ("   ", False),
    ],
)
def test_residue_in_bios(spark, bio, bad):
    got = templates.residue_values(profiles(spark, {"id": 1, "bio": bio, "full_name": "Ann Hugo"}))
    assert bool(got.count()) is bad


def test_templates_give_away_mistyped_messages(spark):
    ok = {"full_name": "Ann Hugo", "bio": "Ann has worked with families and small firms here since 1990."}
    rows = [{"id": i, "full_name": "Ann Hugo", "bio": "This profile was remoced by its owner."} if i == 9 else {"id": i, "full_name": "Ann Hugo", "bio": "This profile was removed by its owner."} for i in range(6, 10)]
    frame = profiles(spark, {"id": 1} | ok, {"id": 2} | ok, *rows)
    assert found(templates.residue_values(frame), "id", "reason") == [(i, "error") for i in range(6, 10)]
    assert [r.rows_by_template for r in templates.template_report(frame).where("verdict = 'error'").collect()] == [1]
    links = profiles(spark, {"id": 1, "photo_url": "https://a.example/heads/%7B%7Bslug%7D%7D.jpg"}, {"id": 2, "photo_url": "https://a.example/heads/ann%20doe-404.jpg"})
    assert found(templates.residue_values(links), "id", "reason") == [(1, "residue")]
    alone = profiles(spark, {"id": 1} | ok, rows[3])
    assert found(templates.residue_values(alone), "id") == []


@pytest.mark.parametrize(
    "link, bad",
    [
        ("https://a.example/img/default-avatar.png", True), ("https://a.example/x/blank.portrait.0.jpg", True), ("https://a.example/login?next=/heads/1.jpg", True), ("#", True), ("https://a.example/heads/${id}.jpg", True), ("https://a.example/heads/undefined.jpg", True), ("https://a.example/s/no-photo-m.png", True),
        ("https://a.example/heads/ann-doe-404.jpg?fallback=default-avatar.png", False), ("https://a.example/default/7/ann-doe.png", False), ("https://a.example/member/99/portrait.jpeg", False), ("https://a.example/m/error-county/5.jpg", False), ("https://a.example/0a1b2.webp?w=300", False),
    ],
)
def test_residue_in_links(link, bad):
    assert (templates.classify_link(link) == "residue") is bad


def test_residue_of_long_and_empty_tables(spark):
    prose = "Ann has practised in Any Town since 1990 and likes it. "
    rows = profiles(spark, {"id": 1, "bio": prose * 2000}, {"id": 2, "bio": prose * 2000 + "Try your search again."}, {"id": 2, "bio": prose})
    assert found(templates.residue_values(rows), "id", "column_name", "reason") == [(2, "bio", "error")]
    assert templates.residue_values(rows.limit(0)).count() == 0


# --- P2 ---------------------------------------------------------------------------------------------------------------
def test_within_is_the_edit_distance_with_swaps():
    def brute(a, b):
        d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    rng = random.Random(1)
    for _ in range(3000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 7))) for _ in "ab")
        for k in (0, 1, 2):
            assert within(a, b, k) == (brute(a, b) <= k)


@pytest.mark.parametrize("a, b, same", [("Hudesby, Penny Hope", "P Hope Hudesby", True), ("Betsy Homveld", "Elizabeth Clark Homveld", True), ("Ann Doe Jr.", "Ann Doe III", False), ("Ann Doe", "Bob Doe", False), ("Dr. Luís E. aBlson", "Luis E. Balson", True), ("Ann Doe-Roe", "Ann Doe", True), (None, "Ann Doe", False), ("", "", False)])
def test_name_match(a, b, same):
    assert bool(name_match(a, b)) is same


@pytest.mark.parametrize("scope", ["", "CA"])
def test_spelling_keys_find_what_brute_force_finds(spark, scope):
    rng = random.Random(7)
    words = {"ralro", "rlaro", "rarlo", "doe", "deo", "doee", "roe", "burns", "bums", "vandermoor", "moor", "moro", "li", "o", "ng"}
    for w in ["serostein", "ralro", "homveld", "lamuristen", "abc"] * 40:
        for _ in range(2):
            i = rng.randrange(len(w) - 1)
            w = rng.choice([w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + w[i + 1 :] if len(w) > 2 else w, w[:i] + "x" + w[i:], w[:i] + "q" + w[i + 1 :]])
        words.add(w)
    n = {w: (100 if w == "ralro" else 1, w) for w in words}
    got = {(r.name, r.key) for r in people.spelling_keys(spark.createDataFrame([(scope, w, False, n[w][0]) for w in words], "scope string, name string, double boolean, n long")).collect()}
    near = last_match if not scope else lambda a, b: within(a, b, (lambda m: 0 if m < 3 else 1 if m < 6 else 2)(min(len(a), len(b))))
    assert got == {(a, b) for a in words for b in words if a == b or (n[b] > n[a] and near(a, b))}
    assert scope or {("rlaro", "ralro"), ("burns", "bums")} <= got | {(b, a) for a, b in got}


def test_swapped_short_last_names_meet(spark):
    rows = profiles(spark, {"id": 1, "full_name": "Robert Ralro", "city": "Any Town", "state": "CA"}, {"id": 2, "full_name": "Robert Rlaro", "city": "Any Town", "state": "CA"})
    who = cut_lineage(people.persons(rows, spark.createDataFrame([], PARSED)))
    assert found(people.linked_pairs(who, people.resolve(who)), "id_a", "id_b") == [(1, 2)]


@pytest.mark.parametrize("a, b", [("Amy Li", "Li, Amy"), ("O, Kim", "O, Kimm"), ("Ng, Wei", "Wei Ng"), ("Latoya James", "James, Latoya")])
def test_short_last_names_and_given_names_as_last_names_meet(spark, a, b):
    doc = '{"phone": "212 555 0100", "address": {"line1": "12 Main St", "city": "Any Town", "state": "CA"}}'
    rows = profiles(spark, {"id": 1, "full_name": a, "merged_data": doc}, {"id": 2, "full_name": b, "merged_data": doc}, {"id": 3, "full_name": "Amy Lo", "merged_data": doc})
    who = cut_lineage(people.persons(rows, spark.createDataFrame([], PARSED)))
    assert found(people.linked_pairs(who, people.resolve(who)), "id_a", "id_b") == [(1, 2)]
    cands = spark.createDataFrame([(1, b, "12 Main St, Any Town, CA", None)], "candidate_id long, name string, location string, bar_number string")
    assert found(linkage.link_rows(who, cands), "id", "candidate_id") == [(1, 1), (2, 1)]


def test_double_names_meet_in_one_word(spark):
    doc = '{"phone": "212 555 0100"}'
    rows = profiles(spark, *[{"id": i, "full_name": n, "merged_data": doc} for i, n in enumerate(["Ana Homveld Serostein", "Ana Homveldseorstein", "Ana Homveld-Serostein", "Ana Serostein", "Eva Homveldserostein"])])
    who = cut_lineage(people.persons(rows, spark.createDataFrame([], PARSED)))
    assert {(0, 1), (0, 2), (0, 3), (1, 2)} <= set(found(people.linked_pairs(who, people.resolve(who)), "id_a", "id_b")) <= {(a, b) for a in range(4) for b in range(4)}


def test_hot_keys_lose_no_pair(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, 1, 2, 3]), rng.choice([None, None, 1]), rng.choice([5, 5, 5, 6])) for i in range(60)]
    keyed = spark.createDataFrame(rows, "rep long, adm int, lic int, k long")
    want = sorted((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[3] == b[3] and (a[1] is None or b[1] is None or a[1] == b[1]) and (a[2] is None or b[2] is None))
    for hot in ([], [(5, True)], [(5, True), (6, True)]):
        assert found(people.met_pairs(keyed, spark.createDataFrame(hot, "k long, hot boolean")), "a", "b") == want
    named = spark.createDataFrame([(i, "CA", "anytown", ["doe"], []) for i in range(5)], "rep long, state string, town string, lasts array<string>, doubles array<string>")
    known = spark.createDataFrame([("", "doe", False, "doe"), ("CA", "anytown", False, "anytown")], "scope string, name string, double boolean, key string")
    monkeypatch.setattr(people, "HOT", 4)
    keys = people.under_evidence(people.by_spelling(named.withColumn("none", F.array().cast("array<long>")), known, "rep", "none"), "none", "rep")
    assert keys.count() == 5 and {r.k for r in people.hot_keys(named).collect()} == {r.k for r in keys.collect()}


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(50, 49), (7, 7), (None, 3)]
    got = dict(found(graph.connected_components(spark.createDataFrame(edges, "a long, b long")), "id", "component"))
    assert got == {i: 0 for i in range(21)} | {49: 49, 50: 49}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_long_paths_and_stars(spark):
    path, star = [(i, i + 1) for i in range(0, 600)], [(1000, 1001 + i) for i in range(300)]
    got = dict(found(graph.connected_components(spark.createDataFrame(path + star + star, "a long, b long")), "id", "component"))
    assert got == {i: 0 for i in range(601)} | {i: 1000 for i in range(1000, 1301)}


def test_variants_are_linked_and_relatives_are_not(spark):
    rows = profiles(
        spark,
        {"id": 1, "full_name": "Elizabeth Homveld", "license_state": "CA", "bar_number": "#77", "city": "Any Town", "state": "CA"},
        {"id": 2, "full_name": "Homvled, Betsy", "city": "Any Town", "state": "CA"},
        {"id": 3, "full_name": "E. Homveld", "license_state": "CA", "bar_number": " 77 ", "state": "CA"},
        {"id": 4, "full_name": "Robert Homveld", "city": "Any Town", "state": "CA"},
        {"id": 5, "full_name": "Elizabeth Homveld", "license_state": "CA", "bar_number": "78", "city": "Any Town", "state": "CA"},
        {"id": 6, "full_name": "Elizabeth Homveld", "city": "Far Away", "state": "NY"},
        {"id": 7, "full_name": None}, {"id": 8, "full_name": ""}, {"id": None, "full_name": "X Y"},
    )
    parsed = spark.createDataFrame([(1, 4, None, None)], PARSED)
    people_rows = cut_lineage(people.persons(rows, parsed))
    got = found(people.linked_pairs(people_rows, people.resolve(people_rows)), "id_a", "id_b")
    assert (1, 3) in got and not any({4, 6} & set(p) for p in got) and (1, 5) not in got
    none = cut_lineage(people.persons(rows.limit(0), parsed))
    assert people.linked_pairs(none, people.resolve(none)).count() == 0


def test_given_names_with_another_first_letter_meet(spark):
    rows = profiles(spark, {"id": 1, "full_name": "Robert Homveld", "city": "Any Town", "state": "CA"}, {"id": 2, "full_name": "Eobert Homveld", "city": "Any Town", "state": "CA"}, {"id": 3, "full_name": "Walter Homveld", "city": "Any Town", "state": "CA"})
    who = cut_lineage(people.persons(rows, spark.createDataFrame([], PARSED)))
    assert found(people.linked_pairs(who, people.resolve(who)), "id_a", "id_b") == [(1, 2)]
    cands = spark.createDataFrame([(1, "Walyer Homveld", "Any Town, CA", None), (2, "Ealter Homveld", "Any Town, CA", None)], "candidate_id long, name string, location string, bar_number string")
    assert found(linkage.link_rows(who, cands), "id", "candidate_id") == [(3, 1), (3, 2)]


# --- P3 ---------------------------------------------------------------------------------------------------------------
def test_survivor_fields(spark):
    import datetime as dt

    at = lambda d: dt.datetime(2024, 1, d)
    rows = profiles(
        spark,
        {"id": 1, "license_state": "CA", "bar_number": "NC-9", "merged_data": '{"phone": "1", "email": "n/a"}', "raw_data_by_source": '{"b": {"data": {"email": "b@x"}}, "a": {"data": {"email": "a@x"}}}', "updated_at": at(1), "manually_curated_fields": ["phone"]},
        {"id": 2, "license_state": "ca ", "bar_number": "# nc 9", "merged_data": '{"phone": "2", "email": ', "raw_data_by_source": '{"a": {"data": {"firm_name": "F"}}}', "updated_at": at(3)},
        {"id": 3, "license_state": "CA", "bar_number": "nc9", "merged_data": '{"phone": "3"}', "raw_data_by_source": "broken", "updated_at": at(2)},
        {"id": 4, "license_state": "CA", "bar_number": "10", "merged_data": '{"phone": "4"}'}, {"id": 5, "license_state": "CA", "merged_data": '{"phone": "5"}'}, {"id": 6, "bar_number": "9"},
    )
    assert found(golden.best_rows(rows), "group_id", "column_name", "from_id", "value") == [(1, "email", 1, "a@x"), (1, "firm_name", 2, "F"), (1, "phone", 1, "1")]
    assert golden.best_rows(rows.limit(0)).count() == 0


def test_truth_discovery_learns_who_is_right(spark):
    votes = [(g, "f", "right", s, 1) for g in range(20) for s in ("a", "b")] + [(g, "f", f"wrong{g}", "c", 1) for g in range(20)] + [(99, "f", "c-says", "c", 1), (99, "f", "a-says", "a", 1)]
    confidence, sources = golden.discover_truth(spark.createDataFrame(votes, "group_id int, field string, said string, source string, n long"))
    trust = dict(found(sources, "source", "reliability"))
    assert trust["a"] > trust["c"]
    best = {r.said: r.confidence for r in confidence.where("group_id = 99").collect()}
    assert best["a-says"] > best["c-says"]


# --- P4 ---------------------------------------------------------------------------------------------------------------
def test_solver_keeps_exclusivity_and_prefers_the_better_link(spark):
    links = [(1, 10, 0.9, 4.0, None), (2, 10, 0.6, 1.0, None), (3, 11, 0.9, 4.0, None), (4, 12, 0.6, 1.0, "b"), (4, 13, 1.0, 20.0, "b")]
    got = {(r.lawyer, r.cand): r.confidence for r in linkage.solve(spark.createDataFrame(links, "lawyer long, cand long, s double, w double, bar string")).collect()}
    assert got[3, 11] == 0.9 and got[1, 10] + got[2, 10] < 1.05 and got[1, 10] > 0.6 > got[2, 10] and got[4, 12] > 0.6 and got[4, 13] > 0.9
    assert linkage.solve(spark.createDataFrame([], "lawyer long, cand long, s double, w double, bar string")).count() == 0


def test_linkage(spark):
    rows = profiles(spark, {"id": 1, "full_name": "Ann Doe", "license_state": "CA", "bar_number": "7", "city": "Any Town", "state": "CA"}, {"id": 2, "full_name": None, "license_state": "CA", "bar_number": "7"}, {"id": 3, "full_name": "Bob Roe", "city": "Any Town", "state": "CA"})
    cands = spark.createDataFrame([(1, "Doe, A.", "Any Town, CA", None), (2, "X", None, " 7 "), (3, "Bob Roe", "Amy Town, CA", None), (4, "Bob Roe", "Elsewhere, CA", None), (5, None, None, None), (6, "Bob Roe", "Amy Town, CA", None)], "candidate_id long, name string, location string, bar_number string")
    who = cut_lineage(people.persons(rows, spark.createDataFrame([], PARSED)))
    got = found(linkage.link_rows(who, cands), "id", "candidate_id")
    assert got == [(1, 1), (1, 2), (2, 2), (3, 3), (3, 6)]
    assert linkage.link_rows(who, cands.limit(0)).count() == 0


def test_both_ways_of_solving_agree(spark):
    rng = random.Random(5)
    links = {}
    for _ in range(80):
        cand = rng.randrange(30)
        links[rng.randrange(12), cand] = (rng.choice([0.6, 0.9, 0.97]), rng.choice([1.0, 4.0, 6.0]), None if cand % 3 else f"b{cand % 4}")
    df = spark.createDataFrame([(a, c, *x) for (a, c), x in links.items()], "lawyer long, cand long, s double, w double, bar string")
    blocks, rows = ({(r.lawyer, r.cand): r.confidence for r in linkage.solve(df, most).collect()} for most in (1_000, 0))
    # The rows stop when all blocks have settled, a block as soon as it has itself.
    assert blocks.keys() == rows.keys() == links.keys() and all(abs(blocks[k] - rows[k]) < 0.03 for k in links)


# --- P5 ---------------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize(
    "a, b, same",
    [
        ("12 N Main Street, Ste 4, Any Town, CA 90001", "Suite 9, 12 North Main St., Any Town, California", True), ("P.O. Box 7, Any Town, CA", "PO BOX 7, Any Town, CA 90001, USA", True), ("99 Twelfth Lane, Any Town, CA", "99 12th Ln, Any Town, CA", True), ("12 Main Street Any Town CA 90001", "12 Mian St, CA 90001", True),
        ("12 Main Street, Any Town, CA", "12 Main Road, Any Town, CA", False), ("12 N Main St, Any Town, CA", "12 S Main St, Any Town, CA", False), ("12 Main St, Any Town, CA", "14 Main St, Any Town, CA", False), ("12 Main St, Any Town, CA", "12 Main St, Any Town, NY", False), ("Any Town, CA", "Any Town, CA", False), (None, "", False),
    ],
)
def test_addresses(spark, a, b, same):
    placed = spark.createDataFrame([(1, a), (2, b)], "scrape_id long, formatted_address string")
    none = spark.createDataFrame([], "candidate_id long, location string")
    got = found(places.address_pairs(placed, profiles(spark), none), "rec_a", "rec_b")
    assert got == ([("place:1", "place:2")] if same else [])


def test_addresses_equal_brute_force(spark):
    import math

    rng = random.Random(9)
    streets = ["homveld", "serostein", "main", "elm", "oakridge", "saintanselm"]
    texts = set()
    for _ in range(160):
        w = rng.choice(streets)
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(w) - 1)
            w = rng.choice([w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + "x" + w[i:], w[: i + 1] + w[i + 2 :] + "q"])
        texts.add(rng.choice([f"{rng.choice([7, 12])} {w} {rng.choice(['st', 'road'])}, Any Town, {rng.choice(['CA', 'NY'])}", f"PO Box {rng.randrange(3)}, Any Town{rng.choice([', CA', ', NY', ''])}"]))
    texts = sorted(texts)
    parsed = [parse_place(t) for t in texts]
    one = {p for p in parsed if p.street}
    grams = {p: {f"^{p.street}$"[i : i + 2] for i in range(len(p.street) + 1)} for p in one}
    df = {g: sum(g in s for s in grams.values()) for s in grams.values() for g in s}
    w2 = {g: math.log(1 + len(one) / n) ** 2 for g, n in df.items()}
    norm = lambda p: sum(w2[g] for g in grams[p])

    def same(a, b):
        if not places.compatible(a, b):
            return False
        if not a.street or not b.street:
            return not a.street and not b.street
        near = within(a.street, b.street, (lambda m: 0 if m < 3 else 1 if m < 6 else 2)(min(len(a.street), len(b.street))))
        return near or sum(w2[g] for g in grams[a] & grams[b]) >= places.COSINE * math.sqrt(norm(a) * norm(b)) - 1e-12

    want = sorted((f"place:{i}", f"place:{j}") for i in range(len(texts)) for j in range(len(texts)) if f"place:{i}" < f"place:{j}" and same(parsed[i], parsed[j]))
    frame = spark.createDataFrame(list(enumerate(texts)), "scrape_id long, formatted_address string")
    none = spark.createDataFrame([], "id long, merged_data string, candidate_id long, location string")
    assert found(places.address_pairs(frame, none, none), "rec_a", "rec_b") == want and len(want) > 20


def test_parse_place_of_odd_texts():
    assert parse_place("x" * 10_000).number == "" and parse_place(", , ,").number == "" and parse_place("CA").state == "CA"


# --- P6 ---------------------------------------------------------------------------------------------------------------
def test_top_n_equals_brute_force(spark):
    rng = random.Random(3)
    data = [(i, rng.choice("ab") if i % 3 else "hot", rng.randint(0, 5), f"i{i % 40:02}") for i in range(600)]
    df = spark.createDataFrame(data, "id long, g string, s int, item string")
    got = found(topn.top_n_per_group(df, ["g"], [F.col("s").desc(), F.col("item"), F.col("id")], "item", 4, salts=8), "g", "id", "rank")
    want = sorted((g, r[0], k + 1) for g in ("a", "b", "hot") for k, r in enumerate(sorted((r for r in data if r[1] == g), key=lambda r: (-r[2], r[3], r[0]))[:4]))
    assert got == want


def test_best_places(spark):
    schema = "discovery_id long, google_place_id string, city string, state string, google_rating double, google_review_count int, discovered_at timestamp_ntz"
    import datetime as dt

    d = dt.datetime(2024, 1, 1)
    rows = [(1, "p", "X", " ca", 5.0, 1, d), (2, "p", "X", "CA", 3.0, 9, d), (3, "q", "X", "CA", 3.0, None, d), (4, "r", "X", "CA", None, 9, d), (5, "s", "X", None, 5.0, 9, d), (6, "t", "X", "", 5.0, 9, d), (7, "u", "X", "CA", float("nan"), 9, d)]
    df = spark.createDataFrame(rows, schema)
    assert found(topn.best_places(df), "state", "google_place_id", "rank") == [("CA", "p", 1), ("CA", "q", 2)]
    assert topn.best_places(df.limit(0)).count() == 0


# --- P7 ---------------------------------------------------------------------------------------------------------------
def test_mapping(spark):
    areas = spark.createDataFrame([(1, "Personal Injury"), (2, "Tax Law")], "area_id long, area_name string")
    cities = spark.createDataFrame([(1, "Saint Elmo", "CA"), (2, "Saint Elmo", "NY"), (3, "Fort Ross", "CA")], "city_id long, city_name string, state_code string")
    hits = spark.createDataFrame([(1, "Personal Injury"), (2, "  - PRESONAL injury (all types)"), (3, "Law, Tax"), (4, "slip and fall"), (5, "yoga"), (6, None), (7, " "), (8, "x" * 5000)], "discovery_id long, practice_area_searched string")
    docs = profiles(spark, {"id": 1, "merged_data": '{"practice_areas": ["Tax Lw", "Tax Lw", null], "address": {"city": "S. Elmo", "state": "NY"}}'}, {"id": 2, "merged_data": '{"address": {"city": "Ft Rsos, CA"}}'}, {"id": 3, "merged_data": '{"address": {"city": "Ft Ross", "state": "NY"'}, {"id": 4, "merged_data": None})
    got = found(canonical.map_typed_values(hits, docs, areas, cities).where("length(typed_value) < 99"), "place_typed", "row_id", "typed_value", "ref_id")
    assert got == [("areas", 1, "Tax Lw", 2), ("city", 1, "S. Elmo", 2), ("city", 2, "Ft Rsos, CA", 3), ("searched", 2, "  - PRESONAL injury (all types)", 1), ("searched", 3, "Law, Tax", 2), ("searched", 4, "slip and fall", 1), ("searched", 5, "yoga", 0)]
    assert canonical.map_typed_values(hits.limit(0), docs.limit(0), areas, cities).count() == 0


# --- P8 ---------------------------------------------------------------------------------------------------------------
def test_sum_of_squares_follows_the_definition():
    rng = random.Random(4)
    for _ in range(60):
        capacity = rng.randint(2, 12)
        sizes = [rng.randint(1, capacity) for _ in range(25)]
        boxes = packing.sum_of_squares(np.array(sizes), capacity)
        fill: dict[int, int] = {}
        for size, box in zip(sizes, boxes):
            def squares(choice):
                trial = fill | {choice: fill.get(choice, 0) + size}
                gaps = [capacity - f for f in trial.values() if f < capacity]
                return sum(gaps.count(g) ** 2 for g in set(gaps))

            options = [b for b, f in fill.items() if f + size <= capacity] + [len(fill)]
            assert squares(int(box)) == min(map(squares, options))
            fill[int(box)] = fill.get(int(box), 0) + size
        assert max(fill.values()) <= capacity


def test_packing_keeps_everything_whole(spark):
    items = spark.createDataFrame([(i, n) for i, n in enumerate([5, 10, 25, 0, 7, 7, 3, 100, 1])] + [(99, None)], "doc_id long, n_tokens long").withColumn("piece", F.lit("clash"))
    spec = spark.createDataFrame([("s", 10), ("bad", 0)], "container_kind string, capacity_tokens int")
    got = packing.pack(items, spec, block=4).collect()
    size: dict[str, int] = {}
    total: dict[int, int] = {}
    for r in got:
        size[r.container_id] = size.get(r.container_id, 0) + r.n_tokens
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
    assert total == {0: 5, 1: 10, 2: 25, 4: 7, 5: 7, 6: 3, 7: 100, 8: 1} and max(size.values()) <= 10
    assert all(sum(x.doc_id == r.doc_id for x in got) == 1 for r in got if total[r.doc_id] <= 10)
    assert packing.pack(items.limit(0), spec).count() == 0 and packing.pack(items, spec.limit(0)).count() == 0


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, ""), (3, None), (4, "<|endoftext|>")], "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    got = dict(found(tokens.count_tokens(df), "doc_id", "n_tokens"))
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 1


# --- P9 ---------------------------------------------------------------------------------------------------------------
def test_temperatures():
    even = mixing.tempered({"a": 0.8, "b": 0.2}, {"a": 0.5, "b": 0.5}, 0.5)
    assert abs(even["a"] / even["b"] - 2.0) < 1e-9  # (0.8 / 0.2) ** 0.5
    weights, exponent, budget = mixing.mixture({"a": 1000, "b": 10}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 4})
    assert exponent == 1.0 and weights == {"a": 0.5, "b": 0.5} and budget == 80
    weights, exponent, _ = mixing.mixture({"a": 1000, "b": 10}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 4}, budget=400)
    assert 0 < exponent < 1 and abs(weights["b"] * 400 - 40) < 1e-3
    assert mixing.mixture({}, {"a": 1.0}, {"a": 1}) == ({}, 1.0, 0)


def test_mixing(spark):
    rng = random.Random(5)
    items = [(i, "big" if i % 3 else "small", rng.randint(1, 9)) for i in range(3000)] + [(9001, None, 5), (9002, "big", None), (9003, "other", 5)]
    df = spark.createDataFrame(items, "doc_id long, source string, n_tokens long").withColumn("rest", F.lit(1))
    targets = spark.createDataFrame([("big", 0.4, 1), ("small", 0.6, 3), ("gone", 0.0, 1)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(df, targets, blocks=16).cache()
    got = {r.source: r for r in mixing.shares(df, targets).collect()}
    assert abs(got["big"].share - 0.4) < 0.005 and got["small"].most_uses <= 3 and got["big"].most_uses == 1 and got["gone"].uses == 0
    assert mixed.groupBy("source", "doc_id", "use").count().where("count > 1").count() == 0
    assert mixing.mix(df.limit(0), targets).count() == 0
    large = {r.source: r for r in mixing.shares(df, targets, 40_000).collect()}
    assert 0 < large["big"].exponent < 1 and all(large[s].most_uses <= large[s].max_repeats and abs(large[s].share - large[s].weight) < 0.01 for s in ("big", "small"))


# --- P10 --------------------------------------------------------------------------------------------------------------
def test_subjects_are_learned(spark):
    rng = random.Random(6)
    terms = {"health": ["surgery", "nurse", "dosage", "scan"], "sport": ["coach", "stadium", "penalty", "marathon"], "arts": ["novel", "gallery", "concert", "mural"]}
    frames = ["Local rules on the {} changed last autumn.", "Everything turned on the {}.", "Keep every letter about the {} in one folder.", "What happened to the {} is still unclear."]
    def doc(kinds, n=6):
        out = [rng.choice(frames).format(rng.choice(terms[k])) for k in kinds for _ in range(n)] + ["Every case is different."] * 2
        rng.shuffle(out)
        return " ".join(out)

    labelled = [(doc(k), list(k)) for k in [("health",), ("sport",), ("arts",), ("health", "arts")] * 25]
    model = subjects.train(labelled, sorted(terms))
    test = [(doc(k), list(k)) for k in [("health",), ("sport",), ("arts",), ("arts", "sport")] * 10]
    assert sum(sorted(k) == model.subjects_of(t) for t, k in test) >= 36
    assert model.subjects_of(None) == model.subjects_of("") == [] and model.subjects_of("Everything turned on the scan. " * 3) == []
    docs = spark.createDataFrame([(1, "Everything turned on the scan. " * 5000), (2, None), (3, " "), (None, "x")], "doc_id long, text string").withColumn("subject", F.lit("clash"))
    assert found(subjects.classify(docs, model), "doc_id", "subject") == [(1, "health")]
    assert subjects.train([], sorted(terms)).subjects_of(test[0][0]) == []


def test_readings_are_stable():
    assert readings("Doe, Ann") == readings("Doe,  Ann ") and SequenceMatcher(None, "a", "a").ratio() == 1.0


def test_pairs_of_spellings_are_shuffled_once(spark):
    """The compared forms, which are wide, stay where they met; only (scope, name, double, key) are made distinct."""
    names = spark.createDataFrame([("", "abcdefgh", False, 3), ("", "abcdefgi", False, 1), ("", "xbcdefgh", False, 1)], "scope string, name string, double boolean, n long")
    known = people.spelling_keys(names)
    assert not [x for x in re.findall(r"hashpartitioning\(([^)]*)\)", known._jdf.queryExecution().executedPlan().toString()) if re.search(r"\ba#", x)]
    assert sorted((r.name, r.key) for r in known.collect()) == [("abcdefgh", "abcdefgh"), ("abcdefgi", "abcdefgh"), ("abcdefgi", "abcdefgi"), ("abcdefgi", "xbcdefgh"), ("xbcdefgh", "abcdefgh"), ("xbcdefgh", "xbcdefgh")]


def _exchanges(df):
    return re.findall(r"hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


def test_rows_are_not_shuffled_once_a_spelling(spark):
    """Towns are looked up before the last names and spellings go as lists; keys have ``KEY`` bits."""
    rows = spark.createDataFrame([(1, "CA", "anytown", ["doe"], [], [7]), (2, "", "", ["doe", "roe"], [], [8])], "rep long, state string, town string, lasts array<string>, doubles array<string>, together array<long>")
    known = spark.createDataFrame([("", "doe", False, "doe"), ("", "doe", False, "roe"), ("", "roe", False, "roe"), ("CA", "anytown", False, "anytown")], "scope string, name string, double boolean, key string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spelt = people.by_spelling(rows, known, "rep", "together")
        assert _exchanges(spelt)[0].startswith("name#")
        keys = people.under_evidence(spelt, "together", "rep").collect()
        assert len(keys) == 2 * 2 + 3 and all(0 <= r.k < 1 << 40 for r in keys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_wide_rows_are_not_shuffled_by_lawyer(spark, monkeypatch):
    """Whether a lawyer has a licence number is known before the rows are joined; one without keeps links by name, one with does not."""
    rows = profiles(spark, {"id": 1, "full_name": "Ann Doe", "license_state": "CA", "bar_number": "7", "city": "Any Town", "state": "CA"}, {"id": 2, "full_name": "Ann Doe", "city": "Any Town", "state": "CA"}, {"id": 3, "full_name": "Bob Roe", "city": "Any Town", "state": "CA"})
    cands = spark.createDataFrame([(1, "Ann Doe", "Any Town, CA", "8"), (2, "Bob Roe", "Any Town, CA", "9"), (3, "Ann Doe", "Any Town, CA", None)], "candidate_id long, name string, location string, bar_number string")
    who = cut_lineage(people.persons(rows, spark.createDataFrame([], PARSED)))
    plans, solve, before = [], linkage.solve, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(linkage, "solve", lambda links: (plans.append(_exchanges(links)), solve(links))[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert found(linkage.link_rows(who, cands), "id", "candidate_id") == [(1, 3), (2, 3), (3, 2)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plans and not [x for x in plans[0] if re.fullmatch(r"lawyer#\d+L?, \d+", x)]
