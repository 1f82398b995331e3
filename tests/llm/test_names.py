from hypothesis import given, settings
from hypothesis import strategies as st

from leafwork.llm import names

ROWS = [
    (1, "Vozond Biosciences S.p.A.", "organisation"), (2, "Drouhefur Therapeutics Ltd", "organisation"), (3, "Drouhefur Biologics, Inc.", "organisation"),
    (4, "Royal Institute for Tropical Fevers Research of Quunor", "organisation"), (5, "Alexander A. Toubrestett, MD, PhD", "person"),
    (6, "Elizabeth D. Flelelkham, PhD", "person"), (7, "Grödrolk Diagnostics Ltd", "organisation"), (8, "Centre for Renal Biology of Xu", "organisation"),
    (9, "Centre for Renal Biology of Yu", "organisation"), (10, "Institute for Renal Biology of Zu", "organisation"), (11, "Kredo Diagnostics Ltd", "organisation"),
    (12, "Plamo Diagnostics A/S", "organisation"), (14, "Aamor Biosciences LLC", "organisation"), (15, "Baadol Biosciences GmbH", "organisation"),
    (16, "Caanot Biologics LLC", "organisation"), (17, "Daavun Biologics A/S", "organisation"), (18, "Royal Institute for Sleep Medicine Research of Wuut", "organisation"),
    (19, "Central Institute for Sleep Medicine Research of Voob", "organisation"), (13, "Robert F. Toubrestett, MD", "person"), (20, "Theodore B. Ganoxby, MD", "person"),
]


def known(rows):
    """The input of a registry held in one shard, counted in plain Python."""
    from collections import Counter

    named = [(i, n, *names.tokens(n)[:2], k == "person") for i, n, k in rows]
    counts = Counter(w for _, _, words, _, _ in named for w in set(words))
    alike = Counter(names.initials_of(words, person) for _, _, words, _, person in named)
    return names.Registry([(i, n, words, legal, person, [w for w in set(words) if counts[w] > 2 and len(w) > 3], alike[names.initials_of(words, person)] if names.initials_of(words, person) else 0) for i, n, words, legal, person in named])


def link(name, rows=ROWS):
    hit = known(rows).link(name)
    return hit[1] if hit and hit[2] == 1 else None


def test_variants():
    same = {
        "Vozond": 1, "VOZOND BIO SCIENCES SPA": 1, "Biosciences, Vozodn": 1, "Vozond Biosci.": 1, "Drouhefur Tx Limited": 2, "Drouhefur Ltd": 2, "drouhefur biol": 3,
        "Grodrolk Dx, Ltd. (Forixstead)": 7, "RITFRQ": 4, "R.I.T.F.R.Q.": 4, "Quunor, Royal Inst. Tropical Fevers Res.": 4, "Liz Flelelkham": 6, "FLELELKHAM, Elizabeth": 6,
        "Flelelkham ED": 6, "E. D. Flelelkham": 6, "Dr Flelelkham": 6, "Sandy Toubrestett": 5, "Ted Ganoxby": 20, "Ganoxby TB": 20, "Toubrestett, Bob (sponsor-investigator)": 13,
        "Vozond Biosciences, a subsidiary of Grödrolk Diagnostics Ltd": 1,
    }
    assert {k: link(k) for k in same} == same


def test_none():
    for name in ("", "---", "Drouhefur", "Vozond Vaccines", "Vozond Biosciences GmbH", "Peter A. Toubrestett", "Dr Toubrestett", "Diagnostics", "Unknown Laboratories Ltd", "the of for", "x" * 5000):
        assert link(name) is None, name


def brute(a, b):
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(row[j - 1] + 1, rows[-1][j] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, rows[-2][j - 2] + 1)
            row.append(cost)
        rows.append(row)
    return rows[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcd", min_size=1, max_size=7), min_size=1, max_size=12), st.text("abcd", max_size=7), st.integers(0, 2))
def test_trie_equals_brute_force(words, query, most):
    assert names.Trie(iter(words)).near(query, most) == {w: brute(query, w) for w in words if brute(query, w) <= most}


def test_over_spark(spark):
    registry = spark.createDataFrame(ROWS, "sponsor_id long, sponsor_name string, sponsor_kind string")
    rows = spark.createDataFrame([(1, "Vozond", 5), (2, "Vozond", 5), (3, "Vozond Biosciences S.p.A.", 5), (4, None, 5), (5, "", 5), (6, "Nobody", 5)], "record_id long, sponsor string, sponsor_id long")
    links = names.link_rows({"manifest": (rows, "record_id")}, registry)
    assert {(r.row_id, r.sponsor_id, r.exact) for r in links.collect()} == {(1, 1, False), (2, 1, False), (3, 1, True)}
    assert {(r.src, r.row_id) for r in names.found_variants(links).collect()} == {("manifest", 1), ("manifest", 2)}
    assert names.link_names(rows.where("false"), registry).count() == 0
    assert names.link_names(rows, registry.where("false")).count() == 0


MORE = [
    (31, "Meridian Oncology Inc", "organisation"), (32, "Meridian Oncology Research Inc", "organisation"), (33, "Royal Institute for Tropical Fungi Research of Quunor", "organisation"),
    (34, "Vozond Research GmbH", "organisation"), (35, "Xavon Research Ltd", "organisation"), (36, "Ybbor Research Ltd", "organisation"),
]
TYPED = (
    "Vozond", "Grodrolk Dx, Ltd.", "Liz Flelelkham", "Nobody", "Meridiam Oncology", "Meridian Oncology", "RITFRQ", "R.I.T.F.R.Q.", "Research", "Xavon Res", "Vozond Research", "Drouhefur", "Drouhefur Tx",
    "Toubrestett", "Sandy Toubrestett", "Vozond Biosciences S.p.A.", "Institute Renal Biology Zu",
)


def test_shards_agree(spark, monkeypatch):
    registry = spark.createDataFrame(ROWS + MORE, "sponsor_id long, sponsor_name string, sponsor_kind string")
    rows = spark.createDataFrame([(n,) for n in TYPED], "sponsor string")
    whole = {tuple(r) for r in names.link_names(rows, registry).collect()}
    assert whole == {(n, i, *rest) for n, i, *rest in whole if link(n, ROWS + MORE) == i} and len(whole) > 8
    assert ("Meridiam Oncology", 31) in {r[:2] for r in whole} and "RITFRQ" not in {r[0] for r in whole}
    for size in (1, 5, 11):
        monkeypatch.setattr(names, "SHARD_NAMES", size)
        assert {tuple(r) for r in names.link_names(rows, registry).collect()} == whole


def test_long_names():
    words = "alpha bravo carol delta ember frost grape hotel india joker karma lemon mango north ocean piano".split()
    rows = [(1, " ".join(words), "organisation"), (2, "Somebody Else", "organisation")]
    assert link(" ".join(reversed(words)).replace("lemon", "lemno"), rows) == 1
    assert link(" ".join(["alpha"] * 40), [(1, " ".join(["alpha"] * 40), "organisation"), (2, "beta", "organisation")]) == 1


@settings(max_examples=300, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from("abcde"), st.integers(0, 2), max_size=4), min_size=1, max_size=5), st.lists(st.sampled_from("abcde"), min_size=1, max_size=5))
def test_assignment_equals_all_orders(nears, own):
    from itertools import permutations

    fits = [sum(near[w] for near, w in zip(nears, order)) for order in permutations(own, len(nears)) if all(w in near for near, w in zip(nears, order))] if len(nears) <= len(own) else []
    assert names.Registry._assign(nears, own) == min(fits, default=None)


def test_a_frequent_name_is_spread(spark, monkeypatch):
    from leafwork import session

    registry = spark.createDataFrame(ROWS, "sponsor_id long, sponsor_name string, sponsor_kind string")
    rows = spark.createDataFrame([(i, "Vozond" if i % 3 else "Nobody") for i in range(90)], "record_id long, sponsor string")
    whole = sorted(tuple(r) for r in names.link_rows({"manifest": (rows, "record_id")}, registry).collect())
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    assert sorted(tuple(r) for r in names.link_rows({"manifest": (rows, "record_id")}, registry).collect()) == whole and len(whole) == 60


COMMON = [
    (41, "Robert F. Toubrestett, MD", "person"), (42, "Robert A. Ganoxby", "person"), (43, "Robert C. Flelelkham", "person"), (44, "Susan D. Toubrestett", "person"), (45, "Daniel K. Toubrestett", "person"),
    (51, "Northern Oncology Research Ltd", "organisation"), (52, "Northern Oncology Vaccines Ltd", "organisation"), (53, "Northern Renal Research Inc", "organisation"), (54, "Coastal Renal Vaccines Inc", "organisation"),
    (55, "Coastal Renal Research Group Ltd", "organisation"), (56, "Coastal Oncology Vaccines Group Ltd", "organisation"), (57, "Eastern Oncology Research Group GmbH", "organisation"),
]
OF_COMMON = {
    "Bob Toubrestett": 41, "Toubrestett RF": 41, "Toubrestett": None, "Robert": None, "NORTHERN ONCOLOGY RESEARCH": 51, "Nothern Renal": 53, "Northern Renal Ltd": None, "Northern Oncology": None,
    "Coastal Renal": None, "Coastal Renal Vaccines": 54, "Research Group GmbH": None, "Oncology": None, "Coastal Group Renal": 55, "Vaccines Coastal Oncology": 56,
}


def test_common_words_alone(spark, monkeypatch):
    # Each of these words but "Eastern" is in over two registered names; what they mean together is found all the same.
    assert {n: link(n, COMMON) for n in OF_COMMON} == OF_COMMON
    registry = spark.createDataFrame(COMMON, "sponsor_id long, sponsor_name string, sponsor_kind string")
    rows = spark.createDataFrame([(n,) for n in OF_COMMON], "sponsor string")
    for size in (100, 5, 1):
        monkeypatch.setattr(names, "SHARD_NAMES", size)
        got = {(r.sponsor, r.sponsor_id, r.edits) for r in names.link_names(rows, registry).collect()}
        assert got == {(n, i, int(n == "Nothern Renal")) for n, i in OF_COMMON.items() if i}
