import random

import pytest
from pyspark.sql import functions as F

from leafwork.operators import corpus, indexes, layout, matching
from leafwork.sources import adapters
from leafwork.streaming import incremental


def test_reference_index_prefers_longest_prefix(spark):
    blocks = spark.createDataFrame([(1, "d", 0, 0, "see SECTION 5.1.9 and Table 3"), (2, "d", 0, 1, "Section 5.1.9, Section 8"), (3, "d", 0, 2, None)], "block_id long, doc_id string, page_num int, order_index int, text string")
    parsed = spark.createDataFrame([(7, "d", 0, 0, "5"), (8, "d", 1, 0, "5.1"), (9, "d", 2, 0, "5.1")], "block_id long, doc_id string, page_num int, order_index int, m11_section string")
    index = indexes.reference_index(blocks, parsed)
    assert {(r.kind, r.target, r.surface, r.target_id) for r in index.collect()} == {("section", "5.1.9", "SECTION 5.1.9", 8), ("table", "3", "Table 3", None), ("section", "8", "Section 8", None)}
    resolved = {(r.block_id, r.surface): (r.target_id, r.confidence) for r in indexes.resolved_mentions(blocks, index).collect()}
    assert resolved[(2, "Section 5.1.9")] == (8, 1.0) and resolved[(1, "Table 3")] == (None, 0.5)


def test_acronyms(spark):
    blocks = spark.createDataFrame([(1, "d", 0, 0, "Serious Adverse Event (SAE) first; SAE, SAEs, xSAE"), (2, "d", 0, 1, "Some Other Expansion (SAE); ZZZ (Objective Response Rate)")], "block_id long, doc_id string, page_num int, order_index int, text string")
    found = indexes.acronym_definitions(blocks)
    assert [tuple(r) for r in found.collect()] == [("d", "SAE", "Serious Adverse Event", 1)]
    uses = {(r.block_id, r.start_pos) for r in indexes.acronym_uses(blocks, found).collect()}
    assert uses == {(1, 23), (1, 35), (2, 22)}


def test_negation_window(spark):
    text = "no evidence of" + " " * 80 + "rash"
    blocks = spark.createDataFrame([(1, text), (2, "no evidence of" + " " * 81 + "rash"), (3, "rash, no evidence of it"), (4, None)], "block_id long, text string")
    found = indexes.negated_entities(indexes.negation_cues(blocks), indexes.spans(blocks, r"\brash\b", ("block_id",)))
    assert [(r.block_id, r.entity_start, r.kind) for r in found.collect()] == [(1, 94, "definite")]


def test_span_overlay(spark):
    rows = [(1, 0, 10, "low", 1), (1, 3, 6, "high", 4), (1, 6, 8, "high", 4), (2, 5, 5, "low", 1)]
    got = indexes.span_overlay(spark.createDataFrame(rows, "key int, start_pos int, end_pos int, kind string, priority int"))
    assert {tuple(r) for r in got.select("key", "start_pos", "end_pos", "kind").collect()} == {(1, 0, 3, "low"), (1, 3, 8, "high"), (1, 8, 10, "low")}


def test_matching_equals_greedy_walk(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)]
    text = lambda: " ".join(rng.sample(words, rng.randint(1, 6)))
    gold = [("k", i, text(), rng.choice("ab")) for i in range(12)]
    got = [("k", i, text(), rng.choice("ab")) for i in range(40)]
    schema = "key string, id long, text string, category string"
    a, b = spark.createDataFrame(got, schema), spark.createDataFrame(gold, schema)
    classes = {r.left_id: r["class"] for r in matching.match_classes(matching.best_matches(a, b), a, b).collect()}
    used, expected = set(), {}
    for _, i, t, category in got:
        best, score = None, 0.0
        for g in gold:
            x, y = set(t.split()), set(g[2].split())
            s = len(x & y) / len(x | y)
            if s > score:
                best, score = g, s
        if score < 0.3:
            expected[i] = "false_positive"
        elif score < 0.5:
            expected[i] = "partial"
        elif best[1] in used:
            expected[i] = "duplicate"
        else:
            used.add(best[1])
            expected[i] = "match" if best[3] == category else "wrong_category"
    assert classes == expected
    metrics = matching.match_metrics(matching.match_classes(matching.best_matches(a, b), a, b), b).first()
    assert metrics.n_extracted == 40 and metrics.n_gold == 12 and metrics.n_missed == 12 - len(used)
    none = matching.match_metrics(a.where("false").select("key", F.lit("x").alias("class")), b.where("false")).first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)


def _texts(key: str, n: int, rng: random.Random) -> list[tuple]:
    return [(key, i, " ".join(rng.sample([f"w{k}" for k in range(14)], rng.randint(1, 7)))) for i in range(n)]


def test_similar_texts_are_never_broadcast(spark, tmp_path):
    """Word sets are larger than the files by which the optimizer judges them; broadcast, they fill the driver."""
    rng = random.Random(6)
    for name in ("a", "b"):
        spark.createDataFrame(_texts("k", 30, rng) + _texts("l", 5, rng), "key string, id long, text string").write.parquet(f"{tmp_path}/{name}")
    a, b = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("a", "b"))
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    for build in (lambda: matching.best_matches(a, b), lambda: matching._prefixed(a, b, 0.3, lambda c: F.split(c, " "))):
        found = build()
        assert found.collect()
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("pairs", [0, 100, 40_000])
@pytest.mark.parametrize("least", [0.3, 0.5, 1.0])
def test_similarities_equal_brute_force(spark, monkeypatch, pairs, least):
    rng = random.Random(7)
    odd = [("k", 90, None), ("k", 91, ""), ("k", 92, " - "), (None, 93, "w1 w2"), ("k", 94, "w1 w2 w3"), ("k", 95, "w3, w2 W1 w1"), ("m", 96, "")]
    left, right = ([*_texts("k", 25, rng), *_texts("l", 6, rng), *odd, (alone, 97, "w1")] for alone in ("x", "y"))
    bag = lambda t: {w.strip(",-").lower() for w in (t or "").split()} - {""}
    expected = {}
    for key, i, s in left:
        for other, j, t in right:
            x, y = bag(s), bag(t)
            if key is not None and key == other and x and y and len(x & y) / len(x | y) >= least:
                expected[key, i, j] = len(x & y) / len(x | y)
    monkeypatch.setattr(matching, "PAIRS", pairs)
    a, b = (spark.createDataFrame(rows, "key string, id long, text string") for rows in (left, right))
    got = [tuple(r) for r in matching.similarities(a, b, least).collect()]
    assert len(got) == len(expected) and {r[:3]: r[3] for r in got} == expected


def test_metric_arithmetic(spark):
    classes = spark.createDataFrame([("match",)] * 19 + [("false_positive",)] * 5, "class string")
    row = matching.match_metrics(classes, spark.range(23)).first()
    assert (round(row.precision, 4), round(row.recall, 4), round(row.f1, 4), row.n_missed) == (0.7917, 0.8261, 0.8085, 4)


def test_fuzzy_presence(spark):
    needles = spark.createDataFrame([("k", 1, "a b c d e f"), ("k", 2, "b c"), ("k", 3, ""), ("k", 4, None), ("k", 5, "x y z q"), ("j", 6, "a b c d")], "key string, needle_id int, text string")
    hay = spark.createDataFrame([("k", "a b c d e", 0, 0, 1), ("k", "z", 0, 1, 2), ("k", None, None, None, 3)], "key string, text string, page_num int, order_index int, block_id long")
    assert {r.needle_id: (round(r.share, 3), r.present) for r in matching.fuzzy_presence(needles, hay).collect()} == {1: (0.667, True), 2: (1.0, True), 3: (0.0, False), 4: (0.0, False), 5: (0.0, False), 6: (0.0, False)}


def test_evidence_tiers(spark):
    claims = spark.createDataFrame([("d", 1, "alpha beta gamma"), ("d", 2, "alpha  beta gamma"), ("d", 3, "word " * 12 + "tail"), ("d", 4, "nothing here at all"), ("d", 5, "beta")], "doc_id string, claim_id int, text string")
    texts = spark.createDataFrame([("d", 10, "x alpha beta gamma y"), ("d", 11, "alpha beta gamma"), ("d", 12, "word " * 13), ("e", 13, "nothing here at all")], "doc_id string, block_id int, text string")
    assert {r.claim_id: (r.block_id, r.tier) for r in matching.evidence(claims, texts).collect()} == {1: (10, 1), 2: (10, 2), 3: (12, 3), 5: (10, 1)}


def test_evidence_equals_brute_force_over_whole_documents(spark):
    import random
    import re

    rng = random.Random(3)
    words = ["Pregnancy", "consent", "of", "\u00a0", "\u200e", "\ufeff", "(", ")", "\u2022", ",", ".", " ", "  ", "\n", "history", "5", "mg", "\u2265", "\u03b2", "\u764c\u75c7", "pre", "e\u0301", "\U0001d400", "-"]
    made = lambda n: "".join(rng.choice(words) + rng.choice(["", " ", " "]) for _ in range(n))
    texts = [(rng.choice("de"), i, made(rng.randint(1, 30))) for i in range(60)]
    claims = [(rng.choice("de"), i, made(rng.randint(1, 2))) for i in range(60)]
    for d, _, body in texts * 3:
        at, n = rng.randrange(len(body)), rng.choice([1, 3, 8, 30, 55, 80])
        claims.append((d, len(claims), body[at : at + n] + rng.choice(["", "", " another end of the claim"])))
    claims += [("d", 1000, "\u200eNo known allergy"), ("d", 1001, "Age over 18"), ("d", 1002, "  "), (None, 1003, "Age"), ("d", 1004, "llergy")]
    texts += [("d", 1000, "x \u200eNo known allergy, none"), ("d", 1001, "\u00a0Age over 18."), ("d", 1002, None), (None, 1003, "Age")]
    level = lambda t: re.sub(r"[ \t\n\x0b\f\r]+", " ", t).strip(" ")

    def tier(claim, body):
        if claim in body:
            return 1
        if level(claim) in level(body):
            return 2
        return 3 if len(claim) >= 50 and level(claim)[:50] in level(body) else None

    wanted = {}
    for d, i, claim in claims:
        hits = [(k, b) for e, b, body in texts if d and d == e and body and level(claim) and (k := tier(claim, body))]
        if hits:
            wanted[i] = min(hits)[::-1]
    assert {wanted[1000], wanted[1001], wanted[1004]} == {(1000, 1), (1001, 1)}
    frames = spark.createDataFrame(claims, "doc_id string, claim_id int, text string"), spark.createDataFrame(texts, "doc_id string, block_id int, text string")
    assert {r.claim_id: (r.block_id, r.tier) for r in matching.evidence(*frames).collect()} == wanted


BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def test_layout(spark):
    rows = [(i, "d", 0, i, "paragraph", "text", (x, 10.0, x + 100, 20.0)) for i, x in enumerate([50.0, 52.0, 90.0, 91.0, 300.0, 305.0])]
    blocks = spark.createDataFrame([*rows, (9, "d", 1, 0, "figure", None, None), (10, "d", 1, 1, None, None, None)], f"block_id long, doc_id string, page_num int, order_index int, block_type string, text string, bbox {BOX}")
    levels = layout.indent_levels(blocks)
    assert {r.block_id: r.level for r in levels.collect()} == {0: 0, 1: 0, 2: 1, 3: 1, 4: 2, 5: 2}
    assert {r.block_id: r.parent_index for r in layout.indent_parents(levels).collect()} == {2: 1, 3: 1, 4: 3, 5: 3}
    assert {r.page_num: r.columns for r in layout.column_estimate(blocks).collect()} == {0: 2}
    features = layout.page_features(blocks)
    assert {r.page_num: (r.char_count, r.is_scanned) for r in features.collect()} == {0: (24, False), 1: (0, True)}
    routed = layout.route(features.withColumn("columns", F.lit(1)), layout.Thresholds(remote=True)).orderBy("page_num").collect()
    assert [r.reason for r in routed] == ["route-all-to-MinerU: plain prose", "route-all-to-MinerU: scanned/garbage-text"]
    assert {tuple(r) for r in layout.contiguous_ranges(spark.createDataFrame([("d", p) for p in (1, 2, 2, 4, None)], "doc_id string, page_num int")).select("first", "last").collect()} == {(1, 2), (4, 4)}


def walked_paragraphs(words):
    """The rule as a state machine, written from its description."""
    lines = []
    for _, top, bottom, text in sorted(words):
        if lines and abs(top - lines[-1]["top"]) <= 3:
            lines[-1]["bottom"] = max(lines[-1]["bottom"], bottom)
            lines[-1]["text"] += " " + text
        else:
            lines.append({"top": top, "bottom": bottom, "text": text})
    gaps = [b["top"] - a["bottom"] for a, b in zip(lines, lines[1:])]
    positive = sorted(g for g in gaps if g > 0)
    limit = max((positive[len(positive) // 2] if positive else 4.0) * 1.8, 6.0)
    out, number = [], 0
    for i, line in enumerate(lines):
        number += i > 0 and gaps[i - 1] > limit
        out.append((number, i, line["text"]))
    return out


def test_paragraph_islands(spark):
    rng = random.Random(5)
    pages = {0: [(1, 0.0, 10.0, "a"), (2, 1.0, 11.0, "a2"), (3, 12.0, 22.0, "b"), (4, 24.0, 34.0, "c"), (5, 60.0, 70.0, "d")], 1: [(1, 5.0, 4.0, "x")]}
    for page in range(2, 12):
        top, words = 0.0, []
        for k in range(rng.randint(1, 25)):
            top += rng.choice([0, 0, 2, 2.9, 3, 3.1, 12, 12, 30, -40])
            words.append((k, top, top + rng.choice([8.0, 10.0]), f"w{k}"))
        pages[page] = words
    rows = [("d", p, *w) for p, words in pages.items() for w in words]
    rng.shuffle(rows)
    got = layout.paragraphs(spark.createDataFrame(rows, "doc_id string, page_num int, word_no int, top double, bottom double, text string")).collect()
    assert {(r.page_num, r.paragraph, r.line, r.text) for r in got} == {(p, *x) for p, words in pages.items() for x in walked_paragraphs(words)}
    assert {(r.paragraph, r.text) for r in got if r.page_num == 0} == {(0, "a a2"), (0, "b"), (0, "c"), (1, "d")}


def test_font_classes(spark):
    cases = [
        ("Title", 12.0, 100.0, "heading"), ("- item", 10.0, 100.0, "list"), ("* item", 10.0, 100.0, "list"), ("1. item", 10.0, 100.0, "paragraph"), ("(a) item", 10.0, 100.0, "paragraph"), ("• item", 12.0, 100.0, "heading"),
        ("small", 9.2, 600.0, "footnote"), ("small", 9.2, 500.0, "paragraph"), ("- small", 9.2, 600.0, "list"), ("Title", 12.0, 600.0, "heading"), ("Head", 12.0, 39.0, "header"), ("Head", 10.0, 40.0, "paragraph"), ("Foot", 9.0, 760.0, "footer"),
        ("two\nlines", 10.0, 10.0, "paragraph"), ("x" * 130, 10.0, 10.0, "paragraph"), ("x" * 250, 12.0, 100.0, "paragraph"), ("  ", 12.0, 10.0, "other"), (None, 12.0, 10.0, "other"), ("text", None, 600.0, "paragraph"),
    ]
    frame = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, text string, size double, y0 double, wanted string")
    got = frame.select("i", "wanted", layout.font_class(F.col("size"), F.lit(10.0), F.col("text"), F.col("y0")).alias("got")).collect()
    assert [(r.i, r.got) for r in got if r.got != r.wanted] == []
    spans = spark.createDataFrame([("d", 0, 10.0, "aaaa"), ("d", 0, 12.0, " bb "), ("d", 0, 0.0, "c" * 50), ("d", 0, 30.0, "   ")], "doc_id string, page_num int, size double, text string")
    assert layout.body_font_size(spans).first().body_size == 10.0
    images = spark.createDataFrame([(1, (0.0, 0.0, 40.0, 40.0)), (2, (0.0, 0.0, 100.0, 100.0)), (3, None)], f"i int, bbox {BOX}")
    assert [r.i for r in layout.figures(images).collect()] == [2]


def test_boxes_and_columns(spark):
    frame = spark.createDataFrame([((10.0, 700.0, 20.0, 780.0),)], f"b {BOX}")
    assert tuple(frame.select(layout.flipped(F.col("b"), F.lit(792.0)).alias("f")).first().f) == (10.0, 12.0, 20.0, 92.0)
    cells = spark.createDataFrame([("d", 0, 1, 10.0), ("d", 0, 1, 10.04), ("d", 0, 1, 50.0), ("d", 0, 2, 5.0), ("d", 1, 3, None)], "doc_id string, page_num int, table_no int, x0 double")
    assert [tuple(r) for r in layout.table_columns(cells, "table_no").collect()] == [("d", 0, 2)]


def met_heads(segments):
    """Arrowheads by the rule as a loop over buckets, written from its description."""
    from math import acos, degrees, hypot

    short = [s for s in segments if 3 <= hypot(s[3] - s[1], s[4] - s[2]) <= 20 and abs(s[3] - s[1]) >= 0.5 and abs(s[4] - s[2]) >= 0.5]
    buckets = {}
    for no, x0, y0, x1, y1 in short:
        for tip, other in (((x0, y0), (x1, y1)), ((x1, y1), (x0, y0))):
            buckets.setdefault((int(tip[0]), int(tip[1])), []).append((no, tip, other))
    heads, seen = [], set()
    for group in buckets.values():
        for i, (a, ta, oa) in enumerate(group):
            for b, tb, ob in group[i + 1 :]:
                if a == b or (min(a, b), max(a, b)) in seen or hypot(ta[0] - tb[0], ta[1] - tb[1]) > 1:
                    continue
                u, v = [((o[0] - t[0]) / hypot(o[0] - t[0], o[1] - t[1]), (o[1] - t[1]) / hypot(o[0] - t[0], o[1] - t[1])) for t, o in ((ta, oa), (tb, ob))]
                if not 20 <= degrees(acos(max(-1, min(1, u[0] * v[0] + u[1] * v[1])))) <= 170:
                    continue
                d = -(u[0] + v[0]) / 2, -(u[1] + v[1]) / 2
                n = hypot(*d)
                heads.append(((ta[0] + tb[0]) / 2, (ta[1] + tb[1]) / 2, d[0] / n, d[1] / n))
                seen.add((min(a, b), max(a, b)))
    return heads


def paired(heads):
    """Arrows by the rule as a greedy loop."""
    used, out = set(), []
    for i, a in enumerate(heads):
        flat, best = abs(a[2]) >= abs(a[3]), None
        for j in range(i + 1, len(heads)):
            b = heads[j]
            if i in used or j in used or (abs(b[2]) >= abs(b[3])) != flat:
                continue
            k = 0 if flat else 1
            span = abs(a[k] - b[k])
            if abs(a[1 - k] - b[1 - k]) <= 3 and (a[2 + k] > 0) != (b[2 + k] > 0) and span >= 10 and (best is None or span < best[0]):
                best = span, j
        if best:
            used |= {i, best[1]}
            out.append((*a[:2], *heads[best[1]][:2], "horizontal" if flat else "vertical", True))
    out += [(a[0] - 20 * a[2], a[1] - 20 * a[3], a[0], a[1], "horizontal" if abs(a[2]) >= abs(a[3]) else "vertical", False) for i, a in enumerate(heads) if i not in used]
    return out


def test_arrows_equal_the_loops(spark):
    rng = random.Random(8)
    pages = {}
    for page in range(12):
        segments = []
        for _ in range(rng.randint(1, 9)):
            x, y, turn = rng.choice([50, 50, 120, 300]) + rng.random(), rng.choice([100, 101.5, 400]) + rng.random(), rng.choice([1, -1])
            legs = [(x - turn * 6, y - 4), (x - turn * 6, y + 4)] if rng.random() < 0.6 else [(x - 4, y - turn * 6), (x + 4, y - turn * 6)]
            for leg in legs + [(x + rng.uniform(-25, 25), y + rng.uniform(-1, 8))]:
                ends = [(x + rng.choice([0, 0, 0.4]), y), leg]
                rng.shuffle(ends)
                segments.append((len(segments) + 1, *ends[0], *ends[1]))
        pages[page] = segments
    rows = [("d", p, *s) for p, segments in pages.items() for s in segments]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id string, page_num int, segment_id int, x0 double, y0 double, x1 double, y1 double")
    heads = layout.arrowheads(frame)
    shown = lambda values: [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in values]
    got = {p: [] for p in pages}
    for r in heads.orderBy("page_num", "head_no").collect():
        got[r.page_num].append((r.x, r.y, r.dx, r.dy))
    wanted = {p: met_heads(s) for p, s in pages.items()}
    assert {p: shown(v) for p, v in got.items()} == {p: shown(v) for p, v in wanted.items()}
    arrows = {p: [] for p in pages}
    for r in layout.pair_arrows(heads).orderBy("page_num", "arrow_no").collect():
        arrows[r.page_num].append((r.x0, r.y0, r.x1, r.y1, r.axis, r.two_headed))
    assert {p: shown(v) for p, v in arrows.items()} == {p: shown(paired(v)) for p, v in wanted.items()}
    assert any(a[5] for v in arrows.values() for a in v) and any(not a[5] for v in arrows.values() for a in v)


def test_redactions(spark):
    marks = spark.createDataFrame([("d", 0, 0.0, 0.0, 0.0, (0.0, 0.0, 612.0, 100.0)), ("d", 1, 0.0, 0.0, 0.0, (0.0, 0.0, 612.0, 3.0)), ("d", 1, 0.9, 0.0, 0.0, (0.0, 0.0, 612.0, 100.0))], f"doc_id string, page_num int, r double, g double, b double, bbox {BOX}")
    pages = spark.createDataFrame([("d", 0, 5), ("d", 1, 0)], "doc_id string, page_num int, char_count int")
    row = layout.redaction_pages(marks, pages).first()
    assert (row.n_pages, row.blank_pages, row.redaction_pages) == (2, 1, 1)


def test_nearest_equals_brute_force(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(60, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(60, [0.0] * 8), (61, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(corpus, "QUERY_BLOCK", 2)
    got = {}
    for r in corpus.nearest(frame, frame.where("vec_id % 20 = 0"), 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for q in (0, 20, 40):
        scores = unit @ unit[q]
        scores[q] = -2
        assert got[q][:4] == np.argsort(-scores)[:4].tolist()
    assert 60 not in got


def test_round_robin(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4), (None, 5)], "s string, k int")
    assert [r.k for r in corpus.round_robin(rows, "s", [F.col("k")], "k", 3).collect()] == [1, 4, 2]


def test_adapters(spark):
    labels = spark.createDataFrame([("Section_Title",), ("page_footer",), ("image_caption",), ("odd",), (None,)], "l string")
    assert [r.v for r in labels.select(adapters.block_type(F.col("l")).alias("v")).collect()] == ["heading", "footer", "caption", "other", None]
    table = spark.createDataFrame([([["a", "b|c"], ["d"]],), ([],)], "rows array<array<string>>")
    assert [r.v for r in table.select(adapters.markdown_table(F.col("rows")).alias("v")).collect()] == ["| a | b\\|c |\n|---|---|\n| d |  |", ""]
    cells = spark.createDataFrame([("t", 0, 0, 1, 2, True, "H<"), ("t", 0, 1, None, None, None, "covered"), ("t", 1, 0, None, None, None, "a"), ("t", 1, 1, None, None, None, None)], "key string, row int, col int, row_span int, col_span int, is_header boolean, text string")
    assert adapters.html_tables(cells, "key").first().html == '<table><tr><th colspan="2">H&lt;</th></tr><tr><td>a</td><td></td></tr></table>'
    text = spark.createDataFrame([('```json\n{"a": 1}\n``` done',), ("no json",), ('{"a": ',), (None,)], "t string")
    assert [r.v and r.v.a for r in text.select(adapters.tolerant_json(F.col("t"), "a int").alias("v")).collect()] == [1, None, None, None]
    ages = spark.createDataFrame([("18 Years",), ("N/A",), (None,)], "a string")
    assert [r.v and (r.v.value, r.v.unit) for r in ages.select(adapters.age(F.col("a")).alias("v")).collect()] == [(18.0, "years"), None, None]


def test_registry_truth(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"protocolSection": {"identificationModule": {"nctId": "NCT1"}, "designModule": {"enrollmentInfo": {"count": 7}}}, "documentSection": {"largeDocumentModule": {"largeDocs": [{"hasProtocol": false, "filename": "a"}, {"hasProtocol": true, "filename": "b"}]}}}')
    row = adapters.registry_truth(adapters.read_json(spark, str(tmp_path), adapters.STUDY_SCHEMA)).first()
    assert (row.nct_id, row.enrollment_count, row.phases, row.protocol_document.filename, row.arms) == ("NCT1", 7, [], "b", None)


def test_first_success(spark):
    rows = [("d", 0, 0, "mineru", "error"), ("d", 0, 1, "pymupdf", "ok"), ("d", 1, 0, "mineru", "ok"), ("d", 2, 0, "mineru", "remote_unavailable"), ("d", 3, 0, "x", "error")]
    got = adapters.first_success(spark.createDataFrame(rows, "doc_id string, page_num int, route_rank int, route string, outcome string"))
    assert {r.page_num: (r.route, r.status) for r in got.collect()} == {0: ("pymupdf", "fallback"), 1: ("mineru", "ok"), 2: (None, "skipped"), 3: (None, "error")}


def test_retry():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise adapters.Transient
        return "ok"

    assert adapters.with_retry(flaky, sleep=waits.append) == "ok" and waits == [1.0, 2.0]
    with pytest.raises(ValueError):
        adapters.with_retry(lambda: int("x"), sleep=waits.append)


def test_layout_tree(spark):
    tree = '[{"page_idx": 2, "discarded_blocks": [{"type": "header", "lines": [{"spans": [{"content": "h"}]}]}], "para_blocks": [{"type": "text", "lines": [{"spans": [{"content": "a"}, {"content": "b"}]}], "bbox": [1, 2, 3, 4]}, {"type": "list", "blocks": [{"type": "text", "lines": [{"spans": [{"content": "c"}]}]}]}]}]'
    frame = spark.createDataFrame([("d", tree), ("e", "{bad"), ("f", None)], "doc_id string, tree string")
    got = adapters.layout_tree_blocks(frame).orderBy("order_index").collect()
    assert [(r.page_num, r.order_index, r.text, r.parent_index) for r in got] == [(2, 0, "h", None), (2, 1, "ab", None), (2, 2, "c", 1)]


def test_streaming(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(1, "a", 1), (2, "b", 2)]
    spark.createDataFrame(rows, "k long, v string, n int").write.parquet(source)
    stream = incremental.landed(spark, source, "k long, v string, n int", 1)
    for _ in range(2):
        incremental.append_processed(stream, lambda b: b.withColumn("m", F.col("n") * 2), target, str(tmp_path / "chk")).awaitTermination()
    assert sorted(r.m for r in spark.read.parquet(target).collect()) == [2, 4]
    done = spark.createDataFrame([], "stage string, input_hash string")
    fresh = incremental.unprocessed(spark.read.parquet(source), done, ["k", "v"], "s")
    seen = fresh.limit(1).select(F.lit("s").alias("stage"), "input_hash")
    assert fresh.count() == 2 and incremental.unprocessed(spark.read.parquet(source), seen, ["k", "v"], "s").count() == 1


def test_presence_reaches_over_blocks_and_segments(spark):
    rng = random.Random(6)
    rows, needles, bodies = [], [], {}
    for d in range(6):
        words, at = [], 0
        for page in range(0, 200, rng.choice([7, 30])):
            some = [f"w{rng.randint(0, 40)}" for _ in range(rng.randint(0, 5))]
            rows.append((f"d{d}", " ".join(some) if rng.random() < 0.9 else f"  {' '.join(some).upper()}\n", page, 0, len(rows)))
            words += some
        bodies[f"d{d}"] = words
        for _ in range(25):
            at, n = rng.randrange(max(1, len(words) - 9)), rng.randint(1, 9)
            some = words[at : at + n]
            if rng.random() < 0.5:
                some = [w if rng.random() < 0.7 else "zz" for w in some]
            needles.append((f"d{d}", len(needles), " ".join(some)))
    needles += [("d0", 900, "w"), ("d0", 901, "zzz"), ("none", 902, "a b c d"), ("none", 903, "a")]
    got = {r.needle_id: (round(r.share, 6), r.present) for r in matching.fuzzy_presence(
        spark.createDataFrame(needles, "key string, needle_id int, text string"), spark.createDataFrame(rows, "key string, text string, page_num int, order_index int, block_id long")).collect()}
    wanted = {}
    for key, i, text in needles:
        words, own = bodies.get(key, []), text.split()
        if len(own) < 4:
            share = 1.0 if own and " ".join(own) in " ".join(words) else 0.0
        else:
            grams = {tuple(own[k : k + 4]) for k in range(len(own) - 3)}
            share = len(grams & {tuple(words[k : k + 4]) for k in range(len(words) - 3)}) / len(grams)
        wanted[i] = (round(share, 6), share >= 0.6)
    assert got == wanted


def test_gram_counts_equal_sets(spark):
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randint(0, 3)}" for _ in range(n)) for n in (0, 1, 3, 4, 5, 40, 400)]
    for text in texts:
        words = text.split()
        assert matching.distinct_grams(words) == (len({tuple(words[k : k + 4]) for k in range(len(words) - 3)}) if len(words) > 3 else bool(words))
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "id long, text string")
    assert {r.id for r in matching.gram_counts(frame, "id").collect()} == {1, 2, 3, 4, 5, 6}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(2)
    base = [[f"w{rng.randint(0, 200)}" for _ in range(rng.randint(1, 60))] for _ in range(15)]
    rows = []
    for words in base:
        for _ in range(6):
            changed = [*words]
            for _ in range(rng.choice([0, 0, 1, 2])):
                changed[rng.randrange(len(changed))] = f"x{rng.randint(0, 3)}"
            rows.append((len(rows), " ".join(changed)))
    rows += [(900, None), (901, ""), (902, "W1, w2"), (903, "w1 w2")]
    sets = {i: frozenset(tuple(t.lower().replace(",", "").split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))) for i, t in rows if t}
    classes = {}
    for i, s in sets.items():
        classes.setdefault(s, i)
    links = {a: sum(x != y and len(x & y) / len(x | y) >= 0.8 for y in classes) for x, a in classes.items()}
    got = {r.id: (r.class_id, r.n_links) for r in matching.near_duplicates(spark.createDataFrame(rows, "id long, text string"), "id").collect()}
    assert got == {i: (classes[s], links[classes[s]]) for i, s in sets.items()} and max(links.values()) > 0
    assert matching.near_duplicates(spark.createDataFrame([], "id long, text string"), "id").count() == 0


def test_term_uses(spark):
    text = "The Adverse Event, adverse events and ADVERSE EVENT; preadverse event; (adverse event)"
    blocks = spark.createDataFrame([(1, "d", 0, 0, text), (2, "d", 0, 1, None), (3, "e", 0, 0, "adverse event")], "block_id long, doc_id string, page_num int, order_index int, text string")
    terms = spark.createDataFrame([("d", "adverse event", 1), ("d", "the", 1), ("d", "(adverse", 1), ("d", "", 1), ("d", None, 1)], "doc_id string, term string, source_id long")
    got = {(r.term, r.start_pos, r.surface) for r in indexes.defined_term_uses(blocks, terms).collect()}
    assert got == {("adverse event", 4, "Adverse Event"), ("adverse event", text.index("ADVERSE"), "ADVERSE EVENT"), ("adverse event", text.index("(") + 1, "adverse event")}
    found = indexes.glossary_sources(spark.createDataFrame([("d", "verse ev"), ("d", "nothing"), ("e", "Event")], "doc_id string, term string"), blocks)
    assert {tuple(r) for r in found.collect()} == {("d", "verse ev", 1), ("d", "nothing", None), ("e", "Event", 3)}


def test_values_without_inner_words_are_mentioned(spark):
    from leafwork.operators import annotate

    values = spark.createDataFrame([("k", "ASTHMA"), ("k", "severe asthma attack"), ("k", "thm"), ("k", "≥"), ("k", " "), ("k", None), ("k", "none"), ("j", "asthma")], "key string, value string")
    texts = spark.createDataFrame([("k", 1, "A severe Asthma attack ≥ 3"), ("k", 2, None)], "key string, block_id long, text string")
    assert {tuple(r) for r in annotate.mentioned(values, texts).collect()} == {("k", "ASTHMA", True), ("k", "severe asthma attack", True), ("k", "thm", True), ("k", "≥", True), ("k", "none", False), ("j", "asthma", False)}


def test_rule_first_with_a_fallback(spark):
    from leafwork.operators import records

    rows = spark.createDataFrame([(1, "a", 0.95), (2, "b", 0.6), (3, None, None)], "i int, r string, c double")
    plain = records.rule_first(rows, F.col("r"), F.col("c"))
    assert {(r.i, r.role, r.confidence, r.by_rule) for r in plain.collect()} == {(1, "a", 0.95, True), (2, "unknown", 0.0, False), (3, "unknown", 0.0, False)}
    asked = records.rule_first(rows, F.col("r"), F.col("c"), lambda rest: rest.withColumns({"role": F.lit("model"), "confidence": F.lit(0.7)}))
    assert {(r.i, r.role, r.by_rule) for r in asked.collect()} == {(1, "a", True), (2, "model", False), (3, "model", False)}
    answers = spark.createDataFrame([("d", 1, "x")], "doc_id string, page_num int, answer string")
    routes = spark.createDataFrame([("d", p, "q") for p in (1, 2, 70)], "doc_id string, page_num int, primary_route string")
    assert {(r.page_num, r.answer) for r in records.prefetched(routes, answers).collect()} == {(1, "x"), (2, None), (70, None)}
    assert {(r.batch, tuple(r.pages)) for r in records.prefetch_plan(routes).collect()} == {(0, (1, 2)), (1, (70,))}
    assert records.head_sample(spark.range(50).withColumnRenamed("id", "page_num")).count() == 30
    assert records.run_summary(spark.createDataFrame([], "outcome string, n_pages int, seconds double")).first().documents == 0
