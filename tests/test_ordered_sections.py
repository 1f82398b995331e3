import random

from pyspark.sql import functions as F

from leafwork.operators import chunks, ordered, sections

SCHEMA = "block_id long, doc_id string, page_num int, order_index int, block_type string, text string, bbox struct<x0:double,y0:double,x1:double,y1:double>"


def make(spark, rows):
    return ordered.distinct_blocks(spark.createDataFrame([(*r, None) for r in rows], SCHEMA))


def random_document(seed, doc, pages=300):
    rng = random.Random(seed)
    rows = []
    for page in range(0, pages, rng.choice([1, 3])):
        for order in range(rng.randint(0, 4)):
            kind = rng.choice(["heading", "paragraph", "table", "footer", "paragraph"])
            number = ".".join(str(rng.randint(1, 3)) for _ in range(rng.randint(1, 4)))
            text = rng.choice([f"{number} Title", f"{number}. Title", "Age", "", None]) if kind == "heading" else rng.choice(["x", "", None])
            rows.append((doc * 100_000 + len(rows), f"d{doc}", page, order, kind, text))
    return rows


def stack_model(rows):
    """The rule as a state machine, written from its description."""
    import re

    out, stack, last = {}, [], 0
    for block_id, _, _, _, kind, text in sorted(rows, key=lambda r: (r[2], r[3])):
        if kind == "heading":
            label = (text or "").strip()
            m = re.match(r"(\d+(?:\.\d+)*)\.?\s+", label)
            depth = m[1].count(".") + 1 if m else last + 1
            last = depth if m else last
            while stack and stack[-1][0] >= depth:
                stack.pop()
            stack.append((depth, label, m[1] if m else None))
        numbers = [s[2] for s in stack if s[2]]
        out[block_id] = ([s[1] for s in stack], stack[-1][0] if stack else 0, numbers[-1] if numbers else None)
    return out


def test_paths_equal_the_stack(spark):
    rows = [r for d in range(6) for r in random_document(d, d)]
    expected = {k: v for d in range(6) for k, v in stack_model([r for r in rows if r[1] == f"d{d}"]).items()}
    random.Random(0).shuffle(rows)
    got = {r.block_id: (list(r.section_path), r.section_depth, r.section_number) for r in sections.section_paths(make(spark, rows)).collect()}
    assert got == expected


def test_segmented_windows_equal_plain_ones(spark):
    from pyspark.sql import Window

    rows = [r for d in range(4) for r in random_document(10 + d, d)]
    frame = make(spark, rows)
    plain = Window.partitionBy("doc_id").orderBy("page_num", "order_index")
    upto = plain.rowsBetween(Window.unboundedPreceding, 0)
    value = F.when(F.col("block_type") == "table", F.col("block_id"))
    a = ordered.carry_last(frame, {"v": value}).withColumn("w", F.last(value, True).over(upto))
    b = ordered.neighbour(frame, {"v": F.col("block_id")}, 1).withColumn("w", F.lead("block_id").over(plain))
    c = ordered.neighbour(frame, {"v": F.col("text")}, -1).withColumn("w", F.lag("text").over(plain))
    d = ordered.reading_position(frame, "v").withColumn("w", (F.row_number().over(plain) - 1).cast("bigint"))
    e = ordered.carry_last(frame, {"v": value}, own=False).withColumn("w", F.last(value, True).over(plain.rowsBetween(Window.unboundedPreceding, -1)))
    for frame in (a, b, c, d, e):
        assert frame.where(~F.col("v").eqNullSafe(F.col("w"))).count() == 0 and frame.count() == len(rows)


def test_repeated_deliveries_and_empty(spark):
    rows = [(2, "d", 0, 0, "heading", "1 B"), (1, "d", 0, 0, "heading", "1 A"), (3, None, 0, 0, "heading", "x"), (4, "d", None, None, None, None)]
    got = {r.block_id: list(r.section_path) for r in sections.section_paths(make(spark, rows)).collect()}
    assert got == {1: ["1 A"], 4: []}
    empty = make(spark, rows).where("false")
    assert sections.section_paths(empty).count() == sections.section_index(sections.section_paths(empty)).count() == chunks.neighbours(empty).count() == 0


def test_index_tree_and_template(spark):
    rows = [(1, "d", 0, 0, "heading", "5 Population"), (2, "d", 0, 1, "heading", "5.1.2. Deep"), (3, "d", 1, 0, "paragraph", "x"), (4, "d", 1, 1, "heading", "Age"), (5, "d", 2, 0, "heading", "12 Other")]
    parsed = sections.template_sections(sections.section_paths(make(spark, rows)))
    got = {r.block_id: (r.m11_section, r.functional_label) for r in parsed.collect()}
    assert got == {1: ("5", "eligibility"), 2: ("5.1", "eligibility_inclusion"), 3: ("5.1", "eligibility_inclusion"), 4: ("5.1", "eligibility_inclusion"), 5: (None, None)}
    assert sections.section_index(parsed).count() == 4
    tree = {tuple(r.path): (r.n_blocks, r.n_below) for r in sections.section_tree(parsed).collect()}
    assert tree[("5 Population",)] == (1, 4) and tree[("5 Population", "5.1.2. Deep")] == (2, 3)
    cover = sections.template_coverage(parsed).first()
    assert (cover.n_present, cover.n_missing, cover.percent) == (1, 10, 9.1)


def test_table_continuations_and_footnotes(spark):
    rows = [
        (1, "d", 0, 0, "table", "a"), (2, "d", 0, 1, "footer", "f"), (3, "d", 1, 0, "header", "h"), (4, "d", 1, 1, "table", "b"), (5, "d", 1, 2, "paragraph", "see x* and [1] and (b)"),
        (6, "d", 1, 3, "footnote", "* first"), (7, "d", 1, 4, "footnote", "* second"), (8, "d", 1, 5, "footnote", "[1] one"), (9, "d", 2, 0, "footnote", "(b) other page"), (10, "d", 3, 0, "table", "c"),
    ]
    frame = make(spark, rows)
    assert [tuple(r) for r in chunks.table_continuations(frame).collect()] == [(1, 4)]
    assert {(r.block_id, r.marker, r.definition_id) for r in chunks.footnotes(frame).collect()} == {(5, "*", 6), (5, "1", 8)}


def test_parents(spark):
    rows = [(1, "d", 0, 0, None), (2, "d", 0, 1, 0), (3, "d", 0, 2, 2), (4, "d", 0, 3, 9), (5, "d", 0, 4, 0), (6, "d", 1, 0, 0)]
    frame = spark.createDataFrame(rows, "block_id long, doc_id string, page_num int, order_index int, parent_block_id int")
    links = chunks.parent_links(frame)
    assert {(r.order_index, r.parent_index) for r in links.collect()} == {(1, 0), (4, 0)}
    assert [list(r.children) for r in chunks.child_lists(links).collect()] == [[1, 4]]


def legacy_model(rows):
    """The older rule as a state machine, written from its description."""
    import re

    out, stack = {}, []
    for block_id, _, _, _, kind, text in sorted(rows, key=lambda r: (r[2], r[3])):
        if kind != "heading":
            continue
        text = text or ""
        m = re.match(r"(\d+(?:\.\d+)*)\s+", text)
        if m:
            depth = m[1].count(".") + 1
            while stack and stack[-1][0] >= depth:
                stack.pop()
            stack.append((depth, text))
        else:
            if stack:
                stack.pop()
            stack.append((1, text))
        out[block_id] = [t for _, t in stack]
    return out


def test_legacy_paths_equal_the_stack(spark):
    rows = [r for d in range(6) for r in random_document(20 + d, d)]
    expected = {k: v for d in range(6) for k, v in legacy_model([r for r in rows if r[1] == f"d{d}"]).items()}
    random.Random(1).shuffle(rows)
    got = {r.block_id: list(r.section_path) for r in sections.legacy_paths(make(spark, rows)).collect()}
    assert got == expected
    assert sections.legacy_paths(make(spark, rows).where("false")).count() == 0


def test_levels_have_no_bound(spark):
    deep = ".".join("1" * 14)
    rows = [(i, "d", i, 0, "heading", f"{'.'.join('1' * (i + 1))} H{i}") for i in range(14)] + [(20, "d", 20, 0, "paragraph", "x"), (21, "d", 21, 0, "heading", "Unnumbered"), (22, "d", 22, 0, "heading", "1.1 Back")]
    got = {r.block_id: (len(r.section_path), r.section_depth, r.section_number) for r in sections.section_paths(make(spark, rows)).collect()}
    assert got[20] == (14, 14, deep) and got[21] == (15, 15, deep) and got[22] == (2, 2, "1.1")
