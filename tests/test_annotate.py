from pyspark.sql import functions as F

from leafwork.operators import annotate


def test_cues_and_telemetry(spark):
    blocks = spark.createDataFrame([(1, "He must come by week 12, for 3 days [1]."), (2, None), (3, "")], "block_id long, text string")
    found = {(r.kind, r.start_pos, r.surface) for r in annotate.cues(blocks, annotate.TIMES).collect()}
    assert found == {("visit", 16, "week 12"), ("duration", 29, "3 days")}
    counts = annotate.telemetry({"t": annotate.cues(blocks, annotate.TIMES), "c": annotate.cues(blocks, annotate.CITATIONS, False)})
    assert {tuple(r) for r in counts.collect()} == {("t", 2, 1), ("c", 1, 1)}


def test_boilerplate(spark):
    rows = [(d, f"Notice {i}\nown {d}") for i, d in enumerate("abc")] + [("d", "alone"), ("e", None)]
    got = {r.doc_id: (r.n_lines, r.boilerplate) for r in annotate.boilerplate_scores(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"a": (2, 0.5), "b": (2, 0.5), "c": (2, 0.5), "d": (1, 0.0)}


def test_purity_structure_and_conformance(spark):
    documents = spark.createDataFrame([(1, "The dose is given to the patient. Die Dosis ist nicht für den Patienten. It is for the study."), (2, None)], "doc_id long, text string")
    assert [(r.doc_id, r.language, round(r.purity, 3)) for r in annotate.language_purity(documents).collect()] == [(1, "en", 0.667)]
    cells = spark.createDataFrame([("t", 0, 0, None, 2, True), ("t", 1, 0, None, None, False), ("t", 1, 1, None, None, None)], "k string, row int, col int, row_span int, col_span int, is_header boolean")
    assert tuple(annotate.table_structure(cells, "k").first()) == ("t", 2, 2, 1, 1)
    got = annotate.conformance(documents, {"text": "text is not null", "key": "doc_id > 0"}).collect()
    assert {tuple(r) for r in got} == {("text", 2, 1), ("key", 2, 0)}


def test_mentions_and_links(spark):
    values = spark.createDataFrame([("k", "Heart Failure"), ("k", "stroke"), ("k", None)], "key string, value string")
    texts = spark.createDataFrame([("k", "with heart failure now"), ("j", "stroke"), ("k", None)], "key string, text string")
    assert {tuple(r) for r in annotate.mentioned(values, texts).collect()} == {("k", "Heart Failure", True), ("k", "stroke", False)}
    uses = spark.createDataFrame([(1, 2), (1, 2), (3, None), (4, 4)], "block_id long, target_id long")
    assert {tuple(r) for r in annotate.co_occurring(uses).collect()} == {(1, 2), (2, 1)}
    assert annotate.recall_report(spark.createDataFrame([(1.0,), (0.5,), (None,)], "recall double").withColumn("k", F.lit(1))).first().mean_recall == 0.75
