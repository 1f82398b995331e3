from pyspark.sql import functions as F

from leafwork.functions import lookups
from leafwork.functions import text as T


def values(spark, function, *texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in frame.select("i", function(F.col("t")).alias("v")).orderBy("i").collect()]


def test_normalize_text(spark):
    assert values(spark, T.normalize_text, "“a”–b  c\n\n\n\nd ", "ﬁ ", None, "", "plain") == ['"a"-b c\n\nd', "fi", None, "", "plain"]
    assert values(spark, T.casefold_key, "Straße", None) == ["strasse", None]


def test_operators(spark):
    texts = ("at least 3", "no fewer than 3", "≥ 3", "atleast 3", "greater than or equal to 3", "up to 5", "minimum of 2", None)
    assert values(spark, T.normalize_operators, *texts) == [">= 3", "<= 3", ">= 3", "atleast 3", ">= 3", "<= 5", ">= 2", None]
    assert values(spark, lambda c: T.normalize_operators(c, False), "no fewer than 3") == [">= 3"]


def test_number_words(spark):
    texts = ("eighteen years", "twenty-one days", "two hundred and five", "three thousand", "hundred", "someone", None)
    assert values(spark, T.number_words, *texts) == ["18 years", "21 days", "205", "3000", "hundred", "someone", None]


def test_identifiers(spark):
    assert values(spark, T.nct_number, "NCT 1234567", "nct-00012345", "NCT123456789", None, "x") == ["NCT01234567", "NCT00012345", None, None, None]
    assert values(spark, T.eudract_number, "2021-004567-11.", "2021 004567 11", "2021-4567-11") == ["2021-004567-11", "2021-004567-11", None]
    assert values(spark, T.doi, "doi: 10.1234/abc.5 x", "10.12/x") == ["10.1234/abc.5", None]


def test_mentions_and_markers(spark):
    assert values(spark, T.mentions, "Table 3a, Section 5.1 and section 5.1, Section 5.1", "Sections", None) == [["Section 5.1", "section 5.1", "Table 3a"], [], None]
    assert [m and (m.kind, m.value) for m in values(spark, T.list_marker, "(a) x", "(B) x", "(12) x", "3. x", "1 Age", "1 age", "• x", "– x", "", None)] == [
        ("paren_lower", "a"), ("paren_upper", "B"), ("paren_num", "12"), ("dot_num", "3"), ("bare_num", "1"), None, ("bullet", "•"), ("dash", "–"), None, None,
    ]
    assert values(spark, T.footnote_markers, "x* y² [12] (b) [12]", "* x", "") == [["²", "*", "12", "b"], [], []]
    assert values(spark, T.leading_marker, "[1] a", "* a", "a) b", "Ab c", None) == ["1", "*", "a", None, None]


def test_initials(spark):
    frame = spark.createDataFrame([("ORR", "ORR"), ("SOAE", "SAE"), ("XY", "ABC"), ("", "A"), ("OSAEX", "SAE")], "l string, a string")
    assert [r.v for r in frame.select(T.initials_match(F.col("l"), F.col("a")).alias("v")).collect()] == [True, True, False, False, True]


def test_forms(spark):
    assert values(spark, T.match_form, r"x \geq 5 \mathrm{mg}", "≥ 5", None) == ["x >= 5 mg", ">= 5", ""]
    assert values(spark, T.compare_form, "A–B  ‘c’", None) == ["a-b 'c'", ""]
    assert values(spark, T.text_confidence, "abc", "", None, "a\x01") == [1.0, 0.0, 0.0, 0.5]
    assert values(spark, T.html_escape, 'a<b & "c"\nd') == ["a&lt;b &amp; &quot;c&quot;<br>d"]


def test_sentences_and_language(spark):
    got = values(spark, T.sentences, "One is. Two here!  Three e.g. four", "", None)
    assert [(s.start, s.end, s.text) for s in got[0]] == [(0, 7, "One is."), (8, 17, "Two here!"), (19, 34, "Three e.g. four")]
    assert got[1] == [] and got[2] is None
    texts = ("The dose of the drug is given", "Die Dosis ist nicht für den Patienten", "Le patient est dans la salle pour un examen", "El paciente no fue según el plan", "患有心力衰竭的受试者", "Прием препарата", "", None)
    assert values(spark, T.language, *texts) == ["en", "de", "fr", "es", "zh", "ru", "en", "en"]


def test_lookups(spark):
    assert values(spark, lookups.unit_code, " MG  per dL", "°C", "parsec", None) == ["mg/dL", "Cel", None, None]
    assert [f and (f.frequency, f.period, f.period_unit, f.label) for f in values(spark, lookups.frequency, "BID", "every 8 hours", "prn", "never", None)] == [(2, 1, "d", "BID"), (1, 8, "h", "TID"), (None, None, None, "PRN"), None, None]
    assert [r and r.code for r in values(spark, lookups.route, "p.o.", "By Mouth", "air")] == ["26643006", "26643006", None]
    assert values(spark, lookups.negation_kind, "HISTORICAL", "odd", None) == ["history", "definite", "definite"]
    assert values(spark, lookups.sex, "Women", "x") == ["female", None]
    assert values(spark, lambda c: lookups.longest_prefix(c, lookups.TEMPLATE_SECTIONS), "5.1.2.3", "9.4", "12", None) == ["5.1", "9", None, None]
    assert values(spark, lambda c: lookups.hints(c, lookups.CLASS_HINTS), "dosing", "background", None) == [["StudyIntervention", "Administration", "Strength"], [], []]
    assert values(spark, lambda c: lookups.entity_type(c)["entity_type"], "lab value", "odd", None) == ["MEASUREMENT", "OTHER", "OTHER"]
    assert values(spark, lambda c: lookups.repaired_type(F.lit("table"), c), "Table_Caption", "page-number", "text", None) == ["caption", "other", "table", "table"]
    assert values(spark, T.chunk_marker, "1. a", "(a) b", "A patient", "text", None) == ["1", "(a)", "A", None, None]
    assert [(r and r.marker, r and r.body) for r in values(spark, T.marker_and_body, "12 text ", "(iv) x", "plain  ")] == [("12", "text"), ("(iv)", "x"), (None, "plain")]
    assert len(lookups.UNITS) < 200 and lookups.UNITS["k/ml"] == "10*3/mL"
