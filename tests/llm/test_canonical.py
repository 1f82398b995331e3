from leafwork.llm import canonical


def forms(spark, *texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    rows = {r.id: r for r in canonical.canonical_texts(frame, ("id",)).collect()}
    return [rows[i].canonical if i in rows else None for i in range(len(texts))]


def test_same_look(spark):
    groups = [
        ("Use of 5 mg", "Use\u00a0of\u20095\u202fmg", "\ufeffUse of 5 mg\u200b", "\uff35\uff53\uff45 of \uff15 mg", "U\u0455\u0435 \u043ef 5 mg", " Use of 5 mg "),
        ("Caf\u00e9-au-lait", "Cafe\u0301-au-lait", "Caf\u00e9\u2011au\u2010lait", "Caf\u00e9\u00ad-au-lait"),
        ("\u00b5g at 5 \u00b0C", "\u03bcg at 5 \u2103"),
        ("\u30ac\u30c7\u30b9\u30fb\u300c\u3002\u300d", "\uff76\uff9e\uff83\uff9e\uff7d\uff65\uff62\uff61\uff63"), ("\u00a2 \u00a3 \u00ac \u00a6 \u00a5 \u20a9", "\uffe0 \uffe1 \uffe2 \uffe4 \uffe5 \uffe6"),
        ("USA Oslo", "\u054d\u054f\u0410 \u0555sl\u0585"), ("HELP", "\u13bb\u13ac\u13de\u13e2"), ("a l g", "\u0251 \u04cf \u0261"), ("5 \u00c5", "5 \u212b"), ("a b", "a\u3164 \u2060b", "a\u2800b", "\uffa0a b"),
        ("confirmed III K", "con\ufb01rmed \u2162 \u212a"),
        ("\u0440\u0435\u0432\u043c\u0430\u0442\u043e\u0438\u0434\u043d\u044b\u0439", "\u0440\u0435\u0432\u043c\u0430\u0442\u043e\u0438\u0434\u043d\u044b\u0438\u0306"),
    ]
    for group in groups:
        assert len(set(forms(spark, *group))) == 1, group


def test_other_look(spark):
    for a, b in (("cm2", "cm\u00b2"), ("Cafe", "Caf\u00e9"), ("x > 5", "x \u2265 5"), ("the", "The"), ("TNF-\u03b1", "TNF-a"), ("**a**", "a"), ("a b", "ab"), ("5 mg", "5 m\u200bg x")):
        one, two = forms(spark, a, b)
        assert one != two, (a, b)


def test_null_empty_ascii_long(spark):
    assert forms(spark, None, "", "   ", "a\tb  c", "x y" * 100_000)[:4] == [None, "", "", "a b  c"]


def test_look_alikes(spark):
    gold = spark.createDataFrame([("d", 1, "a b"), ("d", 2, "a\u00a0b"), ("e", 3, "a b"), ("d", 4, None), ("d", 5, " ")], "doc_id string, gold_id long, text string")
    other = spark.createDataFrame([("d", 7, "a b", 1), ("d", 8, "a \u200bb", 1), ("e", 9, "a b", 1), (None, 10, "a b", 1), ("d", 11, None, 1), ("d", 12, "\u00a0", 1)], "doc_id string, row long, text string, gold_id int")
    found = canonical.look_alikes(gold, {"block": (other, "row")})
    assert {tuple(r) for r in found.collect()} == {("block", 7, 2), ("block", 8, 1), ("block", 8, 2)}
    assert canonical.look_alikes(gold.where("false"), {"block": (other, "row")}).count() == 0


def test_query_gives_the_form_of_all_three_tables(spark, tmp_path):
    from leafwork.llm import queries

    rows = {
        "gold_eligibility": ("gold_id", [(1, "d", "Use\u00a0of 5 mg"), (2, "d", None)]),
        "extracted_criteria": ("criterion_id", [(1, "d", "Use of 5 m\u200bg"), (3, None, "")]),
        "extracted_blocks": ("block_id", [(1, "e", "\uff35se of 5 mg"), (1, "e", "\uff35se of 5 mg"), (4, "e", None)]),
    }
    for name, (key, values) in rows.items():
        spark.createDataFrame(values, f"{key} bigint, doc_id string, text string").write.parquet(str(tmp_path / f"{name}.parquet"))
    found = queries.queries()["p4_canonical"](spark, str(tmp_path))
    assert found.columns[:4] == ["src", "row_id", "doc_id", "canonical"]
    form = "Use of 5 mg"
    assert sorted(((r.src, r.row_id, r.doc_id, r.canonical) for r in found.collect()), key=str) == [("block", 1, "e", form), ("block", 1, "e", form), ("criterion", 1, "d", form), ("criterion", 3, None, ""), ("gold", 1, "d", form)]
