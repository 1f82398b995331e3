from leafwork.llm import scans


def test_skeleton_levels_confusions():
    pairs = [("vveek", "week"), ("frorn", "from"), ("clays", "days"), ("w!th", "with"), ("wifh", "with"), ("witb", "with"), ("coiint", "count"), ("0bese", "obese"), ("unbhnded", "unblinded"), ("tria1", "trial"), ("P@ge", "page")]
    assert all(scans.skeleton(a) == scans.skeleton(b) for a, b in pairs)
    assert scans.skeleton("dose") != scans.skeleton("nose")


def test_page_numbers():
    good = {"1 | Page": 1, "Page 12 of 88": 12, "- 3 -": 3, "[7]": 7, "p. 4": 4, "iv": 4, "Pa9e 3": 3, "Pagc 5 of 8": 5, "3/20": 3, "第 6 页": 6, "l2 | Page": 12, "9": 9}
    assert {k: scans.page_number(k) for k in good} == good
    for line in ("412.0", "15 mg", "week 4.", "2 Introduction", "", "CD20 expression", "mild", "5%", "Page"):
        assert scans.page_number(line) is None, line


def test_line_keys():
    keys = lambda line, page: set(scans.line_keys(line, page))
    assert keys("Protoco1 X, page 12", 11) & keys("Protocol X, pa9e 3", 2)
    assert not keys("Protocol X", 1) & keys("Protocol Y", 2)
    assert not keys("80 mg", 4) & keys("25 mg", 6) and keys("Version 6.0", 1) & keys("Vers!on 6.0", 9)
    assert keys("page 4 of 20", 3) & keys("page 9 of 20", 8)


def test_unbroken_drops_halves():
    assert scans._unbroken("a bro-\nken word") == ["a", "word"]
    assert scans._unbroken("plain words\nhere") == ["plain", "words", "here"]


def _blocks(spark):
    body = "the medical monitor reviews the treatment before every dose and the monitor records the treatment"
    rows, i = [], 0
    for doc in ("s1", "s2", "t1"):
        for page in range(4):
            scanned = "qwen_vl" if doc != "t1" else "docling"
            texts = [("header", f"Protocol ABC-{doc} Amendment"), ("paragraph", body), ("footer", f"Page {page + 1} of 4")]
            for order, (kind, text) in enumerate(texts):
                rows.append((i, doc, page, order, kind, text, scanned))
                i += 1
    rows += [
        (100, "s1", 1, 5, "paragraph", "the trea-\ntment and the medical rnonitor", "qwen_vl"),
        (101, "s1", 2, 7, "paragraph", "before the follow-\nup dose ends with the treat-", "qwen_vl"),
        (102, "s1", 3, -1, "paragraph", "ment reviews", "qwen_vl"),
        (103, "t1", 0, 9, "paragraph", "a follow-up dose, a follow-up dose, rnonitor", "docling"),
        (104, "s1", None, None, "paragraph", None, "qwen_vl"),
        (105, None, 0, 0, None, "", "qwen_vl"),
        (106, "s2", 2, 3, "other", "Protoco1 ABC-s2 Amendment", "qwen_vl"),
    ]
    return spark.createDataFrame(rows, "block_id long, doc_id string, page_num int, order_index int, block_type string, text string, parser_used string")


def test_found(spark):
    noise = scans.ScanNoise(_blocks(spark))
    found = {(r.block_id, r.noise) for r in noise.found().collect()}
    assert (100, "hyphen") in found and (100, "char") in found
    assert (101, "hyphen") in found
    assert (106, "running") in found and (106, "char") in found
    assert {b for b, n in found if n == "page_no"} == {2, 5, 8, 11, 14, 17, 20, 23}
    assert {0, 3, 6, 9, 12, 15} <= {b for b, n in found if n == "running"}
    assert not {b for b, _ in found} & {103, 104, 105, *range(24, 36)}


def test_empty(spark):
    assert scans.ScanNoise(_blocks(spark).where("false")).found().count() == 0


def test_repair_block():
    best = {"rnonitor": "monitor", "trea1ment": "treatment"}
    breaks = {("trea", "tment"): (True, None), ("follow", "up"): (False, None), ("confirm", "ecl"): (True, "confirmed")}
    fix = lambda text, kind="paragraph": scans.repair_block(text, kind, best, breaks, set(), {"Page 3"})
    assert fix("The trea-\ntment, by the RNONITOR\nPage 3\nand follow-\nup.") == "The treatment, by the MONITOR and follow-up."
    assert fix("was Confirm-\necl (Rnonitor).") == "was Confirmed (Monitor)."
    assert fix("- a rnonitor\n- b", "list") == "- a monitor\n- b"
    assert fix("Page 3") == "" and fix("") == ""


def test_paragraphs(spark):
    noise = scans.ScanNoise(_blocks(spark))
    rows = {(r.doc_id, r.first_page, r.last_page): r.text for r in scans.paragraphs(scans.repaired_blocks(noise)).collect() if r.doc_id == "s1"}
    assert any("the treatment and the medical monitor" in t for t in rows.values())
    assert any("with the treatment reviews" in t for t in rows.values())
    assert not any("Protocol ABC" in t or "Page" in t for t in rows.values())
    assert scans.paragraphs(scans.repaired_blocks(noise).limit(0)).count() == 0


def test_clashing_columns(spark):
    blocks = _blocks(spark)
    extra = {n: scans.F.lit("x") for n in ("word", "n", "kind", "num", "a", "b", "skel", "noise", "paragraph")}
    assert scans.ScanNoise(blocks.withColumns(extra)).found().count() == scans.ScanNoise(blocks).found().count()


def _small(spark, texts, kind="paragraph", doc="d"):
    rows = [(i, f"{doc}{i % 2}", i // 2, 0, kind, t, "qwen_vl") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "block_id long, doc_id string, page_num int, order_index int, block_type string, text string, parser_used string")


def test_context_decides(spark):
    # "clays" is written like "days"; only where the corpus has "days" is it a misreading. "modem" is too frequent for the ratio.
    texts = ["on the last days of treatment"] * 120 + ["the clays minerals were weighed"] * 4 + ["on the last clays of treatment"] + ["seen in modern practice today"] * 24 + ["seen in modem practice today"] + ["plug the modem cable here"] * 4
    noise = scans.ScanNoise(_small(spark, texts))
    got = {(r.block_id, r.word, r.best) for r in noise.misread().collect()}
    assert got == {(124, "clays", "days"), (149, "modem", "modern")}


def test_numbers_read_with_a_letter(spark):
    texts = [f"a dose of 150 mg was given on visit {w}" for w in ("one", "two", "three") * 40] + ["a dose of l5O mg was given", "kit l5O was lost", "vitamin B12 was given"]
    got = {(r.block_id, r.word, r.best) for r in scans.ScanNoise(_small(spark, texts)).misread().collect()}
    assert got == {(120, "l5o", "150")}


def test_pairs_equal_brute_force(spark):
    from collections import Counter

    import numpy as np

    texts = ["a b a b c", "c a b", "b", "", "a-b (a) b."]
    frame = _small(spark, texts)
    wanted = Counter()
    for t in texts:
        words = ["", *(c.strip(scans._EDGES).lower() for c in t.split()), ""]
        wanted.update(zip(words, words[1:]))
    h = lambda w: np.array([scans._hash(w)])
    asked = {p: int(scans._pair(h(p[0]), h(p[1]))[0]) for p in wanted}
    counts = {r.pair: r.n for r in scans.pair_counts(frame, spark.createDataFrame([(v,) for v in asked.values()], "h long")).collect()}
    assert all(counts[v] == wanted[p] for p, v in asked.items() if p != ("", ""))


def test_long_words_and_lines(spark):
    word = "x" * 30 + "monitor" + "y" * 60
    line = "Confidential " + "protocol of the long study with a very long running line that has far more than one hundred and forty letters in it " * 2
    texts = [f"{line}\n{word} of page {'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}" for i in range(60)] + [word.replace("m", "rn")]
    found = {(r.block_id, r.noise) for r in scans.ScanNoise(_small(spark, texts)).found().collect()}
    assert (60, "char") in found and {b for b, n in found if n == "running"} == set(range(60))


def test_furniture_of_any_height(spark):
    head = ["Header alpha of the trial", "Header beta of the trial", "Header gamma of the trial", "Header delta of the trial", "Header epsilon of the trial"]
    texts = ["\n".join([*head, f"text {'abcdefgh'[i]} one", f"text {'abcdefgh'[i]} two", "common middle line", f"text {'abcdefgh'[i]} three", f"more {'abcdefgh'[i]} text", f"end {'abcdefgh'[i]} of it"]) for i in range(8)]
    noise = scans.ScanNoise(_small(spark, texts))
    keys = {(r.block_id, r.num) for r in noise.running().collect()}
    own = {h for line in head for h in scans.line_hashes(line, 0)}
    assert {b for b, _ in keys} == set(range(8)) and {n for _, n in keys} == own
    repaired = {r.block_id: r.text for r in scans.repaired_blocks(noise).collect()}
    assert all("Header" not in t and "common middle line" in t for t in repaired.values())


def test_page_numbers_of_any_length():
    assert scans.page_number("- - - Page - - - 12 - - - of - - - 340 - - - - - - - - - - - - - -") == 12
    assert scans.page_number("page " * 30) is None and scans.page_number("1 2 3 4 5 6 7") is None


def test_paragraphs_over_segments(spark, monkeypatch):
    texts = ["The sentence begins here and", "goes on there and", "ends here.", "Another one."]
    rows = [(i, "d", 63 + i, 0, "paragraph", t, "qwen_vl") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "block_id long, doc_id string, page_num int, order_index int, block_type string, text string, parser_used string")
    got = {(r.first_page, r.last_page, r.n_blocks, r.text) for r in scans.paragraphs(scans.repaired_blocks(scans.ScanNoise(frame))).collect()}
    assert got == {(63, 65, 3, "The sentence begins here and goes on there and ends here."), (66, 66, 1, "Another one.")}


def test_pages_beyond_a_million(spark):
    rows = [(2 * i + k, "d", 999_996 + i, k, kind, f"{text}{999_997 + i}{end}", "qwen_vl") for i in range(8) for k, (kind, text, end) in enumerate([("header", "Protocol ABC, page ", ""), ("footer", "", " | Page")])]
    frame = spark.createDataFrame(rows, "block_id long, doc_id string, page_num int, order_index int, block_type string, text string, parser_used string")
    found = {(r.block_id, r.noise) for r in scans.ScanNoise(frame).found().collect()}
    assert {b for b, n in found if n == "running"} == set(range(0, 16, 2)) and {b for b, n in found if n == "page_no"} == set(range(1, 16, 2))
    assert scans.page_number("mmmmiv") == 4004 and scans.page_number("0" * 30 + "12") == 12 and scans.page_number("9" * 5000) is None and scans.page_number("²") is None


def test_halves_of_one_break_in_many_documents(spark):
    # Each half is there five times, but only broken: they are no words. The halves of the compound are words elsewhere.
    rows = []
    for d in range(5):
        rows += [(10 * d, f"d{d}", 0, 0, "paragraph", "The results confirmed the neral-", "qwen_vl"), (10 * d + 1, f"d{d}", 1, 0, "paragraph", "isib as the better one.", "qwen_vl")]
        rows += [(10 * d + 2, f"e{d}", 0, 0, "paragraph", "These were former light-", "qwen_vl"), (10 * d + 3, f"e{d}", 1, 0, "paragraph", "smokers as the others.", "qwen_vl"), (10 * d + 4, f"e{d}", 3, 0, "paragraph", "The light of the smokers.", "qwen_vl")]
    frame = spark.createDataFrame(rows, "block_id long, doc_id string, page_num int, order_index int, block_type string, text string, parser_used string")
    assert {r.block_id for r in scans.ScanNoise(frame).found().where("noise = 'hyphen'").collect()} == {0, 10, 20, 30, 40}
