import numpy as np

from leafwork.llm import repeated

NOTE = "This document is confidential and remains the property of the sponsor at all times"


def test_line_ids_level_case_blanks_and_digits():
    a = repeated.line_ids(f"short\n{NOTE} 12\n\n{NOTE.upper()}  7 ")
    assert a[0] == [2, 4] and a[1][0] == a[1][1]
    assert repeated.line_ids("") == ([], []) and repeated.line_ids("1" * 90) == ([], [])


def test_suffix_array_and_classes_equal_brute_force():
    rng = np.random.default_rng(1)
    for alphabet, cuts in ((3, 6), (2, 3), (1, 4), (40, 5)):
        ids, rows = rng.integers(0, alphabet, 60), np.repeat(np.arange(cuts), 60 // cuts)
        end = [max(np.flatnonzero(rows == r)) + 1 for r in rows]
        suffix = [tuple(ids[i : end[i]]) for i in range(60)]
        order, common = repeated.suffix_array(ids, rows)
        assert sorted(order) == list(range(60))
        for k in range(1, 60):
            a, b = suffix[order[k - 1]], suffix[order[k]]
            assert a <= b and common[k] == next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        left = repeated.remaining(rows)
        for length in (1, 2, 3, 5, 8):
            classes = repeated.prefix_classes(order, common, left, length)
            for i in range(60):
                assert (classes[i] < 0) == (len(suffix[i]) < length)
                for j in range(60):
                    if classes[i] >= 0 and classes[j] >= 0:
                        assert (classes[i] == classes[j]) == (suffix[i][:length] == suffix[j][:length])
    assert repeated.suffix_array(np.zeros(0, np.int64), np.zeros(0, np.int64))[0].size == 0


def _tables(spark, docs=10, pages=2):
    blocks, i = [], 0
    for d in range(docs):
        for p in range(pages):
            own = f"Only document number {'abcdefghij'[d % 10]} page {'abcdefghij'[p % 10]} says these words and nothing else does"
            both = f"{own}\n{NOTE} {d}\nA second repeated line which follows the first one in every document" if d < 6 else own
            blocks.append((i, f"d{d}", p, 0, "paragraph", both))
            i += 1
    blocks += [(900, "d0", 0, 1, "heading", NOTE), (901, "d1", 0, 1, "footer", None), (902, "d2", 0, 1, None, NOTE), (903, "zz", 0, 0, "paragraph", NOTE)]
    manifest = [(f"d{d}", "S") for d in range(docs)] + [("zz", None), ("d0", "S")]
    return (spark.createDataFrame(blocks, "block_id long, doc_id string, page_num int, order_index int, block_type string, text string"),
            spark.createDataFrame(manifest, "nct_id string, sponsor string"))


def test_found(spark):
    blocks, manifest = _tables(spark)
    lines = repeated.RepeatedLines(blocks, manifest)
    found = {tuple(r) for r in lines.found().collect()}
    assert found == {(i, n) for i in range(12) for n in (2, 3)} | {(902, 1)}
    assert {(r.length, r.n) for r in lines.line_blocks().collect()} == {(2, 6), (1, 6)}
    clean = {r.block_id: (r.text, r.n_removed) for r in lines.cleaned().collect()}
    assert clean[0][1] == 2 and "\n" not in clean[0][0] and clean[901] == (None, 0) and clean[902] == ("", 1) and clean[900] == (NOTE, 0)


def test_below_thresholds_and_empty(spark):
    blocks, manifest = _tables(spark, docs=16)
    assert repeated.RepeatedLines(blocks, manifest).found().count() == 0
    assert repeated.RepeatedLines(blocks.where("false"), manifest).found().count() == 0
    assert repeated.RepeatedLines(blocks, manifest.where("false")).found().count() == 0


def test_long_documents_are_split_over_shards(spark, monkeypatch):
    monkeypatch.setattr(repeated, "SEGMENT_PAGES", 2)
    monkeypatch.setattr(repeated, "CHUNK_LINES", 5)
    blocks, manifest = _tables(spark, pages=7)
    lines = repeated.RepeatedLines(blocks, manifest)
    assert {(r.n, r.of) for r in lines.lines().collect()} == {(6, 10)}


def test_clashing_columns_and_repeated_rows(spark):
    blocks, manifest = _tables(spark)
    extra = {n: repeated.F.lit("x") for n in ("source", "line", "line_ids", "long", "n", "sponsor", "nct_id")}
    twice = blocks.unionByName(blocks).withColumns(extra)
    lines = repeated.RepeatedLines(twice, manifest.withColumns({"doc_id": repeated.F.lit("y"), "source": repeated.F.lit(1)}))
    assert {tuple(r) for r in lines.found().collect()} == {(i, n) for i in range(12) for n in (2, 3)} | {(902, 1)}
    assert lines.cleaned().count() == 2 * blocks.count()


def _letters(n):
    return "".join("abcdefghijklmnopqrstuvwxyz"[int(c)] for c in str(n))


def _random_tables(spark, seed, docs=12, sources=2):
    """Documents of random runs of few lines, so that blocks of many lengths recur, spread over text blocks of one to three lines."""
    rng = np.random.default_rng(seed)
    blocks, texts, i = [], {}, 0
    notice = [f"This is line {_letters(k)} of a very long legal notice that many documents repeat word by word" for k in range(9)]
    for d in range(docs):
        lines = []
        for _ in range(6):
            a = int(rng.integers(0, 9))
            lines += notice[a : a + int(rng.integers(1, 10))] + [f"Only document {_letters(d)} says at its place {_letters(len(lines))} these words here"] * int(rng.integers(0, 2))
        texts[f"d{d}"] = lines
        at = page = 0
        while at < len(lines):
            n = int(rng.integers(1, 4))
            blocks.append((i, f"d{d}", page, 0, "paragraph", "\n".join(lines[at : at + n])))
            at, page, i = at + n, page + 1, i + 1
    manifest = [(f"d{d}", f"S{d % sources}") for d in range(docs)]
    return (spark.createDataFrame(blocks, "block_id long, doc_id string, page_num int, order_index int, block_type string, text string"),
            spark.createDataFrame(manifest, "nct_id string, sponsor string"), texts)


def test_blocks_of_any_length_equal_brute_force(spark):
    blocks, manifest, texts = _random_tables(spark, 3)
    share, least = 0.5, 3
    lines = repeated.RepeatedLines(blocks, manifest, documents=least, share=share)
    got = {}
    for r in lines.line_blocks().collect():
        got.setdefault(r.source, []).append((r.length, r.n))
    wanted = []
    for s in range(2):
        docs = [[repeated.line_ids(t)[1][0] for t in texts[f"d{d}"]] for d in range(12) if d % 2 == s]
        def often(run, docs=docs):
            return sum(any(tuple(x[i : i + len(run)]) == run for i in range(len(x))) for x in docs)
        found = set()
        for x in docs:
            longest = []
            for i in range(len(x)):
                n = 0
                while i + n < len(x) and often(tuple(x[i : i + n + 1])) >= max(least, share * len(docs)):
                    n += 1
                longest.append(n)
            found |= {tuple(x[i : i + n]) for i, n in enumerate(longest) if n and (i == 0 or longest[i - 1] <= n)}
        wanted.append(sorted((len(run), often(run)) for run in found))
    assert max(n for w in wanted for n, _ in w) > 4
    assert sorted(sorted(g) for g in got.values()) == sorted(wanted)
    whole = lines.cleaned().collect()
    kept = {line for r in whole for line in r.text.split("\n") if line}
    assert all(line.startswith("Only") or not line for line in kept)
    assert {(r.block_id, r.line_no) for r in lines.found().collect()} == {(b.block_id, n) for b in blocks.collect() for n, t in enumerate(b.text.split("\n"), 1) if t.startswith("This")}


def test_wide_joins_are_salted(spark, monkeypatch):
    from leafwork import session

    blocks, manifest = _tables(spark)
    whole = {tuple(r) for r in repeated.RepeatedLines(blocks, manifest).found().collect()}
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    assert {tuple(r) for r in repeated.RepeatedLines(blocks, manifest).found().collect()} == whole
