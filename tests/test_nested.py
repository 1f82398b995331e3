import json

from leafwork.operators import nested


def block(i, **meta):
    return {"block_type": "paragraph", "text": f"t{i}", "order_index": i, "page_num": 1, "bbox": None, "metadata": meta or None}


def rows(payload):
    text = payload if isinstance(payload, str) or payload is None else json.dumps(payload)
    return [(r[2], r[5], r[7], r[8]) for r in nested.flatten_record(1, "d", text)]


def test_unreadable_payloads_give_nothing():
    for payload in (None, "", "null", "[]", '{"pages": {"1": [{"block', '{"pages": null}', "7", "[" * 100_000):
        assert rows(payload) == []


def test_pages_by_key_by_item_and_wrapped():
    by_key = {"pages": {"4": [block(0), block(1)]}}
    by_item = {"pages": [{"page_idx": 4, "blocks": [block(0), block(1)]}]}
    expected = [(4, "block", -1, 0), (4, "block", -1, 1)]
    assert rows(by_key) == rows(by_item) == rows({"status": "ok", "result": by_key}) == expected


def test_nesting_parents_and_entries():
    inner = block(3, blocks=[block(4)])
    cells = [{"row": 0, "col": 0, "text": "a", "blocks": [block(6)]}, {"row": 0, "col": 1, "text": "b"}]
    page = [
        block(2, blocks=[inner]),
        block(5, cells=cells, table_caption="one", table_footnote=["x", "y"]),
        block(7, parent_block_id=2),
        block(8, parent_block_id=8),
        block(9, parent_block_id=3),
        block(10, parent_block_id=99),
        {**block(11), "metadata": json.dumps({"blocks": [block(12)]})},
    ]
    assert sorted(rows({"pages": {"0": page}})) == sorted([
        (0, "block", -1, 2), (0, "block", 2, 3), (0, "block", 3, 4), (0, "block", -1, 5), (0, "cell", 5, 0), (0, "cell", 5, 1), (0, "block", 5, 6),
        (0, "caption", 5, 0), (0, "footnote", 5, 0), (0, "footnote", 5, 1), (0, "block", 2, 7), (0, "block", -1, 8), (0, "block", -1, 9),
        (0, "block", -1, 10), (0, "block", -1, 11), (0, "block", 11, 12),
    ])


def test_node_links_are_closed():
    got = nested.flatten_record(1, "d", json.dumps({"pages": {"0": [block(0, blocks=[block(1, image_caption=["c"])])]}}))
    ids = {r[3] for r in got}
    assert ids == set(range(len(got))) and all(r[4] == -1 or r[4] in ids for r in got)


def test_odd_values_do_not_crash():
    odd = {"pages": {"1": [block(0, cells=[None, "x", 3]), {"block_type": None, "order_index": 1}, {"order_index": "1", "block_type": "a"}, None, 5]}}
    assert (1, "cell", 0, 2) in rows(odd) and (1, "block", -1, 0) in rows(odd)
    assert rows({"pages": {"1": {"order_index": 2, "block_type": "a"}}}) == [(1, "block", -1, 2)]


def test_over_spark(spark):
    payload = json.dumps({"pages": {"0": [block(0, cells=[{"row": 1, "col": 2, "text": "a"}])]}})
    data = [(1, "d", payload, "clash"), (2, "d", payload, None), (3, None, None, None), (None, "d", payload, None)]
    frame = spark.createDataFrame(data, "response_id bigint, doc_id string, payload string, kind string")
    nodes = nested.flatten_payloads(frame)
    assert nested.found_nodes(nodes).count() == 4
    assert nested.subtype(nodes, "cell").select("row", "col", "text").distinct().collect() == [(1, 2, "a")]
    assert nested.block_table(nodes.limit(0)).count() == 0
    assert nested.flatten_payloads(frame.where("false")).count() == 0


def test_any_depth():
    for depth in (400, 5_000):
        payload = '{"block_type": "a", "order_index": 1, "blocks": [' * depth + "]}" * depth
        assert rows('{"pages": {"0": [' + payload + "]}}") == [(0, "block", -1, 1)] + [(0, "block", 1, 1)] * (depth - 1)
    wrapped = '{"result": ' * 2_000 + '{"pages": {"3": [{"block_type": "a", "order_index": 7}]}}' + "}" * 2_000
    assert rows(wrapped) == [(3, "block", -1, 7)]
    deep = {"block_type": "a", "order_index": 1}
    assert rows('{"pages": {"0": [{"block_type": "a", "order_index": 1, "text": ' + "[" * 3_000 + "]" * 3_000 + "}]}}") == [(0, "block", -1, 1)] and deep


def test_variants_are_routed_to_their_tables(spark):
    page = [
        block(0), block(1, cells=[{"row": 0, "col": 0, "text": "a"}, "b"], table_caption=["c", "d"], has_merges=True), block(2, html="<table>"), block(3, image_caption="f"),
        block(4, blocks=[block(5)]), {**block(6), "metadata": json.dumps({"html": "<i>"})}, block(7, table_footnote=["n"]),
    ]
    frame = spark.createDataFrame([(1, "d", json.dumps({"pages": {"0": page}}))], "response_id bigint, doc_id string, payload string")
    nodes = nested.flatten_payloads(frame).cache()
    got = {name: sorted(r.item_no for r in nested.subtype(nodes, name).collect()) for name in nested.SUBTYPES}
    assert got == {"plain_block": [0, 5], "table_block": [1, 2, 6, 7], "figure_block": [3], "container_block": [4], "cell": [0, 1], "caption": [0, 0, 1], "footnote": [0]}
    assert sum(map(len, got.values())) == nodes.count() and nested.block_table(nodes).count() == 8
    one = nested.subtype(nodes, "table_block").where("item_no = 1").first()
    assert (one.n_cells, one.n_captions, one.has_merges, one.html) == (2, 2, True, None)
    assert nested.subtype(nodes, "container_block").first().n_inside == 1
    nodes.unpersist()


def test_payloads_are_parsed_once_a_session(spark, tmp_path):
    from leafwork.plans.nested import registry

    def land(texts):
        data = [(i, "d", t, None) for i, t in enumerate(texts)]
        spark.createDataFrame(data, "response_id bigint, doc_id string, payload string, kind string").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "mineru_responses.parquet"))

    text = json.dumps({"pages": {"0": [block(0)]}})
    land([text])
    first = registry.queries["p5_blocks"](spark, str(tmp_path))
    assert first.count() == registry.queries["p5_found"](spark, str(tmp_path)).count() == 1
    land([text, text])
    assert registry.queries["p5_plain_blocks"](spark, str(tmp_path)).count() == 2
