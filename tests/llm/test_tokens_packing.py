import base64

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafwork.llm import packing, tokens

BPE = tokens.Bpe(tokens.read_vocabulary())
BYTES = {rank: token for token, rank in BPE.ranks.items()}


def reference():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, tokens.read_vocabulary().splitlines())}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("reference", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_equals_reference_and_round_trips(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = BPE.encode([text])[0]
    assert ids == reference().encode_ordinary(text)
    assert b"".join(BYTES[i] for i in ids).decode() == text


def test_odd_texts():
    texts = ["", "<|endoftext|> hi", "a" * 5000, "漢字" * 900, " " * 3000 + "x", "\n\n \t x", "ab" * 511, "z" * 1023, "z" * 1024, "z" * 1025, "\x1c\x85\u2028 x"]
    encoder = reference()
    assert BPE.encode(texts) == [encoder.encode_ordinary(t) for t in texts]
    assert BPE.encode([None, ""]) == [[], []]


def test_matrix_equals_heap():
    rng = np.random.default_rng(5)
    words = [bytes(rng.choice(list(b"abcdeth in"), int(n)).tolist()) for n in rng.integers(1, 80, 200)]
    assert BPE.encode_words(words) == [BPE._heap(w) for w in words]


def test_ids_over_spark(spark):
    frame = spark.createDataFrame([(1, "hello world", 1), (2, None, 1), (3, "", 1), (1, "hello world", 1)], "doc_id long, text string, ids int")
    rows = sorted((r.doc_id, list(r.ids)) for r in tokens.token_ids(frame).collect())
    assert rows == [(1, BPE.encode(["hello world"])[0])] * 2 + [(2, []), (3, [])]
    assert tokens.token_ids(frame.where("false")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 64), max_size=200))
def test_pack_is_valid_and_tight(sizes):
    sizes = np.array(sizes, np.int64)
    container, window = packing.pack(sizes, 64)
    loads = np.bincount(container, weights=sizes) if len(sizes) else np.array([])
    assert (loads <= 64).all()
    least = -(-int(sizes.sum()) // 64)
    assert len(loads) <= max(1, int(np.ceil(11 / 9 * max(least, (sizes > 32).sum()) + 1)))
    assert len(sizes) == 0 or set(container) == set(range(container.max() + 1))
    assert all(len(set(container[window == w])) == 1 for w in set(window))
    for w in set(window):  # a window is no longer than the context of its longest item's tier
        own = sizes[window == w]
        assert own.sum() <= 64 >> packing.tier_of(np.array([own.max()]), 64)[0]


def test_tiers_matter():
    rng = np.random.default_rng(7)
    sizes = np.minimum(rng.lognormal(4.5, 1.2, 20_000), 2048).astype(np.int64)
    tiered, windows = packing.pack(sizes, 2048)
    flat, whole = packing.pack(sizes, 2048, tiers=1)
    assert (tiered != flat).mean() > 0.5 and len(set(windows)) > 2 * len(set(whole))
    loads = np.bincount(tiered, weights=sizes)
    assert 1 - sizes.sum() / (len(loads) * 2048) < 0.001
    # What is attended to is far less, as short items share short windows.
    spans = [np.bincount(w, weights=sizes) for w in (windows, whole)]
    assert (spans[0] ** 2).sum() < 0.6 * (spans[1] ** 2).sum()


def test_groups_are_balanced():
    loads = np.arange(64)
    groups = packing.balanced_groups(loads, np.zeros(64), 8)
    per = np.bincount(groups, weights=loads)
    assert np.bincount(groups).tolist() == [8] * 8 and per.max() - per.min() <= 8
    kinds = np.repeat([0, 1, 2], [16, 40, 8])
    mixed = packing.balanced_groups(loads, kinds, 8)
    assert all(np.bincount(mixed[kinds == k]).tolist() == [n] * 8 for k, n in ((0, 2), (1, 5), (2, 1)))


def test_pack_over_spark(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ITEMS", 7)
    data = [(i, n) for i, n in enumerate([10, 5, 0, 64, 65, 200, 1, 1, 30, 30, 34, 2, 60, None])]
    frame = spark.createDataFrame(data, "doc_id long, n_tokens int")
    rows = packing.pack_items(frame, 64).collect()
    assert {r.doc_id for r in rows} == set(range(14)) and sum(r["size"] for r in rows) == sum(n or 0 for _, n in data)
    fill = {}
    for r in rows:
        fill[r.container_id] = fill.get(r.container_id, 0) + r["size"]
    assert all(v <= 64 for v in fill.values()) and all(r.fill == fill[r.container_id] for r in rows)
    parts = sorted((r.part_no, r.start, r["size"]) for r in rows if r.doc_id == 5)
    assert parts == [(0, 0, 64), (1, 64, 64), (2, 128, 64), (3, 192, 8)]
    clash = frame.withColumns({n: packing.F.lit(1) for n in ("shard", "size", "start", "tier", "part_no")})
    assert packing.pack_items(clash, 64).count() == len(rows)
    assert packing.pack_items(frame.where("false"), 64).count() == 0
    assert packing.packing_report(packing.pack_items(frame, 64), 64).first().containers == len(fill)
    with pytest.raises(ValueError):
        packing.pack_items(frame, 0)
