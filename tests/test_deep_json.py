import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafwork.functions import deep_json

VALUES = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False) | st.text(), lambda v: st.lists(v) | st.dictionaries(st.text(), v), max_leaves=30)


@settings(max_examples=300, deadline=None)
@given(VALUES, st.sampled_from([None, 1]))
def test_equals_the_standard_parser(value, indent):
    text = json.dumps(value, indent=indent)
    assert deep_json._machine(text) == deep_json.loads(text) == value


@pytest.mark.parametrize("text", ["", " ", "{", "[1,", "[1,]", "{\"a\"}", "{\"a\":}", "{,}", "[1 2]", "]", "1 2", "{\"a\":1]", "tru", "\"a", "[" * 100_000, "{\"a\":" * 5_000])
def test_what_is_no_json_is_refused(text):
    with pytest.raises(ValueError):
        deep_json._machine(text)
    with pytest.raises(ValueError):
        deep_json.loads(text)


def test_any_depth():
    value, depth = deep_json.loads("[" * 50_000 + "]" * 50_000), 1
    while value:
        value, depth = value[0], depth + 1
    assert depth == 50_000


def test_writes_any_depth():
    deep = "[" * 30_000 + '{"a": [1, "é", null], "b": {}}' + "]" * 30_000
    assert deep_json.dumps(deep_json.loads(deep)) == deep
    assert deep_json.dumps({"a": [1, 2, {"b": []}], "c": "x"}) == json.dumps({"a": [1, 2, {"b": []}], "c": "x"})
