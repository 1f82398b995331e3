"""JSON of any nesting depth: the parser and writer of the standard library, and stack machines where these give up."""

from __future__ import annotations

import json
import re
from typing import Any

_TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\],:])|("(?:[^"\\\x00-\x1f]|\\.)*")|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null|NaN|-?Infinity))')


def loads(text: str) -> Any:
    """The value of a JSON text; ValueError if it is none."""
    try:
        return json.loads(text)
    except RecursionError:
        return _machine(text)


def _machine(text: str) -> Any:
    at, stack = 0, []
    root: list[Any] = []
    keys: list[str | None] = []
    want = "value"

    def put(value: Any) -> None:
        if not stack:
            root.append(value)
        elif isinstance(stack[-1], list):
            stack[-1].append(value)
        else:
            stack[-1][keys[-1]] = value

    while at < len(text):
        m = _TOKEN.match(text, at)
        if m is None:
            if text[at:].strip(" \t\n\r"):
                raise ValueError(f"no JSON at {at}")
            break
        at = m.end()
        sign = m[1]
        if want in ("value", "first value") and (m[2] is not None or m[3] is not None):
            put(json.loads(m[2] if m[2] is not None else m[3]))
            want = "next"
        elif want in ("value", "first value") and sign in ("{", "["):
            fresh: Any = {} if sign == "{" else []
            put(fresh)
            stack.append(fresh)
            keys.append(None)
            want = "first key" if sign == "{" else "first value"
        elif want in ("key", "first key") and m[2] is not None:
            keys[-1], want = json.loads(m[2]), "colon"
        elif want == "colon" and sign == ":":
            want = "value"
        elif want == "next" and sign == "," and stack:
            want = "key" if isinstance(stack[-1], dict) else "value"
        elif stack and sign == ("}" if isinstance(stack[-1], dict) else "]") and want in ("next", "first key", "first value"):
            stack.pop()
            keys.pop()
            want = "next"
        else:
            raise ValueError(f"no JSON at {at}")
        if not stack and want == "next":
            want = "end"
    if want != "end":
        raise ValueError("JSON ends early")
    return root[0]


def dumps(value: Any) -> str:
    """JSON text of a value, letters as they are."""
    try:
        return json.dumps(value, ensure_ascii=False)
    except RecursionError:
        out: list[str] = []
        todo: list[tuple[bool, Any]] = [(False, value)]
        while todo:
            done, item = todo.pop()
            if done:
                out.append(item)
            elif isinstance(item, dict):
                parts = [(True, "}")]
                for i, (k, v) in enumerate(reversed(item.items())):
                    parts += [(False, v), (True, ("" if i == len(item) - 1 else ", ") + json.dumps(k, ensure_ascii=False) + ": ")]
                todo += [*parts, (True, "{")]
            elif isinstance(item, list):
                parts = [(True, "]")]
                for i, v in enumerate(reversed(item)):
                    parts += [(False, v)] if i == len(item) - 1 else [(False, v), (True, ", ")]
                todo += [*parts, (True, "[")]
            else:
                out.append(json.dumps(item, ensure_ascii=False))
        return "".join(out)
