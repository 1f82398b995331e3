"""Deeply nested JSON records to related flat tables that keep parent-child links.

Every JSON value is classified bottom-up by a deterministic tree automaton (`classify`): the state of a node depends
only on its kind and on the states of its children, so records whose fields are missing, null, wrapped once more or
given as embedded JSON text still reach the state of their shape. Blocks end in one of four states, by what they and their
metadata hold: table, figure, container (of other blocks) or plain. A top-down walk emits one row per block, cell, caption
and footnote; the state routes each to its typed subtype table (`SUBTYPES`). All rows share the supertype columns
(response_id, page_num, node_id, parent_node, kind, variant, parent_index, item_no); the columns of a subtype are null
elsewhere, so that all tables are projections of one relation. Neither pass recurses: payloads may have any depth.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.functions.deep_json import dumps, loads

NODE_SCHEMA = (
    "response_id bigint, doc_id string, page_num int, node_id int, parent_node int, kind string, variant string, "
    "parent_index int, item_no int, block_type string, text string, row int, col int, row_span int, col_span int, "
    "is_header boolean, x0 double, y0 double, x1 double, y1 double, extra string, html string, has_merges boolean, "
    "n_cells int, n_captions int, n_inside int, shape string"
)
_NAMES = [n.split()[0] for n in NODE_SCHEMA.split(", ")]

# The field names of the landed records.
CHILD_TEXTS = {"table_caption": "caption", "image_caption": "caption", "table_footnote": "footnote"}
WRAPPERS = ("result", "response", "data", "payload")
BLOCK_KEYS = ("order_index", "block_type")
TABLE_KEYS = ("cells", "html", "table_caption", "table_footnote")
FIGURE_KEYS = ("image_caption",)

COMMON = ("response_id", "doc_id", "page_num", "node_id", "parent_node", "parent_index", "item_no", "variant")
_BLOCK = ("block_type", "text", "x0", "y0", "x1", "y1", "extra")
#: The subtype tables: the automaton states routed to each, and its own columns beside the common ones.
SUBTYPES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "plain_block": (("block.plain",), _BLOCK),
    "table_block": (("block.table",), (*_BLOCK, "html", "has_merges", "n_cells", "n_captions")),
    "figure_block": (("block.figure",), (*_BLOCK, "n_captions")),
    "container_block": (("block.container",), (*_BLOCK, "n_inside")),
    "cell": (("cell", "cell.value"), ("row", "col", "row_span", "col_span", "is_header", "text")),
    "caption": (("caption.table", "caption.image"), ("text",)),
    "footnote": (("footnote.table",), ("text",)),
}


class Node:
    """A JSON value with its automaton state; `value` has embedded JSON texts already opened."""

    __slots__ = ("state", "value", "children")

    def __init__(self, state: str, value: Any, children: Any = None) -> None:
        self.state, self.value, self.children = state, value, children


def _leaf_state(value: Any) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    return "text" if isinstance(value, str) else "number"


def _is_page_key(key: str) -> bool:
    return key.lstrip("-").isdigit() and key.isascii()


def _content(states: dict[str, str]) -> str:
    """What an object holds, from the labels and states of its fields: table, figure, container or plain."""
    for found, keys in (("table", TABLE_KEYS), ("figure", FIGURE_KEYS)):
        if any(states.get(k) not in (None, "null") for k in keys) or f"object.{found}" in states.values():
            return found
    inside = any(s.partition(".")[0] in ("block", "blocks") or s == "object.container" for s in states.values())
    return "container" if inside else "plain"


def _object_state(children: dict[str, Node]) -> str:
    """Transition for objects, from the labels and states of the children."""
    states = {k: c.state for k, c in children.items()}
    if all(states.get(k) not in (None, "null") for k in BLOCK_KEYS) and states["order_index"] == "number":
        return f"block.{_content(states)}"
    if states.get("row") == "number" or states.get("col") == "number":
        return "cell"
    if "page_idx" in states and states["page_idx"] == "number":
        return "page"
    if states and all(_is_page_key(k) and s.partition(".")[0] in ("blocks", "block", "empty", "null") for k, s in states.items()):
        return "pages_by_key"
    if "pages" in states or any(states.get(k) == "document" for k in WRAPPERS):
        return "document"
    return f"object.{_content(states)}"


def _array_state(items: list[Node]) -> str:
    """Transition for arrays, from the set of the items' states (nulls do not decide)."""
    states = {i.state.partition(".")[0] for i in items} - {"null"}
    if not states:
        return "empty"
    for one, many in (("block", "blocks"), ("cell", "cells"), ("page", "pages_by_item"), ("text", "texts")):
        if states == {one}:
            return many
    return "blocks" if "block" in states else "array"


def _opened(value: Any) -> Any:
    """An embedded JSON text as its object or array; any other value as it is."""
    if isinstance(value, str) and value[:1] in ("{", "["):
        try:
            inner = loads(value)
        except ValueError:
            return value
        return _opened(inner) if isinstance(inner, (dict, list)) else value
    return value


def classify(value: Any) -> Node:
    """The automaton run over one parsed value, children before parents."""
    root = Node("", _opened(value))
    todo = [root]
    order = []
    while todo:
        node = todo.pop()
        order.append(node)
        if isinstance(node.value, dict):
            node.children = {str(k): Node("", _opened(v)) for k, v in node.value.items()}
            todo += node.children.values()
        elif isinstance(node.value, list):
            node.children = [Node("", _opened(v)) for v in node.value]
            todo += node.children
    for node in reversed(order):
        if isinstance(node.children, dict):
            node.state = _object_state(node.children)
        else:
            node.state = _leaf_state(node.value) if node.children is None else _array_state(node.children)
    return root


def _int(value: Any) -> int | None:
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return None
    try:
        number = int(value)
    except (ValueError, OverflowError):
        return None
    return number if -(2**31) <= number < 2**31 else None


def _text(node: Node | None) -> str | None:
    if node is None or node.state == "null":
        return None
    return node.value if isinstance(node.value, str) else dumps(node.value)


def _bbox(node: Node | None) -> list[float | None]:
    if node is None:
        return [None] * 4
    if isinstance(node.children, list):
        found = [c.value if c.state == "number" else None for c in node.children]
    elif isinstance(node.children, dict):
        found = [node.children[k].value if k in node.children and node.children[k].state == "number" else None for k in ("x0", "y0", "x1", "y1")]
    else:
        found = []
    return [None if v is None else float(v) for v in (found + [None] * 4)[:4]]


def _is_block(node: Node) -> bool:
    return node.state.startswith("block.")


def _outermost(node: Node) -> list[Node]:
    """The blocks in a value that lie in no other block of it, in order."""
    found, todo = [], [node]
    while todo:
        here = todo.pop()
        if _is_block(here):
            found.append(here)
        elif here.children:
            todo += reversed([*here.children.values()] if isinstance(here.children, dict) else here.children)
    return found


class _Walk:
    """The top-down pass over one record's classified tree. What is still to be emitted lies on a stack, so rows come in
    document order, each after the row it lies in."""

    def __init__(self, response_id: int, doc_id: str | None) -> None:
        self.key = (response_id, doc_id)
        self.rows: list[tuple] = []

    def emit(self, page: int, parent_node: int, kind: str, variant: str, parent_index: int, item_no: int, **own: Any) -> int:
        node_id = len(self.rows)
        own |= dict(zip(("x0", "y0", "x1", "y1"), own.pop("bbox", ())))
        self.rows.append((*self.key, page, node_id, parent_node, kind, variant, parent_index, item_no, *(own.get(n) for n in _NAMES[9:])))
        return node_id

    def document(self, root: Node) -> None:
        while root.state == "document" and "pages" not in root.children:
            root = next(root.children[k] for k in WRAPPERS if k in root.children and root.children[k].state == "document")
        pages = root.children.get("pages") if root.state == "document" else root
        if pages is None:
            return
        if isinstance(pages.children, dict) and pages.state != "page":
            for key, blocks in pages.children.items():
                if _is_page_key(key):
                    self.page(int(key), blocks)
        else:
            for page in [pages] if pages.state == "page" else pages.children or []:
                if page.state == "page":
                    number = _int(page.children["page_idx"].value)
                    rest = [c for k, c in page.children.items() if k != "page_idx"]
                    if number is not None:
                        self.page(number, *rest)

    def page(self, number: int, *roots: Node) -> None:
        outer = [b for root in roots for b in _outermost(root)]
        named = {_int(b.children["order_index"].value) for b in outer}
        todo = [(self.block, (b, -1, None)) for b in reversed(outer)]
        while todo:
            step, rest = todo.pop()
            todo += reversed(step(number, named, *rest))

    def block(self, page: int, outer: set[int | None], node: Node, parent_node: int, inside: int | None) -> list[tuple]:
        fields = node.children
        index = _int(fields["order_index"].value)
        if index is None:
            return []
        meta = fields.get("metadata")
        more = meta.children if meta is not None and isinstance(meta.children, dict) else {}
        parent = inside
        if parent is None:
            named = _int(more["parent_block_id"].value) if "parent_block_id" in more else _int(fields["parent_block_id"].value) if "parent_block_id" in fields else None
            parent = named if named is not None and named != index and named in outer else -1
        plain = {k: c.value for k, c in more.items() if c.state in ("text", "number", "bool") and k not in CHILD_TEXTS}
        both = {**fields, **more}
        html, merges = both.get("html"), both.get("has_merges")
        parts = [(name, child) for scope in (fields, more) for name, child in scope.items() if not (name == "metadata" and scope is fields and isinstance(child.children, dict))]
        size = lambda test: sum(len(c.children) if isinstance(c.children, list) else c.state != "null" for n, c in parts if test(n))
        inner = {k: _outermost(c) for k, (n, c) in enumerate(parts) if n not in CHILD_TEXTS and not (n == "cells" and isinstance(c.children, list))}
        me = self.emit(
            page, parent_node, "block", node.state, parent, index, block_type=_text(fields.get("block_type")), text=_text(fields.get("text")), bbox=_bbox(fields.get("bbox")),
            extra=dumps(dict(sorted(plain.items()))) if plain else None, html=_text(html), has_merges=merges.value if merges is not None and merges.state == "bool" else None,
            n_cells=sum(len(c.children) for n, c in parts if n == "cells" and isinstance(c.children, list)), n_captions=size(lambda n: CHILD_TEXTS.get(n) == "caption"),
            n_inside=sum(map(len, inner.values())), shape="+".join(sorted({k for k, c in both.items() if c.state != "null"} - {"metadata"})),
        )
        found: list[tuple] = []
        for k, (name, child) in enumerate(parts):
            if name in CHILD_TEXTS:
                entries = child.children if isinstance(child.children, list) else [] if child.state == "null" else [child]
                found += [(self.entry, (name, entry, me, index, i)) for i, entry in enumerate(entries)]
            elif name == "cells" and isinstance(child.children, list):
                found += [(self.cell, (cell, me, index, i)) for i, cell in enumerate(child.children)]
            else:
                found += [(self.block, (b, me, index)) for b in inner[k]]
        return found

    def entry(self, page: int, outer: set[int | None], name: str, entry: Node, owner: int, index: int, position: int) -> list[tuple]:
        kind = CHILD_TEXTS[name]
        self.emit(page, owner, kind, f"{kind}.{name.partition('_')[0]}", index, position, text=_text(entry))
        return []

    def cell(self, page: int, outer: set[int | None], cell: Node, owner: int, index: int, position: int) -> list[tuple]:
        fields = cell.children if isinstance(cell.children, dict) else {}
        value = lambda k: fields[k].value if k in fields else None
        header = value("is_header")
        me = self.emit(
            page, owner, "cell", "cell" if fields else "cell.value", index, position, text=_text(fields.get("text")) if fields else _text(cell), row=_int(value("row")), col=_int(value("col")),
            row_span=_int(value("row_span")), col_span=_int(value("col_span")), is_header=header if isinstance(header, bool) else None,
            shape="+".join(sorted(k for k, c in fields.items() if c.state != "null")) or cell.state,
        )
        return [(self.block, (b, me, index)) for child in (fields.values() if fields else [cell]) for b in _outermost(child)]


def flatten_record(response_id: int, doc_id: str | None, payload: str | None) -> list[tuple]:
    """All rows of one payload in pre-order; a null, empty or cut-off payload gives none."""
    if not payload:
        return []
    walk = _Walk(response_id, doc_id)
    try:
        root = classify(loads(payload))
    except ValueError:
        return []
    if root.children:
        walk.document(root)
    return walk.rows


def flatten_payloads(records: DataFrame, key: str = "response_id", payload: str = "payload", doc: str = "doc_id") -> DataFrame:
    """One row for each block, cell, caption and footnote at any depth of `payload` (schema `NODE_SCHEMA`).

    parent_index is the order_index of the enclosing block, or else of the outermost block that parent_block_id names,
    -1 if there is none; parent_node links to the node_id of the row it lies in (-1 at the top). Null, empty and
    unreadable payloads give no rows; repeated records give their rows under each key; other columns of `records` are
    neither read nor carried, so their names cannot clash.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            for response_id, doc_id, text in zip(batch["k"], batch["d"], batch["p"]):
                rows += flatten_record(response_id, doc_id, text)
                if len(rows) > 20_000:
                    yield _frame(rows)
                    rows = []
            yield _frame(rows)

    slim = records.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("k"), F.col(doc).alias("d"), F.col(payload).alias("p"))
    return slim.mapInPandas(run, NODE_SCHEMA)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=_NAMES, dtype=object)
    for name, kind in (n.split() for n in NODE_SCHEMA.split(", ")):
        if kind == "int":
            frame[name] = frame[name].astype("Int32")
    return frame


def subtype(nodes: DataFrame, name: str) -> DataFrame:
    """One of the `SUBTYPES`: the rows whose state is routed there, with the common columns and its own."""
    states, own = SUBTYPES[name]
    return nodes.where(F.col("variant").isin(*states)).select(*COMMON, *own)


def block_table(nodes: DataFrame) -> DataFrame:
    """The supertype of all blocks."""
    return nodes.where(F.col("kind") == "block").select(*COMMON, *_BLOCK, "shape")


def found_nodes(nodes: DataFrame) -> DataFrame:
    """The links alone, one row per case."""
    return nodes.select("response_id", "page_num", "kind", "parent_index", "item_no").distinct()
