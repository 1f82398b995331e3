"""Problem 1: oversized items cut into pieces at natural boundaries.

Balanced targets: the minimum number of pieces n follows from length, limit and overlap; n equal targets are laid over
the text, each is snapped to the strongest boundary near it, and n grows by one whenever a piece would break a limit.
Short items never leave the JVM; only oversized ones reach the Python splitter.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Boundary kinds from strong to weak; a boundary is the end of its match.
BOUNDARIES = (
    (5, regex.compile(r"\n[^\S\n]*\n\s*")),
    (4, regex.compile(r"\n")),
    (3, regex.compile(r"[.!?][\"'”’)\]]*\s+|[。！？][”’」』]*\s*")),
    (2, regex.compile(r"[;:,|]\s+|[；：，、]|[.;:,!?|](?=\S)")),
    (1, regex.compile(r"\s+")),
)
_BREAKERS = r"\s.;:,!?|。；：，！？、"
_UNBROKEN = regex.compile(rf"[^{_BREAKERS}]+")
_EDGE = regex.compile(rf"(?<=[{_BREAKERS}])|(?=[{_BREAKERS}])")

PIECE_SCHEMA = "piece_no int, n_pieces int, start_pos int, end_pos int, boundary int, piece string"


class _Edges:
    """The positions on either side of every blank and sign of a text, which serve where no boundary is in reach; they are
    looked for when first asked for."""

    def __init__(self, text: str) -> None:
        self.text, self.found = text, None

    def list(self) -> list[int]:
        if self.found is None:
            self.found = [m.start() for m in _EDGE.finditer(self.text) if 0 < m.start() < len(self.text)]
        return self.found


def boundaries(text: str) -> tuple[list[int], dict[int, int], _Edges]:
    """Positions at which the text may be cut, ascending, the strength of each, and the edges besides."""
    strength: dict[int, int] = {}
    for level, pattern in BOUNDARIES:
        for match in pattern.finditer(text):
            strength.setdefault(match.end(), level)
    strength.pop(0, None)
    strength.pop(len(text), None)
    return sorted(strength), strength, _Edges(text)


def cut_kind(text: str, spans: list[tuple[int, int, int]], limit: int) -> str:
    """'hard' if one of the cuts made falls inside a run longer than the limit without white space and clause
    punctuation, else 'soft'. As no piece exceeds the limit, every such run is cut somewhere inside."""
    ends = [b for _, b, _ in spans[:-1]]
    at = 0
    for run in _UNBROKEN.finditer(text):
        if run.end() - run.start() > limit:
            at = bisect_right(ends, run.start(), at)
            if at < len(ends) and ends[at] < run.end():
                return "hard"
    return "soft"


def _solid(text: str, at: int, low: int) -> int:
    """A hard cut never separates a base character from the combining marks after it, if the window allows."""
    while at > low + 1 and at < len(text) and regex.match(r"\p{M}|‍", text[at]):
        at -= 1
    return at


def _snap(marks: list[int], strength: dict[int, int], low: int, high: int, target: float) -> int | None:
    """The strongest boundary in (low, high], the one nearest to the target among equals."""
    window = marks[bisect_right(marks, low) : bisect_right(marks, high)]
    return max(window, key=lambda p: (strength[p], -abs(p - target)), default=None)


def _next_start(text: str, end: int, limit: int, overlap: int, start: int, marks: list[int], strength: dict[int, int], edges: _Edges) -> int:
    """Where the piece after one from `start` to `end` begins: about `overlap` before the end, at a boundary if one is
    near, and later where the next boundary could not be reached otherwise. Always after `start`, never after `end`."""
    if not overlap:
        return end
    back = _snap(marks, strength, max(start, end - overlap - overlap // 2), end - overlap // 2, end - overlap)
    begin = back if back is not None else _solid(text, end - overlap, start)
    for places in (lambda: marks, edges.list):
        found = places()
        k = bisect_right(found, end)
        reach = (found[k] if k < len(found) else len(text)) - limit
        if reach <= begin:
            break
    return reach if begin < reach <= end else max(begin, start + 1)


def _end(text: str, reach: int, high: int, target: float, marks: list[int], strength: dict[int, int], edges: _Edges) -> tuple[int, int]:
    """The cut in (reach, high] and its strength: the strongest boundary, else the last edge, else a hard cut at the target."""
    end = _snap(marks, strength, reach, high, target)
    if end is not None:
        return end, strength[end]
    found = edges.list()
    k = bisect_right(found, high) - 1
    if k >= 0 and found[k] > reach:
        return found[k], 1
    return _solid(text, max(reach + 1, min(int(target), high)), reach), 0


def _attempt(text: str, n: int, limit: int, overlap: int, marks: list[int], strength: dict[int, int], edges: _Edges) -> list[tuple[int, int, int]] | None:
    """The pieces for n balanced targets as (start, end, strength of the cut at the end), or None if a limit fails."""
    size = len(text)
    step = (size - overlap) / n
    slack = max(1.0, min(step, limit) / 4)
    pieces, start, reach = [], 0, 0
    for i in range(1, n):
        target = min(i * step + overlap, size)
        low, high = max(reach, int(target - slack)), min(start + limit, int(target + slack))
        end = _snap(marks, strength, low, high, target) if high > low else None
        end, cut = (end, strength[end]) if end is not None else _end(text, reach, start + limit, target, marks, strength, edges)
        if end <= reach or end >= size:
            return None
        pieces.append((start, end, cut))
        start, reach = _next_start(text, end, limit, overlap, start, marks, strength, edges), end
    return None if size - start > limit else [*pieces, (start, size, 0)]


def split_spans(text: str, limit: int, overlap: int = 0) -> list[tuple[int, int, int]]:
    """Spans (start, end, strength of the cut at the end; 0 for a hard cut and for the last piece) that cover the text.

    Every span has at most `limit` characters; consecutive spans share about `overlap` characters, fewer where the next
    natural boundary is out of reach otherwise, and each ends after the one before. An empty text or one within the
    limit is one span. The overlap is bounded by half the limit, so that pieces always make progress.
    """
    if limit < 1:
        raise ValueError("limit must be positive")
    size = len(text)
    if size <= limit:
        return [(0, size, 0)]
    overlap = max(0, min(overlap, (limit - 1) // 2))
    marks, strength, edges = boundaries(text)
    least = -(-(size - overlap) // (limit - overlap))
    n, tries = least, 0
    while n <= 2 * least + 4 and tries < 12:
        if pieces := _attempt(text, n, limit, overlap, marks, strength, edges):
            return pieces
        n, tries = n + 1 + n // 16, tries + 1
    pieces, start, reach = [], 0, 0
    while size - start > limit:
        end, cut = _end(text, max(reach, start + limit // 2), start + limit, start + limit, marks, strength, edges)
        if not cut:
            end, cut = _end(text, reach, start + limit, start + limit, marks, strength, edges)
        pieces.append((start, end, cut))
        start, reach = _next_start(text, end, limit, overlap, start, marks, strength, edges), end
    return [*pieces, (start, size, 0)]


def split_oversized(
    items: DataFrame, limits: DataFrame, key: str = "block_id", text: str = "text", scope: str = "block_type", keep: tuple[str, ...] = ("doc_id", "page_num")
) -> DataFrame:
    """The ordered pieces of every item whose text is longer than the limit of its scope.

    `limits` has one row per scope (scope, unit, max_size, overlap); only character limits are used, and it is a small
    dimension that Spark broadcasts by its size. Result: `key`, `scope`, the columns of `keep`, cut (`cut_kind` of the
    cuts made) and `PIECE_SCHEMA`. Null texts,
    texts within their limit and items whose scope has no limit give no rows; repeated items give their pieces each.
    """
    sizes = limits.where(F.col("unit") == "character").groupBy(F.col("scope").alias("__scope")).agg(F.min("max_size").alias("__limit"), F.max(F.coalesce("overlap", F.lit(0))).alias("__overlap"))
    kept = [c for c in dict.fromkeys((key, scope, *keep))]
    big = (
        items.select(*kept, F.col(text).alias("__text"))
        .join(sizes, F.col(scope) == F.col("__scope"))
        .where(F.length("__text") > F.col("__limit"))
        .drop("__scope")
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in big.select(*kept).schema) + ", cut string, " + PIECE_SCHEMA

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for values, body, limit, overlap in zip(batch[kept].itertuples(index=False, name=None), batch["__text"], batch["__limit"], batch["__overlap"]):
                spans = split_spans(body, int(limit), int(overlap))
                cut = cut_kind(body, spans, int(limit))
                rows += [(*values, cut, i, len(spans), a, b, level, body[a:b]) for i, (a, b, level) in enumerate(spans)]
            yield pd.DataFrame(rows, columns=[*kept, "cut", "piece_no", "n_pieces", "start_pos", "end_pos", "boundary", "piece"])

    return big.mapInPandas(run, schema)


def found_oversized(pieces: DataFrame, key: str = "block_id") -> DataFrame:
    """One row per oversized item, from its first piece."""
    return pieces.where(F.col("piece_no") == 0).select(key, "cut")
