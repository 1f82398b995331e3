"""Problem 7: lines repeated across the documents of one source.

Each document is the sequence of its line identifiers in reading order, over all its text blocks. Documents are salted
over shards within their source, and every shard builds the suffix array of its concatenated sequences with the lengths
of the common prefixes of neighbours in it. Suffixes with a common prefix of one line or more are a block; a shard counts
for each block the documents it holds whole, so that the sums over the shards are exact and no source or line is gathered
in one task. Blocks of one line come first; the blocks that begin at each place are then lengthened as far as they span
enough documents, by doubling and halving steps, so that any length is found in a number of rounds that grows with its
logarithm. Blocks that lie in no longer one are deleted whole; single lines are blocks of length one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.session import bounded, cut, shuffle_partitions

_LEVELLED = re.compile(r"[\s\d​-‍⁠﻿]+")
_NO_LETTER = re.compile(r"[\W\d_]+")
#: Pages of a document that stay together in a shard.
SEGMENT_PAGES = 256
#: Lines after which a shard's suffix array is closed; only the memory of a task depends on it.
CHUNK_LINES = 1_000_000


def line_ids(text: str, letters: int = 40) -> tuple[list[int], list[int]]:
    """Numbers (from 1) and 64-bit ids of the lines with at least `letters` letters; case, blanks and digits are levelled."""
    numbers, ids = [], []
    for number, line in enumerate(text.split("\n"), 1):
        if len(line) >= letters and len(_NO_LETTER.sub("", line)) >= letters:
            numbers.append(number)
            ids.append(xxhash.xxh3_64_intdigest(_LEVELLED.sub("", line.casefold())) - (1 << 63))
    return numbers, ids


def line_sequences(blocks: DataFrame, letters: int = 40, skipped: tuple[str, ...] = ("heading", "table")) -> DataFrame:
    """block_id, doc_id, page_num, order_index, line_nos, line_ids: one row per block that has a line long enough."""
    keys = ["block_id", "doc_id", "page_num", "order_index"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_ids(t, letters) for t in batch.column(len(keys)).to_pylist()]
            kept = pa.array([bool(n) for n, _ in found])
            numbers, ids = pa.array([n for n, _ in found], pa.list_(pa.int32())), pa.array([i for _, i in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], numbers, ids], [*keys, "line_nos", "line_ids"]).filter(kept)

    wanted = (F.length("text") >= letters) & ~F.coalesce(F.col("block_type").isin(*skipped), F.lit(False)) & F.col("doc_id").isNotNull()
    slim = blocks.where(wanted).select(F.col("block_id").cast("bigint"), "doc_id", F.col("page_num").cast("int"), F.col("order_index").cast("int"), "text")
    return slim.mapInArrow(run, "block_id bigint, doc_id string, page_num int, order_index int, line_nos array<int>, line_ids array<bigint>")


def document_sources(blocks: DataFrame, manifest: DataFrame) -> DataFrame:
    """doc_id, source (hash of the sponsor as written), long (too many pages for one shard); null sponsors are left out."""
    sources = manifest.where(F.col("sponsor").isNotNull()).select(F.col("nct_id").alias("doc_id"), F.xxhash64("sponsor").alias("source")).distinct()
    pages = blocks.groupBy("doc_id").agg(F.max("page_num").alias("last_page"))
    return pages.join(sources, "doc_id").select("doc_id", "source", (F.coalesce("last_page", F.lit(0)) >= SEGMENT_PAGES).alias("long"))


SHARD_SCHEMA = "source bigint, doc_id string, long boolean, segment int, block_id bigint, start int, line_nos array<int>, line_ids array<bigint>"


def shards(sequences: DataFrame) -> DataFrame:
    """SHARD_SCHEMA: the sequences in reading order, each document (or segment of a long one) whole in one partition.

    `start` is the place of the row's first line in its document's sequence. A block delivered again with the same lines
    at the same place has the place of the first delivery.
    """
    names = [n.split()[0] for n in SHARD_SCHEMA.split(", ")]
    segment = F.when(F.col("long"), F.floor(F.coalesce("page_num", F.lit(0)) / SEGMENT_PAGES)).otherwise(F.lit(0)).cast("int")
    order = ["source", "doc_id", "segment", "page_num", "order_index", "block_id"]
    spread = sequences.withColumn("segment", segment).repartition(shuffle_partitions(sequences.sparkSession), "source", "doc_id", "segment").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        document, place, seen, at = None, None, [], 0
        for batch in batches:
            column = {n: batch.column(n).to_pylist() for n in ("source", "doc_id", "segment", "page_num", "order_index", "line_ids")}
            starts = []
            for source, doc, part, page, order, ids in zip(*column.values()):
                if (source, doc, part) != document:
                    document, place, at = (source, doc, part), None, 0
                if (page, order) != place:
                    place, seen = (page, order), []
                again = next((start for known, start in seen if known == ids), None)
                starts.append(at if again is None else again)
                if again is None:
                    seen.append((ids, at))
                    at += len(ids)
            columns = [pa.array(starts, pa.int32()) if n == "start" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return spread.select("source", "doc_id", "long", "segment", "block_id", "page_num", "order_index", "line_nos", "line_ids").mapInArrow(run, SHARD_SCHEMA)


def remaining(rows: np.ndarray) -> np.ndarray:
    """Elements from each place to the end of its row; equal neighbours in `rows` are one row."""
    n = len(rows)
    ends = np.flatnonzero(np.r_[rows[1:] != rows[:-1], True]) if n else np.zeros(0, np.int64)
    return np.repeat(ends, np.diff(np.r_[-1, ends])) - np.arange(n) + 1


def suffix_array(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the suffixes of all rows in order, and the elements each shares with the one before it.

    A suffix ends with its row. Ranks by the first 1, 2, 4 ... elements are doubled until no two suffixes tie or no row is
    longer; the common prefixes follow from the ranks, from the longest down.
    """
    n = len(ids)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left = remaining(rows)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    levels, length = [rank], 1
    while length < left.max() and rank.max() + 1 < n:
        follow = np.zeros(n, np.int64)
        inside = np.flatnonzero(left > length)
        follow[inside] = rank[inside + length] + 1
        rank = np.unique(rank * (n + 2) + follow, return_inverse=True)[1].astype(np.int64)
        levels.append(rank)
        length *= 2
    order = np.argsort(rank, kind="stable")
    one, two, common = order[:-1], order[1:], np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        open_ = np.flatnonzero((common < left[one]) & (common < left[two]))
        a, b = one[open_] + common[open_], two[open_] + common[open_]
        same = levels[k][a] == levels[k][b]
        common[open_[same]] += np.minimum(1 << k, left[a[same]])
    return order, np.r_[0, common]


def prefix_classes(order: np.ndarray, common: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """For each suffix the class of its first `length` elements (runs of common prefixes in the array), -1 if it is shorter."""
    out = np.full(len(order), -1, np.int64)
    number = np.cumsum(common < length)
    long_enough = left[order] >= length
    out[order[long_enough]] = number[long_enough]
    return out


def block_hashes(ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` elements from each place; that of one element is the element."""
    if length == 1 or not len(at):
        return ids[at]
    total = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(length):
            total = (total ^ ids[at + i].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
    return total.view(np.int64)


COUNT_SCHEMA = "source bigint, line bigint, length int, n bigint, doc_id string"


def _counted(sources: list[int], names: list[str], longs: list[bool], sequences: list[list[int]], starts: list[list[int]], spans: list[list[int]] | None, lengths: list[int], step: int) -> pa.RecordBatch:
    """Documents per block of each of `lengths`: whole ones as sums, long ones by name.

    `starts` are the places of the elements; a gap between two ends a row. With `spans` (the elements already known to
    make a block from each place) only blocks count that are known or asked for with this step.
    """
    sizes = np.array([len(s) for s in sequences])
    total = int(sizes.sum())
    ids = np.fromiter((i for s in sequences for i in s), np.int64, total)
    place = np.fromiter((i for s in starts for i in s), np.int64, total)
    code: dict[tuple[int, str], int] = {}
    per_row = np.array([code.setdefault(k, len(code)) for k in zip(sources, names)], np.int64)
    docs, source = np.repeat(per_row, sizes), np.repeat(np.array(sources, np.int64), sizes)
    with np.errstate(over="ignore"):
        keyed = ids ^ (source * np.int64(0x5851F42D4C957F2D))
    rows = _rows(np.repeat(np.arange(len(sizes)), sizes), place)
    left = remaining(rows)
    order, common = suffix_array(keyed, rows)
    long_doc, name = np.zeros(len(code), bool), np.empty(len(code), object)
    long_doc[per_row], name[per_row] = longs, names
    known = None if spans is None else np.fromiter((i for s in spans for i in s), np.int64, total)
    parts = []
    for length in lengths:
        classes = prefix_classes(order, common, left, length)
        if known is not None:
            classes[(known < length) & (_asked(known, left, step) != length)] = -1
        at = np.flatnonzero(classes >= 0)
        if not len(at):
            continue
        at = at[np.lexsort((docs[at], classes[at]))]
        c, d = classes[at], docs[at]
        first = np.r_[True, (c[1:] != c[:-1]) | (d[1:] != d[:-1])]
        at, c, d = at[first], c[first], d[first]
        line, big = block_hashes(ids, at, length), long_doc[d]
        begin = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        whole = np.add.reduceat((~big).astype(np.int64), begin)
        some = whole > 0
        parts.append((source[at[begin]][some], line[begin][some], np.full(some.sum(), length), whole[some], np.full(some.sum(), None, object)))
        parts.append((source[at[big]], line[big], np.full(big.sum(), length), np.ones(big.sum(), np.int64), name[d[big]]))
    columns = [np.concatenate(p) for p in zip(*parts)] or [[]] * 5
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [n.split()[0] for n in COUNT_SCHEMA.split(", ")])


def _rows(document: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Row number of each element: a new row with every document part and after every gap in its places."""
    new = np.r_[True, (document[1:] != document[:-1]) | (place[1:] != place[:-1] + 1)] if len(place) else np.zeros(0, bool)
    return np.cumsum(new)


def _asked(known: np.ndarray, left: np.ndarray, step: int) -> np.ndarray:
    """The length to try from each place with this step, 0 for none: twice the known length while doubling (known equals
    the step), then the known length and the step, if the step is below its greatest power of two."""
    top = 1 << np.frexp(known.astype(np.float64))[1].astype(np.int64) - 1
    wanted = np.where((known == step) | (step < top), known + step, 0)
    return np.where(wanted <= left, wanted, 0)


def _shard_counts(lengths: list[int], step: int = 0):
    """Arrow function over (source, doc_id, long, ids, places[, known]) that counts documents per block, chunk by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(6)]
        lines = 0

        def close() -> pa.RecordBatch:
            return _counted(*held[:5], held[5] if step else None, lengths, step)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if lines >= CHUNK_LINES and (row[0], row[1]) != (held[0][-1], held[1][-1]):
                    yield close()
                    held, lines = [[] for _ in range(6)], 0
                for column, value in zip(held, row):
                    column.append(value)
                lines += len(row[3])
        if held[0]:
            yield close()

    return run


def _summed(partial: DataFrame) -> DataFrame:
    """source, line, length, n: the documents of each block, over all shards."""
    whole = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0))
    return partial.groupBy("source", "line", "length").agg((whole + F.count_distinct("doc_id")).alias("n"))


def _per_run(work, schema: str):
    """Arrow function that calls work(row, ids, places, known) for each row of runs; its tuples follow the schema."""
    names = [n.split()[0] for n in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                out += work(row, *(np.array(row[c], np.int64) for c in ("ids", "places", "known")))
            parts = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(p, kinds[n.split()[1]]) for p, n in zip(parts, schema.split(", "))], names)

    return run
_ASKED = "source bigint, doc_id string, segment int, i int, length int, line bigint"
_RUN = ["source", "doc_id", "segment", "ids", "places", "known"]


def _widest(place: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Where the blocks begin that lie in no longer one."""
    return np.flatnonzero(~np.r_[False, (place[1:] == place[:-1] + 1) & (known[:-1] > known[1:])])


def _hashed(row: dict, ids: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> list[tuple]:
    """Rows of _ASKED for the blocks of these lengths from these places."""
    hashes = [int(block_hashes(ids, np.array([i]), n)[0]) for i, n in zip(at, lengths.tolist())]
    return [(row["source"], row["doc_id"], row["segment"], int(i), n, h) for i, n, h in zip(at, lengths.tolist(), hashes)]


class RepeatedLines:
    """Lines and blocks of lines of `blocks` repeated within the documents of one source.

    A block counts when it occurs in at least `documents` and at least `share` of its source's documents. The documents of
    a source are the doc_ids with blocks whose manifest row names it; a document under two sources counts in both. Lines
    follow each other in a block when no other line with `letters` letters stands between them in the document. Documents
    of more than SEGMENT_PAGES pages are read in segments of so many pages: a block across such a border counts as two,
    its lines are found all the same. Null or empty texts have no lines; repeated blocks do not raise a count, as
    documents are counted. The shards, the frequent lines and their places are written to the checkpoint folder.
    """

    def __init__(self, blocks: DataFrame, manifest: DataFrame, letters: int = 40, documents: int = 5, share: float = 0.4) -> None:
        self.blocks, self.documents, self.share = blocks, documents, share
        sources = cut(document_sources(blocks, manifest))
        self.sizes = sources.groupBy("source").agg(F.count("*").alias("of"))
        self.shards = cut(shards(line_sequences(blocks, letters).join(sources, "doc_id")))
        ids = F.transform("line_ids", lambda _, i: F.col("start") + i)
        counts = _summed(self.shards.select("source", "doc_id", "long", "line_ids", ids.alias("places")).mapInArrow(_shard_counts([1]), COUNT_SCHEMA))
        self.counts = cut(self._often(counts))
        self.runs = cut(self._lengthened(self._places()))

    def _often(self, counts: DataFrame) -> DataFrame:
        enough = counts.where(F.col("n") >= self.documents).join(self.sizes, "source")
        return enough.where(F.col("n") >= F.col("of") * self.share).select("source", "line", "length", "n", "of")

    def lines(self) -> DataFrame:
        """source, line, n, of: the repeated lines."""
        return self.counts.where("length = 1").select("source", "line", "n", "of")

    def _places(self) -> DataFrame:
        """source, doc_id, long, segment, ids, places (distinct, ascending), known (1 for each), at: the repeated lines of
        each document part. They are few, as each is in many documents; a part has at most SEGMENT_PAGES pages."""
        at = F.explode(F.arrays_zip("line_nos", "line_ids", F.transform("line_ids", lambda _, i: F.col("start") + i).alias("place"))).alias("a")
        flat = self.shards.select("source", "doc_id", "long", "segment", "block_id", at).select(
            "source", "doc_id", "long", "segment", "block_id", F.col("a.line_nos").alias("line_no"), F.col("a.line_ids").alias("line"), F.col("a.place").alias("place")
        )
        kept = bounded(self.lines().select("source", "line"), flat, ["source", "line"], "doc_id")
        grouped = kept.groupBy("source", "doc_id", "segment").agg(F.first("long").alias("long"), F.array_sort(F.collect_list(F.struct("place", "line", "block_id", "line_no"))).alias("at"))
        one = F.array_distinct(F.transform("at", lambda a: F.struct(a["place"].alias("place"), a["line"].alias("line"))))
        spread = grouped.withColumn("one", one)
        return spread.select("source", "doc_id", "long", "segment", F.col("one.line").alias("ids"), F.col("one.place").alias("places"), F.transform("one", lambda _: F.lit(1)).alias("known"), "at")

    def _lengthened(self, runs: DataFrame) -> DataFrame:
        """`runs` with known: from each place the length of the longest block that spans enough documents."""
        runs, step = cut(runs), 1
        while self._round(runs, step) is not None:
            runs, step = self._round_result, step * 2
        while (step := step // 2) >= 1:
            if self._round(runs, step) is not None:
                runs = self._round_result
        return runs

    def _round(self, runs: DataFrame, step: int) -> DataFrame | None:
        """Tries the blocks this step asks for; the lengthened runs, or None if there is nothing to try or to lengthen."""

        def asked(row: dict, ids: np.ndarray, place: np.ndarray, known: np.ndarray) -> list[tuple]:
            wanted = _asked(known, remaining(_rows(np.zeros(len(ids), np.int64), place)), step)
            at = np.flatnonzero(wanted)
            return _hashed(row, ids, at, wanted[at])

        tried = runs.select(*_RUN).mapInArrow(_per_run(asked, _ASKED), _ASKED)
        lengths = sorted(r.length for r in tried.select("length").distinct().collect())
        if not lengths:
            return None
        counted = runs.select("source", "doc_id", "long", "ids", "places", "known").mapInArrow(_shard_counts(lengths, step), COUNT_SCHEMA)
        often = cut(self._often(_summed(counted)))
        new = tried.join(often.select("source", "line", "length"), ["source", "line", "length"], "left_semi").groupBy("source", "doc_id", "segment").agg(F.collect_set("i").alias("hits"))
        if new.isEmpty():
            return None
        self.counts = self.counts.unionByName(often).distinct()
        longer = F.transform("known", lambda n, i: F.when(F.array_contains("hits", i), n + step).otherwise(n))
        joined = runs.join(new, ["source", "doc_id", "segment"], "left")
        self._round_result = cut(joined.withColumn("known", F.when(F.col("hits").isNull(), F.col("known")).otherwise(longer)).drop("hits"))
        return self._round_result

    def _blocks(self) -> DataFrame:
        """source, doc_id, segment, i, length, line: the blocks of each document part that lie in no longer one."""

        def widest(row: dict, ids: np.ndarray, place: np.ndarray, known: np.ndarray) -> list[tuple]:
            at = _widest(place, known)
            return _hashed(row, ids, at, known[at])

        return self.runs.select(*_RUN).mapInArrow(_per_run(widest, _ASKED), _ASKED)

    def line_blocks(self) -> DataFrame:
        """source, line (hash of the block), length, n, of: the blocks to delete, with the documents each occurs in."""
        return self._blocks().select("source", "line", "length").distinct().join(self.counts, ["source", "line", "length"])

    def found(self) -> DataFrame:
        """block_id, line_no of every line of the blocks to delete."""
        schema = "block_id bigint, line_no int"

        def covered(row: dict, ids: np.ndarray, place: np.ndarray, known: np.ndarray) -> list[tuple]:
            at = _widest(place, known)
            gone = {p for i, n in zip(at, known[at]) for p in place[i : i + n].tolist()}
            return [(a["block_id"], a["line_no"]) for a in row["at"] if a["place"] in gone]

        return self.runs.select(*_RUN, "at").mapInArrow(_per_run(covered, schema), schema).distinct()

    def cleaned(self) -> DataFrame:
        """block_id, doc_id, text, n_removed: every block without its repeated blocks of lines; null texts stay null."""
        drop = cut(self.found().groupBy("block_id").agg(F.collect_set("line_no").alias("drop")))
        kept = F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains("drop", i + 1))
        text = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
        joined = bounded(drop, self.blocks.select("block_id", "doc_id", "text"), ["block_id"], None, "left")
        return joined.select("block_id", "doc_id", text.alias("text"), F.coalesce(F.size("drop"), F.lit(0)).alias("n_removed"))
