"""Problem 8: the corpus as token ids of a public byte-level BPE vocabulary.

Texts are cut by the vocabulary's pattern into pretokens; each distinct pretoken of a batch is encoded once. Encoding
runs on length-bucketed, padded numpy matrices: in each round every row merges its leftmost pair of minimum rank. Ranks
of pairs come from an open-addressing hash table held in two arrays; after a merge the row is compacted by one gather
and only the two pairs beside the merge are looked up again. Finished rows leave the matrix.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public vocabularies lie on the driver; the executors get the file's content by broadcast.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pattern that cuts texts for this family of vocabularies; blanks are those of Unicode.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

NONE = np.int32(2**31 - 1)
#: Pretokens longer than this are merged with a heap, as a matrix row would need a round per byte.
LONGEST_ROW = 1024
#: Distinct pretokens remembered by a worker before it forgets them; only memory depends on it.
REMEMBERED = 400_000


def _mix(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(32))


class Bpe:
    """Encoder for one vocabulary given as lines of base64 token and rank."""

    def __init__(self, vocabulary: bytes, pattern: str = PATTERN) -> None:
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        self.pattern = regex.compile(pattern)
        self.bytes = np.full(256, -1, np.int32)
        for value in range(256):
            self.bytes[value] = self.ranks[bytes([value])]
        pairs = [(a, b, r) for t, r in self.ranks.items() for i in range(1, len(t)) if (a := self.ranks.get(t[:i])) is not None and (b := self.ranks.get(t[i:])) is not None]
        self._build(np.array(pairs, np.int64).reshape(-1, 3))
        self.known: dict[str, tuple[int, ...]] = {}

    def _build(self, pairs: np.ndarray) -> None:
        """The hash table: slots are probed linearly; all pairs still without a slot try their next one together."""
        bits = max(10, int(np.ceil(np.log2(max(len(pairs), 1) * 3))))
        self.mask = np.int64((1 << bits) - 1)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int32)
        key = (pairs[:, 0] << 32) | pairs[:, 1]
        slot = (_mix(key) & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(pairs))
        while len(left):
            at = slot[left]
            free = self.keys[at] == -1
            order = left[free]
            self.keys[slot[order]] = key[order]
            placed = self.keys[slot[left]] == key[left]
            self.values[slot[left[placed]]] = pairs[left[placed], 2]
            left = left[~placed]
            slot[left] = (slot[left] + 1) & self.mask

    def lookup(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where the pair does not merge (also where either side is padding, -1)."""
        out = np.full(first.shape, NONE, np.int32)
        todo = np.flatnonzero((first >= 0) & (second >= 0))
        key = (first.ravel()[todo].astype(np.int64) << 32) | second.ravel()[todo].astype(np.int64)
        slot = (_mix(key) & np.uint64(self.mask)).astype(np.int64)
        flat = out.ravel()
        while len(todo):
            seen = self.keys[slot]
            hit = seen == key
            flat[todo[hit]] = self.values[slot[hit]]
            more = ~hit & (seen != -1)
            todo, key, slot = todo[more], key[more], (slot[more] + 1) & self.mask
        return out

    def encode_words(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each pretoken."""
        out: list[tuple[int, ...] | None] = [None] * len(words)
        buckets: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if (rank := self.ranks.get(word)) is not None:
                out[i] = (rank,)
            elif len(word) > LONGEST_ROW:
                out[i] = self._heap(word)
            else:
                buckets.setdefault((len(word) - 1).bit_length(), []).append(i)
        for power, rows in buckets.items():
            width = 1 << power
            step = max(1, (1 << 20) // width)
            for start in range(0, len(rows), step):
                some = rows[start : start + step]
                for i, ids in zip(some, self._matrix([words[i] for i in some], width)):
                    out[i] = ids
        return out

    def _matrix(self, words: list[bytes], width: int) -> list[tuple[int, ...]]:
        sizes = np.array([len(w) for w in words])
        ids = np.full((len(words), width + 1), -1, np.int32)
        inside = np.arange(width + 1) < sizes[:, None]
        ids[inside] = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        ranks = self.lookup(ids[:, :-1], ids[:, 1:])
        out: list[tuple[int, ...]] = [()] * len(words)
        row_of = np.arange(len(words))
        while len(ids):
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(ids)), at]
            done = least == NONE
            if done.any():
                for row, values in zip(row_of[done].tolist(), ids[done].tolist()):
                    out[row] = tuple(v for v in values if v >= 0)
                keep = ~done
                ids, ranks, row_of, at, least = ids[keep], ranks[keep], row_of[keep], at[keep], least[keep]
                if not len(ids):
                    break
            rows = np.arange(len(ids))
            ids[rows, at] = least
            columns = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns > at[:, None]), axis=1) if len(columns) else ranks[:, :0]
            if not ranks.shape[1]:
                ranks = np.full((len(ids), 1), NONE, np.int32)
                ids = np.pad(ids, ((0, 0), (0, 1)), constant_values=-1)
                continue
            here = np.minimum(at, ranks.shape[1] - 1)
            right = self.lookup(ids[rows, here], ids[rows, here + 1])
            ranks[rows, here] = right
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.lookup(ids[before, at[before] - 1], ids[before, at[before]])
        return out

    def _heap(self, word: bytes) -> tuple[int, ...]:
        """The same merges for one long pretoken with a linked list and a heap of (rank, position)."""
        n = len(word)
        ids = self.bytes[np.frombuffer(word, np.uint8)].tolist()
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        starts = [word[i : i + 1] for i in range(n)]
        heap = [(r, i, i + 1) for i in range(n - 1) if (r := self.ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            rank, i, j = heapq.heappop(heap)
            if not (alive[i] and alive[j]) or right[i] != j or self.ranks.get(starts[i] + starts[j]) != rank:
                continue
            starts[i] += starts[j]
            ids[i], alive[j], right[i] = rank, False, right[j]
            if right[j] >= 0:
                left[right[j]] = i
                if (r := self.ranks.get(starts[i] + starts[right[i]])) is not None:
                    heapq.heappush(heap, (r, i, right[i]))
            if left[i] >= 0 and (r := self.ranks.get(starts[left[i]] + starts[i])) is not None:
                heapq.heappush(heap, (r, left[i], i))
        return tuple(v for v, a in zip(ids, alive) if a)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; null and empty texts have none."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        cut = [self.pattern.findall(t) if t else [] for t in texts]
        fresh = list({w for words in cut for w in words if w not in self.known})
        self.known.update(zip(fresh, self.encode_words([w.encode("utf-8", "surrogatepass") for w in fresh])))
        of = self.known.__getitem__
        return [list(chain.from_iterable(map(of, words))) for words in cut]


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _encoded(documents: DataFrame, keys: tuple[str, ...], text: str, vocabulary: str, counts: bool) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    kind, name = (pa.int32(), "n_tokens") if counts else (pa.list_(pa.int32()), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                some = batch.slice(start, 1000)
                ids = bpe.encode(some.column(len(keys)).to_pylist())
                yield pa.RecordBatch.from_arrays([*some.columns[: len(keys)], pa.array([len(i) for i in ids] if counts else ids, kind)], [*keys, name])

    slim = documents.select(*keys, text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keys).schema)
    return slim.mapInArrow(run, f"{schema}, {name} {'int' if counts else 'array<int>'}")


def token_ids(documents: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """`keys` and ids (array<int>, without special tokens) of every row, in one pass without a shuffle.

    Null and empty texts have the empty array. Strings of special tokens in a text are ordinary text.
    """
    return _encoded(documents, keys, text, vocabulary, False)


def token_counts(documents: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """`keys` and n_tokens of every row; the ids do not leave the worker."""
    return _encoded(documents, keys, text, vocabulary, True)
