"""Problem 2: noise in text from scanned pages.

Words of the whole corpus are counted and grouped by their confusable-glyph skeleton: a letter-wise rewriting under
which a misread word and the word it stands for become equal. In each group the frequent form wins over the rare ones,
if the context supports it: where the frequencies leave a form open, the words on either side decide, by how often the
corpus has either form between them. Line-end hyphens are judged by whether the corpus writes the word joined or as a
compound; lines at the edges of pages are keyed by their skeleton with the page number masked and counted over the pages
of their document; page numbers must follow their page at one offset per document.

Three passes over the text run in Arrow batches: words are counted per partition, what may be noise is emitted, and the
pairs of neighbours that the open forms ask for are counted. The second and third look through Bloom filters sized by
what they hold, up to MOST_BITS; beyond, they let more through, and an exact join follows in any case.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafwork.operators.ordered import neighbour, running_sum, segmented
from leafwork.session import bounded, cut, shuffle_partitions

# What each glyph is broken into, so that glyphs confused with each other get equal skeletons.
GLYPHS = {
    "m": "rri", "n": "ri", "u": "ii", "w": "vv", "d": "cl", "h": "li", "b": "li", "8": "li", "e": "c", "f": "t", "0": "o",
    "5": "s", "$": "s", "@": "a", "9": "g", "q": "g", "2": "z", "1": "l", "!": "i", "|": "i",
}
HYPHENS = "-‐¬­"
PAGE_WORDS = ("page", "pag", "pg", "p", "seite", "s", "página", "pagina", "стр", "страница", "第", "页", "頁")
OF_WORDS = ("of", "von", "de", "sur", "из", "共")

_SKELETON = str.maketrans(GLYPHS)
_BREAK = re.compile(rf"[{HYPHENS}][ \t]*\n[ \t]*")
_EDGES = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c not in "!@$|") + "“”„‘’«»…†‡•–—·。，；：、（）"
_PARTS = re.compile(r"[-/‐‑–—]+")
_DIGITS = str.maketrans({"o": "0", "l": "1", "i": "1", "!": "1", "|": "1", "s": "5", "$": "5", "z": "2", "b": "8", "g": "9", "q": "9"})
_PAGE_SKELETONS = {w.translate(_SKELETON) for w in PAGE_WORDS}
_OF_SKELETONS = {w.translate(_SKELETON) for w in OF_WORDS}
_LINE_TOKEN = re.compile(r"[^\W_]+(?:[!@$|][^\W_]+)*[!@$|]?|[!@$|][^\W_]+|[第页頁共]")
_ROMAN = re.compile(r"m*(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})")
_ROMAN_VALUES = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
_NUMBER = re.compile(r"\d[\d.,/:%-]*")
#: Digits, after any zeros, of the largest number that surely fits a bigint; pages are counted in an int, so none has more.
_LONGEST = 18

#: Size of a Bloom filter at most (128 MB); below, it has 16 bits for each member.
MOST_BITS = 1 << 30


def skeleton(word: str) -> str:
    return word.lower().translate(_SKELETON)


def skeleton_column(word: Column) -> Column:
    """`skeleton` inside the JVM; no replacement's result is replaced again, so their order does not matter."""
    single = {k: v for k, v in GLYPHS.items() if len(v) == 1}
    folded = F.translate(F.lower(word), "".join(single), "".join(single.values()))
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), ((k, v) for k, v in GLYPHS.items() if len(v) > 1), folded)


def _words(chunk: str) -> list[str]:
    """The words of a chunk without blanks: itself, and the parts of a compound without digits."""
    word = chunk.strip(_EDGES).lower()
    if not word:
        return []
    parts = _PARTS.split(word)
    if len(parts) > 1 and not any(c.isdigit() for c in word):
        return [word, *(p for p in parts if p)]
    return [word]


def _unbroken(text: str) -> list[str]:
    """The chunks of a text without the halves of words broken at a line end."""
    if "\n" not in text or not _BREAK.search(text):
        return text.split()
    pieces = [p.split() for p in _BREAK.split(text)]
    last = len(pieces) - 1
    return [c for i, p in enumerate(pieces) for c in p[1 if i else 0 : len(p) - 1 if i < last else len(p)]]


def word_table(blocks: DataFrame, text: str = "text") -> DataFrame:
    """word (lower case), n: unbroken occurrences in all texts. Counted per partition first, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            words: Counter[str] = Counter()
            for chunk, n in chunks.items():
                for word in _words(chunk):
                    words[word] += n
            chunks.clear()
            return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for body in batch.column(0).to_pylist():
                chunks.update(_unbroken(body))
            if len(chunks) > 200_000:
                yield flush()
        yield flush()

    counted = blocks.where(F.length(text) > 0).select(text).mapInArrow(run, "word string, n bigint").withColumn("skel", skeleton_column(F.col("word")))
    spread = counted.repartition(shuffle_partitions(blocks.sparkSession), "skel")
    group = Window.partitionBy("skel")
    summed = spread.groupBy("skel", "word").agg(F.sum("n").alias("n")).withColumns({"top": F.max(F.struct("n", "word")).over(group), "total": F.sum("n").over(group)})
    return summed.select("word", "n", "skel", F.col("top.word").alias("best"), F.col("top.n").alias("best_n"), "total")


def word_groups(words: DataFrame) -> DataFrame:
    """skel, best, best_n, total: one row per skeleton."""
    return words.where(F.col("word") == F.col("best")).select("skel", "best", "best_n", "total")


def judged_words(words: DataFrame, ratio: int = 10, least: int = 5, seen: int = 3) -> DataFrame:
    """word, best, misread, open: forms that another form of their skeleton outweighs.

    misread: by frequency alone. The winner must have `least` occurrences and `ratio` times those of the form; five times
    as much for words under four letters and for tokens with digits, among which true neighbours abound. A form with a
    sign or digit between letters that its winner lacks needs only a third of the ratio. open: the context decides, for
    forms with `seen` occurrences or more, as these may be words of their own, for forms outweighed by a third of what is
    needed (none of under four letters or with digits), and for numbers read with a letter.
    """
    short = (F.length("best") < 4) | F.col("best").rlike(r"\d")
    odd = F.col("word").rlike(r"[!@$|0-9]") & ~F.col("best").rlike(r"[!@$|0-9]")
    need = F.when(short, ratio * 5.0).when(odd, F.lit(ratio / 3)).otherwise(F.lit(float(ratio)))
    lettered = F.col("best").rlike(r"\p{L}")
    number = F.col("best").rlike(r"^[0-9][0-9.,]*$") & F.col("word").rlike("[0-9]") & F.col("word").rlike(r"\p{L}")
    common = F.col("best_n") >= F.when(short, least * 20).otherwise(least)
    outweighed = lettered & common & (F.col("best_n") >= F.col("n") * need)
    near = ((lettered & ~short) | number) & common & (F.col("best_n") >= F.col("n") * need / 3)
    kept = words.where((F.col("word") != F.col("best")) & (F.length("best") > 1) & (outweighed | near))
    return kept.select("word", "best", outweighed.alias("misread"), (~outweighed | (F.col("n") >= seen)).alias("open"))


class Bloom:
    """A Bloom filter over 64-bit hashes with two bits for each."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.mask = bits, np.uint64(len(bits) * 64 - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        h = hashes.view(np.uint64)
        out = np.ones(len(h), bool)
        for at in (h & self.mask, (h >> np.uint64(32)) & self.mask):
            out &= (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def bloom_filter(hashes: DataFrame) -> bytes:
    """Bits of the filter over the column `h`, 16 for each row and MOST_BITS at most; the driver gets its longs."""
    n = hashes.count()
    bits = min(MOST_BITS, 1 << max(12, (16 * n).bit_length()))
    place = lambda h: (F.shiftrightunsigned(h.bitwiseAND(F.lit(bits - 1)), 6).alias("slot"), F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63)).cast("int")).alias("bits"))
    both = hashes.select(*place(F.col("h"))).unionByName(hashes.select(*place(F.shiftrightunsigned("h", 32))))
    found = both.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toPandas()
    longs = np.zeros(bits // 64, np.int64)
    longs[found["slot"].to_numpy()] = found["bits"].to_numpy()
    return longs.tobytes()


def _hashed(column: str):
    """Function over Arrow batches: the 64-bit hash of each string of the column, as h."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_hash(w) for w in batch.column(0).to_pylist()], pa.int64())], ["h"])

    return run


def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two neighbours from the hashes of both."""
    with np.errstate(over="ignore"):
        mixed = left.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ right.view(np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)


def _whole(digits: str) -> int | None:
    """The number that the digits write, if it may be the number of a page."""
    if not digits.isdecimal():
        return None
    bare = digits.lstrip("0")
    return int(bare or "0") if len(bare) <= _LONGEST else None


@lru_cache(1 << 17)
def _line_part(token: str) -> tuple[str, int | None]:
    """A token of a line as it enters the keys, and its number, if it may be one of a page."""
    bare = token.strip(_EDGES)
    if bare and any(c.isdigit() for c in bare) and _NUMBER.fullmatch(digits := bare.translate(_DIGITS)):
        return token.replace(bare, digits), _whole(digits)
    return token.translate(_SKELETON), None


def line_keys(line: str, page: int) -> list[str]:
    """Keys of a line that stay equal from page to page: its skeleton with all numbers as they are, and for each number
    once more with that number masked by its distance from the page. Digits read as letters are digits again."""
    parts, numbers = [], []
    for part, number in map(_line_part, line.lower().split()):
        if number is not None:
            numbers.append((len(parts), number))
        parts.append(part)
    keys = [" ".join(parts)]
    for at, number in numbers:
        keys.append(" ".join([*parts[:at], f"#{number - page}", *parts[at + 1 :]]))
    return keys


def line_hashes(line: str, page: int | None) -> list[int]:
    return [_hash(k) for k in line_keys(line, page or 0)]


@lru_cache(1 << 17)
def _page_token(token: str) -> tuple[str, int]:
    """What a token is on a page-number line, and its number: 'number', 'page', 'of', 'roman', 'glyph' (read as a digit) or 'other'."""
    digits, skel = token.translate(_DIGITS), token.translate(_SKELETON)
    if any(c.isdigit() for c in token) and (number := _whole(digits)) is not None:
        return "number", number
    if skel in _PAGE_SKELETONS:
        return "page", 0
    if skel in _OF_SKELETONS:
        return "of", 0
    if _ROMAN.fullmatch(token):
        values = [_ROMAN_VALUES[c] for c in token]
        return "roman", sum(-v if v < max(values[i:]) else v for i, v in enumerate(values))
    return ("glyph", int(digits)) if token in ("l", "i", "|", "o", "s") else ("other", 0)


def page_number(line: str) -> int | None:
    """The number of a line that holds nothing but a page number in some notation, else None."""
    numbers: list[int] = []
    for match in _LINE_TOKEN.finditer(line.lower()):
        kind, number = _page_token(match[0])
        if kind == "number" or (kind in ("roman", "glyph") and not numbers):
            numbers.append(number)
        elif kind != "page" and not (kind == "of" and numbers):
            return None
    if not numbers or len(numbers) > 2 or re.search(r"\d[.,:]\d|%", line):
        return None
    return numbers[0]


SIGN_SCHEMA = "block_id bigint, doc_id string, page_num int, order_index int, kind string, num bigint, a string, b string"
#: Lines at either edge of a block that are keyed at first; as many more follow wherever all of them are running lines.
EDGE = 2


def _edge_rows(where: tuple, lines: list[str], low: int, high: int, page: int | None, sides: str = "hf") -> list[tuple]:
    """Signs of the lines number `low` to `high` from the head (h) or foot (f); a tells the places, b whether lines lie
    further in."""
    found: dict[str, list[str]] = {}
    for i in range(low, min(high, len(lines))):
        for side in sides:
            found.setdefault(lines[i if side == "h" else -1 - i], []).append(f"{side}{i}")
    more = "more" if len(lines) > high else None
    return [(*where, "edge", h, " ".join(places), more) for line, places in found.items() for h in line_hashes(line, page)]


def _content(text: str) -> tuple[list[str], list[str]]:
    """The lines of a text that are not blank, and those of them that are no page numbers."""
    lines = [s for s in map(str.strip, text.split("\n")) if s]
    return lines, [s for s in lines if page_number(s) is None]


def _signs(settled: bytes, open_: bytes):
    """Function over Arrow batches (block_id, doc_id, page_num, order_index, text) that emits signs of noise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [Bloom(np.frombuffer(b, np.uint64)) for b in (settled, open_)]
        known: dict[str, tuple[list[str], list[str]] | None] = {}

        def look(chunks: list[str]) -> None:
            """Enters what the chunks may hold into `known`: (settled, open) words, or None for nothing."""
            words = [(c, w) for c in chunks for w in _words(c)]
            hashes = np.array([_hash(w) for _, w in words], np.int64)
            hits = [f.has(hashes) for f in filters]
            known.update(dict.fromkeys(chunks))
            for k in np.flatnonzero(hits[0] | hits[1]):
                chunk, word = words[k]
                entry = known[chunk] = known[chunk] or ([], [])
                for kind in (0, 1):
                    if hits[kind][k]:
                        entry[kind].append(word)

        for batch in batches:
            rows: list[tuple] = []
            columns = [c.to_pylist() for c in batch.columns]
            texts = [_unbroken(t) for t in columns[4]]
            look(list({c for t in texts for c in t if c not in known}))
            for block, doc, page, order, text, chunks in zip(*columns, texts):
                where = (block, doc, page, order)
                words: set[tuple[str, str | None]] = set()
                for i, chunk in enumerate(chunks):
                    if (entry := known[chunk]) is not None:
                        words.update((w, None) for w in entry[0])
                        if entry[1]:
                            sides = "\x1f".join(chunks[k].strip(_EDGES).lower() if 0 <= k < len(chunks) else "" for k in (i - 1, i + 1))
                            words.update((w, sides) for w in entry[1])
                rows += [(*where, "word" if sides is None else "open", None, w, sides) for w, sides in words]
                lines, edges = _content(text)
                if not lines:
                    continue
                for i in range(len(lines) - 1):
                    if lines[i][-1] in HYPHENS:
                        one, two = lines[i].split()[-1][:-1].lstrip(_EDGES).lower(), lines[i + 1].split()[0].rstrip(_EDGES).lower()
                        if one and two and one[-1].isalpha() and two[0].isalpha():
                            rows.append((*where, "break", None, one, two))
                ends = lines[-1].split()[-1]
                tail = ends[:-1].lstrip(_EDGES).lower() if ends[-1] in HYPHENS else ""
                if tail and tail[-1].isalpha():
                    rows.append((*where, "tail", None, tail, None))
                for s in lines if len(edges) < len(lines) else ():
                    if (number := page_number(s)) is not None:
                        rows.append((*where, "number", number, s, None))
                rows += _edge_rows(where, edges, 0, EDGE, page)
                if edges and edges[0][0].islower():
                    rows.append((*where, "head", None, edges[0].split()[0].rstrip(_EDGES).lower(), None))
                elif len(edges) > 1 and any(s[0].islower() for s in edges[1:3]):
                    first = next(s for s in edges[1:3] if s[0].islower())
                    rows.append((*where, "head", None, first.split()[0].rstrip(_EDGES).lower(), None))
            if len(known) > 500_000:
                known.clear()
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string())
    columns = list(zip(*rows)) or [()] * len(kinds)
    names = [n.split()[0] for n in SIGN_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def scanned(blocks: DataFrame, parser: str = "qwen_vl") -> DataFrame:
    return blocks.where((F.col("parser_used") == parser) & (F.length("text") > 0))


def noise_signs(blocks: DataFrame, judged: DataFrame) -> DataFrame:
    """Rows of SIGN_SCHEMA for the scanned blocks; the judged words enter as two Bloom filters."""
    context = blocks.sparkSession.sparkContext
    shared = [context.broadcast(bloom_filter(cut(judged.where(w).select("word").mapInArrow(_hashed("word"), "h bigint")))) for w in ("not open", "open")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _signs(shared[0].value, shared[1].value)(batches)

    return scanned(blocks).select(F.col("block_id").cast("bigint"), "doc_id", "page_num", "order_index", "text").mapInArrow(run, SIGN_SCHEMA)


def _context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to rows ending in (word, sides, best) the pairs of the form and of its winner with both neighbours."""
    for batch in batches:
        word, sides, best = (batch.column(n).to_pylist() for n in ("word", "sides", "best"))
        around = [s.split("\x1f") for s in sides]
        left, right, own, other = (np.array([_hash(w) for w in column], np.int64) for column in ([a for a, _ in around], [b for _, b in around], word, best))
        pairs = [_pair(left, own), _pair(own, right), _pair(left, other), _pair(other, right)]
        columns = [*batch.columns, *map(pa.array, pairs), pa.array([bool(a) + bool(b) for a, b in around], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lw", "wr", "lb", "br", "sides_n"])


def pair_counts(blocks: DataFrame, asked: DataFrame, text: str = "text") -> DataFrame:
    """pair, n: how often two words with one of the asked hashes (column h) follow each other in the corpus."""
    shared = blocks.sparkSession.sparkContext.broadcast(bloom_filter(asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = Bloom(np.frombuffer(shared.value, np.uint64))
        hashes: dict[str, int] = {}
        counts: Counter[int] = Counter()
        edge = _hash("")
        for batch in batches:
            flat: list[str | None] = [None]
            for body in batch.column(0).to_pylist():
                flat += _unbroken(body)
                flat.append(None)
            for chunk in set(flat) - hashes.keys():
                hashes[chunk] = edge if chunk is None else _hash(chunk.strip(_EDGES).lower())
            line = np.fromiter(map(hashes.__getitem__, flat), np.int64, len(flat))
            pairs = _pair(line[:-1], line[1:])
            found, n = np.unique(pairs[bloom.has(pairs)], return_counts=True)
            counts.update(dict(zip(found.tolist(), n.tolist())))
            if len(hashes) > 500_000:
                hashes.clear()
            if len(counts) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())], ["pair", "n"])
                counts.clear()
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())], ["pair", "n"])

    return blocks.where(F.length(text) > 0).select(text).mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def misread_blocks(signs: DataFrame, judged: DataFrame, blocks: DataFrame, support: int = 3, ratio: int = 10) -> DataFrame:
    """block_id, doc_id, page_num, word, best: the misread words, by the exact join behind the filters.

    An open form is judged where it stands: its support is how often the corpus has it after the same word or before the
    same word, this place left out; that of its winner likewise. A form misread by its frequency stays if it has `support`
    and its winner none; another is misread if its winner has `support` and `ratio` times that of the form.
    """
    where = ["block_id", "doc_id", "page_num"]
    sure = signs.where("kind = 'word'").select(*where, F.col("a").alias("word")).join(judged.where("not open").select("word", "best"), "word").select(*where, "word", "best")
    asked = signs.where("kind = 'open'").select(*where, F.col("a").alias("word"), F.col("b").alias("sides")).join(judged.where("open").select("word", "best", "misread"), "word")
    schema = "block_id bigint, doc_id string, page_num int, word string, sides string, best string, misread boolean, lw bigint, wr bigint, lb bigint, br bigint, sides_n int"
    contexts = cut(asked.select(*where, "word", "sides", "best", "misread").mapInArrow(_context, schema))
    distinct = contexts.select("lw", "wr", "lb", "br", "sides_n").distinct()
    each = distinct.select("lw", "wr", "lb", "br", F.posexplode(F.array("lw", "wr", "lb", "br")).alias("role", "pair"))
    counts = pair_counts(blocks, cut(each.select(F.col("pair").alias("h")).distinct()))
    has = each.join(counts, "pair").groupBy("lw", "wr", "lb", "br").agg(F.sum(F.when(F.col("role") < 2, F.col("n"))).alias("own"), F.sum(F.when(F.col("role") > 1, F.col("n"))).alias("other"))
    joined = contexts.join(has, ["lw", "wr", "lb", "br"], "left")
    own, other = F.coalesce("own", F.lit(0)) - F.col("sides_n"), F.coalesce("other", F.lit(0))
    wrong = F.when(F.col("misread"), ~((own >= support) & (other == 0))).otherwise((other >= support) & (other >= own * ratio))
    return sure.unionByName(joined.where(wrong).select(*where, "word", "best"))


def broken_words(signs: DataFrame, groups: DataFrame, words: DataFrame, least: int = 5) -> DataFrame:
    """block_id, doc_id, page_num, a, b, across, hyphen, misread: pairs of halves on two lines or, if across, on two pages.

    hyphen is true for words written without one. misread is the frequent form the whole is a misreading of, else null.
    A break counts when the corpus has more unbroken occurrences of the joined word than of the compound, both taken by
    skeleton so that a misread half does not hide the word. If it has neither, the halves decide: two words known by
    themselves are a compound; where a half stands as one of a pair over two pages, it does not make itself known.
    """
    pages = signs.where("kind = 'head'").groupBy("doc_id", "page_num").agg(F.min(F.struct("order_index", "block_id", "a")).alias("head"))
    tails = (
        signs.where("kind = 'tail'")
        .select("block_id", "doc_id", F.col("page_num").alias("page"), "a")
        .join(pages.select("doc_id", (F.col("page_num") - 1).alias("page"), F.col("head.a").alias("b")), ["doc_id", "page"])
        .select("block_id", "doc_id", F.col("page").alias("page_num"), "a", "b", F.lit(True).alias("across"))
    )
    inside = signs.where("kind = 'break'").select("block_id", "doc_id", "page_num", "a", "b", F.lit(False).alias("across"))
    pairs = inside.unionByName(tails).withColumns({"joined": skeleton_column(F.concat("a", "b")), "compound": skeleton_column(F.concat_ws("-", "a", "b"))})
    distinct = cut(pairs.select("a", "b", "joined", "compound").distinct())
    # Only the forms that are asked for leave the word table.
    asked = lambda one, two, name: distinct.select(F.explode(F.array(one, two)).alias(name)).distinct()
    sums = cut(bounded(asked("joined", "compound", "skel"), groups.select("skel", "total", "best", "best_n"), ["skel"]))
    ahead = tails.select("doc_id", (F.col("page_num") + 1).alias("page_num"), F.col("b").alias("a")).distinct()
    halves = signs.where("kind = 'tail'").select("a").unionByName(signs.where("kind = 'head'").join(ahead, ["doc_id", "page_num", "a"], "left_semi").select("a"))
    counted = bounded(asked("a", "b", "word"), words.where("n >= 3").select("word", "n"), ["word"])
    broken = halves.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("of"))
    known = cut(counted.join(broken, "word", "left").where(F.col("n") - F.coalesce("of", F.lit(0)) >= 3).select("word"))
    judged = (
        distinct.join(sums.toDF("joined", "as_one", "best_one", "n_one"), "joined", "left")
        .join(sums.toDF("compound", "as_two", "best_two", "n_two"), "compound", "left")
        .join(known.select(F.col("word").alias("a"), F.lit(1).alias("a_known")), "a", "left")
        .join(known.select(F.col("word").alias("b"), F.lit(1).alias("b_known")), "b", "left")
    )
    one, two = F.coalesce("as_one", F.lit(0)), F.coalesce("as_two", F.lit(0))
    neither = (one == 0) & (two == 0) & ~(F.col("a_known").isNotNull() & F.col("b_known").isNotNull())
    hyphen = (one > two) | neither
    best, often = F.when(hyphen, F.col("best_one")).otherwise(F.col("best_two")), F.when(hyphen, F.col("n_one")).otherwise(F.col("n_two"))
    whole = F.when(hyphen, F.concat("a", "b")).otherwise(F.concat_ws("-", "a", "b"))
    misread = F.when((often >= least) & (best != whole), best)
    return pairs.join(judged.select("a", "b", hyphen.alias("hyphen"), misread.alias("misread")), ["a", "b"]).select("block_id", "doc_id", "page_num", "a", "b", "across", "hyphen", "misread")


def document_pages(blocks: DataFrame, parser: str = "qwen_vl") -> DataFrame:
    """doc_id, pages: how many pages of each scanned document have a block, with text or without."""
    return blocks.where(F.col("parser_used") == parser).groupBy("doc_id").agg(F.count_distinct("page_num").alias("pages"))


def recurring_lines(edges: DataFrame, pages: DataFrame, least: int = 3, share: float = 0.5) -> DataFrame:
    """block_id, doc_id, page_num, num, a, b: edge lines with a key that is on at least `least` pages and `share` of the
    document's pages."""
    lines = edges.select("doc_id", "num", "page_num").repartition(shuffle_partitions(edges.sparkSession), "doc_id", "num")
    counted = lines.groupBy("doc_id", "num", "page_num").agg(F.lit(1)).groupBy("doc_id", "num").agg(F.count("*").alias("on")).where(F.col("on") >= least)
    kept = cut(counted.join(pages, "doc_id").where(F.col("on") >= F.col("pages") * share).select("doc_id", "num"))
    return bounded(kept, edges.select("block_id", "doc_id", "page_num", "num", "a", "b"), ["doc_id", "num"])


def running_lines(edges: DataFrame, pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """block_id, doc_id, page_num, num: the recurring lines at the head or foot of their page.

    Where all keyed lines at one edge of a block recur and more lines follow, the next EDGE lines of these blocks are
    keyed too, and so on: furniture of any height is found, while a line inside a text is none.
    """
    pages = cut(pages)
    found, depth = cut(recurring_lines(edges, pages)), EDGE
    parts = [found]
    while True:
        places = found.where("b = 'more'").select("block_id", F.explode(F.split("a", " ")).alias("place")).distinct()
        full = places.groupBy("block_id", F.substring("place", 1, 1).alias("side")).agg(F.count("*").alias("n")).where(F.col("n") == EDGE)
        sides = cut(full.groupBy("block_id").agg(F.array_join(F.sort_array(F.collect_set("side")), "").alias("sides")))
        if sides.isEmpty():
            return reduce(DataFrame.unionByName, parts).select("block_id", "doc_id", "page_num", "num")

        def run(batches: Iterator[pa.RecordBatch], low: int = depth) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = zip(*(c.to_pylist() for c in batch.columns))
                yield _batch([r for block, doc, page, order, text, side in rows for r in _edge_rows((block, doc, page, order), _content(text)[1], low, low + EDGE, page, side)])

        deeper = bounded(sides, scanned(blocks).select(F.col("block_id").cast("bigint"), "doc_id", "page_num", "order_index", "text"), ["block_id"])
        found = cut(recurring_lines(cut(deeper.select("block_id", "doc_id", "page_num", "order_index", "text", "sides").mapInArrow(run, SIGN_SCHEMA)), pages))
        parts.append(found)
        depth += EDGE


def page_number_lines(signs: DataFrame) -> DataFrame:
    """block_id, doc_id, page_num, line: page-number lines at the offset (number less page) that most pages of their document have.

    A tie goes to the offset 1, then to the smaller one; the offset must be 1 or shared by two pages.
    """
    numbers = signs.where("kind = 'number'").select("block_id", "doc_id", "page_num", F.col("a").alias("line"), (F.col("num") - F.col("page_num")).alias("offset"))
    per = numbers.groupBy("doc_id", "offset").agg(F.count_distinct("page_num").alias("on"))
    best = per.groupBy("doc_id").agg(F.max(F.struct("on", (F.col("offset") == 1).alias("usual"), (-F.col("offset")).alias("low"))).alias("top"))
    chosen = best.where("top.on >= 2 or top.usual").select("doc_id", (-F.col("top.low")).alias("offset"))
    return numbers.join(chosen, ["doc_id", "offset"]).select("block_id", "doc_id", "page_num", "line")


class ScanNoise:
    """The shared relations of one run over `blocks`.

    Words, judged words and signs are written to the checkpoint folder, as several relations read them. Null and empty
    texts give no signs; a block that comes twice under two ids is judged twice; a null doc_id makes no document of its own.
    """

    def __init__(self, blocks: DataFrame) -> None:
        self.blocks = blocks
        self.words = cut(word_table(blocks))
        self.groups = word_groups(self.words)
        self.judged = cut(judged_words(self.words))
        signs = cut(noise_signs(blocks, self.judged))
        self.edges, self.signs = signs.where("kind = 'edge'"), cut(signs.where("kind <> 'edge'"))

    def misread(self) -> DataFrame:
        return misread_blocks(self.signs, self.judged, self.blocks)

    def broken(self) -> DataFrame:
        return broken_words(self.signs, self.groups, self.words)

    def running(self) -> DataFrame:
        return running_lines(self.edges, document_pages(self.blocks), self.blocks)

    def found(self) -> DataFrame:
        """block_id, noise: one row per scanned block and kind of noise."""
        broken = self.broken()
        in_halves = broken.where(F.col("misread").isNotNull() & (~F.col("across") | ~F.col("misread").startswith(F.col("a"))))
        kinds = {
            "char": self.misread().select("block_id").unionByName(in_halves.select("block_id")),
            "hyphen": broken.where("hyphen"),
            "running": self.running(),
            "page_no": page_number_lines(self.signs),
        }
        parts = [frame.select("block_id", F.lit(kind).alias("noise")) for kind, frame in kinds.items()]
        return reduce(DataFrame.unionByName, parts).distinct()


def _recased(word: str, original: str) -> str:
    letters = [c for c in original if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return word.upper()
    return word[:1].upper() + word[1:] if original[:1].isupper() else word


def correct_words(text: str, best: dict[str, str]) -> str:
    """The text with each misread word (a key of `best`, lower case) replaced, its capitals kept."""
    if not best:
        return text

    def chunk(match: re.Match) -> str:
        whole = match[0]
        core = whole.strip(_EDGES)
        if not core:
            return whole
        at = whole.index(core)
        if (found := best.get(core.lower())) is not None:
            fixed = _recased(found, core)
        else:
            fixed = "".join(_recased(best[p.lower()], p) if p.lower() in best else p for p in re.split(r"([-/‐‑–—]+)", core))
        return whole[:at] + fixed + whole[at + len(core) :]

    return re.sub(r"\S+", chunk, text)


def repair_block(text: str, kind: str, best: dict[str, str], breaks: dict[tuple[str, str], tuple[bool, str | None]], running: set[int], numbers: set[str], page: int = 0) -> str:
    """One block without page furniture, its broken words joined, its misread words corrected and its lines reflowed.

    Lists and tables keep their lines; other blocks become one line.
    """
    lines = []
    for line in map(str.strip, text.split("\n")):
        if not line or line in numbers or (running and not running.isdisjoint(line_hashes(line, page))):
            continue
        if lines and lines[-1][-1] in HYPHENS:
            first, _, rest = line.partition(" ")
            half = lines[-1].split()[-1][:-1]
            verdict = breaks.get((half.lstrip(_EDGES).lower(), first.rstrip(_EDGES).lower()))
            if verdict is not None:
                joined, word = verdict
                whole = half + ("" if joined else "-") + first
                if word is not None:
                    core = whole.strip(_EDGES)
                    whole = whole.replace(core, _recased(word, core))
                head = lines[-1][: len(lines[-1]) - len(half) - 1]
                lines[-1] = f"{head}{whole} {rest}".rstrip()
                continue
        if kind in ("list", "table") or not lines:
            lines.append(line)
        else:
            lines[-1] = f"{lines[-1]} {line}"
    return correct_words("\n".join(lines), best)


REPAIRED_SCHEMA = "block_id bigint, doc_id string, seg int, page_num int, order_index int, block_type string, text string, joins string"


def _repairs(noise: ScanNoise) -> DataFrame:
    """block_id, doc_id, seg, kind, a, b, num, across, hyphen: all that is to be mended, in one relation."""
    parts = {
        "word": noise.misread().select("block_id", "doc_id", "page_num", F.col("word").alias("a"), F.col("best").alias("b")),
        "break": noise.broken().select("block_id", "doc_id", "page_num", "a", F.concat_ws("\x1f", "b", F.coalesce("misread", F.lit(""))).alias("b"), "across", "hyphen"),
        "running": noise.running().select("block_id", "doc_id", "page_num", "num"),
        "number": page_number_lines(noise.signs).select("block_id", "doc_id", "page_num", F.col("line").alias("a")),
    }
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [frame.withColumn("kind", F.lit(kind)) for kind, frame in parts.items()])
    return _segment(rows).select("block_id", "doc_id", "seg", "kind", "a", "b", "num", "across", "hyphen")


def _segment(rows: DataFrame) -> DataFrame:
    return rows.withColumn("seg", F.floor(F.coalesce("page_num", F.lit(0)) / SEGMENT_PAGES).cast("int"))


def _repair_segment(blocks: pa.Table, repairs: pa.Table) -> pa.Table:
    """The blocks of one segment of pages, one per place, mended; those of nothing but furniture are gone."""
    mend: dict[int, list[dict]] = {}
    for r in repairs.to_pylist():
        mend.setdefault(r["block_id"], []).append(r)
    first: dict[tuple, dict] = {}
    for r in blocks.to_pylist():
        place = (r["page_num"], r["order_index"])
        if place not in first or r["block_id"] < first[place]["block_id"]:
            first[place] = r
    out = []
    for r in first.values():
        if not r["text"]:
            continue
        found = mend.get(r["block_id"], ())
        best = {f["a"]: f["b"] for f in found if f["kind"] == "word"}
        halves = [(f["a"], *f["b"].split("\x1f"), f["across"], f["hyphen"]) for f in found if f["kind"] == "break"]
        inside = {(a, b): (hyphen, word or None) for a, b, word, across, hyphen in halves if not across}
        running, numbers = {f["num"] for f in found if f["kind"] == "running"}, {f["a"] for f in found if f["kind"] == "number"}
        text = repair_block(r["text"], r["block_type"], best, inside, running, numbers, r["page_num"] or 0)
        joins = next(("word" if hyphen else "compound" for *_, across, hyphen in halves if across), None)
        if text:
            out.append({**r, "text": text, "joins": joins})
    return pa.Table.from_pylist(out, schema=_REPAIRED)


_REPAIRED = pa.schema([("block_id", pa.int64()), ("doc_id", pa.string()), ("seg", pa.int32()), ("page_num", pa.int32()), ("order_index", pa.int32()), ("block_type", pa.string()), ("text", pa.string()), ("joins", pa.string())])
#: Pages of a document that are mended and laid out in one task.
SEGMENT_PAGES = 64


def repaired_blocks(noise: ScanNoise) -> DataFrame:
    """REPAIRED_SCHEMA: the scanned blocks, one per place, with their repairs applied; blocks of nothing but furniture
    have no row. joins tells how a word broken at the end goes on: 'word', 'compound' or null. Texts and repairs meet once,
    by segments of pages."""
    rows = noise.blocks.where((F.col("parser_used") == "qwen_vl") & F.col("doc_id").isNotNull())
    slim = _segment(rows.select(F.col("block_id").cast("bigint"), "doc_id", F.col("page_num").cast("int"), F.col("order_index").cast("int"), "block_type", "text"))
    slim = slim.select("block_id", "doc_id", "seg", "page_num", "order_index", "block_type", "text")
    return slim.groupBy("doc_id", "seg").cogroup(_repairs(noise).groupBy("doc_id", "seg")).applyInArrow(_repair_segment, REPAIRED_SCHEMA)


def _numbered(repaired: DataFrame) -> DataFrame:
    """doc_id, seg, block_id, joint, paragraph, spread: the paragraph of each block, how it goes on from the block before
    (null: it begins the paragraph), and whether the paragraph lies in several segments. SQL windows, without the texts."""
    unfinished = ~F.col("text").rlike(r"[.!?:;。！？][\"'”’)\]]*$")
    flags = repaired.select("doc_id", "page_num", "order_index", "block_id", "block_type", "joins", unfinished.alias("unfinished"), F.col("text").rlike(r"^\p{Ll}").alias("low"))
    slim = cut(segmented(flags, pages=SEGMENT_PAGES))
    prose = F.coalesce(F.col("block_type").isin("paragraph", "other", "footnote"), F.lit(False))
    before = neighbour(slim, {"__open": prose & (F.col("unfinished") | F.col("joins").isNotNull()), "__joins": F.col("joins"), "__seg": F.col("seg")}, -1)
    goes_on = F.coalesce(prose & F.col("__open") & (F.col("low") | F.col("__joins").isNotNull()), F.lit(False))
    numbered = running_sum(before.withColumn("__on", goes_on), "paragraph", F.when(F.col("__on"), 0).otherwise(1).cast("bigint"))
    crossing = numbered.where(F.col("__on") & (F.col("__seg") != F.col("seg"))).select("doc_id", "paragraph").distinct().withColumn("spread", F.lit(True))
    marked = numbered.join(crossing, ["doc_id", "paragraph"], "left")
    joint = F.when(F.col("__on"), F.coalesce("__joins", F.lit("space")))
    return marked.select("doc_id", "seg", "block_id", joint.alias("joint"), "paragraph", F.coalesce("spread", F.lit(False)).alias("spread"))


def _joined(text: str, joint: str | None, more: str) -> str:
    if joint in ("word", "compound"):
        return (text[:-1] if text[-1:] and text[-1] in HYPHENS else text) + ("-" if joint == "compound" else "") + more
    return f"{text} {more}"


_PARAGRAPH = "doc_id string, paragraph bigint, block_type string, first_page int, last_page int, n_blocks int, text string"
_PIECE = f"{_PARAGRAPH}, seg int, joint string, spread boolean"


def _flow(blocks: pa.Table, numbers: pa.Table) -> pa.Table:
    """The pieces of paragraphs in one segment, each with the joint before it."""
    of = {r["block_id"]: r for r in numbers.to_pylist()}
    pieces: dict[int, dict] = {}
    order = lambda r: tuple((v is not None, v or 0) for v in (r["page_num"], r["order_index"]))
    for r in sorted(blocks.to_pylist(), key=order):
        n = of[r["block_id"]]
        piece = pieces.get(n["paragraph"])
        if piece is None:
            pieces[n["paragraph"]] = {
                "doc_id": r["doc_id"], "paragraph": n["paragraph"], "block_type": r["block_type"], "first_page": r["page_num"], "last_page": r["page_num"],
                "n_blocks": 1, "text": r["text"], "seg": r["seg"], "joint": n["joint"], "spread": n["spread"],
            }
        else:
            piece |= {"text": _joined(piece["text"], n["joint"], r["text"]), "last_page": r["page_num"], "n_blocks": piece["n_blocks"] + 1}
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.Table.from_pylist([*pieces.values()], schema=pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in _PIECE.split(", ")]))


def paragraphs(repaired: DataFrame) -> DataFrame:
    """doc_id, paragraph, block_type, first_page, last_page, n_blocks, text: readable paragraphs in reading order.

    A block goes on with the next one of its kind when a word is broken between them, or when it does not end a sentence
    and the next starts in lower case. Windows run in segments of pages, so that no document is gathered in one task; the
    texts of a segment meet their paragraph numbers once, and only paragraphs over several segments are gathered again.
    """
    rows = cut(repaired)
    texts = rows.select(*(F.col(c).alias(c) for c in rows.columns))
    pieces = cut(texts.groupBy("doc_id", "seg").cogroup(_numbered(rows).groupBy("doc_id", "seg")).applyInArrow(_flow, _PIECE))
    columns = [f.split()[0] for f in _PARAGRAPH.split(", ")]
    parts = F.array_sort(F.collect_list(F.struct("seg", "joint", "text", "block_type", "first_page", "last_page", "n_blocks"))).alias("p")
    bare = lambda t: F.regexp_replace(t, rf"[{HYPHENS}]$", "")
    step = lambda text, p: F.when(text == "", p["text"]).when(p["joint"] == "word", F.concat(bare(text), p["text"])).when(p["joint"] == "compound", F.concat(bare(text), F.lit("-"), p["text"])).otherwise(F.concat_ws(" ", text, p["text"]))
    wide = pieces.where("spread").groupBy("doc_id", "paragraph").agg(parts).select(
        "doc_id", "paragraph", F.element_at("p", 1)["block_type"].alias("block_type"), F.element_at("p", 1)["first_page"].alias("first_page"), F.element_at("p", -1)["last_page"].alias("last_page"),
        F.aggregate("p", F.lit(0), lambda n, p: n + p["n_blocks"]).alias("n_blocks"), F.aggregate("p", F.lit(""), step).alias("text"),
    )
    return pieces.where("not spread").select(*columns).unionByName(wide)
