"""Text matching: n-gram presence, token similarity, best matches and their evaluation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafwork.functions import text as T
from leafwork.session import bounded, cut


def tokens(text: Column) -> Column:
    return F.filter(F.split(T.compare_form(text), " "), lambda w: w != "")


def distinct_grams(words: list[str], n: int = 4) -> int:
    """How many different n-grams the words have; fewer than n words are one gram, none have none. Exact: grams are told
    apart by numbers for their words, joined two at a time."""
    if len(words) < n:
        return 1 if words else 0
    codes: dict[str, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    grams = ids
    for k in range(1, n):
        grams = np.unique(grams[: len(words) - k] * len(codes) + ids[k:], return_inverse=True)[1]
    return int(grams.max()) + 1


def gram_counts(texts: DataFrame, key: str, text: str = "text", n: int = 4) -> DataFrame:
    """key, n: the distinct n-grams of each text that has words; one Arrow pass, no gram leaves it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [distinct_grams([w for w in t.split(" ") if w], n) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], [key, "n"]).filter(pa.array([c > 0 for c in counts]))

    slim = texts.select(key, T.compare_form(F.col(text)).alias("form"))
    return slim.mapInArrow(run, f"`{key}` {slim.schema[key].dataType.simpleString()}, n bigint")


_WEIGHT = 0x9E3779B97F4A7C15


def gram_hashes(words: list[str], n: int, cache: dict[str, int]) -> np.ndarray:
    """64-bit hashes of all n-grams of the words, repeated ones too; `cache` holds the hashes of words."""
    if len(words) < n:
        return np.zeros(0, np.int64)
    for word in words:
        if word not in cache:
            cache[word] = xxhash.xxh3_64_intdigest(word) - (1 << 63)
    ids = np.fromiter(map(cache.__getitem__, words), np.int64, len(words)).view(np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = (out ^ ids[k : len(words) - n + 1 + k]) * np.uint64(_WEIGHT)
            out ^= out >> np.uint64(32)
    return out.view(np.int64)


#: Pages of a document whose texts are read in one task.
SEGMENT_PAGES = 64
_READ = "key string, seg int, gram bigint, needle_id bigint, head array<string>, tail array<string>"


def fuzzy_presence(needles: DataFrame, haystacks: DataFrame, n: int = 4, threshold: float = 0.6) -> DataFrame:
    """key, needle_id, share, present: whether enough of a needle's n-grams occur in the document of its key.

    `needles` has key, needle_id, text; `haystacks` has key, text, page_num, order_index and block_id: the texts of a key
    in this order are one document, so grams reach over the borders of blocks. Only documents with needles are read, by
    segments of pages; what crosses a segment is made from the words at its ends. The grams, as 64-bit hashes, meet those
    of the needles in a join of checked size. Needles under n words are looked for as substrings of the document; empty
    ones are absent.
    """
    asked = needles.select("key", F.col("needle_id").cast("bigint").alias("needle_id"), T.compare_form(F.col("text")).alias("form")).withColumn("w", F.filter(F.split("form", " "), lambda w: w != ""))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, int] = {}
        for batch in batches:
            keys, ids, grams = [], [], []
            for key, needle, form in zip(*(c.to_pylist() for c in batch.columns)):
                found = np.unique(gram_hashes(form.split(" "), n, cache)).tolist()
                keys += [key] * len(found)
                ids += [needle] * len(found)
                grams += found
            cache = cache if len(cache) < 300_000 else {}
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ids, pa.int64()), pa.array(grams, pa.int64())], ["key", "needle_id", "gram"])

    long = cut(asked.where(F.size("w") >= n).select("key", "needle_id", "form").mapInArrow(spread, "key string, needle_id bigint, gram bigint"))
    short = asked.where((F.size("w") < n) & (F.size("w") > 0)).groupBy("key").agg(F.collect_list(F.struct("needle_id", "form")).alias("short"))
    with_needles = asked.where(F.size("w") > 0).select("key").distinct().join(short, "key", "left")
    near = bounded(cut(with_needles), haystacks.where(F.length("text") > 0).select("key", "page_num", "order_index", "block_id", T.compare_form(F.col("text")).alias("form")), ["key"])
    near = near.withColumn("seg", F.floor(F.coalesce("page_num", F.lit(0)) / SEGMENT_PAGES).cast("int"))
    read = cut(near.groupBy("key", "seg").applyInArrow(lambda t: _read_segment(t, n), _READ))
    ends = read.where("head is not null").select("key", "seg", "head", "tail").join(cut(with_needles), "key")
    across = ends.groupBy("key").applyInArrow(lambda t: _read_borders(t, n), "key string, gram bigint, needle_id bigint")
    grams = read.where("gram is not null").select("key", "gram").unionByName(across.where("gram is not null").select("key", "gram"))
    known = bounded(long.select("key", "gram").distinct(), grams, ["key", "gram"]).distinct()
    hits = long.join(known, ["key", "gram"], "left_semi").groupBy("key", "needle_id").agg(F.count("*").alias("hit"))
    sizes = long.groupBy("key", "needle_id").agg(F.count("*").alias("of"))
    scored = sizes.join(hits, ["key", "needle_id"], "left").select("key", "needle_id", (F.coalesce("hit", F.lit(0)) / F.col("of")).alias("share"))
    held = read.where("needle_id is not null").select("key", "needle_id").unionByName(across.where("needle_id is not null").select("key", "needle_id")).distinct()
    looked = asked.where((F.size("w") < n) & (F.size("w") > 0)).select("key", "needle_id").join(held.withColumn("__hit", F.lit(1.0)), ["key", "needle_id"], "left").select("key", "needle_id", F.coalesce("__hit", F.lit(0.0)).alias("share"))
    none = asked.where(F.size("w") == 0).select("key", "needle_id", F.lit(0.0).alias("share"))
    return scored.unionByName(looked).unionByName(none).withColumn("present", F.col("share") >= threshold)


def _read_segment(table: pa.Table, n: int) -> pa.Table:
    """One segment's distinct grams, the short needles its text holds, and the words at its ends."""
    rows = sorted(table.to_pylist(), key=lambda r: tuple((v is not None, v or 0) for v in (r["page_num"], r["order_index"], r["block_id"])))
    words = [w for r in rows for w in r["form"].split(" ") if w]
    key, seg, body = rows[0]["key"], rows[0]["seg"], " ".join(words)
    held = [s["needle_id"] for s in rows[0]["short"] or () if s["form"] in body]
    grams = np.unique(gram_hashes(words, n, {}))
    size = len(grams) + len(held) + 1
    return pa.table({
        "key": pa.array([key] * size, pa.string()), "seg": pa.array([seg] * size, pa.int32()), "gram": pa.array([*grams.tolist(), *[None] * (len(held) + 1)], pa.int64()),
        "needle_id": pa.array([*[None] * len(grams), *held, None], pa.int64()), "head": pa.array([None] * (size - 1) + [words[: n - 1]], pa.list_(pa.string())),
        "tail": pa.array([None] * (size - 1) + [words[-(n - 1) :] if n > 1 else []], pa.list_(pa.string())),
    })


def _read_borders(table: pa.Table, n: int) -> pa.Table:
    """The grams and short needles that cross from one segment of a document into the next ones."""
    rows = sorted(table.to_pylist(), key=lambda r: r["seg"])
    before: list[str] = []
    grams: set[int] = set()
    held: set[int] = set()
    for r in rows:
        words = before + r["head"]
        grams.update(gram_hashes(words, n, {}).tolist())
        body = " ".join(words)
        held.update(s["needle_id"] for s in r["short"] or () if s["form"] in body)
        # A segment of fewer words than a gram lets grams reach over it.
        before = (before + r["tail"] if len(r["head"]) < n - 1 else r["tail"])[-(n - 1) :] if n > 1 else []
    size = len(grams) + len(held)
    return pa.table({"key": pa.array([rows[0]["key"]] * size, pa.string()), "gram": pa.array([*grams, *[None] * len(held)], pa.int64()), "needle_id": pa.array([*[None] * len(grams), *held], pa.int64())})


def list_recall(needles: DataFrame, haystacks: DataFrame) -> DataFrame:
    """key, n_named, n_found, recall: how many of the named items of a key (outcomes, arms, interventions; key, text)
    its document mentions. Blank items count as named and are never found, as in the rule this follows."""
    numbered = needles.withColumn("needle_id", F.monotonically_increasing_id())
    found = fuzzy_presence(cut(numbered.select("key", "needle_id", "text")), haystacks)
    return found.groupBy("key").agg(F.count("*").alias("n_named"), F.count_if("present").alias("n_found"), F.avg(F.col("present").cast("double")).alias("recall"))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two word sets: 1 if both are empty, 0 if one is."""
    both, union = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when(union == 0, 0.0).otherwise(both / union)


#: Pairs of texts of one key that are compared outright.
PAIRS = 40_000


def similarities(left: DataFrame, right: DataFrame, least: float, words=None) -> DataFrame:
    """key, left_id, right_id, score of the pairs of one key with a score of at least `least`, which is above 0; texts in
    (key, id, text). Scores are exact. Texts without words have no pairs.

    Of keys with at most PAIRS pairs every pair is compared, in one join by key; the pairs of a key are counted for this.
    The texts of larger keys meet by prefix filter. All joins sort and shuffle: the word sets are many times larger than
    what the optimizer takes from the size of the files, by which it would broadcast them.
    """
    words = words or (lambda c: T.word_set(T.match_form(c)))
    count = lambda frame, name: frame.groupBy("key").agg(F.count("*").alias(name))
    large = cut(_met(count(left, "n"), count(right, "m"), ["key"]).where(F.col("n") * F.col("m") > PAIRS).select("key"))
    if large.isEmpty():
        return _paired(left, right, least, words)
    rest, many = ([bounded(large, frame, ["key"], how=how) for frame in (left, right)] for how in ("left_anti", "left_semi"))
    return _paired(*rest, least, words).unionByName(_prefixed(*many, least, words))


def _met(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.hint("merge"), on)


def _paired(left: DataFrame, right: DataFrame, least: float, words) -> DataFrame:
    """similarities() by comparing all pairs of a key."""
    pairs = _met(left.select("key", F.col("id").alias("left_id"), words(F.col("text")).alias("a")), right.select("key", F.col("id").alias("right_id"), words(F.col("text")).alias("b")), ["key"])
    n, m, both = F.size("a"), F.size("b"), F.size(F.array_intersect("a", "b"))
    # Sets of sizes too far apart are not compared; the second bound spares the others the exact score and allows for its
    # rounding. Two sets without words have no score. A filter on one side alone would have its words made twice.
    near = (F.least(n, m) >= F.greatest(n, m) * least - 1e-9) & (both * (1 + least) >= (n + m) * least - 1e-6)
    return pairs.where(near).select("key", "left_id", "right_id", F.try_divide(both, n + m - both).alias("score")).where(F.col("score") >= least)


def _prefixed(left: DataFrame, right: DataFrame, least: float, words) -> DataFrame:
    """similarities() without comparing all pairs of a key.

    Equal word sets (by 128 bits of hash) are one class on either side, and classes meet by prefix filter: with the words of a set ordered
    from rare to frequent in its key, two sets as similar as asked share one of the first n - ceil(least * n) + 1 words
    of each. Frequent words therefore make no candidates; scores are exact. Pairs are between class representatives,
    given back to the members at the end, so copies cost no comparison.
    """

    def bags(frame: DataFrame) -> DataFrame:
        # Empty sets make no words below; a filter on them would move before the choice of keys and make the words of all texts.
        return frame.select("key", "id", F.array_sort(words(F.col("text"))).alias("bag")).withColumn("class", F.struct(F.xxhash64("bag").alias("a"), F.xxhash64(F.lit(7), "bag").alias("b")))

    one, two = bags(left), bags(right)
    sets = {name: frame.groupBy("key", "class").agg(F.min("bag").alias("bag")) for name, frame in (("left", one), ("right", two))}
    spread = {name: frame.select("key", "class", F.size("bag").alias("n"), F.explode("bag").alias("word")) for name, frame in sets.items()}
    often = spread["left"].unionByName(spread["right"]).groupBy("key", "word").agg(F.count("*").alias("df"))

    def prefix(name: str) -> DataFrame:
        ranked = _met(spread[name], often, ["key", "word"]).groupBy("key", "class", "n").agg(F.array_sort(F.collect_list(F.struct("df", "word"))).alias("w"))
        kept = F.slice("w", F.lit(1), (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int"))
        return ranked.select("key", F.col("class").alias(name), F.explode(kept["word"]).alias("word"))

    pairs = _met(prefix("left"), prefix("right"), ["key", "word"]).select("key", "left", "right").distinct()
    full = _met(_met(pairs, sets["left"].toDF("key", "left", "a"), ["key", "left"]), sets["right"].toDF("key", "right", "b"), ["key", "right"])
    scored = full.select("key", "left", "right", jaccard(F.col("a"), F.col("b")).alias("score")).where(F.col("score") >= least)
    members = lambda frame, name: frame.select("key", F.col("class").alias(name), F.col("id").alias(f"{name}_id"))
    return _met(_met(scored, members(one, "left"), ["key", "left"]), members(two, "right"), ["key", "right"]).select("key", "left_id", "right_id", "score")


def shingles(text: Column, n: int = 5) -> Column:
    """Distinct hashes of the runs of n words; a shorter text is one run, one without words has none."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    at = F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1)))
    return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(F.array_distinct(F.transform(at, lambda i: F.xxhash64(F.array_join(F.slice(words, i, n), " ")))))


def near_duplicates(texts: DataFrame, key: str, text: str = "text", least: float = 0.8, n: int = 5) -> DataFrame:
    """`key`, class_id, n_links: of every text with words its class and to how many other classes it is linked.

    Texts of equal shingle sets (runs of n words) are one class, named by its least key; classes are linked when their
    sets are similar by `least`. Candidates come from prefix filters over rare shingles, so frequent ones make none; the
    similarity is exact, and copies are never paired.
    """
    sets = texts.select(F.col(key), F.array_sort(shingles(F.col(text), n)).alias("bag")).where(F.size("bag") > 0)
    hashed = cut(sets.select(key, "bag", F.struct(F.xxhash64("bag").alias("a"), F.xxhash64(F.lit(7), "bag").alias("b")).alias("h")))
    classes = cut(hashed.groupBy("h").agg(F.min(key).alias("class_id"), F.first("bag").alias("bag")))
    spread = classes.select("class_id", F.size("bag").alias("n"), F.explode("bag").alias("s"))
    often = spread.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    # Shingles of one class only can link nothing, but they fill the prefix; so their number is kept beside the others.
    ranked = spread.join(often, "s").groupBy("class_id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("w"))
    lone = F.col("n") - F.size("w")
    kept = ranked.withColumn("take", (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1 - lone).cast("int")).where("take > 0")
    prefix = kept.select("class_id", "n", F.explode(F.slice("w", F.lit(1), F.col("take"))["s"]).alias("s"))
    other = prefix.toDF("other", "m", "s")
    fits = (F.col("class_id") < F.col("other")) & (F.least("n", "m") >= F.greatest("n", "m") * least - 1e-9)
    pairs = prefix.join(other, "s").where(fits).select("class_id", "other").distinct()
    full = pairs.join(classes.select("class_id", F.col("bag").alias("x")), "class_id").join(classes.select(F.col("class_id").alias("other"), F.col("bag").alias("y")), "other")
    linked = cut(full.where(jaccard(F.col("x"), F.col("y")) >= least).select("class_id", "other"))
    both = linked.select("class_id").unionByName(linked.select(F.col("other").alias("class_id"))).groupBy("class_id").agg(F.count("*").alias("n_links"))
    named = classes.select("h", "class_id").join(both, "class_id", "left")
    return hashed.select(key, "h").join(named, "h").select(key, "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def best_matches(candidates: DataFrame, pool: DataFrame, least: float = 0.3, words=None) -> DataFrame:
    """key, left_id, right_id, score: the most similar text of the pool for each candidate that has one of at least
    `least`; ties go to the least id."""
    top = F.max_by(F.struct("right_id", "score"), F.struct("score", -F.col("right_id"))).alias("m")
    return similarities(candidates, pool, least, words).groupBy("key", "left_id").agg(top).select("key", "left_id", "m.right_id", "m.score")


def match_classes(best: DataFrame, candidates: DataFrame, pool: DataFrame, threshold: float = 0.5, partial: float = 0.3) -> DataFrame:
    """key, left_id, right_id, class: match, wrong_category, duplicate, partial or false_positive.

    The best partner does not depend on what others took, so the greedy one-to-one walk is a rank per partner: the first
    candidate of a partner takes it, later ones are duplicates. `candidates` and `pool` carry category.
    """
    sure = F.col("score") >= threshold
    rank = F.row_number().over(Window.partitionBy("key", "right_id", sure).orderBy("left_id"))
    joined = (
        candidates.select("key", F.col("id").alias("left_id"), F.col("category").alias("own")).join(best, ["key", "left_id"], "left")
        .join(pool.select("key", F.col("id").alias("right_id"), F.col("category").alias("other")), ["key", "right_id"], "left").withColumn("rank", rank)
    )
    kind = (
        F.when(F.coalesce("score", F.lit(0.0)) < partial, "false_positive").when(~sure, "partial").when(F.col("rank") > 1, "duplicate")
        .when(F.col("own").eqNullSafe(F.col("other")), "match").otherwise("wrong_category")
    )
    return joined.select("key", "left_id", F.when(F.col("score") >= partial, F.col("right_id")).alias("right_id"), kind.alias("class"))


def match_metrics(classes: DataFrame, pool: DataFrame) -> DataFrame:
    """One row: n_extracted, n_gold, n_correct, n_missed, precision, recall, f1, category_accuracy; 0 for empty sides."""
    kinds = ("n_extracted", "n_correct", "n_wrong", "n_gold")
    flag = lambda *on: [F.lit(1 if k in on else 0).alias(k) for k in kinds]
    own = F.when(F.col("class") == "match", 1).otherwise(0), F.when(F.col("class") == "wrong_category", 1).otherwise(0)
    rows = classes.select(F.lit(1).alias("n_extracted"), own[0].alias("n_correct"), own[1].alias("n_wrong"), F.lit(0).alias("n_gold")).unionByName(pool.select(*flag("n_gold")))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    both = rows.agg(*(F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in kinds))
    rated = both.withColumns({"precision": share(F.col("n_correct"), F.col("n_extracted")), "recall": share(F.col("n_correct"), F.col("n_gold"))})
    return rated.select(
        "n_extracted", "n_gold", "n_correct", (F.col("n_gold") - F.col("n_correct") - F.col("n_wrong")).alias("n_missed"), "precision", "recall",
        share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")).alias("f1"), share(F.col("n_correct"), F.col("n_correct") + F.col("n_wrong")).alias("category_accuracy"),
    )


def evidence(claims: DataFrame, texts: DataFrame, prefix: int = 50) -> DataFrame:
    """claim_id, block_id, tier: where a claim is found in its document's texts: verbatim (1), with blanks levelled (2), by
    its first `prefix` characters (3); the first block of the best tier. Blank claims and claims found nowhere have no row.

    Whatever the tier, the levelled text holds the claim's levelled beginning. Both are cut into runs of letters and digits
    and runs of other signs, so a run inside the beginning is a run of the text, and one at its border is part of a run.
    Each beginning is looked up by one run: of its inner words of four letters or more the one in the fewest texts of the
    document, else its longest run, by way of the document's distinct runs that contain it. No pair is lost, and the pairs
    of a run and a text meet in equi joins, never all texts of a document with all claims.
    """
    level = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    runs = lambda c: F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N} ]+"), F.lit(0))
    asked = claims.select("doc_id", "claim_id", F.col("text").alias("claim"), F.substring(level(F.col("text")), 1, prefix).alias("head")).withColumn("w", runs(F.col("head"))).where(F.size("w") > 0)
    near = texts.join(asked.select("doc_id").distinct(), "doc_id", "left_semi")
    spread = near.select("doc_id", "block_id", F.explode(F.array_distinct(runs(level(F.col("text"))))).alias("run"))
    known = spread.groupBy("doc_id", "run").agg(F.count("*").alias("df"))
    # The last run is at the border too, unless the beginning was cut at a blank.
    inside = F.slice("w", F.lit(2), F.greatest(F.size("w") - F.when(F.endswith("head", F.lit(" ")), 1).otherwise(2), F.lit(0)))
    probes = asked.select("doc_id", "claim_id", "w", F.filter(inside, lambda x: x.rlike(r"[\p{L}\p{N}]{4}")).alias("words")).withColumn("exact", F.size("words") > 0)
    rarest = (
        probes.where("exact").select("doc_id", "claim_id", F.explode(F.array_distinct("words")).alias("run"))
        .join(known, ["doc_id", "run"], "left").groupBy("doc_id", "claim_id").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "run")).alias("m"))
        .select("doc_id", "claim_id", "m.run")
    )
    longest = F.array_max(F.transform("w", lambda x: F.struct(x.rlike(r"[\p{L}\p{N}]").alias("word"), F.length(x).alias("n"), x.alias("part"))))["part"]
    parts = probes.where("not exact").select("doc_id", "claim_id", longest.alias("part"))
    # Distinct parts meet the distinct runs of their document, not its texts.
    holders = parts.select("doc_id", "part").distinct().join(known.select("doc_id", "run"), "doc_id").where(F.contains("run", "part"))
    looked = rarest.unionByName(parts.join(holders, ["doc_id", "part"]).select("doc_id", "claim_id", "run"))
    pairs = looked.join(spread, ["doc_id", "run"]).select("doc_id", "claim_id", "block_id").distinct()
    full = pairs.join(asked.select("doc_id", "claim_id", "claim"), ["doc_id", "claim_id"]).join(near.select("doc_id", "block_id", F.col("text").alias("body")), ["doc_id", "block_id"])
    tier = (
        F.when(F.contains("body", "claim"), 1).when(F.contains(level(F.col("body")), level(F.col("claim"))), 2)
        .when((F.length("claim") >= prefix) & F.contains(level(F.col("body")), F.substring(level(F.col("claim")), 1, prefix)), 3)
    )
    return full.withColumn("tier", tier).where("tier is not null").groupBy("claim_id").agg(F.min(F.struct("tier", "block_id")).alias("m")).select("claim_id", "m.block_id", "m.tier")


def missing_references(rows: DataFrame, targets: DataFrame, on: str) -> DataFrame:
    """Rows whose non-null foreign key has no target."""
    return rows.where(F.col(on).isNotNull()).join(targets.select(on).distinct(), on, "left_anti")
