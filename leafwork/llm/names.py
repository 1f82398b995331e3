"""Problem 3: variant spellings of names typed by people, linked to the registry entity they mean.

Trie join: the words of the registered names are sharded into tries; each typed word traverses a trie under its
Levenshtein automaton (adjacent transpositions count once) and so enumerates the registered words within a bounded
distance. Entities that share all longer words are then checked token by token in any order: every typed word must be
matched by a word of the entity, an abbreviation of it, an initial or a nickname. Where all these words are common in the
registry, the whole name must be given or no other entity have them.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.session import bounded, cut, shuffle_partitions

# Legal forms and their spellings once points are dropped.
LEGAL_FORMS = {
    "inc": "inc", "incorporated": "inc", "corp": "corp", "corporation": "corp", "ltd": "ltd", "limited": "ltd", "llc": "llc",
    "gmbh": "gmbh", "spa": "spa", "as": "as", "plc": "plc", "ag": "ag", "sa": "sa", "bv": "bv", "nv": "nv", "co": "co", "company": "co",
}
# Abbreviations that are not the beginning of their word.
ABBREVIATIONS = {
    "dx": "diagnostics", "tx": "therapeutics", "rx": "pharmaceuticals", "ctr": "centre", "center": "centre", "cntr": "centre", "fdn": "foundation",
    "fndn": "foundation", "natl": "national", "intl": "international", "labs": "laboratories", "pharma": "pharmaceuticals", "hosp": "hospital",
    "univ": "university", "inst": "institute", "dept": "department", "pediatric": "paediatric", "anemias": "anaemias", "tumor": "tumour",
}
JOINED = {("bio", "sciences"): "biosciences", ("bio", "logics"): "biologics", ("bio", "pharma"): "biopharma"}
TITLES = {"dr", "prof", "professor", "mr", "mrs", "ms", "miss", "sir", "md", "phd", "mph", "msc", "dphil", "pharmd", "mbbs", "sponsor", "investigator"}
LINKING = {"of", "for", "the", "and", "in", "de"}
# Short forms of given names.
NICKNAMES = {
    "alexander": "alex alec sandy xander sasha", "andrew": "andy drew", "benjamin": "ben benny benji", "charlotte": "lotte lottie charlie",
    "dorothea": "dora thea dorothy dot dottie", "eleanor": "ellie nell nora ella elle", "elizabeth": "liz beth betty lizzie eliza betsy lisa",
    "francis": "frank fran frankie", "gerald": "gerry jerry", "james": "jim jimmy jamie", "johannes": "hans johan jan", "joseph": "joe joey",
    "josephine": "jo josie", "katherine": "kate kathy katie kat kit", "margaret": "maggie meg peggy greta marge", "michael": "mike mick mickey",
    "nathaniel": "nate nat nathan", "patricia": "pat patty trish tricia", "richard": "rick dick rich ricky", "robert": "bob rob bobby bert robbie",
    "susan": "sue susie suzy", "theodore": "ted theo teddy", "victoria": "vicky tori vicki vic", "william": "bill will billy liam",
    "thomas": "tom tommy", "edward": "ed ted eddie ned", "samuel": "sam sammy", "daniel": "dan danny", "christopher": "chris kit",
    "nicholas": "nick", "anthony": "tony", "rebecca": "becky", "jennifer": "jen jenny", "deborah": "deb debbie", "matthew": "matt",
}
_GIVEN: dict[str, list[str]] = defaultdict(list)
for _full, _shorts in NICKNAMES.items():
    for _short in _shorts.split():
        _GIVEN[_short].append(_full)
_OWNER = re.compile(r"[,;(]?\s*\b(?:a|an)?\s*(?:wholly[- ]owned\s+)?(?:subsidiary|affiliate|division|unit|member|part)\s+of\b.*$", re.I)
_DOTTED = re.compile(r"\b(?:[^\W\d_]\.\s?){2,}")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")

#: Names held by one trie at most; larger registries are joined shard by shard, with the same result.
SHARD_NAMES = 100_000


def fold(text: str) -> str:
    """Letters without marks, case folded."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()


def tokens(name: str) -> tuple[list[str], str | None, bool]:
    """(words, legal form, person by title) of a name; owner, place in brackets, titles and linking words are dropped."""
    text = _OWNER.sub("", fold(name))
    text = re.sub(r"\([^)]*\)?", " ", text)
    text = re.sub(r"\ba/s\b", "as", text)
    text = _DOTTED.sub(lambda m: re.sub(r"[.\s]", "", m[0]) + " " if not re.search(r"[^\W\d_]{2}", m[0]) else m[0], text)
    words = _WORD.findall(text)
    title = any(w in TITLES for w in words)
    words = [w for w in words if w not in TITLES and w not in LINKING]
    for i in range(len(words) - 1, 0, -1):
        if (pair := (words[i - 1], words[i])) in JOINED:
            words[i - 1 : i + 1] = [JOINED[pair]]
    legal = next((LEGAL_FORMS[w] for w in reversed(words) if w in LEGAL_FORMS), None)
    kept = [ABBREVIATIONS.get(w, w) for w in words if w not in LEGAL_FORMS]
    return kept, legal, title


class Trie:
    """Words of one shard; `near` runs the Levenshtein automaton of a query word over it."""

    def __init__(self, words: Iterator[str]) -> None:
        self.root: dict = {}
        for word in words:
            node = self.root
            for letter in word:
                node = node.setdefault(letter, {})
            node[""] = word

    def near(self, query: str, most: int) -> dict[str, int]:
        """Words within `most` edits (insert, delete, replace, swap of neighbours), with their distance."""
        found: dict[str, int] = {}
        first = tuple(range(len(query) + 1))
        stack = [(self.root, "", first, None)]
        while stack:
            node, last, row, before = stack.pop()
            for letter, child in node.items():
                if letter == "":
                    if row[-1] <= most:
                        found[child] = row[-1]
                    continue
                state = [row[0] + 1]
                for i, other in enumerate(query, 1):
                    cost = min(state[i - 1] + 1, row[i] + 1, row[i - 1] + (other != letter))
                    if before is not None and i > 1 and other == last and query[i - 2] == letter:
                        cost = min(cost, before[i - 2] + 1)
                    state.append(cost)
                if min(state) <= most or (before is None or min(row) <= most - 1):
                    if min(state) <= most + 1:
                        stack.append((child, letter, tuple(state), row))
        return {w: d for w, d in found.items() if d <= most}


def allowed(word: str) -> int:
    """Edits a word may differ by: none up to 3 letters, one up to 6, two beyond."""
    return 0 if len(word) < 4 else 1 if len(word) < 7 else 2


def initials_of(words: list[str], person: bool) -> str | None:
    """The letters an organisation of more than three words may be written as."""
    return "".join(w[0] for w in words) if not person and len(words) > 3 else None


class Registry:
    """Entities of one shard indexed for linking.

    `rows` are (id, name, words, legal form, person, words that are common in the whole registry, how many of its
    entities have the same initials): what is judged over all names comes with each, so a shard links as the whole would.
    """

    def __init__(self, rows: list[tuple[int, str, list[str], str | None, bool, list[str], int]]) -> None:
        self.entities: list[tuple[int, list[str], str | None, bool]] = []
        self.exact: dict[str, int] = {}
        self.common: set[str] = set()
        self.by_word: dict[str, set[int]] = defaultdict(set)
        self.by_initials: dict[str, int] = {}
        for at, (entity_id, name, words, legal, person, common, alike) in enumerate(sorted(rows)):
            self.exact.setdefault(name, entity_id)
            self.entities.append((entity_id, words, legal, person))
            self.common.update(common)
            for word in words:
                if len(word) > 1:
                    self.by_word[word].add(at)
            if alike == 1 and (letters := initials_of(words, person)):
                self.by_initials[letters] = at
        self.trie = Trie(iter(self.by_word))
        self._near: dict[str, dict[str, int]] = {}

    def near(self, word: str) -> dict[str, int]:
        """Registered words the typed word may stand for, with the cost of each."""
        if (known := self._near.get(word)) is None:
            known = self.trie.near(word, allowed(word))
            for full in _GIVEN.get(word, ()):
                known[full] = 0
            if len(word) > 2:
                for other in self.common:
                    if other.startswith(word) and other != word:
                        known.setdefault(other, 0)
            if len(self._near) > 200_000:
                self._near.clear()
            self._near[word] = known
        return known

    def link(self, name: str) -> tuple[tuple[int, ...], int, int, int] | None:
        """(cost, entity id, entities of that cost, entities with these common words) of the best the name may mean in this shard, or None.

        Costs compare over shards: (0,) for the spelling itself, (1,) for the initials of one entity, (2, edits, words
        missing, 0 if the legal forms agree) for names with a word that is not common, (3, the same) for names of common words
        alone. Of those a whole name means the entity of least cost; a part of a name means one only if no other entity has
        these words, whatever its legal form. The last number tells how many have them, for that to be summed over shards;
        (4,) stands for such entities of another legal form.
        """
        if name in self.exact:
            return (0, 0, 0, 0), self.exact[name], 1, 0
        words, legal, title = tokens(name)
        if not words:
            return None
        if len(words) == 1 and len(words[0]) > 3 and name in (name.upper(), name.lower()) and (at := self.by_initials.get(words[0])) is not None:
            return (1, 0, 0, 0), self.entities[at][0], 1, 0
        nears = [self.near(w) if len(w) > 1 else {} for w in words]
        scored, alike = [], 0
        for at in self._candidates(words, nears):
            entity_id, own, form, person = self.entities[at]
            if title and not person:
                continue
            cost = self._person(words, nears, own) if person else self._organisation(words, nears, own, legal, form)
            if cost is None:
                continue
            rare = any(w in near for w in own if w not in self.common for near in nears)
            alike += not rare
            if person or not (legal and form and legal != form):
                scored.append(((2 if rare else 3, *cost), entity_id))
        if not scored:
            return ((4, 0, 0, 0), 0, 0, alike) if alike else None
        best, entity_id = min(scored)
        part = best[0] == 3 and best[2] > 0
        return best, entity_id, alike if part else sum(cost == best for cost, _ in scored), alike

    def _candidates(self, words: list[str], nears: list[dict[str, int]]) -> Iterator[int]:
        """The entities with a word near each typed word of more than two letters (shorter ones may be initials); of names
        of shorter words, those with a word near one of them. No other entity can be meant."""
        long = [near for word, near in zip(words, nears) if len(word) > 2]
        if not long:
            yield from {at for near in nears for w in near for at in self.by_word.get(w, ())}
            return
        rarest = min(long, key=lambda near: sum(len(self.by_word.get(w, ())) for w in near))
        for at in {at for w in rarest for at in self.by_word.get(w, ())}:
            own = self.entities[at][1]
            if all(near is rarest or any(w in near for w in own) for near in long):
                yield at

    def _organisation(self, words, nears, own: list[str], legal: str | None, form: str | None) -> tuple[int, int, int] | None:
        edits = self._assign(nears, own)
        return None if edits is None else (edits, len(own) - len(words), 0 if legal == form else 1)

    @staticmethod
    def _assign(nears: list[dict[str, int]], own: list[str]) -> int | None:
        """Least edits to match every typed word with a different word of the entity, in any order.

        Words are matched one by one, each by the cheapest path that may move earlier ones to other words, so that long
        names need no search of all orders.
        """
        if len(nears) > len(own):
            return None
        held: list[int | None] = [None] * len(own)
        total = 0
        for i in range(len(nears)):
            cost: list[int | None] = [nears[i].get(w) for w in own]
            come: list[int | None] = [None] * len(own)
            for _ in own:
                moved = False
                for k, j in enumerate(held):
                    if j is None or cost[k] is None:
                        continue
                    for to, word in enumerate(own):
                        if to != k and word in nears[j]:
                            c = cost[k] - nears[j][own[k]] + nears[j][word]
                            if cost[to] is None or c < cost[to]:
                                cost[to], come[to], moved = c, k, True
                if not moved:
                    break
            free = [(c, k) for k, c in enumerate(cost) if c is not None and held[k] is None]
            if not free:
                return None
            c, k = min(free)
            total += c
            while (before := come[k]) is not None:
                held[k], k = held[before], before
            held[k] = i
        return total

    @staticmethod
    def _person(words: list[str], nears: list[dict[str, int]], own: list[str]) -> tuple[int, int, int] | None:
        """A surname must match; given name and initials must not contradict, in whatever order they come."""
        surname, given, initials = own[-1], own[0], [w[0] for w in own[1:-1]]
        best = None
        for k, near in enumerate(nears):
            if surname not in near or len(words[k]) < 2:
                continue
            edits, missing, ok = near[surname], 1 + len(initials), True
            rest = [(w, n) for i, (w, n) in enumerate(zip(words, nears)) if i != k]
            middle = list(initials)
            named = False
            for w, n in rest:
                if len(w) > 2 or given in n:
                    if given in n and not named:
                        named, edits, missing = True, edits + n[given], missing - 1
                    else:
                        ok = False
                else:
                    for letter in w:
                        if not named and letter == given[0]:
                            named, missing = True, missing - 1
                        elif letter in middle:
                            middle.remove(letter)
                            missing -= 1
                        else:
                            ok = False
            if ok and (best is None or (edits, missing) < best[:2]):
                best = (edits, missing, 0)
        return best


def registered(registry: DataFrame) -> DataFrame:
    """sponsor_id, sponsor_name, words, legal, person, common, alike of each entity whose name has words: the input of
    `Registry`, with what is counted over the whole registry (words of more than three letters in over two names; entities
    with the same initials)."""
    schema = "sponsor_id bigint, sponsor_name string, words array<string>, legal string, person boolean, initials string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for entity_id, name, kind in batch.itertuples(index=False, name=None):
                words, legal, _ = tokens(name)
                if words:
                    rows.append((entity_id, name, words, legal, kind == "person", initials_of(words, kind == "person")))
            yield pd.DataFrame(rows, columns=[n.split()[0] for n in schema.split(", ")])

    named = registry.where(F.col("sponsor_name") != "").select(F.col("sponsor_id").cast("bigint"), "sponsor_name", "sponsor_kind").mapInPandas(run, schema)
    each = named.select("sponsor_id", "sponsor_name", F.explode(F.array_distinct("words")).alias("word"))
    common = each.groupBy("word").agg(F.count("*").alias("n")).where((F.col("n") > 2) & (F.length("word") > 3)).select("word")
    has = each.join(common, "word").groupBy("sponsor_id", "sponsor_name").agg(F.collect_set("word").alias("common"))
    alike = named.where("initials is not null").groupBy("initials").agg(F.count("*").alias("alike"))
    joined = named.join(has, ["sponsor_id", "sponsor_name"], "left").join(alike, "initials", "left")
    return joined.select("sponsor_id", "sponsor_name", "words", "legal", "person", F.coalesce("common", F.array().cast("array<string>")).alias("common"), F.coalesce("alike", F.lit(0)).alias("alike"))


_LINK = "typed string, cost array<int>, sponsor_id bigint, n int, alike int"


def link_names(names: DataFrame, registry: DataFrame, name: str = "sponsor") -> DataFrame:
    """`name`, sponsor_id, edits, exact for each distinct non-null name that means a registered entity.

    `registry` has sponsor_id, sponsor_name and sponsor_kind. It is read shard by shard, SHARD_NAMES rows at most, so
    that what is collected and broadcast has a fixed bound; each name meets every shard and keeps the link of least cost;
    a tie between entities, in one shard or over several, gives none. The distinct names are dealt out over all
    partitions. Empty names and names without letters give no row.
    """
    spark = names.sparkSession
    entities = cut(registered(registry))
    shards = -(-entities.count() // SHARD_NAMES) or 1
    distinct = names.where(F.trim(name) != "").select(F.col(name).alias("typed")).distinct().repartition(shuffle_partitions(spark))
    if shards > 1:
        distinct = cut(distinct)
    parts = []
    for shard in range(shards):
        part = entities if shards == 1 else entities.where(F.pmod(F.xxhash64("sponsor_name"), F.lit(shards)) == shard)
        shared = spark.sparkContext.broadcast([tuple(r) for r in part.collect()])

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            known = Registry(shared.value)
            for batch in batches:
                found = [(typed, known.link(typed)) for typed in batch["typed"]]
                yield pd.DataFrame([(typed, list(hit[0]), *hit[1:]) for typed, hit in found if hit], columns=["typed", "cost", "sponsor_id", "n", "alike"])

        parts.append(distinct.mapInPandas(run, _LINK))
    linked = reduce(DataFrame.unionByName, parts)
    if shards > 1:
        least = linked.groupBy("typed").agg(F.min("cost").alias("cost"), F.sum("alike").alias("alike"))
        linked = linked.drop("alike").join(least, ["typed", "cost"]).groupBy("typed", "cost", "alike").agg(F.first("sponsor_id").alias("sponsor_id"), F.sum("n").alias("n"))
    return linked.where("n = 1 and (cost[0] < 3 or cost[2] = 0 or alike = 1)").select(F.col("typed").alias(name), "sponsor_id", F.col("cost")[1].alias("edits"), (F.col("cost")[0] == 0).alias("exact"))


def link_rows(tables: dict[str, tuple[DataFrame, str]], registry: DataFrame, name: str = "sponsor") -> DataFrame:
    """src, row_id, `name`, sponsor_id, edits, exact: every row of the tables whose name is linked.

    The links of the distinct names are written to the checkpoint folder and meet the rows in a join of checked size, in
    which a name with a third of all rows is spread over many tasks.
    """
    rows = None
    for src, (frame, key) in tables.items():
        part = frame.where(F.col(name).isNotNull()).select(F.lit(src).alias("src"), F.col(key).cast("bigint").alias("row_id"), F.col(name))
        rows = part if rows is None else rows.unionByName(part)
    return bounded(cut(link_names(rows, registry, name)), rows, [name], "row_id").select("src", "row_id", name, "sponsor_id", "edits", "exact")


def found_variants(links: DataFrame) -> DataFrame:
    """Rows that mean an entity but spell it otherwise."""
    return links.where(~F.col("exact")).select("src", "row_id", "sponsor_id").distinct()
