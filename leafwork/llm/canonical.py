"""Problem 4: texts that look the same brought to one form.

The form is computed by DuckDB inside each Arrow partition: one embedded SQL projection of translate, nfc_normalize and
regular expressions. Width, composition, invisible characters, kinds of space and hyphen, ligatures and look-alike
letters are levelled; case, raised digits, accents, signs, words and markup are kept, as they can be seen.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters that are printed like Latin ones, by script, each with the Latin letter (accented ones with theirs).
CYRILLIC_FROM, CYRILLIC_TO = "АВЕЅІЈКМНОРСТУХԌԚԜаеѕіјорсухһԁԛԝҮүЀЁЇѐёїӀӏѴѵӔӕӘә", "ABESIJKMHOPCTYXGQWaesijopcyxhdqwYyÈËÏèëïIlVvÆæƏə"
GREEK_FROM, GREEK_TO = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοϲϳνϹͿό", "ABEZHIKMNOPTYXocjvCJó"
ARMENIAN_FROM, ARMENIAN_TO = "ՍՏՕԼօսոհցզ", "USOLounhgq"
CHEROKEE_FROM, CHEROKEE_TO = "ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃᏀ", "ABCDEHJKLMPRSTVWZG"
LATIN_FROM, LATIN_TO = "ɑɡ", "ag"
# Compatibility letters that are drawn as other letters are (micro, Kelvin, Angstrom and ohm signs).
SAME_FROM, SAME_TO = "\u00b5\u212a\u212b\u2126", "\u03bcK\u00c5\u03a9"
HYPHENS = "\u2010\u2011\ufe63\uff0d"
SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u2800\u3000\t"
INVISIBLE = r"[\x{00AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFA0}\x{FFF9}-\x{FFFB}\x{1D173}-\x{1D17A}\x{E0000}-\x{E0FFF}]"
# Forms of several letters, each with what they are printed like.
SEVERAL = (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"), ("℃", "°C"), ("℉", "°F"), ("№", "No"), ("…", "..."), ("Ǆ", "DŽ"), ("ǆ", "dž"), ("Ǉ", "LJ"), ("ǉ", "lj"), ("Ǌ", "NJ"), ("ǌ", "nj"))
ROMAN = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII", "L", "C", "D", "M")


def _tables() -> list[tuple[str, str, str]]:
    """One-to-one replacements as (class of the characters it starts from, from, to).

    DuckDB's translate builds its map for each row, so the long tables, made by rule, stand apart behind a test of
    whether the text has any of their characters.
    """
    forms = {c: unicodedata.decomposition(chr(c)).split() for c in range(0xFF01, 0xFFEF)}
    wide = {chr(c): chr(int(form[1], 16)) for c, form in forms.items() if form and form[0] in ("<wide>", "<narrow>") and chr(c) not in HYPHENS}
    styled = {chr(start + i): chr(0x41 + i if i < 26 else 0x61 + i - 26) for start in range(0x1D400, 0x1D6A4, 52) for i in range(52)}
    styled |= {chr(0x1D7CE + i): str(i % 10) for i in range(50)}
    pairs = (CYRILLIC_FROM, CYRILLIC_TO), (GREEK_FROM, GREEK_TO), (ARMENIAN_FROM, ARMENIAN_TO), (CHEROKEE_FROM, CHEROKEE_TO), (LATIN_FROM, LATIN_TO), (SAME_FROM, SAME_TO)
    twins = {a: b for one, other in pairs for a, b in zip(one, other, strict=True)} | dict.fromkeys(HYPHENS, "-")
    blanks = dict.fromkeys(SPACES, " ")
    parts = (("[" + SPACES + "]", blanks), ("[\\x{FF01}-\\x{FFEE}]", wide), ("[\\x{1D400}-\\x{1D7FF}]", styled), ("[^\\x00-\\xFF]|" + SAME_FROM[0], twins))
    return [(marks, "".join(table), "".join(table.values())) for marks, table in parts]


def _several() -> tuple[tuple[str, str], ...]:
    upper = tuple((chr(0x2160 + i), r) for i, r in enumerate(ROMAN))
    return SEVERAL + upper + tuple((chr(0x2170 + i), r.lower()) for i, r in enumerate(ROMAN))


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _steps() -> list[str]:
    """Expressions over column t, each applied to the result of the one before.

    Composition comes first, so that a letter with its accent is one character before letters are levelled (an accented
    look-alike keeps its accent); it is repeated at the end, because levelling can make letters composable.
    """
    several = _several()
    marks = _literal("[" + "".join(s for s, _ in several) + "]")
    spelled = "t"
    for source, target in several:
        spelled = f"replace({spelled}, {_literal(source)}, {_literal(target)})"
    steps = [f"nfc_normalize(regexp_replace(t, {_literal(INVISIBLE)}, '', 'g'))"]
    steps += [f"CASE WHEN regexp_matches(t, {_literal(found)}) THEN translate(t, {_literal(a)}, {_literal(b)}) ELSE t END" for found, a, b in _tables()]
    return [*steps, f"CASE WHEN regexp_matches(t, {marks}) THEN {spelled} ELSE t END", "nfc_normalize(t)"]


def _statement() -> str:
    """The projection over the view `batch`, whose text is column t: ASCII texts only have their blanks levelled."""
    source = "SELECT *, t AS original FROM batch WHERE NOT regexp_full_match(t, '[\\x00-\\x7F]*')"
    for step in _steps():
        source = f"SELECT * REPLACE ({step} AS t) FROM ({source})"
    plain = "SELECT * REPLACE (replace(t, chr(9), ' ') AS t), t AS original FROM batch WHERE regexp_full_match(t, '[\\x00-\\x7F]*')"
    ends = "trim(regexp_replace(t, ' *\\r?\\n *', chr(10), 'g'), ' ' || chr(10) || chr(13))"
    return f"SELECT * EXCLUDE (t, original, c), c AS canonical, md5(c) AS look, md5(original) AS raw FROM (SELECT *, {ends} AS c FROM (({source}) UNION ALL ({plain})))"


def _normaliser(columns: list[str]):
    """Function over Arrow batches: runs the statement on each, keeping the columns named."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        statement = _statement()
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            db.register("batch", table)
            yield from db.sql(statement).to_arrow_table().select(columns).to_batches()
            db.unregister("batch")

    return run


def canonical_texts(items: DataFrame, keys: tuple[str, ...], text: str = "text", keep_text: bool = True) -> DataFrame:
    """`keys`, canonical (the one consistent form), look (its MD5) and raw (MD5 of the text as it came).

    A null text has no row; an empty or blank text has the empty form. Repeated rows come out repeated. With keep_text
    false only the digests leave the Python worker.
    """
    slim = items.where(F.col(text).isNotNull()).select(*keys, F.col(text).alias("t"))
    out = [*keys, *(["canonical"] if keep_text else []), "look", "raw"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keys).schema]
    fields += [f"{c} string" for c in out[len(keys) :]]
    return slim.mapInArrow(_normaliser(out), ", ".join(fields))


def look_alikes(gold: DataFrame, others: dict[str, tuple[DataFrame, str]], doc: str = "doc_id", gold_key: str = "gold_id") -> DataFrame:
    """Pairs (src, row_id, gold id) of the same document whose texts look the same but are not the same string.

    `others` names the relations compared with `gold`: src -> (relation, key column). The join is on (document, digest
    of the canonical form), so that one large document is spread over its distinct texts. Texts that are blank in print
    have no pairs.
    """
    left = canonical_texts(gold, (doc, gold_key), keep_text=False).select(F.col(doc).alias("__doc"), gold_key, F.col("look").alias("__look"), F.col("raw").alias("__raw"))
    rows = None
    for src, (frame, key) in others.items():
        part = canonical_texts(frame, (doc, key), keep_text=False).select(F.lit(src).alias("src"), F.col(key).cast("bigint").alias("row_id"), doc, "look", "raw")
        rows = part if rows is None else rows.unionByName(part)
    return (
        rows.join(left, (F.col(doc) == F.col("__doc")) & (F.col("look") == F.col("__look")))
        .where((F.col("raw") != F.col("__raw")) & (F.col("look") != F.md5(F.lit(""))))
        .select("src", "row_id", F.col(gold_key).cast("bigint").alias("gold_id"))
        .distinct()
    )
