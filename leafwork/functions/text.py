"""Scalar text functions as Column expressions; Arrow UDFs only where Spark has no Unicode normalisation."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Quotes, dashes and blanks with their plain forms.
QUOTES = dict.fromkeys("‘’‚‛′", "'") | dict.fromkeys("“”„‟″", '"')
DASHES = dict.fromkeys("‐‑‒–—―−", "-")
# Comparison signs, then English phrases, in the order they are rewritten.
SIGNS = (("≥", ">="), ("≤", "<="), ("≠", "!="), ("⩾", ">="), ("⩽", "<="), ("≧", ">="), ("≦", "<="), ("==", "="))
PHRASES = (
    (r"at\s+least\s+", ">= "), (r"no\s+(?:more|fewer|less)\s+than\s+", "<= "), (r"greater\s+than\s+or\s+equal\s+to\s+", ">= "), (r"less\s+than\s+or\s+equal\s+to\s+", "<= "),
    (r"greater\s+than\s+", "> "), (r"less\s+than\s+", "< "), (r"more\s+than\s+", "> "), (r"up\s+to\s+", "<= "), (r"minimum\s+(?:of\s+)?", ">= "),
    (r"maximum\s+(?:of\s+)?", "<= "), (r"not\s+exceeding\s+", "<= "), (r"exceeding\s+", "> "), (r"below\s+", "< "), (r"above\s+", "> "),
)
# Kinds of list markers in the order they are tried.
LIST_MARKERS = (
    ("paren_lower", r"^\(([a-z])\)\s+"), ("paren_upper", r"^\(([A-Z])\)\s+"), ("paren_num", r"^\((\d{1,3})\)\s+"), ("dot_num", r"^(\d{1,3})\.\s+"),
    ("bare_num", r"^(\d{1,3})\s+[A-Z]"), ("dash_letter", r"^([a-z])\)\s+"), ("dash_letter2", r"^([a-z])\.\s+"), ("bullet", r"^([•‣●◦⁃∙])\s+"),
    ("dash", r"^([‐‑‒–—−\-])\s+"), ("arrow", r"^([→⇒\x{F0D8}])\s+"),
)
# Patterns of references between sections, tables, figures and appendices, for mentions and for the index.
MENTIONS = (r"\bSection\s+\d+(?:\.\d+)*", r"\bTable\s+\d+[A-Za-z]?", r"\bFigure\s+\d+[A-Za-z]?", r"\bAppendix\s+[A-Z](?:\.\d+)*")
INDEXED = (
    ("section", r"\bSection\s+(\d+(?:\.\d+)*)"), ("table", r"\bTable\s+(\d+(?:[-.]\d+)?)"), ("figure", r"\bFigure\s+(\d+(?:[-.]\d+)?)"), ("appendix", r"\bAppendix\s+([A-Z]\d*)"),
)
# Footnote markers inside a text, by kind; group 1 is the marker.
FOOTNOTE_MARKERS = (r"[A-Za-z0-9]([ª²³⁰-⁹])", r"[A-Za-z0-9\)\]]([*†‡§¶])", r"\[(\d{1,3})\]", r"\(([a-z])\)")
LEADING_MARKER = r"^[\(\[]?\s*([a-z]|\d{1,3}|[*†‡§¶])\s*[\)\]\.\:]?\s+"
# Markers a chunk starts with, alone and before its body.
CHUNK_MARKER = r"^\s*(\d+|\([a-z]\)|\([A-Z]\)|[A-Z]\d?|\([ivx]+\))[\.\s]"
MARKER_AND_BODY = r"(?i)^\s*(\d+|\([a-z]\)|\([A-Z]\)|[A-Z]\d*|\([ivx]+\))\s+"
# Spelled-out English numbers.
_ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
NUMBER_WORDS = {w: i for i, w in enumerate(_ONES)} | {w: 20 + 10 * i for i, w in enumerate(_TENS)}
SCALES = {"hundred": 100, "thousand": 1000, "million": 1_000_000}
# Frequent words by language.
FREQUENT_WORDS = {
    "en": "the of and to in is for with that on by be are was at or from as this will not an",
    "de": "der die das und in den von zu mit ist für auf dem des sich nicht ein eine werden wurden bei nach oder als",
    "fr": "le la les de des et en un une du est pour dans que par sur au aux avec ne pas sont été ou",
    "es": "el la los las de y en un una del es para que por con se al no su como fue o según",
}


def _folded(series: pd.Series, change) -> pd.Series:
    return series.map(lambda s: s if s is None or s.isascii() else change(s))


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """NFKC of a text; ASCII texts pass unchanged."""
    return _folded(text, lambda s: unicodedata.normalize("NFKC", s))


@F.pandas_udf(StringType())
def casefold(text: pd.Series) -> pd.Series:
    return text.map(lambda s: s if s is None else s.casefold())


def normalize_text(text: Column) -> Column:
    """NFKC, plain quotes and dashes, plain blanks, runs of blanks and of three or more line ends collapsed, trimmed."""
    table = QUOTES | DASHES
    plain = F.translate(nfkc(text), "".join(table), "".join(table.values()))
    blanks = F.regexp_replace(plain, r"[\x{00A0}\x{2000}-\x{200B}\x{202F}\x{205F}\x{3000}]", " ")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(blanks, r"[ \t]{2,}", " "), r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def casefold_key(text: Column) -> Column:
    """Key for comparison only: the normalised text, case folded."""
    return casefold(normalize_text(text))


def normalize_operators(text: Column, keep_quirk: bool = True) -> Column:
    """Comparison signs and English phrases as >=, <=, !=, > and <.

    With keep_quirk, "no fewer than" and "no less than" become <= as in the original rules; else >=.
    """
    out = reduce(lambda c, s: F.replace(c, F.lit(s[0]), F.lit(s[1])), SIGNS, text)
    phrases = PHRASES if keep_quirk else ((r"no\s+(?:fewer|less)\s+than\s+", ">= "), *PHRASES)
    return reduce(lambda c, p: F.regexp_replace(c, rf"(?i)\b{p[0]}", p[1]), phrases, out)


@F.pandas_udf(StringType())
def number_words(text: pd.Series) -> pd.Series:
    """Spelled-out English numbers as digits ("eighteen" -> "18", "two hundred and five" -> "205")."""
    import re

    word = "|".join(sorted([*NUMBER_WORDS, *SCALES], key=len, reverse=True))
    run = re.compile(rf"\b(?:{word})(?:(?:[\s-]+and)?[\s-]+(?:{word}))*\b", re.I)

    def value(match: re.Match) -> str:
        total = part = 0
        words = [w for w in re.split(r"[\s-]+", match[0].lower()) if w != "and"]
        if words[0] in SCALES:
            return match[0]
        for w in words:
            if w in NUMBER_WORDS:
                part += NUMBER_WORDS[w]
            elif w == "hundred":
                part *= 100
            else:
                total, part = total + part * SCALES[w], 0
        return str(total + part)

    return text.map(lambda s: s if s is None else run.sub(value, s))


def nct_number(text: Column) -> Column:
    """The first registry number, zero-padded to eight digits; null if there is none."""
    digits = F.regexp_extract(text, r"(?i)\bNCT[\s_-]*0*(\d{1,8})(?:[^\dA-Za-z_]|$)", 1)
    return F.when(digits != "", F.concat(F.lit("NCT"), F.lpad(digits, 8, "0")))


def eudract_number(text: Column) -> Column:
    parts = [F.regexp_extract(text, r"\b(\d{4})[\s-]+(\d{6})[\s-]+(\d{2})(?:[^\dA-Za-z_]|$)", i) for i in (1, 2, 3)]
    return F.when(parts[0] != "", F.concat_ws("-", *parts))


def doi(text: Column) -> Column:
    found = F.regexp_extract(text, r"(?i)\b(?:doi[:\s]+)?(10\.\d{4,9}/\S+)", 1)
    return F.when(found != "", found)


def mentions(text: Column) -> Column:
    """References to sections, tables, figures and appendices: distinct, pattern by pattern, first seen first."""
    return F.array_distinct(F.concat(*(F.regexp_extract_all(text, F.lit(f"(?i){p}"), F.lit(0)) for p in MENTIONS)))


def list_marker(text: Column) -> Column:
    """Struct (kind, value) of the marker a text starts with; null if there is none."""
    kinds = [F.when(text.rlike(p), F.struct(F.lit(kind).alias("kind"), F.regexp_extract(text, p, 1).alias("value"))) for kind, p in LIST_MARKERS]
    return F.coalesce(*kinds)


def footnote_markers(text: Column) -> Column:
    """Markers in a text that may point to a footnote: distinct, kind by kind, first seen first."""
    return F.array_distinct(F.concat(*(F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in FOOTNOTE_MARKERS)))


def leading_marker(text: Column) -> Column:
    """The marker a footnote's text starts with; null if there is none."""
    found = F.regexp_extract(F.trim(text), LEADING_MARKER, 1)
    return F.when(found != "", found)


def chunk_marker(text: Column) -> Column:
    """The marker a chunk starts with; null if there is none."""
    found = F.regexp_extract(text, CHUNK_MARKER, 1)
    return F.when(found != "", found)


def marker_and_body(text: Column) -> Column:
    """Struct (marker, body): the leading marker, null if there is none, and the trimmed rest."""
    found = F.regexp_extract(text, MARKER_AND_BODY, 1)
    return F.struct(F.when(found != "", found).alias("marker"), F.regexp_replace(F.regexp_replace(text, MARKER_AND_BODY, ""), r"(?U)^\s+|\s+$", "").alias("body"))


def initials(expansion: Column) -> Column:
    words = F.filter(F.split(F.trim(expansion), r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.upper(F.substring(w, 1, 1))), "")


def initials_match(letters: Column, acronym: Column) -> Column:
    """Whether the letters spell the acronym: equal, containing it, or at least 60 % of it in order."""
    size = F.length(acronym)
    start = F.lit(1)
    hit = lambda k, c: F.when((k <= size) & (F.substring(acronym, k, F.lit(1)) == c), k + 1).otherwise(k)
    matched = F.aggregate(F.filter(F.split(letters, ""), lambda c: c != ""), start, hit) - 1
    return F.when((F.length(letters) == 0) | (size == 0), False).otherwise(F.contains(letters, acronym) | (matched / size >= 0.6))


def compare_form(text: Column) -> Column:
    """Lower case, plain dashes and quotes, single blanks: the form in which texts of two sources are compared."""
    low = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x{2010}-\x{2015}\x{2212}]", "-")
    return F.trim(F.regexp_replace(F.regexp_replace(low, "[‘’“”]", "'"), r"[\s\x{00A0}]+", " "))


def match_form(text: Column) -> Column:
    """Form for token comparison: NFKC, LaTeX commands and braces dropped, signs spelled, single blanks, lower case."""
    rules = ((r"\\geq\b", ">="), (r"\\leq\b", "<="), (r"\\neq\b", "!="), (r"\\mathrm\{([^}]*)\}", "$1"), (r"\\circ\b", "°"), (r"\\[a-zA-Z]+\b", ""), (r"[{}~]", ""))
    out = reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), rules, nfkc(F.coalesce(text, F.lit(""))))
    out = reduce(lambda c, s: F.replace(c, F.lit(s[0]), F.lit(s[1])), (("≥", ">="), ("≤", "<="), ("≠", "!="), ("−", "-")), out)
    return F.lower(F.trim(F.regexp_replace(out, r"\s+", " ")))


def word_set(text: Column) -> Column:
    """Distinct words (letters, digits and underscores of any script)."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}\p{M}_]+"), F.lit(0)))


def text_confidence(text: Column) -> Column:
    """Share of letters and printable ASCII characters; 0 for empty and null texts."""
    kept = F.length(F.regexp_replace(text, r"[^\p{L}\x20-\x7E\t\n\r\x0B\x0C]", ""))
    return F.when(F.length(text) > 0, kept / F.length(text)).otherwise(0.0)


def slug(text: Column, longest: int = 60) -> Column:
    """Letters, digits, points, underscores and hyphens; anything else becomes one underscore."""
    return F.substring(F.regexp_replace(F.trim(text), r"[^A-Za-z0-9._-]+", "_"), 1, longest)


def html_escape(text: Column) -> Column:
    return reduce(lambda c, s: F.replace(c, F.lit(s[0]), F.lit(s[1])), (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "<br>")), text)


def criterion_lines(text: Column, least: int = 25) -> Column:
    """Lines of a free text without bullets, numbers and letters, of at least `least` characters."""
    strip = lambda line: F.regexp_replace(line, r"(?U)^\s+|\s+$", "")
    bare = lambda line: F.regexp_replace(F.regexp_replace(F.regexp_replace(strip(line), r"^[-•*·●∘°]\s*", ""), r"^\d{1,2}[.)]\s*", ""), r"^[A-Za-z][.)]\s*", "")
    lines = F.transform(F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), "\n"), bare)
    return F.filter(lines, lambda line: F.length(line) >= least)


def sentences(text: Column) -> Column:
    """Array of (start, end, text): sentences by rule, offsets from 0 by code point, end exclusive."""
    marked = F.regexp_replace(text, r"([.!?。！？][\"'”’)\]]*)(\s+)(?=[\p{Lu}\p{IsHan}\d\"'“‘(\[])", "$1$2\x1e")
    pieces = F.split(marked, "\x1e")
    empty = F.array().cast("array<struct<start:int,end:int,text:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(state: Column, piece: Column) -> Column:
        at, bare = state["at"], F.regexp_replace(piece, r"^\s+|\s+$", "")
        lead = F.length(piece) - F.length(F.regexp_replace(piece, r"^\s+", ""))
        item = F.struct((at + lead).alias("start"), (at + lead + F.length(bare)).alias("end"), bare.alias("text"))
        return F.struct((at + F.length(piece)).alias("at"), F.when(bare == "", state["out"]).otherwise(F.concat(state["out"], F.array(item))).alias("out"))

    return F.aggregate(pieces, start, step, lambda s: s["out"])


def language(text: Column, characters: int = 500) -> Column:
    """Language of the first characters: script first, then the share of frequent words; "en" if nothing decides."""
    head = F.lower(F.substring(text, 1, characters))
    words = F.split(head, r"[^\p{L}]+")
    count = lambda frequent: F.size(F.filter(words, lambda w: w.isin(*frequent)))
    hits = {lang: count(frequent.split()) for lang, frequent in FREQUENT_WORDS.items()}
    best = F.greatest(*hits.values())
    by_words = F.coalesce(*(F.when((n == best) & (best > 0), F.lit(lang)) for lang, n in hits.items()), F.lit("en"))
    share = lambda script: F.length(F.regexp_replace(head, rf"[^\p{{{script}}}]", "")) * 3 > F.length(F.regexp_replace(head, r"[^\p{L}]", ""))
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "en").when(share("IsHan"), "zh").when(share("IsCyrillic"), "ru").otherwise(by_words)


def quantize_indent(x0: Column, step: int = 12, missing: int = 72) -> Column:
    return F.coalesce((F.bround(x0 / step) * step).cast("int"), F.lit(missing))
