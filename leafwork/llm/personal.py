"""Problem 10: personal information inside free text, found and replaced by typed placeholders.

Anchor expansion: one Aho-Corasick automaton finds at-signs, identifier cues, street words, titles, given names and words
that say what a person does in one pass over the text; numbers long enough for a telephone are a second kind of anchor.
Each anchor has a deterministic local parser that expands to the borders of the mention, however far they lie, and
validates it: e-mail addresses need a domain with a top level, telephone numbers one of the written forms, identity
numbers a cue and a number shape, addresses a house number or box, names a title, a cue, a given name or a person's verb.
Parsers that look back match in reverse from the anchor, so that no window cuts a mention off.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "identity", "phone", "address", "name")
PLACEHOLDERS = {"email": "[EMAIL]", "identity": "[ID]", "phone": "[PHONE]", "address": "[ADDRESS]", "name": "[NAME]"}

# Given names that open a name without title or cue.
GIVEN_NAMES = (
    "Alexander Alexandra Alfred Alice Amelia Andrea Andreas Andrew Ann Anna Anne Anthony Antonio Barbara Beatrice Benjamin Bernard Brian Carl Carlos "
    "Carmen Caroline Catherine Charles Charlotte Christian Christina Christopher Clara Claudia Daniel David Deborah Dennis Diana Dorothea Dorothy Douglas "
    "Edward Eleanor Elena Elisabeth Elizabeth Emily Emma Eric Eva Felix Francis Francisco Frank Franz Frederick Gabriel George Gerald Gregory Hannah Hans "
    "Harold Heinrich Helen Helena Henry Ingrid Isabel Jacob Jacques James Jan Jane Janet Jean Jennifer Jessica Joan Johann Johannes John Jonathan Jorge "
    "Jose Joseph Josephine Juan Judith Julia Karen Karl Katharina Katherine Kathleen Kenneth Kevin Klaus Larry Laura Laurent Lawrence Leonard Linda Lisa Louis Lucas "
    "Lucia Luis Manuel Margaret Maria Marie Mark Martin Mary Matthew Michael Michel Miguel Monika Nancy Nathaniel Nicholas Nicole Olivia Oscar Pablo Pamela "
    "Patricia Patrick Paul Peter Philip Pierre Rachel Ralph Raymond Rebecca Richard Robert Roger Ronald Rosa Ruth Samuel Sandra Sarah Scott Sebastian Sharon "
    "Simon Sophia Sophie Stefan Stephanie Stephen Steven Susan Susanne Teresa Theodore Theresa Thomas Timothy Victor Victoria Vincent Virginia Walter William Wolfgang"
).split()
TITLES = (
    "dr.", "dr", "dra.", "dra", "prof.", "prof", "professor", "mr.", "mr", "mrs.", "mrs", "ms.", "ms", "miss", "herr", "herrn", "frau", "madame", "mme", "mme.",
    "monsieur", "mlle", "sr.", "sra.", "sr", "sra", "señor", "señora", "don", "doña", "docteur", "doctor", "господин", "госпожа", "г-н", "г-жа",
)
NAME_CUES = (
    "signed by", "countersigned:", "countersigned by", "next of kin:", "next of kin", "emergency contact:", "in error for", "participant,", "participant",
    "the patient,", "patient,", "patient", "participante", "paciente", "patientin", "der patient", "patiente", "witnessed by", "guardian:", "attn:", "signé par", "firmado por",
    "unterschrieben von", "пациент", "пациентка", "подписал", "подписала",
)
# What follows the name of a person, by language.
PERSON_VERBS = (
    " lives at ", " lives in ", " resides at ", " resides in ", " called ", " telephoned ", " phoned ", " rang ", " emailed ", " e-mailed ", " wrote to ", " can be reached ", " may be reached ",
    " was born ", " wohnt ", " rief an", " ist erreichbar ", " habite ", " a téléphoné", " a appelé", " est joignable ", " vive en ", " llamó ", " telefoneó ", " проживает ", " позвонил", " позвонила",
)
ID_CUES = (
    "ssn", "social security number", "social security no.", "passport", "passport number", "passport no.", "national health number", "nhs number",
    "national insurance number", "identity number", "identity card", "id number", "driver's licence", "ausweisnummer", "personalausweisnummer", "reisepassnummer",
    "reisepass", "passnummer", "numéro d'identité", "numéro d’identité", "numéro de passeport", "passeport", "sécurité sociale", "número de identidad", "pasaporte", "dni",
    "护照号码", "护照号", "护照", "身份证号码", "身份证号", "身份证", "паспорт", "снилс",
)
NOT_PHONES = regex.compile(
    r"(?:\b(?:lot|batch|kit|cohort|version|specimen|reference|ref|range|protocol|trial|site|invoice|order|sample|study|serial|charge|cohorte|lote|"
    r"registry|reg|nct|eudract|doi|isbn|passport|ssn|identit[yé]|identidad|ausweisnummer|health|insurance|security)\b\.?[ ]*(?:number|no|nr|nummer|numéro|número)?\.?[ ]*[:#]?[ ]*|护照号?)",
    regex.I | regex.REVERSE,
)
# Where a telephone number may begin: an opener that no letter, digit or sign precedes, and eight more digits close by.
PHONE_START = regex.compile(r"(?<![A-Za-z0-9+\-./@_#$€£])(?<!\d (?=\d))[+(\d](?=(?:[^\d\n]{0,4}\d){8})")
PHONE_FORMS = tuple(
    regex.compile(p)
    for p in (
        r"\+\d{1,3}[ .\-]?(?:\(0\)[ .\-]?|\(\d{1,4}\)[ .\-]?)?\d(?:[ .\-/]?\d){5,12}(?!\d)",
        r"00[1-9]\d{0,2}[ .\-](?:\(0\)[ .\-]?)?\d(?:[ .\-/]?\d){5,11}(?!\d)",
        r"\(\d{3}\)[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)",
        r"\(0\d{1,4}\)[ .\-/]?\d(?:[ .\-]?\d){4,8}(?!\d)",
        r"(?:1[\-. ])?[2-9]\d{2}([\-. ])\d{3}[\-. ]?\d{4}(?![\d\-])",
        r"0\d{3,4}[ \-]\d{3}[ \-]?\d{3}(?![\d\-])",
        r"0\d(?:[ .\-]\d{2}){4}(?!\d)",
        r"0\d{2,4}[ /\-]\d{4,8}(?:[ \-]\d{1,4})?(?!\d)",
        r"8[ \-]?\(?\d{3}\)?[ \-]?\d{3}[ \-]?\d{2}[ \-]?\d{2}(?!\d)",
        r"1[3-9]\d{9}(?!\d)",
    )
)
_LOCAL = regex.compile(r"(?P<at>[\p{Latin}0-9](?:[\p{Latin}\p{M}0-9._%+\-]*[\p{Latin}\p{M}0-9_+\-])?)[ ]?", regex.REVERSE)
_LABEL = r"[\p{Latin}0-9](?:[\p{Latin}\p{M}0-9\-]*[\p{Latin}\p{M}0-9])?"
_DOT = r"(?:\.|[ ]?[\[(](?:dot|\.)[\])][ ]?|[ ]dot[ ])"
_DOMAIN = regex.compile(rf"[ ]?{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}\p{{Latin}}{{2,24}}(?![\p{{Latin}}0-9])")
_ID = regex.compile(
    r"(?:[\s:#=(（：]|no\.?|nr\.?|n°|number|nummer|is\b|lautet|es\b|est\b|为|是){0,4}"
    r"(?P<id>[A-Z]{1,3}[ \-]?\d{6,9}(?!\d)|\d{3}[ \-.]?\d{2}[ \-.]?\d{4}(?!\d)|\d{3}[ \-.]?\d{3}[ \-.]?\d{4}(?!\d)|\d{17}[\dXx](?!\d)|\d{2}[ ]?\d{2}[ ]?\d{6}(?!\d))",
    regex.I,
)

_UP = r"\p{Lu}[\p{L}'’]+(?:-\p{Lu}[\p{L}'’]+)*"
_NOT_NAMES = (
    "Street|St|Avenue|Ave|Road|Rd|Lane|Drive|Court|Close|House|Clinic|Hospital|University|Centre|Center|Institute|Foundation|Memorial|Laboratories|Oncology|Index|Scale|Score|"
    "Test|Method|Criteria|Day|Week|Month|Visit|The|This|That|And|For|With|On|In|At|To|By|Of|A|An|Adverse|Study|Protocol|Sponsor|Investigator|Participants?|Patients?"
)
_FULL = regex.compile(
    rf"(?!(?:{_NOT_NAMES})\b)(?:(?:\p{{Lu}}\.[ ]?)+{_UP}|{_UP},[ ](?:{_UP}|\p{{Lu}}\.)(?:[ ]\p{{Lu}}\.)*(?![ ]\p{{Lu}}[\p{{L}}'’])|{_UP}(?:[ ]\p{{Lu}}\.)*(?:[ ](?!(?:{_NOT_NAMES})\b)(?:von[ ]|van[ ]|de[ ]|der[ ])?{_UP})?)"
)
_NOT_PERSONS = (
    f"{_NOT_NAMES}|Committee|Board|Council|Group|Team|Office|Department|Ministry|Agency|Authority|Company|Corporation|Ltd|Inc|GmbH|LLC|Pharma|Pharmaceuticals|Therapeutics|Biosciences|Diagnostics|"
    "Biologics|Trials?|Unit|Nurse|Physician|Monitor|Coordinator|Pharmacist|Manager|Director|Officer|Network|Association|Society|Service|Services|Medical|Clinical|Data|Ethics|Safety|Review|Version|Section|Table|Part"
)
_AFTER_TITLE = regex.compile(rf"[ ](?:(?:Dr|Prof|Med|Dra)\.?[ ](?:med\.[ ])?)*(?P<name>(?:\p{{Lu}}\.[ ]?)*(?!(?:{_NOT_NAMES})\b){_UP}(?:[ ]\p{{Lu}}\.)*(?:[ ](?!(?:{_NOT_NAMES})\b){_UP})?)")
_AFTER_CUE = regex.compile(r"[ \n]{0,2}(?:(?:the|la|le|el|die|der|den)[ ])?(?:(?:Mrs?|Ms|Dra?|Prof|Sra?|Herrn?|Frau|Madame|Mme|Monsieur)\.?[ ])*(?P<at>)")
_AFTER_GIVEN = regex.compile(rf"(?:[ ]\p{{Lu}}\.)*[ ](?!(?:{_NOT_NAMES})\b)(?:von[ ]|van[ ])?{_UP}")
_SURNAME_BEFORE = regex.compile(rf"(?<![\p{{L}}\-])(?P<surname>(?!(?:{_NOT_NAMES})\b){_UP}),[ ]", regex.REVERSE)
_PERSON = rf"(?!(?:{_NOT_PERSONS})\b){_UP}"
_NAME_BEFORE = regex.compile(rf"(?<![\p{{L}}\d\-.'’])(?<!\b(?:[Tt]he|[Aa]n?)[ ])(?<!\p{{Lu}}[\p{{L}}'’\-]*[ ])(?P<name>{_PERSON}(?:[ ]\p{{Lu}}\.)*(?:[ ]{_PERSON})?[ ](?:von[ ]|van[ ]|de[ ]|der[ ])?{_PERSON})", regex.REVERSE)
_INITIAL_START = regex.compile(r"(?:^|[\n(]|[.!?:;][ \n]+|\bday[ ]\d{1,4}[ ]|\b(?:and|und|et|y)[ ])", regex.REVERSE)
_INITIALS = regex.compile(rf"(?:\p{{Lu}}\.[ ]?)*(?!(?:{_NOT_NAMES})\b){_UP}(?=[ ]?(?:\(|,|;|[\p{{Ll}}]))")
_MORE_INITIALS = regex.compile(r"(?:[ ]\p{Lu}\.)*(?![ ]?\p{Lu}[\p{L}'’])")

_UNIT = r"(?:(?:Apt|Apartment|Flat|Unit|Suite|Room)\.?[ ]\d+[A-Za-z]?,?[ ])"
_EN_BEFORE = regex.compile(rf"(?<![\p{{L}}\d]){_UNIT}?\d{{1,5}}[A-Za-z]?,?[ ](?:\p{{Lu}}[\p{{L}}'’\-]+[ ]){{1,3}}", regex.REVERSE)
_FR_BEFORE = regex.compile(r"(?<![\p{L}\d])\d{1,4}(?:[ ]?(?:bis|ter|quater|[A-Z])\b)?,?[ ]", regex.I | regex.REVERSE)
_FR_AFTER = regex.compile(r"(?:d[eu]s?[ ]|de[ ]la[ ]|de[ ]l['’]|d['’])?\p{Lu}[\p{L}'’\-]+(?:[ ]\p{Lu}[\p{L}'’\-]+)*")
_DE_BEFORE = regex.compile(r"(?<![\p{L}\d])\p{Lu}[\p{L}\-.]*", regex.REVERSE)
_DE_AFTER = regex.compile(r"[ ]\d{1,4}[ ]?[a-z]?(?![\p{L}\d])")
_ES_AFTER = regex.compile(r"(?:de[ ](?:la[ ]|los[ ]|las[ ])?|del[ ])?\p{Lu}[\p{L}'’\-]+(?:[ ]\p{Lu}[\p{L}'’\-]+)*,?[ ](?:n\.?º[ ]?)?\d{1,4}")
_ZH_BEFORE = regex.compile(r"(?:寄至|寄往|寄到|送至|住址为|住址是|地址为|地址是|地址：|住址：|住在|居住于|居住在|位于|搬至|迁至)(?P<at>\p{Han}{1,14})", regex.REVERSE)
_ZH_AFTER = regex.compile(r"\d{1,5}(?:号|弄)(?:\d{1,5}(?:单元|栋|幢|楼|层|室))*")
_RU_AFTER = regex.compile(r"[ ]?\p{Lu}[\p{L}\-]+,?[ ](?:д\.[ ]?)?\d{1,4}")
_BOX = regex.compile(r"[ ]?\d{1,6}(?!\d)")
_FLAT_AFTER = regex.compile(r"\d+[A-Za-z]?,[ ](?:\d{1,5}[A-Za-z]?[ ])?\p{Lu}[\p{L}'’\-]+[ ](?:House|Court|Lodge|Building|Tower|Mansions|Hall|Street|St|Avenue|Ave|Road|Rd|Lane|Drive|Close|Blvd|Way|Place)\b")

_PLACE = regex.compile(
    r"(?:,[ ]\d{1,2}\.?º[ ]?[A-Z]?)?,[ ](?:(?:[A-Z]{1,2}-)?\d{4,6}[ ]\p{Lu}[\p{L}'’\-]+|\p{Lu}[\p{L}'’\-]+(?:[ ]\d{4,6})?(?!\d))"
)

# Street words by the place of the name and number: English after both, French between, German joined, Spanish before.
STREETS = {
    "english": ("street", "st.", "st,", "avenue", "ave.", "ave,", "road", "rd", "lane", "drive", "court", "close", "blvd", "boulevard", "way", "terrace", "crescent", "square", "place", "grove", "gardens", "walk", "mews", "parade", "trail", "circle", "parkway", "highway", "heights", "row"),
    "french": ("rue ", "avenue ", "place ", "boulevard ", "chemin ", "allée ", "quai ", "impasse ", "cours ", "square "),
    "german": ("straße", "strasse", "str.", "allee", "weg", "platz", "gasse", "ring", "damm", "ufer"),
    "spanish": ("calle ", "avda. ", "avenida ", "plaza ", "paseo ", "c/ ", "camino "),
    "chinese": ("路", "街", "大道", "巷", "胡同"),
    "russian": ("ул.", "улица", "проспект", "пр-т"),
}

_automaton = None


def _anchors():
    """The automaton over lower-case text; each word carries its (role, length) pairs."""
    global _automaton
    if _automaton is None:
        import ahocorasick

        words: dict[str, set[str]] = {}

        def add(role: str, *texts: str) -> None:
            for text in texts:
                words.setdefault(text, set()).add(role)

        add("at", "@", "(at)", "[at]", "{at}", " at ")
        add("identity", *ID_CUES)
        add("title", *(f"{t}" for t in TITLES))
        add("cue", *NAME_CUES)
        add("given", *(n.lower() for n in GIVEN_NAMES))
        add("does", *PERSON_VERBS)
        add("initial", *(f"{chr(c)}. " for c in range(97, 123)))
        add("box", "po box", "p.o. box", "postfach", "apartado", "boîte postale")
        add("flat", "flat ", "apt ", "apartment ")
        for language, streets in STREETS.items():
            add(language, *streets)
        _automaton = ahocorasick.Automaton()
        for word, roles in words.items():
            _automaton.add_word(word, (word, tuple(sorted(roles))))
        _automaton.make_automaton()
    return _automaton


def _lower(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _email(text: str, start: int, end: int) -> tuple[int, int] | None:
    before = _LOCAL.match(text, 0, start)
    after = _DOMAIN.match(text, end)
    if not before or not after:
        return None
    if text[start:end].strip() == "at" and "dot" not in after[0]:
        return None
    return before.start("at"), after.end()


def _phone(text: str, start: int) -> tuple[int, int] | None:
    for form in PHONE_FORMS:
        if m := form.match(text, start):
            digits = sum(c.isdigit() for c in m[0])
            if 9 <= digits <= 15 and not NOT_PHONES.match(text, 0, start) and not regex.match(r"[\-./]?\d|[ ]?%", text[m.end() : m.end() + 2]):
                return m.span()
    return None


def _address(text: str, role: str, start: int, end: int) -> tuple[int, int] | None:
    if role == "english":
        if end < len(text) and text[end - 1].isalpha() and text[end].isalpha():
            return None
        m = _EN_BEFORE.match(text, 0, start)
        return (m.start(), end) if m and text[start].isupper() else None
    if role == "french":
        m = _FR_BEFORE.match(text, 0, start)
        n = _FR_AFTER.match(text, end)
        return (m.start(), n.end()) if m and n else None
    if role == "german":
        m, n = _DE_BEFORE.match(text, 0, start) or (regex.match("", text, pos=start) if text[start].isupper() else None), _DE_AFTER.match(text, end)
        return (m.start(), n.end()) if m and n else None
    if role == "spanish":
        if start and text[start - 1].isalpha():
            return None
        n = _ES_AFTER.match(text, end)
        return (start, n.end()) if n else None
    if role == "chinese":
        n = _ZH_AFTER.match(text, end)
        if not n:
            return None
        m = _ZH_BEFORE.match(text, 0, start)
        return (m.start("at") if m else max(0, start - 2), n.end())
    if role == "russian":
        n = _RU_AFTER.match(text, end)
        return (start, n.end()) if n and not (start and text[start - 1].isalpha()) else None
    if role == "box":
        n = _BOX.match(text, end)
        return (start, n.end()) if n and not (start and text[start - 1].isalpha()) else None
    n = _FLAT_AFTER.match(text, end)
    return (start, n.end()) if n and not (start and text[start - 1].isalnum()) else None


def _name_at(text: str, start: int) -> tuple[int, int] | None:
    m = _FULL.match(text, start)
    return m.span() if m else None


def _name(text: str, role: str, start: int, end: int) -> tuple[int, int] | None:
    if role == "does":
        m = _NAME_BEFORE.match(text, 0, start)
        return m.span("name") if m else None
    if start and text[start - 1].isalpha():
        return None
    if role == "title":
        if not text[start].isupper() and text[start:end] not in ("señor", "señora", "don", "doña", "madame", "monsieur", "docteur", "doctor"):
            return None
        m = _AFTER_TITLE.match(text, end)
        return m.span("name") if m else None
    if role != "initial" and end < len(text) and text[end - 1].isalpha() and text[end].isalpha():
        return None
    if role == "cue":
        m = _AFTER_CUE.match(text, end)
        found = _name_at(text, m.end()) if m else None
        if not found:
            return None
        words = text[found[0] : found[1]].split()
        single = len(words) == 1 and text[start:end].rstrip(":,").lower() not in ("signed by", "countersigned", "next of kin", "witnessed by", "in error for")
        return None if single else found
    if role == "initial":
        if not text[start].isupper() or not _INITIAL_START.match(text, 0, start):
            return None
        m = _INITIALS.match(text, end)
        return (start, m.end()) if m else None
    word = text[start:end]
    if not (word.istitle() or word.isupper()):
        return None
    if m := _AFTER_GIVEN.match(text, end):
        return start, m.end()
    before = _SURNAME_BEFORE.match(text, 0, start)
    if before and (after := _MORE_INITIALS.match(text, end)):
        return before.start("surname"), after.end()
    if end < len(text) and text[end] == "-" and (m := regex.compile(rf"-{_UP}[ ]{_UP}").match(text, end)):
        return start, m.end()
    return None


def find_mentions(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every mention, in order and without overlap; offsets count code points."""
    if not text:
        return []
    spans: set[tuple[int, int, int]] = set()
    for m in PHONE_START.finditer(text):
        if span := _phone(text, m.start()):
            spans.add((KINDS.index("phone"), span[0], -span[1]))
    for last, (word, roles) in _anchors().iter(_lower(text)):
        end = last + 1
        start = end - len(word)
        for role in roles:
            if role == "at":
                kind, span = "email", _email(text, start, end)
            elif role == "identity":
                kind, span = "identity", None
                if not (start and text[start - 1].isalpha() and text[start - 1].isascii()) and (m := _ID.match(text, end)):
                    span = m.span("id")
            elif role in ("title", "cue", "given", "initial", "does"):
                kind, span = "name", _name(text, role, start, end)
            else:
                kind, span = "address", _address(text, role, start, end)
                if span and (m := _PLACE.match(text, span[1])):
                    span = span[0], m.end()
            if span:
                spans.add((KINDS.index(kind), span[0], -span[1]))
    # Kinds in their order, each mention held against its neighbours among those taken, which do not overlap.
    out: list[tuple[int, int, str]] = []
    for rank, start, back in sorted(spans):
        kind, end = KINDS[rank], -back
        low = high = bisect_left(out, (start, start, ""))
        if low and out[low - 1][1] > start:
            low -= 1
        while high < len(out) and out[high][0] < end:
            high += 1
        if all(o[2] == kind for o in out[low:high]):
            merged = min([start, *(o[0] for o in out[low:high])]), max([end, *(o[1] for o in out[low:high])]), kind
            del out[low:high]
            insort(out, merged)
    return out


def redact(text: str | None, found: list[tuple[int, int, str]] | None = None) -> str | None:
    """The text with each mention replaced by its placeholder; the rest is unchanged."""
    if not text:
        return text
    parts, at = [], 0
    for start, end, kind in find_mentions(text) if found is None else found:
        parts += [text[at:start], PLACEHOLDERS[kind]]
        at = end
    return "".join([*parts, text[at:]])


def mentions(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, kind, start_pos, end_pos: one row per mention. Null, empty and blank texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, kind, a, b) for i, t in zip(batch[key], batch[text]) for a, b, kind in find_mentions(t)]
            yield pd.DataFrame(rows, columns=[key, "kind", "start_pos", "end_pos"])

    slim = documents.where(F.length(text) > 0).select(key, text)
    return slim.mapInPandas(run, f"`{key}` {slim.schema[key].dataType.simpleString()}, kind string, start_pos int, end_pos int")


def redacted(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, text with placeholders, n_mentions; every row comes out, null texts stay null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [find_mentions(t) for t in batch[text]]
            yield pd.DataFrame({key: batch[key], text: [redact(t, f) if f else t for t, f in zip(batch[text], found)], "n_mentions": [len(f) for f in found]})

    slim = documents.select(key, text)
    return slim.mapInPandas(run, f"`{key}` {slim.schema[key].dataType.simpleString()}, `{text}` string, n_mentions int")


def found_mentions(found: DataFrame, key: str = "doc_id") -> DataFrame:
    return found.select(key, "kind", "start_pos").distinct()
