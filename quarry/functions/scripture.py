"""Scripture references: books, citation grammars, canonical forms, contexts."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .text import _fold, roman_value

# Books as key, chapters, aliases (folded, without dots).
BOOKS = """
gen 50 genesis gen gn | ex 40 exodus exod ex | lev 27 leviticus lev lv | num 36 numbers numeri num nm | deut 34 deuteronomy deuteronomium deut dt
josh 24 joshua josue josh jos | judg 21 judges judicum judg idc | ruth 4 ruth rt | 1sam 31 1 samuel 1 sam | 2sam 24 2 samuel 2 sam | 1kgs 22 1 kings 1 kgs | 2kgs 25 2 kings 2 kgs
1chr 29 1 chronicles 1 chr 1 paral | 2chr 36 2 chronicles 2 chr 2 paral | ezra 10 ezra esdras ezr | neh 13 nehemiah nehemias neh | esth 10 esther esth est | job 42 job iob
ps 150 psalms psalm psalmus ps | prov 31 proverbs proverbia prov prv | eccl 12 ecclesiastes eccl eccle | song 8 song canticum cant ct | isa 66 isaiah isaias isa is
jer 52 jeremiah jeremias jer | lam 5 lamentations threni lam | ezek 48 ezekiel ezechiel ezek ez | dan 14 daniel dan dn | hos 14 hosea osee hos os | joel 3 joel jl | amos 9 amos am
obad 1 obadiah abdias obad abd | jonah 4 jonah jonas jon | mic 7 micah michaeas mic | nah 3 nahum nah | hab 3 habakkuk habacuc hab | zeph 3 zephaniah sophonias zeph soph
hag 2 haggai aggaeus hag agg | zech 14 zechariah zacharias zech zach | mal 4 malachi malachias mal | tob 14 tobit tobias tob | jdt 16 judith jdt | wis 19 wisdom sapientia wis sap
sir 51 sirach ecclesiasticus sir eccli | bar 6 baruch bar | 1macc 16 1 maccabees 1 macc 1 mac | 2macc 15 2 maccabees 2 macc 2 mac | matt 28 matthew matthaeus matth matt mt
mark 16 mark marcus marc mc mk | luke 24 luke lucas luc lc lk | john 21 john joannes joan jn | acts 28 acts actus act | rom 16 romans rom rm | 1cor 16 1 corinthians 1 cor | 2cor 13 2 corinthians 2 cor
gal 6 galatians gal ga | eph 6 ephesians ephes eph | phil 4 philippians philipp phil | col 4 colossians coloss col | 1thess 5 1 thessalonians 1 thess | 2thess 3 2 thessalonians 2 thess
1tim 6 1 timothy 1 tim | 2tim 4 2 timothy 2 tim | titus 3 titus tit | phlm 1 philemon phlm | heb 13 hebrews hebr heb | jas 5 james jacobus jac jas | 1pet 5 1 peter 1 petr 1 pet
2pet 3 2 peter 2 petr 2 pet | 1john 5 1 john 1 joan 1 jn | 2john 1 2 john 2 joan 2 jn | 3john 1 3 john 3 joan 3 jn | jude 1 jude judas jud | rev 22 revelation apocalypsis apoc apc rev
"""
#: Aliases of two books, by tradition: the Latin counting of Kings begins with Samuel.
AMBIGUOUS = {"1 reg": {"latin": "1sam", "modern": "1kgs"}, "2 reg": {"latin": "2sam", "modern": "2kgs"}, "1 esdr": {"latin": "ezra", "modern": "ezra"}}


def _catalog() -> tuple[dict[str, int], dict[str, str]]:
    chapters, aliases = {}, {}
    for entry in re.split(r"[|\n]", BOOKS.strip()):
        key, count, rest = entry.split(None, 2)
        chapters[key] = int(count)
        # A number before a name belongs to it: "1 samuel 1 sam" has two aliases.
        for alias in re.findall(r"[1-3] [a-z]+|[a-z]+", rest):
            aliases.setdefault(alias, key)
    return chapters, aliases


CHAPTERS, ALIASES = _catalog()
SINGLE = {k for k, n in CHAPTERS.items() if n == 1}
ROMAN_DIGITS = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def fold_alias(text: Column) -> Column:
    """Lower case without accents, dots to blanks, blanks collapsed; Roman 1 to 3 before a name as digits."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.translate(F.lower(text), "áàâäãéèêëíìîïóòôöõúùûüçñ", "aaaaaeeeeiiiiooooouuuucn"), r"[.]", " "), r"\s+", " "))
    for roman, digit in (("iii", "3"), ("ii", "2"), ("i", "1")):
        plain = F.regexp_replace(plain, f"^{roman} (?=[a-z])", f"{digit} ")
    return plain


def book_key(text: Column, tradition: str = "modern") -> Column:
    """The book's key for an alias; null if it is none."""
    names = ALIASES | {a: by[tradition] for a, by in AMBIGUOUS.items()}
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[fold_alias(text)]


def reference_parts(text: Column) -> Column:
    """struct(book, chapter, start_verse, end_verse) of ``Book c:v-v``, the chapter in either digits; null if it is none."""
    form = r"^\s*((?:[1-3]|I{1,3})?\s*[\p{L}.]+)\s+([0-9]+|[IVXLCivxlc]+)(?:\s*[:., ]\s*([0-9]+)(?:\s*[-–]\s*([0-9]+))?)?\s*$"
    part = lambda i: F.nullif(F.regexp_extract(text, form, i), F.lit(""))
    chapter = F.when(part(2).rlike("^[0-9]+$"), part(2).cast("int")).otherwise(roman_value(part(2)))
    start = part(3).cast("int")
    made = F.struct(book_key(part(1)).alias("book"), chapter.alias("chapter"), start.alias("start_verse"), F.coalesce(part(4).cast("int"), start).alias("end_verse"))
    return F.when(book_key(part(1)).isNotNull() & (chapter > 0), made)


def reference_form(book: Column, chapter: Column, verse: Column, chapter_end: Column, verse_end: Column) -> Column:
    """``book c``, ``book c:v``, ``book c:v-w`` or ``book c:v-d:w`` (P10)."""
    start = F.concat_ws(":", chapter.cast("string"), verse.cast("string"))
    far = chapter_end.isNotNull() & (chapter_end != chapter)
    end = F.when(far, F.concat_ws(":", chapter_end.cast("string"), verse_end.cast("string"))).when(verse_end.isNotNull() & (verse_end != verse), verse_end.cast("string"))
    return F.concat(book, F.lit(" "), F.concat_ws("-", start, end))


def granularity(segments: Column) -> Column:
    """list for several segments, range for one of several places, verse, chapter (P12). Segments: array of (start_chapter, start_verse,
    end_chapter, end_verse)."""
    s = segments[0]
    several = (s["start_chapter"] != s["end_chapter"]) | ~s["start_verse"].eqNullSafe(s["end_verse"])
    return F.when(F.size(segments) > 1, "list").when(several, "range").when(s["start_verse"].isNotNull(), "verse").otherwise("chapter")


def context_kind(block: Column, page: Column, is_index: Column) -> Column:
    """index, apparatus, note, header, footer or body, by the page, then the block."""
    return F.when(is_index | page.isin("indice", "index"), "index").when(block.isin("aparato", "apparatus"), "apparatus").when(block.isin("nota", "note"), "note").when(block.isin("cabecalho", "header"), "header").when(block.isin("rodape", "footer"), "footer").otherwise("body")


def page_side(x1: Column, x2: Column, width: Column) -> Column:
    """both for a box over 72 % of the width, left if it ends before 54 %, right if it begins after 46 % of it."""
    return F.when((x2 - x1) / width >= 0.72, "both").when(x2 / width <= 0.54, "left").when(x1 / width >= 0.46, "right").otherwise("both")


@dataclass
class Citation:
    """What a text cites, where, and how sure that is."""

    book: str
    chapter: int
    verse: int | None
    chapter_end: int
    verse_end: int | None
    start: int
    end: int
    confidence: float
    kind: str
    issues: list[str] = field(default_factory=list)


_NUMBER = r"(?:[0-9]{1,3}|[ivxlc]{1,9}(?![a-z]))"
_NAMES = "|".join(sorted((re.escape(a).replace(r"\ ", r"[. ]+") for a in ALIASES | AMBIGUOUS), key=len, reverse=True))
_BOOK = re.compile(rf"(?<![a-z0-9])({_NAMES})(?![a-z])\.?\s*")
_CHAPTER = re.compile(rf"({_NUMBER})")
_VERSE = re.compile(rf"\s*[:,.]\s*({_NUMBER})")
_RANGE = re.compile(rf"\s*[-–]\s*(?:({_NUMBER})\s*[:]\s*)?({_NUMBER})")
_MORE = re.compile(rf"\s*,\s*({_NUMBER})(?!\s*[:.]\s*[0-9])(?![a-z])")
_NEXT = re.compile(rf"\s*(?:;|\bet\b|\band\b)\s*({_NUMBER})\s*[:,]\s*({_NUMBER})")
_HEADING = re.compile(rf"^\s*(?:in\s+)?psalm(?:us|um|i|o)?\.?\s+({_NUMBER})\s*[.:]?\s*$", re.MULTILINE)


def _value(text: str) -> int:
    if text.isdigit():
        return int(text)
    total = top = 0
    for c in reversed(text):
        n = ROMAN_DIGITS[c]
        total += -n if n < top else n
        top = max(top, n)
    return total


def _folded_with_places(text: str) -> tuple[str, list[int] | range]:
    """The folded text, and for each of its characters the place in the text."""
    if text.isascii():
        return text.lower(), range(len(text) + 1)
    out, places = [], []
    for i, c in enumerate(text):
        for f in _fold(c):
            out.append(f)
            places.append(i)
    return "".join(out), [*places, len(text)]


def citations(text: str, tradition: str = "modern", chapters_too: bool = True) -> list[Citation]:
    """The citations of a text from left to right, without overlap.

    Book, chapter and verse, ranges, lists of verses and continued chapters. Books of one chapter take a lone number as the verse.
    A chapter beyond the book's is an issue and no citation; a falling range loses its end, with an issue. One- and two-letter names
    in lower case need a dot. Chapters alone are cited with less confidence; psalm headings by their own line.
    """
    folded, places = _folded_with_places(text)
    found: list[Citation] = []
    done = -1

    def add(book, chapter, verse, chapter_end, verse_end, start, end, sure, kind, issues):
        found.append(Citation(book, chapter, verse, chapter_end, verse_end, places[start], places[end], sure, kind, issues))

    for m in _BOOK.finditer(folded):
        if m.start() < done:
            continue
        alias = re.sub(r"[. ]+", " ", m.group(1)).strip()
        raw = text[places[m.start()] : places[m.start() + 1] + 1]
        if len(alias) <= 2 and raw[:1].islower() and "." not in m.group(0):
            continue
        book = AMBIGUOUS[alias][tradition] if alias in AMBIGUOUS else ALIASES[alias]
        sure = 0.62 if alias in AMBIGUOUS and len(set(AMBIGUOUS[alias].values())) > 1 else 0.94
        c = _CHAPTER.match(folded, m.end())
        if not c:
            continue
        chapter, at = _value(c.group(1)), c.end()
        v = _VERSE.match(folded, at)
        if book in SINGLE and not v:
            add(book, 1, chapter, 1, chapter, m.start(), at, sure, "verse", ["single_chapter_verse"])
            done = at
            continue
        if not 1 <= chapter <= CHAPTERS[book]:
            continue
        if not v:
            if chapters_too:
                add(book, chapter, None, chapter, None, m.start(), at, min(sure, 0.70), "chapter", [])
                done = at
            continue
        verse, at = _value(v.group(1)), v.end()
        at = _tail(folded, at, m.start(), book, chapter, verse, sure, add)
        while (n := _NEXT.match(folded, at)) and 1 <= _value(n.group(1)) <= CHAPTERS[book]:
            at = _tail(folded, n.end(), n.start(1), book, _value(n.group(1)), _value(n.group(2)), sure, add)
        done = at
    for m in _HEADING.finditer(folded):
        if not any(c.start <= places[m.start(1)] < c.end for c in found) and 1 <= (n := _value(m.group(1))) <= 150:
            add("ps", n, None, n, None, m.start(), m.end(), 0.80, "heading", [])
    return sorted(found, key=lambda c: (c.start, c.end))


def _tail(folded, at, start, book, chapter, verse, sure, add) -> int:
    r = _RANGE.match(folded, at)
    if r:
        last_chapter, last = (_value(r.group(1)) if r.group(1) else chapter), _value(r.group(2))
        rising = (last_chapter, last) > (chapter, verse) and last_chapter <= CHAPTERS[book]
        add(book, chapter, verse, last_chapter if rising else chapter, last if rising else verse, start, r.end(), sure, "range" if rising else "verse", [] if rising else ["falling_range"])
        at = r.end()
    else:
        add(book, chapter, verse, chapter, verse, start, at, sure, "verse", [])
    last = verse
    while (n := _MORE.match(folded, at)) and _value(n.group(1)) > last:
        last = _value(n.group(1))
        r = _RANGE.match(folded, n.end())
        end = _value(r.group(2)) if r and not r.group(1) and _value(r.group(2)) > last else None
        add(book, chapter, last, chapter, end or last, n.start(1), r.end() if end else n.end(), sure, "range" if end else "verse", [])
        at, last = (r.end(), end) if end else (n.end(), last)
    return at


CITATIONS = ArrayType(StructType([StructField(n, IntegerType() if n in ("chapter", "verse", "chapter_end", "verse_end", "start", "end") else StringType()) for n in ("book", "chapter", "verse", "chapter_end", "verse_end", "start", "end", "kind", "issues")]))


@F.pandas_udf(CITATIONS)
def find_citations(text: pd.Series) -> pd.Series:
    """The citations in each text; null and empty texts have none."""
    row = lambda c: {"book": c.book, "chapter": c.chapter, "verse": c.verse, "chapter_end": c.chapter_end, "verse_end": c.verse_end, "start": c.start, "end": c.end, "kind": c.kind, "issues": ",".join(c.issues)}
    return pd.Series([[row(c) for c in citations(t)] if t else [] for t in text])


def label_kind(text: Column, found: Column) -> Column:
    """standalone if a label is nothing but its references, embedded if there is more, none without any (P11); bits 1 and 2 of the masks."""
    covered = F.aggregate(found, F.lit(0), lambda n, c: n + c["end"] - c["start"])
    rest = F.length(F.regexp_replace(text, r"[\s,;.()]", "")) - covered
    return F.when(F.size(found) == 0, "none").when(rest <= 0, "standalone").otherwise("embedded")
