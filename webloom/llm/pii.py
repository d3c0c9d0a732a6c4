"""Problem 1: personal information inside free text.

Offset-preserving deobfuscation. A first transducer maps every character to one character (case, accents, final sigma,
wide digits). Further ones drop combining marks, replace look-alike letters in tokens of mixed script and letters that
stand for zeros in numbers, and rewrite spelled digits and at/dot disguises; each keeps for every character of its output
the stretch of source characters it stands for. Identifiers, addresses and names are detected in the normalised text and
their spans are mapped back to the source, where they become typed placeholders. One narrow pass; nothing is shuffled.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.boilerplate import quick_repair
from webloom.llm.common import documents, map_rows

TYPES = ("email", "phone", "id_number", "address", "name")


class _One(dict):
    """First transducer: one character for each character."""

    def __missing__(self, cp: int) -> str:
        ch = chr(cp)
        digit = unicodedata.digit(ch, None) if ch.isdigit() and unicodedata.category(ch) == "Nd" else None
        if digit is not None:
            out = str(digit)
        elif ch in "\n\t":
            out = ch
        elif ch.isspace():
            out = " "
        else:
            base = unicodedata.normalize("NFKD", ch.lower())[:1] or ch
            out = "σ" if base == "ς" else "-" if base in "‐‑‒–−" else base
        self[cp] = out
        return out


_ONE = _One()

#: Greek and Cyrillic letters that look like Latin ones, and Latin and Cyrillic ones that look like Greek.
TO_LATIN = str.maketrans("αβεζηικμνορτυχωасекморхуіјѕ", "abeznikmvoptuxwacekmopxyijs")
TO_GREEK = str.maketrans("abehikmnopuvwxyztаеікмнорхутв", "αβεηικμνορυνωχυζταεικμηορχυτβ")
#: Digits in words, Greek and English, folded.
DIGIT_WORDS = {"μηδεν": "0", "ενα": "1", "δυο": "2", "τρια": "3", "τεσσερα": "4", "πεντε": "5", "εξι": "6", "επτα": "7", "εφτα": "7", "οκτω": "8", "οχτω": "8", "εννεα": "9", "εννια": "9", "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_SPELLED = re.compile(r"\b(?:(?:%s)\b[ ,.-]*){6,}" % "|".join(DIGIT_WORDS))
_DIGIT_WORD = re.compile("|".join(sorted(DIGIT_WORDS, key=len, reverse=True)))
_AT = re.compile(r"\s*[\[({<]\s*(?:at|παπακι|papaki|@)\s*[\])}>]\s*|\s+(?:παπακι|papaki)\s+|(?<=[a-z0-9]) at (?=[a-z0-9][\w-]*(?:\.[\w-]+)* ?(?:dot|[\[(]dot[\])]|\.) ?[a-z])|(?<=[a-z0-9_])\s*@\s*(?=[a-z0-9])")
_DOT = re.compile(r"\s*[\[({<]\s*(?:dot|τελεια|teleia|\.)\s*[\])}>]\s*|\s+(?:τελεια|teleia|dot)\s+|(?<=[a-z0-9])\s+\.\s+(?=[a-z])")
_SIGN = re.compile(r"@|παπακι|papaki|[\[({<]\s*at\s*[\])}>]| at [a-z0-9.-]+ ?(?:dot|[\[(])")
_MIXED = re.compile(r"[a-z0-9._+@-]*(?:[a-z][α-ωа-я]|[α-ωа-я][a-z]|[α-ω][а-я]|[а-я][α-ω])[a-z0-9α-ωа-я._+@-]*")
_MARKS = re.compile("[\u0300-\u036f]+")
_OH = re.compile(r"(?<![^\W_])(?=[\doο .()-]*\d[oο]|[\doο .()-]*[oο]\d)[+(\doο](?:[\doο .()-]{5,}[\doο])(?![^\W_])")
_DIGIT = re.compile(r"\d")
_CYRILLIC = re.compile("[а-яѐ-џ]")
_GREEK_LETTER = re.compile("[α-ω]")
_LATIN_LETTER = re.compile("[a-z]")

Rewritten = Iterator[tuple[str, int, int]]


class Normal:
    """A normalised line; character i stands for the source characters starts[i] up to ends[i]."""

    def __init__(self, once: str) -> None:
        self.text = once  # a line after the first transducer
        self.starts: list[int] | None = None  # None: every character stands for itself
        self.ends: list[int] | None = None

    def rewrite(self, pattern: re.Pattern[str], to: Callable[[re.Match[str]], Rewritten]) -> None:
        """Replace matches; `to` gives characters with the stretch of the match, from and up to, that each stands for."""
        out, starts, ends, last = [], [], [], 0
        a, b = self.starts or range(len(self.text)), self.ends or range(1, len(self.text) + 1)
        for m in pattern.finditer(self.text):
            out.append(self.text[last : m.start()])
            starts.extend(a[last : m.start()])
            ends.extend(b[last : m.start()])
            for ch, i, j in to(m):
                out.append(ch)
                starts.append(a[m.start() + i])
                ends.append(b[m.start() + j - 1])
            last = m.end()
        if last:
            out.append(self.text[last:])
            starts.extend(a[last:])
            ends.extend(b[last:])
            self.text, self.starts, self.ends = "".join(out), starts, ends

    def span(self, a: int, b: int) -> tuple[int, int]:
        """Source span of the characters a..b-1."""
        return (a, b) if self.starts is None else (self.starts[a], self.ends[b - 1])

    def cased(self, line: str) -> str:
        """The text with the capitals of the source line."""
        if self.starts is None:
            return line
        return "".join(c.upper() if line[a].isupper() else c for c, a in zip(self.text, self.starts, strict=True))


def _same(text: str) -> Rewritten:
    return ((c, k, k + 1) for k, c in enumerate(text))


def _one_script(m: re.Match[str]) -> Rewritten:
    """A token of mixed script in the script most of its letters have; addresses of mail are Latin."""
    token = m[0]
    latin = "@" in token or len(_LATIN_LETTER.findall(token)) >= len(_GREEK_LETTER.findall(token))
    return _same(token.translate(TO_LATIN if latin else TO_GREEK))


def _digits_of(m: re.Match[str]) -> Rewritten:
    """A digit for each word; what follows the last one stays."""
    last = 0
    for w in _DIGIT_WORD.finditer(m[0]):
        yield DIGIT_WORDS[w[0]], w.start(), w.end()
        last = w.end()
    for k in range(last, len(m[0])):
        yield m[0][k], k, k + 1


def letters(once: str) -> Normal:
    """A line after the transducers that work letter by letter."""
    n = Normal(once)
    if _MARKS.search(n.text):
        n.rewrite(_MARKS, lambda m: iter(()))
    # Most lines have one script only.
    if (_LATIN_LETTER.search(n.text) or _CYRILLIC.search(n.text)) and _MIXED.search(n.text):
        n.rewrite(_MIXED, _one_script)
    return n


def disguises(n: Normal) -> Normal:
    """A copy of a line after the transducers for zeros, spelled digits and at/dot."""
    out = Normal(n.text)
    out.starts, out.ends = n.starts, n.ends
    if _DIGIT.search(out.text) and _OH.search(out.text):
        out.rewrite(_OH, lambda m: _same(m[0].translate({ord("o"): "0", ord("ο"): "0"})))
    if _SPELLED.search(out.text):
        out.rewrite(_SPELLED, _digits_of)
    if _SIGN.search(out.text):
        out.rewrite(_AT, lambda m: iter([("@", 0, len(m[0]))]))
        if "@" in out.text:
            out.rewrite(_DOT, lambda m: iter([(".", 0, len(m[0]))]))
    return out


_EMAIL = re.compile(r"[^\W_][\w.%+-]*@(?:[\w-]+\.)+[^\W\d_]{2,}")
#: A number with a foreign country's code, groups divided by at most two signs.
_FOREIGN = re.compile(r"(?<![\w.,/+(-])\+(?!30(?!\d)|30\d{10}(?!\d))[1-9]\d{0,3}(?:[ .-]{0,2}\(?\d{1,5}\)?){1,6}(?![\w,]*\d)")
_PHONE = re.compile(r"(?<![\w.,/+(-])(?:\(?(?:\+|00)30\)?[ .-]{0,2})?(?:\(\d{2,5}\)|\d{2,14})(?:[ .-]{0,2}\d{1,10}){0,5}(?![\w,]*\d)")
_ID = re.compile(
    r"(?<![a-zα-ω])(?:α\.?φ\.?μ\.?|a\.?f\.?m\.?|α\.?μ\.?κ\.?α\.?|a\.?m\.?k\.?a\.?|α\.?δ\.?τ\.?|a\.?d\.?t\.?|(?:αριθμοσ |αρ\. ?|δελτιο |δελτιου )?(?:αστυνομικησ )?ταυτοτητασ?|φορολογικου μητρωου|μητρωου κοινωνικησ ασφαλισησ|κοινωνικησ ασφαλισησ|ταυτ\.|διαβατηριου?|vat|ssn|passport)(?![a-zα-ω])"
    r"[\s:.#-]*(?:(?:με )?αριθμοσ?|αρ\.?|no\.?|number)?[\s:.#-]*([a-zα-ω]{1,2}[ -]?\d{6}(?!\d)|\d(?:[ -]?\d){7,10}(?!\d))"
)
_STREET = re.compile(
    r"(?<![a-zα-ω])(?:επι τησ )?(?:οδοσ|οδου|οδο|λεωφοροσ|λεωφορου|λεωφορο|λεωφ\.?|λ\.|πλατειασ?|πλ\.|odos|leoforos|leof\.?)\s+((?:[a-zα-ω]+\.? ){0,3}?[a-zα-ω]+),?\s+(?:αριθμοσ |αριθμο |αρ\.? ?|no\.? ?)?(\d{1,4})(?:\s?[a-zα-ω])?(?![\w.]*\d)(?![a-zα-ω])"
)
_BARE = re.compile(r"(?<![\w.])([a-zα-ω]{4,}(?: [a-zα-ω]{4,})?) (\d{1,3})\s?[a-zα-ω]?(?: ?& ?[a-zα-ω]+)?,? (?:(?:τ\.? ?κ\.?|tk) ?\d{3} ?\d{2}|\d{3} ?\d{2}(?!\d))(?:,? [α-ω]+)?")
#: Large Greek cities, folded, in the nominative or accusative.
CITIES = ("αθηνα", "θεσσαλονικη", "πατρα", "πειραιασ", "πειραια", "ηρακλειο", "λαρισα", "βολοσ", "βολο", "ιωαννινα", "χανια", "καλαματα", "ροδοσ", "καβαλα", "σερρεσ", "τριπολη", "κορινθοσ", "χαλκιδα", "λαμια", "κομοτηνη", "ξανθη", "δραμα", "κοζανη", "μυτιληνη", "λευκωσια", "λεμεσοσ")
_CITY = re.compile(rf"(?<![\w.])([α-ω]{{4,}}(?: [α-ω]{{4,}})?) (\d{{1,3}})\s?[α-ω]?, (?:{'|'.join(CITIES)})(?!\w)")
_ENGLISH_STREET = re.compile(r"\b\d{1,4}[a-z]? (?:[a-z]+ ){1,3}(?:street|avenue|road|lane|boulevard|square)\b")

#: What every address has beside a digit: a street word, a postal code, or an English street word.
_PLACE = re.compile(r"(?<![a-zα-ω])(?:οδ[οό][σύυ]?|οδου|λεωφ|πλατεια|πλ\.|λ\.|odos|leof)[^\d]{0,60}\d|\d[\s\S]{0,40}?\b\d{3} ?\d{2}(?!\d)|[α-ω] \d{1,3} ?[α-ω]?, [α-ω]|(?:street|avenue|road|lane|boulevard|square)\b")

_UPPER = "A-ZΑ-ΩΆΈΉΊΌΎΏΪΫÀ-ÖØ-ÞА-Я"
_PAIR = re.compile(rf"(?<![\w.])(?=(([{_UPPER}])(?:\.|[^\W\d_]+)[ \xa0]?(?<=[ \xa0.])([{_UPPER}][^\W\d_]{{2,}}))(?![\w@]))")
_FAMILY = re.compile(r"(?:οπουλοσ|οπουλου|οπουλο|ιδησ|ιδη|ιδου|ιαδησ|αδησ|αδη|αδου|ακησ|ακη|ατοσ|ατου|ατο|ελησ|ελη|ουδησ|ουδη|ακοσ|ακου|ογλου|εασ|ιωτησ|ιωτη|ουλησ|ουλη|ινοσ|ινου|ιανοσ|ιανου)$")
_STRONG = re.compile(r"(?:οπουλοσ|οπουλου|οπουλο|ιδησ|ιδου|ιαδησ|αδησ|ακησ|ατοσ|ατου|ελησ|ουδησ|ογλου)$")
_SAID = re.compile(rf"\b(?:[Aa]ccording to|[Bb]y|[Cc]ontact|Mr\.?|Mrs\.?|Ms\.?|Dr\.?|author|editor) ([A-Z][a-z]+|[A-Z]\.) ([A-Z][a-z]{{2,}})\b")

#: Common Greek given names, folded, in the nominative; case forms follow by rule.
GIVEN = """αγγελικη αγγελοσ αθανασιοσ αικατερινη αλεξανδρα αλεξανδροσ αλεξησ αλικη αναστασια αναστασιοσ ανδρεασ αννα αντωνησ αντωνιοσ αντιγονη αργυρω αρησ αριστειδησ αρτεμισ ασημινα αχιλλεασ αθηνα βαγγελησ βαλια βαρβαρα βασιλειοσ βασιλησ βασιλικη βικτωρ γεωργια γεωργιοσ γιαννησ γιωργοσ γρηγορησ δαναη δαφνη δεσποινα δημητρα δημητρησ δημητριοσ διονυσησ δομνα ειρηνη ελενη ελευθερια ελευθεριοσ ελισαβετ ελλη ελπιδα ερμησ ευα ευαγγελια ευαγγελοσ ευγενια ευη ευστρατιοσ ζαχαριασ ζηνων ζωη ηλεκτρα ηλιασ ηρω θαλεια θανασησ θεμησ θεοδωρα θεοδωροσ θωμασ ιακωβοσ ιασονασ ιολη ιουλια ιωαννα ιωαννησ ιωσηφ καιτη καλλιοπη κατερινα κλειω κλεοπατρα κωνσταντινα κωνσταντινοσ κυριακοσ κωστασ λαμπροσ λεωνιδασ λουκασ λυδια μαγδα μαρια μαριαννα μαριλενα μαρινα μαριοσ μαρκοσ μελινα μηνασ μιχαλησ μιχαηλ μυρτω ναταλια νεφελη νικη νικολαοσ νικοσ ξενια οδυσσεασ ολγα ορεστησ παναγιωτα παναγιωτησ παντελησ παρασκευη παυλοσ πελαγια περικλησ πετροσ πηνελοπη ρεα ρενα ρωξανη σοφια σπυροσ σπυριδων σταυροσ στελιοσ στεφανοσ στεφανια στυλιανοσ σωτηρησ σωκρατησ τασοσ τατιανα φαιδρα φανησ φιλιπποσ φοιβοσ φωτεινη φωτησ χαραλαμποσ χαρησ χλοη χρηστοσ χριστινα χρυσα""".split()


#: Common given names in other languages, folded; Cyrillic ones in Cyrillic.
GIVEN_OTHER = """john james robert michael william david richard joseph thomas charles mary patricia jennifer linda elizabeth barbara susan jessica sarah karen peter paul mark george andrew steven emma olivia sophia alice daniel matthew anthony laura julia anna maria
hans peter klaus jurgen wolfgang heinz stefan markus sabine ursula monika petra heike greta jean pierre michel jacques marie claire sophie camille louis antoine ivan georgi dimitar petar nikolay mehmet ahmet mustafa ayse fatma emine
мария иван георги димитър петър николай елена анна сергей александр дмитрий ольга татьяна наталья стоян васил""".split()
#: Endings of Bulgarian and Russian family names.
_SLAVIC_FAMILY = re.compile("(?:ов|ова|ев|ева|ин|ина|ски|ска|ский|ская|енко)$")
#: How Greek letters and pairs of them are written in Latin letters; the longer ones come first.
_ROMAN = (("ου", "ou"), ("ευ", "ef"), ("αυ", "av"), ("γγ", "ng"), ("μπ", "b"), ("ντ", "nt"), ("γκ", "gk"), ("α", "a"), ("β", "v"), ("γ", "g"), ("δ", "d"), ("ε", "e"), ("ζ", "z"), ("η", "i"), ("θ", "th"), ("ι", "i"), ("κ", "k"), ("λ", "l"), ("μ", "m"), ("ν", "n"), ("ξ", "x"), ("ο", "o"), ("π", "p"), ("ρ", "r"), ("σ", "s"), ("τ", "t"), ("υ", "y"), ("φ", "f"), ("χ", "ch"), ("ψ", "ps"), ("ω", "o"))


def roman(name: str) -> str:
    """A folded Greek name in Latin letters."""
    for a, b in _ROMAN:
        name = name.replace(a, b)
    return name


def forms(name: str) -> set[str]:
    """Case forms of a folded Greek given name."""
    for end, stems in (("οσ", ("οσ", "ου", "ο", "ε")), ("ησ", ("ησ", "η")), ("ασ", ("ασ", "α")), ("α", ("α", "ασ", "αν")), ("η", ("η", "ησ", "ην")), ("ω", ("ω", "ωσ")), ("ων", ("ων", "ωνα", "ωνοσ"))):
        if name.endswith(end):
            return {name[: -len(end)] + s for s in stems}
    return {name}


GIVEN_FORMS = frozenset(f for n in GIVEN for f in forms(n))
GIVEN_ROMAN = frozenset(roman(n) for n in GIVEN) | frozenset(GIVEN_OTHER)
_ROMAN_FAMILY = re.compile("(?:opoulos|opoulou|idis|idou|iadis|adis|akis|aki|atos|atou|elis|oudis|oglou|akos|eas|iotis|oulis|inos|ianos)$")
#: Folded words that open sentences or name places and things, and so are no given names.
NOT_GIVEN = frozenset("ο η το οι τα στο στη στην στον στουσ στισ στα του τησ των τον την τουσ τισ και με για απο γιατι κατα προσ επι οδοσ οδου λεωφοροσ πλατεια λεωφ κ κα".split())

_HAS_DIGITS = re.compile(r"\d(?:[^\d\n]{0,4}\d){5}")
_CAPITALS = re.compile(rf"[{_UPPER}](?:\.|[^\W\d_]+\.?)[ \xa0]?[{_UPPER}]")
#: Folded endings of Greek family names that other words have as well; they count after a known given name only.
_GREEK_FAMILY = re.compile("(?:[α-ω]{3})(?:ησ|η|ασ|α|οσ|ου|ο|ωφ|εζ|ελου)$")
_NOT_GREEK = re.compile(r"[^\W\d_α-ω]{3,}$")
#: English words that open sentences before a family name.
ENGLISH_OPENERS = frozenset("the and but for with from when where why how dear hello street mr mrs ms dr sir of in at on to by".split())
_LETTER = re.compile(r"[^\W\d_]")


def _phones(n: Normal) -> Iterator[tuple[int, int]]:
    text = n.text
    for m in _FOREIGN.finditer(text):
        if 8 <= len(re.sub(r"\D", "", m[0])) <= 15:
            yield m.span()
    plain = _LETTER.search(text) is None
    for m in _PHONE.finditer(text):
        a, b = m.start(), m.end()
        s = text[a:b]
        while s:
            digits = re.sub(r"\D", "", s)
            own = digits[4:] if digits.startswith("0030") else digits[2:] if s.lstrip("(").startswith("+30") else digits
            if len(own) <= 10:
                break
            cut = re.search(r"[ .-]+\d+$", s)
            s = s[: cut.start()] if cut else ""
        if not s or len(own) != 10 or own[0] not in "26" or own[1] == "0" and own[0] == "2":
            continue
        groups = re.findall(r"\d+", s)
        if plain and len(own) == len(digits) and len(groups) > 1 and not re.search(r"[().-]", s):
            continue  # a row of numbers
        if len(groups) > 1 and own == digits and len(groups[0]) == 10:
            continue
        yield a, a + len(s)


def _names(line: str) -> Iterator[tuple[int, int]]:
    """Spans of a given name or initial with a family name in a line with its capitals."""
    for m in _PAIR.finditer(line):
        a, b = m.start(1), m.end(1)
        c = m.start(3)
        first, second = line[a:c].strip(), m[3]
        one, two = first.translate(_ONE), second.translate(_ONE)
        if first.endswith("."):
            if len(first) == 2 and (_FAMILY.search(two) if not first.isascii() else _ROMAN_FAMILY.search(two)):
                yield a, b
            continue
        if one in NOT_GIVEN or two in NOT_GIVEN:
            continue
        upper = first.isupper() and len(first) > 1
        if (one in GIVEN_FORMS and _FAMILY.search(two)) or (two in GIVEN_FORMS and _FAMILY.search(one)) or (not upper and not second.isupper() and _STRONG.search(two) and len(two) >= 8 and len(one) >= 3 and not _FAMILY.search(one) and _known(one)):
            yield a, b
        elif one in GIVEN_ROMAN and _NOT_GREEK.match(two) and (not upper or second.isupper()):
            if not _CYRILLIC.match(two) or _SLAVIC_FAMILY.search(two):
                yield a, b
        elif _ROMAN_FAMILY.search(two) and two.isascii() and one.isascii() and len(two) >= 7 and one not in ENGLISH_OPENERS:
            yield a, b
        elif one in GIVEN_FORMS and not upper and not second.isupper() and _GREEK_FAMILY.search(two) and len(two) >= 5 and two not in GIVEN_FORMS:
            yield a, b
    for m in _SAID.finditer(line):
        yield m.start(1), m.end(2)


def _known(one: str) -> bool:
    """A word that has the ending of a Greek given name."""
    return one.endswith(("οσ", "ησ", "ασ", "α", "η", "ω", "ου")) and one not in NOT_GIVEN


def detect(line: str, lower: str | None = None) -> list[tuple[int, int, str]]:
    """Spans (start, end, type) of personal information in a line, in order and without overlap.

    `lower` is the line after the first transducer, if it is known. Each detector asks first for something that all its
    matches have, in the same normalised text it then searches.
    """
    out: list[tuple[int, int, str]] = []
    base = letters(line.translate(_ONE) if lower is None else lower)
    n = disguises(base)

    def add(a: int, b: int, kind: str) -> None:
        if all(b <= x or a >= y for x, y, _ in out):
            out.append((a, b, kind))

    if "@" in n.text:
        for m in _EMAIL.finditer(n.text):
            add(*n.span(m.start(), m.end()), "email")
    if _HAS_DIGITS.search(n.text):
        for m in _ID.finditer(n.text):
            body = re.sub(r"\D", "", m[1])
            if m[1][0].isdigit() and len(body) not in (9, 11):
                continue
            add(*n.span(m.start(1), m.end(1)), "id_number")
        for a, b in _phones(n):
            add(*n.span(a, b), "phone")
    text = base.text
    places = _DIGIT.search(text) is not None and _PLACE.search(text) is not None
    shown = base.cased(line)
    if not places and not _CAPITALS.search(shown):
        return sorted(out)
    if places:
        for pattern in (_STREET, _BARE, _CITY):
            for m in pattern.finditer(text):
                if shown[m.start(1)].isupper() or shown[m.start(1) : m.end(1)].split()[-1][:1].isupper():
                    add(*base.span(m.start(), m.end()), "address")
        for m in _ENGLISH_STREET.finditer(text):
            if re.search(r"[A-Z]", shown[m.start() : m.end()]):
                add(*base.span(m.start(), m.end()), "address")
    for a, b in _names(shown):
        add(*base.span(a, b), "name")
    return sorted(out)


def found(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, pii_type), each once. Null and empty texts hold nothing. A garbled line is also read repaired."""

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        def f(ids: list[int], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, text in zip(ids, texts, strict=True):
                if not text:
                    continue
                for k, (line, lower) in enumerate(zip(text.split("\n"), text.translate(_ONE).split("\n"), strict=True), 1):
                    if not line:
                        continue
                    kinds = {t for _, _, t in detect(line, lower)}
                    fixed = quick_repair(line)
                    if fixed is not line and fixed != line:
                        kinds |= {t for _, _, t in detect(fixed)}
                    for t in sorted(kinds):
                        yield i, k, t

        return f

    return map_rows(docs, ["doc_id", "text"], "doc_id bigint, line_no bigint, pii_type string", make)


def redact_line(line: str) -> tuple[str, int]:
    """The line with typed placeholders, and how many; a garbled line with something personal is given repaired."""
    spans = detect(line)
    fixed = quick_repair(line)
    if fixed != line and len(more := detect(fixed)) > len(spans):
        line, spans = fixed, more
    out, last = [], 0
    for a, b, kind in spans:
        out += [line[last:a], f"[{kind.upper()}]"]
        last = b
    return ("".join([*out, line[last:]]) if spans else line), len(spans)


def redacted(docs: DataFrame) -> DataFrame:
    """Every document with placeholders: doc_id, n_redacted, text. A null text stays null."""

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        def f(ids: list[int], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, text in zip(ids, texts, strict=True):
                if text is None:
                    yield i, 0, None
                    continue
                parts = [redact_line(x) for x in text.split("\n")]
                yield i, sum(n for _, n in parts), "\n".join(x for x, _ in parts)

        return f

    return map_rows(docs, ["doc_id", "text"], "doc_id bigint, n_redacted bigint, text string", make)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return found(documents(spark, d))


def p1_redacted(spark: SparkSession, d: str) -> DataFrame:
    return redacted(documents(spark, d))


def p1_counts(spark: SparkSession, d: str) -> DataFrame:
    """Lines and documents with each type."""
    return found(documents(spark, d)).groupBy("pii_type").agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("doc_id").alias("n_documents"))
