"""Personal information inside free text (problem 4): anchor expansion.

One Aho-Corasick pass over the lower-cased text finds cues: at-signs and their disguises, identifier words, street and
box words, pairs of digits, listed names, titles, words of attribution and initials. Each cue starts a small
deterministic parser that expands from there to both sides, word by word, and validates the whole value; a cue without a
valid value is dropped. Earlier kinds win where values overlap: e-mail, identity number, address, phone, name.

A name is a listed given name with a family name, initials or a given name with a listed family name, or two capitalised words
or initials and one after a title or an attribution. What a word looks like beyond that plays no part.

Scale: a narrow map over whole texts, no shuffle. The name list goes to the executors with the code; it must
not exceed `MAX_NAMES` entries, which is checked. Parsers look back over a stated number of words; a word of more than
`LONG_WORD` characters is part of no value but an e-mail address.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_NAMES = 200_000
LONG_WORD = 1000
PLACEHOLDER = {"email": "<EMAIL>", "phone": "<PHONE>", "id": "<ID>", "address": "<ADDRESS>", "name": "<NAME>"}

_S = r"[ \t  -  ]"  # a blank within a value
_D = r"[\-‐-–]"  # a hyphen within a value
_LOCAL = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+\-]*[A-Za-z0-9])?$")
_DOT = rf"(?:\.|{_S}?[\[({{]{_S}?[dD][oO][tT]{_S}?[\])}}]{_S}?|{_S}(?:DOT|dot){_S})"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?"
_DOMAIN = re.compile(rf"{_S}?({_LABEL}(?:{_DOT}{_LABEL})*{_DOT}[A-Za-z]{{2,}})(?![A-Za-z0-9])")
_AT_WORD = re.compile(rf"(?<={_S})(AT|at)(?={_S})")

_NO = rf"(?:{_S}|\.|:|#|=|number|no\.?|nr\.?|n[°º]|id|is|was|\()*"
_ID = {
    "ssn": re.compile(rf"{_NO}(\d{{3}}(?:{_S}|{_D})?\d{{2}}(?:{_S}|{_D})?\d{{4}})(?!\d)", re.I),
    "ni": re.compile(rf"{_NO}([A-Z]{{2}}(?:{_S}|{_D})?\d{{2}}(?:{_S}|{_D})?\d{{2}}(?:{_S}|{_D})?\d{{2}}(?:{_S}|{_D})?[A-D])(?!\w)", re.I),
    "passport": re.compile(rf"{_NO}([A-Z]{{0,3}}\d{{6,9}})(?!\w)", re.I),
    "tax": re.compile(rf"{_NO}((?:\d{{9,11}}|\d{{2}}{_D}\d{{7}}|\d{{2,3}}(?:(?:{_S}|{_D}|[./])\d{{2,5}}){{2,4}}))(?!\d)", re.I),
}
#: Words that name an identity number, and its form.
ID_CUES = {
    "ssn": "ssn", "social security": "ssn", "social-security": "ssn", "sozialversicherungsnummer": "ssn",
    "national insurance": "ni", "national-insurance": "ni", "ni no": "ni", "ni number": "ni", "nino": "ni",
    "passport": "passport", "passeport": "passport", "pasaporte": "passport", "reisepass": "passport",
    "tax id": "tax", "tax no": "tax", "tax number": "tax", "tax identification": "tax", "taxpayer": "tax", "tax reference": "tax",
    "steuernummer": "tax", "steuer-id": "tax", "numéro fiscal": "tax", "nif": "tax", "itin": "tax", "tin": "tax",
}

_NUM = r"\d{1,5}(?:[A-Za-z]|(?:-\d{1,4}))?"
_CAP = r"[A-ZÀ-ÖØ-Þ][\w'’\-]*"
_SIDE = rf"(?:(?:[NSEW]|[NS][EW])\.?|North|South|East|West|NORTH|SOUTH|EAST|WEST){_S}"
#: number, street, street word: what stands before an English street word
_EN_BEFORE = re.compile(rf"(?<![\w.,\-])({_NUM},?{_S}(?:{_SIDE})?(?:{_CAP}{_S}){{1,3}})$")
_FR_BEFORE = re.compile(rf"(?<![\w.\-])(\d{{1,5}}(?:{_S}?(?:bis|ter|[A-Da-d]))?,?{_S})$")
_FR_AFTER = re.compile(rf"{_S}(?:(?:de{_S}la|de{_S}l['’]|de|du|des|d['’]){_S}?)?{_CAP}")
_ES_AFTER = re.compile(rf"{_S}(?:(?:de{_S}la|del|de{_S}los|de){_S})?{_CAP}(?:{_S}{_CAP}){{0,6}},?{_S}(?:n[º°.]{_S}?)?\d{{1,5}}[A-Za-z]?(?!\w)")
_DE_AFTER = re.compile(rf"{_S}\d{{1,4}}{_S}?[A-Za-z]?(?!\w)")
_DE_BEFORE = re.compile(rf"((?:{_CAP}|Am|An der|Zur|Zum){_S})$")
_BOX_AFTER = re.compile(rf"{_S}?(?:no\.?{_S}?|#)?\d{{1,6}}(?!\w)", re.I)
#: Where the town and code after a street end.
_TOWN = re.compile(rf",?{_S}?(?:in{_S})?(?:\d{{4,5}}{_S})?{_CAP}(?:{_S}(?:\d{{5}}(?:-\d{{4}})?|[A-Z]{{1,2}}\d{{1,2}}[A-Z]?{_S}\d[A-Z]{{2}}))?(?!\w)")
EN_STREETS = ("street", "st", "road", "rd", "avenue", "ave", "lane", "ln", "drive", "dr", "boulevard", "blvd", "court", "ct", "way", "close", "square", "sq", "place", "pl", "terrace", "crescent", "highway", "parkway")
FR_STREETS = ("rue", "avenue", "boulevard", "place", "chemin", "impasse", "quai", "allée", "route", "cours")
ES_STREETS = ("calle", "avenida", "avda.", "plaza", "paseo", "camino", "c/")
DE_STREETS = ("straße", "strasse", "str.", "weg", "platz", "allee", "gasse", "ufer", "damm", "ring")
BOXES = ("p.o. box", "po box", "p.o.box", "p. o. box", "post office box", "postfach", "boîte postale", "apartado de correos", "apartado postal", "apartado")

_P = rf"(?:{_S}|{_D}|[./])"
_EXT = rf"(?:,?{_S}?(?:ext\.?|extension|x|#|Durchwahl|poste){_S}?\d{{1,6}})?"
_PHONE = re.compile(
    rf"(?<![\w@.+/\-‐-–(])(?:"
    rf"\+\d{{1,3}}(?:{_P}?\(0\))?(?:{_P}?\(?\d{{1,8}}\)?){{1,7}}"  # international
    rf"|\(?00{_P}?[1-9]\d{{0,2}}(?:{_P}?\(0\))?(?:{_P}?\d{{1,11}}){{1,6}}"
    rf"|(?:1{_P})?(?:\([2-9]\d{{2}}\){_P}?|[2-9]\d{{2}}{_P}?)[2-9]\d{{2}}{_P}?\d{{4}}"  # three, three and four digits
    rf"|(?:\(0\d{{1,4}}\)|0\d{{1,10}})(?:{_P}?\d{{2,8}}){{0,5}}"  # with a trunk zero
    rf")(?![\w]){_EXT}",
)
#: Words before a number that is no phone.
_NOT_PHONE = re.compile(r"(?<![a-z])(?:isbn|issn|catalogue|catalog|docket|grant|invoice|order|version|(?<!phone )(?<!fax )(?<!mobile )(?:no\.|nr\.|number)|#|doi|id|ref\.?|serial|host|ip)[\s:]*$", re.I)

#: Signs that stand within or right before a phone number.
_PHONE_SIGNS = frozenset("0123456789+()/.") | {c for c in map(chr, range(0x3001)) if re.fullmatch(rf"{_S}|{_D}", c)}
#: No extension after a number is longer.
_EXT_CHARS = 24
#: Words before a number of seven or eight digits that is a phone.
PHONE_CUES = ("phone", "telephone", "tel", "call", "fax", "mobile", "cell", "dial", "ring", "telefon", "tel\u00e9fono", "t\u00e9l\u00e9phone", "anruf", "llame")
_LOCAL_PHONE = re.compile(rf"\.?:?(?:{_S}(?:number|no\.?|me|us|at|on|is|him|her|them|now|nummer)){{0,3}}:?{_S}{{0,3}}(\d{{3,4}}(?:{_S}|{_D})\d{{4}}|\d{{7,8}})(?![\w\-/])(?!{_P}\d)", re.I)

#: Capitalised words that are no given name.
_TITLE_WORDS = frozenset("The A An This That These Those In On At By To Of For From With And Or But If When While Mr Mrs Ms Miss Dr Prof Sir Dame Selon Según Nach Von Der Die Das Ein Eine Le La Les El Los Las Un Une Una According Thanks Regards Sincerely Signed Dear Under Near After Before Every Each Some Many Most Neither Nobody Whoever Although Perhaps Because Later Filed Copyright Share Read Page Am An Zur Zum Our Your His Her Their Its My All Any No Not Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August September October November December".split())
TITLES = ("mr", "mrs", "ms", "miss", "dr", "prof", "professor", "sir", "dame", "herr", "frau", "madame", "monsieur", "señor", "señora")
#: What stands before the name of whoever wrote or said something.
ATTRIBUTIONS = ("by", "according to", "selon", "según", "nach angaben von", "thanks to", "signed", "regards", "sincerely", "yours", "author", "dear")
#: Initials that stand for something else.
_NOT_INITIALS = frozenset("U.S D.C U.K U.N E.U N.Y L.A P.O B.C A.D P.S N.B Q.A E.G I.E A.M P.M".split())
_INSTITUTION = re.compile(rf"[\-'’]?{_S}(?:institute|street|st|road|avenue|lane|drive|square|medal|prize|award|university|college|school|foundation|society|museum|library|hospital|cent(?:re|er)|trust|hall|park|bridge|company|ltd|inc|gmbh|laboratory|laboratories|academy|station|house|books|press|group|records|media|news|times|registry|council|committee|team|institut|stiftung|universität|université)(?!\w)", re.I)
_INITIALS = rf"(?:{_S}?[A-Z]\.)*"
_WORD = r"[A-ZÀ-Þ][\w’'\-]+"
_BEFORE_FAMILY = re.compile(rf"(?<![\w'’.\-@/+])((?:[A-Z]\.{_S}?)+|({_WORD}){_S}(?:[A-Z]\.{_S}?)*)$")
#: What stands before a person: a title, an attribution, the mark of a signature.
_PERSON_NEXT = re.compile(rf"(?:\b(?:Mrs|Mr|Ms|Miss|Dr|Prof)\.?|\b(?:by|By|BY|to|von|Selon|Según|with|and)|[:,—–])[ \t\n    ]+$")
#: The same, where commas and most little words are no sign.
_CUE = re.compile(rf"(?:\b(?:Mrs|Mr|Ms|Miss|Dr|Prof)\.?|\b(?:by|By|BY|Selon|Según|Angaben von|(?:Thanks|According|according|belongs?) to|Regards,|Sincerely,)|[:—–])[ \t\n    ]+$")
_FAMILY_FIRST = re.compile(rf"(?<![\w'’.\-@/+])({_WORD}),{_S}$")
_AFTER_FAMILY = re.compile(rf",{_S}((?:[A-Z]\.(?:{_S}?[A-Z]\.)*)|({_WORD}){_INITIALS})(?!\w)")
_AFTER_GIVEN = re.compile(rf"{_INITIALS}{_S}({_WORD})")
_PARTICLE = rf"(?:(?:de|van|von|der|den|di|da|du|la|le|bin|al){_S})"
#: Two capitalised words, or initials and one, each possibly with initials or a particle between.
_PERSON = re.compile(rf"((?:[A-Z]\.{_S}?)+|({_WORD}){_S}(?:[A-Z]\.{_S}?)*){_PARTICLE}*({_WORD})(?!\w)")
_AFTER_TITLE = re.compile(rf"\.?{_S}+")
_AFTER_ATTRIBUTION = re.compile(r"[,:]?[ \t\n    ]{1,3}")
_MORE = re.compile(rf"{_S}({_WORD})")
_INITIALS_FIRST = re.compile(rf"((?:[A-Z]\.{_S}?)+)({_WORD})(?!\w)")
_SENTENCE_BEFORE = re.compile(r"[.!?][ \t    ]+$")
_LOWER_NEXT = re.compile(rf"{_S}[a-zß-ÿ]")
_BYLINE = re.compile(rf"{_S}([^\W\d_]+){_S}(?:[a-z]\.{_S}?)*([^\W\d_]+)(?![\w’'])")


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def back(text: str, at: int, words: int) -> int:
    """Where the given number of words before `at` begin, or the line, or a word that is too long."""
    i = at
    for _ in range(words):
        while i and text[i - 1] in " \t\u00a0\u2009\u202f":
            i -= 1
        stop = max(0, i - LONG_WORD)
        j = i
        while j > stop and not text[j - 1].isspace():
            j -= 1
        if j == i or (j == stop and j and not text[j - 1].isspace()):
            break
        i = j
    return i


#: Cues that are whole words.
WHOLE = frozenset(("name", "id", "call", "title", "attribution"))


class Finder:
    """Finds the values in a text. given and family: the known names."""

    def __init__(self, given: Iterable[str], family: Iterable[str]):
        import ahocorasick

        self.given = {n.strip().lower() for n in given if n and n.strip()}
        self.family = {n.strip().lower() for n in family if n and n.strip()}
        cues: dict[str, list[tuple[str, str]]] = {}
        for kind, words in (("at", ("@", "[at]", "(at)", "{at}", "[ at ]", "( at )")), ("dot", (" dot ",)), ("en", EN_STREETS), ("fr", FR_STREETS), ("es", ES_STREETS), ("de", DE_STREETS), ("box", BOXES), ("digits", [f"{i:02}" for i in range(100)]), ("initial", [f"{c}. " for c in "abcdefghijklmnopqrstuvwxyz"] + [f"{c}.\u00a0" for c in "abcdefghijklmnopqrstuvwxyz"]), ("call", PHONE_CUES), ("title", TITLES), ("attribution", ATTRIBUTIONS)):
            for w in words:
                cues.setdefault(w, []).append((kind, w))
        for w in ID_CUES:
            cues.setdefault(w, []).append(("id", w))
        for w in self.given | self.family:
            cues.setdefault(w, []).append(("name", w))
        self.cues = ahocorasick.Automaton()
        for w, what in cues.items():
            self.cues.add_word(w, (len(w), what))
        self.cues.make_automaton()

    def find(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) of each value, by start; values do not overlap."""
        if not text:
            return []
        low = _lower(text)
        n = len(text)
        by: dict[str, list[tuple[int, int, str]]] = {}
        for last, (size, what) in self.cues.iter(low):
            end = last + 1
            start = end - size
            for kind, w in what:
                if kind == "initial":
                    if start and (low[start - 1].isalnum() or low[start - 1] in "_.'’") or not text[start].isupper():
                        continue
                elif kind in WHOLE:
                    if (start and (low[start - 1].isalnum() or low[start - 1] == "_")) or (end < n and (low[end].isalnum() or low[end] == "_")):
                        continue
                elif kind == "en" or kind == "fr":
                    if start < 3 or low[start - 1].isalnum() or (end < n and low[end].isalnum()):
                        continue
                by.setdefault(kind, []).append((start, end, w))
        out: list[tuple[str, int, int]] = []
        taken = bytearray(n)

        def add(kind: str, s: int, e: int) -> None:
            if not any(taken[s:e]):
                taken[s:e] = b"\1" * (e - s)
                out.append((kind, s, e))

        for s, e, _ in by.get("at", ()):
            if got := self._email(text, s, e):
                add("email", *got)
        for s, _, _ in by.get("dot", ()):
            for m in _AT_WORD.finditer(text, max(0, back(text, s, 6) - 1), s):
                if (got := self._email(text, m.start(1), m.end(1))) and got[1] > s:
                    add("email", *got)
        for _, e, w in by.get("id", ()):
            if (m := _ID[ID_CUES[w]].match(text, e)) and any(c.isdigit() for c in m[1]):
                add("id", m.start(1), m.end(1))
        for kind in ("box", "en", "fr", "es", "de"):
            for s, e, w in by.get(kind, ()):
                if got := self._address(text, kind, s, e):
                    add("address", *got)
        for _, e, _ in by.get("call", ()):
            if m := _LOCAL_PHONE.match(text, e):
                add("phone", m.start(1), m.end(1))
        done = 0
        for s, e, _ in by.get("digits", ()):
            if s < done:
                continue
            while s > done and text[s - 1] in _PHONE_SIGNS:
                s -= 1
            while e < n and text[e] in _PHONE_SIGNS:
                e += 1
            for m in _PHONE.finditer(text, s, min(n, e + _EXT_CHARS)):
                if m.start() >= e:
                    break
                body = re.split(r"(?i)ext|x|#|durchwahl|poste", m[0])[0]
                digits = sum(c.isdigit() for c in body)
                if 9 <= digits <= 15 and not _NOT_PHONE.search(text, back(text, m.start(), 3), m.start()):
                    add("phone", *m.span())
            done = e
        for s, e, w in by.get("name", ()):
            if not taken[s] and (got := self._name(text, low, s, e, w)):
                add("name", *got)
        for s, e, _ in by.get("title", ()):
            if (text[s].isupper()) and (m := _AFTER_TITLE.match(text, e)) and (got := self._person(text, m.end(), True)):
                add("name", *got)
        for s, e, w in by.get("attribution", ()):
            if (m := _AFTER_ATTRIBUTION.match(text, e)) and (got := self._person(text, m.end(), False)):
                add("name", *got)
            elif w == "by" and text[s].islower() and (not s or text[s - 1] == "\n") and (m := _BYLINE.match(text, e)):
                if m[1].islower() and m[2].islower() and (m[1] in self.given or m[2] in self.family):
                    add("name", m.start(1), m.end())
        for s, _, _ in by.get("initial", ()):
            if not taken[s] and (got := self._initials(text, s)):
                add("name", *got)
        out.sort(key=lambda x: x[1])
        return out

    @staticmethod
    def _email(text: str, s: int, e: int) -> tuple[int, int] | None:
        d = _DOMAIN.match(text, e, min(len(text), e + 320))  # a domain has at most 253 characters, its dots may be spelled
        if not d:
            return None
        left = s - 1 if s and text[s - 1] in " \t   " else s
        lo = left
        while lo and lo > left - 64 and (text[lo - 1].isascii() and (text[lo - 1].isalnum() or text[lo - 1] in "._%+-")):
            lo -= 1
        m = _LOCAL.search(text, lo, left)
        return (m.start(), d.end(1)) if m else None

    @staticmethod
    def _address(text: str, kind: str, s: int, e: int) -> tuple[int, int] | None:
        n = len(text)
        if kind == "box":
            if s and text[s - 1].isalnum() or not (m := _BOX_AFTER.match(text, e)):
                return None
            start, end = s, m.end()
        elif kind == "en":
            if not text[s].isupper() or not (m := _EN_BEFORE.search(text, back(text, s, 5), s)):
                return None
            start, end = m.start(1), e + (text[e : e + 1] == "." and e - s < 5)
        elif kind == "fr":
            if not (m := _FR_BEFORE.search(text, back(text, s, 2), s)) or not (a := _FR_AFTER.match(text, e)):
                return None
            start, end = m.start(1), a.end()
        elif kind == "es":
            if s and text[s - 1].isalnum() or not (a := _ES_AFTER.match(text, e)):
                return None
            start, end = s, a.end()
        else:
            if not (a := _DE_AFTER.match(text, e)):
                return None
            start = s
            while start and s - start < LONG_WORD and (text[start - 1].isalpha() or text[start - 1] == "-"):
                start -= 1
            if start == s:  # a word of its own: the street's name stands before it
                if not text[s].isupper() or not (m := _DE_BEFORE.search(text, back(text, s, 2), s)):
                    return None
                start = m.start(1)
            if not text[start].isupper():
                return None
            end = a.end()
        if t := _TOWN.match(text, end):
            end = t.end()
        return start, end

    def _is_family(self, w: str) -> bool:
        return re.split(r"[\-'’]", w.lower())[0] in self.family

    def _is_given(self, w: str) -> bool:
        return w.lower() in self.given

    def _name(self, text: str, low: str, s: int, e: int, w: str) -> tuple[int, int] | None:
        """A name around a listed one."""
        if not text[s].isupper() or (text[s + 1 : s + 2].isupper() and not text[s:e].isupper()):
            return None
        n = len(text)
        if s > 1 and text[s - 1] in "-'’" and text[s - 2].isalpha():  # the second part of a double name: its first part decides
            k = s - 1
            while k and s - k < LONG_WORD and (text[k - 1].isalpha() or text[k - 1] in "-'’"):
                k -= 1
            if not text[k].isupper():
                return None
            s, w = k, low[k : s - 1]
        if w in self.given:
            m = _AFTER_GIVEN.match(text, e)
            if m and m[1] not in _TITLE_WORDS and len(m[1]) > 2 and not _INSTITUTION.match(text, m.end()) and not _INSTITUTION.match(text, m.start(1) - 1) and (self._is_family(m[1]) or (m[1].isupper() == text[s:e].isupper() and not self._is_given(m[1]))):
                return s, m.end()
            m = _FAMILY_FIRST.search(text, back(text, s, 1), s)
            if m and m[1] not in _TITLE_WORDS and m[1].isupper() == text[s:e].isupper() and (e == n or not text[e].isalnum()) and _CUE.search(text, back(text, m.start(1), 2), m.start(1)):
                return m.start(1), e
            return None
        while e < n and (text[e].isalpha() or (text[e] in "-'’" and e + 1 < n and text[e + 1].isupper())):
            e += 1
        if _INSTITUTION.match(text, e):
            return None
        if m := _BEFORE_FAMILY.search(text, back(text, s, 5), s):
            if m[2] is None or self._is_given(m[2]):
                return m.start(1), e
            unlisted = len(m[2]) > 2 and m[2].isupper() == text[s:e].isupper() and m[2].capitalize() not in _TITLE_WORDS and m[2].lower() not in self.family
            if unlisted and _CUE.search(text, back(text, m.start(1), 2), m.start(1)):
                return m.start(1), e
            if i := re.search(rf"((?:[A-Z]\.{_S}?)+)$", m[1]):  # a word that is no given name, then initials
                return m.start(1) + i.start(1), e
        if m := _AFTER_FAMILY.match(text, e):
            if m[2] is None or self._is_given(m[2]):
                return s, m.end(1)
        return None

    def _person(self, text: str, at: int, title: bool) -> tuple[int, int] | None:
        """A name at a place where a title or an attribution says that a person follows; neither part need be listed."""
        m = _PERSON.match(text, at)
        if not m or m[3].capitalize() in _TITLE_WORDS or _INSTITUTION.match(text, m.end()) or _INSTITUTION.match(text, m.start(3) - 1):
            return None
        end = m.end()
        if m[2] is None:
            return m.start(), end
        if m[2].capitalize() in _TITLE_WORDS or m[2].isupper() != m[3].isupper():
            return None
        if more := _MORE.match(text, end):  # a third capitalised word: a family name after a title, else the name of something
            if not title or _INSTITUTION.match(text, more.end()) or more[1] in _TITLE_WORDS:
                return None
            end = more.end()
        if not title and m[2].isupper():  # in a line of capitals every word looks like a name
            return None
        return m.start(), end

    def _initials(self, text: str, s: int) -> tuple[int, int] | None:
        """Initials and a capitalised word, neither after a title nor with a listed name: two initials, or one that begins a sentence."""
        m = _INITIALS_FIRST.match(text, s)
        if not m or m[2].isupper() or m[2] in _TITLE_WORDS or _INSTITUTION.match(text, m.end()):
            return None
        letters = re.findall(r"[A-Z]", m[1])
        if len(letters) > 1:
            return None if ".".join(letters) in _NOT_INITIALS else (s, m.end())
        before = back(text, s, 2)
        if _PERSON_NEXT.search(text, before, s) or (_SENTENCE_BEFORE.search(text, before, s) and _LOWER_NEXT.match(text, m.end())):
            return s, m.end()
        return None


def _known(names: DataFrame) -> tuple[list[str], list[str]]:
    rows = names.where("name is not null").select("name", F.lower(F.trim("kind")).alias("kind")).distinct().limit(MAX_NAMES + 1).collect()
    if len(rows) > MAX_NAMES:
        raise ValueError(f"the name list has more than {MAX_NAMES} entries")
    return sorted(r[0] for r in rows if r[1] == "given"), sorted(r[0] for r in rows if r[1] == "family")


def find_pii(df: DataFrame, names: DataFrame, id_col: str = "document_id", text: str = "normalized_text", redact: bool = False) -> DataFrame:
    """(document_id, found) of each row, and redacted_text if redact; found: array of struct<pii_type, start_pos, end_pos>.

    Positions count code points. Null and empty texts have an empty array; a null text stays null.
    """
    given, family = _known(names)
    d = df.select(F.col(id_col).alias("document_id"), F.col(text).cast("string").alias("text"))
    id_type = d.schema["document_id"].dataType.simpleString()
    kind = pa.struct([("pii_type", pa.string()), ("start_pos", pa.int64()), ("end_pos", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(given, family)
        for b in batches:
            texts = b.column("text").to_pylist()
            found = [finder.find(x) for x in texts]
            flat = [v for f in found for v in f]
            ends = [0]
            for f in found:
                ends.append(ends[-1] + len(f))
            values = pa.StructArray.from_arrays([pa.array([v[i] for v in flat], kind.field(i).type) for i in range(3)], fields=list(kind))
            cols, cols_names = [b.column("document_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], ["document_id", "found"]
            if redact:
                cols.append(pa.array([replaced(x, f) for x, f in zip(texts, found, strict=True)], pa.string()))
                cols_names.append("redacted_text")
            yield pa.RecordBatch.from_arrays(cols, names=cols_names)

    schema = f"document_id {id_type}, found array<struct<pii_type:string,start_pos:bigint,end_pos:bigint>>" + ", redacted_text string" * redact
    return d.mapInArrow(run, schema)


def replaced(text: str | None, found: list[tuple[str, int, int]]) -> str | None:
    """The text with each value replaced by the placeholder of its kind."""
    if text is None or not found:
        return text
    out, at = [], 0
    for kind, s, e in found:
        out += [text[at:s], PLACEHOLDER[kind]]
        at = e
    return "".join([*out, text[at:]])


def pii_values(df: DataFrame, names: DataFrame, id_col: str = "document_id", text: str = "normalized_text") -> DataFrame:
    """(document_id, pii_type, start_pos), one row per value; a document delivered twice counts once."""
    found = find_pii(df, names, id_col, text).select("document_id", F.explode("found").alias("v"))
    return found.select("document_id", "v.pii_type", "v.start_pos").distinct()
