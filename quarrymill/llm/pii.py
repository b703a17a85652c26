"""Personal information in free text: weak labelers, their reliabilities by expectation-maximisation, a span classifier.

Candidate spans come from shapes alone: numbers, addresses, mail addresses, and for names every two capitalised words side by side (with initials and particles), every "Family, Given" and every two
Arabic words that some labeler has a word for. For each candidate several labelers vote for (1), against (-1) or not at all (0): the shape of the span, a gazetteer of given names, the words before it, the words
after it, words that mark other things, and what the corpus itself teaches. The last is learned from all documents (`Names`): the contexts in which listed given names
stand far more often than other capitalised words, the family names that follow listed given names, and the given names that precede those.

Expectation-maximisation over the candidates of all documents estimates for each kind and labeler how often it is right when it votes, and with that the probability of each candidate. A logistic
classifier is trained on these probabilities, with votes and plain features of the span, and decides on all spans. Both need only how often each combination of kind, votes and length occurs
(`PATTERNS` at most), so nothing is sampled. The texts are searched once: candidates go to the checkpoint folder (`_searched`), and learning and deciding read them from there.
"""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate
from operator import sub

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import texts_of
from quarrymill.session import durable, ensure_checkpoint_dir

KINDS = ("email", "phone", "id_number", "address", "name")
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[NAME]"}

#: Given names common in the languages of the documents; a name outside the list is found by its family name, its title or its context.
GIVEN_NAMES = set(
    """ahmed aisha ali alice amira ana anna anouk antoine bao camille carlos carmen chiara clara claire daniel dana david elena elif emma eva
    fatima felipe felix francesca greta hana hans hassan ibrahim idris ingrid ines isabel ivan jan jean jonas jose juan julia karim khalid lars laura
    leila lena luca lucia luis maria mariam marie marta martin mehmet mei michael mohammed mona nadia nils noor olga omar oscar pablo paul pavel
    peter petra pierre rafael rania rosa ruth said salma samir samira sara sofia sophie stefan susan tarik thomas tomas viktor yasmin youssef yuna yusuf zainab""".split()
)
GIVEN_NAMES_AR = set("ليلى عمر أميرة كريم سلمى نادية رانيا هناء طارق سميرة إدريس أحمد محمد علي فاطمة مريم خالد يوسف حسن حسين ياسمين نور سارة منى زينب إبراهيم عائشة ريم هدى سعيد سمير دانا".split())

_LOW, _UP = "a-zà-öø-ÿß", "A-ZÀ-ÖØ-Þ"
_WORD_CAP = rf"[{_UP}][{_LOW}'’]+"
_CAP = rf"{_WORD_CAP}(?:-{_WORD_CAP})?"
_CAPS_WORD = rf"[{_UP}]{{2,}}(?:-[{_UP}]{{2,}})?"
_PARTICLES = {"van", "von", "de", "der", "bin", "al", "el", "di", "da", "le"}
_PARTICLE = rf"(?: (?:{'|'.join(sorted(_PARTICLES))})\b)*"
#: Capitalised words side by side.
#: Here and below a pattern begins with what a span can begin with, which is found fast, and then looks back.
_RUN = re.compile(rf"[{_UP}](?<![\w@.+-].)(?:[{_LOW}'’]+(?:-{_WORD_CAP})?(?:(?: [{_UP}]\.)?{_PARTICLE} {_CAP})+|[{_UP}]+(?:-[{_UP}]{{2,}})?(?:(?: [{_UP}]\.)? {_CAPS_WORD})+)(?!\w)")
_RUN_WORD = re.compile(r"\S+")
_LISTED_NAME = re.compile(rf"[{_UP}](?<![\w@.+-].)(?:[{_LOW}'’]+, (?P<g>(?!Tel\b){_CAP}(?: [{_UP}]\.)?)(?![{_LOW}])|[{_UP}]{{2,}}, (?P<G>[{_UP}]{{3,}})(?![\w]))")
_TITLE = re.compile(r"(?:\b(?:Dr|Prof|Mr|Mrs|Ms|Mme|Mlle|M|Herr|Frau|Sr|Sra|Dña|Don)\.? )+$")
_TITLE_WORDS = {"dr", "prof", "mr", "mrs", "ms", "mme", "mlle", "m", "herr", "frau", "sr", "sra", "dña", "don", "السيد", "السيدة", "الدكتور", "الدكتورة"}
_ARABIC_RUN = re.compile(r"[ء-ي]+(?: [ء-ي]+)+")
_ARABIC_PARTICLES = {"بن", "بنت", "أبو"}
_UNIT_BEFORE = re.compile(r"(?:\b(?:of|for|in|on|the|The|de|des|du|für|Institute|Chair|Centre|Department|prize|fellowship|Course|Hall|Room|Building)) $")
_UNIT_WORD = re.compile(r"(?i)(?:institut|universit|centre|center|zentrum|department|faculty|school|college|lab|hall|room|building|street|road|avenue|prize|award|library|museum|campus|course|chair|group|project|programm?e?|society|lecture)\w*$")
_UNIT_AFTER = re.compile(r"^ (?:Institute|Centre|Center|Prize|Award|Hall|Lecture|Fellowship|Library|Building|Chair|Foundation|School|Street|Road|Lab)\b")
_AROUND = re.compile(r"\s*(?:\w+|[^\w\s])")
_TOKEN = re.compile(r"\w+|[^\w\s]")
_NEXT_TWO = re.compile(r"\s*(\w+|[^\w\s])(?:\s*(\w+|[^\w\s]))?")
_WORD_CUT = re.compile(r"\w\w")
_DIGITS = re.compile(r"\d+")
_ARABIC = re.compile("[ء-ي]")
_LOWER_WORD = re.compile(rf"(?<![\w.@+-])[{_LOW}]{{2,}}(?![\w.@+-])")

_EMAIL = re.compile(r"[\w.+%-]*\w(?: ?@ ?| ?\[at\] ?| ?\(at\) ?| ?\{at\} ?)[A-Za-z0-9-]+(?:(?:\.| ?\[dot\] ?| ?\(dot\) ?| ?\{dot\} ?)[A-Za-z0-9-]+)+")
_EMAIL_START = re.compile(r"(?<![\w.+%-])" + _EMAIL.pattern)
_EMAIL_AT = re.compile(r"@|[\[({]at[\])}]")
_EMAIL_HEAD = re.compile(r"[\w.+%-]+ ?$")
_NUMBER = re.compile(
    r"[\d٠-٩+(A-Z](?:(?<![\w.,/+٠-٩-].)(?:(?<=\+)[\d٠-٩]|(?<=\()\+?[\d٠-٩]|(?<=[\d٠-٩]))(?:[\d٠-٩]|[ ()/-](?=[\d٠-٩( ])|\.(?=[\d٠-٩])){4,24}[\d٠-٩][A-Z]?(?:(?:,? ?(?:ext\.?|extension|x|Durchwahl|App\.|poste|extensión|تحويلة) ?)\d{1,5})?(?![\w])"
    r"|(?<=[A-Z])(?<![\w-].)[A-Z]?\d{6,9}(?![\w-]))"
)
#: What every such number holds, and not more than two characters after its start.
_NUMBER_CORE = re.compile(r"\d[\d ()/.-]{4,24}\d")
_ID_BEFORE = re.compile(
    r"(?:passport|identity card|national ID|Emirates ID|student|residence permit|social security|Pass|Ausweis|Personalausweis|passeport|identité|séjour|pasaporte|identidad|NIE|DNI|الهوية|السفر|الإقامة|الطالب)(?: ?(?:number|card|no\.|No\.|n°|nº|nummer|numéro|número|nr\.|#))?[ :]*$", re.I
)
_PHONE_BEFORE = re.compile(
    r"(?:\bTel\.?|\bcall|\breached on|\bunder|\bnumber,|\bphone|\bfax|\bmobile|\bappelez le|\bllame al|\brufen Sie|\bTél\.?|\bTeléfono|على|هاتف|: [^.;:|]{3,40},|; [^;|]{5,40};)[ :]*$|(?:^|\n)[-* ]*$", re.I
)
_PHONE_SHAPE = re.compile(
    r"\+\d{1,3}[ -]?(?:\(0\))?[\d ()-]{6,16}(?:[ ,]*ext\.? ?\d+)?|\(\d{3}\) \d{3}-\d{4}|0\d{2,4}[ /-]\d{3,6}[ -]?\d{0,6}(?:[ ,]*ext\.? ?\d+)?|00\d{1,4}-\d{1,3}-\d{5,8}|\d{3}\.\d{3}\.\d{4}|0\d(?:[ .]\d\d){4}|[٠-٩]{4} [٠-٩]{3} [٠-٩]{4}|\d{3}-\d{3}-\d{4}"
)
_ID_SHAPE = re.compile(r"784-\d{4}-\d{7}-\d|[A-Z]{2}\d{7}|[A-Z]\d{8}|\d{9}[A-Z]|\d{8}[A-Z]?|\d{3}-\d{2}-\d{4}|\d{4} \d{4} \d{4}")
_OTHER_BEFORE = re.compile(r"(?:\bDOI|\bISBN|\bISSN|shelf mark|\bpages?|\bvolume|\bSensor|\bVersion|replaced|\bgrant|\breport|\bCourse [A-Z]{2,4}|logged|between|\bNV|المنحة|التقرير|subvention|Projekt|proyecto|Dataset|order|invoice|[$€£])[ :.-]*$", re.I)
_OTHER_AFTER = re.compile(r"^ ?(?:[NSEW]\b|readings|rows|credits|percent|%|crédits|créditos|of the)")

_STREET_EN = r"(?:Street|Road|Lane|Row|Court|Close|Avenue|Way|Crescent|Hill|Square|Place|Drive|Walk|Gate|Mews|Terrace|St\.|Rd\.|Ave\.|Blvd\.)"
_CAPS = rf"[{_UP}][\w’'-]+(?: [{_UP}][\w’'-]+){{0,3}}"
_TOWN = rf"[{_UP}][\w’'-]+(?: [{_UP}][\w’'-]+)?"
_ADDRESSES = [
    re.compile(rf"(?:(?:Flat|Apartment|Apt|Unit) \w{{1,5}}, )?\b\d{{1,5}}[a-z]? (?:[{_UP}][\w’'-]+ ){{1,3}}{_STREET_EN}, (?:(?:Apt|Unit|Suite|Flat)\.? \w{{1,5}}, )?[{_UP}][\w’'-]+(?:, [A-Z]{{2}} \d{{5}}| [A-Z]{{1,2}}\d{{1,2}}[A-Z]? \d[A-Z]{{2}})?"),
    re.compile(rf"\b(?:Flat|Villa|Apartment|Apt) \w{{1,5}}, (?:Building \w{{1,4}}, )?Street \d{{1,4}}, (?:[{_UP}][\w’'-]+ ){{1,3}}District, [{_UP}][\w’'-]+"),
    re.compile(rf"\b\d{{1,4}}(?: ?(?:bis|ter))? (?:rue|avenue|impasse|boulevard|place|chemin|allée|quai|route|cours|square) [^,.;\n]{{2,40}}, (?:(?:appt|bât)\.? [^,\n]{{1,10}}, )?\d{{5}} {_TOWN}"),
    re.compile(rf"\b(?:Calle|Avenida|Plaza|Paseo|Camino|Ronda|Travesía|C/|Avda\.|Pza\.) ?[^,.;\n]{{2,40}}? \d{{1,4}}(?:, [^,\n]{{1,14}}){{0,2}}, \d{{5}} {_TOWN}"),
    re.compile(rf"(?:(?:Am|An der|Auf der|Im|In der|Zum|Zur|Alter|Alte|Neue|Neuer|Unter den) )?[{_UP}][\w’'-]+(?: (?:Straße|Str\.|Weg|Platz|Allee|Gasse|Ufer|Ring))? \d{{1,4}} ?[a-z]?, \d{{5}} {_TOWN}"),
    re.compile(r"(?:(?:شقة|فيلا) [\d٠-٩]{1,5}، )?شارع [ء-ي ]{2,30} [\d٠-٩]{1,5}، حي [ء-ي ]{2,25}، [ء-ي]{3,}"),
]


def _any_of(*parts: str) -> Callable[[str], object]:
    return lambda text: any(map(text.__contains__, parts))


#: What a text must hold to be worth an address pattern; the ends of words for streets are found faster than the words, and postcodes with towns fastest of all.
_STREET_END = re.compile(rf", (?<=(?:eet|oad|ane|Row|urt|ose|nue|Way|ent|ill|are|ace|ive|alk|ate|ews|St\.|Rd\.|ve\.|vd\.), )[{_UP}]")
_STREET = _any_of(*(f"{w}, " for w in "Street Road Lane Row Court Close Avenue Way Crescent Hill Square Place Drive Walk Gate Mews Terrace St. Rd. Ave. Blvd.".split()))
_CODE_AND_TOWN = re.compile(rf", \d{{5}} [{_UP}]")
_RUE = _any_of("rue ", "avenue ", "impasse ", "boulevard ", "place ", "chemin ", "allée ", "quai ", "route ", "cours ", "square ")
_CALLE = _any_of("Calle", "Avenida", "Plaza", "Paseo", "Camino", "Ronda", "Travesía", "C/", "Avda.", "Pza.")


def _address_patterns(text: str) -> Iterator[re.Pattern]:
    """Those of `_ADDRESSES` that may match."""
    if _STREET_END.search(text) and _STREET(text):
        yield _ADDRESSES[0]
    if "District, " in text:
        yield _ADDRESSES[1]
    if _CODE_AND_TOWN.search(text):
        if _RUE(text):
            yield _ADDRESSES[2]
        if _CALLE(text):
            yield _ADDRESSES[3]
        yield _ADDRESSES[4]
    if "شارع" in text:
        yield _ADDRESSES[5]


_ADDRESS_BEFORE = re.compile(r"(?:lives at|moved to|address|domicilié au|domicilio en|wohnhaft|المقيم في|المقيمة في|zu) $")
_POSTCODE = re.compile(r"\b\d{5}\b|\b[A-Z]{1,2}\d{1,2}[A-Z]? \d[A-Z]{2}\b|District|حي ")

#: A line break inside a hard-wrapped sentence; as a blank of the same length it leaves all places as they are.
_WRAP = re.compile(r"\n(?<=[^\n.!?؟:;]\n)(?=[^\n\s#|*-])(?!\d+[.)] )")

LABELERS = ("shape", "gazetteer", "before", "after", "other", "learned")
#: A context is a cue if it stands beside listed names so many times as often (in logarithms) as beside other capitalised words, and at least so often.
CUE_ODDS = 3.0
CUE_COUNT = 4
#: A word is ordinary if it stands so often in lower case, and at least in this share of its uses as part of a name-shaped span; shares hold for corpora of any size.
COMMON_COUNT = 3
COMMON_SHARE = 0.1
#: A name is learned if at least this share of its uses in name-shaped spans is beside known names.
NAME_SHARE = 0.05

_POWERS = 3 ** np.arange(len(LABELERS))
#: Kinds, four lengths, three votes of each labeler.
PATTERNS = len(KINDS) * 4 * 3 ** len(LABELERS)
#: Flags of a name-shaped span: listed given name, title before it, a unit's words after and before it, words that name units; the length comes on top.
_LISTED, _TITLED, _UNIT_NEXT, _UNIT_LAST, _UNIT_FAMILY, _UNIT_GIVEN, _LENGTH = (1 << n for n in range(7))
_WORDS = ("given", "family", "before", "after")
_FOUND = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("marks", pa.int32()), *((c, pa.string()) for c in _WORDS)])


def _plain(tokens: str) -> str:
    return _DIGITS.sub("0", tokens.lower())


class _Around:
    """The words and signs of a text, digits as one sign, to tell what stands right before and right after a place: up to two of them."""

    def __init__(self, text: str):
        self.text = text
        spaced = _AROUND.findall(text)  # each with the blanks before it, so that lengths give the places
        tokens = list(map(str.lstrip, spaced))
        self.ends = list(accumulate(map(len, spaced)))
        self.starts = list(map(sub, self.ends, map(len, tokens)))
        self.tokens = _plain("\n".join(tokens)).split("\n")

    def both(self, start: int, end: int) -> tuple[str, str]:
        """What stands before `start` and what stands after `end`."""
        tokens, starts = self.tokens, self.starts
        i, j = bisect_left(starts, start), bisect_left(starts, end)
        if i > 1 and starts[i - 2] >= start - 40 and self.ends[i - 1] <= start and (last := tokens[i - 1]) != "." and last not in _TITLE_WORDS:
            before = f"{tokens[i - 2]} {last}"
        else:
            before = self._before(i, start)
        if j + 1 < len(starts) and starts[j + 1] < end + 30 and self.ends[j - 1] <= end:
            return before, f"{tokens[j]} {tokens[j + 1]}"
        return before, self._after(j, end)

    def _before(self, i: int, start: int) -> str:
        first = max(0, i - 3)
        while first < i and self.starts[first] < start - 40:
            first += 1
        got = self.tokens[first:i]
        if got and self.ends[i - 1] > start:
            got[-1] = _plain(self.text[self.starts[i - 1] : start])
        return _last_two(got)

    def _after(self, i: int, end: int) -> str:
        got = [t for t, s in zip(self.tokens[i : i + 2], self.starts[i : i + 2]) if s < end + 30]
        if i and self.ends[i - 1] > end:
            got.insert(0, _plain(self.text[end : self.ends[i - 1]]))
        return " ".join(got[:2])


def _search_arabic(text: str, around: _Around, listed: set[str], columns: tuple[list, ...], add: Callable[..., None], outside: Callable[[int, int], int]) -> None:
    """Adds all windows of Arabic words: those after a run's first at once, where its words are tokens and each window has two tokens right before and right after it."""
    tokens, starts, ends = around.tokens, around.starts, around.ends
    pairs = [f"{one} {two}" for one, two in zip(tokens, tokens[1:])]
    for m in _ARABIC_RUN.finditer(text):
        first, last = bisect_left(starts, m.start()), bisect_left(starts, m.end()) - 1
        rest = first + 1
        if (
            0 < first < last - 1 and last + 2 < len(starts) and starts[first] == m.start() and ends[last] == m.end()
            and _ARABIC_PARTICLES.isdisjoint(tokens[rest:last]) and _TITLE_WORDS.isdisjoint(tokens[first : last - 1])
            and max(map(sub, starts[rest:last], starts[rest - 2 : last - 2])) <= 40 and max(map(sub, starts[rest + 3 : last + 3], ends[rest + 1 : last + 1])) < 30
        ):
            start, stop = starts[first], ends[rest]
            add(start, stop, outside(start, stop), tokens[first], tokens[rest], *around.both(start, stop))
            begin, end, given = starts[rest:last], ends[rest + 1 : last + 1], tokens[rest:last]
            marks = [-1 - _LENGTH * ((n > 8) + (n > 11) + (n > 20)) - (_LISTED if g in listed else 0) for n, g in zip(map(sub, end, begin), given)]
            # within the run nothing Latin is near
            marks[-1] -= outside(begin[-1], end[-1])
            for column, more in zip(columns, (begin, end, marks, given, tokens[rest + 1 : last + 1], pairs[rest - 2 : last - 2], pairs[rest + 2 : last + 2])):
                column += more
        else:
            for start, stop, one, two in _arabic_windows(m):
                add(start, stop, outside(start, stop), one, two, *around.both(start, stop))


def _last_two(got: list[str]) -> str:
    while len(got) > 1 and (got[-1] in _TITLE_WORDS or got[-1] == "." and got[-2] in _TITLE_WORDS):
        got.pop()  # a title says enough by itself
    return " ".join(got[-2:])


def _beside(text: str, start: int, end: int) -> tuple[str, str]:
    """What `_Around.both` gives, for texts with few spans."""
    # mostly plain words between blanks
    got = text[max(0, start - 40) : start].rsplit(" ", 3)
    plain = len(got) == 4 and not got[3] and got[1].isalpha() and got[2].isalpha() and got[2].lower() not in _TITLE_WORDS
    before = f"{got[1]} {got[2]}".lower() if plain else _right_before(text, start)
    got = text[end : end + 30].split(" ", 3)
    if len(got) == 4 and not got[0] and got[1].isalpha() and got[2].isalpha():
        return before, f"{got[1]} {got[2]}".lower()
    m = _NEXT_TWO.match(text, end)
    if m is None or m.start(1) >= end + 30:
        return before, ""
    return before, _plain(f"{m[1]} {m[2]}" if m[2] and m.start(2) < end + 30 else m[1])


def _right_before(text: str, start: int) -> str:
    got = _TOKEN.findall(text, max(0, start - 24), start)
    if len(got) < 4:
        at = max(0, start - 40)
        got = _TOKEN.findall(text, at, start)
        if at and got and _WORD_CUT.match(text, at - 1):
            del got[0]
    return _last_two(_plain("\n".join(got[-3:])).split("\n"))


def _name_windows(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, given, family) of all spans with the shape of a name."""
    out = []
    for m in _RUN.finditer(text):
        if m.group().count(" ") == 1:
            given, _, family = m.group().lower().partition(" ")
            out.append((*m.span(), given, family))
            continue
        words = [(w.start() + m.start(), w.end() + m.start(), w.group()) for w in _RUN_WORD.finditer(m.group())]
        caps = [n for n, w in enumerate(words) if w[2] not in _PARTICLES and not w[2].endswith(".")]
        for i, j in zip(caps, caps[1:]):
            out.append((words[i][0], words[j][1], words[i][2].lower(), words[j][2].lower()))
    for m in _LISTED_NAME.finditer(text):
        given = re.sub(r" .*", "", m.group("g") or m.group("G"))
        out.append((m.start(), m.end(), given.lower(), m.group().partition(",")[0].lower()))
    return out


def _arabic_windows(run: re.Match) -> Iterator[tuple[int, int, str, str]]:
    """The same of a run of Arabic words."""
    words = run.group().split(" ")
    at = run.start()
    for i, (given, family) in enumerate(zip(words, words[1:])):
        following = at + len(given) + 1
        end = following + len(family)
        if family in _ARABIC_PARTICLES and i + 2 < len(words):
            family = words[i + 2]
            end += 1 + len(family)
        yield at, end, given, family
        at = following


class Names:
    """What a corpus teaches about names, starting from the listed given names (`listed`).

    `common` are words of name-shaped spans that are ordinary words; `before` and `after` the contexts that are cues; `families` and `givens` the learned names.
    """

    def __init__(self, listed: set[str], common: set[str], before: set[str], after: set[str], families: set[str], givens: set[str]):
        self.listed, self.common, self.before, self.after, self.families, self.givens = listed, common, before, after, families, givens

    def is_listed(self, given: str) -> bool:
        return is_listed(given, self.listed)

    def cued(self, before: pa.Array, after: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return _each(before, lambda c: c in self.before or c.rpartition(" ")[2] in self.before), _each(after, lambda c: c in self.after or c.partition(" ")[0] in self.after)

    def patterns(self, found: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each candidate its pattern (kind, votes, length), whether training takes it, and whether something speaks for it."""
        pattern = found.field("marks").to_numpy().astype(np.int64)
        train, speaks = np.ones(len(pattern), bool), np.ones(len(pattern), bool)
        at = np.flatnonzero(pattern < 0)
        if len(at):
            marks = -1 - pattern[at]
            given, family, before, after = (found.field(c).take(pa.array(at)) for c in _WORDS)
            listed, titled = marks & _LISTED > 0, marks & _TITLED > 0
            common = _each(given, self.common.__contains__)
            ordinary = common | _each(family, self.common.__contains__)
            learned = _each(family, self.families.__contains__) | _each(given, self.givens.__contains__)
            cue, after_cue = self.cued(before, after)
            cue |= titled
            unit = (marks & _UNIT_NEXT > 0) | (marks & _UNIT_LAST > 0) & ~cue
            against = -1 * ordinary
            votes = np.stack([np.ones(len(at)), np.where(listed, 1, against), cue, after_cue, -1 * unit, np.where(learned, 1, against)], axis=1).astype(np.int64)
            pattern[at] = _pattern(KINDS.index("name"), votes, marks // _LENGTH)
            train[at] = (marks & _UNIT_FAMILY == 0) | listed
            speaks[at] = train[at] & (listed | ~common) & (listed | learned | titled | cue & after_cue)
        return pattern, train, speaks


def is_listed(given: str, listed: set[str]) -> bool:
    return given in listed or "-" in given and all(p in listed for p in given.split("-"))


def _each(values: pa.Array, test: Callable[[str], bool]) -> np.ndarray:
    coded = values.dictionary_encode()
    return np.array([bool(test(v)) for v in coded.dictionary.to_pylist()], bool)[coded.indices.to_numpy()]


def _pattern(kind: int, votes: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    return (kind * 4 + length) * 3 ** len(LABELERS) + (votes + 1) @ _POWERS


def _of_pattern(pattern: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, votes, length) of each pattern."""
    rest, votes = np.divmod(pattern, 3 ** len(LABELERS))
    return rest // 4, (votes[:, None] // _POWERS % 3 - 1).astype(float), rest % 4


def learned_names(texts: list[str], given: set[str] | None = None) -> Names:
    """`Names` of texts at hand; `_learned` is the same of a table."""
    listed = given if given is not None else GIVEN_NAMES | GIVEN_NAMES_AR
    found, tokens = searched(pa.array(texts, pa.string()), listed)
    lower = _lower_words(tokens)
    marks, *words = (found.values.field(c).to_pylist() for c in ("marks", *_WORDS))
    windows = [(*w, -1 - m) for m, *w in zip(marks, *words) if m < 0]
    first, second = Counter(w[0] for w in windows), Counter(w[1] for w in windows)
    common = {w for w, n in lower.items() if (u := first[w] + second[w]) and n >= COMMON_COUNT and n >= COMMON_SHARE * u}
    cues = []
    for side, one in ((2, lambda c: c.rpartition(" ")[2]), (3, lambda c: c.partition(" ")[0])):
        mine, other = Counter(), Counter()
        for w in windows:
            if w[side]:
                (mine if w[4] & _LISTED else other).update({w[side], one(w[side])})
        names, rest = max(1, sum(w[4] & _LISTED > 0 for w in windows)), max(1, sum(w[4] & _LISTED == 0 for w in windows))
        cues.append({c for c, n in mine.items() if n >= CUE_COUNT and math.log((n + 0.5) / names) - math.log((other[c] + 0.5) / rest) >= CUE_ODDS})
    names = Names(listed, common, *cues, set(), set())
    names.families = _companions([(f, g, c) for g, f, c in _pairs(names, [w for w in windows if w[4] & _LISTED])], second)
    names.givens = _companions(_pairs(names, [w for w in windows if w[1] in names.families and not w[4] & _UNIT_GIVEN]), first)
    return names


def _pairs(names: Names, windows: list[tuple]) -> list[tuple[str, str, bool]]:
    kept = [w for w in windows if w[0] not in names.common and w[1] not in names.common and not w[4] & _UNIT_FAMILY]
    if not kept:
        return []
    before, after = names.cued(*(pa.array([w[k] for w in kept], pa.string()) for k in (2, 3)))
    return [(w[0], w[1], bool(c)) for w, c in zip(kept, before | after)]


def _companions(pairs: list[tuple[str, str, bool]], uses: Counter) -> set[str]:
    """Words with at least two companions, or one in a cue, in a share of their uses that is no accident."""
    beside: dict[str, set] = {}
    times: Counter = Counter()
    for word, companion, cue in pairs:
        beside.setdefault(word, set()).update((companion, True) if cue else (companion,))
        times[word] += 1
    return {w for w, c in beside.items() if len(c) >= 2 and times[w] >= NAME_SHARE * uses[w]}


def _emails(text: str) -> Iterator[re.Match]:
    """Matches of `_EMAIL`, which can begin only with the word before a sign for "at", or right after another match."""
    at = 0
    while sign := _EMAIL_AT.search(text, at):
        near = max(at, sign.start() - 80)
        m = None
        if head := _EMAIL_HEAD.search(text, near, sign.start()):
            if head.start() > near or near == at:
                m = _EMAIL.match(text, head.start())
            else:
                m = _EMAIL.match(text, at) or _EMAIL_START.search(text, at)
        if m:
            yield m
        at = (m or sign).end()


def _has_arabic(text: str) -> bool:
    return not text.isascii() and _ARABIC.search(text) is not None


def searched(texts: pa.Array, listed: set[str]) -> tuple[pa.ListArray, Counter]:
    """Of each text all spans that may be personal, as a list of `_FOUND`, and how often each run of characters without blanks occurs.

    Spans may overlap, and may go over a line's end. Marks are a span's pattern; of names, whose votes rest on what the corpus teaches, they are -1 less the flags `_LISTED` and so on.
    """
    columns: tuple[list, ...] = tuple([] for _ in _FOUND)
    ends = [0]
    for t in texts.to_pylist():
        if t:
            _search(t, listed, columns)
        ends.append(len(columns[0]))
    values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], fields=list(_FOUND))
    tokens = pc.ascii_split_whitespace(texts).flatten().value_counts()
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values), Counter(dict(zip(*(tokens.field(c).to_pylist() for c in ("values", "counts")))))


def _lower_words(tokens: Counter) -> Counter:
    """How often each word in lower case occurs; none goes over a blank, so that each distinct token is looked at once."""
    words: Counter = Counter()
    for token, n in tokens.items():
        for w in _LOWER_WORD.findall(token):
            words[w] += n
    return words


def _search(text: str, listed: set[str], columns: tuple[list, ...]) -> None:
    text = _WRAP.sub(" ", text)
    add_first, add_last, add_marks, add_given, add_family, add_before, add_after = (c.append for c in columns)

    def add(start: int, end: int, kind: str, votes: tuple[int, ...], n: int) -> None:
        add_first(start), add_last(end), add_marks(_code(kind, votes, _length(n)))
        add_given(""), add_family(""), add_before(""), add_after("")

    def add_name(start: int, end: int, flags: int, given: str, family: str, before: str, after: str) -> None:
        n = end - start
        flags += _LENGTH * ((n > 8) + (n > 11) + (n > 20))
        if given in listed or "-" in given and is_listed(given, listed):
            flags += _LISTED
        add_first(start), add_last(end), add_marks(-1 - flags)
        add_given(given), add_family(family), add_before(before), add_after(after)

    def outside(start: int, end: int) -> int:
        """Flags of what stands right before and after; titles and words of units are Latin."""
        flags = 0
        if text[start - 1 : start] == " " and text[start - 2 : start - 1].isascii():
            tail = text[max(0, start - 14) : start]
            flags += _of_last(tail[tail.rfind(" ", 0, -1) + 1 :])
        if text[end + 1 : end + 2].isascii() and _UNIT_AFTER.match(text[end : end + 14]):
            flags += _UNIT_NEXT
        return flags

    if "@" in text or "at]" in text or "at)" in text or "at}" in text:
        for m in _emails(text):
            plain = "@" in m.group()
            add(m.start(), m.end(), "email", (1, 1 if plain else 0, 1 if re.search(r"(?:mailto:|at |to |à |a |an |من |[:,] )$", text[max(0, m.start() - 8) : m.start()]) else 0, 0, 0, 0), m.end() - m.start())
    core = _NUMBER_CORE.search(text)
    for m in _NUMBER.finditer(text, max(0, core.start() - 2)) if core else ():
        value, start, end = m.group(), m.start(), m.end()
        if value[0] == "(" and ")" not in value:
            value, start = value[1:], start + 1
        digits = sum(map(str.isdigit, value))
        if digits < 7 or digits > 18:
            continue
        before, after = text[max(0, start - 48) : start], text[end : end + 14]
        other = -1 if _OTHER_BEFORE.search(before) or _OTHER_AFTER.match(after) else 0
        labelled = bool(_ID_BEFORE.search(before))
        phone, number = bool(_PHONE_SHAPE.fullmatch(value)), bool(_ID_SHAPE.fullmatch(value))
        if not value[-1].isalpha() and not value[0].isalpha():
            add(start, end, "phone", (1 if phone else -1, 1 if value[0] in "+(0٠" else 0, -1 if labelled else 1 if _PHONE_BEFORE.search(before) else 0, 0, other, 0), digits)
        if "ext" not in value:
            add(start, end, "id_number", (1 if number else 0 if labelled else -1, 0, 1 if labelled else -1, 0, other, 0), digits)
    for pattern in _address_patterns(text):
        for m in pattern.finditer(text):
            add(m.start(), m.end(), "address", (1, 1 if _POSTCODE.search(m.group()) else -1, 1 if _ADDRESS_BEFORE.search(text[max(0, m.start() - 70) : m.start()]) else 0, 0, 0, 0), m.end() - m.start())

    windows = _name_windows(text)
    if not _has_arabic(text):
        for start, end, given, family in windows:
            add_name(start, end, outside(start, end) + _of_words(given, family), given, family, *_beside(text, start, end))
        return
    around = _Around(text)
    for start, end, given, family in windows:
        add_name(start, end, outside(start, end) + _of_words(given, family), given, family, *around.both(start, end))
    _search_arabic(text, around, listed, columns, add_name, outside)


@lru_cache(4096)
def _code(kind: str, votes: tuple[int, ...], length: int) -> int:
    return int(_pattern(KINDS.index(kind), np.array(votes), length))


def _length(n: int) -> int:
    return (n > 8) + (n > 11) + (n > 20)


@lru_cache(65_536)
def _of_words(given: str, family: str) -> int:
    return (_UNIT_GIVEN if _UNIT_WORD.match(given) else 0) + (_UNIT_FAMILY if _UNIT_WORD.match(family) else 0)


@lru_cache(65_536)
def _of_last(word: str) -> int:
    """Flags of the word, with the blank after it, that stands before a span."""
    return (_TITLED if _TITLE.search(word) else 0) + (_UNIT_LAST if _UNIT_BEFORE.search(word) else 0)


def reliabilities(votes: np.ndarray, rounds: int = 30, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of each row, how often each labeler is right, share of true rows), by expectation-maximisation; a row stands for `times` equal ones."""
    times = np.ones(len(votes)) if times is None else times
    right = np.full(votes.shape[1], 0.8)
    share = 0.5
    posterior = np.full(len(votes), 0.5)
    for _ in range(rounds):
        log = np.log(right / (1 - right))
        score = votes @ log + np.log(share / (1 - share))
        posterior = 1 / (1 + np.exp(-score))
        for k in range(votes.shape[1]):
            cast = votes[:, k] != 0
            # a weak prior keeps a labeler that seldom votes near its start
            agree = (times[cast] * np.where(votes[cast, k] > 0, posterior[cast], 1 - posterior[cast])).sum() + 8
            right[k] = np.clip(agree / (times[cast].sum() + 10), 0.55, 0.995)
        share = float(np.clip(((times * posterior).sum() + 1) / (times.sum() + 2), 0.05, 0.95))
    return posterior, right, share


def _features(votes: np.ndarray, length: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones((len(votes), 1)), votes > 0, votes < 0, (length[:, None] > np.arange(3)).astype(float)], axis=1)


class Model:
    """A logistic classifier for each kind, trained on the labelers' joint opinion."""

    def __init__(self, texts: list[str], given: set[str] | None = None):
        names = learned_names(texts, given)
        pattern, train, _ = names.patterns(searched(pa.array(texts, pa.string()), names.listed)[0].values)
        self._fit(names, Counter(pattern[train].tolist()))

    @classmethod
    def of(cls, names: Names, seen: dict[int, int]) -> Model:
        model = cls.__new__(cls)
        model._fit(names, seen)
        return model

    def _fit(self, names: Names, seen: dict[int, int]) -> None:
        """`seen`: how often each pattern occurs."""
        self.names, self.weights, self.reliability = names, {}, {}
        self.probability = np.zeros(PATTERNS)
        seen = dict(sorted(seen.items()))
        pattern, times = np.array(list(seen), np.int64), np.array(list(seen.values()), float)
        of, all_votes, length = _of_pattern(pattern)
        every, every_votes, every_length = _of_pattern(np.arange(PATTERNS))
        for k, kind in enumerate(KINDS):
            votes, n = all_votes[of == k], times[of == k]
            posterior, right, _ = reliabilities(votes, times=n) if len(n) else (np.zeros(0), np.full(len(LABELERS), 0.8), 0.5)
            self.reliability[kind] = right
            x = _features(votes, length[of == k])
            # a prior along the votes keeps combinations sensible that the corpus lacks
            start = np.concatenate([[0.0], np.log(right / (1 - right)), -np.log(right / (1 - right)), [0.0] * 3])
            w = start.copy()
            for _ in range(200 if len(n) else 0):
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                w -= 0.5 * (x.T @ (n * (p - posterior)) / n.sum() + 0.01 * (w - start))
            self.weights[kind] = w
            self.probability[every == k] = 1 / (1 + np.exp(-np.clip(_features(every_votes[every == k], every_length[every == k]) @ w, -30, 30)))

    def spans(self, text: str | None) -> list[tuple[int, int, str, float]]:
        """Accepted spans in order, without overlaps: the more probable, then the longer, wins."""
        return self.chosen(searched(pa.array([text], pa.string()), self.names.listed)[0])[0]

    def chosen(self, found: pa.ListArray) -> list[list[tuple[int, int, str, float]]]:
        """The same for the candidates of each of many texts."""
        flat = found.flatten()
        out: list[list[tuple[int, int, str, float]]] = [[] for _ in range(len(found))]
        pattern, _, speaks = self.names.patterns(flat)
        p = self.probability[pattern]
        at = np.flatnonzero(speaks & (p >= 0.5))
        row = np.repeat(np.arange(len(found)), found.value_lengths().fill_null(0).to_numpy())[at]
        first, last, kind = flat.field("first").to_numpy()[at], flat.field("last").to_numpy()[at], pattern[at] // (4 * 3 ** len(LABELERS))
        for i, s, e, k, q in zip(row.tolist(), first.tolist(), last.tolist(), kind.tolist(), p[at].tolist()):
            out[i].append((s, e, KINDS[k], q))
        return [_apart(spans) if len(spans) > 1 else spans for spans in out]


def _apart(scored: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    # an address holds what looks like other kinds, and is decided first
    scored.sort(key=lambda s: (s[2] != "address", -s[3], s[0] - s[1], s[0]))
    kept: list[tuple[int, int, str, float]] = []
    for s in scored:
        if all(s[1] <= k[0] or s[0] >= k[1] for k in kept):
            kept.append(s)
    return sorted(kept)


def masked(text: str, spans: list[tuple[int, int, str, float]]) -> str:
    out, at = [], 0
    for start, end, kind, _ in spans:
        out += [text[at:start], PLACEHOLDERS[kind]]
        at = end
    return "".join([*out, text[at:]])


#: Candidates of a text on their way through Spark: numbers as bytes, and words a line each, as a row of the JVM for each candidate costs more than the search.
_PACKED = pa.struct([("spots", pa.binary()), *((c, pa.string()) for c in _WORDS)])
_TALLY = pa.struct([("part", pa.string()), ("value", pa.string()), ("mine", pa.int64()), ("other", pa.int64())])


def _packed(found: pa.ListArray) -> pa.StructArray:
    flat, ends = found.values, found.offsets
    spots = np.stack([flat.field(c).to_numpy() for c in ("first", "last", "marks")], axis=1).astype("<i4")
    numbers = pa.Array.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(ends.to_numpy() * np.int32(12)), pa.py_buffer(spots.tobytes())])
    return pa.StructArray.from_arrays([numbers, *(pc.binary_join(pa.ListArray.from_arrays(ends, flat.field(c)), "\n") for c in _WORDS)], fields=list(_PACKED))


def _unpacked(packed: pa.StructArray) -> pa.ListArray:
    numbers = packed.field("spots").cast(pa.binary())
    ends = np.cumsum([0, *pc.binary_length(numbers).to_pylist()]) // 4
    spots = np.frombuffer(b"".join(numbers.to_pylist()), "<i4").reshape(-1, 3)
    some = pa.array(np.diff(ends) > 0)
    words = [pc.split_pattern(packed.field(c).cast(pa.string()).filter(some), "\n").flatten() for c in _WORDS]
    values = pa.StructArray.from_arrays([*(pa.array(np.ascontiguousarray(spots[:, k]), pa.int32()) for k in range(3)), *words], fields=list(_FOUND))
    return pa.ListArray.from_arrays(pa.array(ends // 3, pa.int32()), values)


def _tallied(found: pa.StructArray) -> Iterator[pa.StructArray]:
    """How often each word and context of the name-shaped spans occurs, with and without a listed given name."""
    flags = -1 - found.field("marks").to_numpy()
    names = flags >= 0
    mine = flags[names] & _LISTED > 0
    for part in _WORDS:
        coded = found.field(part).filter(pa.array(names)).dictionary_encode()
        code, n = coded.indices.to_numpy(), len(coded.dictionary)
        counts = (pa.array(np.bincount(code[of], minlength=n)) for of in (mine, ~mine))
        yield pa.StructArray.from_arrays([pa.array([part] * n, pa.string()), coded.dictionary, *counts], fields=list(_TALLY))


#: Texts whose candidates are held at once, and distinct tokens.
_AT_ONCE = 1_000
_TOKENS_AT_ONCE = 200_000


def _searched(documents: DataFrame, key: str, text: str, listed: set[str]) -> DataFrame:
    """(key, text, found, tally), kept in the checkpoint folder: a row for each document with its candidates, and rows with nothing but a tally (`_tallied`, or of a word in lower case)."""
    spark = documents.sparkSession
    kind = documents.schema[key].dataType
    names = [key, text, "found", "tally"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        keys = None

        def tally(of: pa.StructArray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.nulls(len(of), keys), pa.nulls(len(of), pa.string()), pa.nulls(len(of), _PACKED), of], names)

        def lower() -> pa.RecordBatch:
            words = _lower_words(counts)
            counts.clear()
            n = len(words)
            return tally(pa.StructArray.from_arrays([pa.array(["lower"] * n, pa.string()), pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64()), pa.array([0] * n, pa.int64())], fields=list(_TALLY)))

        for whole in batches:
            for at in range(0, whole.num_rows, _AT_ONCE):
                batch = whole.slice(at, _AT_ONCE)
                keys = batch.column(0).type
                found, tokens = searched(batch.column(1), listed)
                counts.update(tokens)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.string()), _packed(found), pa.nulls(len(batch), _TALLY)], names)
                yield from map(tally, _tallied(found.values))
                if len(counts) > _TOKENS_AT_ONCE:
                    yield lower()
        if counts:
            yield lower()

    schema = f"`{key}` {kind.simpleString()}, `{text}` string, found struct<spots: binary, given: string, family: string, before: string, after: string>, tally struct<part: string, value: string, mine: bigint, other: bigint>"
    at = f"{ensure_checkpoint_dir(spark)}/candidates-{uuid.uuid4().hex}"
    documents.select(key, text).mapInArrow(run, schema).write.parquet(at)
    return spark.read.schema(schema).parquet(at)


def _learned(searched: DataFrame, listed: set[str]) -> Names:
    """`learned_names` of all documents of a table; the driver gets only what is learned."""
    spark = searched.sparkSession
    tallies = durable(searched.where("tally is not null").groupBy("tally.part", "tally.value").agg(F.sum("tally.mine").alias("mine"), F.sum("tally.other").alias("other")))
    uses = lambda *columns: tallies.where(F.col("part").isin(*columns)).groupBy(F.col("value").alias("word")).agg(F.sum(F.col("mine") + F.col("other")).alias("uses"))

    lower = tallies.where("part = 'lower'").select(F.col("value").alias("word"), F.col("mine").alias("n")).where(F.col("n") >= COMMON_COUNT)
    common = {r.word for r in lower.join(uses("given", "family"), "word").where(F.col("n") >= COMMON_SHARE * F.col("uses")).select("word").collect()}

    totals = tallies.where("part = 'given'").agg(F.sum("mine").alias("names"), F.sum("other").alias("rest")).first()
    names, rest = max(1, totals.names or 0), max(1, totals.rest or 0)

    def cues(column: str, end: int) -> set[str]:
        each = tallies.where((F.col("part") == column) & (F.col("value") != "")).withColumn("c", F.explode(F.array_distinct(F.array("value", F.substring_index("value", " ", end)))))
        odds = F.log((F.col("n") + 0.5) / names) - F.log((F.col("other") + 0.5) / rest)
        counts = each.groupBy("c").agg(F.sum("mine").alias("n"), F.sum("other").alias("other"))
        return {r.c for r in counts.where((F.col("n") >= CUE_COUNT) & (odds >= CUE_ODDS)).select("c").collect()}

    taught = Names(listed, common, cues("before", -1), cues("after", 1), set(), set())

    def companions(word: str, beside: str, wanted: Callable[[np.ndarray, pa.Array, Names], np.ndarray]) -> set[str]:
        shared = spark.sparkContext.broadcast(taught)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = _unpacked(batch.column(0)).values
                flags, family = -1 - found.field("marks").to_numpy(), found.field("family")
                kept = found.filter(pa.array((flags >= 0) & (flags & _UNIT_FAMILY == 0) & wanted(flags, family, shared.value)))
                ordinary = shared.value.common.__contains__
                kept = kept.filter(pa.array(~(_each(kept.field("given"), ordinary) | _each(kept.field("family"), ordinary))))
                cue, after_cue = shared.value.cued(kept.field("before"), kept.field("after"))
                yield pa.RecordBatch.from_arrays([kept.field("given"), kept.field("family"), pa.array(cue | after_cue)], ["given", "family", "cue"])

        pairs = searched.where("tally is null").select("found").mapInArrow(run, "given string, family string, cue boolean")
        pairs = pairs.groupBy(F.col(word).alias("word"), beside).agg(F.count(F.lit(1)).alias("n"), F.max(F.col("cue").cast("int")).alias("cue"))
        learned = pairs.groupBy("word").agg(F.sum("n").alias("n"), (F.count(F.lit(1)) + F.max("cue")).alias("beside")).where(F.col("beside") >= 2)
        return {r.word for r in learned.join(uses(word), "word").where(F.col("n") >= NAME_SHARE * F.col("uses")).select("word").collect()}

    taught.families = companions("family", "given", lambda flags, family, names: flags & _LISTED > 0)
    if taught.families:
        taught.givens = companions("given", "family", lambda flags, family, names: (flags & _UNIT_GIVEN == 0) & _each(family, names.families.__contains__))
    return taught


def _trained(searched: DataFrame, listed: set[str]) -> Model:
    names = _learned(searched, listed)
    shared = searched.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(PATTERNS, np.int64)
        for batch in batches:
            pattern, train, _ = shared.value.patterns(_unpacked(batch.column(0)).values)
            times += np.bincount(pattern[train], minlength=PATTERNS)
        at = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(times[at])], ["pattern", "n"])

    counts = searched.where("tally is null").select("found").mapInArrow(run, "pattern bigint, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))
    return Model.of(names, {r.pattern: r.n for r in counts.collect()})


def train_from(documents: DataFrame, text: str = "text") -> Model:
    """The model that all documents teach."""
    listed = GIVEN_NAMES | GIVEN_NAMES_AR
    return _trained(_searched(documents.select(F.lit(0).alias("key"), text), "key", text, listed), listed)


def _decided(documents: DataFrame, key: str, text: str) -> tuple[DataFrame, Callable[[pa.RecordBatch], list[list[tuple[int, int, str, float]]]]]:
    """(key, text, found) of each document, and what gives the accepted spans of a batch of it."""
    listed = GIVEN_NAMES | GIVEN_NAMES_AR
    searched = _searched(documents, key, text, listed)
    shared = documents.sparkSession.sparkContext.broadcast(_trained(searched, listed))
    return searched.where("tally is null").select(key, text, "found"), lambda batch: shared.value.chosen(_unpacked(batch.column(2)))


def personal_spans(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, kind, val, first, probability): each span of personal information; val is text[first : first + length of val].

    Null and empty texts have none; copies of a text have the same spans each.
    """
    found, chosen = _decided(documents, key, text)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, (t, spans) in enumerate(zip(texts_of(batch, text), chosen(batch))):
                for start, end, what, p in spans:
                    at.append(i)
                    rows.append((what, t[start:end], start, round(p, 6)))
            cols = [pa.array([r[c] for r in rows], k) for c, k in enumerate((pa.string(), pa.string(), pa.int32(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *cols], [key, "kind", "val", "first", "probability"])

    return found.mapInArrow(run, f"`{key}` {kind}, kind string, val string, first int, probability double")


def masked_documents(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans, masked): each text with typed placeholders for its personal information; null stays null."""
    found, chosen = _decided(documents, key, text)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, text)
            spans = chosen(batch)
            clean = [masked(t, s) if t is not None else None for t, s in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in spans], pa.int32()), pa.array(clean, pa.string())], [key, "spans", "masked"])

    return found.mapInArrow(run, f"`{key}` {kind}, spans int, masked string")
