"""Repair of text from scanned pages: split words, misread words, running headers and page numbers.

* Counts: all words of all pages, fragments at split line ends left out.
* Joins: a line that ends in a hyphen and the next line form a pair; a boosted classifier over the counts of both parts and of the joined and
  the hyphenated word decides whether the hyphen is the scanner's or the word's own.
* Signs: what stands inside words but is no letter of the alphabet (digits, daggers, foreign letters) is taken for the letter that turns most of its words into frequent ones; so the signs of a scanner are
  learned from all words of all pages.
* Misread words: every word type meets other types through an inverted join on character trigrams of its stroke form. A type is looked up by its four rarest trigrams only,
  since one edit spoils at most three, so frequent trigrams are seldom looked up; lengths differ by at most one. A boosted ranker, trained on artificial confusions of this
  corpus's own words (`FIT_WORDS`), chooses a replacement or none.
* Furniture: lines near the top and bottom are grouped by document and by a form without digits and confusable characters; a boosted classifier,
  trained on clear cases of a bounded sample (`FIT_LINES`), decides which forms are running headers. A page number is a line that is a number in the usual dress, or a
  header's number that changes with the page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.boosting import Boosted
from quarrymill.llm.common import texts_of
from quarrymill.session import durable

FIT_WORDS = 3_000
FIT_LINES = 20_000
#: How many times as frequent a replacement must be, unless the word seen has a sign in place of a letter.
LEAST_RATIO = 8
#: From this count on a word is frequent.
LEAST_COUNT = 4
ZONE = 3
GRAM = 3

#: Letters and pairs of letters that are commonly confused in print.
CONFUSIONS = (("e", "c"), ("u", "ii"), ("n", "ri"), ("m", "rn"), ("h", "li"), ("w", "vv"), ("e", "f"))
#: The same letters as the strokes they share: u, h and ii or li; n and ri; m and rn.
LETTER_STROKES = {"l": "i", "c": "e", "f": "e", "ſ": "e", "u": "ii", "h": "ii", "n": "ri", "m": "rri", "w": "vv"}
#: The letters of the pages' languages.
_LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßàâæçèéêëîïôœùûÿáíóúñ"
HYPHENS = "-‐¬­"

_BREAK = re.compile(r"[\s.,;:!?()\[\]{}\"“”«»'’‘/–—·*#~…<>=+]+")
_ROMAN = re.compile(r"[ivxlcdm]{1,8}")
_LIST = re.compile(r"^\s*(?:\d{1,3}[.)]|[-*•–])\s+\S")
_SECTION = re.compile(r"^\s*\d{1,2}(?:\.\d{1,2})+\.?\s+\S")
_NUMBER_LINE = re.compile(
    r"^[\s\-–—~\[\](){}|*·.]*(?:(?:page|seite|página|pagina|p|s|pg|folio)\b\.?\s*)?(\d{1,4}|[ivxlcdm]{1,9})(?:\s*(?:/|of|von|sur|de|di)\s*\d{1,4})?[\s\-–—~\[\](){}|*·]*$", re.I
)
_DRESSED = re.compile(r"[\[\]~/(){}]|^\s*[-–—]|page|seite|página|pagina|\b[ps]\.", re.I)


class Strokes:
    """What each letter and each learned sign looks like; `signs` are (sign, letter), the likeliest letter first."""

    def __init__(self, signs: list[tuple[str, str]] = ()):
        self.signs = list(signs)
        best: dict[str, str] = {}
        for sign, letter in self.signs:
            best.setdefault(sign, LETTER_STROKES.get(letter, letter))
        self.table = str.maketrans({**LETTER_STROKES, **best})
        self.odd = set(best)
        self.confusions = (*CONFUSIONS, *((letter, sign) for sign, letter in self.signs))

    def form(self, word: str) -> str:
        """A word with all confusable characters as one: equal for a word and its usual misreadings."""
        return word.translate(self.table)

    def is_odd(self, word: str) -> bool:
        return any(ch in self.odd or not ch.isalpha() for ch in word)


def tokens(line: str) -> list[str]:
    """Lower-case words of a line, confusable signs included; hyphens inside a word stay."""
    out = []
    for w in _BREAK.split(line.lower()):
        w = w.strip(HYPHENS)
        if len(w) > 1 and any(map(str.isalpha, w)):
            out.append(w)
    return out


def parts_of(token: str) -> list[str]:
    """A hyphenated token's parts, or the token itself: what counts and corrections are about."""
    return [p for p in re.split(rf"[{HYPHENS}]+", token) if len(p) > 1 and any(map(str.isalpha, p)) and not _ROMAN.fullmatch(p)]


def line_pairs(lines: list[str]) -> list[tuple[int, str, str]]:
    """(line, left, right) for each line that ends in a hyphen after a letter: the parts of the word it may split, in lower case."""
    out = []
    for i, line in enumerate(lines[:-1]):
        bare = line.rstrip()
        if len(bare) > 1 and bare[-1] in HYPHENS and bare[-2] not in HYPHENS and not _BREAK.match(bare[-2]):
            left, right = _BREAK.split(bare[:-1])[-1].lower(), _BREAK.split(lines[i + 1].strip())
            right = right[0].lower() if right else ""
            if left and right and any(map(str.isalpha, left)) and any(map(str.isalpha, right)) and lines[i + 1].strip()[:1] not in ("", "(", "["):
                out.append((i, left, right))
    return out


def page_words(text: str) -> tuple[Counter, list[tuple[int, str, str]]]:
    """Counts of a page's whole words, hyphenated ones both whole and in parts, and its line pairs."""
    lines = text.split("\n")
    pairs = line_pairs(lines)
    ends = {i for i, _, _ in pairs}
    counts: Counter = Counter()
    for i, line in enumerate(lines):
        words = tokens(line.rstrip().rstrip(HYPHENS) if i in ends else line)
        if i in ends and words:
            words = words[:-1]
        if i - 1 in ends and words:
            words = words[1:]
        for w in words:
            parts = parts_of(w)
            counts.update(parts)
            if len(parts) > 1:
                counts[re.sub(rf"[{HYPHENS}]+", "-", w)] += 1
    return counts, pairs


def _grams(word: str) -> set[str]:
    padded = f"^{word}$"
    return {padded[i : i + GRAM] for i in range(max(1, len(padded) - GRAM + 1))}


def _edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def correction_features(strokes: Strokes, seen: str, word: str, seen_count: float, word_count: float) -> list[float]:
    a, b = strokes.form(seen), strokes.form(word)
    ga, gb = _grams(seen), _grams(word)
    odd = sum(not ch.isalpha() or ch in strokes.odd for ch in seen)
    return [float(a == b), _edits(a, b), _edits(seen, word), odd, np.log1p(word_count), np.log1p(seen_count), np.log((word_count + 1) / (seen_count + 1)), len(seen), len(seen) - len(word), 2 * len(ga & gb) / (len(ga) + len(gb)), float(seen[0] == word[0])]


def train_correction(words: list[tuple[str, int]], strokes: Strokes, seed: int = 4) -> Boosted:
    """The ranker, from artificial misreadings of frequent words and from real words that are no misreadings."""
    rng = np.random.default_rng(seed)
    words = [(w, n) for w, n in words if len(w) > 2 and not strokes.is_odd(w)]
    if len(words) < 10:
        return Boosted(np.zeros((0, 11)), np.zeros(0))
    index: dict[str, list[int]] = {}
    for i, (w, _) in enumerate(words):
        for g in _grams(w):
            index.setdefault(g, []).append(i)

    def near(seen: str, own: int) -> list[int]:
        shared = Counter(i for g in _grams(seen) for i in index.get(g, ()))
        shared.pop(own, None)
        return [i for i, _ in shared.most_common(3)]

    x, y = [], []
    weights = np.log1p(np.array([n for _, n in words], dtype=float))
    for own in rng.choice(len(words), 2500, p=weights / weights.sum()):
        w, n = words[own]
        seen = w
        for _ in range(1 if rng.random() < 0.8 else 2):
            open_ = [(a, b) for a, b in strokes.confusions if a in seen]
            if open_:
                a, b = open_[rng.integers(len(open_))]
                places = [m.start() for m in re.finditer(re.escape(a), seen)]
                at = places[rng.integers(len(places))]
                seen = seen[:at] + b + seen[at + len(a) :]
        count = float(rng.integers(0, max(2, n // (2 * LEAST_RATIO))))
        if seen != w:
            if strokes.is_odd(seen) and rng.random() < 0.3:
                n, count = int(rng.integers(1, LEAST_RATIO)), 1.0  # a sign gives a rare word away too
            x.append(correction_features(strokes, seen, w, count, n))
            y.append(1.0)
            for i in near(seen, own):
                if strokes.form(words[i][0]) != strokes.form(w):
                    x.append(correction_features(strokes, seen, words[i][0], count, words[i][1]))
                    y.append(0.0)
        # the word as it is, though rare, is no misreading of its neighbours
        rare = float(rng.integers(1, 12))
        for i in near(w, own):
            if strokes.form(words[i][0]) != strokes.form(w):
                x.append(correction_features(strokes, w, words[i][0], rare, words[i][1]))
                y.append(0.0)
    return Boosted(np.array(x), np.array(y))


def pair_features(left: str, right: str, left_n: float, right_n: float, joined_n: float, hyphen_n: float) -> list[float]:
    return [np.log1p(left_n), np.log1p(right_n), np.log1p(joined_n), np.log1p(hyphen_n), np.log1p(joined_n) - np.log1p(hyphen_n), len(left), len(right), float("-" in right or "-" in left)]


def train_pairs(counts: dict[str, int], seed: int = 5) -> Boosted:
    """The line-pair classifier for joins: plain words cut at random places against hyphenated words cut at their hyphen."""
    rng = np.random.default_rng(seed)
    plain = [w for w in counts if w.isalpha() and len(w) > 4]
    own = [w for w in counts if "-" in w]
    x, y = [], []
    for w in (plain[i] for i in (rng.integers(len(plain), size=2000) if plain else ())):
        at = int(rng.integers(2, len(w) - 1))
        left, right = w[:at], w[at:]
        known = counts[w] if rng.random() < 0.8 else 0  # a joined word may be unknown, or misread
        x.append(pair_features(left, right, counts.get(left, 0), counts.get(right, 0), known, counts.get(f"{left}-{right}", 0)))
        y.append(1.0)
    for w in (own[i] for i in (rng.integers(len(own), size=1000) if own else ())):
        left, right = w.rsplit("-", 1) if rng.random() < 0.5 else w.split("-", 1)
        x.append(pair_features(left, right, counts.get(left, 0), counts.get(right, 0), counts.get(left + right, 0), counts[w]))
        y.append(0.0)
    return Boosted(np.array(x).reshape(-1, 8), np.array(y))


def zone_lines(text: str) -> list[tuple[int, str, int, str]]:
    """(line, zone, place, text) of the first and last ZONE non-blank lines; a short page's line is in the nearer zone."""
    full = [(i, s.strip()) for i, s in enumerate(text.split("\n")) if s.strip()]
    out = []
    for k, (i, s) in enumerate(full):
        back = len(full) - 1 - k
        if k < ZONE and k <= back:
            out.append((i, "top", k, s))
        elif back < ZONE:
            out.append((i, "bottom", back, s))
    return out


def line_form(line: str, strokes: Strokes) -> str:
    """What a line and its misread or numbered likes have in common: strokes of its letters, without lone numbers."""
    return re.sub(r"[\W\d_]+", "", strokes.form(re.sub(r"(?<![^\W_])\d+(?![^\W_])", " ", line.lower())))


_END_NUMBERS = (re.compile(r"(?:^|[\s\-–—·|\[(~])(\d{1,4})[\s\-–—·|\])~]*$"), re.compile(r"^[\s\-–—·|\[(~]*(\d{1,4})(?:[\s\-–—·|\])~]|$)"))
_TABBED = re.compile(r"^\d{1,4}(?: {2,}| [|·] )\S|\S(?: {2,}| [|·] )\d{1,4}$")


def line_number(line: str) -> int | None:
    """The number that stands alone at an end of a line; a year is none."""
    found = [int(m[1]) for m in (p.search(line) for p in _END_NUMBERS) if m]
    return next((n for n in found if not 1900 <= n <= 2100), None)


def _furniture_features(row) -> list[float]:
    return [np.log(row["pages"]), row["pages"] / max(1, row["doc_pages"]), row["place"], row["words"], row["upper"], row["stop"], row["listed"], np.log(row["docs"]), float(row["doc_pages"])]


def _zone_rows(batches: Iterator[pa.RecordBatch], strokes: Strokes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for pk, doc, text in zip(texts_of(batch, "pk"), texts_of(batch, "document_id"), texts_of(batch, "ocr_text")):
            lines = text.split("\n")
            for i, zone, place, s in zone_lines(text):
                pure = _NUMBER_LINE.match(s)
                blank = i == 0 or i == len(lines) - 1 or not lines[i - 1].strip() or not lines[i + 1].strip()
                rows.append((pk, doc, i, zone, place, line_form(s, strokes) if not pure else "", line_number(s), bool(pure), bool(pure and (_DRESSED.search(s) or blank or place == 0)), len(s.split()), float(s.isupper()), float(s[-1] in ".,;:?!" + HYPHENS), float(bool(_LIST.match(s) or _SECTION.match(s) or not (s[0].isupper() or s[0].isdigit()))), bool(place == 0 and len(s.split()) < 12 and _TABBED.search(s) and line_number(s) is not None)))
        types = (pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.bool_())
        names = ["pk", "document_id", "line", "zone", "place", "form", "number", "pure", "alone", "words", "upper", "stop", "listed", "tabbed"]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names)


_ZONE_SCHEMA = "pk bigint, document_id string, line int, zone string, place int, form string, number int, pure boolean, alone boolean, words int, upper double, stop double, listed double, tabbed boolean"


def furniture(pages: DataFrame, strokes: Strokes) -> DataFrame:
    """(pk, line, header, number): the lines of each page that are running headers, and those that hold the page's number."""
    zone = durable(pages.mapInArrow(lambda batches: _zone_rows(batches, strokes), _ZONE_SCHEMA))
    doc_pages = pages.groupBy("document_id").agg(F.count_distinct("page_key").alias("doc_pages"))
    keyed = zone.where("form != ''").join(pages.select("pk", "page_key", "page_number"), "pk")
    forms = keyed.groupBy("document_id", "form").agg(
        F.count_distinct("page_key").alias("pages"), F.avg("place").alias("place"), F.avg("words").alias("words"), F.avg("upper").alias("upper"), F.avg("stop").alias("stop"), F.avg("listed").alias("listed"),
        F.count_distinct("number").alias("numbers"),
    )
    spread = forms.groupBy("form").agg(F.count_distinct("document_id").alias("docs"), F.sum(F.when(F.col("pages") > 1, 1).otherwise(0)).alias("again"), F.sum(F.when((F.col("pages") > 1) & (F.col("numbers") > 1), 1).otherwise(0)).alias("counting"))
    forms = durable(forms.join(doc_pages, "document_id").join(spread, "form"))
    total = max(1, forms.count())
    sample = forms.sample(min(1.0, 1.2 * FIT_LINES / total), seed=6).limit(FIT_LINES).collect()
    plain = [r for r in sample if not r.listed and not r.stop]
    sure = [r for r in plain if r.pages >= 3 and r.pages >= 0.2 * r.doc_pages and r.place < 1]  # odd and even pages may have their own
    never = [r for r in sample if r.pages == 1 and r.doc_pages > 2 and r.docs <= 2 or r.listed > 0.5 or r.stop > 0.5]
    x = np.array([_furniture_features(r.asDict()) for r in sure + never]).reshape(-1, 9)
    model = Boosted(x, np.concatenate([np.ones(len(sure)), np.zeros(len(never))])) if sure else None
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            if not rows:
                continue
            p = shared.value.probability(np.array([_furniture_features(r) for r in rows])) if shared.value else np.zeros(len(rows))
            # a line on one page only is a header if in most documents that have it, it is one
            head = [bool(r["stop"] < 0.5 and r["listed"] < 0.5 and (q >= 0.5 if r["pages"] > 1 else r["again"] > 2 and r["again"] > 0.6 * r["docs"])) for q, r in zip(p, rows)]
            count = [h and (r["numbers"] > 1 and r["pages"] > 1 or r["pages"] == 1 and r["numbers"] > 0 and r["counting"] > 0.5 * max(1, r["again"])) for h, r in zip(head, rows)]
            yield pa.RecordBatch.from_arrays([pa.array([r["document_id"] for r in rows]), pa.array([r["form"] for r in rows]), pa.array(head), pa.array(count)], ["document_id", "form", "header", "counting"])

    judged = forms.select("document_id", "form", "pages", "place", "words", "upper", "stop", "listed", "numbers", "doc_pages", "docs", "again", "counting").mapInArrow(judge, "document_id string, form string, header boolean, counting boolean")
    headers = zone.where("listed = 0").join(judged.where("header"), ["document_id", "form"]).select("pk", "line", F.lit(True).alias("header"), (F.col("counting") & F.col("number").isNotNull()).alias("number"))
    tabbed = zone.where("tabbed and listed = 0 and not pure").select("pk", "line", F.lit(True).alias("header"), F.lit(True).alias("number"))
    numbers = zone.where("pure and alone and place < 3").select("pk", "line", F.lit(False).alias("header"), F.lit(True).alias("number"))
    return headers.union(tabbed).union(numbers)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for t in texts_of(batch, "ocr_text"):
            counts.update(page_words(t)[0])
        yield pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(pk, i, a, b) for pk, t in zip(texts_of(batch, "pk"), texts_of(batch, "ocr_text")) for i, a, b in line_pairs(t.split("\n"))]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate((pa.int64(), pa.int32(), pa.string(), pa.string()))], ["pk", "line", "left", "right"])


def _page_types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(pk, w) for pk, t in zip(texts_of(batch, "pk"), texts_of(batch, "ocr_text")) for w in page_words(t)[0] if "-" not in w]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["pk", "word"])


def lexicon(pages: DataFrame) -> DataFrame:
    """(word, n): all words of all pages with their counts."""
    return pages.mapInArrow(_count_rows, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def join_decisions(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(left, right): the distinct line pairs whose hyphen is not the word's own."""
    sample = words.orderBy(F.desc("n"), "word").limit(4 * FIT_WORDS).collect()
    model = pairs.sparkSession.sparkContext.broadcast(train_pairs({r.word: r.n for r in sample}))
    kinds = pairs.select("left", "right").distinct().withColumn("joined", F.concat("left", "right")).withColumn("hyphened", F.concat_ws("-", "left", "right"))
    for c in ("left", "right", "joined", "hyphened"):
        kinds = kinds.join(words.select(F.col("word").alias(c), F.col("n").alias(f"{c}_n")), c, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            if rows:
                x = np.array([pair_features(r["left"], r["right"], *((r[f"{c}_n"] or 0) for c in ("left", "right", "joined", "hyphened"))) for r in rows])
                keep = [r for r, p in zip(rows, model.value.probability(x)) if p >= 0.5]
                yield pa.RecordBatch.from_arrays([pa.array([r["left"] for r in keep], pa.string()), pa.array([r["right"] for r in keep], pa.string())], ["left", "right"])

    return kinds.select("left", "right", "left_n", "right_n", "joined_n", "hyphened_n").mapInArrow(run, "left string, right string")


def learn_strokes(words: DataFrame) -> Strokes:
    """The signs that stand for letters, with the letter that turns most word types with the sign into frequent words.

    A sign is no letter, or a letter outside the alphabet of the pages' languages by whose replacement a third of its words become frequent ones. All word types take part; what
    is collected has a row for a sign and letter.
    """
    plain = words.where(~F.col("word").contains("-"))
    chars = plain.select("word", "n", F.explode(F.array_distinct(F.split("word", ""))).alias("sign")).where("sign != ''")
    odd = chars.where(~F.col("sign").rlike(f"[{_LETTERS}]"))
    one = odd.where("length(word) > 2").groupBy("word").agg(F.max("sign").alias("sign"), F.count(F.lit(1)).alias("signs"), F.max("n").alias("n")).where("signs = 1")
    tried = one.select("word", "sign", F.explode(F.split(F.lit(_LETTERS), "")).alias("letter"), "n").where("letter != ''").withColumn("made", F.replace("word", F.col("sign"), F.col("letter")))
    hits = tried.join(plain.select(F.col("word").alias("made"), F.col("n").alias("made_n")), "made").where((F.col("made_n") >= LEAST_COUNT) & (F.col("made_n") >= 2 * F.col("n")))
    votes = hits.groupBy("sign", "letter").agg(F.count(F.lit(1)).alias("votes"))
    every = votes.groupBy("sign").agg(F.sum("votes").alias("every"))
    every = every.join(hits.groupBy("sign").agg(F.count_distinct("word").alias("mended")), "sign").join(one.groupBy("sign").agg(F.count(F.lit(1)).alias("types")), "sign")
    every = every.where(~F.col("sign").rlike(r"\p{L}") | (F.col("mended") >= F.col("types") / 3))
    chosen = votes.join(every, "sign").where((F.col("votes") >= 3) & (F.col("votes") >= 0.2 * F.col("every"))).orderBy("sign", F.desc("votes"), "letter")
    return Strokes([(r.sign, r.letter) for r in chosen.collect()])  # at most five letters a sign, and a sign is one character


def corrections(words: DataFrame, joined: DataFrame, strokes: Strokes) -> DataFrame:
    """(word, better): the misread word types and their replacements. `joined` (word) are types made by joining lines."""
    fit = words.where(f"n >= {LEAST_COUNT} and not contains(word, '-')").orderBy(F.desc("n"), "word").limit(FIT_WORDS).collect()
    shared = words.sparkSession.sparkContext.broadcast((train_correction([(r.word, r.n) for r in fit], strokes), strokes))
    plain = words.where(~F.col("word").contains("-"))
    every = plain.union(joined.join(plain, "word", "left_anti").select("word", F.lit(0).cast("bigint").alias("n")))

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value[1]
        for batch in batches:
            ws = texts_of(batch, "word")
            marked = [own.form(w) for w in ws]
            cols = [pa.array(marked, pa.string()), pa.array([own.is_odd(w) for w in ws], pa.bool_()), pa.array([sorted(_grams(f)) for f in marked], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], ["word", "n", "form", "odd", "grams"])

    types = durable(every.select("word", "n").mapInArrow(forms, "word string, n bigint, form string, odd boolean, grams array<string>"))
    known = types.where("not odd and n > 0")
    rarity = known.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    # a word of two letters is looked up only if a sign stands in it beside a letter
    seen = types.where("length(word) > 2 or odd").select(F.col("word").alias("seen"), F.col("n").alias("seen_n"), F.col("form").alias("seen_form"), "odd", "grams")
    ranked = seen.select("seen", F.explode("grams").alias("gram")).join(rarity, "gram", "left").groupBy("seen").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram"))), 1, GRAM + 1).alias("rare"))  # bounded by one word
    a = ranked.select("seen", F.explode("rare").alias("g")).where("g.df > 0").select("seen", "g.gram").join(seen.drop("grams"), "seen").withColumn("size", F.length("seen_form"))
    sizes = F.explode(F.array(*(F.length("form") + d for d in (-1, 0, 1)))).alias("size")
    b = known.select("word", "n", "form", sizes, "grams").select("word", "n", "form", "size", F.explode("grams").alias("gram"))
    met = a.join(b, ["gram", "size"]).where(F.col("seen") != F.col("word"))
    enough = (F.col("n") >= LEAST_COUNT) & (F.col("n") >= LEAST_RATIO * F.greatest(F.col("seen_n"), F.lit(1))) & (F.length("seen") > 2)
    met = met.where(F.when(F.col("odd"), (F.col("form") == F.col("seen_form")) & (F.col("n") >= F.col("seen_n")) | enough & F.col("seen").rlike(r"\p{L}{2}")).otherwise(enough))
    met = met.where(F.levenshtein("seen_form", "form", 1) >= 0).select("seen", "word", "seen_n", "n").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, own = shared.value
        for batch in batches:
            rows = batch.to_pylist()
            if rows:
                p = model.probability(np.array([correction_features(own, r["seen"], r["word"], r["seen_n"], r["n"]) for r in rows]))
                keep = [(r["seen"], r["word"], own.form(r["seen"]) == own.form(r["word"]), r["n"], float(q)) for r, q in zip(rows, p) if q >= 0.5]
                yield pa.RecordBatch.from_arrays([pa.array([k[c] for k in keep], t) for c, t in enumerate((pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.float64()))], ["word", "better", "same", "n", "p"])

    # of the words that pass, one of the same strokes, and of those the most frequent, since others may be misread themselves
    order = Window.partitionBy("word").orderBy(F.desc("same"), F.desc("n"), F.desc("p"), "better")
    best = met.mapInArrow(run, "word string, better string, same boolean, n bigint, p double").withColumn("r", F.row_number().over(order)).where("r = 1")
    return best.select("word", "better")


def _cased(seen: str, better: str) -> str:
    letters = [c for c in seen if c.isalpha()]
    if len(letters) > 1 and all(map(str.isupper, letters)):
        return better.upper()
    return better.capitalize() if seen[:1].isupper() else better


def repaired(text: str, joins: set[tuple[str, str]], better: dict[str, str], header: set[int], number: set[int]) -> tuple[str, list[str]]:
    """(paragraphs separated by blank lines, defects) of one page."""
    lines = text.split("\n")
    defects = set()
    if header:
        defects.add("running_header")
    if number:
        defects.add("page_number")
    fixed = {i: b for i, a, b in line_pairs(lines) if (a, b) in joins}
    if fixed:
        defects.add("hyphenation")
    said = page_words(text)[0]
    if any(w in better for w in said) or any(a + b in better for i, a, b in line_pairs(lines) if i in fixed):
        defects.add("misread")
    word = re.compile(rf"[^\s.,;:!?()\[\]{{}}\"“”«»'’‘/–—·*#~…<>=+{HYPHENS}]+")

    def right(s: str) -> str:
        return word.sub(lambda m: _cased(m.group(), better[m.group().lower()]) if m.group().lower() in better else m.group(), s)

    paragraphs: list[str] = []
    open_ = ""
    for i, line in enumerate(lines):
        s = line.strip()
        if i in header or i in number:
            continue
        alone = bool(_SECTION.match(s) or _LIST.match(s))
        if not s or alone:
            if open_:
                paragraphs.append(open_)
            open_ = ""
            if alone:
                paragraphs.append(s)
            continue
        if open_.endswith("\0"):
            open_ = open_[:-1] + s
        elif open_ and open_[-1] in HYPHENS and open_[-2:-1].isalpha():
            open_ += s  # a hyphen of the word's own
        else:
            open_ = f"{open_} {s}" if open_ else s
        if i in fixed:
            open_ = open_.rstrip(HYPHENS) + "\0"
    if open_:
        paragraphs.append(open_)
    return "\n\n".join(right(p.replace("\0", "")) for p in paragraphs), sorted(defects)


def repaired_pages(scans: DataFrame) -> DataFrame:
    """(media_id, document_id, page_number, defects, repaired_text): each distinct page text once, whatever its quality score.

    Null and blank texts are left out; rows that repeat a media_id with the same text are one; a page without a number, or of a document of one page, is
    repaired as far as its own lines and the counts of all pages allow.
    """
    pages = scans.where("trim(ocr_text) != ''").select(F.col("media_id").cast("string").alias("media_id"), F.coalesce(F.col("document_id"), F.concat(F.lit("page:"), "media_id")).alias("document_id"), "page_number", "ocr_text").distinct()
    pages = durable(pages.withColumn("pk", F.xxhash64("media_id", "document_id", "page_number", "ocr_text")).withColumn("page_key", F.xxhash64("media_id")))
    words = durable(lexicon(pages))
    pairs = durable(pages.mapInArrow(_pair_rows, "pk bigint, line int, left string, right string"))
    joins = durable(join_decisions(pairs, words))
    strokes = learn_strokes(words)
    wrong = durable(corrections(words, joins.select(F.concat("left", "right").alias("word")).distinct(), strokes))
    marks = furniture(pages, strokes)
    # all of these lists are bounded by one page
    page_joins = pairs.join(joins, ["left", "right"]).groupBy("pk").agg(F.collect_set(F.struct("left", "right")).alias("joins"))
    types = pages.mapInArrow(_page_types, "pk bigint, word string").union(pairs.select("pk", F.concat("left", "right")))
    page_wrong = types.join(wrong, "word").groupBy("pk").agg(F.collect_set(F.struct("word", "better")).alias("better"))
    page_marks = marks.groupBy("pk").agg(F.collect_set(F.when(F.col("header"), F.col("line"))).alias("header"), F.collect_set(F.when(F.col("number"), F.col("line"))).alias("number"))
    whole = pages.join(page_joins, "pk", "left").join(page_wrong, "pk", "left").join(page_marks, "pk", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (r["media_id"], r["document_id"], r["page_number"], *repaired(r["ocr_text"], {(j["left"], j["right"]) for j in r["joins"] or ()}, {b["word"]: b["better"] for b in r["better"] or ()}, set(r["header"] or ()), set(r["number"] or ())))
                for r in batch.to_pylist()
            ]
            kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.list_(pa.string()))
            cols = [pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([cols[0], cols[1], cols[2], cols[4], cols[3]], ["media_id", "document_id", "page_number", "defects", "repaired_text"])

    chosen = whole.select("media_id", "document_id", F.col("page_number").cast("int").alias("page_number"), "ocr_text", "joins", "better", "header", "number")
    return chosen.mapInArrow(run, "media_id string, document_id string, page_number int, defects array<string>, repaired_text string")


def page_defects(scans: DataFrame) -> DataFrame:
    """(media_id, defect), once each."""
    return repaired_pages(scans).select("media_id", F.explode("defects").alias("defect")).distinct()
