"""Language of texts and of their sentences, by prediction by partial matching.

Each language has a context tree over bytes: counts of the byte that follows each context of up to `ORDER` bytes. A
byte's code length is -log2 of its probability at the longest known context; an escape (method C, with exclusion) leads to the
next shorter context for bytes not seen there. Counts are frozen after training, so a text's code length is the plain sum over its bytes, and
the trees can be laid out as one table: a state for each context, a cost for each state, byte and language.

Training uses a bounded sample of rows (`TRAIN_ROWS`) with usable labels, in two rounds: the second leaves out
rows and sentences that the first round's trees give to another language than their label.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm.common import texts_of

LANGUAGES = ("ar", "de", "en", "es", "fr")
ORDER = 3
TRAIN_ROWS = 12_000
STATES = 24_000
#: Bytes a language may get at most, so that a frequent language's tree is not finer than others'.
TRAIN_BYTES = 1_200_000
#: Bits by which a sentence must be shorter in a second language, and its least number of letters.
MARGIN_BITS = 25.0
LEAST_LETTERS = 20

#: Codes and names of the five languages.
LABELS = {
    "ar": ("ar", "ara", "arabic", "arabe", "árabe", "arabisch", "العربية", "عربي"),
    "de": ("de", "deu", "ger", "german", "deutsch", "allemand", "alemán", "الألمانية"),
    "en": ("en", "eng", "english", "anglais", "inglés", "englisch", "الإنجليزية"),
    "es": ("es", "spa", "spanish", "español", "castellano", "espagnol", "spanisch", "الإسبانية"),
    "fr": ("fr", "fra", "fre", "french", "français", "francés", "französisch", "الفرنسية"),
}
_CODE = {name: code for code, names in LABELS.items() for name in names}
#: A full stop after a number ends a sentence only if the number is a year: "am 9. März" goes on.
_SENTENCE = re.compile(r"\n+|(?:(?<=[^\d\s][.!?…؟])|(?<=\d\d\d\d\.)|(?<=\d[!?…؟]))[\"'”’»)\]]*\s+")
#: What may count as a whole sentence: it ends like one, or is long.
_WHOLE = re.compile(r"[.!?…؟;:][\"'”’»)\]*]*$|(?:\S+\s+){11}")
_GAP = "\n" * ORDER


def label_code(label: str | None) -> str | None:
    """The code of a label that names one of the five languages, region variants included; else None."""
    if label is None:
        return None
    low = label.strip().lower()
    return _CODE.get(low) or _CODE.get(re.split(r"[-_ ]", low)[0])


def sentences(text: str | None) -> list[str]:
    return [s for s in (x.strip() for x in _SENTENCE.split(text or "")) if s]


def _letters(s: str) -> int:
    return sum(map(str.isalpha, s))


class Trees:
    """Frozen context trees of all languages over one alphabet of byte classes."""

    def __init__(self, texts: dict[str, bytes]):
        used = np.zeros(256, np.int64)
        for t in texts.values():
            used += np.bincount(np.frombuffer(_fold(t), np.uint8), minlength=256)
        common = [b for b in np.argsort(-used, kind="stable") if used[b] > 0 and b != 10][:110]
        self.symbol = np.zeros(256, np.int32)  # 0: all other bytes
        for n, b in enumerate(common):
            self.symbol[b] = n + 2
        self.symbol[10] = 1
        a = self.size = len(common) + 2
        streams = {lang: self.symbol[np.frombuffer(_fold(t), np.uint8)].astype(np.int64) for lang, t in texts.items()}
        # the states: all contexts of two symbols, and the most frequent of three
        seen: dict[int, int] = {}
        for s in streams.values():
            keys, n = np.unique((s[:-3] * a + s[1:-2]) * a + s[2:-1], return_counts=True)
            for k, c in zip(keys[n > 1].tolist(), n[n > 1].tolist()):
                seen[k] = seen.get(k, 0) + c
        third = np.array(sorted(sorted(seen, key=lambda k: (-seen[k], k))[: max(0, STATES - a * a)]), dtype=np.int64)
        self.state = np.tile(np.arange(a * a, dtype=np.int32), a)
        self.state[third] = a * a + np.arange(len(third), dtype=np.int32)
        self.costs = np.stack([self._costs(streams[lang], third) for lang in LANGUAGES])

    def _costs(self, s: np.ndarray, third: np.ndarray) -> np.ndarray:
        """Bits of each symbol in each state, in one language."""
        a = self.size

        def escape(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
            """Probabilities at a context from its counts and the next shorter context's probabilities."""
            n, q = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
            rest = np.where(counts > 0, 0, lower)
            room = rest.sum(axis=1, keepdims=True)
            left = np.where(n > 0, q / np.maximum(n + q, 1), 1.0)
            left = np.where(room > 1e-12, left, 0)
            p = np.where(counts > 0, counts / np.maximum(n + q, 1), left * rest / np.maximum(room, 1e-12))
            return p / p.sum(axis=1, keepdims=True)

        uniform = np.full((1, a), 1 / a)
        zero = escape(np.bincount(s, minlength=a)[None, :].astype(float), uniform)
        one = escape(np.bincount(s[:-1] * a + s[1:], minlength=a * a).reshape(a, a).astype(float), zero)
        two = np.bincount((s[:-2] * a + s[1:-1]) * a + s[2:], minlength=a**3).reshape(a * a, a).astype(float)
        two = escape(two, np.tile(one, (a, 1)))
        context = (s[:-3] * a + s[1:-2]) * a + s[2:-1]
        at = np.searchsorted(third, context)
        at[at == len(third)] = 0
        hit = third[at] == context if len(third) else np.zeros(len(at), bool)
        three = np.bincount(at[hit] * a + s[3:][hit], minlength=len(third) * a).reshape(len(third), a).astype(float)
        three = escape(three, two[third % (a * a)])
        return (-np.log2(np.maximum(np.concatenate([two, three]), 1e-9))).astype(np.float16).ravel()

    def code_lengths(self, parts: list[str]) -> np.ndarray:
        """Bits of each part (a row) in each language; parts hold no line break."""
        if not parts:
            return np.zeros((0, len(LANGUAGES)))
        raw = np.frombuffer((_GAP + _GAP.join(parts) + "\n").lower().encode(), np.uint8)
        raw = raw[: len(raw)]
        s = self.symbol[_FOLD[raw]]
        a = self.size
        state = self.state[(s[:-3] * a + s[1:-2]) * a + s[2:-1]]
        at = state * a + s[3:]
        # a part begins after each gap; the line break after it counts as its end
        breaks = raw == 10
        begin = np.flatnonzero(~breaks[3:] & breaks[2:-1])
        within = ~breaks[3:]
        out = np.empty((len(begin), len(LANGUAGES)))
        for n in range(len(LANGUAGES)):
            out[:, n] = np.add.reduceat(np.where(within, self.costs[n][at], np.float16(0)).astype(np.float32), begin) if len(begin) else 0
        return out


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[48:58] = 48
for _c in (9, 11, 12, 13):
    _FOLD[_c] = 32


def _fold(raw: bytes) -> bytes:
    return _FOLD[np.frombuffer(raw, np.uint8)].tobytes()


def train(rows: list[tuple[str, str]]) -> Trees:
    """Trees from (language, text) rows; a language without text gets the statistics of uniform bytes."""
    parts = [(lang, s) for lang, text in rows for s in sentences(text)]

    def fit(chosen: list[tuple[str, str]]) -> Trees:
        by: dict[str, list[str]] = {lang: [] for lang in LANGUAGES}
        size = dict.fromkeys(LANGUAGES, 0)
        for lang, s in chosen:
            if size[lang] < TRAIN_BYTES:
                by[lang].append(s)
                size[lang] += len(s.encode())
        return Trees({lang: (_GAP + _GAP.join(x) + _GAP).lower().encode() for lang, x in by.items()})

    first = fit(parts)
    bits = first.code_lengths([s for _, s in parts])
    best = bits.argmin(axis=1)
    # a wrongly labelled row would teach a language whole lines of another one: only rows that mostly agree with their label stay
    kept, at = [], 0
    for lang, text in rows:
        ss = sentences(text)
        weight = np.bincount(best[at : at + len(ss)], weights=[len(s) for s in ss], minlength=len(LANGUAGES))
        if len(ss) and LANGUAGES[int(weight.argmax())] == lang and weight.max() > 0.9 * weight.sum():
            kept += [(lang, s) for s, b in zip(ss, best[at : at + len(ss)]) if LANGUAGES[b] == lang]
        at += len(ss)
    return fit(kept)


def train_from(records: DataFrame, text: str, label: str) -> Trees:
    """Trees from a sample of at most TRAIN_ROWS labelled rows."""
    labelled = records.select(F.col(text).alias("t"), F.col(label).alias("l")).where("t is not null and l is not null")
    n = max(1, labelled.count())
    rows = labelled.sample(min(1.0, 1.5 * TRAIN_ROWS / n), seed=5).limit(TRAIN_ROWS).toArrow().to_pylist()
    return train([(code, r["t"]) for r in rows if (code := label_code(r["l"]))])


def classify(trees: Trees, texts: list[str | None]) -> list[list[tuple[str, str, float, bool]]]:
    """For each text its segments: (language, text, confidence, whether it counts as use of the language).

    Consecutive sentences of one language are one segment. A short sentence, or one that no language fits clearly better than the text's main one,
    goes with the main language. Confidence is the share of the best language's probability under the code lengths. A text without letters has no segment.
    """
    split = [sentences(t) for t in texts]
    lengths = trees.code_lengths([s for ss in split for s in ss])
    out, at = [], 0
    for ss in split:
        bits = lengths[at : at + len(ss)]
        at += len(ss)
        # a name in brackets or quotes, a menu or a heading is no sentence of its own
        letters = np.array([_letters(s) if s[0] not in "([\"'«“„‘" and _WHOLE.search(s) else 0 for s in ss], dtype=np.int64)
        if not letters.any():
            letters = np.array([_letters(s) for s in ss], dtype=np.int64)
        if not letters.any():
            out.append([])
            continue
        # the main language: the one in which most letters' sentences are shortest
        votes = np.bincount(bits.argmin(axis=1), weights=letters, minlength=len(LANGUAGES))
        total = bits[letters > 0].sum(axis=0)
        main = int(np.lexsort((total, -votes))[0]) if len(ss) > 1 else int(bits[0].argmin())
        best = bits.argmin(axis=1)
        other = (best != main) & (letters >= LEAST_LETTERS) & (bits[:, main] - bits.min(axis=1) >= MARGIN_BITS)
        # a sentence too short to tell goes with the one before it
        chosen = np.where(other, best, main)
        for i in np.flatnonzero((letters < LEAST_LETTERS) & (np.arange(len(ss)) > 0)):
            chosen[i] = chosen[i - 1]
        segments: list[tuple[str, str, float, bool]] = []
        begin = 0
        for i in range(1, len(ss) + 1):
            if i == len(ss) or chosen[i] != chosen[begin]:
                b = bits[begin:i].sum(axis=0)
                gap = np.minimum(b - b[chosen[begin]], 60.0)
                confidence = float(1.0 / np.exp2(-gap).sum()) if (gap > -60).all() else 0.0
                segments.append((LANGUAGES[chosen[begin]], " ".join(ss[begin:i]), confidence, True))
                begin = i
        out.append(segments)
    return out


def used_languages(trees: Trees, texts: list[str | None]) -> list[list[str]]:
    return [sorted({s[0] for s in segments}) for segments in classify(trees, texts)]


def language_segments(records: DataFrame, trees: Trees, key: str, text: str, label: str) -> DataFrame:
    """(key string, label, label_right, segment_no, language, confidence, segment): one row a segment, in order.

    label_right: the label names a language that the text uses, and the text uses no other. Null, empty and letterless texts have no row.
    """
    spark = records.sparkSession
    shared = spark.sparkContext.broadcast(trees)  # bounded: STATES x 112 byte classes x 5 languages of 2 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, 1000):
                batch = whole.slice(s, 1000)
                rows = []
                for k, lab, segments in zip(texts_of(batch, "k"), texts_of(batch, "l"), classify(shared.value, texts_of(batch, "t"))):
                    langs = {x[0] for x in segments}
                    right = len(langs) == 1 and label_code(lab) in langs
                    rows += [(k, lab, right, n + 1, x[0], round(x[2], 6), x[1]) for n, x in enumerate(segments)]
                kinds = (pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.string(), pa.float64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], ["rec_key", "label", "label_right", "segment_no", "lang", "confidence", "segment"])

    chosen = records.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), F.col(label).alias("l"))
    return chosen.mapInArrow(run, "rec_key string, label string, label_right boolean, segment_no int, lang string, confidence double, segment string")


def corpus_language(spark: SparkSession, records: DataFrame, items: DataFrame) -> DataFrame:
    """Segments of all embedding records and evaluation items, with the name of their table in tbl."""
    trees = train_from(records, "retrieval_text", "language")
    asked = items.withColumn("whole_text", F.concat_ws("\n", "query", F.nullif(F.trim("reference_answer"), F.lit(""))))
    a = language_segments(records, trees, "row_id", "retrieval_text", "language").withColumn("tbl", F.lit("embedding_records"))
    b = language_segments(asked, trees, "id", "whole_text", "language").withColumn("tbl", F.lit("mbzuai_preprod_answer_completeness_v1"))
    return a.union(b)


def language_cases(segments: DataFrame) -> DataFrame:
    """(tbl, rec_key, lang): rows whose label is missing or wrong or that use several languages, once a used language."""
    return segments.where(~F.col("label_right")).select("tbl", "rec_key", "lang").distinct()
