"""Template residue, filler, error messages and script notices in captions and descriptions.

A value is cut into sentences, and each distinct sentence form has a SimHash of its characters and pairs of characters. Trusted patterns (general marks of template languages, phrases of
the HTTP standard and of browsers) only give some forms a first label. Labels then spread: the 64 bits are looked up in partitioned tables, each on `bits` sampled bits, with all
buckets one bit away probed from the labelled side; forms that meet are verified by Hamming distance and by edit distance and take the label, round by round until the
connected component is complete. All results are values with a sentence in a labelled component. A sentence with an unfilled variable in it is a component of its own, since what is near to it is the
filled sentence.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import texts_of
from quarrymill.session import durable

#: Forms of a bucket that the length of a table's key aims at, and the least length.
BUCKET_FORMS = 64
LEAST_BITS = 12
#: The tables are as many as bring a pair that differs in `LOOKED_UP` bits together with probability `RECALL`.
LOOKED_UP = 15
RECALL = 0.95
HAMMING = 18
LEAST_SIMILARITY = 0.72

_SENTENCE = re.compile(r"(?<=[.!?؟…])\s+")

#: Unfilled template variables, in the marks of common template languages.
_VARIABLE = re.compile(
    r"""\{\{\{?[^{}]{1,60}\}?\}\}|[$%#@]\{[^{}]{1,60}\}|<%=?[^<>]{0,60}%>|<\?=?[^<>]{0,60}\?>|\{%[^{}]{1,60}%\}|\[\[[^\[\]]{1,60}\]\]|<!--.{0,80}?-->
    |(?<!\w)__[A-Za-z][\w. ]{0,40}?__(?!\w)|(?<![\w%])%[A-Za-z][\w. ]{0,40}?[A-Za-z_]%(?![\w%])|@@[\w ]{2,40}@@|\#[A-Z][A-Z_ ]{1,40}\#|(?<!\w):[a-z]+(?:\[\d+\])?\.\w+:|\bXX[A-Z]{2,}XX\b
    |&(?:lt|LT);\s*[^&]{1,60}&(?:gt|GT);|<[A-Za-z_](?:[\w .:\[\]]|->|-){1,60}>|\{[A-Za-z_](?:[\w .:\[\]]|->|-){1,60}\}|\{\d\}
    |\[(?!NP|VP|PP|sic\])[A-Za-z_](?:[\w .:\[\]',]|->|-){2,60}\]|\[[^\[\]]{0,30}(?:أدخل|اكتب|einfügen|compléter|Insertar)[^\[\]]{0,30}\]
    |\b[a-z]+(?:\[\d\])?->\w+|\b[a-z]+\[\d\]\.[a-z]\w*""",
    re.X,
)
#: Sentences that are wholly a message, in lower case and with single blanks.
_MESSAGE = re.compile(
    r"""^\W*(?:http(?:/\d(?:\.\d)?)?(?:\ error)?|error|erreur|fehler|error\ de|خطأ|الخطأ|status)\b[ :=#(]*(?:[45]\d\d\b|e_\w+|0x[0-9a-f]+|nx\b|err_\w+)
    |^\W*[45]\d\d\W{1,4}(?:not\ found|forbidden|bad\ |service\ |internal|authori|unauthor|gone\b|gateway|too\ many|request|page|proxy|method|unknown|http|nicht|prohibido|interdit)
    |\bmessage="|^traceback\b|^(?:warning|notice|fatal\ error|uncaught\ exception):|undefined\ (?:index|variable|offset)|^internal\ server\ error|^bad\ gateway|^service\ (?:temporarily\ )?unavailable|^gateway\ time|^(?:403\ )?forbidden\W*$|^not\ found\W*$
    |^failed\ to\ (?:fetch|load|open)|^fehler\ beim|^error\ (?:establishing|loading|al\ )|^erreur\ (?:de\ |lors)|^(?:the\ )?connection\ (?:timed\ out|was\ reset|refused)|^(?:access|permission)\ (?:is\ )?denied\b|^you\ do\ not\ have\ permission|^acceso\ denegado|^accès\ refusé|^zugriff\ verweigert
    |^too\ many\ requests|^slow\ down\b|^(?:your\ )?session\ (?:has\ )?expired|^(?:the\ |this\ )?(?:page|file|image|resource|url|content)\b[^,]{0,24}(?:could\ not\ be|cannot\ be|can't\ be|no\ longer\ available|does\ not\ exist|introuvable)|^(?:page|file)\ not\ found
    |^(?:sorry,?\ )?we\ can['’]?t\ find|^(?:oops|whoops)\W|^something\ went\ wrong|seite\ nicht\ gefunden|page\ introuvable|página\ no\ encontrada|الصفحة\ غير\ موجودة
    |^(?:the\ |this\ |your\ )?(?:\w+\ )?(?:host|server|image|file|page|site|request|connection|decoder|stream|resource|module|script|player|plugin|url|address|document|content|media|asset)(?:\ \w+)?\ (?:could\ not|cannot|can't|failed|missing|unavailable|timed\ out|was\ not\ found|is\ (?:under\ maintenance|not\ available|unavailable))\b|^we\ (?:will|'ll|’ll)\ be\ (?:right\ )?back
    |(?:enable|activate|turn\ on|allow|switch\ on)\ (?:javascript|scripts?|cookies)\b|javascript\ (?:is|ist|est|está)\ (?:disabled|required|off|deaktiviert|désactivé|desactivado)|^(?:bitte\ )?aktivieren\ sie\b|(?:activer|activez|active|habilite)\ javascript|تفعيل\ جافا|^scripts\ are\ blocked|^allow\ them\ and\ reload
    |checking\ your\ browser|your\ browser\ before\ access|^verifying\b.*\bhuman|^this\ may\ take\ a\ few\ seconds|does\ not\ support\ the\ (?:video|audio|canvas)|requires\ a\ modern\ browser
    |\blorem\b|\bipsum\b|^((?:\w+\W+){0,2}\w+)(?:\W+\1)+(?:\W+\d+)?\W*$|^\W*(\w)\2{4,}\W*$|^\W*(?:undefined|null|nan|n/a|none|tbd|todo|placeholder|\[object\ object\])\W*$|^todo\b|\btbd\b|\bgoes\ here\b|^insert\ (?:\S+\ ){0,2}\S+$|^:[^\s:][^:]{1,40}:$|^(?:\S+\ ){1,3}to\ be\ (?:supplied|added|confirmed|provided)$
    |^(?:sample|dummy|filler|placeholder|demo)\ (?:text|caption|description|image)\b|^this\ is\ a\ (?:test|sample|dummy)\b|^text[eo]?\ (?:de\ |d['’])(?:ejemplo|démonstration|exemple|prueba|relleno)|beispieltext|blindtext|platzhaltertext|نص\ تجريبي
    |^(?:click|tap)\ to\ edit|^enter\ (?:alternative|alt|a|your|the)\b.*\b(?:text|caption|description|title)\b|^(?:add|write|insert|type)\ (?:a\ |an\ |your\ )?(?:caption|description|text|title)\b|^your\ (?:text|caption|description|title)\ here|(?:description|text|caption|title)\ \(required\)|^\w+:\ *_{3,}""",
    re.X,
)


def sentence_list(value: str | None) -> list[str]:
    """Sentences of a value with single blanks."""
    flat = " ".join((value or "").split())
    return [s for s in _SENTENCE.split(flat) if s]


def sentence_form(sentence: str) -> str:
    """What near sentences are compared by: lower case, digits as one sign, without a reference or a tail of at most two words after a bar or dash."""
    low = re.sub(r"\d+", "0", sentence.lower())
    low = re.sub(r"(?<=\w.)\s*(?:\(\w+ 0\)|\s[|–-] \w+(?: \w+)?)\W*$", "", low)
    return low.strip(" .!…|-–")


def trusted(sentence: str) -> str | None:
    """'message' or 'variable' if a pattern knows the sentence as residue."""
    low = sentence.lower().strip()
    plain = re.sub(r"^\[\w+\]\s*", "", low)
    if any(map(_MESSAGE.search, {low, low.strip(" .…-–("), plain, sentence_form(plain)})):
        return "message"
    found = _VARIABLE.search(sentence)
    if not found:
        return None
    rest = re.sub(r"\W+", "", _VARIABLE.sub("", sentence))
    return "message" if len(rest) < 7 else "variable"


def simhash(text: str) -> int:
    """64 sign bits of the summed hashes of a text's characters and pairs of characters, each as often as it stands there."""
    import xxhash

    padded = f" {text} "
    grams = Counter(padded[i : i + k] for k in (1, 2) for i in range(len(padded) - k + 1))
    h = np.array([xxhash.xxh3_64_intdigest(g.encode()) for g in grams], dtype=np.uint64)
    bits = (h[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    sums = (2 * bits.astype(np.int64) - 1).T @ np.array(list(grams.values()))
    return int(((sums > 0).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64).astype(np.int64))


def plan(forms: int) -> tuple[int, int]:
    """Key length and number of tables for so many forms."""
    bits = min(32, max(LEAST_BITS, math.ceil(math.log2(max(1, forms) / BUCKET_FORMS))))
    p = LOOKED_UP / 64
    met = (1 - p) ** bits + bits * p * (1 - p) ** (bits - 1)
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - met))


def _sentence_rows(trust: Callable[[str], str | None]):
    """The distinct sentence forms of a batch, and whether a pattern knows them, as message or by a variable."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {s for v in texts_of(batch, "value") for s in sentence_list(v)}
            rows = [(sentence_form(s), trust(s)) for s in sorted(seen)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] == "message" for r in rows], pa.bool_()), pa.array([r[1] == "variable" for r in rows], pa.bool_())], ["form", "message", "variable"])

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([simhash(f) for f in texts_of(batch, "form")], pa.int64())], [*batch.schema.names, "h"])


def _keyed(bits: int, tables: int, probing: bool):
    """A row for each table with the key of a form; with `probing` also for each key one bit away."""
    rng = np.random.default_rng(17)
    places = np.stack([rng.choice(64, bits, replace=False) for _ in range(tables)]).astype(np.uint64)
    flips = np.append(0, np.int64(1) << np.arange(bits, dtype=np.int64)) if probing else np.zeros(1, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column(1).to_numpy().view(np.uint64)
            own = (((h[:, None, None] >> places) & np.uint64(1)).astype(np.int64) << np.arange(bits, dtype=np.int64)).sum(axis=2)
            keys = (own[:, :, None] ^ flips) | (np.arange(tables, dtype=np.int64)[:, None] << 32)
            row = pa.array(np.repeat(np.arange(batch.num_rows), tables * len(flips)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(keys.ravel())], [*batch.schema.names, "key"])

    return run


def residue_forms(values: DataFrame, trust: Callable[[str], str | None] = trusted) -> DataFrame:
    """(form): the distinct sentence forms of `value` in components that `trust` gives a label; sentences with a variable are each their own."""
    found = values.mapInArrow(_sentence_rows(trust), "form string, message boolean, variable boolean")
    # one row a form; a third of all rows may hold the same sentence, so the map side folds first
    forms = found.where("form != ''").groupBy("form").agg(F.max("message").alias("message"), F.max("variable").alias("variable"))
    index = durable(forms.mapInArrow(_hashed, "form string, message boolean, variable boolean, h bigint"))
    bits, tables = plan(index.count())
    table = durable(index.where("not message and not variable").select("form", "h").mapInArrow(_keyed(bits, tables, False), "form string, h bigint, key bigint"))
    known = front = index.where("message").select("form", "h")
    while front.head(1):  # each round labels at least one further form, so it ends
        probed = front.withColumnsRenamed({"form": "near", "h": "k"}).mapInArrow(_keyed(bits, tables, True), "near string, k bigint, key bigint")
        # lengths and Hamming distance drop most of what meets before it is shuffled, and the edit distance stops at its bound
        most = F.floor((1 - LEAST_SIMILARITY) * F.greatest(F.length("form"), F.length("near")) + 1e-9).cast("int")
        close = (F.bit_count(F.col("h").bitwiseXOR(F.col("k"))) <= HAMMING) & (F.abs(F.length("form") - F.length("near")) <= most)
        met = probed.join(table, "key").where(close).select("form", "h", "near", most.alias("most")).distinct()
        near = met.where(F.expr("levenshtein(form, near, most) >= 0"))
        front = durable(near.select("form", "h").distinct().join(known.select("form"), "form", "left_anti"))
        known = durable(known.union(front))
    return known.select("form").union(index.where("variable and not message").select("form"))


def residue_values(media: DataFrame, fields: tuple[str, ...] = ("caption", "description"), key: str = "id") -> DataFrame:
    """(media_id, field): the values with a sentence in a labelled component, once each. Null and empty values are none."""
    long = media.select(F.col(key).cast("string").alias("media_id"), F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields))).alias("x")).select("media_id", "x.*").where("trim(value) != ''")
    labelled = residue_forms(long.select("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(m, f, s) for m, f, v in zip(*(texts_of(batch, c) for c in ("media_id", "field", "value"))) for s in map(sentence_form, sentence_list(v))]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.string()) for c in range(3)], ["media_id", "field", "form"])

    said = long.mapInArrow(run, "media_id string, field string, form string").where("form != ''")
    return said.join(labelled, "form", "left_semi").select("media_id", "field").distinct()


def indexable(media: DataFrame, fields: tuple[str, ...] = ("caption", "description"), key: str = "id") -> DataFrame:
    """`media` with null in place of residue in `fields`; all rows and other columns stay."""
    found = residue_values(media, fields, key).groupBy("media_id").agg(F.collect_set("field").alias("residue_fields"))  # at most as many as fields
    joined = media.join(found.withColumnRenamed("media_id", "residue_id"), F.col(key) == F.col("residue_id"), "left")
    return joined.select(*(F.when(F.array_contains(F.coalesce("residue_fields", F.array().cast("array<string>")), c), None).otherwise(F.col(f"`{c}`")).alias(c) if c in fields else F.col(f"`{c}`") for c in media.columns))
