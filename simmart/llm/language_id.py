"""Language of texts and of spans in mixed texts (operator 7).

Words are scored by hashed character trigrams for each language. The script of a word narrows the candidates to the
languages that use it. Viterbi over the words, with a penalty for every switch, labels spans; the language with most
letters is that of the text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bound of the sample the model is fitted on: rows of each language, counted in so many tasks.
TRAIN_ROWS = 2000
TRAIN_PARTS = 8
# Rows are chosen by a hash of so many values.
PLACES = 1 << 40
FEATURES = 1 << 16
SWITCH = 12.0
# A language takes words of a script when at least this share of its letters is in it.
SCRIPT_SHARE = 0.01
NOT_A_CANDIDATE = np.float32(-30.0)
# Bytes of text and language scores that a task handles at once.
PIECE_BYTES = 32 << 20
UNKNOWN = "und"

# Scripts and the ranges of Unicode's blocks that hold their letters.
SCRIPTS = {
    "Latin": [(0x41, 0x2AF), (0x1D00, 0x1DBF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xAB30, 0xAB6F),
              (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x530, 0x58F), (0xFB13, 0xFB17)],
    "Hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x870, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Syriac": [(0x700, 0x74F), (0x860, 0x86F)],
    "Thaana": [(0x780, 0x7BF)],
    "NKo": [(0x7C0, 0x7FF)],
    "Samaritan": [(0x800, 0x83F)],
    "Mandaic": [(0x840, 0x85F)],
    "Devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "Bengali": [(0x980, 0x9FF)],
    "Gurmukhi": [(0xA00, 0xA7F)],
    "Gujarati": [(0xA80, 0xAFF)],
    "Oriya": [(0xB00, 0xB7F)],
    "Tamil": [(0xB80, 0xBFF)],
    "Telugu": [(0xC00, 0xC7F)],
    "Kannada": [(0xC80, 0xCFF)],
    "Malayalam": [(0xD00, 0xD7F)],
    "Sinhala": [(0xD80, 0xDFF)],
    "Thai": [(0xE00, 0xE7F)],
    "Lao": [(0xE80, 0xEFF)],
    "Tibetan": [(0xF00, 0xFFF)],
    "Myanmar": [(0x1000, 0x109F), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F)],
    "Georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF), (0xFFA0, 0xFFDC)],
    "Ethiopic": [(0x1200, 0x139F), (0x2D80, 0x2DDF), (0xAB00, 0xAB2F)],
    "Cherokee": [(0x13A0, 0x13FF), (0xAB70, 0xABBF)],
    "Canadian syllabics": [(0x1400, 0x167F), (0x18B0, 0x18FF)],
    "Khmer": [(0x1780, 0x17FF)],
    "Mongolian": [(0x1800, 0x18AF)],
    "Glagolitic": [(0x2C00, 0x2C5F)],
    "Coptic": [(0x2C80, 0x2CFF)],
    "Tifinagh": [(0x2D30, 0x2D7F)],
    "Kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)],
    "Bopomofo": [(0x3100, 0x312F)],
    "Han": [(0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
    "Yi": [(0xA000, 0xA4CF)],
    "Adlam": [(0x1E900, 0x1E95F)],
    "all others": [],
}
LETTER, MARK = 1, 2

SPANS = "array<struct<lang: string, first_word: int, last_word: int>>"


@dataclass(frozen=True)
class Model:
    langs: list[str]
    scores: np.ndarray  # features x languages
    allowed: np.ndarray  # scripts x languages


@cache
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: ``LETTER`` (category L), ``MARK`` (M) or 0, the number of the script, and the small letter below 0x800."""
    kinds = {"L": LETTER, "M": MARK}
    kind = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), np.uint8, 0x110000)
    script = np.full(0x110000, len(SCRIPTS) - 1, np.uint8)
    for n, ranges in enumerate(SCRIPTS.values()):
        for first, last in ranges:
            script[first : last + 1] = n
    small = [chr(c).lower() for c in range(0x800)]
    lower = np.array([ord(t) if len(t) == 1 and 0x80 <= ord(t) < 0x800 else c for c, t in enumerate(small)])
    return kind, script, lower


class Words:
    """The words of some texts as ranges of letters and their marks in one array of bytes."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8).copy()
        raw[(raw >= 0x41) & (raw <= 0x5A)] |= 0x20
        word = (raw >= 0x61) & (raw <= 0x7A)
        letter = word.copy()
        self.script = np.zeros(len(raw), np.uint8)
        kinds, scripts, lower = _characters()
        # leading bytes and lengths of longer characters
        for low, high, size in ((0xC2, 0xDF, 2), (0xE0, 0xEF, 3), (0xF0, 0xF4, 4)):
            at = np.flatnonzero((raw >= low) & (raw <= high))
            code = (raw[at] & (0xFF >> (size + 1))).astype(np.int64)
            for k in range(1, size):
                code = code << 6 | raw[at + k] & 0x3F
            if size == 2:
                code = lower[code]
                raw[at], raw[at + 1] = 0xC0 | code >> 6, 0x80 | code & 0x3F
            kind = kinds[code]
            letter[at] = kind == LETTER
            self.script[at] = scripts[code]
            for k in range(size):
                word[at + k] = kind > 0
        raw[~word] = 0x20
        turn = np.flatnonzero(word[1:] != word[:-1]) + 1
        heads = np.concatenate([[0], np.cumsum(letter)])
        letters = heads[turn[1::2]] - heads[turn[0::2]]
        some = letters > 0  # marks without a letter are no word
        self.raw, self.starts, self.ends, self.letters = raw, turn[0::2][some], turn[1::2][some], letters[some]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.concatenate([[0], np.cumsum(sizes + 1)]) + 1
        self.counts = np.diff(np.searchsorted(self.starts, begin))

    def features(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Trigrams around every byte of the words first..last, and where each word begins among them."""
        size = self.ends[first:last] - self.starts[first:last]
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        at = np.arange(int(size.sum())) + np.repeat(self.starts[first:last] - begin, size)
        r = self.raw.astype(np.uint32)
        gram = (r[at - 1] << 16 | r[at] << 8 | r[at + 1]) * np.uint32(0x9E3779B1)
        return (gram >> np.uint32(16)).astype(np.int64), begin

    def scripts(self) -> np.ndarray:
        """Script of the first character of each word."""
        return self.script[self.starts]


def _word_scores(words: Words, model: Model) -> np.ndarray:
    out, step = np.empty((len(words.starts), len(model.langs)), np.float32), 200_000
    for first in range(0, len(out), step):
        last = min(len(out), first + step)
        grams, begin = words.features(first, last)
        out[first:last] = np.add.reduceat(model.scores[grams], begin, axis=0)
    allowed = model.allowed[words.scripts()]
    return np.where(allowed | ~allowed.any(axis=1, keepdims=True), out, out + NOT_A_CANDIDATE)


def viterbi(scores: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    """The best label of every word when each change of label inside a text costs ``switch``.

    All texts take their n-th word together; longer texts first, so those still running are a prefix.
    """
    labels = np.zeros(len(scores), np.int64)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    if not len(order):
        return labels
    first = (np.cumsum(counts) - counts)[order]
    size = counts[order]
    running = np.searchsorted(-size, -np.arange(int(size[0])), side="left")  # texts longer than t words
    stay = np.ones(scores.shape, bool)
    come = np.zeros(len(scores), np.int16)
    value = scores[first].copy()
    for t in range(1, int(size[0])):
        n = running[t]
        at, old = first[:n] + t, value[:n]
        best = old.argmax(axis=1)
        other = old[np.arange(n), best][:, None] - np.float32(switch)
        keep = old >= other
        stay[at], come[at] = keep, best
        value[:n] = scores[at] + np.where(keep, old, other)
    label = value.argmax(axis=1)
    for t in range(int(size[0]) - 1, -1, -1):
        n = running[t]
        at, own = first[:n] + t, label[:n]
        labels[at] = own
        label[:n] = np.where(stay[at, own], own, come[at])
    return labels


def _spans(labels: np.ndarray, langs: list[str]) -> list[dict]:
    cut = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
    return [{"lang": langs[labels[a]], "first_word": a, "last_word": b - 1} for a, b in zip(cut, cut[1:])]


def _predict(texts: list[bytes], model: Model, switch: float, spans: bool) -> list[dict]:
    words = Words(texts)
    labels = viterbi(_word_scores(words, model), words.counts, switch)
    doc = np.repeat(np.arange(len(texts)), words.counts)
    share = np.zeros((len(texts), len(model.langs)))
    np.add.at(share, (doc, labels), words.letters)
    total = share.sum(axis=1)
    best = share.argmax(axis=1)
    out, at = [], 0
    for i, n in enumerate(words.counts.tolist()):
        found = {"lang_pred": UNKNOWN, "score": 0.0, "spans": []}
        if total[i]:
            found["lang_pred"] = model.langs[best[i]]
            found["score"] = float(share[i, best[i]] / total[i])
            if spans:
                found["spans"] = _spans(labels[at : at + n], model.langs)
        at += n
        out.append(found)
    return out


def _label(model: Model, switch: float, spans: bool):
    kind = pa.struct(
        [
            ("lang_pred", pa.string()),
            ("score", pa.float64()),
            ("spans", pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("last_word", pa.int32())]))),
        ]
    )

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        limit = max(1 << 20, PIECE_BYTES // max(4, len(model.langs)))
        for batch in batches:
            yield pa.array([f for texts in _pieces(batch, limit) for f in _predict(texts, model, switch, spans)], kind)

    return run


def _pieces(texts: pa.Array | pa.ChunkedArray, limit: int) -> Iterator[list[bytes]]:
    """Runs of whole texts of about ``limit`` bytes."""
    texts = pa.compute.fill_null(texts.cast(pa.binary()), b"")
    sizes = np.cumsum(pa.compute.binary_length(texts).to_numpy(), dtype=np.int64)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + limit)))
        yield texts.slice(first, last - first).to_pylist()
        first = last


def _count(table: pa.Table) -> pa.Table:
    """Trigram and script counts of a part of the sample of one language."""
    counts, scripts = np.zeros(FEATURES), np.zeros(len(SCRIPTS))
    for texts in _pieces(table["text"], PIECE_BYTES // 8):
        words = Words(texts)
        grams, _ = words.features(0, len(words.starts))
        counts += np.bincount(grams, minlength=FEATURES)
        scripts += np.bincount(words.scripts(), weights=words.letters, minlength=len(SCRIPTS))
    return pa.table(
        {
            "lang": pa.array([table["lang"][0].as_py()], pa.string()),
            "grams": pa.array([counts.astype(np.float32).tobytes()], pa.binary()),
            "scripts": pa.array([scripts.tolist()], pa.list_(pa.float64())),
        }
    )


def fit(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int = TRAIN_ROWS) -> Model:
    """A model from about ``rows`` rows of each language, chosen by a hash of the id.

    Rows without text or language are not used. The sample of a language is counted in ``TRAIN_PARTS`` tasks, each of
    which hands 256 KB to the driver.
    """
    known = labelled.select(
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        F.pmod(F.xxhash64(id_col, F.lit("sample")), F.lit(PLACES)).alias("place"),
    ).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = known.select("lang").groupBy("lang").count()
    share = F.lit(float(rows * PLACES)) / F.col("count")
    sample = known.join(F.broadcast(sizes.select("lang", share.alias("share"))), "lang").filter("place < share")
    parts = sample.select("lang", "text", (F.col("place") % TRAIN_PARTS).alias("part")).groupBy("lang", "part")
    counted = parts.applyInArrow(_count, "lang string, grams binary, scripts array<double>")
    sums: dict[str, list[np.ndarray]] = {}
    for r in counted.toLocalIterator():
        own = sums.setdefault(r["lang"], [np.zeros(FEATURES), np.zeros(len(SCRIPTS))])
        own[0] += np.frombuffer(r["grams"], np.float32)
        own[1] += r["scripts"]
    langs = sorted(sums)
    if not langs:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    grams = np.array([sums[name][0] for name in langs]) + 0.5
    logs = np.log(grams / grams.sum(axis=1, keepdims=True))
    letters = np.array([sums[name][1] for name in langs])
    return Model(
        langs,
        np.ascontiguousarray((logs - logs.max(axis=0)).T.astype(np.float32)),
        (letters >= SCRIPT_SHARE * letters.sum(axis=1, keepdims=True)).T,
    )


def identify(docs: DataFrame, model: Model, text_col: str = "text", switch: float = SWITCH, spans: bool = False) -> DataFrame:
    """Every row of ``docs`` with ``lang_pred``, ``score`` and, on demand, ``spans``.

    ``score`` is the share of letters inside spans of the predicted language. Texts without letters, null and empty
    ones, and all texts under a model without languages are ``und`` with score 0; letters are the characters of category L
    of Unicode in any script, and scripts that no language was learned from leave all languages as candidates. Ties go to the language that comes
    first by name. Spans count words (runs of letters and their marks) from 0. Columns of these names are replaced.
    """
    text = F.col(text_col).cast("string")
    if not model.langs:
        found: Column = F.struct(
            F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.array().cast(SPANS).alias("spans")
        )
    else:
        kind = f"struct<lang_pred: string, score: double, spans: {SPANS}>"
        found = F.arrow_udf(_label(model, switch, spans), kind)(text)
    letters = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    # A letter that only Spark's version of Unicode knows makes no word: the first language by name.
    first = F.lit(model.langs[0] if model.langs else UNKNOWN)
    # the row stays in a struct, so that no column of the caller can have a name that is used here
    named = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), found.alias("found"), letters.alias("letters"))
    columns = {
        "lang_pred": F.when(~F.col("letters"), UNKNOWN).when(F.col("found.score") == 0, first).otherwise(F.col("found.lang_pred")),
        "score": F.when(F.col("letters"), F.col("found.score")).otherwise(0.0),
    }
    if spans:
        columns["spans"] = F.col("found.spans")
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in columns]
    return named.select(*kept, *(column.alias(c) for c, column in columns.items()))
