"""Operator 5: the language of a text, by hierarchical discrimination.

First the language family is predicted, by linear support vector machines one against the rest; then the languages of
that family are told apart by one-versus-one linear support vector machines, whose votes (margins break ties) decide.
Features are frequencies of hashed runs of three bytes over the whole text, with A-Z lowered and all other ASCII that is
not a letter as one separator. A linear margin is then a sum of table entries over the text, so scoring is one pass.

The machines learn from a bounded sample: for each language at most `MAX_PER_LANGUAGE` documents, those with the
smallest hash of their id, and at most `MAX_TRAIN` in all, dealt out by rank, so that up to that number every language
has one. `FAMILIES` groups languages; one that it lacks is a family of its own. The machines of a family grow with the
square of its languages.

Edge cases: a null text or one without any letter is `und` with score 0; so is every text if nothing was learned. With
one learned language all other texts get it. An empty table gives an empty result; a text is read whole however long, a
long one alone; of equal votes and odds the first language by name wins. Repeated rows are predicted one by one. Columns besides doc_id, text and
lang are not looked at, and lang only in learning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.common import Workspace, annotate, binary_array, fresh_name, held_out, text_chunks

MODULUS, REMAINDER = 4, 2
MAX_PER_LANGUAGE, MAX_TRAIN = 600, 6000
GRAM_BITS = 12
PASSAGE, MAX_PASSAGES = 400, 15  # bytes of a passage at least; an odd number of passages, so that one is in the middle
CUT_QUANTILE, CUT_LEAST = 0.001, 200  # of correct held-out documents; fewer than the least set no cut
RANGE_PARTS = 4096  # of a range of scores, in which the quantile is looked for
UNKNOWN = "und"
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl"],
    "slavic": ["ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "be"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
    "indo-aryan": ["hi", "ur", "bn", "mr", "ne", "pa", "gu"],
    "semitic": ["ar", "he", "mt", "am"],
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122)]] = 32
_ASCII_LETTER = np.zeros(256, np.uint8)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = 1


def grams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashed three-byte runs, offsets): every document is set between separators, so each has at least one."""
    size = np.diff(off)
    padded = np.full(len(buf) + 2 * len(size) + 2, 32, np.uint32)
    shift = np.repeat(2 * np.arange(len(size)) + 1, size)
    padded[np.arange(len(buf)) + shift] = _FOLD[buf]
    code = padded[:-2] * np.uint32(0x9E3779B1) + padded[1:-1] * np.uint32(0x85EBCA77) + padded[2:] * np.uint32(0xC2B2AE3D)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x27D4EB2F)
    # A document of n bytes has n + 2 padded ones and owns n runs (1 where it is empty), all inside its own padding.
    first = off[:-1] + 2 * np.arange(len(size))
    return code >> np.uint32(32 - GRAM_BITS), np.stack([first, first + np.maximum(size, 1)], 1)


def profiles(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Frequencies of the hashed runs, a float32 row for each document."""
    code, spans = grams(buf, off)
    out = np.zeros((len(spans), 1 << GRAM_BITS), np.float32)
    for i, (a, b) in enumerate(spans):
        out[i] = np.bincount(code[a:b], minlength=1 << GRAM_BITS) / (b - a)
    return out


def has_letter(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether a document has a letter of any script."""
    size = np.diff(off)
    out = np.zeros(len(size), bool)
    full = np.flatnonzero(size)
    if len(full):
        out[full] = np.add.reduceat(_ASCII_LETTER[buf], off[:-1][full], dtype=np.int64) > 0
    for i in full[~out[full]]:
        out[i] = any(map(str.isalpha, buf[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace")))
    return out


# ------------------------------------------------------------------ machines


def svm(x: np.ndarray, y: np.ndarray, c: float = 1e-3, rounds: int = 100) -> tuple[np.ndarray, float, float]:
    """(weights, bias, slope) of a linear machine with squared hinge loss; slope turns a margin into log odds. y is +1 or -1."""
    # The features are scaled to unit spread by scaling the weights, without a copy of the rows.
    spread = (x.std(0) + 1e-4 * x.std() + 1e-9).astype(np.float32)
    y = y.astype(np.float32)
    n = len(y)
    balance = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    v, norm = np.random.default_rng(0).standard_normal(x.shape[1]).astype(np.float32), np.float32(1)
    for _ in range(8):
        v = ((balance * (x @ (v / spread))) @ x) / spread
        norm = np.linalg.norm(v) + np.float32(1e-12)
        v /= norm
    step = np.float32(1 / (2 * (norm + 1) + c))
    w, b = np.zeros(x.shape[1], np.float32), np.float32(0)
    vw, vb, t = w, b, 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ (vw / spread) + vb)) * balance * y
        nw, nb = vw + step * (2 * (slack @ x) / spread - np.float32(c) * vw), vb + step * 2 * slack.sum()
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        vw, vb = nw + np.float32((t - 1) / t2) * (nw - w), nb + np.float32((t - 1) / t2) * (nb - b)
        w, b, t = nw, nb, t2
    margin, slope = y * (x @ (w / spread) + b), 1.0
    for _ in range(60):  # one-parameter logistic fit of the margins
        p = 1 / (1 + np.exp(np.clip(slope * margin, -30, 30)))
        slope = float(np.clip(slope + 2.0 * (p * margin).sum() / n, 0.1, 20))
    return (w / spread).astype(np.float32), float(b), slope


@dataclass(frozen=True)
class Machine:
    weights: np.ndarray
    bias: float
    slope: float


@dataclass(frozen=True)
class LanguageModel:
    families: tuple[str, ...] = ()
    languages: dict[str, tuple[str, ...]] = field(default_factory=dict)  # by family
    family_machines: tuple[Machine, ...] = ()  # one for each family against the rest; none if there is one family
    pair_machines: dict[str, dict[tuple[int, int], Machine]] = field(default_factory=dict)

    def predict(self, buf: np.ndarray, off: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(off) - 1
        names, score = np.full(n, UNKNOWN, object), np.zeros(n)
        known = has_letter(buf, off)
        if not self.families or not known.any():
            return names.tolist(), score
        code, spans = grams(buf, off)
        flat = spans.ravel()

        def margins(machine: Machine) -> np.ndarray:
            # Every second run of reduceat is a document; the others are the padding between them.
            sums = np.add.reduceat(machine.weights[code], np.minimum(flat, len(code) - 1), dtype=np.float64)[::2]
            return sums / (spans[:, 1] - spans[:, 0]) + machine.bias

        family, sure = np.zeros(n, int), np.ones(n)
        if self.family_machines:
            odds = np.stack([m.slope * margins(m) for m in self.family_machines], 1)
            family = odds.argmax(1)
            rest = np.where(np.arange(odds.shape[1]) == family[:, None], -np.inf, odds).max(1)
            sure = 1 / (1 + np.exp(-np.clip((odds.max(1) - rest) / 2, -30, 30)))
        for f, name in enumerate(self.families):
            own, langs = np.flatnonzero((family == f) & known), self.languages[name]
            if not len(own):
                continue
            votes, odds = np.zeros((n, len(langs))), np.zeros((n, len(langs)))
            for (i, j), machine in self.pair_machines.get(name, {}).items():
                m = machine.slope * margins(machine)
                votes[:, i] += m > 0
                votes[:, j] += m <= 0
                odds[:, i] += m
                odds[:, j] -= m
            rank = votes + np.tanh(odds) * 0.25
            best = rank.argmax(1)
            others = max(1, len(langs) - 1)
            within = 1 / (1 + np.exp(-np.clip(odds[np.arange(n), best] / others, -30, 30))) if len(langs) > 1 else np.ones(n)
            names[own] = np.array(langs, object)[best[own]]
            score[own] = (sure * within)[own]
        return names.tolist(), np.clip(score, 0, 1)


def train(x: np.ndarray, langs: list[str]) -> LanguageModel:
    names = np.array(langs, object)
    if not len(names):
        return LanguageModel()
    family = np.array([_FAMILY.get(v, v) for v in langs], object)
    families = tuple(sorted(set(family)))
    first = ()
    if len(families) == 2:
        m = Machine(*svm(x, np.where(family == families[0], 1.0, -1.0)))
        first = (m, Machine(-m.weights, -m.bias, m.slope))
    elif len(families) > 2:
        first = tuple(Machine(*svm(x, np.where(family == f, 1.0, -1.0))) for f in families)
    languages = {f: tuple(sorted(set(names[family == f]))) for f in families}
    pairs: dict[str, dict[tuple[int, int], Machine]] = {}
    for f, own in languages.items():
        pairs[f] = {}
        for i in range(len(own)):
            for j in range(i + 1, len(own)):
                rows = (names == own[i]) | (names == own[j])
                pairs[f][i, j] = Machine(*svm(x[rows], np.where(names[rows] == own[i], 1.0, -1.0)))
    return LanguageModel(families, languages, first, pairs)


def _profile_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for c in text_chunks(batch.column("text")):
            rows = binary_array(profiles(c.buf, c.off).astype(np.float16))
            yield pa.RecordBatch.from_arrays([batch.column(n).slice(c.lo, c.hi - c.lo) for n in ("doc_id", "lang")] + [rows], names=["doc_id", "lang", "profile"])


def learn(docs: DataFrame, max_per_language: int = MAX_PER_LANGUAGE, max_train: int = MAX_TRAIN) -> LanguageModel:
    """A model from the text and lang of documents outside the held-out part; the sample is bounded as the module says."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")).where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"), MODULUS, REMAINDER))
    known = known.distinct()
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))  # a row for each language: the optimizer may broadcast it
    # A first cut by hash leaves about four times the rows wanted, so that a language with most rows meets in no task.
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30))
    some = known.join(counts, "lang").where(place * F.col("n") < (4 * max_per_language) * (1 << 30))
    order = Window.partitionBy("lang").orderBy(place, "doc_id")
    chosen = some.withColumn("r", F.row_number().over(order)).where(F.col("r") <= max_per_language)
    chosen = chosen.orderBy("r", "lang", "doc_id").limit(max_train).select("doc_id", "lang")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most max_train rows of an id and a short code: their size is bounded, so they may be broadcast.
    rows = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(_profile_rows, "doc_id long, lang string, profile binary").orderBy("doc_id", "lang").limit(max_train).toArrow()
    packed = rows.column("profile").combine_chunks()
    x = np.frombuffer(packed.buffers()[2], np.float16, count=len(packed) << GRAM_BITS) if len(packed) else np.zeros(0, np.float16)
    return train(x.reshape(len(packed), 1 << GRAM_BITS).astype(np.float32), rows.column("lang").to_pylist())


def with_language(docs: DataFrame, model: LanguageModel, keep: list[str]) -> tuple[DataFrame, str, str]:
    """The columns `keep` of docs, the predicted language and the score, under names that none of them has."""
    lang, score = fresh_name(keep, "lang_pred"), fresh_name(keep, "lang_score")

    def rate(buf: np.ndarray, off: np.ndarray) -> list:
        names, scores = model.predict(buf, off)
        return [pa.array(names, pa.string()), scores]

    return annotate(docs, "text", rate, [(lang, "string"), (score, "double")], keep), lang, score


def majority(model: LanguageModel, buf: np.ndarray, off: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(commonest language, median score) of the passages with a letter; `und` and -1 where there is none.

    If no language was learned, all is `und`, with 0 where there is a letter.
    """
    if not model.families:
        return [UNKNOWN] * (len(off) - 1), np.where(has_letter(buf, off), 0.0, -1.0)
    size = np.diff(off)
    parts = np.clip(size // PASSAGE, 1, MAX_PASSAGES)
    doc = np.repeat(np.arange(len(size)), parts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = off[:-1][doc] + nth * size[doc] // parts[doc]
    end = off[1:][doc]
    for _ in range(3):  # a character isn't cut
        inside = np.flatnonzero((nth > 0) & (start < end))
        start[inside] += (buf[start[inside]] & 0xC0) == 0x80
    found, scores = model.predict(buf, np.append(start, off[-1]))
    found = np.array(found, object)
    names, score = [UNKNOWN] * len(size), np.full(len(size), -1.0)
    edge = np.searchsorted(doc, np.arange(len(size) + 1))
    for i, (lo, hi) in enumerate(zip(edge, edge[1:], strict=False)):
        told = found[lo:hi] != UNKNOWN
        if told.any():
            score[i] = np.median(scores[lo:hi][told])
            kinds, n = np.unique(found[lo:hi][told].astype(str), return_counts=True)
            names[i] = str(kinds[n.argmax()])
    return names, score


def with_majority(docs: DataFrame, model: LanguageModel, keep: list[str]) -> tuple[DataFrame, str, str]:
    """Like `with_language`, judged by most passages instead of the whole text."""
    lang, score = fresh_name(keep, "lang_pred"), fresh_name(keep, "lang_score")

    def rate(buf: np.ndarray, off: np.ndarray) -> list:
        names, scores = majority(model, buf, off)
        return [pa.array(names, pa.string()), scores]

    return annotate(docs, "text", rate, [(lang, "string"), (score, "double")], keep), lang, score


def value_at(values: DataFrame, column: str, place: int) -> float:
    """The value that stands at a place, from 0, in the order of all values.

    Ranges that hold the place are made narrower until one value is left; of each, `RANGE_PARTS` counts come to the driver.
    """
    value = F.col(column)
    low, high = values.agg(F.min(value), F.max(value)).first()
    while low < high:
        part = F.least(F.floor((value - low) / (high - low) * RANGE_PARTS), F.lit(RANGE_PARTS - 1)).alias("part")
        counts = values.where(value.between(low, high)).groupBy(part).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        for r in sorted(counts.collect(), key=lambda r: r.part):
            if place < r.n:
                low, high = r.low, r.high
                break
            place -= r.n
    return low


def learn_cut(docs: DataFrame, model: LanguageModel) -> float:
    """The score below which a text is in no learned language: a low quantile of all correct held-out documents, 0 if they are few."""
    ws = Workspace(docs.sparkSession, "cut")
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & held_out(F.col("doc_id"), MODULUS, REMAINDER))
    rated, lang, score = with_majority(known.select("lang", "text"), model, ["lang"])
    right = ws.table(rated.where((F.col(lang) == F.col("lang")) & (F.col(score) >= 0)).select(score), "right")
    n = right.count()
    cut = value_at(right, score, int(CUT_QUANTILE * (n - 1))) if n >= CUT_LEAST else 0.0
    ws.clear()
    return cut


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs (doc_id, text, lang)."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rated, lang, score = with_language(ids, learn(docs), ["doc_id"])
    return rated.select("doc_id", held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"), F.col(lang).alias("lang_pred"), F.col(score).alias("score"))
