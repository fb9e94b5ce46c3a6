"""Operator 10: a quality classifier made of rules.

Shallow trees are boosted on text statistics; every path from a root is a rule, a conjunction of `statistic <= cut` and
`statistic > cut`; a lasso logistic regression over the rules keeps a few of them with weights; those are compiled into
one Spark column expression over the statistics. The trees are grown on a bounded sample of labelled documents
(`MAX_TRAIN`, those with the smallest hash of their id); scoring covers the whole text of every document. The lasso sees
the `CANDIDATES` rules that tell most by themselves and chooses at most `MAX_RULES` of them; as it shrinks what it keeps,
the weights of those are fitted once more with a penalty of 1e-5.

Edge cases: a null text counts as empty and gets a score like any other; with no usable label, or labels of one kind
only, the score is the smoothed share of label 1 for all; a document labelled more than once has the smaller label;
repeated rows are scored one by one; an empty table gives an empty result; a text is read whole however long; of rules
that hold for the same rows the shortest counts, then the first by its conditions; a null doc_id is hashed as empty text and never learned from. Columns besides
doc_id and text are not looked at.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import annotate, fresh_name, held_out, span_hashes, word_hashes, word_spans

MAX_TRAIN = 20_000
TREES, DEPTH, BINS, SHRINK = 60, 3, 32, 0.15
CANDIDATES, MAX_RULES = 300, 40
PENALTIES = (3e-2, 1e-2, 3e-3, 1e-3, 3e-4)  # falling
THRESHOLD = 0.7
MODULUS, REMAINDER = 4, 2

_CLASSES = {
    "upper": [(65, 90)],
    "lower": [(97, 122)],
    "digit": [(48, 57)],
    "high": [(128, 255)],
    "blank": [(9, 13), (32, 32)],
    "stop": [(33, 33), (46, 46), (63, 63)],
    "comma": [(44, 44), (59, 59)],
    "exclaim": [(33, 33)],
    "pipe": [(124, 124)],
    "symbol": [(35, 38), (42, 43), (60, 62), (64, 64), (94, 94), (96, 96), (126, 126)],
    "bracket": [(40, 41), (91, 93), (123, 123), (125, 125)],
    "quote": [(34, 34), (39, 39)],
}
STATISTICS = ["n_bytes", "n_words", "n_lines", "word_bytes", "line_words", "longest_word", "short_words", "distinct_words", "top_word", "distinct_lines", "upper_words", "upper_of_letters", "starts_upper", "word_ends_other", *(f"{c}_share" for c in _CLASSES)]


def _table(ranges: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for a, b in ranges:
        out[a : b + 1] = 1
    return out


_TABLES = {c: _table(r) for c, r in _CLASSES.items()}
_LETTER_OR_STOP = _TABLES["upper"] | _TABLES["lower"] | _TABLES["high"] | _TABLES["digit"] | _TABLES["stop"] | _TABLES["comma"]


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of flags between offsets, zero for empty runs."""
    size = np.diff(off)
    full = size > 0
    out = np.zeros(len(size), np.int64)
    if full.any():
        out[full] = np.add.reduceat(flags, off[:-1][full], dtype=np.int64)
    return out


def statistics(buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """The columns of STATISTICS, as doubles; shares are of bytes, words, lines or letters and 0 where there is none."""
    n = np.diff(off)
    words = word_spans(buf, off)
    n_words = np.diff(words.off)
    length = words.end - words.start
    count = {c: _sums(t[buf], off) for c, t in _TABLES.items()}
    newline = buf == 10
    n_lines = _sums(newline.view(np.uint8), off) + (n > 0)

    hashes = word_hashes(buf, words)
    distinct, top = np.zeros(len(n)), np.zeros(len(n))
    for d in range(len(n)):
        a, b = words.off[d], words.off[d + 1]
        if b > a:
            part = np.sort(hashes[a:b])
            edge = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
            distinct[d], top[d] = len(edge) - 1, np.diff(edge).max()

    inner = off[1:-1]
    cuts = np.unique(np.concatenate([off[:-1][n > 0], np.flatnonzero(newline) + 1, inner]))
    cuts = cuts[cuts < len(buf)]
    ends = np.append(cuts[1:], len(buf))
    ends = np.where((ends > cuts) & newline[np.maximum(ends - 1, 0)], ends - 1, ends) if len(cuts) else ends
    lines = span_hashes(buf, cuts, ends) if len(cuts) else np.zeros(0, np.uint64)
    line_off = np.searchsorted(cuts, off)
    distinct_lines = np.zeros(len(n))
    for d in np.flatnonzero(np.diff(line_off) > 1):
        distinct_lines[d] = len(np.unique(lines[line_off[d] : line_off[d + 1]]))
    distinct_lines[np.diff(line_off) == 1] = 1

    upper, lower = count["upper"], count["lower"]
    first = buf[words.start] if len(length) else np.zeros(0, np.uint8)
    last = buf[words.end - 1] if len(length) else np.zeros(0, np.uint8)
    ups = np.concatenate([[0], np.cumsum(_TABLES["upper"][buf], dtype=np.int64)])
    all_upper = ((ups[words.end] - ups[words.start]) * 2 > length) & (length > 1)
    longest = np.zeros(len(n))
    has = n_words > 0
    if has.any():
        longest[has] = np.maximum.reduceat(length, words.off[:-1][has])

    def share(x: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.where(of > 0, x / np.maximum(of, 1), 0.0)

    def word_sum(flags: np.ndarray) -> np.ndarray:
        return _sums(flags.view(np.uint8), words.off)

    out = [
        n, n_words, n_lines, share(_sums(length, words.off), n_words), share(n_words, n_lines), longest, share(word_sum(length <= 3), n_words), share(distinct, n_words), share(top, n_words),
        share(distinct_lines, n_lines), share(word_sum(all_upper), n_words), share(upper, upper + lower), share(word_sum(_TABLES["upper"][first].astype(bool)), n_words),
        share(word_sum(_LETTER_OR_STOP[last] == 0), n_words), *(share(count[c], n) for c in _CLASSES),
    ]
    return [np.asarray(x, np.float64) for x in out]


# ------------------------------------------------------------------ trees, rules, lasso


@dataclass(frozen=True)
class Condition:
    feature: int
    above: bool  # > cut, else <= cut
    cut: float


@dataclass(frozen=True)
class RuleModel:
    names: tuple[str, ...]
    rules: tuple[tuple[Condition, ...], ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for rule, w in zip(self.rules, self.weights, strict=True):
            z += w * _holds(rule, x)
        return 1 / (1 + np.exp(-z))

    def column(self, columns: dict[str, str]) -> Column:
        """The score as a Spark expression over statistics; `columns` maps their names to those of the table."""
        terms = [F.lit(float(self.intercept))]
        for rule, w in zip(self.rules, self.weights, strict=True):
            tests = [(F.col(columns[self.names[c.feature]]) > c.cut) if c.above else (F.col(columns[self.names[c.feature]]) <= c.cut) for c in rule]
            terms.append(F.when(functools.reduce(lambda a, b: a & b, tests), float(w)).otherwise(0.0))
        while len(terms) > 1:  # a balanced sum: a chain of many rules would be too deep a tree
            terms = [a + b for a, b in zip(terms[::2], terms[1::2], strict=False)] + terms[len(terms) & ~1 :]
        return 1 / (1 + F.exp(-terms[0]))


def _holds(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= (x[:, c.feature] > c.cut) == c.above
    return out


def _tree(binned: np.ndarray, cuts: list[np.ndarray], target: np.ndarray, rows: np.ndarray, features: np.ndarray, depth: int) -> tuple[list[tuple[Condition, ...]], np.ndarray]:
    """Paths of a least-squares tree, and its prediction for every row."""
    paths: list[tuple[Condition, ...]] = []
    out = np.zeros(len(target))

    def grow(own: np.ndarray, every: np.ndarray, path: tuple[Condition, ...], left: int) -> None:
        if path:
            paths.append(path)
        best = (1e-9, -1, 0)
        least = max(5, len(rows) // 500)
        if left and len(own) >= 2 * least:
            total, size = target[own].sum(), len(own)
            for f in features:
                b = binned[own, f]
                cnt = np.cumsum(np.bincount(b, minlength=BINS + 1))[:-1]
                tot = np.cumsum(np.bincount(b, weights=target[own], minlength=BINS + 1))[:-1]
                ok = (cnt >= least) & (size - cnt >= least)
                gain = np.where(ok, tot**2 / np.maximum(cnt, 1) + (total - tot) ** 2 / np.maximum(size - cnt, 1) - total**2 / size, 0)[: len(cuts[f])]
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), f, int(gain.argmax()))
        if best[1] < 0:
            out[every] = target[own].mean() if len(own) else 0.0
            return
        _, f, at = best
        for above in (False, True):
            grow(own[(binned[own, f] > at) == above], every[(binned[every, f] > at) == above], (*path, Condition(int(f), above, float(cuts[f][at]))), left - 1)

    grow(rows, np.arange(len(target)), (), depth)
    return paths, out


def _lasso(r: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient for the logistic loss with an absolute penalty; the intercept is free."""
    n, k = r.shape
    y = y.astype(np.float32)
    v, norm = np.ones(k, np.float32), np.float32(0)
    for _ in range(12):  # power iteration: the largest singular value, squared
        v = r.T @ (r @ (v / max(float(np.linalg.norm(v)), 1e-12)))
        norm = np.linalg.norm(v)
    step = np.float32(1 / (0.25 * (1.1 * float(norm) / n + 1)))
    penalty = np.float32(penalty)
    w, b = np.zeros(k, np.float32), np.float32(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(rounds):
        g = 1 / (1 + np.exp(-(r @ vw + vb))) - y
        new = vw - step * (g @ r) / np.float32(n)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        nb = vb - step * g.mean()
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        vw, vb = new + np.float32((t - 1) / t2) * (new - w), nb + np.float32((t - 1) / t2) * (nb - b)
        w, b, t = new, nb, t2
    return w.astype(np.float64), float(b)


def fit(x: np.ndarray, y: np.ndarray, names: list[str], seed: int = 10) -> RuleModel:
    y = y.astype(float)
    if len(y) == 0 or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(tuple(names), (), (), float(np.log(p / (1 - p))))
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    cuts = [c[c < x[:, f].max()] for f, c in enumerate(cuts)]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    margin, found = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}
    for _ in range(TREES):
        rows = rng.permutation(len(y))[: max(10, len(y) // 2)]
        features = rng.permutation(x.shape[1])[: max(3, x.shape[1] // 2)]
        p = 1 / (1 + np.exp(-margin))
        paths, step = _tree(binned, cuts, (y - p) / max(1e-3, float((p * (1 - p)).mean())), rows, features, DEPTH)
        margin += SHRINK * np.clip(step, -20, 20)
        found.update((tuple(sorted(q, key=lambda c: (c.feature, c.above, c.cut))), None) for q in paths)
    columns: dict[bytes, tuple[Condition, ...]] = {}
    for rule in sorted(found, key=len):  # of rules that hold for the same rows, the shortest
        columns.setdefault(np.packbits(_holds(rule, x)).tobytes(), rule)
    rules = [q for q in columns.values() if 0 < _holds(q, x).sum() < len(x)]
    # The rules that tell most by themselves go on to the lasso: a bound on the driver's memory.
    tells = [abs(float(np.dot(h - h.mean(), y - y.mean()))) / h.std() for h in (_holds(q, x).astype(np.float64) for q in rules)]
    rules = [rules[i] for i in np.sort(np.argsort(-np.array(tells), kind="stable")[:CANDIDATES])]
    r = np.stack([_holds(q, x) for q in rules], 1).astype(np.float32) if rules else np.zeros((len(y), 0), np.float32)
    check = rng.random(len(y)) < 0.25
    tried = []
    if r.shape[1] and check.any() and 0 < y[~check].mean() < 1:
        for penalty in PENALTIES:
            w, b = _lasso(r[~check], y[~check], penalty, 200)
            p = np.clip(1 / (1 + np.exp(-(r[check] @ w + b))), 1e-9, 1 - 1e-9)
            loss = -(y[check] * np.log(p) + (1 - y[check]) * np.log(1 - p))
            tried.append((loss.mean(), loss.std() / len(loss) ** 0.5, penalty))
    # The largest penalty within a standard error of the best: few rules. MAX_RULES bounds the compiled expression.
    least = min(tried, default=(0.0, 0.0, PENALTIES[0]))
    penalty = next((p for mean, _, p in tried if mean <= least[0] + least[1]), least[2])
    w, b = _lasso(r, y, penalty) if r.shape[1] else (np.zeros(0), float(np.log(y.mean() / (1 - y.mean()))))
    on = np.sort(np.argsort(-np.abs(w), kind="stable")[:MAX_RULES])
    on = on[np.abs(w[on]) > 1e-6]
    if len(on):  # the kept rules' weights once more, barely penalised, as the lasso shrinks them
        kept, b = _lasso(r[:, on], y, 1e-5)
        w = np.zeros(len(w))
        w[on] = kept
        on = on[np.abs(kept) > 1e-6]
    return RuleModel(tuple(names), tuple(rules[i] for i in on), tuple(float(w[i]) for i in on), float(b))


# ------------------------------------------------------------------ Spark


def learn(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> RuleModel:
    """A model from labelled documents outside the held-out part: at most `max_train`, those with the smallest id hash."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"), MODULUS, REMAINDER))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most max_train rows of two numbers: their size is bounded, so they may be broadcast.
    rows = annotate(texts.join(F.broadcast(known), "doc_id"), "text", statistics, [(s, "double") for s in STATISTICS], ["doc_id", "quality"]).orderBy("doc_id", *STATISTICS).limit(max_train).toArrow()
    return fit(np.stack([rows.column(s).to_numpy() for s in STATISTICS], 1), rows.column("quality").to_numpy(), STATISTICS)


def with_score(docs: DataFrame, model: RuleModel, keep: list[str]) -> tuple[DataFrame, str]:
    """The columns `keep` of docs and the score of the whole text, under a name that none of them has."""
    names = {s: fresh_name(keep, f"_stat_{s}") for s in STATISTICS}
    score = fresh_name(keep, "score")
    rated = annotate(docs, "text", statistics, [(names[s], "double") for s in STATISTICS], keep)
    return rated.select(*[F.col(f"`{c}`") for c in keep], model.column(names).alias(score)), score


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (doc_id, text); labels has (doc_id, quality)."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rated, score = with_score(ids, learn(docs, labels), ["doc_id"])
    return rated.select("doc_id", held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"), F.col(score).alias("score"), (F.col(score) >= THRESHOLD).cast("int").alias("predicted"))
