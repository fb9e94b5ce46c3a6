"""Queries that SQL can't express, against plain implementations in Python that share no function with the operators."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from changeloom.llm import language_id, order_minhash, quality_rules, sentencepiece
from changeloom.llm.queries import PIECES, QUERIES

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas().sort_values("doc_id").reset_index(drop=True)


# ------------------------------------------------------------------ 5


def plain_profile(text):
    """Shares of hashed three-byte runs: A-Z lowered, other ASCII that is no letter a blank, one blank on both sides."""
    raw = [c + 32 if 65 <= c <= 90 else 32 if c < 128 and not 97 <= c <= 122 else c for c in text.encode()]
    raw, found, n = [32, *raw, 32], Counter(), max(1, len(raw))
    for a, b, c in zip(raw, raw[1:], raw[2:], strict=False):
        x = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) & 0xFFFFFFFF
        x ^= x >> 15
        found[((x * 0x27D4EB2F) & 0xFFFFFFFF) >> (32 - language_id.GRAM_BITS)] += 1
    return {k: v / n for k, v in found.items()}


def plain_language(model, text):
    if not any(map(str.isalpha, text)):
        return "und", 0.0
    profile = plain_profile(text)
    odds = lambda m: m.slope * (sum(float(m.weights[k]) * v for k, v in profile.items()) + m.bias)
    logistic = lambda z: 1 / (1 + math.exp(-max(-30, min(30, z))))
    family, sure = 0, 1.0
    if model.family_machines:
        all_odds = [odds(m) for m in model.family_machines]
        family = max(range(len(all_odds)), key=lambda i: (all_odds[i], -i))
        sure = logistic((all_odds[family] - max(x for i, x in enumerate(all_odds) if i != family)) / 2)
    name = model.families[family]
    langs = model.languages[name]
    votes, total = [0] * len(langs), [0.0] * len(langs)
    for (i, j), m in model.pair_machines[name].items():
        x = odds(m)
        votes[i if x > 0 else j] += 1
        total[i] += x
        total[j] -= x
    best = max(range(len(langs)), key=lambda i: (votes[i] + math.tanh(total[i]) * 0.25, -i))
    within = logistic(total[best] / max(1, len(langs) - 1)) if len(langs) > 1 else 1.0
    return langs[best], min(1.0, max(0.0, sure * within))


def test_languages_against_plain_machines(spark, docs):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.learn(table)
    assert len(model.families) > 1 and max(map(len, model.languages.values())) > 1
    got = QUERIES["op5_language_id"](spark, SF).toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        lang, score = plain_language(model, text)
        assert got.lang_pred[i] == lang and math.isclose(got.score[i], score, rel_tol=1e-4, abs_tol=1e-6)
        assert got.held_out[i] == (zlib.crc32(str(i).encode()) % 4 == 2)


def test_every_language_is_learned(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(26 * k + i, " ".join(letters[i] * 3 + letters[(i + k) % 26] for _ in range(20)), f"l{i}") for i in range(26) for k in range(6)]
    rows += [(10_000 + k, "aaa bbb", "l0") for k in range(300)]
    model = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_train=60)
    assert sorted(x for v in model.languages.values() for x in v) == sorted(f"l{i}" for i in range(26))


# ------------------------------------------------------------------ 6


def plain_mix(x):
    for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x ^= x >> 33
        x = (x * m) & MASK
    return x ^ (x >> 33)


def plain_fingerprint(text):
    """For each sketch the tuple of the least occurrence-numbered runs, in text order, hashed."""
    if not text:
        return "0" * 4 * order_minhash.SKETCHES
    step = [int(s) for s in order_minhash._STEP]
    k, points, seen, values = order_minhash.K, [ord(c) for c in text], Counter(), []
    for at in range(max(1, len(points) - k + 1)):
        run = sum(p * step[j] for j, p in enumerate(points[at : at + k]))
        if len(points) < k:
            run += len(points) * step[k + 1]
        value = plain_mix(run & MASK) >> 24
        if seen[value]:
            values.append((plain_mix((value + seen[value] * step[k]) & MASK) >> 24, at))
        else:
            values.append((value, at))
        seen[value] += 1
    values.sort()
    out = ""
    for j in range(order_minhash.SKETCHES):
        start = j * ((1 << 40) // order_minhash.SKETCHES)
        least = sorted(values, key=lambda v: (v[0] - start) % (1 << 40))[: order_minhash.LENGTH]
        acc = 0
        for place, (value, _) in enumerate(sorted(least, key=lambda v: v[1])):
            acc = plain_mix((acc + value * step[place] + place + 1) & MASK)
        out += f"{acc >> 48:04x}"
    return out


def alike(a, b):
    return sum(a[i : i + 4] == b[i : i + 4] for i in range(0, len(a), 4)) / (len(a) // 4)


def test_fingerprints_against_a_plain_version(spark, docs):
    got = QUERIES["op6_order_minhash"](spark, SF).toPandas().set_index("doc_id")
    texts = docs.sort_values("doc_id", ascending=False)
    own = dict(zip(texts.doc_id, texts.text, strict=True))
    some = [i for i in own if len(own[i]) < 6000]
    ids = list(texts.doc_id)
    after = dict(zip(ids, [*ids[1:], ids[0]], strict=True))
    assert len(some) > 100
    for i in some[:60]:
        text, other = own[i], own[after[i]]
        cut = len(text) // 3
        changed = text[: len(text) - cut] + other[:cut]
        assert got.fingerprint[i] == plain_fingerprint(text) and got.edited_fingerprint[i] == plain_fingerprint(changed)
        assert got.edited_sha256[i] == hashlib.sha256(changed.encode()).hexdigest() and got.n_chars[i] == len(text)
        assert got.near_edited[i] == alike(got.fingerprint[i], got.edited_fingerprint[i])
        assert got.near_next[i] == alike(got.fingerprint[i], got.fingerprint[after[i]])


# ------------------------------------------------------------------ 9


def plain_pieces(pieces, unknown, by_byte, text):
    """Ids and score of the best segmentation, a character at a time; of equal ones that with the longer last piece."""
    s = ("▁" + text.replace(" ", "▁")) if text else ""
    best = [(0.0, None)] + [None] * len(s)
    for end in range(1, len(s) + 1):
        for start in range(max(0, end - 40), end):
            piece = pieces.get(s[start:end])
            if best[start] is None or (piece is None and end - start > 1):
                continue
            score = best[start][0] + (piece[1] if piece else unknown)
            if best[end] is None or score > best[end][0]:
                best[end] = (score, (start, piece and piece[0]))
    out, at = [], len(s)
    while at:
        start, piece = best[at][1]
        out = ([piece] if piece is not None else [by_byte[b] for b in s[start:at].encode()]) + out
        at = start
    return out, best[len(s)][0]


def test_pieces_against_plain_segmentation(spark, docs):
    encoder = sentencepiece._encoder(PIECES)
    known = {p.text: (i, p.score) for i, p in enumerate(sentencepiece.read_model(PIECES)[0]) if p.kind == sentencepiece.NORMAL}
    by_byte = [int(x) for x in encoder.by_byte]
    got = QUERIES["op9_sentencepiece"](spark, SF).toPandas().set_index("doc_id")
    assert len(got) == len(docs) and got.round_trip.all()
    some = [(i, t) for i, t in zip(docs.doc_id, docs.text, strict=True) if len(t) < 1500]
    assert len(some) > 50
    for i, text in some[:50]:
        ids, score = plain_pieces(known, encoder.unknown_score, by_byte, text)
        assert got.n_pieces[i] == len(ids) and got.ids_digest[i] == hashlib.blake2b(np.array(ids, "<i4").tobytes(), digest_size=16).hexdigest()
        assert math.isclose(got.score[i], score, rel_tol=1e-9, abs_tol=2e-3)


# ------------------------------------------------------------------ 10


def plain_statistics(text):
    raw = text.encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    lines = raw.split(b"\n") if raw else []
    split = len(lines)
    if lines and not lines[-1]:
        lines = lines[:-1]
    folded = [w.lower() for w in words]
    share = lambda x, of: x / of if of else 0.0
    count = lambda pattern: len(re.findall(pattern, raw))
    upper, lower = count(rb"[A-Z]"), count(rb"[a-z]")
    classes = {"upper": rb"[A-Z]", "lower": rb"[a-z]", "digit": rb"[0-9]", "high": rb"[\x80-\xff]", "blank": rb"[\x09-\x0d ]", "stop": rb"[!.?]", "comma": rb"[,;]", "exclaim": rb"!", "pipe": rb"\|", "symbol": rb"[#-&*+<->@^`~]", "bracket": rb"[()\[\]{}]", "quote": rb"[\"']"}
    out = {
        "n_bytes": len(raw), "n_words": len(words), "n_lines": split, "word_bytes": share(sum(map(len, words)), len(words)), "line_words": share(len(words), split), "longest_word": max(map(len, words), default=0),
        "short_words": share(sum(len(w) <= 3 for w in words), len(words)), "distinct_words": share(len(set(folded)), len(words)), "top_word": share(max(Counter(folded).values(), default=0), len(words)),
        "distinct_lines": share(len({x.lower() for x in lines}), split), "upper_words": share(sum(len(w) > 1 and 2 * len(re.findall(rb"[A-Z]", w)) > len(w) for w in words), len(words)), "upper_of_letters": share(upper, upper + lower),
        "starts_upper": share(sum(65 <= w[0] <= 90 for w in words), len(words)), "word_ends_other": share(sum(not re.match(rb"[A-Za-z0-9\x80-\xff!.?,;]", w[-1:]) for w in words), len(words)),
    }
    return out | {f"{c}_share": share(count(p), len(raw)) for c, p in classes.items()}


def test_quality_against_plain_statistics_and_rules(spark, docs):
    table, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_rules.learn(table, labels)
    assert model.rules
    got = QUERIES["op10_quality_classifier"](spark, SF).toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        own = plain_statistics(text)
        z = model.intercept + sum(w for rule, w in zip(model.rules, model.weights, strict=True) if all((own[model.names[c.feature]] > c.cut) == c.above for c in rule))
        score = 1 / (1 + math.exp(-z))
        assert math.isclose(got.score[i], score, rel_tol=1e-9) and got.predicted[i] == int(score >= 0.7)
        assert got.held_out[i] == (zlib.crc32(str(i).encode()) % 4 == 2)


@pytest.mark.parametrize("text", ["", "\n", "a\n", "a\n\nB!\n", " x\ty ", "Ünï çödé\nÜnï çödé", "A|b|C\n" * 4])
def test_statistics_of_odd_texts(text):
    raw = text.encode()
    got = dict(zip(quality_rules.STATISTICS, (v[0] for v in quality_rules.statistics(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))), strict=True))
    assert got == pytest.approx(plain_statistics(text))


def test_what_a_task_remembers_changes_nothing(monkeypatch, docs):
    pieces = sentencepiece.read_model(PIECES)[0]
    texts = list(docs.text[:40])

    def encoded(encoder, some):
        raw = [t.encode() for t in some]
        ids, off, score = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))
        return [(ids[a:b].tolist(), round(s, 6)) for a, b, s in zip(off, off[1:], score, strict=False)]

    want = [x for t in texts for x in encoded(sentencepiece.Encoder(pieces), [t])]
    for bound in (10**9, 300, 0):
        monkeypatch.setattr(sentencepiece, "SEEN", bound)
        encoder = sentencepiece.Encoder(pieces)
        assert [x for at in range(0, 40, 4) for x in encoded(encoder, texts[at : at + 4])] == want
        assert encoded(encoder, ["", " ", texts[0]])[2] == want[0]
