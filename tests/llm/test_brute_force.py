"""Operators against plain implementations, exact round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from changeloom.llm import common, embedding_dedup, license_scan, lm_scoring, minhash_dedup, order_minhash, packing, quality_rules, sentencepiece, warc
from changeloom.llm.queries import ORACLES, PIECES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas().sort_values("doc_id").reset_index(drop=True)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def brute_components(texts):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    groups, holders = Union(sets), defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                groups.join(i, j)
        for s in sets[i]:
            holders[s].append(i)
    return sets, groups


def test_word_hashes_see_words_only():
    texts = ["A b\tC", "a  b c", "", "a bc", "ab c"]
    raw = [t.encode() for t in texts]
    buf, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
    spans = common.word_spans(buf, off)
    h = common.word_hashes(buf, spans)
    own = [h[a:b].tolist() for a, b in zip(spans.off, spans.off[1:], strict=False)]
    assert own[0] == own[1] and own[2] == [] and len({x for o in own for x in o}) == 5
    for k in (1, 2, 5):
        values, at = common.shingles(h, spans.off, k)
        assert np.diff(at).tolist() == [max(len(o) - k + 1, min(1, len(o))) for o in own]


def test_minhash_components(spark, docs):
    got = QUERIES["op4_minhash_near_dedup"](spark, SF).toPandas().set_index("doc_id")
    sets, groups = brute_components(dict(zip(docs.doc_id, docs.text, strict=True)))
    assert len(got) == len(docs)
    assert all(got.n_shingles[i] == len(s) and got.component_id[i] == groups.find(i) and got.kept[i] == (groups.find(i) == i) for i, s in sets.items())


def test_minhash_groups_around_the_threshold(spark):
    """Many near copies of one text whose likeness to each other lies on both sides of the threshold, and a wide bucket."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    texts = {}
    for i in range(400):
        own = list(base)
        for _ in range(i % 9):
            own[rng.randrange(150)] = f"v{rng.randrange(9999)}"
        texts[i] = " ".join(own)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = minhash_dedup.near_duplicates(rows).toPandas().set_index("doc_id")
    _, groups = brute_components(texts)
    assert [got.component_id[i] for i in texts] == [groups.find(i) for i in texts]


def test_registers_merge_by_maximum_and_estimate():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    one = minhash_dedup.registers(values, np.array([0, 3000]))
    two = minhash_dedup.registers(values, np.array([0, 1000, 3000]))
    assert (two.max(0) == one[0]).all()
    pair = minhash_dedup.registers(np.concatenate([values[:2000], values[400:2400]]), np.array([0, 2000, 4000])).astype(int)
    est = minhash_dedup.likely_similarity(np.array([(pair[0] > pair[1]).sum()]), np.array([(pair[0] < pair[1]).sum()]), np.array([2000.0]), np.array([2000.0]))
    assert abs(est[0] - 1600 / 2400) < 0.15


def test_connected_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(1, 50)]
    got = common.connected_components(common.Workspace(spark, "test"), spark.createDataFrame(edges, "a long, b long")).collect()
    groups = Union({x for e in edges for x in e})
    for a, b in edges:
        groups.join(a, b)
    assert {r.node: r.root for r in got} == {n: groups.find(n) for n in groups.up if any(n in e and e[0] != e[1] for e in edges)}


def test_hot_keys_meet_their_aggregates(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(common, "HUB_ROWS", 20)
    monkeypatch.setattr(common, "MAX_HUBS", 4)
    rows = [(0, i) for i in range(300)] + [(1 + i % 40, i) for i in range(200)] + [(99, 7)]
    frame = spark.createDataFrame(rows, "k long, v long")
    got = common.with_group(frame, "k", "v", len(rows), F.min("v").alias("lo"), F.count("*").alias("n")).collect()
    by = defaultdict(list)
    for k, v in rows:
        by[k].append(v)
    assert sorted((r.k, r.v, r.lo, r.n) for r in got) == sorted((k, v, min(by[k]), len(by[k])) for k, v in rows)


def test_embedding_links(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 24))
    near = np.concatenate([base[:40] + rng.standard_normal((40, 24)) * s for s in (0.01, 0.2, 0.35, 0.45)])
    dense = base[299] + rng.standard_normal((500, 24)) * 0.05
    x = np.concatenate([base, near, dense, base[:10]])
    rows = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = embedding_dedup.near_vectors(rows, window=64).toPandas().sort_values("vec_id")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.9
    np.fill_diagonal(link, False)
    groups = Union(range(len(x)))
    for a, b in zip(*np.nonzero(link), strict=True):
        groups.join(int(a), int(b))
    true = link.sum(1)
    assert (got.n_links.to_numpy() <= true).all()
    assert got.n_links.sum() >= 0.99 * true.sum()
    assert (got.component_id.to_numpy() == np.array([groups.find(i) for i in range(len(x))])).mean() > 0.99


def test_packing_is_best_fit_and_without_conflicts():
    rng = random.Random(5)
    sizes = sorted((rng.randrange(1, 60) for _ in range(400)), reverse=True)
    sources = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in sizes]
    clusters = [rng.choice([-1, -1, -1, 0, 1]) for _ in sizes]
    got = packing.best_fit(sizes, sources, clusters, 100, 2)
    bins: list[list[int]] = []
    for k, (size, source, cluster) in enumerate(zip(sizes, sources, clusters, strict=True)):
        fits = [(100 - sum(sizes[i] for i in b), j) for j, b in enumerate(bins) if sum(sizes[i] for i in b) + size <= 100 and sum(sources[i] == source for i in b) < 2 and not (cluster >= 0 and any(clusters[i] == cluster for i in b))]
        at = min(fits)[1] if fits else len(bins)
        if at == len(bins):
            bins.append([])
        assert got[k] == at
        bins[at].append(k)


def test_packing_whole_table(spark, docs):
    got = QUERIES["op2_best_fit_packing"](spark, SF).toPandas()
    tokens = {i: len(words(t)) + 1 for i, t in zip(docs.doc_id, docs.text, strict=True)}
    assert got.groupby("doc_id").tokens.sum().to_dict() == tokens
    held = got.groupby(["shard", "bin"])
    assert held.tokens.sum().max() <= packing.CAPACITY
    assert got.groupby(["shard", "bin", "source"]).size().max() <= packing.MAX_PER_SOURCE
    assert not got.assign(c=got.cluster.map(bytes)).duplicated(["shard", "bin", "c"]).any()


def test_language_accuracy(spark, docs):
    got = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(lang, on="doc_id")
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]).all()
    assert (both.lang_pred == both.lang)[both.held_out].mean() > 0.97


def test_quality_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op10_quality_classifier"](spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    both = got.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.93


def test_compiled_rules_equal_the_model(spark):
    rng = np.random.default_rng(2)
    x = rng.random((600, 4))
    y = ((x[:, 0] > 0.5) & (x[:, 2] <= 0.7)).astype(int)
    model = quality_rules.fit(x, y, ["a", "b", "c", "d"])
    assert model.rules and ((model.score(x) >= 0.5) == y).mean() > 0.97
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    got = [r.s for r in rows.select(model.column({n: n for n in "abcd"}).alias("s")).collect()]
    assert np.allclose(got, model.score(x))


def test_statistics_of_a_text():
    text = b"Two words! THREE\nTwo words! THREE\n| |"
    got = dict(zip(quality_rules.STATISTICS, (v[0] for v in quality_rules.statistics(np.frombuffer(text, np.uint8), np.array([0, len(text)]))), strict=True))
    assert got["n_words"] == 8 and got["n_lines"] == 3 and got["distinct_lines"] == 2 / 3 and got["distinct_words"] == 4 / 8 and got["top_word"] == 2 / 8 and got["pipe_share"] == 2 / len(text)
    assert got["upper_words"] == 2 / 8


def brute_fingerprint(text):
    k, size, n = order_minhash.K, order_minhash.LENGTH, order_minhash.SKETCHES
    value, place = order_minhash._selected(text)
    out = []
    for j in range(n):
        start = j * ((1 << 40) // n)
        near = sorted(range(len(value)), key=lambda i: ((int(value[i]) - start) % (1 << 40)))[:size]
        out.append([int(value[i]) for i in sorted(near, key=lambda i: place[i])])
    return out


def test_order_minhash_selects_the_least_in_text_order():
    text = "the cat sat on the mat and the cat sat on the hat, " * 3
    value, place = order_minhash._selected(text)
    assert len(value) == len(set(value.tolist())) == len(text) - order_minhash.K + 1
    prints = order_minhash.fingerprint(text)
    tuples = brute_fingerprint(text)
    assert len({(tuple(t), int(p)) for t, p in zip(tuples, prints, strict=True)}) == len({tuple(t) for t in tuples})


def test_order_minhash_follows_edits():
    rng = random.Random(6)
    a = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    few = a[:1000] + "x" + a[1001:]
    swapped = a[1500:] + a[:1500]
    other = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    own = order_minhash.fingerprint(a)
    close, moved, far = (order_minhash.likeness(own, order_minhash.fingerprint(t)) for t in (few, swapped, other))
    assert close > 0.9 and far < 0.1 and moved < close - 0.2  # the same runs in another order are less alike


def test_fingerprint_table(spark, docs):
    got = QUERIES["op6_order_minhash"](spark, SF).toPandas().set_index("doc_id")
    texts = docs.sort_values("doc_id", ascending=False)
    after = list(texts.text[1:]) + [texts.text.iloc[0]]
    for i, text, nxt in zip(texts.doc_id, texts.text, after, strict=True):
        cut = len(text) // 3
        changed = text[: len(text) - cut] + nxt[:cut]
        assert got.n_chars[i] == len(text) and got.edited_sha256[i] == hashlib.sha256(changed.encode()).hexdigest()
        assert got.near_next[i] == order_minhash.likeness(order_minhash.fingerprint(text), order_minhash.fingerprint(nxt))
        assert got.fingerprint[i] == order_minhash._hex(order_minhash.fingerprint(text))


class PlainModel:
    """The model of order three by dictionaries of words."""

    def __init__(self, texts):
        self.uni, self.bi, self.tri, self.starts = Counter(), Counter(), Counter(), 0
        for w in texts:
            self.uni.update(w)
            self.bi.update(zip(["<s>", *w], w, strict=False))
            self.tri.update(zip(["<s>", *w], w, w[1:], strict=False))
            self.starts += 1
        self.n, self.v = sum(self.uni.values()), len(self.uni)

    def p1(self, w):
        return (self.uni[w] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def p2(self, h, w):
        return (self.bi[h, w] + lm_scoring.PRIOR2 * self.p1(w)) / ((self.starts if h == "<s>" else self.uni[h]) + lm_scoring.PRIOR2)

    def p3(self, g, h, w):
        return (self.tri[g, h, w] + lm_scoring.PRIOR3 * self.p2(h, w)) / (self.bi[g, h] + lm_scoring.PRIOR3)

    def base(self, text):
        return sum(math.log10(self.p1(w)) for w in text)

    def score(self, text):
        return math.log10(self.p2("<s>", text[0])) + sum(math.log10(self.p3(*x)) for x in zip(["<s>", *text], text, text[1:], strict=False))


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 20_000, "fan": 4}])
def test_lm_scores(spark, docs, sizes):
    got = lm_scoring.lm_scores(spark.read.parquet(f"{SF}/documents.parquet"), **sizes).toPandas().set_index("doc_id")
    tokens = {i: [*words(t), None] for i, t in zip(docs.doc_id, docs.text, strict=True)}
    model = PlainModel([w for i, w in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1])
    assert len(got) == len(docs)
    for i, w in tokens.items():
        row = got.loc[i]
        assert row.n_tokens == len(w) and row.train_tokens == model.n and row.n_known == sum(model.uni[x] > 0 for x in w)
        assert row.held_out == (zlib.crc32(str(i).encode()) % 5 == 1)
        assert math.isclose(row.base_score, model.base(w), rel_tol=1e-9) and math.isclose(row.score, model.score(w), rel_tol=1e-9)


def lm_block(texts, training):
    raw = [t.encode() for t in texts]
    buf, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
    tokens, at = lm_scoring.block_tokens(buf, off)
    kinds, numbers = np.unique(tokens, return_inverse=True)
    return lm_scoring.Block(kinds, numbers, np.diff(at), np.array(training))


def test_automaton_sums_to_one_and_walks_by_failure_arcs():
    block = lm_block(["a b a c a b", "b b a", "", "zz a b", "a b a c"], [True, True, True, False, False])
    counts, kinds = block.counts(60), 4
    model = lm_scoring.Automaton(block, counts, 60, int(block.flag.sum()), kinds, 3)
    words_ = np.flatnonzero(counts[0][1] > 0)
    unknown = np.flatnonzero(counts[0][1] == 0)[:1]
    end = int(np.searchsorted(block.words, lm_scoring.END))
    left = [0, *(1 + w for w in range(model.width) if model.count[w] and w != end), *(model.first_pair + np.flatnonzero(model.pairs % model.width != end))]
    for state in left:  # every state that is ever left is a distribution over the kinds seen and one unknown
        _, weight = model.step(np.full(len(words_) + 1, state), np.append(words_, unknown))
        assert math.isclose((10**weight).sum(), 1, rel_tol=1e-12)
    want = []
    for a, b in zip(block.off, block.off[1:], strict=False):  # token by token, from the start's state
        state, total = model.word_state(np.array([model.width - 1])), 0.0
        for token in block.tokens[a:b]:
            state, weight = model.step(state, np.array([token]))
            total += weight[0]
        want.append(total)
    assert np.allclose(model.traverse(block), want, rtol=1e-12)


def test_long_texts_are_walked_in_stretches(monkeypatch):
    rng = random.Random(12)
    texts = [" ".join(rng.choice("abcdef") for _ in range(n)) for n in (0, 1, 5, 6, 7, 700)]
    block = lm_block(texts, [True, False, True, True, False, True])
    model = lm_scoring.Automaton(block, block.counts(60), 60, int(block.flag.sum()), 7, 4)
    whole = lm_scoring.STRETCH
    monkeypatch.setattr(lm_scoring, "STRETCH", 100_000)
    want = model.traverse(block)
    for size in (2, 3, whole):
        monkeypatch.setattr(lm_scoring, "STRETCH", size)
        assert np.allclose(model.traverse(block), want, rtol=1e-12)


@given(st.lists(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 2**40)), max_size=50, unique_by=lambda x: x[0]))
def test_packed_arrays_round_trip(pairs):
    pairs.sort()
    keys, counts = np.array([k for k, _ in pairs], np.uint64), np.array([c for _, c in pairs], np.int64)
    a, b = lm_scoring.unpack_sorted(lm_scoring.pack_sorted(keys, counts))
    assert a.tolist() == keys.tolist() and b.tolist() == counts.tolist()


def test_warc_round_trip(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op8_warc"](spark, sf).toPandas().set_index("page_id")
    pages = spark.read.parquet(f"{sf}/pages.parquet").toPandas()
    first = {}
    for i, h in sorted(zip(pages.page_id, pages.html, strict=True)):
        first.setdefault(h, i)
    assert len(got) == len(pages)
    for i, h in zip(pages.page_id, pages.html, strict=True):
        raw, row = h.encode(), got.loc[i]
        again = len(raw) >= 100 and first[h] != i
        assert row.payload_bytes == len(raw) and row.payload_digest == hashlib.sha256(raw).hexdigest()
        assert row.record_type == ("revisit" if again else "response") and (row.refers_to == first[h] if again else row.refers_to != row.refers_to)


def test_archive_has_a_dictionary_in_its_first_frame():
    rng = random.Random(8)
    records = [warc.page_record(i, "http://a/", (" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "epsilon"]) + str(rng.randrange(50)) for _ in range(200))).encode(), "0" * 64, None) for i in range(300)]
    data = warc.archive_bytes(records)
    assert int.from_bytes(data[:4], "little") == 0x184D2A5D
    got = list(warc.read_archive(io.BytesIO(data)))
    assert got[0][0]["WARC-Type"] == "warcinfo" and [f["X-Page-Id"] for f, _ in got[1:]] == [str(i) for i in range(300)]
    assert all(warc.parse_record(r) == g for r, g in zip(records, got[1:], strict=True))
    assert len(data) < sum(map(len, records)) / 2
    few = warc.archive_bytes(records[:2])
    assert len(list(warc.read_archive(io.BytesIO(few)))) == 3


def test_license_alignment():
    a, b = "x the q the y z".split(), "the q w the z".split()
    assert license_scan.align(a, b) == [(1, 0), (2, 1), (3, 3), (5, 4)]
    pairs = [(i, j) for i, j in enumerate([3, 1, 2, 9, 4, 5])]
    assert [j for _, j in license_scan.increasing(pairs)] == [1, 2, 4, 5]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.sampled_from("abcdefg"), max_size=14), st.lists(st.sampled_from("abcdefg"), max_size=14))
def test_alignment_is_a_common_subsequence(a, b):
    got = license_scan.align(a, b)
    assert all(a[i] == b[j] for i, j in got) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))
    if a == b:
        assert len(got) == len(a)


def plain_words(text):
    """Runs of letters, digits and non-ASCII bytes, A-Z folded."""
    return re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower())


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def held(phrase, words_):
    return any(words_[i : i + len(phrase)] == phrase for i in range(len(words_) - len(phrase) + 1))


def plain_scan(text):
    """The best template of a text that holds one license at most, by plain longest common subsequences over all its words."""
    words_, best = plain_words(text), None
    for k, t in enumerate(license_scan.TEMPLATES):
        own = plain_words(t.text)
        if all(held(plain_words(p), words_) for p in t.telling):
            n = longest_common(words_, own)
            if n >= license_scan.MIN_COVERAGE * len(own) and (best is None or n > best[0]):
                best = (n, k)
    return best and license_scan.TEMPLATES[best[1]].license


def test_scan_against_a_plain_scan(spark):
    """Whole licenses, licenses with edited, lost and added words, and sentences near a license, amid foreign words."""
    rng = random.Random(9)
    filler = [f"filler{i}" for i in range(40)] + "the of and to in a is that under license version general public software".split()
    noise = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    rows = []
    for t in license_scan.TEMPLATES:
        for edits in (0, 1, 2):
            w = t.text.split()
            for _ in range(edits * max(len(w) // 30, edits > 1)):
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = rng.choice([["edited"], [], [w[at], "added"]])
            rows.append(" ".join([noise(30), *w, noise(20)]))
    rows += [noise(200) for _ in range(20)]
    got = defaultdict(list)
    for r in license_scan.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect():
        got[r.doc_id].append(r)
    for i, text in enumerate(rows):
        want = plain_scan(text)
        assert [r.license for r in got[i]] == ([want] if want else []), (i, text)
        for r in got[i]:
            assert 30 <= r.first_word <= r.last_word < len(plain_words(text)) - 20 or r.score < 1


@pytest.mark.parametrize(
    ("text", "license"),
    [
        ("Licensed under CC BY 4.0", "CC-BY-4.0"), ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0"), ("Licensed under CC BY-NC 4.0", "CC-BY-NC-4.0"), ("Released under the BSD License", None), ("Released under the GPL License", None),
        ("Released under the ISC License", "ISC"), ("Licensed under the Apache License, Version 1.0", None), ("Licensed under the Apache License, Version 2.0", "Apache-2.0"), ("This work is licensed under the GNU General Public License, version 2", "GPL-2.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 3", "LGPL-3.0"), ("This work is licensed under the GNU Affero General Public License, version 3", "AGPL-3.0"), ("This work is licensed under the GNU General Public License, version 3", "GPL-3.0"),
    ],
)
def test_related_licenses_are_told_apart(text, license):
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.MIN_COVERAGE)
    raw = np.frombuffer(text.encode(), np.uint8)
    found = scanner.findings(*license_scan.hashed_words(raw, np.array([0, len(raw)]))).get(0, [])
    assert [license_scan.TEMPLATES[x.template].license for x in found] == ([license] if license else [])


def test_scan_time_grows_with_the_text():
    import time

    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.MIN_COVERAGE)
    mit = next(t.text for t in license_scan.TEMPLATES if t[:2] == ("MIT", "text")).split()
    rng = random.Random(1)
    shuffled = [w for _ in range(1500) for w in rng.sample(mit, len(mit))]
    for text, n in (("Released under the MIT License. " * 60_000, 60_000), (" ".join(mit * 1500) + " ", 1500), (" ".join(shuffled), 0)):
        raw = np.frombuffer(text.encode(), np.uint8)
        began = time.perf_counter()
        found = scanner.findings(*license_scan.hashed_words(raw, np.array([0, len(raw)]))).get(0, [])
        assert len(found) == n and time.perf_counter() - began < 30


@settings(deadline=None, max_examples=40)
@given(st.lists(st.sampled_from(["mit", "license", "released", "under", "the", "x"]), max_size=60), st.integers(1, 60))
def test_bounds_of_windows(words_, window):
    scanner = license_scan.Scanner([license_scan.Template("MIT", "line", "Released under the MIT License")], 0.8)
    scanner.window[0] = window
    raw = " ".join(words_).encode()
    hashes, _ = license_scan.hashed_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    bounds = scanner.bounds(scanner.codes(hashes), 0).tolist()
    want = [sum((Counter(words_[i : i + window]) & Counter(["mit", "license", "released", "under", "the"])).values()) for i in range(len(words_))]
    assert bounds == want


def plain_viterbi(enc, pieces, text):
    table = {p.text.replace("▁", " "): (i, p.score) for i, p in enumerate(pieces) if p.kind == sentencepiece.NORMAL}
    s = " " + text.replace("▁", " ") if text else ""
    best = [(0.0, None)] + [(-math.inf, None)] * len(s)
    for i in range(len(s)):
        for j in range(i + 1, min(len(s), i + 24) + 1):
            found = table.get(s[i:j], (None, enc.unknown_score) if j == i + 1 else None)
            if found and best[i][0] + found[1] > best[j][0]:
                best[j] = (best[i][0] + found[1], (i, found[0]))
    out, at = [], len(s)
    while at:
        i, piece = best[at][1]
        out = ([piece] if piece is not None else [int(enc.by_byte[b]) for b in s[i:at].encode()]) + out
        at = i
    return out


@pytest.fixture(scope="module")
def pieces():
    # The vocabulary's scores are ranks; huge ones would swamp the rest in a library that adds in single precision.
    return [sentencepiece.Piece(p.text, max(p.score, -100000.0), p.kind) for p in sentencepiece.read_model(PIECES)[0]]


def test_viterbi_against_brute_force_and_the_library(pieces, docs):
    import sentencepiece as library
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(PIECES, "rb") as f:
        model.ParseFromString(f.read())
    for p in model.pieces:
        p.score = max(p.score, -100000.0)
    model.trainer_spec.model_type = 1
    unigram = library.SentencePieceProcessor(model_proto=model.SerializeToString())
    enc = sentencepiece.Encoder(pieces)
    texts = ["", "a", " ", "two  spaces\n\ttab", "日本語 😀", "▁marker", *docs.text[:60]]
    raw = [t.encode() for t in texts]
    ids, off, score = enc.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))
    for k, t in enumerate(texts):
        own = ids[off[k] : off[k + 1]].tolist()
        assert own == unigram.encode(t)
        if len(t) < 400:
            assert own == plain_viterbi(enc, pieces, t)
    back, at = enc.decode(ids, off)
    assert [back[a:b].tobytes().decode() for a, b in zip(at, at[1:], strict=False)] == [t.replace("▁", " ") for t in texts]


def test_trie_holds_its_words():
    rng = random.Random(3)
    own = {bytes(rng.randrange(256) for _ in range(rng.randrange(1, 6))): i for i in range(500) for _ in [0]}
    trie = sentencepiece.DoubleArray(list(own.items()))
    for word in [*own, b"\x00", b"\xff\xff\xff", b"nope"]:
        state = np.zeros(1, np.int32)
        ok = True
        for byte in word:
            state, good = trie.step(state, np.array([byte], np.int32))
            if not good[0]:
                ok = False
                break
        assert (int(trie.value[state[0]]) if ok else -1) == own.get(word, -1)


def test_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 11)]
    assert set(ORACLES) <= set(QUERIES)
