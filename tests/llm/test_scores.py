"""Context trees, likelihood ratios, sharding and decontamination against plain versions."""

import math
import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from custoria.llm import ctw, decontaminate, quality, sharding


# ---- context trees

class PlainTree:
    """The weighted tree stated by recursion."""

    def __init__(self, bodies):
        self.counts = defaultdict(lambda: [0, 0])
        self.longer = defaultdict(set)
        for body in bodies:
            data = bytes(ctw.DEPTH) + body + b"\n"
            for at in range(ctw.DEPTH, len(data)):
                for j in range(8):
                    path = (j, data[at] >> (8 - j))
                    for d in range(ctw.DEPTH + 1):
                        self.counts[data[at - d : at], path][data[at] >> (7 - j) & 1] += 1
                        if d:
                            self.longer[data[at - d + 1 : at], path].add(data[at - d : at])

    @lru_cache(maxsize=None)
    def logs(self, context, path):
        a, b = self.counts[context, path]
        own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)
        if len(context) == ctw.DEPTH:
            return own, 0.0
        below = sum(self.mixed(c, path) for c in self.longer[context, path])
        return own, below

    def mixed(self, context, path):
        own, below = self.logs(context, path)
        return own if len(context) == ctw.DEPTH else float(np.logaddexp(own, below)) - math.log(2)

    def score(self, body):
        data, total = bytes(ctw.DEPTH) + body + b"\n", 0.0
        for at in range(ctw.DEPTH, len(data)):
            for j in range(8):
                path, one = (j, data[at] >> (8 - j)), None
                for d in range(ctw.DEPTH, -1, -1):
                    context = data[at - d : at]
                    if (context, path) not in self.counts:
                        continue
                    a, b = self.counts[context, path]
                    own = (b + 0.5) / (a + b + 1)
                    if one is None:
                        one = own
                    else:
                        weight = math.exp(self.logs(context, path)[0] - math.log(2) - self.mixed(context, path))
                        one = weight * own + (1 - weight) * one
                one = 0.5 if one is None else one
                total += math.log10(one if data[at] >> (7 - j) & 1 else 1 - one)
        return total


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def body(text):
    return b" ".join((text or "").encode().lower().split())


def test_scores_against_the_recursion(docs):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "thin", "other", "Ö", "zero", "a", "A,"]) for _ in range(rng.randint(0, 25)))) for i in range(60)]
    rows += [(1000, None), (1001, "   "), (None, "the other"), (5, "the other"), (5, "the other")]
    got = ctw.scores(docs(rows)).collect()
    assert len(got) == len(rows)
    tree = PlainTree([body(t) for i, t in rows if not held(i)])
    words = Counter(w for i, t in rows if not held(i) for w in [*body(t).split(), b"\n"])
    total, distinct = sum(words.values()), len(words)
    plain = {}
    for i, t in rows:
        tokens = [*body(t).split(), b"\n"]
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        plain[i, len(body(t)), round(base, 6)] = (held(i), len(tokens), sum(words[w] > 0 for w in tokens), tree.score(body(t)))
    for r in got:
        want = plain[r.doc_id, r.n_bytes - 1, round(r.base_score, 6)]
        assert (r.held_out, r.n_tokens, r.n_known) == want[:3] and r.train_tokens == total
        assert r.score == pytest.approx(want[3], rel=1e-5)
        assert r.bits_per_byte == pytest.approx(-r.score * math.log2(10) / r.n_bytes)


def test_scores_of_odd_rows(docs, edges):
    got = ctw.scores(docs(edges)).collect()
    assert len(got) == len(edges) and all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert ctw.scores(docs([(1, "x")]).where("false")).count() == 0


def test_next_byte_probabilities_add_up():
    rng = random.Random(4)
    bodies = [" ".join(rng.choice(["so", "it", "goes"]) for _ in range(9)).encode() for _ in range(30)]
    keys, counts = ctw._block_strings(bodies, [False] * 30)
    local = ctw._levels(keys, counts, range(ctw.TOP + 1, ctw.DEPTH + 1))
    shift = np.uint64(8 * (ctw.DEPTH - ctw.TOP) + 8)
    top_keys, n = ctw._summed(keys >> shift << np.uint64(8) | keys & np.uint64(255), counts)
    top = ctw._levels(top_keys, n, range(ctw.TOP + 1), local[ctw.TOP + 1].above(), ctw.TOP)
    for context in (b"goes ", b"it so", b"xxxxx", b"\0\0\0\0\0"):
        base = 0
        for byte in reversed(context):
            base = base << 8 | byte
        every = np.array([base << 8 | x for x in range(256)], np.uint64)
        assert (10.0 ** ctw._logs(every, {d: level.table for d, level in (local | top).items()})).sum() == pytest.approx(1.0)


def test_held_out_beats_word_counts(spark):
    scored = ctw.scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    out = scored.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


# ---- quality

def signed(x):
    return x - (1 << 64) if x >> 63 else x


def code(word):
    return xxhash.xxh64_intdigest(word.encode(), seed=42)


def pair(a, b):
    """The engine hashes longs one after the other, each seeded by the one before."""
    return signed(xxhash.xxh64_intdigest(b.to_bytes(8, "little"), seed=xxhash.xxh64_intdigest(a.to_bytes(8, "little"), seed=42)))


def plain_words(text):
    return [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]


def plain_grams(text, buckets):
    codes = [code(w) for w in plain_words(text)]
    return [signed(c) % buckets for c in codes] + [pair(a, b) % buckets for a, b in zip(codes, codes[1:])]


def plain_counts(text):
    words = plain_words(text)
    threes = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    seen = Counter(threes)
    covered = {k + d for k, t in enumerate(threes) if seen[t] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if plain_words(x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_against_plain_counts(spark, docs, edges):
    rng = random.Random(9)
    rows = list(edges)
    for i in range(100, 220):
        good = i % 3 > 0
        vocabulary = ["tree", "river", "stone", "cloud", "light", "é"] if good else ["BUY!!", "now###", "$$$", "click<>"]
        text = "".join(rng.choice(vocabulary + ["and", "the"]) + rng.choice([" ", " ", "  ", "\n", "\t"]) for _ in range(rng.choice([20, 60, 300])))
        rows.append((i, text if rng.random() < 0.9 else text[:90] * 4))
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(100, 200)] + [(None, 1), (150, None), (101, 0), (102, None)], "doc_id long, quality int")
    table = docs(rows)
    fitted = quality.fit(table, labels, buckets=512)
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality"), F.max("quality")).collect()
    label = {i: low for i, low, high in marks if low == high}
    counted = {i for i in label if signed(xxhash.xxh64_intdigest(i.to_bytes(8, "little"), seed=42)) % 2 == 0}
    raw, trusted = Counter(), Counter()
    for i, t in rows:
        grams = plain_grams(t, 512)
        raw.update(grams)
        if label.get(i) == 1 and i in counted:
            trusted.update(grams)
    n_raw, n_good = sum(raw.values()) + 512, sum(trusted.values()) + 512
    ratios = [math.log((trusted[b] + 1) / n_good) - math.log((raw[b] + 1) / n_raw) for b in range(512)]
    assert fitted.ratios == pytest.approx(ratios, abs=1e-8)
    judged = quality.judge(table, fitted).collect()
    assert len(judged) == len(rows)
    for r in judged:
        want = plain_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        grams = plain_grams(r.text, 512)
        assert r.base_failed == failed
        if grams:
            assert r.quality_score == pytest.approx(sum(ratios[g] for g in grams) / len(grams), abs=1e-7)
            assert r.kept == (not failed and r.quality_score >= fitted.threshold)
        else:
            assert r.quality_score is None and r.kept is False
    assert quality.keep(table, fitted).count() == sum(r.kept for r in judged)
    # held-out accuracy: documents that no fitting has seen
    unseen = [r for r in judged if (r.doc_id or 0) >= 200 and not r.base_failed]
    assert unseen and all(r.kept == (r.doc_id % 3 > 0) for r in unseen)


def test_quality_without_labels(docs):
    fitted = quality.fit(docs([(1, "a b " * 60)]), docs([(1, "x")]).selectExpr("doc_id", "1 AS quality").where("false"))
    assert fitted.threshold is None
    assert quality.judge(docs([(1, " ".join(map(str, range(60))))]), fitted).first().kept
    assert quality.judge(docs([(1, "x")]).where("false"), fitted).count() == 0


def test_threshold_spares_the_trusted():
    assert quality._threshold([(0, 0, 10), (50, 1, 10)]) == pytest.approx(0.0255)
    assert quality._threshold([(0, 1, 10), (50, 0, 10)]) is None
    assert quality._threshold([(0, 0, 10)]) is None


# ---- shards

def test_shards(docs, edges):
    rows = edges + [(i, f"text {i}") for i in range(100, 600)]
    got = sharding.assign(docs(rows, 6), 16).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    moved = sum(r.grown_shard == 16 for r in got)
    assert 0 < moved < len(rows) / 8
    sizes = {(r.doc_id, r.size, r.text_crc32) for r in got}
    assert sizes == {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows}
    assert len({r.shard for r in got if r.doc_id == 4}) == 1
    assert sharding.assign(docs([(1, "x")]).where("false"), 16).count() == 0


def test_weights_decide_the_shares(docs):
    rows = docs([(i, "") for i in range(4000)])
    counts = dict(sharding.assign(rows, {0: 1.0, 1: 3.0}).groupBy("shard").count().collect())
    assert counts[1] / 4000 == pytest.approx(0.75, abs=0.03)
    grown = sharding.assign(rows, {0: 1.0, 1: 3.0}, grown={0: 1.0, 1: 4.0}).where("shard <> grown_shard").select("grown_shard").distinct().collect()
    assert [r[0] for r in grown] == [1]
    with pytest.raises(ValueError):
        sharding.assign(rows, {0: 0.0})


# ---- decontamination

def plain_hits(text, items, window=13):
    import re

    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, found = split(text), set(), []
    for item, phrase in items:
        w = split(phrase)
        grams = {tuple(w[k : k + window]) for k in range(max(1, len(w) - window + 1))} if w else set()
        places = [(k, len(g)) for g in grams for k in range(len(words) - len(g) + 1) if tuple(words[k : k + len(g)]) == g]
        if places:
            found.append(str(item))
        for k, n in places:
            hit.update(range(k, k + n))
    return len(words), len(hit), sorted(found)


def bench_cases(edges):
    rng = random.Random(8)
    items = [(k, " ".join(rng.choice(["ab", "cd", "ef", "É", "9"]) for _ in range(rng.choice([0, 1, 3, 13, 30])))) for k in range(25)]
    items += [(99, None), (None, "a name without an id"), (98, "...")]
    rows = list(edges)
    for i in range(50, 130):
        text = []
        for _ in range(rng.randint(0, 6)):
            source = rng.choice(items)[1] or ""
            words = source.split()
            at = rng.randint(0, len(words))
            text.append(" ".join(words[at : at + rng.randint(1, 30)]) if rng.random() < 0.6 else " ".join(rng.choice(["zz", "AB,", "cd"]) for _ in range(9)))
        rows.append((i, "-".join(text)))
    return items, rows


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_benchmark_hits(spark, docs, edges, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 500)
    items, rows = bench_cases(edges)
    rows = [r for r in rows if len(r[1] or "") < 30_000]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find(docs(rows), bench).withColumn("hits", decontaminate.hit_words())
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.bench_words, r.hits, r.bench_items) == plain_hits(r.text, items)
        data = (r.text or "").encode()
        assert sum(len(decontaminate.words(data[s.begin_byte : s.end_byte])) for s in r.bench_spans) == r.hits
    cleaned = {(r.doc_id, r.text) for r in decontaminate.remove_spans(found).select("doc_id", "text").collect()}
    want = set()
    for r in got:
        data = (r.text or "").encode()
        for s in reversed(r.bench_spans):
            data = data[: s.begin_byte] + data[s.end_byte :]
        want.add((r.doc_id, None if r.text is None else data.decode()))
    assert cleaned == want


def test_no_benchmark_and_no_documents(spark, docs, edges):
    bench = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    none = decontaminate.find(docs(edges), bench.where("false"))
    assert none.where(F.size("bench_spans") > 0).count() == 0 and none.count() == len(edges)
    assert decontaminate.find(docs([(1, "x")]).where("false"), bench).count() == 0


def test_index_locates_all_occurrences():
    rng = random.Random(3)
    for _ in range(60):
        text = np.array([rng.randint(0, 3) for _ in range(rng.randint(1, 120))] + [0])
        index = decontaminate.FMIndex(text)
        for size in (1, 2, 4):
            phrases = np.array([[rng.randint(1, 4) for _ in range(size)] for _ in range(10)])
            for p, low, high in zip(phrases, *index.search(phrases)):
                want = [k for k in range(len(text) - size + 1) if (text[k : k + size] == p).all()]
                assert sorted(index.locate(np.arange(low, high)).tolist()) == want


@pytest.mark.parametrize("block", [8 << 20, 60])
def test_rows_of_one_item_are_one_item(spark, docs, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "PHRASES", 3)
    words = [f"w{i}" for i in range(40)]
    items = spark.createDataFrame([("x", " ".join(words[:13])), ("x", " ".join(words[:14])), ("y", "w20 w21"), (None, " ".join(words[25:38])), ("x", "w30")], "item_id string, text string")
    found = decontaminate.find(docs([(1, " ".join(words)), (2, "w20 w22")]), items).orderBy("doc_id").collect()
    assert [r["bench_items"] for r in found] == [["x", "y"], []]
    assert [[(s["begin_word"], s["end_word"]) for s in r["bench_spans"]] for r in found] == [[(0, 14), (20, 22), (25, 38)], []]
