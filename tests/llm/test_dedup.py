"""Line dedup, byte dedup and near-dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from custoria.llm import linededup, simhash, suffixdedup
from custoria.llm.queries import ORACLES
from tests.compare import connection, differences


# ---- lines

def brute_lines(rows, lines=3, words=50):
    """Texts without the lines that a repeated window covers; rows of distinct (id, text), earlier ones first."""
    split, seen, out = {}, {}, {}
    for key in rows:
        split[key] = re.split(r"\n(?=[ \t\r\f\x0B]*[^ \t\r\n\f\x0B])", key[1])
    for key, parts in split.items():
        spans = set()
        count = [len(p.split()) for p in parts]
        for s in range(len(parts)):
            for step in (1, -1):
                run, total = [], 0
                at = s
                while 0 <= at < len(parts):
                    run.append(at)
                    total += count[at]
                    if len(run) == lines or total >= words:
                        spans.add((min(run), max(run)))
                        break
                    at += step
        gone = set()
        for b, e in sorted(spans):
            content = tuple(p.strip(" \t\r\n\f\x0b") for p in parts[b : e + 1])
            first = seen.setdefault(content, (key, b))
            if first != (key, b):
                gone.update(range(b, e + 1))
        out[key] = (parts, gone)
    return {k: "\n".join(p for i, p in enumerate(parts) if i not in gone) if gone else k[1] for k, (parts, gone) in out.items()}


def test_lines_against_brute_force(docs):
    rng, rows = random.Random(3), []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(1, 9)):
            if rows and rng.random() < 0.5:
                old = rng.choice(rows)[1].split("\n")
                at = rng.randrange(len(old))
                parts += old[at : at + rng.randint(1, 4)]
            else:
                parts.append(" ".join(rng.choice("abcd") for _ in range(rng.choice([1, 2, 5, 60]))) + rng.choice(["", " ", "\n", "\n \t"]))
        rows.append((i, "\n".join(parts)))
    want = {k[0]: v for k, v in brute_lines([r for r in rows if r[1].strip()]).items()}
    got = linededup.dedup_lines(docs(rows))
    assert {r.doc_id: r.text for r in got.collect()} == {i: want.get(i, t) for i, t in rows}
    assert got.where("lines_removed > 0").count() > 20


def test_lines_of_odd_rows(docs, edges):
    got = linededup.dedup_lines(docs(edges)).select("doc_id", "text", "line_count", "lines_removed", "kept").collect()
    assert len(got) == len(edges)
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(i), str(t)) for i, t in edges)
    assert {r.line_count for r in got if not (r.text or "").strip()} == {0}
    assert linededup.dedup_lines(docs([(1, "x")]).where("false")).count() == 0


def test_equal_rows_lose_the_same_lines(docs):
    run = "\n".join(f"line {k} of the run" for k in range(4))
    got = linededup.dedup_lines(docs([(1, "own words\n" + run), (2, run + "\nits end"), (2, run + "\nits end"), (None, run)]))
    assert sorted(((r.doc_id or 99), r.text, r.line_runs_removed) for r in got.collect()) == [(1, "own words\n" + run, 0), (2, "its end", 1), (2, "its end", 1), (99, "", 1)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    from custoria.llm.queries import QUERIES

    assert differences(QUERIES[name](spark, small), connection(small), ORACLES[name]) is None


# ---- bytes

def brute_bytes(rows):
    first, out = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (t or "").encode()
        for k in range(len(data) - 49):
            first.setdefault(data[k : k + 50], float("inf") if i is None else i)
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            if first[data[k : k + 50]] < (float("inf") if i is None else i):
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept))
    return sorted(out, key=str)


def given_bytes(df):
    got = suffixdedup.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    return sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_against_brute_force(docs, seed):
    rng, rows = random.Random(seed), []
    for i in range(150):
        text = ""
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            if rows and kind < 0.5:
                old = rng.choice(rows)[1]
                at = rng.randint(0, len(old))
                text += old[at : at + rng.randint(20, 120)]
            elif kind < 0.7:
                text += rng.choice("ab") * rng.randint(1, 80)
            elif kind < 0.8:
                text += "xyz é" * rng.randint(1, 30)
            else:
                text += "".join(rng.choice("abcd é") for _ in range(rng.randint(1, 150)))
        rows.append((i if rng.random() < 0.9 else i // 2, text))
    assert given_bytes(docs(rows, 5)) == brute_bytes(rows)


def test_bytes_in_small_slices(docs, monkeypatch):
    rows = [(i, "abcdefghij" * 9 + str(i) + "klmnop" * (i % 5 * 4)) for i in range(25)]
    monkeypatch.setattr(suffixdedup, "SLICE", 64)
    block = suffixdedup.Block([i for i, _ in rows], [t.encode() for _, t in rows])
    whole = sum(len(t) - 49 for _, t in rows if len(t) >= 50)
    assert (block.last - block.first + 1).sum() == whole


def test_bytes_of_odd_rows(docs, edges):
    rows = [r for r in edges if len(r[1] or "") < 30_000]
    assert given_bytes(docs(rows)) == brute_bytes(rows)
    assert suffixdedup.remove_repeats(docs([(1, "x")]).where("false")).count() == 0


# ---- near-duplicates

def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, bits=2):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and bin(a ^ b).count("1") <= bits:
                parent[root(a)] = root(b)
    return {p: root(p) for p in prints}


def test_fingerprints_and_classes(docs, edges):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(60)) for _ in range(40)]
    rows = list(edges) + [(100 + k, t) for k, t in enumerate(base)]
    for k in range(160):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 1, 1, 2, 6])):
            words[rng.randrange(len(words))] = "changed"
        rows.append((200 + k, " ".join(words)))
    got = simhash.classes(docs(rows)).collect()
    assert len(got) == len(rows)
    prints = {str((i, t)): plain_print(t) for i, t in rows}
    groups = plain_classes(set(prints.values()))
    least = {}
    for i, t in rows:
        if i is not None:
            g = groups[plain_print(t)]
            least[g] = min(i, least.get(g, i))
    want = sorted(((i, plain_print(t), least.get(groups[plain_print(t)])) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.simhash % (1 << 64), r.component_id) for r in got), key=str) == want
    assert len(set(r[2] for r in want)) < len(set(prints.values()))
    assert simhash.classes(docs([(1, "x")]).where("false")).count() == 0
    kept = simhash.keep_first(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(set(least.values()))


@pytest.mark.parametrize("thresholds", [(0, 0, 0), (1, 0), (0, 1), (1, 0, -1), (2, -1)])
def test_links_for_every_allocation(spark, monkeypatch, thresholds):
    rng = random.Random(6)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        q = p
        for _ in range(8):
            q ^= 1 << rng.randrange(64)
            prints.add(q)
    parts = len(thresholds)
    plan = simhash.Plan(tuple(tuple(range(k, 64, parts)) for k in range(parts)), thresholds, 0.0)
    monkeypatch.setattr(simhash, "plan", lambda df, bits: plan)
    monkeypatch.setattr(simhash, "MEETING", 3)
    table = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "simhash long").repartition(4)
    found = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links(table).collect()]
    assert all(bin(a ^ b).count("1") <= 2 for a, b in found)
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in found:
        parent[root(a)] = root(b)
    want = plain_classes(prints)
    assert len({(root(p), want[p]) for p in prints}) == len({root(p) for p in prints}) == len(set(want.values()))


def test_allocation_is_the_cheapest():
    rng = random.Random(7)
    for _ in range(50):
        parts = rng.randint(2, 4)
        work = [[0.0, *sorted(rng.random() for _ in range(3))] for _ in range(parts)]
        cost, chosen = simhash.allocate(work, 2)
        assert sum(chosen) == 2 - parts + 1

        def all_ways(k, left):
            if k == parts:
                return 0.0 if left == 0 else float("inf")
            return min(work[k][t + 1] + all_ways(k + 1, left - t) for t in range(-1, 3))

        assert abs(cost - all_ways(0, 2 - parts + 1)) < 1e-9


def test_correlated_bits_share_a_part():
    bits = np.random.default_rng(1).integers(0, 2, (4000, 64))
    bits[:, 40] = bits[:, 3]
    both = bits.T @ bits
    parts = simhash.grouped_bits(both.astype(float), 4000, 3)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert any(3 in p and 40 in p for p in parts)
