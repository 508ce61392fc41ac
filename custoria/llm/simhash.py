"""SimHash near-duplicates found by the generalised pigeonhole principle.

Correlated bits of the distinct fingerprints are grouped into parts. Each part gets its own
threshold, allocated by dynamic programming on estimated candidate counts: if two
fingerprints differ in at most ``bits`` bits and the thresholds add up to bits - parts + 1, then
they are within the threshold of at least one part. Fingerprints meet at the values of a
part (and at the values around them, where its threshold is above zero) and are verified there.
Equal fingerprints count once, and each meeting returns a spanning forest of its links
only, so neither copies nor near-copies multiply.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations
from math import inf

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custoria.llm.common import as_bytes, columns_of, components, gathered, map_batches, rows_of
from custoria.session import materialize

WORDS, BITS = 3, 2
#: Fingerprints that are compared in one meeting; larger ones are split by the remaining bits.
MEETING = 4096
_HASH = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(data: bytes | None, words: int = WORDS) -> int:
    """64 majority bits of the XXH64 values of all word shingles; 0 for a text without words.

    ``bytes.lower`` and ``bytes.split`` act on A-Z and on the six ASCII spaces alone.
    """
    tokens = data.lower().split() if data else []
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*[tokens[k:] for k in range(words)]))
    hashes = np.fromiter(map(_HASH, shingles), np.uint64)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 4096):
        block = hashes[start : start + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_ = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, column: str = "text", words: int = WORDS) -> DataFrame:
    """``df`` with ``simhash`` (the 64 bits as a signed long); a null text has no words."""
    columns = [c for c in df.columns if c != "simhash"]

    def added(batch: pa.RecordBatch) -> list[pa.Array]:
        data = as_bytes(batch.column(columns.index(column)))
        return [pa.array([fingerprint(x, words) for x in data], pa.int64())]

    return map_batches(df, columns, added, [T.StructField("simhash", T.LongType())])


@dataclass(frozen=True)
class Plan:
    """Bits of each part, its threshold (-1: not probed), and the estimated work."""

    parts: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]
    work: float


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how many have each pair of bits set: one 64 by 64 sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            raw = np.ascontiguousarray(batch.column(0).to_numpy().astype("<i8")).view(np.uint8).reshape(-1, 8)
            for start in range(0, len(raw), 65536):
                bits = np.unpackbits(raw[start : start + 65536], axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
            n += len(raw)
        yield pa.RecordBatch.from_arrays([pa.array(range(4097)), pa.array([*total.ravel().astype(np.int64).tolist(), n])], names=["cell", "n"])

    cells = prints.select("simhash").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(4097)
    for cell, n in cells:
        flat[cell] = n
    return int(flat[4096]), flat[:4096].reshape(64, 64)


def grouped_bits(both: np.ndarray, n: int, parts: int) -> tuple[tuple[int, ...], ...]:
    """64 bits in ``parts`` groups of nearly equal size, correlated ones together."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    free, out = set(range(64)), []
    for k in range(parts):
        size = 64 // parts + (k < 64 % parts)
        rest = sorted(free)
        first = max(rest, key=lambda b: (related[b, rest].max(), -b))
        group = [first]
        free.discard(first)
        while len(group) < size:
            best = max(sorted(free), key=lambda b: (related[b, group].sum(), -b))
            group.append(best)
            free.discard(best)
        out.append(tuple(sorted(group)))
    return tuple(out)


def part_value(column, bits: tuple[int, ...]):
    """The bits of a part, in place."""
    return column.bitwiseAND(F.lit(_mask(set(bits))))


def allocate(estimates: list[list[float]], bits: int) -> tuple[float, tuple[int, ...]]:
    """Thresholds that add up to bits - parts + 1 with the least work.

    ``estimates[i][t + 1]`` is the work of part i at threshold t, from -1 (none) on.
    """
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for work in estimates:
        grown: dict[int, tuple[float, tuple[int, ...]]] = {}
        for total, (cost, chosen) in best.items():
            for t in range(-1, bits + 1):
                candidate = (cost + work[t + 1], (*chosen, t))
                if candidate < grown.get(total + t, (inf, ())):
                    grown[total + t] = candidate
        best = grown
    return best[bits - len(estimates) + 1]


def plan(prints: DataFrame, bits: int = BITS) -> Plan:
    """The cheapest parts and thresholds for distinct fingerprints (column simhash).

    For each number of parts, pairs that agree in a part are counted exactly from its value
    counts; pairs that differ in one or two of its bits are estimated from these and from
    each bit's share. The work of a part is its candidate pairs and the rows probed.
    """
    n, both = bit_statistics(prints)
    p = np.diag(both) / max(n, 1)
    agree = np.clip(p**2 + (1 - p) ** 2, 1e-9, 1)
    odds = (1 - agree) / agree
    layouts = [grouped_bits(both, n, parts) for parts in range(2, bits + 2)]
    flat = [(k, i, group) for k, layout in enumerate(layouts) for i, group in enumerate(layout)]
    values = prints.select(F.explode(F.array(*[F.struct(F.lit(j).alias("j"), part_value(F.col("simhash"), g).alias("v")) for j, (_, _, g) in enumerate(flat)])).alias("x"))
    sizes = values.groupBy("x.j", "x.v").agg(F.count("*").cast("double").alias("n")).groupBy("j").agg((F.sum(F.col("n") * (F.col("n") - 1)) / 2).alias("pairs"))
    equal = {j: pairs for j, pairs in sizes.collect()}
    chosen: Plan | None = None
    for k, layout in enumerate(layouts):
        estimates = []
        for j, (layout_at, _, group) in enumerate(flat):
            if layout_at != k:
                continue
            o, pairs = odds[list(group)], equal.get(j, 0.0)
            one, two = o.sum(), (o.sum() ** 2 - (o**2).sum()) / 2
            width = len(group)
            reach = [1.0, 1.0 + one, 1.0 + one + two]
            rows = [1.0, 2.0 + width, 2.0 + width + width * (width - 1) / 2]
            estimates.append([0.0, *[pairs * reach[t] + n * rows[t] for t in range(bits + 1)]])
        work, thresholds = allocate(estimates, bits)
        if chosen is None or work < chosen.work:
            chosen = Plan(layout, thresholds, float(work))
    return chosen


def _mask(bits: set[int]) -> int:
    """The bits as a signed long."""
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def _probes(prints: DataFrame, chosen: Plan) -> DataFrame:
    """(meeting, left, simhash) rows: each fingerprint at its value of every part and, where the threshold
    is above zero, at the values around it; ``left`` are the bits outside the part."""
    rows = [
        (i, _mask(set(flipped)))
        for i, (group, threshold) in enumerate(zip(chosen.parts, chosen.thresholds))
        for size in range(threshold + 1)
        for flipped in combinations(group, size)
    ]
    used = sorted({i for i, _ in rows})
    part = lambda make: F.coalesce(*[F.when(F.col("part") == i, make(chosen.parts[i])) for i in used])
    probes = prints.select("simhash", F.inline(F.array(*[F.struct(F.lit(i).alias("part"), F.lit(m).cast("long").alias("mask")) for i, m in rows])))
    value = part(lambda bits: part_value(F.col("simhash"), bits)).bitwiseXOR(F.col("mask"))
    return probes.select(F.xxhash64("part", value).alias("meeting"), part(lambda bits: F.lit(_mask(set(range(64)) - set(bits)))).alias("left"), "simhash")


def _split(rows: DataFrame, bits: int) -> DataFrame:
    """Meetings of more than MEETING fingerprints split again by the pigeonhole principle.

    Fingerprints that meet differ in at most ``bits`` of the bits that are left. Each level deals these to
    bits + 1 groups, by a digit of the bit's number; in one of them at least two near fingerprints
    agree. When the digits are used up, few bits are left and so few distinct fingerprints can meet.
    """
    done, base, level = [], bits + 1, 0
    while base**level < 64:
        rows = gathered(rows, rows.count())
        hot = materialize(rows.groupBy("meeting").agg(F.count("*").alias("n")).where(F.col("n") > MEETING).select("meeting"))
        if hot.isEmpty():
            break
        done.append(rows.join(hot, "meeting", "left_anti"))
        groups = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(_mask({b for b in range(64) if b // base**level % base == k})).alias("mask")) for k in range(base)])
        large = rows.join(hot, "meeting", "left_semi").select("meeting", "left", "simhash", F.inline(groups))
        mask = F.col("left").bitwiseAND(F.col("mask"))
        rows = materialize(large.select(F.xxhash64("meeting", "k", F.col("simhash").bitwiseAND(mask)).alias("meeting"), F.col("left").bitwiseAND(F.bitwise_not(mask)).alias("left"), "simhash"))
        level += 1
    return _union([*done, rows])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _forest(values: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among fingerprints, compared block by block."""
    values = np.unique(values)
    n = len(values)
    if n < 2:
        return []
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out, unsigned = [], values.view(np.uint64)
    for start in range(0, n, 256):
        block = unsigned[start : start + 256]
        near = np.bitwise_count(block[:, None] ^ unsigned[None, start:]) <= bits
        for a, b in zip(*(x.tolist() for x in np.nonzero(near))):
            if b > a and (ra := root(a + start)) != (rb := root(b + start)):
                parent[max(ra, rb)] = min(ra, rb)
                out.append((int(values[a + start]), int(values[b + start])))
    return out


def _verify(rows: DataFrame, bits: int) -> DataFrame:
    """Links (a, b) inside each meeting; its rows stand together after a sort by meeting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(meeting: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            edges = np.flatnonzero(np.concatenate([[True], meeting[1:] != meeting[:-1], [True]]))
            sizes = np.diff(edges)
            out: list[tuple[int, int]] = []
            # meetings of two need no forest
            pair = edges[:-1][sizes == 2]
            a, b = prints[pair], prints[pair + 1]
            near = (np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= bits) & (a != b)
            out += zip(a[near].tolist(), b[near].tolist())
            for k in np.flatnonzero(sizes > 2).tolist():
                out += _forest(prints[edges[k] : edges[k + 1]], bits)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], names=["a", "b"])

        kept_m, kept_p = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            meeting, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(meeting):
                continue
            cut = int(np.searchsorted(meeting != meeting[-1], False)) if meeting[0] == meeting[-1] else len(meeting) - int(np.argmax(meeting[::-1] != meeting[-1]))
            if cut:
                m, p = np.concatenate([*kept_m, meeting[:cut]]), np.concatenate([*kept_p, prints[:cut]])
                yield links(m, p)
                kept_m, kept_p = [meeting[cut:]], [prints[cut:]]
            elif kept_m[-1].size and kept_m[-1][-1] != meeting[0]:
                yield links(np.concatenate(kept_m), np.concatenate(kept_p))
                kept_m, kept_p = [meeting], [prints]
            else:
                kept_m.append(meeting)
                kept_p.append(prints)
        m = np.concatenate(kept_m)
        if len(m):
            yield links(m, np.concatenate(kept_p))

    dealt = rows.select("meeting", "simhash").repartition("meeting").sortWithinPartitions("meeting")
    return dealt.mapInArrow(run, "a long, b long")


def links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (a, b) that connect the same distinct fingerprints as all pairs within ``bits`` do."""
    chosen = plan(prints, bits)
    return _verify(_split(materialize(_probes(prints, chosen)), bits), bits)


def classes(df: DataFrame, id_column: str = "doc_id", column: str = "text", words: int = WORDS, bits: int = BITS) -> DataFrame:
    """(id, ``simhash``, ``component_id``) of every row: the smallest id reached over links of ``bits`` or fewer bits.

    Null and empty texts and texts of spaces have fingerprint 0 and are linked like any other.
    Rows with equal ids stay rows of their own; a null id is never the smallest, and a class
    without any id has a null component. An empty table gives an empty result.
    """
    stored = materialize(fingerprints(df.select(F.col(id_column).alias("id"), F.col(column).alias("text")), "text", words).select("id", "simhash"))
    distinct = materialize(stored.groupBy("simhash").agg(F.min("id").alias("first")))
    distinct = gathered(distinct, distinct.count())
    linked = components(links(distinct.select("simhash"), bits))
    of_print = distinct.join(linked.withColumnRenamed("node", "simhash"), "simhash", "left").select("simhash", "first", F.coalesce("component", "simhash").alias("class"))
    smallest = of_print.groupBy("class").agg(F.min("first").alias("component_id"))
    named = of_print.join(smallest, "class").select("simhash", "component_id")
    return stored.join(named, "simhash").select(F.col("id").alias(id_column), "simhash", "component_id")


def keep_first(df: DataFrame, id_column: str = "doc_id", column: str = "text", words: int = WORDS, bits: int = BITS) -> DataFrame:
    """``df`` with one row of each class: that of the smallest id.

    Rows with that same id and equal columns cannot be told apart; all but one of them go. A
    row whose id is null stays, as nothing names it as a copy.
    """
    found = classes(df, id_column, column, words, bits)
    keep = found.where(F.col(id_column) == F.col("component_id")).select(F.col(id_column).alias("first")).distinct()
    whole = rows_of(df, column, id=id_column)
    chosen = whole.join(keep, F.col("id") == F.col("first"), "left_semi").withColumn("tie", F.xxhash64("row", "text"))
    once = chosen.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("tie"))).where("n = 1").select("row", "text")
    return once.unionByName(whole.where("id IS NULL").select("row", "text")).select(*columns_of(df.columns, column))
