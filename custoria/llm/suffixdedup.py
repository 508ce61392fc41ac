"""Removal of byte strings that start in an earlier document, by distributed prefix doubling.

Names (ranks) of equal strings double in length, 16, 33, 50 bytes, and a position whose name is
unique drops out. Doubling starts from a synchronised sample of the suffix positions: the anchor
of a 50-byte string is the place of its smallest 16-byte hash, so equal strings have their
anchors at the same place, and about one position in 17 is one.

1. Names of 16 bytes at the anchors. Around an anchor lie up to 35 strings that share it; their
   union, the region, is named as well. A region that an earlier document has, too, is covered as a whole.
   Anchors with a unique name drop out, and so do regions that are alone under theirs.
2. The first documents of regions that share an anchor's name: pairs of names at offset 17, to either side.
3. What is left, string by string: pairs of 32-byte names at offset 18, which make 50 bytes.

In each round the blocks of documents send their names to buckets, where Spark brings equal ones
together; they are sorted there and each block learns what became of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custoria.llm.blocks import dealt, packed, record, steps, stored, unpacked
from custoria.session import materialize

LENGTH, GRAM = 50, 16
#: Anchors of a string's start: LENGTH - GRAM + 1 places.
WINDOW = LENGTH - GRAM + 1
HALF = (LENGTH - GRAM) // 2
#: Positions whose hashes are in memory at once.
SLICE = 1 << 20
NAME = np.uint64((1 << 48) - 1)
EARLIER, SHARED, SEVERAL = 1, 2, 4
U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Block:
    """The bytes of a block's documents, their ids as unsigned order keys, and the anchors."""

    def __init__(self, ids: list[int | None], bodies: list[bytes]):
        # a null id comes after all others
        self.order = np.array([(1 << 64) - 1 if i is None else i + (1 << 63) for i in ids], U)
        sizes = np.array([len(b) for b in bodies], np.int64)
        self.ends = (sizes + 1).cumsum() - 1
        self.begins = self.ends - sizes
        self.data = b"\0".join(bodies) + bytes(LENGTH + 64)
        self.eight = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))
        found = list(self._anchors())
        self.doc, self.anchor, self.first, self.last = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else [()] * 4))

    def name(self, at: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
        """Names of the ``size`` bytes (8 or more) at each place."""
        offsets = [*range(0, size - 7, 8)]
        if offsets[-1] != size - 8:
            offsets.append(size - 8)
        out = np.full(len(at), U(size + 256 * seed + 1))
        for k in offsets:
            out = _mix(out * U(0x9E3779B97F4A7C15) + self.eight[at + k])
        return out

    def _anchors(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(document, anchor, first start, last start) of each run of strings that share an anchor."""
        long_ = np.flatnonzero(self.ends - self.begins >= LENGTH)
        starts, stops = self.begins[long_], self.ends[long_] - LENGTH + 1
        total = int(self.ends[-1]) + 1 if len(self.ends) else 0
        for low in range(0, total, SLICE):
            high = min(total, low + SLICE)
            inside = np.flatnonzero((starts < high) & (stops > low))
            if not len(inside):
                continue
            n = high - low + WINDOW - 1
            gram = _mix(_mix(self.eight[low : low + n]) + self.eight[low + 8 : low + 8 + n])
            key = (gram >> U(32) << U(32)) | (U(0xFFFFFFFF) - np.arange(n, dtype=U))
            width = 1
            while 2 * width <= WINDOW:
                key = np.minimum(key[:-width], key[width:])
                width *= 2
            if width < WINDOW:
                key = np.minimum(key[: len(key) - (WINDOW - width)], key[WINDOW - width :])
            place = (U(0xFFFFFFFF) - (key & U(0xFFFFFFFF))).astype(np.int64)
            new = np.concatenate([[True], place[1:] != place[:-1]])
            new[np.maximum(starts[inside], low) - low] = True
            cuts = stops[inside] - low
            new[cuts[cuts < len(new)]] = True
            first = np.flatnonzero(new)
            last = np.concatenate([first[1:], [high - low]]) - 1
            doc = np.searchsorted(starts, first + low, side="right") - 1
            good = (doc >= 0) & (first + low < stops[np.maximum(doc, 0)])
            first, last, doc = first[good], last[good], doc[good]
            yield long_[doc], place[first] + low, first + low, last + low

    # ---- what each round asks: names, checks and documents

    def round1(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        reach = (self.last - self.first).astype(U) + U(64) * (self.anchor - self.first).astype(U)
        region = _mix(self.name(self.first, LENGTH) ^ _mix(self.name(self.last, LENGTH, 1) + reach))
        return self.name(self.anchor, GRAM) & NAME, region & NAME, self.order[self.doc]

    def settle1(self, codes: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Anchors whose region is covered, and those that go on."""
        covered = (codes & EARLIER > 0) | (self.order[self.doc] > least)
        return covered, ~covered & (codes & SEVERAL > 0)

    def round2(self, live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Requests of the live anchors, and the live anchors with a string reaching to the left, and to the right."""
        at = np.flatnonzero(live)
        # a string that starts HALF or more before the anchor needs the left name, one that starts HALF or less before it the right one
        left = at[self.anchor[at] - self.first[at] >= HALF]
        right = at[self.anchor[at] - self.last[at] <= HALF]
        names = np.concatenate([self.name(self.anchor[left] - HALF, GRAM + HALF), self.name(self.anchor[right], GRAM + HALF)])
        sides = np.concatenate([np.zeros(len(left), U), np.ones(len(right), U)])
        return names & NAME, (names >> U(48)) * U(2) + sides, self.order[self.doc[np.concatenate([left, right])]], left, right

    def round3(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Requests of the strings around anchors that live on to the left or right, and where the strings start."""
        out, docs = [], []
        for chosen, low, high in ((left, None, HALF), (right, HALF, None)):
            first = self.first[chosen] if low is None else np.maximum(self.first[chosen], self.anchor[chosen] - low)
            last = self.last[chosen] if high is None else np.minimum(self.last[chosen], self.anchor[chosen] - high)
            n = np.maximum(last - first + 1, 0)
            before = np.concatenate([[0], n.cumsum()])[:-1]
            out.append(np.repeat(first - before, n) + np.arange(n.sum()))
            docs.append(np.repeat(self.doc[chosen], n))
        start, place = np.unique(np.concatenate(out), return_index=True)
        doc = np.concatenate(docs)[place]
        return self.name(start, 32) & NAME, self.name(start + LENGTH - 32, 32) & NAME, self.order[doc], start

    def runs(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, begin, end) of the bytes covered by strings that start from ``first`` to ``last``."""
        order = np.argsort(first, kind="stable")
        begin, end = first[order], np.maximum.accumulate(last[order] + LENGTH) if len(order) else last
        new = np.concatenate([[True], begin[1:] > end[:-1]]) if len(begin) else np.zeros(0, bool)
        edges = np.flatnonzero(new)
        begin, end = begin[edges], end[np.concatenate([edges[1:], [len(end)]]) - 1] if len(edges) else end
        doc = np.searchsorted(self.begins, begin, side="right") - 1
        # an empty document may begin where another one does
        return np.minimum(doc, len(self.begins) - 1), begin, end


def _entries(names: np.ndarray, checks: np.ndarray, docs: np.ndarray):
    """Distinct (name, check) in order with the smallest and largest document, and each request's entry."""
    order = np.lexsort((docs, checks, names))
    n, c, d = names[order], checks[order], docs[order]
    new = np.concatenate([[True], (n[1:] != n[:-1]) | (c[1:] != c[:-1])]) if len(n) else np.zeros(0, bool)
    edges = np.flatnonzero(new)
    last = np.concatenate([edges[1:], [len(n)]])[: len(edges)] - 1
    entry = np.zeros(len(n), np.int64)
    entry[order] = np.cumsum(new) - 1
    return n[edges], c[edges], d[edges], d[last], entry


REQUEST = "block long, step int, bucket int, n long, names binary, checks binary, least binary, spread binary"
ANSWER = "block long, step int, bucket int, n long, codes binary"


def _asked(block: int, step: int, buckets: int, names: np.ndarray, checks: np.ndarray, docs: np.ndarray) -> pa.Table:
    n, c, least, most, _ = _entries(names, checks, docs)
    order, edges = dealt(n, buckets)
    rows = []
    for b in np.flatnonzero(np.diff(edges)).tolist():
        own = order[edges[b] : edges[b + 1]]
        rows.append((block, step, b, len(own), packed(steps(n[own])), packed(c[own]), packed(least[own]), packed(most[own] - least[own])))
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
    return record(rows, [x.split()[0] for x in REQUEST.split(", ")], kinds)


def _judged(requests: DataFrame) -> DataFrame:
    """For every entry of every block: whether an earlier document has it, whether two documents do, whether its name has several."""

    def run(table: pa.Table) -> pa.Table:
        columns = ("block", "step", "bucket", "n", "names", "checks", "least", "spread")
        rows = list(zip(*(table.column(x).to_pylist() for x in columns)))
        sizes = [r[3] for r in rows]
        names = np.concatenate([unpacked(r[4], r[3]).cumsum(dtype=U) for r in rows])
        checks, least, spread = (np.concatenate([unpacked(r[k], r[3]) for r in rows]) for k in (5, 6, 7))
        order = np.lexsort((checks, names))
        n, c = names[order], checks[order]
        new_name = np.concatenate([[True], n[1:] != n[:-1]])
        new = new_name | np.concatenate([[True], c[1:] != c[:-1]])
        classes = np.cumsum(new) - 1
        edges = np.flatnonzero(new)
        low, high = np.minimum.reduceat(least[order], edges), np.maximum.reduceat((least + spread)[order], edges)
        group = np.cumsum(new_name)[edges] - 1
        several = np.bincount(group)[group] > 1
        codes = np.zeros(len(names), np.uint8)
        codes[order] = EARLIER * (low[classes] < least[order]) + SHARED * (low != high)[classes] + SEVERAL * several[classes]
        out, at = [], 0
        for r, size in zip(rows, sizes):
            out.append((*r[:4], pa.compress(codes[at : at + size].tobytes(), codec="zstd", asbytes=True)))
            at += size
        return record(out, [x.split()[0] for x in ANSWER.split(", ")], [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()])

    return materialize(requests.groupBy("bucket").applyInArrow(run, ANSWER))


def _read(answers: pa.Table, step: int, buckets: int, names: np.ndarray, checks: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code of each request of a step, and the smallest document that the block has for its entry."""
    n, _, least, _, entry = _entries(names, checks, docs)
    order, _ = dealt(n, buckets)
    rows = sorted((b, size, codes) for s, b, size, codes in zip(*(answers.column(x).to_pylist() for x in ("step", "bucket", "n", "codes"))) if s == step)
    codes = np.zeros(len(n), np.uint8)
    if rows:
        codes[order] = np.concatenate([np.frombuffer(pa.decompress(c, decompressed_size=k, codec="zstd", asbytes=True), np.uint8) for _, k, c in rows])
    return codes[entry], least[entry]


def _sides(block: Block, live: np.ndarray, answers: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    names, checks, docs, left, right = block.round2(live)
    codes, _ = _read(answers, 2, buckets, names, checks, docs)
    shared = codes & SHARED > 0
    return left[shared[: len(left)]], right[shared[len(left) :]]


def remove_repeats(df: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, begins, ends, kept) of every row.

    Removed is every byte inside a 50-byte string that also starts in a row with a smaller id;
    ``begins`` and ``ends`` are the maximal removed runs and ``kept`` is what is left, as bytes (a cut
    may split a character). Ids are integers; rows of equal ids do not remove from each other, and
    rows with a null id come last. A null text has no bytes; texts of less than 50 bytes stay whole.
    Matches never cross rows. Names have 96 bits in each round, so two different strings are taken
    for equal with a probability of about n * n / 2**97 for n positions.
    """
    blocks, buckets = stored(df, id_column, column, bytes)

    def load(table: pa.Table) -> tuple[int, Block]:
        return table.column("block")[0].as_py(), Block(table.column("id").to_pylist(), table.column("body").to_pylist())

    def ask1(table: pa.Table) -> pa.Table:
        number, block = load(table)
        return _asked(number, 1, buckets, *block.round1())

    def ask2(table: pa.Table, answers: pa.Table) -> pa.Table:
        number, block = load(table)
        _, live = block.settle1(*_read(answers, 1, buckets, *block.round1()))
        return _asked(number, 2, buckets, *block.round2(live)[:3])

    def ask3(table: pa.Table, answers: pa.Table) -> pa.Table:
        number, block = load(table)
        _, live = block.settle1(*_read(answers, 1, buckets, *block.round1()))
        return _asked(number, 3, buckets, *block.round3(*_sides(block, live, answers, buckets))[:3])

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        _, block = load(table)
        covered, live = block.settle1(*_read(answers, 1, buckets, *block.round1()))
        names, checks, docs, start = block.round3(*_sides(block, live, answers, buckets))
        codes, least = _read(answers, 3, buckets, names, checks, docs)
        single = start[(codes & EARLIER > 0) | (docs > least)]
        doc, begin, end = block.runs(np.concatenate([block.first[covered], single]), np.concatenate([block.last[covered], single]))
        begins: list[list[int]] = [[] for _ in range(table.num_rows)]
        ends: list[list[int]] = [[] for _ in range(table.num_rows)]
        for d, b, e in zip(doc.tolist(), begin.tolist(), end.tolist()):
            begins[d].append(b - int(block.begins[d]))
            ends[d].append(e - int(block.begins[d]))
        bodies = table.column("body").to_pylist()
        kept = [b"".join([body[x:y] for x, y in zip([0, *e], [*b, len(body)])]) for body, b, e in zip(bodies, begins, ends)]
        return pa.table({
            "id": table.column("id"), "n_bytes": pa.array([len(b) for b in bodies], pa.int64()), "n_removed": pa.array([len(b) - len(k) for b, k in zip(bodies, kept)], pa.int64()),
            "n_spans": pa.array([len(b) for b in begins], pa.int64()), "begins": pa.array(begins, pa.list_(pa.int64())), "ends": pa.array(ends, pa.list_(pa.int64())), "kept": pa.array(kept, pa.binary()),
        })

    each = blocks.groupBy("block")
    answers = _judged(each.applyInArrow(ask1, REQUEST))
    answers = answers.unionByName(_judged(each.cogroup(answers.groupBy("block")).applyInArrow(ask2, REQUEST)))
    answers = answers.unionByName(_judged(each.cogroup(answers.groupBy("block")).applyInArrow(ask3, REQUEST)))
    id_type = blocks.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, n_bytes long, n_removed long, n_spans long, begins array<long>, ends array<long>, kept binary"
    return each.cogroup(answers.groupBy("block")).applyInArrow(finish, schema).withColumnRenamed("id", id_column)
