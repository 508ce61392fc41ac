"""Language-model scores by context-tree weighting over bytes.

Each byte is eight binary decisions; a decision is predicted from its context, the DEPTH bytes
before it, by mixing the Krichevsky-Trofimov estimates of the contexts of all depths. The weight
of a context against the longer ones below it is its share of the evidence in the
training text, worked out bottom-up as the method prescribes. A context that training never
reached takes no part.

The counts are those of all byte strings of DEPTH + 1 bytes. Documents are stored in blocks of
bounded size; a block sends its distinct strings, packed, to buckets by their last three bytes of
context. A bucket holds whole subtrees, so it adds up the counts, weights its nodes, and
answers each block with one logarithm per string. Only the tree's top (contexts of two bytes)
passes the driver: at most 256 * 256 * 511 sums. Word counts for the base score go the same way.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custoria.llm.blocks import dealt, packed, record, steps, stored, unpacked
from custoria.session import materialize

DEPTH, TOP = 5, 2
#: Positions that are worked on at once.
SLICE = 1 << 20
END = b"\n"
GRAM, WORD = 0, 1


# ---- strings and words of a block

def _stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Documents as one array, each behind DEPTH zero bytes and ended, and where each one's own bytes begin and end."""
    pad = bytes(DEPTH)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    ends = (sizes + DEPTH).cumsum()
    return np.frombuffer(b"".join([x for t in texts for x in (pad, t, END)]), np.uint8), np.stack([ends - sizes, ends], 1)


def _strings(stream: np.ndarray, start: int, stop: int) -> np.ndarray:
    """For each position the nearest byte of context first, then the farther ones, then the byte itself."""
    key = np.zeros(stop - start, np.uint64)
    for k in range(1, DEPTH + 1):
        key = key << np.uint64(8) | stream[start - k : stop - k]
    return key << np.uint64(8) | stream[start:stop]


def _spans(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """The documents' own bytes, long ones in slices."""
    for begin, end in bounds.tolist():
        for start in range(begin, end, SLICE):
            yield start, min(end, start + SLICE)


def _batches(stream: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """Strings of the documents in pieces of about SLICE positions, in order."""
    waiting, size = [], 0
    for start, stop in _spans(bounds):
        waiting.append(_strings(stream, start, stop))
        size += stop - start
        if size >= SLICE:
            yield np.concatenate(waiting)
            waiting, size = [], 0
    if waiting:
        yield np.concatenate(waiting)


def _distinct(stream: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for piece in _batches(stream, bounds):
        k, c = np.unique(piece, return_counts=True)
        keys, counts = _summed(np.concatenate([keys, k]), np.concatenate([counts, c]))
    return keys, counts


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    unique, place = np.unique(keys, return_inverse=True)
    return unique, np.bincount(place, weights=counts, minlength=len(unique)).astype(np.int64)


def _block_strings(texts: list[bytes], held: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """All strings of a block, and how often each occurs in its training documents."""
    stream, bounds = _stream(texts)
    train = ~np.array(held, bool)
    keys, counts = _distinct(stream, bounds[train])
    more, none = _distinct(stream, bounds[~train])
    return _summed(np.concatenate([keys, more]), np.concatenate([counts, np.zeros(len(more), np.int64)]))


def _block_words(texts: list[bytes], held: list[bool]) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    """Key of each word of a block and of the end, the sorted keys, and their training counts."""
    train, rest = Counter(), set()
    for text, out in zip(texts, held):
        (rest if out else train).update(text.split())
        if out:
            rest.add(END)
        else:
            train[END] += 1
    for word in rest:
        train.setdefault(word, 0)
    named = {w: xxhash.xxh64_intdigest(w) for w in train}
    keys, counts = _summed(np.fromiter(named.values(), np.uint64, len(named)), np.fromiter((train[w] for w in named), np.int64, len(named)))
    return named, keys, counts


def _part(keys: np.ndarray, kind: int) -> np.ndarray:
    """What decides the bucket of a key: the last three bytes of context, or the whole word."""
    return keys >> np.uint64(8 * (DEPTH - 2)) if kind == GRAM else keys


# ---- the tree

def _lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0 by Stirling's series at x + 8."""
    y = x + 8.0
    series = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    product = x * (x + 1) * (x + 2) * (x + 3)
    return series - np.log(product) - np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))


def _evidence(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of that many zeros and ones."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - _lgamma(zeros + ones + 1.0) - 1.1447298858494002


class Level:
    """Nodes of one depth: (context, bits so far of the byte) with their estimate and weight."""

    def __init__(self, context: np.ndarray, byte: np.ndarray, counts: np.ndarray, below: tuple[np.ndarray, np.ndarray] | None):
        ids, bits, n = [], [], []
        for j in range(8):
            ids.append(context << np.uint64(8) | np.uint64(1 << j) | byte >> np.uint64(8 - j))
            bits.append(byte >> np.uint64(7 - j) & np.uint64(1))
            n.append(counts)
        n = np.concatenate(n).astype(np.float64)
        bit = np.concatenate(bits).astype(np.float64)
        self.ids, place = np.unique(np.concatenate(ids), return_inverse=True)
        size = len(self.ids)
        ones, all_ = np.bincount(place, weights=n * bit, minlength=size), np.bincount(place, weights=n, minlength=size)
        self.one = (ones + 0.5) / (all_ + 1.0)
        own = _evidence(all_ - ones, ones)
        if below is None:
            self.weight, self.mixed = np.ones(size), own
        else:
            children = np.bincount(np.searchsorted(self.ids, below[0]), weights=below[1], minlength=size)
            self.mixed = np.logaddexp(own, children) - np.log(2.0)
            self.weight = np.exp(own - np.log(2.0) - self.mixed)

    def above(self) -> tuple[np.ndarray, np.ndarray]:
        """The node of the shorter context for each node, and the evidence that it gets."""
        context, path = self.ids >> np.uint64(8), self.ids & np.uint64(255)
        return context >> np.uint64(8) << np.uint64(8) | path, self.mixed

    @property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes in order, their estimates and weights: plain arrays that travel to the tasks."""
        return self.ids, self.one, self.weight


def _find(nodes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each node, and whether training reached it."""
    if not len(nodes):
        return np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
    at = np.minimum(np.searchsorted(nodes, ids), len(nodes) - 1)
    return at, nodes[at] == ids


def _levels(keys: np.ndarray, counts: np.ndarray, depths: range, below: tuple[np.ndarray, np.ndarray] | None = None, width: int = DEPTH) -> dict[int, Level]:
    """Levels from the deepest to the shallowest of ``depths`` for strings of ``width`` bytes of context."""
    seen = counts > 0
    keys, counts = keys[seen], counts[seen]
    out: dict[int, Level] = {}
    for depth in sorted(depths, reverse=True):
        context, byte = keys >> np.uint64(8 * (width - depth) + 8), keys & np.uint64(255)
        both, n = _summed(context << np.uint64(8) | byte, counts)
        out[depth] = Level(both >> np.uint64(8), both & np.uint64(255), n, below)
        below = out[depth].above()
    return out


def _logs(keys: np.ndarray, tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 of the probability of each string's last byte behind its context, by the tables of all depths."""
    total = np.zeros(len(keys))
    context, byte = keys >> np.uint64(8), keys & np.uint64(255)
    for j in range(8):
        path = np.uint64(1 << j) | byte >> np.uint64(8 - j)
        one, reached = np.full(len(keys), 0.5), np.zeros(len(keys), bool)
        for depth in range(DEPTH, -1, -1):
            nodes, estimate, share = tables[depth]
            if not len(nodes):
                continue
            ids = (context >> np.uint64(8 * (DEPTH - depth)) if depth else np.zeros_like(context)) << np.uint64(8) | path
            at, seen = _find(nodes, ids)
            own, weight = estimate[at], share[at]
            one = np.where(seen, np.where(reached, weight * own + (1 - weight) * one, own), one)
            reached = seen
        bit = byte >> np.uint64(7 - j) & np.uint64(1)
        total += np.log10(np.where(bit == 1, one, 1 - one))
    return total


# ---- Spark steps

def _held(ids: list) -> list[bool]:
    return [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i in ids]


def _body(text: bytes) -> bytes:
    """Lower-cased words joined by one space."""
    return b" ".join(text.lower().split())


REQUEST = "kind int, bucket int, block long, n long, keys binary, counts binary"
ANSWER = "block long, kind int, bucket int, n long, values binary"


def _requests(blocks: DataFrame, buckets: int) -> DataFrame:
    """Stored requests: the strings and words of each block with their training counts, dealt to buckets."""

    def run(table: pa.Table) -> pa.Table:
        block, texts = table.column("block")[0].as_py(), table.column("body").to_pylist()
        held = _held(table.column("id").to_pylist())
        rows = []
        _, words, word_counts = _block_words(texts, held)
        for kind, (keys, counts) in ((GRAM, _block_strings(texts, held)), (WORD, (words, word_counts))):
            order, edges = dealt(_part(keys, kind), buckets)
            for b in np.flatnonzero(np.diff(edges)).tolist():
                chosen = order[edges[b] : edges[b + 1]]
                rows.append((kind, b, block, len(chosen), packed(steps(keys[chosen])), packed(counts[chosen])))
        return record(rows, [x.split()[0] for x in REQUEST.split(", ")], [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()])

    return materialize(blocks.groupBy("block").applyInArrow(run, REQUEST))


def _gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """Keys and summed counts of a bucket, and the keys that each block asked for."""
    asked: dict[int, np.ndarray] = {}
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for n, block, k, c in zip(*(table.column(x).to_pylist() for x in ("n", "block", "keys", "counts"))):
        own = unpacked(k, n).cumsum(dtype=np.uint64)
        keys.append(own)
        counts.append(unpacked(c, n).astype(np.int64))
        asked[block] = own
    return *_summed(np.concatenate(keys), np.concatenate(counts)), asked


def _sums(requests: DataFrame) -> DataFrame:
    """(what, key, value): t string counts of the tree's top, w evidence that its deepest nodes get, N all words, V distinct ones."""

    def run(table: pa.Table) -> pa.Table:
        keys, counts, _ = _gathered(table)
        if table.column("kind")[0].as_py() == WORD:
            rows = [("N", 0, float(counts.sum())), ("V", 0, float((counts > 0).sum()))]
            what, key, value = zip(*rows)
            return pa.table({"what": what, "key": pa.array(key, pa.int64()), "value": value})
        local = _levels(keys, counts, range(TOP + 1, DEPTH + 1))
        seen = counts > 0
        top, n = _summed(keys[seen] >> np.uint64(8 * (DEPTH - TOP) + 8) << np.uint64(8) | keys[seen] & np.uint64(255), counts[seen])
        ids, mixed = local[TOP + 1].above()
        nodes, place = np.unique(ids, return_inverse=True)
        return pa.table({
            "what": pa.array(["t"] * len(top) + ["w"] * len(nodes), pa.string()),
            "key": pa.array(np.concatenate([top, nodes]).astype(np.int64)),
            "value": pa.array(np.concatenate([n.astype(float), np.bincount(place, weights=mixed, minlength=len(nodes))])),
        })

    parts = requests.groupBy("kind", "bucket").applyInArrow(run, "what string, key long, value double")
    return parts.groupBy("what", "key").agg(F.sum("value").alias("value"))


def _answers(requests: DataFrame, top: dict[int, Level]) -> DataFrame:
    """(block, kind, bucket, n, values): per key asked for, the logarithm of a string or the count of a word."""
    sent = requests.sparkSession.sparkContext.broadcast({d: level.table for d, level in top.items()})

    def run(table: pa.Table) -> pa.Table:
        keys, counts, asked = _gathered(table)
        kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
        if kind == WORD:
            values = counts
        else:
            local = _levels(keys, counts, range(TOP + 1, DEPTH + 1))
            values = _logs(keys, sent.value | {d: level.table for d, level in local.items()}).astype("<f4")
        rows = []
        for block, own in asked.items():
            found = values[np.searchsorted(keys, own)]
            rows.append((block, kind, bucket, len(own), packed(found) if kind == WORD else found.tobytes()))
        return record(rows, [x.split()[0] for x in ANSWER.split(", ")], [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()])

    return requests.groupBy("kind", "bucket").applyInArrow(run, ANSWER)


def _answered(table: pa.Table, kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """The answers of all buckets in the order of the block's sorted keys."""
    rows = sorted((b, n, v) for k, b, n, v in zip(*(table.column(x).to_pylist() for x in ("kind", "bucket", "n", "values"))) if k == kind)
    parts = [unpacked(v, n).astype(np.float64) if kind == WORD else np.frombuffer(v, "<f4").astype(np.float64) for _, n, v in rows]
    order, _ = dealt(_part(keys, kind), buckets)
    out = np.zeros(len(keys))
    out[order] = np.concatenate(parts) if parts else np.zeros(0)
    return out


def scores(df: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, held_out, n_bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row.

    A row is held out of training if the CRC-32 of its id, as text, is divisible by 10; a null id is
    the empty text and so held out. The text is lower-cased (A-Z), its words are joined by
    one space and ended by one byte, which ``n_bytes`` counts; a null or empty text is its end alone.
    ``score`` is log10 of the probability of these bytes and ``bits_per_byte`` its code length. The base
    score is that of the words and the end under smoothed word counts. Repeated rows count and
    are scored each for itself. Without training rows every bit has probability 1/2.
    """
    blocks, buckets = stored(df, id_column, column, _body)
    requests = _requests(blocks, buckets)
    sums = {w: ([], []) for w in "twNV"}
    for what, key, value in _sums(requests).toLocalIterator():
        sums[what][0].append(key)
        sums[what][1].append(value)
    total, distinct = (sum(sums[w][1]) for w in "NV")
    top_keys, top_counts = np.array(sums["t"][0], np.uint64), np.array(sums["t"][1], np.float64)
    order = np.argsort(top_keys)
    top = _levels(top_keys[order], top_counts[order], range(TOP + 1), (np.array(sums["w"][0], np.uint64), np.array(sums["w"][1])), TOP)
    answers = _answers(requests, top)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        texts, held = left.column("body").to_pylist(), _held(left.column("id").to_pylist())
        stream, bounds = _stream(texts)
        keys, _ = _distinct(stream, bounds)
        logs = _answered(right, GRAM, keys, buckets)
        named, words, _ = _block_words(texts, held)
        known = _answered(right, WORD, words, buckets)
        count = dict(zip(named, known[np.searchsorted(words, np.fromiter(named.values(), np.uint64, len(named)))].tolist()))
        sizes = bounds[:, 1] - bounds[:, 0]
        edges = np.concatenate([[0], sizes.cumsum()])
        score = np.zeros(len(texts))
        at = 0
        for piece in _batches(stream, bounds):
            # each piece of the block adds to the documents that it touches
            values = logs[np.searchsorted(keys, piece)]
            low, high = np.searchsorted(edges, at, "right") - 1, np.searchsorted(edges, at + len(piece), "left")
            starts = np.maximum(edges[low:high] - at, 0)
            score[low:high] += np.add.reduceat(values, starts)
            at += len(piece)
        tokens, seen, base = [], [], []
        for text in texts:
            counts = np.array([count[w] for w in [*text.split(), END]])
            tokens.append(len(counts))
            seen.append(int((counts > 0).sum()))
            base.append(float(np.log10((counts + 0.1) / (total + 0.1 * (distinct + 1))).sum()))
        return pa.table({
            "id": left.column("id"), "held_out": pa.array(held, pa.bool_()), "n_bytes": pa.array(sizes), "n_tokens": pa.array(tokens, pa.int64()), "n_known": pa.array(seen, pa.int64()),
            "train_tokens": pa.array([int(total)] * len(texts), pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(score), "bits_per_byte": pa.array(-score * np.log2(10.0) / sizes),
        })

    id_type = blocks.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, held_out boolean, n_bytes long, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    found = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
    return found.withColumnRenamed("id", id_column)
