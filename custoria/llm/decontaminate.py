"""Benchmark decontamination with an FM-index for each shard of the training documents.

A shard is what one task reads at a time, up to a fixed number of words. Its words become
symbols; words that no test phrase has, and the ends of documents, become separators that
match nothing. The index holds the transform of the shard's suffixes in a wavelet matrix and
every SAMPLE-th suffix position. All test phrases go backwards through it at once, the
occurrences are located by walking to sampled positions, and overlapping ones are
merged into spans. Nothing is shuffled, and the test set passes in blocks of bounded size.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custoria.llm.common import as_bytes, columns_of, rows_of
from custoria.session import materialize

WINDOW = 13
#: Words of a shard (its last document may go beyond), and distance of the stored suffix positions.
SHARD_WORDS, SAMPLE = 1_000_000, 8
#: Bytes of test text that are sent to the tasks at once, and windows that are looked up at a time.
BLOCK_BYTES, PHRASES = 8 << 20, 1 << 16
#: Maps A-Z to a-z and every other ASCII byte but letters and digits to a space; words are what is left between spaces.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(data: bytes | None) -> list[bytes]:
    return data.translate(FOLD).split() if data else []


class WaveletMatrix:
    """Occurrences of a symbol before a position, for symbols of ``bits`` bits."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.zeros, self.ranks = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level & 1).astype(np.int32)
            rank = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=rank[1:])
            self.ranks.append(rank)
            self.zeros.append(len(symbols) - int(rank[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each ``symbol`` stands before its position."""
        start = np.zeros_like(at)
        for k, (ones, zeros) in enumerate(zip(self.ranks, self.zeros)):
            bit = (symbol >> (self.bits - 1 - k) & 1).astype(bool)
            start = np.where(bit, zeros + ones[start], start - ones[start])
            at = np.where(bit, zeros + ones[at], at - ones[at])
        return at - start

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbol at each position."""
        out = np.zeros_like(at)
        for ones, zeros in zip(self.ranks, self.zeros):
            bit = ones[at + 1] - ones[at]
            out = out << 1 | bit
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return out


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes, ranks doubling until all differ.

    Separators are 0; each of them is a symbol of its own, in the order of its position.
    """
    n = len(text)
    stops = text == 0
    rank = np.where(stops, np.cumsum(stops) - 1, text.astype(np.int64) + n)
    order = np.argsort(rank, kind="stable")
    step = 1
    while True:
        ordered = rank[order]
        dense = np.zeros(n, np.int64)
        dense[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])) if n else 0
        if not n or dense[order[-1]] == n - 1:
            return order
        ahead = np.full(n, 0, np.int64)
        ahead[: n - step] = dense[step:] + 1 if step < n else 0
        rank = dense * (n + 1) + ahead
        order = np.argsort(rank, kind="stable")
        step *= 2


class FMIndex:
    """Backward search in a sequence of symbols from 1; 0 separates, ends it and matches nothing.

    Positions behind a separator are always sampled: steps back never lead across one.
    """

    def __init__(self, text: np.ndarray):
        order = suffix_order(text)
        self.n = len(text)
        last = text[order - 1] if self.n else text  # the symbol before each suffix; the first one wraps to the final 0
        size = int(text.max()) + 1 if self.n else 1
        self.before = np.concatenate([[0], np.bincount(text, minlength=size).cumsum()]).astype(np.int64)
        self.wavelet = WaveletMatrix(last.astype(np.int64), max(1, int(size - 1).bit_length()))
        self.size = size
        self.kept = (order % SAMPLE == 0) | (last == 0)
        self.kept_before = np.concatenate([[0], np.cumsum(self.kept)])
        self.samples = order[self.kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and next row of the suffixes that begin with each phrase (rows of equal length)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((high > low) & (phrases[:, k] > 0) & (phrases[:, k] < self.size))
            dead = np.ones(len(phrases), bool)
            dead[live] = False
            high[dead] = low[dead]
            symbol = phrases[live, k].astype(np.int64)
            low[live] = self.before[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.wavelet.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: steps back to a sampled one are counted."""
        place, steps, open_ = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        at = rows.astype(np.int64)
        while len(open_):
            here = self.kept[at]
            place[open_[here]] = self.samples[self.kept_before[at[here]]] + steps
            open_, at = open_[~here], at[~here]
            if len(open_):
                symbol = self.wavelet.access(at)
                at = self.before[symbol] + self.wavelet.rank(symbol, at)
                steps += 1
        return place


class Phrases:
    """Windows of a block of test items, as symbols of the block's own vocabulary.

    The items' symbols lie in one array; a distinct window is a place in it, with a range in the list of the ids that own it.
    """

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.symbol: dict[bytes, int] = {}
        self.ids = sorted({str(i) for i, tokens in items if i is not None and tokens})
        place = {i: k for k, i in enumerate(self.ids)}
        sizes = np.array([len(tokens) for _, tokens in items], np.int64)
        symbols = (self.symbol.setdefault(w, len(self.symbol) + 1) for _, tokens in items for w in tokens)
        self.codes = np.fromiter(symbols, np.int64, int(sizes.sum()))
        own = np.array([place.get(str(i), -1) if i is not None else -1 for i, _ in items], np.int64)
        begin = np.concatenate([[0], sizes.cumsum()[:-1]]) if len(sizes) else sizes
        self.groups = []
        for n in np.unique(np.minimum(sizes, window)).tolist():
            mine = np.flatnonzero((np.minimum(sizes, window) == n) & (sizes > 0))
            if n and len(mine):
                count = sizes[mine] - n + 1
                starts = np.repeat(begin[mine] - np.concatenate([[0], count.cumsum()[:-1]]), count) + np.arange(count.sum())
                self.groups.append(self._distinct(n, starts, np.repeat(own[mine], count)))
        self.shortest = min((n for n, *_ in self.groups), default=0)

    def _distinct(self, n: int, starts: np.ndarray, own: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """(length, a place of each distinct window, where its owners begin, the owners) by ranks of doubled length."""
        rank, step = self.codes, 1
        while 2 * step <= n:
            ahead = np.zeros_like(rank)
            ahead[:-step] = rank[step:]
            _, rank = np.unique(rank * (len(rank) + len(self.symbol) + 2) + ahead, return_inverse=True)
            step *= 2
        key = rank[starts] * (len(rank) + len(self.symbol) + 2) + rank[starts + n - step]
        _, first, phrase = np.unique(key, return_index=True, return_inverse=True)
        named = own >= 0
        pairs = np.unique(phrase[named] * (len(self.ids) + 1) + own[named])
        phrase = pairs // (len(self.ids) + 1)
        return n, starts[first], np.searchsorted(phrase, np.arange(len(first) + 1)), pairs % (len(self.ids) + 1)

    def occurrences(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, list[int]]]:
        """(document, first word, number of words, items) of every window in the documents of a shard."""
        # only runs of known words that are long enough for a phrase enter the index
        ends = np.cumsum([len(t) + 1 for t in texts])
        whole = np.concatenate([np.append(t, 0) for t in texts])
        stops = np.flatnonzero(whole == 0)
        sizes = np.diff(np.concatenate([[-1], stops])) - 1
        runs = np.flatnonzero(sizes >= max(1, self.shortest))
        if not len(runs) or not self.groups:
            return
        begin, length = stops[runs] - sizes[runs], sizes[runs] + 1
        offset = np.concatenate([[0], length.cumsum()[:-1]])
        place = np.repeat(begin - offset, length) + np.arange(length.sum())
        index = FMIndex(whole[place])
        starts = np.concatenate([[0], ends[:-1]])
        for n, windows, edges, owners in self.groups:
            for some in range(0, len(windows), PHRASES):
                low, high = index.search(self.codes[windows[some : some + PHRASES, None] + np.arange(n)])
                found = np.flatnonzero(high > low)
                if not len(found):
                    continue
                counts = (high - low)[found]
                first = np.concatenate([[0], counts.cumsum()[:-1]])
                rows = np.repeat(low[found] - first, counts) + np.arange(counts.sum())
                at = place[index.locate(rows)]
                doc = np.searchsorted(ends, at, side="right")
                for p, d, a in zip((np.repeat(found, counts) + some).tolist(), doc.tolist(), (at - starts[doc]).tolist()):
                    yield d, a, n, owners[edges[p] : edges[p + 1]].tolist()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching (begin, end) joined."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(a, b) for a, b in out]


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, bytes]]]:
    """The test items in blocks of BLOCK_BYTES (one item may go beyond), fetched one block at a time."""
    block, size = [], 0
    for item, text in benchmark.toLocalIterator():
        data = (text or "").encode()
        if block and size + len(data) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((item, data))
        size += len(data) + 64
    if block:
        yield block


HIT = T.StructType(
    [
        T.StructField("begin_word", T.IntegerType(), False),
        T.StructField("end_word", T.IntegerType(), False),
        T.StructField("begin_byte", T.IntegerType(), False),
        T.StructField("end_byte", T.IntegerType(), False),
    ]
)


def _search(df: DataFrame, column: str, block: list[tuple[object, bytes]], window: int) -> DataFrame:
    """``df`` with ``bench_words``, ``bench_spans`` and ``bench_items`` of one block of test items."""
    new = {"bench_words": T.LongType(), "bench_spans": T.ArrayType(HIT, False), "bench_items": T.ArrayType(T.StringType(), False)}
    columns = [c for c in df.columns if c not in new]
    kept = df.select(*[df[c] for c in columns])
    schema = T.StructType([*kept.schema.fields, *[T.StructField(n, t) for n, t in new.items()]])
    sent = df.sparkSession.sparkContext.broadcast(block)
    spans_type = pa.list_(pa.struct([(f.name, pa.int32()) for f in HIT.fields]))

    def shard(phrases: Phrases, rows: list[pa.RecordBatch], texts: list[np.ndarray], counts: list[int]) -> Iterator[pa.RecordBatch]:
        spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
        items: dict[int, set[int]] = defaultdict(set)
        for doc, start, size, owners in phrases.occurrences(texts):
            spans[doc].append((start, start + size))
            items[doc].update(owners)
        done = 0
        for batch in rows:
            data = as_bytes(batch.column(columns.index(column)))
            found, names = [], []
            for k, raw in enumerate(data, done):
                out = []
                if k in spans:
                    joined = merged(spans[k])
                    places = [m.span() for m in WORD.finditer(raw.translate(FOLD))]
                    out = [dict(zip(HIT.names, (a, b, places[a][0], places[b - 1][1]))) for a, b in joined]
                found.append(out)
                names.append([phrases.ids[i] for i in sorted(items.get(k, ()))])
            total = pa.array(counts[done : done + len(data)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, total, pa.array(found, spans_type), pa.array(names, pa.list_(pa.string()))], names=schema.names
            )
            done += len(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases([(i, words(data)) for i, data in sent.value], window)
        code = phrases.symbol.get
        rows: list[pa.RecordBatch] = []
        texts: list[np.ndarray] = []
        counts: list[int] = []
        total = start = 0
        for batch in batches:
            start = 0
            for k, raw in enumerate(as_bytes(batch.column(columns.index(column)))):
                tokens = words(raw)
                texts.append(np.fromiter((code(w, 0) for w in tokens), np.int64, len(tokens)))
                counts.append(len(tokens))
                total += len(tokens)
                if total >= SHARD_WORDS:
                    rows.append(batch.slice(start, k + 1 - start))
                    yield from shard(phrases, rows, texts, counts)
                    rows, texts, counts, total, start = [], [], [], 0, k + 1
            if start < batch.num_rows:
                rows.append(batch.slice(start))
        if rows:
            yield from shard(phrases, rows, texts, counts)

    return kept.mapInArrow(run, schema)


def find(documents: DataFrame, benchmark: DataFrame, column: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``documents`` with the passages that they share with the test items.

    ``bench_words`` is the number of words, ``bench_spans`` the merged removal spans in
    words and in bytes of the UTF-8 text, ``bench_items`` the ids of the items that have
    a window in the document, sorted as text. A window is ``window`` words of an item, or all
    words of an item that has fewer. Null and empty texts have no words and no spans; items
    without words, or none at all, match nothing. Rows of one item id are windows of one item. Items whose id is
    null give spans, but no name.
    Repeated rows are searched each for itself. Columns of these names are replaced.

    A test set of more than one block is searched block by block; the result of each is
    stored and the lists are merged.
    """
    columns = [c for c in documents.columns if c not in ("bench_words", "bench_spans", "bench_items")]
    searched = None
    for block in _blocks(benchmark.select(F.col(item).cast("string"), F.col(item_text))):
        if searched is None:
            searched = _search(documents, column, block, window)
            continue
        before = rows_of(materialize(searched), column)
        new = _search(before, "text", block, window)
        old = F.col("row")
        searched = new.select(
            *columns_of(columns, column),
            "bench_words",
            _joined(F.concat(old["bench_spans"], F.col("bench_spans"))).alias("bench_spans"),
            F.array_sort(F.array_distinct(F.concat(old["bench_items"], F.col("bench_items")))).alias("bench_items"),
        )
    return _search(documents, column, [], window) if searched is None else searched


def _joined(spans):
    """Spans of two blocks in order, overlapping and touching ones merged."""
    none = F.lit([]).cast(T.ArrayType(HIT, False))

    def add(done, span):
        last = F.element_at(done, -1)
        grown = F.struct(
            last["begin_word"].alias("begin_word"),
            F.greatest(last["end_word"], span["end_word"]).alias("end_word"),
            last["begin_byte"].alias("begin_byte"),
            F.greatest(last["end_byte"], span["end_byte"]).alias("end_byte"),
        )
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end_word"] >= span["begin_word"])
        return F.when(touches, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(grown))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), none, add)


def hit_words():
    """Number of words inside the spans."""
    return F.aggregate("bench_spans", F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["begin_word"])


def contaminated(share: int = 20):
    """Whether at least one ``share``-th of the words is hit."""
    return (hit_words() > 0) & (share * hit_words() >= F.col("bench_words"))


def remove_spans(df: DataFrame, column: str = "text") -> DataFrame:
    """``df`` with the bytes of ``bench_spans`` taken out of ``column``; other texts stay as they are."""
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, spans = columns.index(column), columns.index("bench_spans")
        for batch in batches:
            texts = as_bytes(batch.column(place))
            for k, found in enumerate(batch.column(spans).to_pylist()):
                for span in reversed(found or []):
                    texts[k] = texts[k][: span["begin_byte"]] + texts[k][span["end_byte"] :]
            arrays = list(batch.columns)
            arrays[place] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return df.mapInArrow(run, df.schema)


def names_digest(names: list[str]) -> str:
    """The digest that the query gives for a list of item names; for tests."""
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
