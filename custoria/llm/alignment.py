"""Alignment of two tokenizers over the bytes of one text, and how common each link of ids is.

Tokenizer A reads a space and the text, tokenizer B the text, to which it adds the space itself.
Offsets where tokens of both end cut the text into groups; a link is a pair of an A and a B token
whose bytes overlap. A table made once gives each A id the B id with the same bytes. Links of
such identical ids, which are all links of nearly all one-to-one groups, are counted per task in
one vector as long as the vocabulary. Only the other links, from irregular groups, are counted as
(A id, B id) pairs and shuffled: each block of documents sends every pair once with the number of
its documents that hold it, and gets the total over all blocks back.

Neither tokenizer lets a token cross a single space between two other characters (checked in the
model of B), so each piece of text between such spaces is encoded and aligned once per task and kept.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custoria.llm.common import columns_of, rows_of
from custoria.llm.sentencepiece import SPACE, _wire
from custoria.session import materialize

#: Bytes of text in a block; its last document may go beyond.
BLOCK = 8 << 20
#: Pieces of text kept with their alignment per worker, and characters of them.
KEPT, KEPT_CHARS = 300_000, 8 << 20
#: Rows and characters of one slice of work.
ROWS, CHARS = 512, 4 << 20
#: Entries of the identity vector that travel as one row.
SLICE = 4096
ADDED = ["n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Pieces that are encoded as one text.
TOGETHER = 1000
# Fixed value: the pattern by which byte-level vocabularies split text into words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose classes are the same in every version of Unicode.
LATIN = "\u0250"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it can be
    printed, else the next unused one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _odd(piece: str) -> bool:
    return not piece or piece[0].isspace() or piece[-1].isspace()


class Aligner:
    """Both tokenizers, the bytes of their ids, and the pieces of text aligned so far."""

    def __init__(self, a_file: str, b_file: bytes, shown: bool = True):
        self.a = tokenizers.Tokenizer.from_str(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.shown = shown
        letters = byte_letters()
        added = {t["id"] for t in json.loads(a_file).get("added_tokens", [])}
        words = {i: w for w, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [b""] * (max(words, default=-1) + 1)
        for i, word in words.items():
            self.a_bytes[i] = word.encode() if i in added else bytes(letters[c] for c in word)
        ids, piece = range(self.b.get_piece_size()), self.b.id_to_piece
        self.b_bytes = [bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace(SPACE, " ").encode() for i in ids]
        usual = [i for i in ids if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i))]
        # a piece of its own goes before a byte
        same = {self.b_bytes[i]: i for i in sorted(usual, key=self.b.is_byte, reverse=True)}
        self.same = np.array([same.get(d, -1) for d in self.a_bytes], np.int64)
        self.a_len = np.array([len(d) for d in self.a_bytes], np.int64)
        self.b_len = np.array([len(d) for d in self.b_bytes], np.int64)
        self.n_b = len(self.b_bytes)
        spec, trained = {}, {}
        for field, value in _wire(b_file):
            spec, trained = (dict(_wire(value)) if field == 3 else spec), (dict(_wire(value)) if field == 2 else trained)
        # fields of the model file: character map 2, added space 3, collapsed spaces 4, spaces behind words 24
        plain = not spec.get(2) and spec.get(3, 1) and not spec.get(4, 1) and not trained.get(24, 0)
        self.cuts = bool(plain) and not any(SPACE in piece(i).lstrip(SPACE) for i in usual)
        self.a_text = np.array([[f"{i},", f"{i}|"] for i in range(len(self.a_bytes))], object)
        self.b_text = np.array([[f"{i},", f"{i};"] for i in range(self.n_b)], object)
        self.quick = self._quick(json.loads(a_file))
        self.forget()

    def _quick(self, file: dict):
        """A faster encoder of the same vocabulary and merges for Latin text, where the file is of the form that it knows."""
        at_words, model = file.get("pre_tokenizer") or {}, file["model"]
        plain = at_words.get("type") == "ByteLevel" and at_words.get("use_regex") and not at_words.get("add_prefix_space") and not file.get("normalizer")
        merged = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in model.get("merges", ())]
        vocabulary = model.get("vocab", {})
        order = sorted(vocabulary, key=vocabulary.get)
        if not plain or order[256:] != merged or len({*map(len, order[:256])}) != 1 or model.get("ignore_merges"):
            return None
        ranks = {self.a_bytes[vocabulary[w]]: vocabulary[w] for w in order}
        return tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.texts: list[str] = []
        self.numbers = np.zeros((1024, 4), np.int64)  # A tokens, B tokens, groups, 1 if valid
        self.codes = np.zeros(8192, np.int64)
        self.starts = np.zeros(1025, np.int64)
        self.chars = self.dropped = 0

    def pieces(self, text: str) -> tuple[list[str], list[int | None]]:
        """The pieces under which ``text`` is kept, and their places. Most texts can be split at every space; one with a
        space at an end or beside other white space is cut where CUT says, and such a piece is kept behind a space."""
        found = text.split(" ") if self.cuts else [" " + text]
        at = list(map(self.place.get, found))
        if self.cuts and None in at and any(_odd(p) for p, i in zip(found, at) if i is None):
            found = [" " + p if _odd(p) else p for p in CUT.split(text)]
            at = list(map(self.place.get, found))
        return found, at

    def learn(self, new: list[str]) -> None:
        """Align pieces that were not met before: many at once, in one text, or each for itself."""
        usual = [p for p in new if p[0] != " "] if self.cuts else []
        latin = [p for p in usual if max(p) < LATIN] if self.quick else []
        others = [p for p in usual if not max(p) < LATIN] if self.quick else usual
        single = [[p] for p in new if not self.cuts or p[0] == " "]
        for pieces, quick in ((latin, True), (others, False)):
            texts = [pieces[i : i + TOGETHER] for i in range(0, len(pieces), TOGETHER)]
            while texts:
                texts = [[p] for text in self._learn(texts, quick) for p in text]
        if single:
            self._learn(single, False)

    def _learn(self, texts: list[list[str]], quick: bool) -> list[list[str]]:
        """Align texts made of pieces; those of several pieces that do not come back byte by byte are returned."""
        joined = [" ".join(pieces).removeprefix(" ") if pieces[0][0] == " " else " ".join(pieces) for pieces in texts]
        data = [b" " + t.encode() for t in joined]
        if quick:
            a_ids = [self.quick(" " + t) for t in joined]
        else:
            a_ids = [e.ids for e in self.a.encode_batch([" " + t for t in joined], add_special_tokens=False)]
        b_ids = self.b.encode(joined, num_threads=1)
        a_bytes, b_bytes = self.a_bytes, self.b_bytes
        valid = [b"".join([a_bytes[i] for i in x]) == b"".join([b_bytes[i] for i in y]) == d for x, y, d in zip(a_ids, b_ids, data)]
        bad = [t for t, ok in zip(texts, valid) if not ok and len(t) > 1]
        rest = [i for i, (t, ok) in enumerate(zip(texts, valid)) if ok or len(t) == 1]
        new = list(chain.from_iterable(texts[i] for i in rest))
        good = np.repeat([valid[i] for i in rest], [len(texts[i]) for i in rest]).astype(bool)
        a, b = (np.fromiter(chain.from_iterable(x[i] for i in rest if valid[i]), np.int64) for x in (a_ids, b_ids))
        # offsets in all texts one behind the other; every piece begins with a space
        a_end, b_end = self.a_len[a].cumsum(), self.b_len[b].cumsum()
        sizes = np.fromiter((len(p.encode()) + (p[0] != " ") for p in new), np.int64, len(new))
        piece_end = np.where(good, sizes, 0).cumsum()
        every = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        twice = every[1:] == every[:-1]
        common, every = every[1:][twice], every[np.append(np.ones(min(1, len(every)), bool), ~twice)]
        codes = a[np.searchsorted(a_end, every)] * self.n_b + b[np.searchsorted(b_end, every)]
        groups, links, n_a, n_b = (np.diff(np.searchsorted(x, piece_end, "right"), prepend=0) for x in (common, every, a_end, b_end))
        out = np.empty(len(a) + len(b) if self.shown else 0, object)
        if len(out):
            # tokens in the order of the text form: those of A and then those of B, group by group
            a_through, b_through = np.searchsorted(a_end, common, "right"), np.searchsorted(b_end, common, "right")
            a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
            before = np.concatenate([[0], b_through])[a_group]
            out[np.arange(len(a)) + before] = self.a_text[a, (common[a_group] == a_end).astype(int)]
            out[np.arange(len(b)) + a_through[b_group]] = self.b_text[b, (common[b_group] == b_end).astype(int)]
        ends = (n_a + n_b).cumsum().tolist() if self.shown else [0] * len(new)
        shown = out.tolist()
        known, more = len(self.texts), len(new)
        self.place.update(zip(new, range(known, known + more)))
        self.texts.extend(["".join(shown[s:e])[:-1] for s, e in zip([0, *ends], ends)])
        while len(self.numbers) < known + more:
            self.numbers = np.concatenate([self.numbers, np.zeros_like(self.numbers)])
            self.starts = np.concatenate([self.starts, np.zeros(len(self.starts) - 1, np.int64)])
        while len(self.codes) < self.starts[known] + len(codes):
            self.codes = np.concatenate([self.codes, np.zeros_like(self.codes)])
        self.numbers[known : known + more] = np.stack([n_a, n_b, groups, good], 1)
        self.codes[self.starts[known] : self.starts[known] + len(codes)] = codes
        self.starts[known + 1 : known + more + 1] = self.starts[known] + links.cumsum()
        self.chars += sum(map(len, new))
        return bad

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str] | None, np.ndarray, np.ndarray, np.ndarray]:
        """Per text the numbers of A tokens, B tokens, groups and links, and the groups as text if they are
        ``shown``; per (text, distinct link) the text's place, the link's code and how often it occurs."""
        cut, places = zip(*(self.pieces(t) if t else ([], []) for t in texts)) if texts else ((), ())
        new = list({p: None for pieces, at in zip(cut, places) if None in at for p, i in zip(pieces, at) if i is None})
        full = len(self.texts) > KEPT or self.chars > KEPT_CHARS
        mark = len(self.texts), self.chars
        if new:
            self.learn(new)
        places = [list(map(self.place.__getitem__, pieces)) if None in at else at for pieces, at in zip(cut, places)]
        sizes = np.fromiter(map(len, places), np.int64, len(places))
        at = np.fromiter(chain.from_iterable(places), np.int64, sizes.sum())
        owner = np.repeat(np.arange(len(cut)), sizes)
        invalid = np.bincount(owner, self.numbers[at, 3] == 0, len(cut)) > 0
        keep = ~invalid[owner]
        at, owner = at[keep], owner[keep]
        counts = np.zeros((len(cut), 4), np.int64)
        for i in range(3):
            counts[:, i] = np.bincount(owner, self.numbers[at, i], len(cut))
        first, n = self.starts[at], self.starts[at + 1] - self.starts[at]
        spread = np.repeat(first - np.concatenate([[0], n.cumsum()[:-1]]), n) + np.arange(n.sum())
        space = len(self.a_bytes) * self.n_b
        keys, often = np.unique(np.repeat(owner, n) * space + self.codes[spread], return_counts=True)
        counts[:, 3] = np.bincount(owner, n, len(cut))
        groups = None
        if self.shown:
            ends = np.searchsorted(owner, np.arange(len(cut)), "right").tolist()
            texts_of, at = self.texts, at.tolist()
            groups = [";".join([texts_of[i] for i in at[s:e]]) for s, e in zip([0, *ends], ends)]
        if full:  # what is kept are the pieces met first, mostly the frequent ones
            for piece in new:
                del self.place[piece]
            del self.texts[mark[0] :]
            self.chars = mark[1]
            self.dropped += len(new)
            if self.dropped > 4 * KEPT:
                self.forget()
        return counts, groups, keys // space, keys % space, often


def aligner(files, shown: bool) -> Aligner:
    """The tokenizers in the broadcast ``files``, made once in each worker process, which keeps one of them."""
    kept = sys.modules.setdefault("custoria_worker_aligners", ModuleType("custoria_worker_aligners")).__dict__
    key = (*files.value[2], shown)
    if kept.get("key") != key:
        kept.update(key=key, made=Aligner(*files.value[:2], shown))
    return kept["made"]


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of bounded number and size."""
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and (i - start >= ROWS or held + size > CHARS):
            yield start, i
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield start, len(sizes)


def _files(df: DataFrame, a_path: str, b_path: str):
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return df.sparkSession.sparkContext.broadcast((a.read(), b.read(), (a_path, b_path)))


def _list(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], sizes.cumsum()]), pa.int32()), pa.array(values, kind))


def align(df: DataFrame, a_path: str, b_path: str, column: str = "text") -> DataFrame:
    """``df`` with the numbers of A tokens, B tokens, groups and links, the ``groups`` as text
    (``a1,a2|b1;a3|b2,b3``, decimal ids in order) and the distinct links as ``link_a``, ``link_b`` with ``link_n``,
    how often each occurs. Nothing is shuffled.

    ``a_path`` is a byte-level vocabulary in JSON, ``b_path`` a piece model; the driver reads both and
    broadcasts them. Texts that are null or empty, or that one of them does not give back byte by
    byte, have no tokens: zeros, an empty text and empty lists. Columns of these names are replaced.
    """
    new = ["n_a", "n_b", "n_groups", "n_links", "groups", "link_a", "link_b", "link_n"]
    base = df.drop(*new)
    named = rows_of(base, column)
    files = _files(df, a_path, b_path)
    kinds = [T.LongType()] * 4 + [T.StringType()] + [T.ArrayType(T.IntegerType())] * 2 + [T.ArrayType(T.LongType())]
    schema = T.StructType([*named.schema.fields, *(T.StructField(n, k) for n, k in zip(new, kinds))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(files, True)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, end in _slices([len(t or "") for t in texts]):
                counts, groups, owner, code, often = tool.align(texts[start:end])
                sizes = np.bincount(owner, minlength=end - start)
                lists = [_list(x, sizes, k) for x, k in ((code // tool.n_b, pa.int32()), (code % tool.n_b, pa.int32()), (often, pa.int64()))]
                numbers = [pa.array(counts[:, i]) for i in range(4)]
                yield pa.RecordBatch.from_arrays([*batch.slice(start, end - start).columns, *numbers, pa.array(groups, pa.string()), *lists], names=schema.names)

    found = named.mapInArrow(run, schema)
    return found.select(*columns_of(base.columns, column), *new)


def score(df: DataFrame, a_path: str, b_path: str, column: str = "text") -> DataFrame:
    """``df`` with the columns of ``align`` but for the lists of links, with ``n_best``, the links whose
    pair of ids stands in the most documents of all pairs of its A id (ties included), and
    ``count_sum``, the number of documents with the pair, summed over the links.

    Documents lie in stored blocks of bounded size. The identity vector and the highest count per A id are as long
    as the vocabulary of A and are all that the driver holds; a pair travels once per block, so no
    pair is a hot key. Repeated rows count as documents of their own, null and invalid texts as in
    ``align``; an empty table gives an empty one. Columns of the new names are replaced.
    """
    spark = df.sparkSession
    base = df.drop(*ADDED)
    named = rows_of(base, column)
    files = _files(df, a_path, b_path)
    fields = [*(T.StructField(f.name, f.dataType) for f in named.schema.fields), T.StructField("block", T.LongType())]
    fields += [T.StructField(n, T.ArrayType(T.LongType())) for n in ("codes", "docs")]
    schema = T.StructType(fields)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of documents with their block, after each block its irregular links, at the end the identity vector."""
        tool = aligner(files, False)
        block, size = TaskContext.get().partitionId() << 24, 0
        vector = np.zeros(len(tool.a_bytes), np.int64)
        held: list[np.ndarray] = []

        def rest(number: int, codes: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
            none = [pa.nulls(1, f.type) for f in kinds]
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (codes, docs)]
            return pa.RecordBatch.from_arrays([*none, pa.array([number], pa.int64()), *lists], names=schema.names)

        def merged() -> list[np.ndarray]:
            codes, back = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            return [codes, np.bincount(back, np.concatenate([x[1] for x in held])).astype(np.int64)]

        kinds = None
        for batch in batches:
            kinds = list(batch.schema)
            texts = batch.column("text").to_pylist()
            for start, end in _slices([len(t or "") for t in texts]):
                if size >= BLOCK:
                    yield rest(block, *merged())
                    block, size, held = block + 1, 0, []
                _, _, _, code, _ = tool.align(texts[start:end])
                a = code // tool.n_b
                same = tool.same[a] == code % tool.n_b
                vector += np.bincount(a[same], minlength=len(vector))
                held.append(np.unique(code[~same], return_counts=True))
                if len(held) >= 16:
                    held = [merged()]
                size += sum(len(t or "") for t in texts[start:end])
                part, n = batch.slice(start, end - start), end - start
                empty = pa.nulls(n, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(n, block)), empty, empty], names=schema.names)
        if held:
            yield rest(block, *merged())
        for i in range(0, len(vector), SLICE) if kinds else ():
            yield rest(-1 - i, np.zeros(0, np.int64), vector[i : i + SLICE])

    filled = materialize(named.mapInArrow(fill, schema))
    vectors = filled.where("block < 0").select("block", F.posexplode("docs").alias("at", "docs"))
    vectors = vectors.groupBy((F.lit(-1) - F.col("block") + F.col("at")).alias("a")).agg(F.sum("docs").alias("docs"))
    asked = filled.where("block >= 0 AND codes IS NOT NULL").select(F.col("block").alias("place"), F.explode(F.arrays_zip("codes", "docs")).alias("x"))
    asked = asked.select("place", F.col("x.codes").alias("code"), F.col("x.docs").alias("docs"))
    totals = materialize(asked.groupBy("code").agg(F.sum("docs").alias("total")))
    here = Aligner(*files.value[:2], False)
    width = here.n_b
    identity = np.zeros(len(here.a_bytes), np.int64)
    for row in vectors.where("docs > 0").collect():
        identity[row.a] = row.docs
    best = identity.copy()
    for row in totals.groupBy(F.expr(f"code div {width}").alias("a")).agg(F.max("total").alias("most")).collect():
        best[row.a] = max(best[row.a], row.most)
    shared = spark.sparkContext.broadcast((identity, best))
    answers = asked.join(totals, "code").select("place", "code", "total")
    docs = filled.where("block >= 0 AND codes IS NULL").drop("codes", "docs")
    out = T.StructType([*(filled.schema[c] for c in named.columns), *(T.StructField(n, T.StringType() if n == "groups" else T.LongType()) for n in ADDED)])

    carried = named.columns

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        tool = aligner(files, True)
        identity, best = shared.value
        codes, first = np.unique(right.column("code").to_numpy(), return_index=True)
        total = right.column("total").to_numpy()[first]
        made = []
        texts = left.column("text").to_pylist()
        for start, end in list(_slices([len(t or "") for t in texts])) or [(0, 0)]:
            counts, groups, owner, code, often = tool.align(texts[start:end])
            a = code // width
            same = tool.same[a] == code % width
            held = np.zeros(len(code), np.int64)
            held[same] = identity[a[same]]
            held[~same] = total[np.searchsorted(codes, code[~same])]
            best_here = np.bincount(owner, np.where(held == best[a], often, 0), end - start).astype(np.int64)
            summed = np.zeros(end - start, np.int64)
            np.add.at(summed, owner, held * often)
            part = left.slice(start, end - start)
            numbers = [pa.array(counts[:, i]) for i in range(4)]
            made.append(pa.table([*(part.column(c) for c in carried), *numbers, pa.array(groups, pa.string()), pa.array(best_here), pa.array(summed)], names=out.names))
        return pa.concat_tables(made)

    counted = docs.groupBy("block").cogroup(answers.groupBy("place")).applyInArrow(count, out)
    return counted.select(*columns_of(base.columns, column), *ADDED)
