"""Offset-preserving SentencePiece encoding, and decoding.

The text is normalised by the longest matching prefix of the model's compiled character
map; every normalised byte keeps the place in the text that it came from, so that each
piece is projected to a span of the original bytes. The pieces are merged by their
scores as the model prescribes. Everything is worked out in the tasks that read the text,
with no shuffle.
"""

from __future__ import annotations

import heapq
import re
import struct
import sys
from itertools import groupby
from operator import add
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from custoria.llm.common import as_bytes, map_batches

SPACE = "▁"
#: Segments kept with their pieces per task, and the longest segment that is kept.
CACHED, CACHED_CHARS = 400_000, 48
# Fixed values of the model file: piece types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _wire(data: bytes):
    """(field, value) of a protocol-buffer message; values are numbers or bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at : at + size]
            at += size


def _pair(piece: int, size: int) -> bytes:
    return struct.pack("<ii", piece, size)


class CharacterMap:
    """The compiled map: a double-array trie of prefixes, each with its replacement."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.texts = blob[4 + size :]
        self.starts = {0}
        if self.units:
            self.starts = set(range(256))

    @staticmethod
    def _step(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest entry that ``data`` has at ``at``."""
        if not self.units:
            return None
        node, found = self._step(self.units[0]), None
        for used, byte in enumerate(data[at:], 1):
            node ^= byte
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._step(unit)
            if unit >> 8 & 1:
                found = used, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.texts[start : self.texts.index(b"\0", start)]


class Model:
    """What a BPE model file holds, and encoding of one text by it."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = file.read()
        self.pieces, scores, kinds = [], [], []
        blob, dummy, collapse, escape, suffix, kind, self.fallback = b"", 1, 1, 1, 0, 1, False
        self.unk_surface = " ⁇ "
        for field, value in _wire(data):
            if field == 1:
                entry = dict(_wire(value))
                self.pieces.append(entry.get(1, b"").decode())
                scores.append(struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0)
                kinds.append(entry.get(3, NORMAL))
            elif field == 2:
                spec = dict(_wire(value))
                kind, suffix, self.fallback = spec.get(3, 1), spec.get(24, 0), bool(spec.get(35, 0))
                self.unk_surface = spec[44].decode() if 44 in spec else self.unk_surface
            elif field == 3:
                spec = dict(_wire(value))
                blob, dummy, collapse, escape = spec.get(2, b""), spec.get(3, 1), spec.get(4, 1), spec.get(5, 1)
        if kind != 2 or suffix or not escape or USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("only BPE models with leading, escaped spaces and without user-defined or unused pieces are supported")
        if any(SPACE in p.lstrip(SPACE) for p, k in zip(self.pieces, kinds) if k == NORMAL):
            raise ValueError("a piece spans two words; texts can't be cut at spaces")
        self.map, self.dummy, self.collapse = CharacterMap(blob), bool(dummy), bool(collapse)
        self.identity = not blob and not collapse
        self.kinds = kinds
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == NORMAL}
        self.ranks = {p: -scores[i] for p, i in self.ids.items()}
        self.unk = kinds.index(UNKNOWN)
        self.controls = [i for i, k in enumerate(kinds) if k == CONTROL]
        self.eos = self.pieces.index("</s>")
        self.bytes_at = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == BYTE}
        self.byte_of = {i: bytes([b]) for b, i in self.bytes_at.items()}
        self.packed = {p: _pair(i, len(p.encode())) for p, i in self.ids.items()}
        self.side = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, segment: str) -> list[str]:
        """The segment's pieces: the adjacent pair with the best score merges first, the leftmost of equals."""
        if len(segment) > 100:
            return self._merged_by_heap(segment)
        parts, ranks = list(segment), self.ranks
        pairs = [ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) != NEVER:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NEVER)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], NEVER)
        return parts

    def _merged_by_heap(self, segment: str) -> list[str]:
        """The same for long segments, where looking through all pairs for each merge is too slow."""
        parts: list[str | None] = list(segment)
        n = len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (rank := self.ranks.get(both := parts[left] + parts[right])) is not None:
                heapq.heappush(heap, (rank, left, right, both))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, left, right, both = heapq.heappop(heap)
            if parts[left] is None or parts[right] is None or after[left] != right or parts[left] + parts[right] != both:
                continue
            parts[left], parts[right] = both, None
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p is not None]

    def _unknown(self, piece: str) -> bytes:
        """Entries of a character without a piece: its bytes, of which the last one covers it, or the unknown id."""
        data = piece.encode()
        if not self.fallback:
            return _pair(self.unk, len(data))
        return b"".join([_pair(self.bytes_at[b], len(data) * (k == len(data))) for k, b in enumerate(data, 1)])

    def segment(self, segment: str) -> bytes:
        """Pairs of int32: the ids of a segment and the number of normalised bytes that each one covers.

        Where no piece holds the two characters around a place, nothing merges across it, so
        the parts are encoded, and kept, on their own. Two generations of parts are kept.
        """
        if (known := self.new.get(segment)) is not None:
            return known
        if (found := self.old.get(segment)) is None:
            side, packed = self.side, self.packed
            cuts = [i for i, pair in enumerate(map(add, segment, segment[1:]), 1) if pair not in side]
            if cuts:
                found = b"".join([self.segment(segment[a:b]) for a, b in zip([0, *cuts], [*cuts, len(segment)])])
            else:
                found = b"".join([packed.get(p) or self._unknown(p) for p in self.merged(segment)])
        if len(segment) <= CACHED_CHARS:
            if len(self.new) >= CACHED:
                self.old, self.new = self.new, {}
            self.new[segment] = found
        return found

    def normalised(self, data: bytes) -> tuple[str, np.ndarray]:
        """The normalised text, and for each boundary between its bytes the place in ``data``."""
        out, places, at, space = [], [], 0, SPACE.encode()
        text_end = len(data)
        while at < text_end:
            hit = self.map.longest(data, at)
            if hit is None:
                lead = data[at]
                used = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                new = data[at : at + used]
            else:
                used, new = hit
            out.append((new, at))
            at += used
        ends: list[tuple[bytes, int, int]] = [(new, a, out[i + 1][1] if i + 1 < len(out) else text_end) for i, (new, a) in enumerate(out)]
        if self.collapse:
            squeezed, last = [], True
            for new, a, b in ends:
                if last:
                    new = new.lstrip(b" ")
                last = new.endswith(b" ") if new else last
                squeezed.append((new, a, b))
            while squeezed and not squeezed[-1][0].rstrip(b" "):
                squeezed.pop()
            if squeezed:
                squeezed[-1] = (squeezed[-1][0].rstrip(b" "), *squeezed[-1][1:])
            ends = [x for x in squeezed if x[0]]
        if not any(new for new, _, _ in ends):
            return "", np.zeros(1, np.int64)
        pieces: list[bytes] = []
        if self.dummy:
            pieces.append(space)
            places += [ends[0][1]] * len(space)
        stop = 0
        for new, a, stop in ends:
            new = new.replace(b" ", space)
            pieces.append(new)
            places += [a] * len(new)
        return b"".join(pieces).decode("utf-8", "replace"), np.array([*places, stop], np.int64)

    def encode(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a text in UTF-8, and the first and the next byte of each piece."""
        if not data:
            nothing = np.zeros(0, np.int32)
            return nothing, nothing, nothing
        if self.identity:
            text = data.decode()
            found = map(self.segment, SEGMENT.findall((SPACE if self.dummy else "") + text.replace(" ", SPACE)))
        else:
            text, places = self.normalised(data)
            found = map(self.segment, SEGMENT.findall(text))
        pairs = np.frombuffer(b"".join(found), np.int32).reshape(-1, 2)
        ids, ends = pairs[:, 0], pairs[:, 1].cumsum(dtype=np.int64)
        begins = np.concatenate([np.zeros(1, np.int64), ends])[:-1] if len(ends) else ends
        if self.identity:
            # only spaces changed their size: three bytes stand for one
            if b" " in data or self.dummy:
                raw = np.frombuffer(data, np.uint8)
                width = np.where(raw == 32, 3, 1)
                if self.dummy:
                    width = np.concatenate([[3], width])
                edges = np.concatenate([[0], width.cumsum()])
                begins, ends = np.searchsorted(edges, begins), np.searchsorted(edges, ends)
                if self.dummy:
                    begins, ends = np.maximum(begins - 1, 0), np.maximum(ends - 1, 0)
        else:
            begins, ends = places[begins], places[ends]
        return ids, begins.astype(np.int32), ends.astype(np.int32)

    @property
    def surfaces(self) -> list[bytes]:
        """What each id adds to a decoded text, bytes of a fallback aside."""
        if not hasattr(self, "_surfaces"):
            self._surfaces = [
                b"" if k == CONTROL else self.unk_surface.encode() if k == UNKNOWN else self.byte_of[i] if k == BYTE else p.replace(SPACE, " ").encode()
                for i, (p, k) in enumerate(zip(self.pieces, self.kinds))
            ]
        return self._surfaces

    def decode(self, ids: list[int]) -> bytes:
        """The text in UTF-8; bytes that form no character become U+FFFD each."""
        surfaces, kinds = self.surfaces, self.kinds
        first = next((i for i, x in enumerate(ids) if kinds[x] != CONTROL), None)
        if first is None:
            return b""
        out = b"".join([surfaces[i] for i in ids])
        try:
            out.decode()
            whole = not any(map(ids[:-1].count, self.controls))
        except UnicodeDecodeError:
            whole = False
        if not whole:
            # only bytes that stand side by side form characters
            runs = groupby(ids, key=lambda i: kinds[i] == BYTE)
            out = b"".join([_mended(b"".join([surfaces[i] for i in run])) if raw else b"".join([surfaces[i] for i in run]) for raw, run in runs])
        if (self.dummy or self.collapse) and kinds[ids[first]] == NORMAL and out.startswith(b" "):
            out = out.lstrip(b" ") if self.collapse else out[1:]
        return out


NEVER = float("inf")
SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def _mended(data: bytes) -> bytes:
    """``data`` with U+FFFD in place of each byte that starts no character."""
    out, at = [], 0
    while at < len(data):
        lead = data[at]
        used = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
        try:
            good = used and data[at : at + used].decode()
        except UnicodeDecodeError:
            good = ""
        out.append(data[at : at + used] if good else "�".encode())
        at += used if good else 1
    return b"".join(out)


def model(path: str) -> Model:
    """The model, read once in each worker process; tasks get this function by value, so it is kept beside it."""
    kept = sys.modules.setdefault("custoria_worker_models", ModuleType("custoria_worker_models")).__dict__
    if path not in kept:
        kept[path] = Model(path)
    return kept[path]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    sizes = np.array([0, *map(len, arrays)], np.int64).cumsum().astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(values, pa.int32()))


def encode(df: DataFrame, path: str, column: str = "text", end: bool = True, decoded: bool = False) -> DataFrame:
    """``df`` with ``piece_ids``, ``piece_begins``, ``piece_ends`` (and ``decoded`` text).

    The spans are byte offsets into the UTF-8 text, the end exclusive; pieces that a
    normalisation made out of nothing, the byte pieces before a character's last one and the
    end id are empty spans. ``path`` names the model file on every worker; a column of
    these names is replaced. A null text counts as empty: only the end id. Texts of any
    length are cut at spaces, where no piece crosses, so memory follows the longest text.
    """
    new = ["piece_ids", "piece_begins", "piece_ends", *["decoded"] * decoded]
    columns = [c for c in df.columns if c not in new]

    def added(batch: pa.RecordBatch) -> list[pa.Array]:
        m = model(path)
        ids, begins, ends, texts = [], [], [], []
        for data in as_bytes(batch.column(columns.index(column))):
            data = data or b""
            i, b, e = m.encode(data)
            if end:
                i, b, e = (np.append(x, y).astype(np.int32) for x, y in ((i, m.eos), (b, len(data)), (e, len(data))))
            ids.append(i)
            begins.append(b)
            ends.append(e)
            if decoded:
                texts.append(m.decode(i.tolist()))
        out = [_lists(ids), _lists(begins), _lists(ends)]
        return out + [pa.array(texts, pa.binary()).cast(pa.string())] * decoded

    numbers = T.ArrayType(T.IntegerType(), False)
    fields = [T.StructField(n, numbers) for n in new[:3]] + [T.StructField("decoded", T.StringType())] * decoded
    return map_batches(df, columns, added, fields)


def decode(df: DataFrame, path: str, column: str = "piece_ids") -> DataFrame:
    """``df`` with the text ``decoded`` from the ids in ``column``; null ids give an empty text."""
    columns = [c for c in df.columns if c != "decoded"]

    def added(batch: pa.RecordBatch) -> list[pa.Array]:
        m = model(path)
        rows = batch.column(columns.index(column)).to_pylist()
        return [pa.array([m.decode(r or []) for r in rows], pa.binary()).cast(pa.string())]

    return map_batches(df, columns, added, [T.StructField("decoded", T.StringType())])
