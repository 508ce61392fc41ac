"""Encoding against the library, decoding as a round trip, spans by what they cover."""

import random

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from custoria.llm import sentencepiece as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", " ", "  ", "▁", "\n", "the ", " of", "é", "🙂", "\x00", "</s>", "<0x41>", "世", "́", "    ", "\t", "x" * 130, "zq", "�", "<unk>", "antidisestablish"]


def test_ids_spans_and_text_are_the_library_s():
    mine, theirs, rng = S.Model(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH), random.Random(1)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.choice([0, 3, 25, 60])))
        want = theirs.encode(text, add_eos=True)
        ids, begins, ends = mine.encode(text.encode())
        assert [*ids.tolist(), 2] == want
        assert mine.decode(want) == theirs.decode(want).encode()
        assert [(p.begin, p.end) for p in theirs.encode(text, return_type="proto").pieces] == list(zip(begins.tolist(), ends.tolist()))


def test_decoding_of_any_ids():
    mine, theirs, rng = S.Model(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH), random.Random(2)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(32000), 28705, 0, 1, 2]) for _ in range(rng.randint(0, 12))]
        assert mine.decode(ids) == theirs.decode(ids).encode()


def test_table(spark, docs, edges):
    theirs = sentencepiece.SentencePieceProcessor(model_file=PATH)
    coded = S.encode(docs(edges), PATH, decoded=True)
    rows = coded.collect()
    assert len(rows) == len(edges) and "kept" in coded.columns
    for r in rows:
        assert r.piece_ids == theirs.encode(r.text or "", add_eos=True)
        assert r.decoded == theirs.decode(r.piece_ids)
    again = S.decode(coded.drop("decoded"), PATH).select("decoded").exceptAll(coded.select("decoded"))
    assert again.count() == 0
    assert S.encode(docs([(1, "x")]).where("false"), PATH).count() == 0


def charsmap(entries):
    """A compiled map of a few prefixes: each node's children get a free place of their own."""
    import struct

    texts, values = b"", {}
    for key, new in entries.items():
        values[key] = len(texts)
        texts += new + b"\0"
    units, taken = {0: [0, None, 0]}, {0}

    def place(node, prefix):
        children = sorted({k[len(prefix)] for k in entries if k.startswith(prefix) and len(k) > len(prefix)})
        leaf = prefix in entries
        base = next(b for b in range(1, 1 << 20) if all((node ^ b ^ c) not in taken for c in [*children, *([0] * leaf)]) and b < 1 << 21)
        units[node][0], units[node][2] = base, leaf
        if leaf:
            taken.add(node ^ base)
            units[node ^ base] = ["value", values[prefix], 0]
        for c in children:
            taken.add(node ^ base ^ c)
            units[node ^ base ^ c] = [0, c, 0]
        for c in children:
            place(node ^ base ^ c, prefix + bytes([c]))

    place(0, b"")
    out = []
    for k in range(max(units) + 257):
        u = units.get(k)
        out.append(0x1FF if u is None else (u[1] | 1 << 31) if u[0] == "value" else u[0] << 10 | u[2] << 8 | (u[1] or 0))
    raw = struct.pack(f"<{len(out)}I", *out)
    return struct.pack("<I", len(raw)) + raw + texts


def test_longest_prefix_and_alignment():
    model = S.Model(PATH)
    model.map, model.identity, model.collapse = S.CharacterMap(charsmap({"ﬁ".encode(): b"fi", b"a": b"b", b"ab": b"c", "　".encode(): b" "})), False, True
    assert model.map.longest(b"abx", 0) == (2, b"c") and model.map.longest(b"ax", 0) == (1, b"b") and model.map.longest(b"x", 0) is None
    data = "  ﬁx　 ab ".encode()
    text, places = model.normalised(data)
    assert text == "▁fix▁c"
    ids, begins, ends = model.encode(data)
    pieces = [model.pieces[i] for i in ids]
    assert "".join(pieces) == text
    assert (begins[0], ends[-1]) == (2, len(data) - 1)
    assert all(b <= e for b, e in zip(begins, ends)) and list(ends[:-1]) == list(begins[1:])


def test_workers_without_the_package(tmp_path):
    """Encoding and scoring from a folder and a Python path that do not have the package."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from custoria.session import local_session\n"
        "spark = local_session(2, 2, '1g')\n"
        "from custoria.llm import ctw, decontaminate, html, sentencepiece, simhash, suffixdedup, surrogates\n"
        "df = spark.createDataFrame([(i, f'some words {i} of text ' * 5) for i in range(20)], 'doc_id long, text string')\n"
        f"print('rows', sentencepiece.encode(df, {PATH!r}, decoded=True).count(), ctw.scores(df).count(), suffixdedup.remove_repeats(df).count(),"
        " simhash.classes(df).count(), surrogates.replace(df, b'k').count(), decontaminate.find(df, df.withColumnRenamed('doc_id', 'item_id')).count(),"
        " html.main_text(df.selectExpr('text AS url', 'text AS html')).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "rows 20 20 20 20 20 20 20" in done.stdout, done.stderr[-3000:]
