"""Token alignment against one that goes through the tokens one by one."""

from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from custoria.llm import alignment

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
NEW = ["n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]


@pytest.fixture(scope="module")
def brute():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = alignment.byte_letters()
    names = {i: w for w, i in a.get_vocab().items()}

    def spans(ids, bytes_of):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(bytes_of(i)), i))
            at = out[-1][1]
        return out

    def a_bytes(i):
        return bytes(letters[c] for c in names[i])

    def b_bytes(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def rows(texts):
        """Per text what ``score`` adds, all texts being the corpus."""
        aligned = []
        for text in texts:
            whole = (" " + text).encode() if text else b""
            x = spans(a.encode(" " + text, add_special_tokens=False).ids if text else [], a_bytes)
            y = spans(b.encode(text) if text else [], b_bytes)
            if b"".join(a_bytes(i) for *_, i in x) != whole or b"".join(b_bytes(i) for *_, i in y) != whole:
                x = y = []
            links = [(i, j) for s, e, i in x for t, f, j in y if s < f and t < e]
            groups, start = [], 0
            for cut in sorted({e for _, e, _ in x} & {e for _, e, _ in y}):
                groups.append("|".join(",".join(str(i) for s, e, i in z if start <= s and e <= cut) for z in (x, y)))
                start = cut
            aligned.append((len(x), len(y), len(groups), ";".join(groups), links))
        count = Counter(link for *_, links in aligned for link in set(links))
        best = {}
        for (i, _), n in count.items():
            best[i] = max(best.get(i, 0), n)
        return [(n_a, n_b, n, len(ls), g, sum(count[k] == best[k[0]] for k in ls), sum(count[k] for k in ls)) for n_a, n_b, n, g, ls in aligned]

    return rows


TEXTS = [
    None, "", " ", "  two  spaces ", "plain words in a row", "plain words in a row", "tab\tand\nline \n ends ", "naïve café 東京 🙂 ﷽", "▁ stands for a space",
    "<|endoftext|> <s> </s> <unk> <0x41>", "aaaaaaaaaaaaaaaaaaaaa bbbbbbbbb", "x" * 3000, "don't we'll 12345678 ***", "\x00 \x01 control", "a", " no-break   em",
    "thhawhble theronhe endinghe; mentpapa", "one two three " * 40,
]


def table(docs, texts):
    return docs([(i, t) for i, t in enumerate(texts)])


def test_scores_equal_brute_force(docs, brute):
    found = {r["doc_id"]: tuple(r[c] for c in NEW) for r in alignment.score(table(docs, TEXTS), A, B).collect()}
    assert [found[i] for i in range(len(TEXTS))] == brute(TEXTS)


def test_blocks_do_not_change_counts(docs, brute, monkeypatch):
    for name, value in (("BLOCK", 20), ("ROWS", 2), ("KEPT", 3), ("TOGETHER", 2), ("SLICE", 100)):
        monkeypatch.setattr(alignment, name, value)
    texts = TEXTS[:8] * 2 + TEXTS[12:]
    found = {r["doc_id"]: tuple(r[c] for c in NEW) for r in alignment.score(table(docs, texts), A, B).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts)


def test_links_are_listed(docs, brute):
    texts = TEXTS[:12]
    for row, want in zip(alignment.align(table(docs, texts), A, B).orderBy("doc_id").collect(), brute(texts)):
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["groups"]) == want[:5]
        assert sum(row["link_n"]) == row["n_links"] and len(row["link_a"]) == len(row["link_b"]) == len(row["link_n"])


def test_edges(spark, docs, edges):
    found = alignment.score(docs(edges), A, B)
    assert found.columns == [*docs(edges).columns, *NEW]
    rows = found.collect()
    assert sorted(map(str, (r["doc_id"] for r in rows))) == sorted(map(str, (i for i, _ in edges)))
    for r in rows:
        if not r["text"]:
            assert [r[c] for c in NEW] == [0, 0, 0, 0, "", 0, 0]
        assert r["id"] == 7 and r["n_groups"] <= min(r["n_a"], r["n_b"]) and r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"]
    assert alignment.score(docs(edges).where("false"), A, B).collect() == []
    clash = docs(edges).select("doc_id", "text", F.lit("x").alias("groups"), F.lit("y").alias("block"), F.lit("z").alias("row"))
    assert {(r["block"], r["row"]) for r in alignment.score(clash, A, B).collect()} == {("y", "z")}
