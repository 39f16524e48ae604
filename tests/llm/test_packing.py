"""Every id lies in one piece, sequences are gapless and full, and the cuts are optimal."""

import random
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from carespark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_pieces(pieces, ids_of, window):
    """pieces: (doc_id, start, ids, doc_tokens, sequence, offset)"""
    docs, seqs = defaultdict(list), defaultdict(list)
    for d, start, ids, total, seq, offset in pieces:
        docs[d].append((start, ids, total))
        seqs[seq].append((offset, len(ids) // 4))
    for d, want in ids_of.items():
        got = sorted(docs[d])
        assert b"".join(i for _, i, _ in got) == want
        assert [s for s, _, _ in got] == [sum(len(x[1]) // 4 for x in got[:k]) for k in range(len(got))]
        assert all(t == len(want) // 4 for _, _, t in got)
    padding = 0
    for parts in seqs.values():
        parts.sort()
        end = 0
        for o, n in parts:
            assert o == end
            end += n
        assert 0 < end <= window
        padding += 0 if end & (end - 1) == 0 else window - end
    return padding


def brute(cuts, costs, window):
    best = {0: 0.0}
    for p, c in zip(cuts, costs):
        best[p] = min(best[q] + window - (p - q) + c for q in best if p - window <= q < p)
    return best[cuts[-1]]


def test_cuts_are_optimal():
    rng = random.Random(1)
    for _ in range(300):
        cuts = sorted({*rng.sample(range(1, 120), 40), *range(15, 120, 15)})
        flags = [rng.random() < 0.7 for _ in cuts]
        p = packing.Packer(16, 2.0, 9.0, 1 << 30)
        list(p.add(0, bytes(4 * 120), np.array(cuts), np.array(flags)))
        price = dict(zip(cuts, (2.0 if f else 9.0 for f in flags))) | {120: 0.0}
        path, _ = p.path(last=True)
        spent = sum(16 - (b - a) + price[b] for a, b in zip([0, *path], path))
        assert path[-1] == 120 and spent == brute([*cuts, 120], [price[c] for c in [*cuts, 120]], 16)


def test_inner_cuts():
    ends = np.zeros(100, bool)
    ends[7] = True
    ids = np.array([1] * 5 + [7] + [1] * 20 + [7] + [1] * 3 + [7, 1], dtype="<u4")
    cuts, sentence = packing.inner_cuts(ids, ends, 8)
    assert cuts.tolist() == [6, 14, 22, 27] and sentence.tolist() == [True, False, False, True]
    assert packing.inner_cuts(ids[-1:], ends, 8)[0].tolist() == []


def test_blocks_keep_every_token_and_pad_little():
    rng = random.Random(2)
    for block in (512, 3000, 1 << 20):
        p, ids_of, out = packing.Packer(128, 4.0, 64.0, block), {}, []
        for d in range(300):
            n = rng.choice([1, 3, 50, 127, 128, 129, 700])
            ids = np.arange(d, d + n, dtype="<u4").tobytes()
            cuts = np.arange(10, n, 10)
            ids_of[d] = ids
            out += p.add(d, ids, cuts, np.ones(len(cuts), bool))
        out += p.finish()
        total = sum(len(i) // 4 for i in ids_of.values())
        assert check_pieces(out, ids_of, 128) < 0.08 * total


def test_pieces_equal_library():
    with open(PATH, encoding="utf-8") as f:
        enc = packing.PieceEncoder(f.read())
    tok, rng = Tokenizer.from_file(PATH), random.Random(3)
    abc = ["The", "é", "É", "ß", "Σ", "'re", "'", "7", "²", "ª", "µ", "×", "÷", "\x1c", "\x85", "\xa0", " ", "\n", "<", "<|endoftext|>",
           "_", "!!", "中", "́", "Ɏ", "ʰ"]
    for _ in range(500):
        t = "".join(rng.choice(abc[:rng.randrange(3, len(abc) + 1)]) for _ in range(rng.randrange(40)))
        assert array("I", enc.encode(t)).tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_chunks_equal_library(monkeypatch):
    with open(PATH, encoding="utf-8") as f:
        enc = packing.PieceEncoder(f.read())
    tok, rng = Tokenizer.from_file(PATH), random.Random(4)
    abc = ["The", "don", "é", "Σ", "'", "'s", "'re", "'ll", "t", "l", "7", "½", " ", "\n", "\t", "\u3000", "\x1f", "<", "<|endoftext|>",
           "<|startoftext|>", "!'", "中", "́", "’", "😀", "𝐀", "\x00"]
    texts = ["".join(rng.choices(abc[:rng.randrange(3, len(abc) + 1)], k=rng.randrange(40))) for _ in range(600)] + ["", " ", "'", "'s", ""]
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    for size in (1, 9, 500, 1 << 21):
        monkeypatch.setattr(packing, "CHARS_AT_ONCE", size)
        assert [array("I", b).tolist() for b in enc.encode_all(texts)] == want
        parts = list(packing.slabs("\n".join(texts), size))
        assert "".join(parts) == "\n".join(texts) and all(p[0] in " \n\t" for p in parts[1:])
    assert max(map(len, packing.slabs("ab cd " * 1000, 50))) <= 50 and list(packing.slabs("a" * 100, 8)) == ["a" * 100]


def test_a_piece_is_looked_up_once_in_a_chunk():
    with open(PATH, encoding="utf-8") as f:
        enc = packing.PieceEncoder(f.read())
    asked = []

    class Asked(dict):
        def __getitem__(self, piece):
            asked.append(piece)
            return enc._ids(piece)

    enc.memo = Asked()
    got = enc.encode_all(["Over and over, 7 é.", "over AND É"] * 1000)
    assert sorted(asked) == sorted(s.encode() for s in ("over", "and", ",", "7", "é", "."))
    assert got[::2] == got[:1] * 1000 and got[1::2] == got[1:2] * 1000
    rows = [(n, "x" * 10) for n in range(packing.CHARS_AT_ONCE // 11 + 5)] + [(-1, "y" * packing.CHARS_AT_ONCE), (-2, "")]
    chunks = list(packing.chunks_of(iter(rows)))
    assert [r for c in chunks for r in c] == rows and [len(c) > 1 for c in chunks] == [True, True, False]


def test_documents(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "One two. Three four! " * 900, 0), (4, "nospace" * 3000, 0),
            (5, "same 12 <|endoftext|> text", 0), (6, "same 12 <|endoftext|> text", 0), (7, "日本語。 テキスト é́", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int").coalesce(1)
    tok = Tokenizer.from_file(PATH)
    ids_of = {i: array("I", tok.encode(t or "", add_special_tokens=False).ids + [1]).tobytes() for i, t, _ in rows}
    got = packing.pack_documents(docs, PATH).collect()
    check_pieces([(r.doc_id, r.start, bytes(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in got], ids_of, 2048)
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0
    nulls = spark.createDataFrame([(None, "a")] * 2, "doc_id long, text string")
    assert [r.doc_id for r in packing.pack_documents(nulls, PATH, digests=True).collect()] == [None, None]


def test_sample_table_equals_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tok = Tokenizer.from_file(PATH)
    ids_of = {r.doc_id: array("I", tok.encode(r.text, add_special_tokens=False).ids + [1]).tobytes() for r in docs.collect()}
    got = packing.pack_documents(docs, PATH).collect()
    padding = check_pieces([(r.doc_id, r.start, bytes(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in got], ids_of, 2048)
    assert padding < 0.02 * sum(len(i) // 4 for i in ids_of.values())
