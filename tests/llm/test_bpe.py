"""Encoding equals the tokenizers library; streams equal whole texts; decoding round-trips."""

import hashlib
import random
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from carespark.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def parts():
    with open(PATH, encoding="utf-8") as f:
        m = bpe.MergeList(f.read())
    return m, m.lookahead(), Tokenizer.from_file(PATH)


ODD = ["", " ", "it's 'TIS we'll''s", "a\x1cb\x85c　d", "Ünïcode é́ 각 ΑΣ İx",
       "x<|endoftext|>y <|startoftext|><|endoftex", "²½Ⅷ١٢_a_", "\U0001f600\U0001f468‍\U0001f469", "́ ́a",
       "aaaaaaaaaaaaaaaaaaaaaaaaaaa!!!!!!!!!!!!!!====", "\x00\x7f"]


def test_equals_library_on_odd_texts(parts):
    m, look, tok = parts
    enc = bpe.StreamEncoder(m, look)
    for t in ODD:
        assert array("I", enc.encode(t)).tolist() == tok.encode(t, add_special_tokens=False).ids, t


def random_text(rng, n, alphabet):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_equals_library_on_random_and_long_chunks(parts, monkeypatch):
    m, look, tok = parts
    rng = random.Random(5)
    abc = ["the", "ing", "a", "é", "e", "́", "'s", "'", "'re", "7", "!", "-", "ß", "Σ", "<|endoftext|>", "<|", "한", "ᅡ", "中"]
    for limit in (16, 64, 4096):
        monkeypatch.setattr(bpe, "LONG_CHUNK", limit)
        monkeypatch.setattr(bpe, "FEED_CHARS", 7 if limit == 16 else 50)
        enc = bpe.StreamEncoder(m, look)
        for _ in range(60):
            t = random_text(rng, rng.randrange(1, 300), abc + [" "] * rng.randrange(0, 3))
            assert array("I", enc.encode(t)).tolist() == tok.encode(t, add_special_tokens=False).ids, (limit, t)


def test_one_long_word_with_constant_buffer(parts):
    m, look, tok = parts
    rng = random.Random(6)
    for alphabet in ("ab", "aeinrst", "!=-"):
        t = random_text(rng, 20_000, alphabet)
        w, out, most = bpe.WordTransducer(m, look), [], 0
        for at in range(0, len(t), 100):
            out += w.feed(t[at:at + 100].encode())
            most = max(most, len(w.buf))
        out += w.finish()
        assert out == tok.encode(t, add_special_tokens=False).ids
        assert most <= 4 * look + 164


def test_decoder(parts):
    m, look, tok = parts
    enc = bpe.StreamEncoder(m, look)
    for t in [*ODD, "Zwölf Boxkämpfer 中文"]:
        ids = array("I", enc.encode(t)).tolist()
        d = bpe.StreamDecoder(m)
        assert "".join(d.feed([i]) for i in ids) + d.finish() == tok.decode(ids, skip_special_tokens=False)
    d = bpe.StreamDecoder(m, "text")
    ids = array("I", enc.encode("Zwölf große  Äpfel")).tolist()
    assert "".join(d.feed([i]) for i in ids) + d.finish() == "zwölf große äpfel "


def test_documents(spark, parts):
    _, _, tok = parts
    rows = [(1, None, "x"), (2, "", "x"), (None, "Hello it's", "x"), (3, "same", "x"), (3, "same", "x"), (4, "long word " * 30000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, bpe.encode_documents(docs, PATH, digests=True).collect()), key=str)
    want = []
    for i, t, _ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(),
                     hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.encode_documents(docs.limit(0), PATH).count() == 0
    assert bpe.encode_documents(docs.where("doc_id = 2"), PATH).first()["ids"] == b""
