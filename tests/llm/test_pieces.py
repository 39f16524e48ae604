"""Ids and decoded texts against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from carespark.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "   ", "a", " a", "a ", "a  ", "  a  b  ", "a▁b", "▁", " ▁ x", "▁▁a", "\n", "a\n\n b\t c\r\n", "\x00", "a\x00 b",
       "</s>", "<s> x", "<0x41>", "<unk>", "日本語 テキスト。", "emoji 👩‍👩‍👧 \U0001f600", "é é", "x" * 5000, "日" * 3000, " " * 70, "a" + " " * 33 + "b",
       " nbsp　wide", "﻿bom", "ﬁ ligature", " sep", "once upon a time " * 400]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def want(library, text):
    ids = library.encode(text or "", add_eos=True)
    return ids, library.decode(ids)


def test_odd_texts(spark, library):
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(None, "no id", 2), (3, "  ", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(3)
    got = {(r.doc_id, r.decoded): (r.n_tokens, r.ids) for r in pieces.encode_pieces(df, MODEL, block_bytes=64).collect()}
    for i, text, _ in rows:
        ids, back = want(library, text)
        assert got[i, back] == (len(ids), ids), text
    digests = sorted(map(tuple, pieces.encode_pieces(df, MODEL, digests=True).collect()), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert digests == sorted([(i, len(ids), sha(" ".join(map(str, ids))), sha(back))
                              for i, t, _ in rows for ids, back in [want(library, t)]], key=str)
    assert pieces.encode_pieces(df.limit(0), MODEL).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_random_blocks(library, seed):
    rng = random.Random(seed)
    words = ["the", "of", " ", "  ", "▁", "zürich", "naïve", "\n", "日本", "🎉", "0x1F", "int", "main()", ";\r", "\t", "q" * 40, "\x7f", "é"]
    texts = ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randrange(60))) for _ in range(300)]
    batch = pieces.encode_block(pa.array(range(len(texts))), pa.array(texts), pieces.PieceTables(pieces._model(MODEL)), False)
    for text, ids, back in zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
        assert (ids, back) == want(library, text), repr(text)


def test_blocks_cover_all_rows():
    texts = pa.array(["x" * n for n in (0, 5, 100, 1, 1, 1, 50, 0)])
    spans = list(pieces.blocks_of(texts, 10))
    assert [i for a, n in spans for i in range(a, a + n)] == list(range(len(texts)))
    assert list(pieces.blocks_of(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("seed", range(3))
def test_any_ids_decode_as_in_the_library(library, seed):
    rng = random.Random(seed)
    tables = pieces.PieceTables(pieces._model(MODEL))
    for _ in range(500):
        ids = [rng.choice([0, 1, 2, tables.marker, rng.randrange(3, 259), rng.randrange(3, 259), rng.randrange(259, 32000)])
               for _ in range(rng.randrange(12))]
        assert tables.decode(ids) == library.decode(ids), ids


def test_pieces_that_cross_markers_are_refused():
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    m.ParseFromString(pieces._model(MODEL))
    m.pieces[400].piece = "of" + pieces.MARKER + "the"
    with pytest.raises(ValueError, match="crosses"):
        pieces.chunk_rule(m.SerializeToString())
    m.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError, match="keep texts"):
        pieces.chunk_rule(m.SerializeToString())
