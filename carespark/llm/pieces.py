"""SentencePiece encoding and decoding by a table of distinct marked words.

A BPE model of this family writes a space as a marker, puts one marker before
the text and merges two neighbours only into a piece that it has. If no piece
has a marker after another character, no merge crosses the place where a marker
follows another character, so the text falls into *chunks* (markers, then
characters up to the next marker) that are segmented independently of each
other. ``chunk_rule`` checks this from the model's own pieces.

A block of documents is one run of bytes. Chunk starts are found by a byte
comparison, equal chunks get one number by dictionary encoding, each distinct
chunk is segmented once, and the documents' ids are the table's entries taken
by chunk number, in order. Decoding takes the text of each id from a table of
the pieces. All of this is array work; Python touches a chunk once a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from carespark.llm.common import map_arrow, texts_of

MARKER = "▁"            # FIXED VALUE: what the model's pieces have for a space
BLOCK_BYTES = 4 << 20        # of text whose chunks make one table; a longer text is a block of its own


def chunk_rule(model: bytes) -> None:
    """Raise ValueError unless chunks of this model can be segmented apart."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    m.ParseFromString(model)
    norm, kind = m.normalizer_spec, m.trainer_spec
    if kind.model_type != proto.TrainerSpec.BPE or not kind.byte_fallback or kind.treat_whitespace_as_suffix:
        raise ValueError("a BPE model with byte fallback and markers before words is needed")
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
        raise ValueError("the model must keep texts as they are, but for markers")
    pieces = [p.piece for p in m.pieces]
    if MARKER not in pieces:
        raise ValueError("the marker must be a piece")
    if any(MARKER in p.lstrip(MARKER) for p in pieces):
        raise ValueError("a piece crosses a marker: chunks are not independent")


class PieceTables:
    """The model's tables for one task: the segmenter, each id as decimal text and as decoded bytes."""

    def __init__(self, model: bytes):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.sp.vocab_size()
        self.end = self.sp.eos_id()
        self.marker = self.sp.piece_to_id(MARKER)
        self.byte = np.array([self.sp.is_byte(i) for i in range(n)])
        self.surface = [self._bytes(i) for i in range(n)]
        self.decimal = pa.array([b" %d" % i for i in range(n)], pa.large_binary())
        self.text = pa.array(self.surface, pa.large_binary())

    def _bytes(self, i: int) -> bytes:
        if self.sp.is_byte(i):
            return bytes([int(self.sp.id_to_piece(i)[1:-1], 16)])
        if self.sp.is_control(i):
            return b""
        if self.sp.is_unknown(i):
            return self.sp.decode([i]).encode()
        return self.sp.id_to_piece(i).replace(MARKER, " ").encode()

    def segment(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, one after the other, and where each chunk's begin (and the last ends).
        The model puts a marker before what it is given, so each chunk goes without its first."""
        ids = self.sp.encode([c[1:].decode() for c in chunks], num_threads=1)
        for i in (i for i, c in enumerate(chunks) if c == b" "):
            ids[i] = [self.marker]
        ends = np.concatenate(([0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1])), ends

    def decode(self, ids) -> str:
        """Text of any ids. The marker before the text is dropped; bytes that make no character
        become U+FFFD one by one, within a run of byte ids."""
        ids = [int(i) for i in ids]
        out, run, begun = [], b"", False
        for i in [*ids, None]:
            if i is not None and self.byte[i]:
                run += self.surface[i]
                continue
            if run:
                out.append(_characters(run))
                run, begun = b"", True
            if i is None:
                break
            piece = self.surface[i].decode()
            if not begun and not self.sp.is_unknown(i) and piece.startswith(" "):
                piece, begun = piece[1:], True
            begun = begun or bool(piece)
            out.append(piece)
        return "".join(out)


def _characters(run: bytes) -> str:
    out, at = [], 0
    while at < len(run):
        for n in range(1, 5):
            try:
                out.append(run[at:at + n].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            n = 1
        at += n
    return "".join(out)


def _parts(values: pa.LargeBinaryArray) -> tuple[memoryview, np.ndarray]:
    """Bytes of a binary array and the places where its values begin (and the last ends)."""
    _, offsets, data = values.buffers()
    places = np.frombuffer(offsets, np.int64, len(values) + 1, values.offset * 8)
    return memoryview(data if data is not None else b""), places


def _binary(places: np.ndarray, data) -> pa.LargeBinaryArray:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(places) - 1, [None, pa.py_buffer(np.ascontiguousarray(places, np.int64)), pa.py_buffer(data)])


def chunks_of(texts: pa.Array) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """Chunks of all texts, in order, and where each text's begin (and the last's end). A space in a
    chunk stands for a marker; an empty text has none."""
    texts = pc.replace_substring(texts.cast(pa.large_string()), MARKER, " ")
    full = pc.greater(pc.binary_length(texts), 0)
    marker, none = (pa.scalar(c, pa.large_string()) for c in (" ", ""))
    texts = pc.if_else(full, pc.binary_join_element_wise(marker, texts, none), texts)
    data, places = _parts(texts.cast(pa.large_binary()))
    data = data[places[0]:places[-1]]
    places = places - places[0]
    space = np.frombuffer(data, np.uint8) == 0x20
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[places[:-1][np.diff(places) > 0]] = True
    starts = np.flatnonzero(first)
    bounds = np.searchsorted(starts, places)
    return _binary(np.append(starts, len(space)), data), bounds


class Block:
    """Ids of a block of texts. ``ids``: all in order, without end ids; ``places``: where each text's begin."""

    def __init__(self, texts: pa.Array, tables: PieceTables):
        self.tables = tables
        chunks, self.bounds = chunks_of(texts)
        table = chunks.dictionary_encode()
        self.at = table.indices
        self.table_ids, self.table_places = tables.segment(table.dictionary.to_pylist())
        lengths = np.diff(self.table_places)[self.at.to_numpy(zero_copy_only=False)]
        self.places = np.concatenate(([0], np.cumsum(lengths)))[self.bounds]
        self.counts = np.diff(self.places)

    def ids(self) -> np.ndarray:
        at = self.at.to_numpy(zero_copy_only=False)
        starts, lengths = self.table_places[:-1][at], np.diff(self.table_places)[at]
        before = np.cumsum(lengths) - lengths
        return self.table_ids[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]

    def taken(self, of_id: pa.LargeBinaryArray) -> tuple[memoryview, np.ndarray]:
        """What ``of_id`` has for each id, joined: bytes of all texts and where each text's begin."""
        data, places = _parts(of_id.take(pa.array(self.table_ids)))
        by_chunk = _binary(places[self.table_places], data)
        data, places = _parts(by_chunk.take(self.at))
        return data, places[self.bounds]


def blocks_of(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """(first, number) of the rows of each block."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, n in enumerate(sizes):
        if i > first and held + n > block_bytes:
            yield first, i - first
            first, held = i, 0
        held += int(n)
    if first < len(sizes):
        yield first, len(sizes) - first


DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
TOKENS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def _decoded(block: Block) -> Iterator[bytes]:
    """Each text's ids decoded. Pieces are joined as bytes; where these are no text, byte runs decide."""
    data, places = block.taken(block.tables.text)
    ids = None
    for n, (a, b) in enumerate(zip(places[:-1].tolist(), places[1:].tolist())):
        out = bytes(data[a:b])
        try:
            out.decode()
        except UnicodeDecodeError:
            ids = block.ids() if ids is None else ids
            yield block.tables.decode(ids[block.places[n]:block.places[n + 1]]).encode()
            continue
        yield out[1:] if out[:1] == b" " else out


def encode_block(doc_ids: pa.Array, texts: pa.Array, tables: PieceTables, digests: bool) -> pa.RecordBatch:
    block = Block(texts, tables)
    counts = pa.array(block.counts + 1)
    if not digests:
        places = block.places + np.arange(len(block.places))
        ids = np.insert(block.ids(), block.places[1:], tables.end)
        lists = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(ids, pa.int32()))
        return pa.record_batch([doc_ids, counts, lists, pa.array([t.decode() for t in _decoded(block)], pa.string())], schema=TOKENS)
    data, places = block.taken(tables.decimal)
    shown = []
    for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
        digest = hashlib.sha256(data[a + 1:b] if b > a else b"")
        digest.update((" %d" if b > a else "%d").replace("%d", str(tables.end)).encode())
        shown.append(digest.hexdigest())
    decoded = [hashlib.sha256(t).hexdigest() for t in _decoded(block)]
    return pa.record_batch([doc_ids, counts, pa.array(shown, pa.string()), pa.array(decoded, pa.string())], schema=DIGESTS)


@lru_cache(maxsize=4)
def _model(path: str) -> bytes:
    with open(path, "rb") as f:
        model = f.read()
    chunk_rule(model)
    return model


def broadcast_model(spark: SparkSession, path: str):
    """The model file, checked and sent to the executors (a vocabulary: its size does not grow with data)."""
    return spark.sparkContext.broadcast(_model(path))


def encode_pieces(docs: DataFrame, model_path: str, *, digests: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Ids of every whole text with the end id, and the text that these ids decode to.

    Returns (doc_id, n_tokens, ids array, decoded), with ``digests`` (doc_id, n_tokens, ids_sha256,
    decoded_sha256) in their place. A null or empty text is the end id alone and decodes to an
    empty text; a marker character in a text is a space, as in the library; a null doc_id stays
    null; repeated rows give repeated results; further columns are not read; an empty table gives
    no rows. One scan, no shuffle; memory is that of a block or of the longest text."""
    shared = broadcast_model(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = PieceTables(shared.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for first, n in blocks_of(texts, block_bytes):
                yield encode_block(ids.slice(first, n), texts.slice(first, n), tables, digests)

    more = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return map_arrow(texts_of(docs), run, f"doc_id long, n_tokens long, {more}")
