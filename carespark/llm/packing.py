"""Order-preserving packing of documents into token windows by dynamic programming.

The documents of a partition form one token stream, in stored order; their
texts are turned into ids by chunks of some 2^21 characters. Allowed
cuts are ends of documents (no penalty), of sentences (a small one) and, inside
sentences longer than ``stride`` tokens, every ``stride`` tokens (a large one).
With cut positions p and penalties c, the least cost of a packing that ends at
cut j is

    best(j) = c(j) + min over i with p(j) - window <= p(i) < p(j) of
              best(i) + window - (p(j) - p(i)),

whose inner minimum of best(i) + p(i) runs over a sliding window: a monotone
queue gives it in constant amortised time. The stream is solved by blocks: all
sequences up to the best cut in a block's last window are settled, the tokens
after it open the next block, so memory is that of a block and a row. The very
last remainder of a partition is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections import deque
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from carespark.llm.bpe import Memo, byte_alphabet, fold
from carespark.llm.common import RowSink, map_arrow, rows_of, texts_of

WINDOW = 2048
END_ID = 1              # closes every document
SENTENCE_PENALTY = 4.0  # in tokens of padding
INNER_PENALTY = 24.0
STRIDE = 16
BLOCK_TOKENS = 1 << 19
PIECES_KEPT = 200_000   # distinct pieces whose ids a worker remembers
IDS_AT_ONCE = 64        # rows with ids in an Arrow batch: up to 2048 ids each
CHARS_AT_ONCE = 1 << 21 # characters whose pieces are numbered together
SENTENCE_ENDS = ".!?。！？"


SPACE, LETTER, DIGIT, OTHER = range(4)


@cache
def char_kinds() -> np.ndarray:
    """The kind of each code point in the vocabulary file's split pattern; a surrogate is a piece like a digit."""
    kinds = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    every = np.arange(len(kinds), dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (DIGIT, r"[\p{N}\ud800-\udfff]+")):
        for run in regex.finditer(pattern, every):
            kinds[run.start():run.end()] = kind
    return kinds


def slabs(text: str, size: int) -> Iterator[str]:
    """The text in parts of about ``size`` characters that begin at white space; longer only without it."""
    at, end = 0, size
    while end < len(text):
        cut = max(text.rfind(c, max(end - size, at + 1), end) for c in " \n\t")
        if cut > 0:
            yield text[at:cut]
            at, end = cut, cut
        end += size
    yield text[at:]


def piece_starts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """For each code point of a normalised text, whether a piece begins there."""
    starts = np.empty(len(points), bool)
    starts[:1] = True
    np.not_equal(kinds[1:], kinds[:-1], out=starts[1:])
    marks = np.flatnonzero((points == ord("'")) & starts)
    starts |= kinds == DIGIT
    starts &= kinds != SPACE
    for ending in ("s", "t", "re", "ve", "m", "ll", "d"):      # one piece with the mark before
        fits = marks[marks + len(ending) < len(points)]
        for n, c in enumerate(ending, 1):
            fits = fits[points[fits + n] == ord(c)]
        starts[fits + 1] = False
        rest = fits + len(ending) + 1
        rest = rest[rest < len(points)]
        starts[rest] |= kinds[rest] != SPACE
    return starts


class PieceEncoder:
    """Ids of whole texts as the tokenizers library gives them, each distinct piece worked out once.

    Texts are normalised and split as the vocabulary file says, many at a time:
    Arrow numbers their pieces, so that a piece is looked up once for all of
    them. The library's own model turns a new piece into ids."""

    def __init__(self, text: str):
        self.tok = Tokenizer.from_str(text)
        self.special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        # special tokens pass the split as surrogates, which no text holds
        self.stand_in = {s: chr(0xD800 + n) for n, s in enumerate(self.special)}
        self.stood_for = {c.encode("utf-8", "surrogatepass"): self.special[s] for s, c in self.stand_in.items()}
        self.alphabet = byte_alphabet()
        self.memo = Memo(self._ids, PIECES_KEPT)

    def _ids(self, piece: bytes) -> bytes:
        if piece in self.stood_for:
            return array("I", [self.stood_for[piece]]).tobytes()
        letters = piece.decode("latin-1")
        if not (letters.isascii() and letters.isprintable()):
            letters = "".join([self.alphabet[b] for b in piece])
        return array("I", [t.id for t in self.tok.model.tokenize(letters)]).tobytes()

    def _folded(self, text: str) -> str:
        if "<" not in text:
            return fold(text)
        return "".join([self.stand_in[part] if i % 2 else fold(part) for i, part in enumerate(self.cut.split(text))])

    def _slab(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of a normalised text; where each of its pieces begins, and the ids up to its end."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        kinds = char_kinds()[points]
        starts, solid = piece_starts(points, kinds), kinds != SPACE
        points = points[solid]
        letters = points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        edges = np.append(np.flatnonzero(starts[solid]).astype(np.int32), np.int32(len(points)))
        if len(letters) > len(points):                          # code points to bytes
            wide = np.cumsum((points > 0x7F).view(np.uint8) + (points > 0x7FF) + (points > 0xFFFF), dtype=np.int32)
            edges[1:] += wide[edges[1:] - 1]
        pieces = pa.Array.from_buffers(pa.binary(), len(edges) - 1,
                                       [None, pa.py_buffer(edges), pa.py_buffer(letters)]).dictionary_encode()
        which = pieces.indices.to_numpy()
        found = list(map(self.memo.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False).tolist()))
        flat = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
        count, first = sizes[which], (np.cumsum(sizes, dtype=np.int32) - sizes)[which]
        ends = np.cumsum(count, dtype=np.int32)
        place = np.repeat(first - ends + count, count)
        place += np.arange(len(place), dtype=np.int32)
        return flat[place], np.flatnonzero(starts), ends

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, little-endian unsigned 32-bit."""
        folded = [self._folded(t) for t in texts]
        bounds = np.cumsum([len(t) + 1 for t in folded])        # a line end after each
        text = "\n".join(folded)
        ids, starts, ends, at, n = [], [], [], 0, 0
        for slab in slabs(text, CHARS_AT_ONCE):
            got = self._slab(slab)
            ids.append(got[0])
            starts.append(got[1] + at)
            ends.append(got[2] + np.int64(n))
            at, n = at + len(slab), n + len(got[0])
        ids, ends = np.concatenate(ids), np.concatenate([np.zeros(1, np.int64), *ends])
        stops = ends[np.searchsorted(np.concatenate(starts), bounds)].tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *stops], stops)]

    def encode(self, text: str) -> bytes:
        """One text's ids."""
        return self.encode_all([text])[0]

    def sentence_ends(self) -> np.ndarray:
        """For each id, whether it begins with a sentence end."""
        vocab = self.tok.get_vocab()
        ends = np.zeros(max(vocab.values()) + 1, bool)
        marks = tuple("".join(self.alphabet[b] for b in c.encode()) for c in SENTENCE_ENDS)
        ends[[i for t, i in vocab.items() if t.startswith(marks)]] = True
        return ends


def inner_cuts(ids: np.ndarray, ends: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the allowed cuts within a document, ascending, and which are sentence ends."""
    stops = np.flatnonzero(ends[ids[:-2]]) + 1
    edges = np.concatenate(([0], stops, [len(ids)]))
    wide = np.flatnonzero(np.diff(edges) > stride)
    if not len(wide):
        return stops, np.ones(len(stops), bool)
    count = (edges[wide + 1] - edges[wide] - 1) // stride     # cuts inside each long sentence
    first = np.repeat(edges[wide], count)
    nth = np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count) + 1
    cuts = np.concatenate((stops, first + nth * stride))
    order = np.argsort(cuts, kind="stable")
    return cuts[order], order < len(stops)


class Packer:
    """Packs a stream of documents; emits (doc_id, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, window: int, sentence_penalty: float, inner_penalty: float, block: int):
        self.window, self.block = window, block
        self.penalty = (inner_penalty, sentence_penalty)
        self.sequence = 0
        self.base = self.end = 0                 # stream positions: settled up to, known up to
        self.docs: deque = deque()               # [stream position, doc_id, ids]
        self.cuts: list[int] = []                # after base, ascending
        self.costs: list[float] = []

    def add(self, doc_id, ids: bytes, cuts: np.ndarray, sentence: np.ndarray) -> Iterator[tuple]:
        n = len(ids) // 4
        self.docs.append((self.end, doc_id, ids))
        places, costs = (cuts + self.end).tolist(), [self.penalty[s] for s in sentence.tolist()]
        places.append(self.end + n)
        costs.append(0.0)
        self.end += n
        for at in range(0, len(places), self.block // 8):
            self.cuts += places[at:at + self.block // 8]
            self.costs += costs[at:at + self.block // 8]
            if self.cuts[-1] - self.base >= self.block:
                yield from self._settle(last=False)

    def finish(self) -> Iterator[tuple]:
        if self.cuts:
            yield from self._settle(last=True)

    def path(self, last: bool) -> tuple[list[int], int]:
        """Cuts of the cheapest packing up to the end, or up to the best cut of the
        last window; and how many allowed cuts it settles."""
        w, base = self.window, self.base
        p, c = [base, *self.cuts], [0.0, *self.costs]
        n = len(p)
        key, back = [0.0] * n, [0] * n           # best(i) + p(i); the cut before
        key[0] = float(base)
        queue, head = [0], 0
        for j in range(1, n):
            here = p[j]
            low = here - w
            while p[queue[head]] < low:
                head += 1
            i = queue[head]
            k = c[j] + w + key[i]
            key[j], back[j] = k, i
            while len(queue) > head and key[queue[-1]] > k:
                queue.pop()
            queue.append(j)
        if last:
            j = n - 1
        else:
            j = min((i for i in range(n - 1, 0, -1) if p[i] > p[-1] - w), key=lambda i: key[i] - p[i])
        kept, path = j, []
        while j:
            path.append(p[j])
            j = back[j]
        return path[::-1], kept

    def _settle(self, last: bool) -> Iterator[tuple]:
        path, kept = self.path(last)
        for stop in path:
            if last and stop == self.end and (left := stop - self.base) & (left - 1):
                while left:                      # the remainder, by powers of two
                    size = 1 << (left.bit_length() - 1)
                    yield from self._emit(self.base + size)
                    left -= size
            else:
                yield from self._emit(stop)
        self.cuts, self.costs = self.cuts[kept:], self.costs[kept:]

    def _emit(self, stop: int) -> Iterator[tuple]:
        start = self.base
        while start < stop:
            at, doc_id, ids = self.docs[0]
            n = len(ids) // 4
            end = min(stop, at + n)
            yield doc_id, start - at, ids[4 * (start - at):4 * (end - at)], n, self.sequence, start - self.base
            if end == at + n:
                self.docs.popleft()
            start = end
        self.base = stop
        self.sequence += 1


DIGESTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def chunks_of(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    """Rows (doc_id, text) by some CHARS_AT_ONCE characters; a longer text ends its chunk."""
    chunk, chars = [], 0
    for row in rows:
        chunk.append(row)
        chars += len(row[1]) + 1
        if chars >= CHARS_AT_ONCE:
            yield chunk
            chunk, chars = [], 0
    if chunk:
        yield chunk


def _pack_task(tokenizer, window, sentence_penalty, inner_penalty, stride, block, end_id, digests):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        encoder = PieceEncoder(tokenizer.value[0])
        ends = encoder.sentence_ends()
        packer = Packer(window, sentence_penalty, inner_penalty, block)
        sink = RowSink(DIGESTS, 4096) if digests else RowSink(PIECES, IDS_AT_ONCE)
        close = np.array([end_id], dtype="<u4").tobytes()

        def settled():
            for rows in chunks_of(rows_of(batches)):
                doc_ids, texts = zip(*rows)
                for doc_id, ids in zip(doc_ids, encoder.encode_all(texts)):
                    ids += close
                    yield from packer.add(doc_id, ids, *inner_cuts(np.frombuffer(ids, "<u4"), ends, stride))
            yield from packer.finish()

        for doc_id, start, ids, total, sequence, offset in settled():
            sink.add(doc_id, start, len(ids) // 4, zlib.crc32(ids) if digests else ids, total, first + sequence, offset)
            if sink.full:
                yield sink.batch()
        yield sink.batch()

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, *, window: int = WINDOW, end_id: int = END_ID,
                   sentence_penalty: float = SENTENCE_PENALTY, inner_penalty: float = INNER_PENALTY,
                   stride: int = STRIDE, block_tokens: int = BLOCK_TOKENS, digests: bool = False) -> DataFrame:
    """Pack every whole document into sequences of at most ``window`` tokens.

    Each partition of ``docs`` (a file split: no shuffle) packs its documents in
    stored order, so a retried task writes the same sequences. Returns a row for
    each piece: (doc_id, start, length, ids binary or with ``digests`` ids_crc32,
    doc_tokens, sequence_id, offset); sequence_id holds the partition above bit
    40. A null or empty text is one token, ``end_id``; a null doc_id stays null;
    repeated rows are packed once each; further columns are not read; an empty
    table gives no pieces; a document longer than the window spans several."""
    from carespark.llm.bpe import broadcast_tokenizer

    if stride > window:
        raise ValueError("stride must not exceed the window")
    if block_tokens < 4 * window:
        raise ValueError("a block must hold some windows")
    task = _pack_task(broadcast_tokenizer(docs.sparkSession, tokenizer_path), window, sentence_penalty, inner_penalty,
                      stride, block_tokens, end_id, digests)
    ids = "ids_crc32 long" if digests else "ids binary"
    return map_arrow(
        texts_of(docs), task, f"doc_id long, start long, length long, {ids}, doc_tokens long, sequence_id long, offset long")
