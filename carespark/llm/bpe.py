"""BPE encoding and decoding as streaming transducers with bounded lookahead.

A merge list decides how far to the right a tokenizer must look before a token
can no longer change. ``MergeList.lookahead`` computes such a bound from the
list alone. Think of two runs over words that agree up to position d. Before
any merge both runs have the same segments left of d; the first segment that
differs starts at the *frontier*. The frontier moves left only when a rule
``s = (t, z)`` fires in one run and not in the other, where z starts at the
frontier; it then moves by the length of t. The step before was a rule of an
earlier rank whose left part starts at the same place, so it is a left-spine
part of z. The longest such chain of growing ranks bounds how far a difference
travels:

    reach(t, z) = len(t) + max over t' in left_spine(z) of best(t'),
    best(t') = the largest reach of the earlier rules with left part t'.

So a token that ends ``lookahead`` symbols before the last symbol seen is
stable, and encoding can go on after it as from the start of a word: no merge
crosses a boundary of the final segmentation. The buffer stays constant.

White-space-free chunks repeat a lot, so the ids of short chunks are kept in a
memo of bounded size.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from carespark.llm.common import RowSink, map_arrow, rows_of, texts_of

# FIXED VALUE: white space as the tokenizer's own pattern (\s) has it.
UNICODE_SPACE = "\t-\r \x85\xa0  -     　"
# FIXED VALUE: the split pattern of the vocabulary file.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

MEMO_CHUNKS = 500_000  # distinct chunks a worker remembers
MEMO_CHARS = 48        # longer chunks are not remembered
LONG_CHUNK = 4096      # a chunk beyond this is worked off piecemeal; a quarter of it for an open piece
FEED_CHARS = 1 << 16   # characters given to the encoder at a time


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    extra = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class MergeList:
    """Vocabulary and merges of a tokenizer file (the JSON text of the tokenizers library)."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.surface = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.rules: dict[tuple[int, int], int] = {}
        self.order: list[tuple[int, int, int]] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = self.vocab[left], self.vocab[right]
            made = self.vocab[left + right]
            self.rules.setdefault((a, b), rank)
            self.order.append((a, b, made))
        self.none = len(self.order)
        alphabet = byte_alphabet()
        self.inner = [self.vocab.get(c) for c in alphabet]
        self.final = [self.vocab.get(c + self.suffix) for c in alphabet]

    def lookahead(self) -> int:
        """Symbols that must follow a token's end before it is stable (see the module text)."""
        length: dict[int, int] = {i: 1 for i in (*self.inner, *self.final) if i is not None}
        spine: dict[int, int] = {}  # a token's left part
        best: dict[int, int] = {}
        most = 0
        for a, b, made in self.order:
            far, t = 0, b
            while t is not None:
                far = max(far, best.get(t, 0))
                t = spine.get(t)
            reach = length[a] + far
            most = max(most, reach)
            best[a] = max(best.get(a, 0), reach)
            if made not in length:
                length[made], spine[made] = length[a] + length[b], a
        return most + 1  # the last symbol itself may still become a word end

    def merge(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """Tokens of a symbol sequence and the symbols that each covers: always the
        leftmost pair of the lowest rank."""
        ids, size, get, none = symbols, [1] * len(symbols), self.rules.get, self.none
        ranks = [get(p, none) for p in zip(ids, ids[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            ids[i] = self.order[low][2]
            size[i] += size[i + 1]
            del ids[i + 1], size[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), none)
        return ids, size


class WordTransducer:
    """Bytes of one word in, stable tokens out; the buffer never holds more than a block."""

    def __init__(self, merges: MergeList, lookahead: int):
        self.m, self.look, self.block = merges, lookahead, 3 * lookahead + 64
        self.buf = bytearray()

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        for at in range(0, len(data), self.block):
            self.buf += data[at:at + self.block]
            if len(self.buf) >= self.block:
                ids, size = self.m.merge([self.m.inner[b] for b in self.buf])
                end, keep = 0, len(self.buf) - self.look
                for i, n in zip(ids, size):
                    if end + n > keep:
                        break
                    out.append(i)
                    end += n
                del self.buf[:end]
        return out

    def finish(self) -> list[int]:
        if not self.buf:
            return []
        ids, _ = self.m.merge([*(self.m.inner[b] for b in self.buf[:-1]), self.m.final[self.buf[-1]]])
        self.buf.clear()
        return ids


def _seconds() -> set[str]:
    """Characters that normalisation may join to the one before them."""
    out = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    for c in range(0x300, 0x20000):
        d = unicodedata.decomposition(chr(c))
        if d and d[0] != "<" and len(parts := d.split()) == 2:
            out.add(chr(int(parts[1], 16)))
    return out


def fold(text: str) -> str:
    """The vocabulary file's normalisation, white space apart: NFC, then each character in lower case."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Memo(dict):
    """Ids of short chunks, worked out when first asked for; bounded. When half of the bound is
    reached, only what is asked for again outlives the next half."""

    def __init__(self, work, most: int = MEMO_CHUNKS):
        super().__init__()
        self.work, self.half, self.before = work, most // 2, {}

    def __missing__(self, chunk: str) -> bytes:
        got = self.before.get(chunk)
        if got is None:
            got = self.work(chunk)
        if len(chunk) <= MEMO_CHARS:
            if len(self) >= self.half:
                self.before = dict(self)
                self.clear()
            self[chunk] = got
        return got


class StreamEncoder:
    """Text in by pieces, token ids out (little-endian unsigned 32-bit bytes).

    ``feed`` returns what is stable so far, ``finish`` the rest. What it holds
    is bounded: a chunk of at most LONG_CHUNK characters, or the tail of a long
    one that normalisation, splitting and merging may still change."""

    def __init__(self, merges: MergeList, lookahead: int):
        self.m, self.look = merges, lookahead
        self.space = re.compile(f"[{UNICODE_SPACE}]+")
        self.piece = regex.compile(PIECE)
        self.runs = {k: regex.compile(p) for k, p in (("L", r"\p{L}*"), ("O", r"[^\s\p{L}\p{N}]*"))}
        names = sorted(merges.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.names = names
        self.memo, self.pieces = Memo(self._chunk), Memo(self._piece)
        self.seconds: set[str] | None = None
        self._reset()

    def _reset(self) -> None:
        self.carry = ""            # the chunk that may go on
        self.long = False          # inside a chunk of more than LONG_CHUNK characters:
        self.raw = self.norm = ""  # its tails not yet normalised, not yet split,
        self.word: WordTransducer | None = None  # and its open piece
        self.run = ""

    # -- whole chunks --------------------------------------------------------
    def _piece(self, piece: str) -> bytes:
        w = WordTransducer(self.m, self.look)
        return array("I", w.feed(piece.encode()) + w.finish()).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        out = []
        for i, part in enumerate(self.special.split(chunk) if self.special else [chunk]):
            if i % 2:
                out.append(array("I", [self.m.special[part]]).tobytes())
            else:
                out += map(self.pieces.__getitem__, self.piece.findall(fold(part)))
        return b"".join(out)

    def parts(self, chunks: list[str]) -> list[bytes]:
        """The ids of each of some chunks without white space."""
        return list(map(self.memo.__getitem__, chunks))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text."""
        out = [self.feed(text[at:at + FEED_CHARS]) for at in range(0, len(text), FEED_CHARS)]
        out.append(self.finish())
        return b"".join(out)

    # -- the stream ----------------------------------------------------------
    def feed(self, text: str) -> bytes:
        out = []
        if self.long:
            m = self.space.search(text)
            self.raw += text[:m.start()] if m else text
            out.append(self._long(ends=m is not None))
            if m is None:
                return out[0]
            text = text[m.end():]
        chunks = self.space.split(self.carry + text)
        self.carry = chunks.pop()
        out += self.parts(chunks)
        if len(self.carry) > LONG_CHUNK:
            self.long, self.raw, self.carry = True, self.carry, ""
            out.append(self._long(ends=False))
        return b"".join(out)

    def finish(self) -> bytes:
        out = self._long(ends=True) if self.long else self.memo[self.carry]
        self._reset()
        return out

    def _long(self, ends: bool) -> bytes:
        """Work off a long chunk as far as it is settled."""
        out, raw = [], self.raw
        while self.special and (m := self.special.search(raw)):
            out += self._split(fold(raw[:m.start()]), True)
            out.append(array("I", [self.m.special[m[0]]]).tobytes())
            raw = raw[m.end():]
        cut = len(raw) if ends else self._safe_cut(raw)
        out += self._split(fold(raw[:cut]), ends)
        self.raw = raw[cut:]
        if ends:
            self.long = False
        return b"".join(out)

    def _safe_cut(self, raw: str) -> int:
        """The last place where neither a special token nor a composition can span."""
        if self.seconds is None:
            self.seconds = _seconds()
        cut = len(raw)
        for name in self.names:
            for n in range(1, min(len(name), len(raw) + 1)):
                if raw.endswith(name[:n]):
                    cut = min(cut, len(raw) - n)
        cut -= 1
        while cut > 0 and not (unicodedata.combining(c := raw[cut]) == 0 and c not in self.seconds
                               and unicodedata.normalize("NFC", c) == c):
            cut -= 1
        return max(cut, 0)

    def _split(self, text: str, ends: bool) -> list[bytes]:
        """Split normalised text; the piece at the end stays open unless the chunk ends."""
        out: list[bytes] = []
        text, at, self.norm = self.norm + text, 0, ""
        if self.word:
            at = self.runs[self.run].match(text).end()
            ids = self.word.feed(text[:at].encode())
            if at < len(text) or ends:
                ids += self.word.finish()
                self.word = None
            out.append(array("I", ids).tobytes())
        if self.word:
            return out
        for m in self.piece.finditer(text, at):
            if not ends and (m.end() == len(text) or m.start() + 3 > len(text)):
                if len(m[0]) > LONG_CHUNK // 4:
                    self.run = "L" if regex.match(r"\p{L}", m[0]) else "O"
                    self.word = WordTransducer(self.m, self.look)
                    out.append(array("I", self.word.feed(m[0].encode())).tobytes())
                else:
                    self.norm = text[m.start():]
                return out
            out.append(self.pieces[m[0]])
        return out


class StreamDecoder:
    """Ids in, text out, by an incremental byte-to-text state machine.

    ``surface`` "vocabulary" writes the vocabulary's strings with blanks between
    (the tokenizers library without a decoder); "text" restores bytes and turns
    word ends into blanks. An unfinished UTF-8 sequence waits for the next token;
    bytes that form no character become U+FFFD."""

    def __init__(self, merges: MergeList, surface: str = "vocabulary"):
        self.state = codecs.getincrementaldecoder("utf-8")("replace")
        self.between = b" " if surface == "vocabulary" else b""
        if surface == "vocabulary":
            self.bytes = {i: s.encode() for i, s in merges.surface.items()}
        else:
            of = {c: bytes([b]) for b, c in enumerate(byte_alphabet())}
            end = merges.suffix
            special = set(merges.special.values())
            self.bytes = {
                i: s.encode() if i in special else b"".join(of[c] for c in s.removesuffix(end)) + b" " * s.endswith(end)
                for i, s in merges.surface.items()
            }
        self.begun = False

    def feed(self, ids: Iterable[int]) -> str:
        data = self.between.join(map(self.bytes.__getitem__, ids))
        if self.begun and data:
            data = self.between + data
        self.begun = self.begun or bool(data)
        return self.state.decode(data)

    def finish(self) -> str:
        self.begun = False
        out = self.state.decode(b"", True)
        self.state.reset()
        return out


SCHEMA = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])
DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string())])


def _encode_task(tokenizer, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, lookahead = tokenizer.value
        merges = MergeList(text)
        encoder, decoder = StreamEncoder(merges, lookahead), StreamDecoder(merges)
        sink = RowSink(DIGESTS if digests else SCHEMA, 4096 if digests else 64)
        for doc_id, text in rows_of(batches):
            n, hashed, shown, ids_kept, text_kept = 0, hashlib.sha256(), hashlib.sha256(), [], []

            def take(data: bytes):
                nonlocal n
                n += len(data) // 4
                out = decoder.feed(array("I", data))
                if digests:
                    hashed.update(data)
                    shown.update(out.encode())
                else:
                    ids_kept.append(data)
                    text_kept.append(out)

            for at in range(0, len(text), FEED_CHARS):
                take(encoder.feed(text[at:at + FEED_CHARS]))
            take(encoder.finish())
            tail = decoder.finish()
            if digests:
                shown.update(tail.encode())
                sink.add(doc_id, n, hashed.hexdigest(), shown.hexdigest())
            else:
                sink.add(doc_id, b"".join(ids_kept), "".join(text_kept) + tail)
            if sink.full:
                yield sink.batch()
        yield sink.batch()

    return run


def broadcast_tokenizer(spark, path: str):
    """The tokenizer file's text and its lookahead; its size is the vocabulary's, whatever the data."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    return spark.sparkContext.broadcast((text, MergeList(text).lookahead()))


def encode_documents(docs: DataFrame, tokenizer_path: str, digests: bool = False) -> DataFrame:
    """Encode every whole text and decode its ids again; no shuffle.

    Returns (doc_id, ids as little-endian unsigned 32-bit binary, decoded), or
    with ``digests`` (doc_id, n_tokens, ids_sha256, decoded_sha256). A null text
    counts as empty and gives no ids; a null doc_id stays null; repeated rows
    give repeated results; further columns are not read; an empty table gives
    none. Texts are fed by pieces, so a very long one needs no more memory than
    its row."""
    task = _encode_task(broadcast_tokenizer(docs.sparkSession, tokenizer_path), digests)
    schema = ("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests
              else "doc_id long, ids binary, decoded string")
    return map_arrow(texts_of(docs), task, schema)
