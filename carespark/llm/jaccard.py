"""Exact n-gram Jaccard self-join that uses relations between sets.

A document is the set of its distinct word shingles (64-bit hashes). All sets
share one order of shingles. Two sets of sizes a and b that link have at least
t * max(a, b) shingles in common, so they share one of their first
n - ceil(t * n) + 1 shingles, their *prefixes*.

1. One pass over the texts gives each set's size and digest, and counts words and
   shingles that repeat within a task. The order puts shingles of rare words
   first and shingles that repeat often last; both tables have a bounded size,
   and the order decides speed, never results. Equal sets become one: the
   smallest doc_id stands for them.
2. A second pass emits prefix shingles. Index lists are split by size, as only sets
   of like size link. The smallest doc_id of each list is its *leader*; a member only
   meets the leaders of its lists. Two sets that link share a list, so they meet under
   its leader. No pair of members is emitted.
3. Members travel to their leaders (those with very many members as pairs of chunks).
   First only outlines do, counts of hashes by range that bound what two sets share:
   members that cannot link with any other go no further. The rest bring their sets; ``link_cluster`` joins them exactly:
   - answers are derived from the leader's: with d(P, y) the size of the
     symmetric difference, |d(P, y) - d(P, z)| <= d(y, z) <= d(P, y) + d(P, z)
     decides most pairs without looking at their sets, and members that are
     already connected need no answer at all;
   - the rest probe index lists that are sorted by the shingles left after an
     entry's position: the block of entries that cannot reach the required
     overlap is skipped by one binary search.
4. Links become components by alternating stars on tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespark.llm.common import RowSink, map_arrow, rows_of, write_stage
from carespark.llm.components import connected_components

FREQUENT_SHINGLES = 1 << 18  # at most so many go to the end of the order
FREQUENT_FROM = 4            # repeats that make a shingle frequent
COMMON_WORDS = 1 << 16       # at most so many count as common
LAST = np.uint64(1 << 10)    # the score from which frequent shingles go on
COUNT_BLOCK = 1 << 19        # shingles counted at a time
CHUNK_SHINGLES = 1 << 20     # of one leader's members in one task, per chunk
CHUNK_OUTLINES = 1 << 24     # the same while only their outlines travel
MEMBER_SHINGLES = 64         # what a member counts for besides its shingles, so that chunks
MEMBER_OUTLINE = 1024        # of very small sets stay small too
FILTER_BITS = 1 << 23        # of the filter for documents that any leader meets
WORDS_KEPT = 150_000         # word hashes a worker remembers
SETS_KEPT = 50_000          # digests a worker remembers to emit equal sets once


class WordHashes(dict):
    """58-bit hashes of words, with a word's commonness (see ``commonness``) in the low 6 bits."""

    def __init__(self, common: dict[int, int]):
        super().__init__()
        self.common = common

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word) & ~63
        h = self[word] = h | self.common.get(h, 0)
        return h


class Shingler:
    """Shingle hashes of a text (UTF-8), A-Z lower-cased, and their words' added
    commonness; words are runs without ASCII white space, which is how bytes.lower()
    and bytes.split() see text. ``self.words`` keeps the word hashes of the last text."""

    def __init__(self, words: int, common: tuple[np.ndarray, np.ndarray] | None = None):
        self.k = words
        self.memo = WordHashes(dict(zip(common[0].tolist(), common[1].tolist())) if common else {})
        rng = np.random.Generator(np.random.PCG64(words))
        self.odd = [np.uint64(x | 1) for x in rng.integers(0, 1 << 63, words, dtype=np.uint64)]
        self.words = self.none = np.empty(0, np.uint64)

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        words = data.lower().split()
        n = len(words)
        if n < self.k:
            self.words = self.none
            one = [xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)] if n else []
            return np.array(one, np.uint64), np.zeros(len(one), np.uint64)
        h = np.fromiter(map(self.memo.__getitem__, words), np.uint64, n)
        score = h & np.uint64(63)
        h ^= score
        self.words, m = h, n - self.k + 1
        s, common = h[:m] * self.odd[0], score[:m].copy()
        for j in range(1, self.k):
            s += h[j:m + j] * self.odd[j]
            common += score[j:m + j]
        s ^= s >> np.uint64(32)
        s *= np.uint64(0xD6E8FEB86659FD93)
        s ^= s >> np.uint64(32)
        return s, common


def distinct(s: np.ndarray) -> np.ndarray:
    """Ascending distinct values."""
    s = np.sort(s)
    return s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) else s


def outline(s: np.ndarray) -> bytes:
    """How many of a set's hashes fall into each of some equal ranges: 4 to 8 a range on
    average, as one byte each, 255 for more. The number of ranges is a power of two."""
    bits = max(3, (max(len(s) - 1, 1) // 8).bit_length())
    return np.minimum(np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _unfold(data: bytes) -> np.ndarray:
    c = np.frombuffer(data, np.uint8).astype(np.int32)
    c[c == 255] = 1 << 24     # any number
    return c


def may_link(outlines: list[bytes], sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether each set may link with another one. Two sets share at most the sum over the ranges
    of the smaller of their counts, so no set that links is refused."""
    m = len(outlines)
    out = np.zeros(m, bool)
    rows = [_unfold(o) for o in outlines]
    order = sorted(range(m), key=lambda i: len(rows[i]))
    for width in sorted({len(r) for r in rows}):
        # the sets of this many ranges, then the wider ones folded to as many
        wider = [i for i in order if width <= len(rows[i]) <= 2 * -(-100 // percent) * width]
        table = np.stack([rows[i].reshape(width, -1).sum(1) for i in wider])
        n = sizes[wider]
        for at, y in enumerate(wider):
            if len(rows[y]) != width:
                break
            others = table[at + 1:]
            if not len(others):
                break
            near = 100 * np.minimum(n[at + 1:], n[at]) >= percent * np.maximum(n[at + 1:], n[at])
            if not near.any():
                continue
            z = np.flatnonzero(near)
            most = np.minimum(others[z], table[at]).sum(1)
            hit = z[(100 + percent) * most >= percent * (n[at + 1:][z] + n[at])]
            if len(hit):
                out[y] = True
                out[np.array(wider)[hit + at + 1]] = True
    return out


def prefix(s: np.ndarray, score: np.ndarray, size: int, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first ``size`` distinct shingles of s in the order (score, hash), where a shingle of the
    sorted table ``frequent`` has its rank for score. Only as much is sorted as needed."""
    key = score << np.uint64(52) | s >> np.uint64(12)
    m = min(len(s), 3 * size + 8)
    while True:
        at = np.argpartition(key, m - 1)[:m] if m < len(s) else np.arange(m)
        at = at[np.lexsort((s[at], key[at]))]
        t = s[at]
        new = np.concatenate(([True], t[1:] != t[:-1]))
        t, own = t[new], score[at[new]]
        if not len(frequent):
            often = np.zeros(len(t), bool)
        else:
            place = np.minimum(np.searchsorted(frequent, t), len(frequent) - 1)
            often = frequent[place] == t
        if len(t) - often.sum() >= size:
            return t[~often][:size]
        if m == len(s):
            late = t[often]
            return np.concatenate((t[~often], late[np.lexsort((late, rank[place[often]]))]))[:size]
        m = len(s)


def commonness(counts: np.ndarray) -> np.ndarray:
    """Twice the binary logarithm of a count, 0 to 63."""
    return np.minimum(2 * np.log2(counts), 63).astype(np.int64)


def prefix_size(n: int, percent: int) -> int:
    """First shingles of a set of n of which linked sets share one."""
    return n - -(-percent * n // 100) + 1


def _profile_task(words: int):
    schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("n", pa.int64()),
                        ("outline", pa.binary())])

    def repeats(kind: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        u, n = np.unique(np.concatenate(parts), return_counts=True)
        u, n = u[n > 1].view(np.int64), n[n > 1]
        none = pa.nulls(len(u), pa.int64())
        return pa.record_batch([pa.array(np.full(len(u), kind, np.int32)), pa.array(u), none, none, pa.array(n), pa.nulls(len(u), pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, sink, parts, texts, held = Shingler(words), RowSink(schema), [], [], 0
        for doc_id, data in rows_of(batches):
            s = distinct(shingle(data)[0])
            d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
            sink.add(0, doc_id, int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True), len(s),
                     outline(s) if len(s) else None)
            parts.append(s)
            texts.append(shingle.words)
            held += len(shingle.words)
            if held >= COUNT_BLOCK:
                yield repeats(1, parts)
                yield repeats(2, texts)
                parts, texts, held = [], [], 0
            if sink.full:
                yield sink.batch()
        if parts:
            yield repeats(1, parts)
            yield repeats(2, texts)
        yield sink.batch()

    return run


def _prefix_task(words: int, percent: int, tables):
    schema = pa.schema([("token", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, frequent, rank = tables.value
        shingle, seen, parts, held = Shingler(words, common), set(), [], 0

        def batch():
            return pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*parts)], schema=schema)

        for doc_id, data in rows_of(batches):
            s, score = shingle(data)
            if not len(s):
                continue
            same = xxhash.xxh3_128_digest(shingle.words.tobytes() or data.lower())
            if same in seen:
                continue
            if len(seen) >= SETS_KEPT:
                seen.clear()
            seen.add(same)
            n = len(distinct(s))
            first = prefix(s, score, prefix_size(n, percent), frequent, rank)
            parts.append((first.view(np.int64), np.full(len(first), doc_id, np.int64), np.full(len(first), n, np.int32)))
            held += len(first)
            if held >= 1 << 16:
                yield batch()
                parts, held = [], 0
        if parts:
            yield batch()

    return run


def _sets_task(words: int, wanted):
    schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        shingle, sink = Shingler(words), RowSink(schema, 512)
        for doc_id, data, place in rows_of(batches):
            if bits[place >> 6] >> (place & 63) & 1:
                s = distinct(shingle(data)[0])
                if len(s):
                    sink.add(doc_id, s.tobytes())
            if sink.full:
                yield sink.batch()
        yield sink.batch()

    return run


def _overlaps(x: np.ndarray, tokens: np.ndarray, starts: np.ndarray, sizes: np.ndarray, mark: np.ndarray, of=None) -> np.ndarray:
    """Sizes of the intersections of token set x with all sets (or those in ``of``)."""
    mark[x] = True
    if of is None:
        out = np.add.reduceat(mark[tokens], starts, dtype=np.int64)
    else:
        n = sizes[of]
        begin = np.cumsum(n) - n
        at = np.arange(int(n.sum())) + np.repeat(starts[of] - begin, n)
        out = np.add.reduceat(mark[tokens[at]], begin, dtype=np.int64)
    mark[x] = False
    return out


def link_cluster(sets: list[np.ndarray], leader: int, percent: int) -> np.ndarray:
    """A label for each set; sets have equal labels iff links within the cluster connect them."""
    m = len(sets)
    comp = np.arange(m)
    sizes = np.array([len(s) for s in sets], np.int64)
    if m <= 3:
        for y in range(1, m):
            for z in range(y):
                if comp[y] != comp[z] and min(sizes[y], sizes[z]) * 100 >= percent * max(sizes[y], sizes[z]):
                    both = len(np.intersect1d(sets[y], sets[z], assume_unique=True))
                    if (100 + percent) * both >= percent * (sizes[y] + sizes[z]):
                        comp[comp == comp[y]] = comp[z]
        return comp
    _, tokens, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    starts = np.cumsum(sizes) - sizes
    mark = np.zeros(len(df), bool)

    def own(y):
        return tokens[starts[y]:starts[y] + sizes[y]]

    # the leader's answers for all members
    both = _overlaps(own(leader), tokens, starts, sizes, mark)
    comp[(100 + percent) * both >= percent * (sizes + sizes[leader])] = leader
    probes = np.flatnonzero(comp != leader)
    if not len(probes):
        return comp
    far = sizes + sizes[leader] - 2 * both       # d(leader, y)
    # index lists: each set's prefix, rarest shingles of the cluster first
    row = np.repeat(np.arange(m), sizes)
    order = np.lexsort((tokens, df[tokens], row))
    ranked = tokens[order]
    place = np.arange(len(ranked)) - starts[row]
    reach = np.array([prefix_size(int(n), percent) for n in sizes])
    inside = place < reach[row]
    e_token, e_set, e_left = ranked[inside], row[inside], (sizes[row] - place)[inside]
    by = np.lexsort((-e_left, e_token))
    e_token, e_set, e_left = e_token[by], e_set[by], e_left[by]
    list_at = np.searchsorted(e_token, np.arange(len(df) + 1))
    for y in probes.tolist():
        size, found = int(sizes[y]), []
        need = -(-percent * size // 100)
        prefix = ranked[starts[y]:starts[y] + min(reach[y], size)]
        for i, tok in enumerate(prefix.tolist()):
            a, b = list_at[tok], list_at[tok + 1]
            if b - a > 1:
                # entries are in blocks by position: those with too little left are skipped together
                b = a + np.searchsorted(-e_left[a:b], -need, side="right")
                z = e_set[a:b]
                found.append(z[percent * sizes[z] <= 100 * (size - i)])
        if not found:
            continue
        z = np.unique(np.concatenate(found))
        z = z[(comp[z] != comp[y]) & (100 * np.minimum(sizes[z], size) >= percent * np.maximum(sizes[z], size))]
        most = (100 - percent) * (sizes[z] + size)   # links iff (100 + percent) * d <= most
        z_all, sure = z, (100 + percent) * (far[z] + far[y]) <= most
        maybe = ~sure & ((100 + percent) * np.abs(far[z] - far[y]) <= most)
        links = z_all[sure]
        z = z_all[maybe]
        if len(z):
            both = _overlaps(own(y), tokens, starts, sizes, mark, z)
            links = np.concatenate((links, z[(100 + percent) * both >= percent * (sizes[z] + size)]))
        if len(links):
            labels = np.unique(np.append(comp[links], comp[y]))
            comp[np.isin(comp, labels)] = labels[0]
    return comp


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first columns, as they come."""
    key, rows = None, []
    for r in rows_of(batches):
        if r[:keys] != key:
            if len(rows) > 1:
                yield key, rows
            key, rows = r[:keys], []
        rows.append(r[keys:])
    if len(rows) > 1:
        yield key, rows


def _sift_task(percent: int):
    schema = pa.schema([("leader", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = RowSink(schema)
        for (leader, _, _), rows in _grouped(batches, 3):
            kept = may_link([o for _, _, o in rows], np.array([n for _, n, _ in rows]), percent)
            for (doc_id, _, _), k in zip(rows, kept.tolist()):
                if k:
                    sink.add(leader, doc_id)
            if sink.full:
                yield sink.batch()
        yield sink.batch()

    return run


def _cluster_task(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = RowSink(schema)
        for (leader, _, _), rows in _grouped(batches, 3):
            ids = np.array([i for i, _ in rows], np.int64)
            first = np.flatnonzero(ids == leader)
            comp = link_cluster([np.frombuffer(s, np.uint64) for _, s in rows], int(first[0]) if len(first) else 0, percent)
            order = np.lexsort((ids, comp))
            comp, ids = comp[order], ids[order]
            head = np.concatenate(([True], comp[1:] != comp[:-1]))
            low = ids[head][np.cumsum(head) - 1]
            for a, b in zip(ids[ids != low].tolist(), low[ids != low].tolist()):
                sink.add(a, b)
            if sink.full:
                yield sink.batch()
        yield sink.batch()

    return run


def _chunked(members: DataFrame, weight, limit: int) -> DataFrame:
    """Rows of ``members`` (leader, doc_id, ...) placed into pairs of chunks (leader, i, j): each two
    members of a leader meet in one of them, and no chunk outweighs ``limit``."""
    parts = members.groupBy("leader").agg(F.ceil(F.sum(weight) / limit).cast("int").alias("k"))
    d = members.join(parts, "leader").withColumn("mine", F.pmod(F.xxhash64("doc_id"), F.col("k")).cast("int"))
    places = F.when(F.col("k") == 1, F.expr("array(struct(0 as i, 0 as j))")).otherwise(
        F.expr("transform(sequence(0, k - 1), x -> struct(least(x, mine) as i, greatest(x, mine) as j))"))
    return d.withColumn("place", F.explode(places)).select("leader", "place.i", "place.j", *members.columns[1:])


def _filter(ids: DataFrame) -> np.ndarray:
    """A bit set of FILTER_BITS over the hashes of ids; other documents may pass, none is lost."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = ids.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS >> 6, np.int64)
    out[words["w"].to_numpy()] = words["bits"].to_numpy()
    return out


def _most(counted: DataFrame, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of the largest sums and the sums; at most ``most``, whatever the data."""
    t = counted.groupBy("a").agg(F.sum("n").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "a").limit(most).toArrow()
    return t["a"].to_numpy(), t["n"].to_numpy()


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Link documents whose shingle sets have a Jaccard likeness of ``percent`` / 100 or more.

    Returns a row for each input row: (doc_id, n_shingles, component_id), the
    smallest doc_id that links reach, itself included. Exact but for collisions of
    64-bit hashes. A text of fewer words is one shingle; a null or empty text has
    none and links to nothing. A null doc_id links to nothing and has a null
    component. Rows that share a doc_id are one document: their links unite.
    Repeated rows give repeated results; further columns are not read; an empty
    table gives none."""
    if words < 1 or not 1 <= percent <= 99:
        raise ValueError("words must be 1 or more, percent 1 to 99")
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))
    profile = write_stage(map_arrow(d, _profile_task(words), "kind int, a long, b long, c long, n long, outline binary"), "profile")
    often = _most(profile.where("kind = 1"), FREQUENT_FROM, FREQUENT_SHINGLES)
    often = (often[0].view(np.uint64), LAST + commonness(often[1]).astype(np.uint64))
    order = np.argsort(often[0])
    usual = _most(profile.where("kind = 2"), 2, COMMON_WORDS)
    tables = spark.sparkContext.broadcast(((usual[0].view(np.uint64), commonness(usual[1])), often[0][order], often[1][order]))

    rows = profile.where("kind = 0").select(F.col("a").alias("doc_id"), "b", "c", "n")
    known = d.where("doc_id is not null")
    postings = write_stage(map_arrow(known, _prefix_task(words, percent, tables), "token long, doc_id long, n int"), "prefixes")
    shared = postings.groupBy("token").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low != high")
    # only sets of like size can link: lists are split by size classes, each list holding two neighbouring ones
    level = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent)) + 1e-9).cast("int")
    lists = write_stage(postings.join(shared.select("token"), "token").select(
        "token", "doc_id", F.explode(F.array(level, level + 1)).alias("level")), "lists")
    leaders = lists.groupBy("token", "level").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last")).where("leader != last")
    met = lists.join(leaders.select("token", "level", "leader"), ["token", "level"]).where("doc_id != leader").select(
        "leader", "doc_id").distinct()

    # equal sets are one: the smallest doc_id stands for all. Only sets that occur more than once
    # have a row of their own here, so a widespread one meets a table of known, small size
    heads = write_stage(rows.where("n > 0").groupBy("b", "c").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("times"))
                        .where("times > 1").select("b", "c", "head"), "heads")
    rows = write_stage(rows.join(heads, ["b", "c"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("head", "doc_id")).alias("rep")), "sizes")
    rep = rows.where("doc_id is not null and rep is not null").groupBy("doc_id").agg(
        F.min("rep").alias("rep"), F.max("rep").alias("rep2"), F.max("n_shingles").alias("n"))
    # a doc_id with several texts stands for itself
    own = F.when(F.col("rep") == F.col("rep2"), F.col("rep")).otherwise(F.col("doc_id"))
    rep = rep.select("doc_id", own.alias("rep"), "n")
    met = met.join(rep.select("doc_id", F.col("rep").alias("y"), "n"), "doc_id") \
        .join(rep.select(F.col("doc_id").alias("leader"), F.col("rep").alias("p"), F.col("n").alias("pn")), "leader") \
        .where("p != y").groupBy("p", "y").agg(F.max("n").alias("n"), F.max("pn").alias("pn"))
    met = write_stage(met, "met")
    members = met.select(F.col("p").alias("leader"), F.col("y").alias("doc_id"), "n").unionAll(
        met.groupBy("p").agg(F.max("pn").alias("n")).select(F.col("p").alias("leader"), F.col("p").alias("doc_id"), "n"))
    # outlines refuse most members that only share a few shingles, before whole sets travel
    drawn = profile.where("kind = 0 and a is not null and n > 0").select(F.col("a").alias("doc_id"), F.col("n").alias("size"), "outline")
    outlines = _chunked(members.select("leader", "doc_id", "n"), F.col("n") + MEMBER_OUTLINE, CHUNK_OUTLINES).join(drawn, "doc_id")
    outlines = outlines.select("leader", "i", "j", "doc_id", "size", "outline").repartition("leader", "i", "j") \
        .sortWithinPartitions("leader", "i", "j", "doc_id")
    sifted = map_arrow(outlines, _sift_task(percent), "leader long, doc_id long").distinct()
    members = write_stage(members.join(sifted, ["leader", "doc_id"], "left_semi"), "members")
    wanted = spark.sparkContext.broadcast(_filter(members.select("doc_id")))
    sets = map_arrow(known.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))),
                     _sets_task(words, wanted), "doc_id long, shingles binary")
    clusters = _chunked(members, F.col("n") + MEMBER_SHINGLES, CHUNK_SHINGLES).join(sets, "doc_id").select("leader", "i", "j", "doc_id", "shingles") \
        .repartition("leader", "i", "j").sortWithinPartitions("leader", "i", "j", "doc_id")
    edges = map_arrow(clusters, _cluster_task(percent), "a long, b long")
    # the texts of a repeated doc_id unite
    several = rows.where("doc_id is not null and rep is not null").select("doc_id", "rep").distinct()
    several = several.join(several.groupBy("doc_id").count().where("count > 1"), "doc_id", "left_semi")
    roots = connected_components(edges.unionAll(several.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))))
    return rows.join(roots, F.col("rep") == F.col("node"), "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "rep", "doc_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents that are the smallest doc_id of their component, with all columns.

    Null, empty and wordless texts and rows without a doc_id link to nothing and stay; rows that share
    a doc_id are one document and stay or go together; further columns pass as they are; an empty
    table gives none."""
    dropped = jaccard_components(docs, words, percent).where("doc_id != component_id").select(
        F.col("doc_id").alias("dropped_id")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["dropped_id"], "left_anti")
