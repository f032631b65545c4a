"""Scoring with an interpolated modified Kneser-Ney model of order two or three.

Tokens are lower-cased words and one end of text; a start precedes the first.  Spark jobs count the training texts order by order: (1) words, into
sorted arrays of 64-bit hashes, where a word's place is its number; (2) bigrams, sorted by context number and word number, where a bigram's
place is its number; (3) trigrams, whose context is a bigram's number.  The highest order keeps counts; a lower one keeps with how many different
tokens before it an entry was seen (bigrams that begin a text, which have none, keep counts).  The discounts of an order come from the numbers of
its entries seen one to four times (Chen & Goodman, 1998).  P(w | uv) = max(c(uvw) - D, 0) / c(uv) + g(uv) P(w | v), and so on down to a uniform
1 / (V + 1), which is also what an unknown word gets.  A context that was never seen leaves the lower order's value.  Scoring is one more pass
whose workers memory-map the arrays.

Storage: 4 bytes for each word number of an entry, one for its count (larger ones in a list of their own) and 4 for each context, which says where its
entries end.  Sums of a context are added up when read; those of contexts with over 64 entries are stored.

Identity: words are 64-bit hashes.  Counts have 64 bits.  Word numbers have 32 bits; more than 2^32 distinct words raise an error, and so do more
bigrams than fit beside a word number in 64 bits.

Scale: each task sums its own counts and sends them as packed, compressed sorted runs, one for each shard; shards follow
spark.sql.shuffle.partitions and are equal ranges of context numbers.  A shard is added up and written in pieces, ranges of contexts that hold PIECE
training tokens on average whatever the input, so a task holds the distinct entries of a piece, not one for each task that saw them; the entries of one
context are in one piece, at most as many as there are words.  The driver gets one row for each shard.  The model is in the
shared folder, never broadcast; it grows with the number of distinct entries.  Workers map it where the folder is mounted; from a store
that is not mounted each worker process copies the files it reads to its own disk first, which a large model does not allow: mount the
folder then.  Look-ups are sorted first, so they read the mapped arrays in order.

Nulls: a null text is empty and has one token, the end.  Rows with a null id are scored and not learned from.  Repeated rows count each.
Without training rows V and N are 0 and every token gets probability 1 / (V + 1) = 1.  An empty table gives an empty result.
Texts of any length are read whole.  Extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit
from .common import Workspace, arrow_rows, id_crc, table
from .mapped import Growing, map_array, write_array

END = np.uint64(0x0123456789ABCDEF)
HELD = 3_000_000
ORDER = 3
PIECE = 2_000_000  # training tokens whose entries a task adds up at a time, on average
MANY = 64  # contexts with more entries have stored sums


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows and the rows' offsets among them; each row ends with END."""
    h, at = textkit.word_hashes(data, off)
    rows = len(off) - 1
    ends = at[1:] + np.arange(rows)
    out = np.full(len(h) + rows, END)
    word = np.ones(len(out), bool)
    word[ends] = False
    out[word] = h
    return out, np.concatenate(([0], ends + 1))


def pack(a: np.ndarray) -> bytes:
    """A sorted or small-valued array of unsigned 64-bit integers: differences, byte by byte place, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(b: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).ravel()


_PACKED = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def packed_rows(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
    """Rows of packed runs; keys are sorted and distinct."""
    order = np.argsort(shard, kind="stable")
    keys, counts, shard = keys[order], counts[order].astype(np.uint64), shard[order]
    cut = np.concatenate(([0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(keys)])) if len(keys) else [0]
    parts = [(int(shard[i]), pack(np.diff(keys[i:j], prepend=np.uint64(0))), pack(counts[i:j])) for i, j in zip(cut[:-1], cut[1:])]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*parts) if parts else ([], [], []), _PACKED)], schema=_PACKED)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1)) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(keys) else counts


class Tally:
    """Adds up keys in a task; takes them back as packed runs when it is full and at the end."""

    def __init__(self, shard_of):
        self.shard_of, self.parts, self.size = shard_of, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        k, n = np.unique(keys, return_counts=True)
        self.parts.append((k, n.astype(np.uint64)))
        self.size += len(k)
        if self.size > HELD:
            yield from self.take()

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            k, n = summed(np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts]))
            yield packed_rows(k, n, self.shard_of(k))
        self.parts, self.size = [], 0


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, distinct keys, sums) of rows that come sorted by shard."""
    now, runs, size = None, [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        return summed(np.concatenate([k for k, _ in runs]), np.concatenate([c for _, c in runs]))

    for batch in batches:
        for s, k, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if s != now and runs:
                yield (now, *merged())
                runs, size = [], 0
            now = s
            runs.append((np.cumsum(unpack(k), dtype=np.uint64), unpack(c)))
            size += len(runs[-1][0])
            # runs of many tasks are added up as they come: held are the distinct keys and at most as many more
            if len(runs) > 1 and size > max(HELD, 2 * len(runs[0][0])):
                runs = [merged()]
                size = len(runs[0][0])
    if runs:
        yield (now, *merged())


def deal(runs: DataFrame, pieces: int = 1) -> DataFrame:
    """Packed runs, one shard after another; so many pieces, numbered in their column shard, make a shard."""
    return runs.repartition(F.expr(f"shard div {pieces}")).sortWithinPartitions("shard")


def discounts(n: list[int]) -> tuple[float, float, float, float]:
    """0 and the discounts of counts of one, two, and three or more, from the numbers of entries seen one to four times."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    d = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5 for k in (1, 2, 3)]
    return (0.0, *(min(max(x, 0.05), k) for k, x in zip((1.0, 2.0, 3.0), d)))


def shifted(a: np.ndarray, off: np.ndarray, first: int) -> np.ndarray:
    """The value of the token before each; first for a row's first token."""
    out = np.concatenate(([first], a[:-1]))
    out[off[:-1]] = first
    return out


def lookup(words: np.ndarray, lo: np.ndarray, hi: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Where each w is in words[lo:hi], which ascends; -1: nowhere."""
    at, lo, hi = np.full(len(w), -1), lo.copy(), hi.copy()
    todo = np.flatnonzero(lo < hi)
    while len(todo):
        a, b = lo[todo], hi[todo]
        mid = (a + b) >> 1
        x, y = words[mid], w[todo]
        at[todo[x == y]] = mid[x == y]
        less = x < y
        a, b = np.where(less, mid + 1, a), np.where(less, b, mid)
        lo[todo], hi[todo] = a, b
        todo = todo[(a < b) & (x != y)]
    return at


@dataclass
class Model:
    """Where the arrays are, and the few numbers that the driver holds.  Orders are keys: 1 words, 2 bigrams, 3 trigrams."""

    root: str
    shards: int  # a power of two
    order: int = ORDER
    total: int = 0
    first: dict[int, list[int]] = field(default_factory=dict)  # number of the first entry of each shard, and of all
    block: dict[int, int] = field(default_factory=dict)  # context numbers (order 1: word numbers) of a shard
    piece: dict[int, int] = field(default_factory=dict)  # context numbers of a piece
    d: dict[int, tuple[float, ...]] = field(default_factory=dict)  # discounts
    types: int = 0  # sum of what the words keep
    rest: float = 1.0  # weight of the uniform distribution

    @property
    def size(self) -> int:
        return self.first[1][-1] if self.first else 0

    @property
    def bits(self) -> int:
        """Of a word number in a key; size: unknown, size + 1: start."""
        return (self.size + 1).bit_length()

    def file(self, name: str, n: int, s: int, dtype) -> np.ndarray:
        return np.asarray(map_array(f"{self.root}/{name}{n}-{s}", dtype))

    def word_shard(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.shards.bit_length() + 1)).astype(np.int64) if self.shards > 1 else np.zeros(len(h), np.int64)

    def numbers(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (size: unknown) and training count of each hash."""
        u, at = np.unique(h, return_inverse=True)
        num, cnt = np.full(len(u), self.size, np.int64), np.zeros(len(u), np.int64)
        edges = np.searchsorted(self.word_shard(u), np.arange(self.shards + 1))
        for s in range(self.shards):
            i, j, n = edges[s], edges[s + 1], self.first[1][s + 1] - self.first[1][s]
            if i == j or not n:
                continue
            keys = self.file("hashes", 1, s, np.uint64)
            p = np.minimum(np.searchsorted(keys, u[i:j]), n - 1)
            hit = keys[p] == u[i:j]
            num[i:j][hit] = p[hit] + self.first[1][s]
            cnt[i:j][hit] = self.file("times", 1, s, np.int64)[p[hit]]
        return num[at], cnt[at]

    def keyed(self, context: np.ndarray, num: np.ndarray) -> np.ndarray:
        return context.astype(np.uint64) << np.uint64(self.bits) | num.astype(np.uint64)

    def parted(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context and word numbers of keys."""
        return (keys >> np.uint64(self.bits)).astype(np.int64), (keys & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def visit(self, n: int, keys: np.ndarray) -> Iterator[tuple]:
        """(shard, slice of the keys, contexts in the shard, begins and ends of their entries, places of the keys' entries) for ascending keys."""
        context, w = self.parted(keys)
        edges = np.searchsorted(context, np.arange(self.shards + 1) * self.block[n])
        for s in range(self.shards):
            i, j = edges[s], edges[s + 1]
            if i == j or self.first[n][s] == self.first[n][s + 1]:
                continue
            local, ends = context[i:j] - s * self.block[n], self.file("ends", n, s, np.uint32)
            lo, hi = ends[local].astype(np.int64), ends[local + 1].astype(np.int64)
            yield s, slice(i, j), local, lo, hi, lookup(self.file("words", n, s, np.uint32), lo, hi, w[i:j])

    def entries(self, n: int, keys: np.ndarray) -> np.ndarray:
        """Numbers of the entries of ascending keys; -1: none."""
        out = np.full(len(keys), -1)
        for s, part, _, _, _, at in self.visit(n, keys):
            out[part] = np.where(at < 0, -1, at + self.first[n][s])
        return out

    def last_words(self, n: int, e: np.ndarray) -> np.ndarray:
        """Word numbers at the end of entries, for ascending numbers of entries."""
        out, edges = np.zeros(len(e), np.int64), np.searchsorted(e, self.first[n])
        for s, (i, j) in enumerate(zip(edges[:-1], edges[1:])):
            if i < j:
                out[i:j] = self.file("words", n, s, np.uint32)[e[i:j] - self.first[n][s]]
        return out

    def counts(self, n: int, s: int, at: np.ndarray) -> np.ndarray:
        c = self.file("counts", n, s, np.uint8)[at].astype(np.int64)
        large = np.flatnonzero(c == 255)
        if len(large):
            c[large] = self.file("large", n, s, np.int64)[np.searchsorted(self.file("where", n, s, np.int64), at[large])]
        return c

    def sums(self, n: int, s: int, local: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Total, and entries with counts of one, two and more, of contexts with entries."""
        out = np.zeros((len(local), 4), np.int64)
        size = hi - lo
        few, many = np.flatnonzero(size <= MANY), np.flatnonzero(size > MANY)
        if len(few):
            begin = np.cumsum(size[few]) - size[few]
            c = self.counts(n, s, np.repeat(lo[few] - begin, size[few]) + np.arange(size[few].sum()))
            out[few] = np.column_stack([np.add.reduceat(x.astype(np.int64), begin) for x in (c, c == 1, c == 2, c > 2)])
        if len(many):
            known = self.file("sums", n, s, np.int64).reshape(-1, 5)
            out[many] = known[np.searchsorted(known[:, 0], local[many]), 1:]
        return out

    def step(self, n: int, context: np.ndarray, num: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry (-1: none) and probability of each token in order n, from its context (-1: none), word and probability in the order below."""
        live = np.flatnonzero(context >= 0)
        keys, one, back = np.unique(self.keyed(context[live], num[live]), return_index=True, return_inverse=True)
        found, q, d = np.full(len(keys), -1), p[live][one], np.array(self.d[n])
        for s, part, local, lo, hi, at in self.visit(n, keys):
            found[part] = np.where(at < 0, -1, at + self.first[n][s])
            seen = np.flatnonzero(lo < hi)
            if not len(seen):
                continue
            new = np.diff(local[seen], prepend=-1) > 0
            each = seen[new]
            about = self.sums(n, s, local[each], lo[each], hi[each])[np.cumsum(new) - 1]
            c = np.zeros(len(seen), np.int64)
            hit = np.flatnonzero(at[seen] >= 0)
            c[hit] = self.counts(n, s, at[seen[hit]])
            q[part.start + seen] = (np.maximum(c - d[np.minimum(c, 3)], 0) + about[:, 1:] @ d[1:] * q[part.start + seen]) / about[:, 0]
        entry, out = np.full(len(num), -1), p.copy()
        entry[live], out[live] = found[back], q[back]
        return entry, out

    def probability(self, num: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Of each token of rows that begin at off."""
        p = np.full(len(num), self.rest / (self.size + 1))
        if not self.types:
            return p
        known = num < self.size
        words, back = np.unique(num[known], return_inverse=True)
        c = np.zeros(len(words), np.int64)
        edges = np.searchsorted(words, np.arange(self.shards + 1) * self.block[1])
        for s, (i, j) in enumerate(zip(edges[:-1], edges[1:])):
            if i < j:
                c[i:j] = self.file("follows", 1, s, np.uint32)[words[i:j] - s * self.block[1]]
        p[known] += (np.maximum(c - np.array(self.d[1])[np.minimum(c, 3)], 0) / self.types)[back]
        entry, p = self.step(2, shifted(num, off, self.size + 1), num, p)
        return p if self.order == 2 else self.step(3, shifted(entry, off, -1), num, p)[1]


class Stored:
    """The files of one shard of an order, written piece by piece in the order of contexts; contexts are numbered in the shard."""

    def __init__(self, m: Model, n: int, s: int):
        self.m, self.n, self.s, self.open = m, n, s, {}
        self.contexts = self.size = self.counted = 0
        self.told = np.zeros(4, np.int64)

    def put(self, name: str, a: np.ndarray) -> None:
        if name not in self.open:
            self.open[name] = Growing(f"{self.m.root}/{name}{self.n}-{self.s}")
        self.open[name].add(a)

    def entries(self, context: np.ndarray, w: np.ndarray) -> None:
        """Entries in the order of context and word."""
        if (self.size + len(w)) >> 32:
            raise ValueError("a shard has 2^32 entries: raise spark.sql.shuffle.partitions")
        if not self.contexts:
            self.put("ends", np.zeros(1, np.uint32))
        self.put("ends", (self.size + np.cumsum(np.bincount(context - self.contexts))).astype(np.uint32))
        self.put("words", w.astype(np.uint32))
        self.contexts, self.size = int(context[-1]) + 1, self.size + len(w)

    def counts(self, context: np.ndarray, c: np.ndarray) -> None:
        """Their counts."""
        c = c.astype(np.int64)
        self.put("counts", np.minimum(c, 255).astype(np.uint8))
        at = np.flatnonzero(c >= 255)
        self.put("where", at + self.counted)
        self.put("large", c[at])
        begin = np.flatnonzero(np.diff(context, prepend=-1))
        many = np.diff(np.append(begin, len(c))) > MANY
        self.put("sums", np.column_stack([context[begin], *(np.add.reduceat(x.astype(np.int64), begin) for x in (c, c == 1, c == 2, c > 2))])[many])
        self.counted += len(c)
        self.told += [(c == i).sum() for i in (1, 2, 3, 4)]

    def close(self) -> tuple[int, ...]:
        """Shard, entries, and how many counts are one to four."""
        if self.contexts:
            self.put("ends", np.full(self.m.block[self.n] - self.contexts, self.size, np.uint32))
        for f in self.open.values():
            f.close()
        return self.s, max(self.size, self.counted), *self.told.tolist()


_TOLD = ["n", "n1", "n2", "n3", "n4"]
_RUN = "shard int, keys binary, counts binary"
_STORED = f"{_RUN}, " + ", ".join(f"{x} long" for x in _TOLD)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns, *[pa.nulls(len(b), pa.int64())] * len(_TOLD)], names=[*_PACKED.names, *_TOLD])


def _told(rows: list[tuple[int, ...]]) -> Iterator[pa.RecordBatch]:
    if rows:
        c = list(zip(*rows))
        yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int32()), *[pa.nulls(len(rows), pa.binary())] * 2, *[pa.array(x, pa.int64()) for x in c[1:]]], names=[*_PACKED.names, *_TOLD])


def _split(stored: DataFrame) -> tuple[DataFrame, dict[int, tuple[int, ...]]]:
    """The packed runs of a stage, and what each shard tells of itself."""
    told = stored.filter("n is not null").select("shard", *_TOLD).collect()
    return stored.filter("n is null").select("shard", "keys", "counts"), {r["shard"]: tuple(r)[1:] for r in told}


def _by_counts(told: dict[int, tuple[int, ...]]) -> list[int]:
    return [sum(t[i] for t in told.values()) for i in (1, 2, 3, 4)]


def train(ws: Workspace, rows: DataFrame, order: int = ORDER) -> Model:
    """A model of the texts of rows (text)."""
    if order not in (2, 3):
        raise ValueError(f"order {order}: two and three are supported")
    shards = 1 << max(2, int(ws.spark.conf.get("spark.sql.shuffle.partitions")).bit_length())
    m = Model(f"{ws.root}/model", shards, order)

    def starts(sizes: dict[int, int]) -> list[int]:
        return [0, *np.cumsum([sizes.get(s, 0) for s in range(shards)]).tolist()]

    def words(batches):
        tally = Tally(m.word_shard)
        for batch in batches:
            for _, _, data, off in textkit.chunks(batch.column("text")):
                yield from tally.add(tokens(data, off)[0])
        yield from tally.take()

    def store_words(batches):
        for s, k, c in by_shard(batches):
            write_array(f"{m.root}/hashes1-{s}", k)
            write_array(f"{m.root}/times1-{s}", c.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([len(k)], pa.int64()), pa.array([int(c.sum())], pa.int64())], names=["shard", "n", "total"])

    found = {r["shard"]: r for r in ws.put("words", deal(rows.mapInArrow(words, _RUN)).mapInArrow(store_words, "shard int, n long, total long")).collect()}
    m.first[1] = starts({s: r["n"] for s, r in found.items()})
    m.total = sum(r["total"] for r in found.values())
    if not m.size:
        return m
    if m.size + 2 > 1 << 32:
        raise ValueError(f"{m.size} distinct words do not fit 32 bits")

    pieces: dict[int, int] = {}  # of a shard

    def count(n: int, contexts: int) -> DataFrame:
        """Stores the entries of order n; gives runs for the counts of the order below, and of this order for those that begin a text."""
        if contexts.bit_length() + m.bits > 64:
            raise ValueError(f"{contexts} contexts and {m.size} words do not fit 64 bits")
        pieces[n] = -(-m.total // (shards * PIECE))
        m.piece[n] = piece = -(-contexts // (shards * pieces[n]))
        m.block[n] = block = piece * pieces[n]

        def grams(batches):
            tally = Tally(lambda k: (m.parted(k)[0] // piece).astype(np.int32))
            for batch in batches:
                for _, _, data, off in textkit.chunks(batch.column("text")):
                    h, at = tokens(data, off)
                    num = m.numbers(h)[0]
                    context = shifted(num, at, m.size + 1)
                    if n == 3:
                        keys, back = np.unique(m.keyed(context, num), return_inverse=True)
                        context = shifted(m.entries(2, keys)[back], at, -1)
                    live = context >= 0
                    yield from tally.add(m.keyed(context[live], num[live]))
            yield from tally.take()

        def store(batches):
            below = Tally(lambda k: ((k if n == 2 else m.parted(k)[0]) // m.piece[n - 1]).astype(np.int32))
            told = []
            for s, parts in itertools.groupby(by_shard(batches), lambda x: x[0] // pieces[n]):
                out = Stored(m, n, s)
                for at, k, c in parts:
                    context, w = m.parted(k)
                    out.entries(context - s * block, w)
                    if n == order:
                        out.counts(context - s * block, c)
                    if n == 3:
                        each, back = np.unique(context, return_inverse=True)
                        yield from _runs(below.add(m.keyed(m.last_words(2, each)[back], w)))
                    elif order == 2:
                        yield from _runs(below.add(w.astype(np.uint64)))
                    elif (begins := context == m.size + 1).any():
                        yield from _runs([packed_rows(k[begins], c[begins], np.full(begins.sum(), at))])
                told.append(out.close())
            yield from _runs(below.take())
            yield from _told(told)

        runs, told = _split(ws.put(f"grams{n}", deal(rows.mapInArrow(grams, _RUN), pieces[n]).mapInArrow(store, _STORED)))
        m.first[n] = starts({s: t[0] for s, t in told.items()})
        if n == order:
            m.d[n] = discounts(_by_counts(told))
        return runs

    def store_middle(batches):
        # every bigram follows a start or another token, so the keys of a piece are its entries
        below, told = Tally(lambda k: (k // m.piece[1]).astype(np.int32)), []
        for s, parts in itertools.groupby(by_shard(batches), lambda x: x[0] // pieces[2]):
            out = Stored(m, 2, s)
            for _, k, c in parts:
                context, w = m.parted(k)
                out.counts(context - s * m.block[2], c)
                yield from _runs(below.add(w.astype(np.uint64)))
            told.append(out.close())
        yield from _runs(below.take())
        yield from _told(told)

    def store_follows(batches):
        for s, k, c in by_shard(batches):
            a = np.zeros(m.block[1], np.uint32)
            a[k.astype(np.int64) - s * m.block[1]] = c
            write_array(f"{m.root}/follows1-{s}", a)
            yield from _told([(s, len(c), *(int((c == i).sum()) for i in (1, 2, 3, 4)))])

    m.block[1] = m.piece[1] = -(-m.size // shards)
    runs = count(2, m.size + 2)
    if order == 3:
        runs = runs.unionByName(count(3, m.first[2][-1]))
        runs, told = _split(ws.put("middle", deal(runs, pieces[2]).mapInArrow(store_middle, _STORED)))
        if sum(t[0] for t in told.values()) != m.first[2][-1]:
            raise RuntimeError("bigrams were counted that are not stored, or the other way round")
        m.d[2] = discounts(_by_counts(told))
        ws.drop("grams2", "grams3")
    told = _split(ws.put("follows", deal(runs).mapInArrow(store_follows, _STORED)))[1]
    m.types = m.first[2][-1]
    n = _by_counts(told)
    m.d[1] = discounts(n)
    more = sum(t[0] for t in told.values()) - n[0] - n[1]
    m.rest = (m.d[1][1] * n[0] + m.d[1][2] * n[1] + m.d[1][3] * more) / m.types
    ws.drop("words", "grams2", "middle", "follows")
    return m


def evaluate(rows: DataFrame, m: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for rows (doc_id, held_out, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, total = m.size, m.total
        for batch in batches:
            for a, b, data, off in textkit.chunks(batch.column("text")):
                h, at = tokens(data, off)
                num, cnt = m.numbers(h) if size else (np.zeros(len(h), np.int64), np.zeros(len(h), np.int64))
                base = np.log10((cnt + 0.1) / (total + 0.1 * (size + 1)))
                p = np.log10(m.probability(num, at)) if size else np.zeros(len(h))
                cut = at[:-1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("held_out").slice(a, b - a), pa.array(np.diff(at)), pa.array(np.add.reduceat((cnt > 0).astype(np.int64), cut)), pa.array(np.full(b - a, total)), pa.array(np.add.reduceat(base, cut)), pa.array(np.add.reduceat(p, cut))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return rows.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Learns from the rows of docs (doc_id, text) that are not held out and scores all."""
    ws = Workspace(docs.sparkSession, "lm")
    held = F.coalesce(id_crc(F.col("doc_id")) % 10 == 0, F.lit(False))
    rows = docs.select("doc_id", "text", held.alias("held_out"))
    with arrow_rows(docs.sparkSession):
        model = train(ws, rows.filter("doc_id is not null and not held_out").select("text"), order)
        out = ws.put("scores", evaluate(rows, model), narrow=True)
    ws.drop("model")
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents").select("doc_id", "text"))
