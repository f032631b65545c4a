"""BPE encoding and decoding by speculation and verification.

A text is cut at special tokens and then into words by the tokenizer's pattern.  For each distinct word a greedy longest
match over its bytes proposes tokens.  The proposal is the BPE result if each token encodes to itself and no merge crosses a
boundary, and that is decided pair by pair: walking down the right edge of the left token's merge tree and the left edge of
the right token's, every two parts that exist at the same time must not merge before one of them is used up.  The walk runs on all
distinct adjacent pairs of a batch at once, with a sorted array of merges.  Only words with a pair that fails are merged exactly.

Scale: one pass without a shuffle; each worker process keeps a bounded memo of words.  A text is encoded whole.

Nulls: a null text is empty: no tokens.  Repeated rows are encoded each.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import Workspace, arrow_rows, table
from .textkit import rest

MEMO = 250_000
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BIG = np.int64(1 << 40)
_loaded: dict[str, Tokenizer] = {}


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that the vocabulary file writes for bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in set(shown)):
        out[chr(256 + i)] = b
    return out


class Tokenizer:
    """A byte-level BPE tokenizer from a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"] or model["type"] != "BPE" or model.get("ignore_merges"):
            raise ValueError("only byte-level BPE without a normalizer")
        letters = _byte_letters()
        to_bytes = lambda s: bytes(letters[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {to_bytes(s): i for s, i in model["vocab"].items()}
        self.texts: dict[int, bytes] = {i: s for s, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.words = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        n = max(self.texts) + 1
        # rank of the merge that makes a token (-1: a byte), and its two parts
        self.rank, self.left, self.right = np.full(n, -1, np.int64), np.arange(n), np.arange(n)
        self.ranks: dict[int, int] = {}  # of pairs, as left << 32 | right
        self.made: list[int] = []
        for r, m in enumerate(model["merges"]):
            a, b = (to_bytes(x) for x in (m if isinstance(m, list) else m.split(" ")))
            a, b, c = self.ids[a], self.ids[b], self.ids[a + b]
            self.ranks.setdefault(a << 32 | b, r)
            self.made.append(c)
            if self.rank[c] < 0:
                self.rank[c], self.left[c], self.right[c] = r, a, b
        keys = np.array(list(self.ranks), np.int64)
        order = np.argsort(keys)
        self.pair_key, self.pair_rank = keys[order], np.array(list(self.ranks.values()), np.int64)[order]
        self.byte = [self.ids[bytes([b])] for b in range(256)]
        self.stable = np.zeros(n, bool)
        for s, i in self.ids.items():
            self.stable[i] = self.merge(s) == [i]
        # beginnings of tokens: the token's id, or -1 for what only begins one
        self.starts: dict[bytes, int] = {}
        for s, i in self.ids.items():
            if self.stable[i]:
                for k in range(1, len(s)):
                    self.starts.setdefault(s[:k], -1)
                self.starts[s] = i
        # words and their ids as little-endian 32-bit integers: the latest, and those before
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.known: dict[int, bool] = {}
        self.exact = 0  # words that were merged exactly

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: always the lowest rank, leftmost first."""
        tok = [self.byte[b] for b in word]
        if len(tok) > 64:
            return self.merge_long(tok)
        get, none = self.ranks.get, 1 << 40
        ranks = [get(a << 32 | b, none) for a, b in zip(tok, tok[1:])]
        while ranks:
            r = min(ranks)
            if r == none:
                break
            i = ranks.index(r)
            tok[i] = self.made[r]
            del tok[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(tok[i - 1] << 32 | tok[i], none)
            if i < len(ranks):
                ranks[i] = get(tok[i] << 32 | tok[i + 1], none)
        return tok

    def merge_long(self, tok: list[int]) -> list[int]:
        """The same with a heap over a linked list, for words of any length."""
        n = len(tok)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, tok[i], tok[i + 1]) for i in range(n - 1) if (r := self.ranks.get(tok[i] << 32 | tok[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if tok[i] != a or j >= n or tok[j] != b:
                continue
            tok[i], tok[j] = self.made[r], -1
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for x, y in ((prv[i], i), (i, nxt[i])):
                if x >= 0 and y < n and (r := self.ranks.get(tok[x] << 32 | tok[y])) is not None:
                    heapq.heappush(heap, (r, x, tok[x], tok[y]))
        return [t for t in tok if t >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        get = self.starts.get
        whole = get(word, -1)
        if whole >= 0:
            return [whole]
        out, at, n = [], 0, len(word)
        while at < n:
            end, best, to = at + 1, -1, at + 1
            while end <= n and (i := get(word[at:end])) is not None:
                if i >= 0:
                    best, to = i, end
                end += 1
            out.append(best if best >= 0 else self.byte[word[at]])
            at = to
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens, whether no merge crosses from a to b."""
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a.copy(), b.copy()
        end_x, end_y = np.full(len(a), _BIG), np.full(len(a), _BIG)  # when x and y are used up
        while len(live):
            key = x << 32 | y
            i = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            r = np.where(self.pair_key[i] == key, self.pair_rank[i], _BIG)
            crossed = (r < end_x) & ((r < end_y) | ((r == end_y) & (r < _BIG)))
            ok[live[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~crossed & ((rx >= 0) | (ry >= 0))
            live, x, y, rx, ry, end_x, end_y = (v[go] for v in (live, x, y, rx, ry, end_x, end_y))
            later = rx > ry  # step back from the part that was made last
            end_x, end_y = np.where(later, rx, end_x), np.where(later, end_y, ry)
            x, y = np.where(later, self.right[x], x), np.where(later, y, self.left[y])
        return ok

    def encode_words(self, words: list[str]) -> None:
        """Fills the memo with the tokens of distinct words."""
        raw = [w.encode() for w in words]
        made = [self.propose(w) for w in raw]
        flat = np.fromiter((t for m in made for t in m), np.int64)
        if not len(flat):
            return
        size = np.fromiter(map(len, made), np.int64, len(made))
        owner = np.repeat(np.arange(len(made)), size)
        inner = owner[1:] == owner[:-1]
        bad = np.bincount(owner, ~self.stable[flat], len(made)) > 0
        keys = (flat[:-1] << 32 | flat[1:])[inner]
        pairs = np.unique(keys)
        new = pairs[~np.fromiter((p in self.known for p in pairs.tolist()), bool, len(pairs))]
        if len(self.known) > MEMO:
            self.known.clear()
            new = pairs
        self.known.update(zip(new.tolist(), self.compatible(new >> 32, new & 0xFFFFFFFF).tolist()))
        fits = np.fromiter((self.known[p] for p in pairs.tolist()), bool, len(pairs))
        bad |= np.bincount(owner[1:][inner], ~fits[np.searchsorted(pairs, keys)], len(made)) > 0 if len(keys) else False
        for i in np.flatnonzero(bad).tolist():
            made[i] = self.merge(raw[i])
        self.exact += int(bad.sum())
        flat = np.fromiter(itertools.chain.from_iterable(made), np.uint32).astype("<u4").tobytes()
        ends = list(itertools.accumulate(4 * len(m) for m in made))
        self.memo.update(zip(words, (flat[a:b] for a, b in zip([0, *ends], ends))))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Token ids of whole texts as little-endian 32-bit integers."""
        cut = []
        for t in texts:
            if self.cut and any(s in t for s in self.special):
                cut.append([w for part in self.cut.split(t) for w in ([part] if part in self.special else self.words.findall(part))])
            else:
                cut.append(self.words.findall(t))
        if len(self.memo) > MEMO:
            self.memo, self.old = {}, self.memo
        memo, old = self.memo, self.old
        fresh = {w for w in set().union(*cut) if w not in memo}
        for w in fresh & old.keys() if old else ():
            memo[w] = old[w]
            fresh.discard(w)
        for w in fresh & self.special.keys():
            memo[w] = self.special[w].to_bytes(4, "little")
            fresh.discard(w)
        if fresh:
            self.encode_words(list(fresh))
        return [b"".join(map(memo.__getitem__, words)) for words in cut]

    def forget(self) -> None:
        """Empties the memo, so that an idle worker process does not hold it."""
        self.memo, self.old, self.known = {}, {}, {}
        rest()

    def decode(self, ids: list[int]) -> str:
        """Special tokens are kept; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.texts.__getitem__, ids)).decode("utf-8", "replace")


def tokenizer(path: str) -> Tokenizer:
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]


def id_lists(encoded: list[bytes]) -> pa.Array:
    return pa.array([np.frombuffer(g, "<i4").astype(np.int32) for g in encoded], pa.list_(pa.int32()))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) for rows (doc_id, text); path: the vocabulary file on each worker, by default that of the installed package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path or default_path())
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for a in range(0, len(texts), 64):
                got = t.encode_batch(texts[a : a + 64])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, len(got)), id_lists(got)], names=["doc_id", "ids"])
        t.forget()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) for rows (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path or default_path())
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([t.decode(i or []) for i in batch.column("ids").to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """The columns of docs but text, and n_tokens, ids_sha256, decoded_sha256; ids too if asked for.  One pass encodes and decodes."""
    kept = [f for f in docs.schema.fields if f.name not in ("text", "n_tokens", "ids_sha256", "decoded_sha256", "ids")]
    made = ["n_tokens long", "ids_sha256 string", "decoded_sha256 string", *["ids array<int>"] * with_ids]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path or default_path())
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for a in range(0, len(texts), 64):
                got = t.encode_batch(texts[a : a + 64])
                n = pa.array([len(g) // 4 for g in got], pa.int64())
                sha = pa.array([hashlib.sha256(g).hexdigest() for g in got], pa.string())
                back = pa.array([hashlib.sha256(t.decode(np.frombuffer(g, "<u4").tolist()).encode()).hexdigest() for g in got], pa.string())
                ids = [id_lists(got)] * with_ids
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name).slice(a, len(got)) for f in kept), n, sha, back, *ids], names=[*(f.name for f in kept), *(m.split()[0] for m in made)])
        t.forget()

    ws = Workspace(docs.sparkSession, "bpe")
    with arrow_rows(docs.sparkSession):
        return ws.put("digests", docs.select(*(f.name for f in kept), "text").mapInArrow(run, schema), narrow=not with_ids)


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"))
