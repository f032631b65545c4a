"""N-gram Jaccard join by parity sketches.

Each shingle of a document is hashed to a place in a long bit vector and flips its bit (XOR), so bits that differ between two vectors
are no more than the shingles in one set only.  100 |A n B| >= 80 |A u B| allows D = floor((|A| + |B|) / 9) such shingles.

Pigeonhole: the vector is cut into P segments of hash ranges.  A segment is kept as the XOR of a 64-bit word of each of its
flipped bits (zero words, i.e. segments without shingles, are passed over).  Of the first D + 1 segments that hold shingles at
least one is the same in both documents, and no segment before the first such one is the same; so a document that emits
its first D + 1 filled segments meets every partner.  It emits X more; then partners share X + 1, and a document with fewer
shared segments than that has no partner.  Of what it shares a document may then pass over any X segments, if all documents choose by one
common order: it passes over those that most documents hold.  So passages that many documents share seldom make pairs.

Size bands: P depends on the band [2^b, 2^(b+1)) of the smaller document.  A document emits in its own band, and in the
band below if that band's largest size is within 80 %.  If a document has too few filled segments (ten standard deviations
off at every size) the hash seed moves on.

Verify: (1) copies of one shingle set are one class; one of them stands for it; (2) in rounds each bucket of one segment takes its most
central member, the one with the fewest segments of its own, as hub and verifies the other members against it; links found
join components, and a bucket whose members are all in one component is done; (3) when a round no longer halves what is open, pairs
in a bucket of up to eight that are still in different components are verified; documents of larger buckets are brought together again by their rarest
shingles instead: of n, ordered by how many of these documents have them (those of one component alone come first and meet no one), the first n / 5 + 1,
of which two linked documents share one.  D counts what precedes the first that they share in either, so one of the two has it in its first n / 9
places; rows with more before them are never brought together.  Before a pair is verified, a second parity sketch, of two
to four bits a shingle and 512 at least, must show a Hamming distance of no more than D.  So all links that can change a
component are verified on whole sets, and no pair inside a component is listed.  No bucket or pair is capped.  all_links lists
every candidate pair instead, and counts the links of each class.

Identity: words are 64-bit hashes and shingles 64-bit hashes of five of them; sets are compared as sets of these hashes.

Scale: a task emits the segments of one shingle set once, and passes on segments that repeat among its own documents without
gathering them, so a text that a third of all rows repeat costs one row a segment and task.  Shards are gone through in
pieces: what is held grows with the distinct segments of a shard, not with their repeats.  Shards follow spark.sql.shuffle.partitions.  Buckets
are counted and given hubs by aggregation and joined as stored tables, so adaptive execution can split a large one.

Nulls: a null text is empty: no shingles, linked with nothing, component its own id.  Rows are told apart as rows: rows with one id and
different texts are linked each by its own text, and component_id is the least id reached, null if no row reached has
one.  An empty table gives an empty result.  Texts of any length are read whole.  Ties cannot arise.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkit
from .common import Workspace, arrow_rows, maybe_broadcast, numbered, table
from .graph import components

WIDTH, NUM, DEN = 5, 80, 100
BITS = 512
SINGLE = 64  # below this size every segment holds one shingle
SMALL = 8  # documents of a bucket that are compared without a count of their own shingles
HELD = 1 << 20  # keys that a task gathers before it sends them
_KNOWN = 64  # added to a key's band: another document is known to hold the key
_META = "doc long, id long, n int, s1 long, s2 long, emits boolean, ok boolean"
_PACKED = f"kind int, shard int, keys binary, docs binary, bands binary, {_META}"
_KEYS = f"key long, band int, {_META}"


def _segments(low: int) -> int:
    """P of the band that begins at low."""
    return 1 << 16 if low < SINGLE else low + low // 4


def _extra(low: int) -> int:
    """X of that band."""
    return low // 8


def _allowed(a: int, b: int) -> int:
    """D: most shingles that two sets of these sizes may not share."""
    return (a + b) * (DEN - NUM) // (DEN + NUM)


def roles(n: int) -> Iterator[tuple[int, int]]:
    """(b, D) for each band in which a set of size n emits."""
    b = n.bit_length() - 1
    yield b, _allowed(n, n * DEN // NUM)
    below = (1 << b) - 1
    if below and below * DEN >= n * NUM:
        yield b - 1, _allowed(n, below)


def set_keys(s: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Keys and bands of a sorted set of hashes, and whether there were segments enough."""
    keys, bands, ok = [], [], True
    place = np.sort(textkit.mix(s, 100 + seed)) if seed else s
    word = textkit.mix(place, 200)
    for b, d in roles(len(s)):
        low = 1 << b
        need = d + 1 + _extra(low)
        seg = (place >> np.uint64(32)) * np.uint64(_segments(low)) >> np.uint64(32)
        first = np.concatenate(([0], np.flatnonzero(seg[1:] != seg[:-1]) + 1))
        ok &= len(first) >= need
        k = np.bitwise_xor.reduceat(word, first)[:need]
        keys.append(textkit.mix(k ^ textkit.mix(seg[first[:need]] * np.uint64(64) + np.uint64(b), 300)))
        bands.append(np.full(len(k), b, np.int8))
    return np.concatenate(keys), np.concatenate(bands), ok


def sketch_bits(band: int) -> int:
    return max(BITS, 2 << band)


def set_sketch(s: np.ndarray) -> np.ndarray:
    """The second parity sketch as 64-bit words.  The XOR of its halves is the sketch of half as many bits."""
    bits = sketch_bits(len(s).bit_length() - 1) if len(s) else BITS
    bit = (textkit.mix(s, 400) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(bit, minlength=bits) & 1 == 1).view(np.int64)


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row of the batch, sorted distinct shingle hashes)."""
    for a, b, data, off in textkit.chunks(batch.column("text")):
        h, at = textkit.word_hashes(data, off)
        for i in range(a, b):
            yield i, np.unique(textkit.shingles(h[at[i - a] : at[i - a + 1]], width))


def _runs(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: which begin a run of equal ones, and which belong to a run of more than one."""
    same = k[1:] == k[:-1]
    begins = np.concatenate(([True], ~same))
    return begins, np.concatenate((same, [False])) | ~begins


def _emit(shards: int, seed: int, width: int):
    schema = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary()), ("bands", pa.binary()), ("doc", pa.int64()), ("id", pa.int64()), ("n", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64()), ("emits", pa.bool_()), ("ok", pa.bool_())])

    def pack(k: np.ndarray, d: np.ndarray, b: np.ndarray, shard: np.ndarray, kind: int) -> Iterator[dict]:
        order = np.argsort(shard, kind="stable")
        k, d, b, shard = k[order], d[order], b[order], shard[order]
        cut = np.concatenate(([0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(k)]))
        for i, j in zip(cut[:-1], cut[1:]):
            yield {"kind": kind, "shard": int(shard[i]), "keys": k[i:j].tobytes(), "docs": d[i:j].tobytes(), "bands": b[i:j].tobytes()}

    def flush(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[dict]:
        k, d, b = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order = np.argsort(k, kind="stable")
        k, d, b = k[order], d[order], b[order]
        begins, repeated = _runs(k)
        b = b + np.where(repeated, _KNOWN, 0).astype(np.int8)
        out = list(pack(k[begins], d[begins], b[begins], (k[begins] % np.uint64(shards)).astype(np.int32), 1))
        rest = ~begins
        if rest.any():
            out += pack(k[rest], d[rest], b[rest] - np.int8(_KNOWN), (d[rest] % shards).astype(np.int32), 2)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for batch in batches:
            doc, id_, meta = batch.column("doc").to_pylist(), batch.column("id").to_pylist(), []
            for i, s in _sets(batch, width):
                ok, emits = True, False
                sig = textkit.mix(np.array([np.bitwise_xor.reduce(textkit.mix(s, j)) if len(s) else 0 for j in (500, 501)], np.uint64)).view(np.int64)
                sig = (int(sig[0]), int(sig[1]))
                if len(s) and sig not in seen:
                    if len(seen) > 200_000:  # a set that comes again is sent again
                        seen.clear()
                    seen.add(sig)
                    emits = True
                    k, b, ok = set_keys(s, seed)
                    held.append((k, np.full(len(k), doc[i], np.int64), b))
                    size += len(k)
                meta.append({"kind": 0, "shard": doc[i] % shards, "doc": doc[i], "id": id_[i], "n": len(s), "s1": sig[0], "s2": sig[1], "emits": emits, "ok": bool(ok)})
            if size >= HELD:
                meta += flush(held)
                size = 0
            yield pa.RecordBatch.from_pylist(meta, schema)
        if held:
            yield pa.RecordBatch.from_pylist(flush(held), schema)
        textkit.rest()

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the packed keys of one shard after another: what documents say of themselves, and keys that occur more than once.

    Of each key of the shard at hand one row is kept, marked once it has been given out; pieces of the shard are sorted
    together with these rows.
    """
    names = ["key", "band", "doc", "id", "n", "s1", "s2", "emits", "ok"]
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    known: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    now, size = None, 0

    def keys(k: np.ndarray, d: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        n = len(k)
        blank = [pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())]
        return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(b.astype(np.int32)), pa.array(d), *blank], names=names)

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal known, size
        parts = ([known] if known else []) + held
        k, d, b = (np.concatenate(x) for x in zip(*parts))
        # given out already: rows of `known` whose band is marked twice
        out = np.zeros(len(k), bool)
        if known:
            out[: len(known[0])] = known[2] < 0
        held.clear()
        size = 0
        order = np.argsort(k, kind="stable")
        k, d, b, out = k[order], d[order], b[order], out[order]
        begins, repeated = _runs(k)
        start = np.flatnonzero(begins)
        told = np.logical_or.reduceat(((b & _KNOWN) != 0) | out, start) | repeated[start]
        live = np.repeat(told, np.diff(np.append(start, len(k)))) & ~out
        if live.any():
            yield keys(k[live], d[live], b[live] & np.int8(_KNOWN - 1))
        known = (k[start], d[start], np.where(told, np.int8(-1), b[start] & np.int8(_KNOWN - 1)).astype(np.int8))

    for batch in batches:
        kind = batch.column("kind").to_numpy()
        meta = batch.filter(pa.array(kind == 0))
        if len(meta):
            yield pa.RecordBatch.from_arrays([pa.nulls(len(meta), pa.int64()), pa.nulls(len(meta), pa.int32()), *[meta.column(c) for c in names[2:]]], names=names)
        packed = batch.filter(pa.array(kind > 0))
        for kind, shard, *parts in zip(*(packed.column(c).to_pylist() for c in ("kind", "shard", "keys", "docs", "bands"))):
            k, d, b = (np.frombuffer(p, t) for p, t in zip(parts, (np.uint64, np.int64, np.int8)))
            if kind == 2:
                yield keys(k, d, b)
                continue
            if shard != now:
                if held:
                    yield from flush()
                known = None
            now = shard
            held.append((k, d, b))
            size += len(k)
            if size >= max(HELD, len(known[0]) if known else 0):
                yield from flush()
    if held:
        yield from flush()
    textkit.rest()


def _whole_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, at, sets, size = batch.column("doc").to_numpy(), [], [], 0

            def out() -> pa.RecordBatch:
                sketches = [set_sketch(s) for s in sets]
                lists = [pa.ListArray.from_arrays(np.cumsum([0, *map(len, x)]).astype(np.int32), np.concatenate([v.view(np.int64) for v in x])) for x in (sets, sketches)]
                return pa.RecordBatch.from_arrays([pa.array(doc[at]), *lists], names=["doc", "hashes", "sketch"])

            for i, s in _sets(batch, width):
                at.append(i)
                sets.append(s)
                size += len(s)
                if size >= HELD:
                    yield out()
                    at, sets, size = [], [], 0
            if at:
                yield out()
        textkit.rest()

    return run


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of pairs (a, b) whose whole sets are similar enough."""
    x = pairs.join(sets.select(F.col("doc").alias("b"), F.col("hashes").alias("hb")), "b").join(sets.select(F.col("doc").alias("a"), F.col("hashes").alias("ha")), "a")
    both = F.size(F.array_intersect("ha", "hb"))
    x = x.select("a", "b", both.alias("i"), (F.size("ha") + F.size("hb")).alias("total"))
    return x.filter(F.col("i") * DEN >= (F.col("total") - F.col("i")) * NUM).select("a", "b")


def _fit(sketch: str, band: str) -> Column:
    """The sketch in the size of the band in which two documents meet."""
    s, half = F.col(sketch), (F.size(sketch) / 2).cast("int")
    wide = F.size(sketch) * 64 > F.greatest(F.lit(BITS), F.call_function("shiftleft", F.lit(2), F.col(band)))
    return F.when(wide, F.zip_with(F.slice(s, 1, half), F.slice(s, half + 1, half), lambda x, y: x.bitwiseXOR(y))).otherwise(s)


def _near() -> Column:
    """Sizes and sketches (na, sa, nb, sb) leave room for a link."""
    apart = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    allowed = F.floor((F.col("na") + F.col("nb")) * (DEN - NUM) / (DEN + NUM))
    return (F.abs(F.col("na") - F.col("nb")) <= allowed) & (apart <= allowed)


def _live(keys: DataFrame, reps: DataFrame) -> DataFrame:
    """(key, doc, band, off): segments that representatives (doc, n) share, less the X most frequent of each; off: how many a document
    has for itself, short of a constant."""
    shared = keys.join(reps, "doc")
    often = shared.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    in_doc = Window.partitionBy("doc", "band")
    extra = F.floor(F.call_function("shiftleft", F.lit(1), F.col("band")) / 8)
    x = shared.join(often, "key").withColumn("m", F.count("*").over(in_doc)).withColumn("r", F.row_number().over(in_doc.orderBy(F.col("c").desc(), "key")))
    off = (F.col("n") * 2 * (DEN - NUM) / (DEN + NUM)).cast("long") - F.col("m")
    return x.filter((F.col("m") > extra) & (F.col("r") > extra)).select("key", "doc", "band", off.alias("off"))


class _Components:
    """Components of the links found so far."""

    def __init__(self, ws: Workspace):
        self.ws, self.links, self.comp, self.turn = ws, None, None, 0

    def of(self, rows: DataFrame, doc: str, comp: str) -> DataFrame:
        if self.comp is None:
            return rows.withColumn(comp, F.col(doc))
        known = self.comp.select(F.col("node").alias(doc), F.col("comp").alias(comp))
        return rows.join(known, doc, "left").withColumn(comp, F.coalesce(comp, doc))

    def add(self, links: DataFrame) -> None:
        self.turn += 1
        links = self.ws.put(f"links{self.turn}", links)
        self.links = links if self.links is None else self.links.unionByName(links)
        self.comp = self.ws.put(f"comp{self.turn}", components(self.ws, self.links, f"c{self.turn}-"))


def similarity_classes(docs: DataFrame, width: int = WIDTH, row: str | None = None, all_links: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) for every row of docs (doc_id, text).

    class_id: the least id with the same shingle set.  row: a column of unique integers; the result then has it too, with keep_row, the
    row that stands for the component (least id, nulls last, then least row).  all_links adds links: with how many other classes
    the row's class is linked.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "jaccard")
    docs, plain = numbered(ws, docs.select("doc_id", "text", *([row] if row else [])), row)
    docs = docs.select(F.col("row").alias("doc"), F.col("doc_id").alias("id"), "text")
    shards = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    seed = 0
    while True:
        dealt = docs.mapInArrow(_emit(shards, seed, width), _PACKED).repartition("shard").sortWithinPartitions("shard")
        with arrow_rows(spark):
            out = ws.put("keys", dealt.mapInArrow(_shared, _KEYS))
        if out.filter("not ok").isEmpty():
            break
        seed += 1
    meta = out.filter("key is null").select("doc", "id", "n", "s1", "s2", "emits")
    # of each shingle set one document that sent its segments
    least = F.min("doc") if plain else F.min(F.struct(F.col("id").isNull().alias("no"), "id", "doc"))
    first = meta.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min(F.when(F.col("emits"), F.col("doc"))).alias("rep"), least.alias("least"))
    first = ws.put("first", first)
    meta = ws.put("meta", meta.drop("emits"))
    live = ws.put("live", _live(out.filter("key is not null").select("key", "doc", "band"), first.select(F.col("rep").alias("doc"), "n")))
    ws.drop("keys")
    live = ws.put("open0", live.join(live.groupBy("key").count().filter("count > 1").select("key"), "key", "left_semi"))
    who = ws.put("who", live.select("doc").distinct())
    n = who.count()
    found = _Components(ws)
    if n:
        with arrow_rows(spark):
            sets = docs.join(maybe_broadcast(who, n, 16), "doc", "left_semi").select("doc", "text")
            sets = ws.put("sets", sets.mapInArrow(_whole_sets(width), "doc long, hashes array<long>, sketch array<long>"))
        ws.drop("live")
        _join(ws, live, sets, found, all_links)
    ws.keep("rows", "meta", "first", f"comp{found.turn}", *(f"links{i + 1}" for i in range(found.turn)))
    return _result(meta, first, found, plain, row, all_links)


def _join(ws: Workspace, live: DataFrame, sets: DataFrame, found: _Components, all_links: bool) -> None:
    """Verifies candidates until no pair of different components is left."""
    about = sets.select("doc", F.size("hashes").alias("n"), "sketch")

    def side(x: str) -> DataFrame:
        return about.select(F.col("doc").alias(x), F.col("n").alias("n" + x), F.col("sketch").alias("f" + x))

    turn, before, left = 0, 0, live.count()
    while left and not all_links and (not turn or 2 * left <= before):
        seen = found.of(live, "doc", "comp")
        if turn:
            seen = found.of(seen, "hub", "hc")
        old = F.col("comp") == F.col("hc") if turn else F.lit(False)
        pick = F.struct(old.alias("old"), "off", "doc", "comp")
        hubs = seen.groupBy("key").agg(F.min(pick).alias("h")).select("key", F.col("h.doc").alias("hub"), F.col("h.comp").alias("hc"))
        seen = seen.select("key", "doc", "band", "off", "comp").join(hubs, "key").filter(F.col("doc") != F.col("hub"))
        seen = ws.put(f"seen{turn}", seen)
        pairs = seen.filter("comp <> hc").select(F.col("hub").alias("a"), F.col("doc").alias("b"), "band").distinct()
        pairs = pairs.join(side("b"), "b").join(side("a"), "a").withColumn("sa", _fit("fa", "band")).withColumn("sb", _fit("fb", "band"))
        pairs = ws.put(f"pairs{turn}", pairs.filter(_near()).select("a", "b").distinct())
        found.add(_verify(pairs, sets))
        # what is left: buckets with more than one component
        now = found.of(seen.select("key", "doc", "band", "off", "hub"), "doc", "comp")
        mixed = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
        turn += 1
        live = ws.put(f"open{turn}", now.drop("comp").join(mixed, "key", "left_semi"))
        ws.drop(f"open{turn - 1}", f"seen{turn - 1}", f"pairs{turn - 1}")
        before, left = left, live.count()
    if not left:
        return
    met = ws.put("met", found.of(live.select("key", "doc", "band"), "doc", "comp"))
    met = met.join(met.groupBy("key").agg(F.count("*").alias("c")), "key")
    few = met.filter(F.col("c") <= SMALL).select("key", "doc", "comp", "band", F.lit(0).cast("long").alias("own"))
    rare = _rare(ws, met.filter(F.col("c") > SMALL).select("doc", "comp").distinct(), sets)
    open_ = few.unionByName(rare).join(about, "doc").withColumn("s", _fit("sketch", "band"))
    open_ = ws.put("open", open_.select("key", "doc", "comp", "n", "s", "own"))
    pairs = ws.put("pairs", _compared(*_sides(open_), all_links).distinct())
    ws.drop("open", "met", "often")
    found.add(_verify(pairs, sets))


def _rare(ws: Workspace, who: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, doc, comp, band, own): the shingles by which documents (doc, comp) of large buckets are brought together again, as keys.

    A set of n shingles lacks n / 5 at most of a linked one's; so if both order theirs in one way, the first n / 5 + 1 of each have one in common.
    The order puts shingles of one component first, then rare ones.  own: the place of the key in that order, from 0.  What precedes the first common key
    is in one of the two sets only, so D counts it: there own(x) + own(y) <= D.  Only these documents are counted, since only they are compared.
    """
    who = ws.put("large", who)
    held = sets.join(who, "doc").select("doc", "comp", F.size("hashes").alias("n"), F.explode("hashes").alias("h"))
    often = held.groupBy("h").agg(F.count("*").alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    often = ws.put("often", often.filter("lo < hi").select("h", "c"))
    in_doc = Window.partitionBy("doc")
    x = held.join(often, "h").withColumn("own", F.col("n") - F.count("*").over(in_doc) + F.row_number().over(in_doc.orderBy("c", "h")) - 1)
    x = x.filter(F.col("own") <= F.floor(F.col("n") * (DEN - NUM) / DEN))
    b = F.length(F.bin("n")) - 1
    below = F.call_function("shiftleft", F.lit(1), b) - 1
    bands = F.when((below > 0) & (below * DEN >= F.col("n") * NUM), F.array(b, b - 1)).otherwise(F.array(b))
    x = x.select("h", "doc", "comp", F.explode(bands).alias("band"), "own")
    return x.select(F.xxhash64("h", "band").alias("key"), "doc", "comp", "band", "own")


def _sides(open_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two sides (key, cls, doc, comp, n, s, room) of each bucket, to be joined on key and class.

    What x and y have before their first common key is not in both, so a link needs own(x) + own(y) <= D.  That is room(x) + room(y) >= 0
    with room = 20 n - 180 own.  Those with room meet each other (class -1); those without meet only such as have more room than they
    lack, by powers of two: one with room looks into all classes up to its own.
    """
    room = F.col("n") * (DEN - NUM) - F.col("own") * (DEN + NUM)
    size = F.length(F.bin(F.abs(room))) - F.when(room == 0, 1).otherwise(0)
    rows = open_.select("key", "doc", "comp", "n", "s", room.cast("long").alias("room"), size.alias("size"))
    x = rows.filter("room >= 0").withColumn("cls", F.explode(F.sequence(F.lit(-1), "size")))
    y = rows.withColumn("cls", F.when(F.col("room") >= 0, -1).otherwise(F.col("size")))
    named = lambda df, i: df.select("key", "cls", *[F.col(c).alias(c + i) for c in ("doc", "comp", "n", "s", "room")])
    return named(x, "a"), named(y, "b")


def _compared(x: DataFrame, y: DataFrame, all_links: bool) -> DataFrame:
    """Pairs (a, b) of the two sides whose sizes, own shingles and sketches leave room for a link."""
    once = (F.col("roomb") < 0) | (F.col("doca") < F.col("docb"))
    apart = F.col("doca") != F.col("docb") if all_links else F.col("compa") != F.col("compb")
    same = (x["key"] == y["key"]) & (x["cls"] == y["cls"])
    return x.join(y, same & once & apart & (F.col("rooma") + F.col("roomb") >= 0) & _near()).select(F.least("doca", "docb").alias("a"), F.greatest("doca", "docb").alias("b"))


def _result(meta: DataFrame, first: DataFrame, found: _Components, plain: bool, row: str | None, all_links: bool) -> DataFrame:
    id_ = F.col("least") if plain else F.col("least.id")
    if found.comp is None:
        first = first.withColumn("all", F.col("least"))
    else:
        member = first.join(found.comp.withColumnRenamed("node", "rep"), "rep")
        whole = member.groupBy("comp").agg(F.min("least").alias("all"))
        first = first.join(member.select("rep", "comp").join(whole, "comp").drop("comp"), "rep", "left").withColumn("all", F.coalesce("all", "least"))
    all_ = F.col("all") if plain else F.col("all.id")
    own = [F.col("doc").alias(row)] if row else []
    keep = [(F.col("all") if plain else F.col("all.doc")).alias("keep_row")] if row else []
    if all_links:
        degree = None if found.links is None else found.links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
        first = first.withColumn("links", F.lit(0)) if degree is None else first.join(degree, "rep", "left")
    links = [F.coalesce("links", F.lit(0)).cast("long").alias("links")] if all_links else []
    named = meta.filter("n > 0").join(first, ["n", "s1", "s2"])
    named = named.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), all_.alias("component_id"), id_.alias("class_id"), *own, *keep, *links)
    own, keep = ([F.col("doc").alias(c)] if row else [] for c in (row or "", "keep_row"))
    bare = meta.filter("n = 0").select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("n_shingles"), F.col("id").alias("component_id"), F.col("id").alias("class_id"), *own, *keep, *([F.lit(0).cast("long").alias("links")] if all_links else []))
    return named.unionByName(bare)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS sh FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT r.d, e.b FROM r JOIN e ON r.c = e.a)
SELECT d AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(c) AS component_id FROM r LEFT JOIN n ON n.doc_id = d GROUP BY d
"""
