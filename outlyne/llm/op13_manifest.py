"""Merkle manifest of a dataset: one root for all rows, one subroot for each group, a proof for each row.

A row's leaf is the hash of its fields, each with its length in front.  The leaves of a group, in order of id, are hashed in runs of two up to the
group's subroot; the subroots, in order of their groups, are hashed likewise up to the root.

Method: leaves are sorted by range over (group, id), so a group is spread over as many partitions as it fills.  Counts of each group in each
partition, added up in partition order, give every leaf its position in its group.  A partition's leaves are cut into pieces at
multiples of PIECE positions; each piece builds all subtrees that it holds completely.  Nodes whose sibling or parent needs another
piece, two a level at most, are shuffled by coordinate: all nodes below one node BAND levels up meet, are hashed up to it, and what comes
of them goes to the next band.  Paths are put together from the root down, and each piece then walks its subtrees to give every leaf
its proof.  The subroots pass through the same steps as one more group.

Scale: text is read once and never shuffled; a leaf is 64 digits and an id.  A task holds a piece (PIECE leaves) or the nodes of a
band (2^BAND at most), however large a group is.  A window adds up counts: a group has one count a partition.  All stages are stored tables, so a lost
executor costs a reread.  A proof has one entry a level; proofs are made as they are read and never stored.

Ties: rows of one id are ordered by their leaf, so repeated rows have equal leaves at neighbouring positions, and the root does not depend on
how the input is partitioned.  Null ids come first.  Nulls: a null field is `-` (an empty one `0:`); a null group is a group of
its own, the first.  Texts of any length are hashed whole.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Workspace, id_crc, maybe_broadcast, table

PIECE = 1 << 14
BAND = 14
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "path array<string>"
_NODE = "grp string, n long, level int, ix long, node string"


def encoded(c: Column) -> Column:
    """A field as text that can't be confused with its neighbours: its length in bytes, a colon, its value; `-` for null."""
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, fields)), 256)


def _hash(*nodes: str) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def sibling(entry: Column) -> Column:
    """The digest in an entry of a proof, empty if the node was alone in its run."""
    return F.substring(entry, 2, 64)


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to.  An entry is L or R, the side of the sibling, and the sibling; an empty one is a node alone."""
    return F.aggregate(proof, start, lambda node, e: F.sha2(F.when(F.startswith(e, F.lit("L")), F.concat(sibling(e), node)).otherwise(F.concat(node, sibling(e))), 256))


def _height(n: int) -> int:
    """Levels above the leaves of a tree over n."""
    return (n - 1).bit_length()


def _height_of(n: Column) -> Column:
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _rise(nodes: dict[int, dict[int, str]], n: int, top: int) -> dict[int, dict[int, str]]:
    """Hashes nodes (level -> index -> node) of a tree over n leaves upward to level `top`, as far as all children of a node are known."""
    for level in range(top):
        here, above = nodes.setdefault(level, {}), nodes.setdefault(level + 1, {})
        last = ((n - 1) >> level) & ~1  # a node of even index without a sibling, if it is the last
        for i, x in here.items():
            if i & 1:
                continue
            if i + 1 in here:
                above[i >> 1] = _hash(x, here[i + 1])
            elif i == last and not (n - 1) >> level & 1:
                above[i >> 1] = _hash(x)
    return nodes


def _step(nodes: dict[int, dict[int, str]], level: int, ix: int) -> str:
    """The entry of a proof for one node."""
    other = nodes[level].get(ix ^ 1)
    return "" if other is None else ("L" if ix & 1 else "R") + other


def _grown(n: int, first: int, leaves: list[str]) -> dict[int, dict[int, str]]:
    return _rise({0: {first + i: x for i, x in enumerate(leaves)}}, n, _height(n))


def _ragged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each piece the nodes that it can't hash further."""
    schema = pa.schema([("grp", pa.string()), ("n", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("level", pa.int32()), ("ix", pa.int64()), ("node", pa.string())])
    for batch in batches:
        out = []
        for grp, n, part, piece, first, leaves in zip(*(batch.column(c).to_pylist() for c in ("grp", "n", "part", "piece", "first", "leaves"))):
            nodes = _grown(n, first, leaves)
            for level, here in nodes.items():
                above = nodes.get(level + 1, {})
                out += [{"grp": grp, "n": n, "part": part, "piece": piece, "level": level, "ix": i, "node": x} for i, x in here.items() if i >> 1 not in above]
        yield pa.RecordBatch.from_pylist(out, schema)


def _band(up: int):
    """From nodes below one node of level `up`: what they are hashed to, and each one's path to it."""
    schema = pa.schema([("grp", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("ix", pa.int64()), ("path", pa.list_(pa.string())), ("top", pa.int64()), ("node", pa.string())])

    def run(rows: pa.Table) -> pa.Table:
        grp, n = rows.column("grp")[0].as_py(), rows.column("n")[0].as_py()
        given = list(zip(*(rows.column(c).to_pylist() for c in ("level", "ix", "node"))))
        nodes: dict[int, dict[int, str]] = {}
        for level, i, x in given:
            nodes.setdefault(level, {})[i] = x
        top = min(up, _height(n))
        ((last, made),) = _rise(nodes, n, top)[top].items()
        out = [{"grp": grp, "n": n, "level": top, "ix": last, "node": made}]
        for level, i, _ in given:
            path = [_step(nodes, rung, i >> rung - level) for rung in range(level, top)]
            out.append({"grp": grp, "n": n, "level": level, "ix": i, "path": path, "top": last})
        return pa.Table.from_pylist(out, schema)

    return run


def _walks(payload: list[str]):
    """Rows of each piece with their paths, a thousand at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [batch.schema.field(c).type.value_type for c in payload]
            for grp, n, first, leaves, ends, *given in zip(*(batch.column(c).to_pylist() for c in ("grp", "n", "first", "leaves", "ends", *payload))):
                nodes, rest = _grown(n, first, leaves), {(e["level"], e["ix"]): e["path"] for e in ends}
                for a in range(0, len(leaves), 1000):
                    cut, paths = slice(a, a + 1000), []
                    for at in range(first + a, first + a + len(leaves[cut])):
                        path, level = [], 0
                        while (level, at) not in rest:
                            path.append(_step(nodes, level, at))
                            level, at = level + 1, at >> 1
                        paths.append(path + rest[level, at])
                    columns = [pa.array([grp] * len(paths)), pa.array(leaves[cut]), pa.array(paths, pa.list_(pa.string())), *(pa.array(g[cut], t) for g, t in zip(given, kinds))]
                    yield pa.RecordBatch.from_arrays(columns, names=["grp", "leaf", "path", *payload])

    return run


class Forest:
    """A tree for each group of leaves (grp, leaf, other columns), which are in the order of some of these columns and then of the leaf."""

    def __init__(self, ws: Workspace, name: str, leaves: DataFrame, order: list[str], piece: int = PIECE, band: int = BAND):
        self.ws, self.name = ws, name
        self.payload = [c for c in leaves.columns if c not in ("grp", "leaf")]
        self.types = dict(leaves.dtypes)
        ranges = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # the number of the input row deals equal leaves over several partitions; among them order means nothing
        leaves = ws.put(f"{name}-leaves", leaves.withColumn("any", F.monotonically_increasing_id()))
        keys = ["grp", *order, "leaf", "any"]
        dealt = leaves.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("row", F.monotonically_increasing_id())
        # that number is the partition's in the upper bits and the row's in the lower 33
        rows = ws.put(f"{name}-rows", dealt.withColumns({"part": F.shiftright("row", 33), "i": F.col("row").bitwiseAND(F.lit((1 << 33) - 1))}).drop("row", "any"))
        own = Window.partitionBy("grp")
        counts = rows.groupBy("grp", "part").agg(F.min("i").alias("lo"), F.count("*").alias("c"))
        before = F.coalesce(F.sum("c").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        places = ws.put(f"{name}-places", counts.select("grp", "part", (before - F.col("lo")).alias("shift"), F.sum("c").over(own).alias("n")), narrow=True)
        most, many = places.agg(F.max("n"), F.count("*")).first()
        placed = rows.join(maybe_broadcast(places, many, 64), ["grp", "part"]).withColumn("pos", F.col("i") + F.col("shift"))
        held = F.array_sort(F.collect_list(F.struct("pos", "leaf", *self.payload))).alias("r")
        pieces = placed.groupBy("grp", "n", "part", F.floor(F.col("pos") / piece).alias("piece")).agg(held)
        pieces = pieces.select("grp", "n", "part", "piece", F.col("r")[0]["pos"].alias("first"), F.col("r.leaf").alias("leaves"), *[F.col(f"r.{c}").alias(c) for c in self.payload])
        self.pieces = ws.put(f"{name}-pieces", pieces)
        ends = self.pieces.select("grp", "n", "part", "piece", "first", "leaves").mapInArrow(_ragged, "grp string, n long, part long, piece long, level int, ix long, node string")
        self.ends = ws.put(f"{name}-ends", ends)
        ws.drop(f"{name}-leaves", f"{name}-rows", f"{name}-places")
        self._finish(_height(most or 1), band)

    def _finish(self, height: int, band: int) -> None:
        """Hashes the nodes that pieces left, band by band; roots (grp, n, node)."""
        nodes, open_, self.paths = self.ends.drop("part", "piece"), [], None
        for up in range(band, max(height, 1) + band, band):
            inside = nodes.filter(F.col("level") < up).withColumn("anc", F.expr(f"shiftright(ix, {up} - level)"))
            done = inside.groupBy("grp", "anc").applyInArrow(_band(up), "grp string, n long, level int, ix long, path array<string>, top long, node string")
            done = self.ws.put(f"{self.name}-band{up}", done)
            open_.append((up, done.filter("node is null").select("grp", "level", "ix", "path", "top")))
            made = done.filter("node is not null").select("grp", "n", "level", "ix", "node")
            ready = F.col("level") == _height_of(F.col("n"))
            roots = made.filter(ready).select("grp", "n", "node")
            self.roots = roots if up == band else self.roots.unionByName(roots)
            nodes = made.filter(~ready).unionByName(nodes.filter(F.col("level") >= up))
        for up, own in reversed(open_):  # from the roots down
            if self.paths is None:
                self.paths = own.drop("top")
                continue
            above = self.paths.filter(F.col("level") == up).select("grp", F.col("ix").alias("top"), F.col("path").alias("more"))
            longer = own.join(above, ["grp", "top"], "left").select("grp", "level", "ix", F.concat("path", F.coalesce("more", F.array().cast("array<string>"))).alias("path"))
            self.paths = self.ws.put(f"{self.name}-paths{up}", longer.unionByName(self.paths))

    def rows(self, above: DataFrame | None = None) -> DataFrame:
        """(grp, leaf, path, other columns) of all leaves.  above: (grp, rest), a path that goes on from the root of each group."""
        ends = self.ends.select("grp", "part", "piece", "level", "ix").join(self.paths, ["grp", "level", "ix"])
        if above is not None:
            ends = ends.join(above, "grp").withColumn("path", F.concat("path", "rest"))
        ends = ends.groupBy("grp", "part", "piece").agg(F.collect_list(F.struct("level", "ix", "path")).alias("ends"))
        found = self.pieces.join(ends, ["grp", "part", "piece"]).drop("part", "piece")
        more = "".join(f", {c} {self.types[c]}" for c in self.payload)
        return found.mapInArrow(_walks(self.payload), f"grp string, leaf string, path array<string>{more}")


def manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id", fields: tuple[str, ...] = FIELDS, carry: dict[str, Column] | None = None, piece: int = PIECE, band: int = BAND) -> DataFrame:
    """(order, leaf, subroot, root, proof) for every row of docs, and the columns `carry`, made from the row.

    proof: the entries from the leaf to the root of its group and on to the root of all, as fold() takes them.
    """
    ws = Workspace(docs.sparkSession, "manifest")
    name = F.col(group).cast("string")
    leaves = docs.select(F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("grp"), F.col(order).alias("at"), leaf([F.col(c) for c in fields]).alias("leaf"), *[c.alias(k) for k, c in (carry or {}).items()])
    groups = Forest(ws, "group", leaves, ["at"], piece, band)
    subroots = ws.put("subroots", groups.roots.select(F.lit("").alias("grp"), F.col("grp").alias("of"), F.col("node").alias("leaf")), narrow=True)
    top = Forest(ws, "top", subroots, ["of"], piece, band)
    above = ws.put("above", top.rows().join(top.roots.select("grp", F.col("node").alias("root")), "grp").select(F.col("of").alias("grp"), F.col("leaf").alias("subroot"), "root", F.col("path").alias("rest")), narrow=True)
    n = above.count()
    rows = groups.rows(maybe_broadcast(above.select("grp", "rest"), n, 4096))
    rows = rows.join(maybe_broadcast(above.drop("rest"), n, 256), "grp")
    return rows.select(F.col("at").alias(order), "leaf", "subroot", "root", F.col("path").alias("proof"), *(carry or {}))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = leaf([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS])
    rows = manifest(docs, carry={"tampered": F.when(F.pmod(id_crc(F.col("doc_id")), F.lit(7)) == 0, tampered)})
    digest = F.sha2(F.array_join(F.transform("proof", sibling), ""), 256)
    rows = rows.select("doc_id", "leaf", "subroot", "root", digest.alias("proof_sha256"), fold(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in FIELDS) + ")"
_FORGED = "sha256(" + " || ".join(_FIELD.format("(n_chars + 1)" if c == "n_chars" else c) for c in FIELDS) + ")"
#: Bit by bit: a byte is mixed in, then eight steps follow.
_CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384::BIGINT * (a & 1)) END), 4294967295::BIGINT)"


def _tree_sql(name: str, leaves: str) -> str:
    """CTEs: nodes of the trees over leaves (grp, pos, n, h), and _e: (grp, pos, e) the entries of each leaf's proof."""
    return f"""{name} AS (SELECT grp, 0 AS level, pos AS ix, n, h FROM {leaves}
  UNION ALL SELECT grp, level + 1, ix // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY ix)) FROM {name} WHERE n > 1 GROUP BY grp, level, n, ix // 2),
{name}_l AS (SELECT DISTINCT grp, level FROM {name} WHERE n > 1),
{name}_e AS (SELECT d.grp, d.pos, list(coalesce(CASE WHEN t.ix % 2 = 0 THEN 'L' ELSE 'R' END || t.h, '') ORDER BY l.level) FILTER (WHERE l.level IS NOT NULL) AS e
  FROM {leaves} d LEFT JOIN {name}_l l ON l.grp = d.grp LEFT JOIN {name} t ON t.grp = d.grp AND t.level = l.level AND t.ix = xor(d.pos >> l.level, 1) GROUP BY d.grp, d.pos)"""


ORACLE = f"""
WITH RECURSIVE f AS (SELECT doc_id, coalesce('=' || lang, '') AS grp, {_LEAF} AS h, CASE WHEN {_CRC} % 7 = 0 THEN {_FORGED} END AS forged FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM f),
{_tree_sql("t", "d")},
g AS (SELECT '' AS grp, grp AS name, h, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
{_tree_sql("u", "g")},
r AS (SELECT d.doc_id, d.h AS leaf, g.h AS subroot, (SELECT h FROM u WHERE n = 1) AS root, list_concat(coalesce(t_e.e, []), coalesce(u_e.e, [])) AS e, coalesce(d.forged, d.h) AS start
  FROM d JOIN t_e ON t_e.grp = d.grp AND t_e.pos = d.pos JOIN g ON g.name = d.grp JOIN u_e ON u_e.pos = g.pos),
x AS (SELECT *, list_reduce(list_concat([start], e), lambda a, b: CASE WHEN b = '' THEN sha256(a) WHEN b[1] = 'L' THEN sha256(b[2:] || a) ELSE sha256(a || b[2:]) END) AS folded_root FROM r)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(e, lambda b: b[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM x
"""
