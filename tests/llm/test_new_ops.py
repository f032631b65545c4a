"""Licence scan, fill-in-the-middle and manifest: on odd rows, and against plain restatements."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from outlyne.llm import op11_license_scan as lic, op12_fill_in_middle as fim, op13_manifest as man

from ..twins import SF
from .brute import UP
from .test_ops import LONG, frame

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
NOTICE = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
ODD = [None, "", "  ", "MIT License", "mit-license, the Apache\nLicense; general public license", "mit licensed", LONG + " MIT license " + LONG, "ünï MIT\x00LICENSE 漢字", "<P> kept plain", "a<S>b", "x" * 50_000, "MIT license MIT license", NOTICE, "🙂 a1b2 \n\t"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i * 3, t, "en" if i % 2 else None, None if i % 3 == 0 else f"s{i % 4}") for i, t in enumerate(ODD)]
    return frame(spark, [*rows, rows[3], rows[3], (None, "MIT license", "", "s"), (None, None, None, None), (9, "other text", "en", "")])


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


# 11
def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def plain_scan(texts, notices=lic.NOTICES):
    """[(n_words, places, notices)] by going through every position of every text."""
    docs = [plain_words(t) for t in texts]
    seen = Counter(w for d in docs for w in set(d))
    n, out = len(docs), []
    for d in docs:
        at = lambda i, k: d[i : i + len(k)] == k if i >= 0 else False
        places = sorted((i, label) for p, label in lic.PHRASES.items() for i in range(len(d)) if at(i, p.split()))
        said = []
        for x in notices:
            own, best = x.text.split(), None
            rare = sorted({w for w in own if seen[w]}, key=lambda w: (seen[w], w))[: lic.RARE]
            idf = {w: math.log((n + 2) / (seen[w] + 1)) for w in rare}
            worth = [(w, i, idf[w]) for i, w in enumerate(own) if w in rare and idf[w] >= lic.LEAST * max(idf.values())]
            total, where = sum(v for *_, v in worth), defaultdict(list)
            for i, w in enumerate(d):
                where[w].append(i)
            for s in {i - p for w, p, _ in worth for i in where[w]}:
                got = sum(v for w, p, v in worth if any(0 <= s + p + o < len(d) and d[s + p + o] == w for o in range(-lic.SLACK, lic.SLACK + 1)))
                share = round(got / total, 6)
                keys = [(own_at(own, k.split()), k.split()) for k in x.keys]
                if share >= lic.SHARE and all(any(at(s + p + o, k) for o in range(-lic.REACH, lic.REACH + 1)) for p, k in keys):
                    best = max(best or (0.0, -math.inf), (share, -s))
            if best:
                said.append((x.label, best[0], -best[1]))
        out.append((len(d), places, said))
    return out


def own_at(own, key):
    return next(i for i in range(len(own)) if own[i : i + len(key)] == key)


def scanned(df):
    return [(r["n_words"], [tuple(p) for p in r["places"]], [(x["label"], round(x["share"], 5), x["start"]) for x in r["notices"]]) for r in df.collect()]


def rounded(rows):
    return [(n, p, [(a, round(b, 5), c) for a, b, c in s]) for n, p, s in rows]


def test_op11_odd_rows(spark, odd, none):
    rows = [r["text"] for r in odd.collect()]
    assert sorted(scanned(lic.scan(odd)), key=repr) == sorted(rounded(plain_scan(rows)), key=repr)
    assert lic.scan(none).count() == 0


def test_op11_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = plain_scan([r["text"] for r in docs])
    got = {r["doc_id"]: r for r in lic.op11_license_scan(spark, SF).collect()}
    assert len(got) == len(docs)
    for r, (n, places, said) in zip(docs, want):
        g, starts = got[r["doc_id"]], [p for p, _ in places]
        assert (g["n_words"], g["n_base"], g["first_word"], g["last_word"]) == (n, len(places), min(starts, default=None), max(starts, default=None))
        assert g["base_labels"] == ",".join(sorted({x for _, x in places})) and g["labels"] == ",".join(sorted({x for _, x in places} | {x for x, *_ in said}))
        assert abs(g["score"] - (1.0 if places else max((s for _, s, _ in said), default=0.0))) < 1e-5


def test_op11_notices(spark):
    rnd = random.Random(2)
    prose = lambda k: " ".join(f"w{rnd.randrange(500)}" for _ in range(k))
    own = NOTICE.lower().replace(",", "").split()
    moved = " ".join([*own[:12], "also", *own[12:]])
    half = " ".join(own[:6])
    nokey = " ".join(w for w in own if w != "binary")
    texts = [f"{prose(40)} {t} {prose(30)}" for t in (NOTICE, moved, half, nokey, NOTICE.upper())] + [prose(200) for _ in range(60)]
    got = scanned(lic.scan(frame(spark, [(i, t, None, None) for i, t in enumerate(texts)]).repartition(1)))
    assert got == rounded(plain_scan(texts))
    assert [[x[0] for x in s] for _, _, s in got[:5]] == [["bsd"], ["bsd"], [], [], ["bsd"]] and not any(s for _, _, s in got[5:])


def test_op11_every_occurrence(spark):
    text = "MIT license " * 3000 + "then the Apache License " * 100
    r = lic.scan(frame(spark, [(1, text, None, None)])).first()
    assert len(r["places"]) == 3100 and r["places"][-1]["start"] == 6000 + 4 * 99 + 2
    own = (lic.Notice("own", "all rights are kept by the author of this odd text", ("rights are kept",)),)
    part = frame(spark, [(1, "x all rights are kept by the author", None, None)])
    at = lambda text: [tuple(x) for x in lic.scan(part.withColumn("text", F.lit(text)), notices=own).first()["notices"]]
    assert at("x all rights are kept by the author") == [("own", 1.0, 1)] and at("rights by the author of this odd text") == []


# 12
def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    d = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(m in text for m in fim.SENTINELS) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, None, text)
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", a, b, c, f"<S>{c}<P>{a}<M>{b}")
    return (doc_id, n, "psm", a, b, c, f"<P>{a}<S>{c}<M>{b}")


def test_op12_odd_rows(spark, odd, none):
    got = fim.transform(odd).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:1] + tuple(r)[2:8] for r in got), key=repr) == sorted((plain_fim(r["doc_id"], r["text"]) for r in odd.collect()), key=repr)
    assert all(r["back"] == r["text"] for r in got) and fim.transform(none).count() == 0


def test_op12_seams_and_forms(spark):
    """Texts of pieces of sentinels come back, and forms have their shares."""
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(["<", ">", "P", "S", "M", "<P", "S>", "ab", "é", "🙂", "\n"]) for _ in range(rnd.randrange(1, 30))) for _ in range(3000)]
    got = fim.transform(frame(spark, [(i, t, None, None) for i, t in enumerate(texts)])).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert all(r["back"] == texts[r["doc_id"]] for r in got)
    assert all((r["doc_id"], r["n"], r["form"], r["prefix"], r["middle"], r["suffix"], r["output"]) == plain_fim(r["doc_id"], texts[r["doc_id"]]) for r in got)
    free = [r for r in got if not any(m in r["text"] for m in fim.SENTINELS)]
    share = Counter(r["form"] for r in free)
    assert abs(share["plain"] / len(free) - 0.1) < 0.03 and abs(share["spm"] / (len(free) - share["plain"]) - 0.2) < 0.04
    other = fim.transform(frame(spark, [(i, "some words of a text", None, None) for i in range(50)]), rate=100, spm=100, sentinels=("[p]", "[s]", "[m]"))
    assert all(r["form"] == "spm" and r["output"].startswith("[s]") for r in other.collect())
    assert spark.range(1).select(fim.restore(F.lit("no marks"), F.lit("psm")).alias("x")).first()["x"] is None


# 13
def plain_field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(nodes):
    """Levels of nodes, from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([sha("".join(x[i : i + 2])) for i in range(0, len(x), 2)])
    return levels


def plain_proof(levels, i):
    out = []
    for x in levels[:-1]:
        out.append(("L" if i & 1 else "R") + x[i ^ 1] if i ^ 1 < len(x) else "")
        i >>= 1
    return out


def plain_fold(node, proof):
    for e in proof:
        node = sha(e[1:] + node if e[:1] == "L" else node + e[1:])
    return node


def plain_manifest(rows):
    """Sorted (doc_id, leaf, subroot, root, proof) of rows (doc_id, text, lang, source, n_chars)."""
    groups = defaultdict(list)
    for d, text, lang, source, n in rows:
        groups[lang].append((d is not None, d or 0, sha("".join(map(plain_field, (d, source, lang, n, text)))), d))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top, out = plain_tree([trees[g][-1][0] for g in names]), []
    for j, g in enumerate(names):
        for i, (_, _, leaf, d) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            out.append((d, leaf, trees[g][-1][0], top[-1][0], tuple(plain_proof(trees[g], i) + plain_proof(top, j))))
    return sorted(out, key=repr)


def made(df, **how):
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple(r["proof"])) for r in man.manifest(df, **how).collect()), key=repr)


def given(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()]


def test_op13_odd_rows(spark, odd, none):
    want = plain_manifest(given(odd))
    assert made(odd) == want and made(odd.repartition(3), piece=2, band=1) == want and made(none) == []
    one = frame(spark, [(5, "alone", None, None)])
    assert made(one) == plain_manifest(given(one)) and made(one)[0][4] == () and made(one)[0][1] == made(one)[0][3]


def test_op13_many_groups_small_pieces(spark):
    """Groups of every size up to 20, a group with most rows, ids in no order, repeated rows; pieces and bands so small that several bands are needed."""
    rnd = random.Random(7)
    rows = [(rnd.randrange(10**6), f"t{i}", f"g{k}é", None) for k in range(1, 21) for i in range(k)] + [(rnd.randrange(-(10**6), 10**6), f"big {i}", None, "s") for i in range(700)] + [(77, "same", "same", "same")] * 90
    rnd.shuffle(rows)
    df = frame(spark, rows).repartition(5)
    want = plain_manifest(given(df))
    assert made(df, piece=8, band=3) == want and made(df.coalesce(1), piece=4, band=2) == want
    assert all(plain_fold(leaf, proof) == root for _, leaf, _, root, proof in want)


def test_op13_tampering(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    want = {d: (leaf, sub, root, proof) for d, leaf, sub, root, proof in plain_manifest(given(docs))}
    got = man.op13_manifest(spark, SF).collect()
    assert len(got) == len(want)
    by_id = {r["doc_id"]: r for r in docs.collect()}
    for r in got:
        leaf, sub, root, proof = want[r["doc_id"]]
        assert (r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) == (leaf, sub, root, sha("".join(e[1:] for e in proof)))
        hit, d = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0, by_id[r["doc_id"]]
        forged = sha("".join(map(plain_field, (d["doc_id"], d["source"], d["lang"], d["n_chars"] + hit, d["text"]))))
        assert r["folded_root"] == plain_fold(forged, proof) and r["verified"] == (not hit)
    assert 0 < sum(r["verified"] for r in got) < len(got)
