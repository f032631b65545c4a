"""Registered round trips: what a sink writes to the shared folder a source reads again, and the rows are compared with SQL over the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import scoring as S
from ..operators import infer, records, series, stats
from ..sources import archives, documents, files, rejects, report, scans, sinks, stages
from . import demo, twins as T
from .demo import CFG, EVENT_CFG, LEXICON, table
from .queries import _COLUMNS, _scores, _series, _SER, gelu_sql, query


def _folder(spark, name: str) -> str:
    """A new folder, removed when the JVM ends."""
    path = f"{stages.shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def _documents(spark, sf):
    """Suppliers' scores as prediction documents (entity_id, preds), nested for even keys and flat for odd ones."""
    s = _scores(spark, sf)
    one = lambda g, d: F.max(F.when((F.col("grp") == g) & (F.col("dim") == d), F.col("value")))
    wide = s.groupBy("entity_id").agg(*[one("trait", d).alias(d) for d in demo.DIM_ORDER], *[one("emotion", d).alias(d) for d in demo.EMOTIONS], one("quality", "genuineness").alias("genu"), one("quality", "blend").alias("blend"))
    nested = F.struct(F.struct(*demo.DIM_ORDER).alias("dims"), F.struct(*demo.EMOTIONS).alias("emo"), "genu", "blend")
    flat = F.struct(*demo.DIM_ORDER, *demo.EMOTIONS, "genu", "blend")
    return s, wide.select("entity_id", F.when(F.pmod("entity_id", F.lit(2)) == 0, F.to_json(nested)).otherwise(F.to_json(flat)).alias("preds"))


@query("k07_caption_text", T.render("default"))
def k07_caption_text(spark, sf):
    s, docs = _documents(spark, sf)
    return records.caption(docs, stages.once(demo.supplier_baseline(s), "baseline"), LEXICON, CFG)


@query("k07_caption_json", f"{T.detail()} SELECT {_COLUMNS} FROM detail")
def k07_caption_json(spark, sf):
    """Documents of the description, read again row by row."""
    s, docs = _documents(spark, sf)
    doc = records.caption(docs, stages.once(demo.supplier_baseline(s), "baseline"), LEXICON, CFG, "json")
    cell = "array<struct<pos:int,dim:string,name:string,value:double,z:double,direction:string,intensity:string,always_on:boolean,phrase:string,tag:string>>"
    doc = doc.select("entity_id", F.from_json("json", f"dims {cell}, emotions {cell}, quality {cell}").alias("d"))
    part = lambda p: F.transform(f"d.{p}", lambda x: F.struct(F.lit(p).alias("part"), *(x[c].alias(c) for c in _COLUMNS.split(", ") if c not in ("entity_id", "part"))))
    return doc.select("entity_id", F.inline(F.concat(*map(part, ("dims", "emotions", "quality"))))).select(*_COLUMNS.split(", "))


@query("k07_caption_list", f"{T.detail()} SELECT entity_id, string_agg(phrase, ' / ' ORDER BY part_ix, pos) AS phrases FROM detail GROUP BY entity_id")
def k07_caption_list(spark, sf):
    s, docs = _documents(spark, sf)
    return records.caption(docs, stages.once(demo.supplier_baseline(s), "baseline"), LEXICON, CFG, "list").select("entity_id", F.array_join("phrases", " / ").alias("phrases"))


@query("s01_json_documents", f"WITH {T.SCORES} SELECT entity_id::VARCHAR AS entity_id, dim, value FROM scores WHERE grp = 'trait'")
def s01_documents(spark, sf):
    """Documents written as files, one object or an array of objects in each."""
    _, docs = _documents(spark, sf)
    path = _folder(spark, "documents")
    whole = F.to_json(F.struct(F.col("entity_id").cast("string").alias("id"), F.from_json("preds", "map<string,string>").getItem("dims").alias("dims"), "preds"))
    files = docs.groupBy(F.floor(F.col("entity_id") / 3).alias("name")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(whole), ","), F.lit("]")).alias("value"))
    documents.texts_each(files, path, F.col("name"), F.col("value"), folders=documents.FOLDERS)
    back = scans.documents_of(documents.texts_of(spark, path)).select("entity_id", F.get_json_object("preds", "$.preds").alias("p"))
    dims = F.from_json(F.coalesce(F.get_json_object("p", "$.dims"), F.col("p")), "map<string,double>")
    return back.select("entity_id", F.explode(dims).alias("dim", "value")).filter(F.col("dim").isin(*demo.DIM_ORDER))


@query("s03_baseline_file", f"WITH {T.SCORES}, {T.stats('scores', 'grp')} SELECT dim, grp, mean, median, std, mad, spread, p10, p90, n FROM stats")
def s03_baseline(spark, sf):
    """A baseline document written as one JSON object and loaded again."""
    path = _folder(spark, "baseline")
    b = demo.supplier_baseline(_scores(spark, sf))
    documents.baseline(b, f"{path}/baseline.json", {"made_by": "test"})
    return scans.baseline_document(spark, path).select("dim", "grp", *stats.STATS)


@query("s05_several_files", "SELECT count(*) AS n, sum(o_totalprice)::DOUBLE AS total FROM orders")
def s05_several(spark, sf):
    """Files of one pattern out of a folder of several, a few columns of each."""
    path = _folder(spark, "orders")
    o = table(spark, sf, "orders")
    for i in range(3):
        o.filter(F.pmod("o_orderkey", F.lit(3)) == i).write.parquet(f"{path}/part={i}")
    return scans.parquet_files(spark, path, "*.parquet", ["o_totalprice"]).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))


_ORDERED = "row_number() OVER (ORDER BY r_regionkey, n_nationkey) - 1"
_REGIONS = f"SELECT ({_ORDERED})::INT AS class_ix, n_name AS class, r_name AS grp, 'sound ' || n_name AS description FROM nation JOIN region ON n_regionkey = r_regionkey"


def _taxonomy(spark, sf):
    """A taxonomy document with regions as groups and nations as classes, numbered in document order."""
    path = f"{_folder(spark, 'taxonomy')}/taxonomy.json"
    quoted = lambda c: F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
    item = F.concat(quoted(F.col("n_name")), F.lit(': {"description": '), quoted(F.concat(F.lit("sound "), "n_name")), F.lit("}"))
    groups = n.groupBy("r_regionkey", "r_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", item.alias("t")))), lambda x: x["t"]), ", ").alias("items"))
    documents.ordered(groups, path, F.concat(quoted(F.col("r_name")), F.lit(': {"items": {'), "items", F.lit("}}")), ["r_regionkey"], '{"categories": {', "}}")
    return scans.taxonomy(spark, path)


@query("s10_taxonomy_file", f"{_REGIONS} UNION ALL SELECT count(*), 'no_burst', NULL, NULL FROM nation")
def s10_file(spark, sf):
    return _taxonomy(spark, sf).select(F.col("class_ix").cast("int").alias("class_ix"), "class", "grp", "description")


@query("s10_taxonomy", f"WITH t AS ({_REGIONS}) SELECT grp, count(*) AS n, min(class_ix)::BIGINT AS first_ix FROM t GROUP BY grp")
def s10_taxonomy(spark, sf):
    return _taxonomy(spark, sf).filter("grp is not null").groupBy("grp").agg(F.count("*").alias("n"), F.min("class_ix").cast("long").alias("first_ix"))


@query("s11_synonyms_file", "SELECT lang AS dim, string_agg(DISTINCT source, ',' ORDER BY source) AS synonyms FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def s11_file(spark, sf):
    path = _folder(spark, "synonyms")
    d = table(spark, sf, "documents").filter("lang is not null").groupBy("lang").agg(F.array_sort(F.collect_set("source")).alias("k"))
    body = d.agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("lang", F.struct(F.col("k").alias("keywords"))))).alias("categories"))).alias("value"))
    body.coalesce(1).write.text(path)
    return scans.synonyms(spark, path).select("dim", F.array_join("synonyms", ",").alias("synonyms"))


@query("s12_record_files", f"""WITH {_SER}, o AS (SELECT s.clip, s.ix, s.text, s.start, s."end", coalesce(string_agg(b.label, ',' ORDER BY b.b_ix), '') AS bursts FROM sent s LEFT JOIN bursts b ON b.clip = s.clip AND (b.start + b."end") / 2 BETWEEN s.start - {EVENT_CFG.slack} AND s."end" + {EVENT_CFG.slack} GROUP BY s.clip, s.ix, s.text, s.start, s."end")
SELECT clip::VARCHAR AS id, (row_number() OVER (PARTITION BY clip ORDER BY ix) - 1)::INT AS ix, text, start, "end", bursts FROM o""")
def s12_records(spark, sf):
    """Score records written as JSON, one file each, and read again sentence by sentence."""
    _, s, b = _series(spark, sf)
    path = _folder(spark, "records")
    clips = s.select("clip").distinct().withColumns({"ei_gender": F.lit(1.0), "global_scores": F.lit(None).cast("string")})
    r = records.score_record(clips, s, b, EVENT_CFG)
    record = F.to_json(F.struct(F.col("clip").cast("string").alias("id"), "ei_gender", F.transform("sentences", lambda x: x.dropFields("scores")).alias("sentences")))
    documents.texts_each(r, path, F.col("clip"), record, folders=documents.FOLDERS)
    back = scans.records_of(documents.texts_of(spark, path)).select("id", F.posexplode("sentences").alias("ix", "s"))
    return back.select("id", "ix", "s.text", "s.start", "s.end", F.array_join("s.bursts", ",").alias("bursts"))


@query("k03_results_file", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def k03_results(spark, sf):
    path = _folder(spark, "results")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    sinks.results(c, path)
    return spark.read.schema(c.schema).json(path)


@query("k04_cards", """SELECT conv_id, turn, '<div class="card"><b>' || conv_id || '</b> ' || regexp_replace(replace(replace(replace(replace(replace('(' || text || ')', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '\'\'', '&#x27;'), '\\(([^)]+)\\)', '<span class="burst">(\\1)</span>', 'g') || '</div>' AS html FROM conversations""")
def k04_cards(spark, sf):
    c = table(spark, sf, "conversations").select(F.struct("conv_id", "turn").alias("k"), "conv_id", F.concat(F.lit("("), "text", F.lit(")")).alias("text"))
    body = sinks.cards(c.select(F.col("conv_id").alias("key"), "text", "k").withColumn("key", F.to_json("k")), "key", "text")
    k = F.from_json("key", "conv_id bigint, turn bigint")
    shown = F.regexp_replace("html", r"<b>.*?</b>", F.concat(F.lit("<b>"), k["conv_id"].cast("string"), F.lit("</b>")))
    return body.select(k["conv_id"].alias("conv_id"), k["turn"].alias("turn"), shown.alias("html"))


def _shown(c: str) -> str:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        c = f"replace({c}, '{a}', '{b}')"
    return f"regexp_replace({c}, '\\r\\n|\\r|\\n', '<br>', 'g')"


_OFF = '<span class="off">'
_BURST = '<span class="burst">'
_PAGE = f"""WITH t AS (SELECT conv_id, turn, role, text, conv_id % 11 = 4 AS bad, turn % 2 = 1 AS loud, turn % 3 <> 0 AS kept, len(text) AS n FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
s AS (SELECT conv_id, any_value(bad) AS bad, count(*) AS n, sum(n) AS words, CASE conv_id % 3 WHEN 0 THEN 'calm' WHEN 1 THEN 'a<b' ELSE '' END AS kind,
  string_agg('<li>' || {_shown('text')} || ' <i>' || role || '</i> ' || CASE WHEN loud THEN '{_BURST}' || role || ', with E' || turn || '.</span>' ELSE '{_OFF}no burst</span>' END || '</li>', '' ORDER BY turn) AS said,
  string_agg('<li>' || turn || '.5–' || (turn + 1) || '.0 s: ' || CASE WHEN kept THEN '{_BURST}E' || turn || ' (0.25)</span>' WHEN loud THEN '{_OFF}E' || turn || ' (0.25) left out, too short</span>' ELSE '{_OFF}left out, no burst by 0.75</span>' END || '</li>', '' ORDER BY turn) AS spans,
  regexp_replace({_shown("string_agg('(E' || turn || ') ' || role, ' ' ORDER BY turn)")}, '\\(([^)]+)\\)', '{_BURST}(\\1)</span>', 'g') AS placed FROM t GROUP BY conv_id)
SELECT '<p>' || {_shown('kind')} || ': ' || (count(*) - count(*) FILTER (bad)) || ' clips, ' || count(*) FILTER (bad) || ' errors, ' || coalesce(sum(n) FILTER (NOT bad), 0) || ' spans</p>' AS line FROM s GROUP BY kind
UNION ALL SELECT CASE WHEN bad THEN '<section class="error"><h3>' || conv_id || ' <small>' || {_shown('kind')} || '</small></h3><p>Error: not &amp; read</p></section>' ELSE
  '<section><h3>' || conv_id || ' <small>' || {_shown('kind')} || ', ' || n || '.0 s, ' || words || ' words</small></h3><p>Clip ' || conv_id || '.</p><h4>In place</h4><p>' || placed || '</p><ul>' || spans || '</ul><h4>By sentence</h4><ul>' || said || '</ul></section>' END FROM s"""


@query("k04_report", _PAGE)
def k04_report(spark, sf):
    """Conversations as clips, their turns as sentences and spans: the page's lines, read back from the file without its first and last."""
    t = table(spark, sf, "conversations").filter("conv_id is not null and turn is not null").withColumns({"loud": F.col("turn") % 2 == 1, "kept": F.col("turn") % 3 != 0, "label": F.concat(F.lit("E"), F.col("turn").cast("string"))})
    told = F.concat("role", F.lit(", with "), "label", F.lit("."))
    named = F.when(F.col("loud") | F.col("kept"), F.col("label"))
    sentence = F.struct("turn", "text", F.col("role").alias("caption"), F.when(F.col("loud"), F.col("label")).alias("burst"), told.alias("burst_caption"), F.concat(F.lit("("), "label", F.lit(") "), "role").alias("placed"))
    span = F.struct("turn", (F.col("turn") + 0.5).cast("double").alias("start"), (F.col("turn") + 1).cast("double").alias("end"), named.alias("label"), F.lit(0.25).cast("double").alias("prob"), F.lit(0.75).cast("double").alias("p_noburst"), "kept")
    c = t.groupBy(F.col("conv_id").alias("clip")).agg(F.array_sort(F.collect_list(sentence)).alias("sentences"), F.array_sort(F.collect_list(span)).alias("bursts"), F.count("*").cast("double").alias("dur"), F.sum(F.length("text")).alias("n_words"))
    bad = F.pmod("clip", F.lit(11)) == 4
    c = c.withColumns({"error": F.when(bad, "not & read"), "n_spans": F.when(~bad, F.size("bursts")), "inline": F.array_join(F.transform("sentences", lambda s: s["placed"]), " "), "global_caption": F.concat(F.lit("Clip "), F.col("clip").cast("string"), F.lit("."))})
    kind = F.when(F.col("clip") % 3 == 0, "calm").when(F.col("clip") % 3 == 1, "a<b")
    path = f"{_folder(spark, 'page')}/index.html"
    report.page(c, path, "Clips & bursts", kind)
    return spark.read.text(path).select(F.col("value").alias("line")).filter("line like '<p>%' or line like '<section%'")


@query("k06_file_for_each", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def k06_each(spark, sf):
    path = _folder(spark, "each")
    n = table(spark, sf, "nation")
    sinks.folder_each(n.select("n_nationkey", "n_name", "n_regionkey"), path, "n_regionkey")
    return spark.read.schema("n_nationkey int, n_name string, n_regionkey int").json(path)


@query("k06_file_for_each_row", "SELECT s_suppkey, s_name, s_acctbal, s_suppkey::VARCHAR || '.json' AS file FROM supplier")
def k06_rows(spark, sf):
    """A file for each row, named by its key."""
    path = _folder(spark, "rows")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    documents.one_file_each(s, path, "s_suppkey", documents.FOLDERS)
    return documents.texts_of(spark, path).select(F.from_json("value", s.schema.simpleString()).alias("r"), "file").select("r.*", _file("file"))


_LINES = "l_orderkey, l_linenumber, l_quantity, l_returnflag, l_partkey"


@query("k03_results_document", f"SELECT {_LINES}, count(*) OVER () AS n, row_number() OVER (ORDER BY {_LINES}) - 1 AS pos FROM lineitem")
def k03_document(spark, sf):
    """All lines as one document {n, results}, written by all tasks; positions are those in the document."""
    path = f"{_folder(spark, 'document')}/results.json"
    li = table(spark, sf, "lineitem").select(*_LINES.split(", "))
    documents.results(li, path, li.columns)
    return documents.results_rows(spark, path, li.schema.simpleString()).select("r.*", "n", "pos")


@query("k06_combined_array", "SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders")
def k06_combined(spark, sf):
    path = f"{_folder(spark, 'combined')}/all.json"
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    documents.combined(o, path, ["o_orderkey"])
    return documents.rows(spark, path, o.schema.simpleString()).select("r.*", "pos")


# ---- archives and arrays ----
def _archived(df, path: str, cut: bool = False) -> None:
    """(part, key, content) as one archive for each part, its members in order; cut: the last byte of each archive's last member is missing."""

    def write(pdf):
        import io
        import tarfile

        import pandas as pd

        buf, end = io.BytesIO(), 0
        with tarfile.open(fileobj=buf, mode="w") as tar:
            for key, content in sorted(zip(pdf["key"], pdf["content"])):
                info = tarfile.TarInfo(f"{key}.txt")
                info.size = len(content)
                tar.addfile(info, io.BytesIO(content))
                end = tar.offset - (-info.size % 512)
        with files.created(f"{path}/part{pdf['part'].iloc[0]}.tar") as out:
            out.write(buf.getvalue()[: end - 1] if cut else buf.getvalue())
        return pd.DataFrame({"n": [len(pdf)]})

    df.groupBy("part").applyInPandas(write, "n long").write.format("noop").mode("overwrite").save()


def _turns(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select(F.pmod("conv_id", F.lit(7)).alias("part"), F.format_string("%08d-%04d", "conv_id", "turn").alias("key"), F.col("text").cast("binary").alias("content"))


def _file(c="archive"):
    return F.element_at(F.split(c, "/"), -1).alias("file")


_KEY = "printf('%08d-%04d', conv_id, turn)"


@query("s07_archive_members", f"SELECT 'part' || (conv_id % 7) || '.tar' AS file, {_KEY} AS key, text FROM conversations")
def s07_members(spark, sf):
    """Archives, written by tasks and read again member by member; they are deleted when the members have been written."""
    path = _folder(spark, "archives")
    _archived(_turns(spark, sf), path)
    members, _ = rejects.parted(archives.tar_members(spark, f"{path}/*.tar", ".txt", piece=1 << 20))
    archives.remove(spark, f"{path}/*.tar")
    return members.select(_file(), "key", F.col("content").cast("string").alias("text"))


@query("s07_archive_keys", f"SELECT {_KEY} AS key, text FROM conversations WHERE role = 'user'")
def s07_keys(spark, sf):
    path = _folder(spark, "archives")
    _archived(_turns(spark, sf), path)
    wanted = table(spark, sf, "conversations").filter("role = 'user'").select(F.format_string("%08d-%04d", "conv_id", "turn").alias("key"))
    return archives.tar_members(spark, f"{path}/*.tar", ".txt", wanted).select("key", F.col("content").cast("string").alias("text"))


@query("f15_archive_rejects", f"WITH p AS (SELECT 'part' || (conv_id % 7) || '.tar' AS file, max({_KEY}) AS key FROM conversations GROUP BY 1) SELECT file, key, 'member is cut off' AS error FROM p UNION ALL SELECT file, NULL, 'ReadError: unexpected end of data' FROM p")
def f15_archives(spark, sf):
    """What can't be read of archives whose last member is cut off."""
    path = _folder(spark, "archives")
    _archived(_turns(spark, sf), path, cut=True)
    _, bad = rejects.parted(archives.tar_members(spark, f"{path}/*.tar", ".txt"))
    return bad.select(_file(), "key", "error")


def _saved_arrays(df, path: str, broken: int | None = None) -> None:
    """(part, id, v) as one .npz file for each part; of one part only the first half of the bytes."""

    def write(pdf):
        import io

        import numpy as np
        import pandas as pd

        buf = io.BytesIO()
        np.savez(buf, ids=pdf["id"].to_numpy(), emb=np.stack(pdf["v"].to_numpy()).astype(np.float32))
        part = int(pdf["part"].iloc[0])
        with files.created(f"{path}/part{part}.npz") as out:
            out.write(buf.getvalue()[: len(buf.getvalue()) // 2 if part == broken else None])
        return pd.DataFrame({"n": [len(pdf)]})

    df.groupBy("part").applyInPandas(write, "n long").write.format("noop").mode("overwrite").save()


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.pmod("vec_id", F.lit(5)).alias("part"), F.col("vec_id").alias("id"), F.col("embedding").alias("v"))


@query("s06_npz_rows", "SELECT 'part' || (vec_id % 5) || '.npz' AS file, vec_id::VARCHAR AS id, i::INT AS i, round(embedding[i + 1]::DOUBLE, 5) AS v FROM embeddings, (SELECT unnest(range(64)) AS i)")
def s06_rows(spark, sf):
    """Arrays in files, written by tasks and read again in runs of rows."""
    path = _folder(spark, "arrays")
    _saved_arrays(_vectors(spark, sf), path)
    rows = archives.npz_rows(spark, f"{path}/*.npz", piece=64 << 10)
    return rows.select(_file(), "id", F.posexplode("embedding").alias("i", "v")).withColumn("v", F.round(F.col("v").cast("double"), 5))


@query("f15_npz_rejects", "SELECT 'part' || (vec_id % 5) || '.npz' AS file, CASE WHEN vec_id % 5 = 3 THEN 'BadZipFile' ELSE 'read' END AS state, CASE WHEN vec_id % 5 = 3 THEN 1 ELSE count(*) END AS n FROM embeddings GROUP BY vec_id % 5")
def f15_npz(spark, sf):
    """One of five files is cut in half: it is a reject, the others are read."""
    path = _folder(spark, "arrays")
    _saved_arrays(_vectors(spark, sf), path, broken=3)
    good, bad = rejects.parted(archives.npz_rows(spark, f"{path}/*.npz"))
    both = good.select("archive", F.lit("read").alias("state")).unionByName(bad.select("archive", F.split("error", ":")[0].alias("state")))
    return both.groupBy(_file(), "state").agg(F.count("*").alias("n"))


@query("f15_json_rejects", "SELECT CASE WHEN c_custkey % 5 = 2 THEN NULL WHEN c_custkey % 5 = 4 THEN NULL ELSE c_custkey::VARCHAR END AS key, CASE c_custkey % 5 WHEN 2 THEN 'not JSON' WHEN 4 THEN 'no id' ELSE 'read' END AS state FROM customer")
def f15_json(spark, sf):
    """Documents of which every fifth is broken and every fifth has no id."""
    path, m = _folder(spark, "json"), F.pmod("c_custkey", F.lit(5))
    c = table(spark, sf, "customer")
    doc = F.when(m == 2, F.lit('{"id": ')).when(m == 4, F.lit('{"dims": {}}')).otherwise(F.to_json(F.struct(F.col("c_custkey").cast("string").alias("id"), "c_name")))
    documents.texts_each(c, path, F.col("c_custkey"), doc, folders=documents.FOLDERS)
    good, bad = rejects.parted(scans.checked_of(documents.texts_of(spark, path)))
    return good.select("key", F.lit("read").alias("state")).unionByName(bad.select("key", F.col("error").alias("state")))


_FORTY = 40


def _wide_sql() -> str:
    step = "list_sum(list_transform(range(64), lambda i: (embedding[i + 1]::DOUBLE) * ((((i + h * 5) % 13) - 6) / 10.0::DOUBLE)))"
    return f"SELECT vec_id, 'head' || h AS head, round({step}, 4) AS value FROM embeddings, (SELECT unnest(range({_FORTY})) AS h)"


@query("p21_forty_heads", _wide_sql())
def p21_forty(spark, sf):
    """Forty heads in one pass over sequences of 16 steps by 4 channels, which each head flattens."""
    import numpy as np

    e = table(spark, sf, "embeddings").select("vec_id", F.transform(F.sequence(F.lit(0), F.lit(15)), lambda t: F.slice("embedding", t * 4 + 1, F.lit(4))).alias("steps"))
    heads = {f"head{h}": infer.Net([("linear", np.array([[(((i + h * 5) % 13) - 6) / 10.0 for i in range(64)]]), np.zeros(1))]) for h in range(_FORTY)}
    return infer.run_heads(e, "vec_id", "steps", heads).withColumn("value", F.round("value", 4))


_MEAN, _VAR = "list_sum(x) / 4", "list_sum(list_transform(x, lambda v: (v - list_sum(x) / 4) ** 2)) / 4"


@query("p20_norm_classifier", f"""WITH a AS (SELECT vec_id, list_transform(range(4), lambda h: list_sum(list_transform(range(64), lambda i: (embedding[i + 1]::DOUBLE) * ((((i * 3 + h * 7) % 11) - 5) / 5.0::DOUBLE)))) AS x FROM embeddings),
n AS (SELECT vec_id, list_transform(x, lambda v: greatest(0.0, (v - ({_MEAN})) / sqrt({_VAR} + 1e-5))) AS r FROM a),
c AS (SELECT vec_id, list_transform(range(3), lambda k: list_sum(list_transform(range(4), lambda j: r[j + 1] * ((((j + k) % 3) - 1) * 0.5::DOUBLE)))) AS s FROM n)
SELECT vec_id, round(s[1], 4) AS s0, round(s[2], 4) AS s1, round(s[3], 4) AS s2 FROM c""")
def p20_classifier(spark, sf):
    """linear, layer norm, ReLU, linear: three class scores for each row."""
    import numpy as np

    first = np.array([[(((i * 3 + h * 7) % 11) - 5) / 5.0 for i in range(64)] for h in range(4)])
    last = np.array([[(((j + k) % 3) - 1) * 0.5 for j in range(4)] for k in range(3)])
    net = infer.Net([("linear", first, np.zeros(4)), ("norm", np.ones(4), np.zeros(4)), ("relu",), ("linear", last, np.zeros(3))])
    return infer.run_classifier(table(spark, sf, "embeddings"), "vec_id", "embedding", net).select("vec_id", *[F.round(F.col("scores")[i], 4).alias(f"s{i}") for i in range(3)])


# ---- models of full depth, their weights in a table ----
def _weights(spark, heads: int, widths: tuple[int, ...]):
    """(head, layer, out, w, b) by a rule: the weight of head h, layer l, output o and input i is ((7 h + 3 l + 5 o + 2 i) mod 9 - 4) / 8, b is (o mod 3 - 1) / 4."""
    each = F.sequence(F.lit(0), F.lit(heads - 1))
    sizes = [F.struct(F.lit(n).alias("layer"), F.lit(a).alias("ins"), F.lit(b).alias("outs")) for n, (a, b) in enumerate(zip(widths, widths[1:]))]
    rows = spark.range(1).select(F.explode(each).alias("h")).select("h", F.inline(F.array(*sizes))).withColumn("out", F.explode(F.sequence(F.lit(0), F.col("outs") - 1)))
    w = F.transform(F.sequence(F.lit(0), F.col("ins") - 1), lambda i: (F.pmod(F.col("h") * 7 + F.col("layer") * 3 + F.col("out") * 5 + i * 2, F.lit(9)) - 4) / 8.0)
    return rows.select(F.concat(F.lit("head"), F.col("h").cast("string")).alias("head"), "layer", "out", w.alias("w"), ((F.pmod("out", F.lit(3)) - 1) / 4.0).alias("b"))


def _layers_sql(heads: int, widths: tuple[int, ...], after) -> str:
    """CTEs l0, l1, ...: (vec_id, h, x) after each layer; after(n) gives the CTEs that lead from a{n} to l{n}, for all layers but the last."""
    ctes = [f"z AS (SELECT vec_id, h, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings, (SELECT unnest(range({heads})) AS h))"]
    for n, outs in enumerate(widths[1:]):
        src = f"l{n - 1}" if n else "z"
        w = f"((h * 7 + {n * 3} + o * 5 + i * 2) % 9 - 4) / 8.0::DOUBLE"
        ctes.append(f"a{n} AS (SELECT vec_id, h, list_transform(range({outs}), lambda o: (o % 3 - 1) / 4.0::DOUBLE + list_sum(list_transform(range({widths[n]}), lambda i: x[i + 1] * ({w})))) AS x FROM {src})")
        ctes.append(after(n) if n + 2 < len(widths) else f"l{n} AS (SELECT * FROM a{n})")
    return "WITH " + ", ".join(ctes)


_EMOTION = (64, 16, 8, 8, 4, 1)


@query("p21_forty_chains", f"{_layers_sql(40, _EMOTION, lambda n: f'l{n} AS (SELECT vec_id, h, list_transform(x, lambda v: greatest(0.0, v)) AS x FROM a{n})')} SELECT vec_id, 'head' || h AS head, round(x[1], 4) AS value FROM l4")
def p21_chains(spark, sf):
    """Forty chains of five linear layers with ReLU between them, over sequences that are flattened."""
    e = table(spark, sf, "embeddings").select("vec_id", F.transform(F.sequence(F.lit(0), F.lit(15)), lambda t: F.slice("embedding", t * 4 + 1, F.lit(4))).alias("steps"))
    w = stages.once(_weights(spark, 40, _EMOTION), "weights")
    return infer.layered(e, "vec_id", "steps", w, [["relu"]] * 4 + [[]]).select("vec_id", "head", F.round(F.col("values")[0], 4).alias("value"))


_BLOCKS = (64, 16, 16, 16, 16, 83)
_NORMED = "list_transform(x, lambda v: (v - list_avg(x)) / sqrt(list_sum(list_transform(x, lambda u: (u - list_avg(x)) ** 2)) / len(x) + 1e-5))"


def _block_sql(n: int) -> str:
    return f"n{n} AS (SELECT vec_id, h, unnest({_NORMED}) AS v, unnest(range(16)) AS o FROM a{n}), l{n} AS (SELECT vec_id, h, list({gelu_sql('v')} ORDER BY o) AS x FROM n{n} GROUP BY vec_id, h)"


@query("p20_four_blocks", f"{_layers_sql(1, _BLOCKS, _block_sql)} SELECT vec_id, o::INT AS out, round(v, 3) + 0.0 AS score FROM (SELECT vec_id, unnest(x) AS v, unnest(range(83)) AS o FROM l4)")
def p20_blocks(spark, sf):
    """Four blocks of a linear layer, a norm and GELU, and 83 scores."""
    w = stages.once(_weights(spark, 1, _BLOCKS), "weights")
    made = infer.layered(table(spark, sf, "embeddings"), "vec_id", "embedding", w, [["norm", "gelu"]] * 4 + [[]])
    return made.select("vec_id", F.posexplode("values").alias("out", "score")).withColumn("score", F.round("score", 3))


_TAPS = (((0.25, -0.5), (0.5, 0.125), (-0.25, 0.75), (0.125, 0.0), (0.5, 0.25)), ((1.0, 0.0), (0.0, 0.5), (0.0, -1.0), (0.25, 0.0), (0.0, 0.0)))


def _taps_sql(w, b: float) -> str:
    terms = " + ".join(f"coalesce(max(f.p) FILTER (WHERE f.frame_ix = t.frame_ix + {j - 2}) * {a} + max(f.s) FILTER (WHERE f.frame_ix = t.frame_ix + {j - 2}) * {c}, 0.0)" for j, (a, c) in enumerate(w))
    return f"{b} + {terms}"


@query("p22_convolution", f"WITH {T.FRAMES}, c AS (SELECT clip, frame_ix, p, (frame_ix % 7)::DOUBLE AS s FROM frames), y AS (SELECT t.clip, t.frame_ix, {_taps_sql(_TAPS[0], 0.5)} AS a, {_taps_sql(_TAPS[1], -20.0)} AS b FROM c t JOIN c f ON f.clip = t.clip AND f.frame_ix BETWEEN t.frame_ix - 2 AND t.frame_ix + 2 GROUP BY t.clip, t.frame_ix) SELECT clip, frame_ix, round(a, 6) AS a, round(1 / (1 + exp(-b)), 6) AS p FROM y")
def p22_convolution(spark, sf):
    """Two outputs over five frames of two channels, in pieces of 16 frames; the second becomes a probability."""
    f = demo.event_frames(spark, sf).select("clip", "frame_ix", F.array("p", F.pmod("frame_ix", F.lit(7)).cast("double")).alias("x"))
    y = series.convolve(f, ["clip"], "frame_ix", "x", _TAPS, (0.5, -20.0), 16)
    return y.select("clip", "frame_ix", F.round(F.col("y")[0], 6).alias("a"), F.round(S.sigmoid(F.col("y")[1]), 6).alias("p"))


# ---- audio: vectors as samples of 8, 16, 24 and 32 bits at two rates; every fiftieth file is broken ----
_BITS, _RATES, _NEW = (8, 16, 24, 32), (32_000, 24_000), 16_000


def _wav(bits: int, rate: int, ints) -> bytes:
    import io
    import wave

    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(bits // 8)
        w.setframerate(rate)
        n = bits // 8
        w.writeframes(b"".join((i + 128).to_bytes(1, "little") if n == 1 else i.to_bytes(n, "little", signed=True) for i in ints))
    return out.getvalue()


def _sounds(spark, sf):
    """(vec_id, content)"""
    k = F.col("vec_id")
    bits = F.element_at(F.array(*map(F.lit, _BITS)), F.pmod(F.floor(k / 2), F.lit(4)).cast("int") + 1)
    full = F.pow(F.lit(2.0), bits - 2)
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * full).cast("bigint"))
    rows = table(spark, sf, "embeddings").select("vec_id", bits.alias("bits"), F.element_at(F.array(*map(F.lit, _RATES)), F.pmod(k, F.lit(2)).cast("int") + 1).alias("rate"), ints.alias("ints"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            cells = zip(*(b.column(c).to_pylist() for c in ("vec_id", "bits", "rate", "ints")))
            sounds = [b"RIFF broken" if k % 50 == 7 else _wav(bits, rate, ints) for k, bits, rate, ints in cells]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(sounds, pa.binary())], names=["vec_id", "content"])

    return rows.mapInArrow(run, f"vec_id {dict(rows.dtypes)['vec_id']}, content binary")


def _filter_sql(up: int, down: int) -> str:
    """The filter's definition: a sinc under a raised cosine over sixteen crossings, for each phase scaled to add up to one."""
    import math

    cut, rows = min(1.0, up / down), []
    w = math.ceil(16 / cut)
    for phase in range(up):
        at = [k - phase / up for k in range(-w + 1, w + 1)]
        t = [(math.sin(math.pi * cut * d) / (math.pi * cut * d) if d else 1.0) * (0.5 + 0.5 * math.cos(math.pi * max(-1.0, min(1.0, d * cut / 16)))) for d in at]
        rows.append("[" + ", ".join(f"{x / sum(t)!r}::DOUBLE" for x in t) + "]")
    return "[" + ", ".join(rows) + "]"


_UP_DOWN = {32_000: (1, 2), 24_000: (2, 3)}
_AUDIO = f"""WITH q AS (SELECT vec_id, (vec_id % 2)::INT AS r, ([8, 16, 24, 32])[(vec_id // 2 % 4 + 1)::INT] AS bits, embedding FROM embeddings WHERE vec_id % 50 <> 7),
x AS (SELECT vec_id, r, list_transform(embedding, lambda v: floor(v::DOUBLE * pow(2.0, bits - 2)) / pow(2.0, bits - 1)) AS x FROM q),
t AS (SELECT vec_id, r, x, unnest(range((len(x) * CASE r WHEN 0 THEN 0.5 ELSE 2 / 3.0 END + 0.5)::BIGINT - CASE WHEN (len(x) * CASE r WHEN 0 THEN 0.5 ELSE 2 / 3.0 END + 0.5)::BIGINT > len(x) * CASE r WHEN 0 THEN 0.5 ELSE 2 / 3.0 END + 0.5 THEN 1 ELSE 0 END)) AS i FROM x),
f AS (SELECT 0 AS r, 1 AS up, 2 AS down, {_filter_sql(1, 2)} AS taps UNION ALL SELECT 1, 2, 3, {_filter_sql(2, 3)}),
g AS (SELECT vec_id, i, x, i * down // up AS base, taps[(i * down % up + 1)::INT] AS tap FROM t JOIN f USING (r)),
y AS (SELECT vec_id, i, list_sum(list_transform(range(1, len(tap) + 1), lambda k: CASE WHEN base + k - len(tap) // 2 BETWEEN 0 AND len(x) - 1 THEN tap[k] * x[(base + k - len(tap) // 2 + 1)::INT] ELSE 0.0 END)) AS y FROM g)
SELECT vec_id, i::INT AS i, round(y::FLOAT::DOUBLE, 5) + 0.0::DOUBLE AS sample FROM y"""


@query("s08_resampled", _AUDIO)
def s08_resampled(spark, sf):
    good = scans.decode_audio(_sounds(spark, sf), "vec_id", "content", _NEW).filter("error is null")
    return good.select("vec_id", F.posexplode("samples").alias("i", "s")).select("vec_id", "i", (F.round(F.col("s").cast("double"), 5) + 0.0).alias("sample"))


@query("f15_audio", "SELECT vec_id, vec_id % 50 = 7 AS rejected, CASE WHEN vec_id % 50 <> 7 THEN (len(embedding) * CASE vec_id % 2 WHEN 0 THEN 1 ELSE 4 / 3.0 END / 2)::INT END AS n FROM embeddings")
def f15_audio(spark, sf):
    good, bad = rejects.parted(scans.decode_audio(_sounds(spark, sf), "vec_id", "content", _NEW))
    return good.select("vec_id", F.lit(False).alias("rejected"), F.size("samples").alias("n")).unionByName(bad.select("vec_id", F.lit(True).alias("rejected"), F.lit(None).cast("int").alias("n")))


@query("p27_level_count", "SELECT p_partkey, CASE WHEN p_partkey % 4 IN (0, 1) THEN 7 ELSE len(string_split(p_type, ' ')) + p_partkey % 2 END::INT AS n FROM part")
def p27_levels(spark, sf):
    """Levels that are not named, null or an empty list, count as seven."""
    k, words = F.pmod("p_partkey", F.lit(4)), F.split("p_type", " ")
    levels = F.when(k == 1, F.array().cast("array<string>")).when(k == 2, words).when(k == 3, F.concat(words, F.array("p_brand")))
    return table(spark, sf, "part").select("p_partkey", S.level_count(levels).cast("int").alias("n"))
