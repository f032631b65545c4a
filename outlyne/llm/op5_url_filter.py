"""URL filtering by listed rules and, where none fits, by association rules that Spark's FP-growth mines.

Listed rules are (verdict, host + path).  One fits its host and all subdomains if the url's path starts with the rule's path; the
longest wins.  Urls that a listed rule decides are the labelled transactions: their tokens (host labels, path words with
digits folded, extension, query keys, fragment) and the verdict as one more item.  Tokens that are always together in them are one item,
which a url has if it has any of them: of rules that differ in such tokens only, each says the same.  Frequent sets with a verdict become rules
`tokens -> verdict`; those below SUPPORT or CONFIDENCE go, and so do those that no rule with fewer tokens is worse than.  An
inverted index token -> rule finds the rules of a url: a rule matches when all of its tokens were found.
The surest rule decides; with none the verdict is DEFAULT.

Of equally sure rules the one with more support decides, then the one with more tokens, then the verdict that sorts last.

Scale: only the url column is read.  A support of SUPPORT bounds the frequent tokens, whatever the input, but not the sets of them: n frequent
tokens that are together in many urls, and apart in some, make 2^n sets, all of which are mined before the longer ones are pruned.  Tokens are
told to be always together by two 64-bit hashes over the token sets that hold them.  Index and items are broadcast
only after their size was counted.  Equal urls are matched once.  All steps are DataFrame operations.

Nulls: a null url, or one without `://`, has an empty host and path, no rule and the DEFAULT verdict.  Repeated pages each get a row.
An empty table gives an empty result.  Urls of any length are read whole.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Workspace, lower_ascii, maybe_broadcast, table

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
SUPPORT, CONFIDENCE, DEFAULT = 0.01, 0.8, "allow"


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and what follows them."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(tail, r"^[^?#]*", 0)
    return lower_ascii(host), path, F.substring(tail, F.length(path) + 1, F.length(tail))


def listed_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest listed rule that fits, as a string; null if none does."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def url_tokens(host: Column, path: Column, more: Column) -> Column:
    """Distinct tokens of a url."""
    part = lambda c, sep, kind: F.transform(F.array_remove(F.split(c, sep), ""), lambda x: F.concat(F.lit(kind), x))
    words = F.regexp_replace(F.regexp_replace(path, r"\.[A-Za-z]+$", ""), r"[0-9]+", "#")
    ext = F.regexp_extract(path, r"\.([A-Za-z]+)$", 1)
    query = F.regexp_extract(more, r"^\?([^#]*)", 1)
    keys = part(F.regexp_replace(query, r"=[^&]*", ""), "&", "q:")
    flags = F.array(F.when(ext != "", F.concat(F.lit("x:"), ext)), F.when(F.instr(more, "#") > 0, F.lit("f:")))
    return F.array_distinct(F.array_compact(F.concat(part(host, r"\.", "h:"), part(words, r"[/_\-]", "p:"), keys, flags)))


def together(labelled: DataFrame, support: float = SUPPORT) -> DataFrame:
    """(token, item) for frequent tokens that other frequent ones are always with in rows (tokens); the item is the least of them."""
    sets = labelled.groupBy(F.array_sort("tokens").alias("tokens")).count()
    marks = [F.xxhash64(F.lit(i), "tokens").alias(f"mark{i}") for i in (1, 2)]
    held = sets.select(F.explode("tokens").alias("token"), "count", *marks).groupBy("token").agg(F.sum("count").alias("rows"), F.bit_xor("mark1").alias("mark1"), F.bit_xor("mark2").alias("mark2"))
    held = held.filter(F.col("rows") >= support * labelled.count())
    alike = Window.partitionBy("rows", "mark1", "mark2")
    return held.select("token", F.min("token").over(alike).alias("item"), F.count("*").over(alike).alias("n")).filter("n > 1").select("token", "item")


def as_items(rows: DataFrame, key: str, items: DataFrame) -> DataFrame:
    """rows (key, tokens) with items (token, item) in place of their tokens."""
    each = rows.select(key, F.explode_outer("tokens").alias("token")).join(maybe_broadcast(items, items.count(), 200), "token", "left")
    return each.groupBy(key).agg(F.collect_set(F.coalesce("item", "token")).alias("tokens"))


def mine(ws: Workspace, labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(rid, tokens, verdict, confidence, support) from rows (tokens, verdict)."""
    n = labelled.count()
    schema = "rid string, tokens array<string>, verdict string, confidence double, support double"
    if not n:
        return ws.spark.createDataFrame([], schema)
    tagged = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("="), "verdict"))).alias("items"))
    sets = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence, numPartitions=int(ws.spark.conf.get("spark.sql.shuffle.partitions"))).fit(tagged).freqItemsets
    sets = ws.put("sets", sets.select(F.array_sort("items").alias("items"), "freq"))
    is_label = lambda x: F.startswith(x, F.lit("="))
    with_label = sets.filter(F.exists("items", is_label) & (F.size("items") > 1))
    with_label = with_label.select(F.filter("items", lambda x: ~is_label(x)).alias("tokens"), F.substr(F.filter("items", is_label)[0], F.lit(2)).alias("verdict"), "freq")
    alone = sets.filter(~F.exists("items", is_label)).select(F.col("items").alias("tokens"), F.col("freq").alias("all"))
    rules = with_label.join(alone, "tokens").select("tokens", "verdict", (F.col("freq") / F.col("all")).alias("confidence"), (F.col("freq") / F.lit(n)).alias("support"))
    rules = ws.put("rules", rules.filter(F.col("confidence") >= confidence).withColumn("rid", F.to_json(F.struct("tokens", "verdict"))))
    # a rule goes if leaving out one of its tokens gives one that is as sure
    shorter = rules.select("rid", "verdict", "confidence", F.explode(F.transform("tokens", lambda t: F.array_except("tokens", F.array(t)))).alias("tokens"))
    worse = shorter.alias("a").join(rules.alias("b"), (F.col("a.tokens") == F.col("b.tokens")) & (F.col("a.verdict") == F.col("b.verdict")) & (F.col("b.confidence") >= F.col("a.confidence"))).select("a.rid").distinct()
    return ws.put("kept", rules.join(worse, "rid", "left_anti").select("rid", "tokens", "verdict", "confidence", "support"))


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, verdict) of the surest rule for rows (url, tokens), by an inverted index; urls without a match are left out."""
    index = rules.select(F.explode("tokens").alias("token"), "rid", F.size("tokens").alias("n"), "verdict", "confidence", "support")
    index = maybe_broadcast(index, index.count(), 400)
    hits = urls.select("url", F.explode("tokens").alias("token")).join(index, "token")
    whole = hits.groupBy("url", "rid").agg(F.count("*").alias("found"), F.first("n").alias("n"), F.max(F.struct("confidence", "support", "n", "verdict")).alias("rule")).filter("found = n")
    return whole.groupBy("url").agg(F.max("rule").alias("rule")).select("url", F.col("rule.verdict").alias("mined"))


def judge(pages: DataFrame, rules=RULES, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of pages (page_id, url)."""
    ws = Workspace(pages.sparkSession, "urls")
    host, path, more = url_parts(F.coalesce("url", F.lit("")))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"), more.alias("more"))
    rows = ws.put("rows", rows.withColumn("rule", listed_rule(F.col("host"), F.col("path"), rules)).withColumn("tokens", url_tokens(F.col("host"), F.col("path"), F.col("more"))).drop("more"))
    said = F.lit(None).cast("string")
    for verdict, rule in rules:
        said = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(said)
    labelled = ws.put("labelled", rows.filter("rule is not null").select(F.monotonically_increasing_id().alias("at"), "tokens", said.alias("verdict")))
    open_ = rows.filter("rule is null and url is not null").groupBy("url").agg(F.first("tokens").alias("tokens"))
    items = ws.put("items", together(labelled, support))
    if not items.isEmpty():
        labelled = ws.put("merged", as_items(labelled, "at", items).join(labelled.select("at", "verdict"), "at"))
        open_ = as_items(open_, "url", items)
    found = ws.put("found", match(open_, mine(ws, labelled.select("tokens", "verdict"), support, confidence)))
    ws.keep("rows", "found")
    return rows.join(found, "url", "left").select("page_id", "host", "path", "rule", F.coalesce(said, "mined", F.lit(DEFAULT)).alias("verdict"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"))
