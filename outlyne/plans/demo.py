"""The data flow on the test tables: suppliers are the described entities, users' events the time series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import Config, Lexicon
from ..operators import stats

CFG = Config()
LEXICON = Lexicon(dims={
    "QTY": ("large in order quantity", "small in order quantity", "bulk", "sparse"),
    "PRICE": ("costly in line price", "cheap in line price", "costly", "cheap"),
    "DISC": ("generous in discount", "strict in discount", "generous", "strict"),
    "TAX": ("heavily taxed", "lightly taxed", "taxed", "untaxed"),
    "TEMP": ("long in order lists", "short in order lists", "long-listed", None),
})
NAMES = {"QTY": "Quantity", "PRICE": "Price", "DISC": "Discount", "TAX": "Tax", "TEMP": "Order length", "genuineness": "Genuineness", "blend": "Blend"}
SYNONYMS = {"RETURN": ["returns", "send-backs", "refunds"], "ACCEPT": ["acceptance"]}
DIM_ORDER = ("QTY", "PRICE", "DISC", "TAX", "AGEV", "GEND", "REGS", "TEMP")
EMOTIONS = ("RETURN", "ACCEPT", "OPEN")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def supplier_scores(spark: SparkSession, sf: str) -> DataFrame:
    """(entity_id, grp, dim, dim_ix, value): one aggregate over lineitem, one small join, no wide row is kept."""
    share = lambda c, v: F.avg(F.when(F.col(c) == v, 1.0).otherwise(0.0))
    li = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.avg("l_quantity").alias("q"), F.avg("l_extendedprice").alias("p"), F.avg("l_discount").alias("d"), F.avg("l_tax").alias("t"), F.avg("l_linenumber").alias("ln"),
        share("l_returnflag", "R").alias("r"), share("l_returnflag", "A").alias("a"), share("l_linestatus", "O").alias("o"),
    )
    x = li.join(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal"), "s_suppkey")
    r = lambda c, n=6: F.round(c, n)
    k = F.col("s_suppkey")
    cells = {
        ("trait", "QTY"): F.col("q"), ("trait", "PRICE"): r(F.col("p")), ("trait", "DISC"): r(F.col("d"), 9), ("trait", "TAX"): r(F.col("t"), 9),
        ("trait", "AGEV"): F.col("s_nationkey") * 0.24, ("trait", "GEND"): F.pmod(k, F.lit(25)) * 0.24, ("trait", "REGS"): F.pmod(k * 7, F.lit(25)) * 0.24, ("trait", "TEMP"): F.col("ln"),
        ("emotion", "RETURN"): F.col("r"), ("emotion", "ACCEPT"): F.col("a"), ("emotion", "OPEN"): F.col("o"),
        ("quality", "genuineness"): (F.col("s_acctbal") + 1000.0) / 1833.0, ("quality", "blend"): r(F.col("t") * 125, 7),
    }
    ix = {d: i for names in (DIM_ORDER, EMOTIONS, ("genuineness", "blend")) for i, d in enumerate(names)}
    rows = F.array(*[F.struct(F.lit(g).alias("grp"), F.lit(d).alias("dim"), F.lit(ix[d]).alias("dim_ix"), c.cast("double").alias("value")) for (g, d), c in cells.items()])
    return x.select(k.alias("entity_id"), F.inline(rows))


def experts(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(k.alias("entity_id"), F.when(F.pmod(k, F.lit(10)) != 0, (F.pmod(k, F.lit(9)) - 4) / 4.0).alias("expert"))


def supplier_baseline(scores: DataFrame) -> DataFrame:
    b = stats.baseline_stats(scores, "grp")
    name, syn = F.col("dim"), F.lit(None).cast("array<string>")
    for d, n in NAMES.items():
        name = F.when(F.col("dim") == d, n).otherwise(name)
    for d, w in SYNONYMS.items():
        syn = F.when(F.col("dim") == d, F.array(*map(F.lit, w))).otherwise(syn)
    return b.withColumns({"name": name, "synonyms": syn})


def hours(c: str = "ts"):
    """Hours since 2024 began."""
    return F.round(F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', cast({c} AS TIMESTAMP_NTZ))") / 3.6e9, 2)


#: Bounds that suit hours.
EVENT_CFG = Config(pause=24.0, slack=2.0, locator_threshold=20.0, frames_per_second=1, min_frames=3, min_duration=4.0, min_transient=8.0)


def event_words(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    e = table(spark, sf, "events").filter("event_type IN ('view', 'click')").select(F.col("user_id").alias("clip"), "event_id", "event_type", hours().alias("start"), "value")
    return e.select("clip", (F.row_number().over(Window.partitionBy("clip").orderBy("start", "event_id")) - 1).alias("ix"), F.concat("event_type", F.col("event_id").cast("string")).alias("w"), "start", F.round(F.col("start") + F.floor("value") * 0.1, 2).alias("end"))


def event_bursts(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").filter("event_type = 'error'")
    return e.select(F.col("user_id").alias("clip"), F.col("event_id").alias("b_ix"), hours().alias("start"), F.round(hours() + F.floor("value") * 0.2, 2).alias("end"), F.concat(F.lit("E"), F.pmod("event_id", F.lit(7)).cast("string")).alias("label"))


def event_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return sentences_of(event_words(spark, sf))


def sentences_of(words: DataFrame) -> DataFrame:
    """Five words each; some have no times."""
    w = words.withColumn("s", F.floor(F.col("ix") / 5).cast("int"))
    text = F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ix", "w"))), lambda x: x["w"]), " "), F.lit("."))
    s = w.groupBy("clip", F.col("s").alias("ix")).agg(text.alias("text"), F.min("start").alias("a"), F.max("end").alias("b"))
    timed = F.pmod(F.col("clip") + F.col("ix"), F.lit(7)) != 0
    return s.select("clip", "ix", "text", F.when(timed, F.col("a")).alias("start"), F.when(timed, F.col("b")).alias("end"))


def event_frames(spark: SparkSession, sf: str) -> DataFrame:
    """A user's events in time order are the frames, their values the probabilities; word_ix numbers the words among them."""
    from pyspark.sql import Window

    line = Window.partitionBy("clip").orderBy("ts", "event_id")
    is_word = F.col("event_type").isin("view", "click")
    word_ix = F.count_if(is_word).over(line.rowsBetween(Window.unboundedPreceding, 0)) - 1
    e = table(spark, sf, "events").select(F.col("user_id").alias("clip"), "ts", "event_id", "event_type", "value")
    return e.select("clip", (F.row_number().over(line) - 1).alias("frame_ix"), F.col("value").alias("p"), "event_type", F.when(is_word, word_ix).cast("int").alias("word_ix"))
