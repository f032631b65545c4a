"""Seeded choice: templates, samples, epochs.  Draws are md5 digits, so they do not depend on partitions or processes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import draw, pick
from ..model import BURST_PHRASES, TEMPLATES

EPOCH_STEP, SENTENCE_STEP, CLIP_SEEDS = 1_000_003, 0x9E3779B1, 1 << 30


def template_pick(template: Column, seed: Column) -> Column:
    """`random` draws one of the forms by seed; an unknown name is the default."""
    return F.when(template == "random", pick(TEMPLATES, draw(seed, "template"))).when(template.isin(list(TEMPLATES)), template).otherwise("default")


def burst_phrase(label: Column, seed: Column) -> Column:
    return F.replace(pick(BURST_PHRASES, draw(seed, "burst", label)), F.lit("{b}"), label)


def clip_seed(clip: Column) -> Column:
    return F.pmod(draw(F.lit(0), "clip", clip), F.lit(CLIP_SEEDS))


def sentence_seed(seed: Column, ix: Column) -> Column:
    """ix counts from 0."""
    return seed.cast("bigint").bitwiseXOR((ix.cast("bigint") + 1) * SENTENCE_STEP)


def epochs(examples: DataFrame, n: int, key: str = "example_id") -> DataFrame:
    """Each example once for each epoch, with the seed of the pair."""
    out = examples.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return out.withColumn("seed", F.col("epoch").cast("bigint") * EPOCH_STEP + F.col(key).cast("bigint"))


def augment_draws(seed: Column) -> tuple[Column, Column, Column]:
    """Template, synonym seed, and whether to shuffle."""
    return pick(TEMPLATES, draw(seed, "augment-template")), F.pmod(draw(seed, "augment-synonym"), F.lit(CLIP_SEEDS)), draw(seed, "augment-shuffle") < (1 << 31)


def stratified_sample(df: DataFrame, stratum: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows of each stratum in drawn order: exact, unlike sampleBy."""
    w = Window.partitionBy(stratum).orderBy(draw(F.lit(seed), "sample", F.col(key)), key)
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n).drop("rn")


def simple_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """min(n, rows) rows: a distributed top-n over draws, not a sort of all rows."""
    return df.withColumn("d", draw(F.lit(seed), "sample", F.col(key))).orderBy("d", key).limit(n).drop("d")


def two_level_sample(df: DataFrame, stratum: str, shard: str, key: str, shards: int, per_shard: int, seed: int = 0) -> DataFrame:
    """Of each stratum some drawn shards, of each of those some drawn rows."""
    s = df.select(stratum, shard).distinct()
    s = s.withColumn("sn", F.row_number().over(Window.partitionBy(stratum).orderBy(draw(F.lit(seed), "shard", F.col(shard)), shard))).filter(F.col("sn") <= shards).drop("sn")
    w = Window.partitionBy(stratum, shard).orderBy(draw(F.lit(seed), "key", F.col(key)), key)
    return df.join(s, [stratum, shard], "left_semi").withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= per_shard).drop("rn")


def first_shard_sample(df: DataFrame, shard: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """n drawn rows of the first shard, in drawn order, that has as many."""
    full = df.groupBy(shard).agg(F.count("*").alias("m")).filter(F.col("m") >= n)
    first = full.withColumn("d", draw(F.lit(seed), "shard", F.col(shard))).orderBy("d", shard).limit(1).select(shard)
    return simple_sample(df.join(F.broadcast(first), shard, "left_semi"), key, n, seed)
