"""python -m outlyne caption | baseline: captions of prediction documents, and baselines from scores."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .model import TEMPLATES, Config, Lexicon
from .operators import records, stats
from .sources import documents, scans, stages


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="outlyne", description=__doc__)
    commands = p.add_subparsers(dest="command", required=True)
    c = commands.add_parser("caption", help="say what is unusual in prediction documents")
    c.add_argument("preds", help="path or glob of JSON documents, or - for standard input")
    c.add_argument("--baseline", required=True, help="JSON document of dimensions and their statistics")
    c.add_argument("--words", help="JSON object: dimension -> [high phrase, low phrase, high tag, low tag]")
    c.add_argument("--kv", type=int, default=Config.k_dims, help="dimensions described at most")
    c.add_argument("--ke", type=int, default=Config.k_emotions, help="emotions described at most")
    c.add_argument("--seed", type=int, help="draws synonyms, order and form")
    c.add_argument("--template", default="default", help=f"{', '.join(TEMPLATES)} or random")
    c.add_argument("--shuffle", action="store_true", help="deal dimensions and emotions in drawn order")
    c.add_argument("--json", action="store_true", help="what was selected, in place of the text")
    c.add_argument("--out", help="folder of JSON lines; else rows are printed")
    b = commands.add_parser("baseline", help="statistics of each dimension, as a JSON document")
    b.add_argument("scores", help="Parquet with grp, dim, value")
    b.add_argument("--out", required=True)
    return p.parse_args(argv)


def caption(spark: SparkSession, a: argparse.Namespace) -> None:
    """A document without an id is named by a number.  Rows are printed partition by partition, never gathered."""
    preds = scans.predictions_from_text(spark, sys.stdin.read()) if a.preds == "-" else scans.predictions(spark, a.preds)
    named = F.coalesce("entity_id", F.concat(F.lit("document-"), F.monotonically_increasing_id().cast("string")))
    preds = stages.once(preds.withColumn("entity_id", named), "predictions")
    lexicon = Lexicon(dims=json.loads("\n".join(r[0] for r in spark.read.text(a.words).collect()))) if a.words else Lexicon()
    cfg = replace(Config(), k_dims=a.kv, k_emotions=a.ke, template=a.template)
    seed = None if a.seed is None else F.lit(a.seed)
    out = records.caption(preds, scans.baseline_document(spark, a.baseline), lexicon, cfg, "json" if a.json else "text", seed, shuffle=a.shuffle)
    if a.out:
        out.write.mode("overwrite").json(a.out)
        return
    for r in out.toLocalIterator():
        print(r["json"] if a.json else f"{r['entity_id']} [{r['template']}] {r['text']}")


def baseline(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = stats.baseline_stats(spark.read.parquet(a.scores).select("grp", "dim", "value"), "grp")
    print(f"{documents.baseline(rows, a.out, {'source': a.scores})} dimensions")


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    a = arguments(argv)
    spark = spark or SparkSession.builder.appName("outlyne").getOrCreate()
    {"caption": caption, "baseline": baseline}[a.command](spark, a)


if __name__ == "__main__":
    main()
