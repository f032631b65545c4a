"""License scan by a positional index of rare words, by SQL functions only.

Templates are licence phrases, which must stand word for word, and licence notices, of which a part is enough.  The words of all
templates get their document frequency over all documents, and with it an inverse one (IDF).  The index lists each template's
rarest words with their places in it: of the words that occur in any document RARE of a notice, one of a phrase, less those whose IDF is under LEAST of
the template's highest.  A notice with a key word that no document has can't be verified and is not indexed.  In a text only these words are looked up, at all their
positions: the position less the place is where the template would begin, so the postings of a template are intersected by relative
position.  A phrase is verified word for word at such a beginning.  A notice's beginning is rated by the share of IDF of its postings that are within
SLACK words of where they should be; it counts from SHARE on, if the notice's key phrases stand within REACH words of their places.

Scale: one pass counts the template words of each text (a few hundred groups, summed before the shuffle), one pass scans; nothing
else is shuffled, no text is copied, and no row meets another, so copies and hot sources cost what they hold.  The index is a
literal whose size is that of the templates, not of the documents.  A text's work grows with its words and with its occurrences of rare words.

Nulls: a null text is empty: no words, no places, score 0.  A null id stays.  Repeated rows are scanned each for itself and counted each in
the frequencies.  Texts are read whole; a text's words are one array of its task.  Ties in frequency go by code point.  An
empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, table

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE, LEAST, SLACK, REACH, SHARE = 8, 0.3, 2, 12, 0.6

#: Phrases that are a licence's name, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Notice:
    """A licence notice as words, and the phrases of it that must be found."""

    label: str
    text: str
    keys: tuple[str, ...]


#: The public wording of notices.  They are a parameter of scan().
NOTICES = (
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", ("permission is hereby granted free of charge", "without restriction")),
    Notice("mit", "released under the mit license", ("mit license",)),
    Notice("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", ("apache license", "except in compliance with the license")),
    Notice("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Notice("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("gnu general public license",)),
    Notice("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    Notice("lgpl", "redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ("lesser general public license",)),
    Notice("agpl", "redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", ("affero general public license",)),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Notice("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ("with or without fee is hereby granted",)),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    Notice("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    Notice("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Notice("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    Notice("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Notice("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial 4 0",)),
    Notice("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
)


def words(text: Column) -> Column:
    """Lower-cased words: runs of digits, letters and all that is not ASCII."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP), "")


def frequencies(docs: DataFrame, vocabulary: Sequence[str]) -> tuple[int, dict[str, int]]:
    """Number of rows, and in how many texts each word of the vocabulary occurs."""
    known = F.array_distinct(F.filter(words(F.col("text")), lambda w: w.isin(*vocabulary)))
    rows = docs.select(F.explode(F.array_append(known, "")).alias("w")).groupBy("w").count()  # the empty word counts the rows
    found = {r["w"]: r["count"] for r in rows.collect()}  # as many rows as the vocabulary has words
    return found.pop("", 0), found


_WORDS = "array<struct<w:string,p:int>>"
_INDEX = f"array<struct<label:string,words:{_WORDS},postings:array<struct<w:string,p:int,v:double>>,keys:array<struct<p:int,words:{_WORDS}>>>>"


def _placed(own: Sequence[str]) -> list[dict]:
    return [{"w": w, "p": i} for i, w in enumerate(own)]


def entry(n: int, found: Mapping[str, int], label: str, text: str, rare: int, keys: Sequence[str] = ()) -> dict:
    """A template in the index: its words, postings (word, place, share of the IDF) of its rarest words, and its key phrases."""
    own = text.split()
    idf = {w: math.log((n + 2) / (found[w] + 1)) for w in own if w in found}
    chosen = {w for w in sorted(idf, key=lambda w: (found[w], w))[:rare] if idf[w] >= LEAST * max(idf.values())}
    worth = [(w, i, idf[w]) for i, w in enumerate(own) if w in chosen]
    total, places = sum(v for _, _, v in worth), []
    for key in map(str.split, keys):
        places += [{"p": i, "words": _placed(key)} for i in range(len(own)) if own[i : i + len(key)] == key][:1]
    return {"label": label, "words": _placed(own), "postings": [{"w": w, "p": i, "v": v / total} for w, i, v in worth], "keys": places}


def _literal(entries: list[dict]) -> Column:
    """The index as a constant of the plan."""
    return F.from_json(F.lit(json.dumps(entries)), _INDEX)


def _starts(t: Column, spots: Column, text: Column) -> Column:
    """Where a template would begin, by each of its postings."""
    at = lambda q: F.transform(F.filter(spots, lambda i: F.get(text, i) == q["w"]), lambda i: i - q["p"])
    return F.array_distinct(F.flatten(F.transform(t["postings"], at)))


def _stands(text: Column, at: Column, phrase: Column) -> Column:
    return F.forall(phrase, lambda x: F.coalesce(F.get(text, at + x["p"]) == x["w"], F.lit(False)))


def _around(c: Column | int, reach: int) -> Column:
    return F.sequence(c - F.lit(reach), c + F.lit(reach))


def _share(t: Column, text: Column, at: Column, slack: int) -> Column:
    near = lambda q: F.exists(_around(at + q["p"], slack), lambda i: F.coalesce(F.get(text, i) == q["w"], F.lit(False)))
    return F.round(F.aggregate(t["postings"], F.lit(0.0), lambda got, q: got + F.when(near(q), q["v"]).otherwise(0.0)), 6)


def _verified(t: Column, text: Column, at: Column, reach: int) -> Column:
    return F.forall(t["keys"], lambda k: F.exists(_around(at + k["p"], reach), lambda i: _stands(text, i, k["words"])))


def scan(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, notices: Sequence[Notice] = NOTICES, rare: int = RARE, slack: int = SLACK, reach: int = REACH, share: float = SHARE) -> DataFrame:
    """(doc_id, n_words, places, notices) for rows (doc_id, text).

    places: (start, label) of every phrase that stands in the text, in order; notices: (label, share, start) of the best place of each notice that
    was found, in the order of the templates.  Starts count words from 0; that of a notice may be negative if its first words are missing.
    """
    templates = [*phrases, *(x.text for x in notices)]
    n, found = frequencies(docs, sorted({w for t in templates for w in t.split()}))
    names = [entry(n, found, label, p, 1) for p, label in phrases.items()]
    texts = [entry(n, found, x.label, x.text, rare, x.keys) for x in notices if all(w in found for k in x.keys for w in k.split())]
    lookup = sorted({q["w"] for e in (*names, *texts) for q in e["postings"]})
    rows = docs.select("doc_id", words(F.col("text")).alias("w"))
    rows = rows.withColumn("spots", F.array_compact(F.transform("w", lambda x, i: F.when(x.isin(*lookup), i))))
    w, spots = F.col("w"), F.col("spots")

    def stands(t: Column) -> Column:
        at = F.filter(_starts(t, spots, w), lambda s: _stands(w, s, t["words"]))
        return F.transform(at, lambda s: F.struct(s.alias("start"), t["label"].alias("label")))

    def best(t: Column) -> Column:
        rated = F.transform(_starts(t, spots, w), lambda s: F.struct(_share(t, w, s, slack).alias("share"), (-s).alias("back")))
        good = F.filter(rated, lambda x: (x["share"] >= share) & _verified(t, w, -x["back"], reach))
        return F.transform(F.slice(F.reverse(F.array_sort(good)), 1, 1), lambda x: F.struct(t["label"].alias("label"), x["share"].alias("share"), (-x["back"]).alias("start")))

    some = lambda c, kind: F.when(F.size("spots") > 0, c).otherwise(F.array().cast(kind))
    places = some(F.array_sort(F.flatten(F.transform(_literal(names), stands))), "array<struct<start:int,label:string>>")
    said = some(F.flatten(F.transform(_literal(texts), best)), "array<struct<label:string,share:double,start:int>>")
    return rows.select("doc_id", F.size("w").cast("long").alias("n_words"), places.alias("places"), said.alias("notices"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """score: 1 if a phrase stands in the text, else the share of the best notice, else 0."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.col("places.start")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    score = F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("notices.share"), F.lit(0.0)))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(F.col("places.label")).alias("base_labels"), joined(F.concat("places.label", "notices.label")).alias("labels"), score.alias("score"),
    )
