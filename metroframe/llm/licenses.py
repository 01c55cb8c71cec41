"""License scan: exact phrases, and notices found by diagonal voting.

All rolling k-word groups of every text are joined to the positions of the
templates' groups (about a thousand rows, broadcast). A hit votes for its
diagonal, the offset between its place in the text and in the template.
Neighbouring diagonals, which insertions and deletions make, are merged. A
merged span with enough votes proposes a place, and the words there are aligned
with the template: a notice is found when few words are edited. Words that tell
licenses apart must not be.

No notice is missed by the vote: an edited word breaks at most k groups, so of a
template of n words at least n - k + 1 - k * e groups are left by e edits, on
diagonals at most e apart. With pairs of words and three edits in ten words some
are left of every template of four words and more.

Everything is DataFrame expressions. Groups that hit no template end in the
join, in the task that read them; only votes are shuffled, and the places they
propose go back to their texts.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metroframe.llm.common import stored, texts_and_ids

#: fixed values: the phrases looked up as they are, and their labels
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
#: fixed values: the wording of common license notices, and their labels
TEMPLATES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("spdx license identifier mit", "mit"),
    ("spdx license identifier apache 2 0", "apache-2"),
    ("spdx license identifier gpl 3 0", "gpl-3"),
    ("spdx license identifier mpl 2 0", "mpl-2"),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "mit"),
    ("to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute "
     "sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so", "mit"),
    ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
     "merchantability fitness for a particular purpose and noninfringement", "mit"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
     "without warranties or conditions of any kind either express or implied", "apache-2"),
    ("this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
     "merchantability or fitness for a particular purpose", "gpl"),
    ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
     "this software without specific prior written permission", "bsd"),
]
K = 2
#: the largest share of a template's words that may be edited
EDITED = 0.3
#: words that tell licenses apart: an edited notice holds those of its template and no others
NAMES = ["mit", "bsd", "apache", "mozilla", "eclipse", "gnu", "lesser", "lgpl", "affero", "agpl", "creative", "commons", "cc", "nc",
         "noncommercial", "commercial", "sharealike", "sa", "noderivatives", "nd"]
#: a number may stand as v2
VERSION = r"^v(?=[0-9]+$)"
KELVIN, LIKE_KELVIN = "K", "ĸ"


def words(text: Column) -> Column:
    """The words of a text: A-Z lower-cased, runs of digits, a-z and non-ASCII."""
    # of the characters outside ASCII only the Kelvin sign has an ASCII letter as its lower case
    low = F.lower(F.replace(text, F.lit(KELVIN), F.lit(LIKE_KELVIN)))
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def word_groups(df: DataFrame, *keep: str) -> DataFrame:
    """(keep..., pos, g0 ... g(K-1)): every rolling group of K words of the
    array column ``words``, with its place."""
    n = F.size("words") - (K - 1)
    zipped = F.arrays_zip(*(F.slice("words", F.lit(i + 1), n).alias(f"g{i}") for i in range(K)))
    rows = df.where(F.size("words") >= K).select(*keep, F.posexplode(zipped).alias("pos", "g"))
    return rows.select(*keep, "pos", *(F.col(f"g.g{i}").alias(f"g{i}") for i in range(K)))


def unversioned(word: Column) -> Column:
    return F.when(word.startswith("v"), F.regexp_replace(word, VERSION, "")).otherwise(word)


class Notice:
    """A template as it is looked for: its words, the most edits, what losing
    each word costs, and the fewest votes that so many edits leave."""

    def __init__(self, text: str, label: str, names: list[str]) -> None:
        self.label, self.words = label, [re.sub(VERSION, "", w) for w in template_words(text)]
        n = len(self.words)
        self.most = int(EDITED * n + 1e-9)
        self.votes = max(1, n - K + 1 - K * self.most)
        kept = {*names, *label.split("-")}
        self.cost = [n + 1 if w in kept else 1 for w in self.words]

    def row(self) -> dict:
        # last, after what the words so far cost if all are lost, stands the least cost of any span
        lost = [sum(self.cost[:i]) for i in range(len(self.words) + 1)]
        return {"label": self.label, "n": len(self.words), "most": self.most, "lost": [*lost, lost[-1]],
                "words": [{"word": w, "cost": c, "i": i} for i, (w, c) in enumerate(zip(self.words, self.cost))]}


def literal(value: object, schema: str) -> Column:
    """A nested value as one literal rather than thousands of columns."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def template_table(spark: SparkSession, notices: list[Notice]) -> DataFrame:
    """(t, most, least, t_pos, hash, t0 ...): the templates' word groups."""
    rows = [{"t": t, "most": x.most, "least": x.votes, "words": x.words} for t, x in enumerate(notices)]
    listed = literal(rows, "array<struct<t:int,most:int,least:int,words:array<string>>>")
    groups = word_groups(spark.range(1).select(F.inline(listed)), "t", "most", "least")
    return groups.select("t", "most", "least", F.col("pos").alias("t_pos"), F.xxhash64(*(f"g{i}" for i in range(K))).alias("hash"),
                         *(F.col(f"g{i}").alias(f"t{i}") for i in range(K)))


def proposals(texts: DataFrame, notices: list[Notice]) -> DataFrame:
    """(doc_id, text_key, t, low, high): merged diagonals of ``texts`` (doc_id,
    text_key, text) with votes enough for template t. Equal rows vote together."""
    grams = word_groups(texts.select("doc_id", "text_key", words(F.col("text")).alias("words")), "doc_id", "text_key")
    grams = grams.select("doc_id", "text_key", "pos", *(unversioned(F.col(f"g{i}")).alias(f"g{i}") for i in range(K)))
    grams = grams.withColumn("hash", F.xxhash64(*(f"g{i}" for i in range(K))))
    # templates are a parameter list of the caller, here 21 notices of under 500 groups
    hits = grams.join(F.broadcast(template_table(texts.sparkSession, notices)), "hash")
    hits = hits.where(reduce(Column.__and__, (F.col(f"g{i}") == F.col(f"t{i}") for i in range(K))))
    doc = ["doc_id", "text_key", "t", "most", "least"]
    votes = hits.groupBy(*doc, (F.col("pos") - F.col("t_pos")).alias("diagonal")).agg(F.count(F.lit(1)).alias("votes"))
    order = Window.partitionBy(*doc).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > F.col("most")
    marked = votes.withColumn("first", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("group", F.sum("first").over(order))
    merged = marked.groupBy(*doc, "group").agg(F.sum("votes").alias("votes"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high"))
    return merged.where(F.col("votes") >= F.col("least")).select("doc_id", "text_key", "t", "low", "high")


def edits(around: Column, template: Column, names: list[str]) -> Column:
    """The least cost of word edits between a template and any span of the
    words ``around``; a name that is not listed there costs too much to be
    passed over."""
    weighed = F.transform(around, lambda w: F.struct(unversioned(w).alias("word"), F.when(w.isin(names), template["n"] + 1).otherwise(1).alias("cost")))

    def step(old: Column, w: Column) -> Column:
        def cell(new: Column, t: Column) -> Column:
            other = F.when(t["word"] == w["word"], 0).otherwise(F.greatest(t["cost"], w["cost"]))
            return F.concat(new, F.array(F.least(F.get(old, t["i"] + 1) + w["cost"], F.element_at(new, -1) + t["cost"], F.get(old, t["i"]) + other)))

        return F.aggregate(template["words"], F.array(F.lit(0)), cell,
                           lambda new: F.concat(new, F.array(F.least(F.element_at(old, -1), F.element_at(new, -1)))))

    return F.aggregate(weighed, template["lost"], step, lambda last: F.element_at(last, -1))


def notices_at(places: Column, notices: list[Notice], names: list[str]) -> Column:
    """array<(label, score)>: of the proposed ``places`` those where the column
    ``words`` holds a notice; the score is 1 less the share of edited words."""
    listed = literal([x.row() for x in notices], "array<struct<label:string,n:int,most:int,lost:array<int>,words:array<struct<word:string,cost:int,i:int>>>>")

    def aligned(at: Column) -> Column:
        template = F.get(listed, at["t"])
        start = F.greatest(at["low"] - template["most"], F.lit(0))
        stop = at["high"] + template["n"] + template["most"]
        return F.struct(template["label"].alias("label"), template["n"].alias("n"), template["most"].alias("most"),
                        edits(F.slice("words", start + 1, F.greatest(stop - start, F.lit(0))), template, names).alias("edits"))

    near = F.filter(F.transform(places, aligned), lambda x: x["edits"] <= x["most"])
    return F.transform(near, lambda x: F.struct(x["label"].alias("label"), (1 - x["edits"] / x["n"]).alias("score")))


def template_words(template: str) -> list[str]:
    """What ``words`` gives for a template."""
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", template.replace(KELVIN, LIKE_KELVIN).lower()) if w]


def places(phrase: str) -> Column:
    """Where the words of ``phrase`` stand one after another in ``words``; texts
    without all of them as substrings of the words' text are not searched."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        return reduce(Column.__and__, (F.get("words", i + j) == part for j, part in enumerate(parts)))

    longest = max(parts, key=len)
    some = F.array_contains("words", longest) & (F.size("words") >= len(parts))
    at = F.filter(F.sequence(F.lit(0), F.size("words") - len(parts)), here)
    return F.when(some, at).otherwise(F.array().cast("array<int>"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: list[tuple[str, str]] = PHRASES,
         templates: list[tuple[str, str]] = TEMPLATES, names: list[str] = NAMES) -> DataFrame:
    """One row per row of ``df``: doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score.

    n_base counts all places of the phrases, first_word and last_word are the
    smallest and largest word number where one starts (null without any);
    labels adds those of the notices found. score is 1 with a phrase, else the
    largest share of a template that is not edited, 0 without either. Templates
    of fewer than K words are not found.
    Null and empty texts have no words; rows equal in id and text get equal
    results, null ids too; an empty table gives an empty one. Other columns are
    not read."""
    texts = texts_and_ids(df, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    notices = [Notice(text, label, names) for text, label in templates]
    if notices:
        found = proposals(texts, notices).groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
        found = stored(found.agg(F.collect_list(F.struct("t", "low", "high")).alias("proposed")), "license-places")
        base = texts.join(found, F.expr("text_key = key and doc_id <=> id"), "left").withColumn("words", words(F.col("text")))
        close = F.when(F.col("proposed").isNotNull(), notices_at(F.col("proposed"), notices, names))
    else:
        base, close = texts.withColumn("words", words(F.col("text"))), F.lit(None)
    base = base.select("doc_id", F.size("words").cast("long").alias("n_words"), F.array(*(places(p) for p, _ in phrases)).alias("places"),
                       F.coalesce(close, F.array().cast("array<struct<label:string,score:double>>")).alias("close"))
    label = F.array(*(F.lit(x) for _, x in phrases))
    hit = F.filter(F.arrays_zip(F.col("places"), label.alias("label")), lambda x: F.size(x["places"]) > 0)
    base = base.select("doc_id", "n_words", "close", F.flatten("places").alias("at"), F.array_distinct(F.transform(hit, lambda x: x["label"])).alias("base"))
    every = F.array_union("base", F.col("close.label"))
    return base.select(
        "doc_id", "n_words", F.size("at").cast("long").alias("n_base"), F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"), F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(every), ",").alias("labels"),
        F.when(F.size("at") > 0, 1.0).otherwise(F.coalesce(F.array_max("close.score"), F.lit(0.0))).alias("score"))
