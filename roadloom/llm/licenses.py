"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a window of words of a paragraph (paragraphs end at blank lines, line
breaks inside count for nothing, so wrapped notices stay whole): windows of
twice ``STEP`` words begin every ``STEP`` words, or at the longest template's
length if that is more, so a passage of a template's length lies whole in one.
A block's set are its distinct pairs of neighbouring words. A template is
contained in a block when the block holds at least ``PERCENT`` percent of the
template's pairs. Templates are a table of (label, text).

The texts are read once. A text that holds none of the words that every
containing block must hold (of each template as many pairs as can't all be
missing, those with the longest words) is done with; of the others each block
keeps the template pairs that it holds, which are written. The join is the
prefix-filter kind, over those:

* pairs have one global order, rarest first, by the number of blocks;
* of a template with n pairs and a needed overlap of t, only the first n - t + 1
  are posted: a block without any of them can't reach t;
* blocks with fewer than t pairs are out by length;
* a shared pair's places in both orders bound how many more can be shared,
  which prunes by position;
* what is left is verified on the whole sets.

Copies of a text are joined once. All of it is linear in the texts but for the
join, which is equal keys of a template table with blocks that hold its pairs.

``scan`` also counts the base phrases: places where their words stand
consecutively anywhere in a text.

Defined cases: a null text is empty, has no words, no labels and score 0;
repeated rows are scored alike and all returned; an empty table gives an empty
result; further columns are ignored; templates of under two words match nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom.llm.base import cut

STEP = 64
PERCENT = 80

# Base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Templates of license notices, as lower-case words.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "free software foundation gnu general public license either version 3 of the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
]
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLANK_LINES = r"\n[ \t\r]*\n"
MATCHES = "array<struct<score:double,label:string,block:int>>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _pairs(template: str) -> list[str]:
    """A template's tokens: its distinct pairs of neighbouring words."""
    words = template.split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


Templates = list[tuple[str, str]]


def step_of(templates: Templates, step: int = STEP) -> int:
    return max([step, *[len(t.split()) for _, t in templates]])


def needed(n: int, percent: int = PERCENT) -> int:
    """The overlap that a template of n pairs needs."""
    return math.ceil(n * percent / 100)


def gate(templates: Templates, percent: int = PERCENT) -> list[str]:
    """Words of which a text with a contained template holds one."""
    out = set()
    for _, text in templates:
        pairs = sorted(_pairs(text), key=lambda p: (-max(map(len, p.split())), p))
        out |= {max(p.split(), key=len) for p in pairs[: len(pairs) - needed(len(pairs), percent) + 1]}
    return sorted(out)


def blocks(text: Column, step: int) -> Column:
    """A text's windows, each an array of words, lower-cased (A-Z only)."""
    words = lambda p: F.split(F.trim(F.translate(F.regexp_replace(p, SEPARATORS, " "), _UPPER, _LOWER)), " ")
    last = lambda ws: F.greatest(F.ceil(F.size(ws) / step) - 2, F.lit(0)).cast("int")
    windows = lambda ws: F.transform(F.sequence(F.lit(0), last(ws)), lambda k: F.slice(ws, k * step + 1, F.lit(2 * step)))
    return F.flatten(F.transform(F.transform(F.split(text, BLANK_LINES), words), windows))


def held(text: Column, vocabulary: list[str], step: int) -> Column:
    """array<struct<block,pairs,tokens>>: the blocks that hold any of ``vocabulary``, how many pairs they have, and what they hold."""
    pairs = lambda ws: F.transform(ws, lambda w, i: F.concat_ws(" ", w, F.get(ws, i + 1)))
    known = F.array(*[F.lit(p) for p in vocabulary])
    found = F.transform(blocks(text, step), lambda ws, i: F.struct(i.alias("block"), (F.size(ws) - 1).alias("pairs"), F.array_intersect(pairs(ws), known).alias("tokens")))
    return F.filter(found, lambda x: F.size(x["tokens"]) > 0)


def contained(found: DataFrame, templates: Templates, percent: int = PERCENT) -> DataFrame:
    """(key, matches) of (key, held), by the prefix-filter join; one row for each key with a match."""
    spark = found.sparkSession
    rows = [(i, label, sorted(_pairs(t)), needed(len(_pairs(t)), percent)) for i, (label, t) in enumerate(templates) if len(t.split()) > 1]
    table = spark.createDataFrame(rows, "template int, label string, all array<string>, need int")
    tokens = found.select("key", F.explode("held").alias("x")).select("key", "x.block", "x.pairs", F.explode("x.tokens").alias("token"))
    often = cut(tokens.groupBy("token").agg(F.count("*").alias("often")), "often")
    order = Window.partitionBy("template").orderBy("often", "token")
    ranked = table.select("template", "need", F.size("all").alias("n"), F.explode("all").alias("token")).join(often, "token")
    # A token of no block meets nothing; it would come before all others.
    unseen = F.col("n") - F.count("*").over(Window.partitionBy("template"))
    prefix = ranked.withColumn("place", F.row_number().over(order) - 1 + unseen).filter("place <= n - need")
    sets = tokens.join(often, "token").groupBy("key", "block", "pairs").agg(F.array_sort(F.collect_list(F.struct("often", "token"))).alias("t"))
    posts = sets.select("key", "block", "pairs", F.transform("t", lambda x: x["token"]).alias("tokens"), F.posexplode("t").alias("at", "x")).withColumn("token", F.col("x.token"))
    fits = (F.col("pairs") >= F.col("need")) & (F.col("n") - F.col("place") >= F.col("need")) & (F.size("tokens") - F.col("at") >= F.col("need"))
    met = posts.join(prefix.select("template", "need", "n", "place", "token"), "token").filter(fits).select("key", "block", "template", "tokens").distinct()
    verified = met.join(table, "template").withColumn("both", F.size(F.array_intersect("tokens", "all"))).filter("both >= need")
    match = F.struct((F.col("both") / F.size("all")).alias("score"), "label", F.col("block").cast("int").alias("block"))
    return verified.groupBy("key").agg(F.array_sort(F.collect_list(match)).alias("matches"))


def scan(docs: DataFrame, percent: int = PERCENT, templates: Templates | None = None, step: int = STEP) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and matches (array<struct<score,label,block>>)."""
    templates = TEMPLATES if templates is None else templates
    vocabulary = sorted({p for _, t in templates for p in _pairs(t)})
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    possible = F.col("text").rlike("(?i)" + "|".join(gate(templates, percent))) if vocabulary else F.lit(False)
    rows = docs.select("doc_id", text.alias("text")).withColumn("held", F.when(possible, held(F.col("text"), vocabulary, step_of(templates, step))))
    flat = F.trim(F.regexp_replace("text", SEPARATORS, " ")).alias("flat")
    rows = rows.select("doc_id", flat, F.when(F.size("held") > 0, F.col("held")).alias("held"), F.when(F.size("held") > 0, F.md5(F.col("text").cast("binary"))).alias("key"))
    n_words = F.when(F.col("flat") == "", F.lit(0)).otherwise(F.length("flat") - F.length(F.replace(F.col("flat"), F.lit(" "))) + 1)
    maybe = F.col("flat").rlike("(?i)" + "|".join(PHRASES))
    framed = F.concat(F.lit(" "), F.replace(F.translate("flat", _UPPER, _LOWER), F.lit(" "), F.lit("  ")), F.lit(" "))
    rows = rows.select("doc_id", "key", "held", n_words.cast("long").alias("n_words"), F.when(maybe, framed).alias("framed"))
    places, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        mark = " " + phrase.replace(" ", "  ") + " "
        parts = F.split("framed", mark)
        n = F.coalesce(F.size(parts) - 1, F.lit(0))
        spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" ")))
        words_of = phrase.count(" ") + 1
        # In the framed text every word has one space on each side, so the spaces before a place are twice its words.
        first = F.when(n > 0, spaces(F.get(parts, F.lit(0))) / 2)
        total = spaces(F.col("framed")) / 2
        last = F.when(n > 0, total - spaces(F.get(parts, n)) / 2 - words_of)
        places.append(n)
        firsts.append(first)
        lasts.append(last)
        labels.append(F.when(n > 0, F.lit(label)))
    counted = rows.select(
        "doc_id", "key", "held", "n_words", sum(places[1:], places[0]).cast("long").alias("n_base"), F.least(*firsts).cast("long").alias("first_word"), F.greatest(*lasts).cast("long").alias("last_word"), F.array_compact(F.array(*labels)).alias("base"),
    )
    counted = cut(counted, "licenses")
    found = contained(counted.filter("key is not null").select("key", "held").dropDuplicates(["key"]), templates, percent)
    none = F.array().cast(MATCHES)
    # Texts that hold no pair of a template stay where they are.
    joined = counted.filter("key is not null").join(found, "key", "left").select(*counted.columns, F.coalesce("matches", none).alias("matches"))
    every = counted.filter("key is null").withColumn("matches", none).unionByName(joined)
    listed = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    best = F.coalesce(F.array_max(F.transform("matches", lambda x: x["score"])), F.lit(0.0))
    return every.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", listed(F.col("base")).alias("base_labels"),
        listed(F.concat("base", F.transform("matches", lambda x: x["label"]))).alias("labels"), F.when(F.size("base") > 0, F.lit(1.0)).otherwise(best).alias("score"), "matches",
    )
