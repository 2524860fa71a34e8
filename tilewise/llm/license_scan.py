"""Licence scan: an exact set-similarity join of text blocks with licence templates, in built-in functions only.

Blocks are the lines of a text. The tokens of all templates are ordered by how many documents of the whole corpus hold
them, rarest first. A block can hold the threshold's share of a template only if it has one of the template's prefix
tokens (the rarest, as many as may be missing and one more), enough template tokens at all (length filter) and enough of
them left after the first common one (positional filter). What passes is verified by the full intersection, so every
block at or over the containment threshold is found, and none below it.

Templates are part of the plan, ``TEMPLATES_AT_ONCE`` in one pass of the join over each row and as many passes as it takes,
so the join probes an index within each row: no block, token or document is shuffled. Only the document counts of template
tokens reach the driver.

Notices also run over several lines. A window is as many consecutive words of the text, across lines, as the template has
over the threshold, so that the threshold's share of a full window can be the template's. Each place of a prefix token is
tried with the windows around it; no window at or over the threshold is without such a token.

Next to the templates, fixed phrases are found wherever their words stand consecutively, also across lines.

Defined results: a null or empty text has no words, places or labels and score 0; repeated rows, and rows with equal or null
keys, are scanned alike and each by itself; of templates that tie in a line all labels stay; whole texts of any length are
read; other columns are carried as they are, and a column named like the result raises; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, text_or_empty

THRESHOLD = 0.8
TEMPLATES_AT_ONCE = 200

#: Fixed values of the contract: phrases and their labels.
BASE_PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

#: Licence notices by label.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "Licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work, CC0 1.0"),
    ("all-rights-reserved", "All rights reserved"),
)

_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> list[str]:
    """The words of a template, in order."""
    return re.findall(WORD, text.translate({ord(a): b for a, b in zip(_UPPER, _LOWERED, strict=True)}))


def tokens(text: str) -> list[str]:
    """The distinct words of a template, in order."""
    return list(dict.fromkeys(words(text)))


def spaced(text: Column) -> Column:
    """The words, in the case they have, each with one space before it and one after the last."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, _GAP, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def token_frequencies(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """Documents of the whole table that hold each of these tokens."""
    own = F.split(F.translate(spaced(text_or_empty(text)), _UPPER, _LOWERED), " ")
    found = docs.select(F.explode(F.array_intersect(own, F.array(*map(F.lit, vocabulary)))).alias("t")).groupBy("t").count()
    counts = {r["t"]: r["count"] for r in found.collect()}  # at most one row a template token
    return {t: counts.get(t, 0) for t in vocabulary}


Ranked = tuple[str, list[int], int, int]  # label, ranks of the distinct tokens, tokens needed, words of a window


def scan(docs: DataFrame, text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD, result: str = "licences") -> DataFrame:
    """``docs`` with a struct column ``result``: n_words, n_base, first_word, last_word, base (labels), blocks, windows.

    ``blocks`` lists (block, label, containment, common): the line's number and every template that it contains.
    ``windows`` lists (label, containment, common, start, end): around each place of a template's prefix token, the
    window with the most of its words, the tightest of them, from its first to its last needed word.
    """
    if result.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the table has a column {result} already: name another for the result")
    sets = [(label, tokens(t), words(t)) for label, t in templates]
    vocabulary = sorted({t for _, ts, _ in sets for t in ts})
    count = token_frequencies(docs, vocabulary, text) if vocabulary else {}
    order = sorted(vocabulary, key=lambda t: (count[t], t))
    rank = {t: i for i, t in enumerate(order)}
    ranked = [(label, sorted(rank[t] for t in ts), math.ceil(threshold * len(ts) - 1e-9), math.ceil(len(ws) / threshold - 1e-9)) for label, ts, ws in sets if ts]
    parts = [_found(text, order, ranked[lo : lo + TEMPLATES_AT_ONCE]) for lo in range(0, len(ranked), TEMPLATES_AT_ONCE)]
    blocks = [b for b, _ in parts] or [F.array().cast(_BLOCKS)]
    windows = [w for _, w in parts] or [F.array().cast(_WINDOWS)]
    return docs.withColumn(result, F.struct(*_base(text), F.concat(*blocks).alias("blocks"), F.concat(*windows).alias("windows")))


_BLOCKS = "array<struct<block:int,label:string,containment:double,common:int>>"
_WINDOWS = "array<struct<label:string,containment:double,common:int,start:int,end:int>>"


def _base(text: str) -> list[Column]:
    """n_words, and the places of the fixed phrases."""
    value = text_or_empty(text)
    norm = spaced(value)
    blank = F.trim(norm) == ""
    n_words = F.when(blank, F.lit(0)).otherwise(_spaces(norm) - 1).cast("long")
    parts, counts, firsts, lasts, labels = [], [], [], [], []
    for phrase, label in BASE_PHRASES:
        cut = F.split(norm, f"(?i) {phrase}(?= )")
        n = F.size(cut) - 1
        parts.append(n)
        counts.append(n.cast("long"))
        firsts.append(F.when(n > 0, _spaces(F.element_at(cut, 1))))
        lasts.append(F.when(n > 0, n_words - len(phrase.split()) - (_spaces(F.element_at(cut, -1)) - 1)))
        labels.append(F.when(n > 0, F.lit(label)))

    return [n_words.alias("n_words"), sum(counts[1:], counts[0]).alias("n_base"), F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"), F.array_compact(F.array(*labels)).alias("base")]


def _found(text: str, order: list[str], ranked: list[Ranked]) -> tuple[Column, Column]:
    """The arrays ``blocks`` and ``windows`` for some of the templates. ``order``: all tokens, the rarest first."""
    need = [n for _, _, n, _ in ranked]
    prefix: dict[int, list[tuple[int, int]]] = {}
    for k, (_, rs, n, _) in enumerate(ranked):
        for i, r in enumerate(rs[: len(rs) - n + 1]):
            prefix.setdefault(r, []).append((k, i))
    own_ranks = sorted({r for _, rs, _, _ in ranked for r in rs})

    value = text_or_empty(text)
    norm = spaced(value)
    near = "|".join(re.escape(order[r]) for r in sorted(prefix))
    hit = F.filter(F.transform(F.split(value, "\n"), lambda b, i: F.struct(i.alias("i"), b.alias("b"))), lambda s: F.rlike(s["b"], F.lit(rf"(?i)(?:^|{_GAP[:-1]})(?:{near})(?:{_GAP[:-1]}|$)")))
    rank_of = F.create_map(*[x for r in own_ranks for x in (F.lit(order[r]), F.lit(r))])
    index = F.create_map(*[x for r, at in sorted(prefix.items()) for x in (F.lit(r), F.array(*[F.struct(F.lit(k).alias("k"), F.lit(i).alias("i")) for k, i in at]))])
    table = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(len(rs)).alias("m"), F.lit(need[k]).alias("need"), F.array(*map(F.lit, rs)).alias("ranks"), F.lit(span).alias("span"), F.array(*[F.lit(order[r]) for r in rs]).alias("words")) for k, (label, rs, _, span) in enumerate(ranked)])

    def matches(s: Column) -> Column:
        own = F.split(F.translate(spaced(s["b"]), _UPPER, _LOWERED), " ")
        block = F.array_sort(F.transform(F.array_intersect(own, F.array(*[F.lit(order[r]) for r in own_ranks])), lambda t: F.element_at(rank_of, t)))
        met = F.array_intersect(block, F.array(*map(F.lit, sorted(prefix))))

        def reach(r: Column) -> Column:
            after = F.size(block) - F.array_position(block, r).cast("int")
            near_ = F.transform(F.element_at(index, r), lambda c: F.struct(c["k"].alias("k"), (F.lit(1) + F.least(F.element_at(table, c["k"] + 1)["m"] - c["i"] - 1, after)).alias("most")))
            return F.filter(near_, lambda c: (c["most"] >= F.element_at(table, c["k"] + 1)["need"]) & (F.size(block) >= F.element_at(table, c["k"] + 1)["need"]))

        some = F.array_distinct(F.transform(F.flatten(F.transform(met, reach)), lambda c: c["k"]))
        full = F.transform(some, lambda k: F.struct(F.element_at(table, k + 1).alias("t"), F.size(F.array_intersect(block, F.element_at(table, k + 1)["ranks"])).alias("common")))
        good = F.filter(full, lambda c: c["common"] >= c["t"]["need"])
        return F.transform(good, lambda c: F.struct(s["i"].alias("block"), c["t"]["label"].alias("label"), (c["common"] / c["t"]["m"]).alias("containment"), c["common"].alias("common")))

    def around(all_: Column, p: Column, t: Column) -> Column:
        """The best window of a template in the words that share a window with place p: none or one."""
        low = F.greatest(p - t["span"] + 1, F.lit(0))

        def window(near_: Column, j: Column) -> Column:
            some = F.slice(near_, j + 1, t["span"])
            common = F.array_intersect(some, t["words"])
            width = F.array_max(F.transform(common, lambda x: F.array_position(some, x))).cast("int")
            return F.struct(F.size(common).alias("common"), (-width).alias("tight"), (low + j).alias("start"))

        def best(near_: Column) -> Column:
            at = F.filter(F.sequence(F.lit(0), F.size(near_) - 1), lambda j: F.array_contains(t["words"], F.element_at(near_, j + 1)))
            good = F.filter(F.transform(at, lambda j: window(near_, j)), lambda c: c["common"] >= t["need"])
            enough = F.size(F.array_intersect(near_, t["words"])) >= t["need"]
            return F.when(enough, F.array_max(good))

        top = F.filter(F.transform(F.array(F.slice(all_, low + 1, p + t["span"] - low)), best), lambda c: c.isNotNull())
        return F.transform(top, lambda c: F.struct(t["label"].alias("label"), (c["common"] / t["m"]).alias("containment"), c["common"].alias("common"), c["start"].alias("start"), (c["start"] - c["tight"] - 1).alias("end")))

    def windows(all_: Column) -> Column:
        places = F.array_compact(F.transform(all_, lambda w, i: F.when(w.isin([order[r] for r in sorted(prefix)]), i)))
        of = lambda p: F.element_at(index, F.element_at(rank_of, F.element_at(all_, p + 1)))
        return F.flatten(F.transform(places, lambda p: F.flatten(F.transform(of(p), lambda c: around(all_, p, F.element_at(table, c["k"] + 1))))))

    all_words = F.when(F.size(hit) > 0, F.split(F.trim(F.translate(norm, _UPPER, _LOWERED)), " ")).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(hit, matches)), F.flatten(F.transform(F.array(all_words), windows))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def _around(items: Column, i: Column, n: Column | int) -> Column:
    """The items up to n places before and after place i."""
    first = F.greatest(i - n, F.lit(0))
    return F.slice(items, first + 1, i - first + n + 1)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Notices of related licences share most words; of the templates that one line contains, those with the most words
    in common give the labels. Windows add what lines do not hold, or hold beside a longer notice.
    """
    found = scan(docs.select(key, text), text).select(key, "licences.*")
    # A line's matches stand together, so that each looks at as many neighbours as there are templates, not at all of the text.
    of_line = lambda b, i: F.filter(_around(F.col("blocks"), i, len(TEMPLATES)), lambda x: x["block"] == b["block"])
    found = found.withColumn("blocks", F.filter("blocks", lambda b, i: b["common"] == F.array_max(F.transform(of_line(b, i), lambda x: x["common"]))))
    # Of windows that overlap, those with the most words count; a line's label goes if all its windows give way. A window
    # overlaps none that begins more than the longest window away, and a template has one window at most from a place.
    over = lambda a, b: (b["common"] > a["common"]) & (a["start"] <= b["end"]) & (b["start"] <= a["end"])
    reach = len(TEMPLATES) * max(math.ceil(len(words(t)) / THRESHOLD - 1e-9) for _, t in TEMPLATES)
    placed = F.transform("windows", lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), w["label"].alias("label"), w["containment"].alias("containment"), w["common"].alias("common")))
    # Equal windows are neighbours once sorted; array_distinct would compare all structs with all.
    found = found.withColumn("windows", F.array_sort(placed))
    found = found.withColumn("windows", F.filter("windows", lambda w, i: (i == 0) | (w != F.element_at("windows", F.greatest(i, F.lit(1))))))
    found = found.withColumn("kept", F.filter("windows", lambda a, i: ~F.exists(_around(F.col("windows"), i, reach), lambda b: over(a, b))))
    gone = F.array_except(F.transform("windows", lambda w: w["label"]), F.transform("kept", lambda w: w["label"]))
    found = found.withColumn("gone", gone)
    found = found.withColumn("blocks", F.filter("blocks", lambda b: ~F.array_contains("gone", b["label"])))
    pair = lambda x: F.struct(x["label"].alias("label"), x["containment"].alias("containment"))
    found = found.withColumn("blocks", F.concat(F.transform("blocks", pair), F.transform("kept", pair)))
    best = F.coalesce(F.array_max(F.transform("blocks", lambda b: b["containment"])), F.lit(0.0))
    return found.select(
        key,
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        _joined(F.col("base")).alias("base_labels"),
        _joined(F.concat("base", F.transform("blocks", lambda b: b["label"]))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
