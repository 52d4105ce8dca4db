"""Licence notices by Dice coefficient over word bigrams.

A text is normalised (A-Z lower-cased, words of letters and digits) and compared in its units: every
line, every paragraph if there are blank lines, and the whole text. A unit with a distinct bigrams and a template
with b have a Dice coefficient of 2 |common| / (a + b), which cannot reach t unless a lies between
b t / (2 - t) and b (2 - t) / t; only templates within these bounds are compared.

A notice may also lie inside a longer text: wrapped, split over paragraphs or sharing its line. So templates
that no unit gives are looked for in windows of the words of the whole text. Growing a window by a bigram of the
template never lowers its coefficient, nor does leaving out another one at its ends, so windows from the start of a run
of the template's bigrams to the end of the same or a later run hold the best of every window of up to
b (2 - t) / t bigrams. All of it is built-in functions over one pass of the rows, without a shuffle.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.common import ascii_lower

THRESHOLD = 0.8

#: Wordings of public licences and of the notices that point to them.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software."
    ),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-2-Clause text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "All rights reserved": "All rights reserved.",
}

_OTHER = r"[^\p{L}\p{N}]+"


def template_words(text: str) -> list[str]:
    """The words of a template, as `_words` makes them; templates are ASCII."""
    return re.findall(r"[a-z0-9]+", text.lower())


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(ascii_lower(text), _OTHER, " ")), " ")


def _pairs(words: Column) -> Column:
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1))
    )


def _bigrams(words: Column) -> Column:
    return F.array_distinct(_pairs(words))


def _parts(text: Column) -> Column:
    """The lines of a text, then its paragraphs if there are blank lines."""
    paragraphs = F.when(F.contains(text, F.lit("\n\n")), F.split(text, "\n\n+")).otherwise(F.array().cast("array<string>"))
    return F.concat(F.split(text, "\n"), paragraphs)


def _bounds(size: int, threshold: float) -> tuple[int, int]:
    """Fewest bigrams in common with a template of `size` bigrams, and most bigrams, that reach the threshold."""
    return math.ceil(size * threshold / (2 - threshold) - 1e-9), math.floor(size * (2 - threshold) / threshold + 1e-9)


def _holds(words: list[str], template: list[str], threshold: float) -> bool:
    """True if a window of the words reaches the threshold, by the windows that `_best_window` compares."""
    pairs, wanted = list(zip(words, words[1:])), set(zip(template, template[1:]))
    own = {p for p, pair in enumerate(pairs) if pair in wanted}
    starts, ends = sorted(p for p in own if p - 1 not in own), sorted(p for p in own if p + 1 not in own)
    _, longest = _bounds(len(wanted), threshold)
    windows = (
        set(pairs[first : last + 1])
        for r, first in enumerate(starts) for s, last in enumerate(ends[r:], r)
        if s == r or starts[s] - ends[r] < longest
    )
    return any(2 * len(w & wanted) >= threshold * (len(w) + len(wanted)) for w in windows)


def _runs(found: Column) -> Column:
    """Runs (first, last) of consecutive numbers in an ascending array."""
    starts = F.filter(found, lambda p, i: (i == 0) | (F.get(found, i - 1) < p - 1))
    ends = F.filter(found, lambda p, i: (i == F.size(found) - 1) | (F.get(found, i + 1) > p + 1))
    return F.zip_with(starts, ends, lambda first, last: F.struct(first.alias("first"), last.alias("last")))


def _best_window(stream: Column, candidate: Column) -> Column:
    """Highest coefficient of the windows of the text's bigrams that start and end with runs of the template's."""
    runs, bigrams = candidate["runs"], candidate["bigrams"]

    def dice(start: Column, end: Column) -> Column:
        window = F.slice(stream, start["first"] + 1, end["last"] - start["first"] + 1)
        return 2 * F.size(F.array_intersect(window, bigrams)) / (F.size(F.array_distinct(window)) + F.size(bigrams))

    def from_run(start: Column, r: Column) -> Column:
        # Runs are at least two places apart, so no more than half of `longest` can follow in reach.
        ahead = F.slice(runs, r + 1, F.floor(candidate["longest"] / 2).cast("int") + 2)
        near = F.filter(ahead, lambda end: (end["first"] == start["first"]) | (end["first"] - start["last"] < candidate["longest"]))
        wide = F.filter(near, lambda end: end["last"] - start["first"] + 1 >= candidate["fewest"])
        return F.array_max(F.transform(wide, lambda end: dice(start, end)))

    return F.array_max(F.transform(runs, from_run))


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """id, matches (array of dice, licence, ordered best first) of every row.

    There is a match for each unit and template, and one, that of the best window, for each template that lies inside
    the text without being near any unit; not if it is a part of a template that some unit is near to.
    A null or empty text has no matches. Of equal coefficients the first licence by name comes first.
    Repeated or null ids do not matter, nor do other columns, whatever their names. Templates without two words
    match nothing.
    """
    wanted = {name: template_words(text) for name, text in (templates or TEMPLATES).items()}
    sought = [(name, words) for name, words in sorted(wanted.items()) if len(words) > 1]
    # Hashed once, as fixed values: arrays made by lambdas are not folded, but made anew for every unit.
    hashed = docs.sparkSession.range(1).select(*[_bigrams(F.lit(words)).alias(name) for name, words in sought]).first()
    bigrams = {name: F.lit(found) for (name, _), found in zip(sought, hashed, strict=True)}
    known = F.array(*[F.struct(F.lit(name).alias("licence"), bigrams[name].alias("bigrams")) for name, _ in sought])
    fewest = min(((len(w) - 1) for w in wanted.values() if len(w) > 1), default=1) * threshold / (2 - threshold)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), _parts(text).alias("parts"), F.size(F.split(text, "\n")).alias("n_lines"))
    lists = rows.select("id", F.transform("parts", _words).alias("words"), "n_lines")
    # A unit has fewer distinct bigrams than words: what is too short even so is left out first.
    long_enough = F.filter("words", lambda w: F.size(w) - 1 >= min(fewest, 1.0))
    # The lines come first among the parts; together they hold the words of the text, which is a unit of its own
    # if it has several lines.
    all_words = F.filter(F.flatten(F.slice("words", 1, F.col("n_lines"))), lambda w: w != "")
    lists = lists.select("id", F.transform(long_enough, _bigrams).alias("sets"), all_words.alias("words"), "n_lines")
    streams = lists.select("id", "sets", _pairs(F.col("words")).alias("stream"), "n_lines")
    whole = F.when((F.col("n_lines") > 1) & (F.size("stream") >= min(fewest, 1.0)), F.array(F.array_distinct("stream")))
    none_whole = F.array().cast("array<array<bigint>>")
    sets = streams.select("id", F.concat("sets", F.coalesce(whole, none_whole)).alias("sets"), "stream")

    def compared(unit: Column, template: Column) -> Column:
        a, b = F.size(unit), F.size(template["bigrams"])
        most, least, slack = 2 - threshold, threshold, 1e-9  # the bounds themselves are inside
        near = (a * most + slack >= b * least) & (b * most + slack >= a * least)
        common = F.when(near, F.size(F.array_intersect(unit, template["bigrams"]))).otherwise(0)
        return F.struct((2 * common / (a + b)).alias("dice"), template["licence"].alias("licence"))

    found = F.flatten(F.transform("sets", lambda unit: F.filter(
        F.transform(known, lambda t: compared(unit, t)), lambda m: m["dice"] >= threshold
    )))
    units = sets.select("id", found.alias("found"), "stream")

    everything = sorted(set().union(*hashed))
    hits = F.filter(F.transform("stream", lambda h, i: F.when(h.isin(everything), i)), lambda i: i.isNotNull())
    hit = units.select("id", "found", "stream", hits.alias("hits"))

    # Fewer hits than any template needs are nothing: most texts end here.
    patterns = []
    for name, words in sought:
        fewest_common, longest = _bounds(len(set(zip(words, words[1:]))), threshold)
        holders = [other for other, text in sought if other != name and _holds(text, words, threshold)]
        patterns.append(F.struct(
            F.lit(name).alias("licence"), bigrams[name].alias("bigrams"), F.lit(fewest_common).alias("fewest"),
            F.lit(longest).alias("longest"), F.array(*map(F.lit, [name, *holders])).alias("covered_by"),
        ))

    def open_patterns(found: Column) -> Column:
        return F.filter(F.array(*patterns), lambda t: ~F.exists(found, lambda m: F.array_contains(t["covered_by"], m["licence"])))

    def located(t: Column) -> Column:
        own = F.filter("hits", lambda i: F.array_contains(t["bigrams"], F.get("stream", i)))
        return F.struct(t["licence"], t["bigrams"], t["fewest"], t["longest"], own.alias("own"))

    least = min((_bounds(len(set(zip(w, w[1:]))), threshold)[0] for _, w in sought), default=1)
    candidates = F.filter(F.transform(open_patterns(F.col("found")), located), lambda c: F.size(c["own"]) >= c["fewest"])
    placed = hit.select("id", "found", "stream", F.when(F.size("hits") >= least, candidates).alias("candidates"))
    with_runs = F.transform("candidates", lambda c: F.struct(
        c["licence"], c["bigrams"], c["fewest"], c["longest"], _runs(c["own"]).alias("runs")
    ))
    placed = placed.select("id", "found", "stream", with_runs.alias("candidates"))
    embedded = F.filter(
        F.transform("candidates", lambda c: F.struct(_best_window(F.col("stream"), c).alias("dice"), c["licence"].alias("licence"))),
        lambda m: m["dice"] >= threshold,
    )
    none = F.array().cast("array<struct<dice:double,licence:string>>")
    matched = placed.select("id", F.concat("found", F.coalesce(embedded, none)).alias("found"))
    best_first = F.array_sort("found", lambda x, y: F.when(x["dice"] > y["dice"], -1).when(x["dice"] < y["dice"], 1)
                              .when(x["licence"] < y["licence"], -1).when(x["licence"] > y["licence"], 1).otherwise(0))
    return matched.select("id", best_first.alias("matches"))
