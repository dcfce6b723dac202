"""License scans: known phrases, and blocks of text that hold most words of a license notice. DataFrame functions only.

Method: exact set-similarity join. Tokens are ordered by the number of documents that hold them, rare ones first. A block
that holds enough of a template shares one of the template's first m - need + 1 tokens (prefix filter), has at
least ``need`` template tokens itself (length filter), and at the first shared token enough tokens are left on both sides
(positional filter). Candidates are verified by their intersection. Blocks are overlapping windows of words, so
a notice is found wherever it stands; only documents that hold a prefix token are cut into blocks at all.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygalley.llm.exchange import materialize

# Separators of words, before upper-case letters are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK, STEP = 64, 32
CONTAINMENT = 0.8
# Templates of so few words are names: all their words are needed, with so many others between them at most.
NAME_WORDS, NAME_GAP = 4, 2

PHRASES = {
    "cc-by": ("cc", "by"),
    "gpl": ("general", "public", "license"),
    "reserved": ("all", "rights", "reserved"),
}
# Names of licenses, short enough that all their words are needed, and the clauses of widely used license texts and notices.
# None is longer than STEP words, so one window serves all.
TEMPLATES = {
    "apache-2.0": "apache license 2 0",
    "apache-notice": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind"
    ),
    # Of the MIT and of the BSD text.
    "as-is-warranty": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement"
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met"
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution"
    ),
    "bsd-liability": (
        "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special "
        "exemplary or consequential damages including but not limited to procurement of substitute goods"
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer"
    ),
    "cc-by-nc": "cc by nc",
    # Of the GPL and its kin.
    "gnu-notice": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation"
    ),
    "gnu-warranty": (
        "this program is distributed in the hope that it will be useful but without any warranty without even the "
        "implied warranty of merchantability or fitness for a particular purpose"
    ),
    "gnu-gpl": "gnu general public license",
    "mit": "under mit license",
    "mit-liability": (
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether "
        "in an action of contract tort or otherwise arising from"
    ),
    "mit-notice": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the software"
    ),
    "mit-rights": (
        "to deal in the software without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software"
    ),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files"
    ),
    "mpl": "mozilla public license",
    "mpl-notice": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file"
    ),
}


def window(template: str) -> tuple[int, int]:
    """Words of a block and of the step to the next, such that some block holds the template wherever it stands."""
    n = len(template.split())
    if n <= NAME_WORDS:
        return n + NAME_GAP, 1
    return (BLOCK, STEP) if n <= min(STEP, BLOCK - STEP) else (2 * n, n)


def _checked(template: str) -> set[str]:
    words = template.split()
    if not words or any(re.search(SEPARATORS + "|[A-Z]", w) for w in words):
        raise ValueError(f"a template is words in lower case with spaces between, not {template!r}")
    return set(words)


def _among(words: str, some: set[str]) -> str:
    listed = ", ".join(f"'{w}'" for w in sorted(some))
    return f"{words} in ({listed})"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def token_frequencies(docs: DataFrame, tokens: set[str], text: str = "text") -> dict[str, int]:
    """In how many documents each of a few tokens occurs; over all documents."""
    held = docs.select(_words(F.lower(F.col(text))).alias("words")).select(
        F.explode(F.expr(f"array_distinct(filter(words, w -> {_among('w', tokens)}))")).alias("token")
    )
    found = {r["token"]: r["n"] for r in held.groupBy("token").agg(F.count("*").alias("n")).collect()}
    return {t: found.get(t, 0) for t in tokens}


def _starts(phrase: tuple[str, ...]) -> str:
    """Places in ``words`` where the phrase stands."""
    same = " and ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(phrase))
    last = f"size(words) - {len(phrase)}"
    return f"if({last} >= 0, filter(sequence(0, greatest({last}, 0)), i -> {same}), array())"


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases: dict[str, tuple[str, ...]] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of letters A-Z (lowered), digits and non-ASCII characters. A phrase counts at every place where its words
    stand side by side. A template's label is added if some block of its ``window`` (BLOCK words, taken every STEP words, or
    more for a template above STEP words) holds at least ``containment`` of its distinct words. A name (up to four words)
    must stand together: blocks have two words more than it and begin at every word. Labels are sorted and joined by commas, empty if none. score is 1 with a
    phrase, else the largest containment among added templates, else 0. Null and empty texts have no words. Repeated rows
    are judged each. Other columns are ignored.
    """
    sets = {label: _checked(words) for label, words in templates.items()}
    windows = sorted({window(words) for words in templates.values()})
    own_window = {label: windows.index(window(words)) for label, words in templates.items()}
    need = {label: math.ceil(containment * len(s) - 1e-9) for label, s in sets.items()}
    vocabulary = set().union(*sets.values())
    frequency = token_frequencies(docs, vocabulary.union(*phrases.values()), text)
    order = sorted(vocabulary, key=lambda t: (frequency[t], t))
    rank = {token: i for i, token in enumerate(order)}
    ordered = {label: sorted(rank[t] for t in s) for label, s in sets.items()}
    prefix = {label: r[: len(r) - need[label] + 1] for label, r in ordered.items()}
    rare = {order[r] for p in prefix.values() for r in p}
    telling = rare | {min(phrase, key=lambda t: frequency[t]) for phrase in phrases.values()}

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = plain.select("doc_id", "text", _words(F.col("text")).alias("raw")).select(
        "doc_id",
        F.when(F.col("raw").isNull(), 0).otherwise(F.size("raw")).alias("n_words"),
        F.when(
            F.expr(f"exists(raw, w -> {_among('lower(w)', telling)})"),
            F.expr(f"transform(raw, w -> translate(w, '{UPPER}', '{LOWER}'))"),
        ).alias("words"),
    )
    ranks = ", ".join(f"'{t}', {r}" for t, r in rank.items())
    least = min(need.values())
    some_rare = " or ".join(f"array_contains(b.tokens, {rank[t]})" for t in sorted(rare))

    def blocks_of(number: int) -> str:
        size, step = windows[number]
        inside = f"filter(slice(words, s + 1, {size}), w -> {_among('w', vocabulary)})"
        tokens = f"array_sort(array_distinct(transform({inside}, w -> map({ranks})[w])))"
        starts = f"sequence(0, greatest(size(words) - 1, 0), {step})"
        if step == 1:
            # a block that holds a name can begin at the first of its words
            names = set().union(*(s for label, s in sets.items() if own_window[label] == number))
            starts = f"filter({starts}, i -> {_among('get(words, i)', names)})"
        return f"transform({starts}, s -> struct({number} as window, {tokens} as tokens))"

    cut = ", ".join(blocks_of(i) for i in range(len(windows)))
    blocks = f"filter(concat({cut}), b -> size(b.tokens) >= {least} and ({some_rare}))"
    places = [F.expr(_starts(p)).alias(f"at_{i}") for i, p in enumerate(phrases.values())]
    found = counted.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "n_words",
        *[F.when(F.col("words").isNotNull(), p).alias(f"at_{i}") for i, p in enumerate(places)],
        F.when(F.col("words").isNotNull(), F.expr(blocks)).alias("blocks"),
    )
    found = materialize(found, "license_blocks")

    spark = docs.sparkSession
    rows = [
        (label, own_window[label], ordered[label], len(ordered[label]), need[label], token, place)
        for label in sets
        for place, token in enumerate(prefix[label])
    ]
    probes = spark.createDataFrame(
        rows, "label string, window int, template array<int>, m int, need int, token int, template_place int"
    )
    block_tokens = (
        found.where("size(blocks) > 0")
        .select("row", F.explode("blocks").alias("b"))
        .select("row", "b.window", "b.tokens")
        .select("row", "window", "tokens", F.posexplode("tokens").alias("place", "token"))
        .where(f"place <= size(tokens) - {least}")
    )
    met = block_tokens.join(probes, ["token", "window"]).where(
        "size(tokens) >= need and 1 + least(size(tokens) - place - 1, m - template_place - 1) >= need"
    )
    overlap = F.size(F.array_intersect("tokens", "template"))
    hits = met.withColumn("overlap", overlap).where("overlap >= need")
    per_row = hits.groupBy("row").agg(
        F.collect_set("label").alias("added"), F.max(F.col("overlap") / F.col("m")).alias("best")
    )

    empty = F.array().cast("array<string>")
    starts = [F.coalesce(F.col(f"at_{i}"), F.array().cast("array<int>")) for i in range(len(phrases))]
    all_starts = F.concat(*starts)
    base = F.array_compact(
        F.array(*[F.when(F.size(s) > 0, F.lit(label)) for s, label in zip(starts, phrases)])
    )
    joined = found.join(per_row, "row", "left")
    labels = F.array_sort(F.array_union(base, F.coalesce("added", empty)))
    return joined.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size(all_starts).cast("long").alias("n_base"),
        F.array_min(all_starts).cast("long").alias("first_word"),
        F.array_max(all_starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.size(all_starts) > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
