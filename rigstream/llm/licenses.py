"""License scans: an exact set-similarity join of text blocks with license templates.

The tokens are pairs of neighbouring words. A text is cut into blocks of 2 * BLOCK pairs that begin
every BLOCK pairs, so whatever is at most BLOCK pairs long lies whole in some block. A template is found
in a block that holds a stated share of the template's distinct pairs (containment).

The join orders tokens by the number of blocks of the whole corpus that hold them, rarest first. Of
a template that needs o of its n tokens, a block has to hold one of the n - o + 1 rarest (prefix
filter), so only these meet blocks; the block must hold o tokens that stand in templates at all
(length filter), and behind the first token they share, both must have o - 1 further ones
(positional filter). What is left is counted exactly. Phrases are templates that a block must hold whole;
in the blocks that the join leaves, the places are sought where their words stand consecutively.

One pass in Python reads the texts, some megabytes of words at a time, and keeps of every block the pairs that
stand in templates; all else is joins and aggregates of these. Templates are parameters, and
their index and the counts of their tokens are all that is broadcast or sent to the driver.

Null texts count as empty: no words, no labels, score 0. Rows are scanned each, also repeated ones
and those without an id. Empty tables give no rows. Words are maximal runs of a-z, 0-9 and
characters beyond ASCII, A-Z being lower-cased. Further columns come along if named in ``keep``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rigstream.llm.common import measured
from rigstream.session import materialised

#: Pairs of words after which the next block begins; a block is twice as long.
BLOCK = 48
#: Bytes of a text whose words are held at once.
STEP = 1 << 20
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
REST_OF_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]*")
#: Rows that a task hands on at once.
ROWS = 10_000


@dataclass(frozen=True)
class Template:
    """A license text under its label. ``phrase``: its words must stand consecutively; else ``percent`` of its pairs suffice."""

    label: str
    text: str
    percent: int = 75
    phrase: bool = False

    @property
    def words(self) -> list[bytes]:
        return WORDS.findall(self.text.encode().lower())

    @property
    def pairs(self) -> list[bytes]:
        """The pairs of neighbouring words in the order of the text."""
        return [a + b" " + b for a, b in zip(self.words, self.words[1:])]

    @property
    def needed(self) -> int:
        size = len(set(self.pairs))
        return size if self.phrase else max(1, -(-self.percent * size // 100))


# Fixed values of the contract: phrases and their labels.
PHRASES = [
    Template("cc-by", "cc by", phrase=True),
    Template("gpl", "general public license", phrase=True),
    Template("reserved", "all rights reserved", phrase=True),
]
# Names and notices of licenses and their labels. Names, which differ by a word, must be whole.
NOTICES = [
    Template("gpl-3.0", "GNU General Public License, version 3", 100),
    Template("gpl-2.0", "GNU General Public License, version 2", 100),
    Template(
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation",
    ),
    Template("cc-by-4.0", "CC BY 4.0", 100),
    Template("cc-by-nc-4.0", "CC BY-NC 4.0", 100),
    Template("cc-by-sa-4.0", "CC BY-SA 4.0", 100),
    Template("cc-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("mit", "under the MIT License", 100),
    Template(
        "mit-notice",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
    ),
    Template("apache-2.0", "the Apache License, Version 2.0", 100),
    Template("apache-notice", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template(
        "bsd-notice",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
]
TEMPLATES = PHRASES + NOTICES


def _runs(text: bytes, step: int) -> Iterator[list[bytes]]:
    """The words of a text, those of about ``step`` bytes at a time; no word is cut."""
    begin = 0
    while begin < len(text):
        end = REST_OF_WORD.match(text, min(begin + step, len(text))).end()
        yield WORDS.findall(text[begin:end].lower())
        begin = end


def _pairs_of(text: bytes, known: dict[bytes, dict[bytes, int]], step: int) -> tuple[int, list[tuple[int, int]]]:
    """The number of words, and (place, token) of every known pair."""
    count, last, found = 0, None, []
    for words in _runs(text, step):
        if last is not None:
            words.insert(0, last)
            count -= 1
        for place, word in enumerate(words[:-1], count):
            if word in known:
                token = known[word].get(words[place - count + 1])
                if token is not None:
                    found.append((place, token))
        count += len(words)
        last = words[-1] if words else last
    return count, found


def blocks(docs: DataFrame, tokens: dict[bytes, int], text: str, keep: list[str], block: int, step: int = STEP) -> DataFrame:
    """A row for every document (``_row``, ``n_words``, ``keep``), and one for every block with known pairs.

    Blocks have ``_block``, and the places ``at`` and numbers ``token`` of the pairs; these are null for documents.
    """
    known: dict[bytes, dict[bytes, int]] = {}
    for pair, token in tokens.items():
        first, second = pair.split(b" ")
        known.setdefault(first, {})[second] = token
    kinds = dict(docs.dtypes)
    made = [("_row", pa.int64()), ("n_words", pa.int64()), ("_block", pa.int64()), ("at", pa.list_(pa.int64())), ("token", pa.list_(pa.int32()))]
    schema = ", ".join(
        ["_row long", "n_words long", "_block long", "at array<bigint>", "token array<int>", *[f"`{c}` {kinds[c]}" for c in keep]]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            held: list[list] = [[] for _ in made]
            rows: list[int] = []

            def emptied() -> pa.RecordBatch:
                columns = [pa.array(v, kind) for v, (_, kind) in zip(held, made)]
                taken = pa.array(rows, pa.int32())
                columns += [batch.column(c).take(taken) for c in keep]
                for v in [*held, rows]:
                    v.clear()
                return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in made] + keep)

            def add(i: int, *values) -> None:
                rows.append(i)
                for v, value in zip(held, values):
                    v.append(value)

            for i, value in enumerate(batch.column("_text")):
                n_words, found = _pairs_of(value.as_py() or b"", known, step)
                add(i, number, n_words, None, None, None)
                parts: dict[int, list[tuple[int, int]]] = {}
                for place, token in found:
                    for part in {place // block, max(0, place // block - 1)}:
                        parts.setdefault(part, []).append((place, token))
                for part, pairs in parts.items():
                    add(i, number, None, part, [p for p, _ in pairs], [t for _, t in pairs])
                    if len(rows) >= ROWS:
                        yield emptied()
                number += 1
            if rows:
                yield emptied()

    return docs.select(F.col(text).cast("binary").alias("_text"), *[F.col(c) for c in keep]).mapInArrow(scan, schema)


def _ranks(found: DataFrame, tokens: dict[bytes, int]) -> dict[int, int]:
    """The place of every token in the global order: by the number of blocks that hold it, rarest first."""
    counts = found.select(F.explode(F.array_distinct("token")).alias("token")).groupBy("token").count()
    seen = {row["token"]: row["count"] for row in counts.collect()}
    return {token: rank for rank, token in enumerate(sorted(tokens.values(), key=lambda t: (seen.get(t, 0), t)))}


def _index(spark: SparkSession, templates: list[Template], tokens: dict[bytes, int], ranks: dict[int, int]) -> DataFrame:
    """The prefixes of the templates: a row for each of their rarest tokens."""
    rows = []
    for number, template in enumerate(templates):
        order = sorted(ranks[tokens[pair]] for pair in set(template.pairs))
        for i, rank in enumerate(order[: len(order) - template.needed + 1]):
            rows.append((rank, number, len(order) - i - 1, template.needed))
    return spark.createDataFrame(rows, "_rank int, _template int, _behind int, _needed int")


def _places(template: Template, tokens: dict[bytes, int], block: int) -> Column:
    """The places of a phrase's words that begin in the first half of a block, which is no other block's first half."""
    at, *rest = [F.lit(tokens[pair]) for pair in template.pairs]

    def stands(place: Column, token: Column, by: int) -> Column:
        return F.exists("_pairs", lambda p: (p["at"] == place + by) & (p["token"] == token))

    def begins(pair: Column) -> Column:
        here = (pair["token"] == at) & (pair["at"] < (F.col("_block") + 1) * block) & (pair["at"] >= F.col("_block") * block)
        for by, token in enumerate(rest, 1):
            here = here & stands(pair["at"], token, by)
        return here

    return F.transform(F.filter("_pairs", begins), lambda p: p["at"])


def matches(found: DataFrame, templates: list[Template], tokens: dict[bytes, int], block: int = BLOCK) -> DataFrame:
    """The blocks that hold a template: ``_row``, ``_block``, ``_template``, ``shared``, and ``places`` of phrases."""
    spark = found.sparkSession
    ranks = _ranks(found, tokens)
    by_token = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    ranked = found.withColumn("_ranks", F.array_sort(F.transform(F.array_distinct("token"), lambda t: F.element_at(by_token, t))))
    prefix = _index(spark, templates, tokens, ranks)
    met = ranked.select("_row", "_block", "_ranks", F.size("_ranks").alias("_size"), F.posexplode("_ranks").alias("_i", "_rank"), "at", "token")
    may = met.join(F.broadcast(prefix), "_rank").where(
        (F.col("_size") >= F.col("_needed")) & (1 + F.least(F.col("_behind"), F.col("_size") - F.col("_i") - 1) >= F.col("_needed"))
    )
    # one row for each block and template, however many tokens they met by; blocks do not move for it
    once = may.groupBy("_row", "_block", "_template").agg(
        F.first("_ranks").alias("_ranks"), F.first("_needed").alias("_needed"), F.first("at").alias("at"), F.first("token").alias("token")
    )
    sets = [F.array(*[F.lit(ranks[tokens[pair]]) for pair in sorted(set(t.pairs))]) for t in templates]
    shared, places, empty = F.lit(0), F.lit(None), F.array().cast("array<bigint>")
    for number, template in enumerate(templates):
        mine = F.col("_template") == number
        shared = F.when(mine, F.size(F.array_intersect("_ranks", sets[number]))).otherwise(shared)
        places = F.when(mine, _places(template, tokens, block) if template.phrase else empty).otherwise(places)
    zipped = once.withColumn("_pairs", F.arrays_zip("at", "token"))
    counted = zipped.select("_row", "_block", "_template", "_needed", shared.alias("shared"), places.alias("places"))
    return counted.where(F.col("shared") >= F.col("_needed"))


def scan(
    docs: DataFrame, templates: list[Template] = TEMPLATES, text: str = "text", keep: tuple[str, ...] = ("doc_id",), block: int = BLOCK,
    step: int = STEP,
) -> DataFrame:
    """``keep``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` of every row.

    ``n_base`` counts the places of phrases; ``score`` is the largest share of a found template's
    pairs that one block holds, 1 for phrases, 0 where nothing is found.
    """
    if any(not t.pairs or len(t.pairs) > block for t in templates):
        raise ValueError("templates have two words at least and are no longer than a block's step")
    tokens = {pair: n for n, pair in enumerate(sorted({pair for t in templates for pair in t.pairs}))}
    read = materialised(blocks(docs, tokens, text, list(keep), block, step))
    found = matches(read.where("_block is not null").select("_row", "_block", "at", "token"), templates, tokens, block)
    number = F.col("_template")

    def of(values: list) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), number + 1)

    is_phrase = of([t.phrase for t in templates])
    sound = found.where(~is_phrase | (F.size("places") > 0)).select(
        "_row", of([t.label for t in templates]).alias("label"), is_phrase.alias("phrase"), "places",
        (F.col("shared") / of([len(set(t.pairs)) for t in templates])).alias("share"),
    )

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(labels), ",")

    hits = sound.groupBy("_row").agg(
        F.sum(F.size("places")).alias("n_base"), F.min(F.array_min("places")).alias("first_word"), F.max(F.array_max("places")).alias("last_word"),
        joined(F.collect_set(F.when(F.col("phrase"), F.col("label")))).alias("base_labels"),
        joined(F.collect_set("label")).alias("labels"), F.max("share").alias("score"),
    )
    heads = read.where("_block is null").select("_row", "n_words", *keep)
    whole = heads.join(measured(hits), "_row", "left")
    return whole.select(
        *keep, "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
