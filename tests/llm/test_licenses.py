"""License scans against counting every block."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rigstream.llm import licenses, queries
from rigstream.llm.licenses import Template

DDL = "doc_id long, text string"


def _words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def plain_scan(rows, templates, block):
    out = []
    for doc_id, text in rows:
        words = _words(text)
        pairs = list(zip(words, words[1:]))
        places, base, labels, score = [], set(), set(), 0.0
        for t in templates:
            mine = [w.decode() for w in t.words]
            wanted = set(zip(mine, mine[1:]))
            if t.phrase:
                at = [i for i in range(len(words)) if words[i : i + len(mine)] == mine]
                places += at
                if at:
                    base.add(t.label)
                    score = 1.0
            else:
                shares = [len(wanted & set(pairs[b : b + 2 * block])) for b in range(0, max(len(pairs), 1), block)]
                if max(shares) >= max(1, -(-t.percent * len(wanted) // 100)):
                    labels.add(t.label)
                    score = max(score, max(shares) / len(wanted))
        out.append((doc_id, len(words), len(places), min(places, default=None), max(places, default=None),
                    ",".join(sorted(base)), ",".join(sorted(base | labels)), score))
    return out


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


TEMPLATES = [
    Template("p", "a b", phrase=True), Template("q", "a b a", phrase=True), Template("q", "c é", phrase=True),
    Template("r", "a b c d e f", 60), Template("s", "f e d c b a f", 80), Template("t", "a a a b", 100),
]


@pytest.mark.parametrize("block, step", [(6, 7), (7, 1 << 20), (20, 3)])
def test_scans_equal_counting_every_block(spark, block, step):
    draw = random.Random(block)
    letters = ["a", "b", "c", "d", "e", "f", "é", "x", "A", "B9", "K"]
    texts = [draw.choice([" ", ", ", "\n"]).join(draw.choices(letters, k=draw.randrange(60))) for _ in range(150)]
    texts += [None, "", "  ", "a", "a b", "A\x00B", "a_b", "a b " * 300, "ab" * 500, "É c é"]
    rows = list(enumerate(texts)) + [(None, "a b"), (4, "a b"), (4, "a b")]
    docs = spark.createDataFrame(rows, DDL).repartition(3).withColumn("n_words", F.lit("clash")).withColumn("_row", F.lit(1))
    found = licenses.scan(docs, TEMPLATES, block=block, step=step).collect()
    assert _sorted(found) == _sorted(plain_scan(rows, TEMPLATES, block))


def test_filters_leave_only_blocks_that_may_match(spark):
    templates = [Template("r", "one two three four five six", 80)]
    tokens = {pair: n for n, pair in enumerate(sorted(templates[0].pairs))}
    texts = ["one two three four five six", "one two x four five", "three four five six", "two three four five six seven"]
    read = licenses.blocks(spark.createDataFrame(list(enumerate(texts)), DDL), tokens, "text", ["doc_id"], 10)
    found = licenses.matches(read.where("_block is not null"), templates, tokens, 10)
    assert sorted(r.shared for r in found.collect()) == [4, 5]


def test_notices_are_told_apart(spark):
    texts = {
        "Licensed under CC BY-NC 4.0.": ("cc-by", "cc-by,cc-by-nc-4.0"),
        "This work is licensed under the GNU General Public License, version 3.": ("gpl", "gpl,gpl-3.0"),
        "x " * 500 + "released under\nthe MIT license" + " y" * 500: ("", "mit"),
        "All rights reserved. The license of the public in general.": ("reserved", "reserved"),
        "Licensed under the Apache License, Version 2.0.": ("", "apache-2.0"),
        "clean text about a general public": ("", ""),
        "is hereby granted free of charge to any person obtaining a copy of this program and associated documentation files "
        "to deal in the program without restriction": ("", "mit-notice"),
    }
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], DDL)
    found = {r.doc_id: (r.base_labels, r.labels) for r in licenses.scan(rows).collect()}
    assert found == dict(enumerate(texts.values()))


def test_long_texts_and_empty_tables(spark):
    assert licenses.scan(spark.createDataFrame([], DDL)).collect() == []
    rows = [(1, "all rights reserved " * 200_000), (2, "w" * 3_000_000 + " cc by")]
    first, second = sorted(licenses.scan(spark.createDataFrame(rows, DDL)).collect())
    assert (first.n_words, first.n_base, first.first_word, first.last_word) == (600_000, 200_000, 0, 599_997)
    assert (second.n_words, second.n_base, second.first_word) == (3, 1, 1)
    with pytest.raises(ValueError):
        licenses.scan(spark.createDataFrame(rows, DDL), [Template("x", "word")])


def test_registered_scan(spark):
    df = queries.op12_license_scan(spark, "/root/testdata/sf0.001")
    kinds = dict(df.dtypes)
    assert kinds == {
        "doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
        "base_labels": "string", "labels": "string", "score": "double",
    }
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert _sorted(df.collect()) == _sorted(plain_scan([tuple(r) for r in docs.collect()], licenses.TEMPLATES, licenses.BLOCK))
