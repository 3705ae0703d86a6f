"""BPE, lengths, language and toxicity against brute force and public libraries."""

import base64
import math
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from rigstream.llm import bpe, language, lengths, toxicity

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ODD = [
    None, "", " ", "a", "A b\n\n  c\t", "a" * 3000, "ab" * 1501, "日本語テスト" * 40, "🙂" * 70, "<|endoftext|>", "'s 12'll", "é" * 65,
]
SCHEMA = "doc_id long, text string, ids string, score double"


def _docs(spark, texts):
    return spark.createDataFrame([(i, t, "x", 0.5) for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_decodes(spark, reference):
    draw = random.Random(4)
    texts = ODD + ["".join(draw.choice("aábc \n1!ßx") for _ in range(draw.randrange(300))) for _ in range(200)]
    coded = bpe.encode(_docs(spark, texts), RANKS, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "text", "score", "ids"]
    for row in bpe.decode(coded, RANKS).collect():
        assert row.ids == reference.encode_ordinary(row.text or "")
        assert bytes(row.decoded).decode() == (row.text or "")


def test_bpe_of_an_empty_table(spark):
    assert bpe.digests(_docs(spark, []), RANKS, public_tokenizers.PATTERN, ["doc_id"]).collect() == []


def test_merges_take_the_leftmost_lowest_pair():
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    draw = random.Random(5)
    for _ in range(300):
        data = bytes(draw.choice(b"aabcdef ") for _ in range(draw.randrange(2, 60)))
        parts = [encoder.ranks[bytes([b])] for b in data]
        while True:
            ranked = [(encoder.merges.get(a << 32 | b, math.inf), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            if not ranked or min(ranked)[0] == math.inf:
                break
            rank, i = min(ranked)
            parts[i : i + 2] = [rank]
        assert encoder.merge_long(data) == parts
        assert encoder.merge_short([data], 64) == [b"".join(encoder.packed[p] for p in parts)]


def test_lengths(spark, reference):
    counted = lengths.token_counts(_docs(spark, ODD + ["a b c"] * 5), RANKS, public_tokenizers.PATTERN)
    known = [len(reference.encode_ordinary(t or "")) for t in ODD + ["a b c"] * 5]
    answers = lengths.limits(lengths.histogram(counted)).cache()
    rows = {r.length: r for r in answers.collect()}
    assert sorted(rows) == sorted(set(known))
    for limit, row in rows.items():
        assert row.docs == known.count(limit)
        assert row.tokens == limit * row.docs
        assert row.docs_longer == sum(n > limit for n in known)
        assert row.tokens_longer == sum(n for n in known if n > limit)
        assert row.tokens_kept == sum(min(n, limit) for n in known)
        assert row.share_fitting == pytest.approx(sum(n <= limit for n in known) / len(known))
    for limit in (0, 2, 5, 1000, 10**6):
        found = lengths.totals_at(answers, limit).first()
        assert (found.tokens_kept, found.docs_cut) == (sum(min(n, limit) for n in known), sum(n > limit for n in known))
    assert lengths.quantile(answers, 0.5).first().length == sorted(known)[math.ceil(len(known) / 2) - 1]
    assert lengths.limits(lengths.histogram(counted.limit(0))).collect() == []


def _cost(trees, totals, context, byte):
    if context is None:
        return 8.0
    shorter = context[1:] if context else None
    seen = trees.get(context)
    if seen is None or totals[context] < language.LEAST:
        return _cost(trees, totals, shorter, byte)
    n, kinds = sum(seen.values()), len(seen)
    if byte in seen:
        return -math.log2(seen[byte] / (n + kinds))
    return -math.log2(kinds / (n + kinds)) + _cost(trees, totals, shorter, byte)


def test_code_lengths_are_those_of_the_context_trees():
    texts = {"en": [b"the cat sat on the mat", b"a hat"], "xx": ["été là-bas, l'été".encode(), b"la la la"]}
    trees, totals = {}, {}
    for name, found in texts.items():
        trees[name] = {}
        for data in found:
            padded = [None] * language.ORDER + list(data)
            for i in range(language.ORDER, len(padded)):
                for order in range(language.ORDER + 1):
                    context = tuple(padded[i - order : i])
                    counts = trees[name].setdefault(context, {})
                    counts[padded[i]] = counts.get(padded[i], 0) + 1
                    totals[context] = totals.get(context, 0) + 1
    model = language.learn(texts)
    samples = [b"the mat", b"", "là!".encode(), b"zz\xff", b"x"]
    for data, bits in zip(samples, model.lengths(samples).tolist()):
        padded = [None] * language.ORDER + list(data)
        for name, found in zip(model.languages, bits):
            costs = (
                _cost(trees[name], totals, tuple(padded[i - language.ORDER : i]), padded[i])
                for i in range(language.ORDER, len(padded))
            )
            assert found == sum(round(c * language.UNIT) for c in costs)


def test_languages_held_out(spark):
    docs = spark.createDataFrame(
        [(t, l) for t, l in [("the cat and the dog of the house", "en"), ("der Hund und die Katze im Haus", "de")] for _ in range(9)]
        + [(None, "en"), ("the the", None)], "text string, lang string",
    )
    asked = spark.createDataFrame([("the dog",), ("die Katze",), (None,), ("12 -- !",), ("",)], "text string")
    found = language.identify(asked, language.fit(docs)).collect()
    assert [r.lang_pred for r in found] == ["en", "de", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in found) and found[2].score == 0
    nothing = language.identify(asked, language.fit(docs.limit(0))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_meets_what_edit_distance_says():
    draw = random.Random(3)
    terms = [
        toxicity.Term("".join(draw.choice("abc") for _ in range(draw.randrange(3, 8))), draw.random() < 0.5, draw.random() + 0.1)
        for _ in range(25)
    ]
    automaton = toxicity.Automaton(terms)
    for _ in range(3000):
        word = "".join(draw.choice("abcd") for _ in range(draw.randrange(0, 10)))
        plain = max((t.weight for t in terms if (word == t.text if t.whole else word.startswith(t.text))), default=0.0)
        edited = max(
            (t.weight for t in terms if t.whole and len(t.text) >= toxicity.EDIT_WORD and _edits(word, t.text) == 1), default=0.0
        )
        found = automaton.match(word) or (0.0, 0.0)
        assert found[0] == plain
        if not plain:
            assert found[1] == edited


def test_windows_tell_quotation():
    terms = [toxicity.Term("idiot", True, 5.0)]
    read = toxicity.Reader(terms).figures
    assert read('they said "you idiot" to me')[0] == 0 and read('they said "you idiot" to me')[3] == 5
    assert read('key = "f00" you idiot, "x" is')[0] == 5
    assert read("such idioot talk")[2] == 5
    assert read(None) == read("") == (0, 0, 0, 0)


def test_toxicity_learns_and_holds_out(spark):
    draw = random.Random(8)
    words = ["lorem", "ipsum", "dolor", "amet", "sit", "elit", "sed", "do"]
    rows = []
    for i in range(600):
        text = [draw.choice(words) for _ in range(30)]
        if i % 6 == 0:
            text[draw.randrange(30)] = draw.choice(["vileword", "grunkest", "grunkish"])
        rows.append((i, " ".join(text), int(i % 6 == 0)))
    rows += [(1000, None, 0), (1001, "", None), (1002, "x", 0), (1002, "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.where("doc_id % 2 = 0").select("doc_id", "toxic"))
    scored = toxicity.score(docs, model).where("doc_id % 2 = 1 and toxic is not null").collect()
    assert all(r.predicted == r.toxic for r in scored)
    assert toxicity.score(docs, toxicity.Model()).agg(F.max("score")).first()[0] < 1e-6
    empty = toxicity.fit(docs.select("doc_id", "text"), docs.limit(0).select("doc_id", "toxic"))
    assert empty.terms == [] and toxicity.score(docs.limit(0), model).collect() == []


def test_misspelled_stems_and_short_words_are_met(spark):
    draw = random.Random(11)
    words = ["lorem", "ipsum", "dolor", "amet", "sit", "elit", "sed", "do", "pilt"]
    toxic = ["grunkest", "grunkish", "grunkers", "blorting", "blorted", "zoxy", "vilt"]
    rows = []
    for i in range(1400):
        text = [draw.choice(words) for _ in range(30)]
        if i % 7 == 0:
            word = toxic[i // 7 % len(toxic)]
            # some are misspelled in the labelled documents as well, each in its own way
            text[draw.randrange(30)] = word[0] + draw.choice("bcdfhjkmpqstvwxy") + word[1:] if i % 5 == 0 and len(word) > 4 else word
        rows.append((i, " ".join(text), int(i % 7 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    met = ["grxnkest", "gruunkish", "blrting", "grnkable", "zoxxy", "zxy"]
    # the last is a word of clean documents beside a toxic one
    asked = spark.createDataFrame([(w, "lorem ipsum " + w + " sit") for w in [*met, "pilt"]], "w string, text string")
    found = {r.w: r for r in toxicity.score(asked, model).collect()}
    assert all(found[w].predicted == 1 and found[w].plain == 0 < found[w].misspelled for w in met), found
    assert found["pilt"].predicted == 0 == found["pilt"].misspelled


def test_every_language_is_learned(spark):
    """More languages than any list of the usual ones, each with words of its own."""
    draw = random.Random(21)
    names = [f"l{n:03d}" for n in range(250)]
    letters = {name: draw.sample("abcdefghijklmnopqrstuvwxyz", 8) for name in names}

    def text(name):
        return " ".join("".join(draw.choices(letters[name], k=draw.randrange(2, 7))) for _ in range(80))

    rows = [(name, text(name)) for name in names for _ in range(3)] + [("l000", "a" * 3_000_000), (None, "b c"), ("empty", ""), ("none", None)]
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("_bytes", F.lit(1)).withColumn("_most", F.lit("x"))
    taken = language.sample(docs)
    assert sorted(taken) == names and max(sum(map(len, found)) for found in taken.values()) <= language.SAMPLE_BYTES
    asked = spark.createDataFrame([(name, text(name)) for name in names], "want string, text string")
    found = language.identify(asked, language.fit(docs)).collect()
    assert sum(r.want == r.lang_pred for r in found) >= 0.95 * len(names)
