"""URLs, mixing, joins, fingerprints, top-k, archives and the pipeline against brute force."""

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rigstream.llm import fingerprints, jaccard, mixing, queries, topk, urls, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_longest_rule_wins(spark):
    draw = random.Random(2)
    hosts = ["", "org", "example.org", "a.example.org", "com", "x.com"]
    rules = [urls.Rule(draw.choice(hosts[1:]), draw.choice(["/", "/a/", "/a/b", "/ab", "/a/b/", ""]), draw.random() < 0.5) for _ in range(12)]
    rules = list({(r.host, r.path): r for r in rules}.values())
    found = ["http://" + draw.choice(hosts) + draw.choice(["", "/", "/a", "/a/", "/a/b", "/a/bc/", "/abc?x=/a/", "#/a/"]) for _ in range(200)]
    odd = [None, "", "no scheme", "://", "x://HOST.Org/Ä", "a://b.org:8/a?://c.com/", "h://org\n.org/a/"]
    rows = spark.createDataFrame([(u, "kept") for u in found + odd], "url string, verdict string")
    for row in urls.filter_urls(rows, rules, default_allow=False).collect():
        rest = row.url.split("://", 1)[1] if row.url and "://" in row.url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate({c: c + 32 for c in range(65, 91)})
        assert (row.host, row.path) == (host, path)
        fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: (len(r.name), len(r.host)), default=None)
        assert row.rule == (best.name if best else None)
        assert row.verdict == ("allow" if best and best.allow else "block")


def _mixed(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    return mixing.mix(docs, **options)


@pytest.mark.parametrize("block", [40, 10_000])
def test_mixing_meets_its_targets(spark, block):
    draw = random.Random(7)
    rows = [(i, draw.choice(["a", "a", "a", "b", "c", None]), "w " * draw.randrange(0, 60)) for i in range(900)]
    rows += rows[:5] + [(901, "b", None), (None, "c", "x y")]
    found = _mixed(spark, rows, block=block).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == sorted((r[0] is None, r[0] or 0) for r in rows)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    order = sorted(size, key=lambda s: (s is None, s or ""))
    left, open_, goal = Fraction(3, 2) * sum(size.values()), dict(zip(order, [5, 2, 1, 5])), {}
    while True:
        level = left / sum(open_.values())
        over = [s for s in open_ if level * open_[s] > 2 * size[s]]
        if not over:
            break
        for s in over:
            goal[s] = Fraction(2 * size[s])
            left -= goal[s]
            del open_[s]
    goal |= {s: level * w for s, w in open_.items()}
    for s in order:
        assert target[s] == pytest.approx(float(goal[s]))
        assert abs(taken[s] - target[s]) <= max(60, 0.01 * target[s])
    again = _mixed(spark, rows[::-1], block=block).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_mixing_of_nothing(spark):
    assert _mixed(spark, []).collect() == []
    assert [r.taken for r in _mixed(spark, [(1, "a", ""), (2, None, None)]).collect()] == [0, 0]


def test_flight_keeps_totals():
    draw = random.Random(1)
    sizes = [float(draw.randrange(1, 50)) for _ in range(500)]
    parts = [0.3] * 500
    done = mixing.flight(sizes, parts, np.random.default_rng(3))
    assert sum(0 < v < 1 for v in done) <= 2
    assert sum(s * v for s, v in zip(sizes, done)) == pytest.approx(0.3 * sum(sizes))
    assert sum(done) == pytest.approx(150)


def _brute_components(rows, k, percent):
    sets, parent = [], {}
    for doc_id, text in rows:
        words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        runs = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)] or ([tuple(words)] if words else [])
        sets.append((doc_id, frozenset(runs)))
        parent.setdefault(doc_id, doc_id)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted((d, len(s), root(d)) for d, s in sets)


def _families(seed, families=12, copies=14):
    draw = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(300)]
    common = [draw.choice(vocabulary) for _ in range(25)]
    rows = [(90_000, None), (90_001, ""), (90_002, " \t"), (90_003, "One"), (90_004, "one"), (90_005, "a b"), (90_006, "B a")]
    for f in range(families):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([6, 9, 40, 120]))] + common * (f % 3)
        for c in range(copies):
            words = list(base)
            for _ in range(draw.randrange(0, 4)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            rows.append((f * 100 + c, " ".join(words)))
    return rows + rows[:9]


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80), (1, 50)])
def test_jaccard_components_equal_brute_force(spark, k, percent, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 3)
    monkeypatch.setattr(jaccard, "QUERIES", 4)
    rows = _families(k)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.linked_components(docs, words=k, percent=percent).collect()
    assert sorted(map(tuple, found)) == _brute_components(rows, k, percent)


def test_jaccard_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.linked_components(none).collect() == []
    rows = spark.createDataFrame([(None, "a b c d e f g"), (5, "a b c d e f g"), (None, None)], "doc_id long, text string")
    found = jaccard.linked_components(rows).collect()
    assert sorted((r.n_shingles, r.component_id) for r in found if r.n_shingles) == [(3, 5), (3, 5)]


def test_matrix_filters_never_lose_a_link():
    draw = np.random.default_rng(1)
    for _ in range(400):
        base = np.unique(draw.integers(0, 1 << 63, 120).astype(np.uint64))
        a = np.unique(np.concatenate([base[: draw.integers(80, 120)], draw.integers(0, 1 << 63, draw.integers(0, 12)).astype(np.uint64)]))
        hot = np.sort(base[::7])
        rank = np.arange(len(hot))
        both = len(np.intersect1d(a, base))
        if 100 * both >= 80 * (len(a) + len(base) - both):
            first = [jaccard.first_shingles(s, 80, hot, rank) for s in (a, base)]
            met = np.intersect1d(*first)
            assert len(met)
            room = max(min(len(s) - f.tolist().index(t) for s, f in zip((a, base), first)) for t in met)
            assert 180 * room >= 80 * (len(a) + len(base))
        differing = int(np.bitwise_count(jaccard.parity(a).view(np.uint64) ^ jaccard.parity(base).view(np.uint64)).sum())
        assert differing <= len(a) + len(base) - 2 * both


def test_open_parts_stays_closed_below_the_bound():
    members = {1: np.arange(10, dtype=np.uint64), 2: np.arange(5, 15, dtype=np.uint64)}
    asks = {3: np.arange(100, 110, dtype=np.uint64), 4: np.arange(1, 11, dtype=np.uint64)}
    assert jaccard.open_parts(members, asks, 80) == [(4, 1)]
    assert jaccard.open_parts({}, asks, 80) == []


@pytest.mark.parametrize("slice_rows", [3, 1000])
def test_next_document_and_edits(spark, slice_rows, monkeypatch):
    monkeypatch.setattr(fingerprints.with_next, "__defaults__", (slice_rows,))
    draw = random.Random(6)
    texts = [None, "", "x", "é" * 7, " "] + ["".join(draw.choice("abc déf ") for _ in range(draw.randrange(400))) for _ in range(40)]
    rows = [(i * i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sketch", F.lit(1))
    found = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs).collect()}
    order = sorted(rows, reverse=True)
    assert len(found) == len(rows)
    for (doc_id, text), (after, following) in zip(order, order[1:] + order[:1]):
        text, following, row = text or "", following or "", found[doc_id]
        half = len(text) // 2
        assert row.n_chars == len(text)
        edited = text[: len(text) - half] + following[:half]
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.near_next == 1) == (row.fingerprint == found[after].fingerprint)
        assert (row.near_edited == 1) == (row.fingerprint == row.edited_fingerprint)


def test_repeated_and_null_ids_have_a_next(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (None, "d"), (None, None)], "doc_id long, text string")
    assert fingerprints.edited_fingerprints(docs).count() == 5
    assert fingerprints.edited_fingerprints(docs.limit(0)).count() == 0


def test_closed_syncmers(spark):
    draw = random.Random(9)
    words = [draw.choice("abcdefgh") + str(draw.randrange(9)) for _ in range(200)]
    text = " ".join(words)
    row = spark.createDataFrame([(text,)], "t string").select(
        fingerprints.anchors(F.col("t")).alias("a"),
        F.array(*[F.xxhash64(F.lit(a), F.lit(b)) for a, b in zip(words, words[1:])]).alias("h"),
    ).first()
    span = fingerprints.K - fingerprints.S
    chosen = [i for i in range(len(row.h) - span) if min(row.h[i : i + span + 1]) in (row.h[i], row.h[i + span])]
    assert [x.pos for x in row.a] == chosen
    assert len({x.hash for x in row.a}) == len({tuple(words[i : i + fingerprints.K]) for i in chosen})


def test_anchors_do_not_depend_on_what_stands_around(spark):
    draw = random.Random(10)
    make = lambda n: " ".join("v%d" % draw.randrange(500) for _ in range(n))
    passage = make(60)
    both = [make(30) + " " + passage + " " + make(10), make(7) + " " + passage]
    rows = spark.createDataFrame([(t,) for t in both], "t string").select(fingerprints.anchors(F.col("t")).alias("a")).collect()
    inside = [{(x.pos - at, x.hash) for x in r.a if at <= x.pos <= at + 60 - fingerprints.K} for r, at in zip(rows, (30, 7))]
    assert inside[0] == inside[1] and inside[0]


def test_texts_with_words_have_anchors(spark):
    draw = random.Random(12)
    texts = [" ".join("w%d" % draw.randrange(10**6) for _ in range(n)) for n in (1, 4, 5, 5, 5, 6, 6, 6, 7, 8) for _ in range(6)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    for row in docs.select("text", fingerprints.anchors(F.col("text")).alias("a")).collect():
        assert row.a, row.text
    for row in fingerprints.edited_fingerprints(docs).collect():
        assert row.fingerprint and row.edited_fingerprint and row.near_next == 0


def test_likeness_counts_all_anchors_by_place(spark):
    draw = random.Random(13)
    make = lambda n: ["v%d" % draw.randrange(10**6) for _ in range(n)]
    long, other, passage, line = make(4000), make(4000), make(50), make(12)
    one = long[:2000] + make(1) + long[2001:]
    texts = [
        (long, one), (long[:1000] + passage + long[1000:], other[:3000] + passage + other[3000:]), (long, make(1) + long),
        (line + make(9) + line + long[:9] + line, line), (["a", "b", "c"], ["c", "b", "a"]), (line * 3, line * 4),
    ]
    rows = [(i, " ".join(a), " ".join(b)) for i, (a, b) in enumerate(texts)]
    pairs = spark.createDataFrame(rows, "i int, a string, b string").select("i", *[fingerprints.anchors(F.col(c)).alias(c) for c in "ab"])
    found = pairs.select("i", "a", "b", fingerprints.likeness(F.col("a"), F.col("b")).alias("near")).orderBy("i").collect()
    for row in found:
        both = []
        for side in (row.a, row.b):
            counts = defaultdict(int)
            for x, before in zip(side, [-1, *[x.pos for x in side]]):
                counts[x.hash, x.pos - before] += 1
            both.append(counts)
        met = sum(min(n, both[1][h]) for h, n in both[0].items())
        union = len(row.a) + len(row.b) - met
        assert row.near == pytest.approx(min(met, union - 1) / union)
    near = [r.near for r in found]
    assert 0.99 < near[0] < 1 and 0 < near[1] < 0.02 and 0.99 < near[2] < 1
    assert near[4] == pytest.approx(2 / 3) and near[5] < 1
    whole = spark.createDataFrame([(1, rows[0][1]), (2, rows[0][2])], "doc_id long, text string")
    for row in fingerprints.edited_fingerprints(whole).collect():
        assert len(row.fingerprint.split(".")) > 1500 and 0.99 < row.near_next < 1


def test_top_k_equals_brute_force(spark):
    draw = np.random.default_rng(5)
    known = {i: np.round(draw.normal(size=6), 1).tolist() for i in range(300)}
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (None, [1.0] * 6)]
    again = [(5, known[5]), (7, known[7]), (7, known[7])]
    rows = list(known.items()) + again + bad + [(1000, [1.0, 2.0])]
    vectors = topk.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    found = topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=7, shard=50, block=4).collect()
    whole = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in [*known.items(), *again]]
    expected = []
    for q in range(0, 300, 20):
        asking = next(v for i, v in whole if i == q)
        best = sorted((-int(asking @ v), c) for c, v in whole if c != q)[:7]
        expected += [(q, n, c, -s) for n, (s, c) in enumerate(best, 1)]
    assert sorted(r[:4] for r in map(tuple, found)) == sorted(expected)
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).collect() == []


def test_top_k_of_large_components_is_exact(spark):
    draw = np.random.default_rng(6)
    rows = [(i, (draw.normal(size=3) * 10.0 ** draw.integers(0, 7)).tolist()) for i in range(80)]
    rows += [(100, [1e9, 3e9, 1.0]), (101, [1e9, 3e9, 1.5]), (102, [1e9, -1.0, 0.5]), (103, [300000.0, 1.0, 0.0]), (104, [1e307] * 3)]
    vectors = topk.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)))
    found = topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=4, shard=30).collect()
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows if i != 104}
    expected = []
    for q in (q for q in whole if q % 20 == 0):
        scores = [(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(whole[q], whole[c])))), c) for c in whole if c != q]
        expected += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scores)[:4], 1)]
    assert sorted(r[:4] for r in map(tuple, found)) == sorted(expected)


def test_threshold_stops_early(monkeypatch):
    """On skewed vectors few products are taken, and these are all that is counted."""
    draw = np.random.default_rng(1)
    rows = np.floor(draw.pareto(1.5, size=(2_000, 8)) * 10)
    lists, taken = topk.Lists(rows, np.arange(2_000)), []
    whole = topk.packing.products
    monkeypatch.setattr(topk.packing, "products", lambda a, b, small=None: taken.append(len(a) * len(b)) or whole(a, b, small))
    queries_ = np.floor(draw.pareto(1.5, size=(20, 8)) * 10)
    found, scored = lists.search(queries_, np.full(20, -1), 3, True)
    for query, (best, scores) in zip(queries_, found):
        score = rows @ query
        assert best.tolist() == np.lexsort((np.arange(2_000), -score))[:3].tolist() and scores.tolist() == score[best].tolist()
    assert scored == sum(taken) < 20 * 2_000 / 4


def test_archives_round_trip(spark, tmp_path):
    draw = random.Random(11)
    big = "".join(chr(draw.randrange(32, 1000)) for _ in range(3000))
    rows = [(i, f"http://h/{i}", "".join(chr(draw.randrange(32, 500)) for _ in range(draw.randrange(4000)))) for i in range(150)]
    rows += [(200, "u", big), (201, "u\r\nx", big), (201, "u", big), (None, None, big), (202, "u", None), (203, None, "small"), (204, "u", "small")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = str(tmp_path / "archive")
    warc.write_archives(warc.mark_revisits(pages), folder)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
        read = warc.read_archives(spark, folder)
        found = read.withColumn("page_id", warc.page_id(F.col("record_id"))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(found) == len(rows)
    payloads = {(i, (h or "").encode()) for i, _, h in rows}
    for row in found:
        if row.warc_type == "response":
            assert (row.page_id, bytes(row.payload)) in payloads
            assert row.payload_digest == hashlib.sha1(bytes(row.payload)).hexdigest()
        else:
            assert row.refers_to == "<urn:x-page:201>" and row.payload is None
            assert (row.payload_bytes, row.payload_digest) == (len(big.encode()), hashlib.sha1(big.encode()).hexdigest())
    assert sorted((str(r.page_id), r.warc_type) for r in found if r.page_id in (None, 200, 201)) == [
        ("200", "revisit"), ("201", "response"), ("201", "response"), ("None", "revisit"),
    ]


def test_a_magic_inside_a_member_is_no_record():
    import zlib

    plain = warc._member(1, "u", bytes(range(256)) * 4 + warc.MAGIC * 3, "00" * 20, None, "d")
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    member = stored.compress(zlib.decompress(plain, 31)) + stored.flush()
    data = member + warc.EMPTY + plain
    pieces = data.split(warc.MAGIC)[1:]
    assert len(pieces) > 3
    for cut in range(len(pieces)):
        first, second = warc.Assembler(True), warc.Assembler(False)
        records = [r for p in pieces[:cut] for r in first.add(p)]
        records += [r for p in pieces[cut:] for r in second.add(p)]
        held = warc.Assembler(True)
        open_ = [a.pieces if a.unpacker is not None else [] for a in (first, second)]
        rest = open_[0] + second.orphans + open_[1]
        records += [r for p in rest for r in held.add(p)]
        assert [r[0] for r in sorted(records, key=str)] == ["<urn:x-page:1>"] * 2


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    extra = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "&&& 12", "en", "s", 6)], docs.schema)
    docs = docs.unionByName(extra)
    rows = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language"](spark, docs, sf_dir)
    assert known.columns == columns
    assert {r.doc_id for r in known.collect()} == {i for i, t in rows.items() if t and any(map(str.isalpha, t))}
    single = stages["near_duplicates"](spark, docs, sf_dir)
    assert single.columns == columns
    expected = {c for _, n, c in _brute_components(list(rows.items()), 5, 80)}
    assert sorted(r.doc_id for r in single.collect()) == sorted(expected)
    calm = stages["toxicity"](spark, docs, sf_dir)
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").collect()}
    gone = set(rows) - {r.doc_id for r in calm.collect()}
    assert calm.columns == columns and len(gone - toxic) <= 0.05 * len(rows)
    mixed = stages["mixing"](spark, single, sf_dir)
    assert mixed.columns == columns
    counts = defaultdict(int)
    for r in mixed.collect():
        counts[r.doc_id] += 1
    taken = {r.doc_id: r.copies for r in mixing.mix(single).collect() if r.copies}
    assert counts == taken
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_near_duplicates_go_by_row(spark):
    draw = random.Random(14)
    a, b, c, d, e = [" ".join("u%d" % draw.randrange(10**6) for _ in range(60)) for _ in range(5)]
    rows = [(5, a), (9, a), (5, b), (2, b), (5, c), (5, c), (None, d), (None, d), (None, d + " x"), (None, e), (8, e + " y"), (7, ""), (7, None)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    found = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "")
    assert found.columns == docs.columns
    kept = [(5, a), (2, b), (5, c), (None, d), (8, e + " y"), (7, ""), (7, None)]
    assert sorted(map(str, [(r.doc_id, r.text) for r in found.collect()])) == sorted(map(str, kept))


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.all_queries()) == list(range(1, 14))


def test_repeated_rows_meet_their_target(spark):
    words = " ".join(["w"] * 100)
    rows = [(1, "a", words)] * 1000 + [(i, "a", f"{i} {words[2:]}") for i in range(2, 202)] + [(500, "b", words)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(7).cache()
    mixed = mixing.mix(docs)
    found = mixed.collect()
    assert len(found) == len(rows)
    for source in "ab":
        taken = sum(r.taken for r in found if r.source == source)
        target = next(r.target for r in found if r.source == source)
        assert abs(taken - target) <= 0.01 * target
    assert all(0 <= r.taken <= 2 * r.size for r in found)
    again = sorted(tuple(r) for r in mixing.mix(docs).collect())
    assert again == sorted(tuple(r) for r in found)
    # taking them gives as many rows as the mix says, whatever further columns tell the copies apart
    told = docs.withColumn("n", F.monotonically_increasing_id())
    taken = mixing.apply(told, mixed)
    assert taken.columns == told.columns and taken.count() == sum(r.copies for r in found)
    assert taken.groupBy("n").count().agg(F.max("count")).first()[0] <= 2


INTERNAL = [
    "score", "predicted", "plain", "plain_terms", "misspelled", "quoted", "lang_pred", "code_bits", "_key", "_copy", "copies", "_copies", "_id",
    "_n", "_component", "component_id", "n_shingles", "label", "cls", "size", "target", "taken", "_place", "_part", "_row", "a.b", "Ä ö", "_further_1",
]


def test_stages_leave_columns_of_any_name_alone(spark):
    draw = random.Random(5)
    texts = ["the and of to " + " ".join(draw.choices(["the", "river", "stone", "of", "and", "a", "hill"], k=60)) for _ in range(30)]
    rows = [(i, t, "en", draw.choice("ab"), len(t)) for i, t in enumerate(texts + texts[:3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    for name in INTERNAL:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}-"), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, "/root/testdata/sf0.001")
        assert kept.columns == docs.columns
        found = kept.collect()
        assert found
        for row in found:
            assert all(row[c] == f"{c}-{row.doc_id}" for c in INTERNAL), name
