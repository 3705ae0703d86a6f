"""Document fingerprints from closed syncmers, in DataFrame functions only.

A k-mer is K consecutive words. Its inner substrings are S words long; it is chosen if the smallest
hash among them is that of the first or the last one. Whether a k-mer is chosen depends on its own
words alone, so equal passages choose equal anchors at equal distances, whatever stands around them.
A fingerprint is the list of all anchors with their positions, so it grows with the text. The likeness
of two is the Jaccard likeness of all their anchors, which meet by hash and by the distance from the
anchor before: a passage meets its copy elsewhere but for the copy's first anchor.

A text without a chosen k-mer has its words as anchors; that are all of fewer than K words and some of
up to 2 * K - S - 2. Null and empty texts, and texts of white space, have no anchors and an empty
fingerprint; two such are alike (1), one such and another are not (0).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from rigstream.llm.common import WORD, let

K, S = 5, 2
#: Documents that are put in order together, and the most slices they are cut into; at that number
#: slices grow instead, and are sorted on disk.
SLICE, SLICES = 2_000, 4_096


def _inner(words: Column, s: int) -> Column:
    """Hashes of all runs of ``s`` words."""
    starts = F.sequence(F.lit(0), F.size(words) - s)
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(s)]))


def _chosen(inner: Column, k: int, s: int, made) -> Column:
    """``made(i)`` for the start i of every closed syncmer, given the inner hashes."""
    span = k - s

    def at(i: Column) -> Column:
        between = [F.get(inner, i + j) for j in range(1, span)]
        edge = F.least(F.get(inner, i), F.get(inner, i + span))
        least = F.least(*between) if len(between) > 1 else between[0]
        return F.when(edge <= least, made(i))

    return F.filter(F.transform(F.sequence(F.lit(0), F.size(inner) - span - 1), at), lambda x: x.isNotNull())


def _hash(inner: Column, i: Column, k: int, s: int) -> Column:
    """The hash of the k-mer at ``i``: of inner hashes that together cover its words."""
    covering = sorted({*range(0, k - s + 1, s), k - s})
    return F.xxhash64(*[F.get(inner, i + j) for j in covering])


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Anchors of a text: array of (pos, hash), pos in words."""
    def short(words: Column) -> Column:
        return F.transform(words, lambda w, i: F.struct(i.alias("pos"), F.xxhash64(w).alias("hash")))

    def long(words: Column) -> Column:
        made = lambda h: _chosen(h, k, s, lambda i: F.struct(i.alias("pos"), _hash(h, i, k, s).alias("hash")))
        return let(_inner(words, s), made)

    return _or_words(text, k, short, long)


def _or_words(text: Column, k: int, short: Callable[[Column], Column], long: Callable[[Column], Column]) -> Column:
    """``long`` of the words of a text, or ``short`` of them if there are fewer than ``k`` or nothing was chosen."""
    def either(words: Column) -> Column:
        found = lambda chosen: F.when(F.size(chosen) == 0, short(words)).otherwise(chosen)
        return F.when(F.size(words) < k, short(words)).otherwise(let(long(words), found))

    return let(_words(text), either)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _placed(found: Column) -> Column:
    """A hash of each anchor and of its distance from the anchor before it, or from the text's begin."""
    def at(x: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(found, i - 1)["pos"])
        return F.xxhash64(x["hash"], x["pos"] - before)

    return F.transform(found, at)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two texts' anchors, each met with its distance from the one before it.

    Anchors that occur several times count so often. It is 1 for equal anchors at equal places alone:
    the same anchors in another order count as if one were not met.
    """
    def sided(placed: Column, side: int) -> Column:
        return F.transform(placed, lambda h: F.shiftleft(h, 1) + F.lit(side))

    def meet(state: Column, x: Column) -> Column:
        h = F.shiftright(x, 1)
        open_ = F.when(state["h"] == h, state["open"]).otherwise(F.lit(0))
        second = F.pmod(x, F.lit(2)) == 1
        met = second & (open_ > 0)
        return F.struct(
            h.alias("h"),
            F.when(second, F.greatest(open_ - 1, F.lit(0))).otherwise(open_ + 1).alias("open"),
            (state["met"] + F.when(met, 1).otherwise(0)).alias("met"),
        )

    def shared(both: Column) -> Column:
        x, y = both["x"], both["y"]
        start = F.struct(F.lit(None).cast("long").alias("h"), F.lit(0).alias("open"), F.lit(0).alias("met"))
        met = F.aggregate(F.sort_array(F.concat(sided(x, 0), sided(y, 1))), start, meet, lambda state: state["met"])
        share = lambda m: F.least(m, F.size(x) + F.size(y) - m - 1) / (F.size(x) + F.size(y) - m)
        return F.when(x == y, F.lit(1.0)).otherwise(let(met, share))

    return let(F.struct(_placed(a).alias("x"), _placed(b).alias("y")), shared)


def as_text(found: Column) -> Column:
    """All anchors in order, as pos:hash."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["pos"].cast("string"), F.lower(F.hex(x["hash"])))), ".")


def with_next(docs: DataFrame, key: str, columns: list[str], slice_rows: int = SLICE) -> DataFrame:
    """Add ``next``, a struct of ``columns`` of the next row by descending ``key``; the last row gets the first's.

    Null keys come last; rows of one key follow each other by ``columns``. Rows are cut into slices
    by key, at quantiles of the key, and the first rows of a slice are also sent to the slice before
    it, so slices are ordered on their own. Of every slice the driver learns one number.
    """
    slices = min(SLICES, max(1, -(-docs.count() // slice_rows)))
    shares = [i / slices for i in range(slices - 1, 0, -1)]
    bounds = docs.approxQuantile(key, shares, 0.2 / slices) if shares else []
    if bounds:
        known, steps = F.array(*[F.lit(float(b)) for b in bounds]), [1 << i for i in range(len(bounds).bit_length(), -1, -1)]
        # how many of the falling bounds lie above the key, by binary search
        number = F.aggregate(
            F.array(*[F.lit(s) for s in steps]), F.lit(0),
            lambda at, s: F.when((at + s <= len(bounds)) & (F.get(known, at + s - 1) > F.col(key)), at + s).otherwise(at),
        )
        number = F.when(F.col(key).isNull(), F.lit(len(bounds))).otherwise(number)
    else:
        number = F.lit(0)
    firsts = {r[0]: r[1] for r in docs.groupBy(number.alias("_slice")).agg(F.max(key)).collect()}
    order = sorted(firsts)
    before = {s: order[i - 1] for i, s in enumerate(order)}
    kind = docs.schema[key].dataType
    listed = F.array(*[F.lit(firsts.get(s)).cast(kind) for s in range(len(bounds) + 1)])
    previous = F.array(*[F.lit(before.get(s, 0)) for s in range(len(bounds) + 1)])
    numbered = docs.withColumn("_slice", number)
    own = F.struct(F.lit(False).alias("guest"), F.col("_slice").alias("slice"))
    guest = F.struct(F.lit(True).alias("guest"), F.get(previous, F.col("_slice")).alias("slice"))
    starts = F.col(key).eqNullSafe(F.get(listed, F.col("_slice")))
    dealt = numbered.withColumn("_at", F.explode(F.when(starts, F.array(own, guest)).otherwise(F.array(own))))
    dealt = dealt.withColumn("_slice", F.col("_at.slice")).withColumn("_guest", F.col("_at.guest")).drop("_at")
    window = Window.partitionBy("_slice").orderBy("_guest", F.col(key).desc_nulls_last(), *columns)
    return dealt.withColumn("next", F.lead(F.struct(*columns)).over(window)).where(~F.col("_guest")).drop("_slice", "_guest")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text of ``docs`` (doc_id, text) and of the text whose end is overwritten.

    The last floor(n_chars / 2) code points give way to the first as many of the next document by
    descending doc_id, or to all of it if it is shorter.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # anchors are found again for the next text, as they would weigh more than it on the way
    known = with_next(texts, "doc_id", ["text"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    begin = F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half)
    edited = known.withColumn("n_chars", F.length("text").cast("long")).select(
        "doc_id", "n_chars", F.col("text"), F.col("next.text").alias("next_text"),
        F.concat(begin, F.substring(F.col("next.text"), F.lit(1), half)).alias("edited"),
    )
    found = edited.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), anchors(F.col("text")).alias("own"),
        anchors(F.col("edited")).alias("other"), anchors(F.col("next_text")).alias("next"),
    )
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
