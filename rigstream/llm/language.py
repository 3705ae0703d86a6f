"""Language identification by prediction by partial matching.

Each language has a byte context tree of variable order, learned once and then frozen. In a
context with n symbols of d kinds, a symbol seen c times costs -log2(c / (n + d)) bits; any other
costs the escape, -log2(d / (n + d)), and what it costs in the context one byte shorter; below the
empty context a byte costs 8 bits. The language with the shortest code for the whole text wins.
With frozen statistics the cost depends on the last ``ORDER`` bytes alone, so the trees become one
table of costs, in 1/256 bit, and a text's code length is a sum of whole numbers.

Learning takes documents in the order of a hash, per language until ``SAMPLE_BYTES`` are reached, and not
more than ``TOTAL_BYTES`` of all languages, which share them evenly; the document that reaches the bound is taken up to
it. Every language is learned, however many there are. The table of costs takes ``TABLE_BYTES``; with many
languages the rarest contexts give way to those one byte shorter. These are documented bounds of
the model; scoring covers everything.

A text that is null or has no letter is ``und`` with score 0, and so is every text when no language
was learned. Equal code lengths: the language first in alphabet wins. Empty tables stay empty,
repeated rows are judged each, input columns named like a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from rigstream.llm.common import map_rows, measured, once
from rigstream.session import materialised

ORDER = 3
SAMPLE_BYTES = 1_000_000
TOTAL_BYTES = 64_000_000
#: Contexts seen less often are left to shorter ones.
LEAST = 3
#: Bytes of the table of costs; rarer contexts give way beyond it.
TABLE_BYTES = 48_000_000
UNIT = 256
UNDECIDED = "und"
#: A code may be so many bits longer than the plain bytes; short clean texts stay below.
SLACK = 64


def sample(docs: DataFrame, lang: str = "lang", text: str = "text", budget: int = SAMPLE_BYTES) -> dict[str, list[bytes]]:
    """Texts of each language, to the driver: at most ``budget`` bytes each, and TOTAL_BYTES together."""
    size = F.octet_length(text)
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    draw = F.pmod(F.xxhash64(F.col(text), F.col(lang)), F.lit(1 << 30))
    totals = known.where(size > 0).groupBy(lang).agg(F.sum(size).alias("_bytes"), F.min(draw).alias("_first"))
    totals = materialised(totals)
    count = totals.count()
    if not count:
        return {}
    budget = max(1, min(budget, TOTAL_BYTES // count))
    # twice the share that the budget needs, so that the ordered part below is small for any input; one text at least
    most = F.greatest(F.least(F.lit(1.0), 2 * budget / F.col("_bytes") + 1e-9) * (1 << 30), F.col("_first"))
    chances = measured(totals.select(lang, most.alias("_most")))
    thin = known.select(lang, text).where(size > 0).join(chances, lang).where(draw <= F.col("_most"))
    before = Window.partitionBy(lang).orderBy(draw, text).rowsBetween(Window.unboundedPreceding, -1)
    rows = thin.withColumn("_before", F.coalesce(F.sum(size).over(before), F.lit(0))).where(F.col("_before") < budget)
    texts: dict[str, list[bytes]] = {}
    part = F.substring(F.col(text).cast("binary"), F.lit(1), (F.lit(budget) - F.col("_before")).cast("int"))
    for row in rows.select(lang, part.alias("data")).collect():
        texts.setdefault(row[lang], []).append(bytes(row.data))
    return texts


@dataclass
class Model:
    """Costs by context and next symbol; symbol 0 stands before a text, the last for unseen bytes."""

    languages: list[str]
    symbols: np.ndarray
    kinds: int
    contexts: np.ndarray
    costs: np.ndarray

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code lengths, texts by languages, in 1/UNIT bit."""
        pad = b"\0" * ORDER
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(pad.join([b"", *texts]), np.uint8)
        begin = np.cumsum(sizes + ORDER) - sizes
        coded = self.symbols[data]
        for k in range(1, ORDER + 1):
            coded[begin - k] = 0
        context = np.zeros(len(coded) - ORDER, np.int64)
        for k in range(ORDER):
            context = context * self.kinds + coded[k : k + len(context)]
        rows = self.contexts[context].astype(np.int64) * self.kinds + coded[ORDER:]
        bits = np.zeros((len(texts), len(self.languages)), np.int64)
        full = np.nonzero(sizes)[0]
        if len(full):
            per_byte = self.costs[rows]
            bounds = np.stack([begin[full] - ORDER, begin[full] - ORDER + sizes[full]], 1).ravel()
            # a last bound at the end of the data is left out, as reduceat runs to the end by itself
            bounds = bounds[:-1] if bounds[-1] == len(per_byte) else bounds
            bits[full] = np.add.reduceat(per_byte, bounds, axis=0, dtype=np.int64)[::2]
        return bits

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, the probability of its code against the others', and the bits of its code."""
        data = [(t or "").encode("utf-8") for t in texts]
        lettered = [bool(self.languages) and any(map(str.isalpha, t or "")) for t in texts]
        if not any(lettered):
            return [UNDECIDED] * len(texts), [0.0] * len(texts), [8.0 * len(d) for d in data]
        bits = self.lengths(data)
        best = bits.argmin(1)
        least = bits.min(1)
        chance = 1 / np.exp2(np.maximum(-1000.0, (least[:, None] - bits) / UNIT)).sum(1)
        names = [self.languages[b] if ok else UNDECIDED for b, ok in zip(best.tolist(), lettered)]
        return names, np.where(lettered, chance, 0.0).tolist(), (least / UNIT).tolist()


def learn(texts: dict[str, list[bytes]]) -> Model:
    """The frozen model of some texts per language."""
    languages = sorted(texts)
    if not languages:
        return Model([], np.zeros(256, np.int64), 1, np.zeros(1, np.int32), np.zeros((1, 0), np.uint16))
    seen = np.zeros(256, bool)
    for found in texts.values():
        seen[np.unique(np.frombuffer(b"".join(found), np.uint8))] = True
    kinds = int(seen.sum()) + 2
    symbols = np.full(256, kinds - 1, np.int64)
    symbols[seen] = np.arange(1, kinds - 1)
    counts = []
    for name in languages:
        pad = b"\0" * ORDER
        data = np.frombuffer(pad.join([b"", *texts[name]]), np.uint8)
        coded = symbols[data]
        begin = np.cumsum([len(t) + ORDER for t in texts[name]]) - [len(t) for t in texts[name]]
        real = np.ones(len(coded), bool)
        for k in range(1, ORDER + 1):
            coded[begin - k] = 0
            real[begin - k] = False
        grams = {}
        for order in range(ORDER + 1):
            code = np.zeros(len(coded) - ORDER, np.int64)
            for k in range(ORDER - order, ORDER + 1):
                code = code * kinds + coded[k : k + len(code)]
            grams[order] = np.unique(code[real[ORDER:]], return_counts=True)
        counts.append(grams)
    dense = np.full((1, kinds, len(languages)), 8.0)
    places = np.zeros(1, np.int64)
    for order in range(ORDER + 1):
        # the contexts of this order that any language has seen often enough, most often seen first
        codes, sums = np.unique(np.concatenate([g[order][0] // kinds for g in counts]), return_inverse=True)
        often = np.bincount(sums, np.concatenate([g[order][1] for g in counts]), len(codes)) if len(codes) else np.zeros(0)
        most = TABLE_BYTES // (2 * kinds * max(1, len(languages)))
        keep = np.argsort(-often, kind="stable")[:most]
        kept = np.sort(codes[keep][often[keep] >= LEAST])
        shorter = places[kept % max(1, kinds ** (order - 1))] if order else np.zeros(len(kept), np.int64)
        table = dense[shorter].copy()
        for lang, grams in enumerate(counts):
            code, n = grams[order]
            at = np.searchsorted(kept, code // kinds)
            inside = (at < len(kept)) & (kept[np.minimum(at, len(kept) - 1)] == code // kinds) if len(kept) else np.zeros(len(code), bool)
            at, symbol, n = at[inside], code[inside] % kinds, n[inside]
            total = np.bincount(at, n, len(kept))
            distinct = np.bincount(at, minlength=len(kept))
            known = total > 0
            table[known, :, lang] += -np.log2(distinct[known] / (total + distinct)[known])[:, None]
            table[at, symbol, lang] = -np.log2(n / (total + distinct)[at])
        # contexts left out point to the row of the context one byte shorter
        if order == 0:
            places, dense = np.zeros(1, np.int64), (table if len(kept) else dense)
        else:
            places = np.tile(places, kinds) if order > 1 else np.zeros(kinds, np.int64)
            places[kept] = len(dense) + np.arange(len(kept))
            dense = np.concatenate([dense, table])
    costs = np.minimum(np.round(dense * UNIT), 65_535).astype(np.uint16).reshape(-1, len(languages))
    return Model(languages, symbols, kinds, places.astype(np.int32), costs)


def fit(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Learn from the rows of ``docs``, whose languages are in ``lang``."""
    return learn(sample(docs, lang, text))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``code_bits``, the length of the winning code."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def step(texts: pa.Array) -> list[pa.Array]:
        names, chances, bits = once(shared, lambda parts: Model(**parts)).predict(texts.to_pylist())
        return [pa.array(names, pa.string()), pa.array(chances, pa.float64()), pa.array(bits, pa.float64())]

    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("code_bits", DoubleType())]
    return map_rows(docs, fields, text, step)


def recognised(text: str = "text") -> Column:
    """Rows of ``identify`` whose language is known: no more than SLACK bits are saved by plain bytes."""
    return (F.col("lang_pred") != UNDECIDED) & (F.col("code_bits") - 8 * F.octet_length(text) <= SLACK)
