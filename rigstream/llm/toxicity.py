"""Toxicity: a learned lexicon, met by Levenshtein automata, and scores of the context windows.

Learning finds terms - whole words, or beginnings of words - that stand in toxic documents far more
often than in others. Their trie is intersected with the Levenshtein automaton of each word; the
intersection is kept as a deterministic automaton that grows where words lead, so most words end
after a few letters, and misspelled terms are found with one edit: whole words, also those that a
beginning stands for, and beginnings. What an edit of a beginning, or of a word of SHORT letters, is
worth is learned from the documents in which it stands. Around each occurrence a window
tells quotation from abuse. Four figures per document go into a logistic score: the strongest plain
term, the number of plain terms, the strongest misspelled one, the strongest quoted one.

Learning takes at most ``MAX_ROWS`` labelled documents, whole, in the order of a hash (a documented
bound). Their evidence alone decides which terms are learned. Scoring covers whole texts.

Null and empty texts have no terms and get the score of such a document. Labels that are null are
not learned, of several labels of one id the highest counts, of several texts the smallest. If nothing could be learned, every
score is the share of toxic labels, or 0 without labels. Empty tables stay empty, repeated rows are
scored each, input columns named like a result column are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField

from rigstream.llm.common import map_rows, once
from rigstream.session import materialised

MAX_ROWS = 20_000
#: A term's evidence: G-squared against the share of toxic documents, and toxic documents among its own.
EVIDENCE, PRECISION = 25.0, 0.5
#: Lengths of beginnings that may become terms; letters a whole word needs to be met with an edit.
BEGINNINGS = range(4, 9)
EDIT_WORD = 5
#: A word of so many letters is met with an edit if it is as precise as this.
SHORT, SHORT_PRECISION = 4, 0.95
#: A longer form that stands in so many of a term's toxic documents takes its place.
SPECIFIC = 0.95
#: Characters on either side of an occurrence that are searched for quotation marks.
WINDOW = 80
#: Entries of a counter or of a memory of words, beyond which it is handed on or starts anew.
HELD = 200_000
WORDS = re.compile(r"[^\W_]+")
QUOTES = re.compile("[\"“”„«»]")
FIGURES = ("plain", "plain_terms", "misspelled", "quoted")


@dataclass(frozen=True)
class Term:
    """``whole``: the word ends here; otherwise words that begin so count as well.

    ``edited``: the weight if met with an edit, 0 for never; unless given, that of whole words is ``weight``.
    """

    text: str
    whole: bool
    weight: float
    edited: float | None = None

    @property
    def near(self) -> float:
        if self.edited is not None:
            return self.edited
        return self.weight if self.whole and len(self.text) >= EDIT_WORD else 0.0


class Automaton:
    """Trie of terms times Levenshtein automaton of distance one, determinised as words need it."""

    DEAD = -1

    def __init__(self, terms: list[Term]):
        self.down: list[dict[str, int]] = [{}]
        self.ends: list[list[Term]] = [[]]
        self.editable = [False]
        for term in terms:
            edit = term.near > 0
            node = 0
            self.editable[0] |= edit
            for letter in term.text:
                if letter not in self.down[node]:
                    self.down[node][letter] = len(self.down)
                    self.down.append({})
                    self.ends.append([])
                    self.editable.append(False)
                node = self.down[node][letter]
                self.editable[node] |= edit
            self.ends[node].append(term)
        self._start()

    def _start(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        #: best weight of terms that may end inside a word, and at its end: (without, with an edit)
        self.inside: list[tuple[float, float] | None] = []
        self.final: list[tuple[float, float] | None] = []
        self._state({(0, 0)})

    def _state(self, items: set[tuple[int, int]]) -> int:
        for node, edits in list(items):
            if edits == 0:  # a letter of the term is missing in the word
                items.update((child, 1) for child in self.down[node].values() if self.editable[child])
        held = frozenset(x for x in items if x[1] == 0 or (x[0], 0) not in items)
        if not held:
            return self.DEAD
        if held not in self.states:
            self.states[held] = len(self.sets)
            self.sets.append(held)
            self.moves.append({})
            self.inside.append(self._best(held, whole=False))
            self.final.append(self._best(held, whole=True))
        return self.states[held]

    def _best(self, items: frozenset, whole: bool) -> tuple[float, float] | None:
        best = [0.0, 0.0]
        for node, edits in items:
            for term in self.ends[node]:
                if term.whole == whole:
                    best[edits] = max(best[edits], term.near if edits else term.weight)
        return (best[0], best[1]) if any(best) else None

    def _move(self, state: int, letter: str) -> int:
        items = set()
        for node, edits in self.sets[state]:
            child = self.down[node].get(letter)
            if child is not None:
                items.add((child, edits))
            if edits == 0 and self.editable[node]:
                items.add((node, 1))  # a letter too many
                items.update((other, 1) for other in self.down[node].values() if self.editable[other])
        to = self.moves[state][letter] = self._state(items)
        return to

    def match(self, word: str) -> tuple[float, float] | None:
        """The best weight among terms met as they are, and with one edit; None if there is none."""
        if len(self.sets) > HELD:
            self._start()
        state, plain, edited = 0, 0.0, 0.0
        for letter in word:
            to = self.moves[state].get(letter)
            state = self._move(state, letter) if to is None else to
            if state < 0:
                break
            found = self.inside[state]
            if found:
                plain, edited = max(plain, found[0]), max(edited, found[1])
        else:
            found = self.final[state]
            if found:
                plain, edited = max(plain, found[0]), max(edited, found[1])
        return (plain, edited) if plain or edited else None

    def edited_terms(self, word: str) -> set[Term]:
        """The terms that a word meets with one edit, if it meets none as it is."""
        found = self.match(word)
        if not found or found[0]:
            return set()
        terms, state = set(), 0
        for i, letter in enumerate(word, 1):
            state = self.moves[state][letter]
            if state < 0:
                break
            for node, edits in self.sets[state]:
                if edits:
                    terms.update(t for t in self.ends[node] if t.near > 0 and (not t.whole or i == len(word)))
        return terms


@dataclass
class Model:
    """Terms and the weights of the figures, the constant first."""

    terms: list[Term] = field(default_factory=list)
    weights: list[float] = field(default_factory=lambda: [-30.0, 0.0, 0.0, 0.0, 0.0])


class Reader:
    """The figures of texts under a list of terms."""

    def __init__(self, terms: list[Term]):
        self.automaton = Automaton(terms)
        self.clean: set[str] = set()
        self.hits: dict[str, tuple[float, float]] = {}

    def figures(self, text: str | None) -> tuple[float, float, float, float]:
        low = (text or "").lower()
        words = set(WORDS.findall(low))
        for word in words.difference(self.clean):
            if word not in self.hits:
                found = self.automaton.match(word)
                if found:
                    self.hits[word] = found
                else:
                    self.clean.add(word)
        met = words & self.hits.keys()
        if len(self.clean) + len(self.hits) > HELD:
            hits, self.clean, self.hits = self.hits, set(), {}
        else:
            hits = self.hits
        return self._windows(low, {w: hits[w] for w in met}) if met else (0.0, 0.0, 0.0, 0.0)

    @staticmethod
    def _windows(low: str, met: dict[str, tuple[float, float]]) -> tuple[float, float, float, float]:
        plain = misspelled = quoted = 0.0
        terms = set()
        for found in WORDS.finditer(low):
            hit = met.get(found[0])
            if hit is None:
                continue
            strength, edited = hit
            if in_quotes(low, found.start(), found.end()):
                quoted = max(quoted, strength, edited)
            elif strength:
                plain = max(plain, strength)
                terms.add(found[0])
            else:
                misspelled = max(misspelled, edited)
        return plain, math.log1p(len(terms)), misspelled, quoted


def in_quotes(text: str, begin: int, end: int) -> bool:
    """Whether the window around a word opens a quotation before it and closes it behind."""
    left = text[max(0, begin - WINDOW) : begin]
    right = text[end : end + WINDOW]
    opening = None
    for opening in QUOTES.finditer(left):
        pass
    closing = QUOTES.search(right)
    if opening is None or closing is None:
        return False
    # a mark opens if a space or nothing stands before it, and closes if none does
    opens = opening.start() == 0 or left[opening.start() - 1].isspace()
    closes = closing.start() == 0 or not right[closing.start() - 1].isspace()
    return opens and closes and "\n" not in left[opening.end() :] + right[: closing.start()]


def labelled(docs: DataFrame, labels: DataFrame, most: int = MAX_ROWS) -> DataFrame:
    """``text`` and ``toxic`` of at most ``most`` labelled documents, computed once."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marks = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, 1.2 * most / max(1, marks.count()))
    draw = F.xxhash64("doc_id")
    thin = marks.where(F.pmod(draw, F.lit(1 << 30)) <= F.lit(int(share * (1 << 30))))
    chosen = thin.orderBy(draw, "doc_id").limit(most)
    # not more than `most` rows of two numbers
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # one text for each id, the smallest, so that an id on many rows is one row
    return materialised(found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(counts: dict[str, list[int]]) -> pa.RecordBatch:
        pairs = [counts[t] for t in counts]
        columns = [pa.array(list(counts), pa.string()), *(pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1))]
        return pa.RecordBatch.from_arrays(columns, names=["term", "clean", "toxic"])

    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(WORDS.findall((text or "").lower()))
            # a term that ends with its word is written with a space behind
            terms = {w + " " for w in words if len(w) >= 3}
            terms.update(w[:n] for w in words for n in BEGINNINGS if len(w) >= n)
            side = 1 if toxic else 0
            for term in terms:
                pair = counts.get(term)
                if pair is None:
                    pair = counts[term] = [0, 0]
                pair[side] += 1
            if len(counts) > HELD:
                yield rows(counts)
                counts = {}
    yield rows(counts)


def weigh_edits(rows: DataFrame, terms: list[Term], share: float) -> list[Term]:
    """``terms`` with the weight of their edits, where they name one, learned from ``rows`` (text, toxic).

    The documents that meet a term with an edit alone, and one more as precise as the term, decide; their
    odds are the weight, up to the term's own. Edits that are mostly clean are not met.
    """
    shared = rows.sparkSession.sparkContext.broadcast([(t.text, t.whole, t.weight, t.edited) for t in terms])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = [Term(*t) for t in shared.value]
        places = {t: i for i, t in enumerate(listed)}
        automaton, known = Automaton(listed), {}
        counts = np.zeros((2, len(listed)), np.int64)
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                met: set[int] = set()
                for word in set(WORDS.findall((text or "").lower())):
                    found = known.get(word)
                    if found is None:
                        if len(known) > HELD:
                            known.clear()
                        found = known[word] = tuple(places[t] for t in automaton.edited_terms(word))
                    met.update(found)
                counts[1 if toxic else 0, list(met)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.arange(len(listed)), *counts)], names=["term", "clean", "toxic"])

    counted = rows.mapInArrow(run, "term long, clean long, toxic long").groupBy("term").agg(F.sum("clean"), F.sum("toxic"))
    met = {r[0]: (r[1], r[2]) for r in counted.collect()}
    weighed = []
    for i, term in enumerate(terms):
        if term.edited is not None:
            clean, toxic = met.get(i, (0, 0))
            # of the one document more
            precision = 1 / (1 + math.exp(-term.weight) * (1 - share) / share)
            toxic, clean = toxic + precision, clean + 1 - precision
            odds = math.log(toxic / max(clean, 1e-9) * (1 - share) / share)
            kept = toxic >= PRECISION * (toxic + clean) and odds > 0
            term = replace(term, edited=min(term.weight, odds) if kept else 0.0)
        weighed.append(term)
    return weighed


def learn_terms(rows: DataFrame) -> list[Term]:
    """The terms of ``rows`` (text, toxic) with enough evidence.

    Of a word and its beginnings the longest form that keeps the toxic documents counts; a further one
    only adds a term where it is more precise, or a whole word for its misspellings.
    """
    totals = rows.agg(F.count(F.lit(1)), F.sum(F.col("toxic").cast("long"))).first()
    if not totals[1] or totals[1] == totals[0]:
        return []
    share = totals[1] / totals[0]
    counted = rows.mapInArrow(_count_terms, "term string, clean long, toxic long").groupBy("term")
    k, n = F.col("toxic"), F.col("toxic") + F.col("clean")
    rest = F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (n * F.lit(1 - share)))).otherwise(0.0)
    evidence = 2 * (k * F.log(k / (n * F.lit(share))) + rest)
    sums = counted.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    strong = sums.where((k > 0) & (k >= PRECISION * n) & (evidence >= EVIDENCE))
    found = strong.collect()
    strongest: dict[str, int] = {}
    for row in found:
        for i in range(1, len(row.term)):
            strongest[row.term[:i]] = max(strongest.get(row.term[:i], 0), row.toxic)
    found = [row for row in found if strongest.get(row.term, 0) < SPECIFIC * row.toxic]
    chosen: dict[str, float] = {}
    names = {row.term for row in found}
    terms = []
    for row in sorted(found, key=lambda r: (len(r.term), r.term)):
        precision = row.toxic / (row.toxic + row.clean)
        word = row.term.rstrip()
        shorter = [chosen[word[:i]] for i in range(1, len(word) + 1) if word[:i] in chosen]
        whole, covered = word != row.term, any(p >= precision - 0.02 for p in shorter)
        short = len(word) == SHORT and precision >= SHORT_PRECISION
        if covered and not (whole and (len(word) >= EDIT_WORD or short)):
            continue
        if not whole:
            chosen[word] = precision
        weight = math.log((row.toxic + 0.5) / (row.clean + 0.5) * (1 - share) / share)
        if short and not whole and word + " " not in names:
            terms.append(Term(word, True, weight, weight))
        learned = short if whole else len(word) >= EDIT_WORD
        terms.append(Term(word, whole, weight, weight if learned else None))
    return weigh_edits(rows, terms, share) if any(t.edited for t in terms) else terms


def fit_weights(figures: np.ndarray, toxic: np.ndarray, ridge: float = 0.05) -> list[float]:
    """Logistic regression by Newton steps.

    Weights are held near 1 for the strongest plain and misspelled term, whose figures are log odds,
    and near 0 for the others, so a figure that the rows do not show keeps its meaning.
    """
    x = np.column_stack([np.ones(len(figures)), figures])
    hold = np.diag([1e-6] + [ridge] * figures.shape[1])
    centre = np.array([0.0, 1.0, 0.0, 1.0, 0.0])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (toxic - p) - hold @ (w - centre)
        step = np.linalg.solve((x * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ x + hold, slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return np.round(w, 9).tolist()


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``docs`` (doc_id, text) as far as ``labels`` (doc_id, toxic) name them."""
    rows = labelled(docs, labels)
    terms = learn_terms(rows)
    held = add_figures(rows, terms).select("toxic", *FIGURES).collect()
    if not held:
        return Model()
    held = sorted(map(tuple, held))  # sums of floats in one order, whatever the partitions
    toxic = np.array([r[0] for r in held], float)
    if not terms:
        share = min(max(toxic.mean(), 1e-12), 1 - 1e-12)
        return Model([], [math.log(share / (1 - share)), 0.0, 0.0, 0.0, 0.0])
    return Model(terms, fit_weights(np.array([r[1:] for r in held], float), toxic))


def add_figures(docs: DataFrame, terms: list[Term], text: str = "text") -> DataFrame:
    """Add the four figures of each text."""
    shared = docs.sparkSession.sparkContext.broadcast([(t.text, t.whole, t.weight, t.edited) for t in terms])

    def step(texts: pa.Array) -> list[pa.Array]:
        reader = once(shared, lambda plain: Reader([Term(*t) for t in plain]))
        found = np.array([reader.figures(t) for t in texts.to_pylist()], float).reshape(-1, len(FIGURES))
        return [pa.array(found[:, i]) for i in range(len(FIGURES))]

    return map_rows(docs, [StructField(name, DoubleType()) for name in FIGURES], text, step)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add the figures, ``score`` (0 to 1) and ``predicted`` (1 if the score is at least 0.5)."""
    logit = F.lit(model.weights[0])
    for weight, name in zip(model.weights[1:], FIGURES):
        logit = logit + F.lit(weight) * F.col(name)
    scored = add_figures(docs, model.terms, text).withColumn("score", 1 / (1 + F.exp(-logit)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
