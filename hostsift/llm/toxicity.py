"""Toxicity: a lexicon trie intersected with Levenshtein automata, and context windows.

The lexicon is a short list of well-known terms, joined by words and word stems that
training rows of the toxic class hold and other training rows do not.  The trie of
terms and the automaton "within the term's edits of the word" run as one machine whose
states are sets of (trie node, edits used).  States and transitions are made when first
needed and kept, so a word costs one look-up a letter and most words reach the dead
state after a few letters.  Edits count at every letter, the first included; a term of 5 to 7 letters allows
one edit, a longer one two (learned ones one from 7 letters), a shorter one none; a
stem accepts any ending; look-alike digits and signs are read as letters.

A hit is weighed by the window of tokens around it: quotation marks and reporting
words speak for quotation, second-person words for abuse.  The counts of hits by kind
and context are the inputs of a logistic model.  Lexicon and model are fitted on
separate parts of a bounded sample (``sample_rows``) of labelled rows outside the
held-out fold; scoring covers every whole text.

Nulls and odd input: a null text counts as empty and gets the score of no hits; rows
with a null id are scored and count as held out; null labels are ignored, of
conflicting labels of one id the larger holds; without labels of both classes a fixed
prior weighting is used; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RecentCache, Scratch, held_out
from .quality import fit_logistic, labelled_sample, sigmoid

# Abusive terms, ordinary words that stand within an edit of one, look-alike
# signs, and the words that mark a report or an address.
TERMS = """bastard clown coward cretin degenerate disgusting dumbass dumb filth garbage hideous idiot
imbecile jerk liar loser lunatic moron parasite pathetic retard scum stupid trash ugly vermin worthless""".split()
ORDINARY = """brash bustard class closer clowns coined costard crash crown custard flown filthy idiom
idiots lair lose loses loser's losers lower lowers mason moray motor poser rash roser scam slum seum
stupor studio thrash toser trashy moral maron marron sputid sumo
toward towards howard blown boron dastard empathetic apathetic regenerate regenerated generate""".split()
PLAIN_FORMS = {"clowns", "idiots", "losers", "trashy", "filthy", "loser's"}
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"})
REPORTING = frozenset("said says say called calls call wrote writes quoted quotes quote reported reports told tells according shouted stated claimed word term".split())
ADDRESS = frozenset("you your you're youre u ur yourself are they their all".split())
QUOTES = "\"“”«»„"
WINDOW = 8
DEAD = 0


FIXED, LEARNED, STEM, ONE_EDIT, TWO_EDITS = 1, 2, 3, 4, 5


class FuzzyLexicon:
    """The trie and the automata as one machine, made deterministic as words need it."""

    def __init__(self, terms: list[str], learned: list[str] = (), stems: list[str] = (), limit: int = 50_000):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[tuple[int, int] | None] = [None]
        self.reach = [0]
        self.limit = limit
        for term in terms:
            self._add(term, FIXED, 0 if len(term) < 5 else 1 if len(term) < 8 else 2)
        for term in learned:
            self._add(term, LEARNED, 0 if len(term) < 7 else 1)
        for term in stems:
            self._add(term, STEM, 0)
        self._reset()

    def _add(self, term: str, kind: int, edits: int) -> None:
        node = 0
        for letter in term:
            if letter not in self.children[node]:
                self.children[node][letter] = len(self.children)
                self.children.append({})
                self.ends.append(None)
                self.reach.append(0)
            node = self.children[node][letter]
            self.reach[node] = max(self.reach[node], edits)
        self.reach[0] = max(self.reach[0], edits)
        if self.ends[node] is None:
            self.ends[node] = (kind, edits)

    def _reset(self) -> None:
        self.sets: list[frozenset] = [frozenset()]
        self.number = {self.sets[0]: DEAD}
        self.moves: dict[tuple[int, str], int] = {}
        self.accepts = [0]
        self.stem = [False]
        self.start = self._state({0: 0})

    def _state(self, low: dict[int, int]) -> int:
        """The number of a state: least edits by node, letters of the term left out taken in."""
        todo = list(low)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                e = low[node] + 1
                if e <= self.reach[child] and e < low.get(child, 99):
                    low[child] = e
                    todo.append(child)
        key = frozenset(low.items())
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key)
            kinds = []
            for node, e in key:
                if self.ends[node] and e <= self.ends[node][1]:
                    kinds.append(self.ends[node][0] if e == 0 else ONE_EDIT if e == 1 else TWO_EDITS)
            self.accepts.append(min(kinds, default=0))
            self.stem.append(STEM in kinds)
        return self.number[key]

    def _move(self, state: int, letter: str) -> int:
        low: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.reach[node] and e < low.get(node, 99):
                low[node] = e

        for node, e in self.sets[state]:
            put(node, e + 1)
            for c, child in self.children[node].items():
                put(child, e if c == letter else e + 1)
        return self._state(low) if low else DEAD

    def find(self, word: str) -> int:
        """Kind of the best term that the word is or misspells; 0 for none."""
        if len(self.sets) > self.limit:
            self._reset()
        state, stem = self.start, 0
        for letter in word:
            key = (state, letter)
            nxt = self.moves.get(key)
            if nxt is None:
                nxt = self.moves[key] = self._move(state, letter)
            if self.stem[nxt]:
                stem = STEM
            if nxt == DEAD:
                return stem
            state = nxt
        found = self.accepts[state]
        return min(found, stem) if found and stem else found or stem


_WORDS = re.compile(r"[^\W_]+")


class HitFinder(RecentCache):
    """White-space token -> kind of hit (0: none)."""

    def __init__(self, learned: list[str] = (), stems: list[str] = ()):
        super().__init__()
        self.lexicon = FuzzyLexicon(TERMS, learned, stems)
        self.ordinary = frozenset(ORDINARY) - PLAIN_FORMS

    def make(self, chunk: str) -> int:
        low = chunk.lower()
        words = _WORDS.findall(low)
        found = [self._kind(w) for w in words]
        if not any(found):
            if len(words) > 1 and max(map(len, words)) == 1:  # l.o.s.e.r
                found.append(self._kind("".join(words), ONE_EDIT))
            alike = low.translate(LOOKALIKE)
            if alike != low:
                forms = set(_WORDS.findall(alike.rstrip("i")) + _WORDS.findall(alike)) - set(words)
                found += [self._kind(w, ONE_EDIT) for w in forms]
        return min((f for f in found if f), default=0)

    def _kind(self, word: str, least: int = 0) -> int:
        if word in self.ordinary:
            return 0
        if word in PLAIN_FORMS:
            return FIXED
        hit = self.lexicon.find(word)
        return max(hit, least) if hit else 0

    def features(self, text: str | None) -> np.ndarray:
        """log(1 + count) of hits by kind, each plain and quoted; addressed; plain; plain hits in 100 tokens."""
        tokens = (text or "").split()
        codes = list(map(self.__getitem__, tokens))
        counts = np.zeros(COLUMNS)
        if not any(codes):
            return counts
        # Quotation marks up to each token, for spans that open and close around a hit.
        marks = np.concatenate([[0], np.cumsum([sum(map(t.count, QUOTES)) for t in tokens])])
        for at, code in enumerate(codes):
            if not code:
                continue
            low, high = max(0, at - WINDOW), min(len(tokens), at + WINDOW + 1)
            before, own, after = marks[at] - marks[low], marks[at + 1] - marks[at], marks[high] - marks[at + 1]
            near = {t.lower().strip(".,;:!?()'") for t in tokens[low:high]}
            quoted = own >= 2 or (before + own >= 1 and after + own >= 1 and before + own + after >= 2) or bool(near & REPORTING)
            counts[(code - 1) * 2 + quoted] += 1
            counts[10] += bool(near & ADDRESS) and not quoted
        counts[11] = counts[0:10:2].sum()
        counts[12] = counts[11] / len(tokens) * 100
        return np.log1p(counts)


COLUMNS = 13
_finders: dict[tuple, HitFinder] = {}


def finder(learned: list[str] = (), stems: list[str] = ()) -> HitFinder:
    """The worker's machine for this lexicon, kept from task to task."""
    key = (tuple(learned), tuple(stems))
    if key not in _finders:
        _finders.clear()
        _finders[key] = HitFinder(*key)
    return _finders[key]


#: Used where labels of both classes are missing: plain exact hits decide.
PRIOR = np.array([3.0, 0.3, 2.0, 0.2, 1.0, 0.1, 1.5, 0.1, 0.7, 0.1, 0.5, 0.0, 0.0, -2.0])


def learn_terms(sample: DataFrame, least: int = 5, ratio: float = 50.0, most: int = 3000) -> tuple[list[str], list[str]]:
    """Words and stems (first 5 letters, over several words) of the toxic class in a bounded sample.

    A text counts once, so copies prove nothing; ``most`` bounds what the driver receives.
    """
    texts = sample.groupBy("text").agg(F.max("y").alias("y"))
    words = texts.select(
        "y", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}]{4,40})"), F.lit(1)))).alias("word")
    )
    totals = texts.agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).first()
    share = ((F.col("pos") + 0.5) / float((totals["p"] or 0) + 1)) / ((F.col("neg") + 0.5) / float((totals["n"] or 0) + 1))
    pos, neg = F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")
    kept = (
        words.groupBy("word").agg(pos, neg).filter((F.col("pos") >= least) & (share >= ratio))
        .orderBy(F.desc("pos"), "word").limit(most)
    )
    learned = [r["word"] for r in kept.collect()]
    stem = words.filter(F.length("word") > 5).select(F.substring("word", 1, 5).alias("stem"), "word", "y")
    stems = (
        stem.groupBy("stem").agg(pos, neg, F.approx_count_distinct("word").alias("words"))
        .filter((F.col("pos") >= 4 * least) & (F.col("words") >= 4) & (share >= 4 * ratio))
        .orderBy(F.desc("pos"), "stem").limit(most // 10)
    )
    return sorted(set(learned) - set(TERMS)), sorted(r["stem"] for r in stems.collect())


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample_rows: int = 20_000
) -> tuple[list[str], list[str], np.ndarray]:
    """Learned words, stems and the model's coefficients; two thirds of the sample give the lexicon, one third the model."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = scratch.save(labelled_sample(docs, labels, label_col, sample_rows), "sample")
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3))
    learned, stems = learn_terms(sample.filter(part > 0))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [finder(learned, stems).features(t).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "x": made, "y": batch["y"]})

    rows = sample.filter(part == 0).mapInPandas(pack, "doc_id long, x binary, y int").toPandas().sort_values("doc_id")
    scratch.close()
    y = rows["y"].to_numpy(float)
    if len(set(y.tolist())) < 2:
        return learned, stems, PRIOR
    return learned, stems, fit_logistic(np.stack([np.frombuffer(x, np.float64) for x in rows["x"]]), y, ridge=0.3)


def classify_toxicity(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", threshold: float = 0.5, sample_rows: int = 20_000
) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted, n_hits."""
    learned, stems, coef = fit_toxicity(docs, labels, label_col, sample_rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [finder(learned, stems).features(t.as_py()) for t in batch["text"]]
            x = np.stack(made) if made else np.zeros((0, COLUMNS))
            hits = np.rint(np.expm1(x[:, :10]).sum(1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sigmoid(x @ coef[:-1] + coef[-1])), pa.array(hits)], ["doc_id", "score", "n_hits"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double, n_hits long")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "n_hits",
    )
