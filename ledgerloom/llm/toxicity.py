"""Toxicity: boosted trees over dense features, calibrated by isotonic regression.

The features are lexicon densities, the distance of lexicon words to the second person, and
the rates of capitals, punctuation and obfuscation. Beside a short fixed lexicon there is one
learned from labelled rows: words far more frequent in toxic than in other documents, counted
by Spark over the bounded sample. Trees learn from folds 1 to 3 of the training rows, the
calibration from fold 4.

Defined results: a null text is scored as an empty one; without usable labels of both kinds the
score is the share of label 1 (0.5 without any label); an empty table gives an empty result;
repeated rows get equal scores; a column named ``score`` is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm import boosting, common, labelled

THRESHOLD = 0.5
TREES = 80
CALIBRATION_FOLD = 4
# A learned word: in at least this share of the toxic documents, with these log-odds.
LEAST_SHARE = 0.02
LEAST_DOCUMENTS = 5
LEAST_LOG_ODDS = 2.5
LEXICON_WORDS = 500
NEAR_WORDS = 6

# Fixed lists: common insults, and the words for "you", in the four languages.
INSULTS = frozenset("""
    idiot idiots stupid moron morons dumb loser losers trash garbage scum clown worthless pathetic
    disgusting filth filthy ugly fool fools jerk creep pig pigs vermin hate kill shut
    dumm idioten arschloch abschaum wertlos widerlich trottel
    imbécile stupide ordure dégoûtant minable crétin
    idiota estúpido estúpida basura asqueroso patético imbécil
""".split())
SECOND_PERSON = frozenset("""
    you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos
    tú ti tus usted ustedes vosotros
""".split())

# Fixed substitutes of letters in disguised words.
_DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "@$*")
_REPEATED = re.compile(r"(.)\1{2,}")
_INSIDE = re.compile(r"[a-z][*@$0-9!._-]+[a-z]")
_BROKEN = re.compile(r"[*._\-]")

FEATURES = [
    "words", "fixed lexicon", "fixed lexicon share", "learned lexicon", "learned lexicon share",
    "sum of log-odds", "largest log-odds", "distinct lexicon words", "second person", "lexicon near second person",
    "least distance", "disguised lexicon words", "disguised words", "stretched words", "capital letters",
    "capital words", "exclamation", "question", "punctuation", "longest mark run", "sentences with lexicon",
]


def plain(word: str) -> str:
    """A lower-cased word without punctuation at its ends."""
    return word.lower().strip(_EDGES)


def undisguised(word: str) -> str:
    """Letters put back for digits and symbols, marks inside and repeats taken out."""
    return _REPEATED.sub(r"\1", _BROKEN.sub("", word.translate(_DISGUISE)))


def _runs(text: str) -> int:
    longest = 0
    for run in re.finditer(r"[!?]+", text):
        longest = max(longest, run.end() - run.start())
    return longest


def features(text: bytes | None, learned: dict[str, float]) -> list[float]:
    """Dense features of one whole text."""
    whole = (text or b"").decode("utf-8", "replace")
    raw = whole.split()
    found = [plain(w) for w in raw]
    n = max(len(found), 1)
    odd = {w for w in set(found) if w and not w.isalpha() and _INSIDE.search(w)}
    stretched = {w for w in set(found) if _REPEATED.search(w)}
    meaning = {w: undisguised(w) for w in odd | stretched}
    weights: dict[str, float] = {}
    hidden = set()
    for w in set(found):
        as_word = w
        if w in meaning and w not in INSULTS and w not in learned:
            as_word = meaning[w]
            if as_word in INSULTS or as_word in learned:
                hidden.add(w)
        if as_word in learned or as_word in INSULTS:
            weights[w] = learned.get(as_word, 0.0)
    at = [i for i, w in enumerate(found) if w in weights]
    persons = np.array([i for i, w in enumerate(found) if w in SECOND_PERSON])
    fixed = sum(1 for i in at if meaning.get(found[i], found[i]) in INSULTS or found[i] in INSULTS)
    gained = [weights[found[i]] for i in at if weights[found[i]] > 0]
    if at and len(persons):
        place = np.searchsorted(persons, at)
        left = np.abs(np.array(at) - persons[np.maximum(place - 1, 0)])
        right = np.abs(persons[np.minimum(place, len(persons) - 1)] - np.array(at))
        distance = np.minimum(left, right)
        near, least = float((distance <= NEAR_WORDS).sum()), float(distance.min())
    else:
        near, least = 0.0, 1000.0
    letters = max(sum(map(str.isalpha, whole)), 1)
    ends = np.cumsum([w[-1] in ".!?" for w in raw]) if raw else np.zeros(0)
    chars = max(len(whole), 1)
    marks = sum(whole.count(c) for c in ".,;:!?\"'()-*#$%&@")
    return [
        float(len(found)), float(fixed), fixed / n, float(len(gained)), len(gained) / n,
        float(sum(gained)), max(gained, default=0.0), float(len(weights)), len(persons) / n, near,
        least, float(sum(1 for i in at if found[i] in hidden)),
        sum(1 for w in found if w in odd) / n, sum(1 for w in found if w in stretched) / n,
        sum(map(str.isupper, whole)) / letters, sum(1 for w in raw if len(w) > 1 and w.isupper()) / n,
        whole.count("!") / chars, whole.count("?") / chars, marks / chars, float(_runs(whole)),
        float(len({int(ends[i]) for i in at})),
    ]


@dataclass
class Model:
    lexicon: dict[str, float]
    forest: boosting.Forest
    calibration: boosting.Isotonic

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        rows = np.array([features(t, self.lexicon) for t in texts])
        return np.clip(self.calibration(self.forest.margin(rows)), 0.0, 1.0)


def learn_lexicon(sampled: DataFrame) -> dict[str, float]:
    """Log-odds of words that occur much more in toxic documents of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, labels = [], []
            for text, label in zip(common.texts_of(batch), batch.column("label").to_pylist()):
                found = {plain(w) for w in (text or b"").decode("utf-8", "replace").split()} - {""}
                words += found
                labels += [label] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(labels, pa.int32())],
                                             names=["word", "label"])

    totals = sampled.groupBy("label").count().collect()
    size = {r["label"]: r["count"] for r in totals}
    toxic, other = size.get(1, 0), size.get(0, 0)
    if not toxic or not other:
        return {}
    counts = common.map_batches(sampled.select("text", "label"), run, "word string, label int").groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("other") + 0.5) / (other + 1.0))
    rows = counts.withColumn("odds", odds).where(
        (F.col("toxic") >= max(LEAST_DOCUMENTS, LEAST_SHARE * toxic)) & (F.col("odds") >= LEAST_LOG_ODDS)
    ).orderBy(F.desc("toxic"), "word").limit(LEXICON_WORDS).collect()
    return {r.word: float(r.odds) for r in rows}


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic",
          sample_rows: int = labelled.SAMPLE_ROWS, trees: int = TREES) -> Model:
    """Lexicon, trees and calibration from a bounded sample of labelled training rows."""
    sample = labelled.training_sample(labels, label, sample_rows)
    sampled = common.staged(labelled.sampled_documents(docs, sample), "toxicity-sample")
    for_trees = sampled.where(F.col("fold") != CALIBRATION_FOLD)
    lexicon = learn_lexicon(for_trees)
    rows = labelled.feature_rows(sampled, lambda text: features(text, lexicon))
    x, y, folds = labelled.collected(rows, len(FEATURES))
    fitting = folds != CALIBRATION_FOLD
    forest = boosting.fit(x[fitting], y[fitting], trees=trees)
    held = ~fitting
    calibrated = boosting.isotonic(forest.margin(x[held]), y[held]) if len(np.unique(y[held])) == 2 else \
        boosting.isotonic(np.zeros(0), np.zeros(0))
    return Model(lexicon, forest, calibrated)


def scored(docs: DataFrame, labels: DataFrame, *, score: str = "score", **options) -> DataFrame:
    """``docs`` with a column ``score``: the calibrated probability that a document is toxic."""
    common.configure(docs.sparkSession)
    return labelled.scored(docs, train(docs, labels, **options), score)


def without_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents that score below the threshold, columns unchanged."""
    score = "_toxicity"
    while score in docs.columns:
        score += "_"
    return scored(docs, labels, score=score, **options).where(F.col(score) < threshold).drop(score)
