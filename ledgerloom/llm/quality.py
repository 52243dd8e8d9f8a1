"""Quality classifier: boosted trees over statistics of whole documents.

Defined results: a null text is scored as an empty one; without usable labels of both kinds the
score is the share of label 1 (0.5 without any label); an empty table gives an empty result;
repeated rows get equal scores; a column named ``score`` is replaced.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from ledgerloom.llm import boosting, common, labelled

THRESHOLD = 0.3
TREES = 120

# Fixed ASCII classes of the byte counts.
_SPACE = np.array([9, 10, 11, 12, 13, 32])
_UPPER, _LOWER, _DIGIT = np.arange(65, 91), np.arange(97, 123), np.arange(48, 58)
_STOPS = np.array([ord(c) for c in ".,;:?"])
_MARKS = np.array([ord(c) for c in "#$%&*+/<=>@\\^_`|~"])
_OTHER = np.array([ord(c) for c in "!\"'()-[]{}"])

FEATURES = [
    "bytes", "words", "word length", "word length deviation", "longest word", "one-letter words",
    "long words", "distinct words", "most frequent word", "repeated neighbours", "distinct pairs",
    "lines", "distinct lines", "line length", "short lines", "upper case", "digits", "space", "stops",
    "marks", "other punctuation", "exclamation", "bars", "non-ASCII", "control", "entropy",
    "capital words", "words ending in marks", "compression", "sentence length",
]


def features(text: bytes | None) -> list[float]:
    """Statistics of one whole text."""
    text = text or b""
    found = text.split()
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, n_words = max(len(text), 1), max(len(found), 1)
    lengths = np.fromiter(map(len, found), np.int64, len(found)) if found else np.zeros(1, dtype=np.int64)
    common_words = Counter(found)
    lines = [line for line in text.split(b"\n") if line.strip()]
    n_lines = max(len(lines), 1)
    upper = int(counts[_UPPER].sum())
    letters = max(upper + int(counts[_LOWER].sum()), 1)
    share = counts[counts > 0] / n
    stops = int(counts[46] + counts[33] + counts[63])
    ends = Counter(w[-1] for w in found)
    return [
        float(len(text)), float(len(found)), float(lengths.mean()), float(lengths.std()), float(lengths.max()),
        float((lengths == 1).sum()) / n_words, float((lengths > 14).sum()) / n_words,
        len(common_words) / n_words, max(common_words.values(), default=0) / n_words,
        sum(map(eq, found, found[1:])) / n_words,
        len(set(zip(found, found[1:]))) / max(len(found) - 1, 1),
        float(len(lines)), len(set(lines)) / n_lines, len(text) / n_lines,
        sum(len(line) < 30 for line in lines) / n_lines,
        upper / letters, int(counts[_DIGIT].sum()) / n, int(counts[_SPACE].sum()) / n,
        int(counts[_STOPS].sum()) / n, int(counts[_MARKS].sum()) / n, int(counts[_OTHER].sum()) / n,
        int(counts[33]) / n, int(counts[124]) / n, int(counts[128:].sum()) / n,
        (int(counts[:9].sum()) + int(counts[14:32].sum()) + int(counts[127])) / n,
        float(-(share * np.log2(share)).sum()),
        sum(w[:1].isupper() for w in common_words) / max(len(common_words), 1),
        sum(c for b, c in ends.items() if b in b"#$%&*+/<=>@\\^_`|~!") / n_words,
        len(zstandard.compress(text, 1)) / n, len(found) / (stops + 1),
    ]


@dataclass
class Model:
    forest: boosting.Forest

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return self.forest.probability(np.array([features(t) for t in texts]))


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality",
          sample_rows: int = labelled.SAMPLE_ROWS, trees: int = TREES) -> Model:
    """Fit on a bounded sample of labelled training rows."""
    sample = labelled.training_sample(labels, label, sample_rows)
    x, y, _ = labelled.collected(
        labelled.feature_rows(labelled.sampled_documents(docs, sample), features), len(FEATURES))
    return Model(boosting.fit(x, y, trees=trees))


def scored(docs: DataFrame, labels: DataFrame, *, score: str = "score", **options) -> DataFrame:
    """``docs`` with a column ``score``: the probability of label 1."""
    common.configure(docs.sparkSession)
    return labelled.scored(docs, train(docs, labels, **options), score)
