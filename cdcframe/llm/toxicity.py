"""Toxicity by a weighted lexicon.

The lexicon holds the words, and the stems that words begin with, which labelled toxic texts have far more often than
clean ones, each with its log-odds. An Aho-Corasick automaton finds them in texts whose letters are folded (case, look-alike letters of other scripts) and once
more with digits and signs read as the letters they stand for. A word inside an exception phrase does not count. The sum
of weights, and the sum for the length of the text, give a score by logistic calibration.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcframe.llm.fitting import class_weights, labelled_sample, logistic, probability

#: What is learnt from at most: ids of each class.
SAMPLE_PER_CLASS = 5000
#: A lexicon entry stands in at least so many texts and this share of the toxic sample, and has at least these log-odds.
MIN_TEXTS, MIN_SHARE, MIN_LOG_ODDS = 6, 0.005, 3.0
#: Letters of a stem.
STEM_LETTERS = (4, 8)
THRESHOLD = 0.3

#: Letters of other scripts that look like Latin ones, and digits and signs written for letters.
HOMOGLYPHS = dict(zip("аеорсухіјѕԁһкмтвнѵԛԝαεορτυνικχγωßàáâãäåçèéêëìíîïñòóôõöùúûüýÿāēīōū", "aeopcyxijsdhkmtbhvqwaeoptuvikxywbaaaaaaceeeeiiiinooooouuuuyyaeiou"))
DIGITS = dict(zip("0134578@$!|", "oieastbasil"))
#: Phrases in which a word of the lexicon is harmless.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "clown car", "pond scum", "stupid question", "sore loser")

_HOMOGLYPHS, _DIGITS = str.maketrans(HOMOGLYPHS), str.maketrans(DIGITS)
_SUBSTITUTED = re.compile(r"[0134578@$!|]")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class ToxicityModel:
    """The lexicon has words, and stems with a star at their end."""

    lexicon: dict[str, float]
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros(3))
    exceptions: tuple[str, ...] = EXCEPTIONS


def fold(text: str) -> str:
    """Lower case, look-alike letters as Latin ones. One character for each of the lower-cased text."""
    return text.lower().translate(_HOMOGLYPHS)


class Matcher:
    """Finds the words of a lexicon, outside exception phrases."""

    def __init__(self, lexicon: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.automaton = ahocorasick.Automaton()
        for word, weight in lexicon.items():
            plain = word.removesuffix("*")
            self.automaton.add_word(fold(plain), (len(plain), weight, plain != word))
        for phrase in exceptions:
            self.automaton.add_word(fold(phrase), (len(phrase), None, False))
        self.empty = not lexicon
        if not self.empty:
            self.automaton.make_automaton()

    def _hits(self, text: str) -> Iterator[tuple[int, int, float | None]]:
        size = len(text)
        for last, (length, weight, stem) in self.automaton.iter(text):
            start, end = last + 1 - length, last + 1
            if (start == 0 or not text[start - 1].isalnum()) and (stem or end == size or not text[end].isalnum()):
                yield start, end, weight

    def find(self, text: str) -> list[tuple[int, int, float]]:
        """Start and end in the folded text, and the weight, of all that count."""
        if self.empty:
            return []
        folded = fold(text)
        hits = set(self._hits(folded))
        if _SUBSTITUTED.search(folded):
            hits |= set(self._hits(folded.translate(_DIGITS)))
        harmless = [(a, b) for a, b, weight in hits if weight is None]
        found = [hit for hit in hits if hit[2] is not None]
        if harmless:
            inside = {a: max(y for x, y in harmless if x == a) for a, _ in harmless}
            starts = sorted(inside)
            reach = np.maximum.accumulate([inside[a] for a in starts])
            place = np.searchsorted(starts, [hit[0] for hit in found], side="right") - 1
            found = [hit for hit, k in zip(found, place) if k < 0 or reach[k] < hit[1]]
        return sorted(found)

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Per text: log of the weights found, and log of the weights for each hundred words."""
        out = np.zeros((len(texts), 2))
        for row, text in enumerate(texts):
            if text and (found := self.find(text)):
                total = sum(weight for _, _, weight in found)
                out[row] = np.log1p(total), np.log1p(100 * total / max(1, len(text.split())))
        return out


def _entries(text: str) -> set[str]:
    """The folded words of a text, and the stems they begin with."""
    words = set(_WORD.findall(fold(text)))
    low, high = STEM_LETTERS
    return words | {f"{word[:n]}*" for word in words for n in range(low, min(high, len(word) - 1) + 1)}


def _lexicon(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Of entries with their texts and weights, those that say most: a stem only if it has clearly more texts than any
    longer entry that it begins, and nothing that begins with a stem kept."""
    longer: dict[str, int] = {}
    for entry, (texts, _) in found.items():
        plain = entry.removesuffix("*")
        for n in range(STEM_LETTERS[0], len(plain) + (plain == entry)):
            stem = f"{plain[:n]}*"
            longer[stem] = max(longer.get(stem, 0), texts)
    kept: dict[str, float] = {}
    for entry in sorted(found, key=lambda e: (len(e), e)):
        texts, weight = found[entry]
        plain = entry.removesuffix("*")
        covered = any(f"{plain[:n]}*" in kept for n in range(STEM_LETTERS[0], len(plain) + 1))
        if not covered and (plain == entry or texts > 1.25 * longer.get(entry, 0)):
            kept[entry] = weight
    return kept


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_class: int = SAMPLE_PER_CLASS,
) -> ToxicityModel:
    """A model from labelled rows for which `learn` holds. Without labels every score is 0.5, with one class near its value."""
    sample, counts = labelled_sample(docs.select(id, text), labels, label, learn, per_class, id)
    sample = sample.select("label", "slot", F.col(text).alias("text"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(y, w) for y, t in zip(*(c.to_pylist() for c in batch.columns)) for w in _entries(t or "")]
            columns = [pa.array([y for y, _ in found], pa.int32()), pa.array([w for _, w in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "word"])

    dictionary = sample.filter(F.col("slot") % 2 == 0)
    sizes = {row["label"]: row["count"] for row in dictionary.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    odds = F.log((F.col("ones") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("zeros") + 0.5) / F.lit(clean + 1.0))
    counted = dictionary.select("label", "text").mapInArrow(words, "label int, word string").groupBy("word")
    frequent = (
        counted.agg(F.sum("label").alias("ones"), F.sum(1 - F.col("label")).alias("zeros"))
        .filter(F.col("ones") >= max(MIN_TEXTS, MIN_SHARE * toxic))
        .select("word", "ones", odds.alias("weight"))
        .filter(F.col("weight") >= MIN_LOG_ODDS)
        .collect()  # of a bounded sample
    )
    lexicon = _lexicon({row["word"]: (row["ones"], row["weight"]) for row in frequent}) if clean else {}
    model = ToxicityModel(lexicon)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.lexicon, model.exceptions)
        for batch in batches:
            found = matcher.features(batch.column(1).to_pylist())
            columns = [batch.column(0), pa.array(found[:, 0]), pa.array(found[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "total", "density"])

    rest = sample.filter(F.col("slot") % 2 == 1).select("label", "text")
    measured = rest.mapInArrow(measure, "label int, total double, density double").collect()
    table = np.array(sorted(map(tuple, measured)), float).reshape(-1, 3)
    known = table[:, 0].astype(int)
    model.coefficients = logistic(table[:, 1:], known, class_weights(known, counts))
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and `score` (0 to 1) of every row, whole texts. NULL counts as an empty text. Other columns are not carried."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.lexicon, model.exceptions)
        for batch in batches:
            scores = pa.array(probability(model.coefficients, matcher.features(batch.column(1).to_pylist())))
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=[id, "score"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(score, f"`{id}` {kind}, score double")
