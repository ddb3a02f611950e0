"""Language identification, words first.

A known word scores by its log frequency in each language. A word never seen scores by its character n-grams: the longest
length of which any n-gram is known, then shorter ones.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcframe.llm.fitting import draw

#: What is learnt from at most: documents of each language.
SAMPLE_PER_LANGUAGE = 2000
GRAM_LENGTHS = (5, 4, 3, 2, 1)
#: Scores of unseen words that a task remembers before it starts anew.
MEMO = 200_000
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class LanguageModel:
    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    #: By length of n-gram.
    grams: dict[int, dict[str, int]]
    gram_scores: dict[int, np.ndarray]


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def grams_of(word: str, length: int) -> list[str]:
    padded = f" {word} " if length > 1 else word
    return [padded[i : i + length] for i in range(len(padded) - length + 1)]


def _scores(counts: pa.Table, languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """The row of each entry, and there the log share of each language, of frequencies smoothed by half an occurrence."""
    encoded = counts["entry"].combine_chunks().dictionary_encode()
    names = encoded.dictionary.to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    table = np.full((len(names), len(languages)), 0.5)
    columns = pc.index_in(counts["lang"], pa.array(languages, pa.string())).to_numpy()
    np.add.at(table, (place[encoded.indices.to_numpy()], columns), counts["n"].to_numpy())
    table /= np.maximum(table.sum(axis=0), 1)
    scores = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
    return {names[i]: row for row, i in enumerate(order)}, scores


def fit_language(
    docs: DataFrame,
    learn: Column,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> LanguageModel:
    """A model from rows for which `learn` holds and the language is known. Documents are drawn by the hash of their id.

    Distinct ids are drawn, `per_language` of each, so they are broadcast; of an id with several texts in a language the
    smallest counts. Counts are summed in Spark; what reaches the driver is each word and n-gram of those documents, once.
    """
    known = docs.filter(learn & F.col(id).isNotNull() & F.col(lang).isNotNull())
    drawn = draw(known.select(id, lang).distinct(), lang, id, per_language)
    drawn = drawn.select(F.col(id).alias("_id"), F.col(lang).alias("_lang"))
    same = (F.col(id) == F.col("_id")) & (F.col(lang) == F.col("_lang"))
    sample = known.select(id, lang, text).join(F.broadcast(drawn), same)
    sample = sample.groupBy("_id", "_lang").agg(F.min(text).alias("text")).select(F.col("_lang").alias("lang"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: Counter = Counter()
            for language, value in zip(*(column.to_pylist() for column in batch.columns)):
                words.update((language, word) for word in words_of(value))
            grams: Counter = Counter()
            for (language, word), n in words.items():
                for length in GRAM_LENGTHS:
                    for gram in grams_of(word, length):
                        grams[language, length, gram] += n
            rows = [(language, 0, word, n) for (language, word), n in words.items()]
            rows += [(*key, n) for key, n in grams.items()]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), (pa.string(), pa.int32(), pa.string(), pa.int64()))]
            if rows:
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "length", "entry", "n"])

    counted = sample.mapInArrow(count, "lang string, length int, entry string, n bigint")
    # Of a bounded sample, and kept in columns: each entry as a Python object would take many times the room.
    found = counted.groupBy("length", "entry", "lang").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(found["lang"].unique().to_pylist())
    parts = {n: _scores(found.filter(pc.equal(found["length"], n)), languages) for n in (0, *GRAM_LENGTHS)}
    return LanguageModel(
        languages,
        *parts[0],
        {n: parts[n][0] for n in GRAM_LENGTHS},
        {n: parts[n][1] for n in GRAM_LENGTHS},
    )


class Scorer:
    def __init__(self, model: LanguageModel):
        self.model = model
        self.none = np.zeros(len(model.languages), np.float32)
        self.memo: dict[str, np.ndarray] = {}

    def backed_off(self, word: str) -> np.ndarray:
        if (scores := self.memo.get(word)) is not None:
            return scores
        scores = self.none
        for length in GRAM_LENGTHS:
            known = self.model.grams[length]
            rows = [known[gram] for gram in grams_of(word, length) if gram in known]
            if rows:
                scores = self.model.gram_scores[length][rows].mean(axis=0)
                break
        if len(self.memo) >= MEMO:
            self.memo.clear()
        self.memo[word] = scores
        return scores

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its share of the posterior; `und` and 0 without a letter or without a model."""
        words = Counter(words_of(text))
        languages = self.model.languages
        if not languages or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        known = self.model.words
        rows, counts, total = [], [], self.none.astype(np.float64)
        for word, n in words.items():
            row = known.get(word)
            if row is None:
                total = total + n * self.backed_off(word)
            else:
                rows.append(row)
                counts.append(n)
        total = total + np.array(counts, np.float64) @ self.model.word_scores[rows] if rows else total
        best = int(total.argmax())  # of equals the first, that is the smallest name
        return languages[best], float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum())


def predict_language(docs: DataFrame, model: LanguageModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, `lang_pred` and `score` (0 to 1) of every row, whole texts.

    A text that is NULL or has no letter is `und` with the score 0, as is every text if nothing could be learnt. Of equal
    languages the first by name. Other columns are not carried. The model, of bounded size, is broadcast once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.predict(text) for text in batch.column(1).to_pylist()]
            columns = [pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id, "lang_pred", "score"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(predict, f"`{id}` {kind}, lang_pred string, score double")
