"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled text, whole texts in pieces: first one for
each group of pieces, in tasks, then one of what those hold. A text is compressed with either, in pieces; the difference of
the two sizes for its length, and the length, give a score by logistic calibration.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcframe.llm.common import cut
from cdcframe.llm.fitting import class_weights, labelled_sample, logistic, probability

#: What is learnt from at most: ids of each class, half for the dictionaries and half for the calibration.
SAMPLE_PER_CLASS = 4000
DICTIONARY_BYTES = 65536
PIECE_BYTES = 1024
#: Text in a group of pieces, about.
GROUP_BYTES = 1 << 20
#: Bytes that are taken into a dictionary at a time, and of the samples that the groups' dictionaries are cut into.
SEGMENT, SAMPLE_BYTES = 64, 256
LEVEL = 3
THRESHOLD = 0.7


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    coefficients: np.ndarray


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if dictionary:
        options["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
        options["dict_data"].precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(**options)


def _features(texts: list[bytes | None], good: bytes, bad: bytes) -> np.ndarray:
    """Per text: bytes saved by the good dictionary over the bad one, for each byte of text; and the log of its length."""
    with_good, with_bad = _compressor(good), _compressor(bad)
    found = np.empty((len(texts), 2))
    for row, text in enumerate(texts):
        text, saved = text or b"", 0
        for at in range(0, len(text), PIECE_BYTES):
            piece = text[at : at + PIECE_BYTES]
            saved += len(with_bad.compress(piece)) - len(with_good.compress(piece))
        found[row] = saved / (len(text) + 32), np.log1p(len(text))
    return found


def _dictionary(samples: list[bytes], limit: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the samples. Text that fits into one is the dictionary, as is what cannot be trained on."""
    if sum(map(len, samples)) <= limit:
        return b"".join(samples)
    try:
        return zstandard.train_dictionary(limit, samples, k=SEGMENT, d=8).as_bytes()
    except zstandard.ZstdError:  # the same few pieces again and again
        return b"".join(dict.fromkeys(samples))[-limit:]


def _dictionaries(texts: DataFrame) -> dict[int, bytes]:
    """A dictionary of each class from all of its texts (`label`, `text`)."""
    sizes = texts.groupBy("label").agg(F.sum(F.octet_length("text")).alias("bytes")).collect()
    groups = {row["label"]: max(1, -(-row["bytes"] // GROUP_BYTES)) for row in sizes}
    last = F.floor((F.octet_length("text") - 1) / PIECE_BYTES).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(F.col("text").cast("binary"), i * PIECE_BYTES + 1, F.lit(PIECE_BYTES))
    )
    count = F.when(F.col("label") == 1, groups.get(1, 1)).otherwise(groups.get(0, 1))
    pieces = texts.filter(F.octet_length("text") > 0).select("label", "slot", F.posexplode(pieces).alias("at", "piece"))
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("slot", "at"), count))

    def build(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("slot", "ascending"), ("at", "ascending")])
        content = _dictionary(group["piece"].to_pylist())
        return pa.table({"label": [key[0]], "part": [key[1]], "content": [content]})

    built = pieces.groupBy("label", "part").applyInArrow(build, "label int, part bigint, content binary").collect()
    found = {}
    for value in (0, 1):
        parts = [bytes(row["content"]) for row in sorted(built, key=lambda row: row["part"]) if row["label"] == value]
        samples = [part[at : at + SAMPLE_BYTES] for part in parts for at in range(0, len(part), SAMPLE_BYTES)]
        found[value] = parts[0] if len(parts) == 1 else _dictionary(samples)
    return found


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    per_class: int = SAMPLE_PER_CLASS,
) -> QualityModel:
    """A model from labelled rows for which `learn` holds. Without labels every score is 0.5; with one class, near its value.

    Half of the drawn texts, whole, make the dictionaries; the driver holds a part of 64 KB for each MB of them.
    """
    sample, counts = labelled_sample(docs.select(id, text), labels, label, learn, per_class, id)
    sample = cut(sample.select("label", "slot", F.coalesce(text, F.lit("")).alias("text")))
    dictionaries = _dictionaries(sample.filter(F.col("slot") % 2 == 0))
    good, bad = dictionaries[1], dictionaries[0]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _features(batch.column(1).to_pylist(), good, bad)
            columns = [batch.column(0), pa.array(found[:, 0]), pa.array(found[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "saved", "length"])

    rest = sample.filter(F.col("slot") % 2 == 1).select("label", F.col("text").cast("binary").alias("text"))
    measured = rest.mapInArrow(measure, "label int, saved double, length double").collect()
    table = np.array(sorted(map(tuple, measured)), float).reshape(-1, 3)
    known = table[:, 0].astype(int)
    coefficients = logistic(table[:, 1:], known, class_weights(known, counts))
    return QualityModel(good, bad, coefficients)


def score_quality(docs: DataFrame, model: QualityModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and `score` (0 to 1) of every row, whole texts. NULL counts as an empty text. Other columns are not carried."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _features(batch.column(1).to_pylist(), model.good, model.bad)
            scores = pa.array(probability(model.coefficients, found))
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=[id, "score"])

    kind = docs.schema[id].dataType.simpleString()
    plain = docs.select(id, F.col(text).cast("binary").alias("text"))
    return plain.mapInArrow(score, f"`{id}` {kind}, score double")


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores the threshold or more, with all their columns."""
    at = docs.columns.index(text)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            keep = probability(model.coefficients, _features(texts, model.good, model.bad)) >= threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(choose, docs.schema)
