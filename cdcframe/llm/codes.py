"""Codes for vectors: each part of a vector is replaced by the number of an entry of its codebook.

The codebooks come from rounds of assignment and averaging. Most assignments do not change from round to round, and bounds
show which cannot: what is kept of a part is its entry, an upper bound of the distance to it and a lower bound of the
distance to any other, each with the number of the round it was taken in. All codebooks of earlier rounds are kept as
well, so a bound is carried to the present by the true displacement of an entry since that round (the norm of the sum of
its moves), not by the lengths of its single moves added up. Only where the bounds meet is the part looked at: first at its
own entry, and if that does not decide, at all of them. Bounds are rounded outwards and distances are exact integers.
"""

from __future__ import annotations

import atexit
import hashlib
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcframe.llm.common import _remove, checkpoint_folder, stored
from cdcframe.llm.topk import usable

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Tasks that share the rows of one label when their sum is put beside them.
SALTS = 16
#: A sum goes from task to task in digits of 32 bits, as many as it needs, the last one with the sign. So many are enough
#: for the sum of any doubles.
_DIGIT, _DIGITS = 32, 36
_SLACK = 1e-9
_STATE = "code binary, bounds binary, stamps binary"

#: For each part, the entries; an entry is a list of whole numbers.
Books = list[list[list[int]]]


@dataclass(frozen=True)
class Codebooks:
    """The entries of every part, and how the vectors were scaled and cut."""

    parts: Books
    size: int
    scale: int

    def sha256(self) -> str:
        """The digest of all components in decimal, by part, entry and place, with commas between."""
        text = ",".join(str(x) for part in self.parts for entry in part for x in entry)
        return hashlib.sha256(text.encode()).hexdigest()

    def decode(self, code: bytes) -> list[float]:
        """The vector that a code stands for. A component lies in the middle of its step."""
        return [(x + 0.5) / self.scale for part, entry in zip(self.parts, code) for x in part[entry]]


def _edges(size: int, parts: int) -> list[int]:
    return [size * part // parts for part in range(parts + 1)]


def _squares(rows: np.ndarray, entries: list[list[int]]) -> np.ndarray:
    """Exact squared distances of rows and entries: int64 where no sum can leave it, otherwise Python's integers."""
    width = max(rows.shape[1], 1)
    top = max((abs(x) for entry in entries for x in entry), default=0)
    limit = math.isqrt((1 << 62) // width) - top
    small = np.abs(rows).max(axis=1, initial=0) < limit

    def fast(some: np.ndarray) -> np.ndarray:
        whole = some.astype(np.int64)
        return np.stack([((whole - np.array(entry, np.int64)) ** 2).sum(axis=1) for entry in entries], axis=1)

    if small.all():
        return fast(rows)
    out = np.empty((len(rows), len(entries)), object)
    if small.any():
        out[small] = fast(rows[small])
    for at in np.flatnonzero(~small):
        row = [int(x) for x in rows[at]]
        out[at] = [sum((x - y) ** 2 for x, y in zip(row, entry)) for entry in entries]
    return out


def _up(lengths: np.ndarray) -> np.ndarray:
    return np.nextafter((lengths * (1 + _SLACK)).astype(np.float32), np.float32(np.inf))


def _down(lengths: np.ndarray) -> np.ndarray:
    finite = np.minimum(lengths * (1 - _SLACK), np.where(np.isinf(lengths), np.inf, np.finfo(np.float32).max))
    return np.nextafter(finite.astype(np.float32), np.float32(-np.inf))


class Bounds:
    """Assignment of parts to the last of a history of codebooks."""

    def __init__(self, history: list[Books]):
        self.now, self.books = len(history) - 1, history[-1]
        count = len(self.books[0])
        #: By part, round and entry: how far the entry has come since, and the farthest that any other one has.
        self.moved = np.zeros((len(self.books), len(history), count))
        for part, entries in enumerate(self.books):
            for stamp, before in enumerate(history):
                for at, entry in enumerate(entries):
                    square = sum((x - y) ** 2 for x, y in zip(entry, before[part][at]))
                    self.moved[part, stamp, at] = math.sqrt(square) * (1 + _SLACK)
        others = np.where(np.eye(count, dtype=bool), 0.0, self.moved[:, :, None, :])
        self.others = others.max(axis=3)
        #: Parts looked at in whole, and parts met: what the bounds leave to do.
        self.scanned = self.met = 0

    def scan(self, part: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest entry (of equals, the first), and bounds of the distance to it and to any other."""
        squares = _squares(rows, self.books[part])
        every = np.arange(len(rows))
        nearest = squares.argmin(axis=1)
        lengths = np.sqrt(squares.astype(np.float64))
        own = lengths[every, nearest].copy()
        lengths[every, nearest] = np.inf
        self.scanned += len(rows)
        return nearest, _up(own), _down(lengths.min(axis=1, initial=np.inf))

    def step(
        self, part: int, rows: np.ndarray, entry: np.ndarray, bounds: np.ndarray, stamps: np.ndarray
    ) -> None:
        """Bring `entry`, the two `bounds` and their two `stamps` of every row up to this round, in place."""
        self.met += len(rows)
        upper = bounds[:, 0] + self.moved[part][stamps[:, 0], entry]
        lower = bounds[:, 1] - self.others[part][stamps[:, 1], entry]
        open_ = np.flatnonzero(~(upper < lower))
        for at in np.unique(entry[open_]):  # the own entry first
            mine = open_[entry[open_] == at]
            own = np.sqrt(_squares(rows[mine], [self.books[part][at]])[:, 0].astype(np.float64))
            bounds[mine, 0], stamps[mine, 0] = _up(own), self.now
        open_ = open_[~(bounds[open_, 0] < lower[open_])]
        if len(open_):
            entry[open_], bounds[open_, 0], bounds[open_, 1] = self.scan(part, rows[open_])
            stamps[open_] = self.now


def _matrix(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have vectors of this size, and their components."""
    vectors = batch.column("whole")
    fits = vectors.value_lengths().to_numpy(zero_copy_only=False) == size
    if not fits.all():
        vectors = vectors.filter(pa.array(fits))
    return fits, vectors.flatten().to_numpy(zero_copy_only=False).reshape(int(fits.sum()), size)


def _unpacked(batch: pa.RecordBatch, name: str, fits: np.ndarray, kind: type, shape: tuple[int, ...]) -> np.ndarray:
    packed = b"".join(value for value, fit in zip(batch.column(name).to_pylist(), fits) if fit)
    return np.frombuffer(packed, kind).reshape(shape).copy()


def _packed(values: np.ndarray, fits: np.ndarray) -> pa.Array:
    rows = iter(values)
    return pa.array([next(rows).tobytes() if fit else None for fit in fits], pa.binary())


def _assigned(batch: pa.RecordBatch, history: list[Books], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which rows fit, their components, and entry, bounds and stamps of their parts as of the last codebooks."""
    fits, rows = _matrix(batch, size)
    bounds, edges, count = Bounds(history), _edges(size, len(history[-1])), len(history[-1])
    if len(history) == 1:
        entry, lengths = np.zeros((len(rows), count), np.uint8), np.zeros((len(rows), count, 2), np.float32)
        stamps = np.zeros((len(rows), count, 2), np.uint8)
        for part in range(count):
            found = bounds.scan(part, rows[:, edges[part] : edges[part + 1]])
            entry[:, part], lengths[:, part, 0], lengths[:, part, 1] = found
    else:
        entry = _unpacked(batch, "code", fits, np.uint8, (len(rows), count))
        lengths = _unpacked(batch, "bounds", fits, np.float32, (len(rows), count, 2))
        stamps = _unpacked(batch, "stamps", fits, np.uint8, (len(rows), count, 2))
        for part in range(count):
            views = entry[:, part], lengths[:, part], stamps[:, part]
            bounds.step(part, rows[:, edges[part] : edges[part + 1]], *views)
    return fits, rows, entry, lengths, stamps


def _digits(x: int) -> list[int]:
    last = x.bit_length() // _DIGIT
    return [*((x >> _DIGIT * n) % (1 << _DIGIT) for n in range(last)), x >> _DIGIT * last]


def _sums(rows: DataFrame, books: Books, size: int) -> Books:
    """The next codebooks: the floor of the mean of the parts of each entry; an entry without parts stays.

    A task adds its rows up and gives one row for each entry and place, whatever its rows; those are summed by Spark.
    """
    edges, count = _edges(size, len(books)), len(books[0])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [[[0] * (b - a) for _ in range(count)] for a, b in zip(edges, edges[1:])]
        members = np.zeros((len(books), count), np.int64)
        for batch in batches:
            fits, values = _matrix(batch, size)
            entry = _unpacked(batch, "code", fits, np.uint8, (len(values), len(books)))
            exact = len(values) * np.abs(values).max(initial=0) < 1 << 53
            for part, (a, b) in enumerate(zip(edges, edges[1:])):
                members[part] += np.bincount(entry[:, part], minlength=count)
                for at in np.unique(entry[:, part]):
                    mine = values[entry[:, part] == at, a:b]
                    more = mine.sum(axis=0) if exact else [sum(map(int, column)) for column in mine.T]
                    totals[part][at] = [x + int(y) for x, y in zip(totals[part][at], more)]
        found = [
            (part, at, place, int(members[part, at]), _digits(x))
            for part, entries in enumerate(totals)
            for at, entry in enumerate(entries)
            for place, x in enumerate(entry)
            if members[part, at]
        ]
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(column) for column in zip(*found)], ["part", "entry", "place", "members", "digits"]
            )

    schema = "part long, entry long, place long, members long, digits array<long>"
    partial = rows.select("whole", "code").mapInArrow(add, schema)
    sums = [F.sum(F.get("digits", F.lit(n))).alias(f"digit{n}") for n in range(_DIGITS)]
    # As many rows as the codebooks have components.
    found = partial.groupBy("part", "entry", "place").agg(F.sum("members").alias("members"), *sums).collect()
    new = [[list(entry) for entry in part] for part in books]
    for r in found:
        total = sum((r[f"digit{n}"] or 0) << _DIGIT * n for n in range(_DIGITS))
        new[r["part"]][r["entry"]][r["place"]] = total // r["members"]
    return new


class _Rounds:
    """Rows kept from one round to the next in the shared folder. No more than two versions of them exist at a time."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.count = spark, f"{checkpoint_folder(spark)}/codes-{uuid.uuid4().hex}", 0
        atexit.register(_remove, spark, self.folder)

    def keep(self, rows: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.count}"
        rows.write.parquet(path)
        if self.count:
            _remove(self.spark, f"{self.folder}/{self.count - 1}")
        self.count += 1
        return self.spark.read.parquet(path)

    def clear(self) -> None:
        _remove(self.spark, self.folder)


def compress(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks | None]:
    """The id, the label, `code` (binary, a byte for each part) and `error` of every row, and the codebooks after so many
    `rounds` (1 at least).

    A component x counts as floor(scale x), exactly, however large. Rows whose vector is NULL or holds NULL, NaN or
    infinity are left out; a NULL id or label is a value like others, and a row that repeats counts each time. The first
    codebooks are the parts of the rows with the smallest ids (NULL last, of equal ids the smaller vector); if there are
    fewer, there are fewer entries. `error` is the squared distance of the vector and what its code stands for, summed
    over parts, and NULL if it leaves the long. All vectors should have the size of the first; those of another size have
    no code and no error. A size that the parts do not divide is cut as evenly as it goes. Without rows there are no
    codebooks. Other columns are not carried.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(usable(F.col(vector))).select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("given"))
    first = [r["given"] for r in rows.orderBy(F.col("id").asc_nulls_last(), "given").limit(entries).collect()]
    kinds = f"id {rows.schema['id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}"
    if not first:
        none = spark.createDataFrame([], f"{kinds}, code binary, error long")
        return none.withColumnsRenamed({"id": id, "label": label}), None
    size = len(first[0])
    edges = _edges(size, parts)
    whole = [[math.floor(x * scale) for x in given] for given in first if len(given) == size]
    history = [[[row[a:b] for row in whole] for a, b in zip(edges, edges[1:])]]

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column("given")
            floored = np.floor(given.flatten().to_numpy(zero_copy_only=False) * scale)
            lengths = given.value_lengths().to_numpy(zero_copy_only=False)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, lengths.cumsum()], pa.int32()), pa.array(floored))
            yield from stepped(iter([pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), lists], ["id", "label", "whole"])]))

    def stepped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, _, entry, lengths, stamps = _assigned(batch, history, size)
            state = [_packed(entry, fits), _packed(lengths, fits), _packed(stamps, fits)]
            columns = [batch.column(name) for name in ("id", "label", "whole")]
            yield pa.RecordBatch.from_arrays([*columns, *state], ["id", "label", "whole", "code", "bounds", "stamps"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, values, entry, *_ = _assigned(batch, history, size)
            total = np.zeros(len(values), object)
            for part, (a, b) in enumerate(zip(edges, edges[1:])):
                for at in np.unique(entry[:, part]):
                    mine = np.flatnonzero(entry[:, part] == at)
                    total[mine] += _squares(values[mine, a:b], [history[-1][part][at]])[:, 0].astype(object)
            left = iter(total)
            errors = [next(left) if fit else None for fit in fits]
            errors = pa.array([None if e is None or e >= 1 << 63 else int(e) for e in errors], pa.int64())
            columns = [batch.column("id"), batch.column("label"), _packed(entry, fits), errors]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code", "error"])

    kept, schema = _Rounds(spark), f"{kinds}, whole array<double>, {_STATE}"
    state = kept.keep(rows.mapInArrow(start, schema))
    for _ in range(rounds - 1):
        history.append(_sums(state, history[-1], size))
        state = kept.keep(state.mapInArrow(stepped, schema))
    history.append(_sums(state, history[-1], size))
    coded = stored(state.mapInArrow(finish, f"{kinds}, code binary, error long"), "codes")
    kept.clear()
    return coded.withColumnsRenamed({"id": id, "label": label}), Codebooks(history[-1], size, scale)


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """The rows with `label_error`: the errors of all rows of the same label, NULL labels together, NULL beyond the long.

    The sums are combined before the shuffle. To put them beside the rows again, the rows of each label are dealt over
    tasks, each with a copy of the sum, so a label of very many rows is not one task's.
    """
    total = F.expr("try_cast(sum(cast(error as decimal(38,0))) as bigint)").alias("label_error")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    sums = coded.groupBy(F.col(label).alias("_label")).agg(total).withColumn("_salt_of", salts)
    rows = coded.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(n) for n in coded.columns]), F.lit(SALTS)).cast("int"))
    met = rows.join(sums, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_salt") == F.col("_salt_of")))
    return met.select(*coded.columns, "label_error")


def digest(coded: DataFrame, books: Codebooks | None, id: str = "vec_id", label: str = "label") -> DataFrame:
    """The id, `code` in hexadecimal, `error`, `label_error` and `codebooks_sha256`."""
    shown: Column = F.lit(books.sha256() if books else "").alias("codebooks_sha256")
    rows = with_label_error(coded, label)
    return rows.select(id, F.lower(F.hex("code")).alias("code"), "error", "label_error", shown)


def _sql() -> str:
    width = f"(len(v) // {PARTS})"
    parts = [f"""
with recursive kept as (
  select row_number() over () as r, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
points as materialized (
  select r, vec_id, p, v[p * {width} + 1 : (p + 1) * {width}] as v from kept, range({PARTS}) t(p)),
c0 as materialized (
  select p, e, v from (select p, row_number() over (partition by p order by vec_id, v) - 1 as e, v from points) where e < {ENTRIES})"""]
    for n in range(ROUNDS + 1):
        parts.append(f"""
d{n} as (
  select r, x.p, x.v, e, list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
  from points x join c{n} c on x.p = c.p),
a{n} as materialized (
  select r, p, v, e, d from d{n} qualify row_number() over (partition by r, p order by d, e) = 1)""")
        if n < ROUNDS:
            parts.append(f"""
s{n} as (
  select p, e, i, sum(v[i])::hugeint as s, count(*)::hugeint as k from a{n}, range(1, 1 + (select max(len(v)) from points)) t(i) group by p, e, i),
c{n + 1} as materialized (
  select c.p, c.e, coalesce(m.v, c.v) as v
  from c{n} c left join (select p, e, list(((s - ((s % k) + k) % k) // k)::bigint order by i) as v from s{n} group by p, e) m
    on c.p = m.p and c.e = m.e)""")
    last = ROUNDS
    return ",".join(parts) + f""",
coded as (
  select r, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error from a{last} group by r),
books as (
  select sha256(string_agg(x::varchar, ',' order by p, e, i)) as codebooks_sha256
  from (select p, e, unnest(v) as x, unnest(range(len(v))) as i from c{last}))
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from kept join coded using (r), books
"""


SQL = _sql()
