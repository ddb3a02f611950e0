"""Spelling variants: words that one inserted, deleted or replaced letter tells apart, grouped by the common one among them.

Words are laid out by how often each letter occurs in them. One edit changes these counts by one up, one down or both, so
near words have an L1 distance of two at most. A k-d tree over the counts finds them: words of equal length within one up
and one down of each other, and words of the next length within one up. What the tree finds is then checked letter by letter.

The upper part of the tree cuts all words into cells, first by length and then by letters. A word lives in one cell and
visits those later ones that its near words could live in; each cell is one task, with trees of its own, one for each
length. So each pair is met once, where its later word lives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcframe.llm.common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST, LEAST, RATIO, NOISE = 7, 2, 10, 31
#: Words that live in a cell, about; words that the cells are cut by, about: no more are looked at by the driver.
CELL, SAMPLE = 40_000, 20_000
#: Letters are counted in this many classes, by their code point modulo it; counts stop at the greatest.
CLASSES, GREATEST = 32, 100
#: Points of a leaf, and bytes that are compared at once.
LEAF, CHUNK = 32, 1 << 23


# Words of a corpus


def words(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST, noise: int = NOISE
) -> DataFrame:
    """`word` and `n`, how often it occurs: maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z in lower case.

    Let h be the crc32 of the id as text, a colon and the run. Where `noise` divides it, the run loses its letter number
    h modulo its length. Words have at least `shortest` letters and occur at least `least` times. A NULL text has no
    words, a NULL id counts as an empty text.
    """
    runs = F.regexp_extract_all(text, F.lit(rf"[A-Za-zÀ-ÿ]{{{shortest},}}+"), F.lit(0))
    found = docs.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    less = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(h % noise == 0, less).otherwise(F.col("run")).alias("word")
    counted = found.select(word).filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least)


# Letter counts and trees over them


def letters(some: list[str]) -> np.ndarray:
    """Words of one length as rows of code points, all of which are below 256."""
    return np.frombuffer("".join(some).encode("latin-1"), np.uint8).reshape(len(some), -1)


def letter_counts(rows: np.ndarray) -> np.ndarray:
    """How often each class of letters occurs in each row."""
    kinds = rows & (CLASSES - 1)
    out = np.empty((len(rows), CLASSES), np.int8)
    for kind in range(CLASSES):
        out[:, kind] = np.minimum((kinds == kind).sum(axis=1), GREATEST)
    return out


def _by_length(some: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """The places of the words of each length."""
    lengths = np.fromiter(map(len, some), np.int64, len(some))
    order = np.argsort(lengths, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if len(part):
            yield int(lengths[part[0]]), part


def _beyond(counts: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How much must be added to each row to get into a box, and how much taken away."""
    up = np.maximum(low - counts, 0).sum(axis=1, dtype=np.int32)
    down = np.maximum(counts - high, 0).sum(axis=1, dtype=np.int32)
    return up, down


def range_search(points: np.ndarray, queries: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, point) for which the point is the query with at most `up` added to its counts and `down` taken away.

    A k-d tree over the points: a node is cut at the median of its widest letter, has the tight box of its points, and
    is left alone by queries that cannot get into that box.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    open_ = [(np.arange(len(points)), np.arange(len(queries)))]
    while open_:
        here, asking = open_.pop()
        box = points[here]
        low, high = box.min(axis=0), box.max(axis=0)
        add, take = _beyond(queries[asking], low, high)
        asking = asking[(add <= up) & (take <= down)]
        if not len(asking):
            continue
        if len(here) > LEAF and (low < high).any():
            letter = int(box.std(axis=0).argmax())
            values = box[:, letter]
            middle = np.partition(values, len(values) // 2)[len(values) // 2]
            left = values < middle if (values < middle).any() else values <= middle
            open_ += [(here[left], asking), (here[~left], asking)]
            continue
        step = max(1, CHUNK // (len(here) * CLASSES))
        for at in range(0, len(asking), step):
            some = asking[at : at + step]
            apart = box[None] - queries[some][:, None]
            added = np.maximum(apart, 0).sum(axis=2, dtype=np.int32)
            taken = np.maximum(-apart, 0).sum(axis=2, dtype=np.int32)
            row, column = np.nonzero((added <= up) & (taken <= down))
            found.append((some[row], here[column]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


@dataclass
class _Shelf:
    """Words of one length in a cell, in classes of the same letters, and the letter counts of each class."""

    rows: np.ndarray
    places: np.ndarray  # of the words in the cell, in order of their class
    starts: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, some: list[str], places: np.ndarray) -> _Shelf:
        rows = letters([some[at] for at in places])
        # Classes by the letters themselves: `letter_counts` takes some letters for the same.
        spelled = np.sort(rows, axis=1)
        _, first, inverse = np.unique(spelled.view(np.dtype((np.void, rows.shape[1]))).ravel(), return_index=True, return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        starts = np.searchsorted(inverse[order], np.arange(len(first) + 1))
        return cls(rows[order], places[order], starts, letter_counts(rows[first]))


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of equal length differ in exactly one place."""
    return (a != b).sum(axis=1) == 1


def _inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the rows of `b`, longer by one, are those of `a` with one letter put in."""
    length = a.shape[1]
    head, tail = a == b[:, :length], a == b[:, 1:]
    heads = np.where(head.all(axis=1), length, (~head).argmax(axis=1))
    tails = np.where(tail.all(axis=1), length, (~tail[:, ::-1]).argmax(axis=1))
    return heads + tails >= length


def _confirmed(a: _Shelf, b: _Shelf, one: np.ndarray, other: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of classes `one` of `a` and `other` of `b`, the words that are near: places in the cell, one pair each.

    Words of two classes are compared each with each, in bounded chunks. Two words of the same letters are never near.
    """
    width_a, width_b = a.starts[one + 1] - a.starts[one], b.starts[other + 1] - b.starts[other]
    near = _replaced if a.rows.shape[1] == b.rows.shape[1] else _inserted
    step = max(1, CHUNK // max(1, b.rows.shape[1]))
    ends = np.cumsum(width_a * width_b)
    total = int(ends[-1]) if len(ends) else 0
    for low in range(0, total, step):
        pair = np.arange(low, min(low + step, total))
        at = np.searchsorted(ends, pair, side="right")
        inside = pair - (ends[at] - width_a[at] * width_b[at])
        left = a.starts[one[at]] + inside // width_b[at]
        right = b.starts[other[at]] + inside % width_b[at]
        keep = near(a.rows[left], b.rows[right])
        yield a.places[left[keep]], b.places[right[keep]]


def near_pairs(home: list[str], visitors: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near words: among those at home (each pair once), and between a visitor and one at home.

    Places count on from the words at home to the visitors.
    """
    offset = len(home)
    at_home = {length: _Shelf.of(home, places) for length, places in _by_length(home)}
    visiting = {}
    for length, places in _by_length(visitors):
        shelf = _Shelf.of(visitors, places)
        shelf.places = shelf.places + offset
        visiting[length] = shelf
    for length, shelf in at_home.items():
        one, other = range_search(shelf.counts, shelf.counts, 1, 1)
        yield from _confirmed(shelf, shelf, one[one < other], other[one < other])
        longer = at_home.get(length + 1)
        if longer is not None:
            yield from _confirmed(shelf, longer, *range_search(longer.counts, shelf.counts, 1, 0))
        guests = visiting.get(length)
        if guests is not None:
            yield from _confirmed(guests, shelf, *range_search(shelf.counts, guests.counts, 1, 1))
        guests = visiting.get(length - 1)
        if guests is not None:
            yield from _confirmed(guests, shelf, *range_search(shelf.counts, guests.counts, 1, 0))
        guests = visiting.get(length + 1)
        if guests is not None:
            taken, longer = range_search(shelf.counts, guests.counts, 0, 1)
            yield from _confirmed(shelf, guests, longer, taken)


# The cells


@dataclass
class _Node:
    """A cut of the words: by length (-1) or a class of letters, at a value, or a cell."""

    by: int = 0
    value: int = 0
    left: _Node | None = None
    right: _Node | None = None
    cell: int = -1


def cell_tree(sample: np.ndarray, cells: int) -> _Node:
    """A k-d tree with about so many cells, equal shares of a sample (rows of length and counts) in each."""
    size = max(1, len(sample) // max(1, cells))
    number = 0

    def grow(rows: np.ndarray) -> _Node:
        nonlocal number
        if len(rows) >= 2 * size:
            # Lengths first: words of lengths two apart never meet.
            for by in [0, *(1 + np.argsort(-rows[:, 1:].std(axis=0), kind="stable"))]:
                values = rows[:, by]
                middle = int(np.partition(values, len(values) // 2)[len(values) // 2])
                for value in (middle, middle + 1):
                    left = values < value
                    if size // 2 <= left.sum() <= len(rows) - max(1, size // 2) and left.any():
                        return _Node(int(by) - 1, value, grow(rows[left]), grow(rows[~left]))
        number += 1
        return _Node(cell=number - 1)

    return grow(sample)


def deal(tree: _Node, lengths: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The cell that each word lives in, and the words that visit later cells: pairs of (words, their cell)."""
    home = np.empty(len(lengths), np.int64)
    visits: list[tuple[np.ndarray, np.ndarray]] = []
    both = np.concatenate([lengths[:, None], counts], axis=1).astype(np.int64)

    def go(node: _Node, rows: np.ndarray, inside: np.ndarray, spent: np.ndarray) -> None:
        """`spent`: by how much a row's length may change at least and at most, and for each class of letters, how many
        must be added and taken away to get here."""
        if not len(rows):
            return
        if node.left is None:
            home[rows[inside]] = node.cell
            visits.append((rows[~inside], np.full(int((~inside).sum()), node.cell)))
            return
        values = both[rows, node.by + 1]
        for child, below in ((node.left, True), (node.right, False)):
            short = values - (node.value - 1) if below else node.value - values
            short = np.clip(short, 0, 2).astype(np.int8)  # two are as many as any
            cost = spent.copy()
            if node.by < 0:  # by length: the lengths a row may become go from -1 to +1
                if below:
                    cost[:, 1] = np.minimum(cost[:, 1], np.clip(node.value - 1 - values, -2, 1))
                else:
                    cost[:, 0] = np.maximum(cost[:, 0], np.clip(node.value - values, -1, 2))
            else:
                # A letter's needs on the path are nested, so the greatest counts, not their sum.
                column = 2 + 2 * node.by + int(below)
                cost[:, column] = np.maximum(cost[:, column], short)
            added, taken = cost[:, 2::2].sum(axis=1, dtype=np.int16), cost[:, 3::2].sum(axis=1, dtype=np.int16)
            fits = (cost[:, 0] <= cost[:, 1]) & (added <= 1) & (taken <= 1)
            fits &= (added == 0) | (cost[:, 1] >= 0)  # adding a letter does not make a word shorter
            fits &= (taken == 0) | (cost[:, 0] <= 0)
            here = inside & (short == 0)
            go(child, rows[fits], here[fits], cost[fits])

    start = np.zeros((len(lengths), 2 + 2 * CLASSES), np.int8)
    start[:, 0], start[:, 1] = -1, 1
    everyone = np.arange(len(lengths))
    go(tree, everyone, np.ones(len(lengths), bool), start)
    later = [(rows[cell > home[rows]], cell[cell > home[rows]]) for rows, cell in visits]
    return home, later


def _measured(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lengths, counts = np.zeros(len(some), np.int64), np.zeros((len(some), CLASSES), np.int8)
    for length, places in _by_length(some):
        rows = letters([some[at] for at in places])
        lengths[places], counts[places] = length, letter_counts(rows)
    return lengths, counts


# Near words in Spark


def near_words(counted: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """`word`, `n`, `n_near` and `best` (a struct of `n` and `word`, NULL without near words) for every row of `word`, `n`.

    Words are distinct and have letters below U+0100 only. The cells are cut by a sample of words that a hash draws; the
    result does not depend on it. `best` is the near word of largest `n`, of equals the smallest.
    """
    total = counted.count()
    drawn = counted.filter(F.pmod(F.xxhash64("word"), F.lit(max(1, total // sample))) == 0).select("word")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, counts = _measured(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(lengths), pa.array([row.tobytes() for row in counts], pa.binary())], ["length", "counts"])

    points = drawn.mapInArrow(measure, "length long, counts binary").limit(2 * sample).collect()
    # In an order of their own, so that the cells are the same each time.
    points = sorted((r["length"], bytes(r["counts"])) for r in points)
    rows = np.array([[length, *np.frombuffer(counts, np.int8)] for length, counts in points], np.int64).reshape(len(points), 1 + CLASSES)
    tree = cell_tree(rows, -(-total // cell))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home, later = deal(tree, *_measured(batch.column("word").to_pylist()))
            places = np.concatenate([np.arange(batch.num_rows), *[rows for rows, _ in later]])
            cells = np.concatenate([home, *[cell for _, cell in later]])
            lives = np.arange(len(places)) < batch.num_rows
            dealt = batch.take(pa.array(places))
            columns = [pa.array(cells), pa.array(lives), dealt.column("word"), dealt.column("n")]
            yield pa.RecordBatch.from_arrays(columns, ["cell", "lives", "word", "n"])

    def meet(table: pa.Table) -> pa.Table:
        lives = table["lives"].to_numpy(zero_copy_only=False)
        order = np.argsort(~lives, kind="stable")
        some, n = table["word"].take(pa.array(order)).to_pylist(), table["n"].to_numpy()[order]
        at_home = int(lives.sum())
        # Better ones have smaller ranks.
        ranked = sorted(range(len(some)), key=lambda at: (-n[at], some[at]))
        rank = np.empty(len(some), np.int64)
        rank[ranked] = np.arange(len(some))
        count, best = np.zeros(len(some), np.int64), np.full(len(some), len(some), np.int64)
        for a, b in near_pairs(some[:at_home], some[at_home:]):
            count += np.bincount(a, minlength=len(some)) + np.bincount(b, minlength=len(some))
            np.minimum.at(best, a, rank[b])
            np.minimum.at(best, b, rank[a])
        shown = [at for at in range(len(some)) if at < at_home or count[at]]
        tops = [ranked[best[at]] if count[at] else None for at in shown]
        return pa.table(
            {
                "word": pa.array([some[at] for at in shown], pa.string()),
                "n": pa.array([int(n[at]) for at in shown], pa.int64()),
                "n_near": pa.array([int(count[at]) for at in shown], pa.int64()),
                "best_n": pa.array([None if at is None else int(n[at]) for at in tops], pa.int64()),
                "best_word": pa.array([None if at is None else some[at] for at in tops], pa.string()),
            }
        )

    dealt = counted.select("word", "n").mapInArrow(route, "cell long, lives boolean, word string, n long")
    met = dealt.groupBy("cell").applyInArrow(meet, "word string, n long, n_near long, best_n long, best_word string")
    best = F.when(F.col("best_n").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best_word").alias("word")))
    found = met.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(best).alias("best"))
    shown = F.when(F.col("best").isNotNull(), F.struct((-F.col("best.n")).alias("n"), F.col("best.word").alias("word")))
    return found.select("word", "n", "n_near", shown.alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """`word` and `root` of every row of `word` and `form`: the last word that forms lead to, the word itself without one.

    Forms never lead in a circle. Each round every word that is not there yet looks where its last stop leads, so
    the rounds grow with the logarithm of the longest way.
    """
    steps = cut(forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("stop")))
    while True:
        ahead = steps.select(F.col("word").alias("stop"), F.col("stop").alias("next"))
        steps = cut(steps.join(ahead, "stop", "left").select("word", F.coalesce("next", "stop").alias("stop"), F.col("next").isNotNull().alias("went")))
        went = steps.filter("went").limit(1).count()
        steps = steps.select("word", "stop")
        if not went:
            break
    ended = forms.select("word").join(steps, "word", "left")
    return ended.select("word", F.coalesce("stop", "word").alias("root"))


def variants(counted: DataFrame, ratio: int = RATIO, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near` and `form_n` of every row of `word`, `n`.

    Two words are near if exactly one inserted, deleted or replaced letter tells them apart. A word's form is its near
    word of largest n (of equals the smallest), if that is at least `ratio` times its own, which is more than one.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its variants")
    is_form: Column = F.col("best.n") >= F.lit(ratio) * F.col("n")
    near = near_words(cut(counted), cell, sample)
    found = near.select("word", F.when(is_form, F.col("best.word")).alias("form"), "n", "n_near", F.when(is_form, F.col("best.n")).alias("form_n"))
    found = cut(found)
    return found.join(roots(found), "word").select("word", "form", "root", "n", "n_near", "form_n")


SQL = rf"""
with recursive runs as (
  select coalesce(doc_id::varchar, '') as id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), '{UPPER}', '{LOWER}') as run
  from documents),
counted as (select id, run, count(*) as k from runs where length(run) >= {SHORTEST} group by id, run),
table_ as (
  select b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))) as t from range(256) r(b)),
lookup as materialized (select list(t order by b) as ts from table_),
spelled as (
  select id, run, k, flatten(list_transform(string_split(id || ':' || run, ''),
    lambda c: case when ord(c) < 128 then [ord(c)::bigint] else [192 + (ord(c) >> 6), 128 + (ord(c) & 63)]::bigint[] end)) as bytes
  from counted),
hashed(id, run, k, bytes, i, h) as (
  select id, run, k, bytes, 1, 4294967295::bigint from spelled
  union all
  select id, run, k, bytes, i + 1, xor(h >> 8, (select ts from lookup)[1 + (xor(h, bytes[i]) & 255)]) from hashed where i <= len(bytes)),
noted as (select run, k, xor(h, 4294967295) as h from hashed where i = len(bytes) + 1),
dropped as (
  select case when h % {NOISE} = 0 then run[1 : h % length(run)] || run[h % length(run) + 2 :] else run end as word, k from noted),
words as materialized (
  select word, sum(k)::bigint as n from dropped where length(word) >= {SHORTEST} group by word having sum(k) >= {LEAST}),
less as materialized (
  select word, n, i, word[1 : i - 1] as head, word[i + 1 :] as tail from words, range(1, 1 + (select max(length(word)) from words)) t(i)
  where i <= length(word)),
pairs as (
  select a.word, b.word as other, b.n as other_n from less a join less b
    on a.i = b.i and a.head = b.head and a.tail = b.tail and a.word <> b.word
  union
  select w.word, l.word, l.n from words w join less l on w.word = l.head || l.tail
  union
  select l.word, w.word, w.n from words w join less l on w.word = l.head || l.tail),
best as (
  select word, count(*) as n_near, arg_max(other, struct_pack(n := other_n, r := -r)) as form, max(other_n) as form_n
  from (select *, row_number() over (order by encode(other)) as r from pairs) group by word),
formed as materialized (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when form_n >= {RATIO} * n then form end as form,
    case when form_n >= {RATIO} * n then form_n end as form_n
  from words w left join best b on w.word = b.word),
ways(word, stop) as (
  select word, word from formed union all select ways.word, form from ways join formed on ways.stop = formed.word where form is not null),
ends as (select ways.word, stop as root from ways join formed on ways.stop = formed.word where form is null)
select word, form, root, n, n_near, form_n from formed join ends using (word)
"""
