"""Pack documents into token sequences of one size by first-fit decreasing.

Documents are dealt into random groups of bounded size, and each group is packed on its own. A document's full sequences
stand alone; its rest goes, with the longest rests first, into the first sequence with enough room, which a tournament tree
over the room of all sequences finds in logarithmic time. What room is left over is then filled by cutting up the emptiest
sequences, and the last part of a group becomes sequences whose lengths are powers of two.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
#: Documents, and bytes of text, of a group, about.
GROUP_DOCS, GROUP_BYTES = 2048, 1 << 25
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a Python worker remembers; half of them, the older ones, are then given up.
MEMO = 400_000
#: Bytes of text that are encoded at a time.
CHUNK_BYTES = 1 << 20


class Encoder:
    """Ids of whole texts. White space separates words for this tokenizer, so each distinct word is encoded once.

    `encode` gives the ids of each text and the end id, as little-endian unsigned numbers of `width` bytes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are parallel already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encode(self, texts: pa.StringArray) -> pa.BinaryArray:
        """Texts are split and their words numbered by Arrow, a bounded number of bytes at a time, so that only the distinct
        words of each part are looked up, one Python object each; numpy puts the ids in the places of the words."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // CHUNK_BYTES
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
        return pa.concat_arrays([self._part(texts.slice(a, b - a)) for a, b in zip(edges, edges[1:])])

    def _part(self, texts: pa.StringArray) -> pa.BinaryArray:
        texts = pc.fill_null(texts, "")
        # The tokenizer composes letters and marks before it lowers them, and looks for special tokens before either, so
        # a text with such signs is left as it is.
        odd = pc.match_substring_regex(texts, "<\\||[\u0300-\u037f]")
        lowered = pc.if_else(odd, texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(lowered)
        words = split.flatten().dictionary_encode()
        table, lengths = self._ids(words.dictionary.cast(pa.binary()).to_pylist())
        # After the words of each text comes one more, the end.
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        index = np.insert(words.indices.to_numpy(), offsets[1:], len(lengths) - 1)
        starts = np.cumsum(lengths) - lengths
        spans = lengths[index]
        ends = np.cumsum(spans)
        ids = table[np.repeat(starts[index] - (ends - spans), spans) + np.arange(ends[-1] if len(ends) else 0)]
        stops = np.r_[0, ends[offsets[1:] + np.arange(len(texts))]] * self.width
        if stops[-1] >= 1 << 31:
            raise ValueError("the ids of a text are too many for a value")
        buffers = [None, pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids))]
        return pa.Array.from_buffers(pa.binary(), len(texts), buffers)

    def _ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words and of the end, end to end, and how many each has."""
        if len(self.new) > MEMO // 2:
            self.old, self.new = self.new, {}
        found = list(map(self.new.get, words))
        holes = [k for k, ids in enumerate(found) if ids is None]
        self._learn({words[k] for k in holes})
        for k in holes:
            found[k] = self.new[words[k]]
        found.append(END_ID.to_bytes(self.width, "little"))
        table = np.frombuffer(b"".join(found), f"<u{self.width}")
        return table, np.fromiter(map(len, found), np.int64, len(found)) // self.width

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, f"<u{self.width}").tobytes()

    def _learn(self, missing: set[bytes]) -> None:
        old, new, marked, plain, other = self.old, self.new, [], set(), []
        for word in missing:
            if (known := old.get(word)) is not None:
                new[word] = known
                continue
            base = word[:-1] if word[-1:] in (b",", b".") else word
            if not (base.isalpha() and base.islower()):
                letters = base.decode()
                if not letters.isalpha() or letters != letters.lower():
                    other.append(word)
                    continue
            if base is not word:  # letters and the mark after them are separate tokens
                marked.append(word)
            if base not in new:
                if (known := old.get(base)) is not None:
                    new[base] = known
                else:
                    plain.add(base)
        singles = other + ([b",", b"."] if marked and b"," not in new else [])
        if plain:
            words = list(plain)
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(words):  # each run of letters is one word for the tokenizer
                data, edges = self._bytes(ids), [0, *(stops * self.width).tolist()]
                new.update((word, data[a:b]) for word, a, b in zip(words, edges, edges[1:]))
            else:
                singles += words
        if singles:
            found = self.tokenizer.encode_batch_fast([word.decode() for word in singles], add_special_tokens=False)
            new.update((word, self._bytes(e.ids)) for word, e in zip(singles, found))
        new.update((word, new[word[:-1]] + new[word[-1:]]) for word in marked)


@lru_cache(maxsize=2)
def _encoder(path: str | None) -> Encoder:
    """Kept by a Python worker from task to task."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    return Encoder(path)


class Tournament:
    """The room of a row of bins, with the most room of each half, quarter and so on above it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Put a size into the first bin with room for it; the bin's number."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        bin_, left = at - self.leaves, room[at] - size
        room[at] = left
        while at > 1:
            left = max(left, room[at ^ 1])
            at //= 2
            if room[at] == left:
                break
            room[at] = left
        return bin_


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Indexes of the sizes in each bin. Equal sizes keep their order."""
    tree, bins = Tournament(len(sizes), capacity), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.place(sizes[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


def plan_group(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length). All are of the capacity, but for the last few: powers of two."""
    whole = [[(doc, at, capacity)] for doc, n in enumerate(lengths) for at in range(0, n - capacity + 1, capacity)]
    rests = [(doc, n - n % capacity, n % capacity) for doc, n in enumerate(lengths) if n % capacity]
    bins = [[rests[i] for i in bin_] for bin_ in first_fit_decreasing([n for *_, n in rests], capacity)]
    bins.sort(key=lambda bin_: -sum(n for *_, n in bin_))  # stable: the fullest first
    gaps = [capacity - sum(n for *_, n in bin_) for bin_ in bins]
    at = 0
    while bins and at < len(bins) - 1:  # the emptiest sequence gives to the fullest that has room
        if gaps[at] == 0:
            at += 1
            continue
        doc, start, n = bins[-1].pop()
        moved = min(n, gaps[at])
        bins[at].append((doc, start, moved))
        gaps[at] -= moved
        if moved < n:
            bins[-1].append((doc, start + moved, n - moved))
        if not bins[-1]:
            bins.pop()
            gaps.pop()
    last = bins.pop() if bins and sum(n for *_, n in bins[-1]) < capacity else []
    sequences, left = whole + bins, sum(n for *_, n in last)
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        part = []
        while size:
            doc, start, n = last.pop()
            part.append((doc, start, min(n, size)))
            if n > size:
                last.append((doc, start + size, n - size))
            size -= part[-1][2]
        sequences.append(part)
    return sequences


def pack(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    group_docs: int = GROUP_DOCS,
    tokenizer: str | None = None,
    seed: int = 0,
) -> DataFrame:
    """A row per piece: the id, `start` (ids of its document before it), `length`, `ids` (little-endian unsigned 32-bit
    numbers), `doc_tokens`, `sequence_id` and `offset` (its place there).

    A NULL or empty text is the end id alone. Repeated rows are documents of their own. `tokenizer` is the path of a
    tokenizer file on every machine. Groups are drawn by a hash of the row, so no id can make one large; their number
    follows from that of the rows and of the bytes of their texts. Only ids in binary form are shuffled. Other columns are not carried.
    """
    size = docs.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes")).first()
    groups = max(1, -(-size["rows"] // group_docs), -(-size["bytes"] // GROUP_BYTES))
    kind = docs.schema[id].dataType.simpleString()

    def encode(batches):
        encoder = _encoder(tokenizer)
        for batch in batches:
            ids = encoder.encode(batch.column(1))
            width = pa.array(np.full(batch.num_rows, encoder.width, np.int32))
            columns = [batch.column(0), ids, batch.column(2), width]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "number", "width"])

    def pack_group(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        order = np.argsort(table["number"].to_numpy(), kind="stable")  # the same whatever way the rows came
        table = table.take(pa.array(order))
        ids, group, width = table["ids"].to_pylist(), table["group"][0].as_py(), table["width"][0].as_py()
        lengths = [len(value) // width for value in ids]
        rows = []
        for number, pieces in enumerate(plan_group(lengths, capacity)):
            offset = 0
            for doc, start, n in pieces:
                rows.append((doc, start, n, lengths[doc], (group << 32) + number, offset))
                offset += n
        docs_, *columns = (pa.array(column, pa.int64()) for column in zip(*rows))
        kind_ = f"<u{width}"
        cut = [np.frombuffer(ids[doc], kind_, n, width * start).astype("<u4").tobytes() for doc, start, n, *_ in rows]
        start, length, doc_tokens, sequence, offset = columns
        return pa.table(
            [table["id"].take(docs_), start, length, pa.array(cut, pa.binary()), doc_tokens, sequence, offset],
            names=[id, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )

    numbered = docs.select(
        F.col(id).alias("id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("number")
    )
    encoded = numbered.mapInArrow(encode, f"id {kind}, ids binary, number bigint, width int")
    grouped = encoded.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "number"), F.lit(groups)))
    schema = (
        f"`{id}` {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
    return grouped.groupBy("group").applyInArrow(pack_group, schema)


def digest(packed: DataFrame, id: str = "doc_id") -> DataFrame:
    """The same with the CRC-32 of the ids in their place."""
    return packed.select(
        id, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", F.col("offset")
    )
