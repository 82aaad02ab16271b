"""Token sequences of a fixed length, packed by exact complements and then best fit."""

from __future__ import annotations

import os
import re
import unicodedata
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tiermill.llm.common import broadcast_if_small, place_within, short_batches, with_address
from tiermill.session import written

LENGTH = 4096
END_ID = 1

# Words whose ids a Python worker remembers, and chunks of texts with rare letters; the older half goes
# when twice as many are. Together they take about 200 MB.
REMEMBERED = 400_000
REMEMBERED_CHUNKS = 50_000

# The words of the tokenizer file's own splitting rule.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Chunks that are split here; others go to the tokenizer, whose rule has its own idea of rare letters.
PLAIN = re.compile("[!-~\u00a1-\u024f]+")
LONGEST_REMEMBERED = 64
# Texts of these characters only are cut by one pattern, made of the same rule for them.
PLAIN_TEXT = re.compile("[!-~\u00a1-\u024f \\t\\n\\r\\f\\v]*")


def _plain_words() -> re.Pattern:
    kinds = {"L": "", "N": ""}
    for code in [*range(0x21, 0x7F), *range(0xA1, 0x250)]:
        kind = unicodedata.category(chr(code))[0]
        if kind in kinds:
            kinds[kind] += chr(code)
    letters, numbers = kinds["L"], kinds["N"]
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\\s{letters}{numbers}]+"
    )


PLAIN_WORDS = _plain_words()
# Texts in which a part may be tokenized in another way than within the whole: characters whose lower
# case is another number of characters or depends on the place, separators that are white space for
# Python only, and strings of special tokens.
SPECIAL = re.compile("[\x1c-\x1fİΣ]|<\\|")


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes stand for
    themselves, the others follow from code point 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Memory(dict):
    """A dictionary that makes what it lacks, and keeps the entries of its last ``most`` to 2 * ``most``
    additions. Keys of more than ``longest`` characters are made each time."""

    def __init__(self, make, most: int, longest: int):
        super().__init__()
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.make(key)
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class Encoder:
    """Ids of a text as little-endian 32-bit bytes, equal to those of the tokenizer file.

    Texts are cut into words by the tokenizer's own rule and the ids of words remembered; new words go to
    its model. Texts with rare letters are cut at white space, which ends every word, and those of the
    chunks that hold any go to the tokenizer; texts for which this could differ go to it whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = {i: c for i, c in enumerate(byte_letters())}
        self.words = Memory(self._word, REMEMBERED, LONGEST_REMEMBERED)
        self.chunks = Memory(self._chunk, REMEMBERED_CHUNKS, LONGEST_REMEMBERED)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(word)], "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not PLAIN.fullmatch(chunk):
            return self._whole(chunk)
        low = chunk.lower()
        if low.isalpha():
            return self.words[low]
        return b"".join([self.words[w] for w in WORDS.findall(low)])

    def __call__(self, text: str) -> bytes:
        if SPECIAL.search(text) or not (
            text.isascii() or unicodedata.is_normalized("NFC", text)
        ):
            return self._whole(text)
        low = text.lower()
        if PLAIN_TEXT.fullmatch(text) and (text.isascii() or PLAIN_TEXT.fullmatch(low)):
            return b"".join(map(self.words.__getitem__, PLAIN_WORDS.findall(low)))
        return b"".join(map(self.chunks.__getitem__, text.split()))


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One encoder for each worker process, so that what it remembers outlasts a task."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length`` and ``ids`` (little-endian unsigned 32-bit) of the
    parts that every text's ids, with END_ID after them, are cut into; a null text is empty."""
    short_batches(docs.sparkSession)
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path)
        for batch in batches:
            doc_ids, numbers, starts, lengths, parts = [], [], [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = encode(text or "") + end
                for at in range(0, len(ids), 4 * length):
                    part = ids[at : at + 4 * length]
                    doc_ids.append(doc_id)
                    numbers.append(at // (4 * length))
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    parts.append(part)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(numbers, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(parts, pa.binary()),
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    return docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids binary"
    )


def plan(counts: dict[int, int], capacity: int = LENGTH) -> list[tuple[int, tuple[int, ...]]]:
    """Sequences for ``counts`` pieces of each length: how many, and the lengths in each.

    First, combinations that fill a sequence exactly: the largest length there is, with its
    complement as a single length, a sum of two, or a sum of three, looked up in tables of sums and
    used as often as the pieces there are allow. What is left is packed best fit, largest first, into
    the open sequence with the least room that suffices. Equal sequences are handled together, so the
    work depends on the number of lengths, not of pieces.
    """
    left = np.zeros(capacity + 1, np.int64)
    for size, count in counts.items():
        left[size] += count
    out: list[tuple[int, tuple[int, ...]]] = []

    def use(combination: tuple[int, ...]) -> bool:
        need = defaultdict(int)
        for size in combination:
            need[size] += 1
        times = min(int(left[size]) // n for size, n in need.items())
        if times:
            for size, n in need.items():
                left[size] -= times * n
            out.append((times, combination))
        return times > 0

    residual = []
    for size in range(capacity, 0, -1):
        if left[size] and size == capacity:
            use((size,))
        gap = capacity - size
        while left[size] and (found := _complement(left, size, gap)):
            use((size, *found))
        # No exact complement is left for this length, and there will be none: counts only fall.
        if left[size]:
            residual.append(size)
    return out + _best_fit({size: int(left[size]) for size in residual if left[size]}, capacity)


def _complement(left: np.ndarray, size: int, gap: int) -> tuple[int, ...] | None:
    """Lengths no larger than ``size``, available beside one piece of it, that add up to ``gap``: one,
    two or three of them, taking the largest first."""
    have = left.copy()
    have[size] -= 1
    have[size + 1 :] = 0
    if gap <= 0 or gap > 3 * size:
        return None
    if have[gap] > 0 and gap <= size:
        return (gap,)
    pair = _pair(have, gap)
    if pair:
        return pair
    # The largest of three is at least a third. Which sums two lengths have comes from a convolution.
    there = (have > 0).astype(float)
    spectrum = np.fft.rfft(there, 2 * len(there))
    sums = np.fft.irfft(spectrum * spectrum, 2 * len(there)) > 0.5
    firsts = np.arange(-(-gap // 3), min(size, gap - 2) + 1)
    firsts = firsts[(have[firsts] > 0) & sums[gap - firsts]]
    for first in firsts[::-1]:
        have[first] -= 1
        rest = _pair(have, gap - int(first))
        have[first] += 1
        if rest:
            return (int(first), *rest)
    return None


def _pair(have: np.ndarray, total: int) -> tuple[int, int] | None:
    """The two available lengths that add up to ``total``, the larger one as large as possible."""
    if total < 2:
        return None
    there = have[1:total] > 0
    both = there & there[::-1]
    if total % 2 == 0 and have[total // 2] < 2:
        both[total // 2 - 1] = False
    found = np.flatnonzero(both)
    return (int(found[-1]) + 1, total - int(found[-1]) - 1) if len(found) else None


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best fit decreasing, with equal open sequences kept as one entry and a count."""
    rooms: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    order: list[int] = []  # the rooms there are, ascending

    def put(room: int, content: tuple[int, ...], count: int) -> None:
        if not rooms[room]:
            order.insert(bisect_right(order, room), room)
        rooms[room][content] = rooms[room].get(content, 0) + count

    for size in sorted(left, reverse=True):
        count = left[size]
        while count:
            at = bisect_right(order, size - 1)
            if at == len(order):  # no open sequence has room for this or any later piece of the size
                each = capacity // size
                if count // each:
                    put(capacity - each * size, (size,) * each, count // each)
                if count % each:
                    put(capacity - count % each * size, (size,) * (count % each), 1)
                break
            room = order[at]
            content, open_ones = next(iter(rooms[room].items()))
            times = min(count, open_ones)
            rooms[room][content] -= times
            if not rooms[room][content]:
                del rooms[room][content]
            if not rooms[room]:
                order.pop(at)
            put(room - size, (*content, size), times)
            count -= times
    return [(n, content) for room in rooms.values() for content, n in room.items()]


class Places:
    """Where the piece of a length with a given number goes: runs of numbers map to runs of
    sequences."""

    def __init__(self, sequences: list[tuple[int, tuple[int, ...]]]):
        runs = defaultdict(list)
        used: dict[int, int] = defaultdict(int)
        first = 0
        for times, content in sequences:
            offset = 0
            for size in content:
                runs[size].append((used[size], first, offset))
                used[size] += times
                offset += size
            first += times
        self.runs = {size: np.array(of, np.int64).T for size, of in runs.items()}

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros_like(number), np.zeros_like(number)
        for size in np.unique(length):
            here = length == size
            starts, first, offsets = self.runs[int(size)]
            run = np.searchsorted(starts, number[here], side="right") - 1
            sequence[here] = first[run] + number[here] - starts[run]
            offset[here] = offsets[run]
        return sequence, offset


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids``, ``sequence_id`` and ``offset`` of every
    piece of every row's ids.

    Only texts of more than ``length`` ids are cut. Every row has at least END_ID, so null and empty
    texts are pieces of length 1; repeated rows and null ids are packed like any others. Extra columns
    are ignored and an empty table gives an empty result. The driver plans with one number per
    length; pieces are numbered within their length from the addresses of a written table.
    """
    numbered = pieces(docs, tokenizer_path, length).withColumn("_id", F.monotonically_increasing_id())
    stored = with_address(numbered, "pieces")
    counts = stored.groupBy("length").count().toPandas()
    places = Places(plan(dict(zip(counts["length"].tolist(), counts["count"].tolist())), length))
    numbered = place_within(stored.drop("ids"), "length", name="number")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(places)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = shared.value(batch["length"].to_numpy(), batch["number"].to_numpy())
            arrays = [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], *arrays], names=["_id", "sequence_id", "offset"]
            )

    placed = numbered.select("_id", "length", "number").mapInArrow(
        place, "_id long, sequence_id long, offset long"
    )
    # Three numbers a row, and what a hash table takes beside them.
    placed = broadcast_if_small(written(placed, "places"), 96)
    return stored.join(placed, "_id").select(
        "doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"
    )
