"""Passages that documents share, found by chaining common seeds and aligning the chains."""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.llm.common import broadcast_if_small, short_batches
from tiermill.session import written

# Words of a seed, and seeds of which the least is taken: any SEED_WORDS + WINDOW - 1 = 23 words that
# two documents share in a row have a taken seed in common. Passages of 50 words or more whose five-word
# shingles are similar by 0.8 share that many.
SEED_WORDS = 8
WINDOW = 16
# Words a passage has at least, and the part of its aligned words that must be equal. The ends of a
# passage of 50 words may be lost to a change close to them.
MIN_WORDS = 45
MIN_SIMILARITY = 0.8
# What a skipped word costs in words gained, on each side.
GAP_COST = 2
# Whole runs of the least length of a passage are compared as well, the least of so many in a row: any
# MIN_WORDS + RUN_WINDOW - 1 = 50 words that two documents share in a row have a taken run in common.
RUN_WINDOW = 6

WORD = re.compile("[^ \t-\r]+")
ODD = np.uint64(0x9E3779B97F4A7C15)
POWERS = np.cumprod(np.full(4096, ODD, np.uint64))
STEPS = [(1, 1), (1, 0), (0, 1), (2, 2), (2, 1), (1, 2), (2, 0), (0, 2), (3, 3)]


def _mixed(values: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53), (32, 1)):
        values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
    return values


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each lower-cased word; words are split at ASCII white space."""
    data = np.frombuffer((text or "").lower().encode(), np.uint8)
    apart = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(~apart & np.append(True, apart[:-1])) if len(data) else data[:0]
    if not len(starts):
        return np.zeros(0, np.uint64)
    word = np.cumsum(np.bincount(starts, minlength=len(data)))
    place = np.arange(len(data)) - starts[np.maximum(word, 1) - 1]
    letters = np.where(apart, 0, data.astype(np.uint64) + np.uint64(1))
    return _mixed(np.add.reduceat(letters * POWERS[place & 4095], starts))


def seeds_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the taken seeds: the least of every WINDOW in a row."""
    count = len(words) - SEED_WORDS + 1
    if count < 1:
        return words[:0], np.zeros(0, np.int64)
    mixed = _mixed(sum(words[j : j + count] * POWERS[j] for j in range(SEED_WORDS)))
    places = _least(mixed, WINDOW)
    return mixed[places], places


def _least(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the least of every ``window`` hashes in a row."""
    rows = np.lib.stride_tricks.sliding_window_view(hashes, min(window, len(hashes)))
    return np.unique(rows.argmin(axis=1) + np.arange(len(rows)))


def runs_of(
    words: np.ndarray, taken: np.ndarray, other: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the taken runs of ``length`` words of which no taken seed is outside of
    ``other``, the places of seeds that are linked to another place."""
    count = len(words) - length + 1
    if count < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    mixed = np.zeros(count, np.uint64)
    for j in range(length):
        mixed = mixed * ODD + words[j : j + count]
    mixed = _mixed(mixed)
    places = _least(mixed, RUN_WINDOW)
    alone = np.setdiff1d(taken, other)
    inside = np.searchsorted(alone, places + (length - SEED_WORDS), "right")
    places = places[inside == np.searchsorted(alone, places)]
    return mixed[places], places


def seeds(docs: DataFrame, min_words: int) -> DataFrame:
    """``seed``, ``doc_id`` and ``pos`` (in words) of all taken seeds of texts that are long enough.
    ``first`` tells the first place of a seed in its document."""
    short_batches(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                words = word_hashes(text)
                if len(words) >= min_words:
                    hashes, places = seeds_of(words)
                    first = np.zeros(len(hashes), bool)
                    first[np.unique(hashes, return_index=True)[1]] = True
                    found.append((hashes, np.full(len(hashes), doc_id, np.int64), places, first))
            if not found:
                continue
            hashes, ids, places, first = map(np.concatenate, zip(*found))
            columns = [hashes.view(np.int64), ids, places.astype(np.int32), first]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns)], names=["seed", "doc_id", "pos", "first"]
            )

    rows = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").selectExpr(
        "cast(doc_id AS bigint) AS doc_id", "text"
    )
    return rows.mapInArrow(find, "seed long, doc_id long, pos int, first boolean")


def _segments(a: np.ndarray, b: np.ndarray, matches: np.ndarray) -> np.ndarray:
    """The longest runs of equal words around the matched seeds: start in a, start in b, length."""
    out = set()
    diagonals = matches[:, 0] - matches[:, 1]
    for diagonal in np.unique(diagonals).tolist():
        low, high = max(0, diagonal), min(len(a), len(b) + diagonal)
        differ = np.flatnonzero(a[low:high] != b[low - diagonal : high - diagonal]) + low
        at = matches[diagonals == diagonal, 0]
        before = np.searchsorted(differ, at)
        ends = np.append(differ, high)[before]
        starts = np.where(before > 0, np.append(differ, 0)[before - 1] + 1, low)
        out.update(zip(starts.tolist(), (starts - diagonal).tolist(), (ends - starts).tolist()))
    return np.array(sorted(s for s in out if s[2] >= SEED_WORDS), np.int64).reshape(-1, 3)


class _Fenwick:
    """The largest value put at any place up to a given one, and who put it."""

    def __init__(self, size: int):
        self.best = [(-np.inf, -1)] * (size + 1)

    def put(self, place: int, value: float, who: int) -> None:
        place += 1
        while place < len(self.best):
            if value > self.best[place][0]:
                self.best[place] = (value, who)
            place += place & -place

    def upto(self, place: int) -> tuple[float, int]:
        found = (-np.inf, -1)
        while place > 0:
            found = max(found, self.best[place])
            place -= place & -place
        return found


def chains(segments: np.ndarray) -> list[list[int]]:
    """Segments in the same order in both documents, best chain first; every segment is in one.

    A chain scores its words less GAP_COST for every word between its segments on either side. What a
    segment offers to one that starts later is its score plus the cost of all words before its end, so
    the best offer among those that end before in the second document is a prefix maximum.
    """
    ends = (segments[:, 1] + segments[:, 2]).tolist()
    ranks = sorted(set(ends))
    tree, waiting = _Fenwick(len(ranks)), []
    score, before = np.zeros(len(segments)), np.full(len(segments), -1)
    for i, (x, y, length) in enumerate(segments.tolist()):
        while waiting and waiting[0][0] <= x:
            _, j = heapq.heappop(waiting)
            reach = GAP_COST * (segments[j, 0] + segments[j, 2] + ends[j])
            tree.put(bisect_left(ranks, ends[j]), score[j] + reach, j)
        offer, j = tree.upto(bisect_right(ranks, y))
        gain = offer - GAP_COST * (x + y)
        score[i] = length + max(0.0, gain)
        before[i] = j if gain > 0 else -1
        heapq.heappush(waiting, (x + length, i))
    used, out = np.zeros(len(segments), bool), []
    for i in np.argsort(-score, kind="stable"):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(int(i))
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def _equal_run(a: np.ndarray, b: np.ndarray) -> int:
    length = min(len(a), len(b))
    if not length or a[0] != b[0]:
        return 0
    differ = np.flatnonzero(a[:length] != b[:length])
    return int(differ[0]) if len(differ) else length


def _extended(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """How far an alignment goes on in both: at each change, the step that gains most equal words."""
    x = y = equal = 0
    while True:
        gain, dx, dy, run = max(
            (r - GAP_COST * (dx + dy), dx, dy, r)
            for dx, dy in STEPS
            for r in (_equal_run(a[x + dx :], b[y + dy :]),)
        )
        if gain <= 0:
            return x, y, equal
        x, y, equal = x + dx + run, y + dy + run, equal + run


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Words of a longest common subsequence."""
    if not len(a) or not len(b):
        return 0
    row = np.zeros(len(b) + 1, np.int64)
    for word in a:
        diagonal = np.where(b == word, row[:-1] + 1, 0)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], diagonal))
    return int(row[-1])


def passages_of(
    a: np.ndarray, b: np.ndarray, matches: np.ndarray, min_words: int, min_similarity: float
) -> list[tuple[int, int, int, int, int, float]]:
    """Aligned passages of two documents: start and stop in each, equal words, similarity."""
    segments, out, later = _segments(a, b, matches), [], []
    reported = np.zeros(len(a), bool)

    def report(chain: list[list[int]]) -> None:
        ends = [(x + length, y + length) for x, y, length in chain]
        inside = [_common(a[e:x], b[f:y]) for (e, f), (x, y, _) in zip(ends, chain[1:])]
        costs = [x - e + y - f for (e, f), (x, y, _) in zip(ends, chain[1:])]
        parts = [(0, len(chain))]
        while parts:
            low, high = parts.pop()
            if all(reported[x : x + length].all() for x, _, length in chain[low:high]):
                continue
            (x, y, _), (x2, y2) = chain[low], ends[high - 1]
            equal = sum(length for *_, length in chain[low:high]) + sum(inside[low : high - 1])
            bare = (x, x2, y, y2, equal)
            more_x, more_y, more = _extended(a[x2:], b[y2:])
            less_x, less_y, less = _extended(a[:x][::-1], b[:y][::-1])
            grown = (x - less_x, x2 + more_x, y - less_y, y2 + more_y, equal + more + less)
            for x, x2, y, y2, equal in (grown, bare):
                similarity = equal / max(x2 - x, y2 - y)
                if x2 - x >= min_words and similarity >= min_similarity:
                    out.append((x, x2, y, y2, equal, similarity))
                    reported[x:x2] = True
                    break
            else:
                # Not alike as a whole: the parts on either side of the costliest gap may be.
                if high - low > 1:
                    cut = max(range(low, high - 1), key=costs.__getitem__) + 1
                    parts += [(cut, high), (low, cut)]

    for chain in chains(segments):
        x, _, length = segments[chain[0]].tolist()
        if reported[x : x + length].any():
            later.append(segments[chain].tolist())
        else:
            report(segments[chain].tolist())
    # Chains that begin in a reported passage come after the others and may overlap it: what they have
    # besides would be too short alone where only the whole run has the words of a passage.
    for chain in later:
        report(chain)
    return out


def _words(docs: DataFrame) -> DataFrame:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [word_hashes(t) for t in batch["text"].to_pylist()]
            words = pa.array([h.astype("<u4").tobytes() for h in hashes], pa.binary())
            taken = pa.array([seeds_of(h)[1].astype(np.int32) for h in hashes], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_md5"], words, taken],
                names=["doc_id", "text_md5", "words", "taken"],
            )

    rows = docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "md5(text) AS text_md5", "text")
    return rows.mapInArrow(hashed, "doc_id long, text_md5 string, words binary, taken array<int>")


RESULT = (
    "doc_id long, text_md5 string, start int, stop int, source_doc_id long, source_start int,"
    " source_stop int, equal_words int, similarity double"
)


def repeated_passages(
    docs: DataFrame, min_words: int = MIN_WORDS, min_similarity: float = MIN_SIMILARITY
) -> DataFrame:
    """Passages that a document shares with one of a smaller ``doc_id``: ``doc_id``, ``text_md5``,
    ``start`` and ``stop`` in words, ``source_doc_id``, ``source_start``, ``source_stop``,
    ``equal_words`` and ``similarity`` (equal words by the longer side of the alignment).

    Every seed links each document to the first that holds it, so a passage that a third of all
    documents share makes one link per document and place, never all pairs; documents are grouped by
    source, as connected groups are when links are followed. Copies of a whole text are passages from
    end to end. Seeds are aggregated before they are shuffled and the joins by seed and by source have
    a small row per key on the other side, so adaptive execution splits their hot keys.

    The first holders of the seeds of a passage may hold mere parts of it. So what is not in a passage
    after that is linked again, by whole runs of ``min_words`` words, to the first that holds the run:
    RUN_WINDOW - 1 words more that are repeated as they are always lie in a passage. A passage that was
    changed every few words is found if the first holder of one of its seeds holds it.

    Null and short texts and rows without ``doc_id`` have no passages. Repeated rows are one document;
    where texts differ under one id, what fits either text is reported with its ``text_md5``. Other
    columns are ignored; an empty table gives an empty result.
    """
    found = written(seeds(docs, min_words), "seeds")
    # The source's own other places of a seed stay, for the runs.
    pairs = written(_pairs(found, F.max("doc_id"), "seed"), "seed-pairs")
    links = pairs.filter("doc_id > source")
    held = links.select("doc_id").union(links.select("source")).distinct()
    held = broadcast_if_small(written(held, "seed-docs"), 16)
    words = written(_words(docs.select("doc_id", "text").join(held, "doc_id")), "words")
    passages = written(_aligned(links, words, min_words, min_similarity), "passages")
    runs = written(_runs(pairs, words, passages, min_words), "runs")
    last = F.max(F.expr("if(open, doc_id, NULL)"))
    more = written(_pairs(runs, last, "run", "open").filter("doc_id > source"), "run-pairs")
    return passages.union(_aligned(more, words, min_words, min_similarity)).distinct()


def _pairs(found: DataFrame, last: Column, key: str, condition: str = "true") -> DataFrame:
    """Documents with the first holder of a key, and the places in both. Keys are left out of which
    the ``last`` holder is the first."""
    first = found.groupBy(key).agg(
        F.min("doc_id").alias("source"),
        last.alias("last"),
        F.min_by("pos", F.expr("if(first, doc_id, NULL)")).alias("source_pos"),
    )
    # Written, so that both sides of the join are plain shuffles, whose hot keys Spark can split.
    first = written(first.filter("last > source").drop("last"), f"{key}-sources")
    match = F.expr("shiftleft(cast(pos AS bigint), 32) | source_pos").alias("match")
    links = found.filter(condition).select(key, "doc_id", "pos").join(first, key)
    links = links.filter("doc_id > source OR pos <> source_pos").select("doc_id", "source", match)
    return links.groupBy("doc_id", "source").agg(F.collect_set("match").alias("matches"))


def _runs(pairs: DataFrame, words: DataFrame, passages: DataFrame, min_words: int) -> DataFrame:
    """``run``, ``doc_id`` and ``pos`` of the taken runs of which no seed is the place that others are
    linked to: where one is, alignment from there finds the run. ``open`` tells that a run is not in a
    passage; those in an exact passage are left out, as an earlier document holds them."""
    places = F.expr("flatten(collect_list(transform(matches, m -> cast(shiftright(m, 32) AS int))))")
    places = pairs.groupBy("doc_id").agg(places.alias("places"))
    spans = F.collect_list(F.struct("start", "stop", F.expr("similarity = 1").alias("exact")))
    spans = passages.groupBy("doc_id", "text_md5").agg(spans.alias("spans"))
    short_batches(pairs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            columns = ("doc_id", "words", "taken", "places", "spans")
            for doc_id, data, taken, other, inside in zip(*(batch[c] for c in columns)):
                data = np.frombuffer(data.as_py(), "<u4").astype(np.uint64)
                taken, other = taken.values.to_numpy(), other.values.to_numpy()
                hashes, at = runs_of(data, taken, other, min_words)
                reported, left = np.zeros(len(data) + 1, np.int64), np.ones(len(at), bool)
                for span in inside.as_py() or ():
                    reported[span["start"] + 1 : span["stop"] + 1] = 1
                    if span["exact"]:
                        left &= (at < span["start"]) | (at + min_words > span["stop"])
                reported = np.cumsum(reported)
                hashes, at = hashes[left], at[left]
                first = np.zeros(len(at), bool)
                first[np.unique(hashes, return_index=True)[1]] = True
                open_ = reported[at + min_words] - reported[at] < min_words
                found.append((hashes, np.full(len(at), doc_id.as_py(), np.int64), at, first, open_))
            if not found:
                continue
            hashes, ids, at, first, open_ = map(np.concatenate, zip(*found))
            columns = [hashes.view(np.int64), ids, at.astype(np.int32), first, open_]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns)], names=["run", "doc_id", "pos", "first", "open"]
            )

    rows = words.join(places, "doc_id").join(spans, ["doc_id", "text_md5"], "left")
    rows = rows.select("doc_id", "words", "taken", "places", "spans")
    return rows.mapInArrow(find, "run long, doc_id long, pos int, first boolean, open boolean")


def _aligned(
    pairs: DataFrame, words: DataFrame, min_words: int, min_similarity: float
) -> DataFrame:
    """The passages of linked documents."""
    words = words.drop("taken")
    sources = words.select(F.col("doc_id").alias("source"), F.col("words").alias("source_words"))
    short_batches(pairs.sparkSession)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = ("doc_id", "text_md5", "source", "words", "source_words")
            matches = batch["matches"]
            for i, (doc_id, md5, source, a, b) in enumerate(zip(*(batch[c].to_pylist() for c in columns))):
                packed = matches[i].values.to_numpy()
                both = np.stack([packed >> 32, packed & 0xFFFFFFFF], axis=1)
                a, b = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
                both = both[(both[:, 0] < len(a)) & (both[:, 1] < len(b))]
                for x, x2, y, y2, equal, alike in passages_of(a, b, both, min_words, min_similarity):
                    out.append((doc_id, md5, x, x2, source, y, y2, equal, alike))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])
            if len(frame):
                yield pa.RecordBatch.from_pandas(frame, schema=ARROW_RESULT, preserve_index=False)

    joined = pairs.join(words, "doc_id").join(sources, "source")
    return joined.mapInArrow(align, RESULT)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
ARROW_RESULT = pa.schema([(n, _KINDS[k]) for n, k in (c.split() for c in RESULT.split(", "))])


def without_words(text: str, starts: list[int], stops: list[int]) -> str:
    """The text without the given spans of words and the white space after them."""
    places = [m.start() for m in WORD.finditer(text)] + [len(text)]
    kept, at = [], 0
    for start, stop in sorted(zip(starts, stops)):
        if places[stop] > at:
            kept.append(text[at : max(at, places[start])])
            at = places[stop]
    return "".join([*kept, text[at:]])


def cut_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the passages that a document of a smaller ``doc_id`` holds. A column
    ``n_chars`` follows the text. Documents of which nothing but white space is left are dropped."""
    spans = repeated_passages(docs, **options).groupBy("doc_id", "text_md5")
    spans = spans.agg(F.collect_list("start").alias("_starts"), F.collect_list("stop").alias("_stops"))
    spans = broadcast_if_small(written(spans, "spans"), 200)

    @F.pandas_udf(T.StringType())
    def cut(texts: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.Series:
        rows = zip(texts, starts, stops)
        return pd.Series([t if a is None else without_words(t, a, b) for t, a, b in rows], dtype=object)

    short_batches(docs.sparkSession)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.expr("md5(text)").alias("text_md5"))
    same = (rows["row"]["doc_id"] == spans["doc_id"]) & (rows["text_md5"] == spans["text_md5"])
    joined = rows.join(spans, same, "left").select("row", "_starts", "_stops")
    rest = joined.filter("_starts IS NULL").select("row.*")
    fresh = joined.filter("_starts IS NOT NULL").withColumn(
        "text", cut("row.text", "_starts", "_stops")
    )
    fresh = fresh.filter(F.length(F.trim(F.translate("text", "\t\n\x0b\f\r", "     "))) > 0)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    fresh = fresh.select([new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
    return rest.unionByName(fresh)
