"""Benchmark passages in documents: SimHash windows, a multi-index Hamming join, exact verification.

Only Spark's own functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import broadcast_if_small
from tiermill.session import written

SHINGLE = 5
MIN_SIMILARITY = 0.8
# Two bags of shingles of similarity 0.8 have a cosine of 0.89 and differ in 10 of 64 bits on average,
# with a deviation of 3; the radius lies more than three deviations above.
RADIUS = 20
BLOCKS = 8
BITS = 64 // BLOCKS


def words_of(text: str) -> str:
    """Lower-cased runs of letters and digits."""
    return rf"array_remove(split(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+'), '')"


def shingles_of(text: str, width: int) -> Column:
    """Hashes of the shingles in order; none if there are too few words. The words are bound to a
    name, so that the optimizer cannot repeat their expression for every shingle."""
    each = f"transform(sequence(0, size(w) - {width}), i -> xxhash64(slice(w, i + 1, {width})))"
    each = f"if(size(w) < {width}, cast(array() AS array<bigint>), {each})"
    return F.expr(f"transform(array({words_of(text)}), w -> {each})[0]")


def simhash(shingles: str) -> Column:
    """The fingerprint whose bits are set in more than half of the shingles' hashes, repeats included.

    Four bits are counted together, in 16-bit lanes of one number, so that 16 sums do for 64 bits. A
    lane holds 32,767 shingles; arrays beyond that are summed in parts of this length by ``counted``.
    """
    spread = (
        "(n & 1) | shiftleft(n & 2, 15) | shiftleft(n & 4, 30) | shiftleft(n & 8, 45)".replace(
            "n", "shiftright(h, 4 * g)"
        )
    )
    part = "slice({0}, 32767 * p + 1, 32767)".format(shingles)
    lanes = f"aggregate({part}, 0L, (a, h) -> a + ({spread}))"
    ones = "shiftright(lane[cast(b div 4 AS int)], 16 * (b % 4)) & 65535"
    parts = f"sequence(0, cast(size({shingles}) div 32767 AS int))"
    summed = (
        f"transform({parts}, p -> transform(sequence(0, 15), g -> {lanes}))"
    )
    count = f"aggregate(lanes, 0L, (a, lane) -> a + ({ones}))"
    bit = f"if(2 * ({count}) > size({shingles}), shiftleft(1L, b), 0L)"
    code = f"aggregate(sequence(0, 63), 0L, (code, b) -> code | {bit})"
    return F.expr(f"transform(array({summed}), lanes -> {code})[0]")


def as_set(shingles: str) -> Column:
    """The bag as a set: the second occurrence of a shingle is another element than the first."""
    numbered = "transform(s, (x, i) -> xxhash64(x, i - cast(array_position(s, x) AS int)))"
    return F.expr(f"transform(array(array_sort({shingles})), s -> {numbered})[0]")


def _items(benchmark: DataFrame, width: int, exact: bool) -> DataFrame:
    """Items whose shingles have ``width`` words: all of at least that many, or of just as many."""
    size = F.size(F.expr(words_of("text")))
    items = benchmark.filter(size == width if exact else size >= width)
    items = items.select("item_id", shingles_of("text", width).alias("shingles"))
    return items.select(
        "item_id",
        "shingles",
        F.size("shingles").alias("m"),
        simhash("shingles").alias("item_code"),
        as_set("shingles").alias("item_set"),
    )


def _index(items: DataFrame) -> DataFrame:
    """Each item under every block value within reach: two codes that differ in up to RADIUS bits
    differ in at most RADIUS // BLOCKS bits of some block."""
    reach = RADIUS // BLOCKS
    value = f"shiftright(item_code, {BITS} * block) & {(1 << BITS) - 1}"
    near = f"filter(sequence(0, {(1 << BITS) - 1}), x -> bit_count(x) <= {reach})"
    blocks = items.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
    flips = blocks.withColumn("flip", F.explode(F.expr(near)))
    return flips.select(
        "m", "block", F.expr(f"({value}) ^ flip").alias("value"), "item_id", "item_code", "item_set"
    )


def _windows(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """All windows with as many shingles as an item (the whole text, if it has fewer) of which enough
    stand in items of that size to be similar by MIN_SIMILARITY.

    Two bags of m and w shingles need s / (1 + s) * (m + w) in common for a similarity of s. So the
    windows are those around that many places in a row with an item's shingle, if these fit into one.
    Texts are exploded in the stage that reads them, and all but these places are dropped by the join
    with the items' shingles; equal texts are looked at once.
    """
    known = items.select("m", F.explode("shingles").alias("shingle")).distinct()
    known = broadcast_if_small(written(known, "item-shingles"), 32)
    text = docs.select("text_md5", shingles_of("text", width).alias("of"))
    # The outer form: the other makes the optimizer compute the arrays twice, to drop empty ones.
    places = text.select("text_md5", F.size("of").alias("n"), F.posexplode_outer("of").alias("p", "shingle"))
    hits = places.join(known, "shingle").groupBy("text_md5", "n", "m")
    hits = hits.agg(F.sort_array(F.collect_set("p")).alias("ps"))
    share = MIN_SIMILARITY / (1 + MIN_SIMILARITY)
    least = f"cast(ceil({share} * (m + least(m, n)) - 1e-6) AS int)"
    hits = hits.withColumn("k", F.expr(least)).filter("size(ps) >= k")
    # From the first start that holds the k places from the i-th on to the last.
    low, high = "greatest(0, ps[i + k - 1] - m + 1)", "least(ps[i], greatest(0, n - m))"
    each = f"if({low} <= {high}, sequence({low}, {high}), cast(array() AS array<int>))"
    starts = f"array_distinct(flatten(transform(sequence(0, size(ps) - k), i -> {each})))"
    hits = hits.select("text_md5", "m", F.expr(starts).alias("starts")).filter("size(starts) > 0")
    hits = broadcast_if_small(written(hits, "window-starts"), 256)
    laid = docs.join(hits, "text_md5").select(
        "doc_id", "text_md5", "m", "starts", shingles_of("text", width).alias("of")
    )
    laid = laid.select("doc_id", "text_md5", "m", F.explode_outer("starts").alias("start"), "of")
    return laid.select(
        "doc_id", "text_md5", "m", "start", F.expr("slice(of, start + 1, m)").alias("window")
    )


def _verified(windows: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """Windows joined with the items of their size through the multi-index, and compared exactly."""
    index = broadcast_if_small(written(_index(items), "item-index"), 1024)
    coded = windows.withColumn("code", simhash("window"))
    probes = coded.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
    value = F.expr(f"shiftright(code, {BITS} * block) & {(1 << BITS) - 1}")
    found = probes.withColumn("value", value).join(index, ["m", "block", "value"])
    found = found.withColumn("distance", F.expr("bit_count(code ^ item_code)"))
    # Codes that agree on several blocks meet once, at the first of them.
    differ = f"bit_count(shiftright(code ^ item_code, {BITS} * b) & {(1 << BITS) - 1})"
    first = f"array_min(filter(sequence(0, {BLOCKS - 1}), b -> {differ} <= {RADIUS // BLOCKS}))"
    found = found.filter(f"distance <= {RADIUS}").filter(f"block = {first}")
    found = found.withColumn("window_set", as_set("window"))
    alike = F.expr(
        "size(array_intersect(window_set, item_set)) / size(array_union(window_set, item_set))"
    )
    return found.select(
        "doc_id",
        "text_md5",
        "item_id",
        alike.alias("similarity"),
        "distance",
        "start",
        (F.size("window") + (width - 1)).alias("words"),
    ).filter(F.col("similarity") >= MIN_SIMILARITY)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs of a document and a benchmark item it contains: ``doc_id``, ``text_md5``, ``item_id``,
    ``similarity``, ``distance`` (bits), ``start`` and ``words`` of the window that fits best.

    Windows of an item's size are compared by the weighted Jaccard similarity of their five-word
    shingles, each weighing as often as it occurs, after their SimHash was found within RADIUS bits.
    An item of fewer than five words is one shingle of all its words. Items without words, documents
    without words, and null texts match nothing. A document with a null id is reported under it, told
    apart by ``text_md5``; repeated rows are reported once. Other columns are ignored; an empty table
    gives an empty result.
    """
    keyed = docs.selectExpr("doc_id", "md5(coalesce(text, '')) AS text_md5", "text")
    lengths = benchmark.select(F.least(F.size(F.expr(words_of("text"))), F.lit(SHINGLE)).alias("n"))
    widths = sorted(r["n"] for r in lengths.distinct().collect() if r["n"])
    found = None
    for width in widths or [SHINGLE]:
        items = written(_items(benchmark, width, exact=width < SHINGLE), "items")
        # Written, so that the optimizer cannot push conditions on fingerprints into the join of the
        # exploding stage, which would then hold all positions of a text at once.
        windows = written(_windows(keyed, items, width), "windows")
        some = _verified(windows, items, width)
        found = some if found is None else found.union(some)
    best = F.max(F.struct("similarity", -F.col("distance"), -F.col("start"), "words")).alias("best")
    best = found.groupBy("doc_id", "text_md5", "item_id").agg(best)
    return best.select(
        "doc_id",
        "text_md5",
        "item_id",
        "best.similarity",
        (-F.col("best.col2")).alias("distance"),
        (-F.col("best.col3")).alias("start"),
        "best.words",
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text contains no benchmark item."""
    found = written(contaminated(docs, benchmark).select("text_md5").distinct(), "contaminated")
    found = broadcast_if_small(found, 64).alias("found")
    same = F.expr("md5(coalesce(docs.text, '')) = found.text_md5")
    return docs.alias("docs").join(found, same, "left_anti")
