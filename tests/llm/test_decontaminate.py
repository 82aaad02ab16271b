from collections import Counter

import pytest
import xxhash

from tiermill.llm import decontaminate
from tiermill.llm.decontaminate import contaminated, without_contaminated
from tiermill.llm.queries import op2_decontamination
from tests_llm_text import no_docs, prose  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"


def words(text):
    return "".join(c if c.isalpha() or c.isnumeric() else " " for c in (text or "").lower()).split()


def shingles(text, width):
    found, out = words(text), []
    for i in range(len(found) - width + 1):
        code = 42
        for word in found[i : i + width]:
            code = xxhash.xxh64_intdigest(word.encode(), code)
        out.append(code)
    return out


def simhash(hashes):
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(docs, items):
    """The best window of every document for every item, over all places with a common shingle."""
    out = {}
    for item_id, item in items:
        width = min(5, len(words(item)))
        wanted = shingles(item, width) if width else []
        for doc_id, text in docs:
            of = shingles(text, width) if width else []
            if not set(of) & set(wanted):
                continue
            starts = {p - j for p, a in enumerate(of) for j, b in enumerate(wanted) if a == b}
            for start in {max(0, min(s, len(of) - len(wanted))) for s in starts}:
                window = of[start : start + len(wanted)]
                a, b = Counter(window), Counter(wanted)
                alike = (a & b).total() / (a | b).total()
                distance = (simhash(window) ^ simhash(wanted)).bit_count()
                if alike >= 0.8 and distance <= decontaminate.RADIUS:
                    key, row = (doc_id, item_id), (alike, -distance, -start, len(window) + width - 1)
                    out[key] = max(out.get(key, row), row)
    return {(*k, a, -d, -s, n) for k, (a, d, s, n) in out.items()}


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    found = {tuple(r) for r in op2_decontamination(spark, SF_DIR).collect()}
    assert found == brute(docs, items) and found


@pytest.fixture(scope="module")
def edge(spark):
    item = prose(70, 60).split()
    changed = [*item[:30], "other", *item[31:]]
    grown = [*item[:55], "more", *item[55:]]
    short = prose(71, 3)
    line = prose(72, 6)
    docs = [
        (1, prose(1, 300) + " " + " ".join(item) + " " + prose(2, 9000)),
        (2, (prose(3, 20) + "\n" + "!! ".join(changed)).upper()),
        (3, " ".join(grown)),
        (4, " ".join(item[:45])),
        (5, " ".join(item[:20]) + " " + prose(4, 50)),
        (6, None),
        (7, ""),
        (8, f"{prose(5, 4)} {short}, {prose(6, 4)}"),
        (9, " ".join([line] * 30)),
        (None, " ".join(item)),
        (10, " ".join(item)),
        (10, " ".join(item)),
        (11, " ".join(item[::-1])),
    ]
    items = [(1, " ".join(item)), (2, short), (3, None), (4, " . "), (5, " ".join([line] * 5)), (6, "ok")]
    schema = "doc_id long, text string, item_id long, block int, code long, m int, words string"
    rows = [(i, t, 5, 1, 1, 1, "x") for i, t in docs]
    bench = [(i, t, "x", 1) for i, t in items]
    return (
        spark.createDataFrame(rows, schema),
        spark.createDataFrame(bench, "item_id long, text string, shingles string, start int"),
        docs,
        items,
    )


@pytest.mark.parametrize("most", [500_000, 0])
def test_edge_rows(edge, monkeypatch, most):
    monkeypatch.setattr("tiermill.llm.common.BROADCAST_ROWS", most)
    docs, bench, rows, items = edge
    found = {tuple(r) for r in contaminated(docs, bench).drop("text_md5").collect()}
    assert found == brute(rows, items)
    hit = {(r[0], r[1]) for r in found}
    assert {(1, 1), (2, 1), (3, 1), (None, 1), (10, 1), (8, 2), (9, 5)} <= hit
    assert not {4, 5, 6, 7, 11} & {i for i, _ in hit if i}


def test_clean_rows_stay(edge):
    docs, bench, *_ = edge
    kept = without_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6, 7, 11]


def test_empty_tables(spark, edge, no_docs):
    docs, bench, rows, _ = edge
    assert contaminated(no_docs, bench).count() == 0
    assert contaminated(docs, bench.limit(0)).count() == 0
    assert without_contaminated(docs, bench.limit(0)).count() == len(rows)


def test_long_arrays_are_summed_in_parts(spark):
    hashes = [xxhash.xxh64_intdigest(str(i)) for i in range(70_000)]
    signed = [h - 2**64 if h >> 63 else h for h in hashes]
    df = spark.createDataFrame([(signed,)], "of array<long>")
    assert df.select(decontaminate.simhash("of")).first()[0] % 2**64 == simhash(hashes)


def test_plan_has_no_python(edge):
    docs, bench, *_ = edge
    text = contaminated(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def every_window(docs, items):
    """The highest similarity of any window of a document's that is within the radius."""
    out = {}
    for item_id, item in items:
        width = min(5, len(words(item)))
        wanted = shingles(item, width) if width else []
        for doc_id, text in docs:
            of = shingles(text, width) if width else []
            for start in range(max(1, len(of) - len(wanted) + 1)) if of and wanted else ():
                window = of[start : start + len(wanted)]
                a, b = Counter(window), Counter(wanted)
                alike = (a & b).total() / (a | b).total()
                if alike >= 0.8 and (simhash(window) ^ simhash(wanted)).bit_count() <= decontaminate.RADIUS:
                    out[doc_id, item_id] = max(out.get((doc_id, item_id), 0), alike)
    return out


def test_every_window_counts(spark):
    item = prose(80, 60).split()
    turned = " ".join(item[30:] + item[:30])
    moved = " ".join(["x", "y", *item[2:30], "put", "in", *item[30:58], "z"])
    docs = [
        (1, f"{prose(81, 100)} {turned} {prose(82, 100)}"),
        (2, turned),
        (3, f"{prose(83, 90)} {moved} {prose(84, 90)}"),
        (4, f"{prose(85, 70)} {' '.join(item)} {turned} {prose(86, 70)}"),
        (5, f"{prose(87, 70)} {' '.join(item[:40])}"),
    ]
    items = [(1, " ".join(item)), (2, prose(88, 60))]
    frames = (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in contaminated(*frames).collect()}
    assert found == every_window(docs, items)
    assert {(1, 1), (2, 1), (4, 1)} <= set(found)
