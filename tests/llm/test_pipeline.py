from collections import Counter

from test_decontaminate import brute as brute_contaminated
from test_packing import check as check_packing
from test_simhash import brute_components, plain_fingerprint
from tests_llm_text import edge_docs  # noqa: F401

import corpus_pipeline
from corpus_pipeline import STAGES, run
from tiermill.llm.substring import repeated_passages, without_words
from tiermill.llm.toxicity import toxicity

SF_DIR = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage's rows on its own input, and the pipeline's result from the last."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    kept = [r.asDict() for r in docs.collect()]
    for name, stage in STAGES[:-1]:
        if name == "toxicity":
            labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
            clean = {r["doc_id"] for r in toxicity(docs, labels).collect() if not r["predicted"]}
            kept = [r for r in kept if r["doc_id"] in clean]
        elif name == "near_dedup":
            pairs = [(r["doc_id"], plain_fingerprint(r["text"])) for r in kept]
            first = {i for i, _, c in brute_components(pairs, 4) if i == c}
            kept = [r for r in kept if r["doc_id"] in first]
        elif name == "substring_dedup":
            spans = {}
            for r in repeated_passages(docs).collect():
                spans.setdefault(r["doc_id"], []).append((r["start"], r["stop"]))
            for r in kept:
                if r["doc_id"] in spans:
                    r["text"] = without_words(r["text"], *zip(*spans[r["doc_id"]]))
                    r["n_chars"] = len(r["text"])
            kept = [r for r in kept if r["doc_id"] not in spans or r["text"].strip()]
        else:
            items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()
            texts = [(r["doc_id"], r["text"]) for r in kept]
            found = {i for i, *_ in brute_contaminated(texts, [tuple(i) for i in items])}
            kept = [r for r in kept if r["doc_id"] not in found]
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        ours = Counter(tuple(r) for r in docs.collect())
        assert ours == Counter(tuple(r[c] for c in columns) for r in kept), name
    found = run(spark, SF_DIR).selectExpr(
        "doc_id", "piece", "start", "length", "crc32(ids)", "sequence_id", "offset"
    )
    check_packing([(r["doc_id"], r["text"]) for r in kept], found.collect(), 4096)


def test_edge_rows_pass_through_all_stages(spark, edge_docs):
    docs = edge_docs
    for name, stage in STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == edge_docs.columns, name
    packed = STAGES[-1][1](spark, docs, SF_DIR)
    assert packed.count() >= docs.select("doc_id").distinct().count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_table_passes_through_all_stages(spark, edge_docs):
    docs = edge_docs.limit(0)
    for _, stage in STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0
