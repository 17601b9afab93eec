"""The stages against brute force, and on the driver's tables."""

import re

import corpus_pipeline
import __spark_entry__ as spark_entry

from tests.llm.test_documents import alnum, contaminated, near

SF = "/root/testdata/sf0.001"


def rows(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language"](spark, docs, SF)
    gone = {d for d, _ in rows(docs)} - {d for d, _ in rows(kept)}
    assert kept.columns == columns and all(not re.search(r"[^\W\d_]{2}", t or "") for d, t in rows(docs) if d in gone)
    before = rows(kept)
    kept = stages["near_duplicates"](spark, kept, SF)
    assert kept.columns == columns
    assert sorted(d for d, _ in rows(kept)) == sorted({c for _, n, c in near(before) if n} | {d for d, n, _ in near(before) if not n})
    before = rows(kept)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = stages["clean_of_benchmark"](spark, kept, SF)
    clean = [d for (d, _), (_, hit, _) in zip(before, contaminated_fast(before, items)) if not hit]
    assert kept.columns == columns and sorted(d for d, _ in rows(kept)) == sorted(clean) and len(clean) < len(before)
    kept = stages["mixture"](spark, kept, SF)
    assert kept.columns == columns
    packed = stages["packed"](spark, kept, SF)
    assert {d for r in packed.collect() for d in r.doc_ids} == {d for d, _ in rows(kept)}


def contaminated_fast(docs, items):
    """Brute force with windows in a table."""
    windows = {}
    for item, text in items:
        w = alnum(text)
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for _, text in docs:
        w = alnum(text)
        out.append((len(w), sum(tuple(w[i : i + k]) in windows for k in range(1, 11) for i in range(len(w) - k + 1)), []))
    return out


def test_brute_forces_agree():
    docs, items = [(1, "a b c d e f g h i j k"), (2, "x")], [(1, "b c d e f g h i j k l"), (2, "x")]
    assert [bool(h) for _, h, _ in contaminated(docs, items)] == [bool(h) for _, h, _ in contaminated_fast(docs, items)] == [True, True]


def test_run_and_registration(spark):
    queries = spark_entry.queries()
    assert "pipeline" in queries and sum(re.match(r"op\d+_", q) is not None for q in queries) == 10
    packed = queries["pipeline"](spark, SF)
    assert packed.count() > 0 and [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "clean_of_benchmark", "mixture", "packed"]
