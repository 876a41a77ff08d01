"""The pipeline stage by stage against brute force on its own input."""

import hashlib

import corpus_pipeline
from indexloom.llm import common, language
from test_minhash import brute as near
from test_substring import brute as substrings
from test_text_operators import check_packing

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    junk = spark.createDataFrame([(10_001, "12 34 !!", "en", "s", 8), (10_002, None, None, "s", 0)], docs.schema)
    docs = docs.unionByName(junk)
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        if name == "language":
            sure = {r["doc_id"] for r in language.identify(docs).where("lang_pred <> 'und' AND score >= 0.4").collect()}
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        docs = stage(spark, docs, SF)
        if name != "packing":
            assert docs.columns == columns
            rows[name] = after = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "language":
            assert set(after) == sure and not {10_001, 10_002} & sure
        if name == "exact_dedup":
            last = {}
            for d, t in before:
                key = bytes(t.encode()).translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
                last[key] = max(d, last.get(key, d))
            assert set(after) == set(last.values())
        if name == "near_dedup":
            assert set(after) == {d for d, _, _, kept in near(before, 5) if kept}
        if name == "substring_dedup":
            want = {d: sha for d, n, gone, sha in substrings(before, 50) if not n or gone < n}
            assert {d: hashlib.sha256(" ".join(t.split()).encode()).hexdigest() for d, t in after.items()} == want
        if name == "packing":
            check_packing([tuple(r) for r in docs.collect()], before)
    assert len(rows["language"]) > len(rows["exact_dedup"]) > len(rows["near_dedup"]) >= len(rows["substring_dedup"]) > 0


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.where("doc_tokens > 0").count() == out.count() > 0


def test_rows_are_dropped_not_ids(spark, monkeypatch):
    """A text that nothing else has stays, whatever other rows its id has."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_id int"
    docs = spark.createDataFrame([(5, "x y", "en", "s", 3, 0), (5, "unique text here", "en", "s", 16, 1), (9, "X y", "en", "s", 3, 2), (None, "x Y", "en", "s", 3, 3), (5, "unique text here", "en", "s", 16, 4), (None, None, None, None, None, None)], schema)
    for few in (0, common.FEW_IDS):
        monkeypatch.setattr(common, "FEW_IDS", few)
        out = corpus_pipeline.drop_exact_copies(spark, docs, SF)
        assert out.columns == docs.columns
        assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted([(9, "X y"), (5, "unique text here"), (None, None)], key=str)
    base = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(5, base, "en", "s", 1, 0), (5, "unique text here is all there is", "en", "s", 1, 1), (3, base + " end", "en", "s", 1, 2), (None, base + " End", "en", "s", 1, 3)], schema)
    got = sorted(((r["doc_id"], r["row_id"]) for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()), key=str)
    assert got == [(3, 2), (5, 1)]
