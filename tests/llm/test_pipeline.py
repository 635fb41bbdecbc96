"""Each stage against a plain version on its own input."""

import corpus_pipeline
from llm_helpers import SF_SMALL, texts_of
from test_dedup import brute_lines
from test_jaccard_join import brute

from matchlog.llm import langid, toxicity
from matchlog.llm.common import read, stored


def test_stages(spark, tokenizer):
    docs = read(spark, SF_SMALL, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stored(stage(spark, docs, SF_SMALL), "test-stage")
        before, rows = texts_of(docs), kept.collect()
        if name == "toxicity":
            scores = toxicity.predict(docs, toxicity.train(docs, read(spark, SF_SMALL, "labels"))).collect()
            assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in scores if not r["predicted"]}
        elif name == "language_id":
            told = langid.predict(docs, langid.train(docs)).collect()
            assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in told if r["score"] >= 0.5 and r["lang_pred"] != "und"}
        elif name == "line_dedup":
            expected = {i: text for i, _, _, text in brute_lines(list(before.items()))}
            assert {str(r["doc_id"]): r["text"] for r in rows} == expected
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        elif name == "ngram_jaccard_join":
            assert {str(r["doc_id"]) for r in rows} == {i for i, _, c in brute(list(before.items())) if i == c}
        else:
            tokens = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in before.items()}
            for r in rows:
                seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + r["length"]
            assert seen == tokens
        if name != "best_fit_packing":
            assert kept.columns == columns
            if name != "line_dedup":
                assert all(before[r["doc_id"]] == (r["text"] or "") for r in rows)
        docs = kept


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 0


def test_awkward_documents_pass(spark, awkward, empty, tmp_path):
    spark.createDataFrame([(5, 0), (4, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (awkward, empty):
        n = docs.count()
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)), "test-stage")
        assert (docs.count() > 0) == (n > 0)


def test_near_copies_with_repeated_and_null_ids(spark):
    one, two, three = (" ".join(f"{c}{k}" for k in range(30)) for c in "abc")
    rows = [(1, one), (1, one), (2, one), (3, two), (4, two), (4, three), (None, "few words"), (None, "w x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    expected = [(1, one), (1, one), (3, two), (4, two), (4, three), (None, "few words"), (None, "w x")]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, expected))
