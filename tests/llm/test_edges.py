"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from glyphmill.llm import decontaminate, embedding_dedup, jaccard_join, language_id, packing, quality, sharding, substring_dedup, token_store, warc
from glyphmill.llm._spark import shared_dir

LONG = " ".join(f"w{i * 7919 % 4001}" for i in range(30_000))
SAME = " ".join(f"s{i}" for i in range(60))
ROWS = [
    (None, "no key here at all", "en"), (1, None, "en"), (2, "", None), (3, " \n\t ", "en"), (4, "a", "en"), (5, SAME, "en"),
    (6, SAME, "fr"), (7, LONG, "en"), (8, SAME, "en"), (8, SAME, "en"), (9, "é ü 中 <|endoftext|> \U0001f600", None), (10, "!!! 123", "en"), (None, None, None),
]
CLASH = ("k", "n", "ids", "block", "score", "held_out", "tokens", "bucket", "row", "file", "component_id")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return rows.withColumns({c: F.lit("clash") for c in CLASH}).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 0, 0), (5, 1, 0), (6, 1, 0), (None, 1, 0), (7, None, 0), (8, 1, 1)], "doc_id long, quality int, toxic int")


def ids(rows):
    return sorted((r.doc_id for r in rows), key=lambda x: (x is not None, x))


ALL = sorted((r[0] for r in ROWS), key=lambda x: (x is not None, x))


def test_language(docs):
    got = language_id.predict_languages(docs, language_id.learn_languages(docs)).collect()
    assert ids(got) == ALL
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 10)} == {"und"}
    empty = docs.limit(0)
    assert language_id.predict_languages(empty, language_id.learn_languages(empty)).count() == 0
    assert {r.lang_pred for r in language_id.predict_languages(docs, language_id.learn_languages(empty)).collect()} == {"und"}


def test_quality(docs, labels):
    model = quality.train_quality(docs, labels)
    got = quality.score_quality(docs, model).collect()
    assert ids(got) == ALL and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert quality.score_quality(docs, quality.train_quality(docs, labels.limit(0))).where("score <> 0.5").count() == 0
    assert quality.score_quality(docs.limit(0), model).count() == 0


def test_jaccard(docs):
    got = jaccard_join.jaccard_components(docs).collect()
    assert ids(got) == ALL
    assert {r.doc_id: r.component_id for r in got if r.doc_id} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 5, 9: 9, 10: 10}
    assert {r.n_shingles for r in got if r.doc_id in (1, 2, 3)} == {0} and {r.n_shingles for r in got if r.doc_id in (4, 10)} == {1}
    assert jaccard_join.jaccard_components(docs.limit(0)).count() == 0


def test_substring(docs):
    got = substring_dedup.find_repeats(docs, carry=("lang", "k")).collect()
    assert ids(got) == ALL
    removed = {(r.doc_id, r.n_words, r.n_removed) for r in got if r.doc_id in (5, 6, 8)}
    assert removed == {(5, 60, 0), (6, 60, 60), (8, 60, 60)}
    seven = next(r for r in got if r.doc_id == 7)
    assert seven.n_words == 30_000 and seven.n_removed == 30_000 - 4001
    assert next(r.kept_text for r in got if r.doc_id == 9) == ROWS[10][1]
    assert all(r.carried.k == "clash" for r in got)
    assert substring_dedup.find_repeats(docs.limit(0)).count() == 0


def test_leaks(spark, docs):
    bench = spark.createDataFrame([(1, SAME.upper()[:120]), (1, SAME[:120]), (2, None), (3, ""), (4, "short"), (5, ROWS[10][1].split(" <")[0].replace(" ", "  ")), (6, "s1"), (None, LONG[2000:2400])], "item_id long, text string").withColumn("t", F.lit(1)).where("item_id is null or item_id <> 6")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == {(5, 1), (6, 1), (8, 1), (7, None), (9, 5)}
    # a long item by any part, or by all
    parts = spark.createDataFrame([(1, SAME + " " + LONG[: len(SAME) - 1]), (2, LONG[:1200])], "item_id long, text string")
    cut = {"max_pattern": len(SAME), "indexes_per_pass": 1, "index_bytes": 500}
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, parts, decontaminate.LeakParams(**cut)).collect()} == {(5, 1), (6, 1), (8, 1), (7, 1), (7, 2)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, parts, decontaminate.LeakParams(whole_items=True, **cut)).collect()} == {(7, 2)}
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def test_sharding(docs):
    got = sharding.shard_documents(docs).collect()
    assert ids(got) == ALL
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert {(r.size, r.text_crc32) for r in got if r.doc_id in (1, 2)} == {(1, 0)}
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_packing(docs):
    got = packing.pack_documents(docs).collect()
    assert {r.doc_id for r in got} == set(ALL)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert {r.doc_tokens for r in got if r.doc_id in (1, 2)} == {1}
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_tokens(spark, docs):
    folder = shared_dir(spark, "edge-tokens")
    got = token_store.read_token_store(spark, folder, token_store.write_token_store(docs, folder)).orderBy("start").collect()
    assert [r.doc_id for r in got] == ALL
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    folder = shared_dir(spark, "edge-none")
    assert token_store.read_token_store(spark, folder, token_store.write_token_store(docs.limit(0), folder)).count() == 0


def test_warc(spark):
    rows = [(1, "u", "same"), (2, None, "same"), (3, "a\r\nb", None), (4, "u", ""), (5, "u", "x" * 300_000), (None, "u", "same"), (2, None, "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in ("k", "u", "p", "head")})
    folder = shared_dir(spark, "edge-warc")
    got = warc.read_warc(spark, folder, warc.write_warc(pages, folder)).collect()
    assert sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in got) == sorted(
        [(1, 4, "revisit", 2), (2, 4, "response", None), (2, 4, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (5, 300_000, "response", None), (0, 4, "response", None)], key=lambda r: r[:3]
    )
    folder = shared_dir(spark, "edge-warc0")
    assert warc.read_warc(spark, folder, warc.write_warc(pages.limit(0), folder)).count() == 0


def test_embeddings(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [0.0, 1.0]), (9, [1.0]), (1, [1.0, 0.1]), (None, [1.0, 0.0]), (10, [1e300, 1e300])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("clash") for c in ("row", "v", "t", "label")})
    got = embedding_dedup.link_embeddings(vectors).collect()
    assert len(got) == len(rows)
    assert {(r.component_id, r.kept) for r in got if r.vec_id == 1} == {(1, True)}
    assert {(r.component_id, r.n_links, r.kept) for r in got if r.vec_id == 2} == {(1, 3, False)}
    assert all((r.n_links, r.component_id) == (0, r.vec_id) for r in got if r.vec_id in (3, 4, 5, 6, 7, 8, 9, 10))
    assert embedding_dedup.link_embeddings(vectors.limit(0)).count() == 0
    assert embedding_dedup.link_embeddings(vectors.where("vec_id in (3, 4)")).count() == 2


def test_stages(spark, docs, labels, tmp_path):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    bench = spark.createDataFrame([(1, "nothing of the kind is found in any text")], "item_id long, text string")
    for name, table in (("documents", plain), ("labels", labels), ("benchmark", bench)):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    for source in (plain, plain.limit(0)):
        rows = source
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            rows = corpus_pipeline.keep(stage(spark, rows, str(tmp_path)), str(tmp_path / f"{source is plain}{number}"))
            if number < 4:
                assert rows.columns == plain.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
