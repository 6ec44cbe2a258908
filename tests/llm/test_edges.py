"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import ann, chaining, knn, language_id, line_dedup, mixing, packing, simhash, suffix_dedup, warc
from starloom.llm._common import new_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "row int, fp string, key string, n int, spans int, component_id int, core int, line int, mix_slot int, size int, first int, score string"
LONG = "le petit chat dort " * 40000
WORDS = {"en": "the house and the river with many of those things that were there", "fr": "la maison et le fleuve avec beaucoup de ces choses qui étaient là", "de": "das haus und der fluss mit vielen von diesen dingen die dort waren"}


def odd_rows():
    rows = [(i, f"{WORDS[k]} {i % 7} {w}", k, f"s{i % 3}", 50) for i, (k, w) in enumerate((k, w) for k in WORDS for w in ("alpha", "beta", "gamma", "delta") * 4)]
    rows += [(100, None, "en", "s0", None), (101, "", None, None, 0), (102, "12345 !!!", "en", "s1", 9), (103, LONG, "fr", "s1", len(LONG)), (104, "\n\n", "en", "s0", 2), (None, "the house of the null id", None, "s0", 5)]
    rows += [(7, rows[7][1], "en", "s1", 50)] * 2 + [(105, "Ω" * 900, "en", "s0", 900), (106, "Ω" * 900, "en", "s0", 900), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    rows = spark.createDataFrame(odd_rows(), DOCS)
    extra = {c.split()[0]: F.lit(1).cast(c.split()[1]) for c in CLASH.split(", ")}
    rows.withColumns(extra).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], DOCS).write.parquet(path)
    return spark.read.parquet(path)


N = len(odd_rows())


def test_language(odd, nothing):
    model = language_id.train(odd)
    found = language_id.predict(odd, model)
    assert found.count() == N and "text" not in found.columns and {"row", "score"} <= set(found.columns)
    by_id = {r["doc_id"]: r for r in found.where("doc_id >= 100").collect()}
    for k in (100, 101, 102, 104):
        assert (by_id[k]["lang_pred"], by_id[k]["score"], by_id[k]["accepted"]) == ("und", 0.0, False)
    assert by_id[103]["lang_pred"] == "fr"
    assert language_id.predict(nothing, model).count() == 0
    none = language_id.train(nothing)
    assert {r["lang_pred"] for r in language_id.predict(odd, none).collect()} == {"und"}
    one = language_id.train(odd.where("lang = 'fr'"))
    assert {r["lang_pred"] for r in language_id.predict(odd, one).collect()} == {"und", "fr"}


def test_simhash(odd, nothing):
    found = simhash.near_duplicates(odd)
    assert found.count() == N
    rows = {r["doc_id"]: r for r in found.collect()}
    assert rows[100]["fingerprint"] == rows[101]["fingerprint"] == rows[104]["fingerprint"] == "0" * 16
    assert rows[104]["component_id"] == rows[101]["component_id"] == 100
    assert rows[106]["component_id"] == 105
    assert simhash.near_duplicates(nothing).count() == 0


def test_substrings(odd, nothing):
    rows = {r["doc_id"]: r for r in suffix_dedup.dedup_substrings(odd).collect()}
    assert suffix_dedup.dedup_substrings(odd).count() == N
    assert (rows[100]["n_bytes"], rows[100]["n_removed"], rows[100]["n_spans"]) == (0, 0, 0)
    assert (rows[105]["n_bytes"], rows[105]["n_removed"], rows[105]["n_spans"]) == (1800, 1800, 1)
    assert rows[103]["n_removed"] == len(LONG)
    assert suffix_dedup.dedup_substrings(nothing).count() == 0
    with pytest.raises(ValueError, match="length"):
        suffix_dedup.dedup_substrings(odd, 8)


def test_lines(odd, nothing):
    found = line_dedup.dedup_lines(odd)
    assert found.count() == N and "size" in found.columns
    rows = {r["doc_id"]: r for r in found.collect()}
    assert (rows[100]["text"], rows[100]["line_count"]) == (None, 0)
    assert (rows[101]["text"], rows[101]["line_count"], rows[101]["lines_removed"]) == ("", 1, 0)
    assert (rows[104]["line_count"], rows[104]["lines_removed"], rows[104]["runs_removed"]) == (3, 2, 1)
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_passages(odd, nothing):
    found = chaining.passages(odd)
    assert found.where("doc_id = 100").count() == 0 and chaining.passages(nothing).count() == 0


def test_packing(odd, nothing):
    found = packing.pack(odd)
    assert found.select("doc_id").distinct().count() == odd.select("doc_id").distinct().count()
    assert found.agg(F.sum("n_chars")).first()[0] == odd.agg(F.sum(F.length("text"))).first()[0]
    assert packing.pack(nothing).count() == 0


def test_mixing(odd, nothing):
    found = mixing.mix(odd, block_rows=2)
    assert found.count() == N and found.select("mix_slot", "mix_row").distinct().count() == N
    assert found.where("mix_slot < mix_release or mix_slot >= mix_deadline").count() == 0
    assert mixing.mix(nothing).count() == 0
    assert mixing.mixed_order(odd).columns == [c for c in odd.columns if not c.startswith("mix_")]
    assert mixing.mix(odd, {"s0": 3.0}, block_rows=2).count() == N


def test_vectors(spark):
    rows = [(i, [float(i % 7) + 1, 1.0, 0.5]) for i in range(60)] + [(60, None), (61, [0.0, 0.0, 0.0]), (62, [1.0, None, 2.0]), (63, [float("nan"), 1.0, 1.0]), (64, [float("inf"), 1.0, 1.0]), (65, [1.0]), (80, []), (None, [1.0, 1.0, 1.0]), (0, [1.0, 1.0, 0.5])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, query_id string, tree int")
    asked = df.where("vec_id % 20 = 0")
    found = ann.search(df, asked, 20)
    assert {r["query_id"] for r in found.collect()} == {0, 20, 40}
    best = [r["vec_id"] for r in found.where("query_id = 0").orderBy("rank").collect()]
    assert best == sorted(best, key=lambda i: (-(i % 7), i)) and len(best) == 20 and 0 not in best
    found = knn.search(df, df.where("vec_id % 20 = 0 or vec_id = 61"), 5)
    assert {r["query_id"] for r in found.collect()} == {0, 20, 40, 61}
    assert [(r["vec_id"], r["score"]) for r in found.where("query_id = 61").orderBy("rank").collect()] == [(k, 0) for k in range(5)]
    none = df.limit(0)
    for search in (ann.search, knn.search):
        assert search(none, none).count() == search(df, none).count() == search(none, asked).count() == 0
        few = search(df.where("vec_id in (0, 1, 2)"), asked, 20)
        assert few.where("query_id = 0").count() == 2
        assert search(df.where("vec_id in (61)"), asked).where("query_id = 0").count() <= 1


def test_archives(spark):
    pages = spark.createDataFrame([(5, "u", "aa\r\n\r\nWARC/1.1", 1), (2, "u", "aa\r\n\r\nWARC/1.1", 1), (None, "u\r\nX: 1", "aa\r\n\r\nWARC/1.1", 1), (3, None, None, 1), (4, "", "", 1), (4, "", "", 1), (9, "v", LONG * 3, 1)], "page_id long, url string, html string, row int")
    path = new_folder(spark, "warc")
    warc.write_warc(pages, path)
    rows = warc.read_warc(spark, path)
    assert rows.count() == 7
    assert sorted(r["record_id"] for r in rows.where("record_type = 'response'").collect()) == ["<urn:page:2>", "<urn:page:3>", "<urn:page:9>"]
    assert rows.where("payload_length > 100").first()["payload"] == (LONG * 3).encode()
    same = pages.where("page_id = 4")
    warc.write_warc(same, path + "b", min_bytes=1)
    assert warc.read_warc(spark, path + "b").where("record_type = 'revisit'").count() == 0
    warc.write_warc(same, path + "c")
    assert warc.read_warc(spark, path + "c", "record_type string").groupBy("record_type").count().orderBy("record_type").collect() == [("response", 1), ("revisit", 1)]
    warc.write_warc(pages.limit(0), path + "d")
    assert warc.read_warc(spark, path + "d").count() == 0


def test_pipeline_stages(spark, odd, nothing):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, "")
            if name != "packing":
                assert found.columns == list(corpus_pipeline.COLUMNS)
            assert found.count() <= 2 * docs.count()
