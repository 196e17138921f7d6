"""Every operator and stage on nulls, empty and long texts, ties, repeated
rows, empty tables and extra columns with clashing names."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from medstar.llm import (decontaminate, kd_shards, language_centroids, licence_digests,
                         line_edit_join, line_frequency, mixing, order_minhash, token_orc,
                         toxicity_zstd)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["score", "shard", "slot", "size", "key", "id", "__row", "__key", "__id", "band", "node",
           "label", "w", "part", "of", "rate", "line", "toxic", "__score", "__leaks", "h", "gone"]


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeghilmnorst") for _ in range(rng.randint(2, 9)))
                    for _ in range(n))


ROWS = [
    (1, words(1, 80), "en", "a", 1), (2, words(1, 80), "en", "b", 1),       # equal texts
    (2, words(1, 80), "en", "b", 1), (3, "", "en", "a", 0), (4, None, "en", "a", None),
    (None, words(2, 60), None, None, None), (None, None, None, None, None),
    (None, None, None, None, None), (5, words(3, 60_000), "de", "a", 5),    # a very long text
    (6, "x", "de", "c", 1), (7, "  \n\n\t ", "de", "c", 4), (8, "12 !! 34", None, "c", 8),
    (9, words(4, 30) + "\n" + words(4, 30), "fr", None, 9),
    (10, "\U0001F600 ÄÖ ß ǅ ́é <|endoftext|>", "fr", "a", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ROWS, SCHEMA)
    return plain.withColumns({c: F.lit(c) for c in CLASHES})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 1), (1, 1, 0), (2, 0, 0), (5, None, 0), (9, 1, None), (None, 1, 1), (6, 1, 0)],
        "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, words(4, 30)), (1, words(4, 30)), (2, None), (3, ""), (4, "x"), (None, words(9, 20))],
        "item_id long, text string")


def operators(labels, benchmark):
    import public_tokenizers

    def toxic(d):
        return toxicity_zstd.score_toxicity(d, toxicity_zstd.fit_toxicity(d, labels))

    return {
        "mix": (mixing.mix, None), "shards": (lambda d: kd_shards.shard_table(d, 16), 14),
        "quality": (line_frequency.quality, 14), "cleaned": (line_frequency.cleaned, None),
        "tokens": (lambda d: token_orc.token_table(d, public_tokenizers.path("word_bpe_49k.json")), 14),
        "lines": (line_edit_join.line_dedup, None), "dedup_text": (line_edit_join.dedup_text, 14),
        "licences": (licence_digests.licence_hits, None),
        "language": (lambda d: language_centroids.identify(d, language_centroids.fit_languages(d)), 14),
        "leaks": (lambda d: decontaminate.contaminated(d, benchmark), None),
        "toxic": (toxic, 14), "near": (order_minhash.near_duplicates, 14),
    }


NAMES = ["mix", "shards", "quality", "cleaned", "tokens", "lines", "dedup_text", "licences",
         "language", "leaks", "toxic", "near"]


@pytest.mark.parametrize("name", NAMES)
def test_edge_rows(docs, labels, benchmark, name):
    run, rows = operators(labels, benchmark)[name]
    got = run(docs).toPandas()
    if rows is not None:
        assert len(got) == rows
    if name == "mix":
        assert (got["epoch"] == 0).sum() == 14
    if name == "language":
        by = got.set_index("doc_id")["lang_pred"]
        assert by[8] == by[3] == by[7] == "und" and by[6] != "und"
    if name == "leaks":
        assert got["doc_id"].tolist() == [9] and got["item_id"].tolist() == [1]
    if name == "tokens":
        assert got.set_index("doc_id")["n_tokens"][[3, 4, 7]].tolist() == [1, 1, 1]
        assert got["start"].max() + got.loc[got["start"].idxmax(), "n_tokens"] == got["n_tokens"].sum()
    if name == "near":
        by = got.dropna(subset=["id"]).set_index("id")["class_id"]
        assert by[1] == 1 and set(by[[2]]) == {1} and by[9] == 9 and by[3] == by[4] == 3
    if name == "quality":
        by = got.set_index("doc_id")
        assert by["n_words"][4] == 0 and bool(by["base_failed"][4]) and not by["kept"][4]


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(empty, labels, benchmark, name):
    assert operators(labels, benchmark)[name][0](empty).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, docs, empty, labels, benchmark, tmp_path, name, stage):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = stage(spark, read, str(tmp_path))
    columns = [c for c in read.columns if c != "shard"] + ["shard"] if name == "sharding" else read.columns
    assert got.columns == columns
    rows = got.select("doc_id", "text").collect()
    ids = sorted(r["doc_id"] for r in rows if r["doc_id"] is not None)
    if name == "near_duplicates":
        assert ids == [1, 3, 5, 6, 7, 8, 9, 10] and len(rows) == 9
    if name == "decontamination":
        assert 9 not in ids and len(rows) == 13
    if name == "mixture":
        assert len(rows) >= 14
    if name == "sharding":
        assert len(rows) == 14
    empty.write.parquet(f"{tmp_path}/none.parquet")
    assert stage(spark, spark.read.parquet(f"{tmp_path}/none.parquet"), str(tmp_path)).count() == 0


def test_empty_side_tables(spark, docs, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    model = toxicity_zstd.fit_toxicity(docs, labels)
    assert {r["score"] for r in toxicity_zstd.score_toxicity(docs, model).collect()} == {0.0}
    assert decontaminate.contaminated(docs, benchmark).count() == 0
    assert decontaminate.drop_contaminated(docs, benchmark).count() == 14
