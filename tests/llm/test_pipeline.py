import shutil

import corpus_pipeline
import pytest

from .conftest import LONG, prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, make_docs):
    """A small corpus with one case for each stage."""
    place = tmp_path_factory.mktemp("corpus")
    base = [(i, prose(i, 60, words=3000), "en" if i % 2 else "fr") for i in range(30)]
    item = prose(777, 30)
    copy = base[3][1].split()
    copy[5] = "other"
    rows = base + [
        (100, base[0][1], "fr"),
        (101, " ".join(copy), "en"),
        (102, prose(50, 40) + " " + item + " " + prose(51, 40), "en"),
        (103, "12345 !!!", "en"),
        (104, None, "en"),
        (105, base[1][1] + "\n" + prose(88, 30), "en"),
        (106, LONG, None),
        (107, prose(61, 60), "en"),
        (107, prose(61, 60), "en"),
        (None, prose(62, 60), "en"),
    ]
    make_docs(rows).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return str(place)


def test_stages(spark, folder, monkeypatch):
    from rivulet.llm import language

    learn = language.learn
    monkeypatch.setattr(corpus_pipeline, "learn", lambda docs: learn(docs, steps=20))
    monkeypatch.setattr(corpus_pipeline, "LEAST_SCORE", 0.0)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        seen[name] = docs.collect()
    ids = {n: {r.doc_id for r in rows} for n, rows in seen.items()}
    everyone = {*range(30), *range(100, 108), None}
    assert ids["language"] == everyone - {103, 104}
    assert ids["lines"] == ids["language"] - {100}
    texts = {r.doc_id: r for r in seen["lines"]}
    assert texts[105].text == prose(88, 30) and texts[105].n_chars == len(prose(88, 30))
    assert ids["near_duplicates"] == ids["lines"] - {101}
    assert [r.doc_id for r in seen["near_duplicates"]].count(107) == 1
    assert ids["decontamination"] == ids["near_duplicates"] - {102}
    assert ids["packing"] == ids["decontamination"]
    for k in range(5):
        shutil.rmtree(f"{folder}/{k}")


def test_empty_input(spark, tmp_path, empty):
    empty.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    from rivulet.llm.common import TABLES

    before = len(TABLES)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert len(TABLES) == before + len(corpus_pipeline.STAGES)
