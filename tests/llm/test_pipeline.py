"""The pipeline's stages, each on what the one before kept."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from lotwise.llm import queries
from tests.llm.test_operators import prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(50)
    item = prose(rng, 40)
    texts = [prose(rng, rng.randint(60, 200)) for _ in range(240)]
    docs = [(i, t) for i, t in enumerate(texts)]
    docs = [(i, " ".join(w.upper() + "!!" for w in t.split()) if i % 4 == 3 else t) for i, t in docs]
    near = texts[0].split()
    docs += [(500, texts[0]), (501, " ".join(near[:30] + ["odd"] + near[31:])), (502, prose(rng, 60) + " " + item), (503, prose(rng, 80) + " AKIA" + "Q" * 16)]
    docs += [(504, texts[1]), (504, texts[1]), (505, None), (None, texts[2])]
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path + "/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 != 3), 0) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(path + "/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(path + "/benchmark.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(folder + "/documents.parquet")
    columns, kept = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    ids = {name: Counter(r["doc_id"] for r in rows) for name, rows in kept.items()}
    good = {i for i in range(240) if i % 4 != 3}
    assert len([i for i in good if i in ids["quality"]]) >= 0.98 * len(good) and not [i for i in range(3, 240, 4) if i in ids["quality"]]
    assert 0 in ids["near_dedup"] and not {500, 501} & set(ids["near_dedup"])
    assert ids["near_dedup"][504] + ids["near_dedup"][1] == 1 and ids["near_dedup"][None] + ids["near_dedup"][2] == 1
    assert len([i for i in good if i in ids["near_dedup"]]) >= 0.98 * len(good) - 2
    assert 502 not in ids["decontamination"] and ids["near_dedup"] - ids["decontamination"] == Counter({502: 1})
    assert ids["secrets"] == ids["decontamination"]
    clean = {r["doc_id"]: r for r in kept["secrets"]}
    assert clean[503]["text"].endswith(" [SECRET]") and clean[503]["n_chars"] == len(clean[503]["text"])
    assert {r["doc_id"] for r in kept["packing"]} == set(ids["secrets"])


def test_the_quality_query_grades_rejected_documents_too(spark, folder):
    docs = spark.read.parquet(folder + "/documents.parquet")
    found = queries.op6_quality_classifier(spark, folder).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in docs.collect())
    assert all(r["accepted"] == (r["p_good"] >= 0.5) for r in found) and not all(r["accepted"] for r in found)


def test_run_gives_the_last_stage(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(found.columns) and found.count() > 100


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
