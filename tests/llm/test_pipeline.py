"""The corpus pipeline, stage by stage, on planted documents."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from customer_canon.llm import mixing


@pytest.fixture(scope="module")
def planted(spark, make_docs, text_of, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    docs = [(i, text_of(i, 80 + i % 50) + (f" write to user{i}@mail{i}.org" if i % 10 == 0 else ""), f"src{i % 3}") for i in range(150)]
    docs += [(1000 + i, docs[i][1], "src0") for i in range(20)]
    docs += [(1100 + i, docs[30 + i][1].replace(" of", " off", 1) + " end", "src1") for i in range(10)]
    junk = [(2000 + i, " ".join(w + "###" for w in text_of(500 + i).split()), "src2") for i in range(60)]
    make_docs(docs + junk).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1) for i, _, _ in docs] + [(i, 0) for i, _, _ in junk]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), docs, junk


def test_stages(spark, planted):
    folder, docs, junk = planted
    frames = [spark.read.parquet(f"{folder}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frames[-1], folder).cache()
        assert out.columns == frames[0].columns
        frames.append(out)
    good, single, clean, mixed = frames[1:]
    assert {r.doc_id for r in good.collect()} == {i for i, _, _ in docs}
    ids = {r.doc_id for r in single.collect()}
    assert ids >= set(range(150)) and not ids & set(range(1000, 1020)) and single.count() == len(ids)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert set(texts) == ids and sum("[EMAIL]" in t for t in texts.values()) == 15
    assert not any(re.search(r"@mail", t) for t in texts.values())
    words = sum(len(t.split()) for t in texts.values())
    assert sum(len(r.text.split()) for r in mixed.collect()) == pytest.approx(1.5 * words, abs=9)


def test_run(spark, planted):
    folder, docs, junk = planted
    rows = corpus_pipeline.run(spark, folder).collect()
    assert not {r.doc_id for r in rows} & {i for i, _, _ in junk}
    total = Counter()
    for r in rows:
        assert r.length == len(r.ids)
        total[r.sequence_id] += r.length
    assert max(total.values()) <= 1024
    assert mixing.RANGE_DIGITS == 3 and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality",
        "near_copies",
        "personal_data",
        "mixing",
        "packing",
    ]
