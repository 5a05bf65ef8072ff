"""The stages one after another, each against what it promises."""

import os
import random

import corpus_pipeline
import pytest

from capsieve.llm.store import written

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = seen[name] = written(stage(spark, docs, FOLDER), name)
        if name != "packing":
            assert docs.columns == columns
    ids = {name: {r.doc_id for r in df.select("doc_id").distinct().collect()} for name, df in seen.items()}
    assert ids["packing"] == ids["pii"] == ids["substring_dedup"] == ids["near_dedup"] < ids["documents"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = [labels[i] for i in ids["quality"] if i in labels]
    assert sum(kept) / len(kept) > 0.95
    assert seen["pii"].where("text RLIKE '[a-z]@[a-z0-9]+[.]example'").count() == 0


@pytest.mark.parametrize("stage", range(5))
def test_empty(spark, stage):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    assert corpus_pipeline.STAGES[stage][1](spark, docs, FOLDER).count() == 0


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, ties and columns named like the stages' own, among ordinary documents."""
    rng = random.Random(12)
    words = [f"{a}{b}" for a in ("har", "mel", "tor", "quin", "sab") for b in ("vest", "low", "ine", "ador", "uth", "ery")]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randint(40, 90))) + "." for _ in range(30)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows = [(i, t) for i, t in enumerate(prose)]
    rows += [(100, None), (101, ""), (None, prose[0]), (None, None), (103, " \t "), (104, prose[3]), (104, prose[3]), (105, prose[3]),
             (106, f"{prose[4]} {passage}"), (107, f"{prose[5]} {passage}"), (108, " ".join(rng.choice(words) for _ in range(30_000))),
             (109, f"{passage[::-1]} write to who@mail.example or 10.1.2.3")]
    table = spark.createDataFrame([(i, t, "s", 1, 2, "x", 3, "y", True) for i, t in rows],
                                  "doc_id long, text string, source string, `_lost` int, lost int, row string, id int, predicted string, kept boolean")
    return written(table.repartition(3), "odd"), rows


@pytest.mark.parametrize("stage", range(4))
def test_odd_rows(spark, odd, stage):
    docs, rows = odd
    name, function = corpus_pipeline.STAGES[stage]
    out = written(function(spark, docs, FOLDER), name)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    ids = [i for i, _ in got]
    assert {tuple(r)[2:] for r in out.select(*docs.columns).collect()} == {("s", 1, 2, "x", 3, "y", True)}
    if name == "near_dedup":
        assert sorted(i for i in ids if i is not None) == sorted(i for i, _ in rows if i is not None and i not in (104, 105)) and ids.count(None) == 2
    elif name != "quality":
        assert sorted(map(str, ids)) == sorted(str(i) for i, _ in rows)
    text = dict(got)
    if name == "substring_dedup":
        assert text[3] == rows[3][1] and text[104].strip() == text[105].strip() == "" and len(text[107]) < len(text[106]) and text[100] == ""
    if name == "pii":
        assert text[109].endswith("write to [EMAIL] or [IP]") and text[100] is None and all(text[i] == rows[i][1] for i in range(30))


def test_packing_of_odd_rows(spark, odd):
    docs, rows = odd
    pieces = written(corpus_pipeline.STAGES[4][1](spark, docs, FOLDER), "packing").collect()
    assert len([r for r in pieces if r.piece == 0]) == len(rows)
    assert sorted(r.length for r in pieces if r.doc_id in (100, 101, 103)) == [1, 1, 1] and max(r.piece for r in pieces if r.doc_id == 108) > 5


def test_intermediate_tables_go(spark, odd):
    """Tables of a stage are deleted when the next begins, but not while its unwritten result is passed on."""
    docs, _ = odd
    first = corpus_pipeline.one_of_each(spark, docs, FOLDER)
    passed = corpus_pipeline.without_personal_data(spark, first, FOLDER)
    assert passed.count() == first.count() > 0
    underway = list(corpus_pipeline._underway)
    corpus_pipeline.good_quality(spark, docs, FOLDER)
    assert underway and not set(underway) & set(corpus_pipeline._underway)
    assert not any(os.path.exists(p.removeprefix("file://")) for p in underway)
