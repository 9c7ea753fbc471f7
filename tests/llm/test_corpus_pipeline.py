"""The five stages, each on what the one before kept."""

import corpus_pipeline
import pytest
from conftest import prose
from rivermart.llm import common, pii


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "n-gram Jaccard join", "PII", "mixing sources to target weights", "packing"]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    rows = [(i, prose(i, 40 + i, ("en", "de")[i % 2]), ("en", "de")[i % 2], f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, rows[i][1], rows[i][2], "s0") for i in range(10)]
    rows += [(200, None, "en", "s1"), (201, "", None, None), (202, "12 34 !!", "en", "s2"),
             (203, f"write to ann.9@mail1.acme.org {prose(203, 30)}", "en", "s1"), (None, prose(300, 30), "en", "s1")]
    docs = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(31, 0, 0), (33, 0, 1)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_decisions_take_effect(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, tables), "stage")
        assert docs.columns == columns, name
        seen.append(docs)
    ids = [{r["doc_id"] for r in frame.collect()} for frame in seen]
    assert ids[0] - ids[1] == {200, 201, 202}
    assert ids[1] - ids[2] == {100 + i for i in range(10)}
    assert ids[3] == ids[2]
    private = seen[3].where("doc_id = 203").first()
    assert "acme" not in private["text"] and private["n_chars"] == len(private["text"])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, tables)
    assert {r["doc_id"] for r in packed.collect()} == ids[4]
    whole = corpus_pipeline.run(spark, tables)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, packed.collect()), key=str)


def test_empty_table(spark, tables, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{tables}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_whole_table(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert {r["doc_id"] for r in got} <= {r["doc_id"] for r in docs} and len({r["doc_id"] for r in got}) > 100
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        pieces.sort()
        assert [a for a, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 2048
    assert pii.DEFAULT_KEY
