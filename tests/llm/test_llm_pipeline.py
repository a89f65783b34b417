"""The pipeline's stages on the smallest tables, each against its operator's
brute-force version, and the registered queries."""

import re

import corpus_pipeline as C
import pytest
from llm_fixtures import edges, nothing  # noqa: F401
from test_llm_decontaminate import plain as plain_leaks
from test_llm_packing import check_layout, reference_pieces
from test_llm_pii import plain as plain_spans
from test_llm_simhash import components

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    """Each stage's input and output, written as run() writes them."""
    from barforge.llm.common import written
    docs, out = spark.read.parquet(f"{DIR}/documents.parquet"), []
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, DIR), f"test-{name}")
        out.append(docs)
    return [spark.read.parquet(f"{DIR}/documents.parquet"), *out]


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_names_and_columns(tables):
    assert [n for n, _ in C.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "pii", "best_fit_packing"]
    for t in tables[1:5]:
        assert t.columns == list(C.COLUMNS) and dict(t.dtypes) == dict(tables[0].dtypes)


def test_language_keeps_prose(tables):
    before, after = {r.doc_id: r for r in tables[0].collect()}, {r.doc_id: r for r in tables[1].collect()}
    assert set(after) == {d for d, r in before.items() if re.search("[^\\W\\d_]{3}", r.text)}
    assert all(before[d].lang == r.lang and before[d].text == r.text for d, r in after.items())


def test_one_of_each_group_stays(tables):
    groups = components(rows(tables[1]))
    assert [d for d, _ in rows(tables[2])] == sorted({c for _, _, c in groups})
    assert len(rows(tables[2])) < len(rows(tables[1]))


def test_contaminated_go(spark, tables):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    hit = {d for d, _, _ in plain_leaks(rows(tables[2]), items)}
    assert rows(tables[3]) == [r for r in rows(tables[2]) if r[0] not in hit]


def test_private_data_is_replaced(tables):
    before, after = dict(rows(tables[3])), {r.doc_id: r for r in tables[4].collect()}
    assert set(before) == set(after)
    for d, r in after.items():
        assert plain_spans(r.text) == "" and r.n_chars == len(r.text)
        if not plain_spans(before[d]) and "token" not in before[d]:
            assert r.text == before[d]


def test_packed(tables):
    got = tables[5].collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == reference_pieces(rows(tables[4]), 4096)
    assert check_layout(got, 4096) <= -(-sum(r.length for r in got) // 4096) + 1


def test_stages_take_edges(spark, edges, nothing):
    lang = edges.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in C.STAGES:
        assert stage(spark, nothing.select(*lang.columns), DIR).collect() == [], name
        assert stage(spark, lang, DIR).count() >= 0


def test_registered():
    import __spark_entry__ as E
    names = E.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert len([q for q in names if re.match(rf"op{n}_", q)]) == 1
