"""Licence scan: held-out notices, clean documents, edges."""

import random

import pytest
from llm_fixtures import documents, edges, nothing  # noqa: F401

from barforge.llm import licences as L

#: notices that are not among the templates
HELD_OUT = {"apache": "This file is licensed under the Apache License, Version 2.0, as stated.", "mit": "Code is released under the MIT License here.",
            "gpl": "You may use it under the GNU General Public License, version 3, only.", "cc-by-nc": "Images: licensed under CC BY-NC 4.0 by the author.",
            "proprietary": "Some Company 2020. All rights reserved.", "bsd": "Parts are licensed under the BSD 3-Clause License too."}


def clean_rows(n, seed=2):
    rnd = random.Random(seed)
    vocab = ["the", "of", "and", "under", "a", "this", "is", "work", "in", "house", "river", "2.0", "public", "general", "mountain", "walk", "morning"]
    return [(i, "\n".join(" ".join(rnd.choice(vocab) for _ in range(rnd.randrange(1, 25))) for _ in range(5))) for i in range(n)]


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(documents(spark, clean_rows(400)))


def found(spark, model, rows):
    out = {}
    for r in L.licence_paragraphs(documents(spark, rows).repartition(3), model).where("confirmed").collect():
        out.setdefault(r.doc_id, []).append((r.paragraph, r.family))
    return out


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],), (["x"],), ([],)], "w array<string>").select(L.ngrams_of("w", (2, 3)))
    assert [r[0] for r in df.collect()] == [["a b", "b c", "c d", "a b c", "b c d"], [], []]


def test_held_out_notices(spark, model):
    rows = [(i, f"some text\n\n{t}\nmore text") for i, t in enumerate(HELD_OUT.values())]
    got = found(spark, model, rows)
    assert [got.get(i) for i in range(len(rows))] == [[(2, f)] for f in HELD_OUT]


def test_templates_in_documents(spark, model):
    notices = [(f, t) for f, ts in L.TEMPLATES.items() for t in ts if not t.startswith("SPDX")]
    got = found(spark, model, [(i, f"a\n{t}\nb") for i, (_, t) in enumerate(notices)])
    right = sum(got.get(i) == [(1, f)] for i, (f, _) in enumerate(notices))
    assert right >= 0.9 * len(notices)


def test_clean_documents_have_none(spark, model):
    assert found(spark, model, clean_rows(300, seed=77)) == {}


def test_triggers_lose_nothing(spark, model):
    rows = [(i, t) for i, t in enumerate([*HELD_OUT.values(), *(t for _, t in clean_rows(60, seed=5))])]
    free = L.LicenceModel(model.vectors, model.regression, model.least, None)
    assert model.triggers is not None and found(spark, model, rows) == found(spark, free, rows)


def test_scan_edges(spark, model, edges, nothing):
    df = edges.unionByName(documents(spark, clean_rows(200) + [(900, "Released under the MIT License.\n\nReleased under the MIT License."),
                                                               (901, "x\nLicensed under the Apache License, Version 2.0.\nAll rights reserved.")]))
    got = {}
    rows = L.scan(df, model).collect()
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    assert len(rows) == df.count()
    assert (got[900][0].n_paragraphs, got[900][0].n_licence, got[900][0].families) == (2, 2, ["mit"])
    assert got[901][0].families == ["apache", "proprietary"]
    assert got[1][0].n_paragraphs == got[2][0].n_paragraphs == got[3][0].n_paragraphs == 0 and got[1][0].families == []
    assert len(got[None]) == 2 and got[6][0] == got[6][1]
    assert L.scan(nothing, model).collect() == []
