import textwrap

from helpers import documents, table_rows

from conftest import SF_SMALL
from dimstar.llm import license_scan as L
from dimstar.llm import queries as Q

KNOWN = {
    "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "Released under the MIT License.": "mit",
    "All rights reserved.": "all-rights-reserved",
}


def test_query_finds_every_licence_line(spark):
    expected = {(d, i, KNOWN[line]) for d, t in table_rows(SF_SMALL, "documents", "doc_id, text")
                for i, line in enumerate((t or "").split("\n")) if line in KNOWN}
    got = Q.queries()["op3_license_scan"](spark, SF_SMALL).collect()
    assert expected and {(r.doc_id, r.paragraph, r.licence) for r in got} == expected


def test_families_variants_and_defined_cases(spark):
    filler = "the river runs along the old road and the mill stands by its bank near a field of barley "
    texts = [t for f in L.FAMILIES for t in L.TEMPLATES[f]]
    edge = [None, "", "\n \n\t\n", filler * 300, f"{filler}\nReleased under the MIT License.\n{filler}",
            "This text is released, under the terms of the MIT LICENSE", filler]
    docs = documents(spark, texts + edge, clash=True)
    docs = docs.unionByName(documents(spark, [(len(texts) + 4, edge[4]), (None, "All rights reserved.")], clash=True))
    got = L.scan(docs).collect()
    names = [f for f in L.FAMILIES for _ in L.TEMPLATES[f]]
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    right = sum(r.licence == names[i] for i in range(len(texts)) for r in by_doc.get(i, []))
    assert right >= len(texts) - 1  # held-out-like wording may stay unknown, never another family
    assert all(r.licence in (names[r.doc_id], "unknown") for r in got if r.doc_id is not None and r.doc_id < len(texts))
    at = len(texts)
    assert [i for i in (at, at + 1, at + 2, at + 3, at + 6) if i in by_doc] == []
    assert [(r.paragraph, r.licence) for r in by_doc[at + 4]] == [(1, "mit")] * 2
    assert by_doc[None][0].licence == "all-rights-reserved"
    assert L.scan(documents(spark, [])).count() == 0


def test_wrapped_copies_of_every_template(spark):
    filler = "the river runs along the old road and the mill stands by its bank near a field of barley"
    cases = [(f, t, mark) for f in L.FAMILIES for t in L.TEMPLATES[f] for mark in ("", " * ")]
    texts = []
    for _, t, mark in cases:
        wrapped = textwrap.wrap(t, 72 if len(t) > 80 else len(t) * 2 // 3)
        assert len(wrapped) > 1
        texts.append("\n".join([filler, mark, *(mark + line for line in wrapped), mark, filler]))
    got = L.scan(documents(spark, texts)).collect()
    named = {(r.doc_id, r.licence) for r in got if r.licence != "unknown"}
    assert {i for i, _ in named} >= {i for i, (f, _, _) in enumerate(cases) if f in ("gpl-3.0", "bsd-3-clause")}
    assert len({i for i, _ in named}) >= len(cases) - 2  # one sentence may stay unknown, as when it is one line
    assert named == {(i, cases[i][0]) for i, _ in named}
    assert all(r.paragraph == 2 for r in got if r.licence in ("gpl-3.0", "bsd-3-clause"))
