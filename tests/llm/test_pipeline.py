import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken
from helpers import documents, table_rows
from test_decontamination import brute_force
from test_quality import base_counts
from test_simhash_dedup import components, fingerprint

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF_SMALL
from dimstar.llm import byte_bpe as B
from dimstar.llm import quality_classifier as C
from dimstar.llm import quality_rules as R
from dimstar.llm.common import materialise, table


def test_stages_against_brute_force(spark):
    texts = dict(table_rows(SF_SMALL, "documents", "doc_id, text"))
    items = table_rows(SF_SMALL, "benchmark", "item_id, text")
    labels = table(spark, SF_SMALL, "labels")
    docs, stages = table(spark, SF_SMALL, "documents"), dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "quality rules", "simhash near-dedup", "benchmark decontamination",
                            "byte-level BPE"]

    def step(name):
        out = materialise(stages[name](spark, docs, SF_SMALL), "test-stage")
        assert name == "byte-level BPE" or out.columns == docs.columns
        return out, {r.doc_id for r in out.select("doc_id").collect()}

    expected = {r.row.doc_id for r in C.scored(docs, labels).filter("predicted = 1").collect()}
    docs, ids = step("quality classifier")
    assert ids == expected and 0 < len(ids) < len(texts)

    judged = {r.row.doc_id: r for r in R.judged(docs, labels).collect()}
    docs, ids = step("quality rules")
    for d, r in judged.items():
        n, _, _, _, repeat = base_counts(texts[d])
        assert (d in ids) == (n >= 10 and 100 * repeat <= 20 * n and r.anomaly <= r.threshold)

    prints = [(d, fingerprint(texts[d])) for d in sorted(ids)]
    expected = {d for (d, _), c in zip(prints, components(prints, 2), strict=True) if d == c}
    docs, ids = step("simhash near-dedup")
    assert ids == expected

    clean = lambda t: " ".join("".join(c if c.isalnum() else "" for c in w) for w in t.split())
    hit = {r[0] for r in brute_force([(d, clean(texts[d])) for d in sorted(ids)], [(i, clean(t)) for i, t in items])}
    expected = ids - hit
    docs, ids = step("benchmark decontamination")
    assert ids == expected

    v = B.encoder(corpus_pipeline.TOKENIZER, P.PATTERN).vocabulary
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    out, last = step("byte-level BPE")
    assert last == ids
    for r in out.collect():
        tokens = lib.encode_ordinary(texts[r.doc_id])
        assert r.ids == tokens and r.n_tokens == len(tokens)
        assert r.ids_sha256 == hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    run = {r.doc_id for r in E.queries()["pipeline"](spark, SF_SMALL).select("doc_id").collect()}
    assert run == ids


def test_stages_take_odd_documents(spark):
    text = "A plain text of more than ten words that says nothing of any interest at all. "
    docs = documents(spark, [(1, text), (1, text), (2, None), (3, ""), (None, text + "Indeed."), (4, text * 2000)], clash=True)
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SF_SMALL)
            assert name == "byte-level BPE" or out.columns == rows.columns
            out.collect()
