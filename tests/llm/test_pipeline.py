import os

import pytest
from .brute import cut_repeats, multiset_similarity
from compare import connect, differences
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from siteweave.llm import packing, toxicity
from siteweave.llm.queries import ORACLES, QUERIES
from siteweave.sources.tables import read_table

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(llm, name):
    assert differences(QUERIES[name](llm, SMALL), connect(SMALL), ORACLES[name]) == []


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))


def test_stages_in_order(llm):
    docs = read_table(llm, SMALL, "documents").withColumns({c: F.lit("own") for c in ("key", "row", "score", "times")})
    docs = docs.unionByName(docs.limit(3).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(None).cast("long")))
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = corpus_pipeline.written(stage(llm, docs, SMALL), "stage")
        after = docs.collect()
        seen.append(name)
        if name != "packing":
            assert docs.columns == columns
        {
            "toxicity": check_toxicity,
            "near duplicates": check_near_duplicates,
            "repeated passages": check_passages,
            "mixing": check_mixing,
            "packing": check_packing,
        }[name](llm, before, after)
    assert seen == ["toxicity", "near duplicates", "repeated passages", "mixing", "packing"]


def check_toxicity(llm, before, after):
    labels = read_table(llm, SMALL, "labels")
    frame = llm.createDataFrame([(r.doc_id, r.text) for r in before], "doc_id long, text string")
    model = toxicity.fit(frame, labels, toxicity.in_training())
    scored = toxicity.score_toxicity(frame, model, ["doc_id", "text"]).filter("score < 0.5").collect()
    key = lambda r: repr((r.doc_id, r.text))
    assert sorted(map(key, scored)) == sorted(map(key, after))


def check_near_duplicates(llm, before, after):
    texts = sorted({r.text for r in before if r.text})
    kept = {r.text for r in after if r.text}
    assert len([r for r in after if r.text]) == len(kept)
    for a in texts:
        if a not in kept:
            assert any(multiset_similarity(a, b) >= 0.8 for b in texts if b != a) or sum(r.text == a for r in before) > 1
    for a in kept:
        assert not any(a < b and multiset_similarity(a, b) >= 0.8 for b in kept)
    assert sum(not r.text for r in after) == sum(not r.text for r in before)


def check_passages(llm, before, after):
    want = []
    for r, (n, left) in zip(before, cut_repeats([r.text for r in before], 35), strict=True):
        want.append(repr((r.doc_id, r.text if n == len(left) else " ".join(left))))
    assert sorted(want) == sorted(repr((r.doc_id, r.text)) for r in after)
    assert all(r.n_chars == len(r.text) for r in after if r.text is not None and " " in r.text and r.n_chars is not None)


def check_mixing(llm, before, after):
    times = {}
    for r in after:
        times[r] = times.get(r, 0) + 1
    assert set(times) <= set(before) and max(times.values()) <= 3 * max(before.count(r) for r in times)


def check_packing(llm, before, after):
    pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    total = sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in before)
    assert sum(r.length for r in after) == total
    assert len({r.sequence_id for r in after}) <= -(-total // packing.MAX_TOKENS) + 1


def test_run(llm):
    rows = corpus_pipeline.run(llm, SMALL).collect()
    assert rows and corpus_pipeline.ORACLE_SQL is None
