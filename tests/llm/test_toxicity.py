import os
import random

import pytest
from pyspark.sql import functions as F

from siteweave.llm import toxicity
from siteweave.sources.tables import read_table

FOLDER = "/root/testdata/sf0.1"
STEMS = ["grolm", "vexna", "skorp", "dulth", "brakz"]


@pytest.fixture(scope="module")
def trained(llm):
    """(model, rows): texts in an invented language whose toxic ones hold words from a few stems."""
    draw = random.Random(1)
    syllables = ["ta", "ri", "no", "le", "mo", "sa", "ki", "du", "ven", "tor", "al", "en"]

    def word():
        return "".join(draw.choice(syllables) for _ in range(draw.randrange(1, 5)))

    rows = []
    for i in range(1500):
        toxic = int(i % 5 == 0)
        w = [word() for _ in range(draw.randrange(30, 150))]
        if toxic:
            for _ in range(max(2, len(w) // 30)):
                w.insert(draw.randrange(len(w)), draw.choice(STEMS) + draw.choice(syllables))
        rows.append((i, " ".join(w), toxic))
    docs = llm.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"), toxicity.in_training())
    return model, rows, docs


def test_held_out_rows(trained):
    model, rows, docs = trained
    held = docs.filter(~toxicity.in_training())
    scored = toxicity.score_toxicity(held, model, ["doc_id", "toxic"]).collect()
    right = sum((r.score >= 0.5) == bool(r.toxic) for r in scored)
    assert len(scored) > 200 and right / len(scored) > 0.97


def test_unseen_forms_of_known_stems(trained, llm):
    model, _, _ = trained
    clean = "tari nole mosa kidu ventor alen " * 10
    texts = [(0, clean), (1, clean + " ".join(s + "enal" for s in STEMS)), (2, ""), (3, None), (4, clean * 400)]
    rows = toxicity.score_toxicity(llm.createDataFrame(texts, "doc_id long, text string"), model, ["doc_id"]).collect()
    score = {r.doc_id: r.score for r in rows}
    assert score[0] < 0.5 <= score[1] and score[2] == score[3] < 0.5 and score[4] < 0.5
    assert all(0 <= s <= 1 for s in score.values())


def test_a_word_late_in_a_long_text_counts(trained, llm):
    model, _, _ = trained
    long = "tari nole " * 30_000 + STEMS[0] + "ri"
    (row,) = toxicity.score_toxicity(llm.createDataFrame([(1, long)], "doc_id long, text string"), model, ["doc_id"]).collect()
    assert row.n_words == 60_001 and row.toxic_words >= 1


def test_whole_rows_go_or_stay(trained, llm):
    _, rows, docs = trained
    odd = [(9001, None), (9002, ""), (None, "tari nole"), (9001, None)]
    frame = docs.drop("toxic").unionByName(llm.createDataFrame(odd, "doc_id long, text string"))
    frame = frame.withColumns({c: F.lit("own") for c in ("score", "n_words", "over", "row", "toxic")})
    labels = docs.select("doc_id", "toxic")
    left = toxicity.drop_toxic(frame, labels)
    assert left.columns == frame.columns
    got = [r.doc_id for r in left.collect()]
    assert sum(i is None for i in got) == 1 and got.count(9001) == 2 and got.count(9002) == 1
    clean = {i for i, _, t in rows if not t}
    assert len(clean - set(got)) <= 0.02 * len(clean) and len(set(got) & {i for i, _, t in rows if t}) < 20


def test_without_labels_nothing_is_toxic(make_docs, llm):
    docs = make_docs(["a b", "c d"])
    for rows in ([], [(0, 1, 1)], [(0, 1, None), (None, 1, 1)], [(0, 0, 0), (1, 0, 0)]):
        labels = llm.createDataFrame(rows, "doc_id long, quality int, toxic int")
        model = toxicity.fit(docs, labels, F.lit(True))
        assert [r.score for r in toxicity.score_toxicity(docs, model, ["doc_id"]).collect()] == [0.0, 0.0]
    assert toxicity.drop_toxic(make_docs([]), labels).count() == 0


def test_expanded_words():
    words = ["é".encode(), b"ab", b""]
    out = toxicity.expand(words)
    assert [o[0::2] for o in out] == [b" " + w + b" " for w in words]
    assert toxicity.expand([b"ab"])[0] == out[1]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_labels_of_the_test_tables(llm):
    from siteweave.llm.queries import QUERIES

    scored = QUERIES["op8_toxicity"](llm, FOLDER)
    rows = scored.join(read_table(llm, FOLDER, "labels"), "doc_id").filter("held_out AND toxic IS NOT NULL").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    caught = sum(r.predicted for r in toxic) / len(toxic)
    blamed = sum(r.predicted for r in clean) / len(clean)
    assert caught > 0.8 and blamed < 0.05


def test_ten_toxic_labels_tell_something(llm):
    """On the smallest table the classes get different scores; nothing turns the classifier off."""
    from pathlib import Path

    import pytest

    from siteweave.llm.queries import op8_toxicity

    folder = "/root/testdata/sf0.001"
    if not Path(folder).is_dir():
        pytest.skip("no test tables")
    labels = {r.doc_id: r.toxic for r in llm.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in op8_toxicity(llm, folder).collect() if r.doc_id in labels and not r.held_out]
    scores = {kind: [r.score for r in rows if labels[r.doc_id] == kind] for kind in (0, 1)}
    assert 5 <= len(scores[1]) <= 12
    middle = {kind: sum(s) / len(s) for kind, s in scores.items()}
    assert middle[1] > middle[0] + 0.3
    assert sum(s >= 0.5 for s in scores[1]) >= 0.6 * len(scores[1])
