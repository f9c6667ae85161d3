"""The registered queries over whole tables, against SQL or plain versions, and the pipeline stage by stage."""

import hashlib
import os
import re
from collections import Counter

import pytest

import corpus_pipeline
from tablecare.llm import secrets
from tablecare.llm.jaccard_join import Similarity
from tablecare.llm.queries import ORACLES, QUERIES, vocabulary
from tests.conftest import SMALL
from tests.llm import brute
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def rows():
    return [tuple(r) for r in connect(SMALL).execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) is None


def test_packing_query(spark, rows):
    found = QUERIES["op1_best_fit_packing"](spark, SMALL).collect()
    assert {(r["doc_id"], r["piece"]): [(r["start"], r["length"], r["ids_crc32"])] for r in found} == brute.token_pieces(rows)
    total = sum(r["length"] for r in found)
    assert len({r["sequence_id"] for r in found}) <= 1.05 * total / 4096 + 1


def test_repeats_query(spark, rows):
    found = QUERIES["op3_suffix_array_dedup"](spark, SMALL).collect()
    assert Counter(tuple(r) for r in found) == Counter((i, *d) for (i, _), d in zip(rows, brute.repeats(rows)))


def test_jaccard_query(spark, rows):
    sets, roots = brute.groups(rows, 3, 90)
    expected = Counter((i, len(s), rows[root][0]) for (i, _), s, root in zip(rows, sets, roots))
    assert Counter(tuple(r) for r in QUERIES["op8_ngram_jaccard_join"](spark, SMALL).collect()) == expected


def test_line_query(spark, rows):
    found = {r["doc_id"]: r["removed_lines"] for r in QUERIES["op9_line_dedup"](spark, SMALL).collect()}
    assert found == {i: ",".join(map(str, g)) for (i, _), g in zip(rows, brute.later_lines(rows))}


def test_quality_query(spark, rows):
    found = {r["doc_id"]: r for r in QUERIES["op10_quality_rules"](spark, SMALL).collect()}
    for i, text in rows:
        n, *rest = brute.measures(text)
        assert tuple(found[i])[1:6] == (n, *rest)
        assert found[i]["base_failed"] == (n < 20 or 100 * rest[3] > 30 * n)
        assert not (found[i]["base_failed"] and found[i]["kept"])


def test_secret_query(spark):
    """All findings are credentials that stand in ``token = "..."``, none of those is missed; places and hashes by plain Python."""
    larger = SMALL.replace("0.001", "0.01")
    rows = connect(larger).execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()
    planted = Counter((i, m.start(1), len(m[1]), hashlib.sha256(m[1].encode()).hexdigest()) for i, t in rows for m in re.finditer(r'token = "([0-9a-f]{40})"', t))
    assert len(planted) > 10 and Counter(tuple(r)[:4] for r in QUERIES["op7_secret_scan"](spark, larger).collect()) == planted


def test_the_forest_does_not_depend_on_partitions(spark, monkeypatch):
    texts = secrets.labelled_findings(300, seed=8)
    docs = spark.createDataFrame([(k, b + v + a, p) for k, (v, b, a, p, _) in enumerate(texts)], "doc_id long, text string, source string")
    scores = lambda: sorted(map(tuple, secrets.judge(secrets.find(docs, words), secrets.train(spark, words, secrets.labelled_findings(600))).collect()))
    words, make = vocabulary("word_bpe_49k.json"), type(spark).createDataFrame
    first = scores()
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: make(self, data, *a, **k).coalesce(2))
    assert scores() == first and len(first) > 200 and len({s[-1] for s in first}) > 5
    monkeypatch.undo()
    with pytest.raises(ValueError):
        secrets.train(spark, words, [])


def test_page_query(spark):
    found = QUERIES["op2_html_extraction"](spark, SMALL).collect()
    assert sorted((r["page_id"], r["url"]) for r in found) == sorted(connect(SMALL).execute("SELECT page_id, url FROM pages").fetchall())
    assert all(r["n_chars"] == len(r["text"]) > 0 for r in found)


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs, columns = spark.read.parquet(f"{SMALL}/documents.parquet"), None
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        columns = columns or docs.columns
        stage(spark, docs, SMALL).write.parquet(path := os.path.join(tmp_path, str(k)))
        before = sorted(tuple(r) for r in docs.select("doc_id", "text").collect())
        docs = spark.read.parquet(path)
        if k < 4:
            assert docs.columns == columns
        seen[name] = before, docs.collect()
    before, after = seen["quality rules"]
    failed = {i for i, t in before for n, _, _, _, again in [brute.measures(t)] if n < 20 or 100 * again > 30 * n}
    assert {r["doc_id"] for r in after} <= {i for i, _ in before} - failed and len(after) > 0.8 * (len(before) - len(failed))
    before, after = seen["line dedup"]
    kept = {i: [x for n, x in enumerate(t.split("\n")) if n not in gone] for (i, t), gone in zip(before, brute.later_lines(before))}
    assert {r["doc_id"]: r["text"].split("\n") for r in after} == {i: lines for i, lines in kept.items() if lines}
    before, after = seen["n-gram Jaccard join"]
    roots = brute.groups(before, Similarity().shingle, Similarity().percent)[1]
    assert {r["doc_id"] for r in after} == {before[root][0] for root in roots}
    before, after = seen["benchmark decontamination"]
    held = {d for d, _ in brute.leaks(before, connect(SMALL).execute("SELECT item_id, text FROM benchmark").fetchall())}
    assert {r["doc_id"] for r in after} == {i for i, _ in before} - held
    before, after = seen["best-fit packing"]
    assert {(r["doc_id"], r["piece"]): [(r["start"], r["length"], r["ids_crc32"])] for r in after} == brute.token_pieces(before)


def test_pipeline_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
