import random
import re
import subprocess
import sys

import pytest
from pyspark.sql import Window, functions as F

from tablecare.functions.similarity import best_overlap, padded_words, plain_words, similarity_bounds, term_facts, word_similarity, word_trigrams
from tablecare.operators import searching as s
from tests.conftest import SMALL, final_plan, plan_of


def brute_force(term, text):
    """Word similarity by its definition: all runs of the text's trigrams."""

    def grams(x):
        words = re.findall(r"[^\W_]+", x.lower())
        return [f"  {w} "[i : i + 3] for w in words for i in range(len(w) + 1)]

    wanted, run = set(grams(term)), grams(text)
    best = 0.0
    for i in range(len(run)):
        for j in range(i + 1, len(run) + 1):
            part = set(run[i:j])
            best = max(best, len(part & wanted) / len(part | wanted))
    return best if wanted else 0.0


def test_published_values():
    assert best_overlap(frozenset(word_trigrams("word")), word_trigrams("two words")) == pytest.approx(0.8)
    assert best_overlap(frozenset(word_trigrams("bat")), word_trigrams("Batman Begins")) == pytest.approx(0.75)


def test_similarity_equals_brute_force():
    dice = random.Random(3)
    for _ in range(400):
        text = " ".join("".join(dice.choices("abcé1_", k=dice.randint(1, 5))) for _ in range(dice.randint(1, 8)))
        term = "".join(dice.choices("abcé1 ", k=dice.randint(1, 6)))
        assert best_overlap(frozenset(word_trigrams(term)), word_trigrams(text)) == pytest.approx(brute_force(term, text))


def test_similarity_of_nulls_and_blanks(frame):
    df = frame([(1, "bat", None), (2, None, "bat"), (3, "--", "bat"), (4, "bat", "Bat")], "i int, t string, x string")
    scored = df.orderBy("i").select(word_similarity(F.col("t"), F.col("x"))).collect()
    assert [r[0] for r in scored] == [0.0, 0.0, 0.0, 1.0]


TEXTS = ["100% Wolf", "1000 wolf cubs", "under_score", "underXscore", "back\\slash", "Ünïcode ΣΑΣ", "a", "", None, "Wolf\nLine two"]
TERMS = ["0%", "_", "\\", "wolf", "O", "a", "ne ", "two", "ünï", "σας", "  ", "absent", "wolf\nl", None]


@pytest.fixture()
def catalogue(frame):
    rows = [(i, x, TEXTS[-1 - i], f"2024-01-{i + 1:02d}" if i % 2 else None) for i, x in enumerate(TEXTS)]
    return frame(rows, "id int, name string, other string, day string").withColumn("day", F.col("day").cast("timestamp"))


@pytest.fixture()
def queries(frame):
    return frame([(i, t) for i, t in enumerate(TERMS)], "query_id int, term string")


@pytest.mark.parametrize("few, most", [(512, 10**6), (0, 10**6), (0, 0)])
def test_all_strategies_find_what_contains_finds(spark, catalogue, queries, few, most):
    found = s.candidates(queries, catalogue, "query_id", "term", "id", ["name", "other"], few, most)
    pairs = sorted((r["query_id"], r["id"]) for r in found.collect())
    held = F.contains(F.lower("name"), F.lower(F.trim("term"))) | F.contains(F.lower("other"), F.lower(F.trim("term")))
    expected = queries.where("trim(term) <> ''").crossJoin(catalogue).where(held).select("query_id", "id").collect()
    assert pairs == sorted(tuple(r) for r in expected) and len(pairs) == len(set(pairs))
    assert {q for q, _ in pairs} >= {0, 1, 2, 3, 8}


@pytest.mark.parametrize("few", [512, 0])
def test_ranking_breaks_ties_by_date_then_id(catalogue, queries, few):
    found = s.search(queries, catalogue, ["name", "other"], date="day", k=3, scorer="exact", few=few)
    wolf = [(r["id"], r["relevance"]) for r in found.where("query_id = 3").orderBy("position").collect()]
    assert wolf == [(9, 0.5), (1, 0.5), (0, 0.5)]
    exact = found.where("query_id = 5").orderBy("position").first()
    assert (exact["id"], exact["relevance"]) == (6, 1.0)


def words_of(seed, rows, letters="abcé1_ -", size=14):
    dice = random.Random(seed)
    return ["".join(dice.choices(letters, k=dice.randint(1, size))) for _ in range(rows)]


def test_bounds_enclose_the_similarity(frame):
    pairs = list(zip(words_of(5, 1500, size=7), words_of(6, 1500, size=22))) + [("--", "a"), ("ab", None), ("a", "a"), ("ab c", "xab c"), ("ΣΑΣ", "ein σας")]
    df = frame(pairs, "term string, text string").withColumn("facts", term_facts(plain_words(F.col("term"))))
    low, high = similarity_bounds(F.col("facts"), padded_words(plain_words(F.col("text"))))
    known = 0
    for r in df.select("term", "text", low.alias("low"), high.alias("high")).collect():
        score = brute_force(r["term"], r["text"] or "")
        assert r["low"] <= score <= r["high"], r
        known += r["low"] == r["high"]
    assert known > 500


def all_scored(queries, corpus, columns, k):
    """The best rows where every candidate is scored by its runs."""
    found = s.candidates(queries, corpus, "query_id", "term", "id", columns)
    score = F.greatest(*[word_similarity(F.col("_term"), F.coalesce(c, F.lit(""))) for c in columns], F.lit(0.0))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc_nulls_last("day"), "id"))
    return found.withColumn("score", score).withColumn("place", place).where(F.col("place") <= k).select("query_id", "id", "score", "place")


@pytest.mark.parametrize("few, most", [(512, 10**6), (0, 10**6), (0, 0)])
@pytest.mark.parametrize("k", [1, 4])
def test_bounded_search_equals_scoring_everything(frame, rows, few, most, k):
    dice = random.Random(8)
    catalogue = frame([(i, a, b, dice.choice([None, "2024-01-01", "2024-01-02"])) for i, (a, b) in enumerate(zip(words_of(1, 400, size=20), words_of(2, 400) [:390] + [None] * 10))], "id int, name string, other string, day string")
    queries = frame(list(enumerate(words_of(3, 60, size=4))) + [(None, "ab"), (7, "a")], "query_id int, term string")
    found = s.search(queries, catalogue, ["name", "other"], date="day", k=k, few=few, broadcast_up_to=most)
    assert rows(found) == rows(all_scored(queries, catalogue, ["name", "other"], k)) and found.count() > 40


def test_few_candidates_are_scored_by_their_runs(spark):
    parts = spark.read.parquet(f"{SMALL}/part.parquet").withColumn("_padded_0", padded_words(plain_words(F.col("p_name"))))
    queries = parts.select(F.explode(F.split("p_name", " ")).alias("w")).select(F.explode(F.array("w", F.substring("w", 1, 2))).alias("term")).distinct().withColumn("query_id", F.col("term"))
    found = s.candidates(queries, parts, "query_id", "term", "p_partkey", ["p_name"], facts=True).withColumn("_date", F.lit(None).cast("timestamp"))
    known, open_ = s.bounded_similarity(found, "query_id", "p_partkey", ["_padded_0"], [], 8)
    assert open_.count() < 0.05 * found.count() and known.groupBy("query_id").count().agg(F.max("count")).first()[0] == 8
    plan = plan_of(s.search(queries, parts, ["p_name"], corpus_id="p_partkey"))
    assert plan.count("ArrowEvalPython") == 1 and "WindowGroupLimit" in plan


def test_a_gram_in_every_row_is_dealt_to_many_tasks(spark, frame):
    corpus = spark.range(4000).select("id", F.lit("common words").alias("name"))
    queries = frame([(1, "common"), (2, "words"), (3, "on w")], "query_id int, term string")
    found = s.candidates(queries, corpus, "query_id", "term", "id", ["name"], 0, 0)
    assert found.groupBy("query_id").count().collect() and found.count() == 12_000
    assert "_salt" in plan_of(found)


def test_shuffled_search_broadcasts_neither_catalogue_nor_grams(spark, tmp_path):
    """A file of few bytes with many rows: its size says nothing about the rows that the joins build."""
    path = str(tmp_path / "parts")
    spark.range(20_000).select("id", F.concat(F.lit("large ring "), F.col("id") % 7).alias("title")).write.parquet(path)
    corpus = spark.read.parquet(path)
    asked = spark.createDataFrame([("ring",), ("arge",)], "query_id string").withColumn("term", F.col("query_id"))
    found = s.candidates(asked, corpus, "query_id", "term", "id", ["title"], few=0, broadcast_up_to=0)
    assert found.count() == 40_000
    plan = final_plan(found)
    assert "SortMergeJoin" in plan
    assert not [line for line in plan.split("\n") if "BroadcastHashJoin" in line and ("_row_id" in line or "_salt" in line)]


def test_filter_and_shown_columns(catalogue, queries, rows):
    found = s.search(queries, catalogue, ["name"], where=F.col("id") > 1, show=["other", "id", "day"], k=2)
    assert found.columns == ["query_id", "id", "other", "day", "relevance", "position"]
    assert {r["id"] for r in found.where("query_id = 3").collect()} == {9} and found.where("other IS NOT NULL").count() > 0


def test_limit_is_clamped_and_no_terms_give_no_rows(spark, catalogue, queries):
    assert s.search(queries, catalogue, ["name"], k=0).groupBy("query_id").count().agg(F.max("count")).first()[0] == 1
    assert s.search(queries.where("query_id < 0"), catalogue, ["name"]).count() == 0
    with pytest.raises(ValueError):
        s.search(queries, catalogue, ["name"], scorer="other")


def test_strategies_agree_on_whole_documents(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    words = spark.read.parquet(f"{SMALL}/benchmark.parquet").select(F.explode(F.split("text", r"\s+")).alias("term"))
    queries = words.distinct().withColumn("query_id", F.col("term"))
    totals = [
        s.candidates(queries, documents, "query_id", "term", "doc_id", ["text"], few, most)
        .agg(F.count(F.lit(1)), F.sum(F.xxhash64("query_id", "doc_id") % 1000003))
        .first()
        for few, most in ((10**6, 10**6), (0, 10**6), (0, 0))
    ]
    assert totals[0] == totals[1] == totals[2] and totals[0][0] > 0


def test_no_cartesian_product(catalogue, queries):
    for few, most in ((0, 10**6), (0, 0)):
        plan = plan_of(s.candidates(queries, catalogue, "query_id", "term", "id", ["name"], few, most))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_workers_need_not_have_the_package(tmp_path):
    """A worker that cannot import the package can still load and run the scoring function."""
    from pyspark import cloudpickle

    packed = tmp_path / "packed"
    packed.write_bytes(cloudpickle.dumps((best_overlap, word_trigrams)))
    code = (
        f"import pickle; best, grams = pickle.load(open({str(packed)!r}, 'rb'));"
        "print(best(frozenset(grams('bat')), grams('Batman Begins')))"
    )
    done = subprocess.run([sys.executable, "-I", "-c", code], cwd="/", capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "0.75", done.stderr
