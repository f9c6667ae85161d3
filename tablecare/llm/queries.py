"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablecare.llm import centroids, chat, decontamination, html_content, jaccard_join, line_dedup, packing, quality, secrets, substring_dedup, turn_repair, url_filter, wordpiece_counts
from tablecare.llm.shipping import ship
from tablecare.session import cut_lineage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        @wraps(function)
        def shipped(spark: SparkSession, sf: str) -> DataFrame:
            ship(spark)
            return function(spark, sf)

        QUERIES[function.__name__] = shipped
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of the folder."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The JSON text of a public tokenizer."""
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@query()
def op1_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """A place in a sequence of 4096 tokens for every piece of every document."""
    return packing.pack(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"))


@query()
def op3_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without the bytes of repeated strings of 400 bytes."""
    return substring_dedup.removed_digest(table(spark, sf, "documents"))


def _escaped_in_sql(text: str) -> str:
    for letter in ("\\", *chat.OPENERS):
        text = f"replace({text}, '{letter}', '{letter}\\')"
    return text


@query(
    f"""
    WITH extra AS (SELECT -7 AS conv_id, unnest([0, 1]) AS turn, unnest(['user', 'assistant']) AS role, '</s>[INST] ok [/INST]' AS text),
    t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM extra)
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
        cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        cast(sum({len(chat.TURN + chat.TEXT + chat.END)} + length({_escaped_in_sql("role")}) + length({_escaped_in_sql("text")})) AS BIGINT) AS formatted_chars
    FROM t GROUP BY conv_id
    """
)
def op4_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text and loss mask."""
    said = F.lit("</s>[INST] ok [/INST]").alias("text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said)
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionAll(extra)
    chats = chat.format_chats(turns)
    back = F.array_join(F.transform(chat.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = chats.select("conv_id", "n_turns", back.alias("back"), chat.loss_text(F.col("pieces")).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select("conv_id", "n_turns", F.sha2("back", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


@query()
def op2_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """The main text of every page."""
    return html_content.extract(table(spark, sf, "pages"), html_content.train(html_content.labelled_pages()))


@query()
def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Words and greedy word pieces of every document."""
    return wordpiece_counts.count_tokens(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"))


@query(
    """
    WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents),
    b AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
    ds AS (SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM d WHERE len(w) > 0),
    bs AS (SELECT DISTINCT item_id, unnest(list_transform(generate_series(1, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM b WHERE len(w) > 0),
    n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id)
    SELECT doc_id, item_id, n_shingles, count(*) AS n_shared
    FROM ds JOIN bs USING (s) JOIN n USING (item_id)
    GROUP BY doc_id, item_id, n_shingles HAVING 100 * count(*) >= 80 * n_shingles
    """
)
def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with each benchmark item of which it holds four fifths of the shingles."""
    found = decontamination.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_shared")


@query()
def op7_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Every string of a document that is taken for a real credential."""
    return secrets.scan(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"))


@query()
def op8_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of documents whose sets of three-word shingles have a Jaccard similarity of 0.9 or more."""
    return jaccard_join.document_groups(table(spark, sf, "documents"), jaccard_join.Similarity(shingle=3, percent=90, spread=2.0))


@query()
def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Per document: lines, lines removed as later matches, and their numbers."""
    docs = table(spark, sf, "documents")
    removed = line_dedup.removed_per_document(docs).withColumnsRenamed({"doc_id": "at_id", "text_hash": "at_hash"})
    sized = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"))
    joined = sized.join(removed, sized["doc_id"].eqNullSafe(removed["at_id"]) & (sized["text_hash"] == removed["at_hash"]), "left")
    lost = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", F.size(lost).cast("long").alias("n_removed"), F.array_join(lost, ",").alias("removed_lines"))


@query()
def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Measures and verdict of every document, with cutoffs from the labelled documents per language."""
    measured = cut_lineage(quality.measure(table(spark, sf, "documents"), keep=["doc_id", "lang"]).select("row.*", *quality.MEASURES))
    cutoffs = quality.fit_on(measured, table(spark, sf, "labels"))
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return measured.select("doc_id", *shown, quality.base_failed().alias("base_failed"), quality.verdict(cutoffs, F.col("lang")).alias("kept"))


@query()
def op11_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    rules = map(url_filter.Rule.read, ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/"))
    model = url_filter.train(spark.createDataFrame(url_filter.labelled_urls(), "url string, blocked int"))
    judged = url_filter.judge(table(spark, sf, "pages"), model, rules)
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


def _repair_sql() -> str:
    """One step per turn: the best (cost, audit) of each of the states start (n), system (s), user (u), assistant (a)."""
    far = "{'c': cast(1000000000 AS BIGINT), 'a': ''}"
    add = lambda state, cost, letter: f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}}"
    best = lambda *options: f"list_sort([{', '.join(options)}])[1]"
    keep = lambda state, initial: f"CASE WHEN t.initial = '{initial}' AND t.fault NOT IN ('b', 'd') THEN {add(state, 't.open_end', 'K')} ELSE {far} END"
    turn = lambda state: f"CASE WHEN t.fault NOT IN ('b', 'd') THEN {add(state, '1 + t.open_end', 'R')} ELSE {far} END"
    gone = lambda state: add(state, 2, "D")
    step_u = best(gone("v.u"), *[f(s) for s in ("v.n", "v.s", "v.a") for f in (lambda s: keep(s, "u"), turn)])
    step_a = best(gone("v.a"), keep("v.u", "a"), turn("v.u"))
    closed_u = best("u", add("n", 5, "I"), add("s", 5, "I"), add("a", 5, "I"))
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
    WITH RECURSIVE raw AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            xor(4294967295, list_reduce(list_concat([cast(4294967295 AS BIGINT)], list_transform(string_split(coalesce(cast(conv_id AS VARCHAR), ' ') || ':' || coalesce(cast(turn AS VARCHAR), ' '), ''), lambda x: cast(ascii(x) AS BIGINT))),
                lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS draw
        FROM conversations
    ),
    hurt AS (
        SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
            CASE WHEN draw = 1 THEN '' WHEN draw = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(CASE WHEN draw = 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM raw WHERE draw <> 0
    ),
    marked AS (
        SELECT conv_id, turn, role, text, left(role, 1) AS initial, trim(text, {blank}) AS bare,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text), copy) AS place
        FROM hurt
    ),
    t AS (
        SELECT *, CASE WHEN fault = 't' THEN 5 ELSE 0 END AS open_end
        FROM (SELECT *, CASE WHEN bare = '' THEN 'b' WHEN again > 1 THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault FROM marked)
    ),
    counts AS (
        SELECT conv_id, max(place) AS size, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
            count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair FROM t) GROUP BY conv_id
    ),
    v AS (
        SELECT conv_id, cast(0 AS BIGINT) AS place, {{'c': cast(0 AS BIGINT), 'a': ''}} AS n, {far} AS s, {{'c': cast(5 AS BIGINT), 'a': 'I'}} AS u, {{'c': cast(10 AS BIGINT), 'a': 'II'}} AS a FROM counts
        UNION ALL
        SELECT conv_id, place, n, s, u, {best("a", add("u", 5, "I"))} AS a FROM (
            SELECT conv_id, place, n, s, {closed_u} AS u, a FROM (
                SELECT v.conv_id, t.place, {gone("v.n")} AS n, {best(gone("v.s"), keep("v.n", "s"))} AS s, {step_u} AS u, {step_a} AS a
                FROM v JOIN t ON v.conv_id IS NOT DISTINCT FROM t.conv_id AND t.place = v.place + 1
            )
        )
    ),
    ends AS (SELECT c.*, {best("v.n", "v.a")} AS best FROM counts c JOIN v ON c.conv_id IS NOT DISTINCT FROM v.conv_id AND v.place = c.size),
    letters AS (SELECT conv_id, best.a AS audit, unnest(generate_series(1, length(best.a))) AS spot FROM ends),
    said AS (
        SELECT l.conv_id, l.spot, substr(l.audit, l.spot, 1) AS letter, t.role, t.text, t.initial
        FROM letters l LEFT JOIN t ON l.conv_id IS NOT DISTINCT FROM t.conv_id AND substr(l.audit, l.spot, 1) <> 'I' AND t.place = length(replace(left(l.audit, l.spot), 'I', ''))
    ),
    kept AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY spot) - CASE WHEN first(initial || letter) OVER (PARTITION BY conv_id ORDER BY spot) = 'sK' THEN 1 ELSE 0 END AS k FROM said WHERE letter <> 'D'),
    named AS (SELECT conv_id, spot, CASE WHEN letter = 'K' THEN role WHEN k % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END AS line FROM kept),
    lines AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY spot) AS whole FROM named GROUP BY conv_id)
    SELECT o.conv_id, coalesce(e.gaps, 0) AS gaps, coalesce(e.blank, 0) AS blank, coalesce(e.duplicate, 0) AS duplicate, coalesce(e.truncated, 0) AS truncated,
        coalesce(e.illegal, 0) AS illegal, coalesce(e.best.c, 0) AS cost, coalesce(e.best.a, '') AS audit, sha256(coalesce(l.whole, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN ends e ON o.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN lines l ON o.conv_id IS NOT DISTINCT FROM l.conv_id
    """


@query(_repair_sql())
def op12_turn_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Faults of every damaged conversation, its cheapest edits and a digest of what they give."""
    turns = turn_repair.damaged(table(spark, sf, "conversations"))
    plans = cut_lineage(turn_repair.plan(turns))
    ends = turn_repair.digests(turn_repair.repaired(turns, plans)).withColumnRenamed("conv", "at")
    joined = plans.join(ends, plans["conv"].eqNullSafe(ends["at"]))
    return joined.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@query()
def op13_centroid_clustering(spark: SparkSession, sf: str) -> DataFrame:
    """Cluster, distances and centroid digest of every usable embedding."""
    found = centroids.cluster(table(spark, sf, "embeddings").select("vec_id", "embedding"))
    return found.select("row.vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
