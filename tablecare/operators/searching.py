"""Batch text search: many terms against a catalogue, best matches per term.

A few terms travel as literals: the plan has one generated test per term, and every text passes them in
one scan without a shuffle. With more terms that would cost terms x text, so the terms are filed by grams.

A text that holds a term holds every gram (1 to 3 characters in a row) of the term. So each term
is filed under one of its grams, each text offers its distinct grams, and the two meet in an
equi-join; the substring test then runs on those candidates only. The gram of a term is the one
that is rarest in a sample of the catalogue; any choice gives the same answer. Where ids are shuffled, the
rows of a gram are dealt to several tasks and its terms are sent to each, so a common gram is not one task. These joins
are hinted: Spark estimates rows by the size of compressed files and would broadcast a catalogue or its grams.

Word similarity is bounded in SQL from both sides, which mostly gives the score itself. Only rows whose bounds
differ and that can still reach the best k of their term are scored by looking at the runs of their texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tablecare.functions.similarity import padded_words, plain_words, similarity_bounds, term_facts, word_similarity
from tablecare.functions.text import contains_in_any
from tablecare.session import dealt_out

GRAM = 3
FEW_TERMS = 512
"""Up to this number of queries, each text is tested for every term directly."""

BROADCAST_TERMS = 100_000
"""Terms are sent to every task only up to this number; beyond it the join shuffles ids."""

BROADCAST_BYTES = 64 << 20
LITERAL_BYTES = 1 << 20
"""Bounds on the text of the terms for the same two strategies."""

SAMPLE = 0.05

SALTS = 16
"""Tasks that the rows of one gram are dealt to in the shuffled join."""


def grams(column: Column, size: int) -> Column:
    """The distinct runs of ``size`` characters of a text (a zero-width match at every position)."""
    pattern = "(?s)(?=(" + "." * size + "))"
    return F.array_distinct(F.regexp_extract_all(column, F.lit(pattern), F.lit(1)))


def _all_grams(columns: list[str], sizes: list[int]) -> Column:
    """Distinct grams of several columns; columns are joined by a character no term holds."""
    text = F.lower(F.concat_ws("\u0000", *columns))
    return reduce(F.array_union, [grams(text, size) for size in sizes])


def normal_terms(queries: DataFrame, query_id: str, term: str) -> DataFrame:
    """Trimmed, non-blank terms as (query_id, _term, _size)."""
    trimmed = queries.select(F.col(query_id), F.regexp_replace(F.col(term), r"^\s+|\s+$", "").alias("_term"))
    filled = trimmed.where(F.char_length("_term") > 0)
    return filled.withColumn("_size", F.least(F.char_length(F.lower("_term")), F.lit(GRAM)))


def file_terms(terms: DataFrame, corpus: DataFrame, query_id: str, columns: list[str], sizes: list[int]) -> DataFrame:
    """Each term under its rarest gram: the columns of ``terms`` and _gram."""
    lowered = F.lower("_term")
    options = reduce(lambda rest, n: F.when(F.col("_size") == n, grams(lowered, n)).otherwise(rest), sizes, F.array())
    filed = terms.withColumn("_gram", F.explode(options))
    wanted = filed.select("_gram").distinct()
    offered = corpus.sample(SAMPLE, seed=5).select(F.explode(_all_grams(columns, sizes)).alias("_gram"))
    seen = offered.join(wanted, "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_seen"))
    ranked = filed.join(seen, "_gram", "left").withColumn("_seen", F.coalesce("_seen", F.lit(0)))
    place = F.row_number().over(Window.partitionBy(query_id, "_term").orderBy("_seen", "_gram"))
    return ranked.withColumn("_place", place).where(F.col("_place") == 1).drop("_place", "_seen", "_size")


def _scan(terms: DataFrame, corpus: DataFrame, query_id: str, columns: list[str]) -> DataFrame:
    """Pairs by direct test; the terms are few enough to be literals of the plan."""
    wanted = terms.drop("_size")
    rows = wanted.withColumn("_low", F.lower("_term")).collect()
    lowered = [f"_low_{i}" for i in range(len(columns))]
    texts = dealt_out(corpus).withColumns({low: F.lower(F.coalesce(c, F.lit(""))) for low, c in zip(lowered, columns)})

    def holds(low_term: str) -> Column:
        return reduce(Column.__or__, [F.contains(F.col(low), F.lit(low_term)) for low in lowered])

    tests = F.array(*[F.when(holds(r["_low"]), F.lit(i)).otherwise(F.lit(-1)) for i, r in enumerate(rows)])
    hits = texts.withColumn("_at", F.explode(F.array_remove(tests, -1)))
    numbered = corpus.sparkSession.createDataFrame([(i, *r[: len(wanted.columns)]) for i, r in enumerate(rows)], T.StructType([T.StructField("_number", T.IntegerType()), *wanted.schema.fields]))
    found = hits.join(F.broadcast(numbered), hits["_at"] == numbered["_number"])
    return found.select(*corpus.columns, *wanted.columns)


def candidates(
    queries: DataFrame,
    corpus: DataFrame,
    query_id: str,
    term: str,
    corpus_id: str,
    columns: list[str],
    few: int = FEW_TERMS,
    broadcast_up_to: int = BROADCAST_TERMS,
    facts: bool = False,
) -> DataFrame:
    """All (query, row) pairs where a column of the row holds the term, with the row's columns.

    The number of terms picks the strategy; all three give the same pairs. With ``facts`` each pair also has what
    :func:`similarity_bounds` needs of its term, as ``_facts``.
    """
    terms = normal_terms(queries, query_id, term)
    shape = terms.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("_term")).alias("bytes"), F.collect_set("_size").alias("sizes")
    ).first()
    terms = terms.withColumn("_facts", term_facts(plain_words(F.col("_term")))) if facts else terms
    if shape["n"] == 0:
        others = [f for f in terms.schema.fields if f.name != "_size"]
        return corpus.limit(0).withColumns({f.name: F.lit(None).cast(f.dataType) for f in others})
    if shape["n"] <= few and shape["bytes"] <= LITERAL_BYTES:
        return _scan(terms, corpus, query_id, columns)
    sizes = sorted(shape["sizes"])
    filed = file_terms(terms, corpus, query_id, columns, sizes)
    holds = contains_in_any([F.col(c) for c in columns], F.col("_term"))
    if shape["n"] <= broadcast_up_to and shape["bytes"] <= BROADCAST_BYTES:
        offered = corpus.withColumn("_gram", F.explode(_all_grams(columns, sizes)))
        return offered.join(F.broadcast(filed), "_gram").where(holds).drop("_gram")
    salt = F.pmod(F.xxhash64(corpus_id), F.lit(SALTS)).alias("_salt")
    offered = corpus.select(F.col(corpus_id).alias("_row_id"), salt, F.explode(_all_grams(columns, sizes)).alias("_gram"))
    dealt = filed.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    pairs = offered.join(dealt.hint("merge"), ["_gram", "_salt"]).drop("_gram", "_salt")
    return corpus.join(pairs.hint("merge"), corpus[corpus_id] == pairs["_row_id"]).where(holds).drop("_row_id")


def exact_score(name: Column, term: Column) -> Column:
    """1.0 where the name equals the term but for case, else 0.5."""
    return F.when(F.lower(name) == F.lower(term), F.lit(1.0)).otherwise(F.lit(0.5))


def best_similarity(term: Column, columns: list[Column]) -> Column:
    """The best word similarity of the term over several columns."""
    scores = [word_similarity(term, F.coalesce(c, F.lit(""))) for c in columns]
    return F.greatest(*scores) if len(scores) > 1 else scores[0]


def _best(scored: DataFrame, query_id: str, corpus_id: str, k: int) -> DataFrame:
    """The best ``k`` rows per query with their position; Spark cuts each map task to ``k`` rows per query first."""
    order = [F.col("relevance").desc(), F.col("_date").desc_nulls_last(), F.col(corpus_id)]
    window = Window.partitionBy(query_id).orderBy(*order)
    return scored.withColumn("position", F.row_number().over(window)).where(F.col("position") <= k)


def bounded_similarity(found: DataFrame, query_id: str, corpus_id: str, padded: list[str], kept: list[str], k: int) -> tuple[DataFrame, DataFrame]:
    """Of candidates with ``_facts`` and padded texts: rows of known score, at most the best ``k`` per query, and rows that must be scored.

    A row is known if its bounds are equal. A row is open if they differ and its upper bound reaches the ``k``-th known score of its
    query, so what is left out of both cannot be among the best ``k``.
    """
    bounds = [similarity_bounds(F.col("_facts"), F.col(p)) for p in padded]
    both = [F.greatest(*side) if len(side) > 1 else side[0] for side in zip(*bounds)]
    bounded = found.withColumns({"_low": both[0], "_high": both[1]})
    known = bounded.where(F.col("_low") == F.col("_high")).select(query_id, corpus_id, *kept, "_date", F.col("_low").alias("relevance"))
    known = _best(known, query_id, corpus_id, k).drop("position")
    floor = known.groupBy(F.col(query_id).alias("_asked")).agg(F.when(F.count(F.lit(1)) >= k, F.min("relevance")).alias("_floor"))
    open_ = bounded.where(F.col("_low") < F.col("_high")).join(floor, F.col(query_id).eqNullSafe(F.col("_asked")), "left")
    open_ = open_.where(F.col("_high") >= F.coalesce("_floor", F.lit(0.0)))
    return known, open_.select(query_id, corpus_id, *kept, "_date", F.col("_facts.words").alias("_words"), *padded)


def search(
    queries: DataFrame,
    corpus: DataFrame,
    columns: list[str],
    query_id: str = "query_id",
    term: str = "term",
    corpus_id: str = "id",
    date: str | None = None,
    name: str | None = None,
    k: int = 8,
    scorer: str = "similarity",
    few: int = FEW_TERMS,
    where: Column | None = None,
    show: list[str] | None = None,
    broadcast_up_to: int = BROADCAST_TERMS,
) -> DataFrame:
    """The best ``k`` rows of ``corpus`` per query: (query_id, corpus_id, columns of ``show``, relevance, position).

    Only rows that ``where`` holds for are searched. Rows whose ``columns`` hold the term are scored by word similarity, or with
    ``scorer='exact'`` by equality with ``name``. Order: score, newest ``date`` (NULL last), smallest id.
    """
    if scorer not in ("similarity", "exact"):
        raise ValueError("scorer must be 'similarity' or 'exact'")
    k, show = max(1, k), [c for c in show or [] if c != corpus_id]
    when = F.col(date) if date else F.lit(None).cast("timestamp")
    searched = corpus if where is None else corpus.where(where)
    used = [c for c in dict.fromkeys([corpus_id, *columns, *show, *([name] if name else []), *([date] if date else [])])]
    similar = scorer == "similarity"
    padded = {f"_padded_{i}": padded_words(plain_words(F.col(c))) for i, c in enumerate(columns)} if similar else {}
    offered = searched.select(*used).withColumns(padded) if padded else searched.select(*used)
    found = candidates(queries, offered, query_id, term, corpus_id, columns, few, broadcast_up_to, similar).withColumn("_date", when)
    if similar:
        known, open_ = bounded_similarity(found, query_id, corpus_id, list(padded), show, k)
        best = best_similarity(F.col("_words"), [F.col(p) for p in padded])
        rest = open_.select(query_id, corpus_id, *show, "_date", best.alias("relevance"))
        scored = known.unionByName(rest)
    else:
        score = exact_score(F.col(name or columns[0]), F.col("_term"))
        scored = found.select(query_id, corpus_id, *show, "_date", score.alias("relevance"))
    return _best(scored, query_id, corpus_id, k).select(query_id, corpus_id, *show, "relevance", "position")
