"""Similarity join of documents by word n-grams, with adaptive multi-match prefixes.

The shingles of a document are ordered from rare to frequent. Two sets that overlap enough share a token among their first few;
a document whose first tokens are frequent takes a longer prefix and asks for as many more shared tokens before it is verified.
Equal sets are one class from the start. Inside a bucket of a shared token, members are first compared with one pivot; only
members that no chain of links joins yet are compared with each other, so a large group of near copies costs links in proportion
to its size, and no link between different groups is lost.

The order of tokens is the same for all documents. At first those with a small hash come first, by the exact number of distinct sets
that have them, and the others follow by hash; so only a fixed share of all tokens needs counting, and most documents are seen to
have no partner. The tokens of those that stay are then all counted and ordered by rarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablecare.llm.components import components
from tablecare.llm.words import Words, mix, shingle_sets, slices
from tablecare.session import cut_lineage

LONGEST_MATCH = 8
"""The most shared prefix tokens that a document may ask for."""

CANDIDATE_COST = 4.0
"""Cost of a candidate against that of a prefix token."""

PIVOT_ROUNDS = 2
"""Rounds of comparing bucket members with a pivot before the rest is compared in full."""

BROADCAST_ROWS = 500_000
"""Keys of so many counted rows at most are broadcast; more are joined by a shuffle."""


@dataclass(frozen=True)
class Similarity:
    """Linked if 100 * intersection >= percent * union of the distinct runs of ``shingle`` words.

    ``spread`` is how many prefixes' worth of tokens are counted; more helps where shingles often repeat by chance.
    """

    shingle: int = 5
    percent: int = 80
    spread: float = 1.3

    @property
    def counted(self) -> int:
        """Tokens below this are counted; tokens have 63 bits."""
        return int(min(1.0, self.spread * (100 - self.percent) / 100) * (2**63 - 1))


def _sets(batch_texts: pa.Array, shingle: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    for first, _, data, offsets in slices(batch_texts):
        words = Words(data, offsets)
        yield first, shingle_sets(words, words.hashes(lower=True), shingle)


def signatures(docs: DataFrame, like: Similarity, doc_id: str, text: str) -> DataFrame:
    """Per document: id, hash of the text, number of shingles, how many of them are counted, a 128-bit name of the set (a, b)."""
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, text_hash long, n long, counted long, a long, b long"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in _sets(batch.column(2), like.shingle):
                about = np.zeros((4, len(sets)), np.uint64)
                for i, tokens in enumerate(sets):
                    below = np.searchsorted(_filed(tokens), like.counted)
                    about[:, i] = len(tokens), below, mix(tokens).sum(dtype=np.uint64), mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
                columns = [pa.array(c) for c in about.view(np.int64)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), batch.column(1).slice(first, len(sets)), *columns], ["doc_id", "text_hash", "n", "counted", "a", "b"])

    return docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash"), docs[text].alias("text")).mapInArrow(sign, schema)


def _filed(tokens: np.ndarray) -> np.ndarray:
    """Tokens with 63 bits, as Spark orders them."""
    return (tokens >> np.uint64(1)).view(np.int64)


def _texts_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(a, b, text) of the wanted sets (a, b, doc_id, text_hash)."""
    texts = docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash"), docs[text].alias("text"))
    same = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["text_hash"] == wanted["text_hash"])
    wanted = F.broadcast(wanted) if wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else wanted
    return texts.join(wanted, same).select("a", "b", "text")


def _file(texts: DataFrame, like: Similarity) -> DataFrame:
    """(a, token, at): the tokens of each set that its prefix may take, with their places in the order of the hash.

    These are the counted ones, or as many as the longest prefix has if that is more.
    """

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_numpy()
            for first, sets in _sets(batch.column(1), like.shingle):
                filed = []
                for tokens in map(_filed, sets):
                    longest = len(tokens) - (like.percent * len(tokens) + 99) // 100 + LONGEST_MATCH
                    filed.append(tokens[: max(longest, int(np.searchsorted(tokens, like.counted)))])
                sizes = [len(f) for f in filed]
                places = np.concatenate([np.arange(n) for n in sizes])
                owner = np.repeat(names[first : first + len(sets)], sizes)
                yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(np.concatenate(filed)), pa.array(places)], ["a", "token", "at"])

    return texts.select("a", "text").mapInArrow(spell, "a long, token long, at long")


def prefix_of(n: int, counted: int, shared: tuple[np.ndarray, np.ndarray, np.ndarray], like: Similarity) -> tuple[np.ndarray, np.ndarray, int]:
    """The shared tokens in the prefix of a set of ``n``, their places, and how many of them a partner must share.

    ``shared`` has the tokens that other sets have too, their counts and their places by hash; ``counted`` of the set's tokens are
    counted ones. The other tokens match nothing, but those that are rarer take places in the prefix.
    """
    tokens, counts, places = shared
    outside = tokens >= like.counted
    order = np.lexsort((tokens, np.where(outside, 0, counts), outside))
    tokens, counts, inside = tokens[order], counts[order], int((~outside).sum())
    at = np.where(outside[order], places[order], np.arange(len(tokens)) + counted - inside)
    least = (like.percent * n + 99) // 100
    best, length, match = np.inf, 0, 1
    for m in range(1, min(LONGEST_MATCH, least) + 1):
        size = int(np.searchsorted(at, n - least + m))
        price = size + CANDIDATE_COST * float((counts[:size] - 1).sum()) / (m * m)
        if price < best:
            best, length, match = price, size, m
    return tokens[:length], at[:length], match


def _prefixes(filed: DataFrame, sets: DataFrame, like: Similarity) -> DataFrame:
    """(token, a, n, match, lone, at): the shared tokens, with their places, in the adaptive prefix of every set that may have a partner.

    A set whose prefix holds only tokens of its own leaves here; ``lone`` counts these among the counted tokens.
    """
    bucket = Window.partitionBy("token")
    known = filed.withColumns({"count": F.count("*").over(bucket), "low": F.min("a").over(bucket), "high": F.max("a").over(bucket)})
    lists = known.where("low <> high").groupBy("a").agg(F.collect_set(F.struct("token", "count", "at")).alias("shared"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = batch.column("shared")
            token, count, place = (c.to_numpy(zero_copy_only=False) for c in entries.flatten().flatten())
            ends = np.cumsum([0, *np.diff(entries.offsets.to_numpy())])
            a, n, counted = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "n", "counted"))
            rows = [(np.zeros(0, np.int64), np.zeros((0, 5), np.int64))]
            for i in range(len(a)):
                part = slice(ends[i], ends[i + 1])
                prefix, at, match = prefix_of(int(n[i]), int(counted[i]), (token[part], count[part], place[part]), like)
                if len(prefix):
                    lone = counted[i] - (token[part] < like.counted).sum()
                    own = np.tile(np.array([a[i], n[i], match, lone, 0], np.int64), (len(prefix), 1))
                    own[:, 4] = at
                    rows.append((prefix, own))
            about = np.concatenate([r[1] for r in rows])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([r[0] for r in rows])), *[pa.array(about[:, c].copy()) for c in range(5)]], ["token", "a", "n", "match", "lone", "at"])

    return lists.join(sets, "a").select("a", "n", "counted", "shared").mapInArrow(choose, "token long, a long, n long, match long, lone long, at long")


def _full_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(a, b, tokens) of the sets of some texts."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in _sets(batch.column(2), shingle):
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), batch.column(1).slice(first, len(sets)), tokens], ["a", "b", "tokens"])

    return texts.mapInArrow(spell, "a long, b long, tokens array<long>")


def _verified(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose sets are similar enough."""
    left = full.select(F.struct("a", "b").alias("x"), F.col("tokens").alias("xs"))
    right = full.select(F.struct("a", "b").alias("y"), F.col("tokens").alias("ys"))
    both = F.size(F.array_intersect("xs", "ys"))
    total = F.size("xs") + F.size("ys")
    return pairs.join(left, "x").join(right, "y").where(both * (100 + percent) >= total * percent).select("x", "y")


def _overlap(percent: int) -> Column:
    """The fewest tokens that sets of ``xn`` and ``n`` share if they are similar enough."""
    return F.ceil((F.col("xn") + F.col("n")) * percent / (100 + percent) - 1e-9)


def _fits(percent: int) -> Column:
    """Length filter, and each set has enough tokens that others have too."""
    enough = (F.col("xn") - F.col("xlone") >= _overlap(percent)) & (F.col("n") - F.col("lone") >= _overlap(percent))
    return (F.col("xn") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("xn") * percent) & enough


def link_classes(docs: DataFrame, like: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, links): per document its id, number of shingles and set name; links between set names that span all groups.

    Words are runs of bytes other than ASCII white space, with A-Z in lower case. A null or blank text has an empty set and no
    links. Repeated rows and equal texts have one set. A null id is a document like any other.
    """
    signed = cut_lineage(signatures(docs, like, doc_id, text))
    one = F.min(F.struct("doc_id", "text_hash")).alias("doc"), F.first("n").alias("n"), F.first("counted").alias("counted"), F.count("*").alias("copies")
    sets = signed.where("n > 0").groupBy("a", "b").agg(*one).select("a", "b", "n", "counted", "copies", "doc.doc_id", "doc.text_hash")
    sets = cut_lineage(sets)
    spelt = _file(_texts_of(docs, sets.select("a", "b", "doc_id", "text_hash"), doc_id, text), like)
    partnered = _in_company(cut_lineage(_prefixes(spelt, sets.select("a", "n", "counted"), like))).select("a").distinct()
    wanted = cut_lineage(sets.select("a", "b", "copies", "doc_id", "text_hash").join(partnered, "a", "left_semi"))
    full = cut_lineage(_full_sets(_texts_of(docs, wanted, doc_id, text), like.shingle))

    every = Similarity(like.shingle, like.percent, spread=101 / (100 - like.percent))
    spelt = full.select("a", F.explode("tokens").alias("token")).select("a", F.shiftrightunsigned("token", 1).alias("token"), F.lit(0).cast("long").alias("at"))
    meta = full.select("a", "tokens").dropDuplicates(["a"]).select("a", F.size("tokens").cast("long").alias("n")).withColumn("counted", F.col("n"))
    filed = _in_company(cut_lineage(_prefixes(spelt, meta, every))).join(wanted.select("a", "b", "copies"), "a")
    filed = cut_lineage(filed.select("token", F.struct("a", "b").alias("id"), "n", "match", "lone", "at", "copies"))
    full = cut_lineage(full.join(filed.select("id.a", "id.b").distinct(), ["a", "b"], "left_semi").dropDuplicates(["a", "b"]))

    links, open_ = None, filed.withColumn("label", F.col("id"))
    for turn in range(PIVOT_ROUNDS):
        rank = F.struct(*([] if turn else [-F.col("copies")]), F.xxhash64("id", F.lit(turn)).alias("rank"), "id", "n", "lone", "label")
        pivots = open_.groupBy("token").agg(F.min(rank).alias("pivot"))
        pairs = open_.join(pivots, "token").where(F.col("label") != F.col("pivot.label"))
        pairs = pairs.select(F.col("pivot.id").alias("x"), F.col("pivot.n").alias("xn"), F.col("pivot.lone").alias("xlone"), F.col("id").alias("y"), "n", "lone")
        found = _verified(pairs.where(_fits(like.percent)).select("x", "y").distinct(), full, like.percent)
        links = cut_lineage(found if links is None else links.unionAll(found))
        open_ = _still_open(filed, links)
        if open_.limit(1).count() == 0:
            return signed, links
    rest = _verified(_cross_pairs(open_, like.percent), full, like.percent)
    return signed, cut_lineage(links.unionAll(rest))


def _in_company(filed: DataFrame) -> DataFrame:
    """The rows whose token more than one set has."""
    shared = filed.groupBy("token").count().where("count > 1").select("token")
    return filed.join(shared, "token", "left_semi")


def _still_open(filed: DataFrame, links: DataFrame) -> DataFrame:
    """Bucket rows whose bucket holds members of different groups, with the group as ``label``."""
    groups = components(links)
    rows = filed.join(groups, "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = rows.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("token")
    return cut_lineage(rows.join(mixed, "token", "left_semi"))


def _cross_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different groups that share enough prefix tokens.

    In a bucket the members of its largest group meet only the members of other groups, and a pair is named where its first shared token
    can stand: no more tokens may come before it than either set can miss. A named pair shares as many prefix tokens as both ask for;
    and of the set whose prefix ends first, no more tokens may be missing than the overlap that both sizes need allows.
    """
    largest = rows.groupBy("token", "label").count().groupBy("token").agg(F.max(F.struct("count", "label")).alias("top")).select("token", F.col("top.label").alias("main"))
    placed = rows.join(largest, "token")
    few = placed.where("label <> main").select("token", F.col("id").alias("x"), F.col("n").alias("xn"), F.col("at").alias("xat"), F.col("lone").alias("xlone"), F.col("label").alias("xl"))
    first = (F.col("xn") - F.col("xat") >= _overlap(percent)) & (F.col("n") - F.col("at") >= _overlap(percent))
    met = few.join(placed, "token").where((F.col("xl") != F.col("label")) & ((F.col("label") == F.col("main")) | (F.col("x") < F.col("id"))) & _fits(percent) & first)
    named = met.select("x", F.col("id").alias("y")).distinct()

    prefixes = rows.groupBy("id").agg(F.collect_list("token").alias("prefix"), F.first("n").alias("n"), F.first("match").alias("match"))
    left = prefixes.select(F.col("id").alias("x"), F.col("prefix").alias("xp"), F.col("n").alias("xn"), F.col("match").alias("xm"))
    both = named.join(left, "x").join(prefixes.withColumnRenamed("id", "y"), "y")
    spare = lambda n, match: F.col(match) - F.ceil(F.col(n) * percent / 100 - 1e-9) + _overlap(percent)
    need = F.greatest(F.least("xm", "match"), F.least(spare("xn", "xm"), spare("n", "match")))
    return both.where(F.size(F.array_intersect("xp", "prefix")) >= need).select("x", "y")


def document_groups(docs: DataFrame, like: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest id that links reach, itself included.

    Documents without words form groups of their own; a group of null ids only has a null component.
    """
    signed, links = link_classes(docs, like, doc_id, text)
    lowest = signed.where("n > 0").groupBy("a", "b").agg(F.min("doc_id").alias("own"))
    named = _grouped(lowest, links)
    least = named.groupBy("group").agg(F.min("own").alias("component_id"))
    labels = cut_lineage(named.join(least, "group").select("a", "b", "component_id"))
    full = signed.where("n > 0").join(labels, ["a", "b"]).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    return full.unionAll(signed.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def _grouped(sets: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of sets (a, b) with ``group``, the name that stands for all sets that links join."""
    groups = components(links).select(F.col("id.a").alias("a"), F.col("id.b").alias("b"), F.col("label").alias("group"))
    return sets.join(groups, ["a", "b"], "left").withColumn("group", F.coalesce("group", F.struct("a", "b")))


def keep_one(docs: DataFrame, like: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, that with the smallest id (a null first, then by hash of the text), with all its columns.

    Documents without words are in no group and all stay. Of rows that repeat id and text one stays.
    """
    signed, links = link_classes(docs, like, doc_id, text)
    key = F.struct("doc_id", "text_hash")
    first = signed.where("n > 0").groupBy("a", "b").agg(F.min(key).alias("key"))
    winners = _grouped(first, links).groupBy("group").agg(F.min("key").alias("key")).select("key", F.lit(True).alias("worded"))
    stay = winners.unionAll(signed.where("n = 0").select(key.alias("key"), F.lit(False).alias("worded")).distinct())
    rows = docs.select(F.struct(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash")).alias("key"), F.struct("*").alias("row"))
    ranked = rows.join(cut_lineage(stay), "key").withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("worded")))
    return ranked.where("rank = 1 OR NOT worded").select(*[F.col("row")[c].alias(c) for c in docs.columns])
