"""Removal of lines that repeat or nearly repeat an earlier line: an exact set-similarity join in DataFrame functions.

A line is the set of its five-word shingles. Two lines match if the Jaccard similarity of their sets is 0.8 or more; a line goes
if any earlier line (by doc_id, hash of the text, line number) matches it. A line with fewer words than a shingle has one shingle of
all its words, so it matches equal lines only. Blank lines stay.

1. Equal sets collapse to their first line, with a count.
2. Any two sets that match share ``m`` of the first ``n - ceil(0.8 n) + m`` tokens under any common order. With hashes as the order and
   three shared tokens asked for, most lines are seen to have no partner and leave.
3. The tokens of the lines that stay are ordered by rarity: by how many of them have it. Tokens of one line only match nothing but
   take places in the prefix, so lines without a partner leave here.
4. Lines that share a token of their prefixes are compared with the earliest line of the bucket and with the most frequent one, which
   settles large groups; what is still open is compared with every earlier line of its buckets that passes the length and
   positional filters. Every pair is verified.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablecare.session import cut_lineage

SHINGLE = 5
PERCENT = 80

MATCHES = 3
"""Shared prefix tokens that the first filter asks for."""

BROADCAST_ROWS = 500_000
"""Keys of so many counted rows at most are broadcast; more are joined by a shuffle."""

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
"""The setting by which a job's shuffle files go when it ends, not when the driver happens to collect its garbage."""

_BLANKS = " \t\x0b\x0c\r"


def _worded(line: Column) -> Column:
    """Whether a line has a word. A first character beyond the blanks tells at once; only other lines are trimmed."""
    return (F.ascii(line) > 32) | (F.btrim(line, F.lit(_BLANKS)) != "")


def _shingles(line: Column) -> tuple[Column, Column]:
    """(words as hashes, shingles of the column ``words``): the second reads the first as ``words``.

    A split at single spaces needs no regular expression; the empty strings that it leaves between blanks are no words.
    """
    spaced = F.lower(line)
    for blank in _BLANKS[1:]:
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    words = F.transform(F.array_remove(F.split(spaced, " "), ""), lambda w: F.xxhash64(w))
    runs = F.transform(F.sequence(F.lit(0), F.size("words") - SHINGLE), lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(SHINGLE)]))
    return words, F.when(F.size("words") >= SHINGLE, F.sort_array(F.array_distinct(runs))).otherwise(F.array(F.xxhash64("words")))


def _needed(n: Column) -> Column:
    """The fewest tokens that a match of a set of ``n`` shares with it."""
    return F.ceil(n * PERCENT / 100).cast("int")


def occurrences(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per line that is not blank: its place, its 128-bit set name (a, b), set size and hash-ordered prefix."""
    own = docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash"), docs[text].alias("text"))
    lines = own.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    words, tokens = _shingles(F.col("line"))
    worded = lines.where(_worded(F.col("line"))).select("doc_id", "text_hash", "pos", words.alias("words"))
    sets = worded.select("doc_id", "text_hash", "pos", tokens.alias("tokens"))
    n = F.size("tokens")
    prefix = F.transform(F.slice("tokens", F.lit(1), n - _needed(n) + MATCHES), lambda t: F.shiftright(t, 32).cast("int"))
    return sets.select("doc_id", "text_hash", "pos", F.xxhash64("tokens").alias("a"), F.xxhash64("tokens", F.lit(1)).alias("b"), n.alias("n"), prefix.alias("prefix"))


def _fits(x: str, y: str) -> Column:
    """Length filter."""
    return (F.col(x) * 100 >= F.col(y) * PERCENT) & (F.col(y) * 100 >= F.col(x) * PERCENT)


def _matches(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs (id, other), the ids whose sets match."""
    mine = sets.select("id", F.col("tokens").alias("xs"))
    theirs = sets.select(F.col("id").alias("other"), F.col("tokens").alias("ys"))
    both, total = F.size(F.array_intersect("xs", "ys")), F.size("xs") + F.size("ys")
    return pairs.distinct().join(mine, "id").join(theirs, "other").where(both * (100 + PERCENT) >= total * PERCENT).select("id")


def _by_rarity(sets: DataFrame) -> DataFrame:
    """(token, id, n, first, copies, at): the shared tokens in the prefix of each set, with their places, rare tokens first."""
    spelt = sets.select("id.a", F.explode("tokens").alias("token"))
    known = F.count("*").over(Window.partitionBy("token"))
    common = spelt.withColumn("known", known).where("known > 1")
    lists = common.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("known", "token"))).alias("rare"))
    ordered = lists.join(sets.select("id.a", "id", "n", "first", "copies"), "a").withColumn("lone", F.col("n") - F.size("rare"))
    placed = ordered.where(F.col("lone") <= F.col("n") - _needed(F.col("n"))).select("id", "n", "first", "copies", "lone", F.posexplode("rare").alias("rank", "entry"))
    placed = placed.select(F.col("entry.token").alias("token"), "id", "n", "first", "copies", (F.col("rank") + F.col("lone")).alias("at"))
    return placed.where(F.col("at") <= F.col("n") - _needed(F.col("n")))


def _open_pairs(members: DataFrame, undecided: DataFrame) -> DataFrame:
    """(id, other): an undecided line and an earlier one of its buckets that pass the length and positional filters."""
    later = members.join(undecided, "id", "left_semi")
    earlier = members.select("token", F.col("id").alias("other"), F.col("n").alias("m"), F.col("first").alias("before"), F.col("at").alias("there"))
    can_share = F.least(F.col("n") - F.col("at"), F.col("m") - F.col("there"))
    near = (F.col("before") < F.col("first")) & _fits("n", "m") & (can_share * (100 + PERCENT) >= (F.col("n") + F.col("m")) * PERCENT)
    return later.join(earlier, "token").where(near).select("id", "other")


def _cleaning(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``function`` of documents, whose steps are materialised, without the shuffle files of the steps that are done."""

    @wraps(function)
    def cleaned(docs: DataFrame, *args: str, **named: str) -> DataFrame:
        conf = docs.sparkSession.conf
        before = conf.get(CLEAN_UP, None)
        conf.set(CLEAN_UP, "true")
        try:
            return function(docs, *args, **named)
        finally:
            conf.unset(CLEAN_UP) if before is None else conf.set(CLEAN_UP, before)

    return cleaned


@_cleaning
def later_matches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, pos) of every line that matches an earlier one; ``text_hash`` is ``xxhash64(text)``, ``pos`` from 0.

    A null or empty text has no lines. Equal lines of one document count as any others. Rows that repeat both id and text are one
    document: their lines are judged once. A null id comes first in the order. Further columns do not matter.
    """
    lines = cut_lineage(occurrences(docs, doc_id, text))
    place = F.struct("doc_id", "text_hash", "pos")
    filed = lines.where(F.col("n") > MATCHES).groupBy("a", "b").agg(F.first("prefix").alias("prefix")).select("a", F.explode("prefix").alias("token"))
    bucket = Window.partitionBy("token")
    shared = filed.select("a", F.min("a").over(bucket).alias("low"), F.max("a").over(bucket).alias("high")).where("low <> high")
    partnered = shared.groupBy("a").count().where(F.col("count") >= MATCHES).select("a")

    distinct = lines.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("copies"), F.first("n").alias("n"))
    marked = distinct.join(partnered.withColumn("partnered", F.lit(True)), "a", "left").where("copies > 1 OR partnered")
    marked = cut_lineage(marked)
    sets = cut_lineage(_spelt(docs, marked.where("partnered"), doc_id, text))
    members = cut_lineage(_by_rarity(sets))
    sets = cut_lineage(sets.join(members.select("id").distinct(), "id", "left_semi"))

    pivots = members.groupBy("token").agg(F.min(F.struct("first", "id", "n")).alias("earliest"), F.max(F.struct("copies", "first", "id", "n")).alias("frequent"), F.count("*").alias("size"))
    met = members.select("token", "id", "n", "first").join(pivots.where("size > 1"), "token")
    pivot = F.explode(F.array("earliest", F.struct("frequent.first", "frequent.id", "frequent.n"))).alias("pivot")
    near = met.select("id", "n", "first", pivot).select("id", "n", "first", F.col("pivot.id").alias("other"), F.col("pivot.n").alias("m"), F.col("pivot.first").alias("before"))
    gone = cut_lineage(_matches(near.where((F.col("before") < F.col("first")) & _fits("n", "m")).select("id", "other"), sets).distinct())

    waiting = met.where("size > 2 AND first <> earliest.first").select("id").distinct().join(gone, "id", "left_anti")
    gone = gone.unionAll(_matches(_open_pairs(members, waiting), sets)).distinct()

    judged = marked.select("a", "b", "first", "copies").join(gone.select("id.a", "id.b", F.lit(True).alias("gone")), ["a", "b"], "left")
    judged = judged.where("copies > 1 OR gone").select("a", "b", "first", "gone")
    hit = lines.select("doc_id", "text_hash", "pos", "a", "b").join(judged, ["a", "b"])
    return hit.where(F.col("gone") | ~place.eqNullSafe(F.col("first"))).select("doc_id", "text_hash", "pos").distinct()


def _spelt(docs: DataFrame, active: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The whole sets of the active lines, read again from the documents where they first stand."""
    spots = active.groupBy(F.col("first.doc_id").alias("at_id"), F.col("first.text_hash").alias("at_hash")).agg(F.collect_list(F.struct("a", "b", "n", "first", "copies")).alias("spots"))
    own = docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash"), docs[text].alias("text"))
    spots = F.broadcast(spots) if active.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else spots
    found = own.join(spots, own["doc_id"].eqNullSafe(spots["at_id"]) & (own["text_hash"] == spots["at_hash"]))
    words, tokens = _shingles(F.col("line"))
    lines = found.select(F.split("text", "\n").alias("lines"), F.explode("spots").alias("spot")).select("spot", F.get("lines", F.col("spot.first.pos")).alias("line"))
    return lines.select("spot", words.alias("words")).select(F.struct("spot.a", "spot.b").alias("id"), "spot.n", "spot.first", "spot.copies", tokens.alias("tokens"))


def removed_per_document(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, removed): the line numbers to leave out, for documents that have any."""
    return later_matches(docs, doc_id, text).groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list("pos")).alias("removed"))


def drop_later_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents without those lines; ``length``, if there is such a column, is set to the new number of characters.

    All other columns stay as they are, whatever their names. A text that loses all its lines is dropped with its row; a text
    that was null or empty stays.
    """
    removed = removed_per_document(docs, doc_id, text).select(F.struct("doc_id", "text_hash").alias("key"), "removed")
    rows = docs.select(F.struct(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash")).alias("key"), F.struct("*").alias("row"))
    joined = rows.join(removed, "key", "left")
    lines = F.split(F.col("row")[text], "\n")
    kept = F.filter(lines, lambda line, i: ~F.array_contains(F.col("removed"), i))
    joined = joined.select("row", "removed", F.when(F.col("removed").isNull(), lines).otherwise(kept).alias("lines")).where("removed IS NULL OR size(lines) > 0")
    shown = {text: F.when(F.col("removed").isNull(), F.col("row")[text]).otherwise(F.array_join("lines", "\n"))}
    if length in docs.columns:
        shown[length] = F.when(F.col("removed").isNull(), F.col("row")[length]).otherwise(F.length(shown[text])).cast(docs.schema[length].dataType)
    return joined.select(*[shown.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
