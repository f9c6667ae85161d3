"""Benchmark decontamination: short test items found inside documents, in DataFrame functions.

A document holds an item if at least 80 % of the item's five-word shingles are among its own. Of an item with ``n`` shingles, the
``n - ceil(0.8 n) + 1`` with the smallest hashes (its bottom MinHash values) cannot all be missing from a document that holds it. So
the search looks only for these. Documents are partitioned by size, and a partition only meets items that are small enough: the
largest of their bottom values bounds the hashes that a document of that size has to look up. The bound loses no hit, and
every candidate is verified by its exact shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablecare.session import cut_lineage

SHINGLE = 5
PERCENT = 80

BROADCAST_ROWS = 500_000
"""Small sides of up to so many counted rows of fixed width are broadcast; larger ones are joined by shuffles."""


def small(df: DataFrame) -> DataFrame:
    """``df``, with a broadcast hint if it has few rows; count it only when it is written already."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case; a null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _starts(of: str) -> Column:
    """The places where a shingle starts: 0 alone for fewer words than a shingle, none without words."""
    return F.when(F.size(of) > 0, F.sequence(F.lit(0), F.greatest(F.size(of) - SHINGLE, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _hashes(of: str) -> Column:
    """A hash of each shingle of the word column ``of``, which holds word hashes."""
    return F.transform(_starts(of), lambda i: F.xxhash64(*[F.get(F.col(of), i + k) for k in range(SHINGLE)]))


def _spelt(of: str) -> Column:
    """The distinct shingles of the word column ``of`` as texts."""
    return F.array_distinct(F.transform(_starts(of), lambda i: F.array_join(F.slice(F.col(of), i + 1, SHINGLE), " ")))


def _class(size: Column) -> Column:
    """Partition by size: the number of binary digits."""
    return F.length(F.bin(size.cast("long")))


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, n_shingles, n_shared) of every item that a document holds; ``text_hash`` is ``xxhash64(text)``.

    Null, empty or wordless texts and items hit nothing. An item of fewer than five words is one shingle and hits only documents
    that consist of just those words. Repeated rows give one hit; of equal item ids each text counts. Ids may be null.
    """
    test = items.select(items[item_id].alias("item_id"), words(items[item_text]).alias("words")).where(F.size("words") > 0)
    test = test.withColumn("hashed", F.transform("words", lambda w: F.xxhash64(w)))
    test = test.select("item_id", _spelt("words").alias("spelt"), F.array_sort(F.array_distinct(_hashes("hashed"))).alias("hashes"), F.xxhash64("words").alias("name"))
    n = F.size("hashes")
    need = F.ceil(n * PERCENT / 100).cast("int")
    test = cut_lineage(test.dropDuplicates(["item_id", "name"]).select("item_id", "name", "spelt", _class(need).alias("size_class"), F.slice("hashes", F.lit(1), n - need + 1).alias("bottom")))
    keys = small(cut_lineage(test.select("item_id", "name", F.explode("bottom").alias("token"))))
    bounds = test.groupBy("size_class").agg(F.max(F.array_max("bottom")).alias("bound")).orderBy("size_class").collect()

    own = docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash"), docs[text].alias("text"))
    hashed = own.select("doc_id", "text_hash", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashed"))
    hashed = hashed.withColumn("tokens", _hashes("hashed")).withColumn("size_class", _class(F.size("tokens")))
    highest, bound = None, F.lit(None).cast("long")
    for row in bounds:
        highest = row["bound"] if highest is None else max(highest, row["bound"])
        bound = F.when(F.col("size_class") >= row["size_class"], F.lit(highest)).otherwise(bound)
    looked_up = hashed.withColumn("bound", bound).select("doc_id", "text_hash", F.explode(F.filter("tokens", lambda t: t <= F.col("bound"))).alias("token"))
    met = cut_lineage(looked_up.join(keys, "token").select("doc_id", "text_hash", "item_id", "name").distinct())

    candidates = small(met.select(F.struct("doc_id", "text_hash").alias("key"), "item_id", "name"))
    texts = own.select(F.struct("doc_id", "text_hash").alias("key"), "text").join(candidates, "key").select("key", words(F.col("text")).alias("words"), "item_id", "name")
    spelt = test.select(F.col("item_id").alias("of_item"), F.col("name").alias("of_name"), "spelt")
    spelt = small(spelt) if test.limit(20_001).count() <= 20_000 else spelt
    both = texts.join(spelt, (texts["name"] == spelt["of_name"]) & texts["item_id"].eqNullSafe(spelt["of_item"]))
    shared = both.select("key", "item_id", F.size("spelt").alias("n_shingles"), F.size(F.array_intersect(_spelt("words"), "spelt")).alias("n_shared"))
    held = shared.where(F.col("n_shared") * 100 >= F.col("n_shingles") * PERCENT)
    return held.select("key.doc_id", "key.text_hash", "item_id", F.col("n_shingles").cast("long").alias("n_shingles"), F.col("n_shared").cast("long").alias("n_shared")).distinct()


def drop_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that hold no item, with all their columns."""
    held = small(cut_lineage(leaks(docs, items, doc_id, text).select(F.struct("doc_id", "text_hash").alias("held")).distinct()))
    rows = docs.select(F.struct("*").alias("row"), F.struct(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash")).alias("key"))
    kept = rows.join(held, F.col("key") == F.col("held"), "left_anti")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
