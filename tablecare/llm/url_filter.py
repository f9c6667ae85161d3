"""URL filters: allow and block rules by host and path, and for the rest logistic regression on hashed character n-grams.

Everything that touches the table is a DataFrame expression of one row: no shuffle, no Python worker, so a host that holds a third of
all rows costs no more than any other. The model is fitted by Spark ML on a bounded table of labelled urls.

Null urls, and urls without ``://``, have an empty host and path; no rule fits them and the model sees no n-gram, only its intercept.
A repeated row is judged twice, an empty table gives no rows. A url of any length is read whole: n-grams come from one pass over it.
"""

from __future__ import annotations

import json
import math
import random
import string
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SIZES = (3, 4, 5)
"""Letters in an n-gram."""

BUCKETS = 1 << 13
"""Buckets that n-grams are hashed to."""

MOST_LABELS = 20_000
"""Labelled urls that the model is fitted on at most; of more, those with the smallest hash are taken."""

MOST_INLINE_RULES = 200
"""Up to so many rules are tested as one expression; more are met in a join on the host."""


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def read(cls, text: str) -> Rule:
        """A rule such as ``block example.com/en/``; the host ends at the first slash and is put in lower case (A-Z)."""
        verdict, _, place = text.strip().partition(" ")
        host, slash, path = place.strip().partition("/")
        if verdict not in ("allow", "block") or not host:
            raise ValueError(f"not a rule: {text!r}")
        return cls(verdict, host.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)), slash + path)

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """From the end of the host to the next ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def _grams(text: Column) -> Column:
    """All overlapping n-grams, in one pass over the text for each size."""
    return F.concat(*[F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in SIZES])


def _fields(host: Column, path: Column) -> dict[str, Column]:
    """The texts whose n-grams count, by the name that keeps their n-grams apart; an empty one has none.

    Digits of a path are one digit: numbers of articles say nothing, and few labels would give them chance weights.
    """
    edged = F.when(host == "", "").otherwise(F.concat(F.lit("^"), host, F.lit("$")))
    return {"host": edged, "path": F.translate(path, string.digits, "0" * 10)}


def _buckets(field: str, grams: Column) -> Column:
    return F.transform(grams, lambda g: F.pmod(F.xxhash64(F.lit(field), g), F.lit(BUCKETS)).cast("int"))


@dataclass(frozen=True)
class Model:
    """Weights by bucket; a url is blocked where its score is above 0."""

    intercept: float
    weights: tuple[float, ...]

    def score(self, host: Column, path: Column) -> Column:
        """The log-odds of a url: the weights of its n-grams, per field over the root of their number."""
        weights = F.from_json(F.lit(json.dumps(self.weights)), "array<double>")
        total = F.lit(self.intercept)
        for field, text in _fields(host, path).items():
            grams = _grams(text)
            summed = F.aggregate(_buckets(field, grams), F.lit(0.0), lambda s, b: s + weights[b])
            total = total + summed / F.sqrt(F.greatest(F.size(grams), F.lit(1)))
        return total


def train(labelled: DataFrame, url: str = "url", blocked: str = "blocked", most_labels: int = MOST_LABELS, strength: float = 5e-5) -> Model:
    """Fit the model on a small table of urls and labels (1 block, 0 allow; rows with another label are left out).

    Of more than ``most_labels`` rows those whose url has the smallest hash are taken. The n-grams are hashed by the same expression
    that scores the table; their counts (bounded by the labels) come to the driver and are fitted in one partition, so the model does
    not depend on the cluster. Labels of one kind only, or none, give a model that blocks all or nothing.
    """
    known = labelled.select(F.coalesce(labelled[url], F.lit("")).alias("url"), labelled[blocked].cast("int").alias("label")).where(F.col("label").isin(0, 1))
    known = known.orderBy(F.xxhash64("url"), "url", "label").limit(most_labels)
    fields = _fields(host_of(F.col("url")), path_of(F.col("url")))
    rows = known.select("url", "label", *[_buckets(f, _grams(t)).alias(f) for f, t in fields.items()]).collect()
    rows.sort(key=lambda r: (r["url"], r["label"]))
    kinds = {r["label"] for r in rows}
    if len(kinds) < 2:
        return Model(1.0 if kinds == {1} else -1.0, (0.0,) * BUCKETS)
    examples = []
    for row in rows:
        values: Counter[int] = Counter()
        for field in fields:
            for bucket in row[field]:
                values[bucket] += 1 / math.sqrt(len(row[field]))
        examples.append((float(row["label"]), Vectors.sparse(BUCKETS, sorted(values.items()))))
    frame = labelled.sparkSession.createDataFrame(examples, ["label", "features"]).coalesce(1)
    fitted = LogisticRegression(maxIter=40, regParam=strength, standardization=False).fit(frame)
    return Model(float(fitted.intercept), tuple(float(w) for w in fitted.coefficients.toArray()))


def _rule_inline(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    found = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in sorted(rules, key=_rank, reverse=True)
    ]
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule string, verdict string>")


def _rank(rule: Rule) -> tuple:
    """The longer rule wins, then the longer host, then block."""
    return len(rule.name), len(rule.host), rule.verdict


def _suffixes(host: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rules_by_join(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, found) of the distinct ``places`` (host, path) that a row of ``rules`` (verdict, host, path) fits.

    For rule tables of any size: an equi-join on the host and its parent domains, then the longest rule by a pre-aggregated maximum.
    Spark chooses the join from the sizes and splits the domains that hold most urls.
    """
    asked = places.select("host", "path").distinct().select("host", "path", F.explode(_suffixes(F.col("host"))).alias("domain"))
    lower = F.translate(rules["host"], string.ascii_uppercase, string.ascii_lowercase)
    known = rules.select(lower.alias("domain"), F.coalesce(rules["path"], F.lit("")).alias("starts"), rules["verdict"].alias("verdict")).distinct()
    fits = asked.join(known, "domain").where(F.col("path").startswith(F.col("starts")))
    name = F.concat("domain", "starts")
    ranked = F.struct(F.length(name).alias("size"), F.length("domain").alias("inner"), F.col("verdict").alias("verdict"), name.alias("rule"))
    return fits.groupBy("host", "path").agg(F.max(ranked).alias("best")).select("host", "path", F.struct("best.rule", "best.verdict").alias("found"))


def judge(urls: DataFrame, model: Model, rules: Iterable[Rule] = (), url: str = "url") -> DataFrame:
    """Every row as a struct ``row`` beside host, path, rule, score and verdict (allow or block).

    The longest fitting rule decides; where none fits, ``rule`` is null and the model's ``score`` decides (null where a rule did).
    """
    rules = list(dict.fromkeys(rules))
    packed = urls.select(F.struct(*[urls[c] for c in urls.columns]).alias("row"), host_of(urls[url]).alias("host"), path_of(urls[url]).alias("path"))
    host, path = F.col("host"), F.col("path")
    if len(rules) <= MOST_INLINE_RULES:
        known = packed.withColumn("found", _rule_inline(host, path, rules))
    else:
        spark: SparkSession = urls.sparkSession
        table = spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
        known = packed.join(rules_by_join(packed, table), ["host", "path"], "left")
    scored = known.withColumn("score", F.when(F.col("found").isNull(), model.score(host, path)))
    decided = F.coalesce(F.col("found.verdict"), F.when(F.col("score") > 0, "block").otherwise("allow"))
    return scored.select("row", "host", "path", F.col("found.rule").alias("rule"), "score", decided.alias("verdict"))


BLOCKED_WORDS = (
    "casino poker slots jackpot roulette betting bets bet win winner prize lottery pills pill pharmacy viagra cialis diet cheap discount free "
    "adult sex xxx porn cams dating escort loan loans payday credit spam farm links click clicks ads adserver track tracker popup banner "
    "torrent warez crack keygen serial replica fake hack cheats coupon bonus promo deals money earn rich crypto forex"
).split()
"""Words of hosts that a web filter refuses: gambling, drugs, adult content, debt, advertising, link farms, piracy."""

CLEAN_WORDS = (
    "news daily times post journal press radio library museum school university college institute research science history archive wiki docs "
    "manual guide learn open data code forum community city council garden kitchen recipes travel rail weather climate river mountain forest "
    "music theatre cinema books reader letters health hospital clinic sport football chess bank insurance shop store market studio design "
    "alphabet better windows winter window pillow roads leads soundtrack farmers freedom english gazette essex middlesex"
).split()
"""Words of ordinary hosts; the last row holds words that contain a blocked one."""


_SOUNDS = [*"aeiouaeioubcdfghklmnprstvwz", "th", "sh", "st", "nd", "nt", "wh", "ing", "er", "an", "re", "le"]
"""What invented names are made of."""


def labelled_urls(count: int = 8000, seed: int = 11) -> list[tuple[str, int]]:
    """(url, blocked) made by a rule, half of them blocked: hosts of one or two words or invented names under shared prefixes, endings and paths.

    Only the names tell the two kinds apart, and some paths; prefixes, top-level domains, languages, numbers and queries are drawn alike.
    """
    r = random.Random(seed)
    name = lambda: "".join(r.choice(_SOUNDS) + r.choice(_SOUNDS) for _ in range(r.randint(1, 3)))
    rows = []
    for k in range(count):
        blocked = k % 2
        if blocked:
            words = [r.choice(BLOCKED_WORDS)] + ([r.choice(BLOCKED_WORDS + ["x", "net", "online", "4u", "24"])] if r.random() < 0.8 else [])
        else:
            words = [name()] if r.random() < 0.6 else r.choices(CLEAN_WORDS, k=r.randint(1, 2))
            words += [name()] if r.random() < 0.2 else []
        r.shuffle(words)
        host = r.choice(["", "", "www.", "m.", "blog.", "en."]) + r.choice(["-", "-", ""]).join(words) + r.choice([".example", ".site", ".page", ""]) + r.choice([".com", ".net", ".org", ".info", ".de", ".fr"])
        path = r.choice(["", "/", f"/{r.choice(['en', 'de', 'fr', 'es'])}/{r.randint(1, 10 ** r.randint(1, 5))}", f"/{r.randint(2001, 2026)}/{r.randint(1, 12)}/{name()}", f"/{name()}/{name()}.html", "/index.html"])
        path += r.choice(["", "", "/", ".html"]) if path and not path.endswith(("/", "html")) else ""
        if r.random() < 0.15:
            path = f"/{r.choice(['buy-now', 'bonus', 'promo', 'click', 'win-prize']) if blocked else r.choice(['about', 'contact', 'article', 'chapter', 'photos'])}{path}"
        rows.append((f"{r.choice(['http', 'https'])}://{host}{path}{r.choice(['', '', '?page=2', '#top', '?utm_source=feed'])}", blocked))
    return rows
