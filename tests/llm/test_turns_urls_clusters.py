"""Conversation repair, URL filters and centroid clustering on hostile small tables, against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tablecare.llm import centroids, turn_repair, url_filter
from tablecare.llm.queries import QUERIES
from tests.conftest import SMALL, plan_of
from tests.llm import brute
from tests.oracle import connect

RULES = [url_filter.Rule.read(t) for t in ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")]

URLS = [
    None, "", "no scheme", "http://", "http:///", "://", "HTTP://WWW.Example.COM/EN/x", "https://www.example.com/en/1", "https://a.www.example.com/en/", "https://example.com/en/1?x",
    "https://notexample.com/en/1", "https://example.com", "https://example.com?/en/", "https://example.com#/en/", "https://x.net/es/", "https://net/fr/", "https://xnet/fr/", "https://a.net/fr",
    "a://b://c.com/d", "http://ÄÖ.net/es/é😀", "http://a.com\n/x\ny", "http://user:pw@h.net:80/es/z", "http://.com/", "http://com./", "http://cheap-pills.org/buy", "http://cheap-pills.org/buy",
]


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.train(spark.createDataFrame(url_filter.labelled_urls(), "url string, blocked int"))


def plain_parts(url):
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def plain_verdict(url, model):
    host, path = plain_parts(url)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    score = model.intercept
    for field, text in (("host", f"^{host}$" if host else ""), ("path", re.sub("[0-9]", "0", path))):
        grams = [text[k : k + n] for n in (3, 4, 5) for k in range(len(text) - n + 1)]
        seed, summed = xxhash.xxh64(field.encode(), seed=42).intdigest(), 0.0
        for gram in grams:
            summed += model.weights[xxhash.xxh64(gram.encode(), seed=seed).intdigest() % len(model.weights)]
        score += summed / math.sqrt(max(len(grams), 1))
    return host, path, None, "block" if score > 0 else "allow"


def test_url_query(spark, model):
    rows = connect(SMALL).execute("SELECT page_id, url FROM pages").fetchall()
    found = QUERIES["op11_url_filters"](spark, SMALL)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"] and "Python" not in plan_of(found) and "Exchange" not in plan_of(found)
    assert Counter(map(tuple, found.collect())) == Counter((i, *plain_verdict(u, model)) for i, u in rows)
    judged = url_filter.judge(spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url"), model).collect()
    assert {("-" in r["host"], r["verdict"]) for r in judged} == {(True, "block"), (False, "allow")}


def test_hostile_urls(spark, model):
    long = "http://h.org/" + "ab/" * 200_000
    rows = [(k, u, "x", "y", "z") for k, u in enumerate([*URLS, long])]
    urls = spark.createDataFrame(rows, "page_id long, url string, host string, path string, verdict string").repartition(3)
    found = url_filter.judge(urls, model, RULES).collect()
    assert Counter((r["row"]["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found if r["row"]["page_id"] < len(URLS)) == Counter((k, *plain_verdict(u, model)) for k, u in enumerate(URLS))
    assert {tuple(r["row"])[2:] for r in found} == {("x", "y", "z")}
    assert [plain_verdict(long, model)[3]] == [r["verdict"] for r in found if r["row"]["url"] == long]
    assert url_filter.judge(urls.limit(0), model, RULES).count() == 0
    assert {r["verdict"] for r in url_filter.judge(spark.createDataFrame([(None,), ("",)], "url string"), model).collect()} == {"allow"}


def test_rules_by_join_equal_inline(spark, model, monkeypatch):
    urls = spark.createDataFrame([(u,) for u in URLS], "url string")
    read = lambda df: Counter((r["host"], r["path"], r["rule"], r["verdict"]) for r in df.collect())
    inline = read(url_filter.judge(urls, model, RULES))
    monkeypatch.setattr(url_filter, "MOST_INLINE_RULES", 0)
    assert read(url_filter.judge(urls, model, RULES)) == inline
    with pytest.raises(ValueError):
        url_filter.Rule.read("maybe com/")


def test_held_out_urls(spark, model):
    held = url_filter.labelled_urls(1000, seed=77)
    judged = url_filter.judge(spark.createDataFrame(held, "url string, blocked int"), model).collect()
    assert sum((r["verdict"] == "block") == (r["row"]["blocked"] == 1) for r in judged) >= 0.98 * len(held)
    one_kind = spark.createDataFrame([("http://a.b", 1), (None, None), ("x", 7)], "url string, blocked int")
    assert url_filter.train(one_kind).intercept > 0 > url_filter.train(one_kind.limit(0)).intercept


def test_search_equals_plain_version():
    r = random.Random(12)
    for _ in range(4000):
        size = r.randint(0, 11)
        initials, faults = "".join(r.choices("suuaa-", k=size)), "".join(r.choices("bdt----", k=size))
        assert turn_repair.search(initials, faults) == brute.cheapest_edits(initials, faults)
    for initials in ("u" * 3000, "ua" * 1500, "-" * 3000, "s" * 3000):
        assert turn_repair.search(initials, "-" * 3000) == brute.cheapest_edits(initials, "-" * 3000)


def plain_repair(rows):
    """The digest row of one conversation; ``rows`` are (turn, role, text) in order."""
    seen, initials, faults = set(), [], []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "-")
        seen.add((role, text))
        initials.append(role[:1])
    cost, audit = brute.cheapest_edits([i if i in ("s", "u", "a") else "-" for i in initials], faults)
    lines, left, last = [], iter(rows), ""
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(left)[1:]
        if letter != "D":
            role = role if letter == "K" else "assistant" if last == "u" else "user"
            last = role[0]
            lines.append(f"{role}:{text}")
    numbers = {n for n, _, _ in rows if n is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def repair_all(turns):
    plans = turn_repair.plan(turns)
    ends = {r["conv"]: r["repaired_sha256"] for r in turn_repair.digests(turn_repair.repaired(turns, plans)).collect()}
    return {r["conv"]: (*tuple(r)[1:], ends[r["conv"]]) for r in plans.collect()}


def test_hostile_conversations(spark):
    r = random.Random(3)
    texts = ["", " \t\n", "A sentence.", "no end", "end? \n", "é😀.", "x\u2028", "a " * 100_000 + ".", "A sentence."]
    conversations = {c: [(r.choice([None, 0, 1, 2, 3, 9]), r.choice(["user", "assistant", "system", "tool", "", "User"]), r.choice(texts)) for _ in range(r.randint(1, 9))] for c in range(60)}
    conversations[None] = [(None, "assistant", "Late."), (2, "user", "Early.")]
    conversations[-1] = [(k, ("user", "assistant")[k % 2], f"Turn {k}.") for k in range(5000)]
    order = lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest())
    rows = [(c, *t, "x", "y") for c, ts in conversations.items() for t in ts]
    r.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string, digest string").repartition(5)
    found = repair_all(turn_repair.ordered_turns(frame))
    assert found == {c: plain_repair(sorted(ts, key=order)) for c, ts in conversations.items()}
    kept = turn_repair.repaired(turn_repair.ordered_turns(frame), turn_repair.plan(turn_repair.ordered_turns(frame))).where("conv = -1").orderBy("place").collect()
    assert [(k["place"], k["edit"], k["role"], k["text"]) for k in kept] == [(k, "K", t[1], t[2]) for k, t in enumerate(conversations[-1])]
    assert repair_all(turn_repair.ordered_turns(frame.limit(0))) == {}
    nothing = spark.createDataFrame([(5, None, None, None), (5, None, None, None)], "conv_id long, turn long, role string, text string")
    assert repair_all(turn_repair.ordered_turns(nothing)) == {5: (0, 2, 0, 0, 1, 4, "DD", hashlib.sha256(b"").hexdigest())}


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", f"One. Two! {t}?") for c in range(40) for t in range(6)] + [(None, None, None, None)]
    found = turn_repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    expected = Counter()
    for c, t, role, text in rows:
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        kind = zlib.crc32(name.encode()) % 20
        hurt = {1: "", 2: re.sub("[.!?]", "", text or " ")}.get(kind, " " if text is None else text)
        expected[(c, t, "user" if kind == 4 else role or " ", hurt, kind == 0)] += 2 if kind == 3 else 1
    assert Counter((x["conv"], x["turn"], x["role"], x["text"], x["gone"]) for x in found) == expected


def test_cluster_query(spark):
    rows = connect(SMALL).execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    assert Counter(map(tuple, QUERIES["op13_centroid_clustering"](spark, SMALL).collect())) == Counter(brute.clusters(rows))


def test_hostile_vectors(spark):
    r = random.Random(9)
    coarse = lambda: [r.choice([-0.5, 0.0, 0.25, 0.5]) if k < 3 else 0.0 for k in range(64)]
    rows = [(k, coarse()) for k in range(150)] + [(3, coarse()), (None, coarse()), (None, coarse()), (7, [1000.0] * 64)]
    rows += [(200, None), (201, []), (202, [0.0] * 63), (203, [0.0] * 65), (204, [None] + [0.0] * 63), (205, [math.nan] * 64), (206, [math.inf] + [0.0] * 63)]
    frame = spark.createDataFrame([(i, v, "c", 1, 2) for i, v in rows], "vec_id long, embedding array<float>, cluster string, v int, row int").repartition(7)
    found = centroids.cluster(frame)
    assert Counter((x["row"]["vec_id"], *tuple(x)[1:]) for x in found.collect()) == Counter(brute.clusters(rows))
    assert {(x["row"]["cluster"], x["row"]["v"], x["row"]["row"]) for x in found.collect()} == {("c", 1, 2)}
    assert centroids.cluster(frame.limit(0)).count() == 0 and centroids.cluster(frame.where("vec_id > 199")).count() == 0
    few = frame.where("vec_id < 3")
    assert Counter((x["row"]["vec_id"], *tuple(x)[1:]) for x in centroids.cluster(few).collect()) == Counter(brute.clusters([x for x in rows if x[0] is not None and x[0] < 3]))
    with pytest.raises(Exception, match="after scaling"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>")).collect()


def test_orchard_measures_few_and_ties_go_to_the_smaller():
    r = np.random.default_rng(4)
    for _ in range(30):
        points = r.integers(-3, 4, (24, 2)).astype(np.int64)
        vectors = r.integers(-4, 5, (300, 2)).astype(np.int64)
        every = ((vectors[:, None] - points[None]) ** 2).sum(2)
        number, distance = centroids.Orchard.of(points).nearest(vectors)
        assert (number == every.argmin(1)).all() and (distance == every.min(1)).all()
