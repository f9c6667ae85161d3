"""The operators on hostile small tables, against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablecare.llm import chat, decontamination, html_content, jaccard_join, line_dedup, packing, quality, secrets, substring_dedup, wordpiece_counts
from tablecare.llm.components import components
from tablecare.llm.queries import vocabulary
from tests.conftest import plan_of
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, a string, b string, n string, row string, key string, tokens string, text_hash string, label string"


def prose(r, n):
    return " ".join("".join(r.choices("aeilnorst", k=r.randint(1, 7))) for _ in range(n))


def hostile_rows():
    r = random.Random(4)
    long = "\n".join(prose(r, 40) for _ in range(60))
    base = prose(r, 120)
    near = base.split()
    near[60] = "changed"
    shared = prose(r, 90)
    texts = ["", None, "   \n\t\n", "one", "one two", "one two", long, long, base, base.upper(), " ".join(near), base, f"{prose(r, 30)}\n{shared}\n{prose(r, 9)}", f"{shared}\n{prose(r, 50)}"]
    texts += ["\n".join(["the same line again and again here"] * 30), "a " * 900, "é€😀 " * 60, " thin\x1fspace\x85 words 'tis İ ΣΑΣ <|endoftext|> token", "# * $ % & | < >\n" * 5]
    texts += [" ".join(base.split()[k:] + prose(r, k).split()) for k in range(1, 12)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "one"), (8, base), (None, base), (None, "null id words and more words")]
    r.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return hostile_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else "src", len(t or ""), *["x"] * 8) for k, (i, t) in enumerate(rows)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_measures(docs, empty, rows):
    found = quality.measure(docs, keep=["doc_id", "text"]).select("row.*", *quality.MEASURES[:5]).collect()
    assert Counter((r[1], *r[2:]) for r in found) == Counter((t, *brute.measures(t)) for _, t in rows)
    assert quality.measure(empty).count() == 0
    assert quality.measure(docs).select("row.*").columns == docs.columns


def test_cutoffs_control_risk(spark):
    r = random.Random(2)
    made = [(i, "en" if i % 3 else None, int(r.random() < 0.8)) for i in range(9000)]
    made = [(i, s, q, 100, 500, r.choice([0, 0, 1, 4]) if q else r.choice([0, 40, 90]), 0, 0, 5, 20) for i, s, q in made]
    labelled = spark.createDataFrame(made, "doc_id long, stratum string, quality int, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_capitals long, n_short_words long")
    cutoffs = quality.fit_cutoffs(labelled, "stratum")
    assert {c.stratum for c in cutoffs} == {"en", None} and {c.rule for c in cutoffs} == {"symbols"}
    for c in cutoffs:
        assert c.good_rejected == sum(q and s == c.stratum and y / 100 > c.above for _, s, q, _, _, y, *_ in made)
        assert c.bound == quality.binomial_upper(c.good_rejected, c.good, 0.05 / 8) <= 0.01
    kept = labelled.where(quality.verdict(cutoffs, F.col("stratum")))
    assert kept.where("quality = 1").count() == sum(q for _, _, q, *_ in made)
    assert quality.fit_cutoffs(labelled.limit(0), "stratum") == []


def test_binomial_bound():
    assert abs(quality.binomial_upper(0, 100, 0.05) - (1 - 0.05 ** (1 / 100))) < 1e-9
    assert quality.binomial_upper(5, 5, 0.05) == 1.0


@pytest.mark.parametrize("like", [jaccard_join.Similarity(3, 90, spread=2.0), jaccard_join.Similarity(5, 80), jaccard_join.Similarity(1, 60)])
def test_jaccard_groups(docs, empty, rows, like):
    sets, roots = brute.groups(rows, like.shingle, like.percent)
    ids = defaultdict(list)
    for (i, _), root in zip(rows, roots):
        ids[root].append(i)
    lowest = {root: min((i for i in own if i is not None), default=None) for root, own in ids.items()}
    expected = Counter((i, len(s), lowest[root] if s else i) for (i, _), s, root in zip(rows, sets, roots))
    assert Counter(tuple(r) for r in jaccard_join.document_groups(docs, like).collect()) == expected
    assert jaccard_join.document_groups(empty, like).count() == 0


def test_jaccard_without_pivots(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PIVOT_ROUNDS", 1)
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    like = jaccard_join.Similarity(2, 50, spread=0.5)
    _, roots = brute.groups(rows, 2, 50)
    found = jaccard_join.document_groups(docs, like)
    assert found.select("component_id").where("n_shingles > 0").distinct().count() == len({r for r, (_, t) in zip(roots, rows) if (t or "").strip()})


def test_keep_one(docs, empty, rows):
    kept = jaccard_join.keep_one(docs, jaccard_join.Similarity(5, 80))
    sets, roots = brute.groups(rows, 5, 80)
    assert kept.columns == docs.columns
    assert kept.count() == len({r for r, s in zip(roots, sets) if s}) + sum(not s for s in sets)
    assert jaccard_join.keep_one(empty).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 300), (7, 7)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(chain, "x long, y long")).collect())
    assert found == {**{i: 1 for i in range(1, 61)}, 100: 100, 200: 100, 300: 100}


def ordered(rows):
    """Rows as line dedup orders them, without repeated rows."""
    return sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))


def test_line_dedup(spark, docs, empty, rows):
    once = [(i, t) for i, t in ordered(rows) if i is not None]
    own = spark.createDataFrame(once, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r["removed"] for r in line_dedup.removed_per_document(own).collect()}
    assert found == {i: g for (i, _), g in zip(once, brute.later_lines(once)) if g}
    cleaned = {r["doc_id"]: r for r in line_dedup.drop_later_lines(own.withColumn("n_chars", F.length("text"))).collect()}
    for (i, t), gone in zip(once, brute.later_lines(once)):
        kept = [line for k, line in enumerate(t.split("\n")) if k not in gone] if t is not None else None
        assert (i in cleaned) == (kept != [])
        if i in cleaned:
            assert cleaned[i]["text"] == (t if kept is None else "\n".join(kept)) and cleaned[i]["n_chars"] == (None if t is None else len(cleaned[i]["text"]))
    assert line_dedup.drop_later_lines(docs).columns == docs.columns
    assert line_dedup.drop_later_lines(docs).count() > 0 and line_dedup.drop_later_lines(empty).count() == 0


def test_line_dedup_random(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    r = random.Random(8)
    bases = [[prose(r, 1) for _ in range(r.randint(5, 40))] for _ in range(12)]

    def line():
        words = list(r.choice(bases))
        for _ in range(r.choice([0, 1, 1, 2])):
            words[r.randrange(len(words))] = prose(r, 1)
        return " ".join(words)

    once = [(i, "\n".join(line() for _ in range(r.randint(1, 9)))) for i in range(60)]
    found = {x["doc_id"]: x["removed"] for x in line_dedup.removed_per_document(spark.createDataFrame(once, "doc_id long, text string").repartition(4)).collect()}
    assert found == {i: g for (i, _), g in zip(once, brute.later_lines(once)) if g}


def test_leaks(spark, docs, empty, rows, monkeypatch):
    texts = [t for _, t in rows if t]
    items = [(0, " ".join(texts[2].split()[:30])), (1, "one"), (1, "one two"), (2, None), (3, ""), (None, "null id words and more words"), (4, "never seen words stand here now"), (5, prose(random.Random(1), 50))]
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, doc_id string")
    expected = brute.leaks(rows, items)
    assert expected
    for limit in (500_000, 0):
        monkeypatch.setattr(decontamination, "BROADCAST_ROWS", limit)
        assert {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, bench).collect()} == expected
    kept = decontamination.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not brute.leaks([row], items) for row in rows)
    assert decontamination.leaks(docs, bench.limit(0)).count() == 0 and decontamination.leaks(empty, bench).count() == 0


def test_packing(docs, empty, rows):
    found = packing.pack(docs, vocabulary("word_bpe_49k.json")).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[(r["doc_id"], r["piece"])].append((r["start"], r["length"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {k: sorted(v) for k, v in pieces.items()} == brute.token_pieces(rows)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    assert packing.pack(empty, vocabulary("word_bpe_49k.json")).count() == 0


def test_packing_histograms():
    r = random.Random(6)
    for _ in range(40):
        capacity = r.choice([1, 7, 64, 500])
        histogram = {r.randint(1, capacity): r.randint(1, 400) for _ in range(r.randint(1, 60))}
        groups = packing.pack_histogram(histogram, capacity, 32)
        back = Counter()
        for g in groups:
            assert g.room >= 0 and sum(n * t for n, t in g.content) + g.room == capacity
            for n, t in g.content:
                back[n] += t * g.count
        assert back == Counter(histogram)
        total = sum(n * c for n, c in histogram.items())
        assert sum(g.count for g in groups) <= 2 * -(-total // capacity)


def test_nonnegative_least_squares():
    r = np.random.default_rng(3)
    for _ in range(20):
        a, x = r.random((12, 8)), np.maximum(r.random(8) - 0.4, 0)
        assert np.allclose(packing.nonnegative_least_squares(a, a @ x), x, atol=1e-6)


@pytest.mark.parametrize("largest", [2000, 2])
def test_repeated_strings(spark, docs, empty, rows, largest, monkeypatch):
    monkeypatch.setattr(substring_dedup, "LARGEST_GROUP", largest)
    if largest == 2:
        monkeypatch.setattr(substring_dedup, "BROADCAST_ROWS", 0)
    r = random.Random(largest)
    passage = prose(r, 150)
    more = [(100 + k, prose(r, r.randint(1, 80)) + passage[r.randint(0, 30) : len(passage) - r.randint(0, 30)] + prose(r, 60)) for k in range(12)] + [(150, "xyz" * 700), (151, "q" * 1000)]
    own = docs.select("doc_id", "text", "a", "b").unionAll(spark.createDataFrame([(i, t, "x", "x") for i, t in more], "doc_id long, text string, a string, b string"))
    expected = Counter((i, *d) for (i, _), d in zip(rows + more, brute.repeats(rows + more)))
    assert Counter(tuple(x) for x in substring_dedup.removed_digest(own).collect()) == expected
    assert substring_dedup.removed_digest(empty).count() == 0


@pytest.mark.parametrize(("few", "bits"), [(50_000, 1 << 25), (0, 1 << 25), (0, 1 << 15)])
def test_repeats_broadcast_no_lists(spark, few, bits, monkeypatch):
    """Only hashes or a sieve of bounded size go through the driver, and both lose no document."""
    monkeypatch.setattr(substring_dedup, "BROADCAST_ROWS", few)
    monkeypatch.setattr(substring_dedup, "SIEVE_BITS", bits)
    r = random.Random(bits)
    passage = prose(r, 150)
    data = [(k % 7 or None, prose(r, 60) + passage[k : len(passage) - k] + prose(r, 60)) for k in range(20)] + [(k, prose(r, 90)) for k in range(30, 40)]
    data += [(50, data[0][1]), (None, data[25][1]), (None, data[1][1]), data[3], (60, None), (61, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    keyed = docs.where("text <> ''").select(F.xxhash64("text").alias("a"), "doc_id", F.sequence(F.lit(1), F.lit(500)).alias("spots")).distinct()
    joined = substring_dedup._joined(docs, keyed, "doc_id", "text")
    sent = [line for line in plan_of(joined).splitlines() if "BroadcastExchange" in line]
    assert "SortMergeJoin" in plan_of(joined) and len(sent) == 1
    assert sorted(((x["at_id"], x["text"]) for x in joined.collect()), key=repr) == sorted(((i, t) for i, t in data if t), key=repr)
    sieve = substring_dedup._sieve(keyed.select(F.col("a").alias("key")))
    assert sieve.columns == ["key"] if few else {len(x["bits"]) for x in sieve.collect()} == {4096} and sieve.count() <= bits // 32768
    everything = spark.range(5000).select(F.xxhash64("id").alias("key")).unionAll(keyed.select("a"))
    held, rest = (substring_dedup._sifted(everything, sieve, x) for x in (True, False))
    assert held.count() + rest.count() == everything.count() and rest.join(keyed, F.col("key") == F.col("a")).count() == 0
    expected = Counter((i, *d) for (i, _), d in zip(data, brute.repeats(data)))
    assert Counter(tuple(x) for x in substring_dedup.removed_digest(docs).collect()) == expected


def test_chat_round_trip(spark):
    said = ["", None, "<|turn|>user<|text|>x<|end|>", "</s>[INST] ok [/INST]", "back\\slash <\\| \\\\ [\\", "a" * 5000, "<"]
    turns = [(1, k, r, t) for k, (r, t) in enumerate(zip(["user", "assistant", None, "assistant", "assistant", "<|text|>", "user"], said))] + [(None, 0, "assistant", "x"), (None, 0, "assistant", "x"), (2, None, "user", "y"), (2, 1, "assistant", "z")]
    frame = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, formatted int").repartition(3)
    found = {r["conv_id"]: r for r in chat.format_chats(frame).select("*", chat.read_turns(F.col("formatted")).alias("back"), chat.loss_text(F.col("pieces")).alias("loss")).collect()}
    assert [tuple(t) for t in found[1]["back"]] == [(r or "", t or "") for _, _, r, t in turns[:7]]
    assert found[1]["loss"] == "".join(t or "" for _, _, r, t in turns[:7] if r == "assistant")
    assert all("".join(p["text"] for p in r["pieces"]) == r["formatted"] for r in found.values())
    assert found[None]["n_turns"] == 2 and found[None]["loss"] == "xx" and found[2]["n_turns"] == 2
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_chat_parts(spark):
    parts = [("text", "see <|ima", None, None), ("text", "ge|> ", None, None), ("image", None, "i.png", 2), ("audio", None, "a.wav", None), ("other", "t", None, 3), ("document", "ignored", "d.pdf", -1)]
    row = chat.format_chats(spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, text {chat.PARTS}")).collect()[0]
    assert re.findall(r"<\|(?:image|audio|document)\|>", row["formatted"]) == ["<|image|>", "<|audio|>", "<|document|>"]
    assert [tuple(a) for a in row["attachments"]] == [(0, 2, "image", "i.png", 512), (0, 3, "audio", "a.wav", 25), (0, 5, "document", "d.pdf", 512)]
    assert row["attachment_tokens"] == 1049


def test_longest_match():
    r = random.Random(1)
    for k in range(400):
        entries = {"".join(r.choices("abc", k=r.randint(1, 5))) + r.choice(["", "</w>"]) for _ in range(r.randint(1, 14))} | ({"a", "b", "c", "a</w>", "b</w>", "c</w>"} if k % 2 else set())
        automaton, known = wordpiece_counts.LongestMatch(entries), {tuple(wordpiece_counts.LongestMatch.symbols(e)) for e in entries}
        for _ in range(10):
            word = "".join(r.choices("abc", k=r.randint(1, 12)))
            symbols, at, n = (*word, "</w>"), 0, 0
            while at < len(symbols):
                size = max((j for j in range(1, len(symbols) - at + 1) if symbols[at : at + j] in known), default=0)
                if not size:
                    n = 1
                    break
                at, n = at + size, n + 1
            assert automaton.count(word) == n


def test_token_counts(docs, empty, rows):
    found = wordpiece_counts.count_tokens(docs, vocabulary("word_bpe_49k.json")).collect()
    assert Counter((r["doc_id"], r["n_words"]) for r in found) == Counter((i, len((t or "").lower().split())) for i, t in rows)
    assert all((r["n_tokens"] >= r["n_words"]) for r in found)
    assert wordpiece_counts.count_tokens(empty, vocabulary("word_bpe_49k.json")).count() == 0


PAGES = [
    ("<html><body><nav><a href=x>Home</a></nav><article><h1>Title &amp; more</h1><p>First   para\n<b>bold</b> text here.<p>Second one is here too.</article><footer>&copy; x</footer>", "Title & more\nFirst para bold text here.\nSecond one is here too."),
    ("<body><div class=cookie-notice><p>We use cookies to make things better.</p></div><main><p>The real story is told in this long sentence.</p><aside><p>Related things to read.</p></aside></main><form><label>Name</label></form>", "The real story is told in this long sentence."),
    ("<div id=wrap><div class=header><a href=/>Site</a></div><div class=post><h1>Head line</h1><p>Text one is here.</p><div class='ad-slot'>Buy now our things today.</div><p>Text two is here.</p></div><div id=comments><p>Nice post, I like it very much.</p></div></div>", "Head line\nText one is here.\nText two is here."),
    ("", ""),
    (None, ""),
    ("<script>var x='<p>no</p>'</script><style>p{}</style>", ""),
]


def test_html(spark):
    model = html_content.train(html_content.labelled_pages())
    frame = spark.createDataFrame([(k, None, h, "t") for k, (h, _) in enumerate(PAGES)] + [(None, "u", PAGES[0][0], "t")], "page_id long, url string, html string, text string")
    found = {r["page_id"]: r for r in html_content.extract(frame, model).collect()}
    assert [found[k]["text"] for k in range(len(PAGES))] == [t for _, t in PAGES]
    assert all(r["n_chars"] == len(r["text"]) for r in found.values()) and found[None]["url"] == "u"
    assert html_content.extract(frame.limit(0), model).count() == 0
    held = [html_content.parse(p) for p in html_content.labelled_pages(60, seed=77)]
    forest = html_content.Forest.of(held)
    right = ((model.marginals(forest)[0] > 0.5) == np.array([bool(s) for p in held for s in p.label]))[forest.leaf]
    assert right.mean() > 0.97


def test_sum_product_against_enumeration():
    page = html_content.parse("<div><p>some words are here</p><aside>x</aside></div>")
    forest, r = html_content.Forest.of([page]), np.random.default_rng(5)
    model = html_content.Model(r.normal(size=len(html_content._PLACE)), r.normal(size=(2, 2, 2)))
    own, n = forest.x @ model.weights, len(forest.parent)
    weight, ones = 0.0, np.zeros(n)
    for code in range(2**n):
        y = [(code >> i) & 1 for i in range(n)]
        score = np.exp(sum(own[i] * y[i] for i in range(n)) + sum(model.pair[int(forest.leaf[i]), y[forest.parent[i]], y[i]] for i in range(n) if forest.parent[i] >= 0))
        weight, ones = weight + score, ones + score * np.array(y)
    assert np.allclose(model.marginals(forest)[0], ones / weight)


def test_secrets(spark, docs, empty):
    words = vocabulary("word_bpe_49k.json")
    held = secrets.labelled_findings(400, seed=99)
    model = secrets.train(spark, words, secrets.labelled_findings(2000), trees=20)
    made = spark.createDataFrame([(k, b + v + a, p, y) for k, (v, b, a, p, y) in enumerate(held)], "doc_id long, text string, source string, score int")
    scored = secrets.judge(secrets.find(made, words), model)
    sure = {r["doc_id"] for r in scored.where("score >= 0.5").collect()}
    assert sum((k in sure) == bool(h[4]) for k, h in enumerate(held)) >= 0.97 * len(held)
    assert secrets.find(docs, words).columns[:4] == ["doc_id", "start", "length", "sha256"] and secrets.find(empty, words).count() == 0
    one = spark.createDataFrame([(1, 'é token = "3dc91a32781def2fd668aa2fd071eacee1a19444" x', None, 0), (2, None, "p", 0)], "doc_id long, text string, source string, n int")
    row = secrets.judge(secrets.find(one, words), model).collect()
    assert [(r["doc_id"], r["start"], r["length"], r["sha256"]) for r in row] == [(1, 11, 40, hashlib.sha256(b"3dc91a32781def2fd668aa2fd071eacee1a19444").hexdigest())]
