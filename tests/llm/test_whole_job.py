"""Inputs that the operators once left aside, against plain versions of the whole job."""

import hashlib
import json
from collections import Counter

from tablecare.llm import html_content, line_dedup, secrets, wordpiece_counts
from tablecare.llm.queries import QUERIES, vocabulary
from tests.conftest import SMALL, plan_of
from tests.llm import brute
from tests.oracle import connect


def test_line_dedup_of_short_lines(spark):
    texts = ["Home\n\none two three four\na b c d e f", "home \n \t\n two one three four\nONE  two three\tfour\na b c d", "a b c d\na b c d e\nHome\n\none", "home", "a b c d e f\n\n"]
    rows = list(enumerate(texts))
    expected = {i: g for (i, _), g in zip(rows, brute.later_lines(rows)) if g}
    assert expected == {1: [0, 3], 2: [0, 2], 3: [0], 4: [0]}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["removed"] for r in line_dedup.removed_per_document(docs).collect()} == expected
    assert {r["doc_id"]: r["text"] for r in line_dedup.drop_later_lines(docs).collect()} == {0: texts[0], 1: " \t\n two one three four\na b c d", 2: "a b c d e\n\none", 4: "\n"}


def greedy_pieces(text, vocabulary):
    """Longest entry first, word by word; the last letter of a word stands only in entries that end a word."""
    n = 0
    for word in text.lower().split():
        letters, at = "".join(map(wordpiece_counts.byte_letter, word.encode())) + "</w>", 0
        while at < len(letters):
            ends = [len(letters), *range(len(letters) - 5, at, -1)]
            at = next(end for end in ends if letters[at:end] in vocabulary)
            n += 1
    return n


def test_token_counts_cover_every_word(spark):
    text = vocabulary("word_bpe_49k.json")
    known = set(json.loads(text)["model"]["vocab"]) - {"<|startoftext|>", "<|endoftext|>"}
    assert [greedy_pieces(w, known) for w in ("für", "ciónciónciónue")] == [3, 10]
    rows = [tuple(r) for r in connect(SMALL).execute("SELECT doc_id, text FROM documents").fetchall()] + [(-1, "für ciónciónciónue"), (-2, "</w> a</w> \x00\x1f é😀ß " + "für" * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = Counter((i, len((t or "").lower().split()), greedy_pieces(t or "", known)) for i, t in rows)
    assert Counter(tuple(r) for r in wordpiece_counts.count_tokens(docs, text).collect()) == expected
    assert Counter(tuple(r) for r in QUERIES["op5_token_counts"](spark, SMALL).collect()) == Counter({k: n for k, n in expected.items() if k[0] >= 0})


def test_pages_without_head_end(spark):
    body = "<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>First para is here.<p>Second one is here too.</article><footer>&copy; x</footer>"
    heads = ["<meta charset=utf-8><title>t</title>", "<script>var x</script><style>p{}</style><link rel=x>", "<template><p>no</p></template>", "\n<!-- c -->\n<noscript><p>no</p></noscript>"]
    pages = [f"<!doctype html><html><head>{h}{opened}{body}" for h in heads for opened in ("</head><body>", "<body>", "", "\n")]
    model = html_content.train(html_content.labelled_pages())
    frame = spark.createDataFrame([(k, None, p) for k, p in enumerate(pages)], "page_id long, url string, html string")
    found = [r["text"] for r in html_content.extract(frame, model).orderBy("page_id").collect()]
    assert found == ["Title\nFirst para is here.\nSecond one is here too."] * len(pages)
    runs = lambda source: [t for t in html_content.parse(source).text if t]
    assert runs("<head><title>t</title> text <b>of</b> the page") == ["text of the page"]
    assert runs("<head><title>t</title></body>text") == runs("<head><meta>text") == ["text"]
    assert runs("<html><head><head><title>t</title><p>one") == ["one"]
    assert runs("<head><template><p>no</p></template></head><p>yes") == ["yes"]


def test_secret_spans(spark):
    words = vocabulary("word_bpe_49k.json")
    key, jwt = "q7Zr2LkX9vB4nT6mW1cY", "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.dBjftJeZ4CVP-mB92K27uhbUJU1p1r_wW1gFWFOEjXk"
    texts = [
        ("é API_KEY=", key, " x"), ("run --token=", key, " x"), ("run --token ", "q7Zr2LkX", " x"), ("https://a.b/c?api_key=", key, "&page=2"), ("https://a.b/c?key=", key, "&page=2"),
        ("Authorization: Bearer ", jwt, "\n"), ("see ", jwt, "."), ('é😀 {"password": "', "Ab!9x#z", '", "user": "bob"}'), ("password='", 'p"4,ss=w)rd', "'"), ("private key: ", "hUnter2!", ", user: bob"), ("f(token=", "ab12cd34", ",name=x)"),
    ]
    docs = spark.createDataFrame([(k, b + v + a, "src") for k, (b, v, a) in enumerate(texts)], "doc_id long, text string, source string")
    found = [tuple(r) for r in secrets.find(docs, words).select("doc_id", "start", "length", "sha256").orderBy("doc_id").collect()]
    assert found == [(k, len(b), len(v), hashlib.sha256(v.encode()).hexdigest()) for k, (b, v, _) in enumerate(texts)]
    held = secrets.labelled_findings(1000, seed=31)
    made = spark.createDataFrame([(k, b + v + a, p) for k, (v, b, a, p, _) in enumerate(held)], "doc_id long, text string, source string")
    sure = {tuple(r)[:4] for r in secrets.scan(made, words).collect()}
    real = {(k, len(b), len(v), hashlib.sha256(v.encode()).hexdigest()) for k, (v, b, _, _, y) in enumerate(held) if y}
    assert len(sure & real) >= 0.97 * len(real) and len(sure - real) <= 0.03 * len(held)


def test_line_query_judges_every_line(spark):
    rows = [tuple(r) for r in connect(SMALL).execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()]
    found = {r["doc_id"]: r["removed_lines"] for r in QUERIES["op9_line_dedup"](spark, SMALL).collect()}
    assert found == {i: ",".join(map(str, g)) for (i, _), g in zip(rows, brute.later_lines(rows))}


def test_line_words_between_any_blanks(spark):
    blanks, words = ["\t", "\x0b", "\x0c", "\r", " ", "\r \t", " \x0c\x0b "], "One two É\u00a0é \x01 five six \x1f seven".split(" ")
    lines = [b.join(words) for b in blanks] + [b + b.join(words) + b for b in blanks] + blanks + ["\x01", "\x01 ", "\x1f\t", "\u00a0", " \u00a0", "".join(words)]
    rows = [(0, "\n".join(lines[:9])), (1, "\n".join(lines[9:])), (2, "\n".join(lines)), (3, "\x01\r\n\r\n")]
    expected = {i: g for (i, _), g in zip(rows, brute.later_lines(rows)) if g}
    assert [len(g) for g in expected.values()] == [8, 7, 20, 1]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert {r["doc_id"]: r["removed"] for r in line_dedup.removed_per_document(docs).collect()} == expected


def test_equal_lines_are_collapsed_once(spark):
    rows = [(k, f"a line of {k % 5} words that stands in some texts\nand one of its own {k}") for k in range(20)]
    found = line_dedup.later_matches(spark.createDataFrame(rows, "doc_id long, text string"))
    scans = [line for line in plan_of(found).splitlines() if "Scan ExistingRDD" in line]
    assert len([scan for scan in scans if "prefix" in scan]) == 1
    assert sorted((r["doc_id"], r["pos"]) for r in found.collect()) == [(k, p) for k, g in enumerate(brute.later_lines(rows)) for p in g]


def test_settings_stay_after_line_dedup(spark):
    before = spark.conf.get(line_dedup.CLEAN_UP, None)
    rows = [(0, "one line\nanother line"), (1, "one line")]
    assert line_dedup.later_matches(spark.createDataFrame(rows, "doc_id long, text string")).count() == 1
    assert spark.conf.get(line_dedup.CLEAN_UP, None) == before
