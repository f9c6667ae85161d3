"""Secret scans: a random forest tells real credentials from other strings that look like them.

Candidates are the values that are assigned to a name of a credential, however short and whatever symbols they hold, and other long
runs of key letters, also dotted ones, that are not plain words. Names and separators are not part of a candidate. A forest judges each by its length, the changes between kinds of
letters, how much of it dictionary pieces cover, the path of its document and the words next to it. It is trained from labelled findings.
"""

from __future__ import annotations

import json
import math
import random
import re
import string
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablecare.llm.wordpiece_counts import LongestMatch

LONG = 16
"""Letters of a run that is a candidate wherever it stands."""
SHORT = 4
"""Letters of a value that is a candidate next to the name of a credential."""

RUN = re.compile(r"(?<![\w+/-])[A-Za-z0-9_+/-]++(?:\.[A-Za-z0-9_+/-]++)*+(?:={1,2}(?![\w+/=-]))?")
_PLAIN = re.compile(r"(?:[A-Za-z]?[a-z]+|[A-Z]+)(?:\.(?:[A-Za-z]?[a-z]+|[A-Z]+))*+")
_NEXT = re.compile(r"[,;&](?=[\w.-]{1,64}[:=])")
_OPENED = {")": "(", "]": "[", "}": "{", ">": "<"}
NEAR = 48
"""Letters before and after a candidate that are looked at."""

# Words that name credentials, words that name other things, and parts of paths that hold examples.
NAMES = re.compile(r"secret|token|passw|pwd|api.?key|apikey|auth|bearer|credential|private|access.?key|client.?key", re.I)
_ASSIGNED = re.compile(
    rf"(?P<url>[?&][\w.-]{{0,64}})?(?:{NAMES.pattern})[\w-]{{0,64}}(?:[ \t](?:key|token|phrase))?(?:[\"'`]?\]?[ \t]*(?::=|=>|[:=])[ \t]*|(?<=[\w-])[ \t]+(?=[^\s:=-])(?P<flag>))(?:(?:bearer|basic|token)[ \t]+)?"
    r"(?:[bruf]{0,2}(?P<quote>[\"'`])(?P<quoted>(?:\\.|(?!(?P=quote))[^\s\\])++)(?P=quote)|(?P<bare>[^\s\"'`]++))",
    re.I,
)
_FLAG = re.compile(r"(?:^|\s)--?[\w-]*\Z")
OTHERS = re.compile(r"sha\d*|md5|commit|checksum|digest|uuid|guid|hash|revision|example|sample|placeholder|version|card|account|phone", re.I)
EXAMPLES = re.compile(r"test|example|sample|fixture|mock|doc|readme|lock|\.min\.", re.I)

FEATURES = "size digits uppers lowers hexes symbols changes entropy repeats covered named other assigned quoted example_path".split()


@lru_cache(maxsize=1)
def dictionary(vocabulary: str) -> LongestMatch:
    """An automaton of the vocabulary's words of four letters or more, and of single letters as the rest."""
    words = {t.removesuffix("</w>") for t in json.loads(vocabulary)["model"]["vocab"]}
    return LongestMatch({w for w in words if len(w) >= 4 and w.isascii() and w.isalpha()} | set(string.ascii_lowercase) | {"</w>"})


def features(value: str, before: str, after: str, path: str, words: LongestMatch) -> list[float]:
    """What the forest sees of a candidate."""
    n = len(value)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in value]
    letters = "".join(c for c in value.lower() if c in string.ascii_lowercase)
    counts = Counter(value)
    pieces = words.count(letters) - 1 if letters else 0
    return [
        float(n),
        kinds.count("d") / n,
        kinds.count("u") / n,
        kinds.count("l") / n,
        sum(c in string.hexdigits for c in value) / n,
        kinds.count("s") / n,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        max(counts.values()) / n,
        1 - pieces / len(letters) if letters else 0.0,
        float(bool(NAMES.search(before))),
        float(bool(OTHERS.search(before)) or bool(OTHERS.search(after[:16]))),
        float(bool(re.search(r"[:=]\s*[\"'`]?$", before))),
        float(before[-1:] in "\"'`" and before != "" and after[:1] in "\"'`" and after != ""),
        float(bool(EXAMPLES.search(path))),
    ]


def _assigned(text: str) -> Iterator[tuple[int, int, str]]:
    """(place of the name, place of the value, value) of every value next to the name of a credential.

    A quoted value ends at its quote; a bare one at white space, before the next name of a list or query, and without closing marks.
    """
    for found in _ASSIGNED.finditer(text):
        if found["flag"] is not None and not _FLAG.search(text, max(0, found.start() - NEAR), found.start()):
            continue
        kind = "quoted" if found["quote"] else "bare"
        value = found[kind]
        if kind == "bare":
            value = re.split("[&#]", value, maxsplit=1)[0] if found["url"] else _NEXT.split(value, maxsplit=1)[0]
            while value and (value[-1] in ",;." or value[-1] in _OPENED and _OPENED[value[-1]] not in value):
                value = value[:-1]
        if len(value) >= SHORT and not _PLAIN.fullmatch(value):
            yield found.start(), found.start(kind), value


def candidates(text: str) -> Iterator[tuple[int, str]]:
    """(place, string) of every value next to the name of a credential and of every other long run, but for plain words."""
    named = list(_assigned(text))
    at = 0
    for run in RUN.finditer(text):
        while at < len(named) and named[at][1] + len(named[at][2]) <= run.start():
            yield named[at][1:]
            at += 1
        taken = at < len(named) and named[at][0] < run.end()
        joined = text[run.end() : run.end() + 1]
        if len(run[0]) >= LONG and not taken and not (joined.isalnum() or joined == "_") and not _PLAIN.fullmatch(run[0]):
            yield run.start(), run[0]
    for _, start, value in named[at:]:
        yield start, value


def look(text: str, path: str, words: LongestMatch) -> Iterator[tuple[int, str, list[float]]]:
    """(place, string, features) of every candidate of a text."""
    for start, value in candidates(text):
        end = start + len(value)
        yield start, value, features(value, text[max(0, start - NEAR) : start], text[end : end + NEAR], path, words)


def find(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(doc_id, start, length, sha256, features) of every candidate; ``start`` counts code points from 0.

    A null text has no candidates and a null path is empty. Repeated rows give repeated findings; further columns do not matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = dictionary(shared.value)
        for batch in batches:
            rows, starts, values, seen = [], [], [], []
            for row, (text, path) in enumerate(zip(batch.column(1), batch.column(2))):
                text, path = text.as_py() or "", path.as_py() or ""
                for start, value, shown in look(text, path, words):
                    rows.append(row)
                    starts.append(start)
                    values.append(value)
                    seen.append(shown)
            table = np.array(seen, np.float64).reshape(-1, len(FEATURES))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(values, pa.string()), *[pa.array(c) for c in table.T.copy()]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "value", *FEATURES])

    kind = docs.schema[doc_id].dataType.simpleString()
    chosen = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), docs[path].cast("string").alias("path"))
    found = chosen.mapInArrow(scan, f"doc_id {kind}, start long, value string, " + ", ".join(f"{f} double" for f in FEATURES))
    return found.select("doc_id", "start", F.length("value").cast("long").alias("length"), F.sha2("value", 256).alias("sha256"), *FEATURES)


def labelled_findings(count: int = 4000, seed: int = 11) -> list[tuple[str, str, str, str, int]]:
    """(string, text before, text after, path, 1 real / 0 not): findings as a reviewer would label them, half of them real."""
    r = random.Random(seed)
    alnum, hexes = string.ascii_letters + string.digits, "0123456789abcdef"
    pick = lambda letters, n: "".join(r.choices(letters, k=n))
    word = lambda: pick("aeiou", 1).join(pick("bcdlmnrst", 1) for _ in range(r.randint(2, 4)))
    password = lambda: pick(string.ascii_uppercase, 1) + pick(alnum + "!@$%^*?", r.randint(5, 11)) + pick("!@%^*?", 1) + pick(string.digits, 1)
    prose = lambda: " ".join(word() for _ in range(r.randint(2, 6))) + " "
    found = []
    for _ in range(count // 2):
        value = r.choice([lambda: pick(hexes, r.choice([32, 40, 40, 64])), lambda: pick(alnum, r.randint(20, 64)), lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16), lambda: pick(alnum + "+/", r.randint(27, 60)) + "=", lambda: r.choice(["ghp_", "sk_live_", "xoxb-"]) + pick(alnum, 30), lambda: ".".join(["eyJ" + pick(alnum, r.randint(15, 40)), "eyJ" + pick(alnum + "_-", r.randint(20, 120)), pick(alnum, 43)]), password, password])()
        name = r.choice(["token", "secret", "api_key", "password", "auth", "access_key", "private key", "client_secret"])
        quote = r.choice(['"', "'", ""])
        before, after = name + r.choice([" = ", "=", ": ", ":"]) + quote, quote
        if r.random() < 0.4:
            name = name.replace(" ", "_")
            before, after = r.choice([(f"{name.upper()}=", ""), (f"--{name.replace('_', '-')}=", ""), (f"--{name.replace('_', '-')} ", ""), (f"https://{word()}.example/{word()}?{name}=", f"&{word()}=1"), ("Authorization: Bearer ", "")])
        if not re.fullmatch("[A-Za-z0-9_.-]+", value) and "://" in before:
            before, after = f"{name}=", ""
        found.append((value, prose() + before, after + " " + prose(), r.choice(["src", "app/config.py", "src3", ".env", "deploy.yml"]), 1))
    for _ in range(count - count // 2):
        value = r.choice([lambda: pick(string.digits, r.randint(16, 19)), lambda: "-".join(pick(hexes, n) for n in (8, 4, 4, 4, 12)), lambda: pick(hexes, 40), lambda: "_".join(word() for _ in range(r.randint(4, 6))), lambda: "/".join(word() + word() for _ in range(4)), lambda: "x" * r.randint(16, 40), lambda: "-" * r.randint(16, 60), lambda: "".join(word().capitalize() for _ in range(4)), lambda: word() * 3 + str(r.randint(1, 999)), lambda: "=" * 20, lambda: pick(hexes, 64)])()
        value = value if len(value) >= 16 else value + "0" * (16 - len(value))
        if r.random() < 0.3:
            name, quote = r.choice(["token", "secret", "api_key", "password", "auth", "TOKEN", "--access-key"]), r.choice(['"', "'", ""])
            value = r.choice([lambda: f"${{{word().upper()}_TOKEN}}", lambda: f"get_{word()}()", lambda: f"{word()}.{word()}_{word()}", lambda: f"<your_{word()}>", lambda: f"your-{word()}-here", lambda: "x" * r.randint(4, 20), lambda: "*" * r.randint(4, 12), lambda: f"https://{word()}.example/{word()}", lambda: f"{word()}_{word()}", lambda: f"os.environ[{word()}]", lambda: f"{word()}({word()}.{word()})", lambda: f"Optional[{word()}]", lambda: str(r.randint(1000, 99999)), lambda: f"/{word()}/{word()}.{word()}"])()
            found.append((value, prose() + name + r.choice([" = ", "=", ": ", ":"]) + quote, quote + " " + prose(), r.choice(["src", "src7", "app.py", "app/config.py", ".env"]), 0))
            continue
        if r.random() < 0.15:
            value = r.choice([lambda: ".".join(word() + r.choice(["", "_" + word(), "2"]) for _ in range(r.randint(3, 6))), lambda: f"www.{word()}{word()}-{word()}.{word()}/{word()}/{word()}.html", lambda: f"{word()}{r.randint(1, 99)}/{word()}_{word()}.{word()}.py", lambda: "_".join(word().upper() for _ in range(4)) + "=1"])()
            found.append((value, prose() + r.choice(["", "see ", "at "]), " " + prose(), r.choice(["src", "src7", "docs/readme.md", "app.py"]), 0))
            continue
        if re.fullmatch(r"[0-9a-f]{32,}", value):
            before = prose() + r.choice(["commit ", "sha256: ", "checksum ", "md5 ", "digest=", "revision "])
        else:
            before = prose() + r.choice(["", "", "id: ", "see ", "card ", 'token = "' if set(value) <= set("x0-=") else ""])
        found.append((value, before, " " + prose(), r.choice(["src", "src7", "docs/readme.md", "tests/test_a.py", "package.lock", "app.py"]), 0))
    return found


def train(spark: SparkSession, vocabulary: str, labelled: list[tuple[str, str, str, str, int]], trees: int = 40, depth: int = 8, seed: int = 5) -> RandomForestClassificationModel:
    """A forest from labelled findings; their number is a bound that the caller sets.

    It learns from the candidates of the labelled texts, as a scan finds them: the finding has its label, any other is not real. The
    rows lie in one partition, from which the trees draw, so the forest is the same on every cluster.
    """
    words = dictionary(vocabulary)
    rows = [(*shown, float(y == 1 and (start, value) == (len(b), v))) for v, b, a, p, y in labelled for start, value, shown in look(b + v + a, p, words)]
    if not rows:
        raise ValueError("no labelled findings with a candidate")
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(spark.createDataFrame(rows, [*FEATURES, "label"]).coalesce(1))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label").fit(data.select("features", "label"))


def judge(found: DataFrame, model: RandomForestClassificationModel) -> DataFrame:
    """The candidates with ``score``, the forest's probability that they are real."""
    seen = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
    scored = model.transform(seen).withColumn("score", F.round(vector_to_array("probability")[1], 6))
    return scored.select("doc_id", "start", "length", "sha256", "score")


def scan(docs: DataFrame, vocabulary: str, labelled: list[tuple[str, str, str, str, int]] | None = None, doc_id: str = "doc_id", text: str = "text", path: str = "source", least: float = 0.5) -> DataFrame:
    """(doc_id, start, length, sha256, score) of the findings that are taken for real."""
    model = train(docs.sparkSession, vocabulary, labelled_findings() if labelled is None else labelled)
    return judge(find(docs, vocabulary, doc_id, text, path), model).where(F.col("score") >= least)
