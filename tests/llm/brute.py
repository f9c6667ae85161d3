"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(docs, size):
    """Distinct word runs of each text, A-Z in lower case."""
    out = []
    for _, text in docs:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append({tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set())
    return out


def groups(docs, size, percent):
    """(sets, root of each row) by comparing all pairs."""
    sets = sets_of(docs, size)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and 100 * both >= percent * (len(x) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sets, [find(i) for i in range(len(docs))]


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words, seen, lines = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    counts = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {p for k in range(len(words) - 7) if counts[tuple(words[k : k + 8])] > 1 for p in range(k, k + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered)


def later_lines(docs):
    """Numbers of the lines of each row that match an earlier line, however few words they have; ``docs`` in the order of their ids."""
    seen, out = [], []
    for _, text in docs:
        gone = []
        for number, line in enumerate((text or "").split("\n")):
            words = re.findall("[^\x09-\x0d\x20]+", line.lower())
            if words:
                own = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
                if any(100 * len(own & s) >= 80 * len(own | s) for s in seen):
                    gone.append(number)
                seen.append(own)
        out.append(gone)
    return out


def cheapest_edits(initials, faults):
    """(cost, audit) by keeping the best edits of every state turn by turn."""
    far = (10**9, "")

    def with_inserts(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                after = "ua"["u" == state]
                best[after] = min(best.get(after, far), (cost + 5, audit + "I"))
        return best

    best = with_inserts({"": (0, "")})
    for initial, fault in zip(initials, faults):
        after = {}
        for state, (cost, audit) in best.items():
            moves = [("D", 2, state)]
            if fault not in "bd":
                open_end, following = 5 * (fault == "t"), "ua"["u" == state]
                moves.append(("R", 1 + open_end, following))
                if initial == following or (initial, state) == ("s", ""):
                    moves.append(("K", open_end, initial))
            for letter, paid, to in moves:
                after[to] = min(after.get(to, far), (cost + paid, audit + letter))
        best = with_inserts(after)
    return min(best.get("", far), best.get("a", far))


def clusters(rows, k=16, rounds=3):
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each usable (id, vector), every distance measured."""
    used = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    drawn = sorted(used, key=lambda r: (hashlib.sha256(f"1:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centers = [v for _, v in drawn[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in used:
            members[nearest(v)[1]].append(v)
        centers = [[sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else c for n, c in enumerate(centers)]
    found = [(i, *nearest(v)) for i, v in used]
    total = Counter()
    for _, distance, n in found:
        total[n] += distance
    return [(i, n, d, total[n], sum(total.values()), hashlib.sha256(",".join(map(str, centers[n])).encode()).hexdigest()) for i, d, n in found]


def leaks(docs, items):
    """(doc_id, item_id) of every item with four fifths of its shingles in a document."""

    def shingles(text):
        words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
        return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    own = [(i, shingles(t)) for i, t in docs]
    return {(d, i) for i, t in items for s in [shingles(t)] for d, x in own if s and 100 * len(s & x) >= 80 * len(s)}


def repeats(docs, size=400):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each row."""
    data = [(t or "").encode() for _, t in docs]
    counts = Counter(b[k : k + size] for b in data for k in range(len(b) - size + 1))
    out = []
    for b in data:
        spans = []
        for k in range(len(b) - size + 1):
            if counts[b[k : k + size]] > 1:
                if spans and k <= spans[-1][1]:
                    spans[-1][1] = k + size
                else:
                    spans.append([k, k + size])
        kept, at = b"", 0
        for s, e in spans:
            kept, at = kept + b[at:s], e
        kept += b[at:]
        out.append((len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


def token_pieces(docs, capacity=4096):
    """{(doc_id, piece): (start, length, crc32)}."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = defaultdict(list)
    for i, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out[(i, k)].append((at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    return {k: sorted(v) for k, v in out.items()}
