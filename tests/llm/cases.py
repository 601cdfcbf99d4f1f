"""Small tables with every awkward row, and plain-Python versions of the operators."""

from __future__ import annotations

import re
from collections import defaultdict

SPACES = " \t\n\x0b\x0c\r"
LINE = "This line is long enough to be counted as a repeated one"

TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t \x0b"),
    (4, "a"),
    (5, "one two  three"),
    (6, "one two three"),
    (7, "One two three"),
    (8, "x" * 70_000),
    (9, "x" * 70_000),
    (10, "word " * 30_000 + "end"),
    (11, "🙂🙃 naïve▁café tail é �"),
    (12, f"{LINE}\nunique line of twelve\n{LINE.upper()}  "),
    (13, f"  {LINE}\t\nother"),
    (14, f"{LINE}"),
    (15, f"start\n{LINE}\n\nend"),
    (16, f"{LINE}\n{LINE}"),
    (16, f"{LINE}\n{LINE}"),
    (17, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 4),
    (18, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 4 + "!"),
    (None, "row without an id, said once"),
    (None, "one two three"),
    (20, "mail bob@example.org or +1 (555) 010-9999, 10.0.0.1 4111 1111 1111 1111"),
    (21, "mail ann@x.io.a@b.c 1.2.3.4.5.6.7.8 999.1.1.1 +12 3 +1234567890- 1234-5678"),
]
SOURCES = ["s1", "s0", None, "é"]

#: Names that the operators use inside or give back.
CLASHING = [
    "size", "hash", "node", "ids", "id", "mark", "kept", "score", "label", "target", "positions",
    "n_lines", "kept_text", "passes", "threshold", "features", "text_sha256", "bucket", "sanitised",
]


def documents(spark, texts=None, extra=False):
    rows = [
        (i, t, "en", SOURCES[k % len(SOURCES)], len(t or ""), *([f"c{k}"] * len(CLASHING) * extra))
        for k, (i, t) in enumerate(TEXTS if texts is None else texts)
    ]
    names = ", ".join(f"{c} string" for c in CLASHING) if extra else ""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, f"{schema}, {names}" if names else schema)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def shingles(text, n):
    w = words(lower(text))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def near_components(texts, n, percent):
    """Component per position: the smallest id it reaches."""
    sets = [shingles(t, n) for _, t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(texts)):
        groups[root(i)].append(texts[i][0])
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return [least[root(i)] for i in range(len(texts))]


def kept_lines(texts, least=5, chars=40):
    """(n_lines, n_dropped, kept text) per position."""
    key = lambda line: lower(line.strip(SPACES))
    number = lambda i: -(2**63) if i is None else i
    holders = defaultdict(list)
    for i, t in texts:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= chars:
                holders[k].append(number(i))
    top = {k: max(v) for k, v in holders.items() if len(v) >= least}
    result = []
    for i, t in texts:
        lines = (t or "").split("\n")
        stay = [x for x in lines if top.get(key(x), number(i)) == number(i)]
        result.append((len(lines), len(lines) - len(stay), "\n".join(stay)))
    return result
