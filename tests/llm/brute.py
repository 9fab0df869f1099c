"""Plain versions of the operators, and a small table of awkward documents."""

import re
from collections import defaultdict
from hashlib import sha256

BLANKS = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, n_lines string, entities string, body string"


def awkward_rows():
    long = "\n".join(f"line {i % 700} of a very long text, word{i}" for i in range(3000))
    texts = [
        None, "", " ", "\n", "\n\n", "short", "Hello World, this is a line", "hello world, THIS is a line  ", long, long,
        "ÀÉ straße İstanbul Σίσυφος 中文字 😀👨‍👩‍👧 <|endoftext|> x", "a b c", "A b  c", "one two three four five", "x" * 30_000,
        "the same line of text\nthe same line of text\nother", "the same line of text\n\nother\t", "\x00\x01\x1c weird ▁ <s> </s> <0x0A>",
        "Mail jo@example.org or call +1 (887) 555-1668.", "Mail JO@example.org or call 887-555-1668.",
    ]
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 2}" if i % 5 else None, len(t or ""), "x", "y", None) for i, t in enumerate(texts)]
    return rows + [rows[6], rows[6], (None, "a line without an id here", "en", "src1", 5, None, None, None),
                   (3, "another text under a known id, long enough", "en", "src1", 5, None, None, None)]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def kept_lines(rows):
    """(doc_id, text) -> (doc_id, n_lines, n_dropped, kept text)."""
    first = {}
    key = lambda line: line.strip(BLANKS).translate(UPPER)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                first[key(line)] = min(first.get(key(line), i), i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or first.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def similar(rows, size, percent):
    """(doc_id, text) -> (doc_id, n_shingles, component)."""
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate(UPPER))
        grams = {tuple(w[j:j + size]) for j in range(max(1, len(w) - size + 1))} if w else set()
        sets.append((i, frozenset(grams)))
    root = {n: n for n in range(len(sets))}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    inverted, common = defaultdict(list), defaultdict(int)
    for n, (i, s) in enumerate(sets):
        if i is None:
            continue
        for g in s:
            for m in inverted[g]:
                common[m, n] += 1
            inverted[g].append(n)
    for (m, n), c in common.items():
        if 100 * c >= percent * (len(sets[m][1]) + len(sets[n][1]) - c):
            root[find(m)] = find(n)
    least = {}
    for n, (i, _) in enumerate(sets):
        if i is not None:
            least[find(n)] = min(least.get(find(n), i), i)
    return [(i, len(s), least[find(n)]) if i is not None else (None, None, None) for n, (i, s) in enumerate(sets)]


def sha(text):
    return sha256(text.encode()).hexdigest()
