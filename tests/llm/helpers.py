"""Plain versions that the operators are held against, and documents that are hard to handle."""

import re
from collections import defaultdict

SPACE = re.compile(r"[\x20\x09-\x0D]+")

ODD = [
    None, "", " \n\t ", "word", "a b c d e f g h i j k l", "a b c d e f g h i j k l", "é́ 日本語　x 🙂🙂\n🙂", "x" * 5000, "the same line here\n" * 30,
    "foo's, 'tis (a'b) x.'s <|endoftext|>. A<|ENDOFTEXT|>b! a.b,c;d", "mail me@x.example.com +1 (555) 010-9999 4111111111111111 10.0.0.256 10.0.0.25", "\x00 a\x1cb   c", "word " * 30_000,
]


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def odd_documents(spark, n=3):
    """The odd texts, some ids repeated or null, other columns null, extra columns whose names clash."""
    rows = [(i % 9 if i % 11 else None, t, "en" if i % 2 else None, ["b", "a", None][i % n], None, i, "x") for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, copies string")
    return df.selectExpr("*", "text as TEXT2", "size as key", "1 as part", "'k' as kept")


def jaccard_components(rows, n, num, den):
    """{id: (size, component)} by comparing all pairs that share a shingle."""
    sets, parent = {}, {}
    for i, t in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
        parent[i] = i

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    has = defaultdict(list)
    for i, s in sets.items():
        both = defaultdict(int)
        for x in s:
            for j in has[x]:
                both[j] += 1
            has[x].append(i)
        for j, k in both.items():
            if den * k >= num * (len(s) + len(sets[j]) - k) and find(i) != find(j):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}
