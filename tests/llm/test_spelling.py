import collections
import random
import re
import zlib

import pytest

from catchlake.llm import queries, spelling


def brute(docs, s=spelling.SpellingSettings()):
    """The contract read word by word; near words by their definition over all pairs."""
    counts = collections.Counter()
    for id_, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= s.least_letters and n >= s.least_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    rows = {}
    for w, n in words.items():
        others = [o for o in words if abs(len(o) - len(w)) < 2 and near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] < s.factor * n:
            best = None
        rows[w] = [w, best, w, n, len(others), best and words[best]]
    for row in rows.values():
        while rows[row[2]][1]:
            row[2] = rows[row[2]][1]
    return sorted(map(tuple, rows.values()))


def found(df, s=spelling.SpellingSettings()):
    return sorted(tuple(r) for r in spelling.spelling_variants(df, s).collect())


def variants(seed, words=300):
    """Texts of words with misspellings of them, of several lengths, anagrams and chains among them."""
    rng = random.Random(seed)
    letters = "abcdeinortéüÉ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(words)]
    out = []
    for w in base:
        out += [w] * rng.choice((5, 6, 30, 150, 800))
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w))
            v = rng.choice((w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], "".join(rng.sample(w, len(w)))))
            out += [v] * rng.choice((4, 5, 6, 30))
    rng.shuffle(out)
    return [(i, " ".join(out[at:at + 400])) for i, at in enumerate(range(0, len(out), 400))]


@pytest.mark.parametrize("settings", [{}, {"sample": 200, "cell_words": 20, "leaf_words": 3, "table": 50}, {"cell_words": 1, "leaf_words": 1}])
def test_against_all_pairs(spark, settings):
    docs = variants(3)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = found(df, spelling.SpellingSettings(**settings))
    assert rows == brute(docs) and sum(r[1] is not None for r in rows) > 40


def test_odd_documents(spark, docs_of, odd_texts):
    texts = [*odd_texts, "Straße×x " * 7, "中文abcdefg中 abcdefh " * 9, "abcdefg" * 9000 + " ", ("x" * 70_000 + " ") * 5, ("x" * 69_999 + "y ") * 25]
    df = docs_of(texts).selectExpr("*", "'x' AS word", "1 AS n", "'y' AS form", "2 AS cell")
    docs = list(enumerate(texts))
    assert found(df) == brute(docs)
    assert found(df.unionByName(df)) == brute(docs + docs)
    assert found(df.limit(0)) == []
    unnamed = df.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text")
    assert found(unnamed) == brute([(None, t) for t in texts])


def test_chains_end_at_their_root(spark):
    words = [("aaaaaaaa"[:i] + "b" * (8 - i), 5 * 5 ** i) for i in range(6)]
    docs = [(1, " ".join(w for w, n in words for _ in range(n)))]
    rows = found(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows == brute(docs)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.QUERIES["op11_spelling_variants"](spark, folder).collect())) == brute(docs)
