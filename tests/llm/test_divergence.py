import collections
import random
import re

import numpy as np
import pytest
from llm_helpers import prose

from catchlake.llm import divergence


def brute(docs, s=divergence.AuditSettings()):
    """The contract by plain counting; rows of (lang, source, text)."""
    docs = [tuple(x or "" for x in d) for d in docs]
    words = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        n_docs = collections.Counter(t for d in mine for t in set(words(d[2])))
        kept = sorted(t for t, n in n_docs.items() if n >= s.least_documents)
        count = collections.defaultdict(collections.Counter)
        for _, source, text in mine:
            count[source].update(t for t in words(text) if n_docs[t] >= s.least_documents)
        whole = sum(count.values(), collections.Counter())
        share = lambda c: {t: 1 + 10 ** 9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        shares, q = {source: share(c) for source, c in count.items()}, share(whole)
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for source, p in shares.items():
            pairs = [(-sum(gap(p[t], other[t]) for t in kept), name.encode(), name) for name, other in shares.items() if name != source]
            terms = [(-gap(p[t], q[t]), t.encode(), t) for t in kept if count[source][t] > 0 and p[t] > q[t]]
            out += [(lang, source, "pair", item, -v, i + 1) for i, (v, _, item) in enumerate(sorted(pairs))]
            out += [(lang, source, "term", item, -v, i + 1) for i, (v, _, item) in enumerate(sorted(terms)[:s.top])]
    return sorted(out)


def got(df, s=divergence.AuditSettings()):
    return sorted(map(tuple, divergence.divergence_audit(df, s).collect()))


def corpus(seed):
    rng = random.Random(seed)
    rows = [(rng.choice(("en", "de", None, "")), rng.choice(("a", "b", "é", "c", None, "hot", "hot", "hot")), prose(rng.randrange(6), rng.choice((0, 3, 40, 200)))) for _ in range(150)]
    return rows + [("xx", "a", "only words of few documents"), ("xx", "b", None), ("yy", "alone", "x " * 20), ("en", "void", ""), ("de", "void", None)]


@pytest.mark.parametrize("settings", [{}, {"block_terms": 7, "block_columns": 5, "table": 40}, {"block_cells": 20, "least_documents": 2, "top": 3}])
def test_against_plain_counts(spark, settings):
    s = divergence.AuditSettings(**settings)
    docs = corpus(4)
    df = spark.createDataFrame(docs, "lang string, source string, text string").selectExpr("*", "'x' AS term", "1 AS n", "2 AS value", "3 AS block", "'y' AS item").repartition(3)
    rows = got(df, s)
    assert rows == brute(docs, s) and len(rows) > 100
    assert got(df.unionByName(df), s) == brute(docs + docs, s)
    assert got(df.limit(0), s) == []


def test_odd_documents(spark, docs_of, odd_texts):
    df = docs_of(odd_texts * 11)
    docs = [tuple(r) for r in df.select("lang", "source", "text").collect()]
    assert got(df) == brute(docs)


def test_joint_tables_by_blocks_of_columns():
    rng = np.random.default_rng(1)
    levels = rng.integers(1, 2_000, (300, 6)).astype(np.int64) * 500_000
    levels[:, 5] = 10 ** 9 + 1
    expected = [[int(sum((int(x) - int(y)) ** 2 // (int(x) + int(y)) for x, y in zip(levels[:, a], levels[:, b]))) if a < b else 0 for b in range(6)] for a in range(6)]
    for columns in (1, 64, 512, 10_000):
        assert divergence.priced_products(levels, columns).tolist() == expected


def test_shares_of_large_counts_are_exact(spark):
    n, total, terms = 9 * 10 ** 17, 9 * 10 ** 18, 10 ** 9
    from pyspark.sql import functions as F
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first()
    assert row["p"] == 1 + 10 ** 9 * (n + 2) // (total + 2 * terms)
