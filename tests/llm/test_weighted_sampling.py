import collections
import hashlib
import random

import numpy as np
from llm_helpers import prose

from catchlake.llm import queries, weighted_sampling
from catchlake.llm.weighted_sampling import Sampler, SamplingSettings, fingerprints, likeness, term_weights


def jaccard(a, b):
    x, y = term_weights(a), term_weights(b)
    keys = set(x) | set(y)
    return sum(min(x[k], y[k]) for k in keys) / sum(max(x[k], y[k]) for k in keys) if keys else 1.0


def expected(docs):
    """Each row with its next one by a plain sort; digests and likenesses of the texts."""
    print_ = Sampler(SamplingSettings())
    out = []
    for i, (id_, text) in enumerate(docs):
        text, after = text or "", docs[(i + 1) % len(docs)][1] or ""
        n = len(text) // 4
        changed = text[:len(text) - n] + after[:n]
        out.append((id_, len(text), hashlib.sha256(changed.encode()).hexdigest(), print_(text), print_(changed), likeness(print_(text), print_(changed)),
                    likeness(print_(text), print_(after))))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, fingerprints(df).collect()), key=repr)


def test_rows_and_their_next_ones(spark, docs_of, odd_texts):
    texts = odd_texts + [prose(i, 50 + i) for i in range(40)]
    df = docs_of(texts).selectExpr("*", "'x' AS fingerprint", "'x' AS _range", "1 AS hash").repartition(5)
    assert got(df) == expected(list(enumerate(texts)))
    assert got(df.limit(0)) == []
    assert got(df.filter("doc_id = 13")) == expected([(13, texts[13])])


def test_repeated_rows_and_rows_without_an_id(spark):
    docs = [(None, "no id here")] + [(7, "same text"), (7, "same text")] * 30 + [(8, None), (9, "a b c d e f g h")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = got(df)
    assert len(rows) == len(docs)
    assert collections.Counter(r[0] for r in rows) == collections.Counter(d[0] for d in docs)
    assert sum(r[0] == 7 and r[6] == 1.0 for r in rows) == 59  # the last of the repeats is followed by the empty text
    assert [r for r in rows if r[0] is None][0][2] == hashlib.sha256(b"no id heresa"[:8] + b"sa").hexdigest()


def test_likeness_is_the_generalised_jaccard_similarity():
    """Means over many pairs of texts with all kinds of weights; the spread is that of 96 draws."""
    rng, print_ = random.Random(5), Sampler(SamplingSettings())
    errors = []
    for _ in range(300):
        words = [f"w{rng.randrange(10_000)}" for _ in range(rng.randint(3, 60))]
        weigh = lambda: " ".join(w for w in words for _ in range(rng.choice((0, 1, 1, 2, 5, 20))))
        a, b = weigh(), weigh()
        if a and b:
            j = jaccard(a, b)
            errors.append((likeness(print_(a), print_(b)) - j, j * (1 - j) / 96))
    errors = np.array(errors)
    assert abs(errors[:, 0].mean()) < 4 * np.sqrt(errors[:, 1].sum()) / len(errors)
    assert 0.8 < (errors[:, 0] ** 2).sum() / errors[:, 1].sum() < 1.25


def test_a_full_table_and_many_blocks_change_nothing():
    small = SamplingSettings(table=1)
    big, tiny = Sampler(SamplingSettings()), Sampler(small)
    texts = [prose(i, 200) for i in range(10)] + [" ".join(f"t{i}" for i in range(20_000)), "=" * 3000, "x " * 5000]
    assert [big(t) for t in texts] == [tiny(t) for t in texts] == [big(t) for t in texts]
    assert big("A b\tC") == big("c  a b") and big("Ä") != big("ä") and big(" \n") == ""


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    rows = sorted(map(tuple, queries.QUERIES["op12_weighted_sampling"](spark, folder).collect()), key=repr)
    assert rows == expected(docs)
    near, next_ = np.mean([r[5] for r in rows]), np.mean([r[6] for r in rows])
    assert near > 0.5 > 0.3 > next_


def test_texts_together_and_one_by_one():
    texts = ["", "a a b", *(prose(i, 30) + f" own{i} own{i}" for i in range(40)), " ".join(f"t{i}" for i in range(20_000)), " \n", "a a b"]
    assert Sampler(SamplingSettings()).prints(texts) == [Sampler(SamplingSettings())(t) for t in texts]
    assert Sampler(SamplingSettings(table=1, heavy=1)).prints(texts) == Sampler(SamplingSettings()).prints(texts) and Sampler(SamplingSettings()).prints([]) == []


def test_many_words_are_drawn_once(monkeypatch):
    """The draws of 100,000 words are kept, and a word that many texts hold is drawn anew for none of them."""
    drawn, digest = [], weighted_sampling.xxh64_intdigest
    monkeypatch.setattr(weighted_sampling, "xxh64_intdigest", lambda t, seed: drawn.append(t) or digest(t, seed))
    print_ = Sampler(SamplingSettings())
    texts = [" ".join(["often", *(f"w{i}" for i in range(at, at + 2000))]) for at in range(0, 100_000, 2000)]
    first = [print_(t) for t in texts]
    assert first == [print_(t) for t in texts] and len(drawn) == len(set(drawn)) == 100_001
