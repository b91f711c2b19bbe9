import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import DataFrameWriter

from catchlake.llm import outliers, queries, url_filters, winnowing
from llm_helpers import prose

PYTHON = re.compile("Python|Pandas|Arrow")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contaminated(docs, items):
    windows = collections.defaultdict(set)
    for i, text in items:
        w = words_of(text)
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if n and i is not None else 0):
            windows[tuple(w[a:a + n])].add(i)
    sizes, out = {len(k) for k in windows}, {}
    for i, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in windows:
                    hit.update(range(a, a + n))
                    found |= windows[tuple(w[a:a + n])]
        names = ",".join(sorted(map(str, found)))
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit))
    return out


def test_decontamination_agrees_with_all_windows(spark, docs_of, odd_texts):
    rng = random.Random(4)
    items = [(i, prose(100 + i, rng.randint(10, 60))) for i in range(30)]
    items += [(30, "Tiny item"), (31, "same"), (32, None), (33, " .. "), (None, prose(7, 30)), (34, "la " * 25), (35, items[3][1]), (36, "exactly nine words are in this short item here")]
    texts = list(odd_texts)
    for i in range(60):
        own = items[rng.randrange(30)][1].split()
        a, n = rng.randrange(len(own)), rng.randint(5, 25)
        texts.append(f"{prose(i, rng.randrange(40))} {re.sub('[a-z]', lambda m: m[0].upper(), ' '.join(own[a:a + n]))}, {prose(i + 500, rng.randrange(40))}")
    texts += ["la, " * 60, "x tiny\nITEM y", items[0][1] + " " + items[1][1], "exactly nine words are in this short item here"]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS _w", "'x' AS _hash")
    docs = docs_of(texts)
    result = winnowing.contaminated_words(docs, bench)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in result.collect()}
    want = contaminated(list(enumerate(texts)), items)
    assert got == want and sum(w[4] for w in want.values()) > 20
    kept = winnowing.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, w in want.items() if not w[4]}
    assert winnowing.contaminated_words(docs, bench.limit(0)).filter("n_hit > 0 OR n_items > 0").count() == 0
    assert winnowing.contaminated_words(docs.limit(0), bench).count() == 0
    twice = winnowing.contaminated_words(docs.unionByName(docs), bench).collect()
    assert collections.Counter(r["doc_id"] for r in twice) == dict.fromkeys(want, 2) and {r["doc_id"]: r["n_hit"] for r in twice} == {i: w[1] for i, w in want.items()}


def test_rows_are_dropped_by_id_and_text(spark):
    dirty, clean = prose(101, 30), prose(900, 30)
    bench = spark.createDataFrame([(1, dirty)], "item_id long, text string")
    rows = [(None, dirty), (None, clean), (None, None), (1, dirty), (1, clean), (2, clean), (3, f"{clean} {dirty}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = winnowing.drop_contaminated(docs, bench)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(None, clean), (None, None), (1, clean), (2, clean)], key=str)


def test_every_shared_span_has_a_common_fingerprint(spark):
    rng = random.Random(9)
    for _ in range(5):
        shared = [rng.choice("abc") for _ in range(10)]
        a, b = ([rng.choice("abc") for _ in range(rng.randrange(20))] + shared + [rng.choice("abc") for _ in range(20)] for _ in range(2))
        df = spark.createDataFrame([(0, a), (1, b)], "id int, _w array<string>")
        marks = winnowing.with_fingerprints(df, {winnowing.WINDOW: winnowing.Grams(5, 6)}, False).collect()
        places = [{r["_place"] for r in marks if r["id"] == i} for i in (0, 1)]
        starts = ["".join(a).index("".join(shared)), "".join(b).index("".join(shared))]
        inside = [{p - s for p in own if s <= p <= s + 5} for own, s in zip(places, starts, strict=True)]
        assert inside[0] & inside[1]


def counts(text):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", text or "") if x]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    triples = list(zip(w, w[1:], w[2:], strict=False))
    seen, covered = collections.Counter(triples), set()
    for i, x in enumerate(triples):
        if seen[x] > 1:
            covered |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_counts_and_verdicts(spark, docs_of, odd_texts):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(3000)]
    fresh = lambda n: " ".join(rng.choice(words) + "aa" for _ in range(n))
    texts = odd_texts + [fresh(rng.randint(60, 600)) for _ in range(400)] + [" ".join(f"{w}%%%" for w in fresh(200).split()) for _ in range(20)]
    docs = docs_of(texts, clash=False).selectExpr("doc_id", "text", "lang", "source", "'x' AS _g", "'x' AS kept", "'x' AS n_words", "'x' AS _t")
    rows = {r["doc_id"]: r for r in outliers.rule_verdicts(docs).collect()}
    for i, text in enumerate(texts):
        r, want = rows[i], counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    assert all(rows[i]["kept"] for i in range(len(odd_texts), len(odd_texts) + 400))
    assert not any(rows[i]["kept"] for i in range(len(odd_texts) + 400, len(texts)))
    few = outliers.rule_verdicts(docs.filter("doc_id < 40")).collect()
    assert all(r["kept"] != r["base_failed"] for r in few)  # too few rows for an estimate
    assert outliers.rule_verdicts(docs.limit(0)).count() == 0


def test_each_statistic_rejects_alone(spark, docs_of):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    fresh = lambda n: " ".join(rng.choice(words) + "aa" for _ in range(n))
    long_words = lambda n: " ".join(rng.choice(words) + "a" * 12 for _ in range(n))
    lines = fresh(20).split()
    odd = [fresh(30_000),  # length
           long_words(200),  # length of words
           fresh(200) + " %" * 12,  # mild: six symbols in 100 words
           fresh(200) + "\n" + "\n".join(w for w in lines for _ in range(2)),  # repeated lines, no repeated triple
           fresh(200) + " " + " ".join([fresh(20)] * 4)]  # under a third is repeated
    mild = [fresh(200) + " %", fresh(200) + "\nx\nx", fresh(200) + " aaa bbb ccc " + fresh(3) + " aaa bbb ccc"]
    texts = [fresh(rng.randint(100, 400)) for _ in range(500)] + odd + mild + odd + mild
    langs = ["en"] * 508 + ["xx"] * 8  # too few for an estimate of their own, so that of all rows judges them
    docs = docs_of(texts, langs, clash=False).select("doc_id", "text", "lang", outliers.F.lit("one").alias("source"))
    rows = {r["doc_id"]: r for r in outliers.rule_verdicts(docs).collect()}
    assert not any(r["base_failed"] for r in rows.values())
    assert [rows[i]["kept"] for i in range(500, 516)] == ([False] * 5 + [True] * 3) * 2 and sum(r["kept"] for r in rows.values()) >= 500


def test_no_variance_and_equal_statistics_give_finite_distances(spark):
    rows = [("a", 1500, 1280, 0, i % 7 * 100, i % 7 * 100) for i in range(200)]
    df = spark.createDataFrame(rows, "_g string, x0 long, x1 long, x2 long, x3 long, x4 long")
    found = outliers.estimates_of(df, outliers.McdSettings())
    far = df.withColumnRenamed("_g", "_g2").crossJoin(found).select(outliers.distance().alias("d")).collect()
    assert all(0 <= r["d"] < 100 for r in far)


def test_centre_withstands_a_fifth_of_odd_rows(spark):
    """Against the plain covariance: with 20 % of far rows it would hide them."""
    rng = random.Random(1)
    rows = [("a", *[round(rng.gauss(10, 1) * 256) for _ in range(5)]) for _ in range(800)] + [
        ("a", *[round(rng.gauss(40, 1) * 256) for _ in range(5)]) for _ in range(200)]
    df = spark.createDataFrame(rows, "_g string, x0 long, x1 long, x2 long, x3 long, x4 long")
    found = outliers.estimates_of(df, outliers.McdSettings()).first()
    assert all(abs(found[f"m{i}"] - 10) < 0.2 for i in range(5))


def test_chi2():
    assert outliers.chi2_cdf(11.0705, 5) == pytest.approx(0.95, abs=1e-4)
    assert 1.3 < outliers.consistency(0.75) < 1.5


def judge(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^?#]*", rest[len(re.match(r"[^/?#]*", rest)[0]):])[0]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda x: (x[0], x[1], x[2], x[3] == "block"), default=None)
    return host, path, best and best[2], best[3] if best else default


@pytest.mark.parametrize("rules", [queries.RULES and [(h, p, v) for h, p, v in queries.RULES], [], [
    ("", "/x", "block"), ("a.b.c", "/", "allow"), ("b.c", "", "block"), ("c", "/dir/sub", "allow"), ("c", "/dir", "block"), ("c", "/dir", "allow"), ("x.b.c", "/", "block")]])
def test_url_rules(spark, rules):
    hosts = ["net", "example.net", "m.EXAMPLE.net", "notexample.net", "example.com", "a.org", "org", "a.b.c", "q.a.b.c", "x.b.c", "b.c", "c", "xc", "a\u0000b.c", "", "net.", ".net"]
    paths = ["", "/", "/en/1", "/en", "/de/", "/fr/x?y=/en/", "/dir/sub/f", "/dirx", "/x#/de/", "?q", "#f", "/EN/"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "nothing", "://net/", "a://b://net/", "http://x\n.net/\n"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, urls[0]), (None, urls[0])], "page_id long, url string").selectExpr("*", "'x' AS host", "'x' AS rule", "'x' AS _key")
    frame = spark.createDataFrame([(h, p, v) for h, p, v in rules] + [(None, "/", "block"), ("net", None, "block"), ("net", "/", None)], "host string, path string, verdict string")
    got = url_filters.judged_pages(pages, frame).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        url = urls[r["page_id"] or 0]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judge(url, rules), url
    assert url_filters.judged_pages(pages.limit(0), frame).count() == 0


@pytest.mark.parametrize("name,python", [("op6_outliers", False), ("op7_url_filters", False), ("op10_decontamination", False), ("op3_byte_bpe", True)])
def test_no_python_on_the_main_path(spark, monkeypatch, name, python):
    """The plans of all frames that the query writes on its way, and of the one that it gives back."""
    plans, write = [], DataFrameWriter.parquet

    def noted(self, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert python or len(plans) >= 2
    assert any(PYTHON.search(p) for p in [*plans, df._jdf.queryExecution().executedPlan().toString()]) == python
