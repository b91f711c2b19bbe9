import base64
import collections
import hashlib
import zlib

from pyspark.sql import functions as F

from catchlake.llm import queries, sharding, warc
from catchlake.session import shared_path


def test_shards_match_the_mixture(spark):
    rows = queries.QUERIES["op2_sharding"](spark, "/root/testdata/sf0.01").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    shards = collections.defaultdict(list)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "rows", None)
        shards[r["shard"]].append(r["slot"])
    assert sorted(shards) == list(range(24)) and all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    of = collections.Counter(r["source"] for r in rows)
    by = collections.Counter((r["source"], r["shard"]) for r in rows)
    assert all(abs(by[s, i] - n / 24) <= 2 for s, n in of.items() for i in range(24))


def test_sharding_cases(spark, docs_of, odd_texts):
    docs = docs_of(odd_texts)
    rows = sharding.shard_documents(docs.unionByName(docs), 4).collect()
    assert len(rows) == 30 and sorted(collections.Counter(r["shard"] for r in rows).values()) == [7, 7, 8, 8]
    assert {r["size"] for r in rows if r["doc_id"] in (0, 1)} == {8} and {r["text_crc32"] for r in rows if r["doc_id"] == 0} == {0}
    assert sharding.shard_documents(docs.limit(0), 4).count() == 0
    assert sharding.shard_documents(docs.limit(2), 24).count() == 2
    again = sharding.shard_documents(docs.unionByName(docs).repartition(5), 4).collect()
    place = lambda found: sorted((r["doc_id"], r["shard"], r["slot"]) for r in found)
    assert place(rows) == place(again)


def test_single_row_sources_are_spread(spark):
    rows = spark.range(400).selectExpr("id AS doc_id", "'t' AS text", "concat('s', id) AS source")
    counts = sharding.shard_documents(rows, 4).groupBy("shard").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).collect()
    assert all(r["low"] < 100 and r["high"] > 300 for r in counts)


def expected(pages):
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[digest(h)] = min(i, first.get(digest(h), i))
    out = []
    for i, _, h in pages:
        low = first.get(digest(h))
        again = i is not None and low < i
        out.append((i, len((h or "").encode()), digest(h), "revisit" if again else "response", low if again else None))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=str)


def test_round_trip(spark):
    body = "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nx</p>"
    pages = [(5, "http://a/", body), (3, "http://b/\r\nX: y", body), (9, None, body), (4, "", None), (6, "http://c", ""), (7, "http://d", "\r\n\r\n"),
             (8, "u", "x" * 200_000), (None, "http://e", body), (1, "http://f", "one"), (1, "http://g", "two")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' AS record_type", "'x' AS _first", "'x' AS _digest")
    assert order(warc.archive_round_trip(df).collect()) == order(expected(pages))
    assert warc.archive_round_trip(df.limit(0)).count() == 0
    assert order(warc.archive_round_trip(df.unionByName(df)).collect()) == order(expected(pages + pages))


def test_every_row_is_a_capture(spark):
    pages = [(1, "http://a", "x")] * 4 + [(2, "http://a", "x")] * 2500 + [(None, None, "x")] * 3 + [(None, "", "x"), (None, "", "y"), (None, "", "y"), (3, None, None), (3, "", ""), (3, "", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    assert order(warc.archive_round_trip(df).collect()) == order(expected(pages))
    path = shared_path(spark, "warc")
    warc.write_archives(df, path)
    records = warc.read_records(spark, path)
    assert records.count() == 3 * len(pages) == records.select("record_id").distinct().count()
    assert warc.assemble_captures(records).count() == len(pages)


def test_files_are_bounded_by_bytes(spark):
    pages = [(i, "http://a", f"{i} " + "x" * n) for i, n in enumerate([10] * 12 + [400] * 6 + [3000] * 3)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    path = shared_path(spark, "warc")
    warc.write_archives(df, path, sizes=((100, 5), (1000, 2), (None, 1)))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").collect()
    assert collections.Counter(f["path"].split("/")[-2] for f in files) == {"upto-100": 3, "upto-1000": 3, "upto-any": 3}
    assert warc.read_records(spark, path).filter("record_type = 'response'").count() == len(pages)


def test_captures_are_nested_rows(spark):
    path = shared_path(spark, "warc")
    pages = spark.createDataFrame([(i, f"http://h{i}/", f"body {i % 3}") for i in range(20)], "page_id long, url string, html string")
    warc.write_archives(pages, path, sizes=((None, 3),))
    names = [r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").collect()]
    assert len(names) >= 7
    records = warc.read_records(spark, path)
    assert {r["record_type"]: r["count"] for r in records.groupBy("record_type").count().collect()} == {
        "request": 20, "response": 3, "revisit": 17, "metadata": 20}
    row = warc.assemble_captures(records).filter("metadata.fields['page-id'] = '2'").first()
    assert bytes(row["response"]["payload"]) == b"body 2" and row["request"]["target_uri"] == "http://h2/" == row["response"]["target_uri"]
    lone = warc.assemble_captures(records.filter("record_type = 'request'"))
    assert lone.count() == 20 and lone.filter("response IS NOT NULL").count() == 0


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    pages = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()]
    assert order(queries.QUERIES["op9_warc"](spark, folder).collect()) == order(expected(pages))
