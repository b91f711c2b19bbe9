import corpus_pipeline
import public_tokenizers as P
import tiktoken

from catchlake.llm import byte_bpe
from catchlake.llm.common import table
from llm_helpers import sha
from test_minhash import plain
from test_native import contaminated

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = table(spark, FOLDER, "documents")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    toxic = {r["doc_id"] for r in table(spark, FOLDER, "labels").filter("toxic = 1").collect()}
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, FOLDER), name)
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == columns and after.items() <= before.items()
        seen.append((name, before, after))
        before = after
    (_, _, mild), _, (_, many, single), (_, dirty, clean) = seen
    assert len(toxic & set(mild)) <= 0.5 * len(toxic)  # a few tens of labels to learn from
    assert set(single) == {i for i, (_, top) in plain(many, 5, 80).items() if i == top}
    assert set(clean) == {i for i, found in contaminated(dirty.items(), items).items() if not found[4]}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r["doc_id"] for r in rows} == set(clean)
    assert all(r["n_tokens"] == len(library.encode_ordinary(clean[r["doc_id"]])) and r["decoded_sha256"] == sha(clean[r["doc_id"]].encode()) for r in rows)


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids"] and rows.count() > 50


def test_stages_take_odd_documents(spark, docs_of, odd_texts):
    """Nulls, empty and very long texts, repeated rows and columns with the operators' names go through every stage."""
    docs = docs_of([*odd_texts, *odd_texts[-2:]])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialize(stage(spark, docs, FOLDER), name)
        assert after.columns == docs.columns
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()
