"""The whole chain on odd, empty and clashing documents."""

import public_tokenizers
import tiktoken
from shared import clashing_documents, no_documents, odd_documents, odd_rows, rows_of
from tiktoken.load import load_tiktoken_bpe

import corpus_pipeline

LABELS = "doc_id long, toxic int"


def result(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, None), (None, 1)], LABELS).write.parquet(f"{folder}/labels.parquet")
    return corpus_pipeline.run(spark, str(folder))


def test_odd_and_clashing_documents(spark, tmp_path):
    found = result(spark, tmp_path / "odd", odd_documents(spark)).collect()
    ranks = load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {}
    for doc_id, text, *_ in odd_rows():
        texts.setdefault(doc_id, []).append(text or "")
    # No secrets and no labels: every row of the mix is a text of its own id.
    assert all(library.decode(list(r.ids)) in texts[r.doc_id] for r in found)
    # One of two equal rows and of two equal texts stays.
    taken = {r.doc_id for r in found}
    assert {6, 7} <= taken and 9 not in taken
    clashing = result(spark, tmp_path / "clashing", clashing_documents(spark))
    assert rows_of(clashing.select("doc_id", "ids")) == sorted(((r.doc_id, r.ids) for r in found), key=repr)


def test_no_documents(spark, tmp_path):
    assert result(spark, tmp_path, no_documents(spark)).collect() == []
