"""Token counts, backtracking BPE and the id files against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from shared import clashing_documents, no_documents, odd_documents, odd_rows, rows_of
from tokenizers import Tokenizer

from spendlight.llm import backtrack_bpe, huffman, pretokens, token_counts
from spendlight.session import scratch_dir

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def strange_texts(n=400):
    rng = random.Random(7)
    bits = [" ", "the", "ing", "a", "tion", "'s", "'", "'LL", "\n", "\t", "<|endoftext|>", "12", "..", "é", "ß", "가"]
    spans = [(32, 127), (0x80, 0x600), (0x3000, 0xD000), (0x1F600, 0x1F601), (0xA7CE, 0xA7D0), (0x88F, 0x890)]
    odd = lambda: chr(rng.randrange(*rng.choice(spans)))
    made = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(n)]
    made += ["".join(odd() for _ in range(rng.randrange(40))) for _ in range(n)]
    made += ["".join(rng.choice("aab") for _ in range(rng.randrange(300))) for _ in range(n // 4)]
    return made + ["a" * 5000, "ab" * 3000, " " * 3000, "x" * 300 + "\n" * 200]


@pytest.fixture(scope="module")
def strange(spark):
    texts = strange_texts()
    return texts, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).cache()


def library_ids(texts):
    library = Tokenizer.from_file(JSON)
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_counts_are_the_library_s(strange):
    texts, docs = strange
    found = {r.doc_id: r for r in token_counts.token_counts(docs, JSON).collect()}
    for i, ids in enumerate(library_ids(texts)):
        assert (found[i].n_tokens, found[i].over_limit) == (len(ids), len(ids) > 1024)
        assert found[i].n_bytes == len(texts[i].encode())
        assert found[i].n_whole <= found[i].n_pieces


def test_whole_tokens_encode_alone():
    whole = token_counts._proof(pretokens.read_text(JSON))
    assert len(whole) > 40_000
    some = sorted(whole)[::97]
    assert {len(ids) for ids in library_ids(some)} == {1}


def test_merging_of_long_pieces_is_that_of_short_ones():
    ranks = {"ab": 1, "ba": 2, "aba": 0, "abab": 3}
    rank = lambda a, b: ranks.get(a + b, pretokens.NEVER)

    def plain(parts):
        while True:
            ranks = [(rank(a, b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            best = min(ranks, default=(pretokens.NEVER, 0))
            if best[0] == pretokens.NEVER:
                return parts
            i = best[1]
            parts = [*parts[:i], parts[i] + parts[i + 1], *parts[i + 2 :]]

    rng = random.Random(3)
    for n in (5, 64, 65, 200):
        parts = [rng.choice("abc") for _ in range(n)]
        assert pretokens.merged(parts, rank) == plain(parts)


def test_encoding_is_the_library_s(strange):
    texts, docs = strange
    ranks = pretokens.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = backtrack_bpe.encode(docs, RANKS)
    found = {r.doc_id: r.ids for r in encoded.collect()}
    assert [found[i] for i in range(len(texts))] == [library.encode_ordinary(t) for t in texts]
    decoded = {r.doc_id: bytes(r.decoded) for r in backtrack_bpe.decode(encoded, RANKS).collect()}
    assert [decoded[i] for i in range(len(texts))] == [t.encode() for t in texts]


def test_code_lengths():
    def unlimited(counts):
        import heapq

        heap = [(int(c), i, (i,)) for i, c in enumerate(counts) if c]
        lengths, made = [0] * len(counts), len(counts)
        heapq.heapify(heap)
        while len(heap) > 1:
            (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            for s in x + y:
                lengths[s] += 1
            heapq.heappush(heap, (a + b, made, x + y))
            made += 1
        return lengths

    rng = np.random.default_rng(5)
    for n in (2, 3, 17, 300):
        counts = rng.integers(0, 50, n) ** 2 + (np.arange(n) < 2)
        best = (np.array(unlimited(counts)) * counts).sum()
        assert (huffman.code_lengths(counts, 30) * counts).sum() == best
        short = huffman.code_lengths(1 << np.minimum(np.arange(n), 40), 10)
        assert short.max() <= 10 and (2.0 ** -short[short > 0]).sum() <= 1
    assert huffman.code_lengths(np.array([0, 7, 0]), 16).tolist() == [0, 1, 0]
    assert huffman.code_lengths(np.zeros(4, int), 16).tolist() == [0] * 4
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, int), 3)


def test_files_give_back_the_ids(spark, strange, monkeypatch):
    texts, docs = strange
    monkeypatch.setattr("spendlight.llm.slices.SLICE", 100)
    monkeypatch.setattr(huffman, "BLOCK_IDS", 500)
    path = scratch_dir(spark, "ids")
    huffman.write_ids(docs, path, JSON)
    expected, at = library_ids(texts), 0
    found = {r.doc_id: r for r in huffman.read_ids(spark, path).collect()}
    digests = {r.doc_id: r for r in huffman.read_digests(spark, path).collect()}
    for i, ids in enumerate(expected):
        ids = [*ids, 2]
        assert (found[i].start, found[i].n_tokens, found[i].ids) == (at, len(ids), ids)
        assert digests[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    blocks = spark.read.parquet(f"{path}/blocks").withColumn("file", F.input_file_name())
    starts = [r.start for r in blocks.orderBy("file").collect()]
    assert starts == sorted(starts) and len(starts) > 5


def test_odd_documents(spark):
    docs = odd_documents(spark)
    expected = sorted((len(i) for i in library_ids([r[1] for r in odd_rows()])))
    counts = token_counts.token_counts(docs, JSON)
    assert sorted(r.n_tokens for r in counts.collect()) == expected
    files = huffman.written_digests(docs, JSON)
    assert sorted(r.n_tokens - 1 for r in files.collect()) == expected
    assert max((r.start, r.doc_id is None) for r in files.collect())[1]
    digests = backtrack_bpe.round_trip_digests(backtrack_bpe.encode(docs, RANKS), RANKS)
    texts = sorted(hashlib.sha256((r[1] or "").encode()).hexdigest() for r in odd_rows())
    assert sorted(r.decoded_sha256 for r in digests.collect()) == texts
    clashing = clashing_documents(spark)
    assert rows_of(token_counts.token_counts(clashing, JSON)) == rows_of(counts)
    assert rows_of(huffman.written_digests(clashing, JSON)) == rows_of(files)
    assert rows_of(backtrack_bpe.encode(clashing, RANKS)) == rows_of(backtrack_bpe.encode(docs, RANKS))


def test_no_documents(spark):
    docs = no_documents(spark)
    assert token_counts.token_counts(docs, JSON).collect() == []
    assert huffman.written_digests(docs, JSON).collect() == []
    assert backtrack_bpe.round_trip_digests(backtrack_bpe.encode(docs, RANKS), RANKS).collect() == []
