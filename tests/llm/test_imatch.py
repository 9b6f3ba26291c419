import hashlib
import random

from shared import clashing_documents, no_documents, odd_documents, rows_of

from spendlight.llm import imatch
from spendlight.llm.slices import id_slices


def test_edited_texts_follow_the_id_order(spark):
    rows = [(i * 3 - 50, f"text {i} " + "abcdefgh"[: i % 8] * (i % 5)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in imatch.fingerprints(docs).collect()}
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        assert found[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert found[doc_id].n_chars == len(text)


def test_order_over_many_slices(spark, monkeypatch):
    monkeypatch.setattr("spendlight.llm.slices.SLICE", 7)
    rows = [(i * i % 1009, f"{i} words of text") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few = rows_of(imatch.fingerprints(docs))
    monkeypatch.setattr("spendlight.llm.slices.SLICE", 4096)
    assert few == rows_of(imatch.fingerprints(docs))


def test_slices_stand_in_the_order_of_ids(spark, monkeypatch):
    monkeypatch.setattr("spendlight.llm.slices.SLICE", 10)
    ids = [((i * 37) % 501 - 100,) for i in range(501)] + [(None,), (5,), (5,)]
    docs = spark.createDataFrame(ids, "doc_id long")
    cut, n = id_slices(docs)
    rows = docs.withColumn("s", cut).collect()
    slices = [r.s for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0))]
    assert slices == sorted(slices) and max(slices) == n - 1 and len(set(slices)) > 30


def test_equal_texts_have_equal_fingerprints(spark):
    common = [f"shared{i}" for i in range(40)]
    rows = [(i, " ".join(w for j, w in enumerate(common) if (i + j) % 12 == 0) + f" own{i}") for i in range(120)]
    rows += [(1000, rows[3][1]), (1001, rows[3][1].upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in imatch.fingerprints(docs).collect()}
    assert found[3].fingerprint == found[1000].fingerprint == found[1001].fingerprint
    assert len({r.fingerprint for r in found.values()}) > 5
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found.values())
    assert found[1000].near_next == 1.0


def near_copies(n, of, rng):
    """n texts of the words ``of``, each with one word of its own in a random place."""
    texts = []
    for i in range(n):
        words = list(of)
        words[rng.randrange(len(words))] = f"own{i}"
        texts.append(" ".join(words))
    return texts


def test_near_copies_that_are_a_third_of_all_rows_are_alike(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(2000)]
    hot = near_copies(200, rng.sample(vocabulary, 175), rng)
    other = [" ".join(rng.choices(vocabulary, k=150)) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(hot + other)), "doc_id long, text string")
    found = sorted(imatch.fingerprints(docs).collect())
    assert min(r.near_next for r in found[:199]) > 0.9
    assert max(r.near_next for r in found[199:]) < 0.2
    assert len({r.fingerprint for r in found}) == 600


def test_texts_of_rare_words_only(spark):
    rng = random.Random(4)
    texts = [t for k in range(150) for t in near_copies(2, [f"rare{k}x{j}" for j in range(40)], rng)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted(imatch.fingerprints(docs).collect())
    assert all((r.near_next > 0.8) if i % 2 == 0 else (r.near_next < 0.1) for i, r in enumerate(found))


def test_equal_fingerprints_have_equal_lexicon_terms(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 5, 30]))) for _ in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lexicon = {r.term for r in imatch.lexicon(docs).collect()}
    signed = {}
    for r in imatch.fingerprints(docs).collect():
        terms = set(texts[r.doc_id].split())
        inside = terms & lexicon
        signed.setdefault(r.fingerprint, set()).add(frozenset(inside if len(inside) >= imatch.LEAST else terms))
    assert all(len(terms) == 1 for terms in signed.values())


def test_odd_documents(spark):
    found = imatch.fingerprints(odd_documents(spark))
    rows = {r.doc_id: r for r in found.collect()}
    assert found.count() == 12
    assert rows[3].fingerprint == rows[4].fingerprint
    assert rows[-8].fingerprint == rows[9].fingerprint
    assert rows[2].n_chars == 0
    assert rows_of(imatch.fingerprints(clashing_documents(spark))) == rows_of(found)
    assert imatch.fingerprints(no_documents(spark)).collect() == []
