import hashlib
import random
import re
import time

import numpy as np
import pytest
from shared import clashing_documents, no_documents, odd_documents, rows_of

from spendlight.llm import personal_data as pii

PLAIN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_spans(text):
    """The patterns as they are written, each with its test."""
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2:
                total = sum(d if i % 2 == 0 else (2 * d) // 10 + (2 * d) % 10 for i, d in enumerate(reversed(digits)))
                if not 13 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_plain_patterns():
    draw = random.Random(3)
    pieces = ["a", "B.c", "@", ".", "-", " ", "  ", "+", "(", ")", "1", "25", "256", "0001", "4111111111111111", "\n", "é", "_",
              "x@y.z", "10.0.0.1", "+1 (555) 555-0100", "4111 1111 1111 1111", "3782-822463-10005"]
    for _ in range(4000):
        text = "".join(draw.choices(pieces, k=draw.randint(0, 24)))
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize(
    "text", ["a" * 400_000, "1" * 400_000, "1.2.3." * 60_000, "1 " * 200_000, "a@" * 200_000, "a@b.c " * 60_000,
             "+1 (" * 100_000, "word " * 80_000 + "@", "+" + "1" * 400_000, "mail a@b.co " * 30_000]
)
def test_long_texts_take_linear_time(text):
    began = time.monotonic()
    pii.base_spans(text)
    pii.seeds_of(text)
    assert time.monotonic() - began < 8


def learned_documents():
    """A cue that introduces phones, some in a form that no base pattern has, and a word that introduces anything."""
    rows = [(i, f"please call: +1 (555) 555-{1000 + i} now, and the +1 (555) 555-{2000 + i} or") for i in range(12)]
    rows += [(100 + i, f"so please call: (555) 555-{3000 + i} today") for i in range(2)]
    rows += [(200 + i, f"see the 555 555 {4000 + i} and the w{i} of the v{i}") for i in range(20)]
    return rows + [(300, "mail me at jane.doe@example.org or call: (555) 555-9999")]


def test_patterns_find_unseen_values(spark):
    docs = spark.createDataFrame(learned_documents(), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    assert [found[100 + i].n_found for i in range(2)] == [1, 1]
    start = learned_documents()[12][1].index("(555)")
    assert found[100].spans == f"phone:{start}:{start + 14}" and found[100].n_phone == 0
    assert all(found[200 + i].n_found == 0 for i in range(20)), "a common word is no pattern"
    assert found[300].n_email == 1 and found[300].n_found == 1
    assert found[0].n_phone == 2 and found[0].n_found == 0


def expected_scores(contexts, edges, rounds):
    """The rounds step by step, on dictionaries."""
    scores, confident = {}, {}
    for _ in range(rounds):
        confident = {}
        for kind, context, n, seen in contexts:
            mass = seen + sum(t * scores.get((k, v), 0) for k, c, v, t in edges if (k, c) == (kind, context))
            if mass / (n + 1) >= pii.CONFIDENT:
                confident[kind, context] = mass / (n + 1)
        miss = {}
        for k, c, v, _ in edges:
            if (k, c) in confident:
                miss[k, v] = miss.get((k, v), 1) * (1 - confident[k, c])
        scores = {key: 1 - m for key, m in miss.items()}
    return confident, scores


def test_scores_follow_the_rounds(spark):
    draw = random.Random(5)
    edges = [(k, c, v, draw.randint(1, 3)) for k, c, v in {
        (draw.randint(0, 1), draw.randint(0, 30), draw.randint(0, 60)) for _ in range(300)}]
    contexts = []
    for k, c in sorted({e[:2] for e in edges}):
        seen, maybe = draw.randint(3, 15), sum(t for *key, _, t in edges if key == [k, c])
        contexts.append((k, c, seen + maybe + draw.randint(0, 12), seen))
    patterns, values = pii.scored_patterns(
        spark.createDataFrame(contexts, "kind int, context long, n long, seen long"),
        spark.createDataFrame(edges, "kind int, context long, value long, times long"),
    )
    confident, scores = expected_scores(contexts, edges, pii.ROUNDS)
    assert {(r.kind, r.context): r.confidence for r in patterns.collect()} == pytest.approx(confident, abs=1e-4)
    assert {(r.kind, r.value): r.score for r in values.collect()} == pytest.approx(scores, abs=1e-4)


def test_contexts_in_texts_are_those_of_the_seeds():
    texts = ["Write to Jane\u0130: +1 (555) 555-0100, or host 10.0.0.1\nnot 10.0.0.2", "so a host 10.0.0.9 x\nhost a or host"]
    seeds = [s for t in texts for s in pii.seeds_of(t)]
    assert sorted(kind for kind, *_ in seeds) == [1] * 5 + [3, 3]
    known = np.array(sorted({c for _, c, _ in seeds}), np.int64)
    searcher = pii._Searcher(known, np.full(len(known), 15))
    assert searcher.hits(texts, [pii.base_spans(t) for t in texts]) == [[], []]
    met = dict(zip(known.tolist(), searcher.counts.tolist()))
    # jane, "to jane", host (4), "or host" (2), not, "a host"
    assert sorted(met.values()) == [1, 1, 1, 1, 2, 4]


def test_looks_are_met_wherever_they_stand():
    """The quick look ahead passes every place at which a look matches."""
    found = ["jane.doe(at)example.org", "jane [at] example [dot] org", "jane@host", "fe80::1:2", "::1", "10(dot)1(dot)2(dot)5",
             "4111.1111.1111.1112", "(555) 555-0100", "+49 170 1234567"]
    texts = [f"reach {value}" for value in found] + [f"reach -- {value} z" for value in found]
    context = pii._contexts(pii.word_hashes(["reach"])[0])
    hits = pii._Searcher(context, np.array([15])).hits(texts, [[] for _ in texts])
    assert all(any(text[a:b] == value for _, a, b, *_ in own)
               for text, value, own in zip(texts, found * 2, hits)), [(t, h) for t, h in zip(texts, hits) if not h]


def test_copies_do_not_make_a_pattern(spark):
    rows = [(i, "dial 10.1.2.3 and dial 10.1.2.4") for i in range(500)] + [(900, "dial 10(dot)1(dot)2(dot)5")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.n_found for r in pii.personal_data(docs).collect()} == {0}


@pytest.mark.parametrize("make", [odd_documents, clashing_documents])
def test_odd_documents(spark, make):
    docs = make(spark)
    found = pii.personal_data(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert found.count() == docs.count()
    for r in found.collect():
        spans = plain_spans(texts[r.doc_id] or "") if r.doc_id is not None else []
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_no_documents(spark):
    assert rows_of(pii.personal_data(no_documents(spark))) == []
