import random
import re
import time

import duckdb
import pandas as pd
import pytest
from shared import clashing_documents, no_documents, odd_documents, rows_of

from spendlight.llm import licenses

EVERY = [(name, text) for name, texts in licenses.TEMPLATES.items() for text in texts]


def hits(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: tuple(r)[1:] for r in licenses.license_hits(docs).collect()}


def brute_windows(text, threshold=0.8):
    """Highest Dice and its name over all runs of words of a template's size range, whatever they start and end on."""
    words = re.findall(r"[^\W_]+", (text or "").lower())
    grams = [f"{a} {b}" for a, b in zip(words, words[1:])]
    found = [(0.0, None)]
    for name, wording in EVERY:
        t = set(licenses.bigrams(wording))
        version = set(licenses.version_bigrams(name, wording))
        most = licenses.size_bounds(len(t), threshold)[1] + len(re.findall(r"[^\W_]+", wording)) - 1 - len(t)
        for i in range(len(grams)):
            for j in range(i + 1, min(len(grams), i + most) + 1):
                part = set(grams[i:j])
                if version <= part and 2 * len(part & t) / (len(part) + len(t)) >= threshold:
                    found.append((-2 * len(part & t) / (len(part) + len(t)), name))
    return min(found, key=lambda f: (f[0], f[1] or ""))


def edited_notices(rng, n):
    texts = []
    for _ in range(n):
        words = rng.choice(EVERY)[1].split()[:40]
        for _ in range(rng.randrange(len(words) // 3 + 1)):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = rng.choice([["other"], [], ["of", "the"], words[at - 1 : at + 2]])
        texts.append(" ".join([f"before{i}" for i in range(60)] + words + [f"after{i}" for i in range(60)]))
    return texts


def test_windows_miss_nothing(spark):
    texts = edited_notices(random.Random(5), 60)
    found = {i: h[1] for i, h in hits(spark, texts).items()}
    expected = {i: -brute_windows(t)[0] for i, t in enumerate(texts)}
    assert 10 < sum(d > 0 for d in expected.values()) < 60
    assert found == pytest.approx(expected)


def test_every_template_alone(spark):
    found = hits(spark, [text for _, text in EVERY])
    for i, (name, _) in enumerate(EVERY):
        assert found[i] == (name, 1.0, 1, name)


def test_against_sql(spark):
    rng = random.Random(9)
    texts = edited_notices(rng, 30) + [None, "", "License.", "the license " * 300]
    for _ in range(12):
        notices = [rng.choice(EVERY)[1] for _ in range(rng.randrange(2, 5))]
        texts.append(rng.choice([" ", "\n", ". and so ", "\n\n"]).join(notices))
    found = hits(spark, texts)
    db = duckdb.connect()
    db.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    expected = {r[0]: r[1:] for r in db.execute(licenses.oracle()).fetchall()}
    assert found == expected
    assert max(h[2] for h in found.values()) > 2


@pytest.mark.parametrize("n", [3, 5, 12, 40])
def test_size_bounds_lose_nothing(n):
    least, most = licenses.size_bounds(n, 0.8)
    for size in range(1, 4 * n):
        reaches = 2 * min(size, n) / (size + n) >= 0.8
        assert reaches == (least <= size <= most)


def test_odd_documents(spark):
    found = licenses.license_hits(odd_documents(spark))
    assert {tuple(r)[1:] for r in found.collect()} == {(None, 0.0, 0, "")}
    assert found.count() == 12
    assert rows_of(licenses.license_hits(clashing_documents(spark))) == rows_of(found)
    assert licenses.license_hits(no_documents(spark)).collect() == []


def test_notices_inside_lines_and_paragraphs(spark):
    apache, gpl = licenses.TEMPLATES["Apache-2.0"][1], licenses.TEMPLATES["GPL-3.0"][1]
    wrapped = "\n".join(gpl.split(" ")[:20])
    filler = " ".join(f"and here goes word{i}" for i in range(99))
    texts = {
        "Copyright (c) 2020 Jane Doe. Licensed under the Apache License, Version 2.0.": ("Apache-2.0", 1.0, 1),
        "This project is released under the MIT License.": ("MIT", 1.0, 1),
        "This project is not released under the MIT License.": ("MIT", 1.0, 1),
        "Intro.\nReleased under the MIT License.\nMore.": ("MIT", 1.0, 1),
        f"Title\n\n{apache}\n \nbody": ("Apache-2.0", 1.0, 1),
        apache.replace("compliance", "accordance").upper(): ("Apache-2.0", 0.97, 1),
        "Licensed under CC BY-NC 4.0!\n\nLicensed under CC BY-NC 4.0.": ("CC-BY-NC-4.0", 1.0, 2),
        "released under the terms of another license": (None, 0.0, 0),
        "the the the the the the": (None, 0.0, 0),
        f"{filler} {apache} {filler}": ("Apache-2.0", 1.0, 1),
        f"{filler} {apache.replace('either', 'whether')} {filler}\ncode": ("Apache-2.0", 0.97, 1),
        "# a file\n# " + "\n# ".join(apache.split(". ")) + "\nimport os\n" + filler: ("Apache-2.0", 1.0, 1),
        f"{filler} Released under the MIT License. {filler} Licensed under CC BY-NC 4.0.": ("CC-BY-NC-4.0", 1.0, 2),
        f"Released under the MIT License.\n{filler} Licensed under CC BY 4.0. {filler}": ("CC-BY-4.0", 1.0, 2),
        "We say: Licensed under the Apache License, Version 1.1, and so on and on.": (None, 0.0, 0),
        f"{filler}\n{wrapped}\n{filler}": (None, 0.0, 0),
    }
    found = hits(spark, list(texts))
    for i, (text, (name, dice, n)) in enumerate(texts.items()):
        got = (found[i][0], found[i][2])
        assert got == (name, n) and found[i][1] >= dice, (text[:80], found[i])


def test_versions_tell_licences_apart(spark):
    lgpl = next(t for t in licenses.TEMPLATES["LGPL-2.0"] if "Lesser" in t)
    gpl = licenses.TEMPLATES["GPL-2.0"][0]
    texts = {
        lgpl: "LGPL-2.0",
        lgpl.replace("version 2 ", "version 2.1 "): "LGPL-2.1",
        lgpl.replace("version 2 ", "version 3 "): "LGPL-3.0",
        gpl: "GPL-2.0",
        gpl.replace("version 2 ", "version 3 "): "GPL-3.0",
        gpl.replace("version 2 ", "version 1 "): "",
    }
    found = hits(spark, list(texts))
    assert [found[i][3] for i in range(len(texts))] == list(texts.values())


def test_a_long_text_of_notices(spark):
    rng = random.Random(3)
    parts, words = [], 0
    while words < 100_000:
        parts.append(rng.choice(EVERY)[1])
        words += len(parts[-1].split())
    hits(spark, ["warm up: released under the MIT License"])
    started = time.monotonic()
    (found,) = hits(spark, ["\n".join(parts)]).values()
    assert time.monotonic() - started < 40
    assert found[0] is not None and found[2] == pytest.approx(len(parts), rel=0.01)


def test_a_notice_after_a_long_run_of_its_words(spark):
    for _, text in EVERY:
        assert licenses.bigrams(text)
    mit = licenses.TEMPLATES["MIT"][1]
    text = " ".join(["the software"] * 400) + " " + mit
    assert hits(spark, [text])[0][0] == "MIT"
