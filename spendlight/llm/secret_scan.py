"""Secrets, told apart from copied examples by who owns the candidates across the corpus."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlight.llm.pretokens import texts_of
from spendlight.llm.store import stored

#: The kinds of candidates in the order of their spans. The group is the secret, of the least length.
ASSIGNED = r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [
    ("assign", re.compile(ASSIGNED, re.I | re.A), 12),
    ("access", re.compile(r"(AKIA[A-Z0-9]+)"), 18),
    ("hex", re.compile(r"([0-9a-f]{16,})"), 16),
    ("format", re.compile(r"((?:gh[pousr]_|glpat-|xox[abprs]-|sk_live_|AIza|eyJ)[A-Za-z0-9_.-]+)"), 20),
    ("bare", re.compile(r"([A-Za-z0-9+/_=-]{20,})"), 20),
]
BASE = 3

#: A candidate is a copied example from so many owners on, if so many repositories hold it, or from so many
#: repositories on, even of one owner.
WIDE_OWNERS = 3
SOME_REPOSITORIES = 5
WIDE_REPOSITORIES = 20
#: Bits per character that a live one has at least.
LIVE_BITS = 2.5
#: The same for a string that only its look makes a candidate, which also needs one of each of these.
BARE_BITS = 3.8
MIXED = (re.compile("[0-9]"), re.compile("[a-z]"), re.compile("[A-Z]"))

#: Runs of a value that a placeholder is made of, besides steps like 0123, and the share of it that they cover.
FILLER = re.compile(
    r"example|sample|dummy|changeme|placeholder|redacted|your|x{4,}|\*{4,}|([^\n])\1{5,}", re.I | re.A
)
FILLER_SHARE = 0.5
#: Plain words joined by signs, of which the first or last is a placeholder word; and the ending of documented keys.
WORDED = re.compile(
    r"(?:(?:example|sample|dummy|changeme|placeholder|redacted|your)(?:[^a-z0-9]+(?:[a-z]{1,12}|\d{1,4}))*"
    r"|(?:(?:[a-z]{1,12}|\d{1,4})[^a-z0-9]+)+(?:example|sample|dummy|changeme|placeholder|redacted))",
    re.I | re.A,
)
ENDING = re.compile(r"AKIA[A-Z0-9]{9,}EXAMPLE|[A-Za-z0-9/+]{29,}EXAMPLEKEY")
#: Least length of a run of characters that each follow the one before; 0 and a follow 9.
STEPS = 4
HIDDEN = "[REDACTED]"

SPANS = T.StructType().add(
    "_spans",
    T.ArrayType(
        T.StructType()
        .add("kind", T.IntegerType())
        .add("start", T.IntegerType())
        .add("end", T.IntegerType())
        .add("digest", T.StringType())
        .add("live", T.BooleanType())
    ),
)
_SPAN = pa.struct(
    [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("digest", pa.string()), ("live", pa.bool_())]
)


def bits(value: str) -> float:
    """Entropy per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def is_placeholder(value: str) -> bool:
    """Whether the value is mostly made of placeholder words and runs, or is a placeholder word in a plain phrase."""
    if WORDED.fullmatch(value) or ENDING.fullmatch(value):
        return True
    covered = set()
    for m in FILLER.finditer(value):
        covered.update(range(m.start(), m.end()))
    start, low = 0, value.lower()
    for i in range(1, len(low) + 1):
        if i == len(low) or not _follows(low[i - 1], low[i]):
            if i - start >= STEPS:
                covered.update(range(start, i))
            start = i
    return len(covered) >= FILLER_SHARE * len(value)


def _follows(a: str, b: str) -> bool:
    return a.isalnum() and b.isalnum() and (ord(b) == ord(a) + 1 or (a == "9" and b in "0a"))


def candidates(text: str) -> list[dict]:
    """The candidate spans of a text by start, then kind: base ones, known formats, and bare strings that look random.

    Spans are in code points. Matches of a kind don't overlap; one that is too
    short is dropped together with what it covers. A span of the added kinds is
    left out where one span before it in the list of kinds covers all of it;
    one that only overlaps such a span is judged by itself. Time follows the
    length of the text, also where it is full of candidates.
    """
    found = []
    for kind, (_, pattern, least) in enumerate(KINDS):
        before = sorted((s["start"], s["end"]) for s in found) if kind >= BASE else []
        # The furthest end of the spans up to each.
        furthest = list(accumulate((b for _, b in before), max))
        for m in pattern.finditer(text):
            value = m[1]
            if len(value) < least:
                continue
            at = bisect_right(before, (m.start(), len(text)))
            if at and furthest[at - 1] >= m.end():
                continue
            bare = kind == len(KINDS) - 1
            if bare and not all(p.search(value) for p in MIXED):
                continue
            entropy = bits(value)
            if bare and entropy < BARE_BITS:
                continue
            live = entropy >= LIVE_BITS and not is_placeholder(value)
            digest = xxhash.xxh3_128_hexdigest(value)
            found.append({"kind": kind, "start": m.start(), "end": m.end(), "digest": digest, "live": live})
    return sorted(found, key=lambda s: (s["start"], s["kind"]))


def scanned(docs: DataFrame, text: str, keep_text: bool) -> DataFrame:
    """Add _spans, the candidates of each row, and _row, a number per row; stored once in the shared folder.

    A rerun of a task gives the same numbers, since they count inside a part of the input.
    """
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    kept = [i for i, c in enumerate(numbered.columns) if keep_text or c != text]
    schema = numbered.select(*[numbered.columns[i] for i in kept]).schema
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = pa.array([candidates(t) for texts in texts_of(batch.column(at)) for t in texts], pa.list_(_SPAN))
            names = [batch.schema.names[i] for i in kept]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], spans], names=[*names, "_spans"])

    return stored(numbered.mapInArrow(run, T.StructType([*schema, *SPANS])), "secret-candidates")


def ownership(candidate_rows: DataFrame) -> DataFrame:
    """How widely each candidate is held: digest, owners, repositories, from rows of digest, owner, repository.

    Three groupings, each with a map-side step, so a candidate that stands in a
    third of all documents is counted by repository and by owner first. A null
    owner or repository counts as one.
    """
    return (
        candidate_rows.groupBy("digest", "owner", "repository")
        .agg(F.lit(1).alias("one"))
        .groupBy("digest", "owner")
        .agg(F.count("*").alias("held"))
        .groupBy("digest")
        .agg(F.count("*").alias("owners"), F.sum("held").alias("repositories"))
    )


def judged(rows: DataFrame, owner: str, repository: str, wide: int = WIDE_OWNERS) -> DataFrame:
    """For scanned rows with a candidate: _row and _judged, its spans with the verdict in place of the digest.

    ``copied``: at least WIDE_REPOSITORIES hold the value, or SOME_REPOSITORIES
    of at least ``wide`` owners do; ``live``: it is not copied and looks random.
    Base spans always stay; added ones only if they are live.
    A value that very many rows hold makes one large key of the join, which
    Spark splits; nothing is broadcast by hint.
    """
    held_by = [F.col(owner).alias("owner"), F.col(repository).alias("repository")]
    spans = rows.select("_row", *held_by, F.explode("_spans").alias("s"))
    held = ownership(spans.select("s.digest", "owner", "repository"))
    spread = (F.col("owners") >= wide) & (F.col("repositories") >= SOME_REPOSITORIES)
    copied = spread | (F.col("repositories") >= WIDE_REPOSITORIES)
    wide_ones = held.where(copied).select("digest", F.lit(True).alias("_copied"))
    flat = spans.select("_row", "s.kind", "s.start", "s.end", "s.digest", "s.live")
    verdicts = flat.join(wide_ones, "digest", "left").withColumn("copied", F.coalesce("_copied", F.lit(False)))
    verdicts = verdicts.withColumn("live", F.col("live") & ~F.col("copied"))
    verdicts = verdicts.where((F.col("kind") < BASE) | F.col("live"))
    span = F.struct("start", "kind", "end", "live", "copied")
    return verdicts.groupBy("_row").agg(F.array_sort(F.collect_list(span)).alias("_judged"))


def secrets(
    docs: DataFrame, owner: str = "source", repository: str | None = None, wide: int = WIDE_OWNERS
) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied.

    ``spans`` joins kind:start:end of the base spans and of the live added
    ones; ``base_sha256`` digests the base spans alone. Null texts are empty;
    an empty list is an empty text. Ids may be null or repeat, equal rows are
    judged alike. Without a ``repository`` column every different text of an
    owner is a repository, so exact copies of a leaked file count once. Only
    doc_id, text and the ownership columns are read.
    """
    held_by = [F.col(owner).alias("_owner"), _repository(F.col("text"), repository).alias("_repo")]
    wanted = docs.select(F.col("doc_id").alias("_id"), "text", *held_by)
    rows = scanned(wanted, "text", keep_text=False)
    verdicts = judged(rows.where(F.size("_spans") > 0), "_owner", "_repo", wide)
    found = rows.select("_row", "_id").join(verdicts, "_row", "left")
    nothing = F.array().cast("array<struct<start: int, kind: int, end: int, live: boolean, copied: boolean>>")
    spans = F.coalesce("_judged", nothing)
    name = lambda s: F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), s["kind"] + 1)
    one = lambda s: F.concat_ws(":", name(s), s["start"], s["end"])
    written = lambda xs: F.array_join(F.transform(xs, one), ",")
    of = lambda test: F.size(F.filter("_all", test)).cast("long")
    is_kind = lambda k: lambda s: s["kind"] == k
    return found.withColumn("_all", spans).select(
        F.col("_id").alias("doc_id"),
        *[of(is_kind(k)).alias(f"n_{KINDS[k][0]}") for k in range(BASE)],
        F.sha2(written(F.filter("_all", lambda s: s["kind"] < BASE)).cast("binary"), 256).alias("base_sha256"),
        written(F.col("_all")).alias("spans"),
        of(lambda s: s["live"]).alias("n_live"),
        of(lambda s: s["copied"]).alias("n_copied"),
    )


def redacted(
    docs: DataFrame, owner: str = "source", repository: str | None = None, wide: int = WIDE_OWNERS
) -> DataFrame:
    """All documents with every column; live secrets in their texts are replaced, copied examples stay.

    Documents without a candidate pass as they are; the others meet their
    verdicts by row. ``n_chars``, if there is one, follows the new text.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    column = {name: f"c{i}" for i, name in enumerate(names)}
    text, size = column["text"], column.get("n_chars")
    rows = scanned(plain, text, keep_text=True)
    suspects = rows.where(F.size("_spans") > 0)
    held = _repository(F.col(text), column[repository] if repository else None)
    verdicts = judged(suspects.withColumn("_repo", held), column[owner], "_repo", wide)
    joined = suspects.drop("_spans").join(verdicts, "_row", "left").drop("_row")
    at, out = joined.columns.index(text), plain.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(len(out)).to_pylist()
            texts = [_hidden(t, s or []) for t, s in zip(batch.column(at).to_pylist(), spans)]
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(out))]
            yield pa.RecordBatch.from_arrays(columns, names=out)

    changed = joined.mapInArrow(run, plain.schema)
    if size:
        changed = changed.withColumn(size, F.length(text).cast(plain.schema[size].dataType))
    untouched = rows.where(F.coalesce(F.size("_spans"), F.lit(0)) <= 0).select(*plain.columns)
    return untouched.unionByName(changed).toDF(*names)


def _repository(text: Column, column: str | None) -> Column:
    return F.col(column) if column else F.xxhash64(text)


def _hidden(text: str, spans: list[dict]) -> str:
    """The text with its live spans replaced; overlapping ones are replaced together."""
    out, at = [], 0
    for s in spans:
        if s["live"] and s["end"] > at:
            if s["start"] >= at:
                out += [text[at : s["start"]], HIDDEN]
            at = s["end"]
    return "".join([*out, text[at:]])
