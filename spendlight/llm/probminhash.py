"""Near-duplicate texts by ProbMinHash over weighted word shingles, banding, and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlight.llm.components import components, merged_components
from spendlight.llm.pretokens import chunks_of
from spendlight.llm.store import stored
from spendlight.llm.words import STEP, scrambled, word_hashes

#: Words of a shingle, and the probability Jaccard similarity of a link.
WORDS = 5
SIMILAR = 0.8
#: Registers (a prime), and bands of ROWS of them: a link at SIMILAR shares a band but for one in 16,000.
REGISTERS = 193
BANDS, ROWS = 32, 6
#: Buckets up to this many texts give all their pairs; larger ones are compared with their first text, then in blocks.
SMALL = 8
#: A block holds about this many texts, or as many as have this many bytes; a longer text is one by itself.
BLOCK = 256
BLOCK_BYTES = 1 << 22
#: Share of equal registers under which a pair of a large bucket isn't verified: five deviations below SIMILAR.
ESTIMATE = SIMILAR - 5 * (SIMILAR * (1 - SIMILAR) / REGISTERS) ** 0.5


# --- sketches, inside tasks ---------------------------------------------------


def weighted_shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of texts: the text's place, the shingle's hash, its weight 1 + ln(occurrences); in that order.

    A text of fewer than WORDS words, but at least one, is one shingle.
    """
    words, of = word_hashes(texts)
    per_text = np.bincount(of, minlength=len(texts))
    firsts = np.cumsum(per_text) - per_text
    sizes = np.minimum(per_text, WORDS)
    starts = np.flatnonzero(np.arange(len(words)) <= (firsts + per_text - sizes)[of])
    size = sizes[of[starts]]
    powers = np.multiply.accumulate(np.full(WORDS, STEP))
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    hashes = size.astype(np.uint64)
    for k in range(WORDS):
        hashes = hashes + np.where(k < size, padded[starts + k] * powers[k], np.uint64(0))
    hashes, of = scrambled(hashes), of[starts]
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])])) if len(of) else of
    counts = np.diff(np.append(new, len(of)))
    return of[new], hashes[new], 1 + np.log(counts)


def signatures(texts: list[str]) -> np.ndarray:
    """One row of REGISTERS winners per text; 0 in every place for a text without a word.

    Each shingle's arrivals are the ordered times of independent exponentials
    of its weight, one per register, met in an order of its own: the next comes
    after a step of rate weight * (registers left). The earliest arrival wins a
    register, so two texts share a winner with their probability Jaccard
    similarity. A shingle stops once it is later than all registers of its text.
    """
    of, hashes, weights = weighted_shingles(texts)
    times = np.full(len(texts) * REGISTERS, np.inf)
    winners = np.zeros(len(texts) * REGISTERS, np.uint64)
    stride = (hashes >> np.uint64(32)) % np.uint64(REGISTERS - 1) + np.uint64(1)
    register = hashes % np.uint64(REGISTERS)
    now = np.zeros(len(of))
    live = np.arange(len(of))
    for k in range(REGISTERS):
        own = hashes[live]
        salt = np.uint64((k + 1) * int(STEP) % (1 << 64))
        uniform = (scrambled(own + salt) >> np.uint64(11)).astype(np.float64)
        now = now - np.log((uniform + 0.5) / (1 << 53)) / (weights[live] * (REGISTERS - k))
        last = times.reshape(-1, REGISTERS).max(axis=1)
        on = now < last[of[live]]
        live, now = live[on], now[on]
        if not len(live):
            break
        hit = (register[live] + stride[live] * np.uint64(k)) % np.uint64(REGISTERS)
        at = of[live] * REGISTERS + hit.astype(np.int64)
        np.minimum.at(times, at, now)
        won = now == times[at]
        winners[at[won]] = hashes[live[won]]
    return winners.reshape(-1, REGISTERS)


def bands_of(signature: np.ndarray) -> np.ndarray:
    """One hash per band and text."""
    rows = signature[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    hashed = np.zeros(rows.shape[:2], np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        hashed = scrambled(hashed * STEP + rows[:, :, r])
    return hashed.view(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The exact similarity of two sets of (ascending hashes, weights).

    A shingle d of both counts 1 / sum over all e of max(a_e / a_d, b_e / b_d):
    the first is the larger where b_e / a_e <= b_d / a_d. So shingles are put in
    order of that ratio, and the sums are running ones.
    """
    _, in_a, in_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(in_a):
        return 0.0
    x, y = a[1][in_a], b[1][in_b]
    ratio = y / x
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    upto = np.searchsorted(ratio, ratio, side="right")
    below = np.concatenate([[0], np.cumsum(x)])[upto] + (a[1].sum() - x.sum())
    above = (y.sum() - np.concatenate([[0], np.cumsum(y)])[upto]) + (b[1].sum() - y.sum())
    return float((1 / (below / x + above / y)).sum())


def _texts_in(column: pa.Array) -> Iterator[list[str]]:
    for texts in chunks_of(column):
        for i in range(0, len(texts), 512):
            yield texts[i : i + 512]


def _sketched(rows: DataFrame) -> DataFrame:
    """Replace the text, the last column, by its bands; none for a text without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _texts_in(batch.column(len(names))):
                signature = signatures(texts)
                found = [b if s[0] else b[:0] for b, s in zip(bands_of(signature), signature)]
                own = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns[:-1], pa.array(found, pa.list_(pa.int64()))], names=[*names, "bands"]
                )
                at += len(texts)

    names = rows.columns[:-1]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(run, f"{fields}, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 128):
                rows = batch.slice(i, 128).to_pylist()
                # A text that stands in many pairs here is cut into shingles once.
                known = {r["a"]: r["text_a"] for r in rows} | {r["b"]: r["text_b"] for r in rows}
                sets = dict(zip(known, _shingle_sets(list(known.values()))))
                linked = [(r["a"], r["b"]) for r in rows if probability_jaccard(sets[r["a"]], sets[r["b"]]) >= SIMILAR]
                if linked:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*linked)], names=["a", "b"])

    return pairs.join(second, "b").join(first, "a").mapInArrow(run, "a long, b long")


def _shingle_sets(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    of, hashes, weights = weighted_shingles(texts)
    ends = np.searchsorted(of, np.arange(len(texts)), side="right")[:-1]
    return list(zip(np.split(hashes, ends), np.split(weights, ends)))


def _joined_groups(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that join groups of texts within a bucket: columns a, b.

    ``members`` has bucket, band, node and component. Texts of a bucket's
    largest group are put into blocks by hash, those of its other groups into
    blocks of their own, and blocks are compared in pairs but for those that
    hold the largest group alone. A pair of texts whose groups differ, whose
    signatures are alike enough and whose first shared band is this one is
    verified on the texts; once two groups are joined, their other pairs need
    no look. So a pair of blocks gives fewer links than it holds texts.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for chunk in _texts_in(batch.column(1)):
                short = [s.tobytes() for s in signatures(chunk).astype("<u4")]
                own = batch.slice(at, len(chunk))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(short)], names=["node", "text", "sign"])
                at += len(chunk)

    wanted = texts.join(members.select("node").distinct(), "node").select("node", "text")
    signed = wanted.mapInArrow(sign, "node long, text string, sign binary")
    signed = stored(signed.withColumn("bytes", F.octet_length("text").cast("long")), "signatures")
    sized = members.join(signed.select("node", "bytes"), "node")
    groups = sized.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    largest = F.max(F.struct("n", F.col("component").alias("main"), "bytes")).alias("top")
    blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK, size / BLOCK_BYTES)).cast("int")
    n, size = F.col("top.n"), F.col("top.bytes")
    cut = groups.groupBy("bucket").agg(largest, F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).select(
        "bucket",
        "top.main",
        blocks(n, size).alias("main_blocks"),
        blocks(F.col("n") - n, F.col("bytes") - size).alias("rest_blocks"),
    )
    spread = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    block = F.when(F.col("component") == F.col("main"), spread("main_blocks")).otherwise(
        F.col("main_blocks") + spread("rest_blocks")
    )
    # A block holds about BLOCK texts or BLOCK_BYTES, however large its bucket is.
    packed = (
        members.join(cut, "bucket")
        .withColumn("block", block)
        .join(signed, "node")
        .groupBy("bucket", "band", "block", "main_blocks", "rest_blocks")
        .agg(F.collect_list(F.struct("node", "component", "sign", "text")).alias("texts"))
    )
    packed = stored(packed, "blocks")
    partners = F.sequence(F.greatest("block", "main_blocks"), F.col("main_blocks") + F.col("rest_blocks") - 1)
    left = packed.select(
        "bucket", "band", F.col("block").alias("own"), F.col("texts").alias("left"), F.explode(partners).alias("block")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                left, right = (_Block(batch.column(c)[i].values) for c in (0, 1))
                band, own, block = (batch.column(c)[i].as_py() for c in (2, 3, 4))
                found = _links_between(left, right, band, own == block)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    both = left.join(packed.select("bucket", "block", "texts"), ["bucket", "block"])
    return both.select("left", "texts", "band", "own", "block").mapInArrow(compare, "a long, b long")


class _Block:
    """Texts of a block with their nodes, groups and signatures; a text is read and cut only when a pair needs it."""

    def __init__(self, rows: pa.StructArray):
        self.node, self.component = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("node", "component"))
        joined = b"".join(rows.field("sign").to_pylist())
        self.sign, self.texts, self._sets = np.frombuffer(joined, "<u4").reshape(len(rows), -1), rows.field("text"), {}

    def shingles(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        if at not in self._sets:
            self._sets[at] = _shingle_sets([self.texts[at].as_py()])[0]
        return self._sets[at]


def _links_between(left: _Block, right: _Block, band: int, same: bool) -> list[tuple[int, int]]:
    """Links that join the groups of two blocks, the likeliest pairs first."""
    pairs = []
    for k in range(len(left.node)):
        equal = left.sign[k] == right.sign
        alike = equal.mean(axis=1)
        at = np.flatnonzero((alike >= ESTIMATE) & (right.component != left.component[k]))
        at = at[at > k] if same else at
        if len(at):
            shared = equal[at, : BANDS * ROWS].reshape(len(at), BANDS, ROWS).all(axis=2)
            pairs += [(-alike[i], k, i) for i in at[shared.argmax(axis=1) == band].tolist()]
    if not pairs:
        return []
    joined = {c: c for c in np.concatenate([left.component, right.component]).tolist()}

    def root(c: int) -> int:
        while joined[c] != c:
            c = joined[c]
        return c

    links = []
    for _, k, at in sorted(pairs):
        a, b = root(int(left.component[k])), root(int(right.component[at]))
        if a != b and probability_jaccard(left.shingles(k), right.shingles(at)) >= SIMILAR:
            joined[b] = a
            links.append((int(left.node[k]), int(right.node[at])))
    return links


# --- classes ------------------------------------------------------------------


def _rows(docs: DataFrame) -> DataFrame:
    """id, k1, k2 and text of each document with a text; two 64-bit hashes stand for a text."""
    keyed = docs.select(F.col("doc_id").alias("id"), F.col("text")).where("text is not null")
    return keyed.select("id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), "text")


def text_classes(docs: DataFrame) -> DataFrame:
    """The distinct texts of documents and their classes: k1, k2, class_id, keeper.

    Texts link if the probability Jaccard similarity of their weighted word
    shingles is at least SIMILAR; a class is what links connect. ``class_id`` is
    the smallest id of a class and ``keeper`` whether the document that stays
    has this text.

    Equal texts are one node from the start. Buckets of a band give pairs with
    their first text (all pairs where they are small), which are verified on the
    texts. Where a large bucket is then still in several groups, the pairs
    between the groups are compared by signature, in blocks, and verified there.
    """
    return _classes(_rows(docs), _sketches(docs))


def _sketches(docs: DataFrame) -> DataFrame:
    """id, k1, k2, row (a number per document) and bands of each document with a text."""
    numbered = _rows(docs).withColumn("row", F.monotonically_increasing_id())
    return stored(_sketched(numbered.select("id", "k1", "k2", "row", "text")), "sketches")


def _classes(rows: DataFrame, scanned: DataFrame) -> DataFrame:
    # The first document of a text: the smallest id, null ids last.
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "bands"))
    firsts = scanned.groupBy("k1", "k2").agg(first.alias("first"))
    nodes = stored(firsts.select("k1", "k2", "first.id", F.col("first.row").alias("node"), "first.bands"), "texts")
    bands = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    nodes = nodes.drop("bands")
    shared = bands.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("center")).where("size > 1")
    members = stored(bands.join(shared, "bucket"), "buckets")

    keys = members.select("node").distinct().join(nodes, "node")
    wanted = keys.select("node", F.col("id").alias("own"), F.col("k1").alias("w1"), F.col("k2").alias("w2"))
    match = (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")) & F.col("id").eqNullSafe(F.col("own"))
    texts = rows.join(wanted, match).select("node", "text").dropDuplicates(["node"])
    texts = stored(texts, "candidate-texts")

    stars = members.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b"))
    # At most SMALL texts in a list.
    small = members.where(f"size <= {SMALL}").groupBy("bucket").agg(F.array_sort(F.collect_list("node")).alias("of"))
    every = small.selectExpr("explode(of) as a", "of").selectExpr("a", "explode(of) as b").where("a < b")
    pairs = stored(stars.unionByName(every).distinct(), "pairs")
    links = stored(_verified(pairs, texts), "links")
    groups = components(links)

    large = members.where(f"size > {SMALL}").join(groups, "node", "left")
    large = large.withColumn("component", F.coalesce("component", "node"))
    ends = large.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    split = large.join(ends.where("low <> high").select("bucket"), "bucket")
    open_members = stored(split.select("bucket", "band", "node", "component"), "open")
    if not open_members.isEmpty():
        more = stored(_joined_groups(open_members, texts), "more-links")
        groups = merged_components(groups, more)

    placed = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node"))
    best = placed.groupBy("component").agg(smallest.alias("best"))
    return placed.join(best, "component").select(
        "k1", "k2", "id", F.col("best.id").alias("class_id"), (F.col("best.node") == F.col("node")).alias("keeper")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id, kept.

    ``class_id`` is the smallest id of the document's class, ``kept`` whether it
    is the one that stays. Texts shorter than a shingle are one shingle; texts
    without a word (the empty one too) are only like equal ones. A null text is
    its own class and stays, and so does its row. Of repeated rows one stays.
    Very long texts are compared whole; blocks of them hold fewer texts.
    Null ids come after all others. Only doc_id and text are read.
    """
    rows = _sketches(docs)
    classes = stored(_classes(_rows(docs), rows), "classes").withColumnRenamed("id", "first_id")
    rows = rows.drop("bands")
    # Copies of a text meet its class; the one that stays is the first of those that have the smallest id.
    stays = rows.groupBy("k1", "k2", "id").agg(F.min("row").alias("stay"))
    stays = stays.join(classes.where("keeper"), ["k1", "k2"])
    stays = stays.where(F.col("id").eqNullSafe(F.col("first_id"))).select("stay")
    found = (
        rows.join(classes.select("k1", "k2", "class_id"), ["k1", "k2"])
        .join(stays, F.col("row") == F.col("stay"), "left")
        .select(F.col("id").alias("doc_id"), "class_id", F.col("stay").isNotNull().alias("kept"))
    )
    without = docs.where("text is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"))
    return found.unionByName(without)


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns; documents without a text stay."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, doc_id = F.col(f"c{names.index('text')}"), F.col(f"c{names.index('doc_id')}")
    keepers = stored(text_classes(docs).where("keeper").select("k1", "k2", "id"), "keepers")
    keyed = plain.where(text.isNotNull()).withColumns(
        {"own_1": F.xxhash64(text), "own_2": F.xxhash64(F.lit(1), text), "own_id": doc_id}
    )
    match = (F.col("own_1") == F.col("k1")) & (F.col("own_2") == F.col("k2")) & F.col("own_id").eqNullSafe(F.col("id"))
    kept = keyed.join(keepers, match, "left_semi").dropDuplicates(["own_1", "own_2", "own_id"])
    return kept.select(*plain.columns).unionByName(plain.where(text.isNull())).toDF(*names)
