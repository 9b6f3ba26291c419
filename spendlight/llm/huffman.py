"""Files of token ids in a canonical length-limited Huffman code."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlight.llm.pretokens import Memo, json_vocabulary, read_text, texts_of
from spendlight.llm.slices import id_slices
from spendlight.llm.store import stored
from spendlight.session import scratch_dir

#: Longest code; the decoding table has two to this many entries.
MAX_BITS = 16
#: Pieces of each of two generations that a worker remembers.
KEPT_PIECES = 800_000
#: A block is closed once it holds so many ids.
BLOCK_IDS = 1 << 18
#: Ids between two checkpoints inside a document.
STRIDE = 128


# --- the code -----------------------------------------------------------------


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Code length by id for the counts by id: the shortest code with no word over max_bits (0: not used).

    Package-merge: a level is the leaves and the pairs of the level below in
    order of weight; going back from the last level, the leaves among the items
    taken get one bit more, and the pairs taken say how many items the level
    below gives.
    """
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError("too many ids for the longest code")
    leaves = used[np.argsort(counts[used], kind="stable")]
    weights = counts[leaves].astype(np.int64)
    levels, level = [], weights
    for _ in range(max_bits - 1):
        levels.append(level)
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        level = np.sort(np.concatenate([weights, pairs]), kind="stable")
    levels.append(level)
    take = 2 * len(leaves) - 2
    for depth in range(max_bits - 1, -1, -1):
        if depth == 0:
            lengths[leaves[:take]] += 1
            break
        below = levels[depth - 1]
        pairs = below[: len(below) // 2 * 2].reshape(-1, 2).sum(axis=1)
        from_leaf = np.concatenate([np.ones(len(weights), bool), np.zeros(len(pairs), bool)])
        order = np.argsort(np.concatenate([weights, pairs]), kind="stable")
        own = int(from_leaf[order[:take]].sum())
        lengths[leaves[:own]] += 1
        take = 2 * (take - own)
    return lengths


class Code:
    """The canonical code of given lengths: words of one length count up in the order of the ids."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.bits = max(int(lengths.max(initial=1)), 1)
        steps = np.left_shift(np.int64(1), self.bits - lengths)
        starts = np.cumsum(steps) - steps
        size = int(ids.max(initial=0)) + 1
        self.word, self.length = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.word[ids] = starts >> (self.bits - lengths)
        self.length[ids] = lengths
        self.symbol_at = np.zeros(1 << self.bits, np.int32)
        self.length_at = np.ones(1 << self.bits, np.int64)
        filled = int(steps.sum())
        self.symbol_at[:filled] = np.repeat(ids, steps)
        self.length_at[:filled] = np.repeat(lengths, steps)

    def pack(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The words of several documents, each from a whole byte on, the highest bit first.

        Also the byte where each document starts (and the end of the last), and
        the bit offset of each word from the start of its document.
        """
        lengths = self.length[ids]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        first = np.cumsum(counts) - counts
        doc_bits = upto[first + counts] - upto[first]
        bounds = np.concatenate([[0], np.cumsum(-(-doc_bits // 8))])
        inside = upto[:-1] - np.repeat(upto[first], counts)
        at = inside + np.repeat(bounds[:-1] * 8, counts)
        # A word of up to 32 bits touches two 32-bit cells; a cell's words share no bit, so sums are exact in doubles.
        shifted = (self.word[ids] << (64 - lengths - (at & 31))).view(np.uint64)
        n = int(bounds[-1]) // 4 + 2
        high = np.bincount(at >> 5, (shifted >> np.uint64(32)).astype(np.float64), n)
        low = np.bincount((at >> 5) + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
        return (high + low[: len(high)]).astype(np.uint64).astype(">u4").tobytes(), bounds, inside

    def unpack(self, payload: bytes, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The ids from each bit offset on, ``counts`` many, one stretch behind the other.

        All stretches go forward together, one id each in a step: the next bits
        of each select an entry of the table that holds the id and its length.
        """
        order = np.argsort(-counts, kind="stable")
        left, at = counts[order], starts[order].astype(np.int64)
        firsts = (np.cumsum(counts) - counts)[order]
        raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        out = np.empty(int(counts.sum()), np.int32)
        # Stretches still open at each step: they are in order of falling length.
        longest = int(left[0]) if len(left) else 0
        still = np.searchsorted(-left, -np.arange(1, longest + 1), side="right")
        shift, mask = 32 - self.bits, (1 << self.bits) - 1
        for step, n in enumerate(still.tolist()):
            at = at[:n]
            entry = (window[at >> 3] >> (shift - (at & 7)).astype(np.uint32)) & mask
            out[firsts[:n] + step] = self.symbol_at[entry]
            at = at + self.length_at[entry]
        return out


# --- writing ------------------------------------------------------------------


def _dtype(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def token_ids(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """One row per document: doc_id, n_tokens and ids, packed as little-endian numbers, with the end id.

    Pieces that a worker has met before are looked up; the library encodes the others.
    """
    source = read_text(tokenizer)
    vocabulary = json_vocabulary(source)
    kind = _dtype(max(*vocabulary.ids.values(), *vocabulary.added.values(), end_id) + 1)
    shared = docs.sparkSession.sparkContext.broadcast((source, vocabulary.patterns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, memo = _library_memo(*shared.value, kind)
        lookup, end = memo.__getitem__, np.array([end_id], kind).tobytes()
        special = {i: np.array([i], kind).tobytes() for i in known.added.values()} | {None: b""}

        def packed(text: str) -> bytes:
            parts = []
            for segment, added in known.segments(text):
                parts += [*map(lookup, known.pieces(segment)), special[added]]
            return b"".join(parts) + end

        for batch in batches:
            at = 0
            for texts in texts_of(batch.column(1)):
                ids = list(map(packed, texts))
                counts = pa.array([len(p) // len(end) for p in ids], pa.int64())
                own = batch.column(0).slice(at, len(texts))
                at += len(texts)
                columns = [own, counts, pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary")


@lru_cache(maxsize=2)
def _library_memo(source: str, patterns: tuple[str, ...], kind: str):
    known = json_vocabulary(source, patterns)
    return known, Memo(lambda piece: np.array(known.library_ids(piece), kind).tobytes(), kept=KEPT_PIECES)


def id_counts(ids: DataFrame, size: int) -> DataFrame:
    """How often each id stands in the packed ids of all rows: columns id, n."""
    kind = _dtype(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for i in range(0, len(batch), 512):
                packed = b"".join(batch.column(0).slice(i, 512).to_pylist())
                total += np.bincount(np.frombuffer(packed, kind), minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "n"])

    partial = ids.select("ids").mapInArrow(run, "id long, n long")
    return partial.groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Write the ids of all documents, in ascending doc_id order, under ``path``.

    ``codebook`` holds the code length of each id. ``blocks`` holds one row per
    block, in files in the order of the ids: the ids of all documents before
    it, its documents, how many ids each has, the bit offset of each document
    and of every STRIDE-th id in it, and the bits. A document starts on a whole
    byte and stands in one block. Texts may be null (only the end id); rows
    without a doc_id come last and equal doc_ids follow their bits. An empty
    table gives an empty codebook and no block. Only doc_id (a whole number)
    and text are read.

    Every text is encoded once, into the shared folder; the code is made from
    the counts over all of them. Documents are coded before they are put in
    order, so the shuffle moves the short form.
    """
    spark = docs.sparkSession
    vocabulary = json_vocabulary(read_text(tokenizer))
    size = max(*vocabulary.ids.values(), *vocabulary.added.values(), end_id) + 1
    ids = stored(token_ids(docs, tokenizer, end_id), "token-ids")

    # At most one row per id of the vocabulary.
    counted = np.array([(r["id"], r["n"]) for r in id_counts(ids, size).collect()], np.int64).reshape(-1, 2)
    counts = np.zeros(size, np.int64)
    counts[counted[:, 0]] = counted[:, 1]
    lengths = code_lengths(counts, max(MAX_BITS, size.bit_length() if size > 1 << MAX_BITS else 0))
    used = np.flatnonzero(lengths)
    rows = [(int(i), int(lengths[i])) for i in used]
    spark.createDataFrame(rows, "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")

    slice_of, slices = id_slices(docs.select("doc_id"))
    placed = ids.withColumn("slice", slice_of)
    # One row per slice of the id order, a bounded number.
    sums = {r["slice"]: r["n"] for r in placed.groupBy("slice").agg(F.sum("n_tokens").alias("n")).collect()}
    starts = np.cumsum([0, *[sums.get(i, 0) for i in range(slices)]]).tolist()
    book = spark.sparkContext.broadcast((used, lengths[used], starts))
    kind = _dtype(size)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Code(*book.value[:2])
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.slice(i, 256)
                raw = part.column(3).to_pylist()
                counts = np.array([len(r) for r in raw]) // np.dtype(kind).itemsize
                bits, bounds, inside = own.pack(np.frombuffer(b"".join(raw), kind), counts)
                packed = [bits[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
                points = [inside[e - n : e : STRIDE] for e, n in zip(np.cumsum(counts).tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(points, pa.list_(pa.int64())), pa.array(packed, pa.binary())],
                    names=["slice", "doc_id", "n_tokens", "points", "bits"],
                )

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, at, start, own, held = book.value[2], None, 0, [], 0
        for batch in batches:
            for part, doc_id, n, points, bits in zip(*[c.to_pylist() for c in batch.columns]):
                if own and (part != at or held >= BLOCK_IDS):
                    yield _block(start, own)
                    start, own, held = start + held, [], 0
                if part != at:
                    at, start = part, starts[part]
                own.append((doc_id, n, points, bits))
                held += n
        if own:
            yield _block(start, own)

    coded = placed.select("slice", "doc_id", "n_tokens", "ids").mapInArrow(
        code, "slice int, doc_id long, n_tokens long, points array<long>, bits binary"
    )
    ordered = coded.repartitionById(slices, F.col("slice")).sortWithinPartitions(
        "slice", F.col("doc_id").asc_nulls_last(), "bits"
    )
    schema = "start long, doc_ids array<long>, counts array<long>, points array<long>, bits binary"
    ordered.mapInArrow(block, schema).write.option("compression", "none").parquet(f"{path}/blocks")


def _block(start: int, docs: list[tuple]) -> pa.RecordBatch:
    points, at = [], 0
    for _, _, own, bits in docs:
        points += [8 * at + p for p in own]
        at += len(bits)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([start], pa.int64()),
            pa.array([[d[0] for d in docs]], pa.list_(pa.int64())),
            pa.array([[d[1] for d in docs]], pa.list_(pa.int64())),
            pa.array([points], pa.list_(pa.int64())),
            pa.array([b"".join([d[3] for d in docs])], pa.binary()),
        ],
        names=["start", "doc_ids", "counts", "points", "bits"],
    )


# --- reading ------------------------------------------------------------------


def _decoded(code: Code, row: dict) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """The documents of a block: their ids, where each starts, how long it is, and all token ids."""
    counts = np.array(row["counts"], np.int64)
    per_doc = -(-counts // STRIDE)
    stretches = np.full(int(per_doc.sum()), STRIDE, np.int64)
    stretches[np.cumsum(per_doc) - 1] = counts - (per_doc - 1) * STRIDE
    tokens = code.unpack(row["bits"], np.array(row["points"], np.int64), stretches)
    return row["doc_ids"], row["start"] + np.cumsum(counts) - counts, counts, tokens


def _read(spark: SparkSession, path: str, names: list[str], kinds: list[pa.DataType], sql: str, finish) -> DataFrame:
    # At most one row per id of the vocabulary.
    book = spark.read.schema("id int, bits int").parquet(f"{path}/codebook").collect()
    shared = spark.sparkContext.broadcast((np.array([r["id"] for r in book]), np.array([r["bits"] for r in book])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = None
        for batch in batches:
            for i in range(len(batch)):
                code = code or Code(*shared.value)
                doc_ids, starts, counts, tokens = _decoded(code, batch.slice(i, 1).to_pylist()[0])
                last = finish(tokens, counts)
                columns = [doc_ids, starts, counts, last]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = "start long, doc_ids array<long>, counts array<long>, points array<long>, bits binary"
    return spark.read.schema(schema).parquet(f"{path}/blocks").mapInArrow(run, sql)


def _each(tokens: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    ends = np.cumsum(counts)
    for a, b in zip((ends - counts).tolist(), ends.tolist()):
        yield tokens[a:b]


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids."""
    names, kinds = ["doc_id", "start", "n_tokens", "ids"], [pa.int64()] * 3 + [pa.list_(pa.int32())]
    sql = "doc_id long, start long, n_tokens long, ids array<int>"
    return _read(spark, path, names, kinds, sql, lambda t, c: list(_each(t, c)))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32."""
    names, kinds = ["doc_id", "start", "n_tokens", "ids_crc32"], [pa.int64()] * 4
    sql = "doc_id long, start long, n_tokens long, ids_crc32 long"
    finish = lambda t, c: [zlib.crc32(d.astype("<u4", copy=False)) for d in _each(t, c)]
    return _read(spark, path, names, kinds, sql, finish)


def written_digests(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the documents' ids to the shared folder and digest what the files give back."""
    path = scratch_dir(docs.sparkSession, "id-files")
    write_ids(docs, path, tokenizer, end_id)
    return read_digests(docs.sparkSession, path)
