"""The trie of shared conversation prefixes, by a skeleton of range splitters and local sorted shards."""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlight.llm.mixing import word_count
from spendlight.llm.store import stored

#: A conversation starts with the first turns of the one whose id is the next lower multiple of this.
FAMILY = 20
#: Bytes of a turn in a path.
STEP = 16
#: Bytes of paths and word counts that a shard holds, about.
SHARD_BYTES = 32 << 20
#: Sampled conversations per shard, and the most bytes of the sample's paths.
SAMPLED = 20
SAMPLE_BYTES = 64 << 20
#: The most nodes of the skeleton: it is broadcast, and its aggregates come to the driver.
SKELETON_NODES = 1 << 18
#: Ids of a piece of the text behind a digest.
PIECE = 8192

NOTHING = hashlib.sha256(b"").hexdigest()


# --- paths --------------------------------------------------------------------


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """Each conversation as it is rebuilt: conv_id, path, words.

    ``path`` has STEP bytes a turn, a digest of its role and text, so that
    conversations begin alike where their paths do; ``words`` counts the words
    of each turn. A conversation's turns are one row, of about 20 bytes a turn:
    that bounds it to some 80 million turns.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turn = F.struct("turn", key.alias("key"), word_count(text).cast("int").alias("words"))
    own = (
        conversations.where("conv_id is not null")
        .select("conv_id", turn.alias("t"))
        .groupBy("conv_id")
        # Puts a null turn first.
        .agg(F.sort_array(F.collect_list("t")).alias("own"))
    )
    own = own.select("conv_id", F.col("own.key").alias("keys"), F.col("own.words").alias("words"))
    own = stored(own, "turns")
    heads = own.where(f"conv_id % {FAMILY} = 0").selectExpr(
        "conv_id as head", "slice(keys, 1, 3) as head_keys", "slice(words, 1, 3) as head_words"
    )
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    joined = own.withColumns({"head": F.expr(f"conv_id - conv_id % {FAMILY}"), "h": taken}).join(heads, "head", "left")
    spliced = lambda a, b: F.concat(
        F.coalesce(F.slice(F.col(a), F.lit(1), F.col("h")), F.slice(F.col(b), 1, 0)),
        F.expr(f"if(size({b}) > h, slice({b}, h + 1, size({b})), slice({b}, 1, 0))"),
    )
    keys, words = spliced("head_keys", "keys"), spliced("head_words", "words")
    return joined.select("conv_id", F.unhex(F.array_join(keys, "")).alias("path"), words.alias("words"))


# --- splitters ----------------------------------------------------------------


def splitters(paths: DataFrame, shards: int | None = None) -> list[tuple[bytes, int]]:
    """Ascending (path, conv_id) that cut all conversations into ranges of about equal numbers.

    Taken from a sample by hash of the id whose bytes are counted before it is
    collected. Ids are part of a splitter, so copies of one conversation are
    spread over shards. The paths of all splitters have SKELETON_NODES prefixes
    at most; where they would have more, the longest go.
    """
    size = F.sum(F.length("path") + 4 * F.size("words") + 8)
    n, total = paths.agg(F.count("*"), size).first()
    partitions = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = shards or max(partitions, math.ceil((total or 0) / SHARD_BYTES))
    if not n or shards < 2:
        return []
    slots = 1 << 30
    rate = min(1.0, SAMPLED * shards / n, SAMPLE_BYTES / total)
    while True:
        sample = paths.where(F.pmod(F.xxhash64("conv_id"), F.lit(slots)) < int(rate * slots) + 1)
        if (sample.agg(F.sum(F.length("path"))).first()[0] or 0) <= 2 * SAMPLE_BYTES:
            break
        rate /= 2
    found = sorted((bytes(r.path), r.conv_id) for r in sample.select("path", "conv_id").collect())
    chosen = sorted({len(found) * i // shards for i in range(1, shards)}) if found else []
    kept, seen = [], {}
    for at in sorted(chosen, key=lambda i: len(found[i][0])):
        if len(seen) + len(found[at][0]) // STEP <= SKELETON_NODES:
            _add_path(seen, found[at][0])
            kept.append(found[at])
    return sorted(kept)


def _add_path(nodes: dict, path: bytes) -> None:
    at = 0
    for i in range(0, len(path), STEP):
        at = nodes.setdefault((at, path[i : i + STEP]), len(nodes) + 1)


def skeleton_of(cuts: list[tuple[bytes, int]]) -> dict[tuple[int, bytes], int]:
    """The trie of the splitters' paths: (parent, turn) to node; 0 is the root and parents have smaller numbers."""
    nodes = {}
    for path, _ in cuts:
        _add_path(nodes, path)
    return nodes


# --- shards -------------------------------------------------------------------

NODES = (
    "conv_id long, depth long, parent_conv_id long, parent_node int, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, ends_sha256 string"
)
LOCAL = pa.schema(
    [
        ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("parent_node", pa.int32()),
        ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()), ("node", pa.int32()), ("words", pa.int64()), ("shard", pa.int32()),
        ("ids", pa.string()),
    ]
)
LOCAL_DDL = NODES + ", node int, words long, shard int, ids string"


class _Open:
    """A node on the way to the current conversation."""

    __slots__ = ("skeleton", "words", "least", "convs", "children", "leaves", "saved", "ends", "rows")

    def __init__(self, skeleton: int | None, words: int):
        self.skeleton, self.words, self.least = skeleton, words, None
        self.convs = self.children = self.leaves = self.saved = 0
        #: A running digest, or for a node of the skeleton the ids not yet written.
        self.ends = None if skeleton is None else []
        #: Finished children that wait for this node's smallest member.
        self.rows = []


class _Shard:
    """Walks the conversations of one shard in the order of their paths and ids."""

    def __init__(self, shard: int, skeleton: dict):
        self.shard, self.skeleton, self.before, self.out = shard, skeleton, b"", []
        self.open = [_Open(0, 0)]

    def add(self, conv_id: int, path: bytes, words: list[int]) -> None:
        same, depth = 0, len(path) // STEP
        if path == self.before:
            same = depth
        else:
            most = min(depth, len(self.open) - 1)
            a, b = memoryview(path), memoryview(self.before)
            while same < most and a[same * STEP :][:STEP] == b[same * STEP :][:STEP]:
                same += 1
        while len(self.open) - 1 > same:
            self._close()
        for d in range(same, depth):
            above = self.open[-1].skeleton
            node = None if above is None else self.skeleton.get((above, path[d * STEP : d * STEP + STEP]))
            self.open.append(_Open(node, words[d]))
        top = self.open[-1]
        top.convs += 1
        top.least = conv_id if top.least is None else min(top.least, conv_id)
        if top.skeleton is not None:
            top.ends.append(str(conv_id))
            if len(top.ends) == PIECE:
                self._write_ends(top)
        elif top.ends is None:
            top.ends = hashlib.sha256(str(conv_id).encode())
        else:
            top.ends.update(b",%d" % conv_id)
        self.before = path

    def _write_ends(self, node: _Open) -> None:
        if node.ends:
            self.out.append({"node": node.skeleton, "shard": self.shard, "ids": ",".join(node.ends),
                             "conv_id": int(node.ends[0])})
            node.ends = []

    def _close(self) -> None:
        node = self.open.pop()
        above = self.open[-1] if self.open else None
        if above:
            above.convs += node.convs
            above.least = node.least if above.least is None else min(above.least, node.least)
        if node.skeleton is not None:
            self._write_ends(node)
            self.out.append({
                "node": node.skeleton, "conv_id": node.least, "depth": len(self.open), "n_convs": node.convs,
                "n_children": node.children, "n_leaves": node.leaves, "saved_tokens": node.saved, "words": node.words,
            })
            return
        for row in node.rows:
            row["parent_conv_id"] = node.least
            self.out.append(row)
        row = {
            "conv_id": node.least, "depth": len(self.open), "n_convs": node.convs, "n_children": node.children,
            "n_leaves": node.leaves or 1, "saved_tokens": node.saved + (node.convs - 1) * node.words,
            "ends_sha256": node.ends.hexdigest() if node.ends else NOTHING,
        }
        above.children += 1
        above.leaves += row["n_leaves"]
        above.saved += row["saved_tokens"]
        if above.skeleton is None:
            above.rows.append(row)
        else:
            row["parent_node"] = above.skeleton
            self.out.append(row)

    def finish(self) -> None:
        while self.open:
            self._close()

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        while len(self.out) >= max(least, 1):
            rows, self.out = self.out[:20_000], self.out[20_000:]
            yield pa.RecordBatch.from_pylist(rows, LOCAL)


def _walked(cut: DataFrame, skeleton: dict) -> DataFrame:
    """What the sorted shards give: finished nodes, partial aggregates of skeleton nodes, and their ids in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for i in range(0, len(batch), 256):
                for row in batch.slice(i, 256).to_pylist():
                    if shard is None or shard.shard != row["shard"]:
                        if shard:
                            shard.finish()
                            yield from shard.batches(1)
                        shard = _Shard(row["shard"], skeleton)
                    shard.add(row["conv_id"], row["path"], row["words"])
                yield from shard.batches(20_000)
        if shard:
            shard.finish()
            yield from shard.batches(1)

    return cut.mapInArrow(run, LOCAL_DDL)


def _cut(paths: DataFrame, cuts: list[tuple[bytes, int]]) -> DataFrame:
    """Conversations with their shard, each shard in one task and in order there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 256):
                own = batch.slice(i, 256)
                places = zip(own.column(1).to_pylist(), own.column(0).to_pylist())
                shards = pa.array([bisect_right(cuts, place) for place in places], pa.int32())
                yield pa.RecordBatch.from_arrays([*own.columns, shards], names=["conv_id", "path", "words", "shard"])

    found = paths.select("conv_id", "path", "words").mapInArrow(
        run, "conv_id long, path binary, words array<int>, shard int"
    )
    return found.repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")


# --- the skeleton -------------------------------------------------------------


def _digests(walked: DataFrame) -> DataFrame:
    """node, ends_sha256 of the skeleton nodes at which conversations end.

    A digest is one chain over all ids, so the pieces of a node are streamed
    through one task in order, PIECE ids a row; nothing is gathered there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = digest = None
        out = []
        for batch in batches:
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n != node:
                    if digest:
                        out.append((node, digest.hexdigest()))
                    node, digest = n, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if digest:
            out.append((node, digest.hexdigest()))
        for i in range(0, len(out), 10_000):
            n, found = zip(*out[i : i + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(found)], names=["node", "ends_sha256"])

    pieces = walked.where("ids is not null").select("node", "ids", "shard", "conv_id")
    ordered = pieces.repartition("node").sortWithinPartitions("node", "shard", "conv_id")
    return ordered.select("node", "ids").mapInArrow(run, "node int, ends_sha256 string")


def _skeleton_rows(walked: DataFrame, skeleton: dict) -> list[tuple]:
    """The skeleton's nodes, their partial aggregates reduced and summed up from the leaves; SKELETON_NODES at most.

    node, then the columns of the result but for the digest.
    """
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = walked.where("node is not null and ids is null").groupBy("node")
    known = [F.min("conv_id").alias("least"), F.max("depth").alias("depth"), F.max("words").alias("words")]
    reduced = parts.agg(*known, *sums)
    found = {r.node: r for r in reduced.collect()}
    if not found:
        return []
    parent = {node: above for (above, _), node in skeleton.items()}
    children = {n: r.n_children for n, r in found.items()}
    for n in found:
        if n:
            children[parent[n]] += 1
    leaves = {n: r.n_leaves for n, r in found.items()}
    saved = {n: r.saved_tokens + (r.n_convs - 1) * r.words for n, r in found.items()}
    for n in sorted(found, reverse=True):
        leaves[n] = leaves[n] if children[n] else 1
        if n:
            leaves[parent[n]] += leaves[n]
            saved[parent[n]] += saved[n]
    return [
        (n, r.least, r.depth, found[parent[n]].least if n else None, r.n_convs, children[n], leaves[n], saved[n])
        for n, r in found.items()
    ]


def prefix_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are cut into ranges of (path, id) by sampled splitters. The
    trie of the splitters' paths, the skeleton, is broadcast: a node outside it
    has all its members in one shard, which finishes it while it walks its
    sorted rows; for a node of the skeleton each shard gives a partial
    aggregate, and these are reduced. Finished children of an open node wait
    for its smallest member, so a task holds a shard's nodes at most.

    Turns are ordered by turn, null first; equal ones by the digest of role
    and text. A null role or text is empty. Rows without a conv_id are left
    out; repeated rows are turns of their own. Negative ids count up to zero for
    the conversation they start with, as SQL's remainder does. Without any
    conversation there is no node. Only conv_id, turn, role and text are read.
    """
    paths = stored(rebuilt_paths(conversations), "paths")
    cuts = splitters(paths, shards)
    skeleton = skeleton_of(cuts)
    walked = stored(_walked(_cut(paths, cuts), skeleton), "shards")
    spark = conversations.sparkSession
    rows = _skeleton_rows(walked, skeleton)
    upper = spark.createDataFrame(
        rows,
        "node int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
        " saved_tokens long",
    )
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    digests = _digests(walked)
    top = upper.join(digests, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    # The skeleton has SKELETON_NODES nodes at most.
    above = F.broadcast(upper.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("upper_conv_id")))
    local = walked.where("node is null").join(above, "parent_node", "left")
    local = local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "upper_conv_id"))
    return top.select(names).unionByName(local.select(names))


def oracle() -> str:
    """The same nodes as DuckDB SQL, from all prefixes of all conversations."""
    return r"""
    with recursive turns as (
        select conv_id, turn, md5(length(r)::varchar || ':' || r || x) as k,
               len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) as w
        from (select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as x from conversations)
        where conv_id is not null
    ), placed as (
        select conv_id, k, w, row_number() over (partition by conv_id order by turn nulls first, k) as pos from turns
    ), bits(i, step, c) as (
        select i, 0, i from range(256) t(i)
        union all
        select i, step + 1, xor(c >> 1, case when c % 2 = 1 then 3988292384 else 0 end) from bits where step < 8
    ), crc_table as (
        select list(c order by i) as crcs from bits where step = 8
    ), convs as (
        select conv_id, conv_id - conv_id % 20 as head,
               xor(list_reduce(
                   list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda ch: ascii(ch)::bigint)),
                   lambda a, b: xor(a >> 8, crcs[xor(a & 255, b) + 1])), 4294967295) % 4 as h
        from (select distinct conv_id from placed) cross join crc_table
    ), rebuilt as (
        select c.conv_id, 0 as part, p.pos, p.k, p.w from convs c join placed p on p.conv_id = c.head and p.pos <= c.h
        union all
        select c.conv_id, 1, p.pos, p.k, p.w from convs c join placed p on p.conv_id = c.conv_id and p.pos > c.h
    ), prefixes as (
        select conv_id, string_agg(k, '') over w as path, row_number() over w as d, w as words
        from rebuilt window w as (partition by conv_id order by part, pos)
        union all
        select conv_id, '', 0, 0 from convs
    ), nodes as (
        select path, d, min(conv_id) as conv_id, count(*) as n, max(words) as words from prefixes group by path, d
    ), ends as (
        select path, string_agg(conv_id::varchar, ',' order by conv_id) as ids
        from (select conv_id, max_by(path, d) as path from prefixes group by conv_id) group by path
    ), kids as (
        select left(path, length(path) - 32) as path, count(*) as n_children from nodes where d > 0 group by 1
    ), below as (
        select a.path, sum(case when k.path is null then 1 else 0 end) as n_leaves, sum((b.n - 1) * b.words) as saved
        from nodes a join nodes b on starts_with(b.path, a.path) left join kids k on k.path = b.path group by a.path
    )
    select a.conv_id, a.d::bigint as depth, u.conv_id as parent_conv_id, a.n::bigint as n_convs,
           coalesce(k.n_children, 0)::bigint as n_children, b.n_leaves::bigint as n_leaves,
           b.saved::bigint as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
    from nodes a join below b on b.path = a.path
    left join nodes u on a.d > 0 and u.path = left(a.path, length(a.path) - 32) and u.d = a.d - 1
    left join kids k on k.path = a.path
    left join ends e on e.path = a.path
    """
