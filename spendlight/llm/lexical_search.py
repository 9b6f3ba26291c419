"""Ranked lexical search by Block-Max MaxScore over compressed posting lists, shard by shard."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlight.llm.store import stored

#: Characters below 128 that part terms, and the numbers of the score.
APART = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
UNIT, TF_FACTOR, LENGTH_FACTOR, PERCENT = 1_000_000_000, 1000, 8, 75
BEST = 10

#: Postings of a block, and the documents and postings that fill a shard.
BLOCK = 128
SHARD_DOCS = 1 << 14
SHARD_POSTINGS = 1 << 21
#: Postings of the essential lists that are scored at a time.
WINDOW = 1 << 14
#: The most terms of the queries that one search takes; more queries are searched in several.
VOCABULARY = 1 << 19
#: Bytes of postings of documents that are held before they are passed on.
CHUNK = 1 << 22

# --- terms --------------------------------------------------------------------

_LOWERED = bytes(32 if b in APART else b + 32 if 65 <= b <= 90 else b for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order: runs of all characters but APART, with A-Z in lower case."""
    # Bytes of longer characters are 128 and more, so a run of bytes is a run of characters.
    return text.translate(_LOWERED).split()


def _forward(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document: doc_id, n (its terms with repeats), terms (numbers of those in the vocabulary, ascending), tfs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            at, held, rows = 0, 0, []
            for i in range(len(batch)):
                text = batch.column(1)[i].as_buffer()
                words = terms_of(text.to_pybytes()) if text is not None else []
                known = [k for k in map(number, words) if k is not None]
                terms, tfs = np.unique(np.array(known, np.int32), return_counts=True)
                rows.append((len(words), terms, tfs))
                held += 8 * len(terms) + 64
                if held > CHUNK or i + 1 == len(batch):
                    ns, terms, tfs = zip(*rows)
                    ends = np.cumsum([0, *map(len, terms)], dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(at, len(rows)),
                            pa.array(ns, pa.int64()),
                            pa.ListArray.from_arrays(ends, np.concatenate(terms).astype(np.int32)),
                            pa.ListArray.from_arrays(ends, np.concatenate(tfs).astype(np.int32)),
                        ],
                        names=["doc_id", "n", "terms", "tfs"],
                    )
                    at, held, rows = i + 1, 0, []

    found = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return found.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


# --- the index ----------------------------------------------------------------


def packed(docs: np.ndarray, tfs: np.ndarray) -> bytes:
    """Ascending places and frequencies of a block as gaps and values less one, in 7-bit groups."""
    gaps = np.diff(docs, prepend=docs[0])
    values = np.concatenate([gaps, tfs - 1]).astype(np.uint64)
    groups = np.maximum(1, -(-np.frexp(values.astype(np.float64))[1] // 7))
    firsts = np.cumsum(groups) - groups
    shift = np.arange(groups.sum()) - np.repeat(firsts, groups)
    out = (np.repeat(values, groups) >> (7 * shift).astype(np.uint64)).astype(np.uint8) & 0x7F
    out[np.arange(len(out)) != np.repeat(firsts + groups - 1, groups)] |= 0x80
    return out.tobytes()


def unpacked(data: bytes, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and frequencies of a block whose first place is given."""
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 0x80)
    firsts = np.concatenate([[0], last[:-1] + 1])
    shift = np.arange(len(raw)) - np.repeat(firsts, last - firsts + 1)
    values = np.add.reduceat((raw & 0x7F).astype(np.int64) << (7 * shift), firsts)
    half = len(values) // 2
    return first + np.cumsum(values[:half]), values[half:] + 1


SHARD = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("terms", pa.list_(pa.int32())),
        ("dfs", pa.list_(pa.int64())), ("blocks", pa.list_(pa.int32())), ("firsts", pa.list_(pa.int32())),
        ("lasts", pa.list_(pa.int32())), ("tops", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())),
        ("data", pa.large_binary()),
    ]
)
SHARD_DDL = (
    "doc_ids array<long>, lengths array<long>, terms array<int>, dfs array<long>, blocks array<int>,"
    " firsts array<int>, lasts array<int>, tops array<long>, starts array<long>, data binary"
)


def impacts(tfs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What an occurrence count adds in a document of the length factor m, before the term's weight."""
    return (UNIT * tfs) // (TF_FACTOR * tfs + LENGTH_FACTOR * lengths)


def _shard_of(
    doc_ids: list, ns: np.ndarray, terms: np.ndarray, tfs: np.ndarray, of: np.ndarray, docs_n: int, all_terms: int
) -> pa.RecordBatch:
    """One row of the index: posting lists of the shard's documents, in the order of their ids.

    Each block has its first and last place, its start in ``data`` and the
    largest impact in it.
    """
    order = np.array(sorted(range(len(doc_ids)), key=lambda i: (doc_ids[i] is None, doc_ids[i] or 0)), np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    lengths = (100 - PERCENT) + (PERCENT * ns[order] * docs_n) // max(all_terms, 1)
    of = place[of]
    by = np.lexsort((of, terms))
    terms, of, tfs = terms[by], of[by], tfs[by].astype(np.int64)
    worth = impacts(tfs, lengths[of])
    heads = np.flatnonzero(np.diff(terms, prepend=-1)) if len(terms) else np.empty(0, np.int64)
    dfs = np.diff(np.append(heads, len(terms)))
    blocks = -(-dfs // BLOCK)
    inside = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = np.repeat(heads, blocks) + BLOCK * inside
    end = np.minimum(begin + BLOCK, np.repeat(heads + dfs, blocks))
    data = [packed(of[a:b], tfs[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
    tops = np.maximum.reduceat(worth, begin) if len(begin) else worth
    row = [
        [doc_ids[i] for i in order], lengths, terms[heads], dfs, blocks, of[begin], of[end - 1], tops,
        np.cumsum([0, *map(len, data)]), b"".join(data),
    ]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, SHARD)], schema=SHARD)


def _indexed(forward: DataFrame, docs_n: int, all_terms: int) -> DataFrame:
    """Shards of the index, cut from the rows of each task in turn; no row leaves its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, postings = [], 0, 0

        def shard():
            table = pa.Table.from_batches(held)
            terms, tfs = (table.column(c).combine_chunks() for c in ("terms", "tfs"))
            terms, tfs = (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (terms, tfs))
            sizes = np.diff(terms.offsets.to_numpy())
            return _shard_of(
                table.column("doc_id").to_pylist(), table.column("n").to_numpy(),
                terms.flatten().to_numpy(), tfs.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes),
                docs_n, all_terms,
            )

        for batch in batches:
            for i in range(0, len(batch), 64):
                part = batch.slice(i, 64)
                held.append(part)
                docs, postings = docs + len(part), postings + len(part.column(2).flatten())
                if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                    yield shard()
                    held, docs, postings = [], 0, 0
        if held:
            yield shard()

    return forward.where("size(terms) > 0").mapInArrow(run, SHARD_DDL)


# --- search -------------------------------------------------------------------


class _List:
    """The posting list of a term in a shard, with the query's weight for it."""

    def __init__(self, shard: dict, at: int, weight: int):
        a, b = shard["bounds"][at], shard["bounds"][at + 1]
        self.shard, self.weight, self.at = shard, weight, a
        self.firsts, self.lasts, self.tops = shard["firsts"][a:b], shard["lasts"][a:b], shard["tops"][a:b]
        self.size, self.top = int(shard["dfs"][at]), int(self.tops.max())

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and what they add, opened once per shard."""
        opened, k = self.shard["opened"], self.at + int(i)
        if k not in opened:
            starts = self.shard["starts"]
            places, tfs = unpacked(self.shard["data"][starts[k] : starts[k + 1]], int(self.firsts[i]))
            opened[k] = places, impacts(tfs, self.shard["lengths"][places])
        return opened[k]


class _Heap:
    """The best of a query so far, by score and then place."""

    def __init__(self, best: int):
        self.best, self.rows = best, []

    def floor(self) -> int:
        """What a later document has to exceed."""
        return self.rows[0][0] if len(self.rows) == self.best else 0

    def offer(self, scores: np.ndarray, places: np.ndarray) -> None:
        picked = np.flatnonzero(scores > self.floor())
        if len(picked) > self.best:
            # The best of these, the earlier place first among equals.
            picked = picked[np.lexsort((places[picked], -scores[picked]))[: self.best]]
        for score, place in sorted(zip(scores[picked].tolist(), places[picked].tolist()), key=lambda p: p[1]):
            if len(self.rows) < self.best:
                heapq.heappush(self.rows, (score, -place))
            elif score > self.rows[0][0]:
                heapq.heapreplace(self.rows, (score, -place))


def search_shard(
    shard: dict, query: list[tuple[int, int]], best: int, counts: dict | None = None
) -> list[tuple[int, int]]:
    """The best (place, score) of a shard for a query of (list number in the shard, weight).

    Lists stand in the order of their largest possible share. As long as the
    first of them together can't exceed the floor of the heap they are not
    essential: a document must stand in one of the others to count. Documents
    of the essential lists are scored in windows of ascending places; each is
    then looked up in the other lists, the largest first, unless its score, the
    block's largest share and what the lists left can add stay at the floor.
    Only blocks that some document still needs are opened. Places ascend with
    the ids, so a later document of an equal score never replaces one.
    """
    lists = sorted((_List(shard, at, w) for at, w in query if w), key=lambda x: x.weight * x.top)
    heap = _Heap(best)
    if not lists:
        return []
    upto = np.cumsum([x.weight * x.top for x in lists])
    end, docs, tried = 0, len(shard["lengths"]), 0
    while end < docs:
        floor = heap.floor()
        essential = int(np.searchsorted(upto, floor, side="right"))
        if essential == len(lists):
            break
        # The window ends where the essential lists have given about WINDOW postings.
        start, wanted = end, sum(x.size for x in lists[essential:])
        end = docs if wanted <= WINDOW else min(docs, start + max(BLOCK, docs * WINDOW // wanted))
        if not tried:
            # The first window is small: it gives the floor that later ones are held against.
            end = min(end, max(BLOCK, docs // 16))
        tried += 1
        scores = np.zeros(end - start, np.int64)
        for x in lists[essential:]:
            low, high = np.searchsorted(x.lasts, start), np.searchsorted(x.firsts, end)
            for i in range(low, high):
                places, worth = x.block(i)
                a, b = np.searchsorted(places, (start, end))
                scores[places[a:b] - start] += x.weight * worth[a:b]
        found = np.flatnonzero(scores)
        scores, found = scores[found], found + start
        for k in range(essential - 1, -1, -1):
            x = lists[k]
            on = scores + upto[k] > floor
            scores, found = scores[on], found[on]
            if not len(found):
                break
            block = np.searchsorted(x.lasts, found)
            inside = np.minimum(block, len(x.lasts) - 1)
            holds = (block < len(x.lasts)) & (x.firsts[inside] <= found)
            share = np.where(holds, x.weight * x.tops[inside], 0)
            left = upto[k - 1] if k else 0
            on = scores + share + left > floor
            scores, found, block, holds = scores[on], found[on], block[on], holds[on]
            for i in np.unique(block[holds]).tolist():
                places, worth = x.block(i)
                a, b = np.searchsorted(block, (i, i + 1))
                at = np.minimum(np.searchsorted(places, found[a:b]), len(places) - 1)
                scores[a:b] += np.where(places[at] == found[a:b], x.weight * worth[at], 0)
        heap.offer(scores, found)
    if counts is not None:
        counts["opened"] = counts.get("opened", 0) + len(shard["opened"])
        counts["blocks"] = counts.get("blocks", 0) + sum(len(x.tops) for x in lists)
    return [(-place, score) for score, place in heap.rows]


def opened_shard(row: dict) -> dict:
    """A row of the index as arrays, for ``search_shard``."""
    shard = {k: np.array(row[k], np.int64) for k in ("lengths", "dfs", "firsts", "lasts", "tops", "starts")}
    bounds = np.concatenate([[0], np.cumsum(row["blocks"])]).astype(np.int64)
    return shard | {
        "doc_ids": row["doc_ids"], "bounds": bounds, "data": row["data"], "opened": {},
        "number": {t: i for i, t in enumerate(row["terms"])},
    }


def _searched(index: DataFrame, items: list[tuple[int, list[tuple[int, int]]]], best: int) -> DataFrame:
    """The best of each shard for each query: item, doc_id, score. ``items`` are (number, [(term, weight)])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                shard = opened_shard(batch.slice(i, 1).to_pylist()[0])
                number, out = shard["number"], []
                for item, query in items:
                    own = [(number[t], w) for t, w in query if t in number]
                    out += [(item, shard["doc_ids"][p], s) for p, s in search_shard(shard, own, best)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*out)], names=["item", "doc_id", "score"]
                    )

    return index.mapInArrow(run, "item long, doc_id long, score long")


def _item_batches(items: DataFrame) -> list[DataFrame]:
    """Queries in parts whose terms fit VOCABULARY. ``items`` has item_id and words."""
    n = items.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = max(1, math.ceil(n / VOCABULARY))
    if parts == 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == i) for i in range(parts)]


def query_terms(items: DataFrame) -> DataFrame:
    """item_id, words and their counts of each query; the texts of rows of one item_id are one query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [terms_of((t or "").encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lists, pa.list_(pa.binary()))], names=["item_id", "words"]
            )

    texts = items.groupBy("item_id").agg(F.array_join(F.array_sort(F.collect_set("text")), "\n").alias("text"))
    return texts.mapInArrow(run, "item_id long, words array<binary>")


def ranked(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """The ``best`` documents of each item: item_id, rank, doc_id, score.

    Documents are cut into terms once; those of the queries are kept with their
    counts, from which N, L and df are taken. Each task then cuts its documents
    into shards of the index, which are written and searched each on its own;
    the heaps of the shards are merged by item. The terms of the queries
    travel with the tasks: VOCABULARY at most, more queries are searched in parts.

    A null text has no terms, like an empty one. Equal rows are documents of
    their own; equal scores are ranked by doc_id, null last. Repeated rows of an
    item count once, different texts of one item_id are taken together, and an
    item that no document matches has no row. Other columns are not read.
    """
    queries = stored(query_terms(items.select("item_id", "text")), "queries")
    found = [_ranked(docs, part, best) for part in _item_batches(queries)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _ranked(docs: DataFrame, queries: DataFrame, best: int) -> DataFrame:
    # VOCABULARY terms at most, by _item_batches.
    rows = [(r.item_id, [bytes(w) for w in r.words]) for r in queries.collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, words in rows for w in words}))}
    forward = stored(_forward(docs, vocabulary), "term-counts")
    counted = forward.where("n > 0").agg(F.count("*").alias("n"), F.sum("n").alias("terms")).first()
    docs_n, all_terms = counted.n, counted.terms or 0
    index = stored(_indexed(forward, docs_n, all_terms), "index")
    lists = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t"))
    held = lists.groupBy("t.terms").agg(F.sum("t.dfs").alias("df"))
    weight = {
        r.terms: math.floor(1000 * math.log((2 * docs_n + 2) / (2 * r.df + 1))) for r in held.collect()
    }
    asked = []
    for i, (_, words) in enumerate(rows):
        own: dict[int, int] = {}
        for w in words:
            if (t := vocabulary[w]) in weight:
                own[t] = own.get(t, 0) + weight[t]
        asked.append((i, sorted(own.items())))
    merged = _searched(index, asked, best)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    numbered = [(i, item) for i, (item, _) in enumerate(rows)]
    names = docs.sparkSession.createDataFrame(numbered, "item long, item_id long")
    return top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def oracle() -> str:
    """The same ranks as DuckDB SQL, from the scores of all documents."""
    return r"""
    with terms as (
        select rid, doc_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from (select row_number() over () as rid, doc_id, text from documents)
    ), lengths as (
        select rid, count(*) as n from terms group by rid
    ), totals as (
        select count(*) as docs_n, sum(n)::hugeint as all_terms from lengths
    ), counts as (
        select rid, doc_id, term, count(*) as tf from terms group by rid, doc_id, term
    ), weights as (
        select term, floor(1000 * ln((2 * any_value(docs_n) + 2) / (2 * count(*) + 1)))::bigint as w
        from counts cross join totals group by term
    ), asked as (
        select item_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from (select distinct item_id, text from benchmark)
    ), repeats as (
        select item_id, term, count(*) as times from asked group by item_id, term
    ), scored as (
        select q.item_id, c.rid, c.doc_id,
               sum(q.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (25 + ((75 * l.n * docs_n) // all_terms))))
               )::bigint as score
        from repeats q join counts c using (term) join weights w using (term) join lengths l on l.rid = c.rid
        cross join totals group by q.item_id, c.rid, c.doc_id
    ), placed as (
        select item_id, doc_id, score,
               row_number() over (partition by item_id order by score desc, doc_id nulls last) as place
        from scored where score > 0
    )
    select item_id, place::int as rank, doc_id, score from placed where place <= 10
    """
