"""Byte-level BPE in linear time: longest matches, backtracking, and compatible neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spendlight.llm.pretokens import NEVER, Memo, Splitter, merged, read_ranks, texts_of, unicode_patterns

#: Pieces of each of two generations, and token pairs whose compatibility a worker remembers.
KEPT_PIECES = 250_000
KEPT_PAIRS = 300_000


class Encoder:
    """Encodes pieces by a table of ranks; one per worker.

    A sequence of tokens is what merging would give exactly if every two
    neighbours are what merging gives for their joined bytes. So a piece is
    covered from the left with the longest token at each place; a token that
    doesn't fit the one before is shortened to the next token that is a prefix
    of it, and where none is left the last token is taken back. An end that was
    taken back is dead and never tried again, which keeps the work linear.
    """

    def __init__(self, ranks: dict[bytes, int], patterns: tuple[str, ...] | None = None):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        # Texts that end where a token starts: tokens are stored from back to front, as Latin-1 characters.
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token[::-1].decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.prefix: dict[int, int] = {}
        self.fits: dict[int, bool] = {}
        self.memo = Memo(lambda piece: np.array(self.encode_piece(piece.encode()), "<u4").tobytes(), kept=KEPT_PIECES)
        self.pieces = Splitter(patterns or unicode_patterns()).pieces

    def merge(self, piece: bytes) -> list[int]:
        """Plain merging, for the two tokens of a pair."""
        get = self.ranks.get
        parts = merged([piece[i : i + 1] for i in range(len(piece))], lambda a, b: get(a + b, NEVER))
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        found = self.fits.get(key)
        if found is None:
            found = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            if len(self.fits) >= KEPT_PAIRS:
                self.fits.clear()
            self.fits[key] = found
        return found

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of this one; -1 if none is."""
        found = self.prefix.get(token)
        if found is None:
            text, get = self.bytes_of[token], self.ranks.get
            found = next((r for n in range(len(text) - 1, 0, -1) if (r := get(text[:n])) is not None), -1)
            self.prefix[token] = found
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        if not n:
            return []
        longest = [-1] * n
        last = -1
        for end, token in self.automaton.iter(piece[::-1].decode("latin-1")):
            if end != last:  # the longest of those that end here comes first
                longest[n - 1 - end] = token
                last = end
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, longest[0]
        while at < n:
            if token < 0:  # nothing fits here: take the last token back and shorten it
                if not out:
                    raise ValueError("the vocabulary lacks a byte of the text")
                dead[at] = 1
                token = out.pop()
                at -= len(self.bytes_of[token])
                token = self.shorter(token)
                continue
            end = at + len(self.bytes_of[token])
            if not dead[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            else:
                token = self.shorter(token)
        return out

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.memo.__getitem__, self.pieces(text))), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def _built(key: str, ranks) -> Encoder:
    return Encoder(*ranks.value)


class _Shared:
    """The ranks of a file as a broadcast, and the encoder that a worker builds of them once."""

    def __init__(self, df: DataFrame, path: str):
        ranks = read_ranks(path)
        self.key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
        self.ranks = df.sparkSession.sparkContext.broadcast((ranks, unicode_patterns()))

    def __getstate__(self):
        return self.key, self.ranks

    def __setstate__(self, state):
        self.key, self.ranks = state

    def __hash__(self):
        return hash(self.key)

    def __eq__(self, other):
        return self.key == other.key

    @property
    def value(self) -> tuple[dict[bytes, int], tuple[str, ...]]:
        return self.ranks.value

    def encoder(self) -> Encoder:
        return _built(self.key, self)


def encode(docs: DataFrame, ranks: str) -> DataFrame:
    """One row per document: doc_id and ids, an array of whole numbers.

    ``ranks`` is the driver's path to a rank file, which goes to the executors
    as a broadcast bounded by the vocabulary. Each piece of a text is encoded
    apart, special strings are plain text, null texts are empty. Only doc_id
    and text are read; ids may be null or repeat. Nothing is shuffled.
    """
    shared = _Shared(docs, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.encoder()
        for batch in batches:
            at = 0
            for texts in texts_of(batch.column(1)):
                found = [encoder.encode(t) for t in texts]
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids], names=["doc_id", "ids"])
                at += len(texts)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def _id_lists(column: pa.Array) -> Iterator[np.ndarray]:
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    missing = column.is_null().to_pylist() if column.null_count else None
    for i in range(len(column)):
        yield values[ends[i] : ends[i + 1]] if not (missing and missing[i]) else values[:0]


def _mapped(encoded: DataFrame, ranks: str, columns: dict[str, tuple[pa.DataType, str]], work) -> DataFrame:
    shared = _Shared(encoded, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.encoder()
        for batch in batches:
            rows = [work(encoder, ids) for ids in _id_lists(batch.column(1))]
            arrays = [pa.array([r[i] for r in rows], kind) for i, (kind, _) in enumerate(columns.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *columns])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *[f"{name} {sql}" for name, (_, sql) in columns.items()]])
    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """One row per row of doc_id and ids: doc_id and the bytes of its ids; null ids give no bytes."""
    return _mapped(encoded, ranks, {"decoded": (pa.binary(), "binary")}, lambda e, ids: (e.decode(ids),))


def round_trip_digests(encoded: DataFrame, ranks: str) -> DataFrame:
    """One row per row of doc_id and ids: n_tokens, and digests of the ids and of the bytes they decode to."""
    hexed = lambda b: hashlib.sha256(b).hexdigest()
    return _mapped(
        encoded,
        ranks,
        {
            "n_tokens": (pa.int64(), "long"),
            "ids_sha256": (pa.string(), "string"),
            "decoded_sha256": (pa.string(), "string"),
        },
        lambda e, ids: (len(ids), hexed(ids.astype("<u4").tobytes()), hexed(e.decode(ids))),
    )
