"""Token counts with a shortcut for pieces that are one token."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from spendlight.llm.pretokens import JsonVocabulary, Memo, byte_chars, json_vocabulary, read_text, texts_of

#: A piece's tokens stand in the low bits of its entry, whether it is a whole token above them.
WHOLE = 1 << 40


def whole_tokens(vocabulary: JsonVocabulary) -> list[str]:
    """The vocabulary strings proven to encode alone as one token.

    A string counts if it is valid text, the splitter leaves it in one piece,
    and merging its bytes ends in one part. Strings that fail (broken UTF-8,
    several pieces, merges that end elsewhere) are left to the merging.
    """
    back = {c: b for b, c in enumerate(byte_chars())}
    found = []
    for token in vocabulary.ids:
        try:
            piece = bytes(back[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if vocabulary.pieces(piece) == [piece] and len(vocabulary.merge(piece)) == 1:
            found.append(piece)
    return found


class Counter:
    """Counts the tokens of texts; one per worker."""

    def __init__(self, vocabulary: JsonVocabulary, whole: frozenset[str]):
        self.vocabulary = vocabulary
        self.memo = Memo(lambda piece: len(vocabulary.merge(piece)), dict.fromkeys(whole, WHOLE + 1))

    def count(self, text: str) -> tuple[int, int, int]:
        """Tokens, pieces, and pieces that are whole tokens."""
        tokens = pieces = whole = 0
        lookup = self.memo.__getitem__
        for segment, added in self.vocabulary.segments(text):
            found = self.vocabulary.pieces(segment)
            packed = sum(map(lookup, found))
            tokens += packed % WHOLE + (added is not None)
            whole += packed // WHOLE
            pieces += len(found)
        return tokens, pieces, whole


@lru_cache(maxsize=2)
def _counter(source: str, patterns: tuple[str, ...], whole: frozenset[str]) -> Counter:
    return Counter(json_vocabulary(source, patterns), whole)


@lru_cache(maxsize=2)
def _proof(source: str) -> frozenset[str]:
    return frozenset(whole_tokens(json_vocabulary(source)))


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit, n_pieces, n_whole.

    ``tokenizer`` is the driver's path to a byte-level tokenizers file; its text
    and the proven whole tokens, both bounded by the vocabulary, go to the
    executors as one broadcast. Counts are those of the tokenizers library
    without its template's tokens; strings of special tokens in a text are one
    token each. Null and empty texts have 0 tokens. Only doc_id and text are
    read; ids may be null or repeat. Nothing is shuffled.
    """
    source = read_text(tokenizer)
    shared = docs.sparkSession.sparkContext.broadcast((source, json_vocabulary(source).patterns, _proof(source)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(*shared.value)
        for batch in batches:
            sizes, counts = [], []
            for texts in texts_of(batch.column(1)):
                sizes += [len(t.encode()) for t in texts]
                counts += map(counter.count, texts)
            tokens = [c[0] for c in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                    pa.array([c[1] for c in counts], pa.int64()),
                    pa.array([c[2] for c in counts], pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_pieces", "n_whole"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, n_pieces long, n_whole long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
