"""Byte-level vocabularies and the pieces that are merged apart from each other.

Plain helpers of the token operators: they run inside tasks on one text or one
piece at a time.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from tokenizers import Tokenizer

#: Fixed value: the pattern that splits a text into pieces, with places for the classes of letters, numbers and spaces.
#: No two kinds begin alike but the contractions and the signs, so letters, which are most, may be tried first.
PIECES = " ?[{L}]+|'(?:[stmd]|re|ve|ll)| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"

#: Where the code points of texts end that a pattern is for.
LIMITS = (0x100, 0x10000, 0x110000)

#: Pieces of each of the two generations kept in a worker's memory, and the longest that is kept.
KEPT_PIECES = 400_000
KEPT_CHARS = 200


def piece_patterns(class_of: dict[int, str]) -> tuple[str, ...]:
    """Splitting patterns for given classes of code points: L, N or S; the others are signs.

    With the classes spelled out, a pattern doesn't depend on the Unicode
    version of the process that runs it. There is one for texts below each of
    LIMITS, since small classes match several times faster.
    """
    return tuple(_piece_pattern(class_of, limit) for limit in LIMITS)


def _piece_pattern(class_of: dict[int, str], limit: int) -> str:
    spelled = {}
    for kind in "LNS":
        codes = sorted(c for c, k in class_of.items() if k == kind and c < limit)
        ranges = []
        for c in codes:
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
        spelled[kind] = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)
    return PIECES.format(**spelled)


class Splitter:
    """Cuts texts into pieces."""

    def __init__(self, patterns: tuple[str, ...]):
        self._latin, self._basic, self._full = [re.compile(p).findall for p in patterns]
        self._not_latin = re.compile("[^\\x00-\\xff]").search
        self._not_basic = re.compile("[\\U00010000-\\U0010ffff]").search

    def pieces(self, text: str) -> list[str]:
        if text.isascii() or not self._not_latin(text):
            return self._latin(text)
        return self._full(text) if self._not_basic(text) else self._basic(text)


@lru_cache(maxsize=1)
def unicode_patterns() -> tuple[str, ...]:
    """Splitting patterns by the classes L and N of Unicode and its white space."""
    class_of = {}
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind, pattern in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s")):
        class_of |= dict.fromkeys(map(ord, regex.findall(pattern, every)), kind)
    return piece_patterns(class_of)


@lru_cache(maxsize=None)
def byte_chars() -> list[str]:
    """The character by which a byte-level vocabulary file writes each byte.

    Visible Latin-1 characters stand for themselves, the others for the
    characters from U+0100 on.
    """
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256))
    return [chr(b) if b in shown else chr(256 + next(rest)) for b in range(256)]


def read_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens of a rank file: a base64 text and a rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}


#: Rank of a pair that doesn't merge.
NEVER = 1 << 60


def merged(parts: list, rank_of) -> list:
    """Byte-pair merging: join the adjacent pair of the lowest rank, the leftmost among equals, until none has one.

    ``rank_of(a, b)`` gives NEVER for a pair that doesn't merge. Short lists are
    scanned; long ones keep their pairs in a heap.
    """
    parts = list(parts)
    if len(parts) <= 64:
        ranks = list(map(rank_of, parts, parts[1:]))
        while ranks and (best := min(ranks)) != NEVER:
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of(parts[i - 1], parts[i])
            if i < len(ranks):
                ranks[i] = rank_of(parts[i], parts[i + 1])
        return parts
    n = len(parts)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n and (rank := rank_of(parts[i], parts[after[i]])) != NEVER:
            heapq.heappush(heap, (rank, i, parts[i], parts[after[i]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if parts[i] != a or j >= n or parts[j] != b:
            continue  # one of the two has been merged since
        parts[i], parts[j], after[i] = a + b, None, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [p for p in parts if p is not None]


class JsonVocabulary:
    """A byte-level BPE of the tokenizers library: its merges, and its way of splitting texts.

    Parts are the vocabulary's own strings, one character per byte. Texts are
    cut at the strings of added tokens first, which become one token each.
    """

    def __init__(self, source: str, patterns: tuple[str, ...] | None = None):
        spec = json.loads(source)
        merges = spec["model"]["merges"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        self.ids = spec["model"]["vocab"]
        self.merges = {pair: rank for rank, pair in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = [spec["pre_tokenizer"]["type"], spec["normalizer"], spec["model"].get("dropout")]
        if plain != ["ByteLevel", None, None] or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("a byte-level BPE without normalizer, dropout and prefix space is needed")
        self.library = Tokenizer.from_str(source)
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("|".join(map(re.escape, longest_first))) if self.added else None
        self._chars = byte_chars()
        self._token = self.library.model.tokenize
        #: Worked out on the driver and handed to the workers, since it takes seconds.
        self.patterns = self._own_patterns() if patterns is None else patterns
        #: The pieces of a text without added tokens.
        self.pieces = Splitter(self.patterns).pieces

    def written(self, piece: str) -> str:
        chars = self._chars
        return "".join([chars[b] for b in piece.encode()])

    def merge(self, piece: str) -> list[str]:
        get = self.merges.get
        return merged(self.written(piece), lambda a, b: get((a, b), NEVER))

    def library_ids(self, piece: str) -> list[int]:
        """The library's ids of one piece."""
        return [t.id for t in self._token(self.written(piece))]

    def _own_patterns(self) -> tuple[str, ...]:
        """Splitting patterns by the classes that the library's splitter goes by, whatever its version of Unicode.

        Every code point of the planes that hold letters, numbers or spaces is
        tried behind a letter, a number and a sign: it joins its own kind.
        """
        class_of = {}
        for start in [*range(0, 0x40000, 1 << 14), 0xE0000]:
            codes = [c for c in range(start, start + (1 << 14)) if not 0xD800 <= c < 0xE000]
            probe = "".join([f"a{c}1{c}!{c}\n" for c in map(chr, codes)])
            cuts = {end for _, (_, end) in self.library.pre_tokenizer.pre_tokenize_str(probe)}
            for i, c in enumerate(codes):
                joined = [kind for kind, at in (("L", 1), ("N", 3), ("O", 5)) if 7 * i + at not in cuts]
                class_of[c] = joined[0] if joined else "S"
        class_of[ord("'")] = "O"
        return piece_patterns(class_of)

    def segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Stretches of a text between added tokens, each with the id of the added token behind it."""
        at = 0
        found = self.cut and any(map(text.__contains__, self.added))
        for m in self.cut.finditer(text) if found else ():
            yield text[at : m.start()], self.added[m[0]]
            at = m.end()
        yield text[at:], None


@lru_cache(maxsize=4)
def json_vocabulary(source: str, patterns: tuple[str, ...] | None = None) -> JsonVocabulary:
    """One object per process and file."""
    return JsonVocabulary(source, patterns)


class Memo(dict):
    """Results by piece, worked out on first use; what hasn't been used for two generations goes, ``base`` stays."""

    def __init__(self, work, base: dict | None = None, kept: int = KEPT_PIECES):
        super().__init__(base or {})
        self.work, self.base, self.older, self.most = work, dict(base or {}), {}, kept + len(base or {})

    def __missing__(self, piece):
        value = self.older.get(piece)
        if value is None:
            value = self.work(piece)
        if len(piece) <= KEPT_CHARS:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
                self.update(self.base)
            self[piece] = value
        return value


def texts_of(column: pa.Array, step: int = 256) -> Iterator[list[str]]:
    """The texts of an Arrow column, a few at a time; null is empty."""
    for i in range(0, len(column), step):
        yield [t or "" for t in column.slice(i, step).to_pylist()]


def chunks_of(column: pa.Array, chars: int = 1 << 18) -> Iterator[list[str]]:
    """The texts of an Arrow column, about so many characters at a time: memory follows the longest text alone."""
    held, size = [], 0
    for texts in texts_of(column, 64):
        for text in texts:
            if held and size + len(text) > chars:
                yield held
                held, size = [], 0
            held.append(text)
            size += len(text)
    if held:
        yield held
