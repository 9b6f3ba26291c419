"""Personal data by pattern, and what patterns of context learned from it find besides."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlight.llm.pretokens import chunks_of
from spendlight.llm.store import stored
from spendlight.llm.words import STEP, lowered, scrambled, word_hashes, words_laid_out

#: The kinds in the order of their spans, with the least and most digits or the largest part.
KINDS = ("email", "ip", "card", "phone")
IP_MOST, CARD_DIGITS, PHONE_DIGITS = 255, (13, 19), (9, 15)

#: What a candidate of a kind looks like where the words before it tell the kind: written apart, or unchecked.
DOT, AT = r"(?:\.|\x20?[\[(]\x20?dot\x20?[\])]\x20?)", r"(?:@|\x20?[\[(]\x20?at\x20?[\])]\x20?)"
LOOKS = (
    rf"[A-Za-z0-9._%+-]{{1,64}}{AT}[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{1,63}}){{0,8}}",
    rf"[0-9]{{1,3}}(?:{DOT}[0-9]{{1,3}}){{3}}|(?:[0-9A-Fa-f]{{0,4}}:){{2,7}}[0-9A-Fa-f]{{1,4}}",
    r"[0-9](?:[\x20._-]?[0-9]){11,18}",
    r"\+?\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}",
)
#: Characters after a word up to which an address is looked for.
REACH = 80
#: Characters between a word of context and what it introduces: signs and spaces of one line.
GAP = 6
LOOK = tuple(re.compile(rf"[^\w\n]{{0,{GAP}}}?({look})(?![A-Za-z0-9])") for look in LOOKS)

#: Different values that a context of a kind must have introduced to be a pattern of it, and the least share of all
#: pairs of a context and a value of its kind: so there are at most 1 / SHARE patterns of a kind.
SUPPORT = 3
SHARE = 1e-5
#: A pattern counts from this confidence on, and a value from this score on.
CONFIDENT = 0.5
FOUND = 0.7
#: Rounds of scores between patterns and values.
ROUNDS = 3


# --- base spans ---------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT, _DOMAIN = re.compile("@"), re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS, _PARTS = re.compile(r"[0-9]+"), re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_SPACED, _PAUSE = re.compile(r"[0-9][0-9 -]*"), re.compile(r"[ -]{2,}|[ -]$")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # The name is the whole run before the sign, up to the last match: no run stands before two signs.
    at = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > at and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start() and (domain := _DOMAIN.match(text, m.start())):
            at = domain.end()
            yield start, at


def _ips(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := _DIGITS.search(text, at):
        found = _PARTS.match(text, m.start())
        if found and all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= IP_MOST for p in found[0].split(".")):
            yield found.span()
        at = found.end() if found else m.end()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for run in _SPACED.finditer(text):
        at = run.start()
        for pause in [*_PAUSE.finditer(run[0]), None]:
            end = run.end() if pause is None else run.start() + pause.start()
            digits = text[at:end].replace(" ", "").replace("-", "")
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                yield at, end
            at = end if pause is None else run.start() + pause.end()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if PHONE_DIGITS[0] <= sum(map(str.isdigit, m[0])) <= PHONE_DIGITS[1]:
            yield m.span()


def luhn(digits: str) -> bool:
    """Whether the digits pass the check of card numbers: every second one from the right doubled, sum of all digits."""
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all base spans, by kind and start; in time linear in the text.

    They are the leftmost matches of the patterns of the four kinds that don't
    overlap within a kind, less those that fail the test of the kind.
    """
    return [(k, a, b) for k, spans in enumerate((_emails, _ips, _cards, _phones)) for a, b in spans(text)]


# --- contexts -----------------------------------------------------------------


def _digest(kind: int, value: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}:{value.lower()}") - (1 << 63)


def _word_before(text: str, at: int, most: int) -> tuple[int, int] | None:
    """The word that ends at most ``most`` signs or spaces of one line before ``at``."""
    end = at
    while end and not text[end - 1].isalnum():
        if text[end - 1] == "\n" or at - end >= most:
            return None
        end -= 1
    start = end
    while start and text[start - 1].isalnum():
        start -= 1
    return (start, end) if start < end else None


def _contexts(words: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """Words as contexts, or pairs of a word and the one before it."""
    mixed = words if before is None else words ^ scrambled(before)
    return scrambled(mixed * STEP).view(np.int64)


SEEDS = "kind int, context long, value long, times long"


def seeds_of(text: str) -> list[tuple[int, int, int]]:
    """What introduces the base spans of a text: kind, context (one word, or two), value."""
    spans = base_spans(text)
    if not spans:
        return []
    low, pairs, rows = lowered(text), [], []
    for kind, start, end in spans:
        last = _word_before(low, start, GAP)
        if last is not None:
            first = _word_before(low, last[0], GAP)
            pairs.append((low[slice(*first)] if first else None, low[slice(*last)]))
            rows.append((kind, _digest(kind, text[start:end])))
    words = list(dict.fromkeys(w for pair in pairs for w in pair if w))
    known = dict(zip(words, words_laid_out(words)[0]))
    out = []
    for (kind, value), (first, last) in zip(rows, pairs):
        one = np.array([known[last]])
        out.append((kind, int(_contexts(one)[0]), value))
        if first:
            out.append((kind, int(_contexts(one, np.array([known[first]]))[0]), value))
    return out


def _seeds(docs: DataFrame) -> DataFrame:
    """kind, context, value, and how often the context introduces it, over all base spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks_of(batch.column(0)):
                counts = Counter(seed for t in texts for seed in seeds_of(t))
                if counts:
                    columns = [*zip(*counts), list(counts.values())]
                    types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
                    arrays = [pa.array(c, t) for c, t in zip(columns, types)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["kind", "context", "value", "times"])

    found = docs.where("text is not null").select("text").mapInArrow(run, SEEDS)
    return found.groupBy("kind", "context", "value").agg(F.sum("times").alias("times"))


def induced_patterns(seeds: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """kind, context, seen of those that introduce enough different values; at most 1 / ``share`` of a kind.

    ``seen`` counts the places where the context introduces a base span of the kind.
    """
    held = seeds.groupBy("kind", "context").agg(F.count("*").alias("n"), F.sum("times").alias("seen"))
    all_of = held.groupBy("kind").agg(F.sum("n").alias("total"))
    enough = (F.col("n") >= support) & (F.col("n") >= share * F.col("total"))
    # A row per kind.
    return held.join(F.broadcast(all_of), "kind").where(enough).select("kind", "context", "seen")


# --- what patterns introduce --------------------------------------------------

_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_HIT = pa.struct(
    [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("context", pa.int64()), ("value", pa.int64())]
)
_COUNT = pa.struct([("context", pa.int64()), ("n", pa.int64())])
SCANNED = (
    "_row long, _id long, spans array<struct<kind: int, start: int, end: int>>,"
    " hits array<struct<kind: int, start: int, end: int, context: long, value: long>>,"
    " counts array<struct<context: long, n: long>>"
)


class _Spans:
    """The base spans of a text, found by place."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.all = sorted((a, b) for _, a, b in spans)
        #: The furthest end of the spans up to each.
        self.ends = list(accumulate((b for _, b in self.all), max))

    def overlap(self, start: int, end: int) -> bool:
        at = bisect_left(self.all, (end, 0))
        return at > 0 and self.ends[at - 1] > start


class _Searcher:
    """Looks for known contexts in texts, and counts them."""

    def __init__(self, contexts: np.ndarray, kinds: np.ndarray):
        #: Sorted contexts, with their kinds as bits, and in how many places each was met.
        self.contexts, self.kinds, self.counts = contexts, kinds, np.zeros(len(contexts), np.int64)

    def hits(self, texts: list[str], spans: list[list[tuple[int, int, int]]]) -> list[list[tuple]]:
        """Per text what looks like a kind behind a context of it, outside base spans.

        All words are hashed and looked up at once; only contexts with a digit
        or a sign of an address behind them are looked at in the text.
        """
        out: list[list[tuple]] = [[] for _ in texts]
        if not len(self.contexts):
            return out
        words, of, starts, ends, bounds, chars = words_laid_out([lowered(t) for t in texts])
        if not len(words):
            return out
        lines = np.searchsorted(np.flatnonzero(chars == ord("\n")), starts)
        near = np.append((lines[1:] == lines[:-1]) & (starts[1:] - ends[:-1] <= GAP), False)
        promising = self._promising(words, starts, ends, near, chars)
        placed: dict[int, _Spans] = {}
        for before in (None, np.concatenate([words[:1], words[:-1]])):
            context = _contexts(words, before)
            at = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
            matched = self.contexts[at] == context
            if before is not None:
                matched &= np.concatenate([[False], near[:-1]])
            self.counts += np.bincount(at[matched], minlength=len(self.counts))
            for i in np.flatnonzero(matched & promising).tolist():
                t, kinds = int(of[i]), int(self.kinds[at[i]])
                end = int(ends[i] - bounds[t])
                for kind in range(len(KINDS)):
                    found = LOOK[kind].match(texts[t], end) if kinds >> kind & 1 else None
                    if found is None:
                        continue
                    if t not in placed:
                        placed[t] = _Spans(spans[t])
                    if not placed[t].overlap(*found.span(1)):
                        out[t].append((kind, *found.span(1), int(context[i]), _digest(kind, found[1])))
        return out

    @staticmethod
    def _promising(
        words: np.ndarray, starts: np.ndarray, ends: np.ndarray, near: np.ndarray, chars: np.ndarray
    ) -> np.ndarray:
        """Words behind which a candidate may stand: what every look needs to begin with."""
        last = len(chars) - 1
        after = np.append(starts[1:], last)
        behind = chars[np.minimum(np.append(ends[1:], last), last)]
        digit = near & (((chars[after] >= ord("0")) & (chars[after] <= ord("9"))) | (behind == ord(":")))
        bracket = lambda c: (c == ord("(")) | (c == ord("["))
        at = words == word_hashes(["at"])[0][0]
        at &= bracket(chars[np.maximum(starts - 1, 0)]) | bracket(chars[np.maximum(starts - 2, 0)])
        signs = np.sort(np.concatenate([np.flatnonzero(chars == ord("@")), starts[at], [1 << 60]]))
        return digit | (signs[np.searchsorted(signs, ends)] - ends <= REACH)


def _scanned(docs: DataFrame, contexts: np.ndarray, kinds: np.ndarray) -> DataFrame:
    """_row, _id, spans and hits of each document; and rows without a _row, with the counts of a task's contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = _Searcher(contexts, kinds)
        names = ["_row", "_id", "spans", "hits", "counts"]
        types = [pa.int64(), pa.int64(), pa.list_(_SPAN), pa.list_(_HIT), pa.list_(_COUNT)]
        for batch in batches:
            at = 0
            for texts in chunks_of(batch.column(2)):
                spans = [base_spans(t) for t in texts]
                hits = searcher.hits(texts, spans)
                own = [
                    *[c.slice(at, len(texts)) for c in batch.columns[:2]],
                    pa.array([[dict(zip(("kind", "start", "end"), s)) for s in found] for found in spans], types[2]),
                    pa.array(
                        [[dict(zip(("kind", "start", "end", "context", "value"), h)) for h in found] for found in hits],
                        types[3],
                    ),
                    pa.nulls(len(texts), types[4]),
                ]
                yield pa.RecordBatch.from_arrays(own, names=names)
                at += len(texts)
        met = np.flatnonzero(searcher.counts)
        for i in range(0, len(met), 10_000):
            part = met[i : i + 10_000]
            rows = [{"context": c, "n": n} for c, n in zip(contexts[part].tolist(), searcher.counts[part].tolist())]
            own = [*[pa.nulls(1, t) for t in types[:4]], pa.array([rows], types[4])]
            yield pa.RecordBatch.from_arrays(own, names=names)

    wanted = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").alias("_id"), "text")
    return stored(wanted.mapInArrow(run, SCANNED), "introduced")


# --- scores -------------------------------------------------------------------


def scored_patterns(contexts: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Confident patterns (kind, context, confidence) and the values they find (kind, value, score).

    ``contexts`` has kind, context, n (the places where it stands) and seen
    (those where it introduces a base span of the kind); ``edges`` has kind,
    context, value and times: candidates that contexts introduce. The confidence of
    a pattern is the sum of the scores of what it introduces, over its places
    and one: base spans have score 1, other words 0. A candidate's score is the
    chance that one of its confident patterns is right, as if they were
    independent. Scores start at 0 and grow from round to round. Both are
    aggregates with a map-side step; patterns are few (1 / SHARE of a kind at
    most) and meet the edges by a broadcast.
    """
    contexts, edges, values = stored(contexts, "contexts"), stored(edges, "edges"), None
    for _ in range(rounds):
        weighed, mass = contexts, F.col("seen").cast("double")
        if values is not None:
            share = F.sum(F.col("score") * F.col("times")).alias("gained")
            gained = edges.join(values, ["kind", "value"]).groupBy("kind", "context").agg(share)
            weighed = contexts.join(gained, ["kind", "context"], "left")
            mass = mass + F.coalesce("gained", F.lit(0.0))
        confidence = (mass / (F.col("n") + 1)).alias("confidence")
        patterns = weighed.select("kind", "context", confidence).where(F.col("confidence") >= CONFIDENT)
        patterns = stored(patterns, "patterns")
        # Logarithms in whole millionths sum to the same in any order.
        miss = F.round(F.ln(1 - F.col("confidence")) * 1_000_000).cast("long")
        found = edges.join(F.broadcast(patterns), ["kind", "context"]).groupBy("kind", "value").agg(F.sum(miss).alias("m"))
        values = stored(found.select("kind", "value", (1 - F.exp(F.col("m") / 1_000_000)).alias("score")), "values")
    return patterns, values


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found.

    Base spans are the seeds. The one or two words before them induce patterns;
    behind these, all texts are searched for what looks like the kind but is no
    base span. Scores go back and forth between patterns and values; values that
    score FOUND behind a confident pattern are added. The counts and the digest
    are of base spans alone, ``n_found`` counts the added ones, and ``spans``
    has both by kind, start and end. An added span never overlaps a base one.

    A null text is empty, and so is its list. A context becomes a pattern by
    SUPPORT different values, so copies of a text don't make one; places are
    counted with copies. Ids may be null or repeat. Time is linear in a text's
    length. Without seeds there is no pattern and nothing is added. Only doc_id
    and text are read.
    """
    learned = stored(induced_patterns(stored(_seeds(docs), "seeds")), "learned")
    # At most 1 / SHARE contexts of each kind.
    kinds: dict[int, int] = {}
    for r in learned.select("kind", "context").collect():
        kinds[r.context] = kinds.get(r.context, 0) | 1 << r.kind
    known = np.array(sorted(kinds), np.int64)
    scanned = _scanned(docs, known, np.array([kinds[c] for c in known.tolist()], np.int64))
    rows = scanned.where("_row is not null")
    counts = scanned.where("_row is null").select(F.explode("counts").alias("c")).groupBy("c.context")
    contexts = learned.join(counts.agg(F.sum("c.n").alias("n")), "context").select("kind", "context", "n", "seen")
    hits = rows.where(F.size("hits") > 0).select("_row", F.explode("hits").alias("h")).select("_row", "h.*")
    edges = hits.groupBy("kind", "context", "value").agg(F.count("*").alias("times"))
    patterns, values = scored_patterns(contexts, edges, rounds)
    good = values.where(F.col("score") >= FOUND).select("kind", "value")
    confident = F.broadcast(patterns.select("kind", "context"))
    added = hits.join(confident, ["kind", "context"], "left_semi").join(good, ["kind", "value"], "left_semi")
    added = added.groupBy("_row").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))
    found = rows.select("_row", "_id", "spans").join(added, "_row", "left")
    nothing = F.array().cast("array<struct<kind: int, start: int, end: int>>")
    found = found.withColumn("added", F.coalesce("added", nothing))
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("_id").alias("doc_id"),
        *[of(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_written(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
        _written(F.concat("spans", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_found"),
    )


def _written(spans: Column) -> Column:
    """kind:start:end, joined by commas, in order."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")
