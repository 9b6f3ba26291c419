"""I-Match fingerprints over randomised lexicon subsets. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlight.llm.slices import id_slices

#: Share of documents that hold a term of the lexicon; an inverse document frequency between -ln of both.
DF_BAND = (0.01, 0.1)
#: A text with fewer lexicon terms than this is signed by all its terms.
LEAST = 16
#: A term's subset, one of 64: two digits of its digest, of which the second counts by quarters.
DIGITS, QUARTERS = "0123456789abcdef", "0000111122223333"
#: Cells of the lookup table that a term's hash selects.
CELLS = 1 << 16


def distinct_terms(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits."""
    return F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), lambda t: t != "")


def lexicon(docs: DataFrame, band: tuple[float, float] = DF_BAND) -> DataFrame:
    """Terms whose share of all documents lies in the band: columns term, df.

    Each document counts once per term. A band that starts at the share p holds
    at most (mean distinct terms of a document) / p terms, however large the
    corpus is, since each of them takes p of all documents.
    """
    n = docs.count()
    terms = docs.select(F.explode(distinct_terms(F.coalesce("text", F.lit("")))).alias("term"))
    return terms.groupBy("term").agg(F.count("*").alias("df")).where(F.col("df").between(n * band[0], n * band[1]))


def lexicon_cells(lex: DataFrame) -> Column:
    """The lexicon as a constant array of CELLS texts ' term term ', by the term's hash."""
    cell = F.pmod(F.xxhash64("term"), F.lit(CELLS)).alias("cell")
    filled = lex.groupBy(cell).agg(F.array_join(F.array_sort(F.collect_list("term")), " ").alias("terms"))
    # Bounded by the band, see lexicon().
    cells = [""] * CELLS
    for row in filled.toLocalIterator():
        cells[row["cell"]] = f" {row['terms']} "
    return F.split(F.lit("\n".join(cells)), "\n")


def signature(text: Column, cells: Column, least: int = LEAST) -> Column:
    """Array of one entry per lexicon subset that the text has terms of: the subset's name and a hash of these terms.

    A term's digest puts it into one of 64 random subsets, which together are
    the whole lexicon; a subset's terms are hashed in sorted order. Texts with
    the same entries have the same lexicon terms. A text with fewer than
    ``least`` lexicon terms, such as one of a group so large that its own terms
    are too frequent, or one of only rare words, is signed by all its terms in the
    same way, and one without any term by itself.
    """
    known = lambda t: F.contains(
        F.get(cells, F.pmod(F.xxhash64(t), F.lit(CELLS)).cast("int")), F.concat(F.lit(" "), t, F.lit(" "))
    )
    name = lambda t: F.substring(t, 1, 2)

    def marked(term: Column) -> Column:
        digest = F.substring(F.md5(term), 1, 2)
        quarter = F.translate(F.substring(digest, 2, 1), DIGITS, QUARTERS)
        return F.concat(F.substring(digest, 1, 1), quarter, term)

    def entries(terms: Column) -> Column:
        def gap(x: Column, i: Column) -> Column:
            return F.when(i == 0, "").when(name(x) == name(F.get(terms, i - 1)), " ").otherwise("\n")

        # Sorted terms of one subset stand side by side: a line each.
        lines = F.split(F.array_join(F.transform(terms, lambda x, i: F.concat(gap(x, i), x)), ""), "\n")
        return F.transform(lines, lambda x: F.concat(name(x), F.substring(F.md5(x), 1, 8)))

    def of(terms: Column) -> Column:
        signed = bound(F.filter(terms, known), lambda k: F.when(F.size(k) >= least, k).otherwise(terms))
        by_terms = bound(F.array_sort(F.transform(signed, marked)), entries)
        return F.when(F.size(terms) > 0, by_terms).otherwise(F.array(F.concat(F.lit("no"), F.md5(text))))

    return bound(distinct_terms(text), of)


def bound(value: Column, body) -> Column:
    """body(value), with the value worked out once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that hold a term of either text."""
    names = lambda entries: F.transform(entries, lambda x: F.substring(x, 1, 2))
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(names(a), names(b)))


def with_next(rows: DataFrame, docs: DataFrame, carried: list[str]) -> DataFrame:
    """Add next_<c> for each carried column: its value in the next row by ascending doc_id.

    After the last row comes the first; rows without an id stand last and rows
    with the same id follow the text. The ids are cut into slices by their
    quantiles. Every slice is ordered apart, and the first rows of the next
    slice that has any are copied to it, so nothing is ordered in one task.
    """
    slice_of, _ = id_slices(docs)
    firsts = docs.groupBy(slice_of.alias("_slice")).agg(F.min("doc_id").alias("_first"))
    # One row per slice: a bounded table, cut by id_slices.
    found = sorted((r["_slice"], r["_first"]) for r in firsts.collect())
    if not found:
        return rows.withColumns({f"next_{c}": F.col(c) for c in carried})
    before = [(first, found[i - 1][0], i == 0) for i, (_, first) in enumerate(found)]
    guards = rows.sparkSession.createDataFrame(before, "_first long, _guards int, _wraps boolean")
    is_first = F.col("doc_id").eqNullSafe(F.col("_first"))
    placed = rows.withColumn("_slice", slice_of).join(F.broadcast(guards), is_first, "left")
    as_is = F.struct(F.col("_slice").cast("int").alias("slice"), F.lit(0).alias("guard"))
    ahead = F.struct(F.col("_guards").alias("slice"), F.lit(1).alias("guard"))
    spots = F.when(F.col("_guards").isNull(), F.array(as_is)).otherwise(F.array(as_is, ahead))
    order = "partition by _at.slice order by _at.guard, doc_id nulls last, text"
    led = placed.withColumn("_at", F.explode(spots)).withColumns(
        {f"next_{c}": F.expr(f"lead({c}) over ({order})") for c in carried}
    )
    return led.where("_at.guard = 0").drop("_slice", "_first", "_guards", "_wraps", "_at")


def fingerprints(docs: DataFrame, band: tuple[float, float] = DF_BAND, least: int = LEAST) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and their likeness.

    The edited text has the last quarter replaced by the start of the next
    document. Null texts are empty ones. A fingerprint is the joined entries of
    ``signature``; equal texts have equal ones. Only doc_id (a whole number)
    and text are read. An empty table gives no rows.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cells = lexicon_cells(lexicon(base, band))
    signed = base.withColumn("sig", F.array_join(signature(F.col("text"), cells, least), "-"))
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(
        F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 4) as int))"),
        F.substring("next_text", F.lit(1), quarter),
    )
    pairs = with_next(signed, base.select("doc_id"), ["text", "sig"]).withColumn("edited", edited)
    both = pairs.withColumn("edited_sig", signature(F.col("edited"), cells, least))
    own, after = F.split("sig", "-"), F.split("next_sig", "-")
    return both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("sig").alias("fingerprint"),
        F.array_join("edited_sig", "-").alias("edited_fingerprint"),
        likeness(own, F.col("edited_sig")).alias("near_edited"),
        likeness(own, after).alias("near_next"),
    )


def oracle(band: tuple[float, float] = DF_BAND, least: int = LEAST) -> str:
    """The same fingerprints as DuckDB SQL."""
    words = r"list_distinct(regexp_split_to_array(lower(t), '[^\p{L}\p{N}]+'))"
    mark = f"substr(md5(term), 1, 1) || translate(substr(md5(term), 2, 1), '{DIGITS}', '{QUARTERS}') || term"
    names = lambda c: f"list_transform({c}, lambda e: substr(e, 1, 2))"
    like = lambda a, b: (
        f"len(list_intersect({a}, {b}))::double / len(list_distinct(list_concat({names(a)}, {names(b)})))"
    )
    return f"""
    with base as (
        select row_number() over (order by doc_id nulls last, coalesce(text, '')) as r, count(*) over () as n,
               doc_id, coalesce(text, '') as text from documents
    ), paired as (
        select a.*, length(a.text) as n_chars, b.r as next_r,
               substr(a.text, 1, (length(a.text) - length(a.text) // 4)::int)
               || substr(b.text, 1, (length(a.text) // 4)::int) as edited
        from base a join base b on b.r = a.r % a.n + 1
    ), texts as (
        select r, 0 as kind, text as t from base union all select r, 1, edited from paired
    ), termed as (select r, kind, t, list_filter({words}, lambda w: w <> '') as terms from texts),
    occurring as (select r, kind, unnest(terms) as term from termed),
    frequent as (
        select term, true as lex from occurring where kind = 0 group by term
        having count(*) between (select count(*) from base) * {band[0]}::double
               and (select count(*) from base) * {band[1]}::double
    ), known as (
        select r, kind, term, coalesce(lex, false) as lex, count(lex) over (partition by r, kind) as n_lex
        from occurring left join frequent using (term)
    ), subsets as (
        select r, kind, substr(marked, 1, 2) as name, string_agg(marked, ' ' order by marked) as line
        from (select r, kind, {mark} as marked from known where lex or n_lex < {least}) group by r, kind, name
    ), entries as (
        select r, kind, list(name || substr(md5(line), 1, 8) order by name) as sig from subsets group by r, kind
    ), signed as (
        select r, kind, coalesce(sig, ['no' || md5(t)]) as sig from termed left join entries using (r, kind)
    )
    select p.doc_id, p.n_chars::bigint as n_chars, sha256(p.edited) as edited_sha256,
           array_to_string(a.sig, '-') as fingerprint, array_to_string(e.sig, '-') as edited_fingerprint,
           {like('a.sig', 'e.sig')} as near_edited, {like('a.sig', 'x.sig')} as near_next
    from paired p join signed a on a.r = p.r and a.kind = 0 join signed e on e.r = p.r and e.kind = 1
    join signed x on x.r = p.next_r and x.kind = 0
    """
