"""Licence notices by Dice coefficient over word bigrams. DataFrame operations only."""

from __future__ import annotations

import re
from functools import lru_cache, reduce
from typing import NamedTuple

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The wording of notices by which a licence is recognised.
TEMPLATES = {
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at"
        " your option) any later version.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
        " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,"
        " this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the"
        " above copyright notice, this list of conditions and the following disclaimer in the documentation and/or"
        " other materials provided with the distribution.",
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,"
        " this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the"
        " above copyright notice, this list of conditions and the following disclaimer in the documentation and/or"
        " other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of"
        " its contributors may be used to endorse or promote products derived from this software without specific"
        " prior written permission.",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
        " 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your"
        " option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-2.0": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library"
        " General Public License as published by the Free Software Foundation; either version 2 of the License, or (at"
        " your option) any later version.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 2 of the License, or (at"
        " your option) any later version.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 2.1 of the License, or"
        " (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at"
        " your option) any later version.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL"
        " was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
        " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,"
        " for any purpose, commercial or non-commercial, and by any means.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be"
        " held liable for any damages arising from the use of this software.",
    ],
}

#: Words that say little of a licence.
COMMON = frozenset(
    "0 1 2 3 4 a above an and any anyone are as at be by can code file following for form found free from in is it "
    "its later list means no of on or other source that the this to under use with without work you your appear "
    "available basis charge do event files forms general if may met must option version either except included "
    "including into non public will".split()
)

#: Cells of the lookup table that a bigram's hash selects.
CELLS = 1 << 14

NOT_WORD = r"[^\p{L}\p{N}]+"


class Template(NamedTuple):
    """A notice: its bigrams, the first of them, and those of its version number.

    A match shares ``least`` bigrams or more and spans ``most`` or fewer.
    """

    name: str
    least: int
    most: int
    grams: list[str]
    opening: str
    version: list[str]


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template, as the scan forms them."""
    words = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def version_bigrams(name: str, text: str) -> list[str]:
    """The bigrams of the first version number, from the word before it to its last part.

    A figure in the name of a BSD licence counts clauses and is no version.
    """
    words = words_of(text)
    at = next((i for i, w in enumerate(words) if w.isdigit()), None)
    if at is None or name.startswith("BSD-"):
        return []
    end = next((i for i in range(at, len(words)) if not words[i].isdigit()), len(words))
    return [f"{words[i - 1]} {words[i]}" for i in range(at, end)]


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Bigram counts that can reach the threshold against n: 2 min / (a + b) bounds Dice."""
    reach = [x for x in range(1, int(n * 2 / threshold) + 2) if 2 * min(x, n) / (x + n) >= threshold]
    return reach[0], reach[-1]


def templates(threshold: float) -> list[Template]:
    found = []
    for name in sorted(TEMPLATES):
        for text in TEMPLATES[name]:
            grams, words = bigrams(text), words_of(text)
            least, most = size_bounds(len(grams), threshold)
            repeated = len(words) - 1 - len(grams)
            version = version_bigrams(name, text)
            found.append(Template(name, least, most + repeated, grams, " ".join(words[:2]), version))
    return found


@lru_cache
def key_words(threshold: float) -> list[str]:
    """Words of which every text that reaches the threshold holds one.

    A match shares at least ``least`` of a template's n bigrams, so it can't
    miss all of those that hold a key word once they are more than n - least.
    """
    keys: set[str] = set()
    for t in templates(threshold):
        pairs = [set(g.split()) for g in t.grams]
        while sum(bool(p & keys) for p in pairs) <= len(t.grams) - t.least:
            left = [w for p in pairs if not p & keys for w in p]
            keys.add(min(set(left), key=lambda w: (w in COMMON, -left.count(w), w)))
    return sorted(keys)


def _bigram_hash(gram: str) -> int:
    """xxhash64 of both words, as Spark has it."""
    first, second = gram.split()
    value = xxhash.xxh64_intdigest(second.encode(), xxhash.xxh64_intdigest(first.encode(), 42))
    return value - (1 << 64) if value >> 63 else value


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _constant(values: list, kind: str = "bigint") -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _bound(value: Column, body) -> Column:
    """body(value), with the value worked out once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _marked(words: Column, threshold: float) -> Column:
    """The bigrams of a word sequence: at, before, member, opening, version.

    ``before`` is the place of the same bigram before, or -1, so a bigram is new
    in a window that starts beyond it. The others are sets of templates as bits:
    those that hold it, start with it, and have it in their version.
    """
    known = templates(threshold)
    grams = sorted({g for t in known for g in t.grams})
    bits = lambda held: _constant([sum(1 << i for i, t in enumerate(known) if held(t, g)) for g in grams])
    sets = {
        "member": bits(lambda t, g: g in t.grams),
        "opening": bits(lambda t, g: g == t.opening),
        "version": bits(lambda t, g: g in t.version),
    }
    hashes = [_bigram_hash(g) for g in grams]
    taken = {h % CELLS for h in hashes}
    cells = _constant([int(c in taken) for c in range(CELLS)], "int")

    def place(h: Column) -> Column:
        hit = F.get(cells, F.pmod(h, F.lit(CELLS)).cast("int")) == 1
        return F.when(hit, F.array_position(_constant(hashes), h) - 1).otherwise(-1).cast("int")

    def with_sets(x: Column) -> Column:
        return _bound(
            place(x["hash"]),
            lambda k: F.struct(
                x["at"], x["before"], *(F.coalesce(F.get(v, k), F.lit(0)).alias(c) for c, v in sets.items())
            ),
        )

    def with_before(by_hash: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            last = F.get(by_hash, i - 1)
            before = F.when(last["hash"] == x["hash"], last["at"]).otherwise(-1)
            return F.struct(x["at"].alias("at"), before.alias("before"), x["hash"].alias("hash"))

        return F.sort_array(F.transform(by_hash, one))

    pairs = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    placed = F.transform(pairs, lambda b, i: F.struct(F.xxhash64(F.get(words, i), b).alias("hash"), i.alias("at")))
    return F.transform(_bound(F.sort_array(placed), with_before), with_sets)


def _windows(marked: Column, threshold: float) -> Column:
    """Runs of words that reach the threshold: minus_surplus, minus_dice, name, first and last bigram.

    A window starts on the template's first bigram, or on one of its bigrams that
    follows no other of it: from there to the left Dice only grows. It ends on
    a bigram of the template, has no more bigrams, repeats counted, than the size
    range allows, and the whole version number. From each start the end with
    the highest Dice counts, found in one pass that counts bigrams as they come.
    """
    rows = ", ".join(
        f"named_struct('name', {_sql_text(t.name)}, 'bit', {1 << i}L, 'n', {len(t.grams)}, 'least', {t.least},"
        f" 'most', {t.most}, 'version', {len(set(t.version))})"
        for i, t in enumerate(templates(threshold))
    )
    nothing = F.lit(None).cast("struct<minus_dice: double, minus_surplus: double, last: int>")

    def of_template(t: Column, marks: Column) -> Column:
        def from_start(first: Column) -> Column:
            def step(acc: Column, x: Column) -> Column:
                new, member = x["before"] < first, x["member"].bitwiseAND(t["bit"]) != 0
                total = acc["total"] + new.cast("int")
                shared = acc["shared"] + (new & member).cast("int")
                version = acc["version"] + (new & (x["version"].bitwiseAND(t["bit"]) != 0)).cast("int")
                here = F.struct(
                    (shared * -2.0 / total).alias("minus_dice"),
                    (total * threshold - shared * 2.0).alias("minus_surplus"),
                    x["at"].alias("last"),
                )
                ends = member & (version == t["version"]) & (shared * 2.0 / total >= threshold)
                return F.struct(
                    total.alias("total"), shared.alias("shared"), version.alias("version"),
                    F.when(ends, F.least(acc["best"], here)).otherwise(acc["best"]).alias("best"),
                )

            start = F.struct(
                t["n"].alias("total"), F.lit(0).alias("shared"), F.lit(0).alias("version"), nothing.alias("best")
            )
            best = F.aggregate(F.slice(marked, first + 1, t["most"]), start, step, lambda acc: acc["best"])
            return _bound(
                best,
                lambda b: F.when(
                    b.isNotNull(),
                    F.struct(
                        b["minus_surplus"].alias("minus_surplus"), b["minus_dice"].alias("minus_dice"),
                        t["name"].alias("name"), first.alias("first"), b["last"].alias("last"),
                    ),
                ),
            )

        def starts(mine: Column) -> Column:
            def is_start(m: Column, i: Column) -> Column:
                follows = F.coalesce(F.get(mine, i - 1)["at"] == m["at"] - 1, F.lit(False))
                opens = m["opening"].bitwiseAND(t["bit"]) != 0
                enough = F.get(mine, i + t["least"] - 1)["at"] - m["at"] < t["most"]
                return (opens | ~follows) & enough

            at = F.transform(F.filter(mine, is_start), lambda m: m["at"])
            return F.filter(F.transform(at, from_start), lambda w: w.isNotNull())

        return _bound(F.filter(marks, lambda m: m["member"].bitwiseAND(t["bit"]) != 0), starts)

    marks = F.filter(marked, lambda m: m["member"] != 0)
    return _bound(marks, lambda m: F.flatten(F.transform(F.expr(f"array({rows})"), lambda t: of_template(t, m))))


def _apart(windows: Column) -> Column:
    """Windows that share no word: those with most shared bigrams beyond the threshold go first.

    Windows are cut into groups between which no window reaches, and chosen
    within each, so a text of many notices takes time in proportion.
    """

    def chosen(group: Column) -> Column:
        def free(kept: Column, w: Column) -> Column:
            return ~F.exists(kept, lambda k: (k["first"] <= w["last"] + 1) & (w["first"] <= k["last"] + 1))

        return F.aggregate(
            F.sort_array(group),
            F.array().cast(NOTICES),
            lambda kept, w: F.when(free(kept, w), F.concat(kept, F.array(w))).otherwise(kept),
        )

    def of_sorted(ordered: Column) -> Column:
        def of_lasts(lasts: Column) -> Column:
            # As many windows have ended before the i-th one starts as there are before it.
            cut = F.filter(
                F.transform(ordered, lambda o, i: F.struct(o["first"].alias("first"), i.alias("i"))),
                lambda x: (x["i"] == 0) | (F.get(lasts, x["i"] - 1) + 1 < x["first"]),
            )
            cuts = F.transform(cut, lambda x: x["i"])
            groups = _bound(
                cuts,
                lambda c: F.transform(
                    c, lambda at, k: F.slice(ordered, at + 1, F.coalesce(F.get(c, k + 1), F.size(ordered)) - at)
                ),
            )
            return F.flatten(F.transform(groups, lambda g: chosen(F.transform(g, lambda o: o["window"]))))

        return _bound(F.sort_array(F.transform(ordered, lambda o: o["window"]["last"])), of_lasts)

    by_first = F.transform(windows, lambda w: F.struct(w["first"].alias("first"), w.alias("window")))
    return _bound(F.sort_array(by_first), of_sorted)


NOTICES = "array<struct<minus_surplus: double, minus_dice: double, name: string, first: int, last: int>>"


def license_hits(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row per document: doc_id, license, dice, n_hits, licenses.

    Every run of words whose size allows ``threshold`` for a template is
    compared with it by Dice over distinct word bigrams, see ``_windows``: a
    notice is found on lines of its own, across lines, and among other words.
    Texts without a key word of any template are passed over, as they can't
    reach the threshold. ``n_hits`` counts the notices, which share no word;
    ``licenses`` are their sorted names and ``license`` the one of highest Dice,
    the first by name among equals. A notice needs its template's version number,
    all parts of it. Only the wording counts: "not released under the MIT
    License" is a hit. Case, punctuation and white space don't matter. Null and
    empty texts have license null, dice 0, n_hits 0 and licenses ''. Equal rows
    give equal rows, an empty table none. The time for a text grows with its
    words times those of a template, also where it is one long list of notices.
    Only doc_id and text are read. The work is row by row: nothing is shuffled.
    """
    holds_key = reduce(lambda a, b: a | b, (F.contains(F.col("_low"), F.lit(k)) for k in key_words(threshold)))
    words = F.filter(F.split("_low", NOT_WORD), lambda w: w != "")
    found = _bound(_bound(words, lambda w: _marked(w, threshold)), lambda m: _apart(_windows(m, threshold)))
    best = F.array_min(F.transform("_found", lambda w: F.struct(w["minus_dice"].alias("minus_dice"), w["name"])))
    names = F.array_sort(F.array_distinct(F.transform("_found", lambda w: w["name"])))
    return (
        docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("_low"))
        .select("doc_id", F.when(holds_key, found).otherwise(F.array().cast(NOTICES)).alias("_found"))
        .select("doc_id", "_found", best.alias("_best"))
        .select(
            "doc_id",
            F.col("_best.name").alias("license"),
            F.coalesce(-F.col("_best.minus_dice"), F.lit(0.0)).alias("dice"),
            F.size("_found").cast("long").alias("n_hits"),
            F.array_join(names, ",").alias("licenses"),
        )
    )


def oracle(threshold: float = 0.8) -> str:
    """The scan as DuckDB SQL: all starts and ends by template, then the best that share no word."""
    texts = lambda values: f"[{', '.join(map(_sql_text, values))}]::varchar[]"
    rows = ", ".join(
        f"({i}, {_sql_text(t.name)}, {t.least}, {t.most}, {texts(t.grams)}, {_sql_text(t.opening)}, {texts(t.version)})"
        for i, t in enumerate(templates(threshold))
    )
    return rf"""
    with recursive templates(tid, name, least, most, grams, opening, version) as (values {rows}),
    members as (select tid, unnest(grams) as g from templates),
    worded as (
        select row_number() over () as r, doc_id, list_filter(string_split(
            regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '') as w
        from documents
    ), grammed as (
        select r, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) as gs from worded
    ), placed as (
        select r, unnest(gs) as g, generate_subscripts(gs, 1) as p from grammed
    ), marked as (
        select r, tid, p, g, lag(p) over (partition by r, tid order by p) as before from placed join members using (g)
    ), starts as (
        select r, tid, p as first from marked join templates using (tid)
        where g = opening or before is null or before <> p - 1
    ), parts as (
        select s.r, s.tid, first, p as last, list_distinct(gs[first:p]) as part
        from starts s join templates t using (tid) join marked m on m.r = s.r and m.tid = s.tid
        join grammed on grammed.r = s.r
        where p between first + least - 1 and first + most - 1
    ), counted as (
        select r, tid, name, first, last, len(list_intersect(part, grams)) as shared, len(part) + len(grams) as total
        from parts join templates using (tid) where list_has_all(part, version)
    ), scored as (
        select r, name, first, last, tid, shared * -2.0::double / total as minus_dice,
               total * {threshold}::double - shared * 2.0::double as minus_surplus
        from counted where shared * 2.0::double / total >= {threshold}::double
    ), ended as (
        select * from scored
        qualify row_number() over (partition by r, tid, first order by minus_dice, minus_surplus, last) = 1
    ), listed as (
        select r, list({{'name': name, 'minus_dice': minus_dice, 'first': first, 'last': last}}
                       order by minus_surplus, minus_dice, name, first, last) as rest
        from ended group by r
    ), chosen(r, found, rest) as (
        select r, rest[:0], rest from listed
        union all
        select r, list_append(found, rest[1]),
               list_filter(rest, lambda w: w.first > rest[1].last + 1 or rest[1].first > w.last + 1)
        from chosen where len(rest) > 0
    ), notices as (
        select r, unnest(found) as hit from chosen where len(rest) = 0
    ), best as (
        select r, arg_min(hit.name, {{'d': hit.minus_dice, 'n': hit.name}}) as license, -min(hit.minus_dice) as dice,
               count(*) as n_hits, array_to_string(list_sort(list(distinct hit.name)), ',') as licenses
        from notices group by r
    )
    select doc_id, license, coalesce(dice, 0.0::double) as dice, coalesce(n_hits, 0)::bigint as n_hits,
           coalesce(licenses, '') as licenses
    from worded left join best using (r)
    """
