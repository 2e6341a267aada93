"""Licence scan, with DataFrame functions only.

A text is normalised (lower case, runs of other characters than a-z and 0-9 become one space), so line breaks and comment marks
don't count, and its word bigrams are compared with those of licence templates by the Dice coefficient. Where a notice begins and
ends inside a text is not known, so stretches of as many words as the template has are compared: one from each place at which the
text has one of the template's bigrams. A Dice coefficient of d needs d / (2 - d) of the template's bigrams to be shared at least,
and the smaller of the two sets to have at least d / (2 - d) times the size of the larger: templates of which a whole text has fewer
bigrams are not compared with it, and no stretch outside these bounds is.

Defined results: a null or empty text has no stretch and no licence; the best licence is the one with the highest coefficient,
ties by name; repeated rows are scanned each for itself; an empty table gives an empty table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosopon.llm.common import keyed_text

#: Licence texts in full where they are short, and the notices by which files name the longer ones.
TEMPLATES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
        "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions"
    ),
    "MIT-opening": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MIT-line": "Released under the MIT License.",
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    ),
    "BSD-opening": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"
    ),
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."
    ),
    "Unlicense-line": "This is free and unencumbered software released into the public domain.",
    "reserved": "All rights reserved.",
}


def words_of(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def bigrams_of(text: str) -> list[str]:
    w = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def scan(df: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_units (stretches compared), n_hits (licences found), license (best), dice, licenses (all found, by name). One row per row.
    Templates have two words at least."""
    names = sorted(templates)
    sets = [bigrams_of(templates[k]) for k in names]
    t = round(threshold * 1000)  # thousandths, so that no bound is rounded the wrong way
    every = sorted({b for s in sets for b in s})
    # own: the template's bigrams, words: bigrams of a stretch, least: how many must be shared, order: lower for later names.
    known = F.array(*(
        F.struct(F.array(*map(F.lit, s)).alias("own"), F.lit(len(words_of(templates[k])) - 1).alias("words"), F.lit(len(s)).alias("size"), F.lit(-(-len(s) * t // (2000 - t))).alias("least"), F.lit(-i).alias("order"))
        for i, (k, s) in enumerate(zip(names, sets))
    ))
    normal = F.trim(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "))
    n = F.greatest(F.size("words") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("words", 1, n), F.slice("words", 2, n), lambda a, b: F.concat(a, F.lit(" "), b))
    pair = lambda i: F.get("pairs", i)
    some = F.when(F.size("pairs") > 0, F.filter(F.sequence(F.lit(0), F.size("pairs") - 1), lambda i: pair(i).isin(every))).otherwise(F.array().cast("array<int>"))
    seen = F.array_distinct(F.transform("places", pair))
    live = F.filter(known, lambda k: F.size(F.array_intersect("seen", k["own"])) >= k["least"])
    given = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))  # noqa: E731  (f of a value that is made once)

    def compared(i: Column, k: Column) -> Column:
        """(shared, minus the size of both sets, order) of the stretch at place i, null outside the bounds."""
        return given(
            F.array_distinct(F.slice("pairs", i + 1, k["words"])),
            lambda p: F.when(
                (2000 - t) * F.least(F.size(p), k["size"]) >= t * F.greatest(F.size(p), k["size"]),
                F.struct(F.size(F.array_intersect(p, k["own"])).alias("shared"), (-F.size(p) - k["size"]).alias("less"), k["order"].alias("order")),
            ),
        )

    def counted(state: Column, units: Column) -> Column:
        """The state after the stretches that begin at one place."""
        top = F.array_max(F.filter(units, lambda u: 2000 * u["shared"] >= -t * u["less"]))
        return given(top, lambda u: F.struct(
            (state["n_units"] + F.size(units)).alias("n_units"),
            F.when(u.isNull(), state["best"]).otherwise(F.array_max(F.array(state["best"], F.struct((-2.0 * u["shared"] / u["less"]).alias("dice"), u["order"].alias("order"))))).alias("best"),
            F.when(u.isNull(), state["found"]).otherwise(F.array_union(state["found"], F.array(u["order"]))).alias("found"),
        ))

    def step(state: Column, i: Column) -> Column:
        units = F.transform(F.filter("live", lambda k: F.array_contains(k["own"], pair(i))), lambda k: compared(i, k))
        return given(F.filter(units, lambda u: u.isNotNull()), lambda u: counted(state, u))

    nothing = F.struct(F.lit(0).cast("long").alias("n_units"), F.struct(F.lit(0.0).alias("dice"), F.lit(0).alias("order")).alias("best"), F.array().cast("array<int>").alias("found"))
    # Asking for the size first also keeps the templates that a text may have from being looked for at each place anew.
    result = F.when(F.size("live") > 0, F.reduce("places", nothing, step)).otherwise(nothing)
    name = lambda order: F.get(F.array(*map(F.lit, names)), -order)
    return (
        keyed_text(df, id_col, text_col).select("doc_id", normal.alias("normal"))
        .select("doc_id", F.when(F.col("normal") == "", F.array().cast("array<string>")).otherwise(F.split("normal", " ")).alias("words"))
        .select("doc_id", pairs.alias("pairs"))
        .select("doc_id", "pairs", some.alias("places"))
        .select("doc_id", "pairs", "places", seen.alias("seen"))
        .select("doc_id", "pairs", "places", live.alias("live"))
        .select("doc_id", result.alias("r"))
        .select("doc_id", "r.n_units", "r.best", F.array_sort(F.transform("r.found", name)).alias("found"))
        .select(
            "doc_id", "n_units", F.size("found").cast("long").alias("n_hits"), F.when(F.size("found") > 0, name(F.col("best.order"))).alias("license"),
            F.when(F.size("found") > 0, F.floor(F.col("best.dice") * 10000 + 0.5) / 10000).alias("dice"), F.array_join("found", "|").alias("licenses"),
        )
    )
