"""Licence scans: sparse TF-IDF cosine of passages to licence templates, then inheritance from the nearest directory.

Everything here is DataFrame and SQL functions.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twincheck.llm.decontaminate import _LOWER, _UPPER
from twincheck.llm.scratch import Scratch

# Fixed values: (licence, template), common notices, short and long, and what tells licence texts apart.
_GNU_HEADERS = tuple(
    (licence, f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as "
     f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version")
    for licence, thing, name, version in (
        ("GPL-3.0", "program", "General Public License", "3"), ("GPL-2.0", "program", "General Public License", "2"),
        ("LGPL-3.0", "library", "Lesser General Public License", "3"),
        ("LGPL-2.1", "library", "Lesser General Public License", "2.1"),
        ("AGPL-3.0", "program", "Affero General Public License", "3"),
    )
)
_GNU_NAMES = tuple(
    (licence, text.format(name=name, version=version, date=date))
    for licence, name, version, date in (
        ("GPL-3.0", "General Public License", "3", "29 June 2007"), ("GPL-2.0", "General Public License", "2", "June 1991"),
        ("LGPL-3.0", "Lesser General Public License", "3", "29 June 2007"),
        ("LGPL-2.1", "Lesser General Public License", "2.1", "February 1999"),
        ("AGPL-3.0", "Affero General Public License", "3", "19 November 2007"),
    )
    for text in ("This work is licensed under the GNU {name}, version {version}", "GNU {name} Version {version}, {date}")
)
_CREATIVE = tuple(
    (f"CC-{code}-4.0", text.format(code=code, name=name))
    for code, name in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
        ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    )
    for text in ("Licensed under CC {code} 4.0", "Creative Commons {name} 4.0 International",
                 "This work is licensed under a Creative Commons {name} 4.0 International License")
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. {third}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED."
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software"),
    *_GNU_NAMES,
    *_GNU_HEADERS,
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"),
    ("BSD-2-Clause", _BSD.format(third="")),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("BSD-3-Clause", _BSD.format(third=_BSD_THIRD)),
    ("ISC", "Released under the ISC License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
     "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
     "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    *_CREATIVE,
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work "
     "under CC0 1.0"),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
#: A passage must have all of these that the template has: names, version digits, and the word that tells a licence's name
#: from a common word of some language.
DECISIVE = (
    "1", "2", "3", "4", "affero", "apache", "attribution", "bsd", "by", "cc", "cc0", "clause", "creative", "eclipse", "endorse",
    "general", "gnu", "isc", "lesser", "license", "mit", "mozilla", "nc", "nd", "noderivatives", "noncommercial", "sa", "sharealike",
    "unencumbered",
)
#: It must have none of these that the template lacks: they turn one licence into another.
QUALIFIERS = (
    "affero", "lesser", "nc", "nd", "sa", "noncommercial", "noderivatives", "noderivs", "sharealike", "endorse", "igo",
)
#: A declared identifier, or an expression of several; it decides before any cosine.
SPDX = (
    r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?"
    r"(?: +(?:AND|OR|WITH) +[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?)*)"
)
#: Part of an identifier that names the same licence.
SPDX_VARIANT = r"(?:-only|-or-later|[+])( |$)"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)([.-].*)?$"


@dataclass(frozen=True)
class LicenceScan:
    """A passage has a template's licence from a cosine of ``least`` on, if names and versions (``DECISIVE``) and
    ``QUALIFIERS`` agree."""

    templates: Sequence[tuple[str, str]] = TEMPLATES
    least: float = 0.7


def words(text: str) -> str:
    """SQL for the words of a text: runs of digits and letters a-z, A-Z lower-cased."""
    return f"array_remove(split(translate({text}, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+'), '')"


def _listed(terms) -> str:
    return "array(" + ", ".join(f"'{t}'" for t in sorted(terms)) + ")"


def template_words(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def anchors(vectors: list[dict[str, float]], least: float) -> set[str]:
    """Terms of which every passage similar enough to any of the vectors has at least one.

    Without its heaviest terms a template is shorter than ``least`` times itself; a passage that has none of them meets
    only the rest, so its cosine is below ``least``.
    """
    found = set()
    for vector in vectors:
        rest = total = sum(w * w for w in vector.values())
        for term in sorted(vector, key=lambda t: (-vector[t], t)):
            if rest < least * least * total:
                break
            found.add(term)
            rest -= vector[term] ** 2
    return found


def _needed(vector: dict[str, float], idf: dict[str, float], least: float) -> set[str]:
    """Terms of which a passage that may have the template has one: its rarest decisive term, which it must have, if any."""
    decisive = [t for t in vector if t in DECISIVE]
    return {max(decisive, key=lambda t: (idf[t], t))} if decisive else anchors([vector], least)


def qualifier_mask(terms) -> int:
    return sum(1 << i for i, q in enumerate(QUALIFIERS) if q in terms)


def _identified(files: DataFrame) -> DataFrame:
    """path, digest, best: the first declared identifier of each text that has one."""
    pattern, variant = SPDX.replace("\\", "\\\\"), SPDX_VARIANT.replace("\\", "\\\\")
    return (
        files.filter("contains(text, 'SPDX-License-Identifier:')")
        .selectExpr("path", "digest", f"regexp_extract(text, '{pattern}', 1) AS declared")
        .filter("declared <> ''")
        .selectExpr("path", "digest", f"struct(2D AS score, regexp_replace(declared, '{variant}', '$1') AS licence) AS best")
    )


def own_licences(files: DataFrame, scratch: Scratch, rule: LicenceScan = LicenceScan()) -> DataFrame:
    """``files`` (path, text) to path, digest, licence, score: the declared SPDX identifier of each text (score 1), else its
    best template.

    Passages are all lines, all blocks between empty lines, and the whole text of a licence file. Weights are term
    frequency times ln((1 + files) / (1 + files with the term)) + 1, counted over all files; a word that no template has
    counts as a term of its own that no file has.
    """
    templates = [Counter(template_words(text)) for _, text in rule.templates]
    vocabulary = set().union(*templates)
    texts = files.selectExpr("path", "coalesce(xxhash64(text), 0L) AS digest", "coalesce(text, '') AS text")
    terms = texts.selectExpr(f"explode(concat(array(''), array_intersect({words('text')}, {_listed(vocabulary)}))) AS term")
    # At most one row for each term of the templates, and one for the number of files.
    df = {r["term"]: r["count"] for r in terms.groupBy("term").count().collect()}
    n = df.get("", 0)
    idf = {t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 for t in vocabulary}
    strange = math.log(1 + n) + 1
    vectors = [{t: tf * idf[t] for t, tf in template.items()} for template in templates]
    needed = _listed(set().union(*(_needed(vector, idf, rule.least) for vector in vectors)))

    spark = files.sparkSession
    weights = spark.createDataFrame([(t, idf[t]) for t in sorted(vocabulary)], "term string, idf double")
    template_rows = [
        (number, licence, t, w / math.sqrt(sum(x * x for x in vector.values())), int(t in DECISIVE),
         len(vector.keys() & set(DECISIVE)), qualifier_mask(vector))
        for number, ((licence, _), vector) in enumerate(zip(rule.templates, vectors))
        for t, w in sorted(vector.items())
    ]
    by_term = spark.createDataFrame(
        template_rows,
        "template int, licence string, term string, weight double, decisive int, wanted int, allowed long",
    )

    name = "element_at(split(path, '/'), -1)"
    passages = (
        texts.filter(f"arrays_overlap({words('text')}, {needed})")
        .selectExpr(
            "path",
            "digest",
            r"explode(array_distinct(concat(split(text, '\n'), split(text, '\n[ \t\r]*\n'),"
            f" CASE WHEN {name} RLIKE '{LICENCE_FILE}' THEN array(text) ELSE cast(array() AS array<string>) END)))"
            " AS passage",
        )
        .selectExpr("path", "digest", "xxhash64(passage) AS passage", f"{words('passage')} AS w")
        .filter(f"arrays_overlap(w, {needed})")
        .distinct()
    )
    counted = (
        passages.select("path", "digest", "passage", F.explode("w").alias("term"))
        .groupBy("path", "digest", "passage", "term")
        .agg(F.count("*").alias("tf"))
        .join(F.broadcast(weights), "term", "left")
    )
    vector = scratch.save(counted.selectExpr("*", "tf * idf AS weight"), "passages")
    key = ["path", "digest", "passage"]
    marks = " ".join(f"WHEN '{q}' THEN {1 << i}L" for i, q in enumerate(QUALIFIERS))
    lengths = vector.groupBy(*key).agg(
        F.expr(f"sqrt(sum(CASE WHEN idf IS NULL THEN tf * {strange!r}D * {strange!r}D ELSE weight * weight END))").alias("length"),
        F.expr(f"bit_or(CASE term {marks} ELSE 0L END)").alias("qualifiers"),
    )
    return (
        vector.withColumnRenamed("weight", "own")
        .join(F.broadcast(by_term), "term")
        .groupBy(*key, "template", "licence", "wanted", "allowed")
        .agg(F.sum(F.expr("own * weight")).alias("dot"), F.sum("decisive").alias("found"))
        .filter("found = wanted")
        .join(lengths, key)
        .filter("qualifiers & ~allowed = 0")
        .selectExpr("path", "digest", "licence", "dot / length AS score")
        .filter(F.col("score") >= rule.least)
        .selectExpr("path", "digest", "struct(round(score, 9) AS score, licence) AS best")
        .unionByName(_identified(texts))
        .groupBy("path", "digest")
        .agg(F.max("best").alias("best"))
        .selectExpr("path", "digest", "best.licence AS licence", "least(best.score, 1D) AS score")
    )


def scan_licences(files: DataFrame, rule: LicenceScan = LicenceScan()) -> DataFrame:
    """``files`` (path, text, any more columns) with licence, score, origin (own or inherited, null without a licence)
    and licence_dir, for every row.

    A file with a licence of its own keeps it. Another takes that of the nearest directory, its own first and then
    upwards, that has a licence file (LICENSE, COPYING, ... by name) with a licence: of several the one with the highest
    score, then the greatest name. Directories, not files, are joined with their ancestors; files are joined once, on
    their directory, and a directory with a large share of the files splits over tasks.

    Null and empty texts have no licence of their own but inherit. A null path inherits nothing. Repeated paths are
    judged by their own texts; an empty table gives no rows.
    """
    scratch = Scratch(files.sparkSession, "licences")
    extra = [c for c in files.columns if c not in ("path", "text")]
    short = files.select("path", F.expr("coalesce(xxhash64(text), 0L)").alias("digest"), *extra)
    own = scratch.save(own_licences(files.select("path", "text"), scratch, rule), "own")
    directory = "regexp_replace(path, '[^/]*$', '')"
    licensed = (
        own.filter(f"element_at(split(path, '/'), -1) RLIKE '{LICENCE_FILE}'")
        .groupBy(F.expr(directory).alias("above"))
        .agg(F.max(F.struct("score", "licence")).alias("given"))
    )
    # A directory ends in a slash; its ancestors are its prefixes that do, the empty one included.
    nearest = (
        files.selectExpr(f"{directory} AS dir")
        .filter("dir IS NOT NULL")
        .distinct()
        .selectExpr("dir", "explode(sequence(0, size(split(dir, '/')) - 1)) AS depth")
        .selectExpr(
            "dir", "depth", "concat_ws('/', slice(split(dir, '/'), 1, depth)) || CASE WHEN depth > 0 THEN '/' ELSE '' END AS above"
        )
        .join(licensed, "above")
        .groupBy("dir")
        .agg(F.max(F.struct("depth", "above", "given")).alias("found"))
    )
    with_own = short.alias("f").join(own.alias("o"), F.expr("f.path <=> o.path AND f.digest = o.digest"), "left")
    return (
        with_own.selectExpr("f.*", "o.licence AS own_licence", "o.score AS own_score")
        .join(nearest, F.expr(f"{directory} = dir"), "left")
        .selectExpr(
            "path",
            *[f"`{c}`" for c in extra],
            "coalesce(own_licence, found.given.licence) AS licence",
            "coalesce(own_score, found.given.score) AS score",
            "CASE WHEN own_licence IS NOT NULL THEN 'own' WHEN found IS NOT NULL THEN 'inherited' END AS origin",
            "CASE WHEN own_licence IS NULL THEN found.above END AS licence_dir",
        )
    )
