import pytest

from twincheck.llm.licenses import TEMPLATES, LicenceScan, anchors, scan_licences, template_words


@pytest.fixture(scope="module")
def filler(spark):
    words = "river stone window garden under the with and for table lamp green paper to of in is may use this not be by"
    return [(f"fill/{i}/f{j}.txt", f"{words} {i} {j}") for i in range(5) for j in range(8)]


def scan(spark, rows, rule=LicenceScan()):
    found = scan_licences(spark.createDataFrame(rows, "path string, text string"), rule).collect()
    return {r["path"]: (r["licence"], r["origin"], r["licence_dir"]) for r in found}


def test_every_template_is_its_own_licence(spark, filler):
    rows = [(f"t/{i}.txt", f"# some text\n// {text}.\nmore text here") for i, (_, text) in enumerate(TEMPLATES)]
    found = scan(spark, rows + filler)
    for i, (licence, _) in enumerate(TEMPLATES):
        assert found[f"t/{i}.txt"] == (licence, "own", None)
    assert all(found[path][0] is None for path, _ in filler)


def test_headers_over_several_lines(spark, filler):
    notice = TEMPLATES[1][1].split()
    lines = "\n".join(" * " + " ".join(notice[i : i + 6]) for i in range(0, len(notice), 6))
    found = scan(spark, [("a.c", f"/*\n{lines}\n */\n\nint main() {{ return 0; }}")] + filler)
    assert found["a.c"] == ("Apache-2.0", "own", None)


def test_the_nearest_directory_gives_its_licence(spark, filler):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        ("LICENSE", mit), ("top.txt", "nothing"), ("a/b/COPYING", gpl), ("a/b/LICENSE.md", "words only"), ("a/x.txt", None),
        ("a/b/c/d/y.txt", ""), ("a/b/own.txt", f"z\n{mit}"), ("a/bc/z.txt", "q"), (None, "q"), (None, mit), ("a/b/", "q"),
    ]
    found = scan(spark, rows + filler)
    assert found["top.txt"] == ("MIT", "inherited", "") and found["a/x.txt"] == ("MIT", "inherited", "")
    assert found["a/b/c/d/y.txt"] == ("GPL-3.0", "inherited", "a/b/") and found["a/b/"] == ("GPL-3.0", "inherited", "a/b/")
    assert found["a/b/own.txt"] == ("MIT", "own", None) and found["a/bc/z.txt"] == ("MIT", "inherited", "")
    assert found["a/b/LICENSE.md"] == ("GPL-3.0", "inherited", "a/b/")


def test_edge_cases(spark, filler):
    mit = "Released under the MIT License"
    schema = "path string, text string, licence_id int, score2 int"
    rows = [("d/a.txt", mit, 1, 2), ("d/a.txt", mit, 1, 2), ("d/a.txt", None, 1, 2), ("e/l.txt", "word " * 60_000 + f"\n{mit}\n", 1, 2)]
    files = spark.createDataFrame(rows, schema)
    found = [tuple(r) for r in scan_licences(files).select("path", "licence_id", "licence").collect()]
    assert sorted(found, key=repr) == sorted(
        [("d/a.txt", 1, "MIT"), ("d/a.txt", 1, "MIT"), ("d/a.txt", 1, None), ("e/l.txt", 1, "MIT")], key=repr
    )
    assert scan_licences(files.limit(0)).count() == 0


def test_anchors_bound_the_cosine():
    vectors = [{"a": 3.0, "b": 2.0, "c": 1.0}, {"c": 1.0}]
    assert anchors(vectors, 0.7) == {"a", "c"}
    assert anchors([{}], 0.7) == set() and template_words("A-b, (C) 2.0") == ["a", "b", "c", "2", "0"]


GNU = "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU {0} License\nas published by the Free Software Foundation; either version {1}\nof the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it will be useful."


def test_headers_name_their_own_family_and_version(spark, filler):
    cases = {
        "gpl2": (GNU.format("General Public", 2), "GPL-2.0"),
        "gpl3": (GNU.format("General Public", 3), "GPL-3.0"),
        "lgpl21": (GNU.format("Lesser General Public", 2.1).replace("program", "library"), "LGPL-2.1"),
        "lgpl3": (GNU.format("Lesser General Public", 3), "LGPL-3.0"),
        "agpl": (GNU.format("Affero General Public", 3), "AGPL-3.0"),
        "gpl4": (GNU.format("General Public", 4), None),
        "nd": ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
        "ncnd": ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "CC-BY-NC-ND-4.0"),
        "by": ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
        "igo": ("Licensed under CC BY IGO 4.0.", None),
        "apache1": ("Licensed under the Apache License, Version 1.1", None),
        "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "MPL-2.0"),
        "mpl1": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", None),
        "none": ("This work is licensed under a proprietary license, version 3", None),
    }
    found = scan(spark, [(f"h/{name}.c", text) for name, (text, _) in cases.items()] + filler)
    assert {name: found[f"h/{name}.c"][0] for name in cases} == {name: licence for name, (_, licence) in cases.items()}


def test_declared_identifiers_decide(spark, filler):
    cases = {
        "GPL-2.0-only": "GPL-2.0", "GPL-3.0-or-later": "GPL-3.0", "MIT": "MIT", "BSD-2-Clause": "BSD-2-Clause", "LGPL-2.1+": "LGPL-2.1",
        "Apache-2.0 OR GPL-2.0-or-later": "Apache-2.0 OR GPL-2.0", "GPL-2.0-only WITH Classpath-exception-2.0": "GPL-2.0 WITH Classpath-exception-2.0",
        "EPL-2.0.": "EPL-2.0", "Anything-9.9": "Anything-9.9",
    }
    rows = [(f"s/{i}.c", f"/* SPDX-License-Identifier: {name} */\n// Released under the MIT License") for i, name in enumerate(cases)]
    found = scan(spark, rows + [("s/bad.c", "SPDX-License-Identifier: */ x")] + filler)
    assert [found[f"s/{i}.c"][0] for i in range(len(cases))] == list(cases.values())
    assert found["s/bad.c"][0] is None


def test_whole_licence_texts(spark, filler):
    text = dict((licence, t) for licence, t in TEMPLATES if licence.startswith("BSD"))
    broken = {k: t.replace("met: 1.", "met:\n\n1.").replace(" 2. Re", "\n\n2. Re").replace(" 3. N", "\n\n3. N") for k, t in text.items()}
    titles = {
        "GPL-3.0": "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\n", "GPL-2.0": "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n\n",
        "LGPL-2.1": "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999\n\n", "MPL-2.0": "Mozilla Public License Version 2.0\n====\n\n",
        "Apache-2.0": "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/\n\n", "EPL-2.0": "Eclipse Public License - v 2.0\n\n",
    }
    rows = [(f"{k}/LICENSE", f"Copyright (c) 2024, someone\n\n{t}") for k, t in broken.items()]
    rows += [(f"{k}/COPYING", t + "Preamble of many words. " * 300) for k, t in titles.items()]
    found = scan(spark, rows + filler)
    assert {path.split("/")[0]: found[path][0] for path, _ in rows} == {k: k for k in [*broken, *titles]}
