import math
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from tokenloom.llm import licenses as L
from tokenloom.llm import queries

MIT, APACHE = L.TEMPLATES[1][1], L.TEMPLATES[2][1]


def brute(rows):
    """Every unit against every template with plain dictionaries; then walk up the directories."""
    n = len(rows)
    words = [re.findall(L.TERM, (t or "").lower()) for _, t in rows]
    counted = L.template_terms()
    vocabulary = {t for c in counted for t in c}
    df = Counter(t for w in words for t in set(w) & vocabulary)
    idf = lambda t: math.log((n + 1) / ((df[t] if t in vocabulary else 0) + 1)) + 1
    norm = lambda c: math.sqrt(sum((k * idf(t)) ** 2 for t, k in c.items()))

    def best(unit):
        c = Counter(re.findall(L.TERM, unit))
        return max(
            (round(sum(c[t] * idf(t) * k * idf(t) for t, k in x.items()) / (norm(c) * norm(x)), 6), name)
            for x, (name, _) in zip(counted, L.TEMPLATES, strict=True)
        )

    own = []
    for path, text in rows:
        low = (text or "").lower()
        units = [u for u in {low, *low.split("\n"), *re.split(r"\n[ \t]*\n", low)} if re.search(L.CUE, u)]
        score, name = max(map(best, units), default=(0.0, None))
        every = re.findall(L.TERM, low)
        full = len(every) >= L.FILE_WORDS and L.STRANGE * sum(t not in vocabulary for t in every) <= len(every)
        whole = best(low)[0] if full and re.search(L.CUE, low) else 0.0
        named = bool(re.search(L.LICENCE_FILE, (path or "").rsplit("/", 1)[-1]))
        is_file = (named and score >= L.HEADER) or whole >= L.FILE
        own.append((path, name if score >= L.HEADER or is_file else None, score, is_file and path is not None))
    dirs = {}
    for path, name, score, is_file in own:
        if is_file:
            d = path.rsplit("/", 1)[0] if "/" in path else ""
            dirs[d] = min(dirs.get(d, (1, "")), (-score, name))
    out = []
    for path, name, score, is_file in own:
        origin = None
        if name is None and path is not None:
            d = path.rsplit("/", 1)[0] if "/" in path else ""
            while d not in dirs and d:
                d = d.rsplit("/", 1)[0] if "/" in d else ""
            origin = d if d in dirs else None
        out.append((path, name, score if name else None, is_file, origin, name or (dirs[origin][1] if origin is not None else None)))
    return sorted(out, key=str)


ROWS = [
    ("a/LICENSE", MIT), ("a/x.py", "code here\nmore code"), ("a/b/y.py", "plain text"), ("a/b/COPYING.txt", L.TEMPLATES[5][1]),
    ("a/b/c/d/z.py", "deep text"), ("a/b/h.py", "# " + APACHE + "\nimport os\nlong body of words that go on"), ("top.py", "nothing"),
    ("q/LICENSE", "not a licence at all, but words about other things"), ("q/r.py", "words"), ("ab/x.py", "sibling prefix of a"),
    ("s/one.txt", "Licensed under CC BY-NC 4.0."), ("s/two.txt", "some other text"), ("s/LICENSE", "Released under the MIT License."),
    ("m/n.py", "first paragraph\n\n" + MIT.replace(" to ", "\nto ") + "\n\nlast words"), ("e/empty.py", ""), ("e/null.py", None),
    (None, MIT), (None, "x"), ("a/x.py", "code here\nmore code"), ("long/z.txt", "many words " * 30_000 + "\n" + APACHE),
]


def test_equals_brute_force(spark):
    docs = spark.createDataFrame([(*r, 1) for r in ROWS], "path string, text string, score int").repartition(4)
    got = sorted((tuple(r) for r in L.scan(docs).collect()), key=str)
    assert got == brute(ROWS)
    by = {r[0]: r for r in got}
    assert by["a/x.py"][4:] == ("a", "MIT") and by["a/b/y.py"][4:] == ("a/b", "GPL-3.0")
    assert by["a/b/c/d/z.py"][4] == "a/b" and by["a/b/h.py"][1] == "Apache-2.0" and by["ab/x.py"][5] is None


def test_empty_table(spark):
    assert L.scan(spark.createDataFrame([], "path string, text string")).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(ROWS, "path string, text string")
    plan = L.scan(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_ancestors(spark):
    got = spark.range(1).select(L.ancestors(F.lit("a/b/c")), L.ancestors(F.lit(""))).first()
    assert got[0] == ["", "a", "a/b", "a/b/c"] and got[1] == [""]


def test_headers_that_are_no_template(spark):
    want = {
        "SPDX-License-Identifier: MIT": "MIT", "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
        "/* SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note */": "GPL-2.0-only WITH Linux-syscall-note",
        "# SPDX-License-Identifier: (MIT OR Apache-2.0)": "(MIT OR Apache-2.0)", "SPDX-License-Identifier: Made-Up-9.9": None,
        "MIT License": "MIT", "Apache License": "Apache-2.0", "Licensed under the MIT license": "MIT", "ISC License": "ISC",
        "This software is released under the MIT License, see LICENSE.txt.": "MIT", "BSD 2-Clause License": "BSD-2-Clause",
        "Licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0", "The Unlicense": "Unlicense",
        "Licensed under the GNU General Public License, version 2.": "GPL-2.0", "Released under GPLv3.": "GPL-3.0",
        "GNU Affero General Public License v3.0 or later": "AGPL-3.0", "Licensed under the GNU LGPL v2.1": "LGPL-2.1",
        "Licensed under the Apache License, Version 2.0 (the \"License\");": "Apache-2.0", "The licence of the town ran out": None,
        "A driver under MIT License law was here": None, "isc": None, "the mit": None,
    }
    rows = [(f"d{i}/x.py", f"import os\n{line}\nwords of a body") for i, line in enumerate(want)]
    got = {r.path: r for r in L.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert {line: got[f"d{i}/x.py"].own_licence for i, line in enumerate(want)} == want
    assert not got["d0/x.py"].licence_file


def test_a_short_text_with_a_notice_licenses_nothing_and_sql_states_the_notices(spark, tmp_path):
    texts = [
        "Released under the MIT License.", "a line of prose\nThis work is licensed under the GNU General Public License, version 3.",
        "no notice at all", "SPDX-License-Identifier: MIT\nx = 1", "# SPDX-License-Identifier: (MIT OR Apache-2.0)", "MIT License",
        "Licensed under the GNU LGPL v2.1", "This software is released under the MIT License, see LICENSE.txt.", "SPDX-License-Identifier: Made-Up-9.9",
        "The licence of the town ran out", "isc", "/* SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note */", None, "",
    ]
    full = [(20, L.TEMPLATES[1][1], "en", "lib"), (21, "words", "en", "lib")]
    rows = [(i, t, "en", "src") for i, t in enumerate(texts)] + full
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.queries()["op1_license_scans"](spark, str(tmp_path))
    names = got.columns
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    sql = con.execute(queries.oracle_sql()["op1_license_scans"])
    order = [[d[0] for d in sql.description].index(c) for c in names]
    assert sorted(map(str, (tuple(r[i] for i in order) for r in sql.fetchall()))) == sorted(str(tuple(r)) for r in got.collect())
    licence = {r.path: (r.licence_file, r.licence) for r in got.collect()}
    assert licence["src/en/3"] == (False, "MIT") and licence["src/en/2"] == (False, None) and licence["src/en/8"] == (False, None)
    assert licence["lib/en/20"] == (True, "MIT") and licence["lib/en/21"] == (False, "MIT")
