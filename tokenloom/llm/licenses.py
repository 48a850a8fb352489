"""Licences of files, by sparse TF-IDF cosine to templates and by directory.

A file is scanned in three kinds of units: each line, each paragraph (between blank lines) and the
whole text, whenever the unit has a word that licences are known by (``CUE``).  The cosine between a unit and each
template is taken in the space of all words; document frequencies come from all files, and a word
outside the templates weighs as much as one that no file has.  The best template at ``HEADER`` or more is the
file's own licence.

A line that is nothing but an SPDX tag, a licence's title or a sentence that puts something under a licence (``NOTICES``) is exact and
scores 1; it counts as its file's header, not towards ``FILE``.  An SPDX expression is kept whole; one with an unknown name is no notice.

A file is a licence file if it is named like one, or if its whole text is a licence: it reaches ``FILE``, has ``FILE_WORDS`` words or
more, and at most one in ``STRANGE`` of them is in no template.  Any other file without a
licence of its own takes that of its nearest ancestor directory with a licence file (found by joining directories with the paths
of their ancestors; several licence files: highest score, then first name).

Everything is DataFrame functions.  Only tables with a row for each template word are broadcast unmeasured; their size is fixed by
``TEMPLATES``.

Edge cases: a null or empty text has no licence of its own; a null path has no directory and inherits
nothing; rows with equal path and text get equal results, one each; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import column
from tokenloom.operators.lookup import lookup
from tokenloom.staging import stage

#: What licence notices say.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights. Public domain dedication, CC0 1.0."),
)
CUE = "licen[sc]|copyright|permission|redistribut|warrant|public domain|spdx"
TERM = "[a-z0-9]+(?:[.+-][a-z0-9]+)*"
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|unlicen[sc]e)([._-].*)?$"
HEADER = 0.7
FILE = 0.6
FILE_WORDS, STRANGE = 30, 10

_V2, _V21, _V3 = (rf",?[ ](?:version[ ]|v\.?[ ]?)?{v}(?:[ ]only|[ ]or[ ](?:any[ ])?later(?:[ ]versions?)?)?" for v in (r"2(?:\.0)?", r"2\.1", r"3(?:\.0)?"))
_GPL = r"(?:(?:gnu[ ])?general[ ]public[ ]licen[sc]e|gnu[ ]gpl|gpl)"
_LGPL = r"(?:(?:gnu[ ])?(?:lesser|library)[ ]general[ ]public[ ]licen[sc]e|gnu[ ]lgpl|lgpl)"
_AGPL = r"(?:(?:gnu[ ])?affero[ ]general[ ]public[ ]licen[sc]e|gnu[ ]agpl|agpl)"
_CC = r"(?:creative[ ]commons|cc)"
_CC4 = r"[ -](?:4\.0)(?:[ ]international)?(?:[ ](?:public[ ])?licen[sc]e)?"
#: Names that licences go by, as patterns in lower case.  A name that is a title has to hold the word licence.
NOTICES = (
    ("MIT", r"(?:mit|expat)(?:[ ]licen[sc]e)?(?:[ ]\(mit\))?"),
    ("Apache-2.0", r"apache(?:[ ]software)?[ ]licen[sc]e(?:,?[ ](?:version[ ]|v\.?[ ]?)?2(?:\.0)?)?|apache[ -]2(?:\.0)?(?:[ ]licen[sc]e)?"),
    ("GPL-2.0", _GPL + _V2 + r"|gpl-?v?2(?:\.0)?(?:[ ]licen[sc]e)?"),
    ("GPL-3.0", _GPL + _V3 + r"|gpl-?v?3(?:\.0)?(?:[ ]licen[sc]e)?"),
    ("LGPL-2.0", _LGPL + _V2 + r"|lgpl-?v?2(?:\.0)?(?:[ ]licen[sc]e)?"),
    ("LGPL-2.1", _LGPL + _V21 + r"|lgpl-?v?2\.1(?:[ ]licen[sc]e)?"),
    ("LGPL-3.0", _LGPL + _V3 + r"|lgpl-?v?3(?:\.0)?(?:[ ]licen[sc]e)?"),
    ("AGPL-3.0", _AGPL + _V3 + r"|agpl-?v?3(?:\.0)?(?:[ ]licen[sc]e)?"),
    ("BSD-2-Clause", r"(?:bsd[ -]2[ -]clause|2[ -]clause[ ]bsd|simplified[ ]bsd|freebsd)(?:[ ]licen[sc]e)?"),
    ("BSD-3-Clause", r"(?:bsd[ -]3[ -]clause|3[ -]clause[ ]bsd|(?:new|modified|revised)[ ]bsd)(?:[ ]licen[sc]e)?"),
    ("ISC", r"isc(?:[ ]licen[sc]e)?"),
    ("Unlicense", r"unlicen[sc]e"),
    ("MPL-2.0", r"(?:mozilla[ ]public[ ]licen[sc]e|mpl)(?:,?[ -](?:version[ ]|v\.?[ ]?)?2\.0)"),
    ("EPL-2.0", r"(?:eclipse[ ]public[ ]licen[sc]e|epl)(?:,?[ -](?:version[ ]|v\.?[ ]?)?2\.0)"),
    ("BSL-1.0", r"boost[ ]software[ ]licen[sc]e(?:,?[ -](?:version[ ]|v\.?[ ]?)?1\.0)?"),
    ("Zlib", r"zlib(?:[ ]licen[sc]e)?"),
    ("CC-BY-4.0", _CC + r"[ -](?:by|attribution)" + _CC4),
    ("CC-BY-SA-4.0", _CC + r"[ -](?:by-sa|attribution-sharealike)" + _CC4),
    ("CC-BY-NC-4.0", _CC + r"[ -](?:by-nc|attribution-noncommercial)" + _CC4),
    ("CC0-1.0", r"(?:creative[ ]commons[ ])?cc0(?:[ -]1\.0)?(?:[ ]universal)?(?:[ ]licen[sc]e)?"),
)
NOTICE_CUE = "licen[sc]|spdx|(?:released|distributed|available) under"
_MARKS = r"[ \t\r#*/;%<!>()\"'-]*"
_UNDER = (
    r"(?:(?:this|the)[ ][a-z ]{2,40}[ ]is[ ]|all[ ]code[ ]is[ ])?"
    r"(?:(?:dual[- ])?licen[sc]ed|released|distributed|(?:made[ ])?available|subject[ ]to[ ]the[ ]terms[ ]of|provided)(?:[ ]under)?[ ](?:the[ ]terms[ ]of[ ])?(?:the[ ])?"
)
_REST = r"(?:[ ]\(the[ ]\"licen[sc]e\"\))?(?:[.,;]?[ ]\(?(?:see|as[ ]found[ ]in|which[ ]can[ ]be[ ]found[ ]in|found[ ]in)[ ].{1,100})?"
_TAG = rf"^{_MARKS}spdx-license-identifier:[ \t]*([a-z0-9.+() -]+?)[ \t\r*/>-]*$"
#: SPDX names in their own spelling; operators stay as they are.
SPDX = (
    "MIT", "MIT-0", "Apache-1.1", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Unlicense", "Zlib", "BSL-1.0", "MPL-1.1", "MPL-2.0", "EPL-1.0",
    "EPL-2.0", "WTFPL", "Artistic-2.0", "PSF-2.0", "Python-2.0", "PostgreSQL", "NCSA", "MS-PL", "EUPL-1.2", "CDDL-1.0", "CC0-1.0", "OFL-1.1",
    *(f"{g}{end}" for g in ("GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for end in ("", "+", "-only", "-or-later")),
    *(f"CC-BY{part}-{v}" for part in ("", "-SA", "-NC", "-ND", "-NC-SA", "-NC-ND") for v in ("3.0", "4.0")),
    "AND", "OR", "WITH", "Classpath-exception-2.0", "LLVM-exception", "GCC-exception-3.1", "Linux-syscall-note",
)


def template_terms() -> list[Counter]:
    """Term counts of each template."""
    return [Counter(re.findall(TERM, text.lower())) for _, text in TEMPLATES]


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TERM), F.lit(0))


def _files(df: DataFrame, path: str, text: str) -> DataFrame:
    """``(path, a, b, low)``: a 128-bit name for equal rows, and the text in lower case."""
    named = df.select(column(path).alias("path"), column(text).alias("text"))
    both = [F.col("path"), F.col("text")]
    return named.select(
        "path",
        F.xxhash64(F.lit(1), *both).alias("a"),
        F.xxhash64(F.lit(2), F.reverse("text"), F.col("path")).alias("b"),
        F.lower("text").alias("low"),
    )


def inverse_frequencies(files: DataFrame) -> tuple[DataFrame, float]:
    """``(term, idf)`` of the templates' terms over all files, and the weight of a word that is in none."""
    vocabulary = sorted({t for c in template_terms() for t in c})
    found = F.array_intersect(_terms(F.col("low")), F.lit(vocabulary))  # distinct terms
    counts = files.select(F.explode(found).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = files.count()
    spark = files.sparkSession
    every = spark.createDataFrame([(t,) for t in vocabulary], "term string").join(counts, "term", "left")
    idf = F.log((total + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1
    return every.select("term", idf.alias("idf")), math.log(total + 1) + 1


def _units(files: DataFrame) -> DataFrame:
    """``(a, b, whole, unit, text)``: lines, paragraphs and whole texts with a cue, each once."""
    cue = files.filter(F.regexp_like("low", F.lit(CUE))).select("a", "b", "low").distinct()
    parts = F.array_union(F.split("low", "\n"), F.split("low", r"\n[ \t]*\n"))
    parts = F.filter(F.array_except(parts, F.array("low")), lambda x: F.regexp_like(x, F.lit(CUE)))
    every = F.concat(F.array("low"), parts)
    return cue.select("a", "b", F.posexplode(every).alias("unit", "text"))


def notices(files: DataFrame) -> DataFrame:
    """``(a, b, licence)`` of the lines that are a notice and nothing else."""
    lines = files.filter(F.regexp_like("low", F.lit(NOTICE_CUE))).select("a", "b", F.explode(F.split("low", "\n")).alias("line"))
    lines = lines.filter(F.regexp_like("line", F.lit(NOTICE_CUE))).distinct()
    named = []
    for name, pattern in NOTICES:
        title = rf"^{_MARKS}(?=.*licen[sc]e)(?:the[ ])?(?:{pattern})[ .]*{_MARKS}$"
        under = rf"^{_MARKS}{_UNDER}(?:{pattern})(?:[ ]licen[sc]e)?{_REST}[ .]*{_MARKS}$"
        named.append(F.when(F.regexp_like("line", F.lit(title)) | F.regexp_like("line", F.lit(under)), F.lit(name)))
    spelling = F.create_map(*[F.lit(x) for n in SPDX for x in (n.lower(), n)])
    words = F.filter(F.split(F.regexp_replace(F.regexp_extract("line", _TAG, 1), r"([()])", r" $1 "), " +"), lambda x: x != "")
    words = F.transform(words, lambda x: F.when(x.isin("(", ")"), x).otherwise(F.element_at(spelling, x)))
    tag = F.when(~F.exists(words, lambda x: x.isNull()) & (F.size(words) > 0), F.array_join(words, " "))
    tag = F.regexp_replace(F.regexp_replace(tag, r"\( ", "("), r" \)", ")")
    return lines.select("a", "b", F.coalesce(tag, *named).alias("licence")).filter("licence IS NOT NULL")


def scores(files: DataFrame) -> DataFrame:
    """``(a, b, licence, score, whole)``: best template of any unit, and the best score of a whole text that is a licence."""
    idf, unseen = inverse_frequencies(files)
    idf = stage(idf, "idf")
    weight = {r.term: r.idf for r in idf.collect()}  # one row for each template term
    counted = template_terms()
    norms = [math.sqrt(sum((n * weight[t]) ** 2 for t, n in c.items())) for c in counted]
    rows = [(t, w, [c[t] * w / norm for c, norm in zip(counted, norms, strict=True)]) for t, w in weight.items()]
    table = files.sparkSession.createDataFrame(rows, "term string, idf double, parts array<double>")

    units = _units(files).select("a", "b", "unit", F.explode(_terms(F.col("text"))).alias("term"))
    terms = units.groupBy("a", "b", "unit", "term").agg(F.count(F.lit(1)).alias("tf")).join(F.broadcast(table), "term", "left")
    w = F.col("tf") * F.coalesce("idf", F.lit(unseen))
    dots = [F.sum(w * F.col("parts")[i]).alias(f"d{i}") for i in range(len(TEMPLATES))]
    words, strange = F.sum("tf"), F.sum(F.when(F.col("idf").isNull(), F.col("tf")).otherwise(0))
    full = ((words >= FILE_WORDS) & (strange * STRANGE <= words)).alias("full")
    sums = terms.groupBy("a", "b", "unit").agg(F.sum(w * w).alias("square"), full, *dots)
    best = F.array_max(
        F.array(
            *[
                F.struct(F.round(F.coalesce(f"d{i}", F.lit(0.0)) / F.sqrt("square"), 6).alias("score"), F.lit(name).alias("licence"))
                for i, (name, _) in enumerate(TEMPLATES)
            ]
        )
    )
    found = sums.select("a", "b", "unit", "full", best.alias("best"))
    exact = F.struct(F.lit(1.0).alias("score"), "licence").alias("best")
    found = found.unionByName(notices(files).select("a", "b", F.lit(-1).alias("unit"), F.lit(False).alias("full"), exact))
    whole = F.max(F.when((F.col("unit") == 0) & F.col("full"), F.col("best.score")))
    return found.groupBy("a", "b").agg(F.max("best").alias("best"), whole.alias("whole")).select(
        "a", "b", "best.licence", "best.score", "whole"
    )


def parent(path: Column) -> Column:
    """The directory of a path, '' for one without."""
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.when(path.isNotNull(), ""))


def ancestors(directory: Column) -> Column:
    """A directory and all above it, up to the root ''."""
    parts = F.split(directory, "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    return F.array_distinct(up)


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """``(dir, near, near_licence)`` of distinct directories: the nearest ancestor in ``licensed`` (``dir, licence``)."""
    up = directories.select("dir", F.explode(ancestors(F.col("dir"))).alias("near"))
    met = up.join(licensed.select(F.col("dir").alias("near"), F.col("licence").alias("near_licence")), "near")
    deepest = F.max(F.struct(F.length("near").alias("depth"), "near", "near_licence")).alias("best")
    return met.groupBy("dir").agg(deepest).select("dir", "best.near", "best.near_licence")


def scan(df: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """``(path, own_licence, score, licence_file, from_dir, licence)`` of each row.

    ``licence`` is the file's own or the inherited one; ``from_dir`` the directory it is inherited from.  Runs jobs:
    document frequencies, scores, and the sizes of what is broadcast.
    """
    files = _files(df, path, text)
    scored = stage(scores(files), "licences")
    name = F.regexp_extract("path", r"[^/]*$", 0)
    light = files.select("path", "a", "b")
    # Few files name a licence; the rest of the rows need no shuffle if these measure small.
    key = F.concat_ws(":", F.col("a").cast("string"), F.col("b").cast("string")).alias("k")
    found = lookup(light.select("path", key), scored.select(key, "licence", "score", "whole"), "k").drop("k")
    own = F.col("score") >= HEADER
    is_file = (F.regexp_like(name, F.lit(LICENCE_FILE)) & own) | (F.col("whole") >= FILE)
    rows = found.withColumns(
        {
            "dir": parent(F.col("path")),
            "own_licence": F.when(own | is_file, F.col("licence")),
            "licence_file": F.coalesce(is_file & F.col("path").isNotNull(), F.lit(False)),
        }
    )
    rows = stage(rows.select("path", "dir", "own_licence", F.when(F.col("own_licence").isNotNull(), F.col("score")).alias("score"), "licence_file"), "scanned")
    # The smallest of (-score, name): highest score, then first name.
    first = F.min(F.struct((-F.col("score")).alias("s"), F.col("own_licence").alias("licence"))).alias("first")
    licensed = rows.filter("licence_file").groupBy("dir").agg(first).select("dir", "first.licence")
    near = stage(inherited(rows.filter("dir IS NOT NULL").select("dir").distinct(), licensed), "directories")
    joined = lookup(rows, near, "dir")
    takes = F.col("own_licence").isNull()
    return joined.select(
        "path",
        "own_licence",
        "score",
        "licence_file",
        F.when(takes, F.col("near")).alias("from_dir"),
        F.coalesce("own_licence", "near_licence").alias("licence"),
    )
