"""License scan: sparse TF-IDF cosine of headers and license files to templates, then directory inheritance.

Templates are one-sentence statements and whole license texts.  Windows of a
template's length over a file's terms (across lines, so that wrapped headers and
neighbouring notices do not matter), its lines and the whole file are compared
with the templates; the weights of all terms come from the number of files in
the corpus that hold them.  Windows that cannot reach the threshold are left out
early; the others' terms are joined to the table of all terms.  A file's own
license is its best window at or over the threshold.  A directory has the
license of the license files in it.  A file without a license of its own takes
that of its nearest ancestor directory that has one, found by joins on paths.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from math import log, sqrt
from pathlib import Path
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import prepare, stored, text_or_empty

THRESHOLD = 0.8
# Windows of more terms begin at lines and at that many steps a length, shorter ones at every term.
LONG, STEPS = 64, 32
# Terms that a task counts before it hands them on.
HELD = 300_000
# How files state these licenses, one statement a template.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the terms of the MIT License."),
    ("MIT", "Licensed under the terms of the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]
# The GNU licenses by name, version and identifier, and what their notices say.
GNU = [
    ("GPL-2.0", "General", "2"),
    ("GPL-3.0", "General", "3"),
    ("LGPL-2.1", "Lesser General", "2.1"),
    ("LGPL-3.0", "Lesser General", "3"),
    ("AGPL-3.0", "Affero General", "3"),
]
GNU_NOTICES = [
    "This work is licensed under the GNU {family} Public License, version {version}.",
    "This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {family} Public License "
    "as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
    "you can redistribute it and/or modify it under the terms of the GNU {family} Public License version {version} "
    "as published by the Free Software Foundation",
    "GNU {family} Public License version {version} only",
    "GNU {family} Public License version {version} or later",
]
# Notices without a version count for the newest one; marked by "?", they yield to any that states a license in full.
UNVERSIONED = [
    ("GPL-3.0?", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License."),
    ("LGPL-3.0?", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License."),
]
# Identifiers after "SPDX-License-Identifier:"; the GNU ones also end in -only and -or-later.
IDENTIFIERS = ["MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-1.1", "MPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0"]
TEMPLATES += [
    (name, notice.format(thing=thing, family=family, version=version))
    for name, family, version in GNU
    for notice in GNU_NOTICES
    for thing in (["program", "library"] if "{thing}" in notice else [""])
]
TEMPLATES += UNVERSIONED
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}") for name in IDENTIFIERS]
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}{end}") for name, _, _ in GNU for end in ("", "-only", "-or-later")]
# File names that state the license of their directory.
LICENSE_FILES = ("LICENSE", "LICENCE", "COPYING")
_TERM = re.compile(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*")


def terms(line: str) -> list[str]:
    return _TERM.findall(line.lower())


def full_texts() -> list[tuple[str, str]]:
    """(license, text) of the whole license texts beside this module."""
    folder = Path(__file__).with_name("license_texts")
    return [(f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in sorted(folder.glob("*.txt"))]


class Templates:
    """Weighted term vectors of the templates, and the windows of a file that may reach the threshold.

    The weights of the templates' own terms are known here.  Other terms weigh 1
    at least, which bounds a window's cosine from above.
    """

    def __init__(self, templates: list[tuple[str, str]], threshold: float, files: int, held: dict[str, int]) -> None:
        self.threshold = threshold
        self.idf = {t: log((files + 1) / (n + 1)) + 1 for t, n in held.items()}
        self.vectors: list[tuple[str, int, dict[str, float]]] = []
        self.anchors: dict[str, set[int]] = defaultdict(set)
        for i, (name, text) in enumerate(templates):
            found = terms(text)
            v = {t: n * self.idf[t] for t, n in Counter(found).items()}
            size = sqrt(sum(w * w for w in v.values()))
            u = {t: w / size for t, w in v.items()}
            self.vectors.append((name, len(found), u))
            # without one of these rarest terms a window lacks too much of the template to reach the threshold
            left = 1.0
            for t in sorted(u, key=lambda t: (held[t], -u[t], t)):
                if left < threshold**2 - 1e-9:
                    break
                self.anchors[t].add(i)
                left -= u[t] ** 2

    def _starts(self, n: int, size: int, places: list[int], lines: list[int]) -> Iterable[int]:
        """Where windows of ``size`` terms begin among ``n``: at every term about the anchors, long ones at lines and in steps."""
        last = max(0, n - size)
        if size <= LONG:
            return sorted({s for p in places for s in range(max(0, p - size + 1), min(p, last) + 1)} | ({last} if last == 0 else set()))
        return sorted({*(s for s in lines if s <= last), *range(0, last + 1, size // STEPS), last})

    def windows(self, text: str) -> list[tuple[str, int, float, float, dict[str, int]]]:
        """(license, line, dot product, squared size of the known terms, other terms) of each window that may be the best."""
        low = text.lower()
        every = set(_TERM.findall(low))
        hit = self.anchors.keys() & every
        wanted = {i for t in hit for i in self.anchors[t]}
        wanted = {i for i in wanted if sum(w * w for t, w in self.vectors[i][2].items() if t in every) >= self.threshold**2 - 1e-9}
        if not wanted:
            return []
        found: list[str] = []
        at: list[int] = []  # line of each term
        lines: list[tuple[int, int]] = []
        places: dict[str, list[int]] = defaultdict(list)
        for n, line in enumerate(low.split("\n")):
            own = _TERM.findall(line)
            if own:
                lines.append((len(found), len(found) + len(own)))
                found += own
                at += [n] * len(own)
        for p, t in enumerate(found):
            if t in hit:
                places[t].append(p)
        out = []
        for i in sorted(wanted):
            name, size, u = self.vectors[i]
            mine = sorted(p for t in hit if i in self.anchors[t] for p in places[t])
            spans = {(0, len(found))} | {lines[k] for k in {bisect_right(lines, (p, len(found) + 1)) - 1 for p in mine}}
            for length in {size, size + size // 4}:
                spans |= {(s, min(s + length, len(found))) for s in self._starts(len(found), length, mine, [s for s, _ in lines])}
            for s, e in spans:
                dot = known = 0.0
                other, loose = {}, 0
                for t, k in Counter(found[s:e]).items():
                    weight = self.idf.get(t)
                    if weight is None:
                        other[t] = k
                        loose += k * k
                    else:
                        known += (k * weight) ** 2
                        dot += u.get(t, 0.0) * k * weight
                if dot >= (self.threshold - 1e-9) * sqrt(known + loose):
                    out.append((dot / sqrt(known + loose), (name, at[s], dot, known, other)))
        # a window whose cosine is known rules out those that cannot reach it, and all that are vague
        sure = max((c for c, w in out if not w[4] and not w[0].endswith("?") and c >= self.threshold), default=0.0)
        return [w for c, w in out if c >= sure - 1e-12 and not (sure and w[0].endswith("?"))]


def document_frequencies(src: DataFrame) -> DataFrame:
    """``(term, n)``: the number of files that hold each term; the empty term stands for all files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                c[""] += 1
                c.update(set(terms(t.as_py())))
                if len(c) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["term", "n"])
                    c = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["term", "n"])

    return src.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def own_licenses(files: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """``(doc_id, path, license, cosine, line)`` of each file; null where no window reaches the threshold."""
    src = files.select("doc_id", "path", text_or_empty().alias("text"))
    held = stored(document_frequencies(src), "terms")
    wanted = sorted({t for _, text in templates for t in terms(text)})  # as many as the templates have
    few = {r["term"]: r["n"] for r in held.where(F.col("term").isin(["", *wanted])).collect()}
    total = few.pop("", 0)
    model = files.sparkSession.sparkContext.broadcast(Templates(templates, threshold, total, {t: few.get(t, 0) for t in wanted}))
    id_type = src.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, path string, rid string, "
        "windows array<struct<license: string, line: int, dot: double, known: double, other: array<struct<term: string, k: int>>>>"
    )
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    names, types = arrow.names, arrow.types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ("license", "line", "dot", "known")
        for b in batches:
            found = [model.value.windows(t.as_py()) for t in b.column(2)]
            rows = [
                [dict(zip(fields, w[:4], strict=True)) | {"other": [{"term": t, "k": k} for t, k in w[4].items()]} for w in ws] for ws in found
            ]
            rids = [uuid4().hex if ws else None for ws in found]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rids, types[2]), pa.array(rows, types[3])], names)

    seen = stored(src.mapInArrow(run, schema), "windows")
    some = seen.where("rid IS NOT NULL")
    each = some.select("rid", F.posexplode("windows").alias("pos", "w")).select("rid", "pos", "w.*")
    sure = each.where(F.size("other") == 0).withColumn("loose", F.lit(0.0))
    idf = F.log((F.lit(total) + 1) / (F.col("n") + 1)) + 1
    vectors = each.where(F.size("other") > 0).select("rid", "pos", "license", "line", "dot", "known", F.explode("other").alias("o"))
    weighed = vectors.join(held, F.col("o.term") == F.col("term"))
    open_ = weighed.groupBy("rid", "pos", "license", "line", "dot", "known").agg(F.sum((F.col("o.k") * idf) ** 2).alias("loose"))
    cols = ["rid", "license", "line", (F.col("dot") / F.sqrt(F.col("known") + F.col("loose"))).alias("cosine")]
    scored = sure.select(*cols).unionByName(open_.select(*cols)).where(F.col("cosine") >= threshold)
    # the best cosine of those that are not vague; earlier lines, then names win ties
    order = F.struct(F.endswith("license", F.lit("?")).alias("vague"), (-F.round("cosine", 12)).alias("c"), "line", "license", "cosine")
    best = scored.groupBy(F.col("rid").alias("brid")).agg(F.min(order).alias("b"))
    found = some.join(best, F.col("rid") == F.col("brid"), "left").select("doc_id", "path", F.rtrim("b.license", F.lit("?")).alias("license"), "b.cosine", "b.line")
    none = [F.lit(None).cast(t).alias(n) for n, t in (("license", "string"), ("cosine", "double"), ("line", "int"))]
    return found.unionByName(seen.where("rid IS NULL").select("doc_id", "path", *none))


def license_scan(files: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, path, license, cosine, line, found, origin)`` per row of ``files`` (``doc_id``, ``path``, ``text``).

    Without ``templates``: ``TEMPLATES`` and the whole license texts.  ``line`` is
    where the best window begins.  ``found`` is ``header`` (a window of the file
    itself), ``inherited`` (from the directory ``origin``) or null (none).  Of several license files in a
    directory the best cosine counts, then the name of the license.  A null
    text counts as empty; a file with a null path inherits nothing; repeated
    rows each get their row; other columns are ignored.
    """
    prepare(files.sparkSession)
    own = stored(own_licenses(files, TEMPLATES + full_texts() if templates is None else templates, threshold), "licenses")
    folder = F.expr("CASE WHEN instr(path, '/') > 0 THEN regexp_replace(path, '/[^/]*$', '') ELSE '' END")
    placed = own.withColumn("folder", F.when(F.col("path").isNotNull(), folder))
    named = F.upper(F.regexp_extract("path", r"([^/.]*)(?:\.[^/]*)?$", 1)).isin(*LICENSE_FILES)
    best = F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("best")
    stated = placed.where(named & F.col("license").isNotNull()).groupBy(F.col("folder").alias("above")).agg(best)
    # ancestors of the distinct folders that hold files: as many rows as folders are deep
    folders = placed.select("folder").where("folder is not null").distinct()
    steps = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    chain = folders.select("folder", F.explode(F.array_distinct(above)).alias("above"))
    deep = F.when(F.col("above") == "", 0).otherwise(F.size(F.split("above", "/")))
    nearest = chain.join(stated, "above").groupBy("folder").agg(F.max_by(F.struct("best.license", "above"), deep).alias("near"))
    out = placed.join(nearest, "folder", "left")
    mine = F.col("license").isNotNull()
    return out.select(
        "doc_id", "path", F.coalesce("license", "near.license").alias("license"), "cosine", "line",
        F.when(mine, "header").when(F.col("near").isNotNull(), "inherited").alias("found"),
        F.when(~mine, F.col("near.above")).alias("origin"),
    )


def tree(docs: DataFrame) -> DataFrame:
    """``documents`` as files: folders by source, language and the id's thousands and hundreds.

    Every tenth file is a license file, of its language's folder or of its own one.
    """
    step = lambda n, prefix: F.concat(F.lit(prefix), F.expr(f"doc_id div {n}").cast("string"))
    top = F.concat_ws("/", "source", "lang")
    deep = F.concat_ws("/", top, step(1000, "k"), step(100, "h"))
    path = (
        F.when(F.col("doc_id") % 20 == 0, F.concat_ws("/", top, F.lit("LICENSE")))
        .when(F.col("doc_id") % 20 == 10, F.concat_ws("/", deep, F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", deep, F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))
    )
    return docs.select("doc_id", path.alias("path"), "text")


def query(docs: DataFrame) -> DataFrame:
    return license_scan(tree(docs))
