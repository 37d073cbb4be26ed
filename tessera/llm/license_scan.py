"""License scan: MinHash bands over overlapping windows retrieve templates, exact
shingle containment verifies them.  DataFrame functions only.

Method.  Words are runs of ASCII letters and digits, A-Z as a-z.  A template of n
words is looked for in windows of 2 l words at every l-th word, l = 1.25 n rounded
up, so any stretch of at most l words lies in a window.  Windows and templates get
MinHash signatures of their 5-word shingles (the whole template, if it is
shorter); a band is one value, and one equal band retrieves the template.  The
number of bands b is such that a window holding the wanted share of a template's
shingles, of similarity s to it at least, is missed with probability
(1 - s) ** b <= ``MISS``.  The shingles are then compared exactly.

Before that, texts and windows without any anchor word are left out: anchors are
chosen so that in each template fewer shingles lack one than a match needs, so no
match is lost.

Scale.  One pass; rows with no anchor end in the scan's filter.  Templates are a
parameter of bounded size (``TEMPLATES`` at most) and are broadcast.  Work on a
text is linear in its words; windows are cut out before they become rows.

Nulls and the like: null and empty texts have no licenses.  A result row is a pair
(id, license) with the best window's count; rows that share an id, and rows with a
null id, count as one.  Empty tables give no rows.  Templates without words are
an error.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEMPLATES = 1000
MISS = 1e-6

#: Notices of licenses, as published.
LICENSES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                         "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                      "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
                      "version.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
           "conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "All-rights-reserved": "All rights reserved.",
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Template:
    """A template's words, shingle length, window step and number of bands."""

    def __init__(self, name: str, text: str, k: int, share: float):
        self.name, self.words = name, re.findall("[a-z0-9]+", text.lower())
        if not self.words:
            raise ValueError(f"template {name} has no words")
        self.k = min(k, len(self.words))
        self.step = math.ceil(1.25 * len(self.words))
        self.shingles = {tuple(self.words[i:i + self.k]) for i in range(len(self.words) - self.k + 1)}
        self.needed = math.ceil(share * len(self.shingles))
        most = max(1, 2 * self.step - self.k + 1)
        alike = self.needed / (most + len(self.shingles) - self.needed)
        self.bands = 1 if alike >= 1 else math.ceil(math.log(MISS) / math.log(1 - alike))


def anchor_words(templates: list[Template]) -> list[str]:
    """Words such that in each template fewer shingles lack one than must be matched."""
    chosen: list[str] = []
    for t in templates:
        left = [s for s in t.shingles if not any(w in s for w in chosen)]
        while len(left) >= t.needed:
            # the word of most shingles left; long words are rarer in texts
            w = max({w for s in left for w in s}, key=lambda w: (sum(w in s for s in left) * len(w) ** 2, w))
            chosen.append(w)
            left = [s for s in left if w not in s]
    return chosen


def _shingles(words: Column, k: Column) -> Column:
    whole = F.transform(F.sequence(F.lit(1), F.size(words) - k + 1), lambda i: F.xxhash64(F.array_join(F.slice(words, i, k), " ")))
    return F.when(F.size(words) >= k, F.array_distinct(whole)).otherwise(F.array().cast("array<bigint>"))


def _signature(shingles: Column, bands: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), bands), lambda i: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, i))))


def license_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
                    k: int = 5, share: float = 0.75) -> DataFrame:
    """(id_col, license, n_matched, n_shingles): texts with a window that holds
    ``share`` or more of a template's shingles."""
    known = [Template(n, t, k, share) for n, t in (templates or LICENSES).items()]
    if len(known) > TEMPLATES:
        raise ValueError(f"more than {TEMPLATES} templates")
    spark = docs.sparkSession
    anchors = anchor_words(known)
    classes: dict[tuple[int, int], int] = {}
    for t in known:
        classes[t.k, t.step] = max(t.bands, classes.get((t.k, t.step), 1))
    lits = lambda xs: F.array(*[F.lit(x) for x in xs])
    kinds = F.array(*[F.struct(F.lit(a).alias("k"), F.lit(s).alias("step"), F.lit(b).alias("bands")) for (a, s), b in sorted(classes.items())])

    given = F.array(*[F.struct(F.lit(t.name).alias("license"), lits(t.words).alias("words"), F.lit(t.k).alias("k"), F.lit(t.step).alias("step"),
                               F.lit(classes[t.k, t.step]).alias("bands")) for t in known])
    wanted = (spark.range(1).select(F.explode(given).alias("t")).select("t.*")
              .withColumn("template", _shingles(F.col("words"), F.col("k")))
              .select("license", "template", F.col("k").alias("tk"), F.col("step").alias("tstep"),
                      F.posexplode(_signature(F.col("template"), F.col("bands"))).alias("tband", "tvalue")))

    text = F.translate(F.col(text_col).cast("string"), _UPPER, _LOWER)
    # explode(array(x)) has x computed once for a row: the optimizer repeats an expression wherever it is referred to,
    # inside lambdas for each element, but it doesn't look through a generator.
    once = lambda x: F.explode(F.array(x))
    texts = (docs.where(F.col(text_col).cast("string").rlike("(?i)" + "|".join(anchors)))  # (?i) without u: A-Z only
             .select(F.col(id_col).alias("id"), once(F.regexp_extract_all(text, F.lit("[a-z0-9]+"), F.lit(0))).alias("words")))
    is_anchor = F.transform("words", lambda w: F.array_contains(lits(anchors), w))
    at = F.filter(F.transform(is_anchor, lambda hit, i: F.when(hit, i)), lambda i: i.isNotNull())
    placed = (texts.select("id", "words", once(at).alias("at")).where(F.size("at") > 0)
              .withColumn("kind", F.explode(kinds)).select("*", "kind.*"))
    starts = F.array_distinct(F.flatten(F.transform("at", lambda p: F.array(
        F.floor(p / F.col("step")).cast("int") * F.col("step"),
        F.greatest(F.floor(p / F.col("step")).cast("int") * F.col("step") - F.col("step"), F.lit(0))))))
    windows = (placed.select("id", "k", "step", "bands", F.explode(F.transform(starts, lambda s: F.slice("words", s + 1, 2 * F.col("step")))).alias("window"))
               .select("id", "k", "step", "bands", once(_shingles(F.col("window"), F.col("k"))).alias("own")).where(F.size("own") > 0))
    banded = windows.select("id", "k", "step", "own", F.posexplode(_signature(F.col("own"), F.col("bands"))).alias("band", "value"))
    found = banded.join(F.broadcast(wanted), (F.col("band") == F.col("tband")) & (F.col("value") == F.col("tvalue"))  # bounded: TEMPLATES * bands rows
                        & (F.col("k") == F.col("tk")) & (F.col("step") == F.col("tstep")))
    counted = found.select("id", "license", F.size(F.array_intersect("own", "template")).alias("n"), F.size("template").alias("of"))
    return (counted.groupBy("id", "license").agg(F.max("n").cast("long").alias("n_matched"), F.first("of").cast("long").alias("n_shingles"))
            .where(F.col("n_matched") >= F.ceil(F.col("n_shingles") * share)).withColumnRenamed("id", id_col))


def oracle(templates: dict[str, str] | None = None, k: int = 5, share: float = 0.75) -> str:
    """The same for DuckDB, without MinHash: all shingles of all texts against
    the templates' shingles, counted in each window."""
    known = [Template(n, t, k, share) for n, t in (templates or LICENSES).items()]
    text = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({text(t.name)}, {t.k}, {t.step}, {t.needed}, {len(t.shingles)}, {text(' '.join(s))})"
                       for t in known for s in sorted(t.shingles))
    return f"""
WITH t(license, k, step, needed, n_shingles, shingle) AS (VALUES {values}),
w AS (SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z0-9]+') AS words FROM documents),
g AS (SELECT doc_id, k, p, array_to_string(list_slice(words, p + 1, p + k), ' ') AS shingle
  FROM (SELECT doc_id, words, k, unnest(generate_series(0, len(words) - k)) AS p FROM w, (SELECT DISTINCT k FROM t))),
hits AS (SELECT doc_id, license, step, needed, n_shingles, p, k, shingle FROM g JOIN t USING (k, shingle)),
windows AS (SELECT *, (p // step) * step - back * step AS s FROM hits, (VALUES (0), (1)) AS v(back)),
counted AS (SELECT doc_id, license, needed, n_shingles, s, count(DISTINCT shingle) AS n FROM windows
  WHERE s >= 0 AND p + k <= s + 2 * step GROUP BY ALL)
SELECT doc_id, license, max(n)::BIGINT AS n_matched, any_value(n_shingles)::BIGINT AS n_shingles
FROM counted GROUP BY doc_id, license, needed HAVING max(n) >= needed"""
