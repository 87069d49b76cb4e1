"""Licence scan: a trained paragraph classifier whose findings are confirmed by templates.

Every paragraph (line) of every document goes through a multinomial logistic regression on hashed word
unigrams and bigrams, and so do the last ``WRAP`` words before each single line break with the first ``WRAP``
after it, so a statement wrapped over lines is seen whole wherever it breaks. Blank lines end a statement. Its classes are the licence families, ``unknown`` for licence statements of no known
family, and ``none``. It is trained here, on statements made from the fixed phrases below and on a bounded
sample of ordinary paragraphs of the corpus, half of the statements followed by ordinary text.

A third of the examples is kept back. The largest probability that a family gets there by mistake, and at
least 0.5, is one cut: a licence paragraph whose best family stays below it is ``unknown``. The chance of being
any statement that all but 0.5 % of the ordinary paragraphs stay below there (``QUANTILE``), and at least 0.5, is
the other cut: below it nothing is reported. Paragraphs with a licence word, a family's name or a template's
word pairs are not taken for ordinary ones. A family above the
cut is confirmed if the paragraph contains enough of the word pairs of one of the family's templates.

All steps are DataFrame operations and the JVM feature and regression classes that come with Spark. Scoring
is one pass over the table; only findings are shuffled.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noteflow.llm.store import Scratch, documents

# Names of licence families, and templates that confirm them (lower case words).
NAMES: dict[str, list[str]] = {
    "apache-2.0": ["the Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "the Apache Software License version 2.0"],
    "mit": ["the MIT License", "MIT", "the terms of the MIT license", "the MIT (Expat) License"],
    "bsd": ["the BSD 3-Clause License", "BSD-3-Clause", "the 2-clause BSD license", "a BSD-style license"],
    "gpl-2.0": ["the GNU General Public License, version 2", "GPL-2.0", "GPLv2", "the GNU GPL version 2 or later"],
    "gpl-3.0": ["the GNU General Public License, version 3", "GPL-3.0", "GPLv3", "the GNU GPL version 3 or later"],
    "lgpl": ["the GNU Lesser General Public License", "LGPL-3.0", "LGPLv2.1", "the GNU LGPL version 3"],
    "agpl-3.0": ["the GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3", "the GNU AGPL"],
    "mpl-2.0": ["the Mozilla Public License, version 2.0", "MPL-2.0", "Mozilla Public License 2.0", "the MPL 2.0"],
    "cc-by": ["CC BY 4.0", "the Creative Commons Attribution 4.0 International License", "CC-BY-4.0", "Creative Commons Attribution 3.0"],
    "cc-by-sa": ["CC BY-SA 4.0", "the Creative Commons Attribution-ShareAlike 4.0 License", "CC-BY-SA-3.0", "Creative Commons Attribution Share Alike"],
    "cc-by-nc": ["CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 License", "CC-BY-NC-4.0", "CC BY-NC-SA 4.0"],
    "cc0": ["CC0 1.0", "the CC0 1.0 Universal public domain dedication", "CC0-1.0", "Creative Commons Zero"],
    "unlicense": ["the Unlicense", "Unlicense", "the unlicense.org terms", "the Unlicense public domain dedication"],
}
PHRASES: dict[str, list[str]] = {
    "apache-2.0": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
}
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0", "apache software license version 2 0", "www apache org licenses license 2 0"],
    "mit": ["mit license", "identifier mit", "under mit", "license mit", "mit expat license", "permission is hereby granted free of charge"],
    "bsd": ["bsd 3 clause", "2 clause bsd", "3 clause bsd", "bsd 2 clause", "bsd style license", "bsd license", "redistribution and use in source and binary forms"],
    "gpl-2.0": ["gnu general public license version 2", "gpl 2 0", "gnu gpl version 2", "under gplv2", "license gplv2", "identifier gplv2"],
    "gpl-3.0": ["gnu general public license version 3", "gpl 3 0", "gnu gpl version 3", "under gplv3", "license gplv3", "identifier gplv3"],
    "lgpl": ["gnu lesser general public license", "lgpl 3 0", "lgpl 2 1", "under lgplv2", "under lgplv3", "gnu lgpl"],
    "agpl-3.0": ["gnu affero general public license", "agpl 3 0", "under agplv3", "license agplv3", "gnu agpl"],
    "mpl-2.0": ["mozilla public license", "mpl 2 0"],
    "cc-by": ["cc by 4 0", "cc by 3 0", "creative commons attribution 4 0", "creative commons attribution 3 0"],
    "cc-by-sa": ["cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"],
    "cc-by-nc": ["cc by nc", "creative commons attribution noncommercial"],
    "cc0": ["cc0 1 0", "creative commons zero"],
    "unlicense": ["the unlicense", "under unlicense", "license unlicense", "identifier unlicense", "free and unencumbered software"],
}
UNKNOWN_NAMES = [
    "the Example Source License", "a custom license", "the terms in the LICENSE file", "the Northwind Community License, Version 1.1", "our commercial license agreement",
    "the vendor's end user license", "the House Public License, version 5", "a proprietary license", "the terms of use of this site", "the Acme Shared Source License 0.9",
]
LEADS = ["", "This work is ", "This file is ", "The code in this repository is ", "Content on this page is ", "Our data set is "]
VERBS = ["licensed under ", "released under ", "distributed under ", "made available under "]
OTHERS = ["SPDX-License-Identifier: {}", "License: {}", "Use of this material is governed by {}.", "See {} for details."]

CLASSES = ["none", "unknown", *NAMES]
FEATURES = 1 << 14
#: Ordinary paragraphs to learn from.
SAMPLE = 4000
LICENCE_WORDS = r"(?i)licen[sc]|copyright|spdx|creative commons|public domain|permission is|redistribution"
#: Part of the ordinary paragraphs that stay below the cut of a statement.
QUANTILE = 0.995
#: Part of a template's word pairs that a paragraph must contain.
OVERLAP = 0.8
#: Words on each side of a line break that are judged together. The longest of ``statements()`` has fewer.
WRAP = 20


def statements() -> list[tuple[str, int]]:
    """(text, class) made from the fixed phrases."""
    out = []
    for family, names in [("unknown", UNKNOWN_NAMES), *NAMES.items()]:
        made = [f"{lead}{verb}{name}" for lead in LEADS for verb in VERBS for name in names]
        made += [other.format(name) for other in OTHERS for name in names]
        made = [m[0].upper() + m[1:].rstrip(".") + "." for m in made] + PHRASES.get(family, []) * 6
        out += [(m, CLASSES.index(family)) for m in made]
    return out


def _named() -> str:
    """Pattern of the names of all families, however their words are set apart."""
    names = {tuple(re.findall("[a-z0-9]+", name.lower())) for names in NAMES.values() for name in names}
    # Longest first; "the" before a name is no part of it.
    names = sorted({n[n[0] == "the":] for n in names}, key=lambda n: (-len(n), n))
    return "(?i)(?<![a-z0-9])(?:" + "|".join("[^a-z0-9]+".join(n) for n in names) + ")(?![a-z0-9])"


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def _features(rows: DataFrame) -> DataFrame:
    """Adds ``words``, ``pairs`` and hashed ``features`` of column ``paragraph``."""
    return _hashed(rows.withColumn("words", _tokens(F.col("paragraph"))))


def _hashed(rows: DataFrame) -> DataFrame:
    more = F.greatest(F.size("words") - 1, F.lit(0))
    rows = rows.withColumn("pairs", F.zip_with(F.slice("words", F.lit(1), more), F.slice("words", F.lit(2), more), lambda a, b: F.concat(a, F.lit(" "), b)))
    rows = rows.withColumn("_terms", F.concat("words", "pairs"))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="_terms", outputCol="features").transform(rows).drop("_terms")


def paragraphs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, place, paragraph) of all lines that hold a visible character."""
    lines = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.posexplode(F.split(F.col(f"`{text}`"), "\r\n|\r|\n")).alias("place", "paragraph"))
    return lines.filter(F.col("paragraph").rlike(r"\S"))


def _following(lines: Column, place: Column) -> Column:
    """The first ``WRAP`` words of the lines after this one, up to a blank one, and how many words each of those lines has."""
    near = F.get(lines, place + 1)["words"]
    rest = F.slice(lines, place + 2, WRAP)
    blank = F.array_position(F.transform(rest, lambda line: line["seen"]), False).cast("int")
    rest = F.when(blank > 0, F.slice(rest, F.lit(1), blank - 1)).otherwise(rest)
    words = F.slice(F.flatten(F.transform(rest, lambda line: F.slice(line["words"], 1, WRAP))), 1, WRAP)
    # Most lines are long enough alone.
    alone = F.size(near) >= WRAP
    sizes = F.when(alone, F.array(F.size(near))).otherwise(F.transform(rest, lambda line: F.size(line["words"])))
    return F.struct(F.when(alone, F.slice(near, 1, WRAP)).otherwise(words).alias("words"), sizes.alias("sizes"))


def _ends(sizes: Column) -> Column:
    """How many words have come at the end of each line."""
    start = F.array().cast("array<int>")
    return F.aggregate(sizes, start, lambda acc, n: F.concat(acc, F.array(n + F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)))))


def units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, rid, place, joined, words, cut, sizes): the words of each line, and those around each line break (``joined``), ``cut`` of them before it."""
    raw = F.split(F.col(f"`{text}`"), "\r\n|\r|\n")
    # Each step is exploded on its own, so that a text is split once and each of its lines once.
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.monotonically_increasing_id().alias("rid"), F.explode(F.array(raw)).alias("raw"))
    lines = F.transform("raw", lambda x: F.struct(_tokens(x).alias("words"), x.rlike(r"\S").alias("seen")))
    docs = docs.select("doc_id", "rid", F.explode(F.array(lines)).alias("lines"))
    line = F.transform("lines", lambda x, i: F.struct(i.alias("place"), x["words"].alias("words"), _following(F.col("lines"), i).alias("after")))
    lines = docs.select("doc_id", "rid", F.explode(line).alias("u")).select("doc_id", "rid", "u.place", "u.words", "u.after.sizes", F.col("u.after.words").alias("after")).filter("size(words) > 0")
    lines = lines.withColumn("joined", F.explode(F.when(F.size("after") > 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    cut = F.least(F.size("words"), F.lit(WRAP))
    near = F.concat(F.slice("words", F.size("words") - cut + 1, F.lit(WRAP)), "after")
    return lines.select("doc_id", "rid", "place", "joined", F.when(F.col("joined"), near).otherwise(F.col("words")).alias("words"), cut.alias("cut"), "sizes")


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[LogisticRegressionModel, float, float]:
    """The regression, the cut of a family and the cut of a statement of any kind. At most ``SAMPLE`` paragraphs of the corpus are learned from."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "licences")
    # Few documents reach the sort of the sample: about six for each row of it, each with its lines. The others aren't cut into lines.
    rate = min(1.0, 6 * SAMPLE / max(1, docs.count()))
    near = F.pmod(F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), F.lit("sample")), F.lit(1 << 40)) < int(rate * (1 << 40))
    plain = paragraphs(docs.filter(near), doc_id, text)
    plain = plain.filter(~F.col("paragraph").rlike(LICENCE_WORDS)).filter(~F.col("paragraph").rlike(_named()))
    plain = plain.select(F.substring("paragraph", 1, 4000).alias("paragraph"))
    plain = plain.withColumn("_h", F.xxhash64("paragraph")).orderBy("_h").limit(SAMPLE).coalesce(1)
    plain = _features(plain).filter(~F.exists(_templates(), lambda t: _share(t, F.col("pairs")) >= OVERLAP)).select("paragraph", "_h")
    plain = scratch.keep(plain, "plain").select("paragraph", F.col("_h"), F.pmod(F.col("_h"), F.lit(997)).alias("k"))
    made = spark.createDataFrame([(t, c, k) for k, (t, c) in enumerate(statements())], "paragraph string, label int, n int")
    tails = plain.groupBy("k").agg(F.min("paragraph").alias("tail"))
    # At most 997 tails.
    mixed = made.join(F.broadcast(tails), F.col("n") % 997 == F.col("k")).select(F.concat_ws(" ", "paragraph", F.substring("tail", 1, 600)).alias("paragraph"), "label")
    none = plain.select("paragraph", F.lit(0).alias("label"))
    rows = none.union(made.select("paragraph", "label")).union(mixed)
    rows = scratch.keep(_features(rows.coalesce(1)).withColumn("kept_back", F.pmod(F.xxhash64("paragraph"), F.lit(3)) == 0).select("label", "features", "kept_back"), "examples")
    model = LogisticRegression(maxIter=40, regParam=4e-4, elasticNetParam=0.9, family="multinomial").fit(rows.filter("NOT kept_back").withColumn("label", F.col("label").cast("double")))
    told = model.transform(rows.filter("kept_back")).withColumn("_p", vector_to_array("probability"))
    family = F.array_max(F.slice("_p", 3, len(NAMES)))
    worst = told.agg(
        F.max(F.when((F.col("prediction") > 1) & (F.col("prediction") != F.col("label")), family)).alias("family"),
        F.percentile(F.when(F.col("label") == 0, 1 - F.col("_p")[0]), QUANTILE).alias("statement"),
    ).first()
    return model, *(min(0.99, max(0.5, w or 0.0)) for w in (worst["family"], worst["statement"]))


def _confirmed(family: Column, pairs: Column) -> Column:
    """The largest part of a template's word pairs that the paragraph holds."""
    return F.coalesce(F.array_max(F.transform(_templates(family), lambda t: _share(t, pairs))), F.lit(0.0))


def _share(template: Column, pairs: Column) -> Column:
    return F.size(F.array_intersect(template["wanted"], pairs)) / F.size(template["wanted"])


def _templates(family: Column | None = None) -> Column:
    """Of one family, or all."""
    made = []
    for name, templates in TEMPLATES.items():
        for t in templates:
            words = t.split(" ")
            wanted = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
            made.append(F.struct(F.lit(name).alias("family"), F.array(*[F.lit(w) for w in wanted]).alias("wanted")))
    return F.array(*made) if family is None else F.filter(F.array(*made), lambda t: t["family"] == family)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each paragraph that states a licence: doc_id, place, family, predicted, probability, overlap, confirmed.

    ``place`` is the number of the line, from 0; of a statement wrapped over lines, that of its first. ``predicted`` is ``unknown`` if no family reaches the cut, and
    ``family`` also if the template doesn't confirm the prediction.
    A null or empty text has no paragraphs; null ids are kept as they are; repeated rows are each scanned.
    Other columns are ignored; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "licence-findings")
    model, cut, least = train(docs, doc_id, text)
    # Only the probabilities are read, so nothing else is made for a unit.
    model = model.setRawPredictionCol("").setPredictionCol("")
    judged = model.transform(_hashed(units(docs, doc_id, text)))
    judged = judged.filter(1 - vector_to_array("probability")[0] > least)
    # The families of one paragraph share what is not ``none`` or ``unknown``.
    chance = vector_to_array("probability")
    best = judged.withColumn("_p", F.slice(chance, 3, len(NAMES))).withColumn("probability", F.array_max("_p"))
    names = F.array(*[F.lit(n) for n in NAMES])
    likely = F.element_at(names, F.array_position("_p", F.col("probability")).cast("int"))
    best = best.withColumn("family", F.when(F.col("probability") >= cut, likely).otherwise("unknown"))
    best = best.withColumn("overlap", _confirmed(F.col("family"), F.col("pairs"))).withColumn("confirmed", F.col("overlap") >= OVERLAP)
    # What one side of a break holds by itself is found in its own line.
    sides = [F.slice("pairs", 1, F.greatest(F.col("cut") - 1, F.lit(0))), F.slice("pairs", F.col("cut") + 1, F.lit(WRAP))]
    best = best.withColumn("_alone", F.col("joined") & (F.greatest(*[_confirmed(F.col("family"), side) for side in sides]) >= OVERLAP)).filter("NOT _alone")
    family = F.when(F.col("confirmed"), F.col("family")).otherwise("unknown")
    # The line that holds the last word pair of a confirming template.
    held = F.flatten(F.transform(F.filter(_templates(F.col("family")), lambda t: _share(t, F.col("pairs")) >= OVERLAP), lambda t: t["wanted"]))
    last = F.array_max(F.transform("pairs", lambda pair, i: F.when(F.array_contains(held, pair), i + 1 - F.col("cut"))))
    until = F.when(F.col("joined") & F.col("confirmed"), F.col("place") + 1 + F.size(F.filter(_ends(F.col("sizes")), lambda e: e <= last)))
    found = best.select("doc_id", "rid", "place", "joined", until.alias("until"), family.alias("family"), F.col("family").alias("predicted"), "probability", "overlap", "confirmed")
    return _once(scratch.keep(found, "found")).drop("rid", "joined", "until")


def _once(found: DataFrame) -> DataFrame:
    """Drops what a wrapped statement shows a second time, in its later lines and at the breaks after its first."""
    by, own = Window.partitionBy("rid").orderBy("place"), Window.partitionBy("rid", "family").orderBy("place")
    wrapped, first = F.col("joined") & F.col("confirmed"), Window.unboundedPreceding
    some = lambda what, window: F.coalesce(F.max(what).over(window), F.lit(False))
    part = F.coalesce(F.max("until").over(by.rangeBetween(first, 0)) >= F.col("place"), F.lit(False))
    again = F.coalesce(F.max("until").over(own.rangeBetween(first, -1)) > F.col("place"), F.lit(False))
    told = part | some(~F.col("joined"), by.rangeBetween(0, 1)) | some(wrapped, by.rangeBetween(1, 1)) | some(F.col("joined"), by.rangeBetween(-1, -1))
    twice = F.when(wrapped, again).when(F.col("confirmed"), F.lit(False)).when(F.col("joined"), told).otherwise(part)
    return found.withColumn("_twice", twice).filter("NOT _twice").drop("_twice")


def scan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
