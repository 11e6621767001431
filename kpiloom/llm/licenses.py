"""Licence statements in paragraphs: a sparse n-gram logistic regression names the family, templates confirm it.

The classifier is trained when it is asked for, on the notices below, on variants of them and on a bounded number of
paragraphs of the corpus without a licence word that resemble no notice. Its features are runs of one to three words of
the notices. A run counts only if it holds a word that ordinary paragraphs lack, so a paragraph without such a word has no
feature, is no licence by the intercept alone, and is left out before runs are built. Licences that have no family here
are a class of their own, and calibrate it: a family is believed only above what held-out statements of such licences
reach, and only if a notice of the family confirms it by what no other family's notices hold. Everything is DataFrame and
ML functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, NGram, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import named, staged

NONE, UNKNOWN = "none", "unknown"

#: Notices and heads by licence family, as their texts ask for them, and the identifiers of ``SPDX``.
NOTICES = {
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "GNU AGPL v3 or later",
        "GNU Affero General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Apache License Version 2.0, January 2004",
        "Licensed under Apache 2.0",
        "Apache License",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ),
    "bsd": (
        "Use of this source code is governed by a BSD-style license.",
        "Released under the BSD 3-Clause License.",
        "BSD licensed",
        "BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: redistributions of source code must retain the above copyright notice",
    ),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc0": ("CC0 1.0 Universal public domain dedication", "To the extent possible under law, all copyright has been waived under CC0."),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software under the terms of the GNU General Public License, version 2.",
        "Licensed under the GNU GPL v3 or later",
        "Licensed under GPL 3",
        "GNU General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "GNU LGPL v3 or later",
        "GNU Lesser General Public License",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation, either version 2.1 of the License, or any later version.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "MIT licensed",
        "MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Mozilla Public License 2.0",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "reserved": ("All rights reserved.", "Copyright. All rights reserved. No part may be reproduced without written permission."),
}
SPDX = {
    "agpl": ("AGPL-3.0-only", "AGPL-3.0-or-later"), "apache-2.0": ("Apache-2.0",), "bsd": ("BSD-2-Clause", "BSD-3-Clause"),
    "cc-by": ("CC-BY-4.0",), "cc-by-nc": ("CC-BY-NC-4.0",), "cc-by-sa": ("CC-BY-SA-4.0",), "cc0": ("CC0-1.0",),
    "gpl": ("GPL-2.0-only", "GPL-3.0", "GPL-3.0-or-later"), "lgpl": ("LGPL-2.1-only", "LGPL-3.0-or-later"), "mit": ("MIT",),
    "mpl": ("MPL-2.0",),
}
#: Pairs of words that tell families of nearly the same wording apart; a notice that holds some of them needs one.
NAMES = {
    "agpl": ("gnu affero", "gnu agpl", "identifier agpl"), "gpl": ("gnu general", "gnu gpl", "under gpl", "identifier gpl"),
    "lgpl": ("gnu lesser", "gnu lgpl", "identifier lgpl"),
}
#: Sentences with words of licences that state none.
ORDINARY = (
    "She passed the test and got her driving license in the spring.",
    "The fishing licence costs twenty euros a year.",
    "The general public was invited to the opening of the museum.",
    "The rights of the child are protected by law.",
    "He reserved a table for four at eight.",
    "Version 2 of the report was released under pressure.",
    "The work of the commons committee was subject to debate.",
    "Free software courses are held at the public library.",
    "The Apache people lived in the south west.",
    "She studied at MIT and works on public health.",
    "Permission to land was granted at noon.",
    "All of the rights and wrongs were discussed.",
)

#: Statements of licences of no known family.
GENERIC = (
    "Licensed under the terms of its own license.",
    "Released under a custom license.",
    "This file is licensed under the license in the file.",
    "Use is subject to the license agreement.",
    "Licensed under the community license of the authors.",
    "Licensed under the Eclipse Public License 2.0",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    "Licensed under the European Union Public Licence v1.2",
    "Distributed under the European Union Public Licence.",
    "This is free and unencumbered software released into the public domain.",
    "Distributed under the Boost Software License, Version 1.0.",
    "This software is provided 'as-is', without any express or implied warranty.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "Released under the ISC License.",
    "Licensed under the zlib license.",
    "You may use it under the terms of the Artistic License 2.0.",
    "Subject to the terms of the Common Development and Distribution License 1.0.",
    "This font software is licensed under the SIL Open Font License, Version 1.1.",
    "Licensed under the Microsoft Public License.",
    "Licensed under the Python Software Foundation License.",
    "Available under the Open Data Commons Open Database License.",
    "Use of this software is governed by the Business Source License 1.1.",
    "Licensed under the Elastic License 2.0.",
    "The source is available under the Academic Free License version 3.0.",
    "The author dedicates this work to the public domain.",
    "All copyright and related rights in this work are waived.",
    "SPDX-License-Identifier: EPL-2.0",
    "SPDX-License-Identifier: Unlicense",
    "SPDX-License-Identifier: ISC",
    "SPDX-License-Identifier: LicenseRef-Proprietary",
)

#: Paragraphs of the corpus that train the class of ordinary text, at most.
SAMPLE = 3000
#: A family needs so much of a notice's pairs of words, and so many of them if it has as many; the same goes for those of
#: its pairs that no other family has. A word is no mark if so many of the distinct ordinary paragraphs hold it.
MIN_SIMILARITY, MIN_PAIRS = 0.6, 4
MAX_ORDINARY = 0.002
#: Share of the held-out statements of unknown licences, and of ordinary paragraphs, that lie below the threshold.
BELIEVED = 0.95

#: Words that by themselves are no part of a notice.
PLAIN_WORDS = set("a all and any any are as at be by can for from if in is it may not no of on or the this to under was with you".split())

CUE = r"(?i)licen[sc]|copyright|copyleft|reserved|public domain|creative commons"


@dataclass(frozen=True)
class Classifier:
    families: tuple[str, ...]
    marks: tuple[str, ...]
    vectors: CountVectorizerModel
    model: LogisticRegressionModel
    threshold: float
    held_out_accuracy: float
    left_out: tuple[str, ...] = ()


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """uid (of the row), doc_id, paragraph (number from 0), body: the lines of every text that are not blank."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), named(id_col).alias("doc_id"), named(text_col).alias("text"))
    lines = rows.select("uid", "doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "body"))
    return lines.where(F.trim("body") != "")


def with_words(rows: DataFrame) -> DataFrame:
    """``rows`` (body) with its lower-case words."""
    split = RegexTokenizer(inputCol="body", outputCol="words", pattern=r"[^\p{L}\p{N}]+", toLowercase=True)
    return split.transform(rows)


def with_runs(rows: DataFrame) -> DataFrame:
    """``rows`` (words) with pairs, and runs of one to three words."""
    rows = NGram(n=2, inputCol="words", outputCol="pairs").transform(rows)
    rows = NGram(n=3, inputCol="words", outputCol="triples").transform(rows)
    return rows.withColumn("runs", F.concat("words", "pairs", "triples")).drop("triples")


def notices(spark: SparkSession, left_out: tuple[str, ...] = ()) -> DataFrame:
    """family, body: the fixed notices but those of families ``left_out``, a few dozen rows."""
    rows = [(family, text) for family, texts in NOTICES.items() for text in texts if family not in left_out]
    rows += [(family, f"SPDX-License-Identifier: {name}") for family, names in SPDX.items() for name in names if family not in left_out]
    rows += [(NONE, t) for t in ORDINARY] + [(UNKNOWN, t) for t in GENERIC]
    return spark.createDataFrame(rows, "family string, body string").coalesce(1)


def variants(rows: DataFrame) -> DataFrame:
    """``rows`` (family, body) with each word left out in turn, and in other surroundings."""
    words = F.split("body", " ")
    dropped = F.transform(words, lambda _, i: F.array_join(F.filter(words, lambda _, j: j != i), " "))
    around = [F.concat(F.lit(a), F.col("body"), F.lit(b)) for a in ("", "Copyright (c) 2020 the authors. ", "This page: ") for b in ("", " See the file.")]
    several = F.when(F.col("family") == NONE, F.array(*around[:1])).otherwise(F.concat(F.array(*around), F.filter(dropped, lambda t: t != "")))
    return rows.select("family", F.explode(several).alias("body")).distinct()


def templates(spark: SparkSession, left_out: tuple[str, ...]) -> DataFrame:
    """family, templates: for each notice its pairs of words, those that no other family has, how many of each it takes, and
    the names it holds."""
    rows = with_runs(with_words(notices(spark, left_out).where(~F.col("family").isin(NONE, UNKNOWN)))).select("family", "pairs").collect()
    of_family: dict[str, set[str]] = {}
    for row in rows:
        of_family.setdefault(row["family"], set()).update(row["pairs"])

    def needed(n: int) -> int:
        return max(math.ceil(MIN_SIMILARITY * n), min(n, MIN_PAIRS))

    made = []
    for family, pairs in rows:
        own = sorted(set(pairs) - set().union(*(p for f, p in of_family.items() if f != family)))
        names = sorted(set(pairs) & set(NAMES.get(family, ())))
        made.append((family, sorted(set(pairs)), own, names, needed(len(set(pairs))), needed(len(own))))
    kinds = "family string, pairs array<string>, own array<string>, names array<string>, need int, need_own int"
    template = F.struct("pairs", "own", "names", "need", "need_own")
    return spark.createDataFrame(made, kinds).groupBy("family").agg(F.collect_list(template).alias("templates"))


def words_of(rows: DataFrame, column: str) -> list[str]:
    """The distinct entries of a column of lists, sorted; for the few dozen notices."""
    return sorted(r[0] for r in rows.select(F.explode(column)).distinct().collect())


def ordinary_lines(lines: DataFrame, known: Column) -> DataFrame:
    """The distinct ``lines`` (body, h: its hash) that resemble no notice: h, held_words (those among ``known``).

    The words and pairs of notices alone are kept of a line before equal lines become one, so that little is shuffled;
    these are stored, as a filter would else move below the shuffle and cut every line into words again for each notice.
    """
    listed = notices(lines.sparkSession).where(~F.col("family").isin(NONE, UNKNOWN))
    pairs = [r[0] for r in NGram(n=2, inputCol="words", outputCol="pairs").transform(with_words(listed)).select(F.array_distinct("pairs")).collect()]
    every = F.array(*[F.lit(p) for p in sorted({p for own in pairs for p in own})])
    telling = F.array(*[F.lit(w) for w in sorted({w for own in pairs for p in own for w in p.split()} - PLAIN_WORDS)])
    # most lines hold words such as "the" alone: they have no part of a notice, and their pairs are not made
    place = F.sequence(F.lit(1), F.size("words") - 1)
    made = F.transform(place, lambda i: F.concat_ws(" ", F.element_at("words", i), F.element_at("words", i + 1)))
    some = (F.size("words") > 1) & F.arrays_overlap("words", telling)
    held = F.when(some, F.array_intersect(every, made)).otherwise(F.array().cast("array<string>"))
    kinds = with_words(lines).select("h", F.array_intersect(known, "words").alias("held_words"), held.alias("held_pairs"))
    kinds = staged(kinds.distinct(), "licence-lines")
    alike = [F.size(F.array_intersect("held_pairs", F.array(*map(F.lit, own)))) / len(own) for own in pairs]
    resembles = F.when(F.size("held_pairs") > 0, F.greatest(*alike)).otherwise(0.0) >= MIN_SIMILARITY
    return kinds.where(~resembles).select("h", "held_words")


def train(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, left_out: tuple[str, ...] = ()
) -> Classifier:
    """Fit the classifier; at most ``sample`` paragraphs of ``docs`` (those of the smallest hash) stand for ordinary text.

    Ordinary text are the distinct paragraphs without a cue that resemble no notice. The marks come from all of them, not
    from the sample, so a licence header that many documents carry takes no mark away. One row in five is held out. The
    class of unknown licences is calibrated on it: a family is believed only above the probability that ``BELIEVED`` of the
    held-out statements of unknown licences, and of the ordinary paragraphs with a mark, stay within for their likeliest
    family, and never below one half. Families ``left_out`` are not learnt; their statements are unknown then.
    """
    spark = docs.sparkSession
    given = staged(with_runs(with_words(variants(notices(spark, left_out)))), "licence-notices")
    known = F.array(*map(F.lit, words_of(given.where(F.col("family") != NONE), "words")))
    lines = paragraphs(docs, id_col, text_col).where(~F.col("body").rlike(CUE)).select("body", F.xxhash64("body").alias("h"))
    kinds = ordinary_lines(lines, known)
    least = staged(kinds.select("h").orderBy("h").limit(sample), "licence-sample")
    ordinary = lines.join(least, "h", "left_semi").select("body").distinct().select(F.lit(NONE).alias("family"), "body")
    rows = given.withColumn("sampled", F.lit(False)).unionByName(with_runs(with_words(ordinary)).withColumn("sampled", F.lit(True)))
    rows = staged(rows.withColumn("held", F.pmod(F.xxhash64("body"), F.lit(5)) == 0), "licence-rows")
    # collected are the words, and below the runs of words, of a few dozen notices
    n_plain = kinds.count()
    plain = kinds.select(F.explode("held_words").alias("word")).groupBy("word").count()
    common = {r[0] for r in plain.where(F.col("count") > MAX_ORDINARY * n_plain).collect()}
    marks = [w for w in words_of(given.where(F.col("family") != NONE), "words") if w not in common]
    runs = rows.where(F.col("family") != NONE).select(F.explode("runs").alias("run")).distinct()
    runs = runs.where(F.arrays_overlap(F.split("run", " "), F.array(*map(F.lit, marks))))
    vectors = CountVectorizerModel.from_vocabulary(sorted(r[0] for r in runs.collect()), inputCol="runs", outputCol="features")
    vectors.setBinary(True)
    families = (NONE, UNKNOWN, *sorted(set(NOTICES) - set(left_out)))
    label = (F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1).cast("double")
    # as in use, rows without a mark are left out; ordinary text weighs as much as all notices together
    rows = rows.where(F.arrays_overlap("words", F.array(*map(F.lit, marks))))
    n, n_plain = rows.agg(F.count("*"), F.count(F.when(F.col("family") == NONE, 1))).first()
    weight = F.when(F.col("family") == NONE, (n - n_plain) / max(1, n_plain)).otherwise(1.0)
    rows = vectors.transform(rows).select("family", "held", "features", label.alias("label"), weight.alias("weight"))
    model = LogisticRegression(family="multinomial", maxIter=60, regParam=0.001, weightCol="weight").fit(rows.where("not held").coalesce(1))
    held = scored(model.transform(rows.where("held")), families)
    within = [F.percentile(F.when(F.col("family") == kind, F.col("likely")), F.lit(BELIEVED)) for kind in (NONE, UNKNOWN)]
    plain, strange, accuracy = held.agg(*within, F.avg((F.col("predicted") == F.col("family")).cast("double"))).first()
    return Classifier(families, tuple(marks), vectors, model, max(0.5, plain or 0.0, strange or 0.0), accuracy or 0.0, left_out)


def scored(rows: DataFrame, families: tuple[str, ...]) -> DataFrame:
    """Model output with predicted (the likeliest class) and likely (the probability of the likeliest family)."""
    chances = vector_to_array("probability")
    return rows.withColumns(
        {
            "predicted": F.element_at(F.array(*map(F.lit, families)), F.col("prediction").cast("int") + 1),
            "likely": F.array_max(F.slice(chances, 3, len(families))),
        }
    )


def statements(words: DataFrame) -> DataFrame:
    """doc_id, paragraph, words: lines (uid, doc_id, paragraph, words) of a text that follow each other, as one.

    A notice is wrapped over lines; a line that is blank, or has no mark, ends it. ``paragraph`` is that of its first line.
    """
    follows = F.col("paragraph") - F.row_number().over(Window.partitionBy("uid").orderBy("paragraph"))
    grouped = words.withColumn("run", follows).groupBy("uid", "run").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("paragraph", "words"))).alias("lines")
    )
    joined = F.flatten(F.transform("lines", lambda line: line["words"]))
    return grouped.select("doc_id", F.col("lines")[0]["paragraph"].alias("paragraph"), joined.alias("words"))


def find_licences(docs: DataFrame, classifier: Classifier, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The paragraphs that state a licence: doc_id, paragraph, family, similarity (to the family's nearest notice), probability.

    family is ``unknown`` where no family is likely enough or no notice of it confirms the prediction. A paragraph is a run
    of lines with a mark, numbered by its first line from 0 among all lines of the text, so a notice that is wrapped is
    seen whole; what is no letter or digit, such as a comment's mark, does not count. A paragraph of several licences has
    the likeliest family. Null and empty texts have none. Null ids and repeated rows are rows like others, each found on
    its own; an empty table gives no rows; other columns are not read.
    """
    words = with_words(paragraphs(docs, id_col, text_col))
    # paragraphs that hold no mark have no feature: ordinary text by the intercept
    marked = words.where(F.arrays_overlap("words", F.array(*map(F.lit, classifier.marks))))
    whole = statements(marked.select("uid", "doc_id", "paragraph", "words"))
    guessed = scored(classifier.model.transform(classifier.vectors.transform(with_runs(whole))), classifier.families)
    guessed = guessed.where(F.col("predicted") != NONE).select("doc_id", "paragraph", "predicted", "likely", "pairs")
    known = templates(docs.sparkSession, classifier.left_out)  # a few rows

    def alike(t: Column) -> Column:
        shared = F.size(F.array_intersect(t["pairs"], "pairs"))
        enough = (shared >= t["need"]) & (F.size(F.array_intersect(t["own"], "pairs")) >= t["need_own"])
        enough &= (F.size(t["names"]) == 0) | F.arrays_overlap(t["names"], "pairs")
        return F.struct(enough.alias("enough"), (shared / F.size(t["pairs"])).alias("similarity"))

    nearest = F.array_max(F.transform("templates", alike))
    compared = guessed.join(known, guessed["predicted"] == known["family"], "left").withColumn("nearest", nearest)
    sure = (F.col("likely") > classifier.threshold) & F.col("nearest.enough")
    return compared.select(
        "doc_id", "paragraph", F.when(sure, F.col("predicted")).otherwise(UNKNOWN).alias("family"),
        F.col("nearest.similarity").alias("similarity"), F.col("likely").alias("probability"),
    )
