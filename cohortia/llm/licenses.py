"""Licence notices in texts, paragraph by paragraph.

A multinomial logistic regression over hashed word n-grams gives each paragraph
a family of licences, unknown, or none. It is trained on variants of the
templates below, for unknown on variants of other notices and, for no licence, on
paragraphs of the corpus. What is more likely a notice than not is one; the top
probability tells its family only above a cut that is calibrated on notices that
were not trained on: what stays below is ``unknown``. A prediction is confirmed where the paragraph has enough of
the three-word sequences of one of the family's templates.

All of it is expressions and Spark's own estimators over DataFrames. Paragraphs
are classified where they are read; nothing is shuffled but the training rows,
whose number is bounded by ``training_rows`` and the templates.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia.session import staged

# Short notices of each family, in plain words.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License.",
        "This project is released under the Apache License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD License.",
        "This software is distributed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it under the terms of the GNU General Public License.",
        "Released under the GNU GPL.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the GNU LGPL.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This file is subject to the terms of the Mozilla Public License, version 2.0.",
        "Licensed under the MPL 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
#: Notices of no family above, for training.
OTHERS = [
    "All rights reserved.",
    "Copyright held by the authors. All rights reserved.",
    "Licensed under the Example Vendor Agreement.",
    "This work is licensed under the terms of a commercial contract.",
    "Use of this text is subject to the terms of the publisher.",
    "Released under a private licence of the owner.",
    "Redistribution of this report is not permitted without written consent.",
    "See the file named license for the terms of use.",
]
#: More of them, for calibration.
HELD_BACK = [
    "All rights are reserved by the publisher.",
    "Copyright of the contributors, no rights granted.",
    "Licensed under the Sample Community Agreement, version 2.",
    "This project is released under a proprietary licence.",
    "This software is distributed under the terms of a contract with its owner.",
    "Permission to copy this text is granted to subscribers only.",
    "Released under the Example Public Terms.",
    "Subject to the conditions of the vendor, who owns this file.",
]
NONE, UNKNOWN = "none", "unknown"
FEATURES, VARIANTS = 1 << 14, 24
HINT = "licen|copyright|rights reserved|spdx|redistribut|creative commons|permission"


def words(text: Column) -> Column:
    """Lower-case words; digits of a version are one and the same."""
    plain = F.regexp_replace(F.lower(text), r"\d+(\.\d+)*", "0")
    return F.filter(F.split(plain, r"[^\p{L}0-9]+"), lambda w: w != "")


def ngrams(of: Column, size: int) -> Column:
    """Runs of size words; none where there are fewer."""
    last = F.size(of) - size
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(of, i + 1, size), " "))
    return F.when(last >= 0, runs).otherwise(F.array().cast("array<string>"))


def _featured(rows: DataFrame, text: str) -> DataFrame:
    worded = rows.withColumn("_words", words(F.col(text)))
    terms = worded.withColumn("_terms", F.concat("_words", ngrams(F.col("_words"), 2)))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="_terms", outputCol="_features").transform(terms)


def paragraphs(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, paragraph (its line, from 0) and text of lines with a letter."""
    lines = docs.select(docs[id_col].alias("doc_id"), F.posexplode(F.split(docs[text_col].cast("string"), "\n", -1)).alias("paragraph", "text"))
    return lines.where(F.col("text").rlike(r"\p{L}")).withColumn("paragraph", F.col("paragraph").cast("long"))


@dataclass
class Scanner:
    model: LogisticRegressionModel
    families: list[str]
    cut: float
    overlap: float

    def scan(self, docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
        """doc_id, paragraph, text, family, probability, similarity and confirmed of all notices found.

        family is unknown where a notice is likely, but no family probable
        enough; such rows are never confirmed. probability is that of the family
        that comes first, or of unknown. A notice whose words are in none of the
        lists above is taken for no notice. A null text has no paragraphs, nor has one without
        letters. Null ids stay null, rows that repeat are scanned each for
        itself, and other columns are ignored, whatever their names.
        """
        scored = self.model.transform(_featured(paragraphs(docs, id_col, text_col), "text"))
        scored = scored.withColumn("_chances", vector_to_array("probability"))
        some = F.slice("_chances", 2, len(self.families) - 1)  # without none
        at = F.array_position(some, F.array_max(some)).cast("int")
        family = F.get(F.array(*map(F.lit, self.families)), at)
        top = F.struct(family.alias("family"), F.array_max(some).alias("probability"), F.get("_chances", F.lit(0)).alias("none"))
        # a generator, as a filter would be evaluated with all it depends on before the columns it depends on
        notice = F.explode(F.filter(F.array(top), lambda x: x["none"] < 0.5)).alias("top")
        found = scored.select("doc_id", "paragraph", "text", "_words", notice).select("doc_id", "paragraph", "text", "_words", "top.*")
        known = (F.col("family") != UNKNOWN) & (F.col("probability") >= self.cut)
        best = F.lit(0.0)
        for name, notices in TEMPLATES.items():
            of_family = F.greatest(F.lit(0.0), *[_similarity(notice) for notice in notices])
            best = F.when(F.col("family") == name, of_family).otherwise(best)
        return found.select(
            "doc_id", "paragraph", "text", F.when(known, F.col("family")).otherwise(UNKNOWN).alias("family"), "probability",
            F.when(known, best).otherwise(0.0).alias("similarity"),
        ).withColumn("confirmed", F.col("similarity") >= self.overlap)


def _similarity(notice: str) -> Column:
    """Share of a template's distinct three-word runs that the paragraph has."""
    plain = re.findall(r"[^\W_]+", re.sub(r"\d+(\.\d+)*", "0", notice.lower()))
    runs = sorted({" ".join(plain[i : i + 3]) for i in range(len(plain) - 2)})
    own = F.array_distinct(ngrams(F.col("_words"), 3))
    return F.size(F.array_intersect(own, F.array(*map(F.lit, runs)).cast("array<string>"))) / F.lit(max(len(runs), 1))


def _variants(notices: DataFrame, fillers: DataFrame, count: int) -> DataFrame:
    """Notices with a tenth of their words left out and, mostly, words of the corpus around them."""
    copies = notices.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    split = F.split("text", " ")
    some = F.filter(split, lambda w, i: (F.col("turn") == 0) | (F.pmod(F.xxhash64(w, i, "turn"), F.lit(10)) > 0))
    joined = copies.withColumn("kept", F.array_join(some, " ")).withColumn(
        "at", F.pmod(F.xxhash64("text", "turn"), F.lit(200))
    ).join(fillers, "at", "left")
    around = F.when(F.col("turn") % 3 == 1, F.concat_ws(" ", "kept", "filler")).when(
        F.col("turn") % 3 == 2, F.concat_ws(" ", "filler", "kept")
    )
    return joined.select("family", "turn", F.coalesce(around, "kept").alias("text"))


def train(docs: DataFrame, id_col="doc_id", text_col="text", training_rows: int = 4000, overlap: float = 0.6) -> Scanner:
    """Fit the classifier; training_rows bounds the paragraphs it takes from docs, which need not hold any.

    A corpus paragraph stands for no licence unless it has a word that licences
    use. The cut is the probability that all but one in a hundred variants of
    notices held back stay below, of those that are given a family, but at least
    a half.
    """
    spark: SparkSession = docs.sparkSession
    some = paragraphs(docs, id_col, text_col).where(~F.lower("text").rlike(HINT)).select("text").limit(training_rows)
    plain = staged(some.coalesce(1), "licence-plain")
    fillers = plain.select(
        F.pmod(F.xxhash64("text"), F.lit(200)).alias("at"), F.array_join(F.slice(F.split("text", " "), 1, 8), " ").alias("filler")
    ).groupBy("at").agg(F.min("filler").alias("filler"))
    notices = spark.createDataFrame([(f, t) for f, ts in TEMPLATES.items() for t in ts], "family string, text string")
    other = spark.createDataFrame([(UNKNOWN, t) for t in OTHERS], "family string, text string")
    held = spark.createDataFrame([(UNKNOWN, t) for t in HELD_BACK], "family string, text string")
    families = [NONE, *sorted(TEMPLATES), UNKNOWN]
    rows = _variants(notices.unionByName(other), fillers, VARIANTS).select("family", "text").unionByName(
        plain.select(F.lit(NONE).alias("family"), "text")
    ).unionByName(spark.createDataFrame([(NONE, "a"), (NONE, "the of and to in")], "family string, text string"))
    label = (F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1).cast("double")
    ready = staged(rows.withColumn("label", label).coalesce(1), "licence-training")
    regression = LogisticRegression(featuresCol="_features", labelCol="label", maxIter=40, regParam=1e-3, family="multinomial")
    model = regression.fit(_featured(ready, "text"))
    foreign = model.transform(_featured(_variants(held, fillers, VARIANTS), "text"))
    tops = foreign.where(~F.col("prediction").isin(0, len(families) - 1)).select(F.array_max(vector_to_array("probability")).alias("p"))
    cut = tops.agg(F.percentile("p", F.lit(0.99))).first()[0]
    return Scanner(model, families, max(cut or 0.5, 0.5), overlap)
