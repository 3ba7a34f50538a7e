"""Licence notices in texts: a trained paragraph classifier, confirmed by comparison with templates.

Texts are cut into lines, and lines at the ends of sentences. Training examples are made from notice
templates: whole, without one word each, and in parts. Notices whose identifying words are replaced,
and notices of rights and licences outside the families, make the class ``unknown``; a bounded sample
of the corpus's own pieces, without those that speak of licences or rights, makes the class ``none``.

Two logistic regressions on hashed words and word pairs share the features. The first tells notices
from other text; it sees every piece of the corpus, as one sum over a constant array of weights. Its
threshold is calibrated by pieces that training did not see. Neighbouring pieces it takes for parts of
a notice are joined where no sentence ends between them, so a notice wrapped over several lines is
one paragraph again. The second, multinomial with a calibrated temperature, tells the families apart
in these paragraphs. A family is confirmed if the paragraph shares enough word pairs with one of its
templates; otherwise the notice stays ``unknown``. All steps are DataFrame or SQL functions and
Spark's own machine learning on DataFrames; no Python runs on the executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.frames import prepare, read
from presswork.session import materialize

# Licence families, and short notices by which they are commonly given.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file'
        " except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International"
        " License.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "bsd-3-clause": [
        "Released under the 3-Clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
#: Notices of rights, or of licences outside the families.
OTHERS = [
    "All rights reserved.",
    "Copyright 2020 by the authors. All rights reserved.",
    "Copyright (c) 2015 the contributors",
    "This is free and unencumbered software released into the public domain.",
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software.",
    "This work is dedicated to the public domain.",
    "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    "No part of this publication may be reproduced or distributed without the prior written permission"
    " of the publisher.",
    "Reproduction is permitted provided that the source is acknowledged.",
    "Used with permission of the copyright holder.",
    "Use of this software is subject to the terms of the license agreement.",
    "Alle Rechte vorbehalten.",
    "Dieses Werk steht unter einer freien Lizenz.",
    "Tous droits réservés.",
    "Cette œuvre est distribuée sous licence libre.",
    "Todos los derechos reservados.",
    "Esta obra está bajo una licencia libre.",
    "Tutti i diritti riservati.",
    "Todos os direitos reservados.",
    "Все права защищены.",
    "Данная программа распространяется по свободной лицензии.",
    "Копирование без письменного разрешения правообладателя запрещено.",
    "Всі права захищено.",
    "Με επιφύλαξη παντός δικαιώματος.",
    "版权所有，保留所有权利。",
    "版權所有，翻印必究。",
    "未经许可，不得转载。",
    "本软件按许可证条款发布。",
    "無断転載を禁じます。",
    "著作権者の許可なく複製することを禁じます。",
    "모든 권리 보유. 무단 전재 금지.",
    "جميع الحقوق محفوظة.",
    "כל הזכויות שמורות.",
]
#: Wording by which a piece may be a notice: no example of ``none``.
_RIGHTS = (
    r"(?i)licen[cs]|lizenz|licenza|copyright|copyleft|©|\(c\) *\d|public domain|rights? reserved"
    r"|unauthori[sz]ed (copying|use)|permission|spdx|redistribut|may (not )?be (reproduced|copied|distributed)"
    r"|rechte vorbehalten|urheberrecht|droits r|derechos reservados|diritti riservati|direitos reservados"
    r"|(?u)лиценз|ліценз|прав(а|о)|δικαιώματος|版权|版權|许可|許可|著作権|転載|转载|권리|الحقوق|זכויות"
)
#: Words that tell one family from another; without them a notice is one of an unknown licence.
_NAMES = (
    "apache|mit|gnu|general|public|gpl|mozilla|mpl|bsd|clause|creative|commons|attribution|"
    "noncommercial|international|cc|by|nc|2|3|4|0"
)
BINS = 1 << 16
#: How much more other text weighs than notices when the first model learns.
PRIOR = 4.0
#: Pieces of the corpus to learn ``none`` from, and as many again to calibrate with.
SAMPLE = 6_000
#: Probability from which a piece may be part of a notice that goes on in the next one.
PART = 0.2
#: Share of a template's word pairs that confirms a family.
CONFIRM = 0.7
TEMPERATURES = (0.5, 1.0, 2.0)
LABELS = ["none", "unknown", *TEMPLATES]
#: Where a line is cut: white space after the end of a sentence and before a capital.
_CUT = r"\n|(?<=[.!?])[ \t\r]+(?=\p{Lu})|(?<=[。！？])"
_ENDS = r"[.!?。！？][\s\p{Pe}\p{Pf}\"']*$"
#: Scripts without spaces: each character counts as a word.
_UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once and not per use."""
    return F.element_at(F.transform(F.array(value), use), 1)


def pieces(text: Column) -> Column:
    """The lines of a text, cut at the ends of sentences. Empty pieces stand for blank lines."""
    return F.split(F.coalesce(text, F.lit("")), _CUT)


def _words(body: Column) -> Column:
    """Words of any script, A-Z and other capitals in lower case."""
    wide = F.octet_length(body) > F.char_length(body)
    apart = F.when(
        wide & body.rlike(_UNSPACED), F.regexp_replace(body, f"({_UNSPACED})", " $1 ")
    ).otherwise(body)
    return F.filter(F.split(F.lower(apart), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _neighbours(values: Column, join) -> Column:
    """``join`` of each value and the next one."""
    n = F.size(values)
    return F.zip_with(
        F.slice(values, F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.slice(values, F.lit(2), F.greatest(n - 1, F.lit(0))),
        join,
    )


def _pairs(words: Column) -> Column:
    """The distinct pairs of neighbouring words, and a single word for itself."""
    return _once(
        words,
        lambda w: F.array_distinct(
            F.when(F.size(w) > 1, _neighbours(w, lambda x, y: F.concat_ws(" ", x, y))).otherwise(w)
        ),
    )


def _bins(body: Column) -> Column:
    """The distinct bins of the words and the pairs of neighbouring words."""

    def of(h: Column) -> Column:
        two = _neighbours(h, lambda x, y: F.pmod(F.hash(x, y), F.lit(BINS)))
        return F.array_distinct(F.concat(F.transform(h, lambda x: F.pmod(x, F.lit(BINS))), two))

    return _once(F.transform(_words(body), lambda w: F.hash(w)), of)


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(family, notice) for family, own in TEMPLATES.items() for notice in own]
    return spark.createDataFrame(rows, "family string, notice string")


def _examples(spark: SparkSession) -> DataFrame:
    """(label, body, part) made from the templates; ``part`` 0 is kept for calibration."""
    words = _templates(spark).select("family", _words(F.col("notice")).alias("w"))
    n = F.size("w")
    window = F.greatest(F.ceil(n * 0.7).cast("int"), F.lit(2))
    whole = words.select("family", F.explode(F.array_repeat(F.col("w"), 8)).alias("w"))
    without = words.select(
        "family", "w", F.explode(F.sequence(F.lit(1), n)).alias("i")
    ).select("family", F.filter("w", lambda x, at: at != F.col("i") - 1).alias("w"))
    parts = words.select(
        "family", "w", window.alias("size"),
        F.explode(F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1)))).alias("i"),
    ).select("family", F.slice("w", F.col("i"), F.col("size")).alias("w"))
    known = whole.union(without).union(parts).filter(F.size("w") > 1)
    body = F.array_join("w", " ")
    other = words.select(
        body.alias("body"), F.explode(F.sequence(F.lit(1), F.lit(30))).alias("i")
    ).select(
        F.lit("unknown").alias("label"),
        F.regexp_replace(
            F.col("body"), F.lit(rf"\b({_NAMES})\b"),
            F.concat(F.lit("x"), F.substring(F.md5(F.concat("body", F.col("i").cast("string"))), 1, 6)),
        ).alias("body"),
    )
    made = known.select(F.col("family").alias("label"), body.alias("body")).union(other)
    parted = made.withColumn("part", F.pmod(F.xxhash64("body"), F.lit(5)).cast("int"))
    rights = spark.createDataFrame([(x,) for x in OTHERS], "body string").select(
        F.lit("unknown").alias("label"),
        F.explode(F.array_repeat("body", 8)).alias("body"),
        F.lit(1).alias("part"),
    )
    return parted.union(rights)


def _similarity(spark: SparkSession) -> DataFrame:
    """One row with ``templates``: the family and the word pairs of each."""
    return _templates(spark).select("family", _pairs(_words(F.col("notice"))).alias("grams")).agg(
        F.collect_list(F.struct("family", "grams")).alias("templates")
    )


def _shares(templates: Column, pairs: Column) -> Column:
    """(family, share): how much of each template's word pairs are among the given ones."""
    return _once(
        pairs,
        lambda g: F.transform(
            templates,
            lambda t: F.struct(
                t["family"].alias("family"),
                (F.size(F.array_intersect(t["grams"], g)) / F.size(t["grams"])).alias("share"),
            ),
        ),
    )


@dataclass
class Scanner:
    """Both models, the second one's temperature, and the probability from which text is a notice.

    ``features`` are the second model's: the bins that its examples have. ``table`` is a written row
    of the first one's weights.
    """

    features: CountVectorizerModel
    weights: list[float]
    bias: float
    threshold: float
    families: LogisticRegressionModel
    temperature: float
    table: DataFrame | None = None

    def notice(self, body: Column, weights: Column | None = None) -> Column:
        """Probability that ``body`` is a notice, or a part of one.

        ``weights`` is a column with the row of ``table``; without it they are a constant.
        """
        if weights is None:  # a folded constant: the optimiser parses the list once
            weights = F.split(F.lit(",".join(f"{w:.4g}" for w in self.weights)), ",").cast("array<double>")
        total = F.aggregate(
            _bins(body), F.lit(self.bias), lambda a, b: a + F.get(weights, b.cast("int"))
        )
        return 1 / (1 + F.exp(-total))

    def probabilities(self, df: DataFrame) -> DataFrame:
        """``df`` (with ``body``) and ``p``, the calibrated probabilities of LABELS[1:]."""
        raw = self.families.transform(_vectors(df, self.features))

        softmax = lambda scores: _softmax(scores, F.lit(self.temperature))
        return raw.select(*df.columns, _once(vector_to_array("rawPrediction"), softmax).alias("p"))


def _softmax(scores: Column, temperature: Column) -> Column:
    grown = lambda x: F.aggregate(
        scores, F.lit(0.0), lambda a, y: a + F.exp((y - x) / temperature)
    )
    return F.transform(scores, lambda x: 1 / grown(x))


def _names(body: Column) -> Column:
    return F.transform(_bins(body), lambda b: b.cast("string"))


def _seen(examples: DataFrame) -> list[str]:
    """The examples' bins in order. Others would keep the weight 0; left out, they take no room."""
    seen = examples.select(F.explode("bins").alias("bin")).distinct().orderBy(F.col("bin").cast("int"))
    return seen.toArrow().column("bin").to_pylist()


def _vocabulary(bins: list[str]) -> CountVectorizerModel:
    return CountVectorizerModel.from_vocabulary(bins, inputCol="bins", outputCol="features")


def _vectors(df: DataFrame, features: CountVectorizerModel) -> DataFrame:
    """``df`` and its bins as sparse vectors."""
    return features.transform(df.withColumn("bins", _names(F.col("body"))))


def _sample(corpus: DataFrame, text: str, size: int) -> DataFrame:
    """The ``size`` distinct pieces of the corpus that are first in the order of their hashes.

    A count of all pieces tells below which hash these lie; only pieces below it leave their tasks.
    Where many repeat, so that too few are found, the bound is raised and the corpus read again.
    """
    column = pieces(F.col(f"`{text}`"))
    total = corpus.agg(F.sum(F.size(column).cast("long"))).first()[0] or 0
    order, share = F.xxhash64("body", F.lit(5)), 2.0 * size / max(total, 1)
    while True:
        own = corpus.select(F.explode(column).alias("body")).filter(F.col("body").rlike(r"[\p{L}\p{N}]"))
        if share < 1:
            own = own.filter(order < F.lit(int(-(2**63) + share * 2**64)))
        found = materialize(own.distinct().orderBy(order, "body").limit(size), "licence-sample")
        if share >= 1 or found.count() >= size:
            return found
        share *= 8


def train(corpus: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Scanner:
    """Fit and calibrate on the templates and a bounded sample of the corpus's pieces.

    Pieces much like a template, or with wording of licences or rights, are no examples of ``none``.
    A corpus without such other text gives nothing to tell notices from; the scanner then finds none.
    """
    spark = corpus.sparkSession
    templates = _similarity(spark)
    like = F.exists(_shares(F.col("templates"), _pairs(_words(F.col("body")))), lambda a: a["share"] >= 0.25)
    rest = materialize(
        _sample(corpus, text, 2 * sample).crossJoin(F.broadcast(templates))
        .filter(~like & ~F.col("body").rlike(_RIGHTS))
        .select(
            F.lit("none").alias("label"), "body",
            F.pmod(F.xxhash64("body", F.lit(6)), F.lit(2)).cast("int").alias("part"),
        ),
        "licence-none",
    )
    names = F.array(*[F.lit(x) for x in LABELS])
    examples = materialize(
        _examples(spark).unionByName(rest).select(
            "body", "part", _names(F.col("body")).alias("bins"), F.col("label").alias("label"),
            (F.array_position(names, F.col("label")) - 1).cast("double").alias("number"),
        ).coalesce(4),
        "licence-examples",
    )
    learnt = examples.filter("part > 0")
    own = learnt.filter("number > 0").withColumn("family", F.col("number") - 1)
    known = _vocabulary(_seen(own))
    families = LogisticRegression(
        labelCol="family", family="multinomial", maxIter=25, regParam=1e-4
    ).fit(known.transform(own))
    weights, bias = [0.0] * BINS, 0.0
    notices, others = learnt.agg(
        F.count_if(F.col("number") > 0), F.count_if(F.col("number") == 0)
    ).first()
    if others:
        every = _vocabulary(_seen(learnt))
        gate = LogisticRegression(
            labelCol="notice", weightCol="weight", family="binomial", maxIter=25, regParam=1e-4
        ).fit(
            every.transform(learnt).withColumn("notice", (F.col("number") > 0).cast("double"))
            .withColumn("weight", F.when(F.col("number") > 0, 1.0).otherwise(PRIOR * notices / others))
        )
        for b, weight in zip(every.vocabulary, gate.coefficients.toArray().tolist(), strict=True):
            weights[int(b)] = weight
        bias = float(gate.intercept)
    row = spark.createDataFrame([([float(f"{w:.4g}") for w in weights],)], "weights array<double>")
    table = materialize(row.coalesce(1), "licence-weights")
    scanner = Scanner(known, weights, bias, 0.5, families, 1.0, table)
    held = examples.filter("part = 0").select("body", "number")
    if others:  # half way between the most notice-like other text and most notices, as log odds
        odds = F.log(F.col("score") / (1 - F.col("score") + F.lit(1e-12)))
        scored = held.withColumn("weights", table.scalar())
        scored = scored.select("number", scanner.notice(F.col("body"), F.col("weights")).alias("score"))
        worst, usual = scored.agg(
            F.max(F.when(F.col("number") == 0, odds)),
            F.percentile(F.when(F.col("number") > 0, odds), 0.1),
        ).first()
        worst, usual = worst or 0.0, usual or 0.0
        middle = 1 / (1 + math.exp(-max(worst, (worst + usual) / 2)))
        scanner.threshold = min(0.99, max(0.5, middle))
    else:
        scanner.threshold = 0.99
    tries = F.explode(F.array(*[F.lit(t) for t in TEMPERATURES])).alias("temperature")
    scored = families.transform(_vectors(held.filter("number > 0"), known)).select(
        "number", vector_to_array("rawPrediction").alias("scores"), tries
    )
    chance = F.element_at(_softmax(F.col("scores"), F.col("temperature")), F.col("number").cast("int"))
    tried = scored.select("temperature", (-F.log(F.greatest(chance, F.lit(1e-12)))).alias("loss"))
    best = tried.groupBy("temperature").agg(F.avg("loss").alias("loss")).orderBy("loss", "temperature").first()
    if best:
        scanner.temperature = best["temperature"]
    return scanner


def _joined(parts: Column) -> Column:
    """Neighbouring parts made one paragraph: (at, last, body, best, ends) in order.

    A part goes on with the one before it if that is the piece just before, ends no sentence, and
    the part is not the notice of a template by itself.
    """

    def add(done: Column, part: Column) -> Column:
        before = F.element_at(done, -1)
        goes_on = (
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["last"] + 1 == part["at"])
            & ~F.try_element_at(done, F.lit(-1))["ends"] & ~part["whole"]
        )
        fresh = F.struct(
            part["at"].alias("at"), part["at"].alias("last"), part["body"].alias("body"),
            part["score"].alias("best"), part["ends"].alias("ends"),
        )
        longer = F.struct(
            before["at"].alias("at"), part["at"].alias("last"),
            F.concat_ws(" ", before["body"], F.trim(part["body"])).alias("body"),
            F.greatest(before["best"], part["score"]).alias("best"), part["ends"].alias("ends"),
        )
        return F.when(
            F.coalesce(goes_on, F.lit(False)),
            F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer)),
        ).otherwise(F.concat(done, F.array(fresh)))

    kind = "array<struct<at:int,last:int,body:string,best:double,ends:boolean>>"
    return F.aggregate(parts, F.array().cast(kind), lambda done, part: add(done, part).cast(kind))


def scan(
    df: DataFrame, scanner: Scanner, key: str = "doc_id", text: str = "text",
    weights: DataFrame | None = None,
) -> DataFrame:
    """(key, paragraph, family, probability, similarity, body) of every paragraph that is a notice.

    ``paragraph`` is the place of its first piece in the text. ``family`` is ``unknown`` where no
    template confirms the family found; ``probability`` is that of a notice of any kind, the highest
    of the paragraph and its pieces. Null and empty texts have no paragraphs; repeated rows and rows
    with a null key give each their own. Lines of any length and script are treated alike. Texts are
    scored where they are read; nothing is shuffled. ``weights``, the scanner's ``table``, keeps the
    list of weights out of the plan, of whose text the driver holds several copies.
    """
    templates = _similarity(df.sparkSession)
    held = None if weights is None else F.col("weights")

    def weighed(rows: DataFrame) -> DataFrame:
        return rows if weights is None else rows.withColumn("weights", weights.scalar())

    scored = F.transform(
        pieces(F.col("text")),
        lambda x, i: F.struct(i.alias("at"), x.alias("body"), scanner.notice(x, held).alias("score")),
    )
    likely = F.filter(
        scored, lambda x: (x["score"] >= PART) & x["body"].rlike(r"[\p{L}\p{N}]")
    )
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    # The outer form keeps the optimiser from testing the array first, which would work it out twice.
    few = weighed(rows).select("key", F.explode_outer(F.array(likely)).alias("parts")).filter("size(parts) > 0")
    whole = few.crossJoin(F.broadcast(templates)).select(
        "key", "templates",
        F.transform(
            "parts",
            lambda x: F.struct(
                x["at"].alias("at"), x["body"].alias("body"), x["score"].alias("score"),
                x["body"].rlike(_ENDS).alias("ends"),
                F.exists(
                    _shares(F.col("templates"), _pairs(_words(x["body"]))),
                    lambda a: a["share"] >= CONFIRM,
                ).alias("whole"),
            ),
        ).alias("parts"),
    )
    # The chance is worked out before the rows are: a filter on it would hold the weights once more.
    chances = F.transform(
        _joined(F.col("parts")),
        lambda x: F.struct(
            x.alias("run"), F.greatest(x["best"], scanner.notice(x["body"], held)).alias("chance")
        ),
    )
    joined = weighed(whole).select("key", "templates", F.explode_outer(chances).alias("found")).select(
        "key", "templates", "found.run", "found.chance"
    )
    names = F.array(*[F.lit(x) for x in LABELS[2:]])
    known = joined.select(
        "key", F.col("run.at").alias("paragraph"), F.col("run.body").alias("body"),
        "chance",
        _shares(F.col("templates"), _pairs(_words(F.col("run.body")))).alias("alike"),
    ).filter(F.col("chance") >= scanner.threshold)
    guessed = scanner.probabilities(known).withColumn("tops", F.slice("p", 2, len(LABELS))).withColumn(
        "guess", F.element_at(names, F.array_position("tops", F.array_max("tops")).cast("int"))
    )
    own = F.array_max(F.expr("transform(filter(alike, a -> a.family = guess), a -> a.share)"))
    any_ = F.array_max(F.expr("transform(alike, a -> a.share)"))
    return (
        guessed.withColumn("own", own)
        .withColumn("similarity", F.when(F.col("own") >= CONFIRM, F.col("own")).otherwise(any_))
        .withColumn("family", F.when(F.col("own") >= CONFIRM, F.col("guess")).otherwise("unknown"))
        .select(F.col("key").alias(key), "paragraph", "family", F.col("chance").alias("probability"), "similarity", "body")
    )


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices in the documents: doc_id, paragraph, family, probability, similarity."""
    prepare(spark)
    documents = read(spark, folder, "documents").select("doc_id", "text")
    scanner = train(documents)
    return scan(documents, scanner, weights=scanner.table).drop("body")
