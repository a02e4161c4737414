"""Licence statements in text (trained paragraph classifier).

Lines are the paragraphs. A multinomial logistic regression over the words and word pairs of a paragraph
names the licence family or none. It is trained here on short notices of each family and on sentences that
use the same words without granting anything. A probability below the calibrated bound means
unknown; a named family is confirmed when the paragraph holds most of the words and pairs of one of its notices.

Training looks at the notices only. Documents are scanned, scored and compared by functions of Spark SQL; the
model is a constant of the plan.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"

# Notices by family, in the wording their publishers recommend or that is in common use.
NOTICES = {
    "MIT": (
        "Released under the MIT License.", "Licensed under the MIT license.", "This project is licensed under the terms of the MIT license.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Distributed under the Apache 2.0 license.", "SPDX-License-Identifier: Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GPLv3.", "Licensed under the GNU GPL, version 2 or later.", "SPDX-License-Identifier: GPL-3.0-or-later", "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-2.1-or-later", "This library is free software under the GNU Lesser General Public License.", "Released under the LGPL.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only", "Released under the AGPLv3.", "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Licensed under the BSD 3-Clause License.", "Released under the BSD license.",
        "SPDX-License-Identifier: BSD-2-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0", "If a copy of the MPL was not distributed with this file, you can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0", "Content is available under the Creative Commons Attribution License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Text is available under the Creative Commons Attribution-ShareAlike License.", "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Released under CC BY-NC.", "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.", "Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "This work is dedicated to the public domain.", "SPDX-License-Identifier: CC0-1.0", "SPDX-License-Identifier: Unlicense",
    ),
    "proprietary": (
        "All rights reserved.", "Copyright 2024 the authors. All rights reserved.", "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher.",
        "This document is proprietary and confidential.", "Unauthorized copying of this file is strictly prohibited.",
    ),
}
OTHERS = (
    "He lost his driver's license in the accident.", "She studied copyright law at the university.", "The patent office granted a license to the inventor.", "A fishing license costs twenty dollars.", "The MIT campus lies in Cambridge.",
    "The Apache helicopter flew over the valley.", "Mozilla announced a new version of the browser.", "The software foundation held a public meeting.", "The general public was not admitted.", "The committee reserved all seats in the hall.",
    "Animal rights are discussed in the second chapter.", "They asked for permission to use the room.", "The library is free for all readers.", "License plates are issued by the state.", "Creative people like common spaces.",
    "This work was published in version 3 of the report.", "A copy of the letter was distributed with the file.", "The public domain of the function is the set of real numbers.", "You should have received a copy of the invoice by now.", "The terms of the agreement were not published.",
    "Under the bridge a new version of the ship was released.", "The copyright of the song was sold in 1998.", "We redistribute food in source regions, with or without modification of the routes.", "The licensed electrician repaired the wires.", "His license to practise medicine was revoked.",
)
LEAST_SIMILARITY = 0.6


def grams(text: str) -> list[str]:
    """Words and pairs of words of a paragraph, as ``_grams`` makes them."""
    words = re.findall("[a-z0-9]+", text.lower())
    return sorted({*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))})


def _fit(x: np.ndarray, y: np.ndarray, classes: int, steps: int = 400, rate: float = 0.5, decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    weights, bias, wanted = np.zeros((x.shape[1], classes)), np.zeros(classes), np.eye(classes)[y]
    for _ in range(steps):
        gap = _softmax(x @ weights + bias) - wanted
        weights -= rate * (x.T @ gap / len(x) * 10 + decay * weights)
        bias -= rate * gap.mean(0)
    return weights, bias


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@functools.cache
def train() -> dict:
    """Vocabulary, weights, bias and bound of the classifier, and the grams of each notice.

    The bound is where the notices that a fourth of the data was kept from learning are best told from the other sentences.
    """
    families = [*NOTICES, UNKNOWN]
    texts = [(t, families.index(f)) for f, notices in NOTICES.items() for t in notices] + [(t, len(families) - 1) for t in OTHERS]
    vocabulary = sorted({g for t, _ in texts for g in grams(t)})
    place = {g: i for i, g in enumerate(vocabulary)}
    x, y = np.zeros((len(texts), len(vocabulary))), np.array([f for _, f in texts])
    for i, (t, _) in enumerate(texts):
        x[i, [place[g] for g in grams(t)]] = 1
    sure, wrong = [], []
    for fold in range(4):
        held = np.arange(len(y)) % 4 == fold
        p = _softmax(x[held] @ (w := _fit(x[~held], y[~held], len(families)))[0] + w[1])
        for row, family in zip(p, y[held]):
            best = int(row[:-1].argmax())
            (sure if best == family else wrong).append(row[best])
    bounds = np.linspace(0.3, 0.9, 61)
    errors = [sum(p < b for p in sure) + 2 * sum(p >= b for p in wrong) for b in bounds]
    weights, bias = _fit(x, y, len(families))
    templates = [{"family": i, "grams": grams(t)} for i, f in enumerate(NOTICES) for t in NOTICES[f]]
    weights, bias, bound = np.round(weights, 6), np.round(bias, 6), float(bounds[int(np.argmin(errors))])
    # A family with a probability of at least the bound is ahead of unknown by ln(bound / (1 - bound)); a gram brings it no nearer than its gain.
    gains = np.maximum((weights[:, :-1] - weights[:, -1:]).max(1), 0)
    least = float(np.log(bound / (1 - bound)) - (bias[:-1] - bias[-1]).max() - 1e-6)
    return {"vocabulary": vocabulary, "weights": weights.tolist(), "bias": bias.tolist(), "bound": bound, "gains": gains.tolist(), "least": least, "templates": templates, "families": families}


_MODEL = "vocabulary array<string>, weights array<array<double>>, bias array<double>, bound double, gains array<double>, least double, templates array<struct<family:int,grams:array<string>>>, families array<string>"


def _constant() -> Column:
    """The model as a literal."""
    return F.from_json(F.lit(json.dumps(train())), _MODEL)


def _grams(paragraph: Column) -> Column:
    words = F.array_remove(F.split(F.lower(paragraph), "[^a-z0-9]+"), "")
    pairs = lambda w: F.when(F.size(w) > 1, F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1)))).otherwise(F.array().cast("array<string>"))
    return _let(words, lambda w: F.array_distinct(F.concat(w, pairs(w))))


def licence_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, line, paragraph, family, probability, similarity, confirmed) of the lines that state a licence.

    Every line is looked at; where the words it holds cannot bring any family to the bound, the probabilities are not worked out. Lines count from 0. Null and empty texts have none. Rows are treated one by one, so repeated rows
    give repeated results.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    lines = rows.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "paragraph"))
    # the model is named inside the expression: as a column it would be copied into every row
    model = _constant()
    # an outer explode of one expression, so that Spark does not work it out once for a filter and once more
    named = lines.select("doc_id", "line", "paragraph", F.explode_outer(_let(model, lambda m: _verdicts(m, F.col("paragraph")))).alias("v")).where("v IS NOT NULL")
    return named.select("doc_id", "line", "paragraph", "v.*", (F.col("v.similarity") >= LEAST_SIMILARITY).alias("confirmed"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once for each row."""
    return F.transform(F.array(value), body)[0]


def _verdicts(m: Column, paragraph: Column) -> Column:
    """An array of the family, probability and similarity of a paragraph; empty where it is unknown."""

    def logits(held: Column) -> Column:
        return F.transform(m["bias"], lambda b, k: F.aggregate(held, b, lambda a, p: a + F.get(F.get(m["weights"], p - 1), k)))

    def known(g: Column) -> Column:
        return F.transform(F.array_intersect(m["vocabulary"], g), lambda x: F.array_position(m["vocabulary"], x).cast("int"))

    def near(held: Column) -> Column:
        return F.aggregate(held, F.lit(0.0), lambda a, p: a + F.get(m["gains"], p - 1)) >= m["least"]

    def shares(z: Column) -> Column:
        return _let(F.transform(z, lambda x: F.exp(x - F.array_max(z))), lambda e: _let(F.aggregate(e, F.lit(0.0), lambda a, b: a + b), lambda total: F.transform(e, lambda x: x / total)))

    def similarity(g: Column, best: Column) -> Column:
        own = F.filter(m["templates"], lambda t: t["family"] == best)
        return F.array_max(F.transform(own, lambda t: F.size(F.array_intersect(t["grams"], g)) / F.size(t["grams"])))

    def verdict(g: Column, p: Column) -> Column:
        top = F.array_max(F.slice(p, 1, F.size(p) - 1))
        best = (F.array_position(p, top) - 1).cast("int")
        found = F.array(F.struct(F.get(m["families"], best).alias("family"), top.alias("probability"), similarity(g, best).alias("similarity")))
        return F.when((top >= m["bound"]) & (top > F.element_at(p, -1)), found)

    return _let(_grams(paragraph), lambda g: _let(known(g), lambda held: F.when(near(held), _let(_let(logits(held), shares), lambda p: verdict(g, p)))))
