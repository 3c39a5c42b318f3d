"""Licence scans: TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest directory.

A file's passages are its lines that name a licence (headers, anywhere in the text) and, for files called LICENSE and the like,
its whole text. A passage is compared with each template by the cosine of their sparse TF-IDF vectors; terms are lower-case
runs of ASCII letters and digits, and a term's weight follows from the number of templates that have it. The best template of
the best passage is the file's own licence if the cosine reaches ``LEAST``.

A file that names a licence but does not reach it is looked at again: an SPDX tag is taken as it stands (without "-only",
"-or-later" and "+"), its lines are cut into sentences that are compared with the templates and with ``HEADERS``, and a licence
file's whole text is compared with whole licence texts (``licenses/``) in ``SLOTS`` hashed terms. The first of tag, whole text
and sentence that reaches ``LEAST`` is the file's own licence. So is a file looked at again that only reserves all rights, as
licence texts do too. A file without one inherits that of the nearest directory above it whose licence file has
one, found by joining directories with the ancestors of all directories in use.

Defined results: null and empty texts have no licence of their own. Files with a null path have no directory and inherit nothing.
Of several licence files in one directory the best match counts, ties to the smaller path. Repeated rows are judged alike.
Columns of the input are kept; those named like a result are replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.words import carried, let
from tallyloom.operators.joins import skew_join

# The short notices by which licences are commonly declared.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This source code form is subject to the terms of the Mozilla Public License, version 2.0.",
    "Proprietary": "Copyright. All rights reserved.",
}
#: Further titles and headers of licences, compared with sentences.
HEADERS = [
    ("Apache-2.0", "Apache License Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
]
TEXTS = {p.stem: p.read_text(encoding="utf-8") for p in sorted(Path(__file__).with_name("licenses").glob("*.txt"))}
# The AGPL is the GPL under another name but for its section 13; without it, its text would pass for the GPL.
TEXTS["AGPL-3.0"] = re.sub("(?i)(GNU) (General Public License)", r"\1 Affero \2", TEXTS["GPL-3.0"])
SLOTS = 1 << 12
#: What a file says that reserves all rights, which says little beside a licence.
RESERVED = "Proprietary"
SPDX = r"(?i)spdx-license-identifier:[\x20\t]*(\(?[a-z0-9.+-]+\)?(?:[\x20\t]+(?:or|and|with)[\x20\t]+\(?[a-z0-9.+-]+\)?)*)"
CUE = r"(?i)licen[cs]|copyright|all rights reserved|public domain|spdx|creative commons"
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)(\.[a-z]+)?$"
LEAST = 0.7
DIGITS = 6
RESULTS = ("own_license", "score", "license", "inherited_from")


def terms_of(passage: Column) -> Column:
    return F.array_remove(F.split(F.lower(passage), "[^a-z0-9]+"), "")


def template_weights(templates: dict[str, str]) -> tuple[dict[str, float], float, dict[str, dict[str, float]]]:
    """The inverse document frequency of each term, that of an unknown term, and each template's unit vector."""
    counts = {name: Counter(re.findall("[a-z0-9]+", text.lower())) for name, text in templates.items()}
    having = Counter(t for c in counts.values() for t in c)
    idf = {t: math.log((1 + len(counts)) / (1 + n)) + 1 for t, n in having.items()}
    vectors = {}
    for name, c in counts.items():
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items()))
        vectors[name] = {t: n * idf[t] / norm for t, n in c.items()}
    return idf, math.log(1 + len(counts)) + 1, vectors


def _map(values: dict[str, float]) -> Column:
    return F.create_map(*(F.lit(x) for pair in sorted(values.items()) for x in pair))


def best_match(passage: Column, templates: dict[str, str]) -> Column:
    """struct(score, license) of the most similar template; equal scores go to the first name."""
    idf, unknown, vectors = template_weights(templates)

    def score(terms: Column) -> Column:
        weight = lambda t: F.coalesce(F.try_element_at(_map(idf), t), F.lit(unknown))
        # Runs of equal terms in the sorted list are the term frequencies.
        zero = F.struct(F.lit("").alias("t"), F.lit(0.0).alias("w"), F.lit(0.0).alias("done"))
        step = lambda a, t: F.when(a["t"] == t, F.struct(t.alias("t"), (a["w"] + weight(t)).alias("w"), a["done"].alias("done"))).otherwise(
            F.struct(t.alias("t"), weight(t).alias("w"), (a["done"] + a["w"] * a["w"]).alias("done")))
        norm = F.aggregate(F.sort_array(terms), zero, step, lambda a: F.sqrt(a["done"] + a["w"] * a["w"]))

        def dot(vector: dict[str, float]) -> Column:
            shares = _map({t: x * idf[t] for t, x in vector.items()})
            return F.aggregate(terms, F.lit(0.0), lambda a, t: a + F.coalesce(F.try_element_at(shares, t), F.lit(0.0)))

        def best(length: Column) -> Column:
            dots = [
                F.struct(F.round(dot(v) / length, DIGITS).alias("score"), F.lit(name).alias("license"))
                for name, v in sorted(vectors.items())
            ]
            return F.reduce(F.array(*dots), F.struct(F.lit(0.0).alias("score"), F.lit("").alias("license")),
                            lambda a, d: F.when(d["score"] > a["score"], d).otherwise(a))

        return let(F.when(norm > 0, norm).otherwise(1.0), best)

    return let(terms_of(passage), score)


def best_text(text: Column, texts: dict[str, str]) -> Column:
    """struct(score, license) of the most similar whole text, by the same cosine over hashed terms."""
    slot = lambda term: zlib.crc32(term.encode()) % SLOTS
    counts = {name: Counter(slot(t) for t in re.findall("[a-z0-9]+", whole.lower())) for name, whole in texts.items()}
    having = Counter(k for c in counts.values() for k in c)
    idf = [math.log((1 + len(counts)) / (1 + having[k])) + 1 for k in range(SLOTS)]
    # One string that Spark folds into one constant array; zeros as whole numbers take little room in the plan.
    table = lambda values, unit: F.split(F.lit(",".join(str(round(v * unit)) for v in values)), ",").cast("array<int>")

    def score(slots: Column) -> Column:
        zero = F.struct(F.lit(-1).cast("long").alias("t"), F.lit(0.0).alias("w"), F.lit(0.0).alias("done"))
        weight = lambda t: F.get(table(idf, 1000), t.cast("int")) / 1000
        step = lambda a, t: F.when(a["t"] == t, F.struct(t.alias("t"), (a["w"] + weight(t)).alias("w"), a["done"].alias("done"))).otherwise(
            F.struct(t.alias("t"), weight(t).alias("w"), (a["done"] + a["w"] * a["w"]).alias("done")))
        length = F.aggregate(F.sort_array(slots), zero, step, lambda a: F.sqrt(a["done"] + a["w"] * a["w"]))

        def dot(c: Counter) -> Column:
            norm = math.sqrt(sum((n * idf[k]) ** 2 for k, n in c.items()))
            shares = table((c[k] * idf[k] ** 2 / norm for k in range(SLOTS)), 100_000)
            return F.aggregate(slots, F.lit(0).cast("long"), lambda a, t: a + F.get(shares, t.cast("int"))) / 100_000

        found = [F.struct((-F.round(F.try_divide(dot(c), length), DIGITS)).alias("s"), F.lit(name).alias("license")) for name, c in sorted(counts.items())]
        return let(F.array_min(F.array(*found)), lambda b: F.struct(F.coalesce(-b["s"], F.lit(0.0)).alias("score"), b["license"].alias("license")))

    return let(F.transform(terms_of(text), lambda t: F.crc32(t) % F.lit(SLOTS)), score)


def second_look(text: Column, special: Column, templates: dict[str, str], headers: list[tuple[str, str]], texts: dict[str, str], least: float) -> Column:
    """struct(score, license) of the SPDX tag, else of the whole text if it reaches ``least``, else of the best sentence."""
    none = F.struct(F.lit(0.0).alias("score"), F.lit("").alias("license"))
    better = lambda a, d: F.when(d["score"] > a["score"], d).otherwise(a)
    tag = F.regexp_replace(F.regexp_extract(text, SPDX, 1), r"(?i)(-only|-or-later|\+)(?=[\s)]|$)", "")
    tagged = F.struct(F.lit(1.0).alias("score"), tag.alias("license"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(CUE))
    cut = F.flatten(F.transform(lines, lambda x: F.split(x, r"(?<=[.!?;])[\x20\t]+")))
    # A licence has several templates here, so a number follows its name.
    named = {f"{name}|{k}": t for k, (name, t) in enumerate([*templates.items(), *headers])}
    sentences = F.transform(F.filter(F.array_distinct(cut), lambda x: x.rlike(CUE)), lambda x: best_match(x, named))
    sentence = let(F.reduce(sentences, none, better), lambda b: F.struct(b["score"].alias("score"), F.regexp_replace(b["license"], r"\|\d+$", "").alias("license")))
    whole = F.when(special, best_text(text, texts)).otherwise(none) if texts else none
    return F.when(F.length(tag) > 0, tagged).otherwise(let(whole, lambda w: F.when(w["score"] >= least, w).otherwise(sentence)))


def own_licenses(
        files: DataFrame, templates: dict[str, str], least: float, headers: list[tuple[str, str]] = HEADERS, texts: dict[str, str] = TEXTS) -> DataFrame:
    kept = carried(files.columns, RESULTS)
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(CUE))
    whole = F.when(F.element_at(F.split("path", "/"), -1).rlike(LICENSE_FILE) & text.rlike(CUE), F.array(text)).otherwise(F.array().cast("array<string>"))
    best = F.reduce(
        F.transform(F.array_distinct(F.concat(lines, F.coalesce(whole, F.array().cast("array<string>")))), lambda p: best_match(p, templates)),
        F.struct(F.lit(0.0).alias("score"), F.lit("").alias("license")), lambda a, d: F.when(d["score"] > a["score"], d).otherwise(a))
    special = F.coalesce(F.element_at(F.split("path", "/"), -1).rlike(LICENSE_FILE), F.lit(False))
    settled = lambda b: (b["score"] >= least) & (b["license"] != RESERVED)
    better = lambda b, d: (d["score"] >= least) & ((b["score"] < least) | (d["license"] != RESERVED))
    again = lambda b: F.when(settled(b), b).otherwise(
        let(second_look(text, special, templates, headers, texts, least), lambda d: F.when(better(b, d), d).otherwise(b)))
    found = files.select(*kept, F.when(text.rlike(CUE), let(best, again)).alias("__b"))
    sure = F.col("__b.score") >= least
    return found.select(*kept, F.when(sure, F.col("__b.license")).alias("own_license"), F.coalesce("__b.score", F.lit(0.0)).alias("score"))


def scan(
        files: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST, headers: list[tuple[str, str]] = HEADERS,
        texts: dict[str, str] = TEXTS) -> DataFrame:
    """``files`` (``path``, ``text``) with own licence and score, the licence that holds, and the directory it comes from."""
    if len(templates) + len(headers) + len(texts) > 1000:
        raise ValueError("templates are part of the plan: a thousand at most")
    own = own_licenses(files, templates, least, headers, texts).withColumn("__dir", F.regexp_replace("path", "/[^/]*$", ""))
    name = F.element_at(F.split("path", "/"), -1)
    holders = own.where(name.rlike(LICENSE_FILE) & F.col("own_license").isNotNull()).groupBy(F.col("__dir").alias("__holder")).agg(
        F.min(F.struct((-F.col("score")).alias("s"), F.col("path"), F.col("own_license"))).alias("__best")).select(
        "__holder", F.col("__best.own_license").alias("__given"))
    parts = F.split("__dir", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("dir")))
    used = own.where("__dir is not null").select("__dir").distinct().select("__dir", F.explode(ancestors).alias("a"))
    used = used.select("__dir", F.col("a.depth").alias("depth"), F.col("a.dir").alias("__holder"))
    # A directory near the root may be above a third of all directories, and one directory may hold a third of all files.
    above = skew_join(used, holders, "__holder").groupBy("__dir").agg(F.max(F.struct("depth", "__holder", "__given")).alias("__near"))
    out = skew_join(own, above, "__dir", "left")
    alone = F.col("own_license").isNotNull()
    return out.select(
        *carried(files.columns, RESULTS), "own_license", "score",
        F.coalesce("own_license", "__near.__given").alias("license"),
        F.when(~alone, F.col("__near.__holder")).alias("inherited_from"))
