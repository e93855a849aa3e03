"""Licence scans: texts, their lines and windows of their words compared with licence templates.

All are normalised to words and compared by the Dice coefficient over their distinct word bigrams,
2 |A and B| / (|A| + |B|). A template whose number of bigrams alone rules the threshold out is not compared.
"""

from __future__ import annotations

import json
import pkgutil
import re
import zlib
from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.text import let, text_key

THRESHOLD_PCT = 80
#: Slots of the bitmap of template bigrams.
SLOTS = 1 << 20

#: Notices by which works name their licence.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "all-rights-reserved": "All rights reserved.",
}


@lru_cache(maxsize=1)
def license_texts() -> dict[str, str]:
    """Whole licence texts and complete standard headers, from the file beside this module."""
    return json.loads(pkgutil.get_data(__package__, "licenses.json"))


def _template_bigrams(text: str) -> list[str]:
    found = re.findall(r"[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(found, found[1:], strict=False)})


def bigrams(text: Column) -> Column:
    """Distinct bigrams of the normalised text: lower case, every run of other characters than ASCII
    letters and digits separates words."""
    found = F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")
    return let(
        found,
        lambda w: F.array_distinct(
            F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, w[i + 1]))
        ),
    )


def _crc(gram: str) -> int:
    return zlib.crc32(gram.encode())


def _marks(crcs: set[int]) -> list[int]:
    """Bitmap of the slots (low bits) of digests, 64 to a number."""
    words = [0] * (SLOTS // 64)
    for c in crcs:
        words[(c % SLOTS) // 64] |= 1 << (c % 64)
    return [w - (1 << 64) if w >> 63 else w for w in words]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def _pairs(w: Column, pair) -> Column:
    return F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: pair(F.concat_ws(" ", x, w[i + 1])))


def _windows(b: Column, inside: Column, t: Column, threshold_pct: int) -> Column:
    """Best windows of a bigram array that reach the threshold: first and last bigram (from 0), shared, size.

    A window gains by a template bigram at its edge and loses by another, so the best ones begin where a
    run of template bigrams begins and end at a template bigram. A bigram counts in a window when its
    previous occurrence lies before the window. Of windows that overlap the best one stays, the earlier
    of equal ones.
    """
    step_type = "struct<i:int,size:int,shared:int,last:int,top_shared:int,top_size:int>"

    def previous(s: Column) -> Column:
        own = F.transform(
            s, lambda x, j: F.struct(x["i"].alias("i"), F.when(F.get(s, j - 1)["b"] == x["b"], F.get(s, j - 1)["i"]).otherwise(-1).alias("before"))
        )
        return F.transform(F.sort_array(own), lambda x: x["before"])

    before = let(F.sort_array(F.transform(b, lambda x, i: F.struct(x.alias("b"), i.alias("i")))), previous)

    def search(p: Column) -> Column:
        starts = F.filter(
            F.transform(p, lambda x, i: F.when(x["hit"] & ~F.coalesce(F.get(p, i - 1)["hit"], F.lit(False)), i)), lambda i: i.isNotNull()
        )

        def best(first: Column) -> Column:
            def step(acc: Column, x: Column) -> Column:
                new = (x["before"] < first).cast("int")
                size, shared = acc["size"] + new, acc["shared"] + F.when(x["hit"], new).otherwise(0)
                better = (
                    x["hit"]
                    & (200 * shared >= threshold_pct * (size + t["size"]))
                    & (shared * (acc["top_size"] + t["size"]) > acc["top_shared"] * (size + t["size"]))
                )
                pick = lambda yes, name: F.when(better, yes).otherwise(acc[name]).alias(name)
                return F.struct(
                    (acc["i"] + 1).alias("i"), size.alias("size"), shared.alias("shared"), pick(acc["i"], "last"),
                    pick(shared, "top_shared"), pick(size, "top_size"),
                ).cast(step_type)

            longest = F.floor(t["n"] * (200 - threshold_pct) / threshold_pct).cast("int")
            zero = F.struct(
                first.alias("i"), *(F.lit(v).alias(c) for c, v in (("size", 0), ("shared", 0), ("last", -1), ("top_shared", 0), ("top_size", 0)))
            ).cast(step_type)
            return F.aggregate(
                F.slice(p, first + 1, F.greatest(longest, F.lit(1))), zero, step,
                lambda acc: F.struct(first.alias("first"), acc["last"].alias("last"), acc["top_shared"].alias("shared"), acc["top_size"].alias("size")),
            )

        return F.filter(F.transform(starts, best), lambda x: x["last"] >= 0)

    positions = F.zip_with(before, F.transform(b, lambda x: F.array_contains(inside, x)), lambda x, y: F.struct(x.alias("before"), y.alias("hit")))

    def choose(kept: Column, x: Column) -> Column:
        top = F.get(kept, F.size(kept) - 1)
        better = x["shared"] * (top["size"] + t["size"]) > top["shared"] * (x["size"] + t["size"])
        return (
            F.when((F.size(kept) == 0) | (x["first"] > top["last"]), F.concat(kept, F.array(x)))
            .when(better, F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(x)))
            .otherwise(kept)
        )

    none = F.array().cast("array<struct<first:int,last:int,shared:int,size:int>>")
    return F.aggregate(let(positions, search), none, choose)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Mapping[str, str] | None = None,
    threshold_pct: int = THRESHOLD_PCT,
) -> DataFrame:
    """Per document, licence and place that reaches the threshold: id, tk, license, whole, line, shared,
    size, template_size, dice. Without ``templates``, all notices and the licence texts are looked for.

    A place is the whole text (line 0), a line (from 1), or a window of words anywhere in the text, with
    the line in which it begins. Windows are reported where neither the whole text nor a line that they
    touch reaches the threshold for that licence; they have up to 1.5 times (by the threshold) as many
    words as the template. Only texts and lines with a bigram are compared; a text of one line is
    no line. NULL and empty texts match nothing. Repeated rows give repeated results. No exchange takes place.

    A place that matches shares two thirds (by the threshold) of the template's bigrams, so the text does.
    A bitmap of digests of all template bigrams leaves few bigrams of a text to be counted against that.
    """
    given = {**TEMPLATES, **license_texts()} if templates is None else templates
    known, every = [], set()
    for name, body in sorted(given.items()):
        if grams := _template_bigrams(body):
            crcs = {_crc(g) for g in grams}
            every |= crcs
            need = -(-threshold_pct * len(grams) // (200 - threshold_pct)) - (len(grams) - len(crcs))
            n = len(re.findall(r"[a-z0-9]+", body.lower())) - 1
            known.append({"license": name, "grams": grams, "crcs": sorted(crcs), "need": need, "size": len(grams), "n": n})
    kind = "array<struct<license:string,grams:array<string>,crcs:array<bigint>,need:int,size:int,n:int>>"
    table = F.from_json(F.lit(json.dumps(known)), kind)
    marks = F.from_json(F.lit(json.dumps(_marks(every))), "array<bigint>")
    marked = lambda c: F.getbit(F.get(marks, F.shiftright(c.bitwiseAND(F.lit(SLOTS - 1)), 6).cast("int")), c.bitwiseAND(F.lit(63)).cast("int")) == 1
    text = F.coalesce(F.col(text_col), F.lit(""))
    hits = let(_words(text), lambda w: F.array_distinct(F.filter(_pairs(w, lambda g: F.crc32(g)), marked)))
    candidates = let(
        hits, lambda h: F.filter(table, lambda t: (F.size(h) >= t["need"]) & (F.size(F.array_intersect(h, t["crcs"])) >= t["need"]))
    )
    pairs = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"), text.alias("text"), candidates.alias("c"))
    pairs = pairs.where(F.size("c") > 0).select("id", "tk", "text", F.explode("c").alias("t"))

    t, lines = F.col("t"), F.split("text", "\n")

    def place(whole: bool, line: Column, shared: Column, size: Column) -> Column:
        return F.struct(F.lit(whole).alias("whole"), line.cast("long").alias("line"), shared.cast("long").alias("shared"), size.cast("long").alias("size"))

    def compared(part: Column, whole: bool, line: Column) -> Column:
        return let(bigrams(part), lambda g: place(whole, line, F.size(F.array_intersect(g, t["grams"])), F.size(g)))

    reached = lambda x: (x["size"] > 0) & (200 * x["shared"] >= threshold_pct * (x["size"] + t["size"]))
    places = F.concat(
        F.array(compared(F.col("text"), True, F.lit(0))),
        F.when(F.size(lines) < 2, F.array().cast("array<struct<whole:boolean,line:bigint,shared:bigint,size:bigint>>")).otherwise(
            F.transform(lines, lambda x, i: compared(x, False, i + 1))
        ),
    )
    parts = pairs.withColumn("parts", F.filter(places, reached))
    by_line = F.transform(lines, _words)
    line_of = F.flatten(F.transform(by_line, lambda w, i: F.array_repeat(i + 1, F.size(w))))
    windows = let(let(F.flatten(by_line), lambda w: _pairs(w, lambda g: g)), lambda b: _windows(b, t["grams"], t, threshold_pct))
    outside = let(
        line_of,
        lambda n: F.transform(
            F.filter(
                windows,
                lambda x: ~F.exists("parts", lambda m: (m["line"] >= F.get(n, x["first"])) & (m["line"] <= F.get(n, x["last"] + 1))),
            ),
            lambda x: place(False, F.get(n, x["first"]), x["shared"], x["size"]),
        ),
    )
    found = parts.select(
        "id", "tk", "t.license", t["size"].cast("long").alias("template_size"),
        F.explode(F.when(F.exists("parts", lambda m: m["whole"]), F.col("parts")).otherwise(F.concat("parts", outside))).alias("m"),
    )
    return found.select(
        F.col("id").alias(id_col), "tk", "license", "m.whole", "m.line", "m.shared", "m.size", "template_size",
        (2 * F.col("m.shared") / (F.col("m.size") + F.col("template_size"))).alias("dice"),
    )
