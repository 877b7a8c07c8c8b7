"""License texts in documents: MinHash bands over overlapping windows retrieve, exact shingles verify.

All of it is column expressions, without Python in tasks and without a shuffle: a document is one row
from its words to its licenses. A shingle is five words; shingles are hashed once. A window is
``WINDOW`` shingles, and windows start every half window; a band is the least of the window's hashes
under one of ``BANDS`` reorderings (an exclusive or with a fixed number). A window with Jaccard
similarity J to some window of a template meets it in a band with probability 1 - (1 - J)^BANDS, which
is 0.996 at J = 0.5. Templates of less than a window are met by single shingles, whose band is the
shingle itself, so none is missed. Where a document meets templates, the share of each template's
shingles that the text around has is counted on the words themselves; from ``SHARE`` on it is found.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE, WINDOW, STEP, BANDS, SHARE = 5, 16, 8, 8, 0.8
#: Templates are part of the plan and are kept by every task.
MOST_TEMPLATES = 256

#: Notices as they stand in files and the usual beginnings of the license texts.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer."
    ),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"
    ),
}


def _masks() -> list[int]:
    """Fixed 64-bit numbers, one for each band."""
    out, x = [], 0x9E3779B97F4A7C15
    for _ in range(BANDS):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(x - (1 << 63))
    return out


def words(text: Column) -> Column:
    """Lower-cased runs of digits, letters a-z and anything outside ASCII."""
    return F.array_remove(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _with_shingles(rows: DataFrame, text: str) -> DataFrame:
    """Adds _words and _hashes, the hashes of their shingles (none with fewer than five words)."""
    rows = rows.withColumn("_words", words(F.coalesce(F.col(text), F.lit(""))))
    rows = rows.withColumn("_each", F.transform("_words", lambda w: F.xxhash64(w)))
    last = F.size("_each") - SHINGLE
    shingle = lambda i: F.xxhash64(*(F.get("_each", i + k) for k in range(SHINGLE)))
    hashes = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), shingle)).otherwise(F.array().cast("array<bigint>"))
    return rows.withColumn("_hashes", hashes)


def _band(hashes: Column, mask: int) -> Column:
    return F.array_min(F.transform(hashes, lambda x: x.bitwiseXOR(F.lit(mask))))


def _half(mask: int):
    return lambda b: _band(F.slice("_hashes", b * STEP + 1, STEP), mask)


def _window(mask: int):
    return lambda o: _band(F.slice("_hashes", o, WINDOW), mask)


def _strings(found: Column) -> Column:
    """Shingles of an array of words, as text."""
    last = F.size(found) - SHINGLE
    return F.when(last >= 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(0)) + 1), lambda i: F.array_join(F.slice(found, i, SHINGLE), " "))).otherwise(F.array().cast("array<string>"))


def _index(spark: SparkSession, templates: dict[str, str]) -> list:
    """Per template: name, different shingles, shingles' hashes, bands of all its windows (at every offset)."""
    entries = [F.struct(F.lit(n).alias("name"), F.lit(t).alias("text")) for n, t in sorted(templates.items())]
    rows = _with_shingles(spark.range(1).select(F.explode(F.array(*entries)).alias("t")).select("t.name", "t.text"), "text")
    offsets = F.sequence(F.lit(1), F.greatest(F.size("_hashes") - WINDOW + 1, F.lit(1)))
    bands = F.array(*(F.transform(offsets, _window(m)) for m in _masks()))
    return rows.select("name", F.array_distinct(_strings(F.col("_words"))).alias("shingles"), F.col("_hashes").alias("hashes"), bands.alias("bands")).collect()


def _share(at: Column, template: Column, spread: Column) -> Column:
    """Share of the template's shingles in the words that may belong to it around a shingle."""
    low = F.greatest(at - spread, F.lit(0))
    around = F.slice("_words", low + 1, at - low + spread + WINDOW + SHINGLE)
    return F.size(F.array_intersect(_strings(around), template["shingles"])) / F.size(template["shingles"])


def _verified(entries: list, places: Column) -> Column:
    """Names of those templates whose share is high enough at one of the places."""
    if not entries:
        return F.array().cast("array<string>")
    kept = F.array(*(F.struct(F.lit(e.name).alias("name"), F.array(*map(F.lit, e.shingles)).alias("shingles")) for e in entries))
    good = F.filter(kept, lambda t: F.exists(places, lambda at: _share(at, t, F.size(t["shingles"]) + 2) >= SHARE))
    return F.when(F.size(places) > 0, F.transform(good, lambda t: t["name"])).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Per row: doc_id, n_licenses, licenses (names in order, comma-joined).

    A null or short text has none; repeated rows stay; other columns aren't read. A template of fewer than
    five words can't be told from chance and is an error, as are more than ``MOST_TEMPLATES``.
    """
    templates = TEMPLATES if templates is None else templates
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"{len(templates)} templates; the plan takes {MOST_TEMPLATES}")
    index = _index(docs.sparkSession, templates) if templates else []
    if short := [e.name for e in index if not e.hashes]:
        raise ValueError(f"under {SHINGLE} words: {short}")
    single, long = [e for e in index if len(e.hashes) < WINDOW], [e for e in index if len(e.hashes) >= WINDOW]
    rows = _with_shingles(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text")
    none = F.array().cast("array<int>")
    met = F.transform("_hashes", lambda x, i: F.when(x.isin(sorted({h for e in single for h in e.hashes})), i)) if single else none
    columns = {"_single": F.array_compact(met), "_long": none}
    if long:
        # Bands of half windows first; a window's band is the lesser of its two halves'.
        halves = F.when(F.size("_hashes") > 0, F.sequence(F.lit(0), F.floor((F.size("_hashes") - 1) / STEP).cast("int"))).otherwise(none)
        rows = rows.withColumn("_halves", halves)
        rows = rows.withColumns({f"_b{k}": F.transform("_halves", _half(m)) for k, m in enumerate(_masks())})
        wanted = [sorted({v for e in long for v in e.bands[k]}) for k in range(BANDS)]

        def meets(b: Column) -> Column:
            bands = [F.least(F.get(f"_b{k}", b), F.get(f"_b{k}", b + 1)).isin(wanted[k]) for k in range(BANDS)]
            return reduce(or_, bands)

        columns["_long"] = F.transform(F.filter("_halves", meets), lambda b: b * STEP)
    rows = rows.withColumns(columns)
    found = F.array_sort(F.concat(_verified(single, F.col("_single")), _verified(long, F.col("_long"))))
    rows = rows.select("doc_id", found.alias("_found"))
    return rows.select("doc_id", F.size("_found").cast("long").alias("n_licenses"), F.array_join("_found", ",").alias("licenses"))
