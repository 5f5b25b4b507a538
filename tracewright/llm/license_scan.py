"""Licences of files: sparse TF-IDF cosine to templates, then inheritance by directory.

Units are the lines of a file (headers may stand anywhere in it) and the file as a
whole. Words are runs of letters and digits with A-Z lower-cased; a word weighs
its count times idf = ln((N + 1) / (df + 1)) + 1, df being the files that hold it.
df is counted for the words of the templates; any other word counts as df 0, which
only adds to the length of a unit. A unit without any of a template's heavier words
cannot reach the threshold, so only units with one of them are compared.

A file's own licence is that of its best line with a cosine of ``LINE_COSINE`` or
more. A file is a licence file, and speaks for its directory, if its whole text
reaches ``FILE_COSINE`` or if it has a licence file's name and a licence of its
own. A file without an own licence takes that of the nearest directory above it,
its own first.

Defined results: null and empty texts have no licence of their own; null paths
inherit nothing; of equal cosines the first template by name and the first line
wins; of licence files in one directory the best, then the one with the least path;
rows that share an id are one file with the licence of its best line.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .url_filter import LOWER, UPPER

LINE_COSINE, FILE_COSINE = 0.7, 0.5
WORDS = r"[^\p{L}\p{N}]+"
FILE_NAMES = r"(?i)/(licen[sc]e|copying|notice)([.][^/]*)?$"

# The templates.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
}


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), WORDS), "")


def template_words(templates: dict[str, str]) -> dict[str, Counter]:
    """Words of each template; templates are ASCII."""
    split = {n: "".join(c if c.isalnum() else " " for c in t.lower()).split() for n, t in templates.items()}
    return {n: Counter(w) for n, w in split.items()}


def weights(counts: dict[str, Counter], idf: dict[str, float]) -> dict[str, dict[str, float]]:
    """Unit vectors of the templates."""
    out = {}
    for name, found in counts.items():
        raw = {w: c * idf[w] for w, c in found.items()}
        size = math.sqrt(sum(v * v for v in raw.values()))
        out[name] = {w: v / size for w, v in raw.items()}
    return out


def needed_words(vectors: dict[str, dict[str, float]], cosine: float) -> list[str]:
    """Words of which a unit must hold one to reach the cosine with any template."""
    needed = set()
    for vector in vectors.values():
        light = 0.0
        for word, weight in sorted(vector.items(), key=lambda x: (x[1], x[0])):
            light += weight * weight
            if light >= cosine * cosine * 0.999:
                needed.add(word)
    return sorted(needed)


def scanned(
    files: DataFrame,
    id_col: str = "file_id",
    path_col: str = "path",
    text_col: str = "text",
    templates: dict[str, str] = TEMPLATES,
) -> DataFrame:
    """id, path, license, cosine (own licences only), origin (header, directory or null), from_dir."""
    spark = files.sparkSession
    rows = files.select(
        F.col(id_col).alias("id"), F.col(path_col).alias("path"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = template_words(templates)
    known = sorted({w for c in counts.values() for w in c})
    # One row comes back: the files, and for each word of the templates those that hold it.
    held = rows.select(F.array_intersect(words(F.col("text")), F.array(*map(F.lit, known))).alias("held"))
    total, *df = held.agg(
        F.count("*"), *[F.count_if(F.array_contains("held", w)) for w in known]).first()
    idf = {w: math.log((total + 1) / (n + 1)) + 1 for w, n in zip(known, df)}
    other = math.log(total + 1) + 1
    vectors = weights(counts, idf)

    def compared(units: DataFrame, kind: str, cosine: float) -> DataFrame:
        needed = F.array(*map(F.lit, needed_words(vectors, cosine)))
        found = units.withColumn("words", words(F.col("unit"))).where(F.arrays_overlap("words", needed))
        return found.select("id", "path", F.lit(kind).alias("kind"), "place", "words")

    lines = rows.select("id", "path", F.posexplode(F.split("text", "\n")).alias("place", "unit"))
    whole = rows.select("id", "path", F.lit(-1).alias("place"), F.col("text").alias("unit"))
    lines, whole = compared(lines, "line", LINE_COSINE), compared(whole, "file", FILE_COSINE)
    every = lines.unionByName(whole)
    unit = ["id", "path", "kind", "place"]
    tf = every.select(*unit, F.explode("words").alias("word")).groupBy(*unit, "word").agg(F.count("*").alias("tf"))
    table = spark.createDataFrame(
        [(w, idf[w], [vectors[n].get(w, 0.0) for n in sorted(vectors)]) for w in known],
        "word string, idf double, parts array<double>")
    weighed = tf.join(table, "word", "left").withColumn("weight", F.col("tf") * F.coalesce("idf", F.lit(other)))
    # parts: the word's weight in each template, in the order of their names.
    dots = [
        F.sum(F.coalesce(F.col("weight") * F.col("parts")[i], F.lit(0.0))).alias(f"dot_{i}")
        for i in range(len(templates))
    ]
    sums = weighed.groupBy(*unit).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("size"), *dots)
    cosines = F.array(*[
        F.struct(F.round(F.col(f"dot_{i}") / F.col("size"), 6).alias("cosine"), F.lit(-i).alias("rank"), F.lit(n).alias("name"))
        for i, n in enumerate(sorted(templates))
    ])
    best = sums.select(*unit, F.array_max(cosines).alias("best"))
    limit = F.when(F.col("kind") == "line", LINE_COSINE).otherwise(FILE_COSINE)
    best = best.where(F.col("best.cosine") >= limit)

    own = best.where("kind = 'line'").groupBy("id").agg(
        F.max(F.struct("best.cosine", "best.rank", (-F.col("place")).alias("place"), "best.name")).alias("own"))
    # Licence files, by their text or by their name.
    by_text = best.where("kind = 'file'").select("path", "best.cosine", "best.rank", "best.name")
    by_name = best.where("kind = 'line'").where(F.rlike("path", F.lit(FILE_NAMES))).select(
        "path", "best.cosine", "best.rank", "best.name")
    speakers = by_text.unionByName(by_name).where("path is not null")
    folders = speakers.groupBy(folder(F.col("path")).alias("dir")).agg(
        F.max_by("name", F.struct("cosine", "rank")).alias("license"))
    dirs = rows.where("path is not null").select(folder(F.col("path")).alias("at")).distinct()
    above = dirs.withColumn("dir", F.explode(ancestors(F.col("at"))))
    nearest = above.join(folders, "dir").groupBy("at").agg(
        F.max_by(F.struct("license", "dir"), F.length("dir")).alias("near"))
    joined = rows.select("id", "path", folder(F.col("path")).alias("at")).join(own, "id", "left").join(
        nearest, "at", "left")
    has = F.col("own").isNotNull()
    return joined.select(
        F.col("id").alias(id_col),
        "path",
        F.coalesce("own.name", "near.license").alias("license"),
        F.col("own.cosine").alias("cosine"),
        F.when(has, "header").when(F.col("near").isNotNull(), "directory").alias("origin"),
        F.when(~has, F.col("near.dir")).alias("from_dir"),
    )


def folder(path: Column) -> Column:
    """The directory of a path; empty at the top."""
    return F.regexp_replace(path, "/[^/]*$", "")


def ancestors(directory: Column) -> Column:
    """The directory and all above it, down to the empty one."""
    parts = F.split(directory, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan_sql(files: str, templates: dict[str, str] = TEMPLATES) -> str:
    """DuckDB SQL of ``scanned`` for a relation files(id, path, text)."""
    counts = template_words(templates)
    rows = ", ".join(f"('{n}', '{w}', {c})" for n in sorted(counts) for w, c in sorted(counts[n].items()))
    split = (
        f"list_filter(regexp_split_to_array(translate(unit, '{UPPER}', '{LOWER}'), '{WORDS}'), lambda x: x <> '')")
    names = ", ".join(f"('{n}', {-i})" for i, n in enumerate(sorted(templates)))
    return f"""
    WITH files AS (SELECT id, path, coalesce(text, '') AS text FROM ({files})),
    template(name, word, tf) AS (VALUES {rows}),
    ranks(name, rank) AS (VALUES {names}),
    units AS (
        SELECT id, path, 'file' AS kind, -1 AS place, text AS unit FROM files UNION ALL
        SELECT id, path, 'line', unnest(range(len(string_split(text, chr(10))))) AS place,
            unnest(string_split(text, chr(10))) FROM files),
    split AS (SELECT id, path, kind, place, {split} AS words FROM units),
    total AS (SELECT count(*) AS n FROM files),
    seen AS (
        SELECT word, count(*) AS df FROM (
            SELECT unnest(list_distinct(words)) AS word FROM split WHERE kind = 'file')
        WHERE word IN (SELECT word FROM template) GROUP BY word),
    vocabulary AS (
        SELECT word, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 AS idf
        FROM (SELECT DISTINCT word FROM template) LEFT JOIN seen USING (word), total),
    vector AS (
        SELECT name, word, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY name)) AS weight
        FROM template JOIN vocabulary USING (word)),
    tf AS (
        SELECT id, path, kind, place, word, count(*) AS tf
        FROM (SELECT id, path, kind, place, unnest(words) AS word FROM split
              WHERE list_has_any(words, (SELECT list(word) FROM vocabulary))) GROUP BY ALL),
    weighed AS (
        SELECT tf.*, tf * coalesce(idf, ln(n + 1) + 1) AS weight
        FROM tf LEFT JOIN vocabulary USING (word), total),
    sizes AS (
        SELECT id, path, kind, place, sqrt(sum(weight * weight)) AS size FROM weighed GROUP BY ALL),
    dots AS (
        SELECT id, path, kind, place, name, sum(w.weight * v.weight) AS dot
        FROM weighed w JOIN vector v USING (word) GROUP BY ALL),
    best AS (
        SELECT d.id, d.path, d.kind, d.place,
            max({{'cosine': round(dot / size, 6), 'rank': rank, 'name': name}}) AS best
        FROM dots d JOIN ranks USING (name) JOIN sizes s
            ON d.id IS NOT DISTINCT FROM s.id AND d.path IS NOT DISTINCT FROM s.path
            AND d.kind = s.kind AND d.place = s.place
        GROUP BY ALL),
    good AS (
        SELECT *, best.cosine AS cosine, best.rank AS rank, best.name AS name FROM best
        WHERE best.cosine >= CASE WHEN kind = 'line' THEN {LINE_COSINE} ELSE {FILE_COSINE} END),
    own AS (
        SELECT id, max({{'cosine': cosine, 'rank': rank, 'place': -place, 'name': name}}) AS own
        FROM good WHERE kind = 'line' AND id IS NOT NULL GROUP BY id),
    folders AS (
        SELECT regexp_replace(path, '/[^/]*$', '') AS dir,
            max({{'cosine': cosine, 'rank': rank, 'name': name}}).name AS license
        FROM good WHERE path IS NOT NULL
            AND (kind = 'file' OR regexp_matches(path, '{FILE_NAMES}')) GROUP BY 1),
    dirs AS (SELECT DISTINCT regexp_replace(path, '/[^/]*$', '') AS spot FROM files WHERE path IS NOT NULL),
    nearest AS (
        SELECT spot, max_by({{'license': license, 'dir': dir}}, length(dir)) AS near
        FROM dirs JOIN folders ON spot = dir OR starts_with(spot, dir || '/') GROUP BY spot)
    SELECT f.id, f.path, coalesce(own.name, near.license) AS license, own.cosine AS cosine,
        CASE WHEN own IS NOT NULL THEN 'header' WHEN near IS NOT NULL THEN 'directory' END AS origin,
        CASE WHEN own IS NULL THEN near.dir END AS from_dir
    FROM files f LEFT JOIN own USING (id) LEFT JOIN nearest n
        ON n.spot = regexp_replace(f.path, '/[^/]*$', '')"""
