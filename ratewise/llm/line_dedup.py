"""Line deduplication by overlapping three-line windows.

Every run of three consecutive lines (as they stand, split at \\n) is hashed to 128 bits. A window whose
hash occurs anywhere before, by (doc_id, position), is a repeat; the lines that repeats cover are merged
into runs and removed. The first occurrence of a window stays unless other repeats cover its lines.

Defined results: a null text has no lines and stays null; a text of fewer than three lines has no window;
windows of nothing but white space are not compared; rows of equal doc_id go by a hash of their text,
and rows that agree in both are one document and are cleaned alike; a null doc_id comes first; an empty
table gives no rows; other columns stay, except that n_lines and n_removed are set. A text whose lines
all go becomes the empty string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, mark, at): the windows that occur before; mark is the hash of the text.

    Counting combines on the map side, so a window in a third of all documents sends one row a task;
    the join back to its occurrences is one that Spark splits where rows are many."""
    d = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.split("text", "\n").alias("l")).where(F.size("l") >= window)
    at = F.sequence(F.lit(0), F.size("l") - window)
    d = d.select("doc_id", "mark", F.posexplode(F.transform(at, lambda i: F.concat_ws(
        "\n", *[F.get("l", i + j) for j in range(window)]))).alias("at", "w")).where(F.col("w").rlike(r"[^\x20\x09-\x0D]"))
    d = d.select("doc_id", "mark", "at", F.unhex(F.md5("w")).alias("hash"))
    place = F.struct("doc_id", "mark", "at")
    first = d.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
    return d.join(first.select("hash", "first"), "hash").where(place > F.col("first")).select("doc_id", "mark", "at")


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with its text cleaned, ``n_lines`` (before) and ``n_removed``."""
    found = repeated_windows(docs, window).groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("at")).alias("a"))
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    d = docs.select(F.struct(*kept).alias("d"), F.xxhash64("text").alias("m"))  # the input's columns keep to themselves
    d = d.join(found, F.col("d")["doc_id"].eqNullSafe(F.col("doc_id")) & (F.col("m") == F.col("mark")), "left")
    a, none = F.col("a"), F.array().cast("array<int>")
    starts = F.filter(a, lambda x, i: (i == 0) | (x - F.get(a, i - 1) > window))
    ends = F.transform(F.filter(a, lambda x, i: (i == F.size(a) - 1) | (F.get(a, i + 1) - x > window)), lambda x: x + window)
    d = d.select("d", F.split(F.col("d")["text"], "\n").alias("l"), F.coalesce(starts, none).alias("s"), F.coalesce(ends, none).alias("e"))
    gaps = F.arrays_zip(F.concat(F.array(F.lit(0)), F.col("e")).alias("a"), F.concat(F.col("s"), F.array(F.size("l"))).alias("b"))
    pieces = F.flatten(F.transform(gaps, lambda g: F.slice("l", g["a"] + 1, g["b"] - g["a"])))
    removed = F.aggregate(F.arrays_zip(F.col("s").alias("s"), F.col("e").alias("e")), F.lit(0), lambda n, r: n + r["e"] - r["s"])
    text = F.when(F.size("s") == 0, F.col("d")["text"]).otherwise(F.array_join(pieces, "\n"))
    return d.select(*[text.alias(c) if c == "text" else F.col("d")[c].alias(c) for c in kept],
                    F.greatest(F.size("l"), F.lit(0)).cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT doc_id, i, array_to_string(l[i + 1 : i + 3], chr(10)) AS w
  FROM (SELECT doc_id, l, unnest(range(0, len(l) - 2)) AS i FROM l)
), first AS (
  SELECT w, min((doc_id, i)) AS f FROM w WHERE regexp_matches(w, '[^\x20\x09-\x0D]') GROUP BY w HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS p FROM w JOIN first USING (w) WHERE (doc_id, i) > f
), lines AS (
  SELECT doc_id, unnest(range(0, len(l))) AS p, unnest(l) AS line FROM l
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY p) FILTER (WHERE g.p IS NULL) AS text, count(*) AS n_lines, count(g.p) AS n_removed
  FROM lines LEFT JOIN gone g USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
