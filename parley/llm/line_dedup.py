"""Line dedup: lines seen in several documents stay in the first of them only.

Lines are exploded, normalised and hashed; distinct documents are counted per hash (partial sums before the
shuffle, so a line that a third of all rows share is one row a task); positions to drop go back to their
document, which is put together again by position. Only hashes and positions travel to find the lines; texts move
once, for the reassembly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, Workspace, ascii_lower, hash128, table

MIN_POINTS = 10
LAST = (1 << 63) - 1


def line_key(line):
    """Stripped of `[\\x20\\x09-\\x0D]` at both ends, A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(WHITE)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_points: int = MIN_POINTS) -> DataFrame:
    """All columns of `docs` in a struct `row`, with `n_lines`, `n_dropped` and the new text in `kept`.

    A null or empty text is one empty line. A null id is one document that comes after all others. Rows that repeat
    an id count as one document: none of them loses a line to the other. Lines below `min_points` code points stay.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "lines")
    rows = docs.select(F.struct("*").alias("row")).select(
        "row",
        F.coalesce(F.col(f"row.{id_col}").cast("long"), F.lit(LAST)).alias("doc"),
        F.coalesce(F.col(f"row.{text_col}"), F.lit("")).alias("txt"),
    )
    named = [h.alias(f"r{i}") for i, h in enumerate(hash128(F.col("doc"), F.col("txt")))]
    lines = rows.select("doc", *named, F.posexplode(F.split("txt", "\n", -1)).alias("pos", "line"))
    keys = lines.select("doc", "r0", "r1", "pos", line_key(F.col("line")).alias("key"))
    keys = keys.filter(F.char_length("key") >= min_points).select("doc", "r0", "r1", "pos", *hash128(F.col("key")))
    seen = keys.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    # written, so that the join below has an exchange on either side that AQE can split at a hot line
    seen = work.write(seen.filter("first < last").drop("last"), "recurring")
    drops = keys.join(seen, ["h1", "h2"]).filter("doc > first")
    drops = drops.groupBy("r0", "r1").agg(F.collect_set("pos").alias("gone"))
    drops = work.write(drops, "drops").withColumnsRenamed({"r0": "d0", "r1": "d1"})
    rows = rows.select("row", "txt", *named)
    found = rows.join(drops, (F.col("r0") == F.col("d0")) & (F.col("r1") == F.col("d1")), "left")
    parts = found.select("row", "txt", "gone", F.split("txt", "\n", -1).alias("parts"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("txt")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col("parts"), i)), "\n")
    )
    n_dropped = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone"))
    return parts.select("row", F.size("parts").cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"), kept.alias("kept"))


def op7_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
seen AS (
  SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT a.doc_id, a.pos, a.line, coalesce(a.doc_id > s.first_doc, false) AS gone
  FROM keyed a LEFT JOIN seen s ON a.k = s.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
