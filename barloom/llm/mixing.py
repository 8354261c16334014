"""Mixing sources to target weights by systematic sampling.

Within a source every row has the same expected number of copies, its target over
its size. Rows stand in order of size, so equal steps through the running sum
take short and long texts in proportion. A random offset of the source is added
to the running sum, and a row is emitted once for each whole number its stretch
of the sum crosses.

The running sum is two-level: rows are numbered inside small parts of a source
(a class of sizes, split by a hash of the id), parts are summed up in a table of
one row each. No source is one task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import inner, settled

CAP = 3
#: Size classes per doubling, and parts of a class.
FINE = 8
SALTS = 256
#: The offset is a multiple of this, so adding it to a whole number is exact.
GRAIN = 1 << 20


def size(text: Column) -> Column:
    """Number of words, runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _named(key: Column) -> Column:
    """A key as text that is never null and keeps null apart from all others."""
    return F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit(""))


def _digits(key: Column, first: int, n: int) -> Column:
    """A number from hexadecimal digits of a key's md5; a null key has a digest of its own."""
    digest = F.md5(_named(key))
    return F.conv(F.substring(digest, first, n), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources in order of code points, null last, weigh 1, 2, 3, repeating. A target
    ends at CAP times its source's size, and the excess goes to the others by
    weight until none is above: all targets are the smaller of the cap and the
    weight times one level. Caps are met in order of cap over weight.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weighed = sizes.withColumn("w", (F.row_number().over(order) - 1) % 3 + 1)
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    capped = (
        weighed.withColumn("cap", CAP * F.col("source_size"))
        .withColumn("whole", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("w").over(everything))
        .withColumn("left", F.col("whole") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("open", F.col("weights") - F.coalesce(F.sum("w").over(before), F.lit(0)))
        # Capped as long as the level of those still open is above the own cap.
        .withColumn("capped", F.col("left") * F.col("w") > F.col("cap") * F.col("open"))
    )
    free = F.when(~F.col("capped"), F.struct("left", "open"))
    level = F.first(free, ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        (F.col("level.left") * F.col("w")).cast("double") / F.col("level.open")
    )
    return capped.withColumn("level", level).select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame) -> DataFrame:
    """docs with size, source_size, target and copies added; all rows stay, those left out with 0 copies.

    docs has doc_id, text and source. A null source is a source. Null and empty
    texts have size 0; they are numbered like others and take no words. Rows
    that repeat are rows of their own, in any order among themselves. The result
    depends on ids, sources and sizes alone, not on the order or partitions of the
    input. Existing columns of the added names are replaced.
    """
    names = ["size", "source_size", "target", "copies"]
    docs = docs.select(*[c for c in docs.columns if c not in names])
    words, salt, key, step, at, first = (inner(docs, f"_{n}") for n in ("size", "salt", "key", "class", "at", "first"))
    sized = docs.select(
        *docs.columns,
        size(F.col("text")).alias(words),
        _digits(F.col("doc_id"), 1, 2).alias(salt),
        _named(F.col("source")).alias(key),
    ).withColumn(step, F.floor(F.log2(F.col(words) + F.lit(1.0)) * FINE + 1e-9).cast("int"))
    part = [key, step, salt]
    sums = [F.count("*").alias("n"), F.sum(words).alias("words"), F.first("source").alias("source")]
    parts = settled(sized.groupBy(*part).agg(*sums))
    aims = targets(parts.groupBy("source").agg(F.sum("words").cast("long").alias("source_size")))
    running = Window.partitionBy(key).orderBy(step, salt).rowsBetween(Window.unboundedPreceding, -1)
    begun = parts.withColumn(first, F.coalesce(F.sum("n").over(running), F.lit(0)))
    named = aims.select(_named(F.col("source")).alias(key), "source_size", "target")
    starts = settled(begun.join(named, key).select(*part, first, "source_size", "target"))
    own = Window.partitionBy(*part).orderBy(words, "doc_id")
    joined = sized.withColumn(at, F.row_number().over(own)).join(starts, part)
    place = F.col(first) + F.col(at)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = _digits(F.col("source"), 1, 5) / F.lit(float(GRAIN))
    crossed = F.floor(place * rate + offset) - F.floor((place - 1) * rate + offset)
    return joined.select(
        *docs.columns,
        F.col(words).alias("size"),
        "source_size",
        "target",
        crossed.cast("long").alias("copies"),
    )


def emitted(docs: DataFrame) -> DataFrame:
    """The rows of docs as often as the mix takes them."""
    taken = mix(docs).where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select(*docs.columns)


#: The whole mix in SQL, with the same digests, order and arithmetic.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5(coalesce('k' || CAST(doc_id AS VARCHAR), '')), 1, 2) AS BIGINT) AS salt
  FROM documents
), classed AS (
  SELECT *, CAST(floor(log2(size + 1.0) * 8 + 1e-9) AS INT) AS class FROM sized
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, salt, size, doc_id) AS place FROM classed
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS cap FROM sizes
), capped AS (
  SELECT *, (SELECT sum(source_size) FROM sizes) - coalesce(sum(cap) OVER before, 0) AS remaining,
         (SELECT sum(w) FROM weighed) - coalesce(sum(w) OVER before, 0) AS open
  FROM weighed
  WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT remaining, open FROM capped WHERE remaining * w <= cap * open ORDER BY cap / w, source NULLS LAST LIMIT 1
), aims AS (
  SELECT source, source_size,
         CASE WHEN c.remaining * w > cap * c.open THEN CAST(cap AS DOUBLE)
              ELSE CAST((SELECT remaining FROM level) * w AS DOUBLE) / CAST((SELECT open FROM level) AS DOUBLE) END AS target
  FROM capped c
), rated AS (
  SELECT doc_id, size, a.source_size, a.target, place,
         CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0.0 END AS rate,
         CAST('0x' || substr(md5(coalesce('k' || n.source, '')), 1, 5) AS BIGINT) / 1048576.0 AS start
  FROM numbered n JOIN aims a ON n.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       size * CAST(floor(place * rate + start) - floor((place - 1) * rate + start) AS BIGINT) AS taken
FROM rated
"""
