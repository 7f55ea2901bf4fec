"""Document fingerprints: threshold-scaled sketches, with DataFrame functions only.

A sketch keeps every hash of a five-word shingle that lies below a fixed fraction of the hash
range. Sketches of parts merge by union, and the share of one sketch found in another estimates
containment however unequal the documents are. A text whose shingles all miss the fraction keeps
its smallest hash, so that only a text without words has an empty sketch; merging drops such a
hash again as soon as another part has one below the fraction, so the sketch of parts is that of
the set of all their shingles.

Words are runs other than ASCII white space, with A-Z in lower case; fewer than five words make one
shingle. A shingle's hash is the first 64 bits of its MD5, as 16 hexadecimal digits, which are in
the order of the numbers. Likeness is the shared part of the smaller sketch (1 if both are empty,
0 if one is).

Defined results: a null text is empty; rows without doc_id are left out; of rows with equal doc_id
the smallest text counts; a single document is its own next document; an empty table gives an
empty table; a text is one row however long it is, and so are its shingles' hashes; columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed_docs, one_per_id, spread, written

FRACTION, WIDTH = 1 / 8, 5
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def edge(fraction: float) -> str:
    """Hashes less than this are the fraction of the hash range."""
    return f"{int(2**64 * fraction):016x}"


def kept_hashes(hashes: Column, fraction: float) -> Column:
    """Of distinct hashes those below the fraction, sorted; the smallest of all if there are none."""
    below = F.filter(hashes, lambda h: h < F.lit(edge(fraction)))
    return F.when(F.size(below) > 0, F.array_sort(below)).when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(hashes)


def sketch(text: Column, fraction: float = FRACTION, width: int = WIDTH) -> Column:
    """array<string>: the kept hashes, sorted and distinct."""
    none = F.array().cast("array<string>")

    def of_words(words: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(1)))
        shingle = lambda i: F.substring(F.md5(F.concat_ws(" ", *(F.get(words, i - 1 + k) for k in range(width)))), 1, 16)
        return F.when(F.size(words) > 0, F.array_distinct(F.transform(places, shingle))).otherwise(none)

    # each stage is bound once by a lambda over a one-element array
    words = F.array(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0)))
    return F.get(F.transform(F.transform(words, of_words), lambda h: kept_hashes(h, fraction)), F.lit(0))


def shown(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def packed_hashes(hashes: Column) -> Column:
    """A sketch as 8 bytes per hash, for the way between tasks."""
    return F.unhex(shown(hashes))


def unpacked_hashes(data: Column) -> Column:
    places = F.sequence(F.lit(0), F.floor(F.octet_length(data) / 8).cast("int") - 1)
    return F.when(F.octet_length(data) > 0, F.transform(places, lambda i: F.lower(F.hex(F.substring(data, i * 8 + 1, 8))))).otherwise(F.array().cast("array<string>"))


def likeness(a: Column, b: Column) -> Column:
    smaller = F.least(F.size(a), F.size(b))
    return F.when(smaller > 0, F.size(F.array_intersect(a, b)) / smaller).when(F.size(a) == F.size(b), F.lit(1.0)).otherwise(F.lit(0.0))


def merged(sketches: Column, fraction: float = FRACTION) -> Column:
    """The sketch of several parts together, from an array of their sketches."""
    return kept_hashes(F.array_distinct(F.flatten(sketches)), fraction)


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id, half): the next smaller doc_id, after the smallest the largest.

    Ids are range-partitioned and read again, so that no partition needs more than its own rows
    and the first id of the partition after it; only a row per partition meets in one task.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(ids.repartitionByRange(parts, F.desc("doc_id")).withColumn("part", F.spark_partition_id()), "ids")
    ends = placed.groupBy("part").agg(F.max("doc_id").alias("top"))
    after = Window.orderBy("part")
    whole = after.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lead("top").over(after), F.max("top").over(whole)).alias("wrap"))
    inner = placed.withColumn("next_id", F.lead("doc_id").over(Window.partitionBy("part").orderBy(F.desc("doc_id"))))
    return inner.join(ends, "part").select("doc_id", F.coalesce("next_id", "wrap").alias("next_id"), "half")


def fingerprints(documents: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    docs = one_per_id(keyed_docs(documents))
    links = next_ids(docs.select("doc_id", F.floor(F.length("text") / 2).cast("int").alias("half")))
    # one exchange by doc_id carries texts and sketches, and serves both sides
    own = spread(docs).withColumn("sketch", packed_hashes(sketch(F.col("text"), fraction)))
    # a next document sends the part it is asked for, and its sketch
    asked = links.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("to"), "half")
    sent = own.join(asked.hint("merge"), "doc_id").select("to", "half", F.expr("substring(text, 1, half)").alias("head"), F.col("sketch").alias("next_sketch"))
    met = own.join(sent.hint("merge"), F.col("doc_id") == F.col("to"))
    edited = met.withColumn("edited", F.concat(F.expr("substring(text, 1, length(text) - half)"), F.col("head")))
    done = edited.withColumn("edited_sketch", sketch(F.col("edited"), fraction))
    return done.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.lower(F.hex("sketch")).alias("fingerprint"), shown(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(unpacked_hashes(F.col("sketch")), F.col("edited_sketch")).alias("near_edited"), likeness(unpacked_hashes(F.col("sketch")), unpacked_hashes(F.col("next_sketch"))).alias("near_next"),
    )


#: DuckDB: the same shingles, hashes and intersections as lists.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS u FROM documents WINDOW w AS (ORDER BY doc_id DESC)),
e AS (SELECT doc_id, t, t[1:length(t) - length(t) // 2] || u[1:length(t) // 2] AS x FROM d),
w AS (
  SELECT doc_id, part, regexp_extract_all(translate(v, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, 'own' AS part, t AS v FROM e UNION ALL SELECT doc_id, 'edited', x FROM e)
), h AS (SELECT doc_id, part, list_distinct(CASE WHEN len(w) = 0 THEN [] ELSE [md5(array_to_string(w[i:i + 4], ' '))[1:16] FOR i IN range(1, greatest(len(w) - 4, 1) + 1)] END) AS h FROM w),
b AS (SELECT doc_id, part, h, list_sort(list_filter(h, lambda y: y < '2000000000000000')) AS b FROM h),
k AS (SELECT doc_id, part, CASE WHEN len(b) > 0 THEN b WHEN len(h) > 0 THEN [list_min(h)] ELSE [] END AS s FROM b),
o AS (SELECT doc_id, s AS own, coalesce(lead(s) OVER w, first_value(s) OVER w) AS after FROM k WHERE part = 'own' WINDOW w AS (ORDER BY doc_id DESC)),
m AS (SELECT o.doc_id, own, after, s AS edited FROM o JOIN k ON o.doc_id = k.doc_id AND part = 'edited')
SELECT m.doc_id, length(t) AS n_chars, sha256(x) AS edited_sha256, array_to_string(own, '') AS fingerprint, array_to_string(edited, '') AS edited_fingerprint,
  CASE WHEN least(len(own), len(edited)) > 0 THEN len(list_intersect(own, edited)) / least(len(own), len(edited)) ELSE (len(own) = len(edited))::INT::DOUBLE END AS near_edited,
  CASE WHEN least(len(own), len(after)) > 0 THEN len(list_intersect(own, after)) / least(len(own), len(after)) ELSE (len(own) = len(after))::INT::DOUBLE END AS near_next
FROM m JOIN e USING (doc_id)
"""
