"""Document fingerprints by winnowing, in DataFrame functions only.

Words (runs without white space, lower-cased, longer ones cut every ``WORD_CHARS``
characters) are hashed, and every ``K`` neighbouring ones are combined by a cyclic
polynomial (rotate and exclusive-or), evaluated by doubling: pairs, fours, then fives.
A text of fewer words has one gram of all its words. In each window of ``WINDOW``
grams the least hash is chosen, the rightmost of equal ones, again by doubling (windows
of two, four, eight); the choices, each with its position, are the fingerprint. Hence two texts that share
``WINDOW + K - 1`` words in a row share a fingerprint entry, at known positions.

A chosen gram is one number: 37 bits of hash above 26 bits of reversed position, so that
the least number is the least hash and, among equal ones, the rightmost. A text may
have 67 million words at most; a row of more does not fit Spark's row format anyway.

The edited text needs the next document. doc_id is cut into buckets at approximate
quantiles, documents are dealt by bucket once, and the first document of each bucket is
copied to the bucket before it, so ``lead`` finds every neighbour inside a bucket. The
buckets are as even as the quantiles, whatever the ids.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortwatch.llm.common import table

K = 5
WINDOW = 8
WORD_CHARS = 32
POSITION_BITS, HASH_BITS = 26, 37
POSITIONS = (1 << POSITION_BITS) - 1
# Buckets a shuffle partition, to even out their sizes.
BUCKETS_A_PARTITION = 4
LAST_ID = (1 << 63) - 1


def _rotate(x: F.Column, bits: int) -> F.Column:
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits))


def _from(array: F.Column, start: int) -> F.Column:
    """``array`` from a 1-based place on, empty beyond its end."""
    return F.slice(array, F.lit(start), F.greatest(F.size(array) - (start - 1), F.lit(0)))


def _let(value: F.Column, body) -> F.Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pairs(array: F.Column, shift: int, combine) -> F.Column:
    """Neighbours at a distance, combined; the last ``shift`` have no partner (null)."""
    return _let(array, lambda a: F.zip_with(a, _from(a, shift + 1), combine))


def words(text: F.Column) -> F.Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[^\x20\x09-\x0D]{1,%d}" % WORD_CHARS), F.lit(0))


def grams(text: F.Column) -> F.Column:
    """Hash of every K neighbouring words; one of all words if they are fewer; none without words."""
    def of(h: F.Column) -> F.Column:
        twos = _pairs(h, 1, lambda a, b: _rotate(a, 1).bitwiseXOR(b))
        fours = _pairs(twos, 2, lambda a, b: _rotate(a, 2).bitwiseXOR(b))
        fives = _let(fours, lambda f: F.zip_with(f, _from(h, 5), lambda a, b: _rotate(a, 1).bitwiseXOR(b)))
        return (F.when(F.size(h) >= K, F.slice(fives, F.lit(1), F.size(h) - (K - 1)))
                .when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>")))

    return _let(F.transform(words(text), lambda w: F.xxhash64(w)), of)


def chosen(text: F.Column) -> F.Column:
    """The fingerprint as numbers of hash and reversed position, in order of position."""
    mask = (1 << HASH_BITS) - 1

    def of(g: F.Column) -> F.Column:
        least = g
        for shift in (1, 2, 4):
            least = _pairs(least, shift, lambda a, b: F.least(a, b))
        return F.array_distinct(F.slice(least, F.lit(1), F.greatest(F.size(g) - (WINDOW - 1), F.lit(1))))

    numbered = F.transform(grams(text), lambda g, i: F.shiftleft(g.bitwiseAND(F.lit(mask)), POSITION_BITS).bitwiseOR(F.lit(POSITIONS) - i.cast("long")))
    return _let(numbered, of)


def hashes(fingerprint: F.Column) -> F.Column:
    return F.array_distinct(F.transform(fingerprint, lambda v: F.shiftright(v, POSITION_BITS)))


def shown(fingerprint: F.Column) -> F.Column:
    """``hash@position`` of each entry, hash in hex, position in grams from 0."""
    entry = F.transform(fingerprint, lambda v: F.concat(
        F.hex(F.shiftright(v, POSITION_BITS)), F.lit("@"), (F.lit(POSITIONS) - v.bitwiseAND(F.lit(POSITIONS))).cast("string")))
    return F.array_join(entry, " ")


def likeness(a: F.Column, b: F.Column) -> F.Column:
    """Jaccard likeness of two sets of hashes; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / F.greatest(either, F.lit(1)))


def with_next(docs: DataFrame, n_buckets: int) -> DataFrame:
    """(doc_id, text, bucket, copy) with the first row of each bucket copied behind the bucket before it.

    Rows are ordered by doc_id (null last), then text; after the last comes the first.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(LAST_ID))).withColumn("place", F.col("key").cast("double"))
    cuts = rows.agg(F.percentile_approx("place", [i / n_buckets for i in range(1, n_buckets)], 100 * n_buckets).alias("c")).first()["c"] if n_buckets > 1 else []
    splits = [float("-inf"), *sorted(set(cuts or [])), float("inf")]
    placed = Bucketizer(splits=splits, inputCol="place", outputCol="bucket").transform(rows).withColumn("bucket", F.col("bucket").cast("int")) \
        if len(splits) > 2 else rows.withColumn("bucket", F.lit(0))
    # one row a bucket: its first key, and the bucket before it
    firsts = sorted((r["bucket"], r["first"]) for r in placed.groupBy("bucket").agg(F.min("key").alias("first")).collect())
    if not firsts:
        return placed.select("doc_id", "text", "bucket", "key", F.lit(False).alias("copy"))
    before = [(b, first, firsts[i - 1][0]) for i, (b, first) in enumerate(firsts)]
    edges = docs.sparkSession.createDataFrame(before, "bucket int, first long, before int")
    met = placed.join(F.broadcast(edges), "bucket")
    own = F.struct(F.col("bucket"), F.lit(False).alias("copy"))
    places = F.when(F.col("key") == F.col("first"), F.array(own, F.struct(F.col("before").alias("bucket"), F.lit(True).alias("copy")))).otherwise(F.array(own))
    return met.select("doc_id", "text", "key", F.explode(places).alias("at")).select("doc_id", "text", "key", "at.bucket", "at.copy")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    ``docs`` needs doc_id and text; other columns are ignored. A null text counts as
    empty; an empty text has an empty fingerprint, alike to other empty ones only.
    Equal texts get equal fingerprints. Repeated ids follow in text order, a null id
    comes last, a single document is its own next one; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    n_buckets = BUCKETS_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = Window.partitionBy("bucket").orderBy("copy", "key", "text")
    marked = with_next(docs, n_buckets).repartition("bucket").withColumn("fp", chosen(F.col("text")))
    n_chars = F.length("text")
    paired = marked.select("doc_id", "copy", "text", "fp", F.lead("text").over(order).alias("next_text"), F.lead("fp").over(order).alias("next_fp")).where(~F.col("copy"))
    half = F.floor(n_chars / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n_chars - half), F.substring(F.col("next_text"), F.lit(1), half))
    made = paired.select("doc_id", n_chars.cast("long").alias("n_chars"), "fp", "next_fp", edited.alias("edited"))
    made = made.withColumn("edited_fp", chosen(F.col("edited"))).withColumn("own", hashes(F.col("fp")))
    return made.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), shown(F.col("fp")).alias("fingerprint"),
        shown(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("own"), hashes(F.col("edited_fp"))).alias("near_edited"),
        likeness(F.col("own"), hashes(F.col("next_fp"))).alias("near_next"))


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprint_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
