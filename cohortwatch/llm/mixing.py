"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Targets. Sources in code point order (null last) take the weights in turn and share
``share`` of all words. A source stops at ``max_epochs`` times its size; what it
cannot take is shared again by weight among the others until no target is above its
stop. The fixed point has one water level: with sources sorted by stop / weight the
level after clamping the first j is (total - their stops) / (weight of the rest), and
the first level that the next source can bear is the answer, so prefix sums over the
source table (one row per source) replace the rounds.

Documents. A target of e source sizes takes every document floor(e) times and a
further ``target - floor(e) * source_size`` words: documents in the order of
md5(seed, doc_id, text) whole while they fit, the last one in part. The running sum is cut
by hash prefix: words per (source, prefix) give the prefix in which the budget ends,
a second prefix cuts that one, and only documents of the last prefix (about 1 in
16.7 million of a source) meet in a window. A source with a third of all rows is
therefore never gathered. Only built-in DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortwatch.llm.common import join_keyed, table
from cohortwatch.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = "mix-1"
# Hex digits of one prefix: 4,096 prefixes a level.
PREFIX = 3


def word_count(text: str) -> F.Column:
    """Words of a text column, 0 for null."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(no_source, source_key, source_size) to the same rows with ``target``.

    One row per source: the windows below run over that table, not over documents.
    Sources without words get target 0.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy("no_source", "source_key")
    choice = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("weight", F.element_at(choice, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("stop", F.lit(float(max_epochs)) * F.col("source_size"))
    by_stop = Window.orderBy(F.col("stop") / F.col("weight"), "no_source", "source_key")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.lit(float(share)) * F.sum("source_size").over(everything)
             - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    levels = weighed.withColumn("level", level)
    bearable = F.when(F.col("level") * F.col("weight") <= F.col("stop"), F.struct(F.col("stop") / F.col("weight"), "no_source", "source_key", "level"))
    water = F.min(bearable).over(everything)["level"]
    # no bearable level: the share is above all stops together
    target = F.coalesce(F.least(F.col("stop"), water * F.col("weight")), F.col("stop"))
    return levels.withColumn("target", target).select("no_source", "source_key", "source_size", "target")


KEY = ["no_source", "source_key"]


def marked(docs: DataFrame, seed: str) -> DataFrame:
    """``docs`` with the mix's own columns: source key, __size in words and __order, the draw of a document."""
    # the text is part of the draw, so that rows without an id, or of one id, do not draw alike
    order = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")))))
    return docs.withColumns({
        "no_source": F.col("source").isNull(), "source_key": F.coalesce(F.col("source").cast("string"), F.lit("")),
        "__size": word_count("text"), "__order": order})


def mix_plan(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """One row per source: target, whole epochs, the prefix in which the rest ends and what is left for it."""
    sizes = sized.groupBy(*KEY).agg(F.sum("__size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    sources = (source_targets(sizes, weights, share, max_epochs)
               .withColumn("whole", whole)
               .withColumn("left", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
               .withColumn("last", F.lit("")))
    for level in (1, 2):
        sources = _cut(sized, sources, KEY, level * PREFIX)
    return sources


def take(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (see ``marked``) with source_size, target and __taken, the words that the mix takes."""
    # documents before the last prefix are taken whole, behind it not at all
    dealt = join_keyed(rows, plan, KEY)
    prefix = F.substring("__order", 1, 2 * PREFIX)
    within = dealt.where(prefix == F.col("last"))
    so_far = F.sum("__size").over(Window.partitionBy(*KEY).orderBy("__order", "doc_id", "__size").rowsBetween(Window.unboundedPreceding, -1))
    part = F.greatest(F.lit(0), F.least(F.col("__size"), F.col("left") - F.coalesce(so_far, F.lit(0))))
    others = dealt.where(prefix != F.col("last")).withColumn("__more", F.when(prefix < F.col("last"), F.col("__size")).otherwise(F.lit(0)))
    both = others.unionByName(within.withColumn("__more", part))
    return both.withColumn("__taken", (F.col("whole") * F.col("__size") + F.col("__more")).cast("long"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                max_epochs: float = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, one row per row of ``docs``.

    ``docs`` needs doc_id, text and source; other columns are ignored. A null or
    empty text has size 0 and nothing taken; a null source is a source of its own; a
    null doc_id hashes like an empty one; repeated rows (equal id and text) are rows of their own,
    in any order among themselves since they are equal; an empty table gives an empty one.
    """
    rows = marked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text"), seed)
    sized = cut_lineage(rows.select("doc_id", *KEY, "__size", "__order"))
    taken = take(sized, mix_plan(sized, weights, share, max_epochs))
    return taken.select("doc_id", F.col("__size").alias("size"), "source_size", "target", F.col("__taken").alias("taken"))


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
               max_epochs: float = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as the mix takes them whole, and a part of a document where it takes a part.

    A part holds the document's first words, joined by one space; ``n_chars``, if there,
    is that of the row's text. Documents of which nothing is taken are left out.
    """
    # the row goes along as one value, so its columns cannot clash with those of the mix
    rows = marked(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), "doc_id", "source", "text"), seed)
    sized = cut_lineage(rows.select("doc_id", *KEY, "__size", "__order"))
    taken = take(rows, mix_plan(sized, weights, share, max_epochs)).where("__taken > 0")
    times, rest = F.floor(F.col("__taken") / F.col("__size")).cast("int"), (F.col("__taken") % F.col("__size")).cast("int")
    # 0: the whole text, else the number of its first words
    turns = F.concat(F.array_repeat(F.lit(0), times), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("__words")), " ")
    out = taken.withColumn("__words", F.explode(turns)).select("__row", F.when(F.col("__words") > 0, first).otherwise(F.col("text")).alias("__text"))
    made = {"text": F.col("__text"), "n_chars": F.length("__text")}
    return out.select(*[made[c].cast(docs.schema[c].dataType).alias(c) if c in made else F.col("__row").getField(c).alias(c) for c in docs.columns])


def _cut(sized: DataFrame, sources: DataFrame, key: list[str], digits: int) -> DataFrame:
    """Of each source the next prefix in which its budget ends: ``last``, and what is ``left`` for it."""
    inside = join_keyed(sized, sources, key).where(F.substring("__order", 1, digits - PREFIX) == F.col("last"))
    words = inside.groupBy(*key, F.substring("__order", 1, digits).alias("prefix"), "left").agg(F.sum("__size").alias("words"))
    up_to = words.withColumn("sum", F.sum("words").over(Window.partitionBy(*key).orderBy("prefix")))
    ends = (up_to.where(F.col("sum") >= F.col("left")).groupBy(*key)
            .agg(F.min_by(F.struct("prefix", (F.col("left") - F.col("sum") + F.col("words")).alias("left")), "prefix").alias("end")))
    # a budget above all words in sight cannot end: it takes them all
    return (sources.join(ends, key, "left")
            .withColumn("last", F.coalesce("end.prefix", F.rpad(F.lit(""), digits, "~")))
            .withColumn("left", F.coalesce("end.left", "left")).drop("end"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mix_sources(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS ord
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         2.0::DOUBLE * source_size AS stop
  FROM sizes),
levels AS (
  SELECT *, (1.5::DOUBLE * (SELECT CAST(sum(source_size) AS DOUBLE) FROM sizes)
             - coalesce(sum(stop) OVER (ORDER BY stop / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY stop / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
water AS (SELECT level AS water FROM levels WHERE level * weight <= stop ORDER BY stop / weight, source IS NULL, source LIMIT 1),
targets AS (SELECT source, source_size, least(stop, coalesce((SELECT water FROM water) * weight, stop)) AS target FROM levels),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
cut AS (SELECT *, CAST(round(target - whole * source_size) AS BIGINT) AS budget FROM plan),
run AS (
  SELECT s.doc_id, s.size, c.source_size, c.target, c.whole, c.budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.ord, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far
  FROM sized s JOIN cut c ON s.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, budget - so_far)) AS BIGINT) AS taken
FROM run
"""
