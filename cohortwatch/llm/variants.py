"""Spelling variant grouping by asymmetric q-chunks.

Words are counted over the whole corpus, and words that differ by exactly one edit are
found by signatures of two kinds. As a chunk owner a word of L letters contributes two
disjoint chunks: its first floor(L / 2) letters and the rest. As a gram owner it
contributes its positional grams of the chunk sizes of words of L - 1, L and L + 1
letters. One edit touches at most one of two disjoint chunks, so the other one is a gram of
the edited word, within a shift of one: letters before the edit stay in place and letters
behind it move by the difference in length. Of the positions within that shift only the
text's start for the first chunk and its end for the second can therefore match, and
only these grams are emitted. Chunks and grams meet in an equi-join on (chunk number,
owner's length, letters); of each pair the word that is smaller owns the chunk, and the
edit distance decides.

A chunk that many words share ("inter") would give all pairs of them. Keys with more than
``CROWD`` pairs are refined instead: the preserved half is given, so the one edit lies in the
rest, and the rests are cut into two chunks in their turn, under the key of the half. A
level halves the rest, so the crowd thins until it shares all but one letter, which bounds
it by the alphabet. No word, pair or key is dropped.

Only DataFrame functions are used; the vocabulary, not the corpus, is joined.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.llm.common import stored, table

LETTER = r"[A-Za-zÀ-ÿ]"
MIN_LETTERS = 7
MIN_TIMES = 2
RATIO = 10
# One occurrence in so many loses a letter (chosen by a hash).
DAMAGE = 31
# Pairs of one key that are compared without refining the key.
CROWD = 4096


def counted_words(docs: DataFrame, min_letters: int = MIN_LETTERS, min_times: int = MIN_TIMES, damage: int = DAMAGE) -> DataFrame:
    """(word, n): words of ``docs`` (doc_id, text) and how often they occur, partial sums first."""
    # a run that loses a letter must still be long enough, so shorter runs never count
    runs = F.explode(F.regexp_extract_all("text", F.lit(LETTER + "{%d,}" % min_letters), F.lit(0))).alias("run")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), runs)
    rows = rows.select("id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    hashed = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= min_letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_times)


def _key(number: int, owner_length: F.Column, letters: F.Column) -> F.Column:
    return F.xxhash64("key", F.lit(number), owner_length, letters)


def chunks(rows: DataFrame) -> DataFrame:
    """(key, word, n, rest) to the same columns, two rows a row: each chunk of ``rest``, and what is left of it."""
    rest, length = F.col("rest"), F.length("rest")
    half = F.floor(length / 2).cast("int")
    first, second = F.substring(rest, F.lit(1), half), F.substring(rest, half + 1, length)
    both = F.array(F.struct(_key(0, length, first).alias("key"), second.alias("rest")),
                   F.struct(_key(1, length, second).alias("key"), first.alias("rest")))
    return rows.select("word", "n", F.explode(both).alias("c")).select("c.key", "word", "n", "c.rest")


def positional_grams(rows: DataFrame) -> DataFrame:
    """(key, word, n, rest) to the same columns, six rows a row: the grams that a chunk of a near word can meet."""
    rest, length = F.col("rest"), F.length("rest")
    found = []
    for more in (-1, 0, 1):
        owner = length + more
        half = F.floor(owner / 2).cast("int")
        found.append(F.when(owner >= 0, F.struct(_key(0, owner, F.substring(rest, F.lit(1), half)).alias("key"), F.substring(rest, half + 1, length).alias("rest"))))
        size = owner - half
        fits = (owner >= 0) & (size <= length)
        found.append(F.when(fits, F.struct(_key(1, owner, F.substring(rest, length - size + 1, size)).alias("key"), F.substring(rest, F.lit(1), length - size).alias("rest"))))
    return rows.select("word", "n", F.explode(F.array_compact(F.array(*found))).alias("g")).select("g.key", "word", "n", "g.rest")


def near_pairs(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, n, other, other_n) for the distinct ``words`` (word, n): every two that are one edit apart, word < other."""
    start = words.select(F.lit(0).cast("long").alias("key"), "word", "n", F.col("word").alias("rest"))
    owners, others, found, level = start, start, None, 0
    while True:
        owners = stored(chunks(owners), f"chunks_{level}")
        others = stored(positional_grams(others), f"grams_{level}")
        met = (owners.groupBy("key").agg(F.count("*").alias("c"), F.max(F.length("rest")).alias("left"))
               .join(others.groupBy("key").agg(F.count("*").alias("g")), "key"))
        # one letter left: such a crowd is bounded by the alphabet
        crowded = stored(met.where((F.col("c") * F.col("g") > crowd) & (F.col("left") > 1)).select("key"), f"crowded_{level}")
        deeper = not crowded.isEmpty()
        plain = owners.join(crowded, "key", "left_anti") if deeper else owners
        a, b = plain.alias("a"), others.alias("b")
        close = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
        pairs = (a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.word") < F.col("b.word")) & close)
                 .select("a.word", "a.n", F.col("b.word").alias("other"), F.col("b.n").alias("other_n")))
        found = pairs if found is None else found.unionByName(pairs)
        if not deeper:
            # two chunks may have led to the same pair
            return found.distinct()
        owners, others = (side.join(crowded, "key", "left_semi") for side in (owners, others))
        level += 1


def with_forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n of every word: its near word of largest n, where that is ``ratio`` times its own."""
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    met = words.join(near, "word", "left")
    strong = -F.col("best.less") >= ratio * F.col("n")
    return met.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                      F.when(strong, F.col("best.form")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"))


def with_roots(forms: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``forms`` with root, the end of the chain of forms.

    Each step multiplies n by ``ratio`` at least, so the largest n bounds a chain's length, and
    doubling the steps takes as many rounds as that length has binary digits.
    """
    most = forms.agg(F.max("n").alias("n")).first()["n"] or 1
    steps = 0
    while ratio ** (steps + 1) <= most:
        steps += 1
    hops = forms.where("form is not null").select("word", F.col("form").alias("root"))
    for turn in range(steps.bit_length()):
        on = hops.select(F.col("word").alias("root"), F.col("root").alias("further"))
        hops = stored(hops.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), f"roots_{turn}")
    return forms.join(hops, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(docs: DataFrame, min_letters: int = MIN_LETTERS, min_times: int = MIN_TIMES, ratio: int = RATIO,
                   damage: int = DAMAGE, crowd: int = CROWD) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of ``docs`` (doc_id, text).

    Other columns are ignored. A null or empty text has no words; a null doc_id hashes like
    an empty one; repeated rows count each; a text of any length is read whole, and a run of
    any length is one word. Among near words of equal n the smallest in code point order is
    the form. An empty table gives an empty one. Keys are 64-bit hashes, which can only add
    pairs for the edit distance to judge.
    """
    words = stored(counted_words(docs, min_letters, min_times, damage), "words")
    forms = stored(with_forms(words, near_pairs(words, crowd), ratio), "forms")
    return with_roots(forms, ratio).select("word", "n", "n_near", "form", "form_n", "root")


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the form that it is a variant of."""
    return group_variants(table(spark, sf_dir, "documents", "doc_id", "text"))
