"""Quality rules: base counts, and how far a document's distributions are from its language's.

Two histograms of a document are compared with those of its language by Jensen-Shannon
distance (base 2, 0 to 1): the classes of its characters, and the words that are the
``COMMON`` commonest ones of the language, with one bin for all others. The references come from
all documents of the language: character classes are summed, candidates for the common words
are the frequent items of a sketch that holds ``TRACKED`` items a language (every word with more than
4 / TRACKED of the words is in it), and the candidates are counted exactly, so that the
sketch does not show in the result.

A document that is far from its reference in either histogram is not kept. A short
text is far from any distribution by chance, the more so the fewer its characters or words:
the character rule needs ``MIN_CHARS``, the word rule ``MIN_WORDS``, and the squared limits are
widened by what chance alone gives a text of n characters or words, bins / (8 n ln 2).

Only built-in DataFrame functions are used, in two passes over the texts: the sketch, then all
counts of a document, candidates included. What follows works on one narrow row per document. A
text is read whole, as one row; nothing is exploded but the words for the sketch, which is
combined before it is exchanged, so a language with most of the rows sends as much a
task as another.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.llm.common import join_keyed, stored, table
from cohortwatch.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
# Signs that a word loses at both ends before it is looked up.
PUNCTUATION = ".,;:!?()\"'-"
GRAM = 5
# Character classes: capitals, digits, punctuation, other signs, white space, and all other letters.
CAPITAL, LETTER, DIGIT, SPACE, POINT = r"\p{Lu}", r"\p{L}", r"\p{Nd}", r"\x20\x09-\x0D", r".,;:!?()\"'-"
CLASSES = 6
COMMON = 40
CANDIDATES = 60
TRACKED = 10_000
MIN_CHARS = 200
MIN_WORDS = 50
CLASS_LIMIT = 0.3
WORD_LIMIT = 0.25
# A language needs so many words for references; documents without one are held against the largest others.
REFERENCE_WORDS = 2000
LARGEST = 16
# Buckets of the hash table in which a language's candidates are looked up, and the first of their marks.
BUCKETS = 256
FIRST_MARK = 48


def let(value: F.Column, body) -> F.Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(numbers: F.Column) -> F.Column:
    return F.aggregate(numbers, F.lit(0.0), lambda s, x: s + x)


def repeated_words(words: F.Column, gram: int = GRAM) -> F.Column:
    """Words that lie in windows of ``gram`` words found twice or more."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    places = lambda h: F.sequence(F.lit(1), F.size(h) - (gram - 1))
    windows = let(hashed, lambda h: F.when(F.size(h) >= gram, F.transform(places(h), lambda i: F.xxhash64(F.slice(h, i, F.lit(gram)))))
                  .otherwise(F.array().cast("array<bigint>")))

    def starts(s: F.Column) -> F.Column:
        twice = lambda e, k: (F.get(s, k - 1)["w"] == e["w"]) | (F.get(s, k + 1)["w"] == e["w"])
        return F.sort_array(F.transform(F.filter(s, lambda e, k: F.coalesce(twice(e, k), F.lit(False))), lambda e: e["i"]))

    def covered(p: F.Column) -> F.Column:
        step = F.transform(p, lambda at, k: F.least(F.lit(gram), F.coalesce(F.get(p, k + 1) - at, F.lit(gram))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda n, x: n + x)

    def of(w: F.Column) -> F.Column:
        placed = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(let(let(placed, starts), covered))

    return let(windows, of)


def base_counts(text: str, words: str) -> dict[str, F.Column]:
    """The base columns of a text and its words."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(F.col(words)),
    }


def class_counts(text: str, word_chars: F.Column) -> F.Column:
    """Characters of each class, letters other than capitals last.

    Long runs of letters and spaces go first, so that only the few signs left are looked at by kind.
    """
    signs = F.regexp_replace(text, f"[{LETTER}{SPACE}]+", "")
    capitals = F.length(F.regexp_replace(text, f"[^{CAPITAL}]+", ""))
    n = F.length(text)

    def of(rest: F.Column) -> F.Column:
        digits, points = F.regexp_count(rest, F.lit(f"[{DIGIT}]")), F.regexp_count(rest, F.lit(f"[{POINT}]"))
        return F.array(*[c.cast("long") for c in (capitals, digits, points, F.length(rest) - digits - points, n - word_chars, word_chars - F.length(rest) - capitals)])

    return let(signs, of)


def plain_word(word: F.Column) -> F.Column:
    """Lower-cased, without punctuation at its ends; empty where nothing else is in it."""
    return F.btrim(F.lower(word), F.lit(PUNCTUATION))


def candidate_tables(docs: DataFrame) -> DataFrame:
    """(lang, n_words, words, marks, slots): frequent words of each language with enough words, and their hash table."""
    rows = docs.where(F.col("lang").isNotNull())
    found = rows.select("lang", F.explode(F.regexp_extract_all("__text", F.lit(WORD), F.lit(0))).alias("w")).select("lang", plain_word(F.col("w")).alias("w"))
    frequent = found.groupBy("lang").agg(F.expr(f"approx_top_k(nullif(w, ''), {CANDIDATES}, {TRACKED})").alias("top"), F.count("*").alias("n_words"))
    frequent = frequent.where(F.col("n_words") >= REFERENCE_WORDS).select("lang", "n_words", F.sort_array(F.filter("top.item", lambda w: w.isNotNull())).alias("words"))
    marked = frequent.withColumn("marks", F.transform("words", lambda w, i: F.char(i + FIRST_MARK)))
    entries = F.zip_with("words", "marks", lambda w, m: F.struct(w.alias("word"), m.alias("mark")))
    slots = let(entries, lambda e: F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.filter(e, lambda x: slot(x["word"]) == b)))
    return cut_lineage(marked.withColumn("slots", slots))


def slot(word: F.Column) -> F.Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def candidate_counts(words: str, one: F.Column) -> F.Column:
    """How often each candidate of a table occurs among ``words``."""
    def mark(w: F.Column) -> F.Column:
        plain = plain_word(w)
        return let(plain, lambda p: F.get(F.filter(F.element_at(one["slots"], slot(p) + 1), lambda e: e["word"] == p), F.lit(0))["mark"])

    return let(F.array_join(F.transform(words, mark), ""),
               lambda met: F.transform(one["marks"], lambda m: F.length(met) - F.length(F.replace(met, m, F.lit("")))))


def keyed_by_language(per_lang: DataFrame, columns: list[str], name: str) -> DataFrame:
    """(__ref, name): of each language an array of its one row, and under the empty key one of the largest languages."""
    row = F.struct(*columns)
    largest = per_lang.orderBy(F.desc("n_words"), "lang").limit(LARGEST).agg(
        F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n_words")).alias("less"), "lang", row.alias("row")))), lambda x: x["row"]).alias(name))
    own = per_lang.select(F.concat(F.lit("="), "lang").alias("__ref"), F.array(row).alias(name))
    return own.unionByName(largest.where(F.size(name) > 0).select(F.lit("").alias("__ref"), name))


def measured(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """One narrow row per document: base counts, class counts, counts of the candidates of its reference languages."""
    known = candidates.select("lang", F.concat(F.lit("="), "lang").alias("__own"))
    rows = join_keyed(docs, known, ["lang"], "left").withColumn("__ref", F.coalesce("__own", F.lit(""))).drop("__own")
    rows = join_keyed(rows, keyed_by_language(candidates, ["marks", "slots"], "__tables"), ["__ref"], "left")
    rows = rows.withColumn("__words", F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)))
    rows = rows.withColumns({
        **base_counts("__text", "__words"), "n_chars": F.length("__text"),
        "times": F.transform("__tables", lambda one: candidate_counts("__words", one))})
    rows = rows.withColumn("classes", class_counts("__text", F.col("word_chars")))
    return stored(rows.drop("__text", "__words", "__tables"), "measured")


def references(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """(lang, n_words, class_share, places, share): of each language the shares of the classes and of its commonest words, named by their places among the candidates."""
    own = rows.where("__ref <> ''")
    sums = own.groupBy("lang").agg(F.array(*[F.sum(F.col("classes")[i]) for i in range(CLASSES)]).alias("classes"),
                                   F.array(*[F.sum(F.get(F.col("times")[0], F.lit(i))) for i in range(CANDIDATES)]).alias("times"))
    met = candidates.select("lang", "n_words", "words").join(sums, "lang")
    entries = F.transform("words", lambda w, i: F.struct((-F.get("times", i)).alias("less"), w.alias("word"), i.alias("place")))
    best = met.withColumn("best", F.slice(F.sort_array(entries), 1, COMMON))
    return best.select("lang", "n_words", shares(F.col("classes")).alias("class_share"), F.col("best.place").alias("places"),
                       F.transform("best.less", lambda n: -n / F.col("n_words")).alias("share"))


def shares(counts: F.Column) -> F.Column:
    return let(F.greatest(total(counts), F.lit(1.0)), lambda n: F.transform(counts, lambda x: x / n))


def divergence(p: F.Column, q: F.Column) -> F.Column:
    """Jensen-Shannon distance, base 2, of two arrays of shares."""
    def part(a: F.Column, b: F.Column) -> F.Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    return F.sqrt(F.greatest(F.lit(0.0), total(F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))) / 2))


def with_rest(share: F.Column) -> F.Column:
    """The shares and what they leave of 1."""
    return let(share, lambda s: F.array_append(s, F.greatest(F.lit(0.0), 1 - total(s))))


def limit(level: float, bins: int, n: str) -> F.Column:
    """``level``, widened by what chance gives ``n`` draws into so many bins."""
    return F.sqrt(level ** 2 + bins / (8 * math.log(2) * F.greatest(F.col(n), F.lit(1))))


def quality_rules(docs: DataFrame, class_limit: float = CLASS_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, class_distance, word_distance.

    ``docs`` needs doc_id, text and lang; other columns are ignored. A null text counts as empty
    and fails the base rules; a null language, or one with fewer than ``REFERENCE_WORDS`` words,
    is held against the nearest of the ``LARGEST`` largest references, and without any reference the
    base rules alone decide. Repeated rows are rows of their own with equal results; windows are
    compared by 64-bit hashes; a very long text is one row, read whole. An empty table gives an
    empty one.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("__text"))
    candidates = candidate_tables(texts)
    rows = measured(texts, candidates)
    rows = join_keyed(rows, keyed_by_language(references(rows, candidates), ["class_share", "places", "share"], "__refs"), ["__ref"], "left")
    own = shares(F.col("classes"))
    by_class = let(own, lambda c: F.array_min(F.transform("__refs", lambda r: divergence(c, r["class_share"]))))
    in_doc = lambda times, r: F.transform(r["places"], lambda i: F.get(times, i) / F.greatest(F.col("n_words"), F.lit(1)))
    by_word = F.array_min(F.zip_with("times", "__refs", lambda times, r: divergence(with_rest(in_doc(times, r)), with_rest(r["share"]))))
    rows = rows.withColumns({"class_distance": F.when(F.col("n_chars") >= MIN_CHARS, by_class), "word_distance": F.when(F.col("n_words") >= MIN_WORDS, by_word),
                             "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))})
    far = (F.coalesce(F.col("class_distance") > limit(class_limit, CLASSES, "n_chars"), F.lit(False))
           | F.coalesce(F.col("word_distance") > limit(word_limit, COMMON + 1, "n_words"), F.lit(False)))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       (~F.col("base_failed") & ~far).alias("kept"), "class_distance", "word_distance")


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of every document."""
    out = quality_rules(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return out.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


def _sql() -> str:
    signs = f"regexp_replace(t, '[{LETTER}{SPACE}]+', '', 'g')"
    space = f"(length(t) - length(regexp_replace(t, '[{SPACE}]', '', 'g')))"
    capitals = f"(length(t) - length(regexp_replace(t, '{CAPITAL}', '', 'g')))"
    digits = f"(length(t) - length(regexp_replace(t, '{DIGIT}', '', 'g')))"
    point = POINT.replace("'", "''")
    points = f"(length(t) - length(regexp_replace(t, '[{point}]', '', 'g')))"
    others = f"(length({signs}) - {digits} - {points})"
    counts = f"[{capitals}, {digits}, {points}, {others}, {space}, length(t) - {space} - length({signs}) - {capitals}]"
    plain = f"lambda x: trim(lower(x), '{PUNCTUATION.replace(chr(39), chr(39) * 2)}')"

    def distance(p: str, q: str) -> str:
        part = lambda a, b: f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END"
        terms = f"list_transform(list_zip({p}, {q}), lambda x: {part('x[1]', 'x[2]')} + {part('x[2]', 'x[1]')})"
        return f"sqrt(greatest(0, list_sum({terms}) / 2))"

    rest = lambda p: f"list_append({p}, greatest(0, 1 - list_sum({p})))"
    limit = lambda level, bins, n: f"sqrt({level * level}::DOUBLE + {bins}::DOUBLE / ({8 * math.log(2)!r} * greatest(1, {n})))"
    n = CLASSES
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
cut AS MATERIALIZED (
  SELECT *, regexp_extract_all(t, '{WORD}') AS w, list_transform(regexp_extract_all(t, '{WORD}'), {plain}) AS lw, {counts} AS cls,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM docs),
windows AS (SELECT rid, i, w[i:i + {GRAM - 1}] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - {GRAM - 2})) AS i FROM cut)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, unnest(range(0, {GRAM})) AS k FROM again) GROUP BY rid),
base AS (
  SELECT c.*, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(v.n, 0) AS BIGINT) AS n_repeat_words
  FROM cut c LEFT JOIN covered v USING (rid)),
classes AS (SELECT lang, [{', '.join(f'sum(cls[{i}])' for i in range(1, n + 1))}] AS s FROM cut WHERE lang IS NOT NULL GROUP BY lang),
words AS (SELECT lang, word, count(*) AS times FROM (SELECT lang, unnest(lw) AS word FROM cut WHERE lang IS NOT NULL) GROUP BY ALL),
sizes AS (SELECT lang, sum(times) AS size FROM words GROUP BY lang HAVING sum(times) >= {REFERENCE_WORDS}),
top AS (
  SELECT lang, list(word ORDER BY place) AS common, list(times / size ORDER BY place) AS common_share
  FROM (SELECT lang, word, times, size, row_number() OVER (PARTITION BY lang ORDER BY times DESC, word) AS place FROM words JOIN sizes USING (lang) WHERE word <> '')
  WHERE place <= {COMMON} GROUP BY lang),
refs AS (
  SELECT lang, common, common_share, list_transform(s, lambda x: x / greatest(1, list_sum(s))) AS class_share,
         row_number() OVER (ORDER BY size DESC, lang) AS rank
  FROM top JOIN sizes USING (lang) JOIN classes USING (lang)),
against AS (
  SELECT b.rid, r.* EXCLUDE (lang) FROM base b JOIN refs r ON r.lang = b.lang
  UNION ALL
  SELECT b.rid, r.* EXCLUDE (lang) FROM base b JOIN refs r ON r.rank <= {LARGEST}
  WHERE b.lang IS NULL OR b.lang NOT IN (SELECT lang FROM refs)),
far AS (
  SELECT rid, min(by_class) AS by_class, min(by_word) AS by_word FROM (
    SELECT rid, {distance('list_transform(cls, lambda x: x / greatest(1, length(t)))', 'class_share')} AS by_class,
           {distance(rest('list_transform(common, lambda c: len(list_filter(lw, lambda x: x = c)) / greatest(1, len(lw)))'), rest('common_share'))} AS by_word
    FROM base JOIN against USING (rid))
  GROUP BY rid),
judged AS (
  SELECT b.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CASE WHEN length(t) >= {MIN_CHARS} THEN by_class END AS class_distance, CASE WHEN len(lw) >= {MIN_WORDS} THEN by_word END AS word_distance
  FROM base b LEFT JOIN far USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (coalesce(class_distance, 0) > {limit(CLASS_LIMIT, n, 'length(t)')}
                                OR coalesce(word_distance, 0) > {limit(WORD_LIMIT, COMMON + 1, 'len(lw)')}) AS kept,
       round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance
FROM judged
"""


SQL = _sql()
