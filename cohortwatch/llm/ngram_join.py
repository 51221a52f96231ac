"""N-gram Jaccard join by T-occurrence search (DivideSkip).

Two documents link when their sets of five-word shingles have a Jaccard likeness of
three quarters or more. The work is dealt in steps that lose no link:

1. Documents of equal sets are one class, whose smallest id stands for it.
2. All shingles are counted: a batch of documents sends the low 32 bits of its hashes, in
   one binary row per bucket of the hash space, and gets back those that occur elsewhere,
   with their frequency (shingles that a batch repeats are sent once with their count).
   A link needs three quarters of a document's shingles elsewhere, so all other documents
   are done. Shingles are ordered by frequency, then hash: a link needs a common one
   among the first n - ceil(3n/4) + 1 of both sets (prefix filter), and only these are
   posted. A hash that meets another one's low bits only adds a candidate. Since a common
   line or passage sorts last, posting lists are short even if a third of all documents
   hold it.
3. Lists of up to ``SHORT`` documents give all their pairs, counted over lists; the count
   bounds the overlap (prefix tokens of the set whose prefix ends first that are not
   common to both prefixes cannot be in the other set at all), and pairs that cannot
   reach the overlap fall out. Longer lists, as many near copies make them, give one
   star per band of sizes: its first document with each of the others.
4. Candidates are verified by T-occurrence search: a block of documents forms an
   inverted index, and each star centre or partner queries it with DivideSkip: the
   longest lists are set aside, the short ones are merged with a heap that skips ahead
   by binary search, and the long ones are probed by binary search. Overlaps are exact.
5. The links found so far form components. What long lists have left, pairs across
   components that pass the size and position filters, is verified in the same way.
   Links inside a component would not change it. Components of both make the result.

Nothing is gathered by key without bound: postings stream in sorted order, blocks
are dealt by the indexed document, and centres are copied to the blocks that need them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from math import log2

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.llm.common import importable, join_keyed, map_arrow, stored, table
from cohortwatch.llm.components import connected_components
from cohortwatch.llm.shingles import set_digest, shingle_set

# Likeness of at least LEAST_PERCENT / 100, in whole numbers.
LEAST_PERCENT = 75
# Documents whose shingles are counted at once.
CHUNK_ROWS = 1024
# Buckets of the hash space for each shuffle partition.
BUCKETS_A_PARTITION = 4
SHORT = 8
BLOCK_PAIRS = 400
# Weight of a probe against a merge step when lists are divided.
PROBE_WEIGHT = 0.0085
# Ids (8 bytes) that may be broadcast to filter texts; beyond that a shuffle join does it.
BROADCAST_IDS = 200_000


def least_overlap(n: int) -> int:
    """Common shingles that any link of a set of n needs."""
    return -(-LEAST_PERCENT * n // 100)


def pair_overlap(n: F.Column, m: F.Column) -> F.Column:
    """Common shingles that a link of sets of n and m needs."""
    return F.ceil(F.lit(LEAST_PERCENT) * (n + m) / F.lit(100 + LEAST_PERCENT))


def linked(overlap: int, n: int, m: int) -> bool:
    return 100 * overlap >= LEAST_PERCENT * (n + m - overlap)


def divide_skip(query: list[int], index: dict[int, list[int]], least: int) -> list[tuple[int, int]]:
    """(id, overlap) of every indexed set that holds at least ``least`` elements of ``query``.

    ``index`` maps an element to its sorted ids. The longest lists, as many as the
    published rule sets apart and fewer than ``least``, are only probed.
    """
    lists = sorted((index[t] for t in query if t in index), key=len)
    if len(lists) < least or least < 1:
        return []
    n_long = min(least - 1, int(least / (PROBE_WEIGHT * log2(len(lists[-1]) + 1) + 1))) if len(lists) > 1 else 0
    # probing pays only where lists are longer than the merge they spare
    while n_long and len(lists[-n_long]) <= 2:
        n_long -= 1
    short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
    need = least - n_long
    heap = [(x[0], i) for i, x in enumerate(short)]
    at = [0] * len(short)
    heapify(heap)
    found = []
    while len(heap) >= need:
        low = heap[0][0]
        popped = []
        while heap and heap[0][0] == low:
            popped.append(heappop(heap)[1])
        if len(popped) >= need:
            count = len(popped)
            for x in long:
                k = bisect_left(x, low)
                count += k < len(x) and x[k] == low
            if count >= least:
                found.append((low, count))
            for i in popped:
                at[i] += 1
                if at[i] < len(short[i]):
                    heappush(heap, (short[i][at[i]], i))
            continue
        # too few lists hold it: drop lists until ``need`` of them could meet, and skip to there
        while heap and len(popped) < need - 1:
            popped.append(heappop(heap)[1])
        if not heap:
            break
        to = heap[0][0]
        for i in popped:
            at[i] = bisect_left(short[i], to, at[i])
            if at[i] < len(short[i]):
                heappush(heap, (short[i][at[i]], i))
    return found


def profile(docs: DataFrame) -> DataFrame:
    """(doc_id, n, digest) of every row, stored."""
    def scanned(batch: pa.RecordBatch) -> dict:
        sets = [shingle_set(t) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "n": [len(s) for s in sets], "digest": [set_digest(s) for s in sets]}

    return stored(map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), scanned, "doc_id long, n int, digest binary"), "sets")


# Rows of the frequency count: singles of a chunk with their documents, repeated shingles of
# a chunk with their counts, all places of the repeated ones, and the chunk's documents.
SINGLE, REPEATED, PLACES, HEADER = range(4)
PARTS = "bucket int, chunk long, kind int, a binary, b binary, c binary"


def _u(values: np.ndarray, kind=np.uint32) -> bytes:
    return values.astype(kind).tobytes()


def chunk_parts(buckets: int):
    """A batch of documents as one part per bucket of the hash space, one row each."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        slices = (batch.slice(at, CHUNK_ROWS) for batch in batches for at in range(0, batch.num_rows, CHUNK_ROWS))
        for turn, batch in enumerate(slices):
            chunk = (task << 32) | turn
            sets = [shingle_set(t) for t in batch.column("text").to_pylist()]
            size = np.array([len(s) for s in sets], dtype=np.int64)
            rows = [(chunk % buckets, chunk, HEADER, _u(batch.column("doc_id").to_numpy(), np.int64), _u(size), b"")]
            token = np.concatenate(sets) if size.sum() else np.zeros(0, dtype=np.uint64)
            token = (((token >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32)) | (token & np.uint64(0xFFFFFFFF))
            order = np.argsort(token, kind="stable")
            token, owner = token[order], np.repeat(np.arange(len(sets)), size)[order]
            first = np.flatnonzero(np.diff(token, prepend=token[:1] + np.uint64(1)) != 0)
            times = np.diff(np.append(first, len(token)))
            alone, many = first[times == 1], first[times > 1]
            again = np.repeat(times > 1, times)
            rows.append((chunk % buckets, chunk, PLACES, _u(token[again], np.uint64), _u(owner[again]), b""))
            for kind, at, other in ((SINGLE, alone, owner[alone]), (REPEATED, many, times[times > 1])):
                bounds = np.searchsorted(token[at], np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
                for k in np.flatnonzero(np.diff(bounds)).tolist():
                    lo, hi = bounds[k], bounds[k + 1]
                    rows.append((k, chunk, kind, _u(token[at[lo:hi]] & np.uint64(0xFFFFFFFF)), _u(other[lo:hi]), b""))
            yield _parts_batch(rows)

    return made


def _parts_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 6
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["bucket", "chunk", "kind", "a", "b", "c"])


def count_bucket(group: pa.Table) -> pa.Table:
    """Frequencies of a bucket's shingles; of each chunk those that some other document has too."""
    rows = list(zip(*[group.column(c).to_pylist() for c in ("bucket", "chunk", "kind", "a", "b", "c")]))
    out = [r for r in rows if r[2] in (PLACES, HEADER)]
    counted = [r for r in rows if r[2] in (SINGLE, REPEATED)]
    if counted:
        low = [np.frombuffer(r[3], dtype=np.uint32) for r in counted]
        times = [np.ones(len(x)) if r[2] == SINGLE else np.frombuffer(r[4], dtype=np.uint32) for r, x in zip(counted, low)]
        _, which = np.unique(np.concatenate(low), return_inverse=True)
        count = np.bincount(which, weights=np.concatenate(times))[which].astype(np.int64)
        ends = np.cumsum([len(x) for x in low])
        for r, x, hi in zip(counted, low, ends.tolist()):
            n = count[hi - len(x):hi]
            keep = n > 1
            token = x[keep].astype(np.uint64) | (np.uint64(r[0]) << np.uint64(32))
            owner = _u(np.frombuffer(r[4], dtype=np.uint32)[keep]) if r[2] == SINGLE else b""
            out.append((r[0], r[1], r[2], token.tobytes(), owner, _u(n[keep])))
    return pa.Table.from_batches([_parts_batch(out)])


PREFIX = "doc_id long, n int, last double, offset int, tokens array<long>"
PREFIX_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("last", pa.float64()), ("offset", pa.int32()), ("tokens", pa.list_(pa.int64()))])


def chunk_prefixes(group: pa.Table) -> pa.Table:
    """The chunk's documents that can link at all, with the shared part of their prefix."""
    parts: dict[int, list[tuple]] = {k: [] for k in range(4)}
    for kind, a, b, c in zip(*[group.column(x).to_pylist() for x in ("kind", "a", "b", "c")]):
        parts[kind].append((a, b, c))
    join = lambda kind, at, dtype: np.frombuffer(b"".join(p[at] for p in parts[kind]), dtype=dtype)
    doc_id, size = join(HEADER, 0, np.int64), join(HEADER, 1, np.uint32).astype(np.int64)
    many, many_count = join(REPEATED, 0, np.uint64), join(REPEATED, 2, np.uint32)
    order = np.argsort(many)
    many, many_count = many[order], many_count[order]
    places = join(PLACES, 0, np.uint64)
    token = np.concatenate([join(SINGLE, 0, np.uint64), places])
    owner = np.concatenate([join(SINGLE, 1, np.uint32), join(PLACES, 1, np.uint32)]).astype(np.int64)
    count = np.concatenate([join(SINGLE, 2, np.uint32), many_count[np.searchsorted(many, places)] if len(places) else many_count[:0]]).astype(np.int64)
    shared = np.bincount(owner, minlength=len(size))
    least = -(-LEAST_PERCENT * size // 100)
    fit = (size > 0) & (shared >= least)
    keep = fit[owner]
    token, owner, count = token[keep], owner[keep], count[keep]
    order = np.lexsort((token, count, owner))
    token, owner, count = token[order], owner[order], count[order]
    start = np.searchsorted(owner, np.arange(len(size) + 1))
    out: dict[str, list] = {k: [] for k in ("doc_id", "n", "last", "offset", "tokens")}
    for d in np.flatnonzero(fit).tolist():
        lo = int(start[d])
        hi = lo + int(shared[d] - least[d]) + 1
        out["doc_id"].append(int(doc_id[d]))
        out["n"].append(int(size[d]))
        out["last"].append(float(count[hi - 1]) + float(token[hi - 1]) / 2.0 ** 64)
        out["offset"].append(int(size[d] - shared[d]))
        out["tokens"].append(token[lo:hi].view(np.int64))
    return pa.table(out, schema=PREFIX_ARROW)


def prefixes(docs: DataFrame) -> DataFrame:
    """(doc_id, n, last, offset, tokens): documents of whose shingles enough occur elsewhere.

    tokens are those of the first n - ceil(3n/4) + 1 shingles, in order of frequency, that
    occur elsewhere; ``offset`` of them occur nowhere else and come before; ``last`` is the
    place of the last in the order.
    """
    importable(docs.sparkSession)
    buckets = BUCKETS_A_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    parts = rows.mapInArrow(chunk_parts(buckets), PARTS)
    counted = parts.groupBy("bucket").applyInArrow(count_bucket, PARTS)
    return counted.groupBy("chunk").applyInArrow(chunk_prefixes, PREFIX)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool, bool]]:
    """Stretches of equal tokens in sorted batches: (token, docs, sizes_places, first part, last part).

    A run that goes over the end of a batch comes in parts, so memory is bounded by a batch.
    """
    held: tuple | None = None
    for batch in batches:
        token = batch.column("token").to_numpy()
        if not len(token):
            continue
        doc, size = batch.column("doc_id").to_numpy(), batch.column("np").to_numpy()
        cut = np.flatnonzero(np.diff(token)) + 1
        bounds = np.concatenate([[0], cut, [len(token)]])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            part = (int(token[a]), doc[a:b], size[a:b])
            if held is not None:
                same = held[0] == part[0]
                yield (*held[:3], held[3], not same)
                held = (*part, not same)
            else:
                held = (*part, True)
    if held is not None:
        yield (*held[:3], held[3], True)


def pair_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of short lists, stars of long ones, and the long lists themselves.

    Input: postings sorted by token, size and document. kind 0: pair (a, b) of a short
    list; 1: star centre a with b; 2: long list's token a, document b, size and place.
    """
    out: list[tuple[int, int, int, int]] = []
    centre, last, pending = None, None, []
    for token, docs, places, first, final in runs(batches):
        rows = list(zip(docs.tolist(), places.tolist()))
        if first:
            centre, last, pending = None, None, []
        if first and final and len(rows) <= SHORT:
            ids = sorted({d for d, _ in rows})
            out += [(0, a, b, 0) for i, a in enumerate(ids) for b in ids[i + 1:]]
        else:
            # parts of one run: a short run that was cut by a batch is treated as a long one
            for d, place in rows:
                if d == last:
                    continue
                last = d
                size = place >> 32
                if centre is None or 100 * centre[1] < LEAST_PERCENT * size:
                    centre = (d, size)
                else:
                    out.append((1, centre[0], d, 0))
                pending.append((2, token, d, place))
            out += pending
            pending = []
        if len(out) >= 20_000:
            yield _pairs_batch(out)
            out = []
    yield _pairs_batch(out)


def _pairs_batch(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[1:]]], ["kind", "a", "b", "np"])


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b) links among the candidate pairs (query a, indexed b), by T-occurrence search in blocks of b."""
    spark = docs.sparkSession
    pairs = stored(pairs, "candidates")
    n = pairs.count()
    blocks = max(1, -(-n // BLOCK_PAIRS))
    block = F.pmod(F.xxhash64("b"), F.lit(blocks)).cast("int").alias("block")
    roles = (pairs.select(block, F.col("a").alias("doc_id"), F.lit(True).alias("asks"))
             .unionByName(pairs.select(block, F.col("b").alias("doc_id"), F.lit(False).alias("asks"))).distinct())
    needed = stored(roles.select("doc_id").distinct(), "needed")
    some = F.broadcast(needed) if needed.count() <= BROADCAST_IDS else needed

    def shingled(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "items": [shingle_set(t).tobytes() for t in batch.column("text").to_pylist()]}

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(some, "doc_id")
    sets = map_arrow(texts, shingled, "doc_id long, items binary").distinct()
    return roles.join(sets, "doc_id").groupBy("block").applyInArrow(search_block, "a long, b long")


def search_block(group: pa.Table) -> pa.Table:
    """T-occurrence search of a block's queries in the inverted index of its other sets.

    Of the links found those that join two parts of the block come back; the others would
    not change a component.
    """
    rows = list(zip(group.column("doc_id").to_pylist(), group.column("asks").to_pylist(), group.column("items").to_pylist()))
    sets = {(d, asks): np.frombuffer(x, dtype=np.uint64).tolist() for d, asks, x in rows}
    ids = sorted(d for d, asks in sets if not asks)
    index: dict[int, list[int]] = {}
    for d in ids:
        for t in sets[d, False]:
            index.setdefault(t, []).append(d)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    a, b = [], []
    for (d, asks), items in sets.items():
        if not asks:
            continue
        for other, overlap in divide_skip(items, index, least_overlap(len(items))):
            if other != d and linked(overlap, len(items), len(sets[other, False])):
                low, high = sorted((find(d), find(other)))
                if low != high:
                    root[high] = low
                    a.append(d)
                    b.append(other)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def link_space(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sets, classes of equal sets, and links between classes.

    Returns (doc_id, n, digest) of every row, (digest, class_id) of the classes with several
    rows, and the links (a, b) between class ids: all of them up to links inside a
    component of the others.
    """
    sets = profile(docs)
    usable = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    classes = stored(sets.where(usable).groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("rows")).where("rows > 1").drop("rows"), "classes")
    copies = join_keyed(sets.where(usable).select("doc_id", "digest"), classes, ["digest"]).where("doc_id <> class_id").select("doc_id").distinct()
    firsts = stored(prefixes(docs).join(copies, "doc_id", "left_anti"), "prefixes")
    place = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR((F.col("offset") + F.col("pos")).cast("long")).alias("np")
    postings = firsts.select("doc_id", "n", "offset", F.posexplode("tokens").alias("pos", "token")).select("token", place, "doc_id")
    postings = postings.repartition("token").sortWithinPartitions("token", "np", "doc_id")
    importable(docs.sparkSession)
    lists = stored(postings.mapInArrow(pair_lists, "kind int, a long, b long, np long"), "lists")
    long = lists.where("kind = 2").select(F.col("a").alias("token"), F.col("b").alias("doc_id"), "np")
    links = stored(verified(first_candidates(lists, long, firsts), docs), "links")
    rest = stored(cross_candidates(long, connected_components(links)), "rest")
    if not rest.isEmpty():
        links = links.unionByName(verified(rest, docs))
    return sets, classes, links


def first_candidates(lists: DataFrame, long: DataFrame, firsts: DataFrame) -> DataFrame:
    """Pairs of short lists that can reach their overlap, and the stars of long lists."""
    in_long = long.groupBy("doc_id").agg(F.count("*").alias("longs"))
    facts = firsts.select("doc_id", "n", "last").join(in_long, "doc_id", "left").withColumn("longs", F.coalesce("longs", F.lit(0)))
    left, right = ([F.col(c).alias(f"{c}_{side}") for c in ("n", "last", "longs")] for side in "ab")
    pairs = lists.where("kind = 0").groupBy("a", "b").agg(F.count("*").alias("common"))
    pairs = pairs.join(facts.select(F.col("doc_id").alias("a"), *left), "a").join(facts.select(F.col("doc_id").alias("b"), *right), "b")
    n, m = F.col("n_a"), F.col("n_b")
    after_n, after_m = (F.ceil(F.lit(LEAST_PERCENT) * x / F.lit(100)) - 1 for x in (n, m))
    after = F.when(F.col("last_a") < F.col("last_b"), after_n).when(F.col("last_a") > F.col("last_b"), after_m).otherwise(F.greatest(after_n, after_m))
    sizes = 100 * F.least(n, m) >= LEAST_PERCENT * F.greatest(n, m)
    reach = F.col("common") + F.least("longs_a", "longs_b") + after >= pair_overlap(n, m)
    stars = lists.where("kind = 1 and a <> b").select("a", "b").distinct()
    return pairs.where(sizes & reach).select("a", "b").unionByName(stars).distinct()


def cross_candidates(long: DataFrame, components: DataFrame) -> DataFrame:
    """Pairs of long lists across components that pass the size and position filters.

    In each list the component with most members is set apart; only the members of the
    others are joined with the list, so a crowd of near copies in one component makes
    no pairs with itself.
    """
    known = components.select(F.col("node").alias("doc_id"), "component")
    rows = long.join(known, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    share = rows.groupBy("token", "component").agg(F.count("*").alias("rows"))
    main = share.groupBy("token").agg(F.max_by("component", F.struct("rows", "component")).alias("main"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    mixed_lists = stored(rows.join(main, "token").withColumn("n", F.shiftright("np", 32)).withColumn("rest", F.col("n") - F.col("np").bitwiseAND(F.lit(0xFFFFFFFF))).drop("np"), "mixed")
    minor = mixed_lists.where("component <> main").select("token", *[F.col(c).alias(f"{c}_a") for c in ("doc_id", "component", "n", "rest")])
    n, m = F.col("n_a"), F.col("n")
    passes = (F.col("component_a") != F.col("component")) & (100 * F.least(n, m) >= LEAST_PERCENT * F.greatest(n, m)) \
        & (F.least("rest_a", "rest") >= pair_overlap(n, m))
    pairs = minor.join(mixed_lists, "token").where(passes)
    return pairs.select(F.least("doc_id_a", "doc_id").alias("a"), F.greatest("doc_id_a", "doc_id").alias("b")).distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable by links, the row's own included. Null
    texts and texts without words have no shingles and no links; equal sets link at any
    size; a doc_id stands for all rows that carry it; a row with a null doc_id takes no
    part (component null). An empty table gives an empty one.
    """
    sets, classes, links = link_space(docs)
    rows = join_keyed(sets, classes, ["digest"], "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    found = connected_components(links).select(F.col("node").alias("class_id"), F.col("component").alias("component_id"))
    rows = join_keyed(rows, found, ["class_id"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "class_id"))
    return rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) without the near duplicates: of each component the smallest doc_id stays.

    Rows with a null doc_id stay.
    """
    found = jaccard_components(docs)
    others = stored(found.where("component_id <> doc_id").select("doc_id").distinct(), "others")
    kept = docs.join(F.broadcast(others) if others.count() <= BROADCAST_IDS else others, "doc_id", "left_anti")
    return kept.select(*docs.columns)


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle set size and near-duplicate component of every document."""
    return jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS ws
  FROM documents),
placed AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1) + 1))) AS i FROM worded),
shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM placed),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
linked AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 75 * (p.n + q.n - k)),
edges AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reached AS (SELECT doc_id AS node, doc_id AS low FROM documents UNION SELECT b, low FROM reached JOIN edges ON a = node),
lowest AS (SELECT node, min(low) AS low FROM reached GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, low AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN lowest ON node = d.doc_id
"""
