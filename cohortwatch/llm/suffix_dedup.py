"""Removal of repeated byte strings: shard Burrows-Wheeler transforms merged per anchor.

Every byte covered by a ``WINDOW``-byte string that also starts anywhere else, in the same
document or another, is removed. The collection is never sorted as a whole:

1. Anchors. In each window the least hash among its ``GRAM``-byte grams, the rightmost of
   equal ones, is the window's anchor. Equal windows have equal anchors at the same
   place, so windows that may be equal meet under their anchor's hash. Neighbouring
   windows of one anchor form a piece, the bytes from the first window's start to the
   last one's end; its row carries two hashes and no text.
2. Equal pieces are counted before any text moves: all windows of a piece that occurs
   twice are repeated, and copies of a document, however many, shrink to counts.
3. Anchors with several different pieces need their bytes: one text of each piece is
   read and the pieces are dealt by anchor into bounded groups. In a group, the pieces'
   windows that occur twice are the repeated intervals of the merge of the shards' transforms
   (see ``bwt_merge``).
4. An anchor with more than ``GROUP_PIECES`` different pieces (a passage that very many
   documents share, at the edge where they part) is resolved by counting hashes of ever
   smaller ranges of windows, which combines before the shuffle and gathers nothing.
5. Repeated windows go back to all places of their pieces, and the bytes that they cover
   are cut from each document.

All windows are judged on the input.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.llm.bwt_merge import repeated
from cohortwatch.llm.common import importable, map_arrow, stored, table
from cohortwatch.llm.shingles import _BASE, _Tables, mixed

WINDOW = 400
GRAM = 64
# Longest stretch of a document whose anchors are found at once, in windows.
STRETCH = 1 << 22
PLACE_BITS = 23
GROUP_BYTES = 1_500_000
GROUP_PIECES = 2000
# Widths of the ranges in which the windows of crowded anchors are compared, the last one a window each.
CROWD_WIDTHS = (64, 16, 4, 1)
BROADCAST_IDS = 200_000
ANCHORS = "key long, piece long, doc_id long, text_hash long, first int, last int, times int"


class RollingHash:
    """Hashes of all stretches of one length of a byte string, from prefix sums."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = _Tables.upto(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[end] - self.prefix[start]) * self.down[start] + (end - start).astype(np.uint64) * np.uint64(_BASE))

    def every(self, width: int) -> np.ndarray:
        n = len(self.prefix) - width
        return mixed((self.prefix[width:] - self.prefix[:n]) * self.down[:n] + np.uint64(width * _BASE % (1 << 64)))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: running minima of blocks, forwards and backwards."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def pieces(data: np.ndarray, rolling: RollingHash, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, piece hash, first window, last window) of a document's pieces, in order."""
    n = len(data) - window + 1
    if n < 1:
        none = np.zeros(0, dtype=np.uint64)
        return none, none, none.astype(np.int64), none.astype(np.int64)
    grams = rolling.every(gram)
    wide = window - gram + 1
    anchor, first = [], []
    for lo in range(0, n, STRETCH):
        hi = min(n, lo + STRETCH)
        part = grams[lo:hi + wide - 1]
        place = np.uint64((1 << PLACE_BITS) - 1) - np.arange(len(part), dtype=np.uint64)
        least = sliding_min((part >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | place, wide)
        at = np.concatenate([[0], np.flatnonzero(np.diff(least)) + 1])
        first.append(at + lo)
        anchor.append((np.uint64((1 << PLACE_BITS) - 1) - (least[at] & np.uint64((1 << PLACE_BITS) - 1))).astype(np.int64) + lo)
    start = np.concatenate(first)
    last = np.append(start[1:], n) - 1
    where = np.concatenate(anchor)
    # the anchor's place in the piece is part of the piece's identity through its bytes
    return grams[where], rolling.of(start, last + window), start, last


def text_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def joined_spans(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Union of intervals as maximal runs."""
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    cut = np.flatnonzero(start[1:] > reach[:-1]) + 1
    return list(zip(start[np.append(0, cut)].tolist(), reach[np.append(cut - 1, len(start) - 1)].tolist()))


def anchor_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Pieces of every document; pieces that a document repeats come once, with ``times`` 2,
    and their other places as rows without a key (a repeated stretch of windows)."""
    def scanned(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("key", "piece", "doc_id", "text_hash", "first", "last", "times")}
        for doc_id, text_hash, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text")]):
            data = text_bytes(text)
            if len(data) < window:
                continue
            key, piece, first, last = pieces(data, RollingHash(data), window, gram)
            _, once, which, times = np.unique(piece, return_index=True, return_inverse=True, return_counts=True)
            again = np.ones(len(piece), dtype=bool)
            again[once] = False
            spans = joined_spans(first[again], last[again] + 1)
            keep = ~again
            out["key"] += key[keep].view(np.int64).tolist() + [None] * len(spans)
            out["piece"] += piece[keep].view(np.int64).tolist() + [None] * len(spans)
            out["first"] += first[keep].tolist() + [a for a, _ in spans]
            out["last"] += last[keep].tolist() + [b - 1 for _, b in spans]
            out["times"] += np.minimum(times[which[keep]], 2).tolist() + [2] * len(spans)
            rows = int(keep.sum()) + len(spans)
            out["doc_id"] += [doc_id] * rows
            out["text_hash"] += [text_hash] * rows
        return out

    return stored(map_arrow(docs, scanned, ANCHORS), "anchors")


def keyed_docs(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text): the two first name a row up to equal texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def piece_texts(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(key, piece, body) of the ``wanted`` pieces (key, piece, doc_id, text_hash, first, last), cut from one text each."""
    by_doc = wanted.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("key", "piece", "first", "last")).alias("cuts"))
    by_doc = stored(by_doc, "cuts")
    side = F.broadcast(by_doc.select("doc_id", "text_hash")) if by_doc.count() <= BROADCAST_IDS else by_doc.select("doc_id", "text_hash")
    # only texts that are needed are dealt
    texts = docs.join(side, _same_doc(docs, side), "left_semi")
    met = texts.join(by_doc, _same_doc(texts, by_doc)).select("cuts", "text")

    def cut(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"key": [], "piece": [], "body": []}
        for cuts, text in zip(batch.column("cuts").to_pylist(), batch.column("text").to_pylist()):
            data = text_bytes(text).tobytes()
            for c in cuts:
                out["key"].append(c["key"])
                out["piece"].append(c["piece"])
                out["body"].append(data[c["first"]:c["last"] + window])
        return out

    return map_arrow(met, cut, "key long, piece long, body binary")


def _same_doc(a: DataFrame, b: DataFrame) -> F.Column:
    return a["text_hash"].eqNullSafe(b["text_hash"]) & a["doc_id"].eqNullSafe(b["doc_id"])


def resolve_group(window: int):
    """Repeated windows of a group's pieces, as intervals (low, high) of windows in the piece."""
    def found(group: pa.Table) -> pa.Table:
        bodies = {(k, p): b for k, p, b in zip(*[group.column(c).to_pylist() for c in ("key", "piece", "body")])}
        names = sorted(bodies)
        out: dict[str, list] = {"key": [], "piece": [], "low": [], "high": []}
        for (k, p), many in zip(names, repeated([bodies[x] for x in names], window)):
            edge = np.flatnonzero(np.diff(many.astype(np.int8), prepend=0, append=0))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                out["key"].append(k)
                out["piece"].append(p)
                out["low"].append(a)
                out["high"].append(b - 1)
        return pa.table(out, schema=pa.schema([("key", pa.int64()), ("piece", pa.int64()), ("low", pa.int32()), ("high", pa.int32())]))

    return found


def split_ranges(width: int, window: int, gram: int):
    """The windows of a piece in ranges of ``width`` places before the anchor, each with two hashes.

    A window is named by the anchor's place in it, so equal windows of different pieces fall
    into the same range. ``whole`` is the hash of all bytes of the range's windows, ``core``
    of the bytes that any window of the range holds.
    """
    def made(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("key", "piece", "at", "low", "high", "near", "far", "whole", "core")}
        for key, piece, near, far, body in zip(*[batch.column(c).to_pylist() for c in ("key", "piece", "near", "far", "body")]):
            data = np.frombuffer(body, dtype=np.uint8)
            rolling = RollingHash(data)
            grams = rolling.every(gram)[:window - gram + 1]
            anchor = int(np.flatnonzero(grams.view(np.int64) == key)[-1])
            near, far = max(near, anchor - (len(data) - window)), min(far, anchor)
            at = np.arange(near // width, far // width + 1) * width
            lo, hi = np.maximum(at, near), np.minimum(at + width - 1, far)
            out["at"].append(at)
            out["near"].append(lo)
            out["far"].append(hi)
            out["low"].append(anchor - hi)
            out["high"].append(anchor - lo)
            out["whole"].append(rolling.of(anchor - hi, anchor - lo + window).view(np.int64))
            out["core"].append(rolling.of(anchor - at, anchor - at + window - width + 1).view(np.int64) if width < window else np.zeros(len(at), dtype=np.int64))
            out["key"].append(np.full(len(at), key))
            out["piece"].append(np.full(len(at), piece))
        return {c: np.concatenate(v) if v else [] for c, v in out.items()}

    return made


def resolve_crowded(bodies: DataFrame, window: int, gram: int) -> DataFrame:
    """The same as ``resolve_group`` for pieces of crowded anchors, by counts of hashes only.

    Ranges of windows shrink from level to level. A range whose bytes occur twice is
    repeated as a whole; of different ranges with a common core one each goes on to the
    next level; a range whose core no other has holds no repeated window. At the last
    level a range is one window. Counts combine before the shuffle, and a piece costs a few
    rows a level, not one for each window.
    """
    rows = "key long, piece long, at int, low int, high int, near int, far int, whole long, core long"
    todo = bodies.select("key", "piece", "body", F.lit(0).alias("near"), F.lit(window).alias("far"))
    hits = None
    for width in CROWD_WIDTHS:
        parts = stored(map_arrow(todo, split_ranges(width, window, gram), rows), "ranges")
        same = ["key", "at", "near", "far", "whole"]
        kinds = stored(parts.groupBy(*same, "core").agg(F.min("piece").alias("one"), F.count("*").alias("n")), "kinds")
        twice = parts.join(kinds.where("n > 1").select(*same), same, "left_semi").select("key", "piece", "low", "high")
        hits = twice if hits is None else hits.unionByName(twice)
        if width == 1:
            return hits
        cores = kinds.groupBy("key", "at", "core").agg(F.count("*").alias("n")).where("n > 1").select("key", "at", "core")
        left = kinds.join(cores, ["key", "at", "core"], "left_semi").select("key", F.col("one").alias("piece"), "near", "far")
        todo = left.join(bodies, ["key", "piece"])
    return hits


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_hash, start, end): stretches of bytes covered by repeated windows, for ``keyed_docs``."""
    importable(docs.sparkSession)
    rows = anchor_rows(docs, window, gram)
    inside = rows.where("key is null").select("doc_id", "text_hash", F.col("first").alias("start"), (F.col("last") + window).alias("end"))
    rows = rows.where("key is not null")
    one = F.min(F.struct("doc_id", "text_hash", "first", "last")).alias("one")
    kinds = rows.groupBy("key", "piece").agg(F.sum("times").alias("times"), one)
    kinds = stored(kinds, "pieces")
    # anchors under which anything may repeat, with the number of their different pieces
    keys = kinds.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1")
    mixed_kinds = kinds.join(keys, "key", "left_semi").select("key", "piece", "one.*")
    bodies = stored(piece_texts(docs, mixed_kinds, window), "bodies")
    crowded = stored(keys.where(F.col("kinds") > GROUP_PIECES).select("key"), "crowded")
    plain = bodies.join(F.broadcast(crowded), "key", "left_anti") if crowded.count() <= BROADCAST_IDS else bodies.join(crowded, "key", "left_anti")
    size = plain.agg(F.sum(F.length("body")).alias("n")).first()["n"] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    group = F.pmod(F.xxhash64("key"), F.lit(groups)).alias("group")
    found = plain.select(group, "key", "piece", "body").groupBy("group").applyInArrow(resolve_group(window), "key long, piece long, low int, high int")
    if not crowded.isEmpty():
        found = found.unionByName(resolve_crowded(stored(bodies.join(crowded, "key", "left_semi"), "crowd"), window, gram))
    whole = kinds.where("times > 1").select("key", "piece", F.lit(0).alias("low"), (F.col("one.last") - F.col("one.first")).cast("int").alias("high"))
    hits = stored(found.unionByName(whole), "hits")
    places = rows.select("key", "piece", "doc_id", "text_hash", "first")
    spans = places.join(hits, ["key", "piece"]).select(
        "doc_id", "text_hash", (F.col("first") + F.col("low")).alias("start"), (F.col("first") + F.col("high") + window).alias("end"))
    return spans.unionByName(inside)


def cut_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept, kept_text of every row of ``keyed_docs``."""
    by_doc = spans.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    met = docs.join(by_doc, _same_doc(docs, by_doc), "left").select(docs["doc_id"], docs["text"], by_doc["spans"])

    def kept(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"doc_id": batch.column("doc_id"), "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "n_kept": [], "kept_text": []}
        lists = batch.column("spans")
        for i, text in enumerate(batch.column("text").to_pylist()):
            data = text_bytes(text).tobytes()
            flat = lists[i].values
            runs = [] if flat is None or not len(flat) else joined_spans(flat.field("start").to_numpy(), flat.field("end").to_numpy())
            left, at = [], 0
            for a, b in runs:
                left.append(data[at:a])
                at = b
            rest = b"".join([*left, data[at:]])
            out["n_bytes"].append(len(data))
            out["n_removed"].append(len(data) - len(rest))
            out["n_spans"].append(len(runs))
            out["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
            out["n_kept"].append(len(rest))
            # a character that lost some of its bytes goes as a whole
            out["kept_text"].append(rest.decode("utf-8", "ignore") if runs else text or "")
        return out

    return map_arrow(met, kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_kept long, kept_text string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept, kept_text of every row of ``docs`` (doc_id, text).

    ``window`` is a multiple of 40 and at least ``gram`` + 1. Null texts count as empty;
    texts shorter than the window lose nothing; repeated rows count as repeats of each
    other; a null doc_id is a row like others. Windows are compared by 64-bit hashes of
    their pieces and symbols. Other columns are ignored, whatever their names; a text of any
    length is read whole. ``kept_text`` holds the remaining bytes as text, without characters of
    which a part was removed. An empty table gives an empty one.
    """
    rows = keyed_docs(docs)
    return cut_spans(rows, repeated_spans(rows, window, gram))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that belong to 400-byte strings found elsewhere."""
    return remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
