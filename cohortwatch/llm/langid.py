"""Language identification: averaged hashed subword embeddings with a linear softmax.

A word is cut into character n-grams with word marks, each hashed to one of ``BUCKETS``
embedding rows; a text's vector is the mean over all subwords of all its
words, and a linear softmax gives the classes. Embeddings and weights are learned
together by stochastic gradient descent in numpy, seeded, on the driver, from a
bounded sample of labelled rows:

* ``TRAIN_DOCS`` documents at most, shared evenly by the languages (documents drawn by a
  hash of doc_id and text, so that the draw does not depend on partitioning);
* of each, up to ``SEGMENTS`` windows of ``SEGMENT_WORDS`` words, spread over the text,
  and the text's own length up to that, so that short texts are learned too.

A temperature is fitted on a calibration part: the segments of an eighth of the documents,
of which training saw none (documents of equal first segments stay together). Two levels
reject a text, both reached by all but REJECT_SHARE of the calibration segments: the calibrated
score, and the share of its 3- and 4-grams that training met, less what chance allows for as few
n-grams as the text has. The second sees text that is no learned language too: calibration
segments with their letters shuffled, and those of each language against the n-grams of the
others. Where these stay below, the level is the middle of the gap. It holds for one language
as well, whose score is always 1. Texts without any letter are rejected outright (``und``).

Prediction reads whole texts. Because the model is linear, a text's logits are the sum of its
subwords' (embedding x weights) over their number, so a batch of texts becomes one array of code
points, its n-grams arrays of hashes, and their looked-up rows are added up per text; a
piece of at most ``PIECE_CHARS`` characters is held at a time. The model is BUCKETS x classes numbers and a
table of bits for the n-grams met; it does not grow with the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.llm.common import importable, map_arrow, table, text_udf

BUCKETS = 1 << 15
DIM = 16
NGRAMS = (1, 2, 3, 4)
TRAIN_DOCS = 8000
SEGMENTS = 3
SEGMENT_WORDS = 24
EPOCHS = 6
BATCH = 64
RATE = 0.5
SEED = 7
PIECE_CHARS = 400_000
# Training texts whose subwords are held as arrays at once.
BAG_TEXTS = 500
# Bits of the table of n-grams met, for each n-gram; a false meeting is one in so many.
BITS_A_GRAM = 512
UNKNOWN = "und"
REJECT_SHARE = 0.001
# Standard errors that a share of known n-grams may fall below its level by chance.
BY_CHANCE = 2.0
# Runs of letters with combining marks: no digits, signs or white space.
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Grams:
    """Hashes of one kind of subword over some texts, and the text each belongs to, in order."""

    hashes: np.ndarray
    text: np.ndarray
    long: bool


_PRIME, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_OPEN, _CLOSE = np.uint64(1), np.uint64(2)
# Whether a code point is a letter: 0 or 1, 2 where it was not asked yet.
_letter = np.full(0x110000, 2, dtype=np.uint8)


def is_letter(codes: np.ndarray) -> np.ndarray:
    found = _letter[codes]
    if (found == 2).any():
        for c in np.unique(codes[found == 2]).tolist():
            _letter[c] = LETTERS.fullmatch(chr(c)) is not None
        found = _letter[codes]
    return found == 1


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def subwords(texts: list[str]) -> list[Grams]:
    """All subwords of all words of ``texts`` (lower-cased), kind by kind: n-grams by size, then whole words longer than those.

    Words carry a mark at both ends, which n-grams of two and more characters may hold. 3- and
    4-grams are ``long``.
    """
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    at = np.flatnonzero(is_letter(codes))
    if not len(at):
        return []
    opens = np.ones(len(at), dtype=bool)
    opens[1:] = at[1:] - at[:-1] > 1
    word = np.cumsum(opens) - 1
    place = np.arange(len(at)) + 2 * word + 1
    marked = np.empty(len(at) + 2 * (word[-1] + 1), dtype=np.uint64)
    marked[place] = codes[at].astype(np.uint64) + np.uint64(3)
    starts = place[opens] - 1
    ends = np.append(starts[1:], len(marked))
    marked[starts], marked[ends - 1] = _OPEN, _CLOSE
    size = ends - starts
    ends_of_texts = np.cumsum([len(t) + 1 for t in lowered])
    text_of_word = np.searchsorted(ends_of_texts, at[opens], side="right")
    text = np.repeat(text_of_word, size)
    left = np.repeat(ends, size) - np.arange(len(marked))  # characters up to the word's end
    letter = marked > _CLOSE
    found = [Grams(mixed(marked[letter]), text[letter], False)]
    h = marked
    for n in NGRAMS[1:]:
        h = h[:-1] * _PRIME + marked[n - 1:]
        whole = left[:len(h)] >= n
        found.append(Grams(mixed(h[whole] + np.uint64(n)), text[:len(h)][whole], n > 2))
    long_words = np.flatnonzero(size > max(NGRAMS))
    if len(long_words):
        powers = np.cumprod(np.append(np.uint64(1), np.full(size.max() - 1, _PRIME)), dtype=np.uint64)
        sums = np.add.reduceat(marked * powers[left - 1], starts)
        found.append(Grams(mixed(sums[long_words] ^ _MIX), text_of_word[long_words], False))
    return found


def add_by_text(total: np.ndarray, text: np.ndarray, values: np.ndarray) -> None:
    """Add rows of ``values`` to the rows of ``total`` of their texts, which come in order."""
    if len(text):
        first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        total[text[first]] += np.add.reduceat(values, first, axis=0)


def pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """(numbers of texts, texts) with at most about PIECE_CHARS characters together; longer texts are cut between words.

    A word of more than PIECE_CHARS letters is cut as well.
    """
    rows: list[int] = []
    held: list[str] = []
    room = PIECE_CHARS
    for i, t in enumerate(texts):
        at = 0
        while t and at < len(t):
            if len(t) - at <= room:
                part = t[at:]
            elif held:
                yield rows, held
                rows, held, room = [], [], PIECE_CHARS
                continue
            else:
                part = t[at:at + PIECE_CHARS]
                if at + PIECE_CHARS < len(t):
                    end = len(part)
                    while end and LETTERS.fullmatch(part[end - 1]):
                        end -= 1
                    part = part[:end] or part
            rows.append(i)
            held.append(part)
            at += len(part)
            room -= len(part) + 1
    if held:
        yield rows, held


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def segments(text: str) -> list[str]:
    """Up to SEGMENTS windows of SEGMENT_WORDS words, spread over the text."""
    words = words_of(text)
    if not words:
        return []
    if len(words) <= SEGMENT_WORDS:
        # a short text, and its first words alone: scores must hold for a few words too
        return [" ".join(words)]
    places = np.linspace(0, len(words) - SEGMENT_WORDS, SEGMENTS).astype(int)
    sizes = (SEGMENT_WORDS, SEGMENT_WORDS // 2, SEGMENT_WORDS // 6)
    return [" ".join(words[p:p + sizes[i % len(sizes)]]) for i, p in enumerate(places)]


@dataclass
class LanguageModel:
    """Classes, logits per bucket, temperature, rejection level; bits of the 3- and 4-grams met, and the least share of them."""

    classes: list[str]
    bucket_logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0
    grams: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint8))
    least_known: float = 0.0

    def sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of whole texts: summed logits, number of subwords, of 3- and 4-grams, and of those that training met."""
        logits, n = np.zeros((len(texts), self.bucket_logits.shape[1])), np.zeros(len(texts))
        long, met = np.zeros(len(texts)), np.zeros(len(texts))
        for rows, some in pieces(texts):
            here = np.array(rows)
            for g in subwords(some):
                text = here[g.text]
                add_by_text(logits, text, self.bucket_logits[(g.hashes % np.uint64(BUCKETS)).astype(np.int64)])
                count = np.bincount(text, minlength=len(texts))
                n += count
                if g.long:
                    long += count
                    if len(self.grams):
                        met += np.bincount(text[known(self.grams, g.hashes)], minlength=len(texts))
        return logits, n, long, met

    def predict_all(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(class, calibrated score, accepted) of each text; (und, 0, False) for null and for texts without a letter."""
        if not self.classes:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        logits, n, long, met = self.sums(texts)
        some = n > 0
        p = softmax((logits / np.maximum(n, 1)[:, None] + self.bias) / self.temperature)
        best = p.argmax(axis=1)
        score = np.where(some, p.max(axis=1), 0.0)
        level = known_level(self.least_known, long)
        accepted = some & (score >= self.reject_below) & (met / np.maximum(long, 1) >= level)
        return [self.classes[k] if s else UNKNOWN for k, s in zip(best.tolist(), some.tolist())], score, accepted

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        names, score, accepted = self.predict_all([text])
        return names[0], float(score[0]), bool(accepted[0])


def known(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the n-grams' bits are set; ``bits`` has a power of two of bytes."""
    at = (hashes >> np.uint64(16)) % np.uint64(8 * len(bits))
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bits_of(hashes: np.ndarray) -> np.ndarray:
    size = 1 << max(10, (len(hashes) * BITS_A_GRAM // 8).bit_length())
    bits = np.zeros(size, dtype=np.uint8)
    at = (hashes >> np.uint64(16)) % np.uint64(8 * size)
    np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    return bits


def known_level(least: float, n: np.ndarray) -> np.ndarray:
    """The share of known n-grams that a text with ``n`` of them must have."""
    return least - BY_CHANCE * np.sqrt(least * (1 - least) / np.maximum(n, 1))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def bags(texts: list[str], long: bool = False) -> Iterator[np.ndarray]:
    """Hashes of each text's subwords, or of its 3- and 4-grams only; some texts at a time."""
    for at in range(0, len(texts), BAG_TEXTS):
        some = texts[at:at + BAG_TEXTS]
        kinds = [g for g in subwords(some) if g.long or not long]
        if not kinds:
            yield from (np.zeros(0, np.uint64) for _ in some)
            continue
        text = np.concatenate([g.text for g in kinds])
        order = np.argsort(text, kind="stable")
        hashes = np.concatenate([g.hashes for g in kinds])[order]
        for bag in np.split(hashes, np.searchsorted(text[order], np.arange(1, len(some)))):
            yield bag.copy()


def train(texts: list[str], labels: list[str], docs: list[str] | None = None, seed: int = SEED) -> LanguageModel:
    """Fit the embeddings, the softmax, the temperature and the rejection levels.

    ``docs`` names the document of each text (default: each its own); an eighth of the documents
    is the calibration part. One class gives a model that names no other; no rows give a
    model without classes, whose use predicts ``und``. With no more than two documents a class
    there is no calibration part, and every text with a letter is accepted.
    """
    classes = sorted(set(labels))
    rng = np.random.default_rng(seed)
    y = np.array([classes.index(x) for x in labels], dtype=np.int64)
    if not classes:
        return LanguageModel(classes, np.zeros((BUCKETS, 1)), np.zeros(1))
    _, of = np.unique(docs if docs is not None else [str(i) for i in range(len(texts))], return_inverse=True)
    drawn = rng.permutation(of.max() + 1)
    out = drawn[:max(len(classes), len(drawn) // 8)]
    is_out = np.isin(of, out) if len(drawn) > 2 * len(out) else np.zeros(len(texts), dtype=bool)
    held, fit = np.flatnonzero(is_out), rng.permutation(np.flatnonzero(~is_out))
    grams, least_known = known_grams(texts, y, fit, held)
    if len(classes) < 2:
        return LanguageModel(classes, np.zeros((BUCKETS, 1)), np.zeros(1), grams=grams, least_known=least_known)
    bag = [(b % np.uint64(BUCKETS)).astype(np.int32) for b in bags(texts)]
    fit = fit[[len(bag[r]) > 0 for r in fit]]
    held = held[[len(bag[r]) > 0 for r in held]] if len(held) else fit
    embedding = rng.normal(0, 0.1, (BUCKETS, DIM))
    weight, bias = rng.normal(0, 0.1, (DIM, len(classes))), np.zeros(len(classes))
    share = np.bincount(y[fit], minlength=len(classes)).astype(float)
    balance = np.where(share > 0, len(fit) / np.maximum(share, 1) / len(classes), 0.0)
    steps, step = EPOCHS * (len(fit) // BATCH + 1), 0
    for _ in range(EPOCHS):
        for start in range(0, len(fit), BATCH):
            chosen = rng.permutation(len(fit))[:BATCH] if start + BATCH > len(fit) else np.arange(start, start + BATCH)
            rows = fit[chosen]
            ids = np.concatenate([bag[r] for r in rows])
            size = np.array([len(bag[r]) for r in rows])
            at = np.repeat(np.arange(len(rows)), size)
            first = np.concatenate([[0], np.cumsum(size)[:-1]])
            mean = np.add.reduceat(embedding[ids], first, axis=0) / size[:, None]
            gap = softmax(mean @ weight + bias)
            gap[np.arange(len(rows)), y[rows]] -= 1
            gap *= balance[y[rows]][:, None]
            rate = RATE * (1 - step / steps)
            step += 1
            back = (gap @ weight.T) / size[:, None]
            weight -= rate * (mean.T @ gap) / len(rows) * 4
            bias -= rate * gap.mean(axis=0)
            np.add.at(embedding, ids, -rate * back[at] * 8)
        fit = rng.permutation(fit)
    model = LanguageModel(classes, embedding @ weight, bias, grams=grams, least_known=least_known)
    z = np.stack([model.bucket_logits[bag[r]].mean(axis=0) + bias for r in held])
    truth = y[held]
    model.temperature = calibrate(z, truth)
    p = softmax(z / model.temperature)
    right = p.argmax(axis=1) == truth
    if right.any() and is_out.any():
        model.reject_below = float(np.quantile(p.max(axis=1)[right], REJECT_SHARE))
    return model


def known_grams(texts: list[str], y: np.ndarray, fit: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, float]:
    """Bits of the 3- and 4-grams of the ``fit`` texts, and the least share of them that a text must have (see the module's text)."""
    if not len(fit):
        return np.zeros(0, np.uint8), 0.0
    own = []  # the different n-grams of each class
    for k in range(int(y.max()) + 1):
        seen: set[int] = set()
        for b in bags([texts[r] for r in fit if y[r] == k], long=True):
            seen.update(b.tolist())
        own.append(np.array(sorted(seen), dtype=np.uint64))
    grams, classes_with = np.unique(np.concatenate(own), return_counts=True)
    if not len(held) or not len(grams):
        return bits_of(grams), 0.0
    # the class that alone has the n-gram, or -1
    owner = np.full(len(grams), -1)
    for k, g in enumerate(own):
        owner[np.searchsorted(grams, g)] = k
    owner[classes_with > 1] = -1
    rng = np.random.default_rng(SEED)
    shuffled = []
    for r in held:
        letters = iter(rng.permutation([c for c in texts[r] if c != " "]).tolist())
        shuffled.append("".join(c if c == " " else next(letters) for c in texts[r]))

    def place(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(grams, found), len(grams) - 1)
        return at, grams[at] == found

    def with_chance(share: float, n: int) -> float:
        # the level that a text of n n-grams with this share just reaches
        return share + BY_CHANCE * float(np.sqrt(share * (1 - share) / n))

    clean, strange = [], []
    several = len(set(y.tolist())) > 1
    for r, found, mess in zip(held, bags([texts[r] for r in held], long=True), bags(shuffled, long=True)):
        if not len(found):
            continue
        at, met = place(found)
        clean.append(with_chance(met.mean(), len(found)))
        if several:
            strange.append(with_chance((met & (owner[at] != y[r])).mean(), len(found)))
        strange.append(with_chance(place(mess)[1].mean(), max(1, len(mess))))
    if not clean:
        return bits_of(grams), 0.0
    least, most = float(np.quantile(clean, REJECT_SHARE)), float(np.quantile(strange, 0.99))
    return bits_of(grams), min(1.0, (least + most) / 2 if most < least else least)


def calibrate(z: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least cross-entropy on held rows, by a grid in the logarithm."""
    def loss(t: float) -> float:
        p = softmax(z / t)[np.arange(len(truth)), truth]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    return float(min(np.exp(np.linspace(np.log(0.2), np.log(5), 60)), key=loss))


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_rows(docs: DataFrame, limit: int = TRAIN_DOCS) -> list[tuple[str, str, str]]:
    """(segment, lang, first segment of its document) of a bounded, repeatable draw of the learnable documents.

    The counts per language set the share to draw; rows below that share of the hash
    range are taken, so no language is gathered. Segments, not texts, reach the driver.
    """
    usable = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    # the commonest ``limit`` languages, one document each at least: the class list is bounded too
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(limit // 8).collect()}
    if not counts:
        return []
    each = max(8, limit // len(counts))
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, each / n)))])
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = usable.where(place < share[F.col("lang")]).select("lang", "text")

    def cut(batch: pa.RecordBatch) -> dict:
        out = {"first": [], "lang": [], "segment": []}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            found = segments(text)
            for s in found:
                out["first"].append(found[0])
                out["lang"].append(lang)
                out["segment"].append(s)
        return out

    rows = map_arrow(drawn, cut, "first string, lang string, segment string").collect()
    return sorted({(r["segment"], r["lang"], r["first"]) for r in rows})


def fit_languages(docs: DataFrame, limit: int = TRAIN_DOCS) -> LanguageModel:
    """Learn from text and lang of the documents that are not held out."""
    rows = training_rows(docs, limit)
    return train([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted of every row of ``docs`` (doc_id, text).

    Predictions read the whole text and nothing else. Null texts and texts without a
    letter get ``und``, score 0 and are not accepted; equal texts get equal rows;
    ties go to the class that is first in code point order; an empty table gives an
    empty one; a null doc_id is kept and not held out. A very long text is read in pieces cut
    between words. Columns other than doc_id and text are ignored, whatever their names.
    """
    def predicted(batch: pa.RecordBatch) -> dict:
        names, score, accepted = model.predict_all(batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": names, "score": score, "accepted": accepted}

    return map_arrow(docs.select("doc_id", held_out().alias("held_out"), "text"), predicted,
                     "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text the model accepts.

    Null texts and texts without a letter go; repeated rows stay or go together; without a learned
    class all rows go; an empty table gives an empty one.
    """
    importable(docs.sparkSession)

    def accepted(text: pd.Series) -> pd.Series:
        return pd.Series(model.predict_all(text.tolist())[2], dtype=bool)

    return docs.where(text_udf(accepted, "boolean")(F.col("text")))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return identify(docs, fit_languages(docs))
