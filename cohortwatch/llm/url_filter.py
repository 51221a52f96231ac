"""URL filters: longest-match rules, else naive Bayes over segmented host and path tokens.

Words. Names in a host are cut at hyphens, digits and dots, and what is left is split by
a unigram Viterbi: the split of highest product of word probabilities, where an unknown
stretch of n letters costs 10 / (N * UNKNOWN_BASE^n). Word counts come from all pages: pieces of
hyphenated names, path tokens and the seed words first; then what those leave over of
undivided names, where two registered domains have it. A name that holds a seed and a rest
(casinoqzr, freshpokerhub) is split, not learned whole; as a piece or path token it is a word only if two
domains have it. The seeds together weigh as much as all other words. Counts are over
distinct hosts, so that a host with a third of the pages counts once. The model keeps the
``LEXICON`` commonest words.

Classes. There are no labelled URLs, so seed words label the pages: a page whose words
hold a blocked seed is of class block, any other of class allow. The label's own words are
masked: multinomial naive Bayes counts all other tokens of all pages per class (host words, and
path tokens with their numbers blurred) in ``BUCKETS`` hashed cells, summed per batch before the
shuffle, so it learns the company that seeds keep and cannot give the list back. A page that no
rule fits gets the class of higher posterior, in which a seed takes the place of the prior with
log-odds of ``SEED_ODDS``: a page without any seed is blocked by its company, and one with a seed is
allowed where its company speaks against it more strongly. Tokens that were never seen say nothing.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.llm.common import map_arrow, table

# The rules of the contract, as action and host with path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# Words that mark unwanted pages.
BLOCKED_WORDS = (
    "ads", "adserver", "adult", "bet", "bets", "betting", "casino", "cialis", "crack", "escort", "gambling", "jackpot", "keygen", "loan",
    "loans", "lottery", "malware", "nude", "payday", "phishing", "pills", "poker", "porn", "replica", "roulette", "sex", "slots", "spam",
    "spyware", "torrent", "track", "tracker", "tracking", "viagra", "warez", "webcam", "xxx")
# Common words that help to split names.
PLAIN_WORDS = (
    "best", "big", "blog", "book", "books", "buy", "cheap", "city", "club", "daily", "data", "deal", "deals", "farm", "fast", "forum", "free",
    "game", "games", "get", "global", "go", "good", "guide", "health", "help", "home", "hot", "house", "info", "live", "lucky", "mail",
    "market", "media", "my", "net", "new", "news", "now", "on", "one", "online", "open", "page", "photo", "play", "post", "pro", "quick",
    "room", "sale", "school", "shop", "site", "sport", "store", "super", "the", "time", "top", "travel", "video", "web", "wiki", "win",
    "winner", "work", "world", "your", "zone")
LEXICON = 100_000
SEEDS = tuple(dict.fromkeys(PLAIN_WORDS + BLOCKED_WORDS))
# seeds long enough to mean themselves inside an unknown name; the longest first
SEED_INSIDE = re.compile("(" + "|".join(sorted((w for w in SEEDS if len(w) >= 5), key=lambda w: (-len(w), w))) + ")")
LONGEST_WORD = 24
UNKNOWN_BASE = 4
SEED_COUNT = 5.0
# Log-odds of block of a page with a blocked seed, before its other tokens: right in 99 of 100.
SEED_ODDS = math.log(99)
BUCKETS = 1 << 16
CACHE_NAMES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = re.compile(r"[a-z]+")
PATH_TOKEN = re.compile(r"[^\W_]+")
NUMBER = re.compile(r"\d+")


def url_parts(url: str = "url") -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a url column; both empty for null or without ``://``."""
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


class RuleSet:
    """Rules by host; a lookup walks the host's suffixes, so its cost does not grow with the rules."""

    def __init__(self, rules: tuple[tuple[str, str], ...]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for action, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, action))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, action) of the longest rule that fits; of equal ones the first in code point order, block before allow."""
        found, at = [], 0
        while host:
            for prefix, rule, action in self.by_host.get(host[at:], ()):
                if path.startswith(prefix):
                    found.append((-len(rule), rule, action != "block", action))
            at = host.find(".", at) + 1
            if not at:
                break
        return (best[1], best[3]) if (best := min(found, default=None)) else None


@dataclass
class Segmenter:
    """Unigram word model for names."""

    counts: dict[str, float]
    total: float = field(init=False)

    def __post_init__(self) -> None:
        self.total = max(1.0, sum(self.counts.values()))
        self.cost = {w: math.log(self.total / c) for w, c in self.counts.items() if c > 0}
        self.cache: dict[str, tuple[str, ...]] = {}

    def __reduce__(self):
        return Segmenter, (self.counts,)

    def unknown(self, n: int) -> float:
        return math.log(self.total / 10) + n * math.log(UNKNOWN_BASE)

    def split(self, name: str) -> tuple[str, ...]:
        """Words of a run of letters: the cheapest path; ties to the longer last word."""
        if name in self.cache:
            return self.cache[name]
        best, start = [0.0], [0]
        for end in range(1, len(name) + 1):
            low, at = math.inf, 0
            for s in range(max(0, end - LONGEST_WORD), end):
                c = best[s] + (self.cost.get(name[s:end]) or self.unknown(end - s))
                if c < low:
                    low, at = c, s
            best.append(low)
            start.append(at)
        words, end = [], len(name)
        while end:
            words.append(name[start[end]:end])
            end = start[end]
        found = tuple(reversed(words))
        if len(self.cache) >= CACHE_NAMES:
            self.cache.clear()
        self.cache[name] = found
        return found

    def whole(self, name: str) -> bool:
        """Whether no word is found as a part of ``name``."""
        words = self.words(name)
        return len(words) == 1 or not any(w in self.cost for w in words)

    def host_words(self, host: str) -> list[str]:
        return [w for name in LETTERS.findall(host) for w in self.words(name)]

    def words(self, name: str) -> list[str]:
        """The split, with unknown pieces cut around the seeds in them: two unknown stretches cost more than a short seed saves."""
        return [p for w in self.split(name) for p in ([w] if w in self.cost else SEED_INSIDE.split(w)) if p]


def path_tokens(path: str) -> list[str]:
    """Lower-case tokens of a path, a number blurred to #."""
    return [NUMBER.sub("#", t.lower()) for t in PATH_TOKEN.findall(path)]


def tokens(segmenter: Segmenter, host: str, path: str) -> list[str]:
    return segmenter.host_words(host) + ["/" + t for t in path_tokens(path)]


def bucket(token: str) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % BUCKETS


def weak_label(words: list[str]) -> int:
    """1 (block) if a word, or a path token, is a blocked seed."""
    return int(any(is_seed(w) for w in words))


def is_seed(token: str) -> bool:
    return token.lstrip("/") in _BLOCKED


_BLOCKED = frozenset(BLOCKED_WORDS)


@dataclass
class UrlModel:
    """Segmenter, log-odds of block per token cell, and the prior's log-odds."""

    segmenter: Segmenter
    odds: np.ndarray
    prior: float

    def score(self, host: str, path: str) -> tuple[float, list[str]]:
        """Posterior of block, and the tokens."""
        found = tokens(self.segmenter, host, path)
        start = SEED_ODDS if weak_label(found) else self.prior
        z = start + float(sum(self.odds[bucket(t)] for t in found if not is_seed(t)))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z)))), found


def domain(host: str = "host") -> F.Column:
    """Registered domain: the last two labels, three below a second level such as co.uk; else the host."""
    found = F.regexp_extract(host, r"([^.]+\.(?:ac|co|com|edu|gov|net|org)\.[a-z]{2}|[^.]+\.[^.]+)$", 1)
    return F.when(found == "", F.col(host)).otherwise(found)


def with_seeds(counts: dict[str, float]) -> Segmenter:
    """Word model in which the seeds together weigh half at least, so that a large corpus does not make them rare."""
    least = max(SEED_COUNT, sum(counts.values()) / len(SEEDS))
    return Segmenter({**counts, **{w: counts.get(w, 0.0) + least for w in SEEDS}})


def learn_words(hosts: DataFrame, paths: DataFrame, limit: int = LEXICON) -> Segmenter:
    """Word counts over distinct hosts (host, domain) and paths (path, a first and a last domain), in two rounds (see the module's text)."""
    def count(df: DataFrame, words_of: Callable[[str], Iterable[str]], sure: Callable[[str], bool]) -> dict[str, float]:
        """Counts of the words that are sure or stand in two registered domains."""
        def found(batch: pa.RecordBatch) -> dict:
            out = {"word": [], "low": [], "high": [], "sure": []}
            for text, low, high in zip(*(batch.column(i).to_pylist() for i in (0, 1, -1))):
                for word in words_of(text):
                    out["word"].append(word)
                    out["low"].append(low)
                    out["high"].append(high)
                    out["sure"].append(sure(word))
            return out

        words = map_arrow(df, found, "word string, low string, high string, sure boolean").groupBy("word").agg(
            F.count("*").alias("n"), (F.max("sure") | (F.min("low") < F.max("high"))).alias("kept")).where("kept")
        return {r["word"]: float(r["n"]) for r in words.orderBy(F.desc("n"), "word").limit(limit).collect()}

    def pieces(host: str) -> list[str]:
        return [n for label in host.split(".") if len(names := LETTERS.findall(label)) > 1 for n in names if len(n) <= LONGEST_WORD]

    def path_words(path: str) -> list[str]:
        return [w for w in LETTERS.findall(path.lower()) if 2 < len(w) <= LONGEST_WORD]

    seeds = with_seeds({})
    counts = Counter(count(hosts, pieces, seeds.whole))
    counts.update(count(paths, path_words, seeds.whole))
    first = with_seeds(dict(counts.most_common(limit)))

    def unlearned(host: str) -> list[str]:
        names = [alone[0] for label in host.split(".") if len(alone := LETTERS.findall(label)) == 1]
        return [w for name in names for w in first.words(name) if w not in first.cost and w not in SEEDS and 2 < len(w) <= LONGEST_WORD]

    # an unlearned name, or the rest of one around words, is a word if several domains have it
    counts.update(count(hosts, unlearned, lambda word: False))
    return with_seeds(dict(counts.most_common(limit)))


def learn_urls(parts: DataFrame) -> UrlModel:
    """Fit segmenter and naive Bayes on all rows of ``parts`` (host, path); block and allow start with one pseudo page each."""
    parts = parts.where(F.col("host") != "")
    hosts = parts.select("host").distinct().withColumn("domain", domain())
    shapes = parts.groupBy(F.regexp_replace("path", r"\d+", "0").alias("path")).agg(F.min(domain()).alias("low"), F.max(domain()).alias("high"))
    segmenter = learn_words(hosts, shapes)

    def counted(batch: pa.RecordBatch) -> dict:
        seen: Counter = Counter()
        for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
            words = tokens(segmenter, host, path)
            label = weak_label(words)
            seen[label, -1] += 1
            seen.update((label, bucket(w)) for w in words if not is_seed(w))
        return {"label": [k[0] for k in seen], "cell": [k[1] for k in seen], "n": list(seen.values())}

    # at most 2 * (BUCKETS + 1) rows
    cells = map_arrow(parts, counted, "label int, cell int, n long").groupBy("label", "cell").agg(F.sum("n").alias("n")).collect()
    pages, seen = np.ones(2), np.zeros((2, BUCKETS))
    for r in cells:
        if r["cell"] < 0:
            pages[r["label"]] += r["n"]
        else:
            seen[r["label"], r["cell"]] = r["n"]
    used = seen.sum(axis=0) > 0
    chance = (seen + 1) / (seen.sum(axis=1, keepdims=True) + max(1, used.sum()))
    odds = np.where(used, np.log(chance[1] / chance[0]), 0.0)
    return UrlModel(segmenter, odds, float(np.log(pages[1] / pages[0])))


def judge_urls(pages: DataFrame, model: UrlModel, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score, words of every row of ``pages`` (page_id, url).

    A null url, or one without ``://``, has an empty host and path, fits no rule and is
    judged by the prior. Equal urls get equal rows; a url of any length is read whole; columns
    other than page_id and url are ignored; an empty table gives an empty one.
    """
    rule_set = RuleSet(rules)
    host, path = url_parts()

    def judged(batch: pa.RecordBatch) -> dict:
        hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
        out = {"page_id": batch.column("page_id"), "host": hosts, "path": paths, "rule": [], "verdict": [], "score": [], "words": []}
        for h, p in zip(hosts, paths):
            score, words = model.score(h, p)
            rule = rule_set.find(h, p)
            out["rule"].append(rule[0] if rule else None)
            out["verdict"].append(rule[1] if rule else "block" if score > 0.5 else "allow")
            out["score"].append(score)
            out["words"].append(" ".join(words))
        return out

    return map_arrow(pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path")), judged,
                     "page_id long, host string, path string, rule string, verdict string, score double, words string")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url; the model learns from all pages."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    host, path = url_parts()
    return judge_urls(pages, learn_urls(pages.select(host.alias("host"), path.alias("path"))))
