"""Centroid clustering, spelling variants and quality rules against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortwatch.llm import quality, shallot, variants

from .edge import DOCS, edge_docs


# -- centroid clustering ------------------------------------------------------------------

def plain_clusters(rows, k, rounds):
    """(final centroids, cluster and distance of each row) by looking at every centroid."""
    points = [[math.floor(64 * x) for x in v] for _, v in rows]
    order = sorted(range(len(rows)), key=lambda i: (hashlib.sha256(f"1:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest(), points[i]))
    cents = [points[i] for i in order[:k]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        got = [nearest(p)[1] for p in points]
        for j in range(len(cents)):
            own = [p for p, g in zip(points, got) if g == j]
            if own:
                cents[j] = [sum(x) // len(own) for x in zip(*own)]
    return cents, [nearest(p) for p in points]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as cluster", "1 as point", "2.0 as upper")


@pytest.mark.parametrize("kind", ["spread", "clumped", "tied"])
def test_shallot_equals_a_plain_scan(spark, kind):
    rng = np.random.default_rng(5)
    if kind == "spread":
        m = rng.normal(0, 0.2, (300, 64))
    elif kind == "clumped":
        m = rng.normal(0, 2, (9, 64))[rng.integers(0, 9, 300)] + rng.normal(0, 0.05, (300, 64))
    else:  # few different integers: equal distances, equal and empty centroids
        m = rng.integers(-1, 2, (300, 1)) / 64.0 * np.ones((1, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    cents, want = plain_clusters(rows, 16, 3)
    points, state = shallot.fit_clusters(vectors(spark, rows))
    got = {r["vec_id"]: (r["distance"], r["cluster"]) for r in state.collect()}
    assert points.tolist() == cents and [got[i] for i in range(len(rows))] == want
    out = shallot.cluster_vectors(vectors(spark, rows)).collect()
    assert {r["inertia"] for r in out} == {sum(d for d, _ in want)}
    assert {r["cluster"]: r["cluster_inertia"] for r in out} == {j: sum(d for d, c in want if c == j) for j in {c for _, c in want}}
    assert all(r["centroid_sha256"] == hashlib.sha256(",".join(map(str, cents[r["cluster"]])).encode()).hexdigest() for r in out)
    if kind == "clumped":  # the bounds spare most of the 16 distances
        assert sum(r["scanned"] for r in out) / len(out) < 8


def test_shallot_bounds_hold_when_centroids_move(spark):
    """The state of each pass bounds the true distances, so that nothing is skipped wrongly."""
    rng = np.random.default_rng(9)
    points = rng.integers(-40, 40, (500, 64))
    before = points[:16].copy()
    state = {"cluster": np.zeros(500, int), "second": np.ones(500, int), "upper": np.full(500, np.inf), "lower": np.zeros(500)}
    cents = shallot.Centroids(before, np.zeros(16))
    for _ in range(4):
        best, other, d1, d2, _ = cents.search(points, state["cluster"], state["second"])
        every = ((points[:, None] - cents.points[None]) ** 2).sum(2)
        order = np.argsort(every, axis=1, kind="stable")
        assert (best == order[:, 0]).all() and (d1 == every.min(axis=1)).all() and (d2 == np.sort(every, axis=1)[:, 1]).all()
        after = np.stack([points[best == j].sum(axis=0) // max(1, (best == j).sum()) if (best == j).any() else cents.points[j] for j in range(16)])
        cents = shallot.Centroids(after, shallot.above(shallot.squared(after, cents.points)))
        upper, lower = shallot.above(d1) + cents.moved[best], shallot.below(d2) - cents.others[best]
        every = np.sqrt(((points[:, None] - after[None]) ** 2).sum(2))
        own = every[np.arange(500), best]
        every[np.arange(500), best] = np.inf
        assert (own <= upper).all() and (every.min(axis=1) >= lower).all()
        state["cluster"], state["second"] = best, other


def test_shallot_awkward_vectors(spark):
    v = [0.5] * 64
    rows = [(1, v), (1, v), (None, [0.25] * 64), (2, None), (3, []), (4, [0.5] * 63), (5, [float("nan")] + v[1:]), (6, [float("inf")] + v[1:]),
            (7, [None] + v[1:]), (8, [1e300] + v[1:]), (9, [-0.001] * 64)]
    out = shallot.cluster_vectors(vectors(spark, rows))
    cents, want = plain_clusters([rows[0], rows[1], rows[2], rows[10]], 16, 3)
    got = sorted(((r["vec_id"] or 0, r["distance"], r["cluster"]) for r in out.collect()))
    assert got == sorted((i, d, c) for i, (d, c) in zip([1, 1, 0, 9], want))
    assert shallot.cluster_vectors(vectors(spark, rows).limit(0)).collect() == []
    one = shallot.cluster_vectors(vectors(spark, rows[:1])).collect()
    assert [(r["cluster"], r["distance"], r["inertia"]) for r in one] == [(0, 0, 0)]


# -- spelling variants --------------------------------------------------------------------

def plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def plain_variants(rows):
    n = plain_words(rows)
    out = {}
    for w in n:
        near = [x for x in n if one_edit(w, x)]
        form = min(near, key=lambda x: (-n[x], x), default=None)
        if form is not None and n[form] < 10 * n[w]:
            form = None
        out[w] = [form, None, n[w], len(near), n[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def got_variants(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def damaged_texts(seed, shared=""):
    """Words of several lengths with edits at every place, some of them a hundred times as frequent as others."""
    rng = random.Random(seed)
    letters = "abcdeé\u00ff\u00d7"
    words = [shared + "".join(rng.choices(letters[:3], k=rng.randint(7, 10))) for _ in range(60)]
    rows = []
    for i in range(400):
        text = []
        for _ in range(30):
            w = words[min(59, int(rng.expovariate(0.1)))]
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                at = rng.randrange(len(w) + 1)
                w = rng.choice([w[:at] + rng.choice(letters) + w[at:], w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at + 1:]])
            text.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("crowd", [4096, 3])
def test_variants_equal_all_pairs(spark, crowd):
    rows = damaged_texts(1) + damaged_texts(2, "stampede") + [(None, "Übergröße Übergröße übergröße"), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as word", "1 as n", "'k' as key", "'r' as rest")
    want = plain_variants(rows)
    assert got_variants(variants.group_variants(df, crowd=crowd)) == want
    assert sum(v[3] for v in want.values()) > 500 and sum(v[0] is not None for v in want.values()) > 20


def test_variant_chains_end_at_their_root(spark):
    """Forms of forms: each ten times as frequent as the one before."""
    chain = ["abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk"]
    rows = [(i, w) for w, n in zip(chain, (2, 25, 300, 3100)) for i in range(n)]
    got = got_variants(variants.group_variants(spark.createDataFrame(rows, "doc_id long, text string"), damage=1 << 40))
    assert [got[w][0] for w in chain] == [*chain[1:], None] and {got[w][1] for w in chain} == {chain[-1]}


def test_variants_awkward_rows(spark):
    df = edge_docs(spark)
    assert got_variants(variants.group_variants(df)) == plain_variants([(r[0], r[1]) for r in DOCS])
    assert variants.group_variants(df.limit(0)).collect() == []


# -- quality rules ------------------------------------------------------------------------

WORDS13 = re.compile("[^\\x20\\x09-\\x0D]+")


def plain_repeats(words):
    spots = defaultdict(list)
    for i in range(len(words) - 4):
        spots[tuple(words[i:i + 5])].append(i)
    return len({j for p in spots.values() if len(p) > 1 for i in p for j in range(i, i + 5)})


def plain_base(text):
    text = text or ""
    words = WORDS13.findall(text)
    lines = [x for x in text.split("\n") if WORDS13.search(x)]
    repeats = plain_repeats(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeats,
            len(words) < 10 or 100 * repeats > 20 * len(words))


def jensen_shannon(p, q):
    part = lambda a, b: a * math.log2(2 * a / (a + b)) if a > 0 else 0.0
    return math.sqrt(max(0.0, sum(part(a, b) + part(b, a) for a, b in zip(p, q)) / 2))


def plain_quality(rows):
    """doc_id, base counts and kept, distances by counting everything in dictionaries."""
    def classes(text):
        kinds = [regex.compile(k).findall for k in (r"\p{Lu}", r"\p{Nd}", r"[.,;:!?()\"'-]", r"[\x20\x09-\x0D]", r"[^\p{Lu}\P{L}]")]
        upper, digits, points, spaces, lower = (len(k(text)) for k in kinds)
        return [upper, digits, points, len(text) - upper - digits - points - spaces - lower, spaces, lower]

    plain = lambda text: [w.lower().strip(quality.PUNCTUATION) for w in WORDS13.findall(text)]
    total, words = defaultdict(lambda: [0] * 6), defaultdict(Counter)
    for _, text, lang in rows:
        if text and lang is not None:
            total[lang] = [a + b for a, b in zip(total[lang], classes(text))]
            words[lang].update(plain(text))
    refs = {}
    for lang, n in words.items():
        size = sum(n.values())
        if size >= quality.REFERENCE_WORDS:
            top = sorted((w for w in n if w), key=lambda w: (-n[w], w))[:quality.COMMON]
            refs[lang] = (size, [c / max(1, sum(total[lang])) for c in total[lang]], top, [n[w] / size for w in top])
    largest = sorted(refs.items(), key=lambda x: (-x[1][0], x[0]))[:quality.LARGEST]
    out = []
    for doc_id, text, lang in rows:
        text = text or ""
        base = plain_base(text)
        against = [refs[lang]] if lang in refs else [r for _, r in largest]
        own, found = classes(text), plain(text)
        shares, n = [c / max(1, len(text)) for c in own], Counter(found)
        rest = lambda p: [*p, max(0.0, 1 - sum(p))]
        by_class = min((jensen_shannon(shares, r[1]) for r in against), default=None) if len(text) >= quality.MIN_CHARS else None
        by_word = min((jensen_shannon(rest([n[w] / max(1, len(found)) for w in r[2]]), rest(r[3])) for r in against), default=None) if len(found) >= quality.MIN_WORDS else None
        limit = lambda level, bins, size: math.sqrt(level ** 2 + bins / (8 * math.log(2) * max(1, size)))
        far = (by_class or 0) > limit(quality.CLASS_LIMIT, 6, len(text)) or (by_word or 0) > limit(quality.WORD_LIMIT, quality.COMMON + 1, len(found))
        out.append((doc_id, *base, not base[-1] and not far, by_class, by_word))
    return out


def shown(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=str)


def test_quality_equals_plain_counts(spark, small_dir):
    table = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    extra = [(9001, table[3][1], None), (9002, table[4][1], "xx"), (9003, "a b c d e f g h i j " * 40, "en"), (9004, "ab\n" * 30 + "cd ef", "de")]
    df = spark.createDataFrame(table + extra, "doc_id long, text string, lang string")
    got = quality.quality_rules(df).collect()
    assert shown(map(tuple, got)) == shown(plain_quality(table + extra))
    assert {r["kept"] for r in got} == {True, False}


def test_quality_tells_junk_from_prose(spark):
    """Shouting, signs and word lists go; prose of every language stays."""
    folder = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{folder}/documents.parquet").join(
        spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1"), "doc_id").collect()]
    long = [r for r in rows if r[1] and 300 < len(r[1].split()) < 600][:12]
    made = {"shout": lambda t: t.upper().replace(" ", "!! "), "signs": lambda t: t.replace(" ", "*** ").replace("e", "$"),
            "list": lambda t: " | ".join(w for w in t.split() if len(w) > 6)}
    junk = [(10_000 + 100 * k + i, f(t), lang) for k, f in enumerate(made.values()) for i, (_, t, lang) in enumerate(long)]
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_rules(spark.createDataFrame(rows + junk, "doc_id long, text string, lang string")).collect()}
    assert sum(kept[r[0]] for r in junk) <= 0.05 * len(junk)
    clean = [r for r in rows if not plain_base(r[1])[-1]]
    assert sum(kept[r[0]] for r in clean) >= 0.99 * len(clean)


def test_quality_awkward_rows(spark):
    got = quality.quality_rules(edge_docs(spark)).collect()
    assert shown(map(tuple, got)) == shown(plain_quality([(r[0], r[1], r[2]) for r in DOCS]))
    assert quality.quality_rules(edge_docs(spark).limit(0)).collect() == []
    few = quality.quality_rules(edge_docs(spark).where("doc_id = 14")).collect()
    assert [(r["n_words"], r["kept"], r["class_distance"]) for r in few] == [(3, False, None)]


@given(st.lists(st.sampled_from("abc"), max_size=40))
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_repeated_words_by_every_window(spark, words):
    df = spark.createDataFrame([(words,)], "w array<string>")
    assert df.select(quality.repeated_words(F.col("w"))).first()[0] == plain_repeats(words)
