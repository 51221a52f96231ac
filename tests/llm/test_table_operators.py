"""Operators that compare rows with each other: search, fingerprints, mixing, joins, repeats."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortwatch.llm import components, mixing, multi_index, ngram_join, shingles, suffix_dedup, winnowing
from cohortwatch.llm.bwt_merge import STEP, repeated

from .edge import DOCS, edge_docs, plain_docs


@pytest.fixture(scope="module")
def docs(spark):
    return edge_docs(spark).cache()


# -- nearest neighbours -------------------------------------------------------------------

def test_multi_index_recall_and_scores(spark, small_dir):
    table = spark.read.parquet(f"{small_dir}/embeddings.parquet")
    rows = multi_index.nearest(table, table.where("vec_id % 50 = 0")).collect()
    data = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in table.collect()}
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = total = 0
    for q, found in got.items():
        score = {i: float(v @ data[q] / np.linalg.norm(v) / np.linalg.norm(data[q])) for i, v in data.items() if i != q}
        best = sorted(score, key=lambda i: (-score[i], i))[:5]
        hits += len({i for i, _ in found} & set(best))
        total += 5
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        assert all(s == pytest.approx(score[i], abs=1e-12) for i, s in found)
    assert set(got) == {i for i in data if i % 50 == 0} and hits / total >= 0.9


def test_multi_index_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [0.0, 0.0, 0.0]), (4, None), (5, [1.0, None, 0.0]), (6, [nan, 1.0, 1.0]),
            (7, [inf, 1.0, 1.0]), (8, []), (9, [1.0, 1.0]), (10, [0.0, 1.0, 0.0]), (10, [0.0, 1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (50, [1e-300, 0.0, 0.0]), (100, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as cell", "2 as shard", "3 as score")
    got = sorted(map(tuple, multi_index.nearest(df, df.where("vec_id % 50 = 0")).collect()))
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 50, 1.0), (0, 4, 10, 0.0), (50, 1, 0, 1.0), (50, 2, 1, 1.0), (50, 3, 2, 1.0), (50, 4, 10, 0.0)]
    assert multi_index.nearest(df.limit(0), df).count() == 0 and multi_index.nearest(df, df.limit(0)).count() == 0


def test_cells_are_walked_by_summed_distance():
    rng = np.random.default_rng(0)
    books = multi_index.Codebooks(rng.normal(size=(6, 4)), rng.normal(size=(5, 4)))
    sizes, v = rng.integers(0, 9, 30), rng.normal(size=8)
    a, b = books.halves(v[None, :])
    summed = (multi_index.distances(a, books.left)[0][:, None] + multi_index.distances(b, books.right)[0][None, :]).ravel()
    assert list(books.traverse(v, sizes, 10 ** 9)) == np.argsort(summed, kind="stable").tolist()
    some = list(books.traverse(v, sizes, 20))
    assert sizes[some].sum() >= 20 > sizes[some[:-1]].sum()


# -- fingerprints -------------------------------------------------------------------------

def test_winnowing_edit_and_neighbours(spark, docs, small_dir):
    table = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "") for r in table.select("doc_id", "text").collect()]
    for df, want in ((table, rows), (docs, plain_docs(DOCS))):
        order = sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1].encode()))
        edited = []
        for i, (k, text) in enumerate(order):
            half = len(text) // 2
            edited.append((k, len(text), hashlib.sha256((text[:len(text) - half] + order[(i + 1) % len(order)][1][:half]).encode()).hexdigest()))
        got = winnowing.fingerprint_documents(df).collect()
        assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == Counter(edited)
        assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    texts = spark.createDataFrame([(1, "one alone")], "doc_id long, text string")
    only = winnowing.fingerprint_documents(texts).first()
    assert only["near_next"] == 1.0 and only["edited_sha256"] == hashlib.sha256(b"one aone ").hexdigest()
    assert winnowing.fingerprint_documents(texts.limit(0)).count() == 0


def test_winnowing_positions_follow_a_plain_scan(spark):
    random.seed(4)
    words = ["ab", "cd", "ef"]
    texts = [" ".join(random.choice(words) for _ in range(n)) for n in (0, 1, 4, 5, 6, 11, 12, 13, 40, 200)] + ["same " * 50, "x" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    shown = df.select("i", winnowing.grams(df["text"]).alias("g"), winnowing.shown(winnowing.chosen(df["text"])).alias("f")).collect()
    mask = (1 << winnowing.HASH_BITS) - 1
    for r in shown:
        g = [x & mask for x in r["g"]]
        n_words = len(" ".join(w[k:k + 32] for w in texts[r["i"]].split() for k in range(0, len(w), 32)).split())
        assert len(g) == (n_words - 4 if n_words >= 5 else min(n_words, 1))
        want = []
        for s in range(max(1, len(g) - winnowing.WINDOW + 1) if g else 0):
            window = g[s:s + winnowing.WINDOW]
            low = min(window)
            at = s + max(i for i, x in enumerate(window) if x == low)
            if at not in want:
                want.append(at)
        assert r["f"] == " ".join(f"{g[a]:X}@{a}" for a in want)


def test_winnowing_guarantee(spark):
    random.seed(5)
    t = winnowing.WINDOW + winnowing.K - 1
    common = " ".join(f"c{i}" for i in range(t))
    rows = [(i, " ".join(f"{random.random():.6f}" for _ in range(random.randrange(30))) + f" {common} " + " ".join(f"{random.random():.6f}" for _ in range(random.randrange(30)))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [set(r["h"]) for r in df.select(winnowing.hashes(winnowing.chosen(df["text"])).alias("h")).collect()]
    assert all(a & b for a in sets for b in sets)


# -- mixing -------------------------------------------------------------------------------

def water(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by rounds: clamp, share the excess again, until feasible."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > most * sizes[s]]
        if not over:
            target |= {s: level * w[s] for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


def test_mix_targets_and_draw(spark, docs, small_dir):
    for df in (docs, spark.read.parquet(f"{small_dir}/documents.parquet")):
        rows = {(r["doc_id"], r["source"], r["text"]) for r in df.collect()}
        got = mixing.mix_sources(df).collect()
        assert len(got) == df.count()
        again = mixing.mix_sources(df.repartition(5)).collect()
        assert Counter(map(tuple, got)) == Counter(map(tuple, again))
        sizes = Counter()
        for r in df.collect():
            sizes[r["source"]] += len([w for w in (r["text"] or "").encode().split() if w])
        target = water(sizes)
        source = {k: s for k, s, _ in rows}
        taken = Counter()
        for r in got:
            s = source[r["doc_id"]]
            assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s], rel=1e-9)
            assert 0 <= r["taken"] <= 2 * r["size"]
            taken[s] += r["taken"]
        assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_mixed_rows_hold_the_words(spark, docs):
    words = lambda t: len((t or "").encode().split())
    want, got = Counter(), Counter()
    for r in mixing.mix_sources(docs).collect():
        want[r["doc_id"]] += r["taken"]
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns
    for r in rows.collect():
        got[r["doc_id"]] += words(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert got == +want


# -- near duplicates ----------------------------------------------------------------------

def components_by_hand(rows):
    sets = []
    for k, text in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
        sets.append((k, {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    label = {k: k for k, _ in sets if k is not None}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[i + 1:]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                low, high = sorted((find(a), find(b)))
                label[high] = low
    return Counter((k, len(s), find(k) if k is not None else None) for k, s in sets)


def planted(seed):
    """Chains of edits, crowds of near copies, common passages, short texts."""
    random.seed(seed)
    word = lambda: random.choice("abcdefgh") + random.choice("abcdefgh") + random.choice("ab")
    passage, rows = [word() for _ in range(30)], []
    for _ in range(25):
        rows.append([word() for _ in range(random.randrange(3, 40))])
        rows.append(passage + [word() for _ in range(random.randrange(5, 25))])
    base = [word() for _ in range(60)]
    for _ in range(30):
        copy = list(base)
        for _ in range(random.randrange(1, 3)):
            copy[random.randrange(60)] = "edit%d" % random.randrange(99)
        rows.append(copy)
    chain = [word() for _ in range(80)]
    for i in range(12):
        chain = chain[2:] + ["c%d" % i, "d%d" % i]
        rows.append(list(chain))
    rows += [rows[0], rows[0], ["x"], ["x"], ["x", "y"], []]
    random.shuffle(rows)
    return [(i * 3 + 1, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("short", [8, 2])
def test_jaccard_components(spark, docs, short, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHORT", short)
    monkeypatch.setattr(ngram_join, "BLOCK_PAIRS", 40)
    assert Counter(map(tuple, ngram_join.jaccard_components(docs).collect())) == components_by_hand(plain_docs(DOCS))
    rows = planted(short)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, ngram_join.jaccard_components(df).collect())) == components_by_hand(rows)


def test_jaccard_empty_and_kept(spark, docs):
    assert ngram_join.jaccard_components(docs.limit(0)).count() == 0
    kept = ngram_join.keep_one_each(docs)
    assert kept.columns == docs.columns
    lowest = {low for _, _, low in components_by_hand(plain_docs(DOCS))} - {None}
    assert {r["doc_id"] for r in kept.collect()} == lowest | {None}


def test_divide_skip_equals_counting():
    random.seed(6)
    for _ in range(400):
        universe = random.choice([10, 40, 100])
        sets = [set(random.sample(range(universe), random.randint(1, min(universe, 20)))) for _ in range(random.randint(1, 30))]
        sets += [sets[0] - {min(sets[0])} for _ in range(random.choice([0, 20]))]
        index = defaultdict(list)
        for i, s in enumerate(sets):
            for t in s:
                index[t].append(i)
        query = random.sample(range(universe), random.randint(1, min(universe, 18)))
        least = random.randint(1, len(query))
        want = sorted((i, len(s & set(query))) for i, s in enumerate(sets) if len(s & set(query)) >= least)
        assert sorted(ngram_join.divide_skip(query, dict(index), least)) == want


def test_shingles():
    assert len(shingles.shingle_set("A b\tc d e f")) == 2 and len(shingles.shingle_set("x y")) == 1
    assert not len(shingles.shingle_set(" \n")) and not len(shingles.shingle_set(None))
    assert (shingles.shingle_set("A B c") == shingles.shingle_set(" a  b\nC")).all()
    assert (shingles.shingle_set("É a") != shingles.shingle_set("é a")).any()
    long = "word%d " * 40000 % tuple(range(40000))
    assert len(shingles.shingle_set(long)) == 39996


def test_components(spark):
    path = [(i, i + 1) for i in range(40)]
    edges = spark.createDataFrame([*path, (100, 7), (200, 201), (201, 200), (5, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200}
    assert components.connected_components(edges.limit(0)).count() == 0


# -- repeated strings ---------------------------------------------------------------------

def repeats_by_hand(texts, window):
    data = [t.encode() for t in texts]
    seen = Counter(d[i:i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        cut = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - window + 1):
            if seen[d[i:i + window]] > 1:
                cut[i:i + window] = True
        kept = bytes(b for b, c in zip(d, cut) if not c)
        out.append((len(d), int(cut.sum()), int((np.diff(cut.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [2000, 2])
def test_repeats(spark, docs, crowd, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_PIECES", crowd)
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 6000)
    random.seed(7)
    base = ["".join(random.choice("ab é") for _ in range(160)) for _ in range(6)]
    texts = []
    for _ in range(40):
        t = random.choice(base)[random.randrange(60):] + "".join(random.choice("abc") for _ in range(random.randrange(60))) + random.choice(base)[:random.randrange(160)]
        texts.append(t)
    texts += ["a" * 300, "ab" * 200, texts[0], "", "short"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(900, None)], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:5] for r in suffix_dedup.remove_repeats(df, window=80, gram=33).collect()}
    assert [got[i] for i in range(len(texts))] == repeats_by_hand(texts, 80)
    assert got[900] == (0, 0, 0, hashlib.sha256(b"").hexdigest())
    rows = [r for r in plain_docs(DOCS) if len(r[1]) < 20000]
    edge = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter((k, *x) for (k, _), x in zip(rows, repeats_by_hand([t for _, t in rows], 400)))
    out = suffix_dedup.remove_repeats(edge).collect()
    assert Counter(tuple(r)[:5] for r in out) == want
    assert all(r["n_kept"] == r["n_bytes"] - r["n_removed"] and len(r["kept_text"].encode()) <= r["n_kept"] for r in out)
    assert all(hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in out if len(r["kept_text"].encode()) == r["n_kept"])


def test_repeats_clash_and_empty(spark, docs):
    got = suffix_dedup.remove_repeats(docs).collect()
    assert len(got) == len(DOCS) and {r["n_removed"] for r in got if r["doc_id"] in (7, 8)} == {len("lorem ipsum dolor sit amet ") * 4000}
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_merged_transforms_equal_counting():
    random.seed(8)
    for _ in range(80):
        window = STEP * random.choice([1, 2, 3])
        base = "".join(random.choice("ab") for _ in range(260))
        strings = []
        for _ in range(random.randint(1, 7)):
            s = list(base[random.randrange(90):][:random.randrange(200)]) if random.random() < 0.7 else [random.choice("abcd") for _ in range(random.randrange(190))]
            if s and random.random() < 0.5:
                s[random.randrange(len(s))] = "z"
            strings.append("".join(s).encode())
        seen = Counter(s[i:i + window] for s in strings for i in range(len(s) - window + 1))
        want = [[seen[s[i:i + window]] > 1 for i in range(len(s) - window + 1)] for s in strings]
        assert [x.tolist() for x in repeated(strings, window)] == want


def test_only_stretches_that_may_repeat_are_sorted(monkeypatch):
    """Windows with a symbol that occurs once are left out before the sort; short tails of stretches are no windows."""
    from cohortwatch.llm import bwt_merge
    random.seed(9)
    plain = lambda n: bytes(random.randrange(256) for _ in range(n))
    shared, near = plain(130), plain(100)
    strings = [plain(3000) + shared + plain(500) + near, plain(900) + near + shared + near, plain(4000), b""]
    sorted_ = []
    real = bwt_merge.make_shard
    monkeypatch.setattr(bwt_merge, "make_shard", lambda symbol, *rest: sorted_.append(len(symbol)) or real(symbol, *rest))
    window = 3 * STEP
    seen = Counter(s[i:i + window] for s in strings for i in range(len(s) - window + 1))
    assert [x.tolist() for x in repeated(strings, window)] == [[seen[s[i:i + window]] > 1 for i in range(len(s) - window + 1)] for s in strings]
    assert 0 < sum(sorted_) < 400
    sorted_.clear()
    assert not any(x.any() for x in repeated([plain(2000), plain(2000)], window)) and not sorted_


# -- pipeline -----------------------------------------------------------------------------

def test_pipeline_stages(spark, small_dir):
    import corpus_pipeline
    from cohortwatch.llm import bpe, secret_scan

    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    stage = dict(corpus_pipeline.STAGES)
    named = stage["language_id"](spark, docs, small_dir).cache()
    assert named.columns == docs.columns and named.count() >= 0.99 * len(rows)
    kept = stage["near_duplicates"](spark, named, small_dir).cache()
    want = components_by_hand([(r["doc_id"], r["text"] or "") for r in named.collect()])
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {low for _, _, low in want}
    clean = stage["secret_scan"](spark, kept, small_dir).cache()
    for r in clean.collect():
        assert r["text"] == secret_scan.redact(rows[r["doc_id"]]["text"], "[SECRET]") and r["n_chars"] == len(r["text"])
        assert not secret_scan.base_spans(r["text"])
    mixed = stage["mix_sources"](spark, clean, small_dir).cache()
    taken = Counter()
    for r in mixing.mix_sources(clean).collect():
        taken[r["doc_id"]] = r["taken"]
    got = Counter()
    for r in mixed.collect():
        got[r["doc_id"]] += len(r["text"].encode().split())
    assert mixed.columns == docs.columns and got == +taken
    coded = stage["bpe_codec"](spark, mixed, small_dir).collect()
    c = bpe.codec(bpe.default_vocab())
    texts = Counter((r["doc_id"], tuple(c.encode(r["text"]))) for r in mixed.collect())
    assert Counter((r["doc_id"], tuple(r["token_ids"])) for r in coded) == texts
    assert all(r["n_tokens"] == len(r["token_ids"]) and hashlib.sha256(c.decode(r["token_ids"]).encode()).hexdigest() == r["decoded_sha256"] for r in coded)


def test_pipeline_stages_on_empty_and_awkward_tables(spark, docs):
    """Each stage takes an empty table, and one with nulls, repeated rows, long texts and clashing columns."""
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)
    empty = docs.limit(0)
    for name, fn in corpus_pipeline.STAGES:
        out = fn(spark, empty, "")
        assert out.count() == 0 and (name == "bpe_codec" or out.columns == docs.columns), name
    # nothing to learn a language from: no text is accepted
    assert stage["language_id"](spark, docs.withColumn("lang", docs["lang"].substr(0, 0)).where("lang is null"), "").columns == docs.columns
    # null ids and texts without words stay; of the equal texts 4 and 5 (twice) the smallest id stays, and 7 of 7 and 8
    left = Counter(r["doc_id"] for r in stage["near_duplicates"](spark, docs, "").collect())
    assert left[None] == 1 and left[1] == left[2] == left[3] == 1 and left[4] == 1 and 5 not in left and left[7] == 1 and 8 not in left
    clean = stage["secret_scan"](spark, docs, "").collect()
    assert len(clean) == len(DOCS) and {r["n_chars"] for r in clean if r["text"] is None} == {None}
    narrow = stage["secret_scan"](spark, docs.select("doc_id", "text"), "")
    assert narrow.columns == ["doc_id", "text"] and narrow.count() == len(DOCS)
    mixed = stage["mix_sources"](spark, docs, "").collect()
    assert all(r["text"].split() for r in mixed) and {r["source"] for r in mixed} >= {"a", "b"}
    coded = stage["bpe_codec"](spark, docs.select("doc_id", "text"), "").collect()
    assert len(coded) == len(DOCS) and all(r["source"] is None for r in coded) and {r["n_tokens"] for r in coded if r["doc_id"] in (1, 2, 3)} == {0}
