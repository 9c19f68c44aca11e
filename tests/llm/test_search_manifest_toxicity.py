"""Ranked search, Merkle manifest and toxicity on small fixtures, against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from vitrine.llm import lexical, merkle, toxicity

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(items, docs, k):
    tokens = [(i, collections.Counter(t), len(t)) for i, t in ((i, terms(t)) for i, t in docs) if t]
    n, total = len(tokens), sum(x[2] for x in tokens)
    df = collections.Counter(t for _, c, _ in tokens for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, size in tokens:
            m = 75 + (25 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                found.append((-s, -1 if i is None else i))
        out += [(item, r, None if i < 0 else i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def search_docs():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["Ñandú", "東京", "É", "x1y"]
    docs = [(i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rng.randint(1, 60)))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " .,!\n"), (None, "w1 w2 w50"), (303, "W1,w2;W50"), (303, "w1 w2 w50"), docs[5], (304, "w59 " * 30_000)]
    items = [(1, docs[7][1]), (2, None), (3, "absent words"), (None, "w3 w3 w40 é"), (4, "w50 w59 ñandú Ñandú 東京"), (4, "w1"), (5, docs[8][1] + " " + docs[9][1])]
    return items, docs


def test_ranked_search_equals_brute_force(spark, monkeypatch):
    items, docs = search_docs()
    frame = spark.createDataFrame([(i, t, "a", 1, 2.0) for i, t in docs], "doc_id long, text string, terms string, n int, norm double").repartition(5)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, q int")
    want = {k: brute_search(items, docs, k) for k in (3, 20)}
    for k in (3, 20):
        got = lexical.ranked_search(asked, frame, k=k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == want[k]
    monkeypatch.setattr(lexical, "ITEMS", 3)  # several blocks of items
    assert sorted((tuple(r) for r in lexical.ranked_search(asked, frame, k=3).collect()), key=str) == want[3]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lexical.ranked_search(asked, none).count() == 0
    assert lexical.ranked_search(asked.limit(0), frame).count() == 0


def test_norm_buckets_prune_without_loss(monkeypatch):
    """Buckets below the threshold are not looked at, and what is looked at is exact."""
    rng = np.random.default_rng(2)
    size, rows = 40, 3000
    weights = rng.integers(1, 9000, size)
    sizes = rng.integers(1, 12, rows)
    words = np.concatenate([np.sort(rng.choice(size, n, replace=False)) for n in sizes])
    impact = weights[words] * rng.integers(1, 10**6, len(words))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    norms = np.array([math.sqrt(float((impact[a:b].astype(float) ** 2).sum())) for a, b in zip(ends[:-1], ends[1:], strict=True)])
    order = np.argsort(-norms)
    items = lexical.Items([np.sort(rng.choice(size, 12, replace=False)) for _ in range(5)], [rng.integers(1, 4, 12) for _ in range(5)], weights)
    best, looked = [lexical.Best(4, 0) for _ in range(5)], []
    for a in range(0, rows, 50):
        part = order[a : a + 50]
        w = np.concatenate([words[ends[i] : ends[i + 1]] for i in part])
        v = np.concatenate([impact[ends[i] : ends[i + 1]] for i in part])
        before = [x.threshold for x in best]
        lexical.search_bucket(items, best, norms[part], part, w, sizes[part], v, size)
        looked.append(any(items.norms[q] * norms[part[0]] >= t for q, t in enumerate(before)))
    assert not all(looked)
    for q in range(5):
        times = dict(zip(items.terms[q].tolist(), items.counts[q].tolist(), strict=True))
        full = [sum(times.get(t, 0) * v for t, v in zip(words[a:b].tolist(), impact[a:b].tolist(), strict=True)) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        want = sorted(((-s, i) for i, s in enumerate(full)))[:4]
        assert [(-s, i) for s, i in want] == list(zip(best[q].scores.tolist(), best[q].ids.tolist(), strict=True))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows):
    def cell(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
        return levels

    def way(levels, i):
        out = []
        for level in levels[:-1]:
            a = i // 3 * 3
            out.append(("".join(level[a:i]), "".join(level[i + 1 : a + 3])))
            i //= 3
        return out

    def leaf(r, text):
        return sha("".join(map(cell, (r[0], r[1], r[2], r[3], text))))

    by = collections.defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted((r[0] is not None, r[0] or 0, leaf(r, r[4])) for r in by[s])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        placed = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        for i, r in enumerate(placed):
            path = way(trees[s], i) + way(top, k)
            text = r[4]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(r, text)
            for a, b in path:
                node = sha(a + node + b)
            out.append((r[0], leaf(r, r[4]), trees[s][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), node, node == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows():
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "a", "a", "b", "ü", "B"]), rng.choice(["en", None]), i, f"text {i}\nline\n") for i in range(120)]
    rows += [(500, None, "en", 1, "x\n"), (None, None, None, None, None), (None, "a", "en", 1, "t\n"), (7, "lone", "", None, ""),
             (8, "", "de", 3, "\n"), rows[3], rows[3], (3, "a", "en", 3, "another"), (2**60 + 1, "a", "en", 1, "é\n" * 200_000)]
    return rows


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_equals_brute_force(spark, levels):
    rows = manifest_rows()
    frame = spark.createDataFrame([(*r, "t", 5) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int").repartition(4)
    got = merkle.manifest(frame, claimed=merkle.without_line_ends(), levels=levels)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = got.collect()
    assert sorted((tuple(r[n] for n in names) for r in found), key=str) == brute_manifest(rows)
    assert all(merkle.fold(r["leaf"], r["proof"]) == r["root"] for r in found)


def test_manifest_of_nothing_and_of_one(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.manifest(spark.createDataFrame([], schema)).count() == 0
    one = merkle.manifest(spark.createDataFrame([(1, "s", "en", 2, "ab")], schema)).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["proof"] == [] and one["verified"]
    assert one["leaf"] == sha("1:1" "1:s" "2:en" "1:2" "2:ab") and one["proof_sha256"] == sha("")


def toxic_rows():
    rng = random.Random(4)
    plain = [f"word{i}" for i in range(80)]
    bad = ["grumbling", "grumbled", "vile", "Nasty", "rotten", "hateful"]
    rows, labels = [], []
    for i in range(600):
        toxic = int(rng.random() < 0.2)
        words = rng.choices(plain, k=rng.randint(20, 60)) + rng.choices(bad, k=3 * toxic)
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, toxic))
    return rows, labels


def test_toxicity_neighbours_are_exact_and_scores_hold_out(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in rows] + [(900, None, "x", 1), (901, "", "x", 1), (902, "vile " * 60_000, "x", 1), (None, "vile rotten nasty", "x", 1), (1, rows[1][1], "x", 1)],
        "doc_id long, text string, vote string, score int").repartition(4)
    given = spark.createDataFrame([*labels, labels[0], (2, None), (4, 7), (None, 1)], "doc_id long, toxic int")
    index = toxicity.learn(docs, given, ~toxicity.held_out())
    assert {"vile", "nasty", "rotten", "hateful", "grumb~"} <= set(index.vocabulary)
    got = toxicity.score(docs, index).withColumn("held_out", toxicity.held_out()).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    # labels of held-out rows are never learned from
    learned = {i for i, _ in labels if zlib.crc32(str(i).encode()) % 5}
    assert set(index.ids.tolist()) == learned
    truth = dict(labels)
    out = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in out) >= 0.97 * len(out) and len(out) > 50
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[902]["predicted"] == 1 and by_id[None]["predicted"] == 1 and by_id[900]["predicted"] == by_id[901]["predicted"] == 0
    # every neighbour by brute force over the dense vectors
    size = len(index.vocabulary)
    dense = np.zeros((len(index.ids), size))
    at = np.repeat(np.arange(size), index.runs[:, -1] - index.runs[:, 0])
    dense[index.examples, at] = index.weights
    import pyarrow as pa

    _, term, tf, sizes = toxicity.features(pa.array([t for _, t in rows]), pa.array(index.vocabulary))
    end = 0
    for i, n in enumerate(sizes.tolist()):
        t, f, end = term[end : end + n], tf[end : end + n], end + n
        query = np.zeros(size)
        query[t] = index.vector(t, f)
        cos = dense @ query
        want = np.sort(cos[cos > 1e-12])[::-1][: toxicity.NEIGHBOURS]
        places, found = index.nearest(t, f)
        assert np.allclose(found, want) and np.allclose(cos[places], found)
        assert [e["doc_id"] for e in by_id[rows[i][0]]["evidence"]] == index.ids[places[: toxicity.EVIDENCE]].tolist()


def test_features_are_words_stems_and_repeated_stems():
    import pyarrow as pa

    names, term, tf, sizes = toxicity.features(pa.array(["Walking walked WALK walking", None, "a a"]))
    words = names.to_pylist()
    found = [(words[t], f) for t, f in zip(term.tolist(), tf.tolist(), strict=True)]
    assert sizes.tolist()[1] == 0
    assert dict(found[: sizes[0]]) == {"walking": 2, "walked": 1, "walk": 1, "walki~": 2, "walke~": 1, "walki~2": 2}
    assert dict(found[sizes[0] :]) == {"a": 2, "a~2": 2}


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.score(docs, toxicity.learn(docs, none, ~toxicity.held_out())).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.score(docs, toxicity.learn(docs, one, ~toxicity.held_out())).collect()] == [1.0, 1.0]
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.learn(empty, none, ~toxicity.held_out())).count() == 0


def test_monotone_scores_rise():
    level = toxicity.monotone(np.arange(6), np.array([0.0, 3, 0, 0, 8, 9]), np.array([10.0, 10, 10, 0, 10, 10]), 0.1)
    assert (np.diff(level) >= 0).all() and level[0] < 0.02 and 0.7 < level[-1] < 1
