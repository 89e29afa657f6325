"""Vectors, SimHash, substrings and components against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from panelcast.llm import components, simhash, substrings, vectors


def classes(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(0, i) for i in range(300, 340)]
    edges += [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = classes(500, edges)
    assert all(found.get(i, i) == expected[i] for i in range(500))


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    rows = [c + rng.normal(scale=s, size=16) for c in centres for s in (0, 0, 0.15, 0.2, 0.25)]
    rows = [[float(np.float32(x)) for x in r] for r in rows]
    rows += [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, rows[0][:8], [x * 1e-30 for x in rows[5]]]
    ids = list(range(len(rows)))
    table = spark.createDataFrame([(i, r, "x") for i, r in zip(ids, rows)], "vec_id long, embedding array<float>, label string")
    usable = [r is not None and len(r) > 0 and None not in r and np.isfinite(r).all() and any(r) for r in rows]
    # what is stored is single precision
    stored = [np.array(r, np.float32).astype(float) if u else None for r, u in zip(rows, usable)]
    links = [
        (i, j) for i in ids for j in ids[:i]
        if usable[i] and usable[j] and len(rows[i]) == len(rows[j])
        and stored[i] @ stored[j] / np.linalg.norm(stored[i]) / np.linalg.norm(stored[j]) >= 0.95
    ]
    expected = classes(len(rows), links)
    degree = [sum(i in link for link in links) for i in ids]
    # small cells and squares, so that copies to other cells and cut cells take part
    found = {r.vec_id: r for r in vectors.near_vectors(table, home=30, members=40).collect()}
    assert len(links) > 20
    assert [(found[i].n_links, found[i].component_id, found[i].kept) for i in ids] == [
        (degree[i], expected[i], expected[i] == i) for i in ids
    ]


def test_vectors_repeated_null_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(7, [1.0, 0.0]), (7, [1.0, 0.0]), (None, [1.0, 0.0]), (None, None), (9, None)]
    found = vectors.near_vectors(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in found) == [
        ("7", 2, "7", True), ("7", 2, "7", True), ("9", 0, "9", True), ("None", 0, "None", True), ("None", 2, "7", False),
    ]
    assert vectors.near_vectors(spark.createDataFrame([], schema)).count() == 0


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def texts(n, seed=3):
    rng = random.Random(seed)
    words = ["word%d" % i for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randrange(2, 300))] for _ in range(n // 3)]
    out = []
    for b in base:
        out.append(" ".join(b))
        for _ in range(2):
            other = list(b)
            other[rng.randrange(len(b))] = rng.choice(words)
            out.append("  ".join(other).upper())
    return out


@pytest.mark.parametrize("run", [8192, 3])
def test_simhash_equals_brute_force(spark, docs, monkeypatch, run):
    monkeypatch.setattr(simhash, "RUN", run)
    all_texts = [None, "", " \n", "one", "One", "é É", "a b", "x " * 5000, *texts(90)]
    rows = [(i + 10, t) for i, t in enumerate(all_texts)]
    prints = [fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    expected = classes(len(rows), links)
    found = {r.doc_id: r for r in simhash.near_duplicates(docs(rows)).collect()}
    assert any(e != i for i, e in enumerate(expected[8:], 8))
    assert [(found[i + 10].fingerprint, found[i + 10].component_id) for i in range(len(rows))] == [
        (f"{p:016x}", e + 10) for p, e in zip(prints, expected)
    ]


def test_gray_index_equals_brute_force():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 30, dtype=np.int64).view(np.uint64)
    fp = np.unique([int(base[rng.integers(30)]) ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 6)))) for _ in range(900)]).astype(np.uint64)
    rank = simhash.gray_rank(fp)
    fp = fp[np.argsort(rank)]
    # neighbours in Gray rank differ by one step of the code: the rank's inverse gives the code back
    assert (np.sort(rank) ^ (np.sort(rank) >> np.uint64(1)) == fp).all()
    index = simhash.GrayIndex(fp, np.zeros(1, np.int64))
    a, b = index.search(fp, np.zeros(len(fp), np.int64), 3)
    assert set(zip(a.tolist(), b.tolist())) == set(zip(*[x.tolist() for x in np.nonzero(np.bitwise_count(fp[:, None] ^ fp) <= 3)]))


def test_simhash_without_rows_and_ids(spark, docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    found = simhash.near_duplicates(docs([(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (None, "z")])).collect()
    assert sorted(str(r.component_id) for r in found) == ["5", "5", "5", "None"]


def test_stage_keeps_one_of_each_fingerprint_group(spark, docs):
    """Copies with scattered edits: the stage keeps the first of each group that the operator links."""
    rng = random.Random(11)
    words = ["word%d" % i for i in range(2000)]
    rows = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randrange(60, 300))]
        for edits in (0, 0, 1, 2, 3, 8):
            other = list(base)
            for at in rng.sample(range(len(base)), edits):
                other[at] = rng.choice(words)
            rows.append((len(rows), " ".join(other)))
    prints = [fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    assert len(links) >= 12
    kept = corpus_pipeline.drop_near_duplicates(spark, docs(rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(classes(len(rows), links)))


def removed(rows, window=13):
    """(n_words, n_removed, digest) by the definition; ids that are missing come last."""
    words = [(float("inf") if i is None else i, (t or "").encode().split()) for i, t in rows]
    first = defaultdict(lambda: float("inf"))
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first[key], i)
    out = []
    for i, w in words:
        gone = {k + o for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for o in range(window)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("chunk", [1 << 20, 3000])
def test_substrings_equal_brute_force(spark, docs, chunk):
    rng = random.Random(5)
    words = ["w%d" % i for i in range(300)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows = [(3, None), (4, ""), (5, passage), (5, passage), (None, passage), (None, passage + " end"), (6, "short text"), (7, "a " * 3000)]
    for i in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 120)))
        rows.append((100 - i, text if i % 3 else f"{text}\t{passage[: rng.randrange(len(passage))]}  {text}"))
    found = substrings.drop_repeated(docs(rows).repartition(3), chunk_bytes=chunk).collect()
    assert sorted((r.n_words, r.n_removed, r.kept_sha256) for r in found) == removed(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def test_substrings_of_nothing(spark, docs):
    assert substrings.drop_repeated(docs([])).count() == 0
    assert [r.n_words for r in substrings.drop_repeated(docs([(1, None)])).collect()] == [0]


def test_estimates_lose_no_window(monkeypatch):
    """Few cells: the sketch only ever overestimates."""
    rng = random.Random(6)
    monkeypatch.setattr(substrings, "CELLS", 64)
    found = substrings._Windows([1, 2], [" ".join(rng.choice("ab") for _ in range(300)).encode() for _ in range(2)], 4)
    for row in range(substrings.ROWS):
        cells, used, times, at = substrings._sketch(found, row, 3)
        assert cells.max() < 3 * 64 and times.sum() == len(cells) and at[-1] == len(used)
        for one in np.unique(found.one):
            assert times[np.searchsorted(used, cells[found.one == one][0])] >= (found.one == one).sum()
