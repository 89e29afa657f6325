"""Language ID, mixing, decontamination, the SQL twins and the pipeline."""

import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from check_oracle import compare, duck
from panelcast.llm import decontaminate, language, mixing, queries, sharding, sql, substrings
from panelcast.sources.sinks import materialize
from test_dedup import classes, fingerprint

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_language_on_held_out_documents(spark, data):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang").collect()}
    found = queries.op6_language(spark, data).collect()
    assert len(found) == len(truth) and all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert len(held) > 20 and sum(truth[r.doc_id] == r.lang_pred for r in held) / len(held) >= 0.95


def test_language_undetermined_and_unlearned(spark, docs):
    train = [(i, "the cat and the dog " * 3, "en") for i in range(20)] + [(i, "der hund und die katze " * 3, "de") for i in range(20, 40)]
    train += [(i, "le chien et la chatte " * 3, "fr") for i in range(40, 60)] + [(60, None, "xx"), (61, "12 34", "yy")]
    model = language.fit_documents(docs(train))
    assert model.families == {"germanic": ["de", "en"], "romance": ["fr"]}
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "²½"), (5, "the dog"), (6, "die katze"), (7, "la chatte " * 50_000), (None, "the cat")]
    found = {r.doc_id: r.lang_pred for r in language.identify(docs(rows), model, ["doc_id"]).collect()}
    assert found == {1: "und", 2: "und", 3: "und", 4: "und", 5: "en", 6: "de", 7: "fr", None: "en"}
    empty = language.fit_documents(docs([(1, "text", None)]))
    assert [tuple(r) for r in language.identify(docs([(1, "text")]), empty, ["doc_id"]).collect()] == [(1, "und", 0.0)]
    assert language.document_languages(docs([])).count() == 0
    only = language.fit_documents(docs([(i, "bonjour", "fr") for i in range(8)]))
    assert only.predict("anything")[0] == "fr"


def test_every_label_is_learned(spark, docs):
    """More labels than once were learned; the last ones by number of rows and name are found again."""
    names = [f"q{i:02d}" for i in range(70)]
    rng = random.Random(2)
    words = {n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(6)] for n in names}
    rows = [(i, " ".join(rng.choice(words[n]) for _ in range(12)), n) for i, n in enumerate(names * 9)]
    model = language.fit(docs(rows), F.col("doc_id"), dimensions=512)
    assert sorted(model.families) == names
    assert all(model.predict(" ".join(words[n]))[0] == n for n in names)


def test_sample_bound_and_clashing_names(spark, monkeypatch):
    """Equal ids, missing ids and repeated texts never exceed the bound; columns of any name do no harm."""
    drawn = []
    solve = language.map_texts
    monkeypatch.setattr(language, "map_texts", lambda rows, *a: drawn.append(rows.groupBy("lang").count().collect()) or solve(rows, *a))
    extra = ("bound", "u", "drawn", "n", "least", "sign", "family", "same", "by_key", "share", "rank", "vector")
    names = ", ".join(f"{c} string" for c in extra)
    for ids in (lambda i: 7, lambda i: None, lambda i: i):
        rows = [(ids(i), f"the cat {i} sat", "en", *extra) for i in range(400)] + [(ids(i), f"der hund {i % 50} sass", "de", *extra) for i in range(400)]
        frame = spark.createDataFrame(rows, f"doc_id long, text string, lang string, {names}")
        drawn.clear()
        model = language.fit(frame, F.col("doc_id"), per_language=60, dimensions=256)
        assert {r.lang: r["count"] for r in drawn[0]} == {"en": 60, "de": 50}
        assert model.predict("the cat")[0] == "en" and model.predict("der hund")[0] == "de"
        assert language.identify(frame, model, ["doc_id"]).count() == 800


def test_primal_and_dual_machines_agree():
    rng = np.random.default_rng(3)
    x = np.hstack([rng.normal(size=(300, 20)), np.ones((300, 1))])
    sign = np.where(x[:, 0] + rng.normal(size=300) > 0.4, 1.0, -1.0)
    w = language.fit_machine(x, sign)
    weight = 10.0 * 300 / (2 * np.where(sign > 0, (sign > 0).sum(), (sign < 0).sum()))
    slack = np.maximum(0, 1 - sign * (x @ w))
    # the gradient of the loss vanishes
    assert np.abs(w - x.T @ (weight * sign * slack)).max() < 1e-6 * np.abs(x.T @ (weight * slack)).max()


def targets(sizes, weights=(5, 2, 1)):
    """By the rule: share by weight, cap, share the excess again until nothing is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = budget - sum(2 * sizes[s] for s in capped)
        rest = sum(weight[s] for s in names if s not in capped)
        target = {s: 2.0 * sizes[s] if s in capped else left * weight[s] / rest for s in names}
        over = {s for s in names if s not in capped and target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mix(spark, docs):
    rng = random.Random(3)
    rows = [(i, "word " * rng.randrange(300), None, rng.choice(["a", "b", "b", "b", "ü", None])) for i in range(900)]
    rows += [(10_000, None, None, "a"), (10_001, "w " * 30_000, None, "b"), (10_002, "", None, "empty"), (5, "again and again", None, "a")]
    documents, schedule = mixing.mix(docs(rows))
    found = documents.collect()
    sizes, expected = defaultdict(int), {}
    for _, text, _, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    expected = targets(sizes)
    taken = defaultdict(int)
    assert len(found) == len(rows)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source], rel=1e-12)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - expected[s]) <= max(256, 0.02 * expected[s]) for s in expected)
    again, _ = mixing.mix(docs(rows).repartition(5))
    key = lambda r: (r.doc_id, r["size"], r.taken)
    assert sorted(map(key, found)) == sorted(map(key, again.collect()))
    # the schedule's stretches are what the documents give
    by_source = {r.source: r.n for r in schedule.groupBy("source").agg(F.sum(F.col("last") - F.col("first")).alias("n")).collect()}
    assert by_source == {s: n for s, n in taken.items() if n}


def point_hash(doc_id, size):
    """Spark's chained 64-bit hash of (7, id, size); a null leaves the hash as it is."""
    h = xxhash.xxh64_intdigest(struct.pack("<i", 7), seed=42)
    for value in (doc_id, size):
        if value is not None:
            h = xxhash.xxh64_intdigest(struct.pack("<q", value), seed=h)
    return h


def mixed_by_hand(rows, block=64):
    """Taken words by (source, id, size): the schedule slot by slot, the blocks word by word."""
    line, sizes = defaultdict(list), defaultdict(int)
    for doc_id, text, _, source in rows:
        size = len(WORD.findall(text or ""))
        sizes[source] += size
        line[source].append((point_hash(doc_id, size), doc_id is not None, doc_id or 0, size, doc_id))
    target = targets(sizes)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    names = [s for s in names if target[s] > 0]
    blocks = {s: -(-sizes[s] // block) for s in names}
    need = [target[s] * blocks[s] / sizes[s] for s in names]
    edges = [round(sum(need[: i + 1]) / sum(need) * 2**32) for i in range(len(need))]
    uses, rank = defaultdict(int), defaultdict(int)
    for t in range(round(sum(need))):
        point = (t * 2654435769 + 2654435769 // 2) % 2**32
        source = next(s for s, high in zip(names, edges) if high > point)
        turn, k = divmod(rank[source], blocks[source])
        rank[source] += 1
        uses[source, k] += turn < 2
    taken = Counter()
    for source in names:
        worth = [0] * sizes[source]
        for k in range(blocks[source]):
            for word in range(k * sizes[source] // blocks[source], (k + 1) * sizes[source] // blocks[source]):
                worth[word] = uses[source, k]
        start = 0
        for *_, size, doc_id in sorted(line[source], key=lambda d: d[:4]):
            taken[source, doc_id, size, sum(worth[start : start + size])] += size > 0
            start += size
    return +taken


@pytest.mark.parametrize(("least_bits", "bucket_rows"), [(10, 1 << 16), (1, 16), (1, 1 << 16)])
def test_mix_row_by_row(spark, docs, least_bits, bucket_rows):
    rng = random.Random(8)
    rows = [(i % 500 or None, "word " * rng.randrange(120), None, rng.choice(["a", "b", "b", "b", "ü", None])) for i in range(1500)]
    rows += [(None, "w w w", None, "b")] * 300 + [(7, "again " * 90, None, "a")] * 40
    documents, _ = mixing.mix(docs(rows), chunk=32, least_bits=least_bits, bucket_rows=bucket_rows)
    found = documents.collect()
    assert len(found) == len(rows)
    assert Counter((r.source, r.doc_id, r["size"], r.taken) for r in found if r["size"]) == mixed_by_hand(rows)


def test_mix_with_one_id(spark):
    """A table of one id, in few sizes: rows are counted before they are ordered, and each is there again."""
    rows = spark.range(100_000).select(
        F.lit(5).cast("long").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 3 + 1).cast("int")).alias("text"), F.lit("s").alias("source")
    )
    documents, _ = mixing.mix(rows)
    found = documents.agg(F.count("*").alias("n"), F.sum("taken").alias("taken"), F.countDistinct("start").alias("starts"), F.max(F.col("taken") / F.col("size")).alias("most")).first()
    words = 2 * 100_000 - 1  # sizes 1, 2, 3 in turn, the last row has 1
    assert (found.n, found.starts) == (100_000, 100_000) and found.most <= 2
    assert abs(found.taken - 1.5 * words) <= 256


def test_mix_without_words(spark, docs):
    assert mixing.mix(docs([]))[0].count() == 0
    found = mixing.mix(docs([(1, None, None, "a"), (2, " ", None, None)]))[0].collect()
    assert [(r["size"], r.target, r.taken) for r in found] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("bound", [8 << 20, 64])
def test_windows_and_offsets(spark, docs, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "AUTOMATON_BYTES", bound)
    item = "One two, three four five six seven eight nine ten eleven twelve"
    items = [(1, item), (2, "Short item"), (3, None), (4, "  "), (None, "no id here"), (1, "short item"), (12, "SHORT-ITEM")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    text = f"é A short   item; b. {item.upper()} twelve. NO id HERE"
    rows = [(1, text), (2, None), (3, ""), (4, "one two three four five six seven eight nine"), (None, "short item"), (5, "shortitem short"), (1, text)]
    found = decontaminate.find_windows(docs(rows), benchmark, ("doc_id", "text")).collect()
    full = next(r for r in found if r.doc_id == 1)
    assert [text[s.start : s.end] for s in full.spans] == ["short   item", item.upper(), "NO id HERE"]
    assert list(full.item_ids) == ["1", "12", "2"] and full.n_words == 21
    assert {r.doc_id: len(r.spans) for r in found} == {1: 3, 2: 0, 3: 0, 4: 0, None: 1, 5: 0}
    report = decontaminate.contamination(docs(rows), benchmark).collect()
    assert sorted((r.n_hit, r.n_items, r.contaminated) for r in report) == [(0, 0, False)] * 4 + [(2, 3, True)] + [(17, 3, True)] * 2


def test_equal_items_count_once(spark, docs, monkeypatch):
    """Rows of equal items never fill one group: each stands in one group, once."""
    monkeypatch.setattr(decontaminate, "AUTOMATON_BYTES", 100)
    items = [(1, "one item that many rows hold")] * 500 + [(None, "another one")] * 500 + [(i, f"item number {i}") for i in range(2, 12)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    groups = decontaminate._groups(benchmark)
    assert len(groups) <= 8 and sorted(map(str, (tuple(r) for g in groups for r in g.collect()))) == sorted(map(str, set(items)))
    found = decontaminate.find_windows(docs([(1, "x ONE item, that many rows hold. another one"), (2, "item number 11")]), benchmark).collect()
    assert {r.doc_id: (list(r.item_ids), len(r.spans)) for r in found} == {1: (["1"], 1), 2: (["11"], 1)}


def test_windows_of_nothing(spark, docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.contamination(docs([(1, "a b")]), empty).collect()] == [0]
    assert decontaminate.contamination(docs([]), empty).count() == 0


@pytest.mark.parametrize("name", list(sql.ORACLE_SQL))
def test_query_equals_sql(spark, data, name):
    assert compare(queries.QUERIES[name](spark, data).toPandas(), duck(data).execute(sql.ORACLE_SQL[name]).df()) == ""


def test_pipeline_stages(spark, docs, tmp_path):
    rng = random.Random(9)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu") for b in ("ra", "se", "ti", "vo", "xu")]
    passage = " ".join(rng.choice(words) for _ in range(12))
    rows = []
    for i in range(80):
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randrange(40, 90))), "en", f"s{i % 4}"))
    rows += [(200 + i, rows[i][1].upper(), "en", "s0") for i in range(10)] + [rows[3]]
    rows += [(300, f"{rows[5][1]} {passage} {rows[6][1]}", "en", "s1"), (301, "123 456", "en", "s2"), (302, None, None, None), (None, "only letters here", "en", "s1")]
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing", "sharding"]
    now, ids = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        before = now
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        if name != "sharding":
            assert now.columns == before.columns
        ids.append([r.doc_id for r in now.collect()])
    assert set(ids[0]) == {r[0] for r in rows} - {301, 302} and len(ids[0]) == len(rows) - 2
    left = [r for r in dict.fromkeys(rows) if r[0] not in (301, 302, None)]
    prints = [fingerprint(r[1]) for r in left]
    links = [(i, j) for i in range(len(left)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    groups = defaultdict(list)
    for i, c in enumerate(classes(len(left), links)):
        groups[c].append(left[i][0])
    assert sorted(ids[1], key=str) == sorted([min(g) for g in groups.values()] + [None], key=str)
    assert sorted(ids[2], key=str) == sorted((i for i in ids[1] if i != 300), key=str) and 300 in ids[1]
    assert set(ids[3]) <= set(ids[2]) and max(ids[3].count(i) for i in set(ids[3])) <= 2
    assert sorted(ids[4], key=str) == sorted(ids[3], key=str)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(ids[4])


def test_near_duplicates_with_repeated_and_null_ids(spark, docs):
    """One row of each group stays, whatever its id names elsewhere."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(1, one, "en", "s"), (0, two, "en", "s"), (1, two, "en", "s"), (None, three, "en", "s"), (None, three, "en", "t"), (None, one, "en", "u")]
    left = corpus_pipeline.drop_near_duplicates(spark, docs(rows), "").collect()
    assert sorted((str(r.doc_id), r.text) for r in left) == sorted([("1", one), ("0", two), ("None", three)])


def test_pipeline_of_nothing_and_nulls(spark, docs, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    nulls = [(None, None, None, None), (1, None, None, None), (None, "", None, None), (2, "only one", "en", None), (2, "only one", "en", None)]
    nulls += [(i, f"text number {w}", "en", "s") for i, w in enumerate(("three", "four", "five", "six", "seven"), 3)]
    for rows, left in ((nulls, {2, 3, 4, 5, 6, 7}), ([], set())):
        now = docs(rows)
        for name, stage in corpus_pipeline.STAGES[:3]:
            now = stage(spark, now, str(tmp_path))
            now = materialize(now, name)
        assert sorted(r.doc_id for r in now.collect()) == sorted(left)
        mixed = materialize(corpus_pipeline.mix_sources(spark, now, str(tmp_path)), "mixed")
        found = [r.doc_id for r in mixed.collect()]
        assert set(found) <= left and bool(found) == bool(left)
        assert sorted(r.doc_id for r in corpus_pipeline.shard(spark, mixed, str(tmp_path)).collect()) == sorted(found)


def test_whole_long_text_is_read(spark, docs):
    """A million words, of which only the last matter: nothing is cut off."""
    tail = " ".join(f"end{i}" for i in range(30))
    long = " ".join(f"w{i % 9973}x{i // 9973}" for i in range(1_000_000)) + " " + tail
    rows = docs([(1, tail, "en", "a"), (2, long, "en", "a")])
    benchmark = spark.createDataFrame([(1, tail)], "item_id long, text string")
    hit = {r.doc_id: (r.n_words, r.n_hit) for r in decontaminate.contamination(rows, benchmark).collect()}
    assert hit == {1: (30, 30), 2: (1_000_030, 30)}
    gone = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.drop_repeated(rows, with_text=False).collect()}
    assert gone == {1: (30, 0), 2: (1_000_030, 30)}
    sizes = {r.doc_id: r["size"] for r in mixing.mix(rows)[0].collect()}
    assert sizes == {1: 30, 2: 1_000_030}
    assert {r.doc_id: r["size"] for r in sharding.shard_documents(rows).collect()} == {1: len(tail) + 1, 2: len(long) + 1}
    checksum = {r.doc_id: r.text_crc32 for r in sharding.shard_documents(rows).collect()}
    assert checksum[2] == zlib.crc32(long.encode())
