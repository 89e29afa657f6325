"""Filter audit, conversation repair and context trees against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from check_oracle import compare, duck
from panelcast.llm import contexttree, conversations, filteraudit, queries, sql

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op11_filters", "op12_conversations"])
def test_sql_twins(spark, data, name):
    assert compare(queries.QUERIES[name](spark, data).toPandas(), duck(data).execute(sql.ORACLE_SQL[name]).df()) == ""


# -- filters -----------------------------------------------------------------------------------------


def failed(text):
    words = WORD.findall(text)
    return (
        len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        bool(re.search("[#$%&*|]", text)),
    )


def brute_audit(rows, labels):
    """Each order applied filter by filter to what is left."""
    texts = [(i, s or "", t or "") for i, t, s in rows]
    first = {}
    for i, _, t in texts:
        if i is not None:
            first[t] = min(i, first.get(t, i))
    docs = []
    for i, part, t in texts:
        later = i is not None and first[t] < i
        good, toxic = (any(x[0] == i and i is not None and x[k] == 1 for x in labels) for k in (1, 2))
        docs.append((part, dict(zip("ABCDE", (*failed(t), later))), good, toxic))
    out, removed_by = {}, Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        left = list(docs)
        for step, letter in enumerate(order, 1):
            here = [d for d in left if d[1][letter]]
            left = [d for d in left if not d[1][letter]]
            for part in {d[0] for d in docs}:
                mine = [d for d in here if d[0] == part]
                fails = [d for d in docs if d[0] == part and d[1][letter]]
                removed_by[part, letter] += len(mine)
                out[part, order, step] = (
                    sum(d[0] == part for d in left), len(mine), len(fails) - len(mine), sum(sum(d[1].values()) == 1 for d in fails),
                    sum(d[2] for d in mine), sum(d[3] for d in mine),
                )
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, docs, rows, labels):
    marks = spark.createDataFrame([(*x, "y") for x in labels], "doc_id long, quality int, toxic int, mask string")
    found = filteraudit.filter_interactions(docs([(i, t, "en", s) for i, t, s in rows]), marks)
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in filteraudit._COUNTS) for r in found.collect()}


def test_filter_audit_brute(spark, docs):
    rng = random.Random(5)
    texts = [
        None, "", " ", "a b", "A B C # d", "x " * 60, "w%d " * 3, " ".join(f"w{i}" for i in range(55)), " ".join(f"W{i}" for i in range(60)),
        " ".join(f"w{i}|" for i in range(51)), "é" * 300, "q " * 200_000,
    ]
    rows = [(rng.choice([None, *range(30)]), rng.choice(texts), rng.choice(["a", "b", None, ""])) for _ in range(70)]
    labels = [(rng.choice([None, *range(40)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(40)]
    assert audited(spark, docs, rows, labels) == brute_audit(rows, labels)
    assert audited(spark, docs, rows[:9], []) == brute_audit(rows[:9], [])
    assert audited(spark, docs, [], labels) == {}


def test_filter_audit_splits_copies(spark, docs):
    """A third of all rows with one text of one source and one id."""
    rows = [(7, "same text", "hot")] * 4000 + [(i, f"text {i}", "cold") for i in range(10, 60)] + [(3, "same text", None)]
    found = audited(spark, docs, rows, [(7, 1, 1)] * 5)
    assert found["hot", "EABCD", 1][:2] == (0, 4000) and found["hot", "EABCD", 1][4:6] == (4000, 4000)
    assert found["", "EABCD", 1][:2] == (1, 0) and found["cold", "ABCDE", 1][1] == 50


@given(st.lists(st.integers(0, 7), min_size=1, max_size=8), st.permutations(range(3)))
def test_removal_steps(masks, order):
    steps = filteraudit.removal_steps(np.array(masks), filteraudit.inverse_positions([order]))
    assert steps[:, 0].tolist() == [next((i for i, f in enumerate(order) if m >> f & 1), 3) for m in masks]


# -- conversations -----------------------------------------------------------------------------------


def brute_repair(rows):
    """All paths by dynamic programming over whole strings; rows are (role, text)."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}
    paths = {"": (0, "", ())}

    def better(found, state, path):
        if state not in found or path[:2] < found[state][:2]:
            found[state] = path

    def with_inserts(paths, times):
        best = dict(paths)
        for _ in range(times):
            for state, (cost, audit, out) in list(best.items()):
                for c in step[state]:
                    if c != "s":
                        better(best, step[state][c], (cost + 5, audit + "I", (*out, f"{names[c]}:")))
        return best

    seen, counts = set(), Counter()
    for role, text in rows:
        stripped = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        found = {}
        for state, (cost, audit, out) in with_inserts(paths, 3).items():
            better(found, state, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            cost += 5 * (fault == "truncated")
            for c, after in step[state].items():
                if role[:1] == c:
                    better(found, after, (cost, audit + "K", (*out, f"{role}:{text}")))
                if c != "s":
                    better(found, after, (cost + 1, audit + "R", (*out, f"{names[c]}:{text}")))
        paths = found
    paths = with_inserts(paths, 3)
    cost, audit, out = min(p for s, p in paths.items() if s in ("", "a"))
    return cost, audit, "\n".join(out), counts


def run_repair(rows):
    repair, out, most = conversations.Repair(), [], 0
    seen = set()
    for role, text in rows:
        stripped = text.strip(conversations.SPACE)
        dead = not stripped or (role, text) in seen
        seen.add((role, text))
        out += repair.push(role, text, dead, not dead and stripped[-1] not in ".!?")
        most = max(most, repair.open)
    out += repair.finish()
    return repair.cost, "".join(e[0] for e in out), "\n".join(f"{e[1]}:{e[2]}" for e in out if e[0] != "D"), most


ROLES = st.sampled_from(["system", "user", "assistant", "tool", "", " ", "summary"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ROLES, st.sampled_from(["a.", "b!", "c?", "cut", "", " ", "d. ", "e.", "f.", "g", "h"])), max_size=14))
def test_repair_brute(rows):
    assert run_repair(rows)[:3] == brute_repair(rows)[:3]


def test_repair_memory_is_bounded():
    """Survivors coalesce: the open stretch stays short however long the conversation."""
    rng = random.Random(2)
    rows = [(rng.choice(["user", "assistant", "system", "tool"]), f"{i}" + rng.choice([".", "", "!"])) for i in range(5000)]
    cost, audit, _, most = run_repair(rows)
    assert most < 200 and len(audit.replace("I", "")) == 5000
    assert (cost, audit) == brute_repair(rows[:])[:2]


def test_conversations_brute(spark):
    rng = random.Random(9)
    texts = ["Hello.", "cut off", "", None, " \t", "What?", "Yes! ", "é.", "x. " * 30_000]
    rows = [
        (rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, *range(12)]), rng.choice(["system", "user", "assistant", None, "tool"]), rng.choice(texts), "x")
        for _ in range(150)
    ] + [(100 + i, 0, "user", "hi", "x") for i in range(60)] + [(200, i, "user", "same.", "x") for i in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seen string")
    found = {r.conv_id: r for r in conversations.repair_report(conversations.damage(frame)).collect()}
    told = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        told[conv]
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        told[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    assert set(found) == set(told)
    for conv, mine in told.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        cost, audit, out, counts = brute_repair([r[1:] for r in mine])
        turns = [r[0] for r in mine if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(mine, mine[1:])]
        expected = (
            gaps, counts["blank"], counts["duplicate"], counts["truncated"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256(out.encode()).hexdigest(),
        )
        assert tuple(found[conv])[1:] == expected
    # dropped to the last row: zeros, no edits, the digest of nothing
    gone = [c for c, m in told.items() if not m]
    assert gone and all(tuple(found[c])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone)
    assert conversations.repair_report(conversations.damage(frame.limit(0))).count() == 0


def test_repair_edits_give_the_messages(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "tool", "c."), (1, 3, "user", ""), (2, 0, "assistant", "d."), (2, 1, "user", "e.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    edits = sorted(conversations.repair_edits(frame).collect(), key=lambda r: (r.conv_id, r.place))
    assert "".join(r.edit for r in edits if r.conv_id == 1) == "DKRD" and [r.place for r in edits if r.conv_id == 1] == [0, 1, 2, 3]
    assert [(r.role, r.text) for r in edits if r.conv_id == 1 and r.edit != "D"] == [("user", "b."), ("assistant", "c.")]
    assert [(r.edit, r.fault, r.turn) for r in edits if r.conv_id == 1][3] == ("D", "blank", 3)
    assert "".join(r.edit for r in edits if r.conv_id == 2) == brute_repair([r[2:] for r in rows[4:]])[1]


# -- context trees -----------------------------------------------------------------------------------


def brute_tree(texts, depth):
    """Natural logarithm of a text's probability by the definition, node by node."""
    counts = defaultdict(lambda: [0, 0])
    children = defaultdict(set)

    def decisions(text):
        data = bytes([255]) * depth + text + b"\xff"
        for i in range(depth, len(data)):
            context = data[i - depth : i][::-1]
            for j in range(8):
                yield context, (1 << j) | (data[i] >> (8 - j)), data[i] >> (7 - j) & 1

    for text in texts:
        for context, node, bit in decisions(text):
            for d in range(depth + 1):
                counts[context[:d], node][bit] += 1
                if d:
                    children[context[: d - 1], node].add(context[:d])

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    memo = {}

    def log_pw(context, node):
        key = context, node
        if key not in memo:
            own = log_kt(*counts[key]) if key in counts else 0.0
            if len(context) == depth:
                memo[key] = own
            else:
                below = sum(log_pw(c, node) for c in sorted(children[key])) if key in children else 0.0
                memo[key] = np.logaddexp(own, below) - math.log(2)
        return memo[key]

    def probability(context, node, bit, d=0):
        key = context[:d], node
        a, b = counts[key] if key in counts else (0, 0)
        kt = ((b if bit else a) + 0.5) / (a + b + 1)
        if d == depth:
            return kt
        own = math.exp((log_kt(a, b) if a + b else 0.0) - math.log(2) - log_pw(*key))
        return own * kt + (1 - own) * probability(context, node, bit, d + 1)

    return lambda text: sum(math.log(probability(*x)) for x in decisions(text))


@pytest.mark.parametrize("depth", [2, 4])
def test_context_tree_brute(spark, docs, depth, monkeypatch):
    rng = random.Random(depth)
    rows = [(i, " ".join(rng.choice(["the", "Then", "hen", "één", "a", "z" * 5]) for _ in range(rng.randrange(12)))) for i in range(40)]
    rows += [(40, None), (41, ""), (42, " \n\t "), (None, "the hen"), (None, None), (7, "again the Hen"), (50, "the\x00zero\xa0hen 漢字")]
    # several chunks, several ranges, stretches shorter than a text
    monkeypatch.setattr(contexttree, "LEAST_CHUNK", 200)
    monkeypatch.setattr(contexttree, "MOST_CHUNK", 200)
    found = contexttree.score_texts(docs(rows), depth).collect()
    words = [WORD.findall((t or "").lower()) for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    log_p = brute_tree([" ".join(w).encode() for w, h in zip(words, held) if not h], depth)
    counts = Counter(x for w, h in zip(words, held) if not h for x in [*w, None])
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (
            -1 if i is None else i, h, len(w) + 1, sum(counts[x] > 0 for x in [*w, None]), n,
            round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in [*w, None]), 8), round(log_p(" ".join(w).encode()) / math.log(10), 8),
        )
        for (i, _), w, h in zip(rows, words, held)
    )
    got = sorted((-1 if r.doc_id is None else r.doc_id, *r[1:5], round(r.base_score, 8), round(r.score, 8)) for r in found)
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=2e-7, abs=1e-8)


def test_context_tree_of_nothing(spark, docs):
    assert contexttree.score_texts(docs([])).count() == 0
    # only held-out rows: every bit is a coin
    out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = contexttree.score_texts(docs([(out, "ab")])).first()
    assert (row.n_known, row.train_tokens, row.n_bytes, row.held_out) == (0, 0, 3, True)
    assert row.score == pytest.approx(-24 * math.log10(2)) and row.bits_per_byte == pytest.approx(8) and row.base_score == 0


def test_context_codes_cross_stretches():
    rng = np.random.default_rng(3)
    words = [[bytes(rng.integers(97, 101, rng.integers(1, 9)).tolist()) for _ in range(rng.integers(0, 7))] for _ in range(50)]
    whole = [np.concatenate(x) for x in zip(*contexttree.context_codes(words, 3))]
    for stretch in (1, 2, 5, 64):
        cut = [np.concatenate(x) for x in zip(*contexttree.context_codes(words, 3, stretch))]
        assert all(np.array_equal(a, b) for a, b in zip(whole, cut))


def test_log_estimate():
    zeros, ones = np.array([0.0, 3, 20_000, 5, 1e9]), np.array([0.0, 7, 3, 16_380, 2e9])
    lg = math.lgamma
    expected = [lg(a + 0.5) + lg(b + 0.5) - lg(a + b + 1) - math.log(math.pi) for a, b in zip(zeros, ones)]
    assert contexttree.log_estimate(zeros, ones) == pytest.approx(expected, rel=1e-9, abs=1e-9)


def test_model_on_held_out_texts(spark, data):
    # 1,000 documents: on a few hundred of few distinct words the word counts are still ahead
    folder = data.replace("sf0.001", "sf0.01")
    rows = [r for r in queries.op13_contexttree(spark, folder).collect() if r.held_out]
    assert len(rows) > 10 and sum(r.score for r in rows) / sum(r.base_score for r in rows) < 1.002
    assert 1.5 < sum(r.bits_per_byte * r.n_bytes for r in rows) / sum(r.n_bytes for r in rows) < 2.2
