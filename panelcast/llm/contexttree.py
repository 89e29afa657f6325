"""A byte-wise language model by context-tree weighting, and a word baseline beside it.

A byte is eight binary decisions, each with its own tree of contexts: the bytes before it, the
nearest first, down to ``DEPTH``.  A node holds how often its bit was 0 and 1 and weighs its own
Krichevsky-Trofimov estimate against the product of its children's weighted probabilities, so all
depths are mixed by what the training texts say about each context.  The counts are then fixed:
the probability of a text is the product of its bits' weighted probabilities, and its negative
logarithm the code length that an arithmetic coder would need.

Nothing of the corpus is held in one place.  Documents are packed in chunks; each chunk sends its
distinct contexts with their counts to ranges of contexts, a range adds them up, works out its
part of the tree and answers each chunk, and the chunk adds up its documents.  Ranges are made of
the two nearest bytes, so a subtree never crosses them; the two levels above have a fixed number
of nodes and are made from sums.  Word counts travel the same way.  Equal contexts are added up
before they are sent, so a hot source or group of copies makes no range larger.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.substrings import _unpack, pack_chunks
from panelcast.sources.sinks import intermediate_path

# Parameters: context bytes (2 to 7); bytes of a chunk at least and at most; bytes handled at once.
DEPTH, LEAST_CHUNK, MOST_CHUNK, STRETCH = 6, 8 << 20, 64 << 20, 1 << 20
# Codes that wait to be added up.
_WAITING = 2 << 20
# Chunks and ranges both grow with the root of the corpus, so that pieces stay of a useful size.
_ROOT_BYTES = 50_000
# A byte that UTF-8 never has: it ends every text and fills the contexts before its start.
BOUNDARY = 0xFF
# Documents whose checksum modulo 7 is 2 are not learned from.
HELD_OUT = (7, 2)
_U = np.uint64
_LN10 = math.log(10)


def held_out(doc_id: int | None) -> bool:
    """Whether the model does not learn from a document; one without id is learned from."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % HELD_OUT[0] == HELD_OUT[1]


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased; null has none."""
    return [] if text is None else text.lower().split()


# -- contexts ----------------------------------------------------------------------------------------


def context_codes(words: list[list[bytes]], depth: int = DEPTH, stretch: int = STRETCH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``codes`` and ``doc`` of all positions of some texts: context bytes, the nearest first, then the byte itself.

    A text is its words joined by one space and the boundary; every text starts from boundaries.
    """
    pad = bytes([BOUNDARY])
    b = np.frombuffer(b"".join(pad * depth + b" ".join(w) + pad for w in words), np.uint8)
    spans = np.array([sum(map(len, w)) + max(0, len(w) - 1) + 1 + depth for w in words], np.int64)
    ends = np.cumsum(spans)
    for start in range(0, len(b), stretch):
        stop = min(start + stretch, len(b))
        # contexts reach back over the stretch's start; before the first text there are boundaries
        low = max(0, start - depth)
        part = np.concatenate([np.full(depth - (start - low), BOUNDARY, np.uint8), b[low:stop]]).astype(_U)
        codes = part[depth:].copy()
        for k in range(1, depth + 1):
            codes |= part[depth - k : len(part) - k] << _U(8 * (depth + 1 - k))
        first, last = np.searchsorted(ends, [start, stop - 1], "right")
        docs = np.arange(first, last + 1)
        begin = ends[docs] - spans[docs]
        doc = np.repeat(docs, np.minimum(ends[docs], stop) - np.maximum(begin, start))
        real = np.ones(len(codes), bool)
        filler = (begin[:, None] + np.arange(depth)).ravel() - start
        real[filler[(filler >= 0) & (filler < len(codes))]] = False
        yield codes[real], doc[real]


def _added(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order with their summed counts."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
    return codes[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def batches(texts: list[bytes | None], size: int = STRETCH) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Words of a few texts at a time, with the place of the first."""
    first, words, held = 0, [], 0
    for i, text in enumerate(texts):
        words.append(tokens(text))
        held += 16 + len(text or b"")
        if held >= size:
            yield first, words
            first, words, held = i + 1, [], 0
    if words:
        yield first, words


class _Contexts:
    """Distinct codes, and how often the learned texts have them."""

    def __init__(self):
        self.codes, self.counts, self.waiting = [], [], 0

    def take(self, words: list[list[bytes]], learned: np.ndarray, depth: int) -> None:
        for found, doc in context_codes(words, depth):
            taught = learned[doc]
            one, n = np.unique(found[taught], return_counts=True)
            other, _ = np.unique(found[~taught], return_counts=True)
            self.codes += [one, other]
            self.counts += [n, np.zeros(len(other), np.int64)]
            self.waiting += len(one) + len(other)
            if self.waiting > _WAITING:
                codes, counts = self.all()
                # what is distinct already does not wait
                self.codes, self.counts, self.waiting = [codes], [counts], 0

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        return _added(np.concatenate([np.zeros(0, _U), *self.codes]), np.concatenate([np.zeros(0, np.int64), *self.counts]))


# -- the tree ----------------------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function by Stirling's series, for x of 16 and more."""
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series


# logarithms of gamma at n + 1/2 and n + 1 for small n, by the recurrence
_SMALL = 1 << 14
_HALVES = 0.5 * math.log(math.pi) + np.append(0.0, np.cumsum(np.log(np.arange(_SMALL - 1) + 0.5)))
_WHOLES = np.append(0.0, np.cumsum(np.log(np.arange(1.0, _SMALL))))


def _log_gamma_at(n: np.ndarray, table: np.ndarray, step: float) -> np.ndarray:
    small = n < _SMALL
    if small.all():
        return table[n.astype(np.int64)]
    return np.where(small, table[np.where(small, n, 0).astype(np.int64)], log_gamma(np.where(small, _SMALL, n) + step))


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    halves = _log_gamma_at(zeros, _HALVES, 0.5) + _log_gamma_at(ones, _HALVES, 0.5)
    return halves - _log_gamma_at(zeros + ones, _WHOLES, 1.0) - math.log(math.pi)


class _Level:
    """Nodes of one depth: ``keys`` are context and byte (in order), ``counts`` their number.

    For bit j, ``group[j]`` maps a key to its node; ``zeros``, ``ones`` and ``log_kt`` are the nodes'.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        self.group, self.nodes, self.zeros, self.ones, self.log_kt = [], [], [], [], []
        for j in range(8):
            upper = keys >> _U(8 - j)
            starts = np.flatnonzero(np.append(True, upper[1:] != upper[:-1])) if len(keys) else np.zeros(0, np.int64)
            group = np.zeros(len(keys), np.int64)
            group[starts[1:]] = 1
            group = np.cumsum(group)
            bit = (keys >> _U(7 - j)) & _U(1) > 0
            ones = np.bincount(group, counts * bit, len(starts))
            zeros = np.bincount(group, counts * ~bit, len(starts))
            self.group.append(group)
            # context and the byte's leading j bits after a one: which of the 255 decisions it is
            self.nodes.append(((upper[starts] >> _U(j)) << _U(8)) | (_U(1 << j) | (upper[starts] & _U((1 << j) - 1))))
            self.zeros.append(zeros)
            self.ones.append(ones)
            self.log_kt.append(log_estimate(zeros, ones))

    def estimate(self, j: int) -> np.ndarray:
        """Probability of each key's bit j by its node's own counts."""
        group = self.group[j]
        bit = (self.keys >> _U(7 - j)) & _U(1) > 0
        zeros, ones = self.zeros[j][group], self.ones[j][group]
        return (np.where(bit, ones, zeros) + 0.5) / (zeros + ones + 1.0)


def _shorter(keys: np.ndarray) -> np.ndarray:
    """Keys without their farthest context byte."""
    return (keys >> _U(16)) << _U(8) | (keys & _U(0xFF))


class Tree:
    """The levels from ``depth`` up to ``top`` over some codes and their counts.

    ``log_pw[d][j]`` are the nodes' weighted probabilities and ``own[d][j]`` the share that a node's own
    estimate has in them.  Contexts that were never seen have counts of 0 and say 1/2.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depth: int = DEPTH, top: int = 0):
        self.depth, self.top = depth, top
        self.levels: dict[int, _Level] = {}
        self.parent: dict[int, np.ndarray] = {}  # keys of a level -> keys of the level above
        keys, n = codes, counts.astype(np.float64)
        for d in range(depth, top - 1, -1):
            self.levels[d] = _Level(keys, n)
            if d > top:
                upper = _shorter(keys)
                up, back = np.unique(upper, return_inverse=True)
                self.parent[d] = back
                keys, n = up, np.bincount(back, n, len(up))
        self.log_pw: dict[int, list[np.ndarray]] = {}
        self.own: dict[int, list[np.ndarray]] = {}
        for d in range(depth, top - 1, -1):
            level = self.levels[d]
            if d == depth:
                self.log_pw[d] = level.log_kt
                continue
            below = self.levels[d + 1]
            self.log_pw[d], self.own[d] = [], []
            for j in range(8):
                # the node above each node below, found through any of its keys
                above = np.zeros(len(below.nodes[j]), np.int64)
                above[below.group[j]] = level.group[j][self.parent[d + 1]]
                children = np.bincount(above, self.log_pw[d + 1][j], len(level.nodes[j]))
                weighted = np.logaddexp(level.log_kt[j], children) - math.log(2)
                self.log_pw[d].append(weighted)
                self.own[d].append(np.exp(level.log_kt[j] - math.log(2) - weighted))

    def bits(self) -> np.ndarray:
        """Weighted probability at ``top`` of the eight bits of each code (8 x codes)."""
        out = np.empty((8, len(self.levels[self.depth].keys)))
        for j in range(8):
            p = self.levels[self.depth].estimate(j)
            place = np.arange(len(p))
            for d in range(self.depth - 1, self.top - 1, -1):
                place = self.parent[d + 1][place]
                own = self.own[d][j][self.levels[d].group[j]][place]
                p = own * self.levels[d].estimate(j)[place] + (1 - own) * p
            out[j] = p
        return out


class Root:
    """The two topmost levels, whose nodes are as many as bytes: ``counts`` (nearest byte x byte) and
    ``below`` (nearest byte x decision): the children's summed logarithms."""

    def __init__(self, counts: np.ndarray, below: np.ndarray):
        keys = np.arange(1 << 16, dtype=_U)
        self.one = _Level(keys, counts.ravel().astype(np.float64))
        self.zero = _Level(np.arange(256, dtype=_U), counts.sum(axis=0).astype(np.float64))
        self.own_one, self.own_zero = [], []
        for j in range(8):
            context, node = self.one.nodes[j] >> _U(8), self.one.nodes[j] & _U(0xFF)
            weighted = np.logaddexp(self.one.log_kt[j], below[context, node]) - math.log(2)
            self.own_one.append(np.exp(self.one.log_kt[j] - math.log(2) - weighted))
            which = np.searchsorted(self.zero.nodes[j], node)
            total = np.logaddexp(self.zero.log_kt[j], np.bincount(which, weighted, len(self.zero.nodes[j]))) - math.log(2)
            self.own_zero.append(np.exp(self.zero.log_kt[j] - math.log(2) - total))
        self.kt_one = np.array([self.one.estimate(j) for j in range(8)])
        self.kt_zero = np.array([self.zero.estimate(j) for j in range(8)])

    def log_probability(self, codes: np.ndarray, bits: np.ndarray, depth: int) -> np.ndarray:
        """Natural logarithm of each code's byte, given its bits' probabilities below the two levels."""
        key = (codes >> _U(8 * depth)) << _U(8) | (codes & _U(0xFF))
        byte = codes & _U(0xFF)
        total = np.zeros(len(codes))
        for j in range(8):
            own = self.own_one[j][self.one.group[j][key]]
            p = own * self.kt_one[j][key] + (1 - own) * bits[j]
            own = self.own_zero[j][self.zero.group[j][byte]]
            total += np.log(own * self.kt_zero[j][byte] + (1 - own) * p)
        return total


# -- pieces ------------------------------------------------------------------------------------------


def _squeeze(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    import zstandard

    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T) if len(values) else values
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _spread(blob: bytes, kind) -> np.ndarray:
    import zstandard

    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _squeeze_sorted(codes: np.ndarray) -> bytes:
    return _squeeze(np.diff(codes, prepend=_U(0)))


def _spread_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(_spread(blob, _U), dtype=_U)


def _squeeze_words(words: list[bytes]) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b" ".join(words))


def _spread_words(blob: bytes) -> list[bytes]:
    import zstandard

    # words hold none of the white space that split takes
    return zstandard.ZstdDecompressor().decompress(blob).split()


def _ranges_of(codes: np.ndarray, depth: int, ranges: int) -> np.ndarray:
    """The range of each code, by a hash of its two nearest context bytes."""
    near = codes >> _U(8 * (depth - 1))
    mixed = near * _U(0x9E3779B97F4A7C15)
    return ((mixed >> _U(32)) * _U(ranges) >> _U(32)).astype(np.int64)


def _chunk_pieces(blob: bytes, depth: int, ranges: int) -> Iterator[tuple]:
    """A chunk's distinct codes and words with their counts in learned texts, one piece for every range."""
    ids, texts = _unpack(blob)
    held = np.array([held_out(i) for i in ids], bool)
    contexts, learned, met = _Contexts(), Counter(), set()
    for first, words in batches(texts):
        contexts.take(words, ~held[first : first + len(words)], depth)
        for found, out in zip(words, held[first:]):
            met.update(found)
            if not out:
                learned.update(found)
    codes, counts = contexts.all()
    of = _ranges_of(codes, depth, ranges)
    order = np.argsort(of, kind="stable")
    codes, counts = codes[order], counts[order]
    at = np.searchsorted(of[order], np.arange(ranges + 1))
    dealt: list[list[bytes]] = [[] for _ in range(ranges)]
    for w in met:
        dealt[zlib.crc32(w) % ranges].append(w)
    for r in range(ranges):
        # the ends of the learned texts go with the first range
        times = [learned[w] for w in dealt[r]] + [int((~held).sum()) if r == 0 else 0]
        part = slice(at[r], at[r + 1])
        yield r, _squeeze_sorted(codes[part]), _squeeze(counts[part]), _squeeze_words(dealt[r]), _squeeze(np.array(times, np.int64))


_MERGED = "kind string, place long, value double, pieces binary"
_PIECE = "range int, chunk long, codes binary, counts binary, words binary, times binary"


def _size_of(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text")).cast("long")).first()[0] or 0


def score_texts(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Model and baseline score of every row of ``docs`` (``doc_id``, ``text``).

    Learned from are the rows that ``held_out`` leaves.  A-Z is lower-cased; a text is the sequence
    of its words (runs without space and the five controls from tab to carriage return) and one
    end, and both scores are logarithms to base 10 of the probability of that sequence, the
    model's over the words joined by one space.  Columns: ``doc_id``, ``held_out``, ``n_tokens``
    (words and the end), ``n_known`` (tokens that a learned text has), ``train_tokens`` (tokens of
    all learned texts), ``base_score`` (add-one word counts), ``score``, ``n_bytes`` (bytes and the
    end) and ``bits_per_byte``, the code length.  A null text is an empty one, which has an end;
    equal texts have equal scores; if nothing is learned every bit has probability 1/2.  Rows are
    kept as they are, repeated or not; other columns are not read.
    """
    if not 2 <= depth <= 7:
        raise ValueError("contexts have 2 to 7 bytes")
    spark = docs.sparkSession
    path = intermediate_path(spark, "context_tree")
    total = _size_of(docs)
    chunk_bytes = int(min(MOST_CHUNK, max(LEAST_CHUNK, math.sqrt(total * _ROOT_BYTES))))
    ranges = total // chunk_bytes + 1
    # the blobs are compressed already
    pack_chunks(docs, chunk_bytes).write.option("compression", "none").parquet(f"{path}/chunks")
    chunks = spark.read.schema("chunk long, blob binary").parquet(f"{path}/chunks")

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for chunk, blob in zip(pdf["chunk"], pdf["blob"]):
                rows = [(r, chunk, *rest) for r, *rest in _chunk_pieces(blob, depth, ranges)]
                yield pd.DataFrame(rows, columns=["range", "chunk", "codes", "counts", "words", "times"])

    # the only shuffle of the pieces: a range's sums go up, and its pieces are kept together for the answers
    met = chunks.mapInPandas(send, _PIECE).groupBy("range").applyInPandas(lambda pdf: _sums(pdf, depth), _MERGED)
    met.write.partitionBy("kind").option("compression", "none").parquet(f"{path}/ranges")
    merged = spark.read.schema(_MERGED).parquet(f"{path}/ranges")
    root, totals = _root(merged.where("kind <> 'pieces'"))

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for blob in rows["pieces"]:
                pdf = _table(blob)
                tree, counts = _merged(pdf, depth)
                codes = tree.levels[depth].keys
                logs = root.log_probability(codes, tree.bits(), depth)
                scores, known = [], []
                for own, words in zip(pdf["codes"], pdf["words"]):
                    # logarithms travel in single precision, one part in ten million
                    scores.append(_squeeze(logs[np.searchsorted(codes, _spread_sorted(own))].astype(np.float32)))
                    known.append(_squeeze(np.array([counts[w] for w in _spread_words(words)], np.int64)))
                yield pdf[["chunk", "codes", "words"]].assign(scores=scores, known=known)

    pieces = merged.where("kind = 'pieces'").select("pieces")
    answers = pieces.mapInPandas(answer, "chunk long, codes binary, words binary, scores binary, known binary")

    def finish(key: tuple, packed: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        codes = np.concatenate([_spread_sorted(b) for b in told["codes"]])
        logs = np.concatenate([_spread(b, np.float32) for b in told["scores"]]).astype(np.float64)
        known = {}
        for words, times in zip(told["words"], told["known"]):
            known.update(zip(_spread_words(words), _spread(times, np.int64).tolist()))
        return _scored(*_unpack(packed["blob"].iloc[0]), codes, logs, known, totals, depth)

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(finish, _RESULT)


_RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
    "n_bytes long, bits_per_byte double"
)


def _merged(pdf: pd.DataFrame, depth: int) -> tuple[Tree, dict[bytes, int]]:
    """A range's part of the tree, and how often its words are learned."""
    codes, counts = _added(
        np.concatenate([_spread_sorted(b) for b in pdf["codes"]]), np.concatenate([_spread(b, np.int64) for b in pdf["counts"]])
    )
    words: Counter = Counter()
    for blob, times in zip(pdf["words"], pdf["times"]):
        for w, t in zip(_spread_words(blob), _spread(times, np.int64).tolist()):
            words[w] += t
    return Tree(codes, counts, depth, top=2), words


@dataclass
class _Totals:
    """Of the learned texts: tokens, distinct tokens, and ends."""

    tokens: int
    distinct: int
    ends: int


def _blob(pdf: pd.DataFrame) -> bytes:
    table, sink = pa.Table.from_pandas(pdf, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _table(blob: bytes) -> pd.DataFrame:
    with pa.ipc.open_stream(blob) as reader:
        return reader.read_all().to_pandas()


def _sums(pdf: pd.DataFrame, depth: int) -> pd.DataFrame:
    """What the topmost levels need of a range, and the range's pieces as one row."""
    tree, words = _merged(pdf, depth)
    level = tree.levels[2]
    ends = sum(int(_spread(t, np.int64)[-1]) for t in pdf["times"])
    parts = [
        ("tokens", [0], [sum(words.values()) + ends]),
        # ends are with the first range alone
        ("distinct", [0], [sum(1 for t in words.values() if t) + (ends > 0)]),
        ("ends", [0], [ends]),
        ("counts", _shorter(level.keys), level.counts),
    ]
    for j in range(8):
        # the nearest byte and the decision
        parts.append(("below", (level.nodes[j] >> _U(16)) << _U(8) | (level.nodes[j] & _U(0xFF)), tree.log_pw[2][j]))
    frames = [pd.DataFrame({"kind": k, "place": np.asarray(p).astype(np.int64), "value": np.asarray(x, np.float64)}) for k, p, x in parts]
    sums = pd.concat(frames).groupby(["kind", "place"], as_index=False)["value"].sum().assign(pieces=None)
    kept = pd.DataFrame({"kind": ["pieces"], "place": [0], "value": [0.0], "pieces": [_blob(pdf.drop(columns="range"))]})
    return pd.concat([sums, kept])[["kind", "place", "value", "pieces"]]


def _root(sums: DataFrame) -> tuple[Root, _Totals]:
    """The topmost levels and the totals of the learned texts.

    The sums that reach the driver are as many as pairs of bytes, however large the corpus.
    """
    table = sums.groupBy("kind", "place").agg(F.sum("value").alias("value")).toPandas()
    values = {kind: np.zeros(1 << 16) for kind in ("counts", "below", "tokens", "distinct", "ends")}
    for kind, rows in table.groupby("kind"):
        values[kind][rows["place"].to_numpy(np.int64)] = rows["value"].to_numpy(np.float64)
    root = Root(values["counts"].reshape(256, 256), values["below"].reshape(256, 256))
    return root, _Totals(*(int(values[k][0]) for k in ("tokens", "distinct", "ends")))


def _scored(
    ids: list, texts: list, codes: np.ndarray, logs: np.ndarray, known: dict[bytes, int], totals: _Totals, depth: int
) -> pd.DataFrame:
    """Rows of a chunk from the logarithms of its codes and the counts of its words."""
    unit = math.log10(totals.tokens + totals.distinct + 1)
    base = {w: math.log10(c + 1) - unit for w, c in known.items()}
    strange = {w for w, c in known.items() if not c}
    end = math.log10(totals.ends + 1) - unit
    place = pd.Index(codes)
    score, n_bytes = np.zeros(len(ids)), np.zeros(len(ids), np.int64)
    n_tokens, n_known, base_score = [], [], []
    for first, words in batches(texts):
        at = slice(first, first + len(words))
        for part, doc in context_codes(words, depth):
            score[at] += np.bincount(doc, logs[place.get_indexer(part)], len(words))
            n_bytes[at] += np.bincount(doc, minlength=len(words))
        for w in words:
            n_tokens.append(len(w) + 1)
            n_known.append(len(w) + (totals.ends > 0) - (sum(map(strange.__contains__, w)) if strange else 0))
            base_score.append(math.fsum(map(base.__getitem__, w)) + end)
    out = pd.DataFrame({
        "doc_id": pd.array(ids, "Int64"), "held_out": [held_out(i) for i in ids], "n_tokens": n_tokens, "n_known": n_known,
        "train_tokens": totals.tokens, "base_score": base_score, "score": score / _LN10, "n_bytes": n_bytes,
    })
    return out.assign(bits_per_byte=-score / math.log(2) / n_bytes)
