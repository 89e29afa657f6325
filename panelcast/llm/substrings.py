"""Removal of repeated passages, with a count-min prefilter.

Documents are packed into chunks.  Each chunk sketches its word windows: per row of the sketch the
sorted cells that its windows fall into.  The sketches are merged by ranges of cells, and each
chunk learns which of its cells other chunks use too.  A window's estimate is its least cell
count, never below its true count, so a window estimated once is not repeated.  Only the windows
estimated repeated are then grouped exactly, by ranges of a 96-bit digest, which tells each chunk
the windows that also start in an earlier document.

What moves are sorted arrays of whole ranges, not rows of single windows, and a chunk names each
window once with its first document, so a passage that very many documents share weighs no more
than the number of chunks.  The sketch grows with the corpus and is never held in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.sources.sinks import intermediate_path

WINDOW = 13
ROWS = 2  # rows of the sketch
CELLS = 1 << 24  # cells of one range of a row
RANGE_WINDOWS = CELLS >> 3  # windows that one range is meant for, so that few share a cell by chance
CHUNK_BYTES = 6 << 20

_U = np.uint64
_M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
_LAST = np.iinfo(np.int64).max  # place of a missing doc_id: after all others


# -- packing ---------------------------------------------------------------------------------------


def _pack(ids: list, texts: list[bytes | None]) -> bytes:
    import zstandard

    table = pa.table({"id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.large_binary())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())


def _unpack(blob: bytes) -> tuple[list, list[bytes | None]]:
    import zstandard

    with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)) as reader:
        table = reader.read_all()
    return table["id"].to_pylist(), table["text"].to_pylist()


def pack_chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``chunk``, ``blob``: the rows of ``docs`` (``doc_id``, ``text``) in chunks of about ``chunk_bytes``, unshuffled."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0
        emit = lambda: pa.RecordBatch.from_arrays(
            [pa.array([part << 32 | n], pa.int64()), pa.array([_pack(ids, texts)], pa.binary())], names=["chunk", "blob"]
        )
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_py()
                raw = None if raw is None else raw.encode()
                ids.append(i)
                texts.append(raw)
                size += 16 + len(raw or b"")
                if size >= chunk_bytes:
                    yield emit()
                    ids, texts, size, n = [], [], 0, n + 1
        if ids:
            yield emit()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, "chunk long, blob binary")


# -- windows of a chunk ------------------------------------------------------------------------------


class _Windows:
    """Words and window digests of some documents, in order."""

    def __init__(self, ids: list, texts: list[bytes | None], window: int):
        import xxhash

        self.words = [[] if t is None else t.split() for t in texts]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        total = int(self.lengths.sum())
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(w) for doc in self.words for w in doc), _U, total)
        other = (hashes ^ (hashes >> _U(31))) * _M2
        other ^= other >> _U(29)
        # places among distinct ids, so that equal ids are not earlier than each other
        self.ids = np.array([_LAST if i is None else i for i in ids], np.int64)
        starts_per_doc = np.maximum(self.lengths - window + 1, 0)
        self.doc = np.repeat(np.arange(len(ids)), starts_per_doc)
        within = np.arange(len(self.doc)) - np.repeat(np.cumsum(starts_per_doc) - starts_per_doc, starts_per_doc)
        self.start = self.offsets[self.doc] + within  # word place of each window in the chunk
        n = max(0, total - window + 1)
        one, two = np.zeros(n, _U), np.zeros(n, _U)
        for i in range(window):
            one = one * _M1 + hashes[i : i + n]
            two = two * _M2 + other[i : i + n]
        self.one, self.two = one[self.start], (two[self.start] >> _U(32)).astype(np.uint32)

    def cells(self, row: int, ranges: int) -> np.ndarray:
        """Cells of the windows in one row of the sketch: range times ``CELLS`` plus place in the range."""
        mixed = self.one if not row else (self.one ^ (self.one >> _U(32))) * _M2 * _U(2 * row + 1)
        mixed = mixed ^ (mixed >> _U(33))
        return _range(mixed, ranges) * _U(CELLS) + (mixed & _U(CELLS - 1))


def _range(digests: np.ndarray, ranges: int) -> np.ndarray:
    """Equal ranges of a digest, by its leading half."""
    return (digests >> _U(32)) * _U(ranges) >> _U(32)


# -- sorted numbers as bytes ---------------------------------------------------------------------------


def _encode_sorted(values: np.ndarray) -> bytes:
    """Distinct ascending numbers as compressed differences, byte planes apart."""
    import zstandard

    steps = np.diff(values, prepend=values.dtype.type(0)).astype(np.uint64)
    width = 2 if not len(steps) or steps.max() < 1 << 16 else 8
    planes = steps.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _decode_sorted(blob: bytes) -> np.ndarray:
    import zstandard

    width = blob[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8).reshape(width, -1)
    steps = np.ascontiguousarray(planes.T).view(f"<u{width}").ravel()
    return np.cumsum(steps.astype(np.uint64), dtype=np.uint64)


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def _encode_keys(one: np.ndarray, two: np.ndarray, doc: np.ndarray) -> bytes:
    """Digests in ascending order with the id of the first document of each."""
    import zstandard

    ids, place = np.unique(doc, return_inverse=True)
    parts = [_encode_sorted(one), two.astype("<u4").tobytes(), ids.astype("<i8").tobytes(), place.astype("<u4").tobytes()]
    sizes = np.array([len(p) for p in parts], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(sizes + b"".join(parts))


def _decode_keys(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    ends = 32 + np.cumsum(np.frombuffer(raw[:32], "<i8"))
    one, two, ids, place = (raw[a:b] for a, b in zip([32, *ends[:-1]], ends))
    doc = np.frombuffer(ids, "<i8")[np.frombuffer(place, "<u4")]
    return _decode_sorted(one), np.frombuffer(two, "<u4"), doc


class _Keys:
    """The distinct windows among the flagged ones, with their first document, by ranges of the digest."""

    def __init__(self, found: _Windows, flagged: np.ndarray, ranges: int):
        one, two, doc = found.one[flagged], found.two[flagged], found.ids[found.doc[flagged]]
        order = np.lexsort((doc, two, one))
        one, two, doc = one[order], two[order], doc[order]
        first = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))[: len(one)]
        self.one, self.two, self.least = one[first], two[first], doc[first]
        self.inverse = np.empty(len(one), np.int64)
        self.inverse[order] = np.cumsum(first) - 1
        self.bounds = np.searchsorted(_range(self.one, ranges), np.arange(ranges + 1, dtype=_U))

    def parts(self):
        for r, (a, b) in enumerate(zip(self.bounds[:-1], self.bounds[1:])):
            if b > a:
                yield r, _encode_keys(self.one[a:b], self.two[a:b], self.least[a:b])


# -- the passes --------------------------------------------------------------------------------------

# What a chunk has to say after the prefilter: finished documents, digests to group, unfinished documents.
_STAGE = "range int, chunk long, blob binary, extra binary, doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary, kind string"
_COLUMNS = [c.split()[0] for c in _STAGE.split(", ")]
_RESULT = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]


def _ranges(docs: DataFrame, words_per_byte: float = 1 / 5) -> int:
    """Ranges of cells and digests, from the bytes of text: the sketch is as large as the corpus needs."""
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-int(n_bytes * words_per_byte) // RANGE_WINDOWS))


def _sketch(found: _Windows, row: int, ranges: int) -> tuple[np.ndarray, ...]:
    """A chunk's row of the sketch: cell of each window, distinct cells, their counts, and where ranges begin."""
    cells = found.cells(row, ranges)
    used, times = np.unique(cells, return_counts=True)
    return cells, used, times, np.searchsorted(used, np.arange(ranges + 1, dtype=_U) * _U(CELLS))


def _result(doc_id: int | None, n_words: int, n_removed: int, words: list[bytes], with_text: bool) -> tuple:
    kept = b" ".join(words)
    return doc_id, int(n_words), int(n_removed), hashlib.sha256(kept).hexdigest(), kept if with_text else None


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    # ids stay whole numbers where some are missing
    out = pd.DataFrame(rows, columns=columns, dtype=object)
    return out.astype({c: "Int64" for c in ("doc_id", "n_words", "n_removed") if c in columns})


def drop_repeated(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES, with_text: bool = True) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``, ``kept`` of every row of ``docs``.

    Words are runs of characters other than space and the five ASCII controls tab to carriage
    return.  A word is removed if a window of ``window`` consecutive words covers it whose
    sequence also starts in a document with a smaller ``doc_id``.  ``kept`` holds the kept words
    joined by one space, in UTF-8 (null without ``with_text``), and ``kept_sha256`` its lower-case
    digest.  Null and empty texts have no words; texts shorter than a window keep all.  Rows with
    equal ids do not count as earlier than each other; rows without id come after all others.
    Repeated rows stay rows, and other columns are not read.
    """
    spark = docs.sparkSession
    path = intermediate_path(spark, "substrings")
    ranges = _ranges(docs)
    save = lambda df, name: df.write.option("compression", "zstd").parquet(f"{path}/{name}")
    load = lambda name, schema: spark.read.schema(schema).parquet(f"{path}/{name}")

    # the blobs are compressed already
    pack_chunks(docs, chunk_bytes).write.option("compression", "none").parquet(f"{path}/chunks")
    chunks = load("chunks", "chunk long, blob binary")

    # pass 1: every chunk sketches its windows, ranges of cells are merged, chunks hear of shared cells
    def sketch(batches):
        for pdf in batches:
            for chunk, blob in zip(pdf["chunk"], pdf["blob"]):
                found = _Windows(*_unpack(blob), window)
                rows = []
                for row in range(ROWS):
                    _, used, _, at = _sketch(found, row, ranges)
                    for r in np.flatnonzero(np.diff(at)):
                        part = used[at[r] : at[r + 1]] - _U(int(r) * CELLS)
                        rows.append((row * ranges + int(r), chunk, _encode_sorted(part)))
                if rows:
                    yield pd.DataFrame(rows, columns=["range", "chunk", "cells"])

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(CELLS, np.uint8)
        for blob in pdf["cells"]:
            used = _decode_sorted(blob)
            # saturates at two, all that the estimate needs to tell
            counts[used] += counts[used] < 2
        shared = [_bits(counts[_decode_sorted(blob)] > 1) for blob in pdf["cells"]]
        return pd.DataFrame({"chunk": pdf["chunk"], "range": key[0], "flags": shared})

    replies = "chunk long, range int, flags binary"
    sketched = chunks.mapInPandas(sketch, "range int, chunk long, cells binary")
    save(sketched.groupBy("range").applyInPandas(merge, replies), "shared")

    # pass 2: windows estimated repeated are sent to be grouped exactly
    def estimate(key: tuple, packed: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        flags = dict(zip(shared["range"], shared["flags"]))
        blank = dict.fromkeys(_COLUMNS)
        out = []
        for blob in packed["blob"]:
            ids, texts = _unpack(blob)
            found = _Windows(ids, texts, window)
            repeated = np.ones(len(found.one), bool)
            for row in range(ROWS):
                cells, used, times, at = _sketch(found, row, ranges)
                many = times > 1
                for r in np.flatnonzero(np.diff(at)):
                    many[at[r] : at[r + 1]] |= _flags(flags[row * ranges + int(r)], int(at[r + 1] - at[r]))
                repeated &= many[np.searchsorted(used, cells)]
            for r, keys in _Keys(found, repeated, ranges).parts():
                out.append(blank | {"kind": "keys", "chunk": key[0], "range": r, "blob": keys})
            touched = np.bincount(found.doc[repeated], minlength=len(ids)) > 0
            for i in np.flatnonzero(~touched):
                row = _result(ids[i], found.lengths[i], 0, found.words[i], with_text)
                out.append(blank | dict(zip(_RESULT, row)) | {"kind": "done", "chunk": key[0]})
            if touched.any():
                some = np.flatnonzero(touched)
                rest = _pack([ids[i] for i in some], [texts[i] for i in some])
                out.append(blank | {"kind": "open", "chunk": key[0], "blob": rest, "extra": _bits(repeated[touched[found.doc]])})
        return _frame([tuple(x[c] for c in _COLUMNS) for x in out], _COLUMNS).astype({"range": "Int32"})

    told = chunks.groupBy("chunk").cogroup(load("shared", replies).groupBy("chunk")).applyInPandas(estimate, _STAGE)
    told.write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/estimated")
    estimated = load("estimated", _STAGE)

    def group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_decode_keys(b) for b in pdf["blob"]]
        one, two, doc = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((doc, two, one))
        one, two, ordered = one[order], two[order], doc[order]
        first = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))
        later = np.empty(len(doc), bool)
        later[order] = ordered > ordered[first][np.cumsum(first) - 1]
        ends = np.cumsum([len(p[0]) for p in parts])
        bits = [_bits(later[e - len(p[0]) : e]) for e, p in zip(ends, parts)]
        return pd.DataFrame({"chunk": pdf["chunk"], "range": key[0], "flags": bits})

    keys = estimated.where("kind = 'keys'").select("range", "chunk", "blob")
    save(keys.groupBy("range").applyInPandas(group, replies), "later")

    # pass 3: documents with such windows drop the words that these cover
    def finish(key: tuple, open_: pd.DataFrame, later: pd.DataFrame) -> pd.DataFrame:
        flags = dict(zip(later["range"], later["flags"]))
        out = []
        for blob, extra in zip(open_["blob"], open_["extra"]):
            ids, texts = _unpack(blob)
            found = _Windows(ids, texts, window)
            repeated = _flags(extra, len(found.one))
            keys = _Keys(found, repeated, ranges)
            elsewhere = np.zeros(len(keys.one), bool)
            for r in np.flatnonzero(np.diff(keys.bounds)):
                a, b = keys.bounds[r], keys.bounds[r + 1]
                elsewhere[a:b] = _flags(flags[int(r)], int(b - a))
            # an earlier document in another chunk, or in this one
            gone = elsewhere[keys.inverse] | (found.ids[found.doc[repeated]] > keys.least[keys.inverse])
            edges = np.zeros(int(found.lengths.sum()) + 1, np.int64)
            at = found.start[repeated][gone]
            np.add.at(edges, at, 1)
            np.subtract.at(edges, at + window, 1)
            covered = np.cumsum(edges)[:-1] > 0
            for i, words in enumerate(found.words):
                drop = covered[found.offsets[i] : found.offsets[i] + found.lengths[i]]
                n = int(drop.sum())
                kept = [w for w, d in zip(words, drop.tolist()) if not d] if n else words
                out.append(_result(ids[i], found.lengths[i], n, kept, with_text))
        return _frame(out, _RESULT)

    open_ = estimated.where("kind = 'open'").select("chunk", "blob", "extra")
    finished = open_.groupBy("chunk").cogroup(load("later", replies).groupBy("chunk")).applyInPandas(
        finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary"
    )
    return estimated.where("kind = 'done'").select(*_RESULT).unionByName(finished)
