"""Token-id archives: documents as ids in range-coded, checksummed blocks.

Documents are put in ascending order by range partitioning, tokenised in place, and gathered into
segments of whole documents.  A segment holds a table of its documents and the coded blocks of
``rangecoder``.  Reading decodes the segments independently.

File format of a segment (little endian): ``b"TIDS"``, version (u1), then u8 numbers: documents,
ids, block length, blocks; then per document its number of ids (u8), per block the crc32 of its
ids and the length of its code (u4 each), the crc32 of everything so far (u4), and the codes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm import rangecoder

MAGIC, VERSION = b"TIDS", 1
END_ID = 2
SEGMENT_IDS = rangecoder.BLOCK * rangecoder.LANES
# Words that a task remembers, and the longest one, in bytes.
_WORDS, _LONGEST = 300_000, 64


class WordTokenizer:
    """Ids of whole texts, remembering the ids of words.

    The vocabulary's rules never look across white space (its text splitter leaves it out, and
    its normaliser composes no character with it), so the ids of a text are those of its
    stretches between ASCII white space.  The tokenizer encodes each stretch once per task.
    """

    def __init__(self, path: str):
        self.path, self._tokenizer = path, None
        self._forget()

    def __getstate__(self):
        return {"path": self.path}

    def __setstate__(self, state):
        self.__init__(state["path"])

    def _forget(self):
        self._place: dict[bytes, int] = {}
        self._ids = np.zeros(1 << 16, np.uint16)
        self._starts, self._lengths = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self._used = 0

    def _encode(self, words: list[str]) -> list[list[int]]:
        if self._tokenizer is None:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark shares out the cores
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self.path)
        return [e.ids for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        coded = self._encode([w.decode() for w in words])
        lengths = np.array([len(c) for c in coded], np.int64)
        flat = np.array([i for c in coded for i in c], np.int64)
        if len(flat) and flat.max() >> 16:
            raise ValueError("ids take more than 16 bits")
        n, total = len(self._place), self._used + len(flat)
        self._ids = _room(self._ids, total)
        self._starts, self._lengths = _room(self._starts, n + len(words)), _room(self._lengths, n + len(words))
        self._ids[self._used : total] = flat
        self._starts[n : n + len(words)] = self._used + np.cumsum(lengths) - lengths
        self._lengths[n : n + len(words)] = lengths
        self._used = total
        self._place.update(zip(words, range(n, n + len(words))))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; null has none."""
        return [self._one(t) for t in texts]

    def _one(self, text: str | None) -> np.ndarray:
        words = [] if text is None else text.encode().split()
        if not words:
            return np.zeros(0, np.uint16)
        get = self._place.get
        places = [get(w, -1) for w in words]
        if -1 in places:
            new = list(dict.fromkeys(w for w, p in zip(words, places) if p < 0))
            if max(map(len, new)) > _LONGEST or len(new) > _WORDS:
                # unusual words are not worth remembering: the tokenizer takes the whole text
                return np.array(self._encode([text])[0], np.uint16)
            if len(self._place) + len(new) > _WORDS:
                self._forget()
                return self._one(text)
            self._learn(new)
            places = [self._place[w] for w in words]
        at = np.array(places)
        lengths = self._lengths[at]
        ends = np.cumsum(lengths)
        # stretches of the remembered ids, end to end
        return self._ids[np.repeat(self._starts[at] - ends + lengths, lengths) + np.arange(ends[-1])]


def _room(array: np.ndarray, needed: int) -> np.ndarray:
    if needed <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(needed, 2 * len(array)) - len(array), array.dtype)])


# -- segments ----------------------------------------------------------------------------------------


def pack_segment(documents: list[np.ndarray]) -> bytes:
    ids = np.concatenate(documents)
    length, streams, sums = rangecoder.encode(ids)
    head = MAGIC + bytes([VERSION]) + struct.pack("<4Q", len(documents), len(ids), length, len(streams))
    head += np.array([len(d) for d in documents], "<u8").tobytes() + sums.astype("<u4").tobytes()
    head += np.array([len(s) for s in streams], "<u4").tobytes()
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(streams)


def unpack_segment(data: bytes) -> list[np.ndarray]:
    """The ids of each document; damage anywhere is an error."""
    if data[:4] != MAGIC or data[4] != VERSION:
        raise ValueError("not a segment of this format")
    documents, n_ids, length, blocks = struct.unpack_from("<4Q", data, 5)
    at = 37
    sizes = np.frombuffer(data, "<u8", documents, at).astype(np.int64)
    at += 8 * documents
    sums = np.frombuffer(data, "<u4", blocks, at)
    lengths = np.frombuffer(data, "<u4", blocks, at + 4 * blocks).astype(np.int64)
    at += 8 * blocks
    if struct.unpack_from("<I", data, at)[0] != zlib.crc32(data[:at]):
        raise ValueError("the head of a segment does not match its checksum")
    ends = at + 4 + np.cumsum(lengths)
    streams = [data[e - n : e] for e, n in zip(ends, lengths)]
    ids = rangecoder.decode(n_ids, length, streams, sums)
    return np.split(ids, np.cumsum(sizes)[:-1])


# -- archives ----------------------------------------------------------------------------------------


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of every row of ``docs`` (``doc_id``, ``text``), each followed by ``end_id``, in ascending ``doc_id`` order.

    One row per segment: ``part`` and ``seq`` give the order, ``doc_ids`` its documents, ``data``
    the segment.  Rows without id come first; rows of equal id follow each other in the order of
    a hash of their texts, spread over several parts if they are many.  A null or empty text has
    the end id only.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # the salt spreads repeated rows: a part boundary may fall between them
    keys = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), F.pmod(F.monotonically_increasing_id(), F.lit(64)).alias("salt")]
    ordered = docs.select(*keys, "text").repartitionByRange("doc_id", "h", "salt").sortWithinPartitions("doc_id", "h", "salt")
    tokenizer = WordTokenizer(vocabulary)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        ids: list = []
        rows: list[np.ndarray] = []
        size = 0
        frame = lambda: pd.DataFrame({"part": [part], "seq": [seq], "n_ids": [size], "doc_ids": [ids], "data": [pack_segment(rows)]})
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                coded = np.append(tokenizer.encode([text])[0], np.uint16(end_id))
                if rows and size + len(coded) > segment_ids:
                    yield frame()
                    ids, rows, size, seq = [], [], 0, seq + 1
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                rows.append(coded)
                size += len(coded)
        if rows:
            yield frame()

    segments = ordered.select("doc_id", "text").mapInPandas(write, "part int, seq int, n_ids long, doc_ids array<long>, data binary")
    # the codes are compressed already
    segments.write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``, ``ids`` of every document.

    ``ids_crc32`` is the unsigned crc32 of the ids as little-endian unsigned 32-bit numbers;
    ``ids`` is null without ``with_ids``.
    """
    segments = spark.read.parquet(path)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                documents = unpack_segment(row.data)
                lengths = np.array([len(d) for d in documents], np.int64)
                out = pd.DataFrame({
                    "part": row.part, "seq": row.seq, "doc_id": pd.array(list(row.doc_ids), dtype="Int64"),
                    "at": np.cumsum(lengths) - lengths, "n_tokens": lengths,
                    "ids_crc32": [zlib.crc32(d.astype("<u4").tobytes()) for d in documents],
                })
                out["ids"] = [d.astype(np.int32) for d in documents] if with_ids else None
                yield out

    # ids before a segment: before its part, from one row per part, and before it in its part
    sizes = segments.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part").select(
        "part", "seq", (F.col("part_start") + F.col("inside")).alias("first")
    )
    read_back = segments.select("part", "seq", "doc_ids", "data").mapInPandas(
        read, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long, ids array<int>"
    )
    return read_back.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
