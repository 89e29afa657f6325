"""WARC and token archives, the range coder, licences and sharding."""

import base64
import hashlib
import pathlib
import random
import textwrap
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from check_oracle import compare
from panelcast.llm import licences, rangecoder, sharding, sql, tokens, warc
from panelcast.llm.licence_texts import KNOWN_LICENCES

VOCABULARY = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def test_warc_round_trip(spark, tmp_path):
    rows = [(5, "http://a", "<p>é</p>"), (2, "http://b\r\nX: y", "<p>é</p>"), (3, None, None), (4, "", ""), (9, "u", "z" * 100_000), (None, "n", "<p>é</p>"), (2, "again", "<p>é</p>")]
    path = str(tmp_path / "warc")
    warc.write_archive(pages(spark, rows), path)
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    found = warc.page_records(spark, path).collect()
    assert len(found) == len(rows) and all(r.verified for r in found)
    by_id = {r.page_id: r for r in found if r.page_id not in (2, None)}
    digest = base64.b32encode(hashlib.sha1("<p>é</p>".encode()).digest()).decode()
    assert (by_id[5].payload_bytes, by_id[5].payload_digest, by_id[5].record_type, by_id[5].refers_to) == (9, digest, "revisit", 2)
    assert (by_id[3].record_type, by_id[4].record_type, by_id[4].refers_to, by_id[9].payload_bytes) == ("response", "revisit", 3, 100_000)
    assert sorted(r.record_type for r in found if r.page_id == 2) == ["response", "revisit"]
    assert [(r.record_type, r.refers_to) for r in found if r.page_id is None] == [("revisit", 2)]
    records = {r.page_id: bytes(r.record) for r in warc.read_archive(spark, path).collect()}
    head, body = records[9].split(b"\r\n\r\n", 1)
    assert body == b"z" * 100_000 + b"\r\n\r\n" and b"Content-Length: 100000" in head and head.startswith(b"WARC/1.1\r\n")


def test_warc_least_payload_and_none(spark, tmp_path):
    warc.write_archive(pages(spark, [(1, "a", "xx"), (2, "b", "xx"), (3, "c", "yyyy"), (4, "d", "yyyy")]), str(tmp_path / "a"), min_payload=3)
    found = {r.page_id: r.record_type for r in warc.page_records(spark, str(tmp_path / "a")).collect()}
    assert found == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    warc.write_archive(pages(spark, []), str(tmp_path / "b"))
    assert warc.page_records(spark, str(tmp_path / "b")).count() == 0


def test_warc_damage_is_found(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_archive(pages(spark, [(1, "a", "xx")]), path)
    spark.sql("SELECT 'no such digest' AS digest, binary('xx') AS payload").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="payload"):
        warc.page_records(spark, path).collect()


def test_licences(spark, docs):
    known = dict(KNOWN_LICENCES[:9])
    mit = "Copyright (c) 2020 Someone\n\n" + known["MIT"].replace("“", '"').replace("sublicense", "SUB LICENSE")
    zlib_text = "(C) 1999 A. Uthor\r\n" + known["Zlib"].replace("acknowledgment", "acknowledgement").replace(" ", "\n ")
    rows = [(1, mit), (2, zlib_text), (3, known["MIT"] + " more"), (4, None), (5, ""), (6, "MIT License"), (7, known["Unlicense"].replace("https", "http")), (1, mit)]
    found = sorted((r.doc_id, r.licence, r.canonical_sha256) for r in licences.scan_licences(docs(rows)).collect() if r.licence)
    assert [f[:2] for f in found] == [(1, "MIT"), (1, "MIT"), (2, "Zlib"), (7, "Unlicense")]
    nothing = {r.doc_id: r.canonical_sha256 for r in licences.scan_licences(docs(rows)).collect()}
    assert nothing[4] is None and nothing[5] == hashlib.sha256(b"").hexdigest()
    assert licences.scan_licences(docs([])).count() == 0


def test_licences_wrapped_and_commented(spark, docs):
    """Known licences at any width, below holder lines, plain or behind comment marks."""
    rows, expected = [], {}
    for name, body in KNOWN_LICENCES[:9]:
        for width in (30, 54, 65, 78):
            lines = [line for part in body.split("\n\n") for line in [*textwrap.wrap(part, width, break_on_hyphens=False), ""]]
            for mark in ("", "# ", " * ", "// "):
                head = ["Copyright (c) 2020 Some One", "Copyright 2019, The X Authors", "All rights reserved.", ""]
                rows.append((len(rows), "\n".join(mark + line for line in head + lines)))
                expected[rows[-1][0]] = name
    isc = dict(KNOWN_LICENCES[:9])["ISC"].replace("above copyright", "above\ncopyright")
    rows.append((len(rows), isc))
    expected[rows[-1][0]] = "ISC"
    assert {r.doc_id: r.licence for r in licences.scan_licences(docs(rows)).collect()} == expected


def test_licence_sql_on_licences(spark, docs, tmp_path):
    """The twin states the rule in its own way; here it meets licences, not prose that merely names them."""
    known = dict(KNOWN_LICENCES[:9])
    heads = (
        "", "Copyright (c) 2020 Some One\n", "Portions copyright by X\n(C) 1999 Y\r\n", " * Copyright: the X contributors.\n * ALL RIGHTS RESERVED.\n", "© z\n",
        "copyright [year] holder\n(c) <yyyy>\n", "copyright laws apply\n", "all rights reserved by us\n", "the copyright (c) 2020\n", "Copyright the authors of this\n",
    )
    rows = [(i, head + body) for i, (head, body) in enumerate((h, b) for h in heads for b in known.values())]
    folder = pathlib.Path("/usr/share/common-licenses")
    rows += [(1000 + i, f.read_text(encoding="utf-8")) for i, f in enumerate(sorted(folder.glob("*"))) if f.is_file()]
    rows += [(3000, known["ISC"].replace("above copyright", "above\ncopyright")), (2000, None), (2001, ""), (0, rows[0][1])]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = licences.scan_licences(spark.read.parquet(str(tmp_path / "documents.parquet"))).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(found, con.execute(sql.ORACLE_SQL["op4_licences"]).df()) == ""
    named = found[found.licence.notna()]
    assert set(known) <= set(named.licence) and len(found) > len(named) >= 7 * len(known)


def test_whole_long_licences(spark, docs):
    """Licence files as Debian ships them, and those without their appendix behind comment marks."""
    folder = pathlib.Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    found = {licence: folder / name for name, licence in names.items() if (folder / name).exists()}
    if not found:
        pytest.skip("no licence files")
    rows, expected = [], []
    for licence, path in found.items():
        text = path.read_text(encoding="utf-8")
        terms = text.partition("END OF TERMS AND CONDITIONS")[0]
        for t in (text, terms, "\n".join(f" * {line}" for line in text.split("\n")), text + " and more"):
            rows.append((len(rows), t))
            expected.append(None if t.endswith(" and more") else licence)
    assert [r.licence for r in sorted(licences.scan_licences(docs(rows)).collect(), key=lambda r: r.doc_id)] == expected


@pytest.mark.parametrize("ranges", [256, 4])
def test_shards(spark, docs, ranges):
    rng = random.Random(1)
    rows = [(rng.randrange(10**6), "é" * rng.randrange(200)) for _ in range(600)]
    rows += [(17, "same text")] * 400 + [(None, None)] * 30 + [(5, ""), (6, "long " * 20_000)]
    found = sharding.shard_documents(docs(rows), ranges=ranges, per_range=8).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in found) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    total = sum(r.size for r in found)
    largest = max(r.size for r in found)
    for shard in range(8):
        mine = [r for r in found if r.shard == shard]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(r.size for r in mine) - total / 8) <= 2 * largest
    small = [r for r in rows if len(r[1] or "") < 1000]
    sizes = [0] * 8
    for r in sharding.shard_documents(docs(small), ranges=ranges).collect():
        sizes[r.shard] += r.size
    assert max(sizes) - min(sizes) < 900


def test_shards_of_little(spark, docs):
    assert sharding.shard_documents(docs([])).count() == 0
    assert [(r.size, r.slot, r.law) for r in sharding.shard_documents(docs([(None, None)])).collect()] == [(1, 0, "bytes")]


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 4000), st.integers(1, 65535), st.integers(0, 2**32 - 1))
def test_range_coder_round_trip(n, highest, seed):
    rng = np.random.default_rng(seed)
    ids = np.minimum(rng.geometric(1 / (highest + 1), n), 65535)
    length, streams, sums = rangecoder.encode(ids)
    assert (rangecoder.decode(n, length, streams, sums) == ids).all()


def test_range_coder_adapts_and_checks():
    pattern = np.tile(np.arange(40), 400)
    length, streams, sums = rangecoder.encode(pattern)
    assert sum(map(len, streams)) * 8 / len(pattern) < 4
    noise = np.random.default_rng(0).integers(0, 1 << 16, 3000)
    length, streams, sums = rangecoder.encode(noise)
    assert (rangecoder.decode(len(noise), length, streams, sums) == noise).all()
    streams[2] = bytes([streams[2][0] ^ 1]) + streams[2][1:]
    with pytest.raises(ValueError, match="block 2"):
        rangecoder.decode(len(noise), length, streams, sums)
    with pytest.raises(ValueError, match="bits"):
        rangecoder.encode(np.array([1 << 16]))


def test_segment_round_trip():
    documents = [np.array(d, np.int64) for d in ([2], list(range(3000)), [7, 2], [5] * 9000)]
    data = tokens.pack_segment(documents)
    assert all((a == b).all() for a, b in zip(documents, tokens.unpack_segment(data), strict=True))
    with pytest.raises(ValueError, match="checksum"):
        tokens.unpack_segment(data[:40] + bytes([data[40] ^ 1]) + data[41:])


WHITE = " \t\n\x0b\x0c\r\x1c\x85  　"


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(WHITE + "aZé'sΣς<|endoftext|>́̈12.,-"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_word_memory_changes_no_id(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(VOCABULARY) if not hasattr(test_word_memory_changes_no_id, "t") else test_word_memory_changes_no_id.t
    test_word_memory_changes_no_id.t = whole
    words = getattr(test_word_memory_changes_no_id, "w", None) or tokens.WordTokenizer(VOCABULARY)
    test_word_memory_changes_no_id.w = words
    for t in (text, text + " <|endoftext|> " + text):
        assert words.encode([t])[0].tolist() == whole.encode(t, add_special_tokens=False).ids


def test_token_archive(spark, docs, tmp_path, data):
    from tokenizers import Tokenizer

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").limit(60).collect()]
    rows += [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "w" * 70_000), (10**6 + 3, "same"), (10**6 + 3, "same")]
    path = str(tmp_path / "ids")
    tokens.write_ids(docs(rows), path, VOCABULARY, segment_ids=2000)
    found = sorted(tokens.read_ids(spark, path).collect(), key=lambda r: r.start)
    tokenizer, start = Tokenizer.from_file(VOCABULARY), 0
    for r, (doc_id, text) in zip(found, sorted(rows, key=lambda r: r[0]), strict=True):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (doc_id, start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_archive_of_nothing_and_without_ids(spark, docs, tmp_path):
    tokens.write_ids(docs([]), str(tmp_path / "none"), VOCABULARY)
    assert tokens.read_ids(spark, str(tmp_path / "none")).count() == 0
    tokens.write_ids(docs([(None, "b"), (1, "a")]), str(tmp_path / "some"), VOCABULARY)
    assert [(r.doc_id, r.start) for r in tokens.read_ids(spark, str(tmp_path / "some")).orderBy("start").collect()] == [(None, 0), (1, 2)]
