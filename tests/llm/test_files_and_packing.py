import hashlib
import os
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers as P
import zstandard
from conftest import EDGES
from tokenizers import Tokenizer

import corpus_pipeline
from wardlake.llm import catalog, packing, warc
from wardlake.llm.common import shared_path, written
from wardlake.session import prepare

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, sha1 string, payload int, refers_to string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "c") for r in rows], PAGES)


def test_pages_come_back_from_the_archives(spark):
    big = "é" * 300_000
    rows = [(1, "http://a/ü ?q=\r\nX: y", "<p>one</p>"), (2, "http://b", "<p>one</p>"), (3, None, None), (4, "http://d", ""), (None, "http://e", "<p>one</p>"),
            (5, "http://f", big), (6, "http://f", big), (2, "http://b", "<p>one</p>"), (None, None, "alone"), (7, "u", "a\r\n\r\nb")]
    out = warc.round_trip(pages(spark, rows), file_bytes=1000).collect()
    want = sorted([(i, (h or "").encode(), "revisit" if (i, h) in [(2, "<p>one</p>"), (None, "<p>one</p>"), (4, ""), (6, big)] else "response")
                   for i, _, h in rows], key=lambda x: repr((x[0], len(x[1]), x[2])))
    got = sorted(out, key=lambda r: repr((r.page_id, r.payload_bytes, r.record_type)))
    low = {b"<p>one</p>": 1, b"": 3, big.encode(): 5}
    for r, (i, payload, kind) in zip(got, want, strict=True):
        assert (r.page_id, r.payload_bytes, r.record_type, r.error) == (i, len(payload), kind, None)
        assert r.payload_digest == warc.digest(payload)
        assert r.refers_to == (low[payload] if kind == "revisit" else None)
        assert (bytes(r.payload) == payload) if kind == "response" else r.payload is None


def test_small_payloads_are_all_responses(spark):
    rows = [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbbbb"), (4, "u", "bbbbbb")]
    out = {r.page_id: r.record_type for r in warc.round_trip(pages(spark, rows), min_bytes=5).collect()}
    assert out == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_no_pages_no_records(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0


def archive(records, dictionary=b"WARC/1.1 a dictionary of plain text", packed=False):
    pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
    lead = zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary
    return struct.pack("<II", warc.DICT_FRAME, len(lead)) + lead + b"".join(map(pack.compress, records))


def test_reader_takes_plain_and_compressed_dictionaries():
    records = [warc.record(i, "http://x", b"body %d" % i, None) for i in range(3)]
    for packed in (False, True):
        assert [r["payload"] for r in warc._walk(archive(records, packed=packed))] == [b"body 0", b"body 1", b"body 2"]
    plain = zstandard.ZstdCompressor().compress(records[0])
    assert [r["record_id"] for r in warc._walk(plain)] == ["<urn:wardlake:page:0>"]


def foreign(version, kind, headers, block, ident):
    head = {"warc-type": kind, "WARC-RECORD-ID": f"<urn:uuid:{ident}>", "Warc-Date": "2024-05-01T12:00:00Z", **headers, "content-length": str(len(block))}
    return version + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head.items()) + b"\r\n" + block + b"\r\n\r\n"


def test_archives_of_other_writers_come_back_whole(spark):
    http = {"Content-Type": "application/http; msgtype=response", "WARC-Target-URI": "http://x/"}
    body = b"hello world, in chunks"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5;a=b\r\nhello\r\n11\r\n world, in chunks\r\n0\r\n\r\n"
    sha = hashlib.sha256(body).hexdigest()
    records = [
        foreign(b"WARC/1.0", "warcinfo", {"Content-Type": "application/warc-fields", "WARC-Filename": "a.warc"}, b"software: x\r\n", "i"),
        foreign(b"WARC/1.0", "request", {"Content-Type": "application/http;msgtype=request"}, b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", "q"),
        foreign(b"WARC/1.0", "response", http | {"WARC-Payload-Digest": f"sha256:{sha.upper()}"}, chunked, "r1"),
        foreign(b"WARC/1.1", "response", http | {"WARC-Payload-Digest": "sha1:" + warc.digest(b"plain").lower()},
                b"HTTP/1.0 404 Not Found\r\nContent-Type:\r\n text/plain\r\n\r\nplain", "r2"),
        foreign(b"WARC/1.1", "resource", {"Content-Type": "image/png", "WARC-Block-Digest": "blake9:zz"}, b"\x00\xff", "s"),
        foreign(b"WARC/1.1", "response", {"Content-Type": "text/dns", "WARC-Target-URI": "dns:x"}, b"20240501\r\nx. 300 IN A 1.2.3.4\r\n", "d"),
        foreign(b"WARC/1.1", "revisit", http | {"WARC-Refers-To-Target-URI": "http://x/"}, b"", "v"),
        foreign(b"WARC/1.1", "metadata", {}, b"", "m"),
        foreign(b"WARC/1.1", "response", http | {"WARC-Truncated": "length"}, b"HTTP/1.1 200 OK\r\nContent-Length: 99\r\n\r\ncut", "t"),
        foreign(b"WARC/1.1", "resource", {"WARC-Block-Digest": "sha1:AAAA"}, b"x", "bad1"),
        foreign(b"WARC/1.1", "response", http, b"HTTP/1.1 200 OK\r\nContent-Length: 99\r\n\r\nshort", "bad2")]
    # streaming frames without a size, with a skippable frame between them
    pack = zstandard.ZstdCompressor(write_content_size=False)
    frames = []
    for r in records:
        out = pack.compressobj()
        frames.append(out.compress(r) + out.flush())
    content = frames[0] + struct.pack("<II", 0x184D2A53, 3) + b"pad" + b"".join(frames[1:])
    path = shared_path(prepare(spark), "foreign")
    os.makedirs(path)
    with open(f"{path}/x.warc.zst", "wb") as f:
        f.write(content)
    rows = {re.sub(".*:|>", "", r.record_id): r for r in warc.read_archives(spark, path).where("error IS NULL").collect()}
    assert {k: r.record_type for k, r in rows.items()} == {
        "i": "warcinfo", "q": "request", "r1": "response", "r2": "response", "s": "resource", "d": "response", "v": "revisit", "m": "metadata", "t": "response"}
    assert {k: r.payload and bytes(r.payload) for k, r in rows.items()} == {
        "i": b"software: x\r\n", "q": b"", "r1": body, "r2": b"plain", "s": b"\x00\xff", "d": b"20240501\r\nx. 300 IN A 1.2.3.4\r\n", "v": None, "m": b"", "t": b"cut"}
    assert rows["r1"].http_status == 200 and rows["r2"].http_status == 404 and rows["i"].version == "WARC/1.0" and rows["s"].http_status is None
    assert rows["i"].headers["warc-filename"] == "a.warc" and rows["r1"].date == "2024-05-01T12:00:00Z" and rows["d"].url == "dns:x"
    faults = sorted(r.error for r in warc.read_archives(spark, path).where("error IS NOT NULL").collect())
    assert faults == ["block does not match its digest", "payload does not match its length"]
    assert {r.page_id for r in warc.page_records(warc.read_archives(spark, path)).collect()} == {None}


def test_frame_ends_are_found():
    rnd = random.Random(1)
    for size in (0, 1, 255, 256, 70_000, 400_000):
        for data in (bytes(size), rnd.randbytes(size)):
            for sums in (False, True):
                frame = zstandard.ZstdCompressor(write_checksum=sums).compress(data)
                assert warc.frame_end(memoryview(frame + b"rest"), 0) == len(frame)


def test_faulty_records_are_told_apart():
    good = warc.record(1, "http://x", b"body", None)
    bad = [good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"WARC-Type", b"WARC-Tipe"), good.replace(b"body", b"bodies"),
           good.replace(b"body", b"ydob"), good[:-2], good.replace(b"Content-Length: 4", b"Content-Length: 5")]
    got = list(warc._walk(archive([good, *bad, good])))
    assert [r["error"] is None for r in got] == [True, *[False] * len(bad), True]
    whole = archive([good, good])
    cut = list(warc._walk(whole[:-3]))
    assert cut[0]["error"] is None and cut[-1]["error"] and len(cut) == 2
    assert [bool(r["error"]) for r in warc._walk(whole[:6])] == [True]


TOK = Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def check_pieces(pairs, rows, max_tokens=1024):
    ids = {}
    for i, t in pairs:
        ids.setdefault(i, []).append(np.array([*TOK.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4"))
    left = {i: sorted(x.tobytes() for x in v) for i, v in ids.items()}
    single = [i for i, v in ids.items() if len(v) == 1]
    for i in single:
        at, whole = 0, ids[i][0]
        for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(whole)
            assert bytes(r["token_bytes"]) == whole[at:at + r["length"]].tobytes()
            at += r["length"]
        assert at == len(whole)
    assert sum(r["length"] for r in rows) == sum(len(x) // 4 for v in left.values() for x in v)
    seqs = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == seqs.get(r["sequence_id"], 0)
        seqs[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n == max_tokens or (n < max_tokens and n & (n - 1) == 0) for n in seqs.values())


def test_packing_is_an_exact_partition(spark, make_docs):
    pairs = EDGES + [(100 + i, r.text) for i, r in enumerate(spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect())]
    for block in (1 << 20, 3000):
        rows = packing.pack(make_docs(pairs), P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, block_tokens=block).collect()
        check_pieces(pairs, [r.asDict() for r in rows])
    assert packing.pack(make_docs([]), P.path("byte_bpe_50k.json")).count() == 0


def test_both_tokenizer_libraries_give_the_same_ids():
    enc = packing.Encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rnd = random.Random(2)
    marks = "aZé ß\n\t\r\x0b\x85  'sll9٣漢字かな한글😀́<|endoftext|>Ж_-…"
    for _ in range(400):
        text = "".join(rnd.choice(marks) for _ in range(rnd.randrange(0, 60)))
        for t in (text, text + "<|endoftext|>"):
            assert enc.ids(t).tolist() == [*TOK.encode(t, add_special_tokens=False).ids, 0]


def test_pieces_go_to_the_cheapest_sequence_with_room():
    placed, rest = packing.balance([10, 7, 6, 5, 4], 16, 2, 1.0, 1.0)
    # 10 | 7, then 6 to the cheaper 7, 5 to 10 (13 has no room), 4 has no room whole: 1 + 3, nothing is left over
    assert [(i, s, n) for i, _, n, s, _ in placed] == [(0, 0, 10), (1, 1, 7), (2, 1, 6), (3, 0, 5), (4, 1, 3), (4, 0, 1)] and rest == []
    rnd = random.Random(3)
    lengths = [rnd.randint(1, 1023) for _ in range(400)]
    n = sum(lengths) // 1024
    placed, rest = packing.balance(lengths, 1024, n, 1.0, 1 / 1024)
    cost, used = np.zeros(n), np.zeros(n)
    for _, _, size, s, _ in placed:
        cost[s] += size + size * size / 1024
        used[s] += size
    assert (used == 1024).all() and sum(x[2] for x in rest) < 1024
    assert cost.std() < 0.25 * cost.mean()


def test_powers_of_two():
    assert packing.powers_of_two(700) == [512, 128, 32, 16, 8, 4] and packing.powers_of_two(0) == []


# ------------------------------------------------------------- pipeline

def test_pipeline_stages_follow_their_operators(spark):
    prepare(spark)
    docs = start = spark.read.parquet(f"{SF}/documents.parquet")
    ids = [set(r.doc_id for r in docs.select("doc_id").collect())]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, SF), name)
        assert docs.columns == start.columns and docs.dtypes == start.dtypes
        ids.append(set(r.doc_id for r in docs.select("doc_id").collect()))
        if name == "line_dedup":
            assert ids[-1] == ids[-2]
            assert docs.where("n_chars <> length(text)").count() == 0 and docs.count() == before.count()
    assert ids[0] > ids[1] and ids[2] > ids[3] > ids[4]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(labels.get(i, 0) == 0 for i in ids[0] - ids[1])      # no clean document is rejected
    rows = corpus_pipeline.pack(spark, docs, SF).collect()
    assert {r.doc_id for r in rows} == ids[4]
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in [r for r in rows if r.start == 0][:50]:
        whole = np.array([*TOK.encode(texts[r.doc_id], add_special_tokens=False).ids, 0], dtype="<u4")
        assert zlib.crc32(whole[:r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(whole)


def test_stages_take_edge_cases(spark, make_docs):
    prepare(spark)
    for pairs in (EDGES, []):
        docs = make_docs(pairs)
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            got = stage(spark, docs, SF)
            assert got.columns == docs.columns and got.count() <= len(pairs)
        scored = corpus_pipeline.quality(spark, docs, SF)
        assert scored.columns == docs.columns and scored.count() <= len(pairs)
        assert catalog.packed(docs).count() >= len(pairs)
    path = shared_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
