import base64
import gzip
import hashlib
import os
import time
import zlib

import pytest
import zstandard

from feedmart.llm import warc

PAGES = "page_id long, url string, html string"


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


HTML = "<html><head><title>A &amp; B</title><style>x</style></head><body><!-- no --><p>One <b>t</b>wo\n three</p><a href='/x?a=1&amp;b=2'>l</a><script>s</script>é"
ROWS = [(1, "https://a.example/1", HTML), (2, "https://a.example/2", None), (None, None, "plain\r\n\r\nWARC/1.0\r\n"), (3, "u", ""), (4, "https://l.example/", "<p>word</p>" * 60_000), (1, "https://a.example/1", HTML)]


def test_derived_records_link_to_their_response(spark):
    frame = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "1 as type", "'h' as headers", "'b' as BLOCK")
    made = warc.responses(frame, "2024-05-01T00:00:00Z")
    source = {r.record_id: r for r in made.collect()}
    got = warc.derive(made).collect()
    assert len(got) == 2 * len(ROWS) and {r.refers_to for r in got} == set(source) and len(source) == len(ROWS) - 1
    for r in got:
        origin = source[r.refers_to]
        payload = bytes(origin.block).split(b"\r\n\r\n", 1)[1]
        assert r.source_id == r.refers_to == r.headers["WARC-Refers-To"] and r.target_uri == origin.target_uri and r.date == origin.date
        assert r.headers["WARC-Refers-To-Payload-Digest"] == sha1(payload) == origin.headers["WARC-Payload-Digest"]
        assert all(r.headers[f"X-Source-{k}"] == v for k, v in origin.headers.items())
        assert r.block_digest == sha1(bytes(r.block)) == r.headers["WARC-Block-Digest"] and r.content_length == len(r.block)
    first = {r.type: r for r in got if r.headers.get("X-Source-X-Page-ID") == "1"}
    assert bytes(first["conversion"].block).decode() == "One two three\nl\né"
    meta = bytes(first["metadata"].block).decode().split("\r\n")
    assert f"conversion: {first['conversion'].record_id}" in meta and "title: A & B" in meta and "outlink: /x?a=1&b=2" in meta
    assert "source-status: HTTP/1.1 200 OK" in meta and "source-http-content-type: text/html; charset=utf-8" in meta
    again = {(r.record_id, r.block_digest) for r in warc.derive(made.repartition(3)).collect()}
    assert again == {(r.record_id, r.block_digest) for r in got}


def test_odd_responses(spark):
    rows = [
        ("r1", "response", None, None, None, bytearray(b"HTTP/1.0 404 Not Found\r\nX: 1")),
        ("r2", "response", "u", "d", {"A": None}, bytearray(b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x89PNG")),
        ("r3", "response", "u", "d", {}, bytearray(b"HTTP/1.1 200 OK\r\nContent-Type: text/plain; charset=latin-1\r\n\r\n\xe9t\xe9")),
        ("r4", "response", "u", "d", {}, bytearray(b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=no-such\r\n\r\nok")),
        (None, "response", "u", "d", {}, None), ("q", "request", "u", "d", {}, bytearray(b"GET /")),
    ]
    got = warc.derive(spark.createDataFrame(rows, warc.RECORD)).collect()
    kinds = {}
    for r in got:
        kinds.setdefault(r.refers_to, []).append((r.type, bytes(r.block)))
    assert len(kinds) == 5 and [k for k, _ in kinds["r2"]] == ["metadata"]
    assert dict(kinds["r3"])["conversion"] == "été".encode() and dict(kinds["r4"])["conversion"] == b"ok" and dict(kinds["r1"])["conversion"] == b""
    assert warc.derive(spark.createDataFrame([], warc.RECORD)).count() == 0


@pytest.mark.parametrize("options", [{}, {"compression": "gzip"}])
def test_files_read_back_as_they_were(spark, tmp_path, options):
    made = warc.responses(spark.createDataFrame(ROWS, PAGES), "2024-05-01T00:00:00Z")
    both = made.unionByName(warc.derive(made).select(*made.columns))
    warc.write(both.repartition(2), str(tmp_path / "out"), per_file=4, **options)
    key = lambda rows: [tuple("" if x is None else x for x in r) for r in rows]
    back = warc.read(spark, str(tmp_path / "out"))
    read, wrote = (sorted(key([(r.record_id, r.type, r.target_uri, r.date, str(sorted(r.headers.items())), bytes(r.block)) for r in df.collect()])) for df in (back, both))
    assert read == wrote
    assert len(warc.derive(back).collect()) == 2 * len(ROWS)


def test_text_behind_elements_without_end_tags():
    head = "<html><head><meta charset=utf-8><title>T <b></title><style>s</style><script>'<p>'</script>"
    for start in ("</head><body>", "<body>", "", "<p>", "<noscript>", "<template><p>"):
        assert warc.plain_text(f"{head}{start}One<p>two</p>") == "One\ntwo", start
    assert warc.plain_text("<head><title>T<body>One") == "One"
    assert warc.plain_text("<title>T</title>a<noscript>n</noscript>b<template>x<template>y</template>z</template>c") == "a\nb\nc"
    assert warc.plain_text("<p>a</p><svg><title>drawing</title></svg>") == "a\ndrawing"


def test_malformed_pages_are_read_in_linear_time():
    started = time.monotonic()
    for piece in ("<a ", "<svg ", "<!", "<a '", "<title>", "<noscript>", "<noscript ", "</title ", "<a href", "<"):
        page = "<body>one " + piece * (1_000_000 // len(piece))
        assert warc.plain_text(page).startswith("one")
        warc.derive_one("<urn:x>", None, None, {}, page.encode())
    nested = "<noscript>" * 50_000 + "hidden" + "</noscript>" * 50_000 + "<p>one"
    assert warc.plain_text(nested) == "one"
    assert time.monotonic() - started < 120


def test_elements_that_are_not_shown():
    assert warc.plain_text("a<noscript>b<noscript>c</noscript>d</noscript>e<template>f</template>g") == "a\ne\ng"
    assert warc.plain_text("a<noscript>b") == "a\nb" and warc.plain_text("a</noscript>b<template>c</template>") == "a\nb"
    assert warc.plain_text("<title>T</title>one <b two <i>three</i>") == "one three"


def coded(body, *headers, chunk=None):
    if chunk:
        body = b"".join(b"%x;a=b\r\n%s\r\n" % (len(body[i : i + chunk]), body[i : i + chunk]) for i in range(0, len(body), chunk)) + b"0\r\n\r\n"
    lines = b"".join(h.encode() + b"\r\n" for h in headers)
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + lines + b"\r\n" + body


def test_transfer_and_content_codings_are_undone():
    page = ("<title>T</title><p>one é</p>" + "<p>two</p>" * 3000).encode()
    text = ["one é", *["two"] * 3000]
    bare = zlib.compressobj(wbits=-15)
    bare = bare.compress(page) + bare.flush()
    packed = {
        "gzip": gzip.compress(page), "x-gzip": gzip.compress(page[:99]) + gzip.compress(page[99:]), "deflate": zlib.compress(page),
        "Deflate": bare, "zstd": zstandard.compress(page), "deflate, gzip": gzip.compress(zlib.compress(page)), "identity": page, "gzip, none": page,
    }
    conversion = lambda block: warc.derive_one("<urn:x>", None, None, {}, block)[1][-1].decode().split("\n")
    for coding, body in packed.items():
        assert conversion(coded(body, f"Content-Encoding: {coding}")) == text, coding
        assert conversion(coded(body, f"Content-Encoding: {coding}", "Transfer-Encoding: chunked", chunk=1000)) == text, coding
    assert conversion(coded(page, "Transfer-Encoding: chunked")) == text  # the crawler has undone it, but kept the header
    meta = warc.derive_one("<urn:x>", None, None, {}, coded(packed["gzip"], "Transfer-Encoding: chunked", chunk=7))[0][-1].decode()
    assert f"source-payload-digest: {sha1(packed['gzip'])}\r\n" in meta
    torn = conversion(coded(packed["gzip"][:-20], "Content-Encoding: gzip"))
    assert torn[0] == "one é" and set(torn[1:-1]) == {"two"} and len(torn) > 100
    assert conversion(coded(b"\x1f\x8b", "Content-Encoding: gzip")) and conversion(coded(b"", "Content-Encoding: gzip", "Transfer-Encoding: chunked")) == [""]
    assert conversion(coded(b"5\r\none t\r\n9\r\nwo", "Transfer-Encoding: chunked")) == ["one two"]


def test_broken_records_are_set_aside_and_repeated_headers_kept(spark, tmp_path):
    record = lambda i, body=b"x", length=None: (
        b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <%d>\r\nWARC-Concurrent-To: <a>\r\nWARC-Concurrent-To: <b>\r\nContent-Length: %s\r\n\r\n%s\r\n\r\n"
        % (i, length if length is not None else b"%d" % len(body), body)
    )
    whole = record(1) + record(2, length=b"many") + b"noise\r\n" + record(3, b"WARC/1.1\r\n\r\n") + record(4, b"abc", b"999999") + record(5, b"")
    torn = record(6) + record(7)[:30]
    (tmp_path / "a.warc").write_bytes(whole)
    (tmp_path / "b.warc").write_bytes(torn)
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(record(8)) + gzip.compress(record(9, os.urandom(5000)))[:-4000])
    (tmp_path / "d.warc").write_bytes(b"")
    good = warc.read(spark, str(tmp_path))
    rows = {r.record_id: r for r in good.collect()}
    assert set(rows) == {"<1>", "<3>", "<5>", "<6>", "<8>"} and bytes(rows["<3>"].block) == b"WARC/1.1\r\n\r\n"
    assert all(r.headers == {"WARC-Concurrent-To": "<a>\n<b>"} for r in rows.values())
    broken = sorted((r.file[-6:], r.reason) for r in warc.read_broken(spark, str(tmp_path)).collect())
    assert broken == [("a.warc", "no length"), ("a.warc", "torn block"), ("arc.gz", "torn block"), ("b.warc", "torn header")]
    warc.write(good, str(tmp_path / "out"))
    again = {r.record_id: r for r in warc.read(spark, str(tmp_path / "out")).collect()}
    assert again == rows and warc.read_broken(spark, str(tmp_path / "out")).count() == 0
