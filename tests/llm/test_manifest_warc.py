"""Merkle manifest and WARC archives against plain versions, on given tables and awkward rows."""

import gzip
import hashlib
import io
import json
import zlib

import duckdb
import pytest
from pyspark.sql import Row

from frostline.llm import merkle, sql, warc
from frostline.llm.common import Stages, table
from frostline.session import new_folder

DOCUMENT = "doc_id bigint, source string, lang string, n_chars bigint, text string, at int, hash string, tree string, level int"
PAGE = "page_id bigint, url string, html string, archive string, seq int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle_by_hand(rows):
    """The same rows from plain lists of levels."""
    def leaf(r, text):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)])

    def lowered(text):
        return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    def levels(digests):
        out = [digests]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
        return out

    def fold(tree, place, digest, proof):
        for level in tree[:-1]:
            first = place // 8 * 8
            run = level[first:first + 8]
            left, right = run[:place - first], run[place - first + 1:]
            proof += left + right
            digest, place = h(*left, digest, *right), place // 8
        return digest

    leaves = {}
    for r in rows:
        tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
        leaves.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), leaf(r, lowered(r.text)) if tampered else None, r.doc_id))
    langs = sorted(leaves, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in langs:
        leaves[lang].sort(key=lambda x: x[:3])
        trees[lang] = levels([x[2] for x in leaves[lang]])
    top = levels([trees[lang][-1][0] for lang in langs])
    out = []
    for rank, lang in enumerate(langs):
        for place, (_, _, own, changed, doc_id) in enumerate(leaves[lang]):
            proof = []
            root = fold(top, rank, fold(trees[lang], place, changed or own, proof), proof)
            out.append((doc_id, own, trees[lang][-1][0], top[-1][0], h(*proof), root, root == top[-1][0]))
    return sorted(out, key=str)


def awkward_documents():
    rows = [Row(doc_id=n, source="s", lang="hot", n_chars=n, text=f"Text Of {n}", at=1, hash="x", tree="y", level=3) for n in range(600)]
    rows += [Row(doc_id=n, source=None, lang=f"l{n:02d}", n_chars=None, text=None, at=1, hash="x", tree="y", level=3) for n in range(70)]
    rows += [Row(doc_id=None, source="", lang=None, n_chars=0, text="", at=None, hash=None, tree=None, level=None)] * 3
    rows += [Row(doc_id=7, source="same", lang="é", n_chars=1, text="ÄAßİ" * 5000, at=1, hash="x", tree="y", level=3)] * 11
    rows += [Row(doc_id=8, source="tie", lang="é", n_chars=n, text="T", at=1, hash="x", tree="y", level=3) for n in range(9)]
    return rows


def proofs_of(docs, spark):
    found = merkle.proofs(docs, Stages(spark))
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_manifest_equals_plain_version(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    assert proofs_of(docs, spark) == merkle_by_hand(docs.collect())


def test_manifest_of_awkward_rows(spark):
    rows = awkward_documents()
    got = proofs_of(spark.createDataFrame(rows, DOCUMENT).repartition(5), spark)
    assert got == merkle_by_hand(rows)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("count", [0, 1, 8, 9])
def test_manifest_of_few_rows(spark, count):
    rows = awkward_documents()[:count]
    assert proofs_of(spark.createDataFrame(rows, DOCUMENT), spark) == merkle_by_hand(rows)


def test_later_jumps_use_salted_copies(spark, monkeypatch):
    monkeypatch.setattr(merkle, "CROWD", 1)
    rows = awkward_documents()
    assert proofs_of(spark.createDataFrame(rows, DOCUMENT), spark) == merkle_by_hand(rows)


def test_proof_leads_to_the_root_and_to_no_other(spark, sf_dir):
    row = merkle.manifest(table(spark, sf_dir, "documents"), Stages(spark)).filter("doc_id = 5").first()

    def fold(digest):
        for step in row.steps:
            if not step.alone:
                digest = h(*[digest if i == step.place else k.hex() for i, k in enumerate(step.kids)])
        return digest

    assert fold(row.leaf.hex()) == row.root.hex() != fold(h("other"))


def records_of(pages, spark, **limits):
    found = warc.round_trip(pages, Stages(spark), **limits)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def warc_by_sql(rows):
    import pandas as pd

    con = duckdb.connect()
    frame = pd.DataFrame([(r.page_id, r.html) for r in rows], columns=["page_id", "html"]).astype({"page_id": "Int64", "html": "string"})
    con.register("given", frame)
    con.execute("CREATE VIEW pages AS SELECT page_id, CAST(html AS VARCHAR) AS html FROM given")
    return sorted(con.execute(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({sql.WARC})").fetchall(), key=str)


def awkward_pages():
    page = lambda n, html, url="http://h/": Row(page_id=n, url=url, html=html, archive="a", seq=0)
    rows = [page(n, "<p>hot copy</p>" * 10, f"http://h{n}/ä b\r\nX: y") for n in range(400)]
    rows += [page(n, f"<p>{n}</p>") for n in range(400, 430)]
    rows += [page(n, "short", None) for n in range(430, 440)] + [page(n, None, "") for n in range(440, 444)] + [page(444, "")]
    rows += [page(n, "x" * 99) for n in (445, 446)] + [page(n, "x" * 100) for n in (448, 447)]
    rows += [page(500, "WARC/1.1\r\n\r\nHTTP\r\n\r\n" + "é漢" * 400_000)] * 2   # longer than any piece, written twice
    rows += [page(None, "without an id" * 20), page(600, "without an id" * 20), page(None, "none has an id" * 20), page(None, "none has an id" * 20)]
    return rows


@pytest.mark.parametrize("limits", [{}, {"archive_bytes": 2000, "archive_records": 30}])
def test_archives_of_awkward_rows(spark, limits):
    rows = awkward_pages()
    pages = spark.createDataFrame(rows, PAGE).repartition(4)
    assert sorted((tuple(r) for r in records_of(pages, spark, **limits).collect()), key=str) == warc_by_sql(rows)


def test_no_pages_no_records(spark):
    assert records_of(spark.createDataFrame([], PAGE), spark).count() == 0


def test_archives_on_disk(spark, sf_dir):
    """Raw archives are one member; normalised ones open at every offset of the sidecar and hold the whole html."""
    stages, raw, folder = Stages(spark), new_folder(spark, "raw"), new_folder(spark, "norm")
    pages = table(spark, sf_dir, "pages")
    written = warc.write(pages, raw, stages, archive_bytes=200_000)
    for row in written.select("archive").distinct().collect():
        engine = zlib.decompressobj(31)
        with open(row.archive, "rb") as data:
            engine.decompress(data.read())
        assert engine.eof and not engine.unused_data
    html = {r.page_id: r.html for r in pages.collect()}
    seen = {}
    for row in warc.normalise(written, folder, stages).collect():
        whole, end = open(row.archive, "rb").read(), 0
        entries = [json.loads(line) for line in open(row.sidecar)]
        assert len(entries) == row.records
        for entry in entries:
            assert entry["offset"] == end
            end += entry["length"]
            fields, http, payload = warc.parse(gzip.decompress(whole[entry["offset"]:end]))
            if entry["type"] == "response":
                seen[warc.page_of(entry["id"])] = payload.decode()
        assert end == len(whole)
    assert seen == html


def member(kind, block, **fields):
    return warc.head(kind, len(block), {"WARC-Record-ID": f"<urn:x:{kind}>", **fields}) + block + b"\r\n\r\n"


def test_other_layouts_are_normalised_too():
    """Several members, records cut anywhere, kinds that are only copied."""
    http = warc.http_head(5) + b"hello"
    stream = member("warcinfo", b"note") + member("response", http, **{"WARC-Target-URI": "u", "Content-Type": "t"}) + member("metadata", b"")
    for cuts in ([], [10], [50, 51, 300], list(range(20, len(stream), 7))):
        source = b"".join(gzip.compress(stream[a:b]) for a, b in zip([0, *cuts], [*cuts, len(stream)]))
        out = io.BytesIO()
        entries = list(warc.rewrite(io.BytesIO(source), out, {}))
        assert [e["type"] for e in entries] == ["warcinfo", "response", "metadata"]
        assert b"".join(gzip.decompress(out.getvalue()[e["offset"]:e["offset"] + e["length"]]) for e in entries) == stream


def test_damaged_archives_are_refused():
    whole = gzip.compress(member("warcinfo", b"note" * 100))
    for source in (whole[:-20], gzip.compress(member("warcinfo", b"note")[:-6]), gzip.compress(b"WARC/1.1\r\nno end")):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.rewrite(io.BytesIO(source), io.BytesIO(), {}))
    wrong = member("response", warc.http_head(2) + b"ab", **{"WARC-Target-URI": "u", "WARC-Payload-Digest": "sha256:00"})
    with pytest.raises(ValueError):
        list(warc.rewrite(io.BytesIO(gzip.compress(wrong)), io.BytesIO(), {}))
