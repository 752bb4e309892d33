from __future__ import annotations

import gzip
import hashlib

import corpus_pipeline
from strata.llm import common, simhash, warc
from tests.conftest import SF001
from tests.llm.data import empty, frame, prose, rows

PAGES = "page_id long, url string, html string, record_type string"


def pages():
    big = "<p>" + prose(1, 60) + "</p>"
    tricky = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + prose(2, 40)
    return [(5, "http://a/5", big, None), (2, "http://a/2\r\nX: y", big, None), (9, None, big, None),
            (1, "u", "short", None), (3, "u", "short", None), (4, "u", None, None), (6, "u", "", None),
            (7, "u", tricky, None), (8, "u", tricky, None), (10, "u", "é" * 50, None), (11, "u", "é" * 50, None)]


def test_round_trip(spark, tmp_root):
    out = warc.deduplicated_archive(spark.createDataFrame(pages(), PAGES).repartition(3), f"{tmp_root}/w")
    first = {}
    for i, _, h, _ in pages():
        first[h or ""] = min(i, first.get(h or "", i))
    want = set()
    for i, _, h, _ in pages():
        b = (h or "").encode()
        later = len(b) >= 100 and first[h] != i
        want.add((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if later else "response",
                  first[h] if later else None))
    assert {tuple(r) for r in out.select("page_id", "payload_bytes", "payload_digest", "record_type",
                                         "refers_to").collect()} == want
    bodies = warc.read_archives(spark, f"{tmp_root}/w", with_payload=True).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in bodies if r.record_type == "response"} == {
        i: h or "" for i, _, h, _ in pages() if i in {w[0] for w in want if w[3] == "response"}}
    assert all(not r.payload for r in bodies if r.record_type == "revisit")


def test_empty_and_repeated_pages(spark, tmp_root):
    assert warc.deduplicated_archive(spark.createDataFrame([], PAGES), f"{tmp_root}/none").count() == 0
    twice = spark.createDataFrame([pages()[0], pages()[0], (None, "u", pages()[0][2], None)], PAGES)
    got = sorted((str(r.page_id), r.record_type) for r in warc.deduplicated_archive(twice, f"{tmp_root}/t").collect())
    assert got == [("5", "response"), ("5", "response"), ("None", "revisit")]


def test_parser_reads_any_members():
    rec = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    one, many = gzip.compress(rec * 3), gzip.compress(rec) * 3
    for blob in (one, many):
        assert [p for _, p in warc.parse_archive(blob)] == [b"hello"] * 3


def test_stages_bear_odd_rows(spark):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame(spark), SF001)
        extra = ["copies", "taken"] if name == "mixing" else []
        assert out.columns == frame(spark).columns + extra, name
        assert out.count() <= len(rows())
        assert stage(spark, empty(spark), SF001).count() == 0, name


def test_pipeline_stage_by_stage(spark):
    """run() against the stages' own decisions, made again one by one."""
    docs = common.table(spark, SF001, "documents")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    toxic = corpus_pipeline.toxicity_stage(spark, docs, SF001).cache()
    kept = {r.doc_id for r in toxic.select("doc_id").collect()}
    near = simhash.near_duplicates(toxic).collect()
    kept = {r.doc_id for r in near if r.doc_id == r.component_id}
    bench = [r.text for r in common.table(spark, SF001, "benchmark").collect()]
    import re
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: word.findall(t.translate({c: c + 32 for c in range(65, 91)}))       # noqa: E731
    grams = {tuple(w[i:i + 10]) for w in map(low, bench) for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(g) for g in grams}
    texts = {r.doc_id: low(r.text) for r in docs.collect()}
    clean = {i for i in kept if not any(tuple(texts[i][s:s + n]) in grams
                                        for n in sizes for s in range(len(texts[i]) - n + 1))}
    out = corpus_pipeline.run(spark, SF001).collect()
    got = {r.doc_id for r in out}
    assert len(got) == len(out) and got <= clean <= ids
    assert all(1 <= r.copies <= 3 for r in out)
    missing = clean - got               # the mix takes others in their place
    assert len(missing) < len(clean)
