import base64
import hashlib
import random
import time
from html.parser import HTMLParser

import pytest

from punctual.llm import warc

SCHEMA = "page_id long, url string, html string, block string"
PAGE = '<html><head><title>T &amp; U</title><style>p{}</style><script>var a="</p>";</script></head><body><!-- no --><p>One  two</p><div>three<br>four</div></body></html>'


def test_derivatives_link_to_their_source(spark):
    rows = [(1, "http://a.example/x", PAGE, ""), (2, None, None, None), (3, "http://b.example/\r\nInjected: 1", "", ""), (4, "u", "z" * 300_000, ""), (1, "http://a.example/x", PAGE, "")]
    got = warc.derivatives(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 15
    by = {(r.page_id, r.warc_type): r for r in got}
    for page, url, page_html, _ in rows:
        source = warc.response(url, (page_html or "").encode(), page)
        r = by[page, "response"]
        assert (r.record_id, r.refers_to, r.block) == (source.get("WARC-Record-ID"), None, source.block.decode())
        for kind in ("metadata", "conversion"):
            r = by[page, kind]
            assert r.refers_to == source.get("WARC-Record-ID") != r.record_id
            assert r.payload_digest == "sha1:" + base64.b32encode(hashlib.sha1((page_html or "").encode()).digest()).decode()
            assert r.block_digest == warc.digest(r.block.encode()) and r.content_length == len(r.block.encode())
        assert f"source-payload-digest: {source.get('WARC-Payload-Digest')}" in by[page, "metadata"].block
    assert by[1, "conversion"].block == "T & U\nOne two\nthree\nfour"
    assert by[2, "conversion"].block == "" and by[2, "conversion"].target_uri is None
    assert by[3, "metadata"].target_uri == "http://b.example/ Injected: 1"


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip(compress):
    source = warc.response("http://a.example/é", PAGE.encode(), 1)
    records = [source, *warc.derive(source), warc.Record([("WARC-Type", "warcinfo"), ("Content-Length", "0")])]
    data = warc.dumps(records, compress)
    assert warc.loads(data) == records
    assert [warc.derive(r) for r in warc.loads(data) if r.get("WARC-Type") == "response"] == [tuple(records[1:3])]


def test_cut_off_records_raise():
    data = warc.dumps([warc.response("u", b"page", 1)], compress=False)
    for bad in (data[:-5], b"junk", data + b"WARC/1.1\r\n"):
        with pytest.raises(ValueError):
            warc.loads(bad)


def test_written_members_read_back(spark, tmp_path):
    warc.write(spark.createDataFrame([(1, "u", PAGE, "")], SCHEMA), str(tmp_path / "w"))
    members = spark.read.parquet(str(tmp_path / "w")).collect()
    assert [r.get("WARC-Type") for r in warc.loads(bytes(members[0].warc))] == ["response", "metadata", "conversion"]


def test_files_of_records_are_read_and_derived(spark, tmp_path):
    sources = [warc.response(f"http://a.example/{i}", (PAGE * i).encode(), i, date=f"2024-01-0{i + 1}T00:00:00Z", headers=[("Server", f"s{i}")]) for i in range(4)]
    info = warc.Record([("WARC-Type", "warcinfo"), ("Content-Length", "4")], b"a: b")
    bare = warc.Record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("Content-Length", "9")], b"no header")
    (tmp_path / "a.warc.gz").write_bytes(warc.dumps([info, *sources[:2]]))
    (tmp_path / "b.warc").write_bytes(warc.dumps([*sources[2:], bare], compress=False))
    (tmp_path / "c.warc").write_bytes(b"")
    records = warc.read(spark, str(tmp_path))
    assert records.count() == 6
    got = {(r.refers_to, r.warc_type): r for r in warc.derived(records).collect()}
    assert len(got) == 10
    for s in [*sources, bare]:
        for r in warc.derive(s):
            row = got[s.get("WARC-Record-ID"), r.get("WARC-Type")]
            assert (row.record_id, row.target_uri, row.block, row.block_digest) == (r.get("WARC-Record-ID"), r.get("WARC-Target-URI"), r.block.decode(), r.get("WARC-Block-Digest"))
    assert "http-server: s1" in got[sources[1].get("WARC-Record-ID"), "metadata"].block
    (tmp_path / "d.warc").write_bytes(warc.dumps([bare], compress=False)[:-6])
    with pytest.raises(Exception, match="cut off"):
        warc.read(spark, str(tmp_path)).count()


class Plain(HTMLParser):
    """The same text through the standard parser."""

    def __init__(self):
        super().__init__()
        self.hidden, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        self.out.append("\n" if tag in ("p", "div", "li", "h1", "title", "br") else "")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")
        self.out.append("\n" if tag in ("p", "div", "li", "h1", "title") else "")

    def handle_data(self, data):
        self.out.append("" if self.hidden else data)

    def text(self, page):
        self.feed(page)
        self.close()
        return "\n".join(x for x in (" ".join(line.split()) for line in "".join(self.out).split("\n")) if x)


def test_text_agrees_with_a_parser():
    rng = random.Random(7)
    inner = ["one &amp; two", "x &lt; y", "<b>bold</b> text", "<br>", "<p>para</p>", "<!-- <p>gone</p> -->", "<script>if (a<b) { '</p>' }</script>", "<STYLE>p > a {}</STYLE >", "<div title='q'>d</div>", "<li>item", "caf\u00e9", "<h1>H</h1>", "&#233;t&eacute;"]
    for _ in range(200):
        page = "<html><head><title>t</title></head><body>" + " ".join(rng.choice(inner) for _ in range(rng.randint(0, 30))) + "</body></html>"
        assert warc.plain_text(page.encode()) == Plain().text(page)


@pytest.mark.parametrize("piece", [b"<!--", b"<script>", b"<a ", b"<p", b"</scriptx", b"<script></scriptx>", b"&amp", b"<!-- -->", b"<svg"])
def test_hostile_pages_take_linear_time(piece):
    began = time.time()
    warc.plain_text(piece * 100_000)
    assert time.time() - began < 5
    assert warc.plain_text(b"<p>seen</p><!-- no end " + piece) == "seen"


def test_empty_table(spark):
    assert warc.derivatives(spark.createDataFrame([], SCHEMA)).count() == 0
