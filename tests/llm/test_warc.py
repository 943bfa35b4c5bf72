import hashlib
import base64
import json

from skyloom.llm import warc

PAGES = "page_id long, url string, html string, headers string"
PAGE = """<html><head><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script></head><body>
<!-- gone --><h1>Head</h1><p>one<br>two <b>bold</b>&copy;</p><script>x<y</script><a href="/next?a=1&amp;b">link</a> 3 < 4 <p></p></body></html>"""


def records(spark, pages):
    return warc.responses_of(spark.createDataFrame([(*p, "clash") for p in pages], PAGES))


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_derivatives_refer_to_their_response(spark):
    found = records(spark, [(1, "http://a.net/x/y", PAGE), (2, None, None), (None, "http://b.net", "plain"), (1, "http://a.net/x/y", PAGE)])
    responses = {r["record_id"]: r for r in found.collect()}
    derived = warc.derive(found).collect()
    assert len(derived) == 8 and len(responses) == 3
    for row in derived:
        source, headers = responses[row["refers_to"]], dict(row["headers"])
        payload = bytes(source["content"]).partition(b"\r\n\r\n")[2]
        assert headers["WARC-Refers-To"] == source["record_id"] and headers["WARC-Target-URI"] == source["target_uri"]
        assert headers["WARC-Source-Payload-Digest"] == source["headers"]["WARC-Payload-Digest"] == sha(payload)
        assert headers["WARC-Block-Digest"] == sha(bytes(row["content"])) and headers["Content-Length"] == str(len(row["content"]))
        if row["record_type"] == "metadata":
            about = json.loads(bytes(row["content"]))
            assert about["warc-header"] == source["headers"] and about["http-headers"]["content-length"] == str(len(payload))
    one = next(r["record_id"] for r in responses.values() if r["target_uri"] == "http://a.net/x/y")
    mine = {r["record_type"]: bytes(r["content"]).decode() for r in derived if r["refers_to"] == one}
    assert mine["conversion"] == "Head\none\ntwo bold\u00a9\nlink 3 < 4"
    about = json.loads(mine["metadata"])
    assert about["title"] == "A & B" and about["links"] == [{"element": "a", "url": "http://a.net/next?a=1&b"}]


def test_files_round_trip(spark):
    found = records(spark, [(i, f"http://a.net/{i}", PAGE * i) for i in range(5)])
    every = found.unionByName(warc.derive(found))
    members = [bytes(r["member"]) for r in warc.encode(every).collect()]
    back = warc.decode(spark.createDataFrame([(bytearray(b"".join(members)),)], "content binary"))
    key = lambda rows: sorted((r["record_id"], r["record_type"], str(r["refers_to"]), bytes(r["content"]), sorted(r["headers"].items())) for r in rows)
    assert key(back.collect()) == key(every.collect())
    assert next(warc.parsed(b"".join(members)))[0]["WARC-Type"] == "response"


def test_charsets_odd_markup_and_empty_tables(spark):
    assert warc.decoded("\u00e9".encode("latin-1"), {"content-type": "text/html; charset=ISO-8859-1"}) == "\u00e9"
    assert warc.decoded(b'<meta charset="cp1252">\x93', {}).endswith("\u201c")
    assert warc.decoded(b"\xff", {"content-type": "text/html; charset=nonsense"}) == "\ufffd"
    assert warc.plain_text("a<script>never closed <p>b") == "a" and warc.plain_text("<p>1<p>2") == "1\n2"
    assert warc.split_http(b"no header") == ("", {}, b"no header")
    empty = records(spark, [])
    assert warc.derive(empty).count() == 0 and warc.encode(empty).count() == 0


def test_refusing_charsets_bad_lengths_and_an_open_head():
    for charset in ("undefined", "idna", "no-such-codec"):
        assert warc.decoded("café".encode(), {"content-type": f"text/html; charset={charset}"}) == "café"
    assert warc.plain_text("<html><head><title>T</title><body><p>visible text") == "visible text"
    assert warc.plain_text("<head><meta charset=utf-8><title>T</title><p>shown</p>") == "shown"
    block = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: x\r\n\r\nabc\r\n\r\nWARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    found = list(warc.parsed(block))
    assert [(h["WARC-Type"], c) for h, c in found] == [("response", b"abc"), ("metadata", b"ok")]
