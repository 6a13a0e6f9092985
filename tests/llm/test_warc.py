import gzip
import io

import pytest

from ledgerloom.llm import common, warc

PAGES = [(1, "http://a/", "<p>é one</p>"), (2, "http://b/", "<p>é one</p>"), (3, None, None), (9, "u\r\nx: y\u2028 z", ""), (4, "http://c/", "x" * 300_000), (5, "http://d", "\r\n\r\n"), (6, "", "a\r\n\r\nb"), (2, "http://b/2", "<p>é one</p>"), (None, "n", "lone"), (7, "p", "pair"), (None, "q", "pair")]


def want(rows, least=0):
    top = {}
    for page, _, html in rows:
        key = html or ""
        top[key] = max([x for x in (top.get(key), page) if x is not None], default=None)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        revisit = len(body) >= least and page != top[html or ""]
        out.append((page, len(body), warc.digest(body), "revisit" if revisit else "response", top[html or ""] if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, table, least):
    folder = common.new_folder(spark, "warc-test")
    names = warc.write(table(PAGES, "page_id long, url string, html string"), folder, least=least)
    found = warc.read(spark, folder, names, payload=True).collect()
    assert sorted((tuple(r[:5]) for r in found), key=repr) == want(PAGES, least)
    for r in found:
        if r.record_type == "response":
            assert warc.digest(r.payload) == r.payload_digest and len(r.payload) == r.payload_bytes
        else:
            assert r.payload == b""
    assert "u%0D%0Ax:%20y%E2%80%A8%20z" in {r.url for r in found}
    common.remove(folder)


def members(rows):
    return [warc.record(page, "http://x/", body, refers, refers is not None) for page, body, refers in rows]


def test_every_record_is_a_gzip_member():
    parts = members([(1, b"abc", None), (2, b"abc", 1)])
    for part in parts:
        assert gzip.decompress(part).startswith(b"WARC/1.1\r\n")
    found = []
    for one in warc.records(io.BytesIO(b"".join(parts))):
        body = b"".join(one.payload())
        found.append((one.page("warc-record-id"), one.fields["warc-type"], body))
    assert found == [(1, "response", b"abc"), (2, "revisit", b"")]


def test_damage_is_found():
    whole = members([(1, b"some payload" * 20, None)])[0]

    def read(data):
        for one in warc.records(io.BytesIO(data)):
            for _ in one.payload():
                pass

    read(whole)
    for cut in (5, len(whole) // 2, len(whole) - 1):
        with pytest.raises(warc.Damaged):
            read(whole[:cut])
    plain = gzip.decompress(whole)
    for bad in (plain.replace(b"some", b"SOME", 1), plain.replace(b"Content-Length: 3", b"Content-Length: 2", 1), plain[:-4], plain + b"x", b"HTTP" + plain[4:]):
        with pytest.raises(warc.Damaged):
            read(gzip.compress(bad))
    # Records that a caller skips are passed over.
    two = b"".join(members([(1, b"a" * 200_000, None), (2, b"b", None)]))
    assert [one.page("warc-record-id") for one in warc.records(io.BytesIO(two))] == [1, 2]


def test_empty_table(spark, table):
    folder = common.new_folder(spark, "warc-test")
    names = warc.write(table([], "page_id long, url string, html string"), folder)
    assert names == [] and warc.read(spark, folder, names).count() == 0
