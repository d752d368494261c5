import hashlib

import pytest
from conftest import plan_of
from helpers import clashing

from suretygraph.llm import warc
from suretygraph.storage import staging_folder

MARK = "\nWARC/1.1\r\n"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def records(spark, frame, **options):
    folder = f"{staging_folder(spark)}/warc"
    warc.write_archives(frame, folder, **options)
    return folder, warc.read_records(spark, folder).collect()


ROWS = [
    (1, "http://a/ü?x=%0A", "x" * 250), (2, "http://b/\r\nWARC-Type: fake", "x" * 250), (3, None, "short"), (4, "u", "short"),
    (5, "u", None), (6, "u", ""), (7, "u", MARK * 30), (8, "u", MARK[1:] * 12), (9, "u", "é" * 77 + "\r\n\r\n" * 9 + "\r\n"),
    (10, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\nWARC/1.1\r\n" * 5), (11, "u", "\r\n" * 60), (12, "u", "\0\1" * 80),
    (None, "u", "x" * 250), (None, "u", "only without an id " * 9), (13, "u", "y" * 100), (13, "u", "y" * 100), (14, "u", "y" * 100),
    (15, "u", "z" * 99), (16, "u", "z" * 99), (None, None, None), (17, "u", "😀" * 5000),
]


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 16])
@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_round_trip(spark, chunk, compression):
    if chunk == 1 and compression == "gzip":
        return
    rows = [r for r in ROWS if chunk > 1 or len(r[2] or "") < 400]
    folder, found = records(spark, clashing(pages(spark, rows)).repartition(3), chunk=chunk, compression=compression)
    wanted = []
    least = {}
    for i, _, html in rows:
        if i is not None:
            least[html or ""] = min(least.get(html or "", i), i)
    for i, url, html in rows:
        body = (html or "").encode()
        first = least.get(html or "")
        revisit = len(body) >= 100 and first is not None and (i is None or i > first)
        wanted.append((i, url, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    order = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.kind, r.refers_to) for r in found), key=order) == sorted(wanted, key=order)
    blocks = warc.read_chunks(spark, folder).collect()
    assert all(len(b.block) <= chunk and warc._VERSION.encode() not in bytes(b.block) for b in blocks)
    whole = {}
    for b in sorted(blocks, key=lambda b: b.number):
        whole.setdefault(b.record, []).append(bytes(b.block))
    texts = {(html or "").encode() for _, _, html in rows} | {b""}
    assert {b"".join(v) for v in whole.values()} <= texts


def test_damage_is_an_error(spark):
    folder = f"{staging_folder(spark)}/warc"
    warc.write_archives(pages(spark, [(1, "u", "abc" * 50)]), folder, compression="none")
    lines = spark.read.option("lineSep", warc._END).text(folder)
    broken = f"{folder}-broken"
    lines.selectExpr("replace(value, 'abcabc', 'abcabd') AS value").coalesce(1).write.option("lineSep", warc._END).text(broken)
    with pytest.raises(Exception, match="damaged"):
        warc.read_records(spark, broken).collect()


def test_empty_table(spark):
    assert records(spark, pages(spark, []))[1] == []


def test_a_payload_of_many_chunks_is_cut_before_any_shuffle(spark):
    """Some megabytes each, three copies, and one page of its own."""
    frame = spark.range(4).selectExpr("id AS page_id", "'u' AS url", "repeat(if(id = 3, '0123456789abcde\n', 'payload of a page\n'), 400000) AS html")
    folder, found = records(spark, frame)
    assert sorted((r.page_id, r.kind, r.refers_to, r.payload_bytes) for r in found) == [
        (0, "response", None, 7_200_000), (1, "revisit", 0, 7_200_000), (2, "revisit", 0, 7_200_000), (3, "response", None, 6_400_000)]
    blocks = warc.read_chunks(spark, folder).selectExpr("kind", "octet_length(block) AS n")
    assert blocks.filter(f"n > {warc.CHUNK}").isEmpty()
    assert blocks.filter("kind = 'continuation'").count() == -(-7_200_000 // warc.CHUNK) + -(-6_400_000 // warc.CHUNK) - 2
    joined = warc.chunks(warc.payloads(frame, "page_id", "url", "html").selectExpr("*", "'r' AS record"))
    assert "Exchange" not in plan_of(joined)
