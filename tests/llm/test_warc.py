import hashlib
import random

import pytest

from chunkloom.llm import warc

SCHEMA = "page_id bigint, url string, html string, payload string"


def expected(rows, min_bytes):
    largest, count = {}, {}
    for page, _, html, *_ in rows:
        body = (html or "").encode()
        if len(body) >= min_bytes:
            count[body] = count.get(body, 0) + 1
            if page is not None:
                largest[body] = max(page, largest.get(body, page))
    out = []
    for page, _, html, *_ in rows:
        body = (html or "").encode()
        first = largest.get(body) if page is not None and len(body) >= min_bytes else None
        first = first if first is not None and first > page else None
        out.append((page, "revisit" if first is not None else "response", first, len(body), hashlib.sha1(body).hexdigest()))
    return sorted(out, key=repr)


def read_back(spark, rows, path, min_bytes):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(2)
    warc.write_archives(frame, path, min_bytes)
    return sorted((tuple(r) for r in warc.read_archives(spark, path).collect()), key=repr)


@pytest.mark.parametrize("split_bytes", [1 << 26, 3000])
def test_records_survive_magic_in_payloads(spark, tmp_path, split_bytes):
    rng = random.Random(5)
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:9>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(None, None, None), (1, "http://a/\r\nx", ""), (2, "u", "WARC/1.1\r\n"), (3, "u", fake), (4, "u", fake * 3 + "tail")]
    rows += [(5, "u", "start " + fake * 2), (6, "u", "x" * 40), (7, "u", "x" * 40), (7, "u", "x" * 40), (None, "u", "x" * 40)]
    rows += [(8, "u", "é" * 30000 + fake), (9, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 99999\r\n\r\n")]
    rows += [(10 + i, f"http://h/{i}", rng.choice(["short", "long " * rng.randrange(200), fake])) for i in range(80)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        assert read_back(spark, rows, str(tmp_path / "w"), 30) == expected(rows, 30)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_pages(spark, tmp_path):
    assert read_back(spark, [], str(tmp_path / "none"), 30) == []


def archive(spark, tmp_path, n=5):
    """The text of an archive of ``n`` records, and where each begins."""
    rows = [(i, "u", "text", "") for i in range(n)]
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), str(tmp_path / "w"))
    text = "".join(r[0] for r in spark.read.text(str(tmp_path / "w"), wholetext=True).collect())
    return text, [i for i in range(len(text)) if text.startswith("WARC/1.1", i)]


@pytest.mark.parametrize("split_bytes", [700])
def test_damaged_files(spark, tmp_path, split_bytes):
    text, begins = archive(spark, tmp_path)
    other = text.replace("\r\n\r\ntext", "\r\n\r\nTEXT", 1)
    damaged = {
        "broken": (text[: begins[2]] + "??" + text[begins[2] :], 2, begins[2], "chain"),
        "cut": (text[:-3], 4, begins[4], "chain"),
        "cut-head": (text[: begins[3] + 30], 3, begins[3], "chain"),
        "foreign": ("no archive\n" * 9, 0, 0, "chain"),
        "long": (text[: begins[1]] + text[begins[1] :].replace("Content-Length: ", "Content-Length: 999", 1), 1, begins[1], "chain"),
        "payload": (other, 4, begins[0], "payload"),
    }
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        folder = tmp_path / "all"
        folder.mkdir()
        for name, (content, *_) in damaged.items():
            (folder / name).write_bytes(content.encode())
        (folder / "empty").write_bytes(b"")
        found = [(r["file"].rsplit("/", 1)[1], *tuple(r)[1:]) for r in warc.damaged_parts(spark, str(folder)).collect()]
        assert sorted(found) == sorted((name, offset, damage) for name, (_, _, offset, damage) in damaged.items())
        assert warc.read_archives(spark, str(folder), skip_damaged=True).count() == sum(d[1] for d in damaged.values())
        with pytest.raises(ValueError, match=f"broken is damaged at byte {begins[2]}$"):
            warc.read_archives(spark, str(folder))
        (tmp_path / "two").mkdir()
        (tmp_path / "two" / "a").write_bytes(damaged["payload"][0].encode())
        with pytest.raises(Exception, match="a payload is not what its headers say"):
            warc.read_archives(spark, str(tmp_path / "two")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_many_shared_digests_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    rows = [(i, "u", f"text {i // 3}" * 9) for i in range(30)]
    assert read_back(spark, rows, str(tmp_path / "w"), 30) == expected(rows, 30)
