import gzip
import hashlib
from pathlib import Path

from clientele.llm.staging import Staging
from clientele.llm.warc import open_store, read_warc, write_warc

PAGES = "page_id long, url string, html string, shard string, kind string, digest string"


def pages():
    big = "<p>" + "x" * 200 + "</p>"
    out = [(i, f"http://h/{i}", f"<html>{i} é</html>" * (i % 40)) for i in range(200)]
    out += [(500, "http://h/a b\r\nc", big), (300, None, big), (400, "http://ü/", big),
            (600, "u", "short"), (601, "u", "short"), (602, "u", None), (603, None, ""),
            (None, "n", big), (None, "n", "z" * 150), (None, None, None), (500, "again", big),
            (700, "v", "w" * 120), (700, "v", "w" * 120)]
    return [(*p, "x", "x", "x") for p in out]


def expected(rows):
    first = {}
    for i, _, html, *_ in rows:
        key = (i is None, i)
        if html not in first or key < first[html]:
            first[html] = key
    done, out = set(), []
    for i, _, html, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        is_first = len(data) < 100 or (first[html][1] == i and (i, html) not in done)
        done.add((i, html))
        out.append((i, len(data), hashlib.sha256(data).hexdigest(),
                    "response" if is_first else "revisit", None if is_first else first[html][1]))
    return sorted(map(str, out))


def files(path):
    _, folder = open_store(path)
    return {f.name: f.read_bytes() for f in Path(folder, "records").iterdir()}


def test_round_trip_and_repeatable_bytes(spark):
    rows = pages()
    df = spark.createDataFrame(rows, PAGES)
    one, two = Staging(spark, "warc-a").path, Staging(spark, "warc-b").path
    manifest = write_warc(df.repartition(5), one, roll_bytes=1500)
    write_warc(df.repartition(2), two, roll_bytes=1500)
    back = read_warc(spark, one).collect()
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to))
                  for r in back) == expected(rows)
    for r in back:                             # payloads come back byte for byte
        if r.record_type == "response":
            assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest
            assert len(r.payload) == r.payload_bytes
        else:
            assert r.payload is None
    assert files(one) == files(two)            # byte for byte
    listed = {r.file: r for r in manifest.collect()}
    assert set(listed) == set(files(one))      # no temporary file is left
    for name, data in files(one).items():
        assert listed[name].bytes == len(data)
        assert listed[name].sha256 == hashlib.sha256(data).hexdigest()
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == listed[name].records
    assert any(r.part > 0 for r in listed.values())   # files were rolled


def test_records_are_range_sorted(spark):
    df = spark.createDataFrame(pages(), PAGES)
    path = Staging(spark, "warc-c").path
    write_warc(df, path, roll_bytes=1500)
    ids = []
    for _, data in sorted(files(path).items()):
        for line in gzip.decompress(data).split(b"\r\n"):
            if line.startswith(b"X-Page-ID: "):
                ids.append(int(line[11:]))
    assert ids == sorted(ids)


def test_extreme_and_null_ids(spark):
    ids = [-(1 << 63), (1 << 63) - 1, None, 0, -(1 << 62) - 5, None]
    same = "<p>" + "x" * 200
    rows = [(i, f"http://e.example/{n}", same if n % 2 else f"{same}{n}") for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = Staging(spark, "warc-e").path
    write_warc(df, path, roll_bytes=300)
    back = read_warc(spark, path).collect()
    assert sorted(map(str, (r.page_id for r in back))) == sorted(map(str, ids))
    assert [r.page_id for r in back if r.record_type == "response" and r.payload_bytes == len(same)] == [0]


def test_empty(spark):
    path = Staging(spark, "warc-d").path
    assert write_warc(spark.createDataFrame([], PAGES), path).count() == 0
    assert read_warc(spark, path).count() == 0
