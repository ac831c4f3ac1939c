"""Operator 10: bundles, seek tables, records."""

import base64
import hashlib
import io

import pytest
import zstandard
from lexicount.llm import warc

ROWS = [
    (1, "http://a/", "<p>é</p>"), (2, "http://b/\r\nx: y", "<p>é</p>"), (9, None, "<p>é</p>"), (3, "u", ""), (4, "u", None),
    (5, "u", "x" * 300_000), (6, "u", "x" * 300_000), (7, "u", "\r\n\r\nWARC/1.1\r\n"), (8, "u", "one"), (None, "u", "two"), (None, None, None),
    (8, "u", "one"), (-3, "u", "minus"), (-4, "u", "minus"),
]


def pages_of(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 1, "s") for r in rows], "page_id long, url string, html string, chosen int, sha1 string")


def expected(rows, least=0):
    top = {}
    for i, _, h in rows:
        h = h or ""
        if len(h.encode()) >= least and i is not None:
            top[h] = max(i, top.get(h, i))
    out = []
    for i, _, h in rows:
        h = h or ""
        ref = top.get(h) if len(h.encode()) >= least else None
        ref = None if ref == i else ref
        sha = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        out.append((i, len(h.encode()), sha, "response" if ref is None else "revisit", ref))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 4, 10**6])
def test_round_trip(spark, least):
    index = warc.archived(pages_of(spark).repartition(2), least=least, per_frame=3)
    got = sorted((tuple(r) for r in warc.read_back(index).collect()), key=str)
    assert got == expected(ROWS, least)


def test_empty_table(spark):
    index = warc.archived(pages_of(spark, []))
    assert index.count() == 0 and warc.read_back(index).count() == 0


def test_whole_table(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    got = sorted((tuple(r) for r in warc.read_back(warc.archived(pages)).collect()), key=str)
    assert got == expected(rows)


def test_bundles_read_from_end_to_end_and_by_seeking(spark):
    index = warc.archived(pages_of(spark).coalesce(1), per_frame=4).collect()
    assert len({(r.bundle, r.frame) for r in index}) > 2
    for name in {r.bundle for r in index}:
        files, path = warc._open(name)
        with files.open_input_file(path) as f:
            whole = f.read()
            table = warc.seek_table(f)
        own = [r for r in index if r.bundle == name]
        assert {(r.at, r.size) for r in own} == {(a, c) for a, c, _ in table}
        # A plain reader goes through all frames and over the table.
        stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(whole), read_across_frames=True).read()
        assert len(stream) == sum(d for _, _, d in table)
        base = {a: sum(x[2] for x in table[:k]) for k, (a, _, _) in enumerate(table)}
        at = 0
        for r in sorted(own, key=lambda r: (r.at, r.begin)):
            assert base[r.at] + r.begin == at
            headers, block = warc.parse(stream[at : at + r.length])
            assert int(headers["content-length"]) == len(block)
            at += r.length
        assert at == len(stream)


def test_damage_is_found(spark):
    index = warc.archived(pages_of(spark, ROWS[:1]))
    r = index.first()
    files, path = warc._open(r.bundle)
    body = warc.record(1, "u", b"other", 5, warc.digest(b"right"), None, False)
    out = files.open_output_stream(path, compression=None)
    writer = warc.BundleWriter(out)
    writer.add(body)
    writer.close()
    with files.open_input_file(path) as f:
        (place, size, _), = warc.seek_table(f)
    bad = index.selectExpr("page_id", "bundle", "frame", f"{place}L AS at", f"{size}L AS size", "0L AS begin", f"{len(body)}L AS length")
    with pytest.raises(Exception, match="damaged"):
        warc.read_back(bad).collect()
    with pytest.raises(ValueError):
        warc.parse(b"HTTP/1.1 200\r\n\r\n")


def test_frames_are_found_by_the_seek_table(spark):
    index = warc.archived(pages_of(spark).coalesce(1), per_frame=4)
    # The places that the index names as well are not what is read by.
    blind = index.selectExpr("page_id", "bundle", "frame", "-1L AS at", "-1L AS size", "begin", "length")
    assert sorted((tuple(r) for r in warc.read_back(blind).collect()), key=str) == expected(ROWS)
    name = index.first().bundle
    files, path = warc._open(name)
    with files.open_input_file(path) as f:
        table = warc.seek_table(f)
        f.seek(0)
        whole = f.read()
    foot = len(whole) - 9 - 8 * len(table)
    first = foot + 8  # the second entry
    wrong = (
        whole[:foot] + whole[first : first + 8] + whole[foot:first] + whole[first + 8 :],  # two entries swapped
        whole[: foot + 4] + b"\x01\x00\x00\x00" + whole[first:],  # another size
        whole[:foot] + b"\x01\x00\x00\x00" + whole[foot + 4 :],  # another compressed size
    )
    for k, body in enumerate(wrong):
        files, other = warc._open(f"{name}.{k}")
        with files.open_output_stream(other, compression=None) as out:
            out.write(body)
        with pytest.raises(Exception, match="seek table|[Zz]std|decompress|frame"):
            list(warc.read_records(files, other, [r.asDict() for r in index.collect()]))


def test_record_headers():
    text = warc.record(4, "http://x/\r\nWARC-Type: evil", b"", 7, "A" * 32, 9, True)
    headers, block = warc.parse(text)
    assert headers["warc-type"] == "revisit" and block == b""
    assert headers["warc-refers-to"] == "<urn:page:9>" and headers["warc-target-uri"] == "http://x/ WARC-Type: evil"
    assert headers["warc-profile"] == warc.PROFILE


def test_a_repeated_task_writes_a_bundle_of_its_own(spark):
    """What a lost task leaves behind is in no index: the attempt that counts
    names its own bundle only, and a half-written one is never reported."""
    import pyarrow as pa
    from lexicount.sinks import fresh_path

    folder = warc.qualified(spark, fresh_path(spark, "warc-test"))
    rows = [{"page_id": k, "url": "u", "payload": f"page {k}", "sha1": hashlib.sha1(f"page {k}".encode()).hexdigest(), "refers_to": None} for k in range(10)]
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.string()), ("sha1", pa.string()), ("refers_to", pa.int64())])
    batch = pa.RecordBatch.from_pylist(rows, schema)

    def lost():
        yield batch
        raise OSError("the executor is gone")

    run = warc._write(folder, 4, 3)
    with pytest.raises(OSError):
        next(run(lost()))
    first, second = ([r for b in run(iter([batch])) for r in b.to_pylist()] for _ in range(2))
    assert len({r["bundle"] for r in first + second}) == 2
    files, path = warc._open(second[0]["bundle"])
    got = warc.read_records(files, path, second)
    assert sorted(warc._id(h["warc-record-id"]) for _, h, _ in got) == list(range(10))


def test_a_path_without_a_scheme_is_in_the_default_file_system(spark, scratch):
    """The cluster's default is not this machine: Spark says which store it is,
    and nothing is written to a folder of that name here."""
    import os

    mine = f"/shared-{os.path.basename(scratch)}"
    conf = {"fs.defaultFS": "viewfs://cluster/", f"fs.viewfs.mounttable.cluster.link.{mine}": f"file://{scratch}"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        assert warc.qualified(spark, f"{mine}/bundles here") == f"viewfs://cluster{mine}/bundles%20here"
        assert os.listdir(scratch) == ["bundles here"] and not os.path.exists(mine)
        assert warc.qualified(spark, f"file://{scratch}/a b") in (f"file:{scratch}/a%20b", f"file://{scratch}/a%20b")
    finally:
        for k in conf:
            spark.conf.unset(k)
    with pytest.raises(ValueError, match="file system"):
        warc._open(f"{mine}/bundle")
    files, path = warc._open(f"file:{scratch}/a%20b")
    assert path == f"{scratch}/a b" and files.type_name == "local"


def test_a_folder_without_a_scheme(spark, scratch):
    index = warc.archived(pages_of(spark), folder=f"{scratch}/own folder")
    assert all(r.bundle.startswith("file:") for r in index.collect())
    assert sorted((tuple(r) for r in warc.read_back(index).collect()), key=str) == expected(ROWS)


class Counted:
    """A file system that counts what is read."""

    def __init__(self, files):
        self.files, self.reads = files, 0

    def open_input_file(self, path):
        source, outer = self.files.open_input_file(path), self

        class Source:
            __enter__ = lambda s: s
            __exit__ = lambda s, *e: source.close()
            size, seek = source.size, source.seek

            def read(self, n):
                outer.reads += n
                return source.read(n)

        return Source()


def test_reading_holds_one_frame(spark):
    rows = [(k, "u", f"page {k} " * 2000) for k in range(40)]
    index = [r.asDict() for r in warc.archived(pages_of(spark, rows).coalesce(1), per_frame=4).collect()]
    files, path = warc._open(index[0]["bundle"])
    counted = Counted(files)
    places = sorted({(r["at"], r["size"]) for r in index})
    foot = 9 + 8 * len(places)
    assert len(places) == 10
    for n, (_, headers, _) in enumerate(warc.read_records(counted, path, index)):
        assert headers["warc-type"] == "response"
        assert counted.reads == foot + sum(size for _, size in places[: n // 4 + 1])
