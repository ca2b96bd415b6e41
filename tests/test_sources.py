"""Table files, snapshots, listings, copies: round trips and broken inputs."""

import io
import json
import os
import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimenta.functions.ddl import parse_create
from sedimenta.model import NOT_DELETED, ROW_SCHEMA
from sedimenta.operators.typed_rows import as_schema, typed_rows, write_rows
from sedimenta.plans import jobs
from sedimenta.sources import copy_files, json_snapshot, layout, listing, table_files

small = st.binary(max_size=12)
cells = st.lists(
    st.fixed_dictionaries(
        {"kind": st.sampled_from(["live", "d", "e", "c", "rt"]), "name": st.binary(min_size=1, max_size=9), "value": small, "ts": st.integers(-(2**63), 2**63 - 1),
         "ttl": st.integers(0, 99), "local_deletion_time": st.integers(0, 99), "ts_last_delete": st.integers(1, 99), "range_max": small}
    ), max_size=5,
)
tables = st.lists(st.tuples(small, st.sampled_from([NOT_DELETED, 0, 1412627101051000]), cells), max_size=5)


def told(a):
    keep = {"live": ("value",), "d": ("value",), "e": ("value", "ttl", "local_deletion_time"), "c": ("value", "ts_last_delete"), "rt": ("range_max", "local_deletion_time"), "row": ()}[a["kind"]]
    return {k: a[k] for k in (*keep, *(("name", "ts") if a["kind"] != "row" else ()), "kind")}


@settings(max_examples=80, deadline=None)
@given(tables, st.sampled_from(["ic", "jb"]))
def test_layout_round_trip(rows, version):
    data = b"".join(layout.row_bytes(k, d, c, version) for k, d, c in rows)
    got = list(layout.read_rows(io.BytesIO(data), version, len(data)))
    want = [(k, d, told(x)) for k, d, c in rows for x in (c or [{"kind": "row"}])]
    assert [(a["row_key"], a["row_deleted_at"], told(a)) for a in got] == want
    assert all(a["size"] == len(layout.cell_bytes(a)) for a in got if a["kind"] != "row")


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=5000), st.sampled_from(["SnappyCompressor", "LZ4Compressor", "org.x.DeflateCompressor"]), st.integers(1, 700), st.integers(0, 5000))
def test_chunks(data, codec, chunk, at):
    packed, info = layout.compressed_file(data, codec, chunk)
    assert layout.read_compression(io.BytesIO(layout.compression_bytes(info))) == info
    f = io.BufferedReader(io.BytesIO(packed))
    reader = layout.Chunks(f, info, len(packed), at)
    assert layout._take(reader, max(0, len(data) - at)) == data[at:] and reader.read(1) == b""
    if len(data) > chunk:
        with pytest.raises(layout.CorruptInput):
            cut = packed[: info.offsets[-1] - 1]
            layout._take(layout.Chunks(io.BytesIO(cut), info, len(cut)), len(data))


@given(st.binary(max_size=3000))
def test_snappy(data):
    assert layout.decode_snappy(layout.encode_snappy(data, 100)) == data
    assert layout.decode_snappy(layout.compress("SnappyCompressor", data)) == data
    if data:
        with pytest.raises(Exception):
            layout.decode_snappy(layout.encode_snappy(data, 100)[:-1])


def write(folder, name, rows, version, codec=None, index=True):
    os.makedirs(folder, exist_ok=True)
    parts, entries, at = [], [], 0
    for key, deleted, cs in rows:
        entries.append((key, at))
        parts.append(layout.row_bytes(key, deleted, cs, version))
        at += len(parts[-1])
    data = b"".join(parts)
    base = f"{folder}/{name}-{version}-1"
    if codec:
        data, info = layout.compressed_file(data, codec, 64)
        open(f"{base}-CompressionInfo.db", "wb").write(layout.compression_bytes(info))
    open(f"{base}-Data.db", "wb").write(data)
    if index:
        open(f"{base}-Index.db", "wb").write(layout.index_bytes(entries))
    return f"{base}-Data.db"


def some_rows(n, seed=1, ts=100):
    rng = random.Random(seed)
    return [(struct.pack(">i", k), NOT_DELETED, [{"kind": "live", "name": f"c{i}".encode(), "value": rng.randbytes(5).hex().encode(), "ts": ts + i} for i in range(rng.randrange(6))]) for k in range(n)]


@pytest.mark.parametrize("version", ["ic", "jb"])
@pytest.mark.parametrize("codec", [None, "LZ4Compressor"])
def test_read_tables(spark, tmp_path, version, codec):
    rows = some_rows(200)
    write(f"{tmp_path}/one", "ks-t", rows, version, codec)
    write(f"{tmp_path}/two/deep", "ks-t", some_rows(50, 2, 500), version)
    open(f"{tmp_path}/two/empty-jb-9-Data.db", "wb").close()
    want = sum(max(1, len(c)) for _, _, c in rows) + sum(max(1, len(c)) for _, _, c in some_rows(50, 2, 500))
    whole = table_files.read_tables(spark, str(tmp_path))
    assert whole.count() == want and whole.where("kind = 'error'").count() == 0
    split = table_files.read_tables(spark, [f"{tmp_path}/one", f"{tmp_path}/two"], blocksize=1024)
    assert split.rdd.getNumPartitions() > 4
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(split, whole)
    joined = table_files.read_tables(spark, str(tmp_path), blocksize=4096, combine=True, maxcombined=2)
    assert same(joined, whole)
    assert table_files.read_tables(spark, str(tmp_path), blocksize=1024, splitcompressed=False).count() == want
    assert whole.select(F.count_distinct("source_path")).first()[0] == 2


def test_snapshot_job(spark, tmp_path):
    old, new = some_rows(100, 1, 100), some_rows(100, 2, 200)
    new[5] = (new[5][0], 10**6, [])
    write(f"{tmp_path}/in", "ks-a", old, "ic")
    write(f"{tmp_path}/in", "ks-b", new, "jb", "SnappyCompressor")
    got = jobs.snapshot(spark, f"{tmp_path}/in", f"{tmp_path}/json")
    assert got == {"rows_written": 100, "rows_too_big": 0, "inputs_in_error": 0}
    want = {}
    for key, _, cs in old + new:
        row = want.setdefault(key.hex(), {})
        for c in cs:
            row[c["name"].hex()] = [c["name"].hex(), c["value"].hex(), c["ts"]]
    want[new[5][0].hex()] = {}
    lines = [x["value"].split("\t") for x in spark.read.text(f"{tmp_path}/json").collect()]
    back = {k: json.loads(v)[k] for k, v in lines}
    assert {k: v["columns"] for k, v in back.items()} == {k: sorted(v.values()) for k, v in want.items()}
    assert back[new[5][0].hex()]["deletedAt"] == 10**6 and back[new[6][0].hex()]["deletedAt"] == NOT_DELETED
    # to table files and back again
    jobs.snapshot(spark, f"{tmp_path}/in", f"{tmp_path}/tables", jobs.SnapshotJob(sink="tables", version="ic", dataset="ks-t"))
    assert all(n.startswith("ks-t-ic-0000") for n in os.listdir(f"{tmp_path}/tables"))
    with pytest.raises(Exception):
        jobs.snapshot(spark, f"{tmp_path}/in", f"{tmp_path}/tables", jobs.SnapshotJob(sink="tables"))
    jobs.snapshot(spark, f"{tmp_path}/tables", f"{tmp_path}/again")
    assert sorted(x["value"] for x in spark.read.text(f"{tmp_path}/again").collect()) == sorted("\t".join(x) for x in lines)


def test_broken_inputs(spark, tmp_path):
    good = write(f"{tmp_path}/a", "ks-a", some_rows(20), "jb")
    bad = write(f"{tmp_path}/b", "ks-b", some_rows(20, 3), "jb", index=False)
    open(bad, "r+b").truncate(os.path.getsize(bad) - 3)
    atoms = table_files.read_tables(spark, str(tmp_path))
    assert atoms.where("kind = 'error'").count() == 1 and atoms.where(F.col("source_path") == bad).count() > 15
    with pytest.raises(RuntimeError):
        jobs.snapshot(spark, str(tmp_path), f"{tmp_path}/out")
    assert spark.read.text(f"{tmp_path}/out").count() == 20  # the output stands
    assert jobs.snapshot(spark, str(tmp_path), f"{tmp_path}/out2", jobs.SnapshotJob(allowed_errors=1))["inputs_in_error"] == 1
    # a broken cell in a row of known size: the next row is read
    data = bytearray(b"".join(layout.row_bytes(k, d, c, "ic") for k, d, c in some_rows(5)))
    rows = [r for r in some_rows(5)]
    at = next(i for i, r in enumerate(rows) if r[2])
    start = sum(len(layout.row_bytes(*r, "ic")) for r in rows[:at])
    data[start + 6 + 24 : start + 6 + 26] = b"\xff\xff"
    got = list(layout.read_rows(io.BytesIO(bytes(data)), "ic"))
    assert [a["kind"] for a in got].count("error") == 1 and got[-1]["row_key"] == rows[-1][0]
    assert os.path.exists(good)



def test_reading_is_bounded(tmp_path, monkeypatch):
    """Rows of absurd sizes are refused, batches are cut by bytes, and a store's fault is no damaged input."""
    row = bytearray(layout.row_bytes(b"k", NOT_DELETED, some_rows(9)[-1][2] or [{"kind": "live", "name": b"c", "value": b"v", "ts": 1}], "ic"))
    row[3:11] = struct.pack(">q", 1 << 60)
    with pytest.raises(layout.CorruptInput, match="a row of"):
        list(layout.read_rows(io.BytesIO(bytes(row)), "ic", len(row)))
    with pytest.raises(layout.CorruptInput):
        list(layout.read_rows(io.BytesIO(bytes(row)), "ic"))
    cells = [{"kind": "live", "name": f"c{k}".encode(), "value": b"x" * 100_000, "ts": 1} for k in range(200)]
    path = write(str(tmp_path), "ks-t", [(b"k", NOT_DELETED, cells)], "jb")
    part = table_files.Combined((table_files.Split(path, 0, os.path.getsize(path)),))
    batches = list(table_files.Reader({"path": path}).read(part))
    assert len(batches) >= 3 and sum(b.num_rows for b in batches) == 200
    with pytest.raises(OSError):
        list(table_files.read_split(table_files.Split(f"{tmp_path}/gone-jb-1-Data.db", 0, 10)))


def test_snappy_streams_by_block():
    blocks = list(layout.snappy_blocks(io.BytesIO(layout.encode_snappy(b"y" * 1000, 100))))
    assert [len(b) for b in blocks] == [100] * 10
    assert b"".join(layout.snappy_blocks(io.BytesIO(layout.compress("SnappyCompressor", b"z" * 50)))) == b"z" * 50


def test_one_pass_and_versions(spark, tmp_path):
    """A snapshot reads its input once; an export refuses two versions; a copy wants one kind of input."""
    write(f"{tmp_path}/in", "ks-a", some_rows(10), "jb")
    write(f"{tmp_path}/in", "ks-b", some_rows(10, 2, 300), "ic")
    plan = []
    seen = jobs.to_lines
    try:
        jobs.to_lines = lambda rows, *a: (plan.append(rows._jdf.queryExecution().optimizedPlan().toString()), seen(rows, *a))[1]
        assert jobs.snapshot(spark, f"{tmp_path}/in", f"{tmp_path}/out")["inputs_in_error"] == 0
    finally:
        jobs.to_lines = seen
    assert plan[0].count("RelationV2") == 1 and "CollectMetrics" in plan[0]
    with pytest.raises(Exception, match="several format versions"):
        jobs.export(spark, f"{tmp_path}/in", "CREATE TABLE t (k int PRIMARY KEY, v int)", f"{tmp_path}/rows")
    for given in ({}, {"inputs": "/a", "manifest": "/b"}):
        with pytest.raises(ValueError):
            jobs.copy(spark, f"{tmp_path}/c", **given)


def test_split_cut():
    offsets = list(range(0, 1000, 10))
    assert list(table_files.cut(1000, iter(offsets), 2000)) == [(0, 1000)]
    cuts = list(table_files.cut(1000, iter(offsets), 100))
    assert cuts[0] == (0, 100) and sum(n for _, n in cuts) == 1000 and all(s in offsets for s, _ in cuts) and cuts[-1][1] <= 120
    splits = [table_files.Split("x", 0, n) for n in (50, 60, 10, 200, 1)]
    assert [[s.length for s in g] for g in table_files.combine(splits, 120, 10)] == [[50, 60, 10], [200], [1]]
    assert [len(g) for g in table_files.combine(splits, 10**9, 2)] == [2, 2, 1]


def test_compression_info_of_the_minute_beside(tmp_path):
    store, _ = table_files.filesystem(str(tmp_path))
    data = f"{tmp_path}/1412000000000/201410061530/ks-t-jb-1-Data.db"
    for minute, found in (("201410061529", True), ("201410061531", True), ("201410061533", False)):
        path = f"{tmp_path}/1412000000000/{minute}/ks-t-jb-1-CompressionInfo.db"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        open(path, "wb").close()
        assert (table_files.compression_path(store, data) == path) is found
        if not found:
            assert table_files.compression_path(store, data).split("/")[-2] == "201410061531"  # the later minute first


LINES = [
    '756964\t{"756964":{"deletedAt":10,"columns":[["cell","00000002",1312400480243000],["gone","59",9],["same","59",10],["t","59",11,"d"]]}}',
    '6b\t/a/path\t{"6b":{"deletedAt":-9223372036854775808,"columns":[["e","00",5,"e",604800,1320339905],["c","00",5,"c",7],["\\\\N","00",1],["e","01",6]]}}',
    '6d\t{"6d":{"deletedAt":99,"columns":[["a","00",5]]}}',
    '6e\t{"6e":{"deletedAt":1,"columns":[]}}',
    "no snapshot line",
    "",
]


def test_load_snapshot(spark, tmp_path):
    (tmp_path / "lines").write_text("\n".join(LINES))
    got = {r["key"]: r for r in json_snapshot.read_snapshot(spark, str(tmp_path / "lines")).collect()}
    assert set(got) == {"756964", "6b"}
    assert [c["name"] for c in got["756964"]["bag_columns"]] == ["cell", "same"]
    e, c, n, e2 = got["6b"]["bag_columns"]
    assert (e["ttl"], e["local_deletion_time"], c["ttl"], n["name"]) == (604800, 1320339905, 7, "\\N")
    assert got["6b"]["map_columns"]["e"]["value"] == "01"
    raw = json_snapshot.read_snapshot(spark, str(tmp_path / "lines"), clean=False)
    assert raw.count() == 4 and raw.select("key").columns == ["key"]


def test_library_lines(spark):
    text = '{"uid": {"deletedAt": 10, "columns": [["cell","00000002",1312400480243000], ["\\\\N","59",1], ["x","59",2,"e",604800,1320339905], ["y","59",3,"c",7]]}}'
    rows = json_snapshot.parse_lines(spark.createDataFrame([("uid\t" + text,)], "value string"))
    assert json_snapshot.to_library_lines(rows).first()["line"] == text


def test_lines(spark):
    row = (b"k\xff", "/p", 5, [(b'a"\\\n', b"v", 1, None, None, None, None, 30), (b"b", b"\xff", 2, "d", None, None, None, 30), (b"c", b"", 3, "e", 60, 99, None, 30), (b"d", b"x", 4, "c", None, None, 7, 30)])
    df = spark.createDataFrame([row], ROW_SCHEMA)
    line = json_snapshot.to_lines(df).first()["line"]
    assert line == '6bff\t{"6bff":{"deletedAt":5,"columns":[["61225c0a","76",1],["62","ff",2,"d"],["63","",3,"e",60,99],["64","78",4,"c",7]]}}'
    typed = json_snapshot.to_lines(df, "UTF8Type", "UTF8Type", "UTF8Type", trace_source=True).first()["line"]
    key, path, body = typed.split("\t")
    assert (key, path) == ("6bff", "/p") and json.loads(body)["6bff"]["columns"][0][0] == 'a"\\\n' and json.loads(body)["6bff"]["columns"][1][1] == "ff"
    legacy = json.loads(json_snapshot.to_lines(df, name_type="UTF8Type", legacy_names=True).first()["line"].split("\t")[1])
    assert legacy["6bff"]["columns"][0][0] == 'a\\"\\\\ '
    big = json_snapshot.to_lines(df, max_row_bytes=119).first()
    assert big["too_big"] and json.loads(big["line"].split("\t")[1])["6bff"]["columns"] == ["error", "row too large: 120 bytes - limit 119 bytes", 0]
    assert not json_snapshot.to_lines(df, max_row_bytes=120).first()["too_big"]


def test_listing(spark, tmp_path):
    for name in ("t/a-jb-1-Data.db", "t/a-jb-1-Index.db", "t/.hidden", "t/_tmp", "t/a.idx-jb-2-Data.db", "u/part=3/b-ic-1-Data.db", "u/x+y z"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    names = lambda df: sorted(r["path"].split("/")[-1] for r in df.collect())
    everything = listing.listing(spark, str(tmp_path))
    assert names(everything) == ["a-jb-1-Data.db", "a-jb-1-Index.db", "a.idx-jb-2-Data.db", "b-ic-1-Data.db", "x+y z"]
    data = listing.data_files(spark, str(tmp_path))
    assert names(data) == ["a-jb-1-Data.db", "a.idx-jb-2-Data.db", "b-ic-1-Data.db"]
    assert names(listing.without_secondary_indexes(data)) == ["a-jb-1-Data.db", "b-ic-1-Data.db"]
    assert names(listing.first_only(data)) == ["a-jb-1-Data.db"]
    assert listing.input_globs(data).count() == 2
    assert listing.partition_info(data).where("partition = 'part=3'").count() == 1
    with pytest.raises(Exception, match="several format versions"):
        listing.require_one_version(data).count()
    assert listing.require_one_version(listing.filtered(data, lambda p: p.contains("/t/"))).count() == 2
    folders = spark.createDataFrame([("/x/batch_id=12",), ("/x/batchid=9/",), ("/x/batch_id=3",)], "path string")
    assert names(listing.latest_batch(folders)) == [""]
    other = spark.createDataFrame([("/x/a",), ("/x/b",)], "path string")
    assert listing.latest_batch(other).count() == 2
    listing.write_manifest(data, f"{tmp_path}/manifest")
    assert listing.read_manifest(spark, f"{tmp_path}/manifest").count() == 3


def test_copy(spark, tmp_path):
    (tmp_path / "in/deep").mkdir(parents=True)
    (tmp_path / "in/deep/a").write_bytes(b"x" * 200_000)
    (tmp_path / "in/b").write_bytes(layout.encode_snappy(b"hello " * 9000))
    files = listing.listing(spark, f"{tmp_path}/in")
    got = copy_files.copy_files(files, f"{tmp_path}/out", base=f"{tmp_path}/in").collect()
    assert sum(r["bytes"] for r in got) == 200_000 + os.path.getsize(tmp_path / "in/b") and (tmp_path / "out/deep/a").read_bytes() == b"x" * 200_000
    assert sorted(os.listdir(tmp_path / "out")) == ["b", "deep"]
    with pytest.raises(FileExistsError):
        copy_files.copy_files(files, f"{tmp_path}/out", base=f"{tmp_path}/in")
    twice = copy_files.copy_files(files, f"{tmp_path}/twice", base=f"{tmp_path}/in")
    assert twice.count() == 2 and twice.count() == 2  # acted on again, as after a lost executor
    assert sorted(os.listdir(tmp_path / "twice")) == ["b", "deep"]
    with pytest.raises(Exception):  # no stream: nothing is left behind
        copy_files.copy_files(files.where(F.col("path").endswith("/a")), f"{tmp_path}/bad", unsnap=True).collect()
    assert os.listdir(tmp_path / "bad") == []
    copy_files.copy_files(files.where(F.col("path").endswith("/b")), f"{tmp_path}/plain", unsnap=True, overwrite=True).collect()
    assert (tmp_path / "plain/b").read_bytes() == b"hello " * 9000


def test_ddl():
    t = parse_create('CREATE TABLE ks."T" (a int, b text, "C c" bigint, d map<text, int>, s text STATIC, PRIMARY KEY ((a, b), "C c")) WITH CLUSTERING ORDER BY ("C c" DESC) AND x = 1')
    assert (t.partition, t.clustering, t.static, t.regular, t.types["d"]) == (("a", "b"), ("C c",), ("s",), ("d",), "map<text,int>")
    assert t.key_type == "CompositeType(Int32Type,UTF8Type)" and t.comparator == "CompositeType(ReversedType(LongType),UTF8Type)"
    one = parse_create("create table t (k uuid primary key, v blob) with compact storage")
    assert (one.key_type, one.comparator) == ("UUIDType", "UTF8Type")
    for bad in ("SELECT 1", "CREATE TABLE t (a int)", "CREATE TABLE t (a int"):
        with pytest.raises(ValueError):
            parse_create(bad)


def test_typed_rows(spark, tmp_path):
    from sedimenta.functions.ddl import require_exportable

    def name(*parts, static=False):
        return (b"\xff\xff" if static else b"") + b"".join(struct.pack(">H", len(p)) + p + b"\0" for p in parts)

    n = lambda x: struct.pack(">i", x)
    cell = lambda nm, v, ts=1, **k: {"kind": "live", "name": nm, "value": v, "ts": ts} | k
    rows = [
        (n(1), 10**12, [cell(name(n(5), b""), b""), cell(name(n(5), b"v"), b"old"), cell(name(n(5), b"v"), b"new", 2), cell(name(n(6), b"v"), b"x"), cell(name(b"", b"s", static=True), b"st")]),
        (n(2), NOT_DELETED, [cell(name(b"", b"s", static=True), b"only")]),
        (n(3), NOT_DELETED, [cell(name(n(1), b"v"), b"dead", kind="d"), cell(name(n(2), b"v"), b"due", kind="e", ttl=1, local_deletion_time=50), cell(name(n(3), b"v"), b"alive", kind="e", ttl=1, local_deletion_time=150)]),
        (n(4), NOT_DELETED, []),
    ]
    write(str(tmp_path), "ks-t", rows, "jb")
    ddl = "CREATE TABLE t (k int, c int, v text, s text static, PRIMARY KEY (k, c))"
    got = typed_rows(table_files.read_tables(spark, str(tmp_path)), parse_create(ddl), now=100)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 5, "new", "st"), (1, 6, "x", "st"), (2, None, None, "only"), (3, 3, "alive", None)], key=str)
    schema = json.dumps({"type": "record", "name": "r", "fields": [{"name": "k", "type": "int"}, {"name": "v", "type": ["null", "string"]}]})
    assert as_schema(got, schema).dtypes == [("k", "int"), ("v", "string")]
    assert write_rows(got, f"{tmp_path}/rows") == "parquet" and spark.read.parquet(f"{tmp_path}/rows").count() == 4
    assert jobs.export(spark, str(tmp_path), ddl, f"{tmp_path}/rows2", now=100) == "parquet"
    ranges = [(n(1), NOT_DELETED, [{"kind": "rt", "name": b"a", "range_max": b"b", "ts": 1}])]
    write(f"{tmp_path}/rt", "ks-t", ranges, "jb")
    with pytest.raises(Exception, match="range tombstones"):
        typed_rows(table_files.read_tables(spark, f"{tmp_path}/rt"), parse_create(ddl)).collect()
    for bad in ("CREATE TABLE t (k int PRIMARY KEY, v list<int>)", "CREATE TABLE t (k int PRIMARY KEY, v int) WITH COMPACT STORAGE"):
        with pytest.raises(ValueError):
            require_exportable(parse_create(bad))
