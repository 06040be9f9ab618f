import json
import random
import zlib
from pathlib import Path

import pytest
import zstandard
from pyspark.sql import functions as F

from gneiss.operators.compaction import compact, complete_zstd, read_records, validate
from gneiss.operators.json_values import json_key, json_keys


def payloads(rng):
    out = [b"", None, b"one line", b"ends\n", b"two\nlines", b"\n", b"{}" * 5000, "Ø×—".encode()]
    return out + [bytes(rng.choices(b"abc\n{}", k=rng.randint(0, 80))) for _ in range(300)]


@pytest.mark.parametrize("target", [64, 4096, 1 << 20])
def test_round_trip_holds_each_file_once(spark, target, tmp_path):
    rng = random.Random(1)
    data = [(i, p, "x") for i, p in enumerate(payloads(rng))] + [(3, b"same id", "x")]
    df = spark.createDataFrame(data, "file_id long, payload binary, container string").repartition(5)
    index = compact(df, str(tmp_path / "c"), target_bytes=target)
    back = [(r.file_id, None if r.payload is None else bytes(r.payload)) for r in read_records(index).collect()]
    assert sorted(back, key=repr) == sorted(((i, p) for i, p, _ in data), key=repr)
    checked = validate(index).collect()
    assert all(r.damaged == 0 and r.missing_bytes == 0 for r in checked) and sum(r.records for r in checked) == sum(p is not None for _, p, _ in data)
    assert {p.name for p in (tmp_path / "c").iterdir() if not p.name.startswith(".")} == {r.container for r in checked}


def test_containers_are_few_and_newline_delimited(spark, tmp_path):
    df = spark.createDataFrame([(i, json.dumps({"i": i})) for i in range(500)], "file_id long, payload string").repartition(8)
    index = compact(df, str(tmp_path / "c"))
    files = [p for p in (tmp_path / "c").glob("*.nd")]
    assert len(files) == 1
    assert sorted(json.loads(x)["i"] for x in files[0].read_text().splitlines()) == list(range(500))
    assert index.count() == 500


def test_zstandard_frames_are_joined_unparsed(spark, tmp_path):
    c = zstandard.ZstdCompressor(write_checksum=True)
    frames = [c.compress(f"text {i}\n".encode() * (i + 1)) for i in range(20)]
    broken = frames[0][:-3]
    assert all(map(complete_zstd, frames)) and complete_zstd(frames[0] + frames[1]) and not complete_zstd(broken) and not complete_zstd(frames[1] + b"x")
    df = spark.createDataFrame([*enumerate(frames), (99, broken)], "file_id long, payload binary").coalesce(1)
    index = compact(df, str(tmp_path / "c"))
    kinds = {r.file_id: r.kind for r in index.collect()}
    assert kinds.pop(99) == "nd" and set(kinds.values()) == {"zstd"}
    whole = b"".join(p.read_bytes() for p in (tmp_path / "c").glob("*.zstd"))
    text = zstandard.ZstdDecompressor().stream_reader(whole, read_across_frames=True).read()
    assert text == b"".join(f"text {i}\n".encode() * (i + 1) for i in range(20))
    assert {bytes(r.payload) for r in read_records(index).collect()} == {*frames, broken}


def test_large_frames_with_and_without_sizes(spark):
    data = bytes(random.Random(2).randbytes(300_000)) + b"a" * 500_000
    assert complete_zstd(zstandard.ZstdCompressor().compress(data))
    o = zstandard.ZstdCompressor(write_content_size=False).compressobj()
    assert complete_zstd(o.compress(data) + o.flush())


def test_headers_stand_once_per_container(spark, tmp_path):
    head = b"a,b\n"
    df = spark.createDataFrame([(1, head + b"1,2\n"), (2, head + b"3,4"), (3, b"5,6\n")], "file_id long, payload binary").coalesce(1)
    index = compact(df, str(tmp_path / "c"), header=head)
    (file,) = (tmp_path / "c").glob("*.nd")
    assert file.read_bytes() == b"a,b\n1,2\n3,4\n5,6\n"
    assert {r.file_id: bytes(r.payload) for r in read_records(index, head).collect()} == {1: head + b"1,2\n", 2: head + b"3,4", 3: b"5,6\n"}


def test_damage_is_found(spark, tmp_path):
    index = compact(spark.createDataFrame([(1, "aaaa"), (2, "bbbb")], "file_id long, payload string").coalesce(1), str(tmp_path / "c"))
    (file,) = (tmp_path / "c").glob("*.nd")
    file.write_bytes(file.read_bytes().replace(b"bbbb", b"bxbb"))
    (tmp_path / "c" / f".{file.name}.crc").unlink(missing_ok=True)
    assert validate(index).first().damaged == 1
    with pytest.raises(Exception, match="damaged"):
        read_records(index).collect()


def test_empty_table_and_leftovers(spark, tmp_path):
    folder = tmp_path / "c"
    folder.mkdir()
    (folder / "r1-000000-77-0.nd").write_text("left by a lost attempt")
    (folder / "r2-000000-77-0.nd").write_text("of another run")
    index = compact(spark.createDataFrame([], "file_id long, payload string"), str(folder), run="r1")
    assert index.count() == 0 and read_records(index).count() == 0 and validate(index).count() == 0
    assert [p.name for p in folder.glob("*.nd")] == ["r2-000000-77-0.nd"]


def test_crc_is_of_the_whole_payload(spark, tmp_path):
    index = compact(spark.createDataFrame([(1, "abc")], "file_id long, payload string"), str(tmp_path / "c"))
    assert index.first().crc == zlib.crc32(b"abc")
    assert Path(tmp_path / "c").exists() and index.where(F.col("length") == 3).count() == 1


@pytest.mark.parametrize(
    "a,b,same",
    [
        ('{"a": 1, "b": [1, 2]}', '{"b":[1,2],"a":1}\n', True),
        ('{"a": "Ø"}', '{"a": "\\u00d8"}', True),
        ("[1, 2]", "[2, 1]", False),
        ("1", "1.0", True),
        ("1e2", "100", True),
        ("1", "true", False),
        ('"1"', "1", False),
        ("{}", "[]", False),
        ("null", "null", True),
        ('{"a": 1, "a": 2}', '{"a": 2}', True),
        ('"\\/"', '"/"', True),
    ],
)
def test_json_equality(a, b, same):
    assert (json_key(a.encode()) == json_key(b.encode())) is same


@pytest.mark.parametrize("bad", [b"", b"{", b"NaN", b"[1,]", b"{'a': 1}", b"\xff", b"\xef\xbb\xbf{}", None, b"Infinity"])
def test_not_json(bad):
    assert json_key(bad) is None


def test_deep_and_long_values(spark):
    deep, long = b"[" * 100_000 + b"]" * 100_000, json.dumps(["x" * 2_000_000]).encode()
    assert json_key(deep) == json_key(deep + b" ") and json_key(long) == json_key(b" " + long)
    df = spark.createDataFrame([(1, b"{}"), (2, None), (3, b"oops")], "file_id long, payload binary")
    assert [r.file_id for r in json_keys(df).collect()] == [1]


def test_long_integers_are_json():
    digits = b"7" * 5000
    key = json_key(b'{"b": 1, "a": ' + digits + b"}")
    assert key is not None and key == json_key(b'{"a":' + digits + b',"b":1.0}')
    assert len({key, json_key(b'{"a":-' + digits + b',"b":1}'), json_key(b'{"a":"' + digits + b'","b":1}'), json_key(b'{"a":' + digits + b'7,"b":1}')}) == 4


def test_deep_values_are_compared_by_value():
    def nest(inner, n, pad=""):
        return (f'{pad}{{"b":{pad}1,"a":[' * n + inner + "]}" * n).encode()

    def turned(inner, n):
        return ('{"a":[' * n + inner + '], "b": 1.0}' * n).encode()

    for n in (90, 110, 3000, 50_000):
        key = json_key(nest("2", n))
        assert key is not None and key == json_key(nest("2e0", n, " \n")) == json_key(turned("2.0", n))
        assert key != json_key(nest("3", n)) and json_key(nest("2", n) + b"]") is None and json_key(nest("2,", n)) is None and json_key(nest("", n)) not in (None, key)
    assert json_key(b"[" * 5000) is None and json_key(b"[" * 500 + b"}" * 500) is None and json_key(b'{"a"' * 300 + b"}" * 300) is None


def test_numbers_compare_by_value_however_long():
    same = [["1e400", "10e399", "1" + "0" * 400], ["0.1", "0.10", "1e-1", "0.1000000000000000000000"], ["0.1234567890123456789", "1234567890123456789e-19"], ["-0.0", "0", "0e999999999999999999"], ["7" * 5000, "7" * 5000 + ".0"]]
    keys = [{json_key(x.encode()) for x in group} for group in same]
    assert all(len(k) == 1 and None not in k for k in keys[:4]) and len(set.union(*keys[:4])) == 4
    assert len({json_key(x.encode()) for x in ("1e400", "1e500", "1e-400", "0", "0.12345678901234567", "0.12345678901234568")}) == 6
    assert json_key(b"1e9999999999999999999") is not None


def test_another_run_into_the_same_folder_spares_the_first(spark, tmp_path):
    df = spark.createDataFrame([(1, b"a"), (2, b"b")], "file_id long, payload binary")
    first = compact(df, str(tmp_path / "c"))
    (tmp_path / "c-index").rename(tmp_path / "kept-index")
    first = spark.read.parquet(str(tmp_path / "kept-index")).withColumn("folder", F.lit(str(tmp_path / "c")))
    compact(df, str(tmp_path / "c"))
    assert sorted(bytes(r.payload) for r in read_records(first).collect()) == [b"a", b"b"]
