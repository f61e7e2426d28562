import json
import zlib

import zstandard

from spanloom.operators import compaction

SCHEMA = "segment_id long, file_id long, written_at long, segment array<float>, label string, bin int, part string"


def records(spark):
    data = [(1, 10, 5, [1.0, None], "a", 0, "x"), (1, 11, 4, [1.0, None], "a", 0, "x"), (1, 11, 4, [1.0, None], "a", 0, "x"), (2, 10, 5, [], None, 0, None), (3, 12, 1, None, "é\n", 0, "x"), (4, 12, 1, [2.0], "b", 0, "x"), (4, 12, 2, [2.0], "b", 0, "x"), (None, 12, 1, [9.0], "n", 0, "x"), (None, 12, 1, [9.0], "n", 0, "x"), (5, None, 1, [3.0], "c", 0, "x")]
    return spark.createDataFrame(data, SCHEMA)


FILES = "file_id long, n_bytes long"


def check(spark, tmp_path, target_bytes=64 << 20):
    target, manifest = compaction.consolidate_segments(records(spark), spark.createDataFrame([(10, 500)], FILES), f"file://{tmp_path}/out", target_bytes)
    lines = []
    for r in manifest.where("name is not null").orderBy("name", "at").collect():  # every frame by itself, at its place
        raw = (tmp_path / "out" / r["name"]).read_bytes()[r["at"] : r["at"] + r["bytes"]]
        raw = zstandard.decompress(raw)
        assert len(raw) == r["raw_bytes"] and zlib.crc32(raw) == r["crc"]
        lines += raw.decode().splitlines()
    assert sorted(lines) == sorted(r["line"] for r in compaction.read_consolidated(target, manifest).collect())
    found = [json.loads(x) for x in lines]
    assert sorted(x["segment_id"] for x in found if "segment_id" in x) == [1, 2, 3, 4, 5]
    assert sum("segment_id" not in x for x in found) == 2
    assert sorted(r["key"] for r in compaction.repeated_keys(manifest).collect()) == [1, 4]
    sizes = compaction.file_sizes(manifest).where("name is not null").collect()
    assert {r["name"] for r in sizes} == {x.name for x in (tmp_path / "out").iterdir() if not x.name.startswith(".")}
    assert all(r["bytes"] == (tmp_path / "out" / r["name"]).stat().st_size for r in sizes)
    assert sum(r["copies_dropped"] for r in compaction.file_sizes(manifest).collect()) == 3
    return sizes


def test_each_record_once(spark, tmp_path):
    assert len(check(spark, tmp_path)) == 1


def test_files_keep_to_their_size(spark, tmp_path):
    sizes = check(spark, tmp_path, 150)
    assert len(sizes) > 1 and all(r["frames"] == 1 or r["bytes"] <= 150 for r in sizes)


def test_large_files_in_parts(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(compaction, "FRAME_LINES", 2)
    check(spark, tmp_path / "a")
    monkeypatch.setattr(compaction, "BROADCAST_FILES", 0)
    check(spark, tmp_path / "b")


def test_empty(spark, tmp_path):
    target, manifest = compaction.consolidate_segments(records(spark).limit(0), spark.createDataFrame([], FILES), f"file://{tmp_path}/out")
    assert manifest.count() == 0 and compaction.read_consolidated(target, manifest).count() == 0


def test_directory_of_text(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(40):
        (source / f"{i}.csv").write_text(f"k,v\n{i},a" + ("\n" if i % 2 else ""))
    (source / "empty.csv").write_text("")
    done = compaction.compact_directory(spark, str(source), f"file://{tmp_path}/out", suffix=".csv", header_lines=1, target_bytes=60).collect()
    texts = [(tmp_path / "out" / r["name"]).read_text() for r in done]
    assert 1 < len(done) < 10 and sum(r["sources"] for r in done) == 40
    assert all(t.startswith("k,v\n") and t.count("k,v") == 1 for t in texts)
    assert sorted(int(x.split(",")[0]) for t in texts for x in t.splitlines()[1:]) == list(range(40))
    assert len(list(source.iterdir())) == 41


def test_directory_of_frames(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(20):
        (source / f"{i}.zst").write_bytes(zstandard.compress(f"{i}\n".encode()))
    done = compaction.compact_directory(spark, str(source), f"file://{tmp_path}/out", suffix=".zst", target_bytes=10**6).collect()
    with zstandard.ZstdDecompressor().stream_reader((tmp_path / "out" / done[0]["name"]).read_bytes(), read_across_frames=True) as f:
        assert sorted(map(int, f.read().split())) == list(range(20))


def test_header_longer_than_a_piece():
    pieces = [b"a,", b"b", b"\n1,", b"2\n"]
    head, rest = compaction._without_header(iter(pieces), 1)
    assert head == b"a,b\n" and b"".join(rest) == b"1,2\n"
    head, rest = compaction._without_header(iter([b"only"]), 2)
    assert head == b"only" and b"".join(rest) == b""
