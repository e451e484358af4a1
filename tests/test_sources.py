"""Media headers, JSON documents, archives and versioned tables."""

import json
import os
import tarfile
import threading

import pytest
from pyspark.sql import functions as F

from framewright.operators import publish
from framewright.sources import archives, documents, files, media, versions
from framewright.sources.scratch import filesystem, new_folder

VIDEO = "{}/videos/chunk-{:03d}/observation.images.rgb_{:02d}/episode_{:06d}.mp4"


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("media")
    header = b"\0\0\0\x18ftypisom" + b"x" * 50
    for subset in ("arm", "lab/rover", "lab/dog"):
        for chunk in range(3):
            for camera in (1, 2):
                path = root / VIDEO.format(subset, chunk, camera, chunk * 10 + camera)
                path.parent.mkdir(parents=True, exist_ok=True)
                path.write_bytes(header if camera == 1 else b"\0\0\0\x18fty"[: 7 * chunk])
    (root / "arm/videos/chunk-000/observation.images.rgb_01/.episode_000001.7.part.mp4").write_bytes(header)
    (root / "arm/notes.mp4").write_bytes(header[:11])
    (root / "arm/meta").mkdir()
    (root / "arm/meta/info.json").write_text("{}")
    return root


def test_headers_of_a_tree(spark, tree):
    rows = {r["path"]: r for r in media.scan_headers(spark, f"file://{tree}").withColumn("is_mp4", files.has_mp4_signature(F.col("header"))).collect()}
    assert len(rows) == 19 and not any("part" in p for p in rows)
    r = rows[VIDEO.format("lab/rover", 2, 1, 21)]
    assert (r["subset"], r["chunk"], r["input_camera"], r["episode"], r["bytes"], bytes(r["header"]), r["is_mp4"]) == ("lab/rover", "chunk-002", "observation.images.rgb_01", "episode_000021", 62, b"\0\0\0\x18ftypisom", True)
    assert (rows["arm/notes.mp4"]["subset"], rows["arm/notes.mp4"]["is_mp4"]) == (None, False)
    assert bytes(rows[VIDEO.format("arm", 0, 2, 2)]["header"]) == b"" and rows[VIDEO.format("arm", 1, 2, 12)]["is_mp4"] is False
    assert media.scan_headers(spark, f"file://{tree}", header=0).filter("header is not null").count() == 0
    assert [r["path"] for r in media.scan_headers(spark, f"file://{tree}", ".json").collect()] == ["arm/meta/info.json"]


def test_conditions_reach_the_listing(spark, tree, capfd):
    picked = media.scan_headers(spark, f"file://{tree}").filter("subset in ('lab/dog', 'x') and chunk = 'chunk-001'").filter(F.col("bytes") > 0)
    assert sorted(r["episode"] for r in picked.collect()) == ["episode_000011", "episode_000012"]
    picked.explain()
    plan = capfd.readouterr().out
    assert "media_headers" in plan and "chunk-001" not in plan.split("BatchScan")[0], plan  # no filter is left above the source
    reader = media.MediaReader({"path": f"file://{tree}"})
    seen, listed = [], reader.listed
    reader.wanted = {"subset": {"lab/dog"}, "chunk": {"chunk-001"}}
    reader.listed = lambda system, base, folder: seen.append(folder) or listed(system, base, folder)
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 2
    assert not [f for f in seen if f.startswith("arm") or "rover" in f or "chunk-000" in f or "chunk-002" in f], seen


def test_a_large_file_costs_one_small_read(spark, tmp_path):
    path = tmp_path / VIDEO.format("s", 0, 1, 1)
    path.parent.mkdir(parents=True)
    with open(path, "wb") as out:
        out.write(b"\0\0\0\x18ftypisom")
        out.truncate(3 << 30)  # sparse
    reader = media.MediaReader({"path": f"file://{tmp_path}"})
    before = int(next(x for x in open("/proc/self/io") if x.startswith("rchar")).split()[1])
    (batch,) = [b for p in reader.partitions() for b in reader.read(p)]
    after = int(next(x for x in open("/proc/self/io") if x.startswith("rchar")).split()[1])
    assert batch.column("bytes")[0].as_py() == 3 << 30 and after - before < 1 << 20
    assert media.scan_headers(spark, f"file://{tmp_path}").filter(files.has_mp4_signature(F.col("header"))).count() == 1


def test_directories_in_slices(spark, tree):
    every = media.MediaReader({"path": f"file://{tree}", "slices": "3", "splits": "2"})
    pieces = every.partitions()
    rows = [[p for b in every.read(piece) for p in b.column("path").to_pylist()] for piece in pieces]
    assert len(pieces) == 6 and sum(bool(r) for r in rows) > 3 and len(sum(rows, [])) == len(set(sum(rows, []))) == 19


def test_an_empty_tree(spark, tmp_path):
    assert media.scan_headers(spark, f"file://{tmp_path}").collect() == []


def test_unknown_keys_come_back(spark, tmp_path):
    lines = ['{"a":{"b":[1,null,{"c":"é\\n"}]},"episode_index":7,"length":5,"n":null,"w":123456789012345678901234567890}', "", '{"length":6}', '{"episode_index":1,"length":2,"z":[[],{}]}']
    (tmp_path / "in.jsonl").write_text("\n".join(lines), encoding="utf-8")
    rows = documents.scan_json_rows(spark, f"file://{tmp_path}/in.jsonl")
    out = new_folder(spark)
    documents.write_json_rows(rows, "row", out)
    assert sorted(r[0] for r in spark.read.text(out).collect()) == sorted(x for x in lines if x)
    changed = new_folder(spark)
    documents.write_json_rows(rows.select(documents.with_keys(F.col("row"), length=F.lit(9), seen=F.lit(True)).alias("row")), "row", changed)
    assert sorted(r[0] for r in spark.read.text(changed).collect()) == sorted(
        ['{"a":{"b":[1,null,{"c":"é\\n"}]},"episode_index":7,"length":9,"n":null,"w":123456789012345678901234567890,"seen":true}', '{"length":9,"seen":true}', '{"episode_index":1,"length":9,"z":[[],{}],"seen":true}'])
    (tmp_path / "bad.jsonl").write_text('{"a": ')
    with pytest.raises(Exception, match="(?i)malformed"):
        documents.scan_json_rows(spark, f"file://{tmp_path}/bad.jsonl").collect()


def described(spark, tmp_path, documents_):
    for subset, text in documents_.items():
        (tmp_path / subset / "meta").mkdir(parents=True)
        (tmp_path / subset / "meta/info.json").write_text(text)
    return documents.scan_descriptors(spark, f"file://{tmp_path}")


def test_descriptors(spark, tmp_path):
    good = {"codebase_version": "v2.1", "fps": 15, "features": {"a.b": {"dtype": "image", "names": None}, "c": {"dtype": "video"}, "d": {}}, "chunks_size": 10, "data_path": "d/{episode_chunk:03d}/{episode_index}.parquet", "total_frames": 3}
    texts = {"x/one": json.dumps(good), "two": json.dumps(good | {"codebase_version": "v3.0"}), "three": "{", "four": json.dumps({k: v for k, v in good.items() if k != "features"}), "five": json.dumps(good | {"codebase_version": None}), "six": json.dumps(good | {"chunks_size": 0}), "seven": "[]", "eight": ""}
    found = described(spark, tmp_path, texts)
    issues = {r["subset"]: r["issue"] for r in documents.descriptor_issues(found).collect()}
    assert issues == {"two": "version v3.0", "three": "no JSON object", "four": "no features", "five": "version absent", "six": "no chunk size", "seven": "version absent", "eight": "no JSON object"}
    usable = documents.usable_descriptors(found)
    assert [tuple(r) for r in documents.feature_table(usable).orderBy("feature").collect()] == [("x/one", "a.b", "image"), ("x/one", "c", "video"), ("x/one", "d", None)]
    episodes = spark.createDataFrame([("x/one", 7, 4), ("x/one", 12, 6), ("two", 1, 1)], "subset string, episode_index long, length long")
    totals = documents.dataset_totals(episodes, usable)
    assert [tuple(r) for r in totals.collect()] == [("x/one", 2, 10, 10)]
    (row,) = documents.with_totals(usable, totals).collect()
    assert json.loads(row["document"]) == good | {"total_frames": 10, "total_images": 10} and list(json.loads(row["document"]))[:6] == list(good)[:6]
    assert row["info"]["total_images"] == 10
    assert sorted(r["path"] for r in documents.episode_files(episodes, found).collect()) == ["x/one/d/000/7.parquet", "x/one/d/001/12.parquet"]


def test_path_templates(spark):
    rows = spark.createDataFrame([("a/{i}/{i:03d}-{j:06d}", 7, 1234567), ("{j}", 1, 2), ("plain", 1, 2)], "t string, i long, j long")
    assert [r[0] for r in rows.select(documents.template_path(F.col("t"), {"i": F.col("i"), "j": F.col("j")})).collect()] == ["a/7/007-1234567", "2", "plain"]


# archives

MEMBERS = "shard long, archive string, member string, payload binary"


def names_of(folder, archive):
    with tarfile.open(f"{filesystem(folder)[1]}/{archive}") as tar:
        return {m.name: tar.extractfile(m).read() for m in tar.getmembers()}, tar.getnames()


def test_archives_are_made_once(spark):
    folder = new_folder(spark)
    members = spark.createDataFrame([(1, "x/a.tar", "b", b"22"), (1, "x/a.tar", "a", b"1"), (2, "y.tar", "é" * 80, None)], MEMBERS).repartition(3)
    status = lambda overwrite: {r["archive"]: (r["status"], r["members"], r["payload_bytes"]) for r in archives.pack_export(members, ["shard"], folder, overwrite).collect()}
    assert status(False) == {"x/a.tar": ("created", 2, 3), "y.tar": ("created", 1, 0)}
    assert status(False)["x/a.tar"][0] == "skipped" and status(True)["x/a.tar"][0] == "created"
    assert names_of(folder, "x/a.tar") == ({"a": b"1", "b": b"22"}, ["a", "b"]) and names_of(folder, "y.tar")[1] == ["é" * 80]
    assert archives.pack_export(members.limit(0), ["shard"], new_folder(spark)).collect() == []


def test_an_aborted_job_leaves_no_archive(spark):
    folder = new_folder(spark)
    rows = [(k, f"{k}.tar", f"m{i:03d}", b"x" * 100) for k in range(4) for i in range(50)]
    members = spark.createDataFrame(rows, MEMBERS)
    bad = members.withColumn("payload", F.when((F.col("shard") == 3) & (F.col("member") == "m049"), F.raise_error(F.lit("broken")).cast("binary")).otherwise(F.col("payload")))
    with pytest.raises(Exception, match="broken"):
        archives.pack_export(bad, ["shard"], folder)
    left = [f for _, _, names in os.walk(filesystem(folder)[1]) for f in names]
    assert left == []


def test_a_shard_larger_than_the_task(monkeypatch, tmp_path):
    """400 MB through a writer that holds one payload: the process's peak hardly moves."""
    import resource

    import pyarrow as pa
    import pyspark

    monkeypatch.setattr(pyspark.TaskContext, "get", classmethod(lambda cls: type("Context", (), {"taskAttemptId": lambda self: 7})()))

    def batches():
        for i in range(100):
            yield pa.RecordBatch.from_arrays([pa.array(["x/big.tar"]), pa.array([f"m{i:03d}"]), pa.array([b"x" * 4_000_000], pa.binary())], ["archive", "member", "payload"])

    writer = archives.TarWriter({"path": f"file://{tmp_path}"})
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    written = writer.write(batches())
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100_000
    assert not (tmp_path / "x/big.tar").exists()
    writer.commit([written, None])
    with tarfile.open(tmp_path / "x/big.tar") as tar:
        assert len(tar.getnames()) == 100 and sum(m.size for m in tar.getmembers()) == 400_000_000


# versions


def numbers(spark, first, last):
    return spark.range(first, last).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("chunk"))


def test_one_of_two_publishers_wins(spark):
    table = versions.VersionedTable(spark, new_folder(spark))
    table.append(numbers(spark, 0, 5))
    reports, gate = {}, threading.Barrier(2)
    current = table.current

    def publisher(name):
        own = versions.VersionedTable(spark, table.root)
        waited = []

        def both_have_checked():
            found = current()
            if not waited:
                waited.append(gate.wait(60))
            return found

        own.current = both_have_checked
        reports[name] = publish.publish_staged(numbers(spark, 10, 14), own, ["k"]).collect()

    threads = [threading.Thread(target=publisher, args=(n,)) for n in "ab"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(len(r) for r in reports.values()) == [0, 4]
    assert sorted(r["k"] for r in table.read().collect()) == [0, 1, 2, 3, 4, 10, 11, 12, 13]


def test_publishing(spark):
    table = versions.VersionedTable(spark, new_folder(spark))
    assert publish.publish_staged(numbers(spark, 0, 4), table, ["k"]).count() == 0
    report = publish.publish_staged(numbers(spark, 2, 6), table, ["k"], first=1).collect()
    assert [(r["k"], r["conflicts"]) for r in report] == [(2, 2)]
    assert table.current().number == 1 and table.read().count() == 4
    with pytest.raises(versions.Superseded):
        table.commit(versions.Version(), table.current().schema, [])


def test_rewriting_keeps_the_version_before(spark):
    table = versions.VersionedTable(spark, new_folder(spark))
    table.append(numbers(spark, 0, 9), "chunk", "gzip")
    first = table.current()
    rows = table.read(first).filter("k > 3")
    files.rewrite_frames(table, rows, spark.createDataFrame([("1",), ("7",)], "chunk string"))
    second = table.current()
    assert dict(first.folders)["0"] == dict(second.folders)["0"] and dict(first.folders)["1"] != dict(second.folders)["1"]
    assert sorted(r["k"] for r in table.read(first).collect()) == list(range(9))
    assert sorted(r["k"] for r in table.read().collect()) == [0, 2, 3, 4, 5, 6, 7, 8]
    assert files.codec_of(spark, f"{table.root}/{dict(second.folders)['1']}") == "gzip"
    killed = rows.withColumn("k", F.when(F.col("k") == 7, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("k")))
    with pytest.raises(Exception, match="killed"):
        files.rewrite_frames(table, killed, spark.createDataFrame([("1",)], "chunk string"))
    assert table.current() == second and sorted(r["k"] for r in table.read().collect()) == [0, 2, 3, 4, 5, 6, 7, 8]
    assert table.read(keys=["2"]).count() == 3 and table.read(keys=[]).count() == 0


def test_versions_by_rename(spark, monkeypatch, tmp_path):
    """The way of other file systems: a rename that refuses to overwrite."""
    monkeypatch.setattr(versions.os, "link", None)
    uri = f"file://{tmp_path}/v.json"
    real = str.startswith
    plain = lambda text: versions.create_absent(spark, type("Uri", (str,), {"startswith": lambda self, p: p != "file:" and real(self, p)})(uri), text)
    assert plain(b"one") is True and plain(b"two") is False
    assert (tmp_path / "v.json").read_bytes() == b"one" and [p.name for p in tmp_path.iterdir() if p.name.endswith("part")] == []
