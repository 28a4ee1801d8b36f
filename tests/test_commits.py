"""What commits of state tables write, and what they leave."""

import json

from pyspark.sql import functions as F

from stratum.sources.files import few_listing_tasks

from .test_runs import content, table


def test_each_row_of_a_commit_goes_to_one_bucket_folder(spark, tmp_path):
    t, written = table(spark, tmp_path, buckets=2, bucket_rows=25), []
    write = t._write
    t._write = lambda df, folder, manifest: (written.append((folder.rsplit("/", 1)[1], df.count())), write(df, folder, manifest))[1]
    rows = lambda a, b, name: spark.range(a, b).select("id", F.lit(name).alias("name"), F.lit(0).alias("n"))
    newer = lambda old, new: new
    t.merge(rows(0, 200, "a"), newer, unique=True)
    assert written == [("_v=1f", 200)] and len(t.runs()) == 8
    t.merge(rows(150, 210, "b"), newer, unique=True)
    runs = t.runs()
    assert sorted(written[1:]) == sorted((f"_v={name}", sum(r["rows"] for own in runs.values() for r in own if r["folder"] == name)) for name in {r["folder"] for own in runs.values() for r in own} - {"1f"})
    assert {f.name for f in (tmp_path / "t").glob("_v=2*")} == {name for name, _ in written[1:]}
    assert content(t.read()) == {i: ("b" if i >= 150 else "a", 0) for i in range(210)}


def test_folders_are_those_of_the_kept_versions(spark, tmp_path):
    t = table(spark, tmp_path, buckets=3, bucket_rows=40)
    for step in range(6):
        t.upsert(spark.range(step * 7, step * 7 + (60 if step % 3 == 0 else 9)).select("id", F.lit("x").alias("name"), F.lit(step).alias("n")))
    t.delete_where("id % 50 = 3")
    named = set()
    for manifest in (tmp_path / "t").glob("_manifest-*"):
        named |= {f"_v={r['folder']}/__bucket={b}" for b, own in json.loads(manifest.read_text())["runs"].items() for r in own}
    assert {f"{p.parent.name}/{p.name}" for p in (tmp_path / "t").glob("_v=*/__bucket=*")} == named
    assert len(list((tmp_path / "t").glob("_manifest-*"))) == 2 and not (tmp_path / "t/_staging").exists()


def test_listing_of_folders_leaves_the_setting_as_it_was(spark):
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    with few_listing_tasks(spark):
        assert int(spark.conf.get(name)) == 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(name) == before
