"""Layout, change feed, sinks, settings, paths."""

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import changes, layout
from lakestrata.operators.changes import snapshot_changes
from lakestrata.session import new_scratch
from lakestrata.sources import fs, ingest, paths, settings, tables
from tests.conftest import SF


def parquet_files(spark, path):
    return [n for n in fs.list_names(spark, path) if n.endswith(".parquet")]


def test_recluster_splits_a_value_that_holds_most_rows(spark, tmp_path):
    source = f"{tmp_path}/in"
    # nine tenths of the rows are copies of one row
    rows = spark.range(20_000).select(F.when(F.col("id") < 18_000, 1).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v"))
    rows.repartition(8).write.parquet(source)
    out = layout.recluster(spark, source, str(tmp_path), "out", ["k"], target_bytes=fs.size(spark, source) // 10)
    stored = spark.read.parquet(out)
    assert stored.count() == 20_000 and stored.columns == ["k", "v"]
    sizes = [r["count"] for r in stored.groupBy(F.col("_metadata.file_name")).count().collect()]
    assert max(sizes) < 2 * 20_000 / len(sizes)


def test_recluster_separates_ranges(spark, tmp_path):
    out = layout.recluster(spark, f"{SF}/lineitem.parquet", str(tmp_path), "out", ["l_shipdate"], target_bytes=128 * 1024)
    spans = spark.read.parquet(out).groupBy(F.col("_metadata.file_name")).agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b")).orderBy("a").collect()
    assert len(spans) > 4
    assert all(left["b"] <= right["a"] for left, right in zip(spans, spans[1:]))


def ranges(spark, path, column):
    return spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).agg(F.min(column).alias("a"), F.max(column).alias("b")).collect()


def test_curve_lets_every_column_skip_files(spark, tmp_path):
    by = ["l_shipdate", "l_partkey", "l_comment_like"]
    source = f"{tmp_path}/in"
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    # a skewed number, and a text whose first characters say nothing
    lines.withColumn("l_comment_like", F.concat(F.lit("Customer#000"), F.format_string("%06d", F.col("l_suppkey") * 7 + F.col("l_orderkey") % 7))).repartition(4).write.parquet(source)
    out = layout.recluster_curve(spark, source, str(tmp_path), "out", by, target_bytes=fs.size(spark, source) // 96)
    stored = spark.read.parquet(out)
    assert stored.columns == spark.read.parquet(source).columns
    assert stored.exceptAll(spark.read.parquet(source)).isEmpty() and stored.count() == lines.count()
    for column in by:
        spans, wanted = ranges(spark, out, column), spark.read.parquet(source).select(column).orderBy(F.rand(1)).limit(9).collect()
        read = [sum(s["a"] <= w[0] <= s["b"] for s in spans) for w in wanted]
        assert sum(read) / len(read) < len(spans) * 0.4, (column, read, len(spans))


def test_curve_of_nulls_ties_and_nothing(spark, tmp_path):
    source = f"{tmp_path}/in"
    rows = spark.range(2_000).select(F.when(F.col("id") % 3 > 0, F.lit(5)).alias("k"), F.lit(None).cast("string").alias("t"), F.lit(True).alias("b"))
    rows.write.parquet(source)
    out = layout.recluster_curve(spark, source, str(tmp_path), "out", ["k", "t", "b"], target_bytes=fs.size(spark, source) // 4)
    assert spark.read.parquet(out).count() == 2_000
    assert len({(s["a"], s["b"]) for s in ranges(spark, out, "k")}) >= 2
    rows.limit(0).write.parquet(f"{tmp_path}/none")
    assert spark.read.parquet(layout.recluster_curve(spark, f"{tmp_path}/none", str(tmp_path), "no", ["k"])).count() == 0
    with pytest.raises(ValueError, match="no order"):
        layout.with_curve(spark.range(1).select(F.array("id").alias("a")), ["a"], "_curve")


@pytest.mark.parametrize("axes,bits", [(1, 5), (2, 4), (3, 3)])
def test_curve_visits_neighbours(spark, axes, bits):
    """Every cell once, and each step moves along one axis by one: that is what makes it Hilbert's."""
    names = [f"x{i}" for i in range(axes)]
    cells = spark.range(2 ** (bits * axes)).select("id", *(F.shiftright("id", bits * i).bitwiseAND(F.lit(2**bits - 1)).alias(n) for i, n in enumerate(names)))
    kept = cells.select("*", *(F.col(n).alias(f"cell_{n}") for n in names))
    turned = layout._along_hilbert(kept, names, bits).collect()
    place = lambda row: [row[n] >> bit & 1 for bit in reversed(range(bits)) for n in names]
    walk = [[row[f"cell_{n}"] for n in names] for row in sorted(turned, key=place)]
    assert len({tuple(place(row)) for row in turned}) == len(walk)
    assert all(sum(abs(a - b) for a, b in zip(one, two)) == 1 for one, two in zip(walk, walk[1:]))


def test_ranks_follow_values(spark):
    rows = spark.range(4_096).select((F.col("id") * F.col("id")).alias("v"))
    found = layout.with_curve(rows, ["v"], "at").orderBy("v").collect()
    at = [r["at"] for r in found]
    assert at == sorted(at) and set(at) == set(range(256)) and max(map(at.count, set(at))) <= 20


def test_compact_in_place_leaves_large_files_alone(spark, tmp_path):
    folder = f"{tmp_path}/a b"
    spark.range(50_000).coalesce(1).write.parquet(folder)
    ((large, size),) = [(n, b) for n, b in fs.list_files(spark, folder).items() if n.endswith(".parquet")]
    spark.range(50_000, 60_000).repartition(30).write.mode("append").parquet(folder)
    first = layout.compact_in_place(spark, folder, target_bytes=size)
    assert first.kept == 1 and first.replaced == 30 and 1 <= first.written <= 3
    assert large in fs.list_names(spark, folder)
    assert sorted(r["id"] for r in spark.read.parquet(folder).collect()) == list(range(60_000))
    assert layout.compact_in_place(spark, folder, target_bytes=size) == layout.Compaction(1 + first.written, 0, 0)


def test_compact_in_place_keeps_folder_keys_and_finishes_what_was_cut_short(spark, tmp_path, monkeypatch):
    folder = f"{tmp_path}/t"
    rows = spark.range(900).withColumn("day", F.col("id") % 3).withColumn("v", F.when(F.col("id") > 500, F.col("id")))
    rows.repartition(5).write.partitionBy("day").parquet(folder)
    with monkeypatch.context() as patch, pytest.raises(OSError):
        cut_short(patch, "rename")
        layout.compact_in_place(spark, folder)
    found = layout.compact_in_place(spark, folder)
    assert found == layout.Compaction(3, 0, 0)  # the plan was carried out first
    stored = spark.read.parquet(folder)
    assert sorted(map(tuple, stored.select("id", "day", "v").collect())) == sorted(map(tuple, rows.collect()))
    assert all(len(parquet_files(spark, f"{folder}/day={d}")) == 1 for d in range(3))


def test_compact_in_place_shuffles_nothing(spark, tmp_path):
    folder = f"{tmp_path}/t"
    rows = spark.range(9_000).select("id", F.lit("own").alias("_file"), (F.col("id") % 7).alias("_bin"))
    rows.repartitionByRange(9, "id").sortWithinPartitions("id").write.parquet(folder)
    jobs = spark.sparkContext.statusTracker()
    before = set(jobs.getJobIdsForGroup(None))
    assert layout.compact_in_place(spark, folder) == layout.Compaction(0, 9, 1)
    assert all(len(jobs.getJobInfo(job).stageIds) == 1 for job in set(jobs.getJobIdsForGroup(None)) - before)
    stored = spark.read.parquet(folder)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, rows.collect()))
    at = [r["id"] for r in stored.orderBy(F.col("_metadata.row_index")).collect()]
    assert sum(b != a + 1 for a, b in zip(at, at[1:])) < 9  # each file's rows in their order


def test_compact_in_place_makes_a_file_of_each_bin(spark, tmp_path):
    folder = f"{tmp_path}/t"
    spark.range(160_000).repartition(16).write.parquet(folder)
    sizes = [b for n, b in fs.list_files(spark, folder).items() if n.endswith(".parquet")]
    assert layout.compact_in_place(spark, folder, target_bytes=4 * max(sizes)) == layout.Compaction(0, 16, 4)
    assert spark.read.parquet(folder).select("id").distinct().count() == 160_000


def test_bins():
    sizes = {"a": 5, "b": 4, "c": 3, "d": 3, "e": 2, "big": 30, "z": 0}
    found = layout.bins_of(sizes, 10)
    assert sorted(n for b in found for n in b) == sorted(sizes)
    assert all(sum(sizes[n] for n in b) <= 10 or b == ["big"] for b in found) and len(found) == 3


def test_compact_makes_few_files_without_a_shuffle(spark, tmp_path):
    source = f"{tmp_path}/in"
    spark.range(10_000).repartition(40).write.parquet(source)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    out = layout.compact(spark, source, str(tmp_path), "one")
    assert len(parquet_files(spark, out)) == 1
    out = layout.compact(spark, source, str(tmp_path), "some", target_bytes=fs.size(spark, source) // 4)
    assert 4 <= len(parquet_files(spark, out)) <= 6
    assert spark.read.parquet(out).select("id").distinct().count() == 10_000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == kept


def test_file_count():
    assert [layout.file_count(b, 10) for b in (0, 1, 10, 11)] == [1, 1, 1, 2]
    with pytest.raises(ValueError):
        layout.file_count(1, 0)


def test_changes_between_snapshots(spark):
    schema = "k long, a string, b double"
    old = spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0), (3, "z", None), (None, "n", 0.0)], schema)
    new = spark.createDataFrame([(None, "n", 0.0), (2, None, 2.0), (3, "z", 3.0), (4, "w", 4.0)], schema).select("b", "k", "a")
    out = snapshot_changes(old, new, ["k"])
    assert out.columns == ["change_type", "k", "a", "b"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [("delete", 1, "x", 1.0), ("update_pre", 3, "z", None), ("update_post", 3, "z", 3.0), ("insert", 4, "w", 4.0)], key=repr
    )
    assert snapshot_changes(old, old, ["k"]).count() == 0
    with pytest.raises(ValueError):
        snapshot_changes(old, new.drop("a"), ["k"])


def test_changes_of_swapped_nulls(spark):
    """Rows that a plain hash takes for equal, and values that differ in form only."""
    schema = "k long, a long, b long, l array<long>, s struct<x: long, y: long>, d double"
    old = [(1, None, 1, None, None, 0.0), (2, 1, 1, [None, 1], None, 0.0), (3, 1, 1, [], (None, 1), 0.0), (4, 1, 1, [1], (1, 1), 0.0), (5, 1, 1, None, None, None)]
    new = [(1, 1, None, None, None, 0.0), (2, 1, 1, [1, None], None, 0.0), (3, 1, 1, [], (1, None), 0.0), (4, 1, 1, [1], (1, 1), -0.0), (5, 1, 1, None, None, None)]
    out = snapshot_changes(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), ["k"]).collect()
    assert sorted((r["k"], r["change_type"]) for r in out) == [(k, t) for k in (1, 2, 3) for t in ("update_post", "update_pre")]


@pytest.mark.parametrize("wrong", ["one half equal", "all differ"])
def test_changes_when_digests_mislead(spark, monkeypatch, wrong):
    """One half of a digest is enough to find a change, and a digest that differs is not taken for one."""
    digest = changes.row_digest

    def misled(schema, columns):
        if wrong == "all differ":
            return F.struct(F.rand().alias("a"), F.lit(0).alias("b"))
        return F.struct(F.lit(0).cast("long").alias("a"), digest(schema, columns)["b"].alias("b"))

    monkeypatch.setattr(changes, "row_digest", misled)
    old = spark.range(500).select("id", (F.col("id") % 7).alias("v"))
    new = spark.range(10, 510).select("id", F.when(F.col("id") % 100 == 50, -1).otherwise(F.col("id") % 7).alias("v"))
    counts = {r["change_type"]: r["count"] for r in snapshot_changes(old, new, ["id"]).groupBy("change_type").count().collect()}
    assert counts == {"delete": 10, "insert": 10, "update_pre": 5, "update_post": 5}


def test_changes_of_empty_snapshots_and_clashing_names(spark):
    schema = "_old long, `a.b` string, _digest long, _side long, _key_0 long, change_kind string"
    none = spark.createDataFrame([], schema)
    some = spark.createDataFrame([(1, "x", 2, 3, 4, "c"), (None, "y", 2, 3, 4, None)], schema)
    assert snapshot_changes(none, none, ["_old"]).count() == 0
    assert [r["change_type"] for r in snapshot_changes(none, some, ["_old"]).collect()] == ["insert"] * 2
    gone = snapshot_changes(some, none, ["_old", "a.b"]).collect()
    assert sorted((r["change_type"], r["a.b"], r["_key_0"]) for r in gone) == [("delete", "x", 4), ("delete", "y", 4)]


def test_write_files_counts_and_overwrites(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert tables.write_files(spark.range(100), path, files=3) == 100
    assert len(parquet_files(spark, path)) == 3
    assert tables.write_files(spark.range(7), path) == 7
    assert spark.read.parquet(path).count() == 7
    with pytest.raises(ValueError):
        tables.write_files(spark.range(1), path, files=0)


def test_write_files_makes_more_files_of_large_data(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    monkeypatch.setattr(tables, "FILE_BYTES", 100_000)
    rows = spark.range(50_000).select("id", F.xxhash64("id").alias("v"))
    assert tables.write_files(rows, path, files=2) == 50_000
    found = [b for n, b in fs.list_files(spark, path).items() if n.endswith(".parquet")]
    assert len(found) > 3 and max(found) < 2 * 100_000
    assert spark.read.parquet(path).exceptAll(rows).isEmpty()
    assert tables.write_files(spark.range(0), path, files=2) == 0


def test_full_refresh_keeps_what_readers_may_hold(spark, tmp_path):
    root = f"{tmp_path}/v"
    with pytest.raises(FileNotFoundError):
        tables.current_version(spark, root)
    for n in range(1, 5):
        tables.full_refresh(spark.range(n), root)
        assert tables.current_version(spark, root).count() == n
    assert tables.numbered(spark, root, "version") == [2, 3]
    tables.full_refresh(tables.current_version(spark, root).limit(1), root)
    assert tables.current_version(spark, root).count() == 1


def test_failed_refresh_leaves_the_old_version(spark, tmp_path):
    root = f"{tmp_path}/v"
    tables.full_refresh(spark.range(3), root)
    with pytest.raises(Exception):
        tables.full_refresh(spark.range(3).select(F.raise_error(F.lit("stop")).cast("long").alias("id")), root)
    assert tables.current_version(spark, root).count() == 3


def test_replace_table_and_scan(spark):
    tables.replace_table(spark.range(3), "replaced")
    tables.replace_table(spark.range(2), "replaced")
    assert tables.scan_table(spark, "spark_catalog.default.replaced").count() == 2
    spark.sql("DROP TABLE replaced")


@pytest.fixture
def table(spark):
    name = "settings_" + new_scratch(spark, "t").rsplit("-", 1)[-1]
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_settings(spark, table):
    settings.replace_settings(spark, table, {"a": "1", "b": "", "q": "it's"})
    assert settings.load_settings(spark, table) == {"a": "1", "b": "", "q": "it's"}
    with pytest.raises(KeyError, match="absent"):
        settings.load_settings(spark, table, required=("a", "absent"))
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        settings.load_settings(spark, "no_such_table")


def test_settings_insert_is_idempotent(spark, table):
    settings.replace_settings(spark, table, {"a": "1"})
    new = spark.createDataFrame([("a", "2"), ("c", "3"), ("c", "3")], "key string, value string")
    for _ in range(2):
        settings.insert_missing(spark, table, new)
        assert settings.load_settings(spark, table) == {"a": "1", "c": "3"}
        assert spark.table(table).count() == 2


def test_settings_with_other_column_names(spark, table):
    names = ("Clave", "Valor")
    settings.replace_settings(spark, table, {"a": "1"}, names)
    new = spark.createDataFrame([("b", "2")], "Clave string, Valor string")
    settings.insert_missing(spark, table, new, names)
    assert settings.load_settings(spark, table, columns=names) == {"a": "1", "b": "2"}
    assert settings.lookup(spark.table(table), "b", names).first()["Valor"] == "2"


def test_only_wanted_settings_are_read(spark, table):
    settings.replace_settings(spark, table, {"a": "1", "b": "2", "c": "3"})
    assert settings.load_settings(spark, table, ("a", "c")) == {"a": "1", "c": "3"}


def test_code_lists():
    assert settings.split_codes("DATM, CATM,PGSL,X", 3) == ["DATM", "CATM", "PGSL"]
    for bad in ("A,B", "A,,C", ""):
        with pytest.raises(ValueError):
            settings.split_codes(bad, 3)


def test_paths():
    volume = {"TipoStorage": "Volume", "catalogoVolume": "c", "esquemaVolume": "s", "nombreVolume": "v"}
    assert paths.resolve_path(volume, "a/b/") == "/Volumes/c/s/v/a/b/"
    bucket = {"TipoStorage": "AmazonS3", "bucketS3": "b", "prefijoS3": "ignored"}
    assert paths.resolve_path(bucket, "a/b") == "s3://b/a/b"
    for bad in ({"TipoStorage": "HDFS"}, {}, {"TipoStorage": "AmazonS3", "bucketS3": ""}):
        with pytest.raises(ValueError):
            paths.resolve_path(bad, "a")


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from lakestrata import session

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"
            applicationId = "x"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Cluster)


def test_half_filled_folders_are_written_again(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).write.parquet(f"{root}/version=0")  # what a rename that was cut short leaves
    assert tables.numbered(spark, root, "version") == []
    assert tables.full_refresh(spark.range(5), root).endswith("version=0")
    assert tables.current_version(spark, root).count() == 5
    tables.publish(spark.range(9), root, "version=0")  # whole: left alone
    assert tables.current_version(spark, root).count() == 5


def cut_short(monkeypatch, name, times=1):
    """Make the file helper ``name`` fail on its next ``times`` calls that concern a marker or data file."""
    kept, left = getattr(fs, name), [times]

    def fail(spark, path, *rest):
        if left[0] and "_notes" not in path:
            left[0] -= 1
            raise OSError("cut short")
        return kept(spark, path, *rest)

    monkeypatch.setattr(fs, name, fail)


@pytest.mark.parametrize("lost", ["marker", "some files"])
def test_a_publish_cut_short_goes_on_with_the_same_files(spark, tmp_path, monkeypatch, lost):
    """A stream that saw the folder before it was whole neither doubles nor loses rows."""
    root, reads = f"{tmp_path}/t", []
    with monkeypatch.context() as patch, pytest.raises(OSError):
        cut_short(patch, "write_text")
        tables.publish(spark.range(100).repartition(4), root, "batch=0")
    if lost == "some files":  # as if the rename of the folder had stopped half way, one file copied and not yet deleted
        names = [n for n in fs.list_names(spark, f"{root}/batch=0") if n.endswith(".parquet")]
        for name in names[:2]:
            fs.rename(spark, f"{root}/batch=0/{name}", f"{root}/_staging/batch=0/{name}")
        stored = open(f"{root}/batch=0/{names[3]}", "rb").read()
        open(f"{root}/_staging/batch=0/{names[3]}", "wb").write(stored)

    def read():
        stream = spark.readStream.schema("id long").parquet(root)
        ingest.run_available(stream, f"{tmp_path}/checkpoint", lambda batch, n: reads.extend(r["id"] for r in batch.collect()))

    read()
    assert tables.numbered(spark, root, "batch") == []
    tables.publish(spark.range(100).repartition(3), root, "batch=0")
    read()
    assert tables.numbered(spark, root, "batch") == [0] and sorted(reads) == list(range(100))
    assert fs.list_names(spark, f"{root}/_staging/_notes") == []
    assert fs.list_names(spark, f"{root}/_staging") == ["_notes"]


def test_a_note_without_its_files_is_not_trusted(spark, tmp_path):
    root = str(tmp_path)
    tables.publish(spark.range(3), root, "batch=0")
    fs.delete(spark, f"{root}/batch=0")
    fs.write_text(spark, f"{root}/_staging/_notes/batch=0.json", '["gone.parquet"]')
    tables.publish(spark.range(4), root, "batch=0")
    assert spark.read.parquet(f"{root}/batch=0").count() == 4


@pytest.fixture
def swapped(spark):
    yield "spark_catalog.default.swapped"
    spark.sql("DROP TABLE IF EXISTS spark_catalog.default.swapped")


def test_refresh_table_swaps_whole_versions(spark, tmp_path, swapped):
    root = f"{tmp_path}/it's a table"
    tables.refresh_table(spark.range(3), swapped, root)
    assert spark.table(swapped).count() == 3
    # a reader that began before the refresh; the new content may come from the old
    early = spark.table(swapped)
    tables.refresh_table(spark.table(swapped).filter("id > 0"), swapped, root)
    assert sorted(r["id"] for r in spark.table(swapped).collect()) == [1, 2]
    broken = spark.range(4).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        tables.refresh_table(broken, swapped, root)
    assert sorted(r["id"] for r in spark.table(swapped).collect()) == [1, 2]
    assert early.columns == ["id"] and tables.numbered(spark, root, "version") == [0, 1]


def test_refresh_table_with_other_columns(spark, tmp_path, swapped):
    root = str(tmp_path)
    tables.refresh_table(spark.range(3), swapped, root)
    tables.refresh_table(spark.range(3).withColumn("odd `name`", F.lit("x")), swapped, root)
    assert spark.table(swapped).columns == ["id", "odd `name`"] and spark.table(swapped).count() == 3
    tables.refresh_table(spark.range(2).select(F.col("id").cast("string").alias("id")), swapped, root)
    assert spark.table(swapped).dtypes == [("id", "string")]
    tables.refresh_table(spark.range(0).select(F.col("id").cast("string").alias("id")), swapped, root)
    assert spark.table(swapped).count() == 0


def test_refresh_table_leaves_managed_tables_alone(spark, tmp_path, swapped):
    spark.range(2).write.format("parquet").saveAsTable(swapped)
    with pytest.raises(ValueError, match="not EXTERNAL"):
        tables.refresh_table(spark.range(3), swapped, str(tmp_path))
    assert spark.table(swapped).count() == 2
