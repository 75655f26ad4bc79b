"""Sinks, mutation, versions, quality rules and streams on small frames."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeshelf.operators import layout, versions
from lakeshelf.operators.joins import broadcast_checked, estimated_bytes, full_join, join_null_safe
from lakeshelf.operators.layout import (
    STAGED, bucket, compact, compact_in_place, file_stats, held, pack, partition_stats, truncate_number,
)
from lakeshelf.operators.mutate import (
    DuplicateKeys, delete, delete_from, merge, merge_into, merge_metrics, update, update_table,
)
from lakeshelf.operators.quality import (
    QualityError, at_least, at_most, codes_with_many_labels, enforce, equal_to, evaluate,
)
from lakeshelf.plans import readings
from lakeshelf.session import folders_in, forget_stored, new_path, shared_folder, store, subfolders
from lakeshelf.sources.readers import read_delimited, read_jdbc, sniff_separator, unique_names
from lakeshelf.sources import sinks
from lakeshelf.sources.sinks import BatchRejected, append_evolving, replace_partitions, write_files
from lakeshelf.streaming import files as streams


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


# --- files -------------------------------------------------------------------


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_separator_rule(spark, tmp_path):
    for text, sep in [("a;b;c;d", ";"), ("a,b,c,d", ","), ("a\tb\tc\td", "\t"), ("a|b|c|d", "|"), ("a,b", ";")]:
        path = tmp_path / f"h{ord(sep)}{len(text)}"
        path.write_text(text + "\n1\n")
        assert sniff_separator(spark, str(path)) == sep


def test_repeated_header_gets_positions(spark, tmp_path):
    path = tmp_path / "dup.csv"
    path.write_bytes("UF;Espécie;Espécie;X\nSão Paulo;87;Amparo;1\n".encode("latin-1"))
    df = read_delimited(spark, str(path))
    assert df.columns == ["UF", "Espécie1", "Espécie2", "X"]
    assert tuple(df.first()) == ("São Paulo", "87", "Amparo", "1")


def test_unique_names():
    assert unique_names(["a", "b", "a", "a"]) == ["a", "b", "a_1", "a_2"]


def test_empty_frame_with_schema(spark):
    df = spark.createDataFrame([], "id int, nome string")
    assert df.count() == 0 and df.columns == ["id", "nome"]


def test_jdbc_bounds_are_checked(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none", "t", "id", 5, 5, 4)
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none", "t", "id", 0, 5, 0)


@pytest.fixture
def months(spark):
    path = new_path(spark, "months")
    df = spark.createDataFrame([(1, "202601"), (2, "202601"), (3, "202602")], "v int, m string")
    replace_partitions(df, path, "m")
    return path, df


def test_month_replace_is_idempotent_and_leaves_others(spark, months):
    path, df = months
    new = spark.createDataFrame([(9, "202601")], "v int, m string")
    for _ in range(2):
        replace_partitions(new, path, "m", only=["202601"])
    assert rows(spark.read.schema(df.schema).parquet(path)) == [(3, "202602"), (9, "202601")]


@pytest.mark.parametrize("batch", [[], [(1, "202601"), (2, "202602")], [(1, None)]])
def test_bad_batches_are_refused_before_the_write(spark, months, batch):
    path, df = months
    with pytest.raises(BatchRejected):
        replace_partitions(spark.createDataFrame(batch, "v int, m string"), path, "m", only=["202601"])
    assert spark.read.schema(df.schema).parquet(path).count() == 3


def test_batch_is_computed_once(spark, months):
    path, _ = months
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    batch = spark.createDataFrame([(7, "202602")] * 10, "v int, m string").mapInPandas(seen, "v int, m string")
    replace_partitions(batch, path, "m", only=["202602"])
    assert runs.value == 10


def test_empty_batch_without_month_list(spark, months):
    with pytest.raises(BatchRejected):
        replace_partitions(spark.createDataFrame([], "v int, m string"), months[0], "m")


def test_append_refuses_a_changed_type(spark):
    old = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(BatchRejected):
        append_evolving(spark.createDataFrame([("x",)], "a string"), old, new_path(spark, "t"))


def test_error_mode_refuses_an_existing_path(spark):
    path = new_path(spark, "t")
    spark.range(3).write.mode("errorifexists").parquet(path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        spark.range(3).write.mode("errorifexists").parquet(path)


def test_file_counts_and_compaction(spark):
    small, big = new_path(spark, "small"), new_path(spark, "big")
    write_files(spark.range(1000).repartition(20), small, 20, heavy=True)
    assert file_stats(spark, small)[0] == 20
    before, after = compact(spark, small, big)
    assert (before, after) == (20, 1)
    assert rows(spark.read.parquet(big)) == rows(spark.read.parquet(small))


def test_partitioned_compaction_keeps_partitions(spark):
    small, big = new_path(spark, "small"), new_path(spark, "big")
    spark.range(100).withColumn("p", F.col("id") % 3).repartition(8).write.partitionBy("p").parquet(small)
    before, after = compact(spark, small, big, ["p"])
    assert after < before
    assert rows(partition_stats(spark.read.parquet(big), ["p"]).select("p", "rows")) == [(0, 34), (1, 33), (2, 33)]


def test_partitioned_compaction_keeps_text_and_file_size(spark):
    small, big = new_path(spark, "small"), new_path(spark, "big")
    source = spark.range(4000).selectExpr("id", "if(id % 2 = 0, '007', '010') AS p")
    source.repartition(8).write.partitionBy("p").parquet(small)
    _, after = compact(spark, small, big, ["p"], file_bytes=file_stats(spark, small)[1] // 6)
    assert 6 <= after <= 8
    assert rows(spark.read.schema(source.schema).parquet(big).groupBy("p").count()) == [("007", 2000), ("010", 2000)]


def _names(spark, path, schema):
    found = spark.read.schema(schema).parquet(path).select("_metadata.file_path").distinct().collect()
    return {"/".join(r[0].split("/")[-2:]) for r in found}


def _files_to_compact(spark):
    """A large file and eight small ones in three folders, one of them NULL, one escaped."""
    path = new_path(spark, "files")
    source = spark.range(9000).selectExpr("id", "CASE id % 3 WHEN 0 THEN 'a:b/c%' WHEN 1 THEN '007' END AS p")
    schema = source.schema
    source.where("id < 8000").repartition("p").write.partitionBy("p").parquet(path)
    large = _names(spark, path, schema)
    source.where("id >= 8000").repartition(8).write.mode("append").partitionBy("p").parquet(path)
    limit = min(size for _, size in _sizes(spark, path, large)) - 1
    return path, schema, large, limit, rows(source)


def _sizes(spark, path, names=None):
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    found = [("/".join(r[0].split("/")[-2:]), r[1]) for r in listing.select("_metadata.file_path", "length").collect()]
    return [f for f in found if names is None or f[0] in names]


def test_compaction_in_place_leaves_large_files(spark):
    path, schema, large, limit, data = _files_to_compact(spark)
    old, new = compact_in_place(spark, path, schema, ["p"], limit)
    assert (old, new) == (24, 3)  # eight small files of each folder became one
    names = _names(spark, path, schema)
    assert large < names and len(names) == 6
    assert rows(spark.read.schema(schema).parquet(path)) == data
    assert compact_in_place(spark, path, schema, ["p"], limit) == (0, 0)
    assert _names(spark, path, schema) == names and f"{STAGED}" not in subfolders(spark, path)


@pytest.mark.parametrize("done", range(4))
def test_compaction_that_stops_is_finished(spark, monkeypatch, done):
    """Stopped after so many moves and removals, the next run ends it and loses nothing."""
    path, schema, large, limit, data = _files_to_compact(spark)
    left, moved, removed = [done * 9], layout.rename_file, layout.remove_folder

    def counted(fn):
        def run(s, at, *a):
            if at.endswith(".parquet"):
                if left[0] == 0:
                    raise RuntimeError("stopped")
                left[0] -= 1
            return fn(s, at, *a)
        return run

    monkeypatch.setattr(layout, "rename_file", counted(moved))
    monkeypatch.setattr(layout, "remove_folder", counted(removed))
    if done < 3:
        with pytest.raises(RuntimeError):
            compact_in_place(spark, path, schema, ["p"], limit)
    else:
        compact_in_place(spark, path, schema, ["p"], limit)
    monkeypatch.undo()
    layout.finish_compaction(spark, path)
    assert rows(spark.read.schema(schema).parquet(path)) == data and len(_names(spark, path, schema)) == 6


def test_packing_is_first_fit():
    sizes = [("a", 6), ("b", 5), ("c", 4), ("d", 3), ("e", 2), ("f", 9)]
    assert pack(sizes, 10) == [["a", "c"], ["b", "d", "e"]]
    assert pack([], 10) == [] and pack([("a", 1)], 10) == []


def test_bucketed_tables_join_without_a_shuffle(spark):
    from lakeshelf.queries.tables import lay_bucketed_join

    made = lay_bucketed_join(spark, "/root/testdata/sf0.001")
    assert made.count() > 0
    text = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "SortMergeJoin" in text and "Bucketed: true" in text


def test_full_join_lets_null_keys_by_and_splits_hot_ones(spark):
    left = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 3), (None, "d", None), (3, None, 5)], "k int, x string, j int")
    right = spark.createDataFrame([("p", 1), ("q", 2), (None, None), ("r", None), ("s", 1)], "y string, k int")
    want = rows(left.join(right, ["k"], "full"))
    got = full_join(left, right, ["k"])
    assert got.columns == ["k", "x", "j", "y"] and rows(got) == want
    assert "FullOuter" not in got._jdf.queryExecution().executedPlan().toString()
    two = right.withColumnsRenamed({"y": "z"}).withColumn("j", F.lit(1))
    assert rows(full_join(left, two, ["k", "j"])) == rows(left.join(two, ["k", "j"], "full"))
    assert rows(full_join(left.where("k > 9"), right, ["k"])) == rows(left.where("k > 9").join(right, ["k"], "full"))
    with pytest.raises(ValueError):
        full_join(left, right.withColumnRenamed("y", "x"), ["k"])


def test_hot_key_of_a_full_join_is_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    hot = new_path(spark, "hot")
    spark.range(60000).selectExpr("if(id < 30000, 1, id) AS k", "uuid() AS x").repartition(8).write.parquet(hot)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        left, right = spark.read.parquet(hot), spark.range(50, 300).selectExpr("id * 300 - 14999 AS k", "id AS y").repartition(3)
        made = full_join(left, right, ["k"])
        assert made.count() == left.join(right, ["k"], "full").count()
        joined = full_join(left, right, ["k"])
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _scanned_rows(df):
    """Rows that the file scans of an executed frame gave."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        if hasattr(node, "plan") and name.endswith("QueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_point_lookup_skips_by_bloom_filter(spark):
    path = new_path(spark, "arrival")
    ids = spark.range(0, 40000).selectExpr("id * 2 AS id", "CAST(id AS DOUBLE) AS value", "timestamp_seconds(id) AS time")
    readings.write_as_they_come(ids.orderBy(F.hash("id")).coalesce(2), path, group_rows=1000)
    for wanted, hits in ((4242, 1), (79998, 1), (4243, 0), (33333, 0)):
        found = readings.point_lookup(spark, path, wanted)
        assert len(found.collect()) == hits
        # Every row group spans nearly all ids, so only the filter can leave one out; 1 in 100 may deceive.
        assert _scanned_rows(found) <= 1000 * hits + 2000
    plain = new_path(spark, "plain")
    ids.orderBy(F.hash("id")).coalesce(2).write.option("parquet.block.row.count.limit", "1000").parquet(plain)
    found = readings.point_lookup(spark, plain, 4242)
    assert len(found.collect()) == 1 and _scanned_rows(found) > 20000


def test_one_month_is_written_without_a_shuffle(spark, months, monkeypatch):
    path, _ = months
    batch, gathered = spark.range(50).selectExpr("CAST(id AS INT) AS v", "'202601' AS m"), []
    made = sinks.balanced
    monkeypatch.setattr(sinks, "balanced", lambda df, *columns: gathered.append(columns) or made(df, *columns))
    replace_partitions(batch, path, "m")
    assert gathered == [("m",)]
    replace_partitions(batch, path, "m", only=["202601"])
    replace_partitions(batch, path, "m", already_split=True)
    assert gathered == [("m",)]


def test_store_keeps_rows_and_schema(spark):
    df = spark.range(5).withColumn("x", F.lit(None).cast("decimal(12,2)"))
    assert store(spark, df, "t").schema.simpleString() == df.schema.simpleString()


def test_held_frames_are_released(spark):
    df = spark.range(10)
    with held(df) as (kept,):
        assert kept.is_cached
    assert not df.is_cached


def test_transforms(spark):
    got = spark.createDataFrame([(7,), (-3,), (None,)], "x int").select(
        truncate_number(F.col("x"), 5).alias("t"), bucket(F.col("x"), 4).alias("b")
    ).collect()
    assert [r["t"] for r in got] == [5, -5, None]
    assert all(r["b"] in range(4) for r in got[:2]) and got[2]["b"] is None


# --- joins -------------------------------------------------------------------


def test_broadcast_only_when_estimated_small(spark):
    small = spark.range(100)
    assert 0 < estimated_bytes(small) < 10_000
    big = spark.range(1000)
    with_hint = big.join(broadcast_checked(small), "id")._jdf.queryExecution().toString()
    without = big.join(broadcast_checked(small, max_bytes=10), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "BroadcastHashJoin" in with_hint
    assert "strategy=broadcast" not in without


def test_null_safe_join(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, l string")
    right = spark.createDataFrame([(None, "x"), (2, "y")], "k int, r string")
    assert rows(join_null_safe(left, right, ["k"])) == [(None, "b", "x")]
    assert rows(join_null_safe(left, right, ["k"], "left")) == [(1, "a", None), (None, "b", "x")]


# --- mutation ----------------------------------------------------------------


def test_update_sees_old_values(spark):
    df = spark.createDataFrame([(1, 10, 5), (2, None, 7)], "id int, a int, b int")
    got = update(df, F.col("a") > 0, {"a": F.col("b"), "b": F.col("a")})
    assert rows(got) == [(1, 5, 10), (2, None, 7)]


def test_delete_keeps_null_predicate(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (3, 50)], "id int, a int")
    assert rows(delete(df, F.col("a") < 30)) == [(2, None), (3, 50)]


def test_merge(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    source = spark.createDataFrame([("B", 2), ("C", 3), ("N", None)], "v string, id int")
    assert rows(merge(target, source, ["id"])) == [
        (1, "a"), (2, "B"), (3, "C"), (None, "N"), (None, "n"),
    ]
    assert rows(merge_metrics(target, source, ["id"])) == [(1, 2, 0, 3)]


def test_merge_refuses_duplicate_keys(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y")], "id int, v string")
    with pytest.raises(DuplicateKeys):
        merge(target, source, ["id"])


# --- versions ----------------------------------------------------------------


def test_versions(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    two = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    table = versions.stamped(one, 0).unionByName(versions.stamped(two, 1))
    log = versions.commits(spark, [(0, 0, "2026-01-01", "WRITE"), (1, 1, "2026-01-02", "WRITE"), (2, 2, "2026-01-03", "DELETE")])
    assert rows(versions.as_of(table, log, 0)) == rows(one)
    assert rows(versions.as_of(table, log, moment="2026-01-01T12")) == rows(one)
    assert rows(versions.as_of(table, log, 1)) == rows(two)
    assert rows(versions.as_of(table, log)) == []  # the last commit emptied it
    changes = versions.diff(one, two, ["id"])
    assert rows(changes.select("id", "change")) == [(2, "changed"), (3, "added")]
    assert rows(versions.diff(two, one, ["id"]).select("id", "change")) == [(2, "changed"), (3, "removed")]
    back = versions.restored(log, 0, "2026-01-04")
    assert rows(versions.as_of(table, back)) == rows(one)
    assert [tuple(r) for r in versions.change_log(table, back).collect()] == [
        (0, "2026-01-01", "WRITE", 2), (1, "2026-01-02", "WRITE", 3), (2, "2026-01-03", "DELETE", 0), (3, "2026-01-04", "RESTORE", 2),
    ]
    with pytest.raises(ValueError):
        versions.as_of(table, log, moment="2025-01-01")


def test_commit_log_by_name_or_path(spark):
    path, log = new_path(spark, "log"), versions.commits(spark, [(2, 2, "c", "DELETE"), (0, 0, "a", "WRITE"), (1, 1, "b", "MERGE"), (1, 1, "b", "MERGE")])
    log.write.parquet(path)
    sinks.register_external(spark, "commit_log_test", path, versions.COMMITS)
    try:
        for kept in (versions.commit_log(spark, name="commit_log_test"), versions.commit_log(spark, path=path)):
            assert [r.version for r in versions.listed(kept, 3).collect()] == [0, 1, 1]
            assert rows(versions.summary(kept)) == [(0, 2, 3, "DELETE")]
    finally:
        spark.sql("DROP TABLE commit_log_test")
    for wrong in ({}, {"name": "a", "path": "b"}):
        with pytest.raises(ValueError, match="exactly one"):
            versions.commit_log(spark, **wrong)
    assert rows(versions.summary(versions.commits(spark, []))) == [(None, None, 0, None)]


def test_stored_tables_can_be_removed(spark):
    made = [store(spark, spark.range(n), "kept") for n in (3, 4)]
    assert [m.count() for m in made] == [3, 4]
    folder = made[0].inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert forget_stored(spark) >= 2 and forget_stored(spark) == 0
    assert folder.rsplit("/", 1)[1] not in subfolders(spark, folder.rsplit("/", 1)[0])


@pytest.mark.parametrize("key", [1, None])
def test_diff_refuses_a_key_held_twice(spark, key):
    twice = spark.createDataFrame([(key, "x"), (key, "y")], "id int, v string")
    once = spark.createDataFrame([(key, "y")], "id int, v string")
    for left, right in ((twice, once), (once, twice)):
        with pytest.raises(DuplicateKeys):
            versions.diff(left, right, ["id"])


def test_tables_changed_in_place_leave_other_partitions_alone(spark):
    path, schema = new_path(spark, "t"), "id int, v int, p string"
    start = spark.createDataFrame([(1, 10, "a"), (2, 20, "a"), (3, 30, "b"), (4, 40, "c"), (5, 50, None)], schema)
    replace_partitions(start, path, "p")

    def files_of(p):
        return {r[0] for r in spark.read.schema(schema).parquet(path).where(p).select("_metadata.file_name").collect()}

    def now():
        return rows(spark.read.schema(schema).parquet(path))

    untouched = files_of("p = 'c'")
    update_table(spark, path, start.schema, "p", F.col("id") == 1, {"v": F.lit(11)})
    merge_into(spark, path, start.schema, "p", spark.createDataFrame([(3, 33, "b"), (6, 60, "b")], schema), ["id"])
    assert now() == rows(spark.createDataFrame([(1, 11, "a"), (2, 20, "a"), (3, 33, "b"), (6, 60, "b"), (4, 40, "c"), (5, 50, None)], schema))
    delete_from(spark, path, start.schema, "p", (F.col("id") == 2) | (F.col("p") == "b") | F.col("p").isNull())
    assert now() == [(1, 11, "a"), (4, 40, "c")]
    assert files_of("p = 'c'") == untouched


def test_tables_changed_in_place_keep_the_rows_without_a_partition(spark):
    schema = "id int, v int, p string"
    start = spark.createDataFrame([(1, 10, "a"), (2, 20, None), (3, 30, None), (4, 40, "c")], schema)

    def changed(change):
        path = new_path(spark, "t")
        replace_partitions(start, path, "p")
        change(path)
        return rows(spark.read.schema(schema).parquet(path))

    def merged(*source):
        return changed(lambda path: merge_into(spark, path, start.schema, "p", spark.createDataFrame(source, schema), ["id"]))

    assert merged((2, 22, None), (5, 50, None)) == [(1, 10, "a"), (2, 22, None), (3, 30, None), (4, 40, "c"), (5, 50, None)]
    assert merged((2, 22, "")) == [(1, 10, "a"), (2, 22, None), (3, 30, None), (4, 40, "c")]
    updated = changed(lambda path: update_table(spark, path, start.schema, "p", F.col("id") <= 2, {"v": F.lit(0)}))
    assert updated == [(1, 0, "a"), (2, 0, None), (3, 30, None), (4, 40, "c")]
    left = changed(lambda path: delete_from(spark, path, start.schema, "p", F.col("id") == 2))
    assert left == [(1, 10, "a"), (3, 30, None), (4, 40, "c")]


def _table(spark, data, schema="id int, v int, p string"):
    path, start = new_path(spark, "t"), spark.createDataFrame(data, schema)
    replace_partitions(start, path, "p")
    return path, start.schema


def _now(spark, path, schema):
    return rows(spark.read.schema(schema).parquet(path))


# Values whose folder is not named like them, NULL among them.
ODD = ["a:b", "a/b", "a%b", "a b", "é", "x=y", "a?*[{", "+&#", "007", None]


def test_update_moves_rows_and_loses_none(spark):
    start = [(1, 10, "x"), (2, 20, "x"), (3, 30, "y"), (4, 40, "y"), (5, 50, "z"), (6, 60, None)]
    path, schema = _table(spark, start)
    update_table(spark, path, schema, "p", F.col("id") == 1, {"p": F.lit("y")})
    assert _now(spark, path, schema) == rows(spark.createDataFrame([(1, 10, "y"), *start[1:]], schema))
    # All rows leave z and the NULL partition, for one that is new and one that is there.
    update_table(spark, path, schema, "p", F.col("id") >= 5, {"p": F.when(F.col("id") == 5, "new").otherwise("x"), "v": F.col("v") + 1})
    wanted = [(1, 10, "y"), (2, 20, "x"), (3, 30, "y"), (4, 40, "y"), (5, 51, "new"), (6, 61, "x")]
    assert _now(spark, path, schema) == rows(spark.createDataFrame(wanted, schema))
    assert sorted(subfolders(spark, path)) == ["p=new", "p=x", "p=y"]
    # To NULL, spelt as the empty text.
    update_table(spark, path, schema, "p", F.col("p") == "y", {"p": F.lit("")})
    wanted = [(i, v, None if p == "y" else p) for i, v, p in wanted]
    assert _now(spark, path, schema) == rows(spark.createDataFrame(wanted, schema))


def test_update_swaps_two_partitions(spark):
    path, schema = _table(spark, [(1, 10, "x"), (2, 20, "y")])
    update_table(spark, path, schema, "p", F.lit(True), {"p": F.when(F.col("p") == "x", "y").otherwise("x")})
    assert _now(spark, path, schema) == [(1, 10, "y"), (2, 20, "x")]


def test_delete_removes_folders_whose_names_are_escaped(spark):
    start = [(i, i, p) for i, p in enumerate(ODD)] + [(100 + i, i, p) for i, p in enumerate(ODD)]
    for i, p in enumerate(ODD):
        path, schema = _table(spark, start)
        delete_from(spark, path, schema, "p", F.col("p").eqNullSafe(p))
        assert _now(spark, path, schema) == rows(spark.createDataFrame([r for r in start if r[2] != p], schema)), p
        assert len(subfolders(spark, path)) == len(ODD) - 1
        if i == 0:  # a row each, then all that is left
            delete_from(spark, path, schema, "p", F.col("id") < 100)
            assert _now(spark, path, schema) == rows(spark.createDataFrame([r for r in start[len(ODD):] if r[2] != p], schema))
            delete_from(spark, path, schema, "p", F.lit(True))
            assert _now(spark, path, schema) == [] and subfolders(spark, path) == []


def test_changes_in_partitions_with_escaped_names(spark):
    start = [(i, i, p) for i, p in enumerate(ODD)]
    path, schema = _table(spark, start)
    update_table(spark, path, schema, "p", F.lit(True), {"v": -F.col("v")})
    merge_into(spark, path, schema, "p", spark.createDataFrame([(50 + i, 1, p) for i, p in enumerate(ODD)], schema), ["id"])
    wanted = [(i, -i, p) for i, p in enumerate(ODD)] + [(50 + i, 1, p) for i, p in enumerate(ODD)]
    assert _now(spark, path, schema) == rows(spark.createDataFrame(wanted, schema))


def test_folders_spelt_otherwise_are_replaced(spark):
    path, _ = _table(spark, [(1, 10, "007"), (2, 20, "8")])
    schema = spark.createDataFrame([], "id int, v int, p int").schema
    update_table(spark, path, schema, "p", F.col("id") == 1, {"v": F.lit(11)})
    assert _now(spark, path, schema) == [(1, 11, 7), (2, 20, 8)]
    assert sorted(subfolders(spark, path)) == ["p=7", "p=8"]


def test_folders_of_one_value_spelt_twice_are_changed_together(spark):
    path, _ = _table(spark, [(1, 10, "007"), (2, 20, "7"), (3, 30, "8")])
    schema = spark.createDataFrame([], "id int, v int, p int").schema
    update_table(spark, path, schema, "p", F.col("id") == 1, {"v": F.lit(11)})
    assert _now(spark, path, schema) == [(1, 11, 7), (2, 20, 7), (3, 30, 8)]
    assert sorted(subfolders(spark, path)) == ["p=7", "p=8"]


def test_merge_updates_keys_in_whatever_partition_they_lie(spark):
    path, schema = _table(spark, [(1, 10, "x"), (2, 20, "x"), (3, 30, None), (4, 40, "z"), (None, 50, "w"), (6, 60, "u")])

    def files_of(p):
        return {r[0] for r in spark.read.schema(schema).parquet(path).where(p).select("_metadata.file_name").collect()}

    untouched = files_of("p IN ('w', 'u')")
    # 1 moves to a new partition, 3 leaves the NULL partition, 4 enters it; 2 stays where it is.
    source = [(1, 11, "y"), (3, 33, "x"), (4, 44, None), (5, 55, "y"), (None, 0, "y")]
    for _ in range(2):  # again: a MERGE that is repeated changes nothing, but NULL keys match nothing
        merge_into(spark, path, schema, "p", spark.createDataFrame(source, schema), ["id"])
        source = source[:-1]
    wanted = [(1, 11, "y"), (2, 20, "x"), (3, 33, "x"), (4, 44, None), (5, 55, "y"), (None, 0, "y"), (None, 50, "w"), (6, 60, "u")]
    assert _now(spark, path, schema) == rows(spark.createDataFrame(wanted, schema))
    assert "p=z" not in subfolders(spark, path) and files_of("p IN ('w', 'u')") == untouched
    merge_into(spark, path, schema, "p", spark.createDataFrame([], schema), ["id"])
    assert _now(spark, path, schema) == rows(spark.createDataFrame(wanted, schema))


def test_changes_that_hit_nothing_write_nothing(spark):
    path, schema = _table(spark, [(1, 10, "x"), (2, 20, "y")])
    files = {r[0] for r in spark.read.parquet(path).select("_metadata.file_name").collect()}
    update_table(spark, path, schema, "p", F.col("id") == 9, {"p": F.lit("y")})
    delete_from(spark, path, schema, "p", F.col("id") == 9)
    assert {r[0] for r in spark.read.parquet(path).select("_metadata.file_name").collect()} == files


# --- quality -----------------------------------------------------------------


def test_rules(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    seen = evaluate(
        df,
        [
            equal_to("rows", F.count(F.lit(1)), 3),
            at_most("nulls", F.count_if(F.col("x").isNull()), 0),
            at_least("sum", F.sum("x"), 4),
            at_least("nothing", F.max(F.lit(None).cast("int")), 0),
        ],
    )
    assert {r["rule"]: r["passed"] for r in seen.collect()} == {
        "rows": True, "nulls": False, "sum": True, "nothing": False,
    }
    with pytest.raises(QualityError, match="nulls: 1.0 against 0.0"):
        enforce(seen)
    enforce(seen.where("rule = 'rows'"))


def test_codes_with_many_labels(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "c")], "code int, label string")
    assert rows(codes_with_many_labels(df, "code", "label")) == [(2, 2)]


# --- streams -----------------------------------------------------------------


def test_triggers():
    assert streams.trigger("once") == streams.trigger("available") == {"availableNow": True}
    assert streams.trigger("interval", "30 seconds") == {"processingTime": "30 seconds"}


def test_upsert_stream_goes_on_where_it_stopped(spark):
    source, out, offsets = (new_path(spark, n) for n in ("in", "out", "offsets"))
    schema = "k INT"

    def feed(values):
        spark.createDataFrame([(v,) for v in values], schema).coalesce(1).write.mode("append").json(source)
        counts = streams.running_counts(streams.json_stream(spark, source, schema), "k")
        running = streams.upsert_tables(counts, ["k"], out, offsets)
        running.awaitTermination()
        return rows(streams.latest_upserts(spark, out))

    assert feed([1, 1, 2]) == [(1, 2), (2, 1)]
    assert feed([2, 3]) == [(1, 2), (2, 2), (3, 1)]
    # A restart that finds nothing new still has the last table, and old ones are gone.
    for _ in range(2):
        counts = streams.running_counts(streams.json_stream(spark, source, schema), "k")
        streams.upsert_tables(counts, ["k"], out, offsets).awaitTermination()
        assert rows(streams.latest_upserts(spark, out)) == [(1, 2), (2, 2), (3, 1)]
    assert feed([4]) == [(1, 2), (2, 2), (3, 1), (4, 1)]


def test_upsert_stream_writes_the_buckets_of_changed_keys_only(spark):
    source, out, offsets = (new_path(spark, n) for n in ("in", "out", "offsets"))

    def feed(values, buckets=8):
        spark.createDataFrame([(v,) for v in values], "k INT").coalesce(1).write.mode("append").json(source)
        counts = streams.running_counts(streams.json_stream(spark, source, "k INT"), "k")
        streams.upsert_tables(counts, ["k"], out, offsets, buckets=buckets).awaitTermination()
        seen.update(v for v in values)
        return rows(streams.latest_upserts(spark, out))

    def files():
        return {p for b, p in streams._newest_buckets(spark, out).items()}

    seen = Counter()
    everything = [*range(40), None, None]
    assert feed(everything) == sorted(seen.items(), key=str)
    before = files()
    assert len(before) == 8
    for batch in ([7, 7], [None], [100]):  # a key that is there, one that is NULL, a new one
        assert feed(batch) == sorted(seen.items(), key=str)
        assert len(files() - before) == 1  # one bucket was written again
        before = files()
    # Folders that were replaced are gone, but for those that the last batch started from.
    everywhere = [f for b in streams._finished(spark, out) for f in streams._bucket_numbers(spark, out, b)]
    assert len(everywhere) <= 9


def test_upsert_batch_that_is_repeated_gives_the_same(spark):
    out = new_path(spark, "out")
    write = []
    stream = spark.readStream.format("rate").load()
    made, streams._start = streams._start, lambda s, mode, fn, *a: write.append(fn)
    try:
        streams.upsert_tables(stream, ["k"], out, "unused", buckets=4)
    finally:
        streams._start = made
    schema = "k int, count bigint"
    for batch, data in enumerate(([(1, 1), (2, 1)], [(2, 5), (None, 1)], [(None, 2)])):
        for _ in range(3 if batch else 1):
            write[0](spark.createDataFrame(data, schema), batch)
    assert rows(streams.latest_upserts(spark, out)) == [(1, 1), (2, 5), (None, 2)]


def test_complete_stream_keeps_two_tables(spark):
    source, out, offsets = (new_path(spark, n) for n in ("in", "out", "offsets"))
    for values in ([1], [1, 2], [2], [3]):
        spark.createDataFrame([(v,) for v in values], "k INT").coalesce(1).write.mode("append").json(source)
        counts = streams.running_counts(streams.json_stream(spark, source, "k INT"), "k")
        streams.complete_tables(counts, out, offsets).awaitTermination()
    assert rows(streams.latest_table(spark, out)) == [(1, 2), (2, 2), (3, 1)]
    assert len(folders_in(spark, out)) == 2
