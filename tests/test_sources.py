"""File discovery, header contract, lineage, versioned store."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from snapmart.sources import files
from snapmart.sources.lake import VersionedTable

HEADER = ",".join(files.REQUIRED_COLUMNS)


def _row(name, value="10", metric="oil_production", url="https://x.example/a", licence="L"):
    return (f'"{name}",2025,{metric},{value},m3,1.5,-2.0,Source,{url},2026-04-09,'
            f"{licence},2026-07-24")


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_discovery_is_recursive_and_sorted(spark, workdir):
    _write(f"{workdir}/b.csv", ["x", "1"])
    _write(f"{workdir}/nested/a.csv", ["x", "2"])
    _write(f"{workdir}/nested/skip.txt", ["x"])
    found = files.discover_files(spark, workdir)
    assert [os.path.basename(p) for p in found] == ["b.csv", "a.csv"]


def test_discovery_of_missing_or_empty_directory(spark, workdir):
    assert files.discover_files(spark, f"{workdir}/absent") == []
    os.makedirs(f"{workdir}/empty")
    assert files.discover_files(spark, f"{workdir}/empty") == []
    assert files.list_files(spark, f"{workdir}/absent").count() == 0
    with pytest.raises(FileNotFoundError, match="nothing to read"):
        files.read_raw_csv(spark, [], label="source")


def test_missing_columns_are_listed_sorted(spark, workdir):
    _write(f"{workdir}/oil.csv", ["municipality,year,metric", "A,2025,oil_production"])
    with pytest.raises(ValueError, match=r"lacks required column\(s\) \['five_year_change_pct', 'licence'"):
        files.read_raw_csv(spark, [f"{workdir}/oil.csv"], label="oil.csv")


def test_reordered_header_in_a_later_file_fails(spark, workdir):
    _write(f"{workdir}/a.csv", [HEADER, _row("A")])
    cols = list(files.REQUIRED_COLUMNS)
    cols[0], cols[1] = cols[1], cols[0]
    _write(f"{workdir}/b.csv", [",".join(cols), "2025,B,oil_production,1,m3,,,S,https://x,"
                                                "2026-04-09,L,2026-07-24"])
    df = files.read_raw_csv(spark, [f"{workdir}/a.csv", f"{workdir}/b.csv"])
    with pytest.raises(Exception):
        df.collect()


def test_na_tokens_become_null_and_lineage(spark, workdir):
    _write(f"{workdir}/oil.csv", [HEADER, _row("A", value="NA"), _row("Taber, M.D.")])
    raw = files.read_raw_csv(spark, [f"{workdir}/oil.csv"])
    bronze = files.stamp_lineage(raw)
    rows = {r.municipality: r for r in bronze.collect()}
    assert rows["A"].value is None
    assert rows["Taber, M.D."].value == "10"
    assert rows["A"].source_file == "oil.csv"
    assert len(rows["A"].record_hash) == 64
    assert bronze.schema["ingested_at_utc"].dataType.typeName() == "timestamp"


def test_metric_domain(spark, workdir):
    _write(f"{workdir}/ok.csv", [HEADER, _row("A"), _row("B")])
    _write(f"{workdir}/bad.csv", [HEADER, _row("A"), _row("B", metric="well_count")])
    _write(f"{workdir}/nulls.csv", [HEADER, _row("A", metric="")])
    ok = files.load_bronze(spark, [files.SnapshotSource("oil", (f"{workdir}/ok.csv",),
                                                        "oil_production")])
    assert ok.count() == 2
    for name in ("bad", "nulls"):
        with pytest.raises(files.MetricDomainError, match="holds values other than"):
            files.load_bronze(spark, [files.SnapshotSource(
                name, (f"{workdir}/{name}.csv",), "oil_production")])


def test_versioned_table_commit_and_upsert(spark, workdir):
    table = VersionedTable(spark, f"{workdir}/lake")
    assert not table.exists()
    v1 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert table.upsert(v1, ["k"]) == 1
    src = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert table.upsert(src, ["k"]) == 2
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "a"), (2, "B"), (3, "c")]
    assert sorted(tuple(r) for r in table.read(1).collect()) == [(1, "a"), (2, "b")]
    assert table.current_version() == 2


def test_versioned_table_rejects_duplicate_first_load(spark, workdir):
    from snapmart.operators.upsert import DuplicateSourceKeyError

    table = VersionedTable(spark, f"{workdir}/lake")
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(DuplicateSourceKeyError):
        table.upsert(dup, ["k"])
    assert not table.exists()


def test_metric_extract_sink_is_one_partitioned_write(spark, workdir):
    from snapmart.sources.sinks import write_metric_extracts

    fact = spark.createDataFrame([("a", "oil", 1.0), ("b", "gas", 2.0)],
                                 "entity string, metric string, value double")
    write_metric_extracts(fact, f"{workdir}/extracts")
    assert sorted(d for d in os.listdir(f"{workdir}/extracts") if d.startswith("metric=")) == [
        "metric=gas", "metric=oil"]
    back = spark.read.option("header", True).csv(f"{workdir}/extracts")
    assert back.filter(F.col("metric") == "oil").count() == 1


def test_partitioned_upsert_and_schema_evolution(spark, workdir):
    table = VersionedTable(spark, f"{workdir}/lake", partition_by=["p"])
    schema = "p string, k int, v string"
    table.upsert(spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z"), ("c d/e", 4, "w")], schema), ["p", "k"])
    table.upsert(spark.createDataFrame([("a", 2, "Y"), ("a", 5, "n")], schema), ["p", "k"])
    assert _rows(table.read()) == [("a", 1, "x"), ("a", 2, "Y"), ("a", 5, "n"), ("b", 3, "z"),
                                   ("c d/e", 4, "w")]
    assert _rows(table.read(1)) == [("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z"), ("c d/e", 4, "w")]
    table.upsert(spark.createDataFrame([("e", 9, "q", 1.5)], schema + ", extra double"),
                 ["p", "k"])
    got = {r.k: r for r in table.read().collect()}
    assert got[9].extra == 1.5 and got[1].extra is None and len(got) == 6


def test_a_root_with_pattern_signs_keeps_every_row(spark, workdir):
    table = VersionedTable(spark, f"{workdir}/t[1]")
    assert table.write(spark.range(5).selectExpr("cast(id as int) k", "'x' v")) == 1
    assert table.upsert(spark.createDataFrame([(4, "y"), (9, "z")], "k int, v string"), ["k"]) == 2
    assert table.exists() and table.read().count() == 6
    assert VersionedTable(spark, f"{workdir}/t1").exists() is False


def test_an_unreadable_pointer_is_an_error(spark, workdir, monkeypatch):
    from pyspark.errors import AnalysisException

    import snapmart.sources.lake as lake

    table = VersionedTable(spark, f"{workdir}/lake")
    table.write(spark.range(3).selectExpr("id k"))
    monkeypatch.setattr(lake, "is_missing_path", lambda exc: False)
    with pytest.raises(AnalysisException):
        VersionedTable(spark, f"{workdir}/absent").exists()


def test_upsert_widens_a_changed_type(spark, workdir):
    table = VersionedTable(spark, f"{workdir}/lake")
    table.upsert(spark.createDataFrame([(1, 5), (2, 6)], "k int, v int"), ["k"])
    table.upsert(spark.createDataFrame([(1, 5.75)], "k long, v double"), ["k"])
    assert _rows(table.read()) == [(1, 5.75), (2, 6.0)]


def test_csv_round_trip_keeps_quotes_commas_and_blanks(spark, workdir):
    from snapmart.sources.sinks import write_csv

    texts = ['say "hi", ok', '"quoted" ok', " pad ", "a,b", 'tail"', "\\back\\"]
    write_csv(spark.createDataFrame([(t, str(i)) for i, t in enumerate(texts)], "x string, n string"), f"{workdir}/out")
    back = files.read_raw_csv(spark, [f"{workdir}/out"], required=["x", "n"])
    assert [r.x for r in back.orderBy("n").collect()] == texts


def test_csv_cells_with_line_breaks(spark, workdir):
    with open(f"{workdir}/m.csv", "w") as out:
        out.write('x,n\n"one\ntwo",1\n"say ""hi"" ok",2\n')
    back = files.read_raw_csv(spark, [f"{workdir}/m.csv"], required=["x", "n"], multi_line=True)
    assert [r.x for r in back.orderBy("n").collect()] == ["one\ntwo", 'say "hi" ok']


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_discovered_paths_with_spaces_are_readable(spark, workdir):
    _write(f"{workdir}/in dir/my file.csv", [HEADER, _row("A")])
    paths = files.discover_files(spark, workdir)
    assert files.read_raw_csv(spark, paths).count() == 1


def test_key_bucket_partitioned_upsert_touches_few_buckets(spark, workdir):
    from snapmart.operators.upsert import key_bucket

    table = VersionedTable(spark, f"{workdir}/bucketed", partition_by=["bucket"])
    base = spark.range(200).selectExpr("cast(id as int) k", "'x' v")
    table.upsert(base.withColumn("bucket", key_bucket(["k"], 16)), ["bucket", "k"])
    batch = spark.createDataFrame([(3, "y"), (500, "z")], "k int, v string")
    table.upsert(batch.withColumn("bucket", key_bucket(["k"], 16)), ["bucket", "k"])
    got = {r.k: r.v for r in table.read().collect()}
    assert len(got) == 201 and got[3] == "y" and got[500] == "z" and got[4] == "x"
    touched = {r.b for r in batch.select(key_bucket(["k"], 16).alias("b")).collect()}
    first, second = (sorted(d for d in os.listdir(workdir + "/bucketed") if d.startswith("table_version=")))
    written = {int(d.removeprefix("bucket=")) for d in os.listdir(f"{workdir}/bucketed/{second}") if d.startswith("bucket=")}
    assert written == touched and len(touched) <= 2
    # untouched buckets are still read from the first version's files
    files_of = {(r.bucket, os.path.basename(os.path.dirname(os.path.dirname(r.f)))) for r in table.read().select(
        "bucket", F.input_file_name().alias("f")).distinct().collect()}
    assert files_of == {(b, second if b in touched else first) for b in range(16)}


def test_partition_scoped_versions(spark, workdir):
    """Null and odd partition values, two partition columns, old versions, a whole write between, an empty batch."""
    table = VersionedTable(spark, f"{workdir}/t", partition_by=["p", "q"])
    schema, keys = "p string, q int, k int, v string", ["p", "q", "k"]

    def put(*rows):
        return table.upsert(spark.createDataFrame(list(rows), schema), keys)

    put(("a", 1, 1, "x"), ("a", 2, 1, "x"), ("b", 1, 1, "x"), ("a b/c", 1, 1, "x"))
    put(("a", 1, 1, "y"), ("a", 1, 2, "new"))
    put(("a b/c", 1, 1, "z"), ("c", 3, 1, "c"))
    put()
    assert _rows(table.read()) == sorted([
        ("a", 1, 1, "y"), ("a", 1, 2, "new"), ("a", 2, 1, "x"), ("b", 1, 1, "x"), ("a b/c", 1, 1, "z"), ("c", 3, 1, "c")])
    assert _rows(table.read(2)) == sorted([
        ("a", 1, 1, "y"), ("a", 1, 2, "new"), ("a", 2, 1, "x"), ("b", 1, 1, "x"), ("a b/c", 1, 1, "x")])
    assert table.current_version() == 4
    table.write(spark.createDataFrame([("d", 1, 1, "only")], schema))
    put(("e", 1, 1, "e"))
    assert _rows(table.read()) == [("d", 1, 1, "only"), ("e", 1, 1, "e")]
    # a null partition value never matches as a key, and is kept
    null = VersionedTable(spark, f"{workdir}/n", partition_by=["p"])
    for rows in ([(None, 1, "x"), ("a", 1, "x")], [(None, 1, "y")], [("a", 1, "z")]):
        null.upsert(spark.createDataFrame(rows, "p string, k int, v string"), ["p", "k"])
    got = sorted(map(str, null.read().collect()))
    assert got == sorted(map(str, [null.read().first().__class__(p=p, k=1, v=v) for p, v in ((None, "x"), (None, "y"), ("a", "z"))]))


def test_a_first_load_runs_its_source_once(spark, workdir):
    """Rows are drawn anew whenever the source's plan runs: the count of those drawn tells how often it did."""
    drawn = spark.sparkContext.accumulator(0)

    def draw(i):
        drawn.add(1)
        return (i, "a" if i % 2 else "b")

    source = spark.createDataFrame(spark.sparkContext.range(0, 300, numSlices=3).map(draw), "k int, p string")
    table = VersionedTable(spark, f"{workdir}/once", partition_by=["p"])
    table.upsert(source, ["p", "k"])
    assert drawn.value == 300 and table.last_rows_written == 300 and table.read().count() == 300


def test_a_first_load_rejects_keys_that_partition_names_hide(spark, workdir):
    from snapmart.operators.upsert import DuplicateSourceKeyError

    table = VersionedTable(spark, f"{workdir}/t", partition_by=["p"])
    schema = "p string, k int"
    with pytest.raises(DuplicateSourceKeyError):
        table.upsert(spark.createDataFrame([("", 1), ("", 1)], schema), ["p", "k"])
    assert not table.exists()
    table.upsert(spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], schema), ["p", "k"])
    assert table.read().count() == 3


def test_keys_that_a_table_repeats_are_all_updated(spark, workdir):
    table = VersionedTable(spark, f"{workdir}/t", partition_by=["p"])
    schema = "p string, k int, v string"
    table.write(spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 1, "w")], schema))
    table.upsert(spark.createDataFrame([("a", 1, "new"), ("a", 3, "n")], schema), ["p", "k"])
    assert _rows(table.read()) == [("a", 1, "new"), ("a", 1, "new"), ("a", 2, "z"), ("a", 3, "n"), ("b", 1, "w")]


def test_a_changed_type_rewrites_every_partition(spark, workdir):
    table = VersionedTable(spark, f"{workdir}/t", partition_by=["p"])
    table.upsert(spark.createDataFrame([("a", 1, 5), ("b", 1, 6)], "p string, k int, v int"), ["p", "k"])
    table.upsert(spark.createDataFrame([("a", 1, 5.75)], "p string, k int, v double"), ["p", "k"])
    assert _rows(table.read()) == [("a", 1, 5.75), ("b", 1, 6.0)]


def test_the_listing_is_a_table(spark, workdir):
    _write(f"{workdir}/b b.csv", ["x", "1"])
    _write(f"{workdir}/nested/a+%.csv", ["x", "22"])
    rows = files.list_files(spark, workdir).orderBy("length").collect()
    assert [os.path.basename(r.path) for r in rows] == ["b b.csv", "a+%.csv"] and [r.length for r in rows] == [4, 5]
    raw = files.read_raw_csv(spark, [workdir], required=["x"])
    assert {r.source_path for r in raw.collect()} == {r.path for r in rows}


def test_files_of_one_name_are_ordered_by_their_folder(spark, workdir):
    from snapmart.operators.standardize import standardize

    for folder, value in (("a", "1"), ("b", "2")):
        _write(f"{workdir}/{folder}/part-0.csv", [HEADER, _row("X", value=value)])
    raw = files.read_raw_csv(spark, [workdir])
    silver = standardize(files.stamp_lineage(raw)).collect()
    assert [(r.value, r.source_file) for r in silver] == [(2.0, "part-0.csv")]


def test_staged_bronze_parses_every_file_once(spark, workdir):
    """One job for each header, one that parses and writes; the check of the metric reads nothing again."""
    sources = []
    for name in ("oil", "gas"):
        _write(f"{workdir}/{name}.csv", [HEADER, _row("A"), _row("B")])
        sources.append(files.SnapshotSource(name, (f"{workdir}/{name}.csv",), "oil_production"))
    sc = spark.sparkContext
    sc.setJobGroup("stage-bronze", "")
    try:
        bronze = files.stage_bronze(spark, sources, f"{workdir}/bronze")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("stage-bronze")) == 3
    assert bronze.groupBy("dataset").count().count() == 2 and "FileScan csv" not in bronze._jdf.queryExecution().toString()
    _write(f"{workdir}/bad.csv", [HEADER, _row("A"), _row("B", metric="well_count")])
    _write(f"{workdir}/none.csv", [HEADER])
    for name in ("bad", "none"):
        with pytest.raises(files.MetricDomainError, match="holds values other than"):
            files.stage_bronze(spark, [*sources, files.SnapshotSource(name, (f"{workdir}/{name}.csv",), "oil_production")], f"{workdir}/again-{name}")


def test_stage_bucketed_keeps_rows_and_splits_a_hot_key(spark, workdir):
    from pyspark.sql import functions as F

    from snapmart.sources.sinks import stage_bucketed

    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 2).alias("part"), F.col("id").alias("v"))
    for _ in range(2):  # a second run into the same folder replaces the first
        out = stage_bucketed(df, "bucket-test", "k", buckets=5, path=f"{workdir}/t", partition_by=["part"], sort_within=["v"])
    assert out.columns == df.columns
    assert sorted(out.collect(), key=lambda r: r["v"]) == sorted(df.collect(), key=lambda r: r["v"])
    assert spark.read.parquet(f"{workdir}/t").count() == 3000
    empty = stage_bucketed(df.limit(0), "bucket-empty", "k", buckets=5, partition_by=["part"])
    assert empty.count() == 0 and empty.columns == df.columns


def test_tables_over_scratch_folders_are_dropped(spark, workdir):
    from snapmart import session
    from snapmart.sources.sinks import stage_bucketed

    df = spark.range(10).withColumnRenamed("id", "k")
    kept = stage_bucketed(df, "own", "k", buckets=2, path=f"{workdir}/own")
    before = {t.name for t in spark.catalog.listTables()}
    with session.scratch_run():
        assert stage_bucketed(df, "gone", "k", buckets=2).count() == 10
        assert len({t.name for t in spark.catalog.listTables()} - before) == 1
    assert {t.name for t in spark.catalog.listTables()} == before
    assert kept.count() == 10


def test_lake_layers_are_deduplicated_once_and_written_in_zstd(spark, workdir, monkeypatch):
    from snapmart.plans import medallion
    from tests.conftest import SF_SMALL

    passed = spark.sparkContext.accumulator(0)
    made = medallion.lake_silver

    def counted(stored, keys):
        def count(batches):
            for batch in batches:
                passed.add(batch.num_rows)
                yield batch

        silver = made(stored, keys)
        return silver.mapInArrow(count, silver.schema)

    monkeypatch.setattr(medallion, "lake_silver", counted)
    result = medallion.lake_run(spark, SF_SMALL, f"{workdir}/lake")
    assert passed.value == result["silver_rows"] == spark.read.parquet(result["export"]).count() > 0
    for layer in ("landed", "bronze", "silver", "silver_export"):
        names = [f for _, _, files in os.walk(f"{workdir}/lake/{layer}") for f in files if f.endswith(".parquet")]
        assert names and all(f.endswith(".zstd.parquet") for f in names)
