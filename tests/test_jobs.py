"""Jobs end to end, gates, publication and layers."""

import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from strata.operators import columns, geometry, quality
from strata.operators.quality import GateError
from strata.plans import jobs
from strata.session import ship
from strata.sources import scan, sinks
from strata.spec import FeatureSpec, lab_catalogue
from test_geometry import FAR, SQUARE, polygon
from workload import inputs


def spec(survey=("objectid", "duplicata", "data_de_analise")):
    import dataclasses
    return dataclasses.replace(lab_catalogue()["solo"], survey_columns=survey,
                               excluded=("lote", "longitude", "latitude"))


def samples(spark, **change):
    rows = [(1, -45.5, -10.0, "01/02/2020", "sim", "L1", "5,3", "<1"), (2, None, -11.0, "x", None, "L1", "IS", "-2"),
            (3, -44.0, -12.0, None, "1", "L2", "", None)]
    df = spark.createDataFrame(rows, "objectid long, longitude double, latitude double, data_de_analise string, "
                                     "duplicata string, lote string, `Au (ppb)` string, `Cu ppm` string")
    return df.withColumns(change)


def test_lab_run(spark, tmp_path):
    paths = jobs.run_lab(samples(spark), spec(), str(tmp_path))
    assert list(paths) == ["solo_amostras", "solo_analises_quimicas", "solo_pivot_join"]
    gold = f"{tmp_path}/analise_quimica_solo/gold"
    assert os.path.relpath(paths["solo_pivot_join"], gold).split("/")[1:] == ["public", "solo_pivot_join"]
    assert sinks.current_tables(spark, gold) == {**paths, "survey": paths["solo_amostras"], "assay": paths["solo_analises_quimicas"]}
    survey, assay = sinks.published(spark, gold)
    assert survey.exceptAll(spark.read.parquet(paths["solo_amostras"])).isEmpty()  # identity views are the pair itself
    assert assay.exceptAll(spark.read.parquet(paths["solo_analises_quimicas"])).isEmpty()
    joined = spark.read.parquet(paths["solo_pivot_join"]).orderBy("objectid").collect()
    assert [(r.objectid, r.duplicata, r.au_ppb, r.cu_ppm) for r in joined] == [
        (1, True, 5.3, 1.0), (2, False, 0.0, 2.0), (3, True, None, None)]
    assert joined[0].geometry.asDict() == {"x": -45.5, "y": -10.0, "srid": 4674} and joined[1].geometry is None
    assert joined[0].data_de_analise.isoformat() == "2020-02-01T00:00:00" and joined[1].data_de_analise is None


def test_publication_is_versioned(spark, tmp_path):
    root = str(tmp_path)
    a, b = spark.range(3).toDF("objectid"), spark.range(5).toDF("amostra")
    with pytest.raises(FileNotFoundError):
        sinks.published(spark, root)
    assert sinks.replace_survey_and_assay(a, b, root) == 1
    old = sinks.published(spark, root)
    assert sinks.replace_survey_and_assay(a.limit(1), b.limit(2), root) == 2
    assert [d.count() for d in sinks.published(spark, root)] == [1, 2]
    assert [d.count() for d in old] == [3, 5]  # a reader of the old pair is not disturbed


def test_failed_write_publishes_nothing(spark, tmp_path):
    root = str(tmp_path)
    sinks.replace_survey_and_assay(spark.range(3).toDF("objectid"), spark.range(5).toDF("amostra"), root)
    broken = spark.range(2).select(F.raise_error(F.lit("lost")).cast("long").alias("amostra"))
    with pytest.raises(Exception, match="lost"):
        sinks.replace_survey_and_assay(spark.range(1).toDF("objectid"), broken, root)
    assert [d.count() for d in sinks.published(spark, root)] == [3, 5]


def test_gates_stop_the_job(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(GateError, match="empty table"):
        jobs.run_bronze(samples(spark).where("false"), spec(), root)
    with pytest.raises(GateError, match="repeated key"):
        jobs.run_bronze(samples(spark, objectid=F.lit(7)), spec(), root)
    bad = samples(spark, **{"Au (ppb)": F.lit("abc")})
    bronze = scan.read_layer_parquet(spark, jobs.run_bronze(bad, spec(), root))
    with pytest.raises(GateError, match="bad_value"):
        jobs.run_assay(bronze, spec(), root)
    with pytest.raises(GateError, match="missing_geometry"):
        jobs.run_survey(bronze, spec(), root, require_geometry=True)


def test_broken_runs_leave_the_good_layer(spark, tmp_path):
    root, job = str(tmp_path), spec()
    good = jobs.run_bronze(samples(spark), job, root)
    for broken in (samples(spark).where("false"), samples(spark, objectid=F.lit(7)),
                   samples(spark, objectid=F.lit(None).cast("long"))):
        with pytest.raises(GateError):
            jobs.run_bronze(broken, job, root)
        assert spark.read.parquet(good).count() == 3
        assert sinks.current_layer(spark, root, f"{job.name}/bronze", f"{job.source}.parquet").count() == 3
    jobs.run_bronze(samples(spark).limit(2), job, root)
    assert sinks.current_layer(spark, root, f"{job.name}/bronze", f"{job.source}.parquet").count() == 2
    with pytest.raises(FileNotFoundError):
        sinks.current_layer(spark, root, "none", "x")


def test_two_publishers_get_two_versions(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        for r in range(3):
            got = list(pool.map(lambda k: sinks.publish_pair(spark, f"s{k}", f"a{k}", f"{tmp_path}/{r}"), range(8)))
            assert sorted(got) == list(range(1, 9))


#: A store that never sees what others have written, but creates a file only once.
LYING_STORE = """
import java.io.*; import java.nio.file.*; import org.apache.hadoop.fs.*; import org.apache.hadoop.fs.Path;
public class LyingStore extends RawLocalFileSystem {
  public java.net.URI getUri() { return java.net.URI.create("lying:///"); }
  public boolean exists(Path f) { return false; }
  public FSDataOutputStream create(Path f, org.apache.hadoop.fs.permission.FsPermission p, boolean overwrite, int buffer, short copies,
                                   long block, org.apache.hadoop.util.Progressable progress) throws IOException {
    File file = pathToFile(f);
    file.getParentFile().mkdirs();
    OpenOption[] how = overwrite ? new OpenOption[] {StandardOpenOption.CREATE, StandardOpenOption.WRITE}
                                 : new OpenOption[] {StandardOpenOption.CREATE_NEW, StandardOpenOption.WRITE};
    return new FSDataOutputStream(Files.newOutputStream(file.toPath(), how), null);
  }
}
"""


@pytest.fixture
def lying(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.getClassLoader()
    compiler = spark.sparkContext._jvm.org.codehaus.janino.SimpleCompiler()
    compiler.setParentClassLoader(before)
    compiler.cook(LYING_STORE)
    conf.setClassLoader(compiler.getClassLoader())
    conf.set("fs.lying.impl", "LyingStore")
    yield "lying://"
    conf.setClassLoader(before)


@pytest.mark.parametrize("store", ["file", "lying"])
def test_a_version_is_claimed_once(spark, tmp_path, lying, store):
    """Eight writers, fifty versions, each claimed by exactly one, also where a look before creating would say nothing is there."""
    base = f"{tmp_path}/claims" if store == "file" else f"{lying}{tmp_path}/claims"
    with ThreadPoolExecutor(8) as pool:
        for version in range(50):
            won = list(pool.map(lambda k: sinks._claim(spark, f"{base}/{version}", f"writer-{k}"), range(8)))
            assert sum(won) == 1
            assert open(f"{tmp_path}/claims/{version}").read() == f"writer-{won.index(True)}"


def test_a_store_that_cannot_write_is_no_rival(spark, tmp_path, lying):
    (tmp_path / "flat").write_text("a file where the folder should be")
    with pytest.raises(Exception, match="flat"):
        sinks._claim(spark, f"{lying}{tmp_path}/flat/1", "writer")


def test_pair_and_views_change_together(spark, tmp_path):
    """A reader in a loop during twenty publications finds every name, whole and never older than before."""
    root, names = str(tmp_path), ["pair_samples", "pair_values", "pair_joined"]
    spark.sql("CREATE DATABASE IF NOT EXISTS lab_pairs")

    def publish(k):
        paths = {}
        for n, rows in zip(names, (2, 3, 4), strict=True):
            paths[n] = sinks.write_checked(spark.range(rows).select(F.lit(k).alias("mark"), "id"), f"{root}/data-{k}/{n}")
        sinks.publish_pair(spark, paths[names[0]], paths[names[1]], root, **paths)
        return sinks.point_catalog(spark, root, "lab_pairs", names)

    publish(0)
    seen, stop, read = [], threading.Event(), threading.Event()

    def reader():
        last = [0, 0, 0]
        while not stop.is_set():
            tables = sinks.current_tables(spark, root)
            marks = {spark.read.parquet(tables[n]).first().mark for n in [*names, "survey", "assay"]}
            assert len(marks) == 1, marks  # one manifest row: all of one version
            for i, (n, rows) in enumerate(zip(names, (2, 3, 4), strict=True)):
                got = spark.table(f"lab_pairs.{n}").collect()
                assert len(got) == rows and len({r.mark for r in got}) == 1 and got[0].mark >= last[i]
                last[i] = got[0].mark
            seen.append(last[0])
            read.set()

    with ThreadPoolExecutor(1) as pool:
        watch = pool.submit(reader)
        try:
            for k in range(1, 21):
                assert publish(k) == k + 1
            read.wait(30)
        finally:
            stop.set()
        watch.result()
    assert len(seen) > 1
    assert sinks.table_statistics(spark, "lab_pairs.pair_joined").first().num_rows == 4
    gone = sinks.retire(spark, f"{root}/manifest", keep=1, schema="lab_pairs")
    assert len(gone) == 60 and not any(os.path.exists(p) for p in gone)
    assert {t.name for t in spark.catalog.listTables("lab_pairs")} >= {f"{n}__v21" for n in names}
    assert not spark.catalog.tableExists("lab_pairs.pair_joined__v20") and spark.table("lab_pairs.pair_joined").count() == 4
    for n in names:
        spark.sql(f"DROP VIEW lab_pairs.{n}")
        spark.sql(f"DROP TABLE lab_pairs.{n}__v21")


def test_a_managed_table_is_refused_not_dropped(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS lab_pairs")
    spark.sql("DROP TABLE IF EXISTS lab_pairs.kept")
    spark.range(7).write.saveAsTable("lab_pairs.kept")
    path = sinks.write_checked(spark.range(1), f"{tmp_path}/data")
    sinks.hand_over(spark, f"{tmp_path}/manifest", {"kept": path})
    with pytest.raises(ValueError, match="is a table"):
        sinks.point_catalog(spark, str(tmp_path), "lab_pairs", ["kept"])
    assert spark.table("lab_pairs.kept").count() == 7
    spark.sql("DROP TABLE lab_pairs.kept")
    spark.sql("DROP TABLE lab_pairs.kept__v1")


def test_a_failing_view_leaves_the_published_version(spark, tmp_path):
    paths = jobs.run_lab(samples(spark), spec(), str(tmp_path))
    gold = f"{tmp_path}/analise_quimica_solo/gold"
    broken = spark.range(2).select(F.raise_error(F.lit("lost")).cast("long").alias("objectid"))
    with pytest.raises(Exception, match="lost"):
        jobs.publish(spark, paths["solo_amostras"], paths["solo_analises_quimicas"], spec(), [], gold, broken)
    assert sinks.current_tables(spark, gold)["solo_pivot_join"] == paths["solo_pivot_join"]
    assert spark.read.parquet(paths["solo_pivot_join"]).count() == 3


def test_old_versions_are_retired(spark, tmp_path):
    paths = [sinks.write_layer(spark.range(k + 1), str(tmp_path), "a", "b") for k in range(4)]
    assert sinks.retire(spark, f"{tmp_path}/a/b/manifest", keep=2) == sorted(paths[:2])
    assert [os.path.exists(p) for p in paths] == [False, False, True, True]
    assert sinks.current_layer(spark, str(tmp_path), "a", "b").count() == 4


def test_catalogue_runs_from_its_target_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS lab_targets")
    specs = lab_catalogue("raw")
    source = samples(spark)
    chem, count, weight = source, source.drop("Au (ppb)", "Cu ppm").withColumn("ouro_1_mm", F.lit("3")), \
        source.drop("Au (ppb)", "Cu ppm").withColumn("zircao", F.lit("1,5"))
    sources = {n: {"chem": chem, "count": count, "weight": weight}[s.kind] for n, s in specs.items()}
    targets = {}
    for n in specs:
        targets[n] = f"lab_targets.{n}_amostras"
        spark.sql(f"DROP TABLE IF EXISTS {targets[n]}")
        empty = spark.createDataFrame([], "objectid long, data_de_analise timestamp_ntz, duplicata boolean, longitude double, latitude double")
        sinks.clone_schema(empty, targets[n], path=f"{tmp_path}/targets/{n}")
    done = jobs.run_catalogue(sources, specs, str(tmp_path / "run"), targets)
    assert set(done) == set(specs) and len(done) == 9
    for n, paths in done.items():
        assert spark.read.parquet(list(paths.values())[1]).count() == {"chem": 4, "count": 3, "weight": 3}[specs[n].kind]
    with pytest.raises(ValueError, match="no survey columns"):
        jobs.run_lab(chem, specs["solo"], str(tmp_path / "none"))


def test_published_tables_have_statistics(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS lab_gold")
    jobs.run_lab(samples(spark), spec(), str(tmp_path), schema="lab_gold")
    assert {n: sinks.table_statistics(spark, f"lab_gold.{n}").first().num_rows
            for n in ("solo_amostras", "solo_analises_quimicas", "solo_pivot_join")} == {
        "solo_amostras": 3, "solo_analises_quimicas": 4, "solo_pivot_join": 3}
    for n in ("solo_amostras", "solo_analises_quimicas", "solo_pivot_join"):
        spark.sql(f"DROP VIEW lab_gold.{n}")
        spark.sql(f"DROP TABLE lab_gold.{n}__v1")


def test_reload_keeps_every_file_as_its_own_table(spark, tmp_path):
    os.makedirs(tmp_path / "d")
    spark.createDataFrame([(1, "a\x00", 2)], "fid long, a string, only_a int").toPandas().to_parquet(tmp_path / "d" / "pre_one.parquet")
    spark.createDataFrame([(1, "b"), (2, "c")], "fid long, only_b string").toPandas().to_parquet(tmp_path / "d" / "pre_two.parquet")
    out = jobs.reload_dir(spark, str(tmp_path / "d"), "pre", str(tmp_path / "r"), "pre_")
    assert {(r.table_name, r.rows, r.valid) for r in out.collect()} == {("one", 1, None), ("two", 2, None)}
    assert sinks.current_layer(spark, str(tmp_path / "r"), "tables", "one").collect() == [(1, "a", 2)]
    both = scan.scan_dir(spark, str(tmp_path / "d"), "pre")
    assert sorted(both.columns) == ["a", "fid", "only_a", "only_b"] and both.where("only_b is not null").count() == 2


def test_a_folder_of_files_is_one_table(spark, tmp_path):
    spark.range(100).selectExpr("id as fid").repartition(4).write.parquet(str(tmp_path / "d" / "pre_many [1].parquet"))
    spark.range(3).selectExpr("id as fid", "id as v").toPandas().to_parquet(tmp_path / "d" / "pre_one.parquet")
    tables = scan.dir_tables(spark, str(tmp_path / "d"), "pre", "pre_")
    assert {name: df.count() for name, df in tables.items()} == {"many [1]": 100, "one": 3}
    assert tables["many [1]"].columns == ["fid"] and scan.dir_tables(spark, str(tmp_path / "d"), "nothing") == {}


def test_names_lose_no_letter():
    assert columns.slug("δ18O (‰)") == "delta18o" and columns.slug("β") == "beta" and columns.slug("µg/l") == "ug_l"
    for name in ("Ж", "--", "°"[:0]):
        with pytest.raises(ValueError):
            columns.slug(name)


def test_floating_text_is_exact(spark):
    from strata.functions import clean
    values = [1.234567890123e-4, 1e-15, 3.2e-13, 1.5e30, -2.5e-7, 4.9e-324, 1.7976931348623157e308, 1e7, 123456789.25, 0.1, -0.0, 1e22, 9.999e15]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = df.select("v", clean.plain_text(F.col("v"), df.schema["v"].dataType).alias("t")).collect()
    assert all("E" not in r.t and float(r.t) == r.v for r in out), out


def test_a_unit_with_two_rules_is_refused(spark):
    units = spark.createDataFrame([(1, "A", 1, 2, 3), (2, "A", 4, 5, 6)], "id long, sigla string, r int, g int, b int")
    with pytest.raises(GateError, match="repeated sigla"):
        jobs.style_table(units, spark.createDataFrame([("A",)], "sigla string"))


def test_quarantine_and_clean_rows_are_all_rows(spark):
    bronze = samples(spark, **{"Cu ppm": F.when(F.col("objectid") == 2, "??").otherwise(F.col("`Cu ppm`"))})
    bronze = jobs.bronze_frame(bronze, spec())
    bad = quality.distinct_keys(jobs.bad_values(bronze, spec()), "amostra")
    kept = bronze.join(bad, bronze.objectid == bad.amostra, "left_anti")
    assert {r.amostra for r in bad.collect()} == {2}
    assert {r.objectid for r in kept.collect()} == {1, 3}


def test_enforce_names_the_first_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(GateError, match=r"key: 1 violations, first \[\(1, 2\)\]"):
        quality.enforce(quality.unique_key(df, ["k"]), "key", ["k"])
    quality.enforce(quality.unique_key(df.distinct(), ["k"]), "key")


def feature_source(spark):
    ship(spark)
    cells = [polygon(SQUARE), polygon(SQUARE[:-1]), polygon([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]), None,
             polygon(FAR[:1] + FAR)]
    rows = [(i, f"n{i}\x00", bytearray(c) if c else None) for i, c in enumerate(cells)]
    return spark.createDataFrame(rows, "objectid long, nome string, shape binary")


@pytest.mark.parametrize("auto_repair", [True, False])
def test_feature_run(spark, tmp_path, auto_repair):
    job = FeatureSpec(source="a.layer", target="gold.a_layer", srid=4326, auto_repair=auto_repair)
    paths = jobs.run_features(feature_source(spark), job, str(tmp_path))
    gold = spark.read.parquet(paths["gold"])
    assert geometry.srid_of(gold, "geometry") == 4674
    rows = {r.fid: r for r in gold.collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4] and rows[1].nome == "n1"
    assert bytes(rows[1].geometry) == (polygon(SQUARE) if auto_repair else polygon(SQUARE[:-1]))
    assert bytes(rows[4].geometry) == polygon(FAR[:1] + FAR)  # valid features are not touched
    layers = spark.read.parquet(paths["layers"])
    faults = {(r.layer, r.fid): r.invalid_reason for r in layers.where("layer <> 'valid'").collect()}
    left = {("invalid_after_autorepair", 2): "Self-intersection", ("invalid_after_autorepair", 3): None}
    assert faults == {("invalid", 1): "Ring not closed", ("invalid", 2): "Self-intersection", ("invalid", 3): None,
                      **(left if auto_repair else {})}
    report = spark.read.parquet(paths["report"]).first()
    assert report.has_null_byte_str and report.crs_is_different and report.has_invalid_geometry
    audit = spark.read.parquet(paths["audit"]).first()
    assert (audit.target, audit.rows_inserted) == ("gold.a_layer", 5) and audit.updated_at is not None


def test_repeated_fid_stops_the_feature_run(spark, tmp_path):
    source = feature_source(spark).withColumn("objectid", F.lit(1).cast("long"))
    with pytest.raises(GateError, match="repeated fid"):
        jobs.run_features(source, FeatureSpec(source="a", target="b"), str(tmp_path))


@pytest.mark.parametrize("gate", ["repeated fid", "features behind the repair", "no SRID", "late"])
def test_a_failing_feature_run_leaves_all_tables_of_the_last_good_one(spark, tmp_path, monkeypatch, gate):
    job, root = FeatureSpec(source="a.layer", target="gold.a_layer", srid=4326), str(tmp_path)
    good = jobs.run_features(feature_source(spark), job, root)
    counts = {part: spark.read.parquet(path).count() for part, path in good.items()}
    source = feature_source(spark)
    if gate == "repeated fid":
        source = source.union(source)
    elif gate == "no SRID":
        monkeypatch.setattr(geometry, "reproject", lambda df, geom, srid: df.withColumn(geom, F.concat(geom, F.lit(b""))))
    elif gate == "late":  # lost in the very last table
        def lose(*_args, **_how):
            raise RuntimeError("late")
        monkeypatch.setattr(sinks, "hand_over", lose)
    else:
        from strata.operators import features
        split = features.split_layers
        monkeypatch.setattr(features, "split_layers", lambda *a: {k: v.where("fid <> 0") for k, v in split(*a).items()})
    with pytest.raises(Exception, match=gate):
        jobs.run_features(source, job, root)
    assert jobs.current_features(spark, root, job.target) == {k: v for k, v in good.items() if k != "audit"}
    assert {part: spark.read.parquet(path).count() for part, path in good.items()} == counts
    if gate != "late":
        return
    monkeypatch.undo()
    again = jobs.run_features(feature_source(spark).where("objectid < 3"), job, root)
    assert jobs.current_features(spark, root, job.target)["gold"] == again["gold"] != good["gold"]
    assert [r.rows_inserted for r in spark.read.parquet(again["audit"]).orderBy("updated_at").collect()] == [5, 3]


def test_layers_hand_over_after_their_gates(spark, tmp_path):
    """Feature and layer sinks keep the last good run when a later one breaks a gate."""
    located = geometry.with_srid(spark.range(3).withColumn("geometry", F.lit(bytearray(polygon(SQUARE)))), "geometry", 4326)
    many = F.col("id") > 1
    for home, write in ((f"{tmp_path}/f", lambda df, **how: sinks.write_features(df, f"{tmp_path}/f", **how)),
                        (f"{tmp_path}/l", lambda df, **how: sinks.write_layers({"all": df}, f"{tmp_path}/l", **how))):
        good = write(located.limit(2), gates={"too_many": many})
        with pytest.raises(GateError, match="too_many"):
            write(located, gates={"too_many": many})
        with pytest.raises(GateError, match="empty"):
            write(located.limit(0), check=lambda df: quality.enforce(quality.not_empty(df), "empty"))
        assert sinks.current_run(spark, home) == good and spark.read.parquet(good).count() == 2
        assert sinks.current_run(spark, home) != write(located) == sinks.current_run(spark, home)


def test_layers_prune_to_their_directory(spark, tmp_path):
    path = sinks.write_layers({"valid": spark.range(3), "invalid": spark.range(2)}, str(tmp_path / "l"))
    df = scan.read_named_layer(spark, path, "invalid")
    assert df.count() == 2
    assert len(df.inputFiles()) and "PartitionFilters: [isnotnull(layer" in df._jdf.queryExecution().toString()


def test_scan_dir_takes_tokens_literally(spark, tmp_path):
    for name in ("pre_af_x.parquet", "pre_[af]_y.parquet", "other.parquet"):
        os.makedirs(tmp_path / "d", exist_ok=True)
        spark.range(2).toPandas().to_parquet(tmp_path / "d" / name)
    named = columns.with_table_name(scan.scan_dir(spark, str(tmp_path / "d"), "[af]"), "pre_")
    assert {r.table_name for r in named.collect()} == {"[af]_y"}
    assert scan.scan_dir(spark, str(tmp_path / "d"), "af").count() == 4


def test_database_hands_over_wkb():
    assert scan.spatial_query("a.layer", ["objectid", "nome", "shape"], "shape") == \
        "(SELECT objectid, nome, sde.st_asbinary(shape) AS shape FROM a.layer) features"


@pytest.mark.parametrize("kind", ["count", "weight"])
def test_direct_pivot_equals_the_long_way(spark, kind):
    import dataclasses
    from strata.operators import joins, reshape
    cols, names, job = {
        "count": (inputs.count_columns, inputs.COUNT_ANALYTES, inputs.COUNT_SPEC),
        "weight": (inputs.weight_columns, inputs.WEIGHT_ANALYTES, inputs.WEIGHT_SPEC),
    }[kind]
    bronze = inputs.derived(spark, "/root/testdata/sf0.001", "orders", cols())
    assay = jobs.assay_frame(bronze, job)
    labels = [job.labels.get(n, n) for n in names]
    long_way = joins.survey_pivot_join(
        jobs.survey_frame(bronze, job),
        reshape.pivot_assays(assay, labels, val=job.value_columns[0]))
    direct = jobs.survey_pivot_frame(bronze, job)
    assert direct.columns == long_way.columns
    assert direct.exceptAll(long_way).isEmpty() and long_way.exceptAll(direct).isEmpty()


def test_all_media_in_one_partitioned_table(spark, tmp_path):
    bronze = jobs.bronze_frame(samples(spark), spec())
    path = jobs.run_all_assays({"solo": (bronze, spec()), "rocha": (bronze, spec())}, str(tmp_path / "all"))
    assert {(r.meio, r["count"]) for r in spark.read.parquet(path).groupBy("meio").count().collect()} == {
        ("solo", 4), ("rocha", 4)}


def test_type_inference(spark):
    df = spark.createDataFrame([("1", "1.5", "x", "1", None, "007", "1.50"), ("2", "3", "4", "1d", None, "8", "2.0")],
                               "a string, b string, c string, d string, e string, f string, g string")
    assert dict(columns.infer_types(df).dtypes) == {
        "a": "bigint", "b": "double", "c": "string", "d": "string", "e": "string", "f": "string", "g": "string"}
    assert dict(columns.infer_types(df, ["b"]).dtypes)["a"] == "string"


def test_generic_types(spark):
    df = spark.sql("select cast(1 as decimal(10,0)) a, cast(1 as decimal(30,0)) b, cast(1.5 as decimal(5,2)) c, "
                   "date'2020-01-02' d, 1 e")
    assert dict(columns.generalize_types(df).dtypes) == {
        "a": "bigint", "b": "decimal(30,0)", "c": "decimal(5,2)", "d": "timestamp_ntz", "e": "int"}
