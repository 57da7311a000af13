"""Plan checks and files."""

import pytest

from linkscout.operators import classify, links, ranker
from linkscout.plans import catalog
from linkscout.sources import readers, sinks
from linkscout.sources.fixtures import Fixtures


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["link_view", "fcc_buffer_join", "roof_points", "vector_g", "hub_lookup", "cci_rank"])
def test_no_all_pairs_join(spark, sf_dir, name):
    plan = physical(catalog.QUERIES[name](spark, sf_dir))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name,table,scans,all_scans", [
    ("roof_points", "part.parquet", 1, 3), ("link_view", "part.parquet", 1, 3), ("disjunctive_join", "part.parquet", 1, 3),
    ("fcc_buffer_join", "orders.parquet", 0, 12), ("building_rank_all", "orders.parquet", 0, 14), ("path_clearance", "events.parquet", 2, 3),
])
def test_inputs_are_read_once(spark, sf_dir, name, table, scans, all_scans):
    """Joins count their keys when they are built; the plan that is left reads each base table once and what was written."""
    plan = physical(catalog.QUERIES[name](spark, sf_dir)).split("== Initial Plan ==")[0]
    assert sum(table in line for line in plan.splitlines() if "FileScan" in line) <= scans
    assert plan.count("FileScan") <= all_scans


def test_report_reads_only_its_columns(spark, sf_dir, tmp_path):
    fx = Fixtures(spark, sf_dir)
    fx["fx_scrub"].write.parquet(str(tmp_path / "scrub"))
    fx["fx_cci_sites"].write.parquet(str(tmp_path / "sites"))
    scrub, sites = spark.read.parquet(str(tmp_path / "scrub")), spark.read.parquet(str(tmp_path / "sites"))
    plan = physical(classify.classification("b", scrub, sites).drop("crown_area"))
    assert "In(structure_id" in plan and "In(s_bu_type_code" in plan
    assert "open_levels" not in plan and "s_pop_tier_name" not in plan


def test_link_views(spark, sf_dir):
    d = catalog.Data(spark, sf_dir)
    public = links.register_link_views(d["circuits"], d.buildings)
    assert spark.table("link_lines").count() == public.count()


def test_files(spark, sf_dir, tmp_path):
    d = catalog.Data(spark, sf_dir)
    run = d.run()
    sinks.write_candidate_file(run.all_ranked, str(tmp_path / "candidates"))
    rows = spark.read.csv(str(tmp_path / "candidates"), header=True)
    assert rows.columns == ["site_id", "candidate_type", "id", "lat", "long", "fw_rank"]
    assert rows.count() == run.assembled.count()
    sinks.write_report(run.ranked, str(tmp_path / "report"))
    report = spark.read.parquet(str(tmp_path / "report"))
    assert "height" not in report.columns and "power_company" in report.columns
    assert report.count() == run.ranked.count()
    sinks.write_rank_sheets({"ospi": ranker.rank_sheet(run.ranks["ospi"], "ospi", run.all_ranked)}, str(tmp_path / "sheets"))
    assert spark.read.parquet(str(tmp_path / "sheets")).where("candidate_type = 'ospi'").count() > 0
    sinks.write_layers(run.ranked, d.sources, str(tmp_path / "layers"))
    assert spark.read.parquet(str(tmp_path / "layers/spider_lines")).count() == run.ranked.count()
    sinks.write_geojson_lines(spark.read.parquet(str(tmp_path / "layers/candidates")), str(tmp_path / "geojson"))
    assert spark.read.text(str(tmp_path / "geojson")).where("value like '%\"Point\"%'").count() == run.ranked.count()


def test_whole_run_to_files(spark, sf_dir, tmp_path):
    """All files of a run, in their order, published together with their rows, and no intermediate left behind."""
    import os

    from linkscout.operators import storage
    from linkscout.plans import site_search

    d = catalog.Data(spark, sf_dir)
    t = d.tables()
    before = sorted(os.listdir(storage.shared_root(spark))) if os.path.isdir(storage.shared_root(spark)) else []
    path = str(tmp_path / "out")
    site_search.run_to_files(t, d.cleared, ["candidate_type", "id"], path)
    assert sorted(os.listdir(storage.shared_root(spark))) == before
    manifest = sinks.current(spark, path)
    kinds = ("candidates", "report", "sheets", "layers", "ranked", "tower_scrub", "planner")
    assert set(os.listdir(f"{path}/{manifest['run']}")) == set(kinds)

    def folder(table):
        return sinks.current_folder(spark, path, table)

    for table, about in manifest["tables"].items():
        reader = spark.read.option("header", True).csv if table in ("candidates", "ranked", "tower_scrub", "planner") else spark.read.parquet
        assert reader(folder(table)).count() == about["rows"]
    planner = spark.read.csv(folder("planner"), header=True)
    assert planner.count() == t.sources.count() and "Max Power (dBm)" in planner.columns
    scrub = spark.read.csv(folder("tower_scrub"), header=True)
    assert tuple(scrub.columns) == classify.SCRUB_SHEET and scrub.count() > 0
    # Order inside the files: by site and rank.
    files = sorted(f for f in os.listdir(folder("candidates")) if f.startswith("part"))
    rows = [(r.site_id, int(r.fw_rank) if r.fw_rank else -1) for f in files for r in spark.read.csv(f"{folder('candidates')}/{f}", header=True).collect()]
    assert rows == sorted(rows) and len(rows) > 0
    parts = sorted(f for f in os.listdir(folder("report")) if f.startswith("part"))
    report = [(r.site_id, r.fw_rank) for f in parts for r in spark.read.parquet(f"{folder('report')}/{f}").collect()]
    assert report == sorted(report) and len(report) > 0
    columns = spark.read.parquet(folder("report"))
    assert all(columns.where(f"`{c}` is not null").limit(1).count() for c in columns.columns)
    # A run that fails midway leaves the one before as it was.
    with pytest.raises(RuntimeError), sinks.published(spark, path) as failed:
        failed.watched("candidates", spark.range(3)).write.parquet(failed.folder("candidates"))
        raise RuntimeError("lost")
    assert sinks.current(spark, path) == manifest and spark.read.csv(folder("candidates"), header=True).count() == len(rows)
    with sinks.published(spark, path) as second:
        second.watched("candidates", spark.range(3)).write.parquet(second.folder("candidates"))
    assert sinks.current(spark, path)["tables"]["candidates"]["rows"] == 3 and len(os.listdir(f"{path}/manifests")) >= 2


def test_absent_sink_fields_raise(spark, sf_dir):
    from linkscout.operators import outputs

    ranked = catalog.Data(spark, sf_dir).run().ranked
    assert outputs.sink_rows(ranked).count() > 0
    with pytest.raises(ValueError, match="missing columns: modulation, state"):
        outputs.sink_rows(ranked.drop("modulation", "state"))


def test_materialising_needs_a_shared_folder(spark, monkeypatch):
    from linkscout.operators import storage

    class Elsewhere:
        class sparkContext:
            applicationId, master = "other", "spark://host:7077"

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_root(Elsewhere)


def test_candidate_csv(spark, tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text(",candidate_type,id,cand_dist_km,long,lat,height,pnt_geom,Clearance_Score\n3,re_asd,11,0.4,-73.9,40.7,131.0,,Pass\n")
    row = readers.read_candidates(spark, str(path)).first()
    assert (row.id, row.height, row.pnt_geom, row.clearance_score) == ("11", 131.0, None, "Pass")
