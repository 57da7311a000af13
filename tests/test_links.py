"""The link view shuffles and writes the columns that it shows, and no copy of a key."""

from linkscout.operators import links


def test_link_view_carries_what_it_shows(spark, monkeypatch):
    written = []

    def counted(df):
        written.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return df, df.count()

    monkeypatch.setattr(links, "counted", counted)
    columns = "circuit_id long, name string, bandwidth string, circuit_type string, a_location_clli string, z_location_clli string"
    rows = [(1, "FW-1-B1-B2", "100", links.LINK_TYPE, "B3", None), (2, "FW-2-B9-B2", "", links.LINK_TYPE, None, "B1"), (3, "FW-3-B1-B2", "5", "Dark Fiber", "B1", "B2"),
            (4, "FW-4-B1-B8", "7", links.LINK_TYPE, "B1", "B8"), (4, "FW-4-B1-B8", "7", links.LINK_TYPE, "B1", "B8")]
    buildings = spark.createDataFrame([("B1", 1.0, 2.0), ("B2", 1.5, 2.5), ("B3", 3.0, 4.0), ("B3", 3.5, 4.5), (None, 0.0, 0.0)], "name string, lon double, lat double")
    view = links.link_view(spark.createDataFrame(rows, columns), buildings)
    found = sorted(((r.name, r.a_loc_clli, r.geom_info, r.bandwidth_mbps) for r in view.collect()), key=str)
    want = [("FW-1-B1-B2", "B3", "All Geometries Present", 100)] * 3 + [("FW-2-B9-B2", "B9", "Missing A-Location Lat/Long", None)] * 2
    assert found == sorted(want + [("FW-4-B1-B8", "B1", "Missing Z-Location Lat/Long", 7)] * 2, key=str)
    assert len(written) == 2
    for names, plan in written:
        assert "circuit_id" not in names and "_code#" not in plan and "_part#" not in plan
