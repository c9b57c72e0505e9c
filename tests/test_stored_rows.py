"""What queries store and shuffle on their way to the result."""

from __future__ import annotations

from lotseries.bindings import queries, tables


def test_the_cycles_store_only_what_is_used(spark, tmp_path, monkeypatch):
    """The master is stored once, with the columns used, by the queries that read it twice."""
    kept = []
    monkeypatch.setattr(queries, "stored", lambda df: kept.append(df.columns) or df)
    monkeypatch.setattr(tables, "table", lambda s, _, name: s.read.parquet(f"/root/testdata/sf0.001/{name}.parquet"))
    for name in ("next_harvest", "cycle_age", "valid_cycles", "sampled_renovations", "csv_round_trip"):
        kept.clear()
        monkeypatch.setattr(queries.reports, "sampled_renovations", lambda rows: rows)
        monkeypatch.setattr(queries.writers, "write_csv", lambda df, path: None)
        monkeypatch.setattr(queries.readers, "read_observations_csv", lambda s, path: None)
        queries.QUERIES[name](spark, "")
        wanted = ["lot_id", "obs_date", "nir", "red", "swir", "noise", "part"] if name == "csv_round_trip" else ["lot_id", "obs_date", "harvest", "ndvi_ref"]
        assert kept == [wanted], name
