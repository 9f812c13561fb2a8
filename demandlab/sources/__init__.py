from demandlab.sources.io import Tables, load, materialize, profile, read_panel_csv, write_panel  # noqa: F401
