"""Sources: domain tables projected from the driver's Parquet, rule tables, files."""
