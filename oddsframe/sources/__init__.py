"""Sources and sinks: league CSV files, the data dictionary, layer tables,
and the test harness match table derived from ``orders``."""
