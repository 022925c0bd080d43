"""Sources and sinks: delimited text, Parquet, fitted models, metric logs."""
