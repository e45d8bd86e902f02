"""Sources: the nine platform-telemetry tables as DataFrames."""
