"""pulsegrid — telemetry analytics (metrics, logs, traces, query corpora) on Spark DataFrames."""

__version__ = "0.1.0"
