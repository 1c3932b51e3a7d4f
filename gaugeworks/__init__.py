"""gaugeworks: DataFrame and Structured Streaming operators for machine-sensor telemetry."""

__version__ = "0.1.0"
