"""fieldlake: farm-sensing and plant-health analytics as Spark DataFrame jobs."""

__version__ = "0.1.0"
