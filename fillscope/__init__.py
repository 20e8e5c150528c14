"""fillscope: prediction-market trade analytics as Spark DataFrame jobs."""

__version__ = "0.1.0"
