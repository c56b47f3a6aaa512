"""tallygrid: statistics of large Monte Carlo parameter sweeps as Spark jobs."""

__version__ = "0.1.0"
