"""logonlens: login-anomaly analytics over authentication and red-team logs on Spark.

Every operator is a plain function from DataFrames to a DataFrame; reading and
writing live in :mod:`logonlens.sources`, orchestration in :mod:`logonlens.plans`.
"""

__version__ = "0.1.0"
