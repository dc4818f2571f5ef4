"""ebbflow — subscriber-churn analytics as Spark jobs.

Profiling, cleaning, imputation, feature encoding, exact stratified
splits, Spark ML fitting and scoring, threshold sweeps and ranking
metrics, all expressed as DataFrame plans so Catalyst and AQE decide the
physical strategy.
"""

__version__ = "0.1.0"
