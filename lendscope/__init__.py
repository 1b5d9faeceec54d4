"""lendscope: credit-risk data jobs (clean, sample, split, features, learners,
evaluation, ranking, drift, refit, scoring) as Spark DataFrame plans."""

__version__ = "0.1.0"
