"""rollforge: rollout, preference and evaluation data jobs for PySpark.

Every job is a ``DataFrame -> DataFrame`` function or a ``Column`` builder.
Model outputs (responses, log-probabilities, scores, embeddings) are inputs.
"""

__version__ = "0.1.0"
