"""Annotation-quality analytics on Spark: DataFrame operators to check, reconcile, score and publish large annotated corpora."""
