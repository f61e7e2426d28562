"""spanloom: labelled time intervals, sampled signals and training-data preparation as Spark jobs."""
