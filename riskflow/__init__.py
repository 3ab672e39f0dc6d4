"""Transaction-risk analytics as Spark jobs: plain DataFrame -> DataFrame functions."""
