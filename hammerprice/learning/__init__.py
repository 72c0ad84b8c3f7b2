"""Feature preparation and regression on ``pyspark.ml``."""
