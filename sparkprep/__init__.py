"""sparkprep: data preparation, data quality, text mining and model
evaluation as composable Spark DataFrame operators."""

__version__ = "0.1.0"
