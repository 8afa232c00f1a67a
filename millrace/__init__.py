"""millrace: a Spark-first engine for curating large multimodal web corpora."""

__version__ = "0.1.0"
