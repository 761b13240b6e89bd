"""corpusflow: curate multimodal corpora into training-ready tables on Spark."""

__version__ = "0.1.0"
