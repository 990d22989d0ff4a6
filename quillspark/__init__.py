"""quillspark: Spark-first analytics over collections of scholarly and document records."""

__version__ = "0.1.0"
