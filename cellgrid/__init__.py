"""Spark-native analytics for many-marker tissue images and, in ``llm``, for training text."""
