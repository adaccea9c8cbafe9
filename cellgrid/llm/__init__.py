"""Operations of a large-scale training-data pipeline, each a composition of Spark DataFrames.

Nothing else in the library imports this subpackage; ``queries.py`` registers one query per operator.
"""
