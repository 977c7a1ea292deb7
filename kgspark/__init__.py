"""kgspark: knowledge-graph construction and training-data operators on PySpark."""
