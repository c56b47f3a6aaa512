"""Writers. Spark's commit protocol publishes a result as a whole or not at all."""
