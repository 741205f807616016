"""docquarry: a Spark-first engine that turns documents into retrieval and training data."""
