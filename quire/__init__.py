"""quire: document knowledge-base analytics on Spark."""
