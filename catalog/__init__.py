"""The registered queries, their SQL counterparts, and how the given tables feed the model."""
