"""The registered queries: stand-in inputs, Spark queries and their SQL counterparts."""
