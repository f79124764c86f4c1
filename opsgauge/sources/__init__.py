"""Reading tables, the schemas they must fit, and writing the report."""
