"""The query catalogue: each query as a plan of operators, and the SQL it must equal."""
