"""The operators run over the test tables, and the SQL their results must equal."""
