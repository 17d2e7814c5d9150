"""The layered run and the queries over the test tables."""
