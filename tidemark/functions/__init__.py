"""Column builders. All of them stay inside Catalyst; none is a Python UDF."""
