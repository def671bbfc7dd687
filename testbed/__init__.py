"""The driver's tables mapped onto the lake's inputs, the queries over them, and their checks."""
