"""Document outlines from laid-out text lines, as Spark DataFrame transformations."""
