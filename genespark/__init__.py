"""Gene-annotation refinement as Spark DataFrame operators."""
