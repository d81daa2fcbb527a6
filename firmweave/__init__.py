"""Company registry engine on Spark: clean, match, harmonise, load, model."""
