"""Insurance-claim analytics expressed as Spark DataFrame and SQL plans."""
