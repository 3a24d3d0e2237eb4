"""Pattern-mining operators expressed as Spark DataFrame plans."""
