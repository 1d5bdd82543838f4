"""Credit feature and label store on Spark: operators, sources and layer plans."""
