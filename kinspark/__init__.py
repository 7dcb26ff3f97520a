"""kinspark: record linkage and corpus operators as Spark plans."""
