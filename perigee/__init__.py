"""Close-approach analytics on Spark: daily feed documents in, day stores and marts out."""
