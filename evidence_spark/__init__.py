"""Evidence and claim analytics over timed transcripts and articles, on Spark DataFrames."""
