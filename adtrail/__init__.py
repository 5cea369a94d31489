"""adtrail: advertising event data on Spark, from raw topics to attribution."""
