"""plinth: building-footprint fusion and corpus preparation on Spark."""
