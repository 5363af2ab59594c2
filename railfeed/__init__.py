"""railfeed: Spark jobs for a rail and weather feed warehouse."""
