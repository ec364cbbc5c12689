"""Trip analytics as Spark jobs: landing, cleaning, reports and dashboard data sets."""
