"""Job-advert analytics as Spark jobs: landing, cleaning, quality, text scan, trends, history."""
