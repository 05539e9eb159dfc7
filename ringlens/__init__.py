"""Call-tracking and marketing report library, plus a documentation-page ETL, on Spark."""
