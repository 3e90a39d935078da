"""Web-page analytics on Spark: frontier, extraction, classification, versioned articles, reports."""
