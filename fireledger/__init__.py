"""Fire-emission warehouse on Spark: cleaning, dimensions, fact, audits, reports."""
