"""Hospital activity analytics on Spark: record classification, cohorts, rates, flows and extracts."""
