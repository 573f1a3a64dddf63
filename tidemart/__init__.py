"""tidemart: commerce-event funnel analytics expressed as plain Spark DataFrames."""
