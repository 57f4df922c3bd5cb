"""tidemill: a dataset-curation engine on the DataFrame, SQL and Structured Streaming APIs."""
