"""Speech and text corpus curation on Spark."""
