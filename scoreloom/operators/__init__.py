"""The steps of the run: documents, games, statistics, upsert, feed and derived metrics."""
