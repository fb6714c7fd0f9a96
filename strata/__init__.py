"""A layered analytics engine on Spark DataFrames: raw records, dimensions with history, facts, summaries, reports,
streams, graphs and governance."""
