"""Payment-risk analytics as plain PySpark: ingest, enrich, score, export, report, graph, text set."""
