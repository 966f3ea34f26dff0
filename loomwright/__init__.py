"""Curation of corpora of papers, diagrams and rendered pages, on Spark."""
