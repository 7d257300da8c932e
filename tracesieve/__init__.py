"""Curation, grading and evaluation of reasoning-trace datasets on Spark."""
