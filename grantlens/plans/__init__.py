"""Whole jobs: cleaning, questions, summaries, filtered views, samples, reports."""
