"""Multi-step results: marts, cohorts, scoring, cleaning and feature runs."""
