"""Multi-step jobs: star-schema load, analytic reports, file import."""
