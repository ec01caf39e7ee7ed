"""DataFrame → DataFrame steps: activity, novelty, alerts."""
