"""Multi-step plans: layer refinement, reports and experiments."""
