"""Learners, batch scoring and the Estimator/Model pair."""
