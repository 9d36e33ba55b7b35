"""Structured Streaming versions of scoring, monitoring, SRM, PSI and the batched bandit."""
