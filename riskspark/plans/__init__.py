"""Composite plans (risk scoring, persistence, gap suspecting, claim preparation)."""
